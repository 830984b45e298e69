"""Benchmark decontamination by template canonicalisation.

Words are reduced to templates: numbers, names (capitalised words) and units
after a number become typed placeholders, other words lose case and outer
punctuation. Windows of ``WINDOW`` template words of the benchmark items are
joined by hash with the windows of all documents, once with placeholders for
names and once with the names as caseless words, since text in other case
doesn't show its names. Hits of one item near each other in a document, within
twice the item's length, are one occurrence. In it, every slot value of the item
must stand for one value of the document; windows that contradict the usual
value of a slot don't count. An item is found when the windows that count
cover at least ``COVERAGE`` of its windows: verbatim if every slot has the
item's own value, otherwise re-parameterised.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from rillmark.llm import arrays as A
from rillmark.llm.tables import cut, fresh
from rillmark.operators.joins import lookup

WINDOW = 5
COVERAGE = 0.8
#: A window with fewer literal words keeps its words instead of placeholders.
LEAST_LITERALS = 2
#: Bits of the filter for each window of the benchmark, and the most bits of the whole filter (32 MB), as a power of two.
BITS_A_KEY, MOST_BITS = 64, 28
LITERAL, NUMBER, NAME, UNIT = range(4)
# Unit words that become a placeholder after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes lb lbs pound pounds ounce ounces "
    "ml l litre litres liter liters gallon gallons cup cups second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros usd eur percent degree degrees kmh mph volt volts watt watts kw kwh"
).split()
NUMBER_TEXT = r"^[+\-]?[$€£]?[0-9][0-9.,:/]*%?$"
NAME_TEXT = r"^\p{Lu}\p{L}*\p{Ll}"
EDGES = r"^[^\p{L}\p{N}$€£+\-]+|[^\p{L}\p{N}%]+$"


@dataclass
class Templates:
    """Template words of some texts: exact and placeholder hashes, the latter with and without names as slots, slot types and the text each word belongs to."""

    exact: np.ndarray
    slotted: np.ndarray
    worded: np.ndarray
    kind: np.ndarray
    codes: np.ndarray
    cores: list[str]
    counts: np.ndarray

    def windows(self, size: int, names: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window of ``size`` words, with names as slots or as words, and whether it lies in one text."""
        literal = self.kind == LITERAL if names else (self.kind == LITERAL) | (self.kind == NAME)
        literals = np.concatenate([[0], np.cumsum(literal)])
        n = max(0, len(self.exact) - size + 1)
        few = literals[size : size + n] - literals[:n] < min(LEAST_LITERALS, size)
        room = np.repeat(np.cumsum(self.counts), self.counts) - np.arange(len(self.exact))
        return np.where(few, A.rolling(self.exact, size), A.rolling(self.slotted if names else self.worded, size)), room[:n] >= size


def canonical(column: pa.Array) -> Templates:
    """Template words; words without a letter or digit are left out, null has none."""
    words = A.words_of(column)
    cores = pc.replace_substring_regex(A.valid_text(words.vocab), EDGES, "")
    number = pc.match_substring_regex(cores, NUMBER_TEXT).to_numpy(zero_copy_only=False)
    name = pc.match_substring_regex(cores, NAME_TEXT).to_numpy(zero_copy_only=False)
    real = pc.match_substring_regex(cores, r"[\p{L}\p{N}]").to_numpy(zero_copy_only=False)
    lower = pc.utf8_lower(cores)
    unit = pc.is_in(lower, pa.array(UNITS, pa.large_string())).to_numpy(zero_copy_only=False)
    texts = [t.casefold() for t in cores.to_pylist()]
    exact = np.fromiter((xxhash.xxh64_intdigest(t, 7) for t in texts), np.uint64, len(texts))
    keep = real[words.codes] if words.size else np.empty(0, bool)
    codes = words.codes[keep]
    docs = words.docs[keep]
    counts = np.bincount(docs, minlength=len(words.counts))
    kind = np.where(number, NUMBER, np.where(name, NAME, LITERAL)).astype(np.int8)[codes] if len(codes) else np.empty(0, np.int8)
    if len(codes):
        after_number = np.zeros(len(codes), bool)
        after_number[1:] = (kind[:-1] == NUMBER) & (docs[1:] == docs[:-1])
        kind[after_number & unit[codes]] = UNIT
    exact = exact[codes] if len(codes) else np.empty(0, np.uint64)
    marks = np.array([0, *(xxhash.xxh64_intdigest(t, 11) for t in ("number", "name", "unit"))], np.uint64)
    slotted = np.where(kind == LITERAL, exact, marks[kind])
    return Templates(exact, slotted, np.where(kind == NAME, exact, slotted), kind, codes, texts, counts)


SALTS = {(size, names): np.uint64(xxhash.xxh64_intdigest(f"{size}{names}", 13)) for size in range(1, WINDOW + 1) for names in (True, False)}


def window_keys(made: Templates, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Window size, first words and join keys of all windows of these sizes, with names as slots and as words."""
    for size, names in product(sizes, (True, False)):
        hashes, whole = made.windows(size, names)
        at = np.flatnonzero(whole)
        yield size, at, hashes[at] ^ SALTS[size, names]


ITEM = "kinds array<int>, words array<string>, size int, keys array<bigint>, places array<int>"


def _items(benchmark: DataFrame) -> DataFrame:
    """``(item, item_no)`` and :data:`ITEM`, a row for each item with a word, on a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, "text"):
            made = canonical(piece.column(1))
            begins, size = np.cumsum(made.counts) - made.counts, np.minimum(made.counts, WINDOW)
            keys, places = [[] for _ in made.counts], [[] for _ in made.counts]
            for width, at, found in window_keys(made, sorted(set(size.tolist()) - {0})):
                owner = np.searchsorted(begins + made.counts, at, side="right")
                for i, place, key in zip(owner.tolist(), at.tolist(), found.view(np.int64).tolist(), strict=True):
                    if size[i] == width:
                        keys[i].append(key)
                        places[i].append(place - int(begins[i]))
            words = [[made.cores[c] for c in made.codes[b : b + n]] for b, n in zip(begins, made.counts, strict=True)]
            kinds = [made.kind[b : b + n].tolist() for b, n in zip(begins, made.counts, strict=True)]
            ints, texts = pa.list_(pa.int32()), pa.list_(pa.string())
            columns = [pa.array(kinds, ints), pa.array(words, texts), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(places, ints)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns], names=["item", "kinds", "words", "size", "keys", "places"])

    kind = StructType([StructField("item", benchmark.schema["item"].dataType), *StructType.fromDDL(ITEM).fields])
    return cut(benchmark.mapInArrow(run, kind).filter("size > 0").withColumn("item_no", F.monotonically_increasing_id()), "items")


class KeyFilter:
    """A Bloom filter of ``2 ** power`` bits, two of them for each window key."""

    CHUNK = 1 << 16

    def __init__(self, power: int):
        self.power, self.shift, self.bits = power, np.uint64(64 - power), np.zeros(1 << power - 3, np.uint8)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return keys >> self.shift, (keys * A.MULTIPLIER) >> self.shift

    def add(self, keys: np.ndarray) -> None:
        for at in self.places(keys):
            np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        held = np.ones(len(keys), bool)
        for at in self.places(keys):
            held &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return held

    def chunks(self) -> Iterator[tuple[int, bytes]]:
        for lo in range(0, len(self.bits), self.CHUNK):
            part = self.bits[lo : lo + self.CHUNK]
            if part.any():
                yield lo, part.tobytes()

    def merge(self, lo: int, raw: bytes) -> None:
        self.bits[lo : lo + len(raw)] |= np.frombuffer(raw, np.uint8)


def _filter_of(windows: DataFrame, most_bits: int) -> KeyFilter:
    """The filter of all keys, made in the tasks; the driver joins their bits one piece after the other."""
    power = min(most_bits, max(19, (windows.count() * BITS_A_KEY).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = KeyFilter(power)
        for batch in batches:
            own.add(batch.column(0).to_numpy().view(np.uint64))
        for lo, raw in own.chunks():
            yield pa.record_batch([pa.array([lo], pa.int64()), pa.array([raw], pa.binary())], names=["lo", "raw"])

    bits = KeyFilter(power)
    for row in windows.select("key").mapInArrow(run, "lo long, raw binary").toLocalIterator():
        bits.merge(row.lo, row.raw)
    return bits


def _hits(docs: DataFrame, wanted: KeyFilter, sizes: list[int]) -> DataFrame:
    """``(row, doc_id, word, key, heard)``: windows of documents whose key the filter may hold, with their words. One scan."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for piece in A.pieces(batches, "text"):
            made = canonical(piece.column(1))
            ends = np.cumsum(made.counts)
            for size, at, keys in window_keys(made, sizes):
                hit = held.value.may_hold(keys)
                at, keys = at[hit], keys[hit]
                doc = np.searchsorted(ends, at, side="right")
                heard = [[made.cores[c] for c in made.codes[a : a + size]] for a in at.tolist()]
                if len(at):
                    columns = [pa.array(row + doc), piece.column(0).take(pa.array(doc)), pa.array((at - (ends - made.counts)[doc]).astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(heard, pa.list_(pa.string()))]
                    yield pa.record_batch(columns, names=["row", "doc_id", "word", "key", "heard"])
            row += piece.num_rows

    head = [StructField("row", LongType()), StructField("doc_id", docs.schema["id"].dataType)]
    return docs.mapInArrow(run, StructType([*head, *StructType.fromDDL("word int, key bigint, heard array<string>").fields]))


def occurrences(pairs: list[tuple[int, int]], reach: int) -> Iterator[list[tuple[int, int]]]:
    """Hits of an item of ``reach`` words that may be one occurrence, as (word, item's word).

    First the runs whose words shift by a few places at most, then, where
    there are several runs, from the start of each all hits within twice
    the item's length: as many words as it has may stand in between.
    """
    pairs = sorted(set(pairs), key=lambda p: (p[0] - p[1], p[0]))
    group: list[tuple[int, int]] = []
    starts = []
    for pair in pairs:
        # Inserted or lost words shift the rest by a few places.
        if group and pair[0] - pair[1] - (group[-1][0] - group[-1][1]) > max(2, reach // 8):
            yield group
            starts.append(min(group)[0])
            group = []
        group.append(pair)
    yield group
    if starts:
        starts.append(min(group)[0])
        pairs.sort()
        words = [word for word, _ in pairs]
        for start in sorted(set(starts)):
            yield pairs[bisect_left(words, start) : bisect_left(words, start + 2 * reach)]


def judge(size: int, kinds: list[int], own: list[str], pairs: list[tuple[int, int]], heard: dict[int, list[str]]) -> tuple[int, int, bool]:
    """Windows that count, changed slots, and whether the occurrence is verbatim in them; ``heard`` has the words at each hit."""
    votes: dict[tuple[int, str], Counter] = defaultdict(Counter)
    seen = set()
    for word, place in pairs:
        for k in range(size):
            if kinds[place + k] != LITERAL and (word + k, place + k) not in seen:
                seen.add((word + k, place + k))
                votes[kinds[place + k], own[place + k]][heard[word][k]] += 1
    usual = {slot: min(c, key=lambda v: (-c[v], v != slot[1], v)) for slot, c in votes.items()}
    counted = {
        place
        for word, place in pairs
        if all(kinds[place + k] == LITERAL or usual[kinds[place + k], own[place + k]] == heard[word][k] for k in range(size))
    }
    changed = sum(value != slot[1] for slot, value in usual.items())
    return len(counted), changed, changed == 0


FOUND = "n_windows int, matched int, coverage double, kind string"


def _judged(met: DataFrame, coverage: float) -> DataFrame:
    """The best occurrence of each document and item whose hits cover enough of it."""
    kind = StructType([met.schema["doc_id"], StructField("item_id", met.schema["item"].dataType), *StructType.fromDDL(FOUND).fields])
    item_type = to_arrow_type(met.schema["item"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (hits, kinds, own, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("hits", "kinds", "words", "size")), strict=True)):
                total, best = len(own) - size + 1, None
                heard = {h["word"]: h["heard"] for h in hits}
                for pairs in occurrences([(h["word"], h["place"]) for h in hits], len(own)):
                    if len({place for _, place in pairs}) < coverage * total:
                        continue
                    counted, _, verbatim = judge(size, kinds, own, pairs, heard)
                    if counted >= coverage * total:
                        row = (total, counted, counted / total, "verbatim" if verbatim else "reparameterised")
                        best = max(best or row, row, key=lambda r: (r[1], r[3]))
                if best:
                    rows.append((i, *best))
            if rows:
                at, *values = zip(*rows, strict=True)
                kinds_of = (pa.int32(), pa.int32(), pa.float64(), pa.string())
                ids = [batch.column("doc_id").take(pa.array(at)), batch.column("item").take(pa.array(at)).cast(item_type)]
                yield pa.record_batch([*ids, *[pa.array(v, k) for v, k in zip(values, kinds_of, strict=True)]], names=kind.names)

    return met.select("doc_id", "item", "hits", "kinds", "words", "size").mapInArrow(run, kind)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE, most_bits: int = MOST_BITS
) -> DataFrame:
    """``(doc_id, item_id, n_windows, matched, coverage, kind)``: a row for each document and benchmark item found in it.

    Whole texts of all documents are scanned once, whatever the size of the
    benchmark: a filter of at most ``2 ** most_bits`` bits keeps windows that
    may be the benchmark's, and these are joined with its windows by hash.
    Items without a word are never found; an item shorter than a window is one
    window. Null texts have no words. Rows that repeat a doc_id have a row
    each; rows that repeat an item too. Empty tables give no rows.
    """
    items = _items(benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")))
    windows = items.select("item_no", "size", F.explode(F.arrays_zip("keys", "places")).alias("w")).select("item_no", "size", F.col("w.keys").alias("key"), F.col("w.places").alias("place"))
    windows = cut(windows, "item-windows")
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # WINDOW rows at most
    wanted = _filter_of(windows, most_bits)
    hits = cut(_hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), wanted, sizes), "window-hits")
    met = lookup(hits.withColumnRenamed("key", "met"), windows.drop("size"), "met", "key", how="inner", unique=False)
    per_item = met.groupBy("row", "doc_id", "item_no").agg(F.collect_list(F.struct("word", "place", "heard")).alias("hits"), F.count_distinct("place").alias("n"))
    known = items.select(F.col("item_no").alias("no"), "item", "kinds", "words", "size")
    enough = lookup(per_item, known, "item_no", "no", how="inner").filter(F.col("n") >= F.lit(coverage) * (F.size("words") - F.col("size") + 1))
    return _judged(enough, coverage)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. A null id is never dropped by another row's find, only by its own."""
    hits = cut(contaminated(docs, benchmark, id_col, text_col, **options).select("doc_id").distinct(), "contaminated")
    mark = fresh(docs, "_hit")
    return docs.join(hits.withColumnRenamed("doc_id", mark), docs[id_col].eqNullSafe(F.col(mark)), "left_anti")
