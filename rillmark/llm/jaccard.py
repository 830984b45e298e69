"""Links between texts whose sets of word shingles have a Jaccard similarity of at least a bound.

Candidates share one of ``BANDS`` keys of ``ROWS`` MinHash values: of pairs at
0.8 all but one in twenty million do, more similar ones miss less often. Every
candidate is then verified on the whole shingle sets, so no link is wrong.

In a key that more than ``PAIRS_TO`` sets share, all are first compared with
one of them. Keys that meet in a set make a crowd. What is still apart from
the key's first one after that is compared with all of its crowd of fitting
size, in chunks by matrix products, so that no rows of pairs are made. A large
group of near copies costs a few rows a member; sets that are many, share
keys and yet stay below the bound cost the square of their number in products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm import arrays as A
from rillmark.llm.components import components
from rillmark.llm.tables import cut

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
PAIRS_TO = 8
#: About so many sets and shingles are in a chunk that is compared at once.
CHUNK_SETS, CHUNK_HASHES = 128, 1 << 15
#: Shingles that the matrices of two chunks hold at once.
VOCAB_BLOCK = 4096
SEED = 42
_RANDOM = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_MASKS, _FACTORS = _RANDOM[0], _RANDOM[1] | np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of all texts back to back, and how many each has.

    Words are cut at ASCII white space, ASCII letters lose case; a shorter
    text is one shingle, a text without words has none.
    """
    data, offsets = A.text_buffer(column)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.astype(np.uint8) << 5)
    starts, ends, counts = A.spans(data, offsets)
    codes, vocab = A.encode_spans(data, starts, ends)
    digest = xxhash.xxh64_intdigest
    words = np.fromiter((digest(w, SEED) for w in vocab.to_pylist()), np.uint64, len(vocab))[codes]
    begins, width = np.cumsum(counts) - counts, np.minimum(counts, size)
    n = np.where(counts > 0, counts - width + 1, 0)
    hashes = np.empty(int(n.sum()), np.uint64)
    for k in sorted(set(width.tolist()) - {0}):
        some = width == k
        hashes[A.ragged((np.cumsum(n) - n)[some], n[some])] = A.rolling(words, k)[A.ragged(begins[some], n[some])]
    owner = np.repeat(np.arange(len(counts)), n)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[first], np.bincount(owner[first], minlength=len(counts))


def set_prints(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit digest of each set; texts with the same shingles share it."""
    raw, stop = hashes.tobytes(), np.cumsum(counts) * 8
    each = zip((stop - counts * 8).tolist(), stop.tolist(), strict=True)
    return np.fromiter((xxhash.xxh64_intdigest(raw[a:b], SEED) for a, b in each), np.uint64, len(counts))


def prints(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    return set_prints(*shingle_sets(column, size))


def band_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of ``BANDS`` keys for each set that isn't empty."""
    heads = (np.cumsum(counts) - counts)[counts > 0]
    keys = np.zeros((len(heads), BANDS), np.uint64)
    if len(heads):
        for i in range(BANDS * ROWS):
            least = np.minimum.reduceat((hashes ^ _MASKS[i]) * _FACTORS[i], heads)
            keys[:, i // ROWS] = keys[:, i // ROWS] * A.MULTIPLIER + least
    return keys ^ (keys >> np.uint64(29))


def set_rows(docs: DataFrame, id_col: str, text_col: str, size: int, fingerprints: Callable[[pa.Array, int], np.ndarray]) -> DataFrame:
    """``(id, fp, n, keys, bits)``, one row for each document: digest and size of its set, its band keys, and its fingerprint by the given function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, "text"):
            hashes, counts = shingle_sets(piece.column(1), size)
            ends = np.cumsum((counts > 0) * BANDS)
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(band_keys(hashes, counts).view(np.int64).ravel()))
            digests, bits = (pa.array(x.view(np.int64)) for x in (set_prints(hashes, counts), fingerprints(piece.column(1), size)))
            yield pa.record_batch([piece.column(0), digests, pa.array(counts, pa.int64()), keys, bits], names=["id", "fp", "n", "keys", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long, n long, keys array<long>, bits long")


def _sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(fp, hashes)`` of the wanted prints; only documents that have one are read for it."""
    ids = rows.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min("id").alias("wanted_id"))
    ids = cut(ids.select("wanted_id").distinct(), "wanted")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, "text"):
            hashes, counts = shingle_sets(piece.column(0), size)
            raw, stop = hashes.tobytes(), np.cumsum(counts) * 8
            blobs = [raw[a:b] for a, b in zip((stop - counts * 8).tolist(), stop.tolist(), strict=True)]
            yield pa.record_batch([pa.array(set_prints(hashes, counts).view(np.int64)), pa.array(blobs, pa.binary())], names=["fp", "hashes"])

    return cut(texts.mapInArrow(run, "fp long, hashes binary").join(wanted, "fp", "left_semi").dropDuplicates(["fp"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both / (len(x) + len(y) - both) >= similarity:
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def links(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, size: int, similarity: float) -> DataFrame:
    """Links ``(a, b)`` between prints of ``rows`` whose components are those of all candidates at least this similar."""
    distinct = rows.groupBy("fp").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    keyed = distinct.select("fp", "n", F.posexplode("keys").alias("band", "key"))
    sizes = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), F.min_by(F.struct("fp", "n"), F.xxhash64("fp", "band")).alias("lead")).filter("members > 1")
    shared = cut(keyed.join(sizes, ["band", "key"]), "bands")
    alike = F.least("n", "m") >= F.greatest("n", "m") * F.lit(similarity) - 1e-6  # sizes that leave the similarity possible

    def paired(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, ["band", "key"]).filter(alike)

    ordered = (F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    cold, hot = shared.filter(F.col("members") <= PAIRS_TO), shared.filter(F.col("members") > PAIRS_TO)
    others = cold.select("band", "key", F.col("fp").alias("other"), F.col("n").alias("m"))
    pairs = paired(cold, others).filter("fp < other").select(*ordered)
    led = hot.withColumns({"other": F.col("lead.fp"), "m": F.col("lead.n")}).filter(alike).filter("fp <> other").select(*ordered)
    pairs = cut(pairs.union(led).distinct(), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).union(hot.select("fp")).distinct()
    sets = _sets(docs, rows, cut(wanted, "wanted"), id_col, text_col, size)
    found = cut(verified(pairs, sets, similarity), "verified")
    if hot.isEmpty():
        return found
    crowds = components(hot.select(F.col("fp").alias("a"), F.col("lead.fp").alias("b"))).select(F.col("node").alias("fp"), F.col("root").alias("crowd"))
    joined = components(found)
    root = joined.select(F.col("node").alias("fp"), F.col("root"))
    leads = joined.select(F.col("node").alias("lead_fp"), F.col("root").alias("lead_root"))
    hot = hot.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp")).withColumn("lead_fp", F.col("lead.fp")).join(leads, "lead_fp", "left")
    # Of two members of a key with different roots at least one is not with the key's lead.
    apart = (F.col("root") != F.coalesce("lead_root", "lead_fp")).cast("int")
    members = hot.groupBy("fp").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.max(apart).alias("apart")).join(crowds, "fp")
    return found.union(cut(crowd_links(members, sets, similarity), "verified"))


def crowd_links(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b)`` inside a crowd between members of different roots, where a chunk of them holds one that is apart."""
    step = F.floor(F.log("n") / F.log(F.lit(1 / similarity)) + 1e-9)  # similar sets are at most one step apart
    members = cut(members.withColumn("step", step), "members")
    share = F.greatest(F.count(F.lit(1)) / CHUNK_SETS, F.sum("n") / CHUNK_HASHES)
    shares = members.groupBy("crowd", "step").agg(F.ceil(share).alias("shares"), F.max("apart").alias("some"))
    # Steps without a member that is apart are needed only beside one that has some.
    beside = shares.filter("some = 1").select("crowd", F.explode(F.array(*[F.col("step") + i for i in (-1, 0, 1)])).alias("step")).distinct()
    dealt = members.join(shares.join(beside, ["crowd", "step"]), ["crowd", "step"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("shares")))
    row = F.struct("fp", "root", "hashes")
    chunks = dealt.join(sets, "fp").groupBy("crowd", "step", "part").agg(F.collect_list(row).alias("rows"), F.max("apart").alias("apart"))
    chunks = cut(chunks, "chunks")
    # The wanted pairs of chunks first, as small rows keyed by the chunk they need: no key holds a whole crowd.
    names = chunks.select("crowd", "step", "part", "apart", F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step2"))
    many = shares.select("crowd", F.col("step").alias("step2"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("part2"))
    wanted = names.join(many, ["crowd", "step2"]).filter("step2 > step or part <= part2")
    other = chunks.select("crowd", F.col("step").alias("step2"), F.col("part").alias("part2"), F.col("rows").alias("rows2"), F.col("apart").alias("apart2"))
    met = wanted.join(other, ["crowd", "step2", "part2"]).filter("apart + apart2 > 0").drop("apart", "apart2").join(chunks.drop("apart"), ["crowd", "step", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (x, x_root, left), (y, y_root, right) = (_chunk(batch.column(c)[i].values) for c in (0, 1))
                both = in_both(left, right)
                union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - both
                at, to = np.nonzero((both / union >= similarity) & (x_root[:, None] != y_root[None, :]))
                yield pa.record_batch([pa.array(x[at]), pa.array(y[to])], names=["a", "b"])

    return met.select("rows", "rows2").mapInArrow(run, "a long, b long")


def _chunk(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    fp, root, hashes = rows.flatten()
    return fp.to_numpy(), root.to_numpy(), [np.frombuffer(h.as_buffer(), np.uint64) for h in hashes]


def in_both(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right."""
    vocab = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    both = np.zeros((len(left), len(right)))
    for lo in range(0, len(vocab), VOCAB_BLOCK):
        block = vocab[lo : lo + VOCAB_BLOCK]
        both += np.rint(_matrix(left, block) @ _matrix(right, block).T)
    return both


def _matrix(sets: list[np.ndarray], vocab: np.ndarray) -> np.ndarray:
    """One row of zeros and ones for each set."""
    made = np.zeros((len(sets), len(vocab)), np.float32)
    for i, each in enumerate(sets):
        hit, at = A.member(each, vocab)
        made[i, at[hit]] = 1
    return made
