"""SimHash near-dedup with pigeonring candidate filtering.

A fingerprint's 64 bits are a ring of eight segments of eight bits. If two
fingerprints differ in at most ``BITS`` = 2 bits, then some segment starts a
chain in which the first l segments differ in at most l * BITS / 8 bits, for
every l up to 8. With two bits, the first three segments of such a chain are
equal: these 24 bits and the chain's start are the join key. The longer
prefixes of the chain prune candidates before the whole distance is taken.

A key that more than ``BALL_FROM`` different fingerprints share is not
paired. Its members list themselves and their forty neighbours at one bit in
the five open segments; two fingerprints differ in at most two bits exactly
if these lists meet, and all that meet in a list entry differ in at most two.
So one link to the smallest member of each entry carries the same components
with 41 rows for a fingerprint instead of a square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm import arrays as A
from rillmark.llm import jaccard
from rillmark.llm.components import components
from rillmark.llm.tables import cut, fresh

SHINGLE = 3
SEED = 42
BITS = 2
SEGMENTS = 8
WIDTH = 64 // SEGMENTS
#: Equal segments at the head of a chain: the l with l * BITS / SEGMENTS < 1.
HEAD = -(-SEGMENTS // BITS) - 1
BALL_FROM = 64


def fingerprints(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text: a bit is set if over half of the shingles' hashes have it."""
    data, offsets = A.text_buffer(column)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.astype(np.uint8) << 5)
    starts, ends, counts = A.spans(data, offsets)
    length = ends - starts
    # Words of one text, one space apart.
    begin = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[A.ragged(begin, length)] = data[A.ragged(starts, length)]
    stop = begin + length
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = A.ragged(np.cumsum(counts) - counts, shingles)
    last = first + np.repeat(np.minimum(counts, size), shingles) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[first].tolist(), stop[last].tolist(), strict=True)), np.uint64, len(first))
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    made = np.zeros((len(counts), 64), bool)
    some = np.flatnonzero(shingles)
    if len(some):
        heads = (np.cumsum(shingles) - shingles)[some]
        made[some] = np.add.reduceat(bits, heads, axis=0, dtype=np.int32) * 2 > shingles[some, None]
    return np.packbits(made, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint_rows(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """``(id, fp)``, one row for each document; ``fp`` is the signed reading of the 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, "text"):
            yield pa.record_batch([piece.column(0), pa.array(fingerprints(piece.column(1), size).view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _segments(fp: Column, start: int, count: int) -> Column:
    """``count`` segments from ``start`` around the ring, as one number."""
    turn = start * WIDTH
    turned = F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn)) if turn else fp
    return F.shiftrightunsigned(turned, 64 - count * WIDTH)


def _chain_holds(diff: Column, start: Column) -> Column:
    """Every prefix of the chain from ``start`` stays within its share of the differing bits."""
    cases = None
    for s in range(SEGMENTS):
        held = reduce(lambda a, b: a & b, [F.bit_count(_segments(diff, s, n)) <= n * BITS // SEGMENTS for n in range(HEAD + 1, SEGMENTS)])
        cases = F.when(start == s, held) if cases is None else cases.when(start == s, held)
    return cases


def links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints whose components are those of all pairs within ``BITS``."""
    fp = F.col("fp")
    keyed = distinct.select("fp", F.posexplode(F.array(*[_segments(fp, s, HEAD) for s in range(SEGMENTS)])).alias("start", "head"))
    sizes = keyed.groupBy("start", "head").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(keyed.join(sizes, ["start", "head"]), "chains")
    cold = shared.filter(F.col("n") <= BALL_FROM)
    left, right = cold.select("start", "head", F.col("fp").alias("a")), cold.select("start", "head", F.col("fp").alias("b"))
    pairs = left.join(right, ["start", "head"]).filter("a < b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    pairs = pairs.filter(_chain_holds(diff, F.col("start"))).filter(F.bit_count(diff) <= BITS).select("a", "b")
    hot = shared.filter(F.col("n") > BALL_FROM)
    masks = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64 - HEAD * WIDTH)])
    # The open segments are the low bits once the ring is turned to the chain's start.
    turned = reduce(lambda c, s: c.when(F.col("start") == s, _segments(fp, s, SEGMENTS)), range(1, SEGMENTS), F.when(F.col("start") == 0, fp))
    near = hot.select("start", "fp", turned.alias("ring")).select("start", "fp", F.explode(F.transform(masks, lambda m: F.col("ring").bitwiseXOR(m))).alias("near"))
    balls = near.groupBy("start", "near").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    stars = near.join(balls.select("start", "near", "low"), ["start", "near"]).filter("fp > low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return pairs.union(stars)


def print_links(rows: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the set digests ``fp`` whose fingerprints ``bits`` are in one component of :func:`links`."""
    prints = rows.select("fp", "bits").distinct()
    near = components(links(prints.select(F.col("bits").alias("fp")).distinct()))
    grouped = prints.join(near, F.col("bits") == F.col("node"), "left").select("fp", F.coalesce("root", "bits").alias("root"))
    least = grouped.groupBy("root").agg(F.min("fp").alias("least"))
    return grouped.join(least, "root").filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most two
    differing bits between fingerprints of shingles of ``size`` words. With a
    ``similarity``, texts whose shingle sets have an exact Jaccard similarity
    of at least so much (:mod:`jaccard`) are linked as well, which reaches
    past the two bits; ``fp`` is then a digest of the set. Null, empty and
    blank texts have fingerprint zero and link like any other; rows of one id
    keep a row each; null ids are members but never name a component that has
    another id. No rows: no rows.
    """
    made = fingerprint_rows(docs, id_col, text_col, size) if similarity is None else jaccard.set_rows(docs, id_col, text_col, size, fingerprints)
    rows = cut(made, "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    if similarity is None:
        found = links(distinct.select("fp"))
    else:
        found = print_links(rows).union(jaccard.links(docs, rows, id_col, text_col, size, similarity))
    joined = components(found)
    labels = distinct.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labels.select("fp", "root").join(least, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """One row of each component of ``docs``: that of the smallest id; of rows that repeat that id, any one.

    All columns are kept. A component of null ids alone keeps one row.
    """
    found = cut(near_duplicates(docs, id_col, text_col, size, similarity).select(F.col(id_col).alias("_id"), "fp", "root", "component_id"), "components")
    stays = F.col("_id").eqNullSafe(F.col("component_id"))
    per_id = found.groupBy("_id").agg(F.count(F.lit(1)).alias("n"), F.max(stays).alias("stays")).filter("stays")
    mark, many, print_kept, root_kept = (fresh(docs, n) for n in ("_kept", "_many", "_print", "_root"))
    marked = docs.join(per_id.select(F.col("_id").alias(mark), (F.col("n") > 1).alias(many)), docs[id_col].eqNullSafe(F.col(mark)))
    single = marked.filter(~F.col(many)).select(*docs.columns)
    # Rows that share their id are told apart by their fingerprints, and one row of a component is taken.
    rest = _with_fingerprints(marked.filter(many).select(*docs.columns), text_col, many, size, fingerprints if similarity is None else jaccard.prints)
    roots = found.filter(stays).select(F.col("_id").alias(mark), F.col("fp").alias(print_kept), F.col("root").alias(root_kept)).distinct()
    met = rest.join(roots, rest[id_col].eqNullSafe(F.col(mark)) & (F.col(many) == F.col(print_kept)))
    return single.unionByName(met.dropDuplicates([root_kept]).select(*docs.columns))


def _with_fingerprints(rows: DataFrame, text_col: str, name: str, size: int, prints: Callable[[pa.Array, int], np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, text_col):
            made = pa.array(prints(piece.column(piece.schema.get_field_index(text_col)), size).view(np.int64))
            yield pa.RecordBatch.from_arrays([*piece.columns, made], names=[*piece.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))
