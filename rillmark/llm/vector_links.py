"""Embedding near-dedup: an exact metric range join on the unit sphere.

Cosine of at least c is a distance of at most r = sqrt(2 - 2c) between unit
vectors. Pivots cut the vectors into cells, each vector in the cell of its
nearest pivot. By the triangle inequality, a vector x can only be within r of
a vector of cell j if d(x, p_j) <= d(x, p_home) + 2r; in Euclidean space the
plane between two pivots gives the sharper (d(x, p_j)^2 - d(x, p_home)^2) / (2
d(p_j, p_home)) <= r. The number of pivots is the cheapest of a few on a
sample; where no bound separates anything that is one.

A cell is cut into blocks of up to ``BLOCK`` vectors, rings around its pivot.
A block, not a vector, is replicated to a cell that one of its vectors must
reach, and keeps its least and largest distance to every pivot: only blocks
whose distances to every pivot come within r of each other meet. Pairs of
blocks are dealt in tiles, so that a blob is sent once for many pairs, and a
cell that holds a third of all vectors becomes many tiles. Equal vectors are
one weighted vector. A pair of blocks sends the number of links of each vector
and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.components import components, forest
from rillmark.llm.tables import cut

COSINE = 0.9
#: Vectors of a block, and bytes of them in double precision.
BLOCK, BLOCK_BYTES = 4096, 8 << 20
#: Numbers of pivots that are tried; pivots are sent to every task.
PIVOTS = (1, 4, 16, 64, 256)
#: Vectors on which the numbers of pivots are compared, and from which pivots come.
SAMPLE = 2048
#: Blocks along a tile's side at most; a task holds one side.
TILE = 16
#: Blocks of a cell that one task pairs with another cell's.
PAIR_BLOCKS = 512
SLACK = 1e-9
#: Single precision screens products; what comes this close is computed again in double precision.
SCREEN = 1e-4
STEP = 1024


def usable(vector: str):
    """Neither null nor zero, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(rows: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows or vanishes."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _home_and_cells(u: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and which cells it must be copied to (its home included)."""
    square = np.maximum(0.0, 2.0 - 2.0 * (u @ pivots.T))
    home = square.argmin(axis=1)
    near = square[np.arange(len(u)), home]
    between = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (pivots @ pivots.T)))[home]
    triangle = np.sqrt(square) - np.sqrt(near)[:, None] <= 2 * radius + SLACK
    plane = square - near[:, None] <= 2 * radius * between + SLACK
    inside = triangle & plane
    inside[np.arange(len(u)), home] = True
    return home, inside


def _far_apart(u: np.ndarray, wanted: int) -> np.ndarray:
    """Rows of u, each the farthest from those before it; fewer than wanted where all others are equal to one."""
    chosen, gap = [0], 2.0 - 2.0 * (u @ u[0])
    while len(chosen) < wanted and gap.max() > SLACK:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, 2.0 - 2.0 * (u @ u[chosen[-1]]))
    return u[chosen]


def choose_pivots(sample: np.ndarray, total: int, radius: float, block: int) -> np.ndarray:
    """The pivots with the least work for ``total`` vectors, judged on a sample of unit vectors.

    Work is the number of compared pairs, a vector's own cell against what is
    copied to it, and the copies themselves. More pivots must save a tenth.
    """
    best, least = sample[:1], float("inf")
    for wanted in PIVOTS:
        if wanted > 1 and wanted > total / block * 4:
            break
        pivots = _far_apart(sample, wanted)
        home, inside = _home_and_cells(sample, pivots, radius)
        own, met = np.bincount(home, minlength=len(pivots)) / len(sample), inside.mean(axis=0)
        work = total * float(own @ met) + block * float(inside.sum(axis=1).mean())
        if work < 0.9 * least:
            best, least = pivots, work
    return best


def _measured(classes: DataFrame, pivots: np.ndarray, radius: float) -> DataFrame:
    """``(home, ring, cid, n, v)``: the cell of each vector and its distance to the cell's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                part = batch.slice(lo, STEP)
                square = 2.0 - 2.0 * (units(_matrix(part.column(2))) @ pivots.T)
                home = square.argmin(axis=1)
                yield pa.record_batch([pa.array(home.astype(np.int32)), pa.array(square[np.arange(len(home)), home]), *part.columns], names=["home", "ring", "cid", "n", "v"])

    return classes.mapInArrow(run, f"home int, ring double, cid long, n long, v {classes.schema['v'].dataType.simpleString()}")


BLOCK_COLUMNS = "block long, home int, cells array<int>, low binary, high binary, cid binary, n binary, v binary"


def _blocks(measured: DataFrame, pivots: np.ndarray, radius: float, size: int, parts: int) -> DataFrame:
    """Blocks as rows of blobs: the cells it reaches, its distances to all pivots from ``low`` to ``high``, its vectors."""

    def pack(rows: list[pa.RecordBatch], home: int, number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        raw = _matrix(table.column("v").combine_chunks())
        u = units(raw)
        reached = _home_and_cells(u, pivots, radius)[1].any(axis=0)
        apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (u @ pivots.T)))
        blobs = [apart.min(axis=0).tobytes(), apart.max(axis=0).tobytes(), *[table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("cid", "n")], raw.tobytes()]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), *[pa.binary()] * 5]
        values = [number, home, np.flatnonzero(reached).astype(np.int32).tolist(), *blobs]
        return pa.record_batch([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], names=["block", "home", "cells", "low", "high", "cid", "n", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, count, cell = TaskContext.get().partitionId() << 32, [], 0, None
        for batch in batches:
            homes = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(homes)) + 1).tolist(), len(homes)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                while lo < hi:
                    if held and (homes[lo] != cell or count == size):
                        yield pack(held, cell, number)
                        number, held, count = number + 1, [], 0
                    cell, take = int(homes[lo]), min(hi - lo, size - count)
                    held.append(batch.slice(lo, take))
                    lo, count = lo + take, count + take
        if held:
            yield pack(held, cell, number)

    return measured.repartitionByRange(parts, "home", "ring", "cid").sortWithinPartitions("home", "ring", "cid").mapInArrow(run, BLOCK_COLUMNS)


def _meeting(blocks: DataFrame, radius: float) -> DataFrame:
    """``(a, b)``: blocks a <= b that each reach the other's cell and whose distances to no pivot are more than r apart.

    A cell of many blocks is paired in slices, each with a copy of the others' small rows.
    """
    slim = blocks.select("block", "home", "cells", "low", "high")
    many = slim.groupBy("home").agg(F.count(F.lit(1)).alias("n"))
    slices = many.select(F.col("home").alias("cell"), F.greatest(F.lit(1), F.ceil(F.col("n") / PAIR_BLOCKS)).cast("int").alias("slices"))
    # One small row for each pivot.
    own = slim.join(F.broadcast(slices), F.col("home") == F.col("cell")).withColumn("slice", F.pmod(F.xxhash64("block"), F.col("slices")).cast("int"))
    other = slim.withColumn("cell", F.explode("cells")).join(F.broadcast(slices), "cell")
    other = other.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    x = own.select("cell", "slice", F.col("block").alias("a"), F.col("home").alias("xh"), F.col("cells").alias("xc"), F.col("low").alias("xl"), F.col("high").alias("xu"))
    y = other.select("cell", "slice", F.col("block").alias("b"), F.col("home").alias("yh"), F.col("low").alias("yl"), F.col("high").alias("yu"))
    found = x.join(y, ["cell", "slice"]).filter("a <= b and array_contains(xc, yh)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xl, xu, yl, yu = (np.frombuffer(b"".join(batch.column(i).to_pylist())).reshape(batch.num_rows, -1) for i in range(2, 6))
            near = (np.maximum(xl - yu, yl - xu) <= radius + SLACK).all(axis=1)
            yield pa.record_batch([batch.column(0).filter(pa.array(near)), batch.column(1).filter(pa.array(near))], names=["a", "b"])

    return found.select("a", "b", "xl", "xu", "yl", "yu").mapInArrow(run, "a long, b long")


def block_links(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y whose cosine is at least ``cosine``; both hold unit vectors in double precision."""
    out_a, out_b = [], []
    y32 = y.astype(np.float32).T.copy()
    for lo in range(0, len(x), STEP):
        part = x[lo : lo + STEP]
        a, b = np.nonzero(part.astype(np.float32) @ y32 >= np.float32(cosine - SCREEN))
        for k in range(0, len(a), 1 << 17):
            i, j = a[k : k + (1 << 17)], b[k : k + (1 << 17)]
            linked = np.einsum("ij,ij->i", part[i], y[j]) >= cosine
            out_a.append(i[linked] + lo)
            out_b.append(j[linked])
    empty = [np.empty(0, np.int64)]
    return np.concatenate(out_a or empty), np.concatenate(out_b or empty)


def _rows(x_id: np.ndarray, counts: np.ndarray, node: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(counts)
    a = pa.array(np.concatenate([x_id[some], node]), pa.int64())
    b = pa.array([None] * len(some) + root.tolist(), pa.int64())
    n = pa.array(counts[some].tolist() + [None] * len(node), pa.int64())
    return pa.record_batch([a, b, n], names=["a", "b", "n"])


def _links_of(x: tuple, y: tuple, same: bool, cosine: float) -> Iterator[pa.RecordBatch]:
    """Links between two blocks ``(ids, weights, vectors)``, counted on both sides."""
    i, j = block_links(x[2], y[2], cosine)
    if same:
        i, j = i[i != j], j[i != j]
    if len(i):
        yield _rows(x[0], np.bincount(i, weights=y[1][j], minlength=len(x[0])).astype(np.int64), *forest(x[0][i], y[0][j]))
        if not same:
            yield _rows(y[0], np.bincount(j, weights=x[1][i], minlength=len(y[0])).astype(np.int64), i[:0], i[:0])


def _join_blocks(tiles: DataFrame, dim: int, dtype: str, cosine: float) -> DataFrame:
    """``(a, b, n)``: with b null, n links of class a found in a pair of blocks; otherwise a link of the forest.

    Rows ``(tile, block, partners, cid, n, v)`` come by tile. Blocks without
    ``partners`` are the tile's left side and are held; each of the others
    that follow meets those it names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, left = None, {}
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}
                if row["tile"] != tile:
                    tile, left = row["tile"], {}
                held = (np.frombuffer(row["cid"], np.int64), np.frombuffer(row["n"], np.int64), units(np.frombuffer(row["v"], dtype).reshape(-1, dim)))
                if row["partners"] is None:
                    left[row["block"]] = held
                    continue
                for other in row["partners"]:
                    yield from _links_of(left[other], held, other == row["block"], cosine)

    return tiles.mapInArrow(run, "a long, b long, n long")


def class_links(classes: DataFrame, dim: int, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Link counts and a connecting forest of the classes ``(cid, n, v)`` of one vector length."""
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    total, cores = classes.count(), classes.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(block, BLOCK_BYTES // (8 * dim)))
    rows = classes.orderBy(F.xxhash64(F.lit(3), "cid")).limit(SAMPLE).select("v").collect()
    pivots = choose_pivots(units(np.array([r.v for r in rows], np.float64)), total, radius, size)
    measured = _measured(classes, pivots, radius)
    # Ranges of rather less than a block each leave few blocks half empty; a range may hold several.
    parts = int(max(1, min(-(-total // max(1, int(0.8 * size))), 64 * cores)))
    blocks = cut(_blocks(measured, pivots, radius, size, parts), "blocks")
    pairs = cut(_meeting(blocks, radius), "block-pairs")
    side = int(max(1, min(TILE, (total / size) // (8 * cores) ** 0.5)))
    # A tile's side is a run of blocks of one range, or that of several ranges where these hold few blocks.
    each = max(1, round(total / size / parts))
    ranges, runs = max(1, side // each), max(side, 1) if each > side else 1 << 31
    tile = F.struct(*[F.struct(F.floor(F.shiftright(c, 32) / ranges), F.floor(F.pmod(c, F.lit(1 << 32)) / runs)) for c in ("a", "b")])
    dealt = pairs.select(F.xxhash64(tile).alias("tile"), "a", "b")
    right = dealt.groupBy("tile", F.col("b").alias("at")).agg(F.collect_list("a").alias("partners"))
    left = dealt.select("tile", F.col("a").alias("at"), F.lit(None).cast("array<bigint>").alias("partners")).distinct()
    wanted = int(max(1, min(dealt.select("tile").distinct().count(), 64 * cores)))
    sent = left.unionByName(right).join(blocks.select("block", "cid", "n", "v"), F.col("at") == F.col("block"))
    ordered = sent.select("tile", "block", "partners", "cid", "n", "v").repartition(wanted, "tile").sortWithinPartitions("tile", F.col("partners").isNotNull(), "block")
    dtype = "<f8" if "double" in classes.schema["v"].dataType.simpleString() else "<f4"
    return _join_blocks(ordered, dim, dtype, cosine)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row for each row of ``vectors``.

    ``n_links`` counts the other rows at ``cosine`` or more, ``component_id``
    is the smallest id reachable, and ``kept`` marks rows with that id. Null
    and zero vectors and those with null or non-finite components link with
    nothing; so do vectors of different lengths. Equal vectors link. Rows
    that repeat an id are rows of their own; a null id is a member but names
    no component that has another id. No rows: no rows.
    """
    element = "array<double>" if "double" in vectors.schema[vector_col].dataType.simpleString() else "array<float>"
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable(vector_col), F.col(vector_col).cast(element)).alias("v"))
    grouped = rows.filter("v is not null").groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = cut(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    dims = sorted(r.d for r in classes.select(F.size("v").alias("d")).distinct().collect())  # the lengths of vectors in use
    found = [cut(class_links(classes.filter(F.size("v") == d).select("cid", "n", "v"), d, cosine, block), "vector-links") for d in dims]
    links = reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], "a long, b long, n long")
    counts = links.filter("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    roots = components(links.filter("b is not null").select("a", "b"))
    named = classes.join(roots, F.col("cid") == F.col("node"), "left").select("cid", "v", "n", "least", F.coalesce("root", "cid").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    full = named.join(least, "root").join(counts, F.col("cid") == F.col("a"), "left")
    full = full.select(F.col("v").alias("class_v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component")
    linked = F.col("class_v").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("id"))
    joined = rows.join(full, F.col("v") == F.col("class_v"), "left")
    return joined.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def oracle() -> str:
    """All pairs and their closure in DuckDB's SQL; for small tables."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS vec_id, (SELECT count(*) FROM links WHERE links.a = reach.a) AS n_links, min(b) AS component_id, a = min(b) AS kept
FROM reach GROUP BY a
"""
