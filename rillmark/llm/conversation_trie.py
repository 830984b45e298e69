"""The prefix trie of conversations, built with ROLLUP over columns of turn ids.

A conversation is a row of ``BLOCK`` turn-id columns; ``rollup`` over them
with ``grouping_id`` gives every prefix of every conversation in one
aggregate. A longer conversation goes on in further rows, each keyed by the
node its preceding row ended in, so that one rollup covers all blocks.

A turn id is 96 bits of the SHA-256 of role and text and the byte length of
the text. A node is named by 128 bits that are the exclusive or of one hash
for each (turn id, position) of its path: the name of a longer path follows
from that of a shorter one, and a history can be summed up in pieces.

Subtree figures need no walk over the trie. The smallest member of a node
*owns* it; what a conversation owns is the end of its path, from a depth
``o`` on. A subtree's distinct text is what its members own (but for the
part that its own smallest member owns above it), its leaves are the owned
ends, and a node's parent belongs to the same owner unless the node lies at
depth ``o``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rillmark.llm.tables import cut
from rillmark.operators.joins import lookup
from rillmark.operators.scan import Scan, running_count, scan

BLOCK = 8
HEAD = 8
#: Bytes of joined ids that one row carries to the hashing of a node's ends.
ENDS_BYTES = 1 << 20


def _running(kind, both) -> callable:
    """A scan of the rows before each row with a mergeable aggregate; ``both`` joins two values."""

    def before(w: WindowSpec) -> WindowSpec:
        return w.rowsBetween(Window.unboundedPreceding, -1)

    def made(value: Column) -> Scan:
        return Scan(
            local=lambda w: F.coalesce(kind(value).over(before(w)), F.lit(0).cast("long")),
            total=lambda order: kind(value),
            carry=lambda total, w: F.coalesce(kind(total).over(before(w)), F.lit(0).cast("long")),
            merge=lambda carry, local, first, last: both(F.coalesce(carry, F.lit(0).cast("long")), local),
        )

    return made


sum_before = _running(F.sum, lambda a, b: a + b)
xor_before = _running(F.bit_xor, lambda a, b: a.bitwiseXOR(b))


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes: 12 of a digest of role and text, 4 with the UTF-8 length of the text. Null is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 24), F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0")))


def _bytes(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 13, 4)), 16, 10).cast("long")


def _mark(turn: Column, place: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), turn, place)


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(c, p, t)``: turn ids with their place from 0 in the order of ``turn``, null first.

    Equal turns follow their ids. Rows without a conversation are none of any.
    A conversation that holds very many rows is numbered in segments.
    """
    rows = conversations.select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("at"), turn_id(F.col(role), F.col(text)).alias("t"))
    placed = scan(rows.filter("c is not null"), ["c"], ["at", "t"], p=running_count())
    return placed.select("c", (F.col("p") - 1).alias("p"), "t")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``(c, p, t)`` with the head of each conversation exchanged, and all conversations ``(c, turns)``.

    The head has h = crc32(c) % 9 turns, those of conversation c - c % 5; the
    conversation's own turns follow after its first h.
    """
    convs = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select(
        "c", "n", (F.col("c") - F.col("c") % 5).alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % 9).alias("h")
    )
    given = convs.select(F.col("c").alias("giver"), F.least("n", F.lit(HEAD)).alias("has"))
    convs = convs.join(given, F.col("base") == F.col("giver"), "left")
    head = F.least("h", F.coalesce("has", F.lit(0))).alias("head")
    convs = cut(convs.select("c", "base", "h", head, F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest")), "conversations")

    heads = turns.filter(F.col("p") < HEAD).select(F.col("c").alias("giver"), "p", "t")
    taken = convs.join(heads, (F.col("base") == F.col("giver")) & (F.col("p") < F.col("h"))).select("c", "p", "t")
    shift = convs.select(F.col("c").alias("own"), "h", "head")
    own = lookup(turns, shift, "c", "own", how="inner").filter("p >= h").select("c", (F.col("p") - F.col("h") + F.col("head")).alias("p"), "t")
    return taken.unionByName(own), convs.select("c", (F.col("head") + F.col("rest")).alias("turns"))


def blocks(turns: DataFrame, convs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows of ``size`` turn ids ``t1..``, keyed by the node ``(n1, n2)`` at which the row starts.

    ``b`` numbers the rows of a conversation, ``above`` are the bytes before
    the row, ``turns`` and ``total`` the turns and bytes of the conversation,
    ``e1, e2`` the node at which the row ends. A conversation without turns
    has one row of nulls.
    """
    place = F.col("p") % size
    columns = [F.max(F.when(place == i, F.col("t"))).alias(f"t{i + 1}") for i in range(size)]
    marks = [F.bit_xor(_mark(F.col("t"), F.col("p"), s)).alias(f"m{s}") for s in (1, 2)]
    rows = turns.groupBy("c", (F.col("p") - place).alias("start")).agg(*columns, *marks, F.sum(_bytes(F.col("t"))).alias("size"))
    rows = rows.withColumn("b", (F.col("start") / size).cast("long")).drop("start")
    rows = scan(rows, ["c"], ["b"], n1=xor_before(F.col("m1")), n2=xor_before(F.col("m2")), above=sum_before(F.col("size")))
    rows = cut(
        rows.select("c", "b", "n1", "n2", "above", "size", F.col("n1").bitwiseXOR(F.col("m1")).alias("e1"), F.col("n2").bitwiseXOR(F.col("m2")).alias("e2"), *[f"t{i + 1}" for i in range(size)]),
        "blocks",
    )
    totals = convs.join(rows.groupBy(F.col("c").alias("conv")).agg(F.sum("size").alias("total")), F.col("c") == F.col("conv"), "left")
    totals = totals.select(F.col("c").alias("conv"), "turns", F.coalesce("total", F.lit(0)).alias("total"))
    empty = totals.filter("turns = 0").select(F.col("conv").alias("c"), "turns", "total")
    whole = lookup(rows.drop("size"), totals, "c", "conv", how="inner").unionByName(empty, allowMissingColumns=True)
    return whole.na.fill(0, ["b", "n1", "n2", "above", "e1", "e2"])


def _rollup(rows: DataFrame, size: int, aggregates: str) -> DataFrame:
    """Aggregates of every prefix of every row, with its depth, node, parent and the bytes before its last turn.

    Groups that end in a null column are rows shorter than the group and no
    nodes; a row's empty prefix is the preceding row's last node, so it is
    kept for the root alone.
    """
    ids = [f"t{i + 1}" for i in range(size)]
    levels = "array(" + ", ".join(f"{t} is not null" for t in ids) + ")"
    found = rows.sparkSession.sql(
        f"""select b, n1, n2, above, {", ".join(ids)}, {size} - bit_count(grouping_id()) as level, {aggregates}
        from {{rows}} group by b, n1, n2, above, rollup ({", ".join(ids)})
        having if(level = 0, b = 0, {levels}[level - 1])""",
        rows=rows,
    )

    def path(seed: int, last: Column) -> Column:
        first = F.col("b") * size
        marks = [F.when(F.lit(i) < last, _mark(F.col(t), first + i, seed)).otherwise(F.lit(0).cast("long")) for i, t in enumerate(ids)]
        return reduce(lambda a, m: a.bitwiseXOR(m), marks, F.col(f"n{seed}"))

    level = F.col("level")
    above = sum((F.when(F.lit(i) < level - 1, _bytes(F.col(t))).otherwise(0) for i, t in enumerate(ids)), F.col("above"))
    figures = [c for c in found.columns if c not in ("b", "n1", "n2", "above", "level", *ids)]
    return found.select(
        (F.col("b") * size + level).alias("depth"), *[path(s, level).alias(f"k{s}") for s in (1, 2)], *[path(s, level - 1).alias(f"u{s}") for s in (1, 2)],
        above.alias("before"), *figures,
    )


def _name(first: str, second: str) -> Column:
    return F.concat_ws(".", first, second)


def _owners(nodes: DataFrame) -> DataFrame:
    """``(owner, o, leaf, kept_from, adopted)`` for each conversation that owns a node.

    ``kept_from`` are the bytes above depth ``o``; ``adopted`` is the owner of
    the parent there, null at the root.
    """
    own = nodes.groupBy(F.col("low").alias("owner")).agg(
        F.min("depth").alias("o"), F.max((F.col("deepest") == F.col("depth")).cast("long")).alias("leaf"),
        F.min_by("before", "depth").alias("kept_from"), F.min_by("u1", "depth").alias("u1"), F.min_by("u2", "depth").alias("u2"),
    )
    own = cut(own.withColumn("parent", F.when(F.col("o") > 0, _name("u1", "u2"))).drop("u1", "u2"), "owners")
    names = nodes.select(_name("k1", "k2").alias("node"), F.col("low").alias("adopted"))
    # A parent with very many children is a hot key of this lookup, which spreads it.
    return lookup(own, names, "parent", "node").drop("parent")


def _ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids ``c`` of each node ``(e1, e2)``: ``(x1, x2, ends_sha256)``.

    Ranges of (node, id) join their ids first, in pieces of ``ENDS_BYTES``, so
    the chained hashing of a node that ends a third of all conversations
    reads a few long pieces and never holds its ids.
    """
    placed = ends.repartitionByRange("e1", "e2", "c").sortWithinPartitions("e1", "e2", "c")
    joined = placed.mapInArrow(_join_ids, "e1 long, e2 long, c long, ids string")
    chained = joined.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "c")
    return chained.mapInArrow(_chain, "x1 long, x2 long, ends_sha256 string")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        e1, e2, c = (batch.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(np.concatenate([[True], (e1[1:] != e1[:-1]) | (e2[1:] != e2[:-1])]))
        stops = np.concatenate([starts[1:], [len(c)]])
        rows = []
        for a, z in zip(starts.tolist(), stops.tolist(), strict=True):
            for at in range(a, z, ENDS_BYTES // 20):
                rows.append((e1[a], e2[a], c[at], ",".join(map(str, c[at : min(z, at + ENDS_BYTES // 20)].tolist()))))
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["e1", "e2", "c", "ids"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest = None, None
    for batch in batches:
        done = []
        for e1, e2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if at == (e1, e2):
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                done.append((*at, digest.hexdigest()))
            at, digest = (e1, e2), hashlib.sha256(ids.encode())
        if done:
            yield _digests(done)
    if at is not None:
        yield _digests([(*at, digest.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["x1", "x2", "ends_sha256"])


def trie(turns: DataFrame, convs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of turns ``(c, p, t)`` and conversations ``(c, turns)``.

    No conversations: no rows, not even a root.
    """
    rows = cut(blocks(turns, convs, size), "rows")
    nodes = cut(_rollup(rows, size, "min(c) as low, max(turns) as deepest"), "nodes")
    owned = lookup(rows, _owners(nodes), "c", "owner")
    owned = owned.select(*rows.columns, "o", "adopted", F.coalesce(F.col("total") - F.col("kept_from"), F.lit(0)).alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    figures = _rollup(
        owned, size,
        "count(*) as n_convs, min(c) as conv_id, sum(total) as totals, sum(own) as owns, sum(leaf) as n_leaves, "
        "min_by(own, c) as first_own, min_by(total, c) as first_total, min_by(o, c) as o, min_by(adopted, c) as adopted",
    )
    children = nodes.filter("depth > 0").groupBy(F.col("u1").alias("p1"), F.col("u2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    last = rows.filter((F.col("b") + 1) * size >= F.col("turns")).select("e1", "e2", "c")
    ends = _ends_digests(last)
    met = figures.join(children, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")), "left")
    met = met.join(ends, (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2")), "left")
    distinct = F.col("owns") - F.col("first_own") + F.col("first_total") - F.col("before")
    return met.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.when(F.col("depth") > 0, F.when(F.col("o") < F.col("depth"), F.col("conv_id")).otherwise(F.col("adopted"))).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
        (F.col("totals") - F.col("n_convs") * F.col("before") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """The trie of all rebuilt conversations."""
    turns = cut(numbered_turns(conversations), "turns")
    return trie(*rebuilt(turns), size)


def oracle() -> str:
    crc = "list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda a, v: xor(xor(a, v) >> 1, 3988292384 * (xor(a, v) & 1)))"
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
named as (select *, sha256(strlen(role) || ':' || role || text) as k, strlen(text) as size from turns),
own as (select conv_id, list({{'k': k, 'size': size}} order by turn nulls first, k) as l, xor({crc}, 4294967295) % 9 as h from named group by conv_id),
rebuilt as (
  select c.conv_id, list_concat(coalesce(g.l[1:c.h], []), c.l[c.h + 1:]) as l
  from own c left join own g on g.conv_id = c.conv_id - c.conv_id % 5),
places as (select conv_id, l, unnest(range(len(l) + 1)) as d from rebuilt),
paths as (
  select conv_id, d, len(l) as turns, case when d > 0 then l[d].size else 0 end as size,
    sha256(array_to_string(list_transform(l[1:d], lambda x: x.k), ',')) as node,
    case when d > 0 then sha256(array_to_string(list_transform(l[1:d - 1], lambda x: x.k), ',')) end as parent
  from places),
nodes as (
  select node, any_value(parent) as parent, any_value(d) as depth, any_value(size) as size, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(conv_id, ',' order by conv_id) filter (turns = d), '') as ends
  from paths group by node),
kids as (select parent, count(*) as n_children from nodes where parent is not null group by parent),
above as (select distinct a.node as top, b.node from paths a join paths b on a.conv_id = b.conv_id and a.d <= b.d),
sums as (
  select top, sum(case when k.n_children is null then 1 else 0 end) as n_leaves, sum((n.n_convs - 1) * n.size) as saved_tokens
  from above join nodes n on n.node = above.node left join kids k on k.parent = n.node group by top)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join sums s on s.top = n.node left join kids k on k.parent = n.node left join nodes p on p.node = n.parent
"""
