"""Substring dedup by fixed-block anchors.

A passage of ``window`` words that also occurs in an earlier document holds,
wherever it starts there, one whole block of ``(window + 1) // 2`` words of
that document's non-overlapping blocks. So:

1. every document marks its blocks and probes with every rolling window of
   block length; probes of one hash range meet, and an *anchor* is a probe
   that some document holds as a block and at least two documents hold;
2. anchors are extended: the windows of full length around them get a
   96-bit fingerprint, and for each fingerprint the smallest doc_id is found;
3. each document drops the words of the windows that an earlier one has.
   Neighbouring windows join into the maximal repeat.

Texts are dealt once into chunks of about ``CHUNK_BYTES``; hashes travel as
sorted byte planes, one blob for each (chunk, hash range), each hash once for
a chunk however often it occurs. A passage that a third of all documents
share therefore costs a chunk one entry, and no task sees a group of
documents. A false anchor costs an extra fingerprint, never a wrong result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillmark.llm import arrays as A
from rillmark.llm.tables import cut, fresh

WINDOW = 13
CHUNK_BYTES = 4 << 20
#: Chunks' bytes to a hash range.
PART_BYTES = 8 << 20
LEAST_CHUNKS = 64
#: What a row counts for besides its text.
ROW_BYTES = 64
ANCHOR_BITS = 48
LAST = np.iinfo(np.int64).max
PROBES = "part long, chunk long, hashes binary, flags binary"
PRINTS = "part long, chunk long, low binary, high binary, doc binary, many binary"


@dataclass(frozen=True)
class Layout:
    window: int
    parts: int

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


def _ids(piece: pa.RecordBatch) -> np.ndarray:
    """Document ids; a null id comes after all others."""
    return piece.column(1).cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _runs(ascending: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]])) if len(ascending) else np.empty(0, np.int64)


def _blobs(part: np.ndarray, chunk: int, columns: list) -> dict:
    """One row for each part; ``columns`` are (values, packer), ordered by part."""
    starts = _runs(part)
    ends = [*starts[1:], len(part)]
    rows = [[packer(values[a:b]) for a, b in zip(starts, ends, strict=True)] for values, packer in columns]
    return {"part": part[starts].astype(np.int64), "chunk": np.full(len(starts), chunk, np.int64), "rows": rows}


def _anchor_hashes(words: A.Words, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each rolling window of block length and which of them lie in one text."""
    hashes = A.rolling(words.hashes(1), layout.block) >> np.uint64(64 - ANCHOR_BITS)
    return hashes, words.room()[: len(hashes)] >= layout.block


def _probe(table: pa.Table, layout: Layout) -> pa.Table:
    """Distinct anchor hashes of a chunk; flag 1: a block, flag 2: in two documents or more."""
    schema = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("flags", pa.binary())])
    found, owner, block = [], [], []
    for piece in A.table_pieces(table, table.column_names[2]):
        words = A.words_of(piece.column(2))
        hashes, whole = _anchor_hashes(words, layout)
        at = np.arange(words.size) - np.repeat(np.cumsum(words.counts) - words.counts, words.counts)
        found.append(hashes[whole])
        owner.append(_ids(piece)[words.docs[: len(hashes)][whole]])
        block.append((at[: len(hashes)][whole] % layout.block == 0).astype(np.uint8))
    hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
    if not len(hashes):
        return schema.empty_table()
    owner, block = np.concatenate(owner), np.concatenate(block)
    order = np.argsort(hashes, kind="stable")
    hashes, owner, block = hashes[order], owner[order], block[order]
    starts = _runs(hashes)
    many = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
    flags = np.maximum.reduceat(block, starts) | (many.astype(np.uint8) << 1)
    hashes = hashes[starts]
    made = _blobs(A.range_bucket(hashes, ANCHOR_BITS, layout.parts), table.column(0)[0].as_py(), [(hashes, A.pack_sorted), (flags, lambda v: v.tobytes())])
    return pa.table([made["part"], made["chunk"], *made["rows"]], schema=schema)


def _meet_anchors(table: pa.Table) -> pa.Table:
    """Of the probes of one hash range, those that are a block and in two documents, sent back to their chunks."""
    chunks = table.column("chunk").to_numpy()
    hashes = [A.unpack_sorted(b) for b in table.column("hashes").to_pylist()]
    flags = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("flags").to_pylist()])
    source = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    hashes, flags, source = hashes[order], flags[order], source[order]
    starts = _runs(hashes)
    size = np.diff(np.append(starts, len(hashes)))
    seen = np.bitwise_or.reduceat(flags, starts)
    hit = np.repeat(((seen & 1) > 0) & (((seen & 2) > 0) | (size > 1)), size)
    hashes, source = hashes[hit], source[hit]
    order = np.argsort(source, kind="stable")
    hashes, source = hashes[order], source[order]
    starts = _runs(source)
    return pa.table(
        {
            "chunk": chunks[source[starts]] if len(starts) else np.empty(0, np.int64),
            "hashes": pa.array([A.pack_sorted(h) for h in np.split(hashes, starts[1:])] if len(starts) else [], pa.binary()),
        }
    )


def _anchored(words: A.Words, anchors: np.ndarray, layout: Layout) -> np.ndarray:
    """Positions of the full windows that hold an anchor."""
    hashes, whole = _anchor_hashes(words, layout)
    hit = np.zeros(words.size + 1, np.int64)
    hit[: len(hashes)] = A.member(hashes, anchors)[0] & whole
    before = np.concatenate([[0], np.cumsum(hit)])
    n = max(0, words.size - layout.window + 1)
    reach = layout.window - layout.block + 1
    return np.flatnonzero((before[reach : reach + n] > before[:n]) & (words.room()[:n] >= layout.window))


def _prints(words: A.Words, at: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of fingerprint of the windows at these positions."""
    return A.rolling(words.hashes(2), layout.window)[at], A.rolling(words.hashes(3), layout.window)[at] >> np.uint64(32)


def _extend(texts: pa.Table, replies: pa.Table, layout: Layout) -> pa.Table:
    """For each distinct fingerprint around a chunk's anchors: its smallest doc_id, and whether two documents have it."""
    schema = pa.schema([(n, pa.int64()) for n in ("part", "chunk")] + [(n, pa.binary()) for n in ("low", "high", "doc", "many")])
    if texts.num_rows == 0 or replies.num_rows == 0:
        return schema.empty_table()
    anchors = np.sort(np.concatenate([A.unpack_sorted(b) for b in replies.column("hashes").to_pylist()]))
    low, high, owner = [], [], []
    for piece in A.table_pieces(texts, texts.column_names[2]):
        words = A.words_of(piece.column(2))
        at = _anchored(words, anchors, layout)
        a, b = _prints(words, at, layout)
        low.append(a)
        high.append(b)
        owner.append(_ids(piece)[words.docs[at]])
    low, high, owner = np.concatenate(low), np.concatenate(high), np.concatenate(owner)
    if not len(low):
        return schema.empty_table()
    order = np.lexsort((owner, high, low))
    low, high, owner = low[order], high[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
    last = np.append(starts[1:], len(low)) - 1
    many = (owner[starts] != owner[last]).astype(np.uint8)
    low, high, first = low[starts], high[starts], owner[starts]
    columns = [(low, A.pack_sorted), (high, A.pack), (first.view(np.uint64), A.pack), (many, lambda v: v.tobytes())]
    made = _blobs(A.range_bucket(low, 64, layout.parts), texts.column(0)[0].as_py(), columns)
    return pa.table([made["part"], made["chunk"], *made["rows"]], schema=schema)


def _meet_prints(table: pa.Table) -> pa.Table:
    """The smallest doc_id of each fingerprint of one hash range, sent to the chunks that hold a later one."""
    chunks = table.column("chunk").to_numpy()
    low = [A.unpack_sorted(b) for b in table.column("low").to_pylist()]
    source = np.repeat(np.arange(len(low)), [len(x) for x in low])
    low = np.concatenate(low)
    high, doc = (np.concatenate([A.unpack(b) for b in table.column(n).to_pylist()]) for n in ("high", "doc"))
    doc = doc.view(np.int64)
    many = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("many").to_pylist()])
    order = np.lexsort((high, low))
    low, high, doc, many, source = low[order], high[order], doc[order], many[order], source[order]
    starts = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
    first = np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(low))))
    keep = (first < doc) | (many > 0)
    low, high, first, source = low[keep], high[keep], first[keep], source[keep]
    order = np.argsort(source, kind="stable")
    low, high, first, source = low[order], high[order], first[order], source[order]
    starts = _runs(source)
    slices = list(zip(starts, np.append(starts[1:], len(low))[: len(starts)], strict=True))
    return pa.table(
        {
            "chunk": chunks[source[starts]] if len(starts) else np.empty(0, np.int64),
            "low": pa.array([A.pack_sorted(low[a:b]) for a, b in slices], pa.binary()),
            "high": pa.array([A.pack(high[a:b]) for a, b in slices], pa.binary()),
            "doc": pa.array([A.pack(first[a:b].view(np.uint64)) for a, b in slices], pa.binary()),
        }
    )


def _removed(words: A.Words, ids: np.ndarray, known: tuple[np.ndarray, ...], layout: Layout) -> np.ndarray:
    """Which words a window of an earlier document covers."""
    key, doc = known
    n = max(0, words.size - layout.window + 1)
    at = np.flatnonzero(words.room()[:n] >= layout.window)
    probe = np.empty(len(at), key.dtype)
    probe["low"], probe["high"] = _prints(words, at, layout)
    found, where = _find(probe, key)
    at, where = at[found], where[found]
    at = at[doc[where] < ids[words.docs[at]]]
    change = np.zeros(words.size + 1, np.int64)
    change[at] += 1
    change[at + layout.window] -= 1
    return np.cumsum(change)[:-1] > 0


def _find(probe: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the ascending (low, high) table that equal each probe; equal lows are walked through."""
    where = np.searchsorted(key["low"], probe["low"])
    found = np.zeros(len(probe), bool)
    open_, at = np.arange(len(probe)), where.copy()
    while len(open_):
        inside = at < len(key)
        open_, at = open_[inside], at[inside]
        same = key["low"][at] == probe["low"][open_]
        open_, at = open_[same], at[same]
        hit = key["high"][at] == probe["high"][open_]
        found[open_[hit]], where[open_[hit]] = True, at[hit]
        open_, at = open_[~hit], at[~hit] + 1
    return found, where


def _kept_texts(words: A.Words, keep: np.ndarray, joined: bool) -> pa.Array:
    """The kept words of each text: joined by one space, or with the white space that followed them."""
    docs = words.docs
    starts, ends, owner = words.starts[keep], words.ends[keep], docs[keep]
    data = words.data.copy()
    mark = np.zeros(len(data) + 1, np.int8)
    if joined:
        more = np.concatenate([owner[1:] == owner[:-1], [False]]) if len(owner) else np.empty(0, bool)
        data[ends[more]] = 32
        stops = ends + more
    else:
        following = np.append(words.starts[1:], len(data))
        last = np.append(docs[1:] != docs[:-1], True) if words.size else np.empty(0, bool)
        stops = np.where(last, words.offsets[docs + 1], following)[keep]
        heads = words.offsets[:-1]
        leads = np.where(words.counts > 0, words.starts[np.minimum(np.cumsum(words.counts) - words.counts, max(words.size - 1, 0))] if words.size else 0, words.offsets[1:])
        np.add.at(mark, heads, 1)
        np.add.at(mark, leads, -1)
    mark[starts] += 1
    mark[stops] -= 1
    inside = np.cumsum(mark[:-1], dtype=np.int64) > 0
    sizes = np.concatenate([[0], np.cumsum(inside)])[words.offsets]
    return A.strings(data[inside], sizes - sizes[0])


def _rewrite(texts: pa.Table, replies: pa.Table, layout: Layout, joined: bool, schema: pa.Schema) -> pa.Table:
    if texts.num_rows == 0:
        return schema.empty_table()
    rows = replies.to_pylist()
    low = np.concatenate([A.unpack_sorted(r["low"]) for r in rows] or [np.empty(0, np.uint64)])
    high, doc = (np.concatenate([A.unpack(r[n]) for r in rows] or [np.empty(0, np.uint64)]) for n in ("high", "doc"))
    order = np.lexsort((high, low))
    key = np.empty(len(low), [("low", np.uint64), ("high", np.uint64)])
    key["low"], key["high"] = low[order], high[order]
    known = key, doc[order].view(np.int64)
    out = []
    for piece in A.table_pieces(texts, texts.column_names[2]):
        words = A.words_of(piece.column(2))
        gone = _removed(words, _ids(piece), known, layout)
        removed = np.bincount(words.docs, weights=gone, minlength=len(words.counts)).astype(np.int64)
        columns = [piece.column(1), *piece.columns[3:], _kept_texts(words, ~gone, joined), pa.array(words.counts.astype(np.int64)), pa.array(removed)]
        out.append(pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
    return pa.concat_tables(out)


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, joined: bool = True, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Documents without the passages of ``window`` words that an earlier document has.

    Returns every row and column of ``docs`` but the text, then ``kept_text``,
    ``n_words`` and ``n_removed`` (underscores are added where ``docs`` has a
    column of that name). ``joined`` writes kept words with one space between
    them; otherwise each keeps the white space that followed it, and a text
    that loses nothing stays as it was.

    Null text: no words, empty result. Texts shorter than the window keep all.
    Rows with one doc_id don't remove each other's words; a null id counts as
    the largest. No rows: no rows. A text is held whole, so its length is
    bounded by a task's memory.
    """
    length = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    alike = docs.groupBy(F.col(id_col), length.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    held = F.when(F.col("n") > 1, F.col("n") * (F.col("length") + ROW_BYTES))
    found = alike.agg(F.sum(F.col("n") * F.col("length")).alias("size"), F.max(held).alias("most")).first()
    size, tie = found.size or 0, fresh(docs, "_row")
    docs = docs.withColumn(tie, F.lit(0).cast("long"))
    if (found.most or 0) > chunk_bytes:
        # Rows of one id and length that fill a chunk are told apart by their place in a written copy.
        docs = cut(docs.withColumn(tie, F.monotonically_increasing_id()), "rows")
    chunks = max(LEAST_CHUNKS, -(-size // chunk_bytes))
    layout = Layout(window, max(LEAST_CHUNKS, -(-size // PART_BYTES)))
    others = [c for c in docs.columns if c not in (id_col, text_col, tie)]
    row = F.xxhash64(F.col(id_col), F.octet_length(text_col), F.col(tie))
    named = docs.select(F.pmod(row, F.lit(chunks)).alias("_chunk"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(others)])
    docs = docs.drop(tie)
    kept = docs.select(id_col, *others).schema
    result = T.StructType([T.StructField(f.name, f.dataType) for f in kept])
    for name, kind in (("kept_text", T.StringType()), ("n_words", T.LongType()), ("n_removed", T.LongType())):
        result = result.add(fresh(docs, name), kind)
    arrow = to_arrow_schema(result)

    def by_part(df: DataFrame):
        return df.groupBy("part")

    def beside_texts(df: DataFrame):
        return named.groupBy("_chunk").cogroup(df.groupBy("chunk"))

    probes = named.groupBy("_chunk").applyInArrow(lambda t: _probe(t, layout), PROBES)
    anchors = by_part(probes).applyInArrow(_meet_anchors, "chunk long, hashes binary")
    prints = beside_texts(anchors).applyInArrow(lambda t, r: _extend(t, r, layout), PRINTS)
    firsts = by_part(prints).applyInArrow(_meet_prints, "chunk long, low binary, high binary, doc binary")
    return beside_texts(firsts).applyInArrow(lambda t, r: _rewrite(t, r, layout, joined, arrow), result)


def oracle(window: int = WINDOW) -> str:
    """Words, removed words and a digest of the rest in DuckDB's SQL."""
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
k AS (
  SELECT *, string_agg(word, ' ') OVER ahead AS run, count(*) OVER ahead AS size FROM w
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)),
h AS (SELECT doc_id, pos, word, size = {window} AND min(doc_id) OVER (PARTITION BY run, size) < doc_id AS hit FROM k),
g AS (
  SELECT doc_id, pos, word, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS gone FROM h),
s AS (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(s.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""
