"""Token ids in seekable zstandard files.

A file holds documents in ascending id order. Each document's ids, unsigned
32-bit little-endian, are one independent zstandard frame (several if it has
more than ``FRAME_IDS`` ids). Then come a directory of the documents and, as
in the public seekable format, a table of all frames with the XXH64 checksum
of each; both sit in skippable frames, so any zstandard tool can unpack the
file. A reader opens the end of the file, finds the frames of the documents
it wants and decompresses only those.
"""

from __future__ import annotations

import io
import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmark.llm import arrays as A
from rillmark.llm.tables import open_store, store_uri
from rillmark.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
FRAME_IDS = 1 << 20
FILE_BYTES = 32 << 20
LEVEL = 3
#: Bytes of words and ids that a worker remembers; other words are encoded again in each piece.
MEMO_BYTES = 96 << 20
#: What a remembered word costs besides its bytes and ids.
ENTRY_BYTES = 160
#: Text of a piece: the longer, the fewer words are looked up again.
ENCODE_BYTES = 4 << 20
#: Plain words of one library call.
TOGETHER = 64
#: Printable ASCII without the apostrophe of contractions and the ``<`` of special tokens, and the letters of Latin-1.
PLAIN_WORD = r"^[!-&(-;=-~À-ÖØ-öø-ÿ]+$"
#: The tokenizer's own cut of a plain word; each part ends in a token that ends a word.
PLAIN_PARTS = r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^A-Za-zÀ-ÖØ-öø-ÿ0-9]+"
# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


class WordEncoder:
    """Ids of words by the tokenizers library; remembers the first words of a worker, up to ``MEMO_BYTES``.

    Plain words have a known number of word ends, one for each of their parts,
    so many go through the library in one call, a space between them, and are
    told apart by the tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.memo: dict[bytes, int] = {}
        self.room = MEMO_BYTES
        self.sizes, self.begins, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def __call__(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids and first id of each word, and the ids."""
        distinct = vocab.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter((self.memo.get(w, -1) for w in distinct), np.int64, len(distinct))
        missing = np.flatnonzero(known < 0)
        sizes, begins, flat = self._encode(vocab.take(pa.array(missing)))
        all_sizes, all_begins, all_flat = (np.concatenate(x) for x in ((self.sizes, sizes), (self.begins, begins + len(self.flat)), (self.flat, flat)))
        known[missing] = len(self.sizes) + np.arange(len(missing))
        cost = np.cumsum(np.fromiter((len(distinct[i]) for i in missing), np.int64, len(missing)) + 4 * sizes + ENTRY_BYTES)
        spare = int(np.searchsorted(cost, self.room, side="right"))
        self.room -= int(cost[spare - 1]) if spare else 0
        if spare:
            self.memo.update(zip(map(distinct.__getitem__, missing[:spare].tolist()), range(len(self.sizes), len(self.sizes) + spare), strict=True))
            used = len(self.sizes) + spare
            self.sizes, self.begins, self.flat = all_sizes[:used], all_begins[:used], all_flat
        return all_sizes[known], all_begins[known], all_flat

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        texts = A.valid_text(words)
        plain = pc.match_substring_regex(texts, PLAIN_WORD).to_numpy(zero_copy_only=False)
        simple, others = texts.filter(pa.array(plain)), self._call(texts.filter(pa.array(~plain)).to_pylist())
        parts, simple = pc.count_substring_regex(simple, PLAIN_PARTS).to_numpy(zero_copy_only=False), simple.to_numpy(zero_copy_only=False).tolist()
        ids = np.concatenate([np.empty(0, np.uint32), *self._call([" ".join(simple[i : i + TOGETHER]) for i in range(0, len(simple), TOGETHER)])])
        stops = (np.flatnonzero(self.ends[ids]) + 1)[np.cumsum(parts) - 1]
        sizes, begins = np.zeros(len(plain), np.int64), np.zeros(len(plain), np.int64)
        begins[plain] = np.concatenate([[0], stops[:-1]]) if len(stops) else 0
        sizes[plain] = stops - begins[plain]
        lengths = np.fromiter(map(len, others), np.int64, len(others))
        sizes[~plain], begins[~plain] = lengths, len(ids) + np.cumsum(lengths) - lengths
        return sizes, begins, np.concatenate([ids, *others])

    def _call(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode(column: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts back to back, each text's ended by ``end_id``, and where each text starts.

    No token of this tokenizer reaches over white space, so each distinct
    word of a piece is encoded once.
    """
    words = A.words_of(column)
    sizes, begins, flat = _encoder(path)(words.vocab)
    lengths = sizes[words.codes] if words.size else np.empty(0, np.int64)
    before = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.cumsum(words.counts)
    per_doc = before[ends] - before[ends - words.counts]
    offsets = np.concatenate([[0], np.cumsum(per_doc + 1)])
    ids = np.full(offsets[-1], end_id, np.uint32)
    if words.size:
        ids[A.ragged(offsets[:-1], per_doc)] = flat[A.ragged(begins[words.codes], lengths)]
    return ids, offsets


class ArchiveWriter:
    """Writes one file; ``close`` adds the directory and the seek table."""

    def __init__(self, sink: io.IOBase, level: int = LEVEL):
        self.sink, self.compressor = sink, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[bool, int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids), len(self.frames)))
        for at in range(0, len(ids), FRAME_IDS):
            raw = ids[at : at + FRAME_IDS].astype("<u4").tobytes()
            self._frame(self.compressor.compress(raw), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)

    def _frame(self, packed: bytes, size: int, checksum: int) -> None:
        self.frames.append((len(packed), size, checksum))
        self.sink.write(packed)

    def close(self) -> None:
        named, ids, sizes, frames = (list(x) for x in zip(*self.docs, strict=True)) if self.docs else ([], [], [], [])
        table = np.array([named, ids, sizes, frames], "<i8")
        listing = self.compressor.compress(table.tobytes())
        self._frame(struct.pack("<II", SKIPPABLE_MAGIC, len(listing)) + listing, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        entries = np.array(self.frames, "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class ArchiveReader:
    """Reads the documents of one seekable source."""

    def __init__(self, source):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        end = source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token archive")
        table = source.read_at(12 * count, end - 9 - 12 * count)
        self.sizes, self.raw_sizes, self.checksums = np.frombuffer(table, "<u4").reshape(count, 3).T.astype(np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        listing = source.read_at(int(self.sizes[-1]) - 8, int(self.begins[-1]) + 8)
        table = np.frombuffer(self.unpacker.decompress(listing), "<i8").reshape(4, -1)
        self.named, self.ids, self.counts, self.first = table[0].astype(bool), table[1], table[2], table[3]
        self.starts = np.cumsum(self.counts) - self.counts

    def document(self, i: int) -> bytes:
        """Ids of the i-th document as bytes; only its frames are read."""
        last = self.first[i + 1] if i + 1 < len(self.first) else len(self.sizes) - 1
        out = []
        for f in range(self.first[i], last):
            raw = self.unpacker.decompress(self.source.read_at(int(self.sizes[f]), int(self.begins[f])))
            if len(raw) != self.raw_sizes[f] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[f]:
                raise ValueError(f"frame {f} is damaged")
            out.append(raw)
        return b"".join(out)

    def find(self, wanted: set[int]) -> Iterator[tuple[int, bytes]]:
        """``(doc_id, ids)`` of the wanted documents that this file holds."""
        for i in np.flatnonzero(self.named & np.isin(self.ids, list(wanted))):
            yield int(self.ids[i]), self.document(i)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode whole texts and write them in ascending id order; returns ``(path, start)`` of the files.

    Null ids come first; rows of one id are ordered by text. A null text is
    empty and has the end id alone. Files are dealt by ranges of (id, text
    hash), so an id that repeats very often still fills several files. A task
    that runs again writes the same bytes under a name of its own and moves
    them into place. No rows: no file.
    """
    folder = store_uri(docs.sparkSession, folder)
    size = docs.select(F.sum(F.octet_length(text_col)).alias("n")).first().n or 0
    parts = max(1, -(-size // file_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    dealt = named.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, sink, tokens = TaskContext.get(), None, 0
        name = f"part-{context.partitionId():06d}"
        for piece in A.pieces(batches, "text", ENCODE_BYTES):
            if sink is None:
                store, root = open_store(folder)
                store.create_dir(root, recursive=True)
                draft = f"{root}/.{name}-{context.taskAttemptId()}"
                sink = store.open_output_stream(draft)
                writer = ArchiveWriter(sink)
            ids, offsets = encode(piece.column(1), tokenizer_path, end_id)
            for doc_id, a, b in zip(piece.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                writer.add(doc_id, ids[a:b])
            tokens += len(ids)
        if sink is not None:
            writer.close()
            sink.close()
            store.move(draft, f"{root}/{name}.tok.zst")
            yield pa.record_batch([pa.array([f"{folder}/{name}.tok.zst"]), pa.array([context.partitionId()], pa.int64()), pa.array([tokens], pa.int64())], names=["path", "part", "tokens"])

    # One small row for each file written, as a commit protocol sends.
    files = sorted(dealt.mapInArrow(write, "path string, part long, tokens long").collect(), key=lambda r: r.part)
    rows, start = [], 0
    for f in files:
        rows.append((f.path, start))
        start += f.tokens
    return docs.sparkSession.createDataFrame(rows, "path string, start long")


def read_tokens(files: DataFrame, ids: set[int] | None = None) -> DataFrame:
    """``(doc_id, start, ids)`` of all documents, or of some, from the files of :func:`write_tokens`.

    ``start`` counts the ids of all documents before it; ``ids`` are bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, name = open_store(path)
                with store.open_input_file(name) as source:
                    reader = ArchiveReader(source)
                    wanted = range(len(reader.ids)) if ids is None else np.flatnonzero(reader.named & np.isin(reader.ids, list(ids))).tolist()
                    yield from _batches(reader, wanted, start)

    parts = max(1, files.count())
    return files.repartition(parts, "path").mapInArrow(read, "doc_id long, start long, ids binary")


def _batches(reader: ArchiveReader, wanted, start: int) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for i in wanted:
        raw = reader.document(i)
        rows.append((int(reader.ids[i]) if reader.named[i] else None, start + int(reader.starts[i]), raw))
        size += len(raw)
        if size > A.PIECE_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "start", "ids"])


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents to a new folder below the shared one and read them back."""
    folder = scratch_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, public_tokenizers.path(TOKENIZER), id_col, text_col))
