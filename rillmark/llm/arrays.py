"""Arrow text columns as numpy arrays: bytes, words, windows and compact blobs.

A *piece* is a slice of a batch with a bounded number of text bytes, so that
the arrays of one step stay small whatever the batch holds. A document is
never cut; one longer than the bound makes a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 1 << 20
#: The bytes of the class [\x20\x09-\x0D] that separates words.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SECOND_MULTIPLIER = np.uint64(0xC4CEB9FE1A85EC53)
#: Runs of more bytes are hashed one by one.
LONG_RUN = 256
#: Keeps the first 0 to 8 bytes of a little-endian number.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts back to back and the offset of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Strings from bytes back to back; ``kind`` defaults to string."""
    made = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return made.cast(pa.large_string()).cast(kind or pa.string())


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each, in order.

    Workers outlive a task and keep what Arrow has freed, so that is given back after each batch.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)
        del batch, column
        pa.default_memory_pool().release_unused()


def table_pieces(table: pa.Table, text: str) -> Iterator[pa.RecordBatch]:
    return pieces(table.to_batches(), text)


@dataclass
class Words:
    """The words of some texts."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    @property
    def size(self) -> int:
        return len(self.starts)

    @cached_property
    def _encoded(self) -> tuple[np.ndarray, pa.Array]:
        return encode_spans(self.data, self.starts, self.ends)

    @property
    def codes(self) -> np.ndarray:
        """Places of the words in ``vocab``."""
        return self._encoded[0]

    @property
    def vocab(self) -> pa.Array:
        """The distinct words."""
        return self._encoded[1]

    @property
    def docs(self) -> np.ndarray:
        """Number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(np.cumsum(self.counts), self.counts) - np.arange(self.size)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits of hash of each word."""
        return span_hashes(self.data, self.starts, self.ends, seed)


def _mixed(state: np.ndarray) -> np.ndarray:
    state = state * MULTIPLIER
    state ^= state >> np.uint64(32)
    state *= SECOND_MULTIPLIER
    state ^= state >> np.uint64(29)
    return state


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 bits of hash of each run of bytes, eight bytes of all runs at a time."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    start = int(_mixed(np.array([seed + 1], np.uint64))[0])
    state = _mixed((eight[starts] & FIRST_BYTES[np.minimum(size, 8)]) ^ (size.astype(np.uint64) + np.uint64(start >> 1)))
    done, more = 8, np.flatnonzero((size > 8) & (size <= LONG_RUN))
    while len(more):
        state[more] = _mixed(state[more] ^ (eight[starts[more] + done] & FIRST_BYTES[np.minimum(size[more] - done, 8)]))
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        state[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], seed)
    return state


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run without separators, and the number of runs of each text."""
    inside = ~separators[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def encode_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes and distinct values (binary) of runs found by :func:`spans`."""
    if not len(starts):
        return np.empty(0, np.int32), pa.array([], pa.large_binary())
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    packed = data[~separators[data]]
    array = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    encoded = array.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def words_of(column: pa.Array | pa.ChunkedArray) -> Words:
    data, offsets = text_buffer(column)
    starts, ends, counts = spans(data, offsets)
    return Words(data, offsets, starts, ends, counts)


def valid_text(values: pa.Array) -> pa.Array:
    """Binary values as strings; bytes that are no UTF-8 become the replacement character."""
    try:
        return values.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in values.to_pylist()], pa.large_string())


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries, texts not yet told apart."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Runs of 1, 2, 4 ... entries; those that add up to ``size`` are put together, the short ones behind.
    part, width, total, held = hashes, 1, None, 0
    while True:
        if size & width:
            total = part if total is None else part[: len(total) - width] * _power(held) + total[width:]
            held += width
        if 2 * width > size:
            break
        part = part[: len(part) - width] * _power(width) + part[width:]
        width *= 2
    total = total[:n]
    return total ^ (total >> np.uint64(29))


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(MULTIPLIER), exponent, 1 << 64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i]`` of all i, back to back."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    begins = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - begins, lengths)


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as an offset and byte planes; planes of zeros compress away."""
    values = np.ascontiguousarray(values, np.uint64)
    if not len(values):
        return b""
    base = values.min()
    rest = values - base
    width = max(1, (int(rest.max()).bit_length() + 7) // 8)
    planes = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + int(base).to_bytes(8, "little") + planes.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    width = blob[0]
    planes = np.frombuffer(blob, np.uint8, offset=9).reshape(width, -1)
    rest = np.zeros((planes.shape[1], 8), np.uint8)
    rest[:, :width] = planes.T
    return rest.view("<u8").ravel() + np.uint64(int.from_bytes(blob[1:9], "little"))


def pack_sorted(values: np.ndarray) -> bytes:
    """As :func:`pack`, for ascending numbers: the steps between them are stored."""
    values = np.ascontiguousarray(values, np.uint64)
    return int(values[0]).to_bytes(8, "little") + pack(np.diff(values)) if len(values) else b""


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    first = np.array([int.from_bytes(blob[:8], "little")], np.uint64)
    return np.cumsum(np.concatenate([first, unpack(blob[8:])]), dtype=np.uint64)


def range_bucket(values: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bucket of each ``bits``-wide number; a bucket is a range of numbers."""
    return ((values >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)


def member(values: np.ndarray, ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in the ascending array, and where."""
    if not len(ascending):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values, at
