"""SentencePiece encoding and decoding by a forward pass shared between words.

Text becomes marked words: a space turns into the mark, the text gets one in
front, and a word is a run of marks with what follows it. No piece of the
model reaches from a letter to a mark, so words are encoded one by one. The
distinct words of a slice of texts are sorted; walking through them in this
order is a depth-first walk of their trie, and the forward states of the
prefix that a word shares with the one before it stay on the stack.

The forward state of a prefix is its best score with the last piece of the
best path for a unigram model. For a BPE model, whose encoding is a sequence
of merges and not the path of the best score, it is the last piece of the
prefix's own encoding: of the pieces that end there, the one that follows its
predecessor's state as a pair the merges leave alone. Both give the ids of
the sentencepiece library; a character without a piece becomes bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from rillmark.llm import arrays as A

MODEL = "piece_bpe_32k.model"
MARK = "▁"
MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)
#: Text of a slice: the longer, the fewer words are looked up again, and the larger its arrays.
ENCODE_BYTES = 1 << 19
#: Bytes of words and ids that a task remembers between slices of texts, and what a word costs besides.
MEMO_BYTES, ENTRY_BYTES = 32 << 20, 160
#: Pairs of pieces whose merging a task remembers.
MEMO_PAIRS = 200_000
#: Steps of the piece automaton that a task remembers.
MEMO_STEPS = 200_000


class PieceModel:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        if proto is None:
            with open(path, "rb") as file:
                proto = file.read()
        model.ParseFromString(proto)
        spec = model.trainer_spec
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("only models with the identity normaliser and a dummy prefix")
        self.unigram = spec.model_type == spec.UNIGRAM
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.surface = [p.piece for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.bytes = [-1] * 256
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
        if min(self.bytes) < 0:
            raise ValueError("only models with byte pieces")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece reaches over a word's start")
        scores = [self.score[i] for i in self.ids.values()]
        self.unknown = min(scores, default=0.0) - 10.0
        #: Beginnings of pieces are the nodes of an automaton, made as texts reach them; the root is the empty one.
        self.nodes: dict[str, int] = {p[:n]: -1 for p in self.ids for n in range(1, len(p) + 1)} | {"": 0}
        self.names, self.next, self.ends, self.steps = [""], [{}], [[]], 0
        self.start = len(self.surface)
        self.pairs: dict[int | tuple[str, str], bool] = {}

    def step(self, node: int, char: str) -> int:
        """The longest beginning of a piece that ends the text once ``char`` follows what ``node`` stands for."""
        name = self.names[node] + char
        while name not in self.nodes:
            name = name[1:]
        to = self.nodes[name]
        if to < 0:
            to = self.nodes[name] = len(self.names)
            tails = [name[n:] for n in range(len(name))]
            self.names.append(name)
            self.next.append({})
            self.ends.append([(len(t), t, self.ids[t]) for t in tails if t in self.ids])
        if self.steps < MEMO_STEPS:
            self.next[node][char] = to
            self.steps += 1
        return to

    def merged(self, text: str) -> list[str]:
        """Merges from single characters on: always the best-scored adjacent pair, the left one of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: str, left_id: int, right: str, right_id: int) -> bool:
        """Whether merging leaves these two neighbours as they are; ids are -1 for characters without a piece."""
        key = left_id << 20 | right_id if left_id >= 0 and right_id >= 0 else (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = self.merged(left + right) == ([left, right] if left else [right])
            if len(self.pairs) < MEMO_PAIRS:
                self.pairs[key] = known
        return known


class TrieWalk:
    """Encodes ascending words; ``spell`` lists the pieces' ids of the word the walk stands on."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.word = ""
        #: For each prefix length: score, start, text and id of the last piece; the id is -1 for a bare character.
        self.states: list[tuple[float, int, str, int]] = [(0.0, 0, "", model.start)]
        #: For each prefix length: the automaton's node.
        self.nodes = [0]
        self.steps = 0

    def go(self, word: str) -> None:
        common, old = 0, self.word
        for a, b in zip(old, word):
            if a != b:
                break
            common += 1
        states, nodes, next_of, ends = self.states, self.nodes, self.model.next, self.model.ends
        del states[common + 1 :], nodes[common + 1 :]
        step, node = self._best if self.model.unigram else self._last, nodes[common]
        for end in range(common + 1, len(word) + 1):
            char = word[end - 1]
            to = next_of[node].get(char)
            node = self.model.step(node, char) if to is None else to
            nodes.append(node)
            states.append(step(ends[node], end, char))
        self.steps += len(word) - common
        self.word = word

    def _best(self, pieces: list[tuple[int, str, int]], end: int, char: str) -> tuple[float, int, str, int]:
        """The state after ``char``, of size, text and id of the pieces that end there, the longest first; without one of a character it stands bare."""
        model, states = self.model, self.states
        best = None
        for size, piece, i in pieces if pieces and pieces[-1][0] == 1 else [*pieces, (1, char, -1)]:
            score = states[end - size][0] + (model.score[i] if i >= 0 else model.unknown)
            if best is None or score > best[0]:
                best = score, end - size, piece, i
        return best

    def _last(self, pieces: list[tuple[int, str, int]], end: int, char: str) -> tuple[float, int, str, int]:
        """As :meth:`_best`, by merges."""
        model, states = self.model, self.states
        for size, piece, i in pieces:
            _, _, left, left_id = states[end - size]
            stays = model.pairs.get(left_id << 20 | i) if left_id >= 0 else None
            if model.stays(left, left_id, piece, i) if stays is None else stays:
                return 0.0, end - size, piece, i
        _, _, left, left_id = states[end - 1]
        if (not pieces or pieces[-1][0] != 1) and model.stays(left, left_id, char, -1):
            return 0.0, end - 1, char, -1
        raise AssertionError(f"no encoding of {self.word!r} ends here")

    def spell(self) -> list[int]:
        out, end = [], len(self.word)
        while end:
            _, start, piece, i = self.states[end]
            out.extend([i] if i >= 0 else [self.model.bytes[b] for b in reversed(piece.encode("utf-8"))])
            end = start
        return out[::-1]


class Memo:
    """Ids of the words a task met first, up to ``MEMO_BYTES``, back to back in one array."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.room = MEMO_BYTES
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int32)

    def look_up(self, words: list[bytes], model: PieceModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids and first id of each word, and the ids."""
        known = np.fromiter((self.at.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(known < 0)
        made = encode_words([words[i].decode("utf-8", "replace") for i in missing.tolist()], model)
        new = np.fromiter(map(len, made), np.int64, len(made))
        sizes = np.concatenate([self.sizes, new])
        ids = np.concatenate([self.ids, np.fromiter((i for word in made for i in word), np.int32)])
        known[missing] = len(self.sizes) + np.arange(len(missing))
        cost = np.cumsum(np.fromiter((len(words[i]) for i in missing.tolist()), np.int64, len(missing)) + 4 * new + ENTRY_BYTES)
        spare = int(np.searchsorted(cost, self.room, side="right"))
        if spare:
            self.room -= int(cost[spare - 1])
            self.at.update((words[i], len(self.sizes) + k) for k, i in enumerate(missing[:spare].tolist()))
            self.sizes = sizes[: len(self.sizes) + spare]
            self.ids = ids[: self.sizes.sum()]
        return sizes[known], (np.cumsum(sizes) - sizes)[known], ids


@lru_cache(maxsize=2)
def _worker_model(path: str) -> tuple[PieceModel, Memo]:
    return PieceModel(path), Memo()


def encode_words(words: list[str], model: PieceModel) -> list[list[int]]:
    """Ids of each word, in the given order."""
    walk, out = TrieWalk(model), [None] * len(words)
    for i in sorted(range(len(words)), key=words.__getitem__):
        walk.go(words[i])
        out[i] = walk.spell()
    return out


def marked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the marked texts, starts of their words and the number of words of each text."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    wide = np.where(data == 32, 3, 1)
    wide_offsets = np.concatenate([[0], np.cumsum(wide)])[offsets]
    shift = np.zeros(len(offsets), np.int64)
    shift[full + 1] = 3
    shift = np.cumsum(shift)
    new_offsets = wide_offsets + shift
    out = np.empty(new_offsets[-1], np.uint8)
    place = np.cumsum(wide) - wide + np.repeat(shift[1:], np.diff(offsets))
    out[place] = data
    spaces = place[data == 32]
    fronts = new_offsets[full]
    for k in range(3):
        out[spaces + k] = MARK_BYTES[k]
        out[fronts + k] = MARK_BYTES[k]
    # A word starts at each mark that no mark precedes; a mark written in the text counts as well.
    is_mark = np.zeros(len(out), bool)
    is_mark[:-2] = (out[:-2] == MARK_BYTES[0]) & (out[1:-1] == MARK_BYTES[1]) & (out[2:] == MARK_BYTES[2]) if len(out) > 2 else False
    after = np.zeros(len(out) + 3, bool)
    after[3:] = is_mark
    first = np.zeros(len(out), bool)
    first[fronts] = True
    starts = np.flatnonzero(is_mark & (~after[: len(out)] | first))
    return out, starts, np.diff(np.searchsorted(starts, new_offsets))


def encode_texts(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts back to back and where each text starts; null and empty texts have none."""
    model, memo = _worker_model(path)
    data, starts, counts = marked(*A.text_buffer(column))
    if not len(starts):
        return np.empty(0, np.int32), np.zeros(len(counts) + 1, np.int64)
    ends = np.append(starts[1:], len(data))
    array = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
    encoded = array.dictionary_encode()
    codes = encoded.indices.to_numpy()
    sizes, begins, flat = memo.look_up(encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), model)
    lengths = sizes[codes]
    last = np.cumsum(counts)
    before = np.concatenate([[0], np.cumsum(lengths)])
    return flat[A.ragged(begins[codes], lengths)], np.concatenate([[0], before[last]])


def decode_ids(ids: np.ndarray, offsets: np.ndarray, model: PieceModel) -> pa.Array:
    """Texts of id sequences: marks become spaces, the one in front goes, byte pieces join into characters."""
    table = [p.replace(MARK, " ").encode() for p in model.surface]
    for value, i in enumerate(model.bytes):
        table[i] = bytes([value])
    size = np.fromiter(map(len, table), np.int64, len(table))
    flat = np.frombuffer(b"".join(table), np.uint8)
    lengths = size[ids]
    data = flat[A.ragged((np.cumsum(size) - size)[ids], lengths)]
    ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
    fronts = ends[:-1][np.diff(ends) > 0]
    keep = np.ones(len(data), bool)
    keep[fronts[data[fronts] == 32]] = False
    kept = np.concatenate([[0], np.cumsum(keep)])[ends]
    made = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(data[keep])])
    return A.valid_text(made).cast(pa.string())


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of each text as ``ids_col`` (array of int).

    Null texts have null ids and empty texts an empty list; whole texts are
    encoded. Nothing is shuffled, rows stay in their partitions. With
    ``decoded_col`` the ids are decoded in the same pass, as ``decode`` does.
    """
    path = path or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, text_col, ENCODE_BYTES):
            column = piece.column(piece.schema.get_field_index(text_col))
            ids, offsets = encode_texts(column, path)
            made = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=column.is_null())
            columns, names = [*piece.columns, made], [*piece.schema.names, ids_col]
            if decoded_col:
                columns.append(_decoded(made, _worker_model(path)[0]))
                names.append(decoded_col)
            yield pa.RecordBatch.from_arrays(columns, names=names)
        # The worker goes on to tasks of other stages.
        _worker_model.cache_clear()

    kind = _with(docs, ids_col, "array<int>")
    return docs.mapInArrow(run, kind.add(decoded_col, "string") if decoded_col else kind)


def _decoded(column: pa.ListArray, model: PieceModel) -> pa.Array:
    sizes = column.value_lengths().fill_null(0).to_numpy()
    made = decode_ids(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]), model)
    return pc.if_else(column.is_valid(), made, pa.scalar(None, pa.string()))


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each id sequence as ``text_col``; null ids give null. An id outside the model fails."""
    path = path or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _worker_model(path)[0]
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                made = _decoded(part.column(part.schema.get_field_index(ids_col)), model)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, text_col])

    return rows.mapInArrow(run, _with(rows, text_col, "string"))


def _with(df: DataFrame, name: str, kind: str) -> StructType:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"there is a column {name} already")
    return StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])


def library(path: str | None = None):
    """The library's own processor for the model, to compare with."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
