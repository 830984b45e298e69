"""BPE encoding by backtracking over longest tokens, and decoding by an offset table.

A word is a string of base units (the byte alphabet; a word's last unit is a
unit of its own kind). An Aho-Corasick automaton over all tokens gives the
longest token at every position. The encoder takes the longest token, then
shorter ones that are prefixes of it, until the token and the one before it
are a *compatible pair*: merging their joint text leaves both as they are. If
none is, the position cannot be a token's start and the encoder steps back.
Every position is given up at most once, so the work is linear in the word,
and a sequence of compatible pairs is what the merges give.

Text is first normalised and cut into words as the tokenizer's file says;
white space ends every word, so each distinct run without white space of a
piece of text is cut and encoded once.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from rillmark.llm import arrays as A
from rillmark.llm.tables import fresh

TOKENIZER = "word_bpe_49k.json"
#: Bytes of runs, and of words, that a worker remembers with their ids between pieces of text.
MEMO_BYTES = 64 << 20
#: Pairs of tokens in a worker's compatibility table.
MEMO_PAIRS = 1 << 18
#: What a remembered word costs besides its bytes and ids.
ENTRY_BYTES = 160
#: Runs that the library cuts into words in one call.
TOGETHER = 256
#: Runs of letters and ASCII marks, which may be cut together with a space between them.
PLAIN_RUN = r"^[!-~À-ÖØ-öø-ÿ]+$"
#: Ids decoded in one step.
DECODE_IDS = 1 << 18
#: First code point of the base units in the automaton's strings.
UNITS_AT = 0x4E00


class PairEncoder:
    """Tokens, automaton and pair table of a tokenizer file with a BPE model.

    A token's number among the merges is its rank: base units come first,
    then one token for each merge, in the order of the merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = model["end_of_word_suffix"] or ""
        unusual = model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"] or model["ignore_merges"] or model["byte_fallback"] or spec["decoder"]
        if unusual or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError("only plain BPE models without a decoder, with added tokens that stand for themselves")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        vocab = model["vocab"]
        self.surface = {i: t for t, i in {**vocab, **self.added}.items()}
        self._number(vocab, [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])
        self._automaton()
        self.pairs: dict[int, bool] = {}
        #: Ids of the words met first, up to ``MEMO_BYTES``.
        self.words: dict[str, list[int]] = {}
        self.room = MEMO_BYTES
        self._offsets()

    def _number(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        """Ranks of tokens, the two parts of each, and the rank that a pair of tokens merges to."""
        made = [a + b for a, b in merges]
        merged = set(made)
        if len(merged) != len(made) or not merged <= vocab.keys():
            raise ValueError("every merge makes a token of its own")
        base = [t for t in vocab if t not in merged and t not in self.added]
        self.n_base = len(base)
        order = [*base, *made]
        rank = {t: i for i, t in enumerate(order)}
        self.ids = [vocab[t] for t in order]
        self.left = [-1] * self.n_base + [rank[a] for a, _ in merges]
        self.right = [-1] * self.n_base + [rank[b] for _, b in merges]
        self.joined = {self._key(rank[a], rank[b]): self.n_base + i for i, (a, b) in enumerate(merges)}
        # A base unit's character is its rank, so a token is a string of its units.
        self.unit = {t: chr(UNITS_AT + i) for i, t in enumerate(base)}
        self.units: list[str] = list(self.unit.values())
        for a, b in zip(self.left[self.n_base :], self.right[self.n_base :], strict=True):
            self.units.append(self.units[a] + self.units[b])
        self.length = [len(u) for u in self.units]

    @staticmethod
    def _key(a: int, b: int) -> int:
        return a << 32 | b

    def _automaton(self) -> None:
        """Only tokens that their own text merges to can occur; each knows the next shorter one that begins it.

        A token's text merges to it if that holds for both parts and nothing
        joins them before its own merge.
        """
        self.automaton = ahocorasick.Automaton()
        forms: list[bool] = []
        for i, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            forms.append(i < self.n_base or forms[a] and forms[b] and self._meet(a, b, i))
        usable = {u: i for i, u in enumerate(self.units) if forms[i]}
        for units, i in usable.items():
            self.automaton.add_word(units, i)
        self.automaton.make_automaton()
        self.shorter = [next((usable[u[:n]] for n in range(len(u) - 1, 0, -1) if u[:n] in usable), -1) for u in self.units]

    def _meet(self, a: int, b: int, until: int) -> bool:
        """Whether no merge made before ``until`` reaches over the border of two tokens.

        Merges are taken back in the reverse order of their making; of equal
        ones the right one was made later. What faces each other at the border
        at some time may have merged then if its merge comes earlier than what
        is still to be made.
        """
        while True:
            joint = self.joined.get(self._key(a, b))
            if joint is not None and joint < until:
                return False
            if a > b:
                if a < self.n_base:
                    return True
                until, a = a, self.right[a]
            else:
                if b < self.n_base:
                    return True
                until, b = b + 1, self.left[b]

    def compatible(self, a: int, b: int) -> bool:
        key = self._key(a, b)
        known = self.pairs.get(key)
        if known is None:
            known = self._meet(a, b, len(self.units))
            if len(self.pairs) < MEMO_PAIRS:
                self.pairs[key] = known
        return known

    def encode_units(self, units: str) -> list[int]:
        """Ids of one word given as base units."""
        size = len(units)
        if size == 1:
            return [self.ids[ord(units) - UNITS_AT]]
        longest, length = [-1] * size, self.length
        for end, token in self.automaton.iter(units):
            # Matches that end later are longer at the same start.
            longest[end + 1 - length[token]] = token
        open_ends = bytearray(b"\x01") * (size + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token >= 0 and not (open_ends[at + length[token]] and (not tokens or self.compatible(tokens[-1], token))):
                token = self.shorter[token]
            if token >= 0:
                tokens.append(token)
                at += length[token]
                token = longest[at] if at < size else -1
            else:
                # No token can follow here: give this border up and try the token before it shorter.
                open_ends[at] = 0
                token = tokens.pop()
                at -= length[token]
        return [self.ids[t] for t in tokens]

    def encode_run(self, run: str) -> list[int]:
        """Ids of a run without white space: added tokens stand for themselves, the rest is normalised and cut into words."""
        out: list[int] = []
        for part in self.specials.split(run) if self.specials else [run]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += [i for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self._normal(part)) for i in self.encode_word(word)]
        return out

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        """Ids of runs that match ``PLAIN_RUN``; many are cut in one call unless they hold added tokens or change their length."""
        out = []
        for lo in range(0, len(runs), TOGETHER):
            part = runs[lo : lo + TOGETHER]
            text = " ".join(part)
            normal = self._normal(text)
            if len(normal) != len(text) or self.specials and self.specials.search(text):
                out += map(self.encode_run, part)
                continue
            # Each run begins after the space that ends the one before.
            starts, at = [], 0
            for run in part:
                starts.append(at)
                at += len(run) + 1
            found: list[list[int]] = [[] for _ in part]
            n, after = 0, starts[1] if len(part) > 1 else at
            for word, (begin, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                while begin >= after:
                    n += 1
                    after = starts[n + 1] if n + 1 < len(part) else at
                found[n] += self.encode_word(word)
            out += found
        return out

    def _normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def encode_word(self, word: str) -> list[int]:
        known = self.words.get(word)
        if known is None:
            unit = self.unit
            known = self.encode_units("".join([unit[c] for c in word[:-1]]) + unit[word[-1] + self.suffix])
            cost = 2 * len(word) + 8 * len(known) + ENTRY_BYTES
            if cost <= self.room:
                self.words[word] = known
                self.room -= cost
        return known

    def _offsets(self) -> None:
        """Bytes of all tokens, each with a space in front, and where each begins."""
        table = [b" " + self.surface[i].encode() if i in self.surface else b"" for i in range(max(self.surface) + 1)]
        self.sizes = np.fromiter(map(len, table), np.int64, len(table))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of id sequences: the tokens' own strings with a space between. Other ids than tokens are left out."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        data = np.empty(ends[-1], np.uint8)
        at = 0
        for lo in range(0, len(ids), DECODE_IDS):
            part = self.blob[A.ragged(self.begins[ids[lo : lo + DECODE_IDS]], sizes[lo : lo + DECODE_IDS])]
            data[at : at + len(part)] = part
            at += len(part)
        keep = np.ones(len(data), bool)
        keep[ends[:-1][np.diff(ends) > 0]] = False
        kept = ends - np.concatenate([[0], np.cumsum(np.diff(ends) > 0)])
        return A.strings(data[keep], kept, pa.string())


class Memo:
    """Ids of the runs met first, up to ``MEMO_BYTES``; each piece of text looks its distinct runs up."""

    def __init__(self, encoder: PairEncoder):
        self.encoder, self.known, self.room = encoder, {}, MEMO_BYTES

    def __call__(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids and first id of each run, and the ids."""
        distinct = runs.to_pylist()
        found = list(map(self.known.get, distinct))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            texts = A.valid_text(runs.take(pa.array(missing)))
            plain = pc.match_substring_regex(texts, PLAIN_RUN).to_pylist()
            simple = iter(self.encoder.encode_runs(texts.filter(pa.array(plain)).to_pylist()))
            for i, is_plain, text in zip(missing, plain, texts, strict=True):
                ids = array("i", next(simple) if is_plain else self.encoder.encode_run(text.as_py())).tobytes()
                found[i] = ids
                cost = len(distinct[i]) + len(ids) + ENTRY_BYTES
                if cost <= self.room:
                    self.known[distinct[i]] = ids
                    self.room -= cost
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), np.int32)


@lru_cache(maxsize=2)
def _worker(path: str) -> Memo:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Memo(PairEncoder(path))


def encode_texts(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts back to back and where each text starts; null is empty."""
    words = A.words_of(column)
    sizes, begins, flat = _worker(path)(words.vocab)
    lengths = sizes[words.codes] if words.size else np.empty(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(words.counts)])]
    return flat[A.ragged(begins[words.codes], lengths)] if words.size else flat, ends


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text as ``ids_col`` (array of int), and what they decode to as ``decoded_col``.

    A null text is empty: no ids. A name that is taken gets underscores. Rows
    stay in their partitions, nothing is shuffled; a worker holds a piece of
    text of about a megabyte (one document, if longer) and a memo of a bounded
    number of bytes. Repeated rows are encoded each by itself.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    ids_col = fresh(docs, ids_col)
    kind = StructType([*docs.schema.fields, *StructType.fromDDL(f"`{ids_col}` array<int>").fields])
    if decoded_col:
        decoded_col = fresh(docs.withColumn(ids_col, F.lit(0)), decoded_col)
        kind = kind.add(decoded_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, text_col):
            ids, offsets = encode_texts(piece.column(piece.schema.get_field_index(text_col)), path)
            made = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
            if decoded_col:
                made.append(_worker(path).encoder.decode(ids, offsets))
            yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=kind.names)

    return docs.mapInArrow(run, kind)


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each id sequence as ``text_col``; null ids give an empty text."""
    path = path or public_tokenizers.path(TOKENIZER)
    text_col = fresh(rows, text_col)
    kind = StructType([*rows.schema.fields, *StructType.fromDDL(f"`{text_col}` string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                column = part.column(part.schema.get_field_index(ids_col))
                sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                made = _worker(path).encoder.decode(ids, np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=kind.names)

    return rows.mapInArrow(run, kind)
