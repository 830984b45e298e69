"""The backtracking encoder against the tokenizers library and against plain merging."""

from __future__ import annotations

import hashlib
import json
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rillmark.llm import pair_bpe
from rillmark.llm.queries import QUERIES

PATH = public_tokenizers.path(pair_bpe.TOKENIZER)
ODD = [
    "", None, " \t\n", "Hello<|endoftext|>World <|startoftext|>x", "<|endoftext", "it's don't WE'LL I'D", "İstanbul ΣΑΣ ẞ ﬁ", "x y   z ", "é ́a å",
    "日本語 한국어 가", "🤦🏼‍♂️ ok", "a1b22 3.14 !!!???###", "a" * 3000, "!" * 3000, "é" * 700, "x\x00y\x1cz\u0085w", "the the, The. THE; the", "ab\x0bcd\x0cef",
]


def texts():
    draw = random.Random(3)
    out = list(ODD)
    out += ["".join(draw.choice("aeinrstlhd") for _ in range(draw.randint(1, 60))) for _ in range(2000)]
    out += ["".join(chr(draw.choice([draw.randint(32, 126), draw.randint(160, 0x2FFF), draw.randint(0x1F300, 0x1F6FF)])) for _ in range(30)) for _ in range(500)]
    return out


def test_ids_and_texts_are_the_librarys(spark):
    rows = [(i, t, "mine", "d") for i, t in enumerate(texts())] + [(0, ODD[3], "mine", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").repartition(4)
    coded = pair_bpe.encode(docs, decoded_col="decoded")
    assert coded.columns == ["doc_id", "text", "ids", "decoded", "ids_", "decoded_"]
    library = Tokenizer.from_file(PATH)
    got = coded.collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids_ == want, r.text
        assert r.decoded_ == library.decode(want, skip_special_tokens=False), r.text
    again = pair_bpe.decode(coded.drop("decoded", "decoded_"), ids_col="ids_").collect()
    assert {(r.doc_id, r.decoded) for r in again} == {(r.doc_id, r.decoded_) for r in got}
    assert pair_bpe.encode(docs.filter("false"), decoded_col="decoded").count() == 0


def test_query_digests(spark, sf_dir):
    library = Tokenizer.from_file(PATH)
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want[r.doc_id] = (len(ids), *digests)
    got = QUERIES["op12_pair_bpe"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def merged(parts, ranks):
    while True:
        found = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
        if found is None:
            return parts
        i = found[1]
        parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2 :]]


@pytest.mark.parametrize("seed", range(6))
def test_random_merge_tables(tmp_path, seed):
    """Small tables of random merges, some of which make tokens that no text merges to."""
    draw = random.Random(seed)
    known, merges = list("abc"), []
    while len(merges) < 25:
        pair = (draw.choice(known), draw.choice(known))
        if "".join(pair) not in known:
            merges.append(pair)
            known.append("".join(pair))
    spec = json.loads(Tokenizer.from_file(PATH).to_str())
    spec["added_tokens"] = []
    spec["model"] |= {"vocab": {t: i for i, t in enumerate(known)}, "merges": [list(m) for m in merges], "end_of_word_suffix": None}
    path = tmp_path / "table.json"
    path.write_text(json.dumps(spec))
    encoder, ranks = pair_bpe.PairEncoder(str(path)), {m: i for i, m in enumerate(merges)}
    for _ in range(1500):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 30)))
        assert [known[i] for i in encoder.encode_word(word)] == merged(list(word), ranks)


def test_memos_are_bounded_by_bytes():
    memo = pair_bpe.Memo(pair_bpe.PairEncoder(PATH))
    memo.room = 1000
    long = [("x" * 400 + str(i)).encode() for i in range(10)]
    sizes, begins, flat = memo(pa.array(long, pa.large_binary()))
    assert len(memo.known) < 3 and memo.room >= 0
    again = memo(pa.array(long[::-1], pa.large_binary()))
    for i in range(10):
        a, b = flat[begins[i] :][: sizes[i]], again[2][again[1][9 - i] :][: again[0][9 - i]]
        assert a.tolist() == b.tolist()
