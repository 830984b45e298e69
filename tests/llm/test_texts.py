"""Operators over texts against brute force: token archives, pieces, repeats, near-duplicates."""

from __future__ import annotations

import io
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from rillmark.llm import arrays as A
from rillmark.llm import piece_codec, repeats, simhash, token_archive
from rillmark.llm.components import components, forest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, hash string, fp long, chunk int, kept_text string, part string, block int"
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["to", "The", "été", "naïve", "x1", "don't", "wörter", "12.5", "end."]) + rng.choice(["", "", "ly", "ing"]) for _ in range(n))


def documents() -> list[tuple]:
    shared = sentence(1, 40)
    texts = {
        1: sentence(2, 30), 2: shared, 3: "intro words " + shared + " outro", 4: None, 5: "", 6: " \t\n", 7: shared, 8: shared.upper(),
        9: sentence(3, 12), 10: sentence(3, 13), 11: sentence(3, 14), 12: "a a a a a a a a a a a a a a a a a a a a", 13: "b " + "a " * 30,
        14: sentence(4, 6000), 15: sentence(4, 6000) + " tail", 16: "x" * 50_000, 17: "one", 18: "ONE", 19: "two words", 20: "é è\x0b\x0cz\x1cq",
    }
    rows = [(i, t, "h", i, 0, "k", "p", 1) for i, t in texts.items()]
    return [*rows, rows[1], (21, None, None, None, None, None, None, None), (None, shared, None, None, None, None, None, None), (None, "lonely", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


def expected_repeats(rows: list[tuple], window: int) -> dict:
    key = lambda i: (i is None, i or 0)
    first: dict = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, (True, 1)), key(i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < key(i):
                gone[p : p + window] = [True] * window
        out.append((i, " ".join(x for x, g in zip(w, gone, strict=True) if not g), len(w), sum(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [1, 2, 5, 13])
def test_repeats_match_brute_force(docs, window):
    got = repeats.drop_repeats(docs, window=window)
    assert got.columns == ["doc_id", "hash", "fp", "chunk", "kept_text", "part", "block", "kept_text_", "n_words", "n_removed"]
    rows = [tuple(r) for r in got.select("doc_id", "kept_text_", "n_words", "n_removed").collect()]
    assert sorted(rows, key=repr) == expected_repeats([(r[0], r[1]) for r in documents()], window)


def test_repeats_with_small_chunks(docs):
    got = repeats.drop_repeats(docs.select("doc_id", "text"), chunk_bytes=500)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_repeats([(r[0], r[1]) for r in documents()], 13)


def test_repeats_keep_white_space(docs):
    got = {r.doc_id: r.kept_text_ for r in repeats.drop_repeats(docs.filter("doc_id in (1, 2, 3, 6, 20)"), joined=False).collect()}
    texts = dict((r[0], r[1]) for r in documents())
    assert got[1] == texts[1] and got[6] == texts[6] and got[20] == texts[20]
    assert got[3] == "intro words outro"


def fingerprint(text: str | None) -> int:
    w = WORD.findall((text or "").translate(UPPER_TO_LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(keys: list[int], near) -> dict[int, int]:
    label = list(range(len(keys)))
    for a in range(len(keys)):
        for b in range(a):
            if near(keys[a], keys[b]):
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return {k: label[i] for i, k in enumerate(keys)}


def test_near_duplicates_match_brute_force(docs):
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    prints = [(r[0], fingerprint(r[1])) for r in documents()]
    label = linked(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {g: min((i for i, p in prints if label[p] == g and i is not None), default=None) for g in label.values()}
    assert sorted(map(tuple, got), key=repr) == sorted(((i, f"{p:016x}", least[label[p]]) for i, p in prints), key=repr)


def test_one_of_each_group_stays(docs):
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {r.root for r in simhash.near_duplicates(docs).collect()}
    assert kept.count() == len(groups)


@pytest.mark.parametrize("ball_from", [1, 4, 10_000])
def test_links_connect_what_pairs_connect(spark, monkeypatch, ball_from):
    monkeypatch.setattr(simhash, "BALL_FROM", ball_from)
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(12)]
    keys = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3]))) for c in centres for _ in range(40)})
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    roots = {r.node: r.root for r in components(simhash.links(spark.createDataFrame([(k,) for k in signed], "fp long"))).collect()}
    label = linked(keys, lambda a, b: (a ^ b).bit_count() <= 2)
    for a, ka in zip(signed, keys, strict=True):
        for b, kb in zip(signed, keys, strict=True):
            assert (roots.get(a, a) == roots.get(b, b)) == (label[ka] == label[kb])


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (5, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_connects_the_same():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 50), rng.integers(0, 60, 50)
    label = linked(sorted({*a.tolist(), *b.tolist()}), lambda x, y: bool((((a == x) & (b == y)) | ((a == y) & (b == x))).any()))
    node, root = forest(a, b)
    found = dict(zip(node.tolist(), root.tolist(), strict=True))
    for x in label:
        for y in label:
            assert (found.get(x, x) == found.get(y, y)) == (label[x] == label[y])


ODD = ["a<|endoftext|>b  c'S 12　x\x1cy", "ΣΑΣ É́ é ́x", "", None, "don't do İ   z <|startoftext|> q", "\x85a\x0bb 'll'll 's", "ab.cd, e,f. ..", "漢字かな 😀 ok"]


def test_ids_are_the_librarys():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_archive.TOKENIZER)
    library = Tokenizer.from_file(path)
    texts = [*ODD, *(r[1] for r in documents())]
    ids, offsets = token_archive.encode(pa.array(texts, pa.string()), path)
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, token_archive.END_ID]


def test_token_files_hold_all_documents_in_order(spark, docs, tmp_path):
    path = public_tokenizers.path(token_archive.TOKENIZER)
    files = token_archive.write_tokens(docs, str(tmp_path), path, file_bytes=20_000)
    rows = sorted(token_archive.read_tokens(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows if r.doc_id is not None] == sorted(r[0] for r in documents() if r[0] is not None)
    assert [r.doc_id for r in rows[:2]] == [None, None]
    at = 0
    texts = {r[0]: r[1] for r in documents()}
    for r in rows:
        assert r.start == at
        at += len(r.ids) // 4
        if r.doc_id is not None:
            assert bytes(r.ids) == token_archive.encode(pa.array([texts[r.doc_id]], pa.string()), path)[0].astype("<u4").tobytes()
    assert {r.doc_id for r in token_archive.read_tokens(files, {3, 14, 999}).collect()} == {3, 14}
    empty = token_archive.write_tokens(docs.filter("false"), str(tmp_path / "none"), path)
    assert token_archive.read_tokens(empty).count() == 0


class Counted:
    """A file that counts the bytes that are read."""

    def __init__(self, raw: bytes):
        self.file, self.total = pa.PythonFile(io.BytesIO(raw), "r"), 0

    def size(self):
        return self.file.size()

    def read_at(self, nbytes, offset):
        self.total += nbytes
        return self.file.read_at(nbytes, offset)


def test_reader_reads_only_the_wanted_frames(monkeypatch):
    import zstandard

    monkeypatch.setattr(token_archive, "FRAME_IDS", 100)
    sink = io.BytesIO()
    writer = token_archive.ArchiveWriter(sink)
    rng = np.random.default_rng(1)
    ids = {i: rng.integers(0, 1 << 32, n).astype(np.uint32) for i, n in enumerate([1, 99, 100, 101, 5000, 0, 7])}
    for i, values in ids.items():
        writer.add(i, values)
    writer.close()
    raw = sink.getvalue()
    source = Counted(raw)
    reader = token_archive.ArchiveReader(source)
    listing = source.total
    assert dict(reader.find({3, 5})) == {3: ids[3].tobytes(), 5: b""}
    assert source.total - listing < 600
    assert [reader.document(i) for i in ids] == [v.tobytes() for v in ids.values()]
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole == b"".join(v.tobytes() for v in ids.values())
    damaged = bytearray(raw)
    damaged[reader.begins[1] + reader.sizes[1] - 3] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_archive.ArchiveReader(Counted(bytes(damaged))).document(1)


def test_pieces_are_the_librarys(spark, docs):
    library = piece_codec.library()
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate([*ODD, "  a  b ", " ", "▁", "a▁b ▁▁ c", "<s> <0x41> <unk>", "\n\nx\t y"])], "doc_id long, text string")
    coded = piece_codec.decode(piece_codec.encode(docs.select("doc_id", "text").union(extra)))
    for r in coded.collect():
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == library.encode(r.text)
            assert r.decoded == library.decode(r.ids)
            assert r.decoded == r.text or "▁" in r.text


def test_unigram_scores_are_the_best():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(piece_codec.MODEL), "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    for i, piece in enumerate(proto.pieces):
        if piece.type == piece.NORMAL:
            piece.score = -8 - (i * 7919 % 1009) / 100
    raw = proto.SerializeToString()
    model, library = piece_codec.PieceModel(proto=raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    words = sorted({w for r in documents() if r[1] and len(r[1]) < 2000 for w in r[1].split()} | {"abcdefg", "undeniably", "ßtraße"})
    cost = lambda ids: sum(library.get_score(i) for i in ids)
    for word, ids in zip(words, piece_codec.encode_words(["▁" + w for w in words], model), strict=True):
        assert cost(ids) == pytest.approx(cost(library.encode(word)), abs=1e-3)


def test_shared_prefixes_are_walked_once():
    model = piece_codec.PieceModel(public_tokenizers.path(piece_codec.MODEL))
    walk = piece_codec.TrieWalk(model)
    for word in ("▁abcde", "▁abcdf", "▁abcdf", "▁abx"):
        walk.go(word)
    assert walk.steps == 6 + 1 + 0 + 1


def test_packed_numbers_come_back():
    rng = np.random.default_rng(2)
    for values in (np.array([], np.uint64), np.array([5], np.uint64), rng.integers(0, 2**63, 1000).astype(np.uint64), np.array([2**64 - 1, 0], np.uint64)):
        assert (A.unpack(A.pack(values)) == values).all()
        assert (A.unpack_sorted(A.pack_sorted(np.sort(values))) == np.sort(values)).all()


def test_registered_text_queries(spark, sf_dir):
    from tokenizers import Tokenizer

    from rillmark.llm.queries import QUERIES

    rows = sorted((tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    library, at, expected = Tokenizer.from_file(public_tokenizers.path(token_archive.TOKENIZER)), 0, []
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op1_token_frames"](spark, sf_dir).collect())) == expected
    pieces = piece_codec.library()
    counts = {r.doc_id: r for r in QUERIES["op4_sentencepiece"](spark, sf_dir).collect()}
    coded = spark.createDataFrame([(i, pieces.encode(t or "")) for i, t in rows], "doc_id long, ids array<int>").select("doc_id", F.size("ids").alias("n"), F.xxhash64("ids").alias("h"))
    assert all((counts[r.doc_id].n_pieces, counts[r.doc_id].ids_hash, counts[r.doc_id].round_trip) == (r.n, r.h, True) for r in coded.collect())
    import hashlib

    kept = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_substring_dedup"](spark, sf_dir).collect()}
    assert kept == {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, k, n, g in expected_repeats(rows, 13)}
    prints = {i: fingerprint(t) for i, t in rows}
    label = linked(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {g: min(i for i, p in prints.items() if label[p] == g) for g in label.values()}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, sf_dir).collect()} == {i: (f"{p:016x}", least[label[p]]) for i, p in prints.items()}


def test_empty_tables(docs):
    none = docs.filter("false")
    assert repeats.drop_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one_of_each(none).count() == 0
    assert piece_codec.decode(piece_codec.encode(none)).count() == 0


def test_words_with_signs_and_digits_share_library_calls():
    encoder = token_archive.WordEncoder(public_tokenizers.path(token_archive.TOKENIZER))
    words = [f"Ab{i}$$%" for i in range(200)] + ["|", "--", "x-y.z", "été#1", "don't", "<|endoftext|>", "a</w>b", "it's,", "10,000.50", "Ω1"]
    sent = []
    call = encoder._call
    encoder._call = lambda texts: sent.append(len(texts)) or call(texts)
    sizes, begins, flat = encoder(pa.array([w.encode() for w in words], pa.large_binary()))
    assert [flat[b : b + n].tolist() for n, b in zip(sizes, begins)] == [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert sum(sent) <= 5 + -(-len(words) // token_archive.TOGETHER)


def test_word_ids_are_remembered_up_to_a_number_of_bytes():
    model, memo = piece_codec.PieceModel(public_tokenizers.path(piece_codec.MODEL)), piece_codec.Memo()
    memo.room, library = 2000, piece_codec.library()
    words = [("▁" + "long" * 100 + str(i)).encode() for i in range(20)] + ["▁short".encode(), "▁λ\U0001f600λ".encode()]
    for given in (words, words[::-1]):
        sizes, begins, ids = memo.look_up(given, model)
        assert [ids[b : b + n].tolist() for n, b in zip(sizes, begins)] == [library.encode(w.decode()[1:]) for w in given]
    assert 0 < len(memo.at) < 8 and memo.room >= 0
