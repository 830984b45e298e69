"""URL rules, vectors, classifiers, decontamination, web archives and the pipeline on small tables."""

from __future__ import annotations

import hashlib
import io
import math
import re
import struct
import zipfile

import numpy as np
import oracle
import test_near_copies as near_copies
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillmark.llm import language, quality, templates, url_rules, vector_links, web_archive
from rillmark.llm.queries import ORACLES, QUERIES
from rillmark.llm.tables import balanced_sample, crc_fold

URLS = [
    None, "", "no scheme", "http://Example.ORG/es/1?x#y", "https://www.example.org/en/12", "http://example.org", "http://example.org?q", "https://notexample.org/es/a",
    "http://x.com/fr/", "http://x.com/de/é", "http://com/de/", "ftp://a.adult-x.net/", "http://free-bets.example.net/de/", "http://u@spam-farm.example.net:80/#f",
    "http://a.net/wp-login.php?x", "http://a.net/b/wp-login.phpx", "x://", "http://a//b://c.org/es/", "http://host.example.org/ES/", "http://İ.org/x\ny",
]


def verdict(url: str | None) -> tuple:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(str.maketrans(url_rules.UPPER, url_rules.LOWER))
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    fits = []
    for outcome, rule_host, rule_path in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")):
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            fits.append((-len(rule_host + rule_path), rule_host + rule_path, outcome))
    if fits:
        return host, path, min(fits)[1], min(fits)[2]
    globs = ["*.adult-*", "*-bets.*", "*.spam-*", "*/wp-login.php*"]
    hit = any(re.fullmatch(".*".join(map(re.escape, g.split("*"))), "." + host + path, re.S) for g in globs)
    return host, path, None, "block" if hit else "allow"


def test_urls_are_judged(spark):
    rows = [(i, u, "r", "v") for i, u in enumerate([*URLS, URLS[3], URLS[3]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, token string")
    got = url_rules.judge(pages)
    assert got.columns == ["page_id", "url", "rule", "token", "host", "path", "rule_", "verdict"]
    assert {r.page_id: (r.host, r.path, r.rule_, r.verdict) for r in got.collect()} == {i: verdict(u) for i, u, *_ in rows}
    assert url_rules.judge(pages.filter("false")).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, []).collect()} == {"allow"}
    whole = [url_rules.pattern_rule("block", "*login*"), url_rules.host_rule("allow", "net", "")]
    assert {r.page_id for r in url_rules.judge(pages, whole).filter("verdict = 'block'").collect()} == set()
    assert whole[0].tokens == () and whole[1].tokens == ("net",)


def test_url_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op3_url_filter"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def test_rules_are_indexed_by_their_rarest_token(spark):
    subjects = spark.createDataFrame([(".a.org/x",), (".b.org/x",), (".c.org/y",)], "subject string")
    rules = [url_rules.host_rule("block", "c.org", "/y/z"), url_rules.host_rule("block", "org", "/x/"), url_rules.pattern_rule("allow", "*q*")]
    assert {r.rule_no: r.token for r in url_rules.rule_index(subjects, rules).collect()} == {0: "c", 1: "x", 2: ""}


def linked_vectors(rows: list[tuple]) -> list[tuple]:
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    near = [[i != j and a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.9 for j, b in enumerate(units)] for i, a in enumerate(units)]
    label = list(range(len(rows)))
    for i, row in enumerate(near):
        for j, hit in enumerate(row):
            if hit and label[i] != label[j]:
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    least = {g: min((rows[i][0] for i in range(len(rows)) if label[i] == g and rows[i][0] is not None), default=None) for g in label}
    return sorted(((i, sum(near[k]), least[label[k]], i == least[label[k]]) for k, (i, _) in enumerate(rows)), key=repr)


def vectors(seed: int, n: int, dim: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(int(i), (centres[i % 6] + rng.normal(size=dim) * 0.35).astype(np.float32).tolist()) for i in range(n)]
    odd = [None, [], [0.0] * dim, [1.0] * (dim - 1) + [None], [1.0] * (dim - 1) + [math.nan], [1.0] * (dim - 1) + [math.inf], [1.0] * (dim + 1), [1e30] * dim, [1e-30] * dim]
    return [*rows, *((1000 + k, v) for k, v in enumerate(odd)), rows[0], (2000, rows[0][1]), (2001, rows[0][1]), (None, rows[1][1]), (None, None)]


@pytest.mark.parametrize(("n", "dim", "block"), [(120, 4, 8), (150, 16, 20), (40, 3, 2048)])
def test_vector_links_match_brute_force(spark, n, dim, block):
    rows = vectors(n, n, dim)
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cid int, v int").repartition(4)
    got = vector_links.near_duplicates(table, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == linked_vectors(rows)


def test_vectors_in_double_precision_and_empty(spark):
    table = spark.createDataFrame(vectors(1, 30, 5), "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in vector_links.near_duplicates(table).collect()), key=repr) == linked_vectors(vectors(1, 30, 5))
    assert vector_links.near_duplicates(table.filter("false")).count() == 0
    assert [tuple(r) for r in vector_links.near_duplicates(table.filter("vec_id = 1002")).collect()] == [(1002, 0, 1002, True)]


def test_copies_cover_the_radius():
    rng = np.random.default_rng(9)
    u = vector_links.units(rng.normal(size=(400, 5)))
    pivots = u[:12]
    home, inside = vector_links._home_and_cells(u, pivots, math.sqrt(0.2))
    for a, b in zip(*np.nonzero(u @ u.T >= 0.9), strict=True):
        assert inside[b, home[a]]
    assert not inside.all()


def test_language_is_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op6_language_id"](spark, sf_dir)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == docs.count()
    joined = found.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert joined.right > 0.95 and 0 <= joined.low <= joined.high <= 1


def test_language_edge_cases(spark):
    texts = ["the and of to", "der die das und", None, "", "123 !?", "le la les", "漢字"]
    rows = [(i, t, ["en", "de", "en", "de", None, "fr", "en"][i % 7], 0.5) for i, t in enumerate(texts * 3)] + [(0, "the and of to", "en", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, salt double")
    model = language.train(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert model.languages == ["de", "en", "fr"]
    assert [got[i][0] for i in (0, 1, 5)] == ["en", "de", "fr"]
    assert [got[i] for i in (2, 3, 4)] == [("und", 0.0)] * 3 and got[6][0] in model.languages
    empty = language.train(docs.filter("false"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, empty).collect()} == {("und", 0.0)}


def test_word_features_stay_inside_words():
    features, sizes = language.word_features(pa.array([b"ab", b"x", "éß".encode()], pa.large_binary()))
    assert sizes.tolist() == [2 + 3 + 2, 1 + 2 + 1, 2 + 3 + 2]
    alone, _ = language.word_features(pa.array([b"x"], pa.large_binary()))
    assert features[7:11].tolist() == alone.tolist()


def test_temperature_undoes_a_factor():
    rng = np.random.default_rng(4)
    logits = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in language.softmax(logits)])
    assert language.temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)


def test_quality_is_found(spark, sf_dir):
    found = QUERIES["op9_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    right = found.join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.9
    folds = found.select("held_out", (crc_fold("doc_id", 3) == 1).alias("fold")).distinct().collect()
    assert {(r.held_out, r.fold) for r in folds} == {(True, True), (False, False)}


def test_quality_edge_cases(spark):
    rows = [(i, "Plain words here and there, one after another." if i % 2 else "!!! ### $$$ %%%", 7) for i in range(200)] + [(500, None, 7), (501, "", 7), (0, "", 7), (None, "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(1, None, 0), (3, 0, 0), (None, 1, 0), (9999, 1, 0)], "doc_id long, quality int, salt int")
    model = quality.train(docs, labels, F.lit(True))
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in scored if r.doc_id is not None and 0 < r.doc_id < 200)
    for none in (labels.filter("false"), labels.filter("quality = 1")):
        assert {r.score for r in quality.score(docs, quality.train(docs, none, F.lit(True))).collect()} == ({0.5} if none.isEmpty() else {1 / (1 + math.exp(-6.0))})
    assert quality.statistics(pa.array([None, ""], pa.string())).tolist() == [[0.0] * len(quality.STATISTICS)] * 2


def test_trees_equal_a_walk_by_rows():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 4)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.grow(x, y, np.ones(500), trees=20)

    def walk(row):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(t):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += leaf[node - len(t)]
        return total

    assert trees.margin(x) == pytest.approx([walk(r) for r in x])
    assert ((trees.scores(x) >= 0.5) == (y == 1)).mean() > 0.97


def test_sample_is_bounded_and_balanced(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 4900, "big").otherwise("small").alias("kind"))
    n = {r.label: r["count"] for r in balanced_sample(rows, "id", "kind", 64).groupBy("label").count().collect()}
    assert n["big"] == 64 and 40 <= n["small"] <= 64


QUESTION = "Maria bought 12 apples and Peter bought 7 pears, so how many fruits did Maria and Peter carry home after 3 hours?"


def test_reparameterised_questions_are_found(spark):
    changed = QUESTION.replace("Maria", "Olga").replace("Peter", "Hugo").replace("12", "40").replace("7", "15").replace("hours", "days")
    mixed = QUESTION.replace("so how many fruits did Maria", "so how many fruits did Olga").replace("bought 12", "bought 5")
    texts = {
        1: QUESTION, 2: "Intro. " + QUESTION.lower().replace("maria", "Maria").replace("peter", "Peter") + " More text.", 3: "x " + changed + " y",
        4: QUESTION.replace("Peter carry", "Hugo carry").replace("and Peter bought", "and Olga bought"), 5: "Some other text about apples and pears that Maria bought.",
        6: None, 7: "", 8: "word " * 4000 + QUESTION + " word" * 4000, 9: "short one", 10: " ".join(QUESTION.split()[:9]), 11: "\n".join(QUESTION.split()), 12: mixed,
    }
    docs = spark.createDataFrame([*((i, t, 1) for i, t in texts.items()), (1, QUESTION, 1), (None, QUESTION, 1)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, QUESTION, 0), (2, None, 0), (3, "", 0), (4, "short one", 0), (5, "1 2 3 4 5 6", 0), (1, QUESTION, 0)], "item_id long, text string, doc_id int")
    # Four bits in all let every window pass the filter; the join alone decides then.
    for most_bits in (28, 10, 3):
        rows = templates.contaminated(docs, bench, most_bits=most_bits).collect()
        kinds = {(r.doc_id, r.item_id): r.kind for r in rows}
        assert kinds == {(1, 1): "verbatim", (2, 1): "verbatim", (3, 1): "reparameterised", (8, 1): "verbatim", (11, 1): "verbatim", (9, 4): "verbatim", (None, 1): "verbatim"}
        assert sum(r.doc_id == 1 for r in rows) == 4
    left = templates.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 7, 10, 12]
    assert templates.contaminated(docs.filter("false"), bench).count() == 0
    assert templates.contaminated(docs, bench.filter("false")).count() == 0


def test_planted_passages_are_found(spark, sf_dir):
    squeeze = lambda t: " " + " ".join((t or "").split()) + " "
    docs = {r.doc_id: squeeze(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: squeeze(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    whole = {(d, i) for i, t in items.items() for d, text in docs.items() if t in text}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, sf_dir).collect()}
    assert whole <= got
    for d, i in got - whole:
        assert len(set(docs[d].split()) & set(items[i].split())) >= 0.5 * len(set(items[i].split()))


PAGES = [
    (1, "http://a/1", "x" * 1000, "z"), (2, "http://a/2", "x" * 1000, "z"), (3, None, "x" * 999, "z"), (4, "http://a/4", "x" * 999, "z"), (5, "u\r\nWARC-Type: x", None, "z"),
    (6, "", "", "z"), (7, "http://é/ü", "é" * 600, "z"), (8, "http://a b/", "é" * 600, "z"), (8, "http://a b/", "é" * 600, "z"), (None, "n", "é" * 600, "z"), (9, "big", "ab\r\n\r\n" * 300_000, None),
    (None, "n", "q" * 1500, "z"), (None, "n", "q" * 1500, "z"),
]


def test_pages_come_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, sha1 string").repartition(3)
    files = web_archive.write_pages(pages, str(tmp_path))
    got = web_archive.read_pages(files).collect()
    payload = lambda html: (html or "").encode()
    expected = []
    for i, url, html, _ in PAGES:
        top = max((j for j, _, h, _ in PAGES if h == html and j is not None), default=None) if len(payload(html)) >= 1000 else None
        revisit = top is not None and (i is None or i < top)
        shown = url if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
        expected.append((i, shown, len(payload(html)), hashlib.sha1(payload(html)).hexdigest(), "revisit" if revisit else "response", top if revisit else None, None if revisit else payload(html)))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)
    assert web_archive.read_pages(web_archive.write_pages(pages.filter("false"), str(tmp_path / "none"))).count() == 0
    for (path,) in files.collect():
        with zipfile.ZipFile(path) as package:
            assert package.testzip() is None and all(m.compress_type == zipfile.ZIP_STORED for m in package.infolist())


@pytest.mark.parametrize("limit", [1 << 31, 200])
def test_directories_of_both_kinds(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1 if limit == 200 else 65535)
    sink = io.BytesIO()
    rows = [(i, f"http://a/{i}", b"p" * (50 * i), hashlib.sha1(b"p" * (50 * i)).digest(), None) for i in range(30)]
    assert web_archive.write_archive(sink, iter(rows)) == 30
    raw = sink.getvalue()
    assert (struct.pack("<I", web_archive.END64) in raw) == (limit == 200)
    for tail in (b"", b"a note"):
        noted = raw[:-2] + struct.pack("<H", len(tail)) + tail
        reader = web_archive.ArchiveReader(pa.PythonFile(io.BytesIO(noted), "r"))
        headers, block = reader.record(reader.entries[17])
        assert headers["WARC-Record-ID"] == "<urn:page:17>" and block.endswith(b"\r\n\r\n" + b"p" * 850)
    with pytest.raises(ValueError):
        web_archive.directory(pa.PythonFile(io.BytesIO(b"no archive at all, but long enough for an end record"), "r"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_registered_queries_match_sql(name, spark, sf_dir):
    con = oracle.connect(sf_dir)
    assert oracle.difference(oracle.spark_bag(QUERIES[name](spark, sf_dir)), oracle.sql_bag(con, ORACLES[name])) is None


def test_registered_vectors_match_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(300)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert sorted((tuple(r) for r in vector_links.near_duplicates(table).collect()), key=repr) == linked_vectors(rows)


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline
    from rillmark.llm import piece_codec, repeats

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).cache()
    odd = spark.createDataFrame([(90_001, None, "en", None, None), (90_002, "", None, "s", 0), (None, "Plain words for a null id, one after another here.", None, None, 3)], docs.schema)
    docs = docs.union(odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "substring_dedup":
            before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in rows}
            removed = {r.doc_id: r.n_removed for r in repeats.drop_repeats(docs).collect()}
            assert before.keys() == after.keys() and any(removed.values())
            assert all(after[i] == before[i] if not removed[i] else after[i].n_chars == len(after[i].text) < len(before[i].text) for i in after)
        if name == "simhash_near_dedup":
            texts = {i: r.text for i, r in enumerate(docs.collect())}
            assert len(set(near_copies.groups(texts).values())) == len(rows)
        if name == "decontaminate":
            gone = {r.doc_id for r in templates.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
            assert sorted(r.doc_id or -1 for r in rows) == sorted(r.doc_id or -1 for r in docs.collect() if r.doc_id not in gone)
        if name == "sentencepiece":
            library = piece_codec.library()
            assert out.columns == [*docs.columns, "ids", "n_pieces"]
            assert all(r.ids == (None if r.text is None else library.encode(r.text)) for r in rows)
            assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
        docs = spark.createDataFrame(rows, out.schema)
    assert len(rows) > 50


def test_pipeline_run_is_its_stages_one_after_the_other(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < docs.count() <= kept, name
        kept = docs.count()
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == docs.columns
    assert oracle.difference(oracle.spark_bag(got.withColumn("ids", F.xxhash64("ids"))), oracle.spark_bag(docs.withColumn("ids", F.xxhash64("ids")))) is None
