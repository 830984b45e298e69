"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import conversation_trie, filter_audit, language, pair_bpe, piece_codec, quality, repeats, simhash, templates, token_archive, url_rules, vector_links, web_archive
from rillmark.llm.tables import crc_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as the token files hold them, with their place in the whole sequence."""
    rows = token_archive.round_trip(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fitting rule and verdict of every page's URL."""
    return url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    coded = piece_codec.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), decoded_col="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip")
    )


def op5_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return vector_links.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and its probability of every document, learnt from four folds of five."""
    docs, fold = _table(spark, sf_dir, "documents"), crc_fold("doc_id", 5)
    model = language.train(docs, fold != 0)
    return language.predict(docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text"), model).drop("text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item found in it."""
    return templates.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many repeat an earlier passage, and a digest of the rest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = repeats.drop_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from two folds of three."""
    docs, fold = _table(spark, sf_dir, "documents"), crc_fold("doc_id", 3)
    model = quality.train(docs, _table(spark, sf_dir, "labels"), fold != 1)
    scored = quality.score(docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of every page as the packaged archives hold them."""
    return web_archive.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of every order of the five filters keeps and removes, by language."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    coded = pair_bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), decoded_col="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_frames": op1_token_frames,
    "op2_simhash": op2_simhash,
    "op3_url_filter": op3_url_filter,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_vector_links": op5_vector_links,
    "op6_language_id": op6_language_id,
    "op7_decontaminate": op7_decontaminate,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality": op9_quality,
    "op10_web_archive": op10_web_archive,
    "op11_filter_audit": op11_filter_audit,
    "op12_pair_bpe": op12_pair_bpe,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_rules.oracle(),
    "op5_vector_links": vector_links.oracle(),
    "op8_substring_dedup": repeats.oracle(),
    "op10_web_archive": web_archive.oracle(),
    "op11_filter_audit": filter_audit.oracle(),
    "op13_conversation_trie": conversation_trie.oracle(),
}
