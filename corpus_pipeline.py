"""A training corpus from raw documents: five stages, each one operator over all its predecessor kept.

A stage is ``function(spark, docs, sf_dir)``; its result is written as Parquet
and read back as the next one's ``docs``. All but the last return the columns
of ``docs``; the last adds the piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import jaccard, piece_codec, quality, repeats, simhash, templates
from rillmark.llm.tables import crc_fold, cut, fresh


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.5 or more. It learns from the labels of two folds of three."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_fold("doc_id", 3) != 1)
    score = fresh(docs, "score")
    return quality.score(docs, model, score_col=score).filter(F.col(score) >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id. Shingles are five words, links a Jaccard similarity of 0.8."""
    return simhash.keep_one_of_each(docs, size=jaccard.SHINGLE, similarity=jaccard.SIMILARITY)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of an earlier document go from the texts; every document stays and ``n_chars`` follows its text."""
    kept, removed, null = fresh(docs, "kept_text"), fresh(docs, "n_removed"), fresh(docs, "_null")
    rows = repeats.drop_repeats(docs.withColumn(null, F.col("text").isNull()), joined=False)
    text = F.when(~F.col(null), F.col(kept))
    size = F.when(F.col(removed) > 0, F.length(kept).cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item, verbatim or re-parameterised."""
    return templates.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document; ``text`` is what they decode to. Names that ``docs`` has get underscores."""
    decoded, ids, size = (fresh(docs, name) for name in ("decoded", "ids", "n_pieces"))
    coded = piece_codec.encode(docs, ids_col=ids, decoded_col=decoded)
    return coded.withColumns({"text": F.col(decoded), size: F.size(ids).cast("long")}).drop(decoded)


STAGES = [
    ("quality_filter", quality_filter),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: Neither hashes of shingles nor trained trees nor piece ids have an SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
