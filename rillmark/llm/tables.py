"""Column selection, written intermediate tables and label samples."""

from __future__ import annotations

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.session import scratch_dir


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that lineage ends at files all executors see."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_uri(spark: SparkSession, folder: str) -> str:
    """A folder as Spark resolves it, so that tasks that open it themselves reach the cluster's default store too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return folder if uri.startswith("file:") else uri


def open_store(uri: str) -> tuple[FileSystem, str]:
    """File system and path of a folder or file that tasks write or read by themselves."""
    return FileSystem.from_uri(uri) if ":/" in uri else (LocalFileSystem(), uri)


def crc_fold(column: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def balanced_sample(rows: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` keys of each label, drawn by hash: ``(key, label, salt)``.

    One row for each (label, salt) survives the map-side aggregate, so a label
    that holds most rows costs no task more than any other.
    """
    draw = F.xxhash64(F.lit(71), F.col(key))
    named = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), draw.alias("draw")).filter("key is not null and label is not null")
    salted = named.withColumn("salt", F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(per_label)).cast("int"))
    return salted.groupBy("label", "salt").agg(F.min_by("key", F.struct("draw", "key")).alias("key"))
