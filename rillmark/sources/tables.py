"""Files, in-memory rows, external queries and the plain sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillmark.functions.text import camel_columns


def from_rows(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """In-memory rows, for fixtures and small configuration."""
    return spark.createDataFrame(list(rows), schema)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def line_stream(spark: SparkSession, directory: str, files_per_batch: int = 1) -> DataFrame:
    """Lines of files as they appear in a directory."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(directory)


def csv_table(spark: SparkSession, path: str, schema: str, view: str | None = None) -> DataFrame:
    """Headerless CSV with a declared schema, as a view when a name is given."""
    df = spark.read.schema(schema).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def catalog_csv_table(spark: SparkSession, name: str, path: str, schema: str) -> DataFrame:
    """A catalogued table over CSV files, to read by name and to insert into."""
    spark.sql(f"create table {name} ({schema}) using csv location '{path}'")
    return spark.table(name)


def insert_into(df: DataFrame, name: str) -> None:
    """Append rows to a catalogued table, columns by position."""
    df.write.insertInto(name)


def query_rows(spark: SparkSession, sql: str, camel: bool = False) -> DataFrame:
    """Rows of a SQL query over catalogued tables; failures are raised."""
    df = spark.sql(sql)
    return camel_columns(df) if camel else df


def jdbc_query(
    spark: SparkSession, url: str, query: str, camel: bool = False, partition: dict[str, str] | None = None, **options: str
) -> DataFrame:
    """Rows of a query run by an external database.

    ``partition`` holds ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions``: without it the read is a single task.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition:
        reader = reader.option("dbtable", f"({query}) q").options(**partition)
    else:
        reader = reader.option("query", query)
    df = reader.options(**options).load()
    return camel_columns(df) if camel else df


def print_rows(df: DataFrame, label: str = "", n: int = 20) -> StreamingQuery | None:
    """Print a batch, or start a console query for a stream."""
    if df.isStreaming:
        return df.writeStream.format("console").queryName(label or None).start()
    if label:
        print(f"{label}>")
    df.show(n, truncate=False)
    return None


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).csv(path)
