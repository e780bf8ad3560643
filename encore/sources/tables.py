"""Readers: warehouse tables by name or path, day partitions, raw log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import partition_values


def read_table(spark: SparkSession, name_or_path: str, database: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """A whole table: catalog name (optionally in ``database``) or a parquet path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(name_or_path)
    return spark.table(f"{database}.{name_or_path}" if database else name_or_path)


def read_day(df: DataFrame, data_dt: str, col: str = "data_dt") -> DataFrame:
    """One day's partition; the string literal lets Catalyst prune partitions."""
    return df.where(F.col(col) == F.lit(str(data_dt)))


def read_range(df: DataFrame, low: str, high: str, col: str = "data_dt") -> DataFrame:
    """Inclusive day range ``[low, high]`` on the string partition column."""
    return df.where(F.col(col).between(F.lit(str(low)), F.lit(str(high))))


def read_client_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw client log text, one record per line (``value`` column).

    Gzip files are not splittable: each file is one task, so many smaller log
    files parallelise the read; :func:`encore.plans.client_log.parse` spreads
    the rows out again right after the read.
    """
    return spark.read.text(path)


def newest_day(spark: SparkSession, table: str, at_most: str | None = None, col: str = "data_dt") -> str | None:
    """The newest day a partitioned table has (not after ``at_most``): the catalog's list, no row is read."""
    days = {d for d in partition_values(spark, table, col) if at_most is None or d <= at_most}
    return max(days, default=None)


def log_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modified) of the files behind a landing path; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.col("modificationTime").alias("modified"))
