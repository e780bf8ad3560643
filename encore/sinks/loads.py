"""Loads of files that are taken in once: day tables partitioned by load, with a ledger of the files.

A load writes its rows, and the identity (path, length, time) of every file
they come from, into partitions ``(data_dt, load_id)`` of its own.  Folders are
written first and seen by nobody; they become partitions one table after the
other, and the load counts once its partition of the last table exists.  That
one catalog entry is the commit: before it the files are still new and what
the load left is dropped by the next one, after it they are never read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import create_table, described

PARTITION = ("data_dt", "load_id")
#: A file's identity.
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                      T.StructField("modified", T.TimestampType()), T.StructField("data_dt", T.StringType())])


def create_loaded_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None) -> None:
    """A parquet table partitioned by day and load; readers of the day see all its loads."""
    create_table(spark, name, schema, partition_col=PARTITION, location=location)


def _loads(spark: SparkSession, table: str, data_dt: str) -> set[str]:
    rows = spark.sql(f"SHOW PARTITIONS {table} PARTITION (`data_dt` = '{data_dt}')").collect()
    return {r[0].split("load_id=", 1)[1] for r in rows}


def drop_unfinished(spark: SparkSession, tables: list[str], data_dt: str) -> None:
    """Take out of ``tables`` what loads left there that have not reached the last one."""
    done = _loads(spark, tables[-1], data_dt)
    for table in tables[:-1]:
        for load in sorted(_loads(spark, table, data_dt) - done):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`data_dt` = '{data_dt}', `load_id` = '{load}')")


def new_files(files: DataFrame, ledger: str, data_dt: str) -> DataFrame:
    """The ``files`` (:data:`FILES` without the day) that no finished load of the day has taken in."""
    names = ["path", "length", "modified"]
    known = files.sparkSession.table(ledger).where(F.col("data_dt") == F.lit(data_dt)).select(*names)
    return files.select(*names).join(known, names, "left_anti")


def write_load(frames: dict[str, DataFrame], data_dt: str, load_id: str | None = None) -> str:
    """Write each table's rows of a load, then make them partitions in the given order; the last is the commit."""
    load_id = load_id or uuid.uuid4().hex
    for table, df in frames.items():
        spark = df.sparkSession
        cols = [c for c in spark.table(table).columns if c not in PARTITION]
        folder = f"{described(spark, table)['Location'].rstrip('/')}/data_dt={data_dt}/load_id={load_id}"
        df.select(*cols).hint("rebalance").write.mode("overwrite").parquet(folder)
    for table, df in frames.items():
        df.sparkSession.sql(f"ALTER TABLE {table} ADD PARTITION (`data_dt` = '{data_dt}', `load_id` = '{load_id}')")
        df.sparkSession.catalog.refreshTable(table)
    return load_id
