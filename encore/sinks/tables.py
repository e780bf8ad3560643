"""Writers: key-multiplexed text, partitioned parquet tables, JDBC.

Every write goes through Spark's commit protocol: a lost executor's tasks
are re-run and only committed files become visible, so a job can be
restarted and overwrites of a day partition are idempotent.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir


def write_by_key(df: DataFrame, path: str, key: str = "request_type", value: str = "line",
                 mode: str = "overwrite") -> None:
    """One directory per key value (``path/key=<k>/part-*.txt``), the key not
    written into the lines.  Rows are rebalanced by key first: a key's rows
    meet in one task, or in as many as its size needs."""
    df.select(key, value).hint("rebalance", key).write.mode(mode).partitionBy(key).text(path)


def _partition_cols(partition_col) -> tuple[str, ...]:
    return (partition_col,) if isinstance(partition_col, str) else tuple(partition_col or ())


def _ddl(schema: T.StructType, partition_cols: tuple[str, ...]) -> str:
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in partition_cols]
    return ", ".join(cols + [f"`{c}` string" for c in partition_cols])


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_col: str | tuple[str, ...] | None = "data_dt", location: str | None = None,
                 fmt: str = "parquet", options: dict | None = None, bucket_by: tuple[str, int] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS … USING <fmt> [OPTIONS] [PARTITIONED BY] [CLUSTERED BY] [LOCATION]``.

    ``bucket_by=(column, n)`` clusters and sorts the rows by the column into n
    buckets: joins and groupings on it with tables of as many buckets read
    them as they lie, without a shuffle.

    Parquet by default; ``fmt="csv", options={"sep": "\\t"}`` gives the
    tab-separated text layout of a raw (ODS) table.
    """
    parts = _partition_cols(partition_col)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, parts)}) USING {fmt}"
    if options:
        sql += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    if parts:
        sql += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})"
    if bucket_by:
        sql += f" CLUSTERED BY (`{bucket_by[0]}`) SORTED BY (`{bucket_by[0]}`) INTO {bucket_by[1]} BUCKETS"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def overwrite_partition(df: DataFrame, table: str, data_dt: str, partition_col: str = "data_dt") -> None:
    """Replace one day of ``table`` by the rows of ``df``, leaving every other day untouched.

    A static ``INSERT OVERWRITE ... PARTITION``: no rows empty the day, and no
    session setting is involved.
    """
    view = f"encore_day_{uuid.uuid4().hex}"
    cols = [c for c in df.sparkSession.table(table).columns if c != partition_col]
    df.select(*cols).hint("rebalance").createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{partition_col}` = '{data_dt}') SELECT * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def overwrite_days(df: DataFrame, table: str, days: list[str], partition_col: str = "data_dt") -> None:
    """Replace each of ``days`` by its rows of ``df``, a day without rows by nothing.

    ``df`` is computed once, into a staged folder laid out by day.  A parquet
    table takes all days with rows in one write that replaces just these
    partitions; days without rows are emptied where the table has them.
    """
    spark, path, col = df.sparkSession, stage_path(df.sparkSession), F.col(partition_col)
    df.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path).where(col.isin(list(days)))
    try:
        about = described(spark, table)
        if about.get("Provider", "").lower() != "parquet":
            for day in days:
                overwrite_partition(staged.where(col == F.lit(day)), table, day, partition_col)
            return
        present = [r[0] for r in staged.select(partition_col).distinct().collect()]
        if present:
            staged.select(*spark.table(table).columns).hint("rebalance", partition_col).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(about["Location"])
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(
                f"PARTITION (`{partition_col}` = '{d}')" for d in present))
            spark.catalog.refreshTable(table)
        known = partition_values(spark, table, partition_col)
        for day in sorted(set(days) & known - set(present)):
            overwrite_partition(staged.where("false"), table, day, partition_col)
    finally:
        drop_stage(spark, path)


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """Columns, location, provider and the like of a catalog table."""
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def partition_values(spark: SparkSession, table: str, partition_col: str = "data_dt") -> set[str]:
    """The partitions the catalog has of ``table``: names only, no data is read."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    parts = [dict(x.split("=", 1) for x in r[0].split("/")) for r in rows]
    return {p[partition_col] for p in parts}


def append_partition(df: DataFrame, table: str, data_dt: str | None = None,
                     partition_col: str = "data_dt") -> None:
    """Append rows to a day (a re-run adds the rows again, as a file load does)."""
    if data_dt is not None:
        df = df.withColumn(partition_col, F.lit(str(data_dt)))
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the whole (unpartitioned) table, keeping its definition."""
    df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)


def overwrite_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Replace an unpartitioned table of :func:`create_table` with ``bucket_by=(key, buckets)``.

    The rows are shuffled by the key first, so a bucket is one file; later
    joins on the key shuffle none of them.
    """
    df.select(*df.sparkSession.table(table).columns).repartition(buckets, key).write.mode("overwrite").insertInto(table)


def write_partitioned(df: DataFrame, path: str, partition_col: str = "data_dt") -> None:
    """Path-level dynamic overwrite of the day partitions present in ``df``."""
    df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_col).parquet(path)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register partition directories written at path level in the catalog."""
    spark.catalog.recoverPartitions(table)


def publish_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
                 properties: dict | None = None, truncate: bool = True,
                 num_partitions: int | None = None) -> None:
    """Write to a JDBC table.  ``overwrite`` truncates (keeps the DDL) when the
    table exists; ``append`` adds rows.  Connection settings (driver, user,
    password) come from the caller.  ``num_partitions`` bounds the number of
    concurrent connections."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    if mode == "overwrite" and truncate:
        w = w.option("truncate", "true")
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def stage_path(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/encore-stage-{uuid.uuid4().hex}"


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a staged folder once no plan reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, how: str = "parquet") -> DataFrame:
    """Compute ``df`` once and cut its lineage, in the shared folder named by
    ``spark.checkpoint.dir`` (never a machine-local or local checkpoint).

    ``parquet`` (default) writes a columnar table there and reads it back --
    compact, and later reads scan only the columns they use; ``checkpoint``
    uses ``DataFrame.checkpoint()``.  Either way later stages never recompute
    upstream work, and a lost executor re-reads files instead.  Jobs remove
    the folder once their result is written (:func:`staged_folders`).
    """
    spark = df.sparkSession
    if how == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    path = stage_path(spark)
    df.write.parquet(path)
    _OPEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_OPEN: dict[str, list[str]] = {}


@contextmanager
def staged_folders(spark: SparkSession):
    """Removes, at its end, the folders that :func:`materialize` wrote inside it."""
    paths = _OPEN.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        while len(paths) > before:
            drop_stage(spark, paths.pop())
