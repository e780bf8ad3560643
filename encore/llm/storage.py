"""Tables that an operator writes between its steps, in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


#: Spark's switch to delete a query's shuffle files when it ends, rather than when the driver next collects garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/encore-llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """``df`` computed once: written as Parquet in the shared folder and read again.

    Its shuffle files go as soon as it is written, so the disk holds those of one step at a time.
    """
    spark = df.sparkSession
    path, before = path or stage_path(spark, name), spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def _scanned(docs: DataFrame) -> bool:
    """Whether the rows are those of Parquet files, as they are there."""
    lines = docs._jdf.queryExecution().optimizedPlan().toString().strip().split("\n")
    scan = {line.strip(" :+-").split(" ")[0] for line in lines} <= {"Project", "Relation"} and lines[-1].endswith(" parquet")
    return scan and "_metadata" not in docs.columns


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row's file and place there (file, at: bigint), the same whenever it is computed; see :func:`numbered`."""
    if _scanned(docs):
        return docs.withColumns({"file": F.xxhash64("_metadata.file_path"), "at": F.col("_metadata.row_index")})
    own = F.monotonically_increasing_id()
    return staged(docs.withColumns({"file": F.shiftright(own, 33), "at": own.bitwiseAND((1 << 33) - 1)}), "placed")


def numbered(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with a name (a string) of each row's own, the same whenever it is computed.

    Rows of Parquet files are named by file and place in it, whatever the
    splits they are read in; anything else is written first.
    """
    if _scanned(docs):
        return docs.withColumn(column, F.concat(
            F.hex(F.xxhash64("_metadata.file_path")), F.lit("-"), F.hex("_metadata.row_index")))
    return staged(docs.withColumn(column, F.monotonically_increasing_id().cast("string")), "numbered")


def drop(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
