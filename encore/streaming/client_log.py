"""Incremental client-log ingest with Structured Streaming.

The batch job parses a whole day's log file at once.  Where log files land in
a directory over the day (``<landing>/data_dt=<yyyyMMdd>/*.gz``), the same
parse runs as a file stream: each new file is processed once, the song-play
rows are appended to the day partitions of a parquet table and the routed
text per request type to its directories.  The file sinks and the stream
checkpoint (under ``spark.checkpoint.dir`` unless given) make every file's
rows appear exactly once, also across restarts and lost executors.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans import client_log
from ..session import checkpoint_dir

_LANDING_SCHEMA = T.StructType([T.StructField("value", T.StringType()),
                                T.StructField("data_dt", T.StringType())])


def _lines(spark: SparkSession, landing_dir: str, max_files: int | None):
    r = spark.readStream.format("text").schema(_LANDING_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(landing_dir)


def start_song_play_stream(spark: SparkSession, landing_dir: str, table_dir: str,
                           checkpoint: str | None = None, mode: str = "reference",
                           available_now: bool = True, max_files: int | None = None,
                           partitions: int | None = None) -> StreamingQuery:
    """Stream new log files into the song-play table (parquet, by ``data_dt``).

    Point ``table_dir`` at the table's location; new day directories become
    visible to catalog readers after ``sinks.tables.recover_partitions``.
    """
    parsed = client_log.parse(_lines(spark, landing_dir, max_files), mode, partitions, keep=("data_dt",))
    plays = client_log.song_play(parsed, None, mode)
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/song_play_stream"
    w = (plays.writeStream.format("parquet").outputMode("append").partitionBy("data_dt")
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_dir)


def start_routed_stream(spark: SparkSession, landing_dir: str, routed_dir: str,
                        checkpoint: str | None = None, mode: str = "reference",
                        available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Stream new log files into per-(day, request type) text directories."""
    parsed = client_log.parse(_lines(spark, landing_dir, max_files), mode, keep=("data_dt",))
    routed = client_log.route(parsed, mode).select("line", "data_dt", "request_type")
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/routed_stream"
    w = (routed.writeStream.format("text").outputMode("append").partitionBy("data_dt", "request_type")
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(routed_dir)


def start_rejects_stream(spark: SparkSession, landing_dir: str, rejects_dir: str,
                         checkpoint: str | None = None, mode: str = "reference",
                         available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Stream the song-play records that cannot be read to a parquet table by ``data_dt``."""
    parsed = client_log.parse(_lines(spark, landing_dir, max_files), mode, keep=("data_dt",))
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/rejects_stream"
    w = (client_log.rejects(parsed).writeStream.format("parquet").outputMode("append").partitionBy("data_dt")
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(rejects_dir)
