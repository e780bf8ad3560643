"""Session helpers for tests, the bench and local runs.

On a cluster the caller owns the session; nothing here is required by the
pipelines themselves.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package is written against.  AQE re-plans joins
# from real runtime sizes (that is the size check behind every broadcast we
# get), coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # File sizes are no proof of a side's size: only AQE, which has measured
    # it, may turn a join into a broadcast join.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster, sized from the bytes a job reads.

    Shuffle partitions are input/target, at least twice the task slots, and
    AQE coalesces the small ones toward ``target_partition_bytes``; skewed
    partitions above 4x the median are split.  A join becomes a broadcast
    join only from a measured size below a fixed ceiling.
    """
    slots = executors * cores_per_executor
    parts = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        **{k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.sql.adaptive")},
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "encore",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; sets a scratch checkpoint dir."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="encore-ckpt-")
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="encore-wh-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared file system path every executor can reach);
    only when it is unset on a local-mode session (tests) do we take a fresh
    scratch folder of our own -- on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(a machine-local folder does not survive a lost executor)")
        d = tempfile.mkdtemp(prefix="encore-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
