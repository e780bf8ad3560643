"""Table and JDBC sinks: partition overwrite keeps other days and is idempotent."""

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from conftest import rows
from encore import schemas
from encore.sinks import tables as W


def _rsi_rows(spark, day, n=3):
    data = [("1", f"s{i}", f"n{i}", float(i), i + 1, day) for i in range(n)]
    return spark.createDataFrame(data, schemas.SONG_RSI)


def test_overwrite_partition_keeps_other_days(spark):
    name = f"t_rsi_{uuid.uuid4().hex[:8]}"
    loc = tempfile.mkdtemp(prefix="encore-wh-")
    W.create_table(spark, name, schemas.SONG_RSI, location=loc)
    W.create_table(spark, name, schemas.SONG_RSI, location=loc)        # IF NOT EXISTS
    W.overwrite_partition(_rsi_rows(spark, "20201229"), name, "20201229")
    W.overwrite_partition(_rsi_rows(spark, "20201230", 2), name, "20201230")
    W.overwrite_partition(_rsi_rows(spark, "20201230", 2), name, "20201230")       # re-run: idempotent
    counts = {r[0]: r[1] for r in spark.table(name).groupBy("data_dt").count().collect()}
    assert counts == {"20201229": 3, "20201230": 2}
    W.append_partition(_rsi_rows(spark, "x", 1), name, data_dt="20201230")
    assert spark.table(name).where("data_dt = '20201230'").count() == 3
    W.overwrite_partition(_rsi_rows(spark, "x", 0), name, "20201230")   # no rows: the day is emptied
    assert {r[0]: r[1] for r in spark.table(name).groupBy("data_dt").count().collect()} == {"20201229": 3}


def test_overwrite_days_and_files(spark):
    name, loc = f"t_days_{uuid.uuid4().hex[:8]}", tempfile.mkdtemp(prefix="encore-wh-")
    W.create_table(spark, name, schemas.SONG_RSI, location=loc)
    days = ["20201228", "20201229", "20201230"]
    for d in days:
        W.overwrite_partition(_rsi_rows(spark, d, 9), name, d)
    two = _rsi_rows(spark, "20201228", 4).unionByName(_rsi_rows(spark, "20201230", 5)).repartition(8)
    W.overwrite_days(two, name, days)
    assert {r[0]: r[1] for r in spark.table(name).groupBy("data_dt").count().collect()} == {"20201228": 4, "20201230": 5}
    for d in ("20201228", "20201230"):
        assert len([f for f in os.listdir(os.path.join(loc, f"data_dt={d}")) if f.endswith(".parquet")]) == 1
    path = tempfile.mkdtemp(prefix="encore-route-")
    lines = spark.range(8000).selectExpr("concat('t', id % 4) AS request_type", "cast(id AS string) AS line").repartition(8)
    W.write_by_key(lines, path)
    for k in range(4):
        assert len([f for f in os.listdir(os.path.join(path, f"request_type=t{k}")) if f.endswith(".txt")]) <= 2


def test_staged_folders_are_removed(spark):
    with W.staged_folders(spark):
        df = W.materialize(spark.range(5))
        path = df.inputFiles()[0].replace("file://", "")
        assert os.path.exists(path) and df.count() == 5
    assert not os.path.exists(path)


def test_overwrite_table_and_recover(spark):
    name = f"t_base_{uuid.uuid4().hex[:8]}"
    W.create_table(spark, name, schemas.MAC_STORE_MAP, partition_col=None)
    df = spark.createDataFrame([("1", "a"), ("2", "b")], schemas.MAC_STORE_MAP)
    W.overwrite_table(df, name)
    W.overwrite_table(df.limit(1), name)
    assert spark.table(name).count() == 1
    # path-level write, then register the partitions in the catalog
    loc = tempfile.mkdtemp(prefix="encore-wh-")
    t2 = f"t_path_{uuid.uuid4().hex[:8]}"
    W.create_table(spark, t2, schemas.SONG_RSI, location=loc)
    W.write_partitioned(_rsi_rows(spark, "20201230"), loc)
    W.recover_partitions(spark, t2)
    assert spark.table(t2).count() == 3


def test_jdbc_overwrite_and_append(spark):
    url = f"jdbc:derby:memory:encore{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    top = _rsi_rows(spark, "20201230", 5).where(F.col("rsi_rank") <= 3)
    W.publish_jdbc(top, url, "tm_song_rsi", "overwrite", props)
    W.publish_jdbc(top, url, "tm_song_rsi", "overwrite", props)
    W.publish_jdbc(top.limit(1), url, "tm_song_rsi", "append", props)
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "tm_song_rsi") \
        .option("driver", props["driver"]).load()
    assert back.count() == 4


def test_materialize_uses_checkpoint_dir(spark):
    from encore.session import checkpoint_dir
    d = checkpoint_dir(spark)
    df = W.materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and os.path.isdir(d.replace("file:", ""))
    assert rows(df.where("id < 2")) == [(0, 0), (1, 2)]


def test_cluster_conf_sizes_partitions():
    from encore.session import cluster_conf
    c = cluster_conf(100 << 40)                     # 100 TB read
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)      # the target size holds at any input
    mid = cluster_conf(4 << 40)
    assert int(mid["spark.sql.shuffle.partitions"]) == (4 << 40) // (256 << 20)
    assert c["spark.sql.adaptive.enabled"] == "true"
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80


def test_tab_separated_text_table(spark):
    name = f"t_tsv_{uuid.uuid4().hex[:8]}"
    loc = tempfile.mkdtemp(prefix="encore-tsv-")
    W.create_table(spark, name, schemas.SONG_PLAY, location=loc, fmt="csv", options={"sep": "\t"})
    df = spark.createDataFrame([("s1", "m", "0", "u", "0", "1", "2", "n", "p", "o", "20201230")], schemas.SONG_PLAY)
    W.overwrite_partition(df, name, "20201230")
    assert rows(spark.table(name)) == rows(df.select(*spark.table(name).columns))
    files = [f for d, _, fs in os.walk(loc) for f in fs if f.endswith(".csv")]
    line = open(os.path.join(loc, "data_dt=20201230", files[0])).read().strip()
    assert line == "s1\tm\t0\tu\t0\t1\t2\tn\tp\to"


def test_materialize_checkpoint_mode(spark):
    df = W.materialize(spark.range(5).withColumn("y", F.col("id") + 1), how="checkpoint")
    assert rows(df) == [(i, i + 1) for i in range(5)]
