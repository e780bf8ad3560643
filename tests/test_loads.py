"""Loads of log files: taken in once, a failed load leaves nothing; counts add up; newest day without a scan."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from encore import schemas
from encore.plans import client_log, jobs
from encore.sinks import loads
from encore.sinks import tables as W
from encore.sources import fixtures as fx
from encore.sources import tables as S

DAY = "20240101"


def _tables(spark):
    name, path = f"ld_{uuid.uuid4().hex[:8]}", W.stage_path(spark)
    t = jobs.Tables(play=f"{name}_play", log_rejects=f"{name}_rej", log_counts=f"{name}_cnt", log_files=f"{name}_files")
    jobs.create_loaded_log(spark, t, path)
    return t


def _log(spark, parts=3):
    path = W.stage_path(spark)
    fx.client_log_lines(spark, SF_SMALL).repartition(parts).write.option("compression", "gzip").text(path)
    return path


def test_same_files_twice_add_nothing(spark):
    t, log, routed = _tables(spark), _log(spark), W.stage_path(spark)
    assert jobs.load_client_log(spark, log, DAY, routed, t) == 3
    once = rows(spark.table(t.play).drop("load_id"))
    assert jobs.load_client_log(spark, log, DAY, routed, t) == 0
    more = _log(spark, 1)
    assert jobs.load_client_log(spark, [log, more], DAY, routed, t) == 1
    assert rows(spark.table(t.play).drop("load_id")) == sorted(once * 2, key=repr)
    assert jobs.load_client_log(spark, log, "20240102", routed, t) == 3          # the ledger is the day's
    counts = {r.metric: r.n for r in spark.table(t.log_counts).where(F.col("data_dt") == DAY).groupBy("metric").agg(F.sum("n").alias("n")).collect()}
    assert counts["lines"] == counts["dropped"] + counts["records"] == 2 * fx.client_log_lines(spark, SF_SMALL).count()
    assert counts["rejected"] == spark.table(t.log_rejects).where(F.col("data_dt") == DAY).count()


def test_failed_load_leaves_nothing(spark, monkeypatch):
    t, log, routed = _tables(spark), _log(spark), W.stage_path(spark)
    whole = loads.write_load

    def fails_before_the_commit(frames, data_dt, load_id):
        whole({k: v for k, v in frames.items() if k != t.play}, data_dt, load_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(loads, "write_load", fails_before_the_commit)
    with pytest.raises(RuntimeError):
        jobs.load_client_log(spark, log, DAY, routed, t)
    assert spark.table(t.play).count() == 0
    monkeypatch.undo()
    assert jobs.load_client_log(spark, log, DAY, routed, t) == 3
    parsed = client_log.parse(fx.client_log_lines(spark, SF_SMALL))
    names = schemas.SONG_PLAY.names
    assert rows(spark.table(t.play), *names) == rows(client_log.song_play(parsed, DAY), *names)
    assert spark.table(t.log_rejects).count() == client_log.rejects(parsed).count()
    assert spark.table(t.log_files).count() == 3


def test_newest_day_reads_no_rows(spark):
    name, path = f"nd_{uuid.uuid4().hex[:8]}", W.stage_path(spark)
    W.create_table(spark, name, schemas.SONG_PLAY, location=path)
    assert S.newest_day(spark, name) is None
    with pytest.raises(ValueError):
        jobs.newest(spark, name)
    W.write_partitioned(fx.play_log(spark, SF_SMALL), path)
    W.recover_partitions(spark, name)
    want = fx.play_log(spark, SF_SMALL).agg(F.max("data_dt")).first()[0]
    spark.sparkContext.setJobGroup("newest", "newest")
    assert S.newest_day(spark, name) == want and S.newest_day(spark, name, at_most="19950105") == "19950105"
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("newest") in ((), [])
    spark.sparkContext.setJobGroup("", "")


def test_overwrite_days_leaves_other_days(spark):
    name = f"od_{uuid.uuid4().hex[:8]}"
    W.create_table(spark, name, schemas.SONG_PLAY, location=W.stage_path(spark))
    plays = fx.play_log(spark, SF_SMALL).where(F.col("data_dt") <= "19950105")
    days = [f"1995010{k}" for k in range(1, 6)]
    W.overwrite_days(plays, name, days)
    assert rows(spark.table(name)) == rows(plays)
    kept = plays.where((F.col("data_dt") == "19950102") & (F.col("optrate_type") == "0"))
    W.overwrite_days(kept.unionByName(plays.where(F.col("data_dt") == "19950105")), name, ["19950102", "19950103"])
    want = plays.where(~F.col("data_dt").isin("19950102", "19950103")).unionByName(kept)
    assert rows(spark.table(name)) == rows(want)


def test_counts_of_a_log_without_a_record(spark):
    t, routed, path = _tables(spark), W.stage_path(spark), W.stage_path(spark)
    spark.createDataFrame([("a&b",), ("",)], "value string").write.text(path)
    assert jobs.load_client_log(spark, path, DAY, routed, t) >= 1
    counts = {(r.metric, r.request_type): r.n for r in spark.table(t.log_counts).collect()}
    assert counts[("lines", None)] == counts[("dropped", None)] == 2 and sum(counts.values()) == 4


def test_variant_fields_and_rejects(spark):
    data = [("A", '{"mid": 5, "uid": "x", "event_id": 7}'), ("A", '{"mid": 5.5}'), ("B", "{"), ("B", None), ("B", "[1]"),
            (client_log.L.SONG_PLAY, "{")]
    df = spark.createDataFrame(data, "request_type string, payload string")
    assert rows(client_log.requests(df)) == sorted([("A", 5, None, 7), ("A", 5, None, None), ("B", None, None, None)], key=repr)
    assert rows(client_log.request_rejects(df)) == sorted([("B", "{"), ("B", None)], key=repr)
    plan = client_log.requests(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1 or plan.count("Generate") == 1
