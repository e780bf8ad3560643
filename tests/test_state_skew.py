"""Kept daily state, sketches, frequent keys and bucketed tables."""

import random
import re
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from encore import registry, schemas
from encore.operators import skew
from encore.operators.trailing import daily_state, sketch_state, trailing_from_sketches, trailing_from_state, trailing_stats
from encore.plans import jobs, machines, songs
from encore.sinks import tables as W
from encore.sources import fixtures as fx

ARGS = ("songid", "data_dt", (7, 30), ("uid", "order_id"))


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def _plays(spark, n=900, days=50):
    rnd = random.Random(11)
    recs = [(rnd.choice(["a", "b", "c", None]), rnd.choice(["u1", "u2", "0", "", None]), f"o{rnd.randrange(60)}",
             f"202001{d + 1:02d}" if (d := rnd.randrange(days)) < 31 else f"202002{d - 30:02d}") for _ in range(n)]
    return spark.createDataFrame(recs, "songid string, uid string, order_id string, data_dt string")


def test_state_merges_to_the_same_statistics(spark):
    plays = _plays(spark)
    state = daily_state(plays, "songid", "data_dt", ("uid", "order_id"))
    for first, last in ((None, None), ("20200210", "20200212"), ("20200212", "20200212")):
        assert rows(trailing_from_state(state, *ARGS, first, last)) == rows(trailing_stats(plays, *ARGS, first, last))


def test_many_days_gathers_no_sets(spark):
    plan = _plan(trailing_stats(_plays(spark), *ARGS))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_" not in plan


def test_sketches_are_near_and_of_fixed_size(spark):
    many = spark.range(60_000).select((F.col("id") % 2).cast("string").alias("songid"), F.col("id").cast("string").alias("uid"),
                                      F.lit("o").alias("order_id"), F.concat(F.lit("2020010"), F.col("id") % 3 + 1).alias("data_dt"))
    state = sketch_state(many, "songid", "data_dt", ("uid", "order_id"))
    assert state.agg(F.max(F.length("s_uid"))).first()[0] < 4200
    got = {r.songid: r for r in trailing_from_sketches(state, *ARGS).where(F.col("data_dt") == "20200103").collect()}
    assert all(abs(r.d_uid_7 - 30_000) < 1500 and r.d_order_id_7 == 1 and r.n_7 == 30_000 for r in got.values()) and len(got) == 2
    small = _plays(spark)
    exact, near = trailing_stats(small, *ARGS), trailing_from_sketches(sketch_state(small, "songid", "data_dt", ("uid", "order_id")), *ARGS)
    assert rows(near) == rows(exact)          # few values are counted exactly


def test_state_update_scans_its_day_only(spark):
    name, path = f"st_{uuid.uuid4().hex[:8]}", W.stage_path(spark)
    W.create_table(spark, name, schemas.SONG_PLAY, location=path)
    W.write_partitioned(fx.play_log(spark, SF_SMALL), path)
    W.recover_partitions(spark, name)
    plan = _plan(songs.song_state(jobs.read_day(spark.table(name), "19950210")))
    assert re.findall(r"PartitionFilters: \[([^\]]*)\]", plan) and "= 19950210" in plan
    t = jobs.Tables(play=name, song_state=name + "_state", song_sketches=name + "_sk", song_features=name + "_f", song_base=name + "_b")
    for table, schema in ((t.song_state, schemas.SONG_STATE), (t.song_sketches, schemas.SONG_SKETCHES), (t.song_features, schemas.SONG_FEATURES)):
        W.create_table(spark, table, schema, location=W.stage_path(spark))
    W.create_table(spark, t.song_base, schemas.SONG_BASE, partition_col=None, location=W.stage_path(spark))
    for day in ("19950208", "19950210"):
        jobs.update_song_state(spark, day, t)
        jobs.update_song_state(spark, day, t, distinct="approx")
    plays = fx.play_log(spark, SF_SMALL).where(F.col("data_dt").isin("19950208", "19950210"))
    want = rows(songs.features(plays, spark.table(t.song_base), "19950210", "19950210"))
    for source in ("state", "sketches"):
        jobs.build_song_features(spark, "19950210", None, t, source=source)
        assert rows(spark.table(t.song_features)) == want


def test_skewed_join_equals_join_and_is_balanced(spark):
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise((F.col("id") % 500).cast("string")).alias("uid"),
        "id").unionAll(spark.createDataFrame([("hot", 7)] * 3, "uid string, id bigint"))
    right = spark.range(1, 400).select(F.col("id").cast("string").alias("uid"), F.col("id").alias("r")).unionAll(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "uid string, r bigint"))
    got = skew.skewed_left_join(left, right, "uid")
    assert rows(got) == rows(left.join(right, "uid", "left"))
    assert set(skew.frequent_keys(left, "uid", 8)) == {"hot"}
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        dealt = skew.skewed_left_join(left, right, "uid").where("uid IS NOT NULL").groupBy(F.spark_partition_id()).count()
        sizes = sorted(r[1] for r in dealt.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]


def test_skewed_join_without_frequent_or_any_rows(spark):
    left = spark.range(100).select(F.col("id").cast("string").alias("uid"))
    right = left.select("uid", F.lit(1).alias("r"))
    assert skew.frequent_keys(left, "uid", 4) == {}
    assert rows(skew.skewed_left_join(left, right, "uid", 4)) == rows(left.join(right, "uid", "left"))
    assert skew.skewed_left_join(left.limit(0), right, "uid").count() == 0


def test_bucketed_sources_join_without_shuffle(spark):
    df = registry.QUERIES["machine_base_info_bucketed"](spark, SF_SMALL)
    plan = _plan(df)
    keyed = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert keyed and set(keyed) <= {"store_id", "id"} and plan.count("SortMergeJoin") >= 4
    m = fx.machine_sources(spark, SF_SMALL, True)
    assert rows(df) == rows(machines.base_info(m["mac"], m["loc"], m["admin"], m["store_map"], m["store"]))


def test_frequent_and_missing_keys_go_apart_with_the_same_statistics(spark):
    from encore.operators.trailing import _days_as_bits, _per_day, _stacked, apart_by_key
    rnd = random.Random(4)
    recs = [("hot" if rnd.random() < 0.4 else rnd.choice([None, *"abcdefghijklmnopqrstuvwxyz"]), rnd.choice(["0", None, "u1", "u2"]),
             f"o{rnd.randrange(40)}", rnd.choice(["20200101", "20200131", "20200310", "20200311", None])) for _ in range(900)]
    plays = spark.createDataFrame(recs, "songid string, uid string, order_id string, data_dt string")
    calm, apart = apart_by_key(plays, "songid")
    assert {r.songid for r in apart.distinct().select("songid").collect()} >= {"hot", None}
    assert calm.count() + apart.count() == 900 and calm.where("songid = 'hot'").count() == 0
    stacked = _stacked(plays, "songid", "data_dt", ("uid", "order_id"))
    first, last = stacked.agg(F.min("dn"), F.max("dn")).first()
    want, got = _per_day(stacked), _days_as_bits(stacked, first, last)
    cols = ("key", "kind", "v", "dn")
    assert last - first > 64 and rows(got, *cols) == rows(want, *cols)
    assert rows(got.where("kind = '#'"), *cols, "n") == rows(want.where("kind = '#'"), *cols, "n")


def test_plays_are_shuffled_once_by_song(spark):
    """The rows of all songs but those apart meet one shuffle, whose keys all later steps share."""
    plays = _plays(spark)
    plan = _plan(trailing_stats(plays, *ARGS))
    assert plan.count("REPARTITION_BY_COL") == 1 and len(re.findall("Exchange hashpartitioning", plan)) == 1 + 3  # three of those apart
