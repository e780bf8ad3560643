"""Ranking operators and the RSI jobs."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from encore import schemas
from encore.operators.ranking import row_number, row_number_window, top_n
from encore.plans import rsi


def _scores(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one dominant group (a third of all rows), ties on the score, a NULL group
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        data.append((g, rnd.choice(["1", "7", "30"]), f"id{i:05d}", float(rnd.randint(0, 20))))
    return spark.createDataFrame(data, "grp string, period string, id string, score double")


def test_rank_equals_window(spark):
    df = _scores(spark).repartition(7)
    order = [F.col("score").desc(), F.col("id").asc()]
    a = row_number(df, ["grp", "period"], order, "rk")
    b = row_number_window(df, ["grp", "period"], order, "rk")
    assert rows(a, "grp", "period", "id", "rk") == rows(b, "grp", "period", "id", "rk")


def test_rank_no_groups(spark):
    df = _scores(spark, 500)
    order = [F.col("score").desc(), F.col("id").asc()]
    a = row_number(df, [], order, "rk")
    b = row_number_window(df.withColumn("one", F.lit(1)), ["one"], order, "rk").drop("one")
    assert rows(a, "id", "rk") == rows(b, "id", "rk")


def test_top_n(spark):
    df = _scores(spark)
    order = [F.col("score").desc(), F.col("id").asc()]
    t = top_n(df, ["grp", "period"], order, 5, "rk")
    full = row_number_window(df, ["grp", "period"], order, "rk").where("rk <= 5")
    assert rows(t) == rows(full)
    assert t.groupBy("grp", "period").count().where("count > 5").count() == 0


def _features(spark):
    recs = [
        ("s1", "A", "1", 5, 10, 3), ("s2", "A", "1", 5, 10, 3), ("s3", "B", "2", 9, 1, 1),
        ("s4", None, None, 1, 1, 1), ("s5", None, None, 2, 2, 2),
    ]
    data = []
    for nbr, singer, sid, s1, s7, s30 in recs:
        row = {n: None for n in schemas.SONG_FEATURES.names}
        row.update(nbr=nbr, name="n" + nbr, singer1=singer, singer1id=sid, mac_time=0, singcnt=s1, suppcnt=0,
                   usercnt=1, orderidcnt=1, sing7cnt=s7, supp7cnt=0, user7cnt=1, orderid7cnt=1, sing30cnt=s30,
                   supp30cnt=0, user30cnt=1, orderid30cnt=1, dtop7singcnt=s7, dtop7suppcnt=0,
                   dtop30singcnt=s30, dtop30suppcnt=0, data_dt="20201230")
        data.append(tuple(row[n] for n in schemas.SONG_FEATURES.names))
    return spark.createDataFrame(data, schemas.SONG_FEATURES)


def test_song_rsi_ranks_and_ties(spark):
    f = _features(spark)
    r = rsi.song_rsi(f)
    assert r.columns == schemas.SONG_RSI.names
    got = {(x["period"], x["nbr"]): x["rsi_rank"] for x in r.collect()}
    assert got[("1", "s3")] == 1
    assert got[("7", "s1")] == 1 and got[("7", "s2")] == 2          # tie broken by id
    assert rows(rsi.song_rsi_top(f, 2)) == rows(r.where("rsi_rank <= 2"))
    assert rows(rsi.top_n(r, 2)) == rows(r.where("rsi_rank <= 2"))


def test_singer_rollup_and_rank(spark):
    f = _features(spark)
    roll = {(x["singer1id"], x["singer1"]): x for x in rsi.singer_rollup(f).collect()}
    assert roll[("1", "A")]["sing_cnt"] == 10 and roll[("1", "A")]["rct_7_sing_cnt"] == 20
    assert roll[(None, None)]["sing_cnt"] == 3                      # NULL singer is its own group
    r = rsi.singer_rsi(f)
    assert r.columns == schemas.SINGER_RSI.names
    assert r.count() == 3 * 3
    assert rows(rsi.singer_rsi_top(f, 1)) == rows(r.where("rsi_rank <= 1"))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_two_million_rows_in_three_groups(spark, adaptive):
    """A hot tie, an extra column, no group in one task: the same ranks as a window, row for row."""
    df = spark.range(2_000_000).select(
        (F.col("id") % 3).cast("string").alias("period"), F.lit("20201230").alias("data_dt"),
        F.concat(F.lit("s"), F.col("id")).alias("nbr"), F.concat(F.lit("n"), F.col("id") % 7).alias("name"),
        F.when(F.col("id") % 10 < 4, 1.5).otherwise(F.xxhash64("id") % 1000 / 10).alias("rsi"))
    order = rsi._song_order()
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = row_number(df, ["data_dt", "period"], order, "rk")
        want = row_number_window(df, ["data_dt", "period"], order, "rk").select("nbr", F.col("rk").alias("w"))
        joined = got.join(want, "nbr", "full")
        n, wrong = joined.agg(F.count(F.lit(1)), F.sum((~F.col("rk").eqNullSafe(F.col("w"))).cast("int"))).first()
        assert (n, wrong) == (2_000_000, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)


def test_repeated_dimension_key_has_fixed_ranks(spark):
    f = _features(spark)
    twice = f.union(f.withColumn("name", F.lit("other")))
    assert rows(rsi.song_rsi(twice.repartition(5))) == rows(rsi.song_rsi(twice.repartition(3)))
