"""Song dimension, features and the trailing-window operator against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from encore import schemas
from encore.operators.trailing import trailing_stats
from encore.plans import songs

D = "20201230"


def _day(offset):
    return (dt.date(2020, 12, 30) + dt.timedelta(days=offset)).strftime("%Y%m%d")


PLAY_COLS = schemas.SONG_PLAY.names


def _plays(spark, recs):
    """recs: (songid, uid, order_id, day_offset)"""
    data = [(s, "m1", "0", u, "0", "0", "0", "n", "1", o, _day(off)) for s, u, o, off in recs]
    return spark.createDataFrame(data, schemas.SONG_PLAY)


def _brute(recs, day_off, spans=(7, 30)):
    """Per song with plays on day_off: n_0, n_k, peak_k, distinct uid/order (NULL ignored)."""
    out = {}
    for s in {r[0] for r in recs if r[3] == day_off}:
        mine = [r for r in recs if r[0] == s]
        today = [r for r in mine if r[3] == day_off]
        res = {"n_0": len(today), "d_uid_0": len({r[1] for r in today if r[1] is not None}),
               "d_order_id_0": len({r[2] for r in today if r[2] is not None})}
        for k in spans:
            win = [r for r in mine if day_off - k <= r[3] <= day_off]
            res[f"n_{k}"] = len(win)
            per_day = {}
            for r in win:
                per_day[r[3]] = per_day.get(r[3], 0) + 1
            res[f"peak_{k}"] = max(per_day.values())
            res[f"d_uid_{k}"] = len({r[1] for r in win if r[1] is not None})
            res[f"d_order_id_{k}"] = len({r[2] for r in win if r[2] is not None})
        out[s] = res
    return out


EDGE = [  # song, uid, order, day offset
    ("a", "u1", "o1", 0), ("a", "u1", "o1", 0), ("a", "u2", "", 0), ("a", "0", "", -1),
    ("a", None, "o2", -6), ("a", "u3", "o3", -7), ("a", "u4", "o4", -8), ("a", "u5", "o5", -30),
    ("a", "u6", "o6", -31), ("a", "u7", "o7", 1),
    ("b", "u1", "o9", -3),                 # no play today: absent from the result
    ("c", "u1", None, 0), ("c", "u1", "o8", -29),
    (None, "u1", "o1", 0), (None, "u2", "o2", -5),
]


@pytest.mark.parametrize("single", [True, False])
def test_trailing_stats_edges(spark, single):
    df = _plays(spark, EDGE)
    lo = hi = D if single else None
    st = trailing_stats(df, "songid", "data_dt", (7, 30), ("uid", "order_id"), lo, hi)
    if not single:
        st = st.where(F.col("data_dt") == D)
    got = {r["songid"]: r.asDict() for r in st.collect()}
    exp = _brute(EDGE, 0)
    assert set(got) == set(exp)
    for s, e in exp.items():
        for k, v in e.items():
            assert got[s][k] == v, (s, k)


def test_trailing_stats_random_all_days(spark):
    rnd = random.Random(7)
    recs = [(rnd.choice(["s1", "s2", "s3", None]), rnd.choice(["u1", "u2", "0", None, "u3"]),
             rnd.choice(["o1", "o2", "", None]), -rnd.randint(0, 60)) for _ in range(600)]
    # one hot song holding a third of the rows
    recs += [("hot", rnd.choice(["u1", "u2", "0"]), "o" + str(rnd.randint(0, 50)), -rnd.randint(0, 60))
             for _ in range(300)]
    st = trailing_stats(_plays(spark, recs), "songid", "data_dt", (7, 30), ("uid", "order_id"))
    got = {(r["songid"], r["data_dt"]): r.asDict() for r in st.collect()}
    days = {r[3] for r in recs}
    n = 0
    for off in days:
        for s, e in _brute(recs, off).items():
            g = got[(s, _day(off))]
            for k, v in e.items():
                assert g[k] == v, (s, off, k)
            n += 1
    assert n == len(got)


def test_single_day_equals_many_days(spark):
    rnd = random.Random(3)
    recs = [(rnd.choice(["s1", "s2", None]), rnd.choice(["u1", "u2", None]), rnd.choice(["o1", ""]),
             -rnd.randint(0, 40)) for _ in range(300)]
    df = _plays(spark, recs)
    for off in (0, -3, -10):
        d = _day(off)
        a = trailing_stats(df, "songid", "data_dt", (7, 30), ("uid", "order_id"), d, d)
        b = trailing_stats(df, "songid", "data_dt", (7, 30), ("uid", "order_id"), d, _day(off + 5)) \
            .where(F.col("data_dt") == d)
        assert rows(a) == rows(b)


def _base(spark):
    from encore.sources.fixtures import song_info
    return songs.base_info(song_info(spark, "/root/testdata/sf0.001"))


def test_features_reference_and_intended(spark):
    base = _base(spark)
    recs = [("1", "u1", "o1", 0), ("1", "u2", "o2", -7), ("1", "u2", "o3", -20), ("1", "u2", "o3", -20),
            (None, "u1", "o1", 0), (None, "u1", "o1", -2)]
    df = _plays(spark, recs)
    ref = {r["nbr"]: r for r in songs.features(df, base, D, D).collect()}
    assert ref["1"]["singcnt"] == 1 and ref["1"]["sing7cnt"] == 2 and ref["1"]["sing30cnt"] == 4
    assert ref["1"]["user30cnt"] == 2 and ref["1"]["orderid30cnt"] == 3
    assert ref["1"]["dtop7singcnt"] == 2 and ref["1"]["dtop30singcnt"] == 4    # window totals
    assert ref["1"]["name"] is not None                                         # joined to dimension
    assert ref[None]["singcnt"] == 1 and ref[None]["sing7cnt"] == 0 and ref[None]["dtop30singcnt"] == 0
    daily = {r["nbr"]: r for r in songs.features(df, base, D, D, peak="daily", mode="intended").collect()}
    assert daily["1"]["dtop7singcnt"] == 1 and daily["1"]["dtop30singcnt"] == 2
    assert daily[None]["sing7cnt"] == 2
    assert songs.features(df, base, D, D).columns == schemas.SONG_FEATURES.names


def test_features_optrate_filter(spark):
    base = _base(spark)
    data = [("1", "m", t, "u", "0", "0", "0", "n", "1", "o", D) for t in ("0", "0", "3")]
    df = spark.createDataFrame(data, schemas.SONG_PLAY)
    all_ops = songs.features(df, base, D, D).first()
    only = songs.features(df, base, D, D, optrate_types=["0"]).first()
    assert all_ops["singcnt"] == 3 and only["singcnt"] == 2


def test_base_info_columns(spark):
    b = _base(spark)
    assert b.columns == schemas.SONG_BASE.names
    assert dict(b.dtypes)["prdct_type"] == "array<string>"
    assert dict(b.dtypes)["mac_time"] == "int"


def test_trailing_stats_property(spark):
    """Random small play logs: both plans equal brute force for every day."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    rec = st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["u1", "u2", "0", "", None]),
                    st.sampled_from(["o1", "o2", None]), st.integers(min_value=-45, max_value=0))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(rec, min_size=1, max_size=40))
    def check(recs):
        df = _plays(spark, recs)
        many = {(r["songid"], r["data_dt"]): r.asDict()
                for r in trailing_stats(df, "songid", "data_dt", (7, 30), ("uid", "order_id")).collect()}
        expected = {}
        for off in {r[3] for r in recs}:
            for s, e in _brute(recs, off).items():
                expected[(s, _day(off))] = e
        assert set(many) == set(expected)
        for k, e in expected.items():
            assert {c: many[k][c] for c in e} == e
        last = max(r[3] for r in recs)
        one = trailing_stats(df, "songid", "data_dt", (7, 30), ("uid", "order_id"), _day(last), _day(last))
        for r in one.collect():
            assert {c: r[c] for c in expected[(r["songid"], r["data_dt"])]} == expected[(r["songid"], r["data_dt"])]

    check()


def test_features_exact_windows(spark):
    base = _base(spark)
    recs = [("1", "u1", "o1", 0), ("1", "u2", "o2", -7), ("1", "u3", "o3", -30), ("1", "u4", "o4", -29)]
    df = _plays(spark, recs)
    ref = songs.features(df, base, D, D).first()
    exact = songs.features(df, base, D, D, inclusive=False).first()
    assert (ref["sing7cnt"], ref["sing30cnt"]) == (2, 4)
    assert (exact["sing7cnt"], exact["sing30cnt"], exact["user30cnt"]) == (1, 3, 3)
