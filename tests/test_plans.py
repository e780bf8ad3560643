"""Plan-shape guards for scale: no row-at-a-time Python, no cross joins, top-n
limited before the shuffle, one JSON parse per line, bounded shuffle count."""

import re

import pytest

from conftest import SF_SMALL
from encore import registry
from encore.plans import rsi


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(q(spark, SF_SMALL)) for name, q in registry.queries().items()}


def test_no_python_udf_or_cross_join(plans):
    for name, p in plans.items():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_top_n_limits_before_shuffle(plans):
    for name in ("song_rsi_top30", "singer_rsi_top30"):
        assert plans[name].count("WindowGroupLimit") >= 2, name


def test_one_json_parse_per_line(plans):
    for name in ("log_song_play_flatten", "log_request_routing", "log_rejects"):
        assert plans[name].count("from_json(") == 1, name
        assert plans[name].count("split(") == 1, name


def test_features_shuffle_count(plans):
    keyed = re.findall(r"Exchange (hashpartitioning|rangepartitioning)", plans["song_features"])
    # daily state, neighbouring days of a value, (song, day) points, per-song window; the dimension
    assert len(keyed) == 5
    assert "ObjectHashAggregate" not in plans["song_features"] and "collect_set" not in plans["song_features"]


def test_scans_read_only_used_columns(plans):
    # the play log needs 5 of lineitem's 11 columns
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet", plans["song_features"])
    assert scans and all(len(cols.split(",")) == 5 for cols in scans)


def test_features_join_reuses_song_partitioning(spark):
    """Without broadcast, only the dimension is shuffled for the join."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        p = _plan(registry.queries()["song_features"](spark, SF_SMALL))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in p
    assert len(re.findall(r"Exchange hashpartitioning\(nbr#", p)) == 1


def test_groups_are_not_ranked_in_one_window(spark):
    feats = registry.QUERIES["song_features"](spark, SF_SMALL)
    p = _plan(rsi.song_rsi(feats))
    assert "row_number()" not in p and "encore-stage-" in p     # numbered by the sort, counts from the written rows


def test_static_sizes_never_broadcast(plans):
    assert "BroadcastHashJoin" not in plans["song_features"]


def test_one_day_prunes_partitions(spark):
    """Both bounds of a day's window reach a day-partitioned table's scan."""
    from encore.operators.trailing import trailing_stats
    from encore.sinks import tables as W
    path = W.stage_path(spark)
    registry._plays(spark, SF_SMALL).write.partitionBy("data_dt").parquet(path)
    plays = spark.read.schema("songid string, uid string, order_id string, data_dt string").parquet(path)
    for first, last in (("19950215", "19950215"), ("19950210", "19950215")):
        p = _plan(trailing_stats(plays, "songid", "data_dt", (7, 30), ("uid",), first, last))
        parts = re.findall(r"PartitionFilters: \[([^\]]*)\]", p)
        assert parts and all(">= 199501" in x and f"<= {last}" in x for x in parts)
