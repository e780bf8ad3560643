"""Command line dispatch on a scratch database."""

import tempfile
import uuid

import pytest

from conftest import SF_SMALL
from encore.__main__ import main
from encore.sources import fixtures as fx


def test_cli_song_base_and_features(spark):
    db = f"cli_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db}")
    main(["create-warehouse", "--database", db, "--location", tempfile.mkdtemp(prefix="encore-cli-")])
    fx.song_info(spark, SF_SMALL).write.saveAsTable(f"{db}.to_song_info_d")
    fx.play_log(spark, SF_SMALL).write.mode("overwrite").insertInto(f"{db}.to_client_song_play_operate_req_d")
    main(["song-base", "--database", db])
    assert spark.table(f"{db}.tw_song_baseinfo_d").count() == spark.table(f"{db}.to_song_info_d").count()
    from encore.session import cluster_conf
    saved = {k: spark.conf.get(k, None) for k in cluster_conf(1)}
    try:
        main(["song-features", "--database", db, "--day", "19950202", "--to", "19950210",
              "--input-bytes", "1000000"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8000"
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    days = {r[0] for r in spark.table(f"{db}.tw_song_ftur_d").select("data_dt").distinct().collect()}
    assert days and all("19950202" <= d <= "19950210" for d in days)
    before = sorted(map(str, spark.table(f"{db}.tw_song_ftur_d").where("data_dt = '19950210'").collect()))
    for day in ("19950209", "19950210"):
        main(["song-state", "--database", db, "--day", day])
    assert spark.table(f"{db}.tw_song_state_d").select("data_dt").distinct().count() == 2
    main(["song-features", "--database", db, "--day", "newest", "--exact-windows", "--mode", "intended"])
    assert spark.table(f"{db}.tw_song_ftur_d").where("data_dt > '19950210'").count() > 0
    assert before == sorted(map(str, spark.table(f"{db}.tw_song_ftur_d").where("data_dt = '19950210'").collect()))
    with pytest.raises(SystemExit):
        main(["no-such-job"])


def test_cli_loads_a_log_once(spark):
    db = f"cli_log_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db}")
    main(["create-log", "--database", db, "--location", tempfile.mkdtemp(prefix="encore-cli-")])
    log = tempfile.mkdtemp(prefix="encore-cli-log-")
    fx.client_log_lines(spark, SF_SMALL).write.mode("overwrite").text(log)
    for _ in range(2):
        main(["load-log", "--database", db, "--day", "20240101", "--log-path", log, "--routed-dir", tempfile.mkdtemp()])
    lines = spark.table(f"{db}.to_client_log_counts_d").where("metric = 'lines'").collect()
    assert [r.n for r in lines] == [fx.client_log_lines(spark, SF_SMALL).count()]


def test_cli_refuses_switches_without_effect():
    for args in (["song-rsi", "--mode", "intended"], ["song-rsi", "--peak", "daily"], ["machine-base", "--append"],
                 ["song-features", "--tz", "Asia/Shanghai"], ["song-rsi", "--bounded"], ["machine-base", "--skewed"],
                 ["song-rsi", "--source", "state"], ["song-base", "--exact-windows"]):
        with pytest.raises(SystemExit):
            main([*args, "--day", "20201230"])
    with pytest.raises(SystemExit):
        main(["machine-base", "--day", "newest"])

