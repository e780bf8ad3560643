"""End-to-end: the daily jobs on a scratch warehouse built from sf0.001, JDBC to in-memory Derby."""

import gzip
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from encore.plans import jobs, rsi, songs
from encore.sources import fixtures as fx


def test_daily_jobs(spark):
    sfx = uuid.uuid4().hex[:6]
    t = jobs.Tables(**{f: f"{getattr(jobs.Tables(), f)}_{sfx}" for f in jobs.Tables.__dataclass_fields__})
    wh = tempfile.mkdtemp(prefix="encore-wh-")
    jobs.create_warehouse(spark, t, wh)
    # source tables
    fx.song_info(spark, SF_SMALL).write.saveAsTable(t.song_info)
    regs = fx.registrations(spark, SF_SMALL)
    for ch, name in [("alipay", t.reg_alipay), ("wechat", t.reg_wechat), ("qq", t.reg_qq), ("app", t.reg_app)]:
        regs[ch].write.saveAsTable(name)
    fx.logins(spark, SF_SMALL).write.partitionBy("data_dt").saveAsTable(t.logins)
    m = fx.machine_sources(spark, SF_SMALL)
    for k, name in [("mac", t.mac), ("loc", t.mac_loc), ("admin", t.mac_admin),
                    ("store_map", t.mac_store_map), ("store", t.store)]:
        m[k].write.saveAsTable(name)
    plays = fx.play_log(spark, SF_SMALL)
    plays.write.mode("overwrite").insertInto(t.play)

    # client log ingest: gzip file -> routed dirs + song-play partition
    lines = [r[0] for r in fx.client_log_lines(spark, SF_SMALL).collect()]
    logf = os.path.join(tempfile.mkdtemp(prefix="encore-log-"), "clientlog.gz")
    with gzip.open(logf, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    routed = tempfile.mkdtemp(prefix="encore-routed-")
    rej = jobs.ingest_client_log(spark, logf, "20240101", routed, t, partitions=4)
    assert rej.count() > 0
    assert spark.table(t.log_rejects).where("data_dt = '20240101'").count() == rej.count()
    n1 = spark.table(t.play).where("data_dt = '20240101'").count()
    assert n1 > 0
    jobs.ingest_client_log(spark, logf, "20240101", routed, t, partitions=4)      # re-run: same rows
    assert spark.table(t.play).where("data_dt = '20240101'").count() == n1
    assert spark.table(t.play).where("data_dt = '19950210'").count() > 0           # other days kept

    jobs.build_song_base(spark, t)
    day = "19950210"
    jobs.build_song_features(spark, "19950202", day, t)
    feats = spark.table(t.song_features)
    assert feats.select("data_dt").distinct().count() <= 9
    expect = songs.features(plays, songs.base_info(fx.song_info(spark, SF_SMALL)), "19950202", day)
    assert rows(feats.drop("data_dt"), *[c for c in expect.columns if c != "data_dt"]) == \
        rows(expect.drop("data_dt"))

    # re-run one day alone (single-day plan): same rows as the range run
    before = rows(feats.where(F.col("data_dt") == day))
    jobs.build_song_features(spark, day, None, t)
    assert rows(spark.table(t.song_features).where(F.col("data_dt") == day)) == before

    url = f"jdbc:derby:memory:jobs{sfx};create=true"
    db = jobs.Jdbc(url, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    jobs.build_song_rsi(spark, day, t, db)
    jobs.build_singer_rsi(spark, day, t, db)
    ranked = spark.table(t.song_rsi).where(F.col("data_dt") == day)
    assert rows(ranked) == rows(rsi.song_rsi(expect.where(F.col("data_dt") == day)))

    def jdbc(table):
        return spark.read.format("jdbc").option("url", url).option("dbtable", table) \
            .option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").load()
    assert jdbc("tm_song_rsi").count() == ranked.where("rsi_rank <= 30").count()
    assert jdbc("tm_singer_rsi").count() > 0

    last = spark.table(t.logins).agg(F.max("data_dt")).first()[0]
    jobs.build_user_login(spark, last, t, db)
    assert spark.table(t.login_detail).where(F.col("data_dt") == last).count() > 0
    jobs.build_machine_base(spark, "20201230", t, db)
    assert jdbc("tw_ycabk_mac_baseinfo_d").count() == spark.table(t.machine_base).count() > 0
