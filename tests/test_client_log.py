"""Client log parsing, routing, flattening; gzip / tar.gz sources; key-multiplexed output."""

import gzip
import io
import os
import tarfile
import tempfile

from conftest import rows
from encore import schemas
from encore.plans import client_log as CL
from encore.sinks.tables import write_by_key
from encore.sources.tables import read_client_log

SONG = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
GOOD = ('{"songid": "lx7", "mid": 41, "optrate_type": 0, "uid": 0, "consume_type": 0, '
        '"play_time": 0, "dur_time": 0, "session_id": 905, "songname": "海上月", "pkg_id": 100, "order_id": ""}')
OTHER = '{"package": 12, "state": "open", "minutes": 30, "mid": 41}'
MISSING = '{"songid": "x1", "mid": 1}'
LINES = [
    f"1600000002&41&{SONG}&{GOOD}&6.2.0.8&4.7.1.2",                     # good song play
    f"1600000002&41&MINIK_CLIENT_REPORT_PKG_USE_STATUS&{OTHER}&6.2.0.8&4.7.1.2",
    f"1600000002&41&{SONG}&{GOOD}&6.2.0.8",                               # 5 fields
    f"1600000002&41&{SONG}&{GOOD.replace('海上月', 'a&b')}&6.2.0.8&4.7.1.2",  # & inside: 7
    f"1600000002&41&{SONG}&{GOOD}&6.2.0.8&",                              # trailing & after 5: 5
    f"1600000002&41&{SONG}&{MISSING}&6.2.0.8&4.7.1.2&",                  # trailing & after 6: kept
    f"1600000002&41&{SONG}&&6.2.0.8&4.7.1.2",                            # empty payload
    f"1600000002&41&{SONG}&{{\"songid\": &6.2.0.8&4.7.1.2",              # malformed
    "\x00\x00\x00",                                                           # NUL padding
]


def _lines(spark, lines=LINES):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_gate(spark):
    p = CL.parse(_lines(spark))
    assert p.count() == 5
    assert {r[0] for r in p.collect()} == {SONG, "MINIK_CLIENT_REPORT_PKG_USE_STATUS"}
    q = CL.parse(_lines(spark), mode="intended")
    assert q.count() == 6          # the record with '&' in the payload survives
    assert any("a&b" in r[1] for r in q.collect())


def test_song_play_flatten_and_rejects(spark):
    p = CL.parse(_lines(spark))
    t = CL.song_play(p, "20201230")
    assert t.columns == schemas.SONG_PLAY.names
    got = rows(t, "songid", "mid", "uid", "order_id", "pkg_id", "songname")
    assert got == [("lx7", "41", "0", "", "100", "海上月"), ("x1", "1", "null", "null", "null", "null")]
    intended = {r["songid"]: r for r in CL.song_play(p, "20201230", mode="intended").collect()}
    assert intended["x1"]["uid"] is None
    rej = CL.rejects(p).collect()
    assert len(rej) == 2 and {r["payload"] for r in rej} == {"", '{"songid": '}
    with_pt = CL.song_play(p, "20201230", include_play_time=True)
    assert "play_time" in with_pt.columns and len(with_pt.columns) == 12


def test_route(spark):
    r = {x["request_type"]: x["line"] for x in CL.route(CL.parse(_lines(spark, LINES[:2]))).collect()}
    assert r[SONG] == "lx7\t41\t0\t0\t0\t0\t905\t海上月\t100\t"
    assert r["MINIK_CLIENT_REPORT_PKG_USE_STATUS"] == OTHER


def test_gzip_and_tar_sources(spark):
    tmp = tempfile.mkdtemp(prefix="encore-log-")
    body = ("\n".join(LINES[:2] + LINES[5:6]) + "\n").encode()
    gz = os.path.join(tmp, "day.log.gz")
    with gzip.open(gz, "wb") as f:
        f.write(body)
    tgz = os.path.join(tmp, "currentday_clientlog.tar.gz")
    with tarfile.open(tgz, "w:gz") as tf:
        for i in range(2):
            info = tarfile.TarInfo(f"part{i}.log")
            info.size = len(body)
            tf.addfile(info, io.BytesIO(body))
    want = rows(CL.parse(_lines(spark, LINES[:2] + LINES[5:6])))
    assert rows(CL.parse(read_client_log(spark, gz))) == want
    got_tar = rows(CL.parse(read_client_log(spark, tgz), partitions=4))
    assert got_tar == sorted(want * 2, key=repr)


def test_write_by_key(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="encore-route-"), "all_client_tables")
    routed = CL.route(CL.parse(_lines(spark))).repartition(3)
    write_by_key(routed, out)
    dirs = sorted(d for d in os.listdir(out) if d.startswith("request_type="))
    assert dirs == ["request_type=MINIK_CLIENT_REPORT_PKG_USE_STATUS", f"request_type={SONG}"]
    back = spark.read.text(os.path.join(out, f"request_type={SONG}"))
    assert back.count() == 2 and "request_type" not in back.columns


def test_route_intended_keeps_columns_aligned(spark):
    p = CL.parse(_lines(spark, [LINES[5]]), mode="intended")
    line = CL.route(p, mode="intended").first()["line"]
    assert line.split("\t") == ["x1", "1", "", "", "", "", "", "", "", ""]
    ref = CL.route(CL.parse(_lines(spark, [LINES[5]]))).first()["line"]
    assert ref.split("\t") == ["x1", "1"] + ["null"] * 8


def test_ingest_keeps_tabs_rejects_and_days_without_plays(spark):
    import uuid

    from encore.plans import jobs
    sfx, wh = uuid.uuid4().hex[:6], tempfile.mkdtemp(prefix="encore-wh-")
    t = jobs.Tables(**{f: f"{getattr(jobs.Tables(), f)}_{sfx}" for f in jobs.Tables.__dataclass_fields__})
    jobs.create_warehouse(spark, t, wh)
    tabbed = GOOD.replace("海上月", "a\\tb\\nc")
    lines = [*LINES, f"1600000002&41&{SONG}&{tabbed}&6.2.0.8&4.7.1.2"]
    path = os.path.join(tempfile.mkdtemp(prefix="encore-log-"), "log.gz")
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    routed = tempfile.mkdtemp(prefix="encore-routed-")
    rej = jobs.ingest_client_log(spark, path, "20201230", routed, t, mode="intended")
    plays = {(r.songid, r.songname, r.pkg_id) for r in spark.table(t.play).collect()}
    assert ("lx7", "a\tb\nc", "100") in plays and ("x1", None, None) in plays      # kept whole; a missing key is NULL
    text = [r.value for r in spark.read.text(f"{routed}/20201230/request_type={SONG}").collect()]
    assert len(text) == spark.table(t.play).count() and all(x.count("\t") == 9 for x in text)
    assert rej.count() == spark.table(t.log_rejects).count() == 2
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(LINES[1] + "\n")                                                   # a day without song plays
    jobs.ingest_client_log(spark, path, "20201230", routed, t)
    assert spark.table(t.play).count() == 0 and spark.table(t.log_rejects).count() == 0

