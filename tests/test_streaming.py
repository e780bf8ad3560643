"""File-stream ingest: each landed file is processed once, across runs."""

import gzip
import os
import tempfile

from conftest import rows
from encore import schemas
from encore.plans import client_log as CL
from encore.streaming.client_log import start_rejects_stream, start_routed_stream, start_song_play_stream
from test_client_log import LINES


def _land(d, day, name, lines):
    p = os.path.join(d, f"data_dt={day}")
    os.makedirs(p, exist_ok=True)
    with gzip.open(os.path.join(p, name), "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_song_play_stream_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="encore-stream-")
    landing, table, routed = (os.path.join(base, x) for x in ("landing", "table", "routed"))
    ckpt, ckpt2 = os.path.join(base, "ckpt"), os.path.join(base, "ckpt2")
    _land(landing, "20201230", "a.gz", LINES)
    q = start_song_play_stream(spark, landing, table, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(table).count() == 2
    _land(landing, "20201231", "b.gz", LINES[:1])
    q = start_song_play_stream(spark, landing, table, ckpt)     # restart from the checkpoint
    q.awaitTermination()
    out = spark.read.schema(schemas.SONG_PLAY).parquet(table)     # day stays a string
    assert {r[0]: r[1] for r in out.groupBy("data_dt").count().collect()} == {"20201230": 2, "20201231": 1}
    batch = CL.song_play(CL.parse(spark.createDataFrame([(x,) for x in LINES], "value string")), "20201230")
    assert rows(out.where("data_dt = '20201230'").select(*batch.columns)) == rows(batch)
    r = start_routed_stream(spark, landing, routed, ckpt2)
    r.awaitTermination()
    assert sorted(os.listdir(os.path.join(routed, "data_dt=20201230"))) == [
        "request_type=MINIK_CLIENT_REPORT_PKG_USE_STATUS", "request_type=MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"]
    j = start_rejects_stream(spark, landing, os.path.join(base, "rejects"), os.path.join(base, "ckpt3"))
    j.awaitTermination()
    bad = CL.rejects(CL.parse(spark.createDataFrame([(x,) for x in LINES], "value string")))
    assert spark.read.parquet(os.path.join(base, "rejects")).count() == bad.count() > 0
