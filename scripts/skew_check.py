"""Skew check: song features and ranking when one song holds a third of all plays.

Builds a skewed play log from lineitem (every third line is the same song and
anonymous user), runs the all-days features and the song ranking with the
event log on, and prints per-stage task-time balance (max task / median task)
so a stage that funnels the hot key into one task would stand out; the ranks
are compared with a plain window's.

usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from encore.operators.ranking import row_number_window  # noqa: E402
from encore.plans import rsi, songs  # noqa: E402
from encore.session import local_session  # noqa: E402
from encore.sources import fixtures as fx  # noqa: E402


def _stages(evdir):
    tasks, names = {}, {}
    for root, _, files in os.walk(evdir):
        for f in files:
            raw = open(os.path.join(root, f), "rb").read()
            if f.endswith(".zstd"):
                raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
            for line in raw.decode("utf-8", "replace").splitlines():
                if not line.startswith("{"):
                    continue
                e = json.loads(line)
                if e.get("Event") == "SparkListenerTaskEnd":
                    ti = e["Task Info"]
                    tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
                elif e.get("Event") == "SparkListenerStageCompleted":
                    names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Number of Tasks"]
    return tasks


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    evdir = tempfile.mkdtemp(prefix="encore-ev-")
    spark = local_session(cores="8", shuffle_partitions=8,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": evdir})
    plays = fx.play_log(spark, sf)
    hot = F.col("order_id").isNotNull() & (F.xxhash64("session_id", "dur_time", "data_dt") % 3 == 0)
    skewed = plays.withColumn("songid", F.when(hot, F.lit("HOT")).otherwise(F.col("songid"))) \
                  .withColumn("uid", F.when(hot, F.lit("0")).otherwise(F.col("uid")))
    share = skewed.agg(F.avg((F.col("songid") == "HOT").cast("double"))).first()[0]
    base = songs.base_info(fx.song_info(spark, sf))
    feats = songs.features(skewed, base)
    feats.write.format("noop").mode("overwrite").save()
    ranked = rsi.song_rsi(feats)
    plain = row_number_window(rsi.song_scores(feats), ["data_dt", "period"], rsi._song_order(), "rsi_rank")
    same = ranked.select(*plain.columns)
    wrong = same.exceptAll(plain).count() + plain.exceptAll(same).count()
    spark.stop()
    print(f"ranks that differ from a plain window: {wrong}")
    print(f"hot song share of plays: {share:.3f}")
    print("stage  tasks  max_ms  median_ms  max/median")
    for sid, t in sorted(_stages(evdir).items()):
        med = statistics.median(t) or 1
        print(f"{sid:5d}  {len(t):5d}  {max(t):6d}  {med:9.0f}  {max(t) / med:10.1f}")


if __name__ == "__main__":
    main()
