"""Command line for the daily jobs, for ``spark-submit`` or ``python -m encore``.

    spark-submit --py-files encore.zip -m encore song-features --day 20201230
    python -m encore song-rsi --day 20201230 --jdbc-url jdbc:... --jdbc-driver ...

Table names default to the warehouse names (``jobs.Tables``); ``--database``
qualifies them.  The session (master, memory, ``spark.checkpoint.dir``) comes
from spark-submit / spark-defaults; ``--input-bytes`` applies
``session.cluster_conf`` sizing to the SQL settings of this run.
"""

from __future__ import annotations

import argparse
import dataclasses
import os

from pyspark.sql import SparkSession

from .plans import jobs
from .session import cluster_conf

COMMANDS = ["create-warehouse", "client-log", "song-base", "song-features", "song-rsi", "singer-rsi",
            "user-login", "machine-base", "create-log", "load-log", "song-state"]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="encore", description="karaoke warehouse daily jobs")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--day", help="yyyyMMdd day to build (first day of a range with --to), or 'newest': the newest "
                                 "partition of the command's input table")
    p.add_argument("--to", help="last day of a range (song-features)")
    p.add_argument("--database", help="database qualifying every table name")
    p.add_argument("--location", help="root folder for create-warehouse")
    p.add_argument("--log-path", help="client log file(s) (client-log)")
    p.add_argument("--routed-dir", help="output folder of routed log text (client-log)")
    p.add_argument("--mode", default="reference", choices=["reference", "intended"])
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-user", default=os.environ.get("ENCORE_JDBC_USER"))
    p.add_argument("--jdbc-password", default=os.environ.get("ENCORE_JDBC_PASSWORD"))
    p.add_argument("--tz", default="UTC", help="time zone of post times (song-base)")
    p.add_argument("--peak", default="total", choices=["total", "daily"], help="window peak (song-features)")
    p.add_argument("--append", action="store_true", help="add to the day instead of replacing it (client-log)")
    p.add_argument("--exact-windows", action="store_true", help="windows of 7 and 30 days, not 8 and 31 (song-features, user-login)")
    p.add_argument("--optrate-types", nargs="+", help="operation types that count as plays (song-features, song-state)")
    p.add_argument("--bounded", action="store_true", help="single-login users: their rows inside the window only (user-login)")
    p.add_argument("--skewed", action="store_true", help="deal hot user ids over tasks (user-login)")
    p.add_argument("--source", default="plays", choices=["plays", "state", "sketches"],
                   help="what features are merged from (song-features)")
    p.add_argument("--distinct", default="exact", choices=["exact", "approx"], help="kind of state kept (song-state)")
    p.add_argument("--input-bytes", type=int, help="bytes the job reads; sizes shuffle partitions")
    p.add_argument("--executors", type=int, default=1000, help="executors of the cluster (with --input-bytes)")
    p.add_argument("--cores", type=int, default=4, help="cores of an executor (with --input-bytes)")
    return p


#: Switches and the commands they act on; elsewhere they are refused.
SWITCHES = {"mode": ("client-log", "load-log", "song-base", "song-features", "machine-base"),
            "exact_windows": ("song-features", "user-login"), "optrate_types": ("song-features", "song-state"),
            "bounded": ("user-login",), "skewed": ("user-login",), "source": ("song-features",), "distinct": ("song-state",),
            "tz": ("song-base",), "peak": ("song-features",),
            "append": ("client-log",), "to": ("song-features",)}


#: Tables whose newest partition ``--day newest`` stands for.
INPUTS = {"song-features": "play", "song-state": "play", "song-rsi": "song_features", "singer-rsi": "song_features",
          "user-login": "logins"}


def _refuse_idle(parser: argparse.ArgumentParser, a) -> None:
    for name, commands in SWITCHES.items():
        if getattr(a, name) != parser.get_default(name) and a.command not in commands:
            parser.error(f"--{name.replace('_', '-')} has no effect on {a.command}")
    if a.day == "newest" and a.command not in INPUTS:
        parser.error(f"--day newest has no meaning for {a.command}")


def _tables(database: str | None) -> jobs.Tables:
    t = jobs.Tables()
    if not database:
        return t
    return jobs.Tables(**{f.name: f"{database}.{getattr(t, f.name)}" for f in dataclasses.fields(t)})


def _jdbc(a) -> jobs.Jdbc | None:
    if not a.jdbc_url:
        return None
    props = {k: v for k, v in (("driver", a.jdbc_driver), ("user", a.jdbc_user),
                               ("password", a.jdbc_password)) if v}
    return jobs.Jdbc(a.jdbc_url, props)


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    a = parser.parse_args(argv)
    _refuse_idle(parser, a)
    spark = SparkSession.builder.appName(f"encore-{a.command}").getOrCreate()
    if a.input_bytes:
        for k, v in cluster_conf(a.input_bytes, a.executors, a.cores).items():
            spark.conf.set(k, v)
    t, db = _tables(a.database), _jdbc(a)
    if a.day == "newest":
        a.day = jobs.newest(spark, getattr(t, INPUTS[a.command]))
    if a.command == "create-warehouse":
        jobs.create_warehouse(spark, t, a.location)
    elif a.command == "client-log":
        jobs.ingest_client_log(spark, a.log_path, a.day, a.routed_dir, t, append=a.append, mode=a.mode)
    elif a.command == "song-base":
        jobs.build_song_base(spark, t, a.tz, a.mode)
    elif a.command == "create-log":
        jobs.create_loaded_log(spark, t, a.location)
    elif a.command == "load-log":
        jobs.load_client_log(spark, a.log_path, a.day, a.routed_dir, t, mode=a.mode)
    elif a.command == "song-state":
        jobs.update_song_state(spark, a.day, t, a.distinct, a.optrate_types)
    elif a.command == "song-features":
        jobs.build_song_features(spark, a.day, a.to, t, peak=a.peak, source=a.source, inclusive=not a.exact_windows,
                                 optrate_types=a.optrate_types, mode=a.mode)
    elif a.command == "song-rsi":
        jobs.build_song_rsi(spark, a.day, t, db)
    elif a.command == "singer-rsi":
        jobs.build_singer_rsi(spark, a.day, t, db)
    elif a.command == "user-login":
        jobs.build_user_login(spark, a.day, t, db, bounded=a.bounded, inclusive=not a.exact_windows, skewed=a.skewed)
    elif a.command == "machine-base":
        jobs.build_machine_base(spark, a.day, t, db, mode=a.mode)


if __name__ == "__main__":
    main()
