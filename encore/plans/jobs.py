"""The daily warehouse jobs, wired to tables.

Each job reads its inputs by table name (or parquet path), runs the pure
DataFrame plan from ``encore.plans`` and writes its output partition with an
idempotent overwrite; publication to JDBC reads the partition just written,
so the plan is never computed twice.  Days, table names, paths and JDBC
settings are arguments -- nothing is hard-coded.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.dates import day_minus, day_range
from ..sinks import loads as L
from ..sinks import tables as W
from ..sources.tables import log_files, newest_day, read_client_log, read_day, read_range, read_table
from . import client_log, machines, rsi, songs, users


@dataclass
class Jdbc:
    """Connection settings for a publication target (supplied by the caller).

    ``max_connections`` caps concurrent writers (Spark coalesces the write to
    that many partitions), so a wide cluster does not flood the database.
    """
    url: str
    properties: dict = field(default_factory=dict)
    max_connections: int = 8

    def publish(self, df: DataFrame, table: str, mode: str) -> None:
        W.publish_jdbc(df, self.url, table, mode, self.properties, num_partitions=self.max_connections)


@dataclass
class Tables:
    """Warehouse table names (override any of them)."""
    play: str = "to_client_song_play_operate_req_d"
    song_info: str = "to_song_info_d"
    song_base: str = "tw_song_baseinfo_d"
    song_features: str = "tw_song_ftur_d"
    song_state: str = "tw_song_state_d"
    song_sketches: str = "tw_song_sketches_d"
    song_rsi: str = "tw_song_rsi_d"
    singer_rsi: str = "tw_singer_rsi_d"
    reg_alipay: str = "to_user_alipay_info_d"
    reg_wechat: str = "to_user_wechat_info_d"
    reg_qq: str = "to_user_qq_info_d"
    reg_app: str = "to_user_app_info_d"
    logins: str = "to_user_login_info_d"
    login_detail: str = "tw_user_login_d"
    mac: str = "to_ycak_mac_d"
    mac_loc: str = "to_ycak_mac_loc_d"
    mac_admin: str = "to_ycbk_mac_admin_map_d"
    mac_store_map: str = "to_ycbk_mac_store_map_d"
    store: str = "to_ycbk_store_d"
    machine_base: str = "tw_ycabk_mac_baseinfo_d"
    log_rejects: str = "to_client_log_rejects_d"
    log_counts: str = "to_client_log_counts_d"
    log_files: str = "to_client_log_files_d"


LOG_REJECTS = T.StructType([T.StructField("request_type", T.StringType()), T.StructField("payload", T.StringType()),
                            schemas.DATA_DT])
LOG_COUNTS = T.StructType([T.StructField("metric", T.StringType()), T.StructField("request_type", T.StringType()),
                           T.StructField("n", T.LongType()), schemas.DATA_DT])


def create_warehouse(spark: SparkSession, t: Tables = Tables(), location: str | None = None) -> None:
    """Create every output table if absent (parquet, day-partitioned)."""
    def loc(name):
        return f"{location}/{name}" if location else None
    W.create_table(spark, t.play, schemas.SONG_PLAY, location=loc(t.play))
    W.create_table(spark, t.log_rejects, LOG_REJECTS, location=loc(t.log_rejects))
    W.create_table(spark, t.log_counts, LOG_COUNTS, location=loc(t.log_counts))
    W.create_table(spark, t.song_base, schemas.SONG_BASE, partition_col=None, location=loc(t.song_base))
    W.create_table(spark, t.song_features, schemas.SONG_FEATURES, location=loc(t.song_features))
    W.create_table(spark, t.song_state, schemas.SONG_STATE, location=loc(t.song_state))
    W.create_table(spark, t.song_sketches, schemas.SONG_SKETCHES, location=loc(t.song_sketches))
    W.create_table(spark, t.song_rsi, schemas.SONG_RSI, location=loc(t.song_rsi))
    W.create_table(spark, t.singer_rsi, schemas.SINGER_RSI, location=loc(t.singer_rsi))
    W.create_table(spark, t.login_detail, schemas.LOGIN_DETAIL, location=loc(t.login_detail))
    machine_d = T.StructType(schemas.MACHINE_BASE.fields + [schemas.DATA_DT])
    W.create_table(spark, t.machine_base, machine_d, location=loc(t.machine_base))


def _log_counts(spark: SparkSession, counts: list[tuple]) -> DataFrame:
    return spark.createDataFrame(counts, "metric string, request_type string, n bigint")


def _read_log(spark: SparkSession, files: list[str] | str, mode: str):
    """The log's records, written once, and what was observed on the way.

    Written as they are read, a task a compressed file; what follows reads the
    written records, in as many tasks as their size needs, without a shuffle.
    """
    lines, records = Observation(), Observation()
    raw = client_log.counted_lines(read_client_log(spark, files), lines)
    return W.materialize(client_log.counted_records(client_log.parse(raw, mode), records)), lines, records


def ingest_client_log(spark: SparkSession, log_path: str, data_dt: str, routed_dir: str,
                      t: Tables = Tables(), partitions: int | None = None, append: bool = False,
                      mode: str = "reference") -> DataFrame:
    """Client log file(s) of a day -> text directories by request type, the
    song-play table's day, the rejects table's day and the counts of the load.

    The lines are parsed once; table and text both come from that, so neither
    depends on the other's format.  Lines, records by type and rejects are
    counted as they pass.  ``partitions`` spreads the records over that many
    tasks (default: as many as their size needs).  ``append`` adds the rows whatever was loaded before;
    :func:`load_client_log` takes each file in once.  Returns the day's
    rejected records.
    """
    with W.staged_folders(spark):
        parsed, lines, records = _read_log(spark, log_path, mode)
        dealt = parsed.repartition(partitions) if partitions else parsed
        W.write_by_key(client_log.route(dealt, mode), f"{routed_dir}/{data_dt}")
        plays, seen = client_log.song_play(dealt, data_dt, mode), Observation()
        rejected = W.materialize(client_log.rejects(parsed).observe(seen, F.count(F.lit(1)).alias("rejected")))
        put = W.append_partition if append else W.overwrite_partition
        put(plays, t.play, data_dt)
        put(rejected, t.log_rejects, data_dt)
        put(_log_counts(spark, client_log.load_counts(lines, records, seen)), t.log_counts, data_dt)
    return read_range(read_table(spark, t.log_rejects), data_dt, data_dt).select("request_type", "payload")


def create_loaded_log(spark: SparkSession, t: Tables = Tables(), location: str | None = None) -> None:
    """The log's tables partitioned by day and load, for :func:`load_client_log`."""
    for name, schema in ((t.log_files, L.FILES), (t.log_rejects, LOG_REJECTS), (t.log_counts, LOG_COUNTS),
                         (t.play, schemas.SONG_PLAY)):
        L.create_loaded_table(spark, name, schema, f"{location}/{name}" if location else None)


def load_client_log(spark: SparkSession, log_path: str, data_dt: str, routed_dir: str, t: Tables = Tables(),
                    mode: str = "reference") -> int:
    """Add to a day the log files under ``log_path`` that it has not yet; returns their number.

    The tables are those of :func:`create_loaded_log`.  Files, rejects, counts
    and plays of a load are committed together (:mod:`..sinks.loads`): a run
    that fails leaves nothing behind, a run repeated adds nothing.
    """
    tables = [t.log_files, t.log_rejects, t.log_counts, t.play]
    L.drop_unfinished(spark, tables, data_dt)
    with W.staged_folders(spark):
        files = W.materialize(L.new_files(log_files(spark, log_path), t.log_files, data_dt))
        paths = [r.path for r in files.select("path").collect()]  # the reader lists its files on the driver anyway
        if not paths:
            return 0
        parsed, lines, records = _read_log(spark, paths, mode)
        load = uuid.uuid4().hex
        W.write_by_key(client_log.route(parsed, mode), f"{routed_dir}/{data_dt}/load_id={load}")
        seen = Observation()
        rejected = W.materialize(client_log.rejects(parsed).observe(seen, F.count(F.lit(1)).alias("rejected")))
        L.write_load({t.log_files: files, t.log_rejects: rejected,
                      t.log_counts: _log_counts(spark, client_log.load_counts(lines, records, seen)),
                      t.play: client_log.song_play(parsed, data_dt, mode)}, data_dt, load)
    return len(paths)


def build_song_base(spark: SparkSession, t: Tables = Tables(), tz: str = "UTC", mode: str = "reference") -> None:
    W.overwrite_table(songs.base_info(read_table(spark, t.song_info), tz, mode), t.song_base)


def newest(spark: SparkSession, table: str) -> str:
    """The newest day of a day table, from the catalog's partitions."""
    day = newest_day(spark, table)
    if day is None:
        raise ValueError(f"{table} has no day yet")
    return day


def update_song_state(spark: SparkSession, data_dt: str, t: Tables = Tables(), distinct: str = "exact",
                      optrate_types: list[str] | None = None) -> None:
    """A day's state (``exact``) or sketches (``approx``) from that day's plays, replacing what was kept of it.

    To be run when a day has been loaded and again when rows for it arrive late.
    """
    plays = songs.counted_plays(read_day(read_table(spark, t.play), data_dt), optrate_types)
    if distinct == "approx":
        W.overwrite_partition(songs.sketches(plays), t.song_sketches, data_dt)
    else:
        W.overwrite_partition(songs.song_state(plays), t.song_state, data_dt)


def build_song_features(spark: SparkSession, first_day: str, last_day: str | None = None,
                        t: Tables = Tables(), peak: str = "total", source: str = "plays", inclusive: bool = True,
                        optrate_types: list[str] | None = None, mode: str = "reference") -> None:
    """Features for every day in ``[first_day, last_day]`` in one pass over the
    days ``[first_day - 30, last_day]`` of the play log (``source="plays"``),
    or of what :func:`update_song_state` keeps of them (``"state"``,
    ``"sketches"``): a day's run then merges 31 small partitions."""
    last_day = last_day or first_day
    table, merge = {"plays": (t.play, songs.features), "state": (t.song_state, songs.features_from_state),
                    "sketches": (t.song_sketches, songs.features_from_sketches)}[source]
    rows = read_range(read_table(spark, table), day_minus(first_day, 30), last_day)
    only = {"optrate_types": optrate_types} if source == "plays" else {}
    f = merge(rows, read_table(spark, t.song_base), first_day, last_day, peak=peak, mode=mode, inclusive=inclusive, **only)
    W.overwrite_days(f, t.song_features, day_range(first_day, last_day))


def build_song_rsi(spark: SparkSession, data_dt: str, t: Tables = Tables(), jdbc: Jdbc | None = None,
                   top: int = 30, jdbc_table: str = "tm_song_rsi") -> None:
    feats = read_range(read_table(spark, t.song_features), data_dt, data_dt)
    with W.staged_folders(spark):
        W.overwrite_partition(rsi.song_rsi(feats), t.song_rsi, data_dt)
    if jdbc is not None:
        written = read_range(read_table(spark, t.song_rsi), data_dt, data_dt)
        out = rsi.top_n(written, top).select(F.lit(int(data_dt)).alias("data_dt"), "period", "nbr", "name", "rsi", "rsi_rank")
        jdbc.publish(out, jdbc_table, "overwrite")


def build_singer_rsi(spark: SparkSession, data_dt: str, t: Tables = Tables(), jdbc: Jdbc | None = None,
                     top: int = 30, jdbc_table: str = "tm_singer_rsi") -> None:
    feats = read_range(read_table(spark, t.song_features), data_dt, data_dt)
    with W.staged_folders(spark):
        W.overwrite_partition(rsi.singer_rsi(feats), t.singer_rsi, data_dt)
    if jdbc is not None:
        written = read_range(read_table(spark, t.singer_rsi), data_dt, data_dt)
        out = rsi.top_n(written, top).select(F.lit(int(data_dt)).alias("data_dt"), "period", "singer1id", "singer1", "rsi", "rsi_rank")
        jdbc.publish(out, jdbc_table, "overwrite")


def build_user_login(spark: SparkSession, data_dt: str, t: Tables = Tables(), jdbc: Jdbc | None = None,
                     days: int = 7, jdbc_table: str = "tw_user_login_7_d", bounded: bool = False, inclusive: bool = True,
                     skewed: bool = False) -> None:
    regs = users.registrations({
        "alipay": read_table(spark, t.reg_alipay), "wechat": read_table(spark, t.reg_wechat),
        "qq": read_table(spark, t.reg_qq), "app": read_table(spark, t.reg_app)})
    detail = users.login_detail(read_table(spark, t.logins), regs, data_dt, skewed)
    W.overwrite_partition(detail, t.login_detail, data_dt)
    if jdbc is not None:
        single = users.single_login(read_table(spark, t.login_detail), data_dt, days, bounded, inclusive)
        jdbc.publish(single, jdbc_table, "append")


def bucket_machine_sources(spark: SparkSession, t: Tables, bucketed: Tables, buckets: int,
                           location: str | None = None) -> None:
    """The machine sources of ``t`` written by machine id into the tables of ``bucketed``.

    :func:`build_machine_base` on these joins them where they lie; only its
    last join, by store, shuffles.
    """
    for name, schema, key in (("mac", schemas.MAC, "mid"), ("mac_loc", schemas.MAC_LOC, "mid"),
                              ("mac_admin", schemas.MAC_ADMIN, "machine_num"),
                              ("mac_store_map", schemas.MAC_STORE_MAP, "machine_num")):
        table = getattr(bucketed, name)
        W.create_table(spark, table, schema, partition_col=None, bucket_by=(key, buckets),
                       location=f"{location}/{table}" if location else None)
        W.overwrite_bucketed(read_table(spark, getattr(t, name)), table, key, buckets)


def build_machine_base(spark: SparkSession, data_dt: str, t: Tables = Tables(), jdbc: Jdbc | None = None,
                       mode: str = "reference", jdbc_table: str = "tw_ycabk_mac_baseinfo_d") -> None:
    base = machines.base_info(read_table(spark, t.mac), read_table(spark, t.mac_loc),
                              read_table(spark, t.mac_admin), read_table(spark, t.mac_store_map),
                              read_table(spark, t.store), mode)
    W.overwrite_partition(base, t.machine_base, data_dt)
    if jdbc is not None:
        written = read_range(read_table(spark, t.machine_base), data_dt, data_dt).drop("data_dt")
        jdbc.publish(written, jdbc_table, "overwrite")
