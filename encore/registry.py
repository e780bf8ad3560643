"""Registered queries over the driver's test tables (used by ``__spark_entry__``).

Each query builds the stand-in warehouse inputs from the test tables
(``encore.sources.fixtures``) and runs the library's job on all of it.
Results are normalised for engine-neutral comparison: integers as bigint,
doubles rounded to 6 places, arrays joined with ``|``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import machines as FM
from .functions import songs as FS
from .functions import users as FU
from . import schemas
from .functions.dates import day_minus, day_range, window_bounds
from .plans import client_log, jobs, machines, rsi, songs, users
from .sinks import tables as W
from .sources import fixtures as fx
from .sources.tables import read_day, read_range, read_table

LOG_DAY = "20240101"   # the day the raw log file belongs to


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ----------------------------------------------------------------- shared inputs
def _plays(spark, d):
    return fx.play_log(spark, d)


def _base(spark, d):
    return songs.base_info(fx.song_info(spark, d))


def _features(spark, d, peak="total"):
    return songs.features(_plays(spark, d), _base(spark, d), peak=peak)


def _parsed(spark, d, mode="reference"):
    return client_log.parse(fx.client_log_lines(spark, d), mode)


def _regs(spark, d):
    return users.registrations(fx.registrations(spark, d))


def _detail_history(spark, d, day=None):
    return users.login_detail(fx.logins(spark, d), users.registrations(fx.registrations(spark, d, gaps=True)), day)


def latest_day(df: DataFrame, col: str = "data_dt") -> str:
    """The newest day partition present ("today" for a daily job)."""
    return df.agg(F.max(col)).first()[0]


# ----------------------------------------------------------------- client log
def log_parse_gate(spark, d):
    """Raw log lines -> (request_type, payload) for six-field records."""
    return _parsed(spark, d)


def log_parse_intended(spark, d):
    """Same gate, payloads may contain '&'."""
    return _parsed(spark, d, "intended")


def log_request_routing(spark, d):
    """Routed text: song plays as tab-joined rows, other types unchanged."""
    return client_log.route(_parsed(spark, d))


def log_song_play_flatten(spark, d):
    """Song-play records as the ten-column day table ('null' for missing keys)."""
    return client_log.song_play(_parsed(spark, d), LOG_DAY)


def log_song_play_intended(spark, d):
    """Intended reading: '&' inside the payload kept, a missing key is NULL."""
    return client_log.song_play(_parsed(spark, d, "intended"), LOG_DAY, mode="intended")


def log_rejects(spark, d):
    """Song-play records whose payload is not a JSON object."""
    return client_log.rejects(_parsed(spark, d))


def log_requests_typed(spark, d):
    """Typed fields of every well-formed request that is no song play, from one VARIANT parse a line."""
    return client_log.requests(_parsed(spark, d))


def log_request_rejects(spark, d):
    """Requests other than song plays whose payload is malformed."""
    return client_log.request_rejects(_parsed(spark, d))


# ----------------------------------------------------------------- songs
def song_album_name(spark, d):
    """Album cleaning of every raw song."""
    s = fx.song_info(spark, d)
    return s.select("nbr", FS.album_name(F.col("album")).alias("album"))


def song_singer_info(spark, d):
    """First and second singer name/id of every raw song."""
    s = fx.song_info(spark, d)
    si = F.col("singer_info")
    return s.select("nbr", FS.singer_info(si, 1, "name").alias("singer1"),
                    FS.singer_info(si, 1, "id").alias("singer1id"),
                    FS.singer_info(si, 2, "name").alias("singer2"),
                    FS.singer_info(si, 2, "id").alias("singer2id"))


def song_post_time(spark, d):
    """Post time normalisation of every raw song (UTC)."""
    s = fx.song_info(spark, d)
    return s.select("nbr", FS.post_time(F.col("post_time"), "UTC").alias("post_time"))


def song_auth_company(spark, d):
    """Licensing company, warehouse and intended readings."""
    s = fx.song_info(spark, d)
    return s.select("nbr", FS.auth_company(F.col("auth_co")).alias("auth_co"),
                    FS.auth_company(F.col("auth_co"), "intended").alias("auth_co_intended"))


def song_product_types(spark, d):
    """Product types stripped of brackets, and as an array."""
    s = fx.song_info(spark, d)
    pt = FS.product_types(F.col("prdct_type"))
    return s.select("nbr", pt.alias("product_types"), FS.product_type_array(pt).alias("prdct_type"))


def song_name_length(spark, d):
    """Character length of every raw song name."""
    s = fx.song_info(spark, d)
    return s.select("nbr", FS.text_length(F.col("name")).alias("name_len"))


def song_base_info(spark, d):
    """The 43-column song dimension."""
    return _base(spark, d)


def song_counts_one_pass(spark, d):
    """Trailing 1/8/31-day counts, peaks and distinct users/orders for every song and day."""
    from .operators.trailing import trailing_stats
    return trailing_stats(_plays(spark, d), "songid", "data_dt", (7, 30), ("uid", "order_id"))


def song_features(spark, d):
    """Song features for every day with plays, joined to the song dimension."""
    return _features(spark, d)


def song_features_daily(spark, d):
    """The daily job's own shape: features of the newest day (single-day plan,
    reading that day's 31-day window of the play log)."""
    plays = _plays(spark, d)
    day = latest_day(plays)
    return songs.features(plays, _base(spark, d), day, day)


def song_peak_daily(spark, d):
    """Intended reading: daily peaks and real counts for a NULL song id."""
    f = songs.features(_plays(spark, d), _base(spark, d), peak="daily", mode="intended")
    return f.select("nbr", "data_dt", "singcnt", "sing7cnt", "sing30cnt", "dtop7singcnt", "dtop30singcnt")


def song_features_play_ops(spark, d):
    """Features counting only song requests (operation type 0)."""
    return songs.features(_plays(spark, d), _base(spark, d), optrate_types=["0"])


def song_features_incremental(spark, d):
    """Features merged from kept daily state: 34 days are loaded, but one lacks its song requests; when these arrive
    only that day's state is computed anew, and the days from it on are merged again."""
    plays, last = _plays(spark, d).where(F.col("data_dt").isNotNull()), latest_day(_plays(spark, d))
    (play, play_path), (state, state_path), (base, base_path), (feats, feats_path) = (_scratch(spark) for _ in range(4))
    t = jobs.Tables(play=play, song_state=state, song_base=base, song_features=feats)
    for name, schema, path in ((play, schemas.SONG_PLAY, play_path), (state, schemas.SONG_STATE, state_path),
                               (feats, schemas.SONG_FEATURES, feats_path)):
        W.create_table(spark, name, schema, location=path)
    W.create_table(spark, base, schemas.SONG_BASE, partition_col=None, location=base_path)
    W.overwrite_table(_base(spark, d), base)
    late = day_minus(last, 3)
    days = day_range(day_minus(late, 30), last)
    in_time = plays.where((F.col("data_dt") != late) | (F.col("optrate_type") != "0"))
    W.overwrite_days(in_time.where(F.col("data_dt").between(days[0], last)), play, days)
    W.overwrite_days(songs.song_state(spark.table(play)), state, days)
    jobs.build_song_features(spark, late, last, t, source="state")
    W.append_partition(plays.where((F.col("data_dt") == late) & (F.col("optrate_type") == "0")), play, late)
    jobs.update_song_state(spark, late, t)
    jobs.build_song_features(spark, late, last, t, source="state")
    return spark.table(feats)


def song_features_approx(spark, d):
    """Distinct users and orders from merged sketches, each against the exact count: within 5 % (three standard
    errors of a sketch of 4,096 registers), or one where that is less."""
    keys = ["nbr", "data_dt"]
    exact = _features(spark, d)
    approx = songs.features(_plays(spark, d), _base(spark, d), distinct="approx")
    counts = [f"{c}{w}cnt" for w in ("", "7", "30") for c in ("user", "orderid")]
    plain = [c for c in exact.columns if c not in counts and c not in keys]
    both = exact.join(approx.select(*[F.col(c).alias(f"a_{c}") for c in [*keys, *plain, *counts]]),
                      F.col("nbr").eqNullSafe(F.col("a_nbr")) & (F.col("data_dt") == F.col("a_data_dt")))
    near = [(F.abs(F.col(f"a_{c}") - F.col(c)) <= F.greatest(F.lit(1), 0.05 * F.col(c))).alias(f"{c}_near") for c in counts]
    same = [F.col(f"a_{c}").eqNullSafe(F.col(c)) for c in plain]
    alike = same[0]
    for x in same[1:]:
        alike = alike & x
    return both.select(*keys, "singcnt", "sing30cnt", alike.alias("rest_equal"), *near)


def song_rsi(spark, d):
    """Song RSI ranked per day and period (all songs)."""
    return rsi.song_rsi(_features(spark, d))


def song_rsi_top30(spark, d):
    """Top 30 songs per day and period."""
    return rsi.song_rsi_top(_features(spark, d), 30)


def singer_rollup(spark, d):
    """Song measures summed per day and first singer."""
    return rsi.singer_rollup(_features(spark, d))


def singer_rsi(spark, d):
    """Singer RSI ranked per day and period."""
    return rsi.singer_rsi(_features(spark, d))


def singer_rsi_top30(spark, d):
    """Top 30 singers per day and period."""
    return rsi.singer_rsi_top(_features(spark, d), 30)


# ----------------------------------------------------------------- users
def user_registrations_union(spark, d):
    """The four registration channels in one layout."""
    return _regs(spark, d)


def user_login_detail(spark, d):
    """Every login with its registrations (all days)."""
    return _detail_history(spark, d)


def user_login_skewed(spark, d):
    """Login detail where a third of the logins has one uid and a third none: the uid is dealt over tasks, the
    others never meet the shuffle."""
    regs = users.registrations(fx.registrations(spark, d, gaps=True))
    return users.login_detail(fx.logins(spark, d, skewed=True), regs, skewed=True)


def user_login_mode(spark, d):
    """Login mode of every login."""
    lg = fx.logins(spark, d)
    return lg.select("id", "mode_type", FU.login_mode(F.col("mode_type")).alias("login_mode"))


def user_score_cast(spark, d):
    """Lenient integer reading of every registration score."""
    r = _regs(spark, d)
    return r.select("uid", "reg_channel", "score", FU.score_int(F.col("score")).alias("score_int"))


def user_single_login(spark, d):
    """Whole history of users with exactly one login in the 8 days up to the newest day."""
    hist = _detail_history(spark, d)
    return users.single_login(hist, latest_day(fx.logins(spark, d)), days=7)


def user_single_login_bounded(spark, d):
    """Single-login users, returning only their rows inside the window."""
    hist = _detail_history(spark, d)
    return users.single_login(hist, latest_day(fx.logins(spark, d)), days=7, bounded=True)


# ----------------------------------------------------------------- machines
def _m(spark, d, gaps=False):
    return fx.machine_sources(spark, d, gaps)


def machine_id_universe(spark, d):
    """Distinct machine ids of the three machine sources."""
    m = _m(spark, d, gaps=True)
    return machines.id_universe(m["mac"], m["loc"], m["admin"])


def machine_location_repair(spark, d):
    """Location rows repaired as the warehouse does (half-'null' rows twice)."""
    return machines.repair_locations(_m(spark, d)["loc"])


def machine_location_repair_intended(spark, d):
    """Location rows, repaired rows winning (one each)."""
    return machines.repair_locations(_m(spark, d)["loc"], mode="intended")


def machine_province_city(spark, d):
    """Province and city of every location address."""
    loc = _m(spark, d)["loc"]
    return loc.select("mid", FM.province(F.col("address")).alias("province"),
                      FM.city(F.col("address"), F.col("real_address")).alias("city"))


def machine_compact_time(spark, d):
    """Compact revenue/sale times of every location."""
    loc = _m(spark, d)["loc"]
    return loc.select("mid", FM.compact_time(F.col("revenue_time")).alias("revenue_time"),
                      FM.compact_time(F.col("sale_time")).alias("sale_time"))


def machine_base_info_intended(spark, d):
    """Machine dimension built on the intended location repair."""
    m = _m(spark, d, gaps=True)
    return machines.base_info(m["mac"], m["loc"], m["admin"], m["store_map"], m["store"], mode="intended")


def machine_mac_loc_join(spark, d):
    """Id universe x repaired locations x machine info (24 columns)."""
    m = _m(spark, d, gaps=True)
    universe = machines.id_universe(m["mac"], m["loc"], m["admin"])
    return machines.mac_with_location(machines.repair_locations(m["loc"]), m["mac"], universe)


def machine_product_name(spark, d):
    """Product name of every admin row."""
    adm = _m(spark, d)["admin"]
    return adm.select("machine_num", "product_type",
                      FM.product_name(F.col("product_type")).alias("product_name"))


def machine_base_info(spark, d):
    """The 30-column machine dimension."""
    m = _m(spark, d, gaps=True)
    return machines.base_info(m["mac"], m["loc"], m["admin"], m["store_map"], m["store"])


def machine_base_info_bucketed(spark, d):
    """The machine dimension from sources bucketed by machine id: only the store join shuffles."""
    m, (suffix, path) = _m(spark, d, gaps=True), _scratch(spark)
    raw = jobs.Tables(**{f: f"{suffix}_raw_{f}" for f in ("mac", "mac_loc", "mac_admin", "mac_store_map")})
    own = jobs.Tables(**{f: f"{suffix}_{f}" for f in ("mac", "mac_loc", "mac_admin", "mac_store_map")})
    for field, source in (("mac", "mac"), ("mac_loc", "loc"), ("mac_admin", "admin"), ("mac_store_map", "store_map")):
        m[source].createOrReplaceTempView(getattr(raw, field))
    jobs.bucket_machine_sources(spark, raw, own, buckets=8, location=path)
    return machines.base_info(spark.table(own.mac), spark.table(own.mac_loc), spark.table(own.mac_admin),
                              spark.table(own.mac_store_map), m["store"])


# ----------------------------------------------------------------- sources and sinks
def _scratch(spark):
    """A new table name and folder for a round trip through the catalog."""
    path = W.stage_path(spark)
    return "encore_" + path.rpartition("-")[2], path


def song_rsi_one_day(spark, d):
    """Song RSI of the newest day, its features read as one day partition (SRC3, FLT3)."""
    plays = _plays(spark, d)
    day = latest_day(plays)
    feats = songs.features(plays, _base(spark, d), day, day)
    return rsi.song_rsi(read_day(feats, day))


def user_login_detail_one_day(spark, d):
    """Login detail of the newest day."""
    return _detail_history(spark, d, latest_day(fx.logins(spark, d)))


def sink_overwrite_day(spark, d):
    """Day overwrite of the play table (SNK2, SNK5): the three newest days are written, then the newest is replaced
    by its song requests and the one before by nothing."""
    plays, (name, path) = _plays(spark, d), _scratch(spark)
    W.create_table(spark, name, schemas.SONG_PLAY, location=path)
    last = latest_day(plays)
    for day in [day_minus(last, k) for k in range(3)]:
        W.overwrite_partition(plays.where(F.col("data_dt") == day), name, day)
    W.overwrite_partition(plays.where((F.col("data_dt") == last) & (F.col("optrate_type") == "0")), name, last)
    W.overwrite_partition(plays.where("false"), name, day_minus(last, 1))
    return spark.table(name)


def sink_overwrite_and_recover(spark, d):
    """The song dimension overwritten as a table (SNK4), features written by path and recovered as partitions (SNK6),
    read back by name (SRC2) and joined."""
    (base, base_path), (feats, feats_path) = _scratch(spark), _scratch(spark)
    W.create_table(spark, base, schemas.SONG_BASE, partition_col=None, location=base_path)
    W.overwrite_table(_base(spark, d).where("false"), base)
    W.overwrite_table(_base(spark, d), base)
    W.create_table(spark, feats, schemas.SONG_FEATURES, location=feats_path)
    W.write_partitioned(_features(spark, d), feats_path)
    W.recover_partitions(spark, feats)
    return read_table(spark, feats).join(read_table(spark, base).select("nbr", "dur"), ["nbr", "dur"]).select(
        "nbr", "dur", "singcnt", "sing7cnt", "data_dt")


def log_ingest_round_trip(spark, d):
    """Gzip log file -> text by request type, play table and rejects, all read back (SRC1, SNK1, SNK3)."""
    (play, play_path), (rej, rej_path) = _scratch(spark), _scratch(spark)
    log, routed = W.stage_path(spark), W.stage_path(spark)
    fx.client_log_lines(spark, d).write.option("compression", "gzip").text(log)
    counts, counts_path = _scratch(spark)
    t = jobs.Tables(play=play, log_rejects=rej, log_counts=counts)
    W.create_table(spark, play, schemas.SONG_PLAY, location=play_path)
    W.create_table(spark, rej, jobs.LOG_REJECTS, location=rej_path)
    W.create_table(spark, counts, jobs.LOG_COUNTS, location=counts_path)
    jobs.ingest_client_log(spark, log, LOG_DAY, routed, t)
    text = spark.read.text(f"{routed}/{LOG_DAY}")
    table = spark.table(play).where(F.col("data_dt") == LOG_DAY)
    return text.select(F.lit("text").alias("sink"), "request_type", F.col("value").alias("line")).unionByName(
        table.select(F.lit("table").alias("sink"), F.lit(fx.SONG_PLAY_TYPE).alias("request_type"), F.concat_ws(
            "\t", *[c for c in schemas.SONG_PLAY.names if c != "data_dt"]).alias("line"))).unionByName(
        spark.table(rej).select(F.lit("rejects").alias("sink"), "request_type", F.col("payload").alias("line")))


def _log_table_rows(spark, t):
    """Plays, rejects and summed counts of a log's tables as (sink, line)."""
    play = spark.table(t.play).where(F.col("data_dt") == LOG_DAY)
    counts = spark.table(t.log_counts).groupBy("metric", "request_type").agg(F.sum("n").alias("n"))
    return play.select(F.lit("table").alias("sink"), F.concat_ws(
        "\t", *[c for c in schemas.SONG_PLAY.names if c != "data_dt"]).alias("line")).unionByName(
        spark.table(t.log_rejects).select(F.lit("rejects").alias("sink"), F.col("payload").alias("line"))).unionByName(
        counts.select(F.lit("counts").alias("sink"), F.concat_ws(" ", "metric", "request_type", F.col("n").cast("string")).alias("line")))


def log_ingest_counts(spark, d):
    """Lines, dropped lines, records by type and rejects of an ingest, counted while they pass (FLT1)."""
    (play, play_path), (rej, rej_path), (counts, counts_path) = (_scratch(spark) for _ in range(3))
    log = W.stage_path(spark)
    fx.client_log_lines(spark, d).write.option("compression", "gzip").text(log)
    t = jobs.Tables(play=play, log_rejects=rej, log_counts=counts)
    for name, schema, path in ((play, schemas.SONG_PLAY, play_path), (rej, jobs.LOG_REJECTS, rej_path),
                               (counts, jobs.LOG_COUNTS, counts_path)):
        W.create_table(spark, name, schema, location=path)
    jobs.ingest_client_log(spark, log, LOG_DAY, W.stage_path(spark), t)
    return spark.table(counts).select("metric", "request_type", "n")


def log_load_once(spark, d):
    """Log files arrive in two goes, the second path naming the first files again and then all once more: each file is
    taken in once (SNK3)."""
    name, path = _scratch(spark)
    t = jobs.Tables(play=f"{name}_play", log_rejects=f"{name}_rejects", log_counts=f"{name}_counts", log_files=f"{name}_files")
    log = W.stage_path(spark)
    jobs.create_loaded_log(spark, t, path)
    lines = fx.client_log_lines(spark, d)
    half = F.pmod(F.xxhash64("value"), F.lit(3))
    routed = W.stage_path(spark)
    lines.where(half == 0).write.option("compression", "gzip").text(f"{log}/go=1")
    jobs.load_client_log(spark, f"{log}/go=1", LOG_DAY, routed, t)
    lines.where(half != 0).write.option("compression", "gzip").text(f"{log}/go=2")
    for _ in range(2):
        jobs.load_client_log(spark, [f"{log}/go=1", f"{log}/go=2"], LOG_DAY, routed, t)
    return _log_table_rows(spark, t)


def song_features_newest(spark, d):
    """Features of the newest day a play table has, found in its partitions, not its rows (SRC3)."""
    (play, play_path), (base, base_path), (feats, feats_path) = (_scratch(spark) for _ in range(3))
    t = jobs.Tables(play=play, song_base=base, song_features=feats)
    W.create_table(spark, play, schemas.SONG_PLAY, location=play_path)
    W.write_partitioned(_plays(spark, d), play_path)
    W.recover_partitions(spark, play)
    W.create_table(spark, base, schemas.SONG_BASE, partition_col=None, location=base_path)
    W.overwrite_table(_base(spark, d), base)
    W.create_table(spark, feats, schemas.SONG_FEATURES, location=feats_path)
    jobs.build_song_features(spark, jobs.newest(spark, play), None, t)
    return spark.table(feats)


def log_song_play_with_time(spark, d):
    """Song plays with the play time kept (the eleven-field row)."""
    return client_log.song_play(_parsed(spark, d), LOG_DAY, include_play_time=True)


def sql_functions(spark, d):
    """The cleaners registered as SQL functions, called from SQL over registrations, machines and songs (UDF2)."""
    from .functions import sql
    sql.register(spark)
    regs, m, song = _regs(spark, d), _m(spark, d), fx.song_info(spark, d)
    return regs.selectExpr("uid AS id", "'score' AS rule", "CAST(score_int(score) AS STRING) AS value").unionByName(
        m["loc"].selectExpr("mid AS id", "'time' AS rule", "compact_time(revenue_time) AS value")).unionByName(
        m["admin"].selectExpr("machine_num AS id", "'product' AS rule", "product_name(product_type) AS value")).unionByName(
        song.selectExpr("nbr AS id", "'types' AS rule", "product_types(prdct_type) AS value")).unionByName(
        fx.logins(spark, d).selectExpr("id", "'mode' AS rule", "login_mode(mode_type) AS value")).unionByName(
        fx.logins(spark, d).selectExpr("id", "'week before' AS rule", "day_minus(data_dt, 7) AS value")).unionByName(
        _by_rule(song, "nbr", {
            "album": "album_name(album)", "singer1": "singer_info(singer_info, 1, 'name')",
            "singer1id": "singer_info(singer_info, 1, 'id')", "singer2": "singer_info(singer_info, 2, 'name')",
            "posted": "post_time(post_time, 'UTC')", "company": "auth_company(auth_co, 'reference')",
            "company name": "auth_company(auth_co, 'intended')"})).unionByName(
        _by_rule(m["loc"], "mid", {"province": "province(address)", "city": "city(address, real_address)"}))


def _by_rule(df, key, calls):
    """(id, rule, value): one row per rule, each called from SQL."""
    named = df.selectExpr(f"{key} AS id", *[f"{call} AS `{rule}`" for rule, call in calls.items()])
    pairs = ", ".join(f"'{rule}', `{rule}`" for rule in calls)
    return named.selectExpr("id", f"stack({len(calls)}, {pairs}) AS (rule, value)")


# ----------------------------------------------------------------- misc
def date_window_filter(spark, d):
    """Plays in the 31 day partitions up to the newest day (inclusive range read)."""
    p = _plays(spark, d)
    lo, hi = window_bounds(latest_day(p), 30)
    return read_range(p, lo, hi)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        log_parse_gate, log_parse_intended, log_request_routing, log_song_play_flatten,
        log_song_play_intended, log_rejects, log_requests_typed, log_request_rejects,
        song_album_name, song_singer_info, song_post_time, song_auth_company, song_product_types,
        song_name_length, song_base_info, song_counts_one_pass, song_features, song_peak_daily,
        song_features_play_ops, song_features_daily, song_features_incremental, song_features_approx,
        song_rsi, song_rsi_top30, singer_rollup, singer_rsi, singer_rsi_top30,
        user_registrations_union, user_login_detail, user_login_skewed, user_login_mode, user_score_cast,
        user_single_login, user_single_login_bounded,
        machine_id_universe, machine_location_repair, machine_location_repair_intended,
        machine_province_city, machine_compact_time, machine_mac_loc_join, machine_product_name,
        machine_base_info, machine_base_info_intended, machine_base_info_bucketed,
        date_window_filter, song_rsi_one_day, user_login_detail_one_day, sink_overwrite_day,
        sink_overwrite_and_recover, log_ingest_round_trip, log_ingest_counts, log_load_once, song_features_newest,
        log_song_play_with_time, sql_functions,
    ]
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda f: lambda spark, d: normalise(f(spark, d)))(f) for name, f in QUERIES.items()}
