"""Song dimension (cleaning) and song features (1/7/30-day play statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import songs as S
from ..operators.trailing import apart_by_key, daily_state, sketch_state, trailing_from_sketches, trailing_from_state, trailing_stats


def base_info(song_info: DataFrame, tz: str = "UTC", mode: str = "reference") -> DataFrame:
    """Clean the raw song table into the 43-column song dimension.

    Album, singers (first two of the singer JSON), post time, licensing
    company and product types are normalised with native Column expressions;
    the name falls back to the other name; ``mac_time`` is 0.
    """
    c = F.col
    cleaned = {
        "nbr": c("nbr"),
        "name": F.coalesce(c("name"), c("other_name")),
        "album": S.album_name(c("album")),
        "singer1": S.singer_info(c("singer_info"), 1, "name"),
        "singer2": S.singer_info(c("singer_info"), 2, "name"),
        "singer1id": S.singer_info(c("singer_info"), 1, "id"),
        "singer2id": S.singer_info(c("singer_info"), 2, "id"),
        "mac_time": F.lit(0),
        "post_time": S.post_time(c("post_time"), tz),
        "auth_co": S.auth_company(c("auth_co"), mode),
        "prdct_type": S.product_type_array(S.product_types(c("prdct_type"))),
    }
    return song_info.select(*[cleaned.get(n, c(n)).alias(n) for n in schemas.SONG_BASE.names])


# Feature columns, in table order (after nbr and the 12 dimension columns).
_DIM_COLS = ["name", "source", "album", "prdct", "lang", "video_format", "dur",
             "singer1", "singer1id", "singer2", "singer2id", "mac_time"]


def features(plays: DataFrame, base: DataFrame, first_day: str | None = None,
             last_day: str | None = None, peak: str = "total", mode: str = "reference",
             optrate_types: list[str] | None = None, inclusive: bool = True, distinct: str = "exact") -> DataFrame:
    """Per song and day with plays: counts, distinct users and distinct orders
    for the day, the 7-day and the 30-day windows, window peaks, joined to the
    song dimension.  One scan of the play log for every day in the range.

    * windows are ``between day-k and day`` (8 and 31 partitions);
      ``inclusive=False`` makes them exactly 7 and 30 days
    * ``peak="total"`` stores the window total as the "peak" (warehouse rule);
      ``peak="daily"`` the largest single-day count in the window
    * ``mode="reference"``: a NULL song id, which never matches a join, gets 0
      for its window columns; likes (``supp*``) are 0 as there is no like log
    * ``optrate_types`` restricts which operation types count as plays
      (default: all of them, as the warehouse does)
    * ``distinct="approx"`` estimates distinct users and orders from sketches
      of fixed size per song and day, merged over a window's days
    """
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    plays = counted_plays(plays, optrate_types)
    if distinct == "approx":
        calm, apart = (trailing_from_sketches(sketches(p), *_WINDOWED, _spans(inclusive), _DISTINCT, first_day, last_day)
                       for p in apart_by_key(plays, "songid"))
        return _features(calm.unionByName(apart), base, peak, mode, _spans(inclusive))
    stats = trailing_stats(plays, *_WINDOWED, _spans(inclusive), _DISTINCT, first_day, last_day)
    return _features(stats, base, peak, mode, _spans(inclusive))


_WINDOWED, _DISTINCT = ("songid", "data_dt"), ("uid", "order_id")


def _spans(inclusive: bool) -> tuple[int, int]:
    return (7, 30) if inclusive else (6, 29)


def counted_plays(plays: DataFrame, optrate_types: list[str] | None = None) -> DataFrame:
    """The columns of the play log that features need, of the operation types that count."""
    if optrate_types is not None:
        plays = plays.where(F.col("optrate_type").isin(list(optrate_types)))
    return plays.select("songid", "data_dt", "uid", "order_id")


def song_state(plays: DataFrame, optrate_types: list[str] | None = None) -> DataFrame:
    """Each day's part of the features (:data:`schemas.SONG_STATE`), from that day's plays alone."""
    return daily_state(counted_plays(plays, optrate_types), *_WINDOWED, _DISTINCT).select(*schemas.SONG_STATE.names)


def features_from_state(state: DataFrame, base: DataFrame, first_day: str | None = None, last_day: str | None = None,
                        peak: str = "total", mode: str = "reference", inclusive: bool = True) -> DataFrame:
    """:func:`features` merged from kept :func:`song_state` days, without reading the play log."""
    stats = trailing_from_state(state, *_WINDOWED, _spans(inclusive), _DISTINCT, first_day, last_day)
    return _features(stats, base, peak, mode, _spans(inclusive))


def sketches(plays: DataFrame) -> DataFrame:
    """Per song and day: plays, and sketches of its users and orders, of a size that does not grow with either."""
    return sketch_state(plays, *_WINDOWED, _DISTINCT)


def features_from_sketches(state: DataFrame, base: DataFrame, first_day: str | None = None, last_day: str | None = None,
                           peak: str = "total", mode: str = "reference", inclusive: bool = True) -> DataFrame:
    """:func:`features` with distinct counts estimated from kept :func:`sketches`."""
    stats = trailing_from_sketches(state, *_WINDOWED, _spans(inclusive), _DISTINCT, first_day, last_day)
    return _features(stats, base, peak, mode, _spans(inclusive))


def _features(stats: DataFrame, base: DataFrame, peak: str, mode: str, spans: tuple[int, int]) -> DataFrame:
    if peak not in ("total", "daily"):
        raise ValueError("peak must be 'total' or 'daily'")
    w7, w30 = spans
    known = F.col("songid").isNotNull() if mode == "reference" else F.lit(True)

    def windowed(col: str):
        return F.when(known, F.col(col)).otherwise(F.lit(0)).cast("bigint")

    zero = F.lit(0).cast("bigint")
    top = "n" if peak == "total" else "peak"
    feats = stats.select(
        F.col("songid").alias("nbr"), "data_dt",
        F.col("n_0").cast("bigint").alias("singcnt"), zero.alias("suppcnt"),
        F.col("d_uid_0").alias("usercnt"), F.col("d_order_id_0").alias("orderidcnt"),
        windowed(f"n_{w7}").alias("sing7cnt"), zero.alias("supp7cnt"),
        windowed(f"d_uid_{w7}").alias("user7cnt"), windowed(f"d_order_id_{w7}").alias("orderid7cnt"),
        windowed(f"n_{w30}").alias("sing30cnt"), zero.alias("supp30cnt"),
        windowed(f"d_uid_{w30}").alias("user30cnt"), windowed(f"d_order_id_{w30}").alias("orderid30cnt"),
        windowed(f"{top}_{w7}").alias("dtop7singcnt"), zero.alias("dtop7suppcnt"),
        windowed(f"{top}_{w30}").alias("dtop30singcnt"), zero.alias("dtop30suppcnt"),
    )
    # Left join to the dimension; only the 12 used columns are read.  AQE
    # picks broadcast vs. sort-merge from the real size of either side.
    dim = base.select(F.col("nbr"), *[F.col(c) for c in _DIM_COLS])
    joined = feats.join(dim, "nbr", "left")
    return joined.select(*schemas.SONG_FEATURES.names)
