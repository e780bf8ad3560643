"""Song and singer influence index (RSI): score, rank per day and period, top-n.

The three periods are produced as one long table with ``stack`` (one scan,
one ranking), not as three ranked copies unioned together.  Ties are broken
by all other output columns, so every run ranks the same way, also where the
dimension repeats a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rsi as R
from ..operators.ranking import row_number, top_n as _top_n


def _long_by_period(scored: DataFrame, ids: list[str]) -> DataFrame:
    """(ids…, data_dt, rsi_1d, rsi_7d, rsi_30d) -> (period, ids…, rsi, data_dt)."""
    return scored.select(
        "data_dt", *ids,
        F.stack(F.lit(len(R.PERIODS)),
                *[x for p in R.PERIODS for x in (F.lit(str(p)), F.col(f"rsi_{p}d"))]
                ).alias("period", "rsi"))


def song_scores(features: DataFrame) -> DataFrame:
    """Per song and day: RSI for each period, in long form (period, nbr, name, rsi)."""
    c = F.col
    scored = features.select(
        "data_dt", "nbr", "name",
        R.song_rsi(1, c("singcnt"), c("suppcnt")).alias("rsi_1d"),
        R.song_rsi(7, c("sing7cnt"), c("supp7cnt"), c("dtop7singcnt"), c("dtop7suppcnt")).alias("rsi_7d"),
        R.song_rsi(30, c("sing30cnt"), c("supp30cnt"), c("dtop30singcnt"), c("dtop30suppcnt")).alias("rsi_30d"))
    return _long_by_period(scored, ["nbr", "name"])


def _song_order():
    return [F.col("rsi").desc_nulls_last(), F.col("nbr").asc_nulls_first(), F.col("name").asc_nulls_first()]


def song_rsi(features: DataFrame, data_dt: str | None = None) -> DataFrame:
    """Rank songs by RSI per day and period (``row_number``, 1 = highest)."""
    if data_dt is not None:
        features = features.where(F.col("data_dt") == F.lit(data_dt))
    ranked = row_number(song_scores(features), ["data_dt", "period"], _song_order(), "rsi_rank")
    return ranked.select(*schemas.SONG_RSI.names)


def song_rsi_top(features: DataFrame, n: int = 30, data_dt: str | None = None) -> DataFrame:
    """Top ``n`` songs per day and period, ranks equal to :func:`song_rsi`'s."""
    if data_dt is not None:
        features = features.where(F.col("data_dt") == F.lit(data_dt))
    ranked = _top_n(song_scores(features), ["data_dt", "period"], _song_order(), n, "rsi_rank")
    return ranked.select(*schemas.SONG_RSI.names)


_ROLLUP = [
    ("sing_cnt", "singcnt"), ("supp_cnt", "suppcnt"),
    ("rct_7_sing_cnt", "sing7cnt"), ("rct_7_supp_cnt", "supp7cnt"),
    ("rct_7_top_sing_cnt", "dtop7singcnt"), ("rct_7_top_supp_cnt", "dtop7suppcnt"),
    ("rct_30_sing_cnt", "sing30cnt"), ("rct_30_supp_cnt", "supp30cnt"),
    ("rct_30_top_sing_cnt", "dtop30singcnt"), ("rct_30_top_supp_cnt", "dtop30suppcnt"),
]


def singer_rollup(features: DataFrame, data_dt: str | None = None) -> DataFrame:
    """Sum the ten song measures per (day, first singer id, first singer).

    Songs without a dimension row have a NULL singer and form their own group;
    only the first singer of a duet is credited.  The aggregation is partial
    on the map side, so a dominant singer costs one row per task.
    """
    if data_dt is not None:
        features = features.where(F.col("data_dt") == F.lit(data_dt))
    return (features.groupBy("data_dt", "singer1id", "singer1")
            .agg(*[F.sum(src).cast("bigint").alias(dst) for dst, src in _ROLLUP])
            .select(*schemas.SINGER_ROLLUP.names))


def singer_scores(rollup: DataFrame) -> DataFrame:
    c = F.col
    scored = rollup.select(
        "data_dt", "singer1id", "singer1",
        R.singer_rsi(1, c("sing_cnt"), c("supp_cnt")).alias("rsi_1d"),
        R.singer_rsi(7, c("rct_7_sing_cnt"), c("rct_7_supp_cnt"),
                     c("rct_7_top_sing_cnt"), c("rct_7_top_supp_cnt")).alias("rsi_7d"),
        R.singer_rsi(30, c("rct_30_sing_cnt"), c("rct_30_supp_cnt"),
                     c("rct_30_top_sing_cnt"), c("rct_30_top_supp_cnt")).alias("rsi_30d"))
    return _long_by_period(scored, ["singer1id", "singer1"])


def _singer_order():
    return [F.col("rsi").desc_nulls_last(), F.col("singer1id").asc_nulls_first(),
            F.col("singer1").asc_nulls_first()]


def singer_rsi(features: DataFrame, data_dt: str | None = None) -> DataFrame:
    """Roll songs up to first singers, score and rank per day and period."""
    scores = singer_scores(singer_rollup(features, data_dt))
    ranked = row_number(scores, ["data_dt", "period"], _singer_order(), "rsi_rank")
    return ranked.select(*schemas.SINGER_RSI.names)


def singer_rsi_top(features: DataFrame, n: int = 30, data_dt: str | None = None) -> DataFrame:
    scores = singer_scores(singer_rollup(features, data_dt))
    ranked = _top_n(scores, ["data_dt", "period"], _singer_order(), n, "rsi_rank")
    return ranked.select(*schemas.SINGER_RSI.names)


def top_n(ranked: DataFrame, n: int = 30) -> DataFrame:
    """Keep ranks 1..n of an already ranked RSI table (e.g. read back from the
    written partition, so publishing does not recompute the ranking)."""
    return ranked.where(F.col("rsi_rank") <= n)
