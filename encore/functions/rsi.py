"""Song and singer influence index (RSI) formulas.

Let L(x) = ln(x + 1).  Every RSI is ``(weighted sum)^2 * 10``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed weights of the index.
W_AVG = 0.63    # weight of the per-day average
W_PEAK = 0.37   # weight of the peak / secondary statistic
W_SING = 0.8    # weight of plays
W_SUPP = 0.2    # weight of likes

PERIODS = (1, 7, 30)


def _l(x: Column) -> Column:
    return F.log(x + F.lit(1.0))


def _square10(x: Column) -> Column:
    return F.pow(x, 2) * F.lit(10.0)


def song_rsi(days: int, sing: Column, supp: Column,
             top_sing: Column | None = None, top_supp: Column | None = None) -> Column:
    """Song RSI of a ``days`` period.

    1 day:  L(sing)·.63·.8 + L(supp)·.63·.2
    k days: (L(sing/k)·.63 + L(top_sing)·.37)·.8 + (L(supp/k)·.63 + L(top_supp)·.37)·.2
    """
    if days == 1:
        return _square10(_l(sing / F.lit(1)) * W_AVG * W_SING + _l(supp / F.lit(1)) * W_AVG * W_SUPP)
    k = F.lit(days)
    return _square10((_l(sing / k) * W_AVG + _l(top_sing) * W_PEAK) * W_SING
                     + (_l(supp / k) * W_AVG + _l(top_supp) * W_PEAK) * W_SUPP)


def singer_rsi(days: int, sing: Column, supp: Column,
               top_sing: Column | None = None, top_supp: Column | None = None) -> Column:
    """Singer RSI of a ``days`` period (grouped by statistic, not by measure).

    1 day:  L(sing)·.63·.8 + L(supp)·.63·.2
    k days: (L(sing/k)·.63 + L(supp)·.37)·.8 + (L(top_sing/k)·.63 + L(top_supp)·.37)·.2
    """
    if days == 1:
        return _square10(_l(sing / F.lit(1)) * W_AVG * W_SING + _l(supp) * W_AVG * W_SUPP)
    k = F.lit(days)
    return _square10((_l(sing / k) * W_AVG + _l(supp) * W_PEAK) * W_SING
                     + (_l(top_sing / k) * W_AVG + _l(top_supp) * W_PEAK) * W_SUPP)
