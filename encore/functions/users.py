"""User-table functions as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Login mode codes as the login table stores them.
LOGIN_MODES = [(0, "alipay"), (1, "wechat"), (3, "qq")]
DEFAULT_LOGIN_MODE = "app"


def lenient_int(s: Column) -> Column:
    """Text -> int the way a non-ANSI cast reads it.

    ``"10"`` 10, ``" 7 "`` 7, ``"12.5"`` 12 (truncated), ``""``/``"x"``/overflow
    NULL -- never an error.
    """
    return s.try_cast("decimal(38,6)").try_cast("int")


def login_mode(mode_type: Column) -> Column:
    """0 alipay, 1 wechat, 3 qq; anything else (NULL, ``""``, 2, …) app."""
    code = lenient_int(mode_type.cast("string"))
    expr = F.lit(DEFAULT_LOGIN_MODE)
    for k, name in reversed(LOGIN_MODES):
        expr = F.when(code == k, F.lit(name)).otherwise(expr)
    return expr


def score_int(score: Column) -> Column:
    """``cast(score as int)`` with the lenient reading of :func:`lenient_int`."""
    return lenient_int(score)
