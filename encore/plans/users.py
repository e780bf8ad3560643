"""Users: registrations from four channels, daily login detail, single-login users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import users as U
from ..functions.dates import window_bounds
from ..operators.skew import skewed_left_join

# Per channel: target column -> source column, "" literal, or None (NULL).
# Fixed layout of the four registration sources.
CHANNELS = {
    "alipay": {"phone_number": "msisdn", "score": "score", "is_certified": "is_certified",
               "is_student_certified": "is_student_certified", "openid": "openid",
               "wxid": "", "appid": "", "qqid": ""},
    "wechat": {"phone_number": "msisdn", "score": "score", "is_certified": None,
               "is_student_certified": None, "openid": "", "wxid": "wxid", "appid": "", "qqid": ""},
    "qq": {"phone_number": "msisdn", "score": "score", "is_certified": "", "is_student_certified": "",
           "openid": "", "wxid": "", "appid": "", "qqid": "openid"},
    "app": {"phone_number": "phone_number", "score": "", "is_certified": "", "is_student_certified": "",
            "openid": "", "wxid": "", "appid": "app_uid", "qqid": ""},
}


def registrations(sources: dict[str, DataFrame]) -> DataFrame:
    """Align the channel tables to one 17-column layout and union them.

    A uid registered in several channels keeps one row per channel.
    """
    parts = []
    for channel, mapping in CHANNELS.items():
        if channel not in sources:
            continue
        df = sources[channel]
        cols = []
        for name in schemas.REGISTRATIONS.names:
            if name == "reg_channel":
                cols.append(F.lit(channel).alias(name))
                continue
            src = mapping.get(name, name)
            if src is None:
                cols.append(F.lit(None).cast("string").alias(name))
            elif src == "":
                cols.append(F.lit("").alias(name))
            else:
                cols.append(F.col(src).cast("string").alias(name))
        parts.append(df.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def login_detail(logins: DataFrame, regs: DataFrame, data_dt: str | None = None, skewed: bool = False) -> DataFrame:
    """Each login of the day (every day when ``data_dt`` is None) with the
    user's registrations; a user in k channels gives k rows, an unregistered
    user one row of NULLs.

    Shuffle join on uid; a hot uid on the login side is split by AQE's skew
    handling (the registration side has at most one row per channel).
    ``skewed`` finds hot uids first, deals their logins over tasks and keeps
    logins without uid out of the shuffle: one more pass over the uid column.
    """
    if data_dt is not None:
        logins = logins.where(F.col("data_dt") == F.lit(str(data_dt)))
    joined = skewed_left_join(logins, regs, "uid") if skewed else logins.join(regs, ["uid"], "left")
    c = F.col
    out = {
        "login_mode": U.login_mode(c("mode_type")),
        "score": U.score_int(c("score")),
    }
    return joined.select(*[out.get(n, c(n)).alias(n) for n in schemas.LOGIN_DETAIL.names])


def single_login(detail_history: DataFrame, data_dt: str, days: int = 7, bounded: bool = False,
                 inclusive: bool = True) -> DataFrame:
    """All detail rows of users with exactly one detail row in the window
    ``[data_dt - days, data_dt]`` and a known registration machine.

    ``bounded=False`` returns the users' whole history (warehouse rule);
    ``True`` only their rows inside the window.  Left-semi join: each user's
    rows are returned once whatever the window count table looks like.
    """
    lo, hi = window_bounds(str(data_dt), days, inclusive)
    in_window = detail_history.where(F.col("data_dt").between(F.lit(lo), F.lit(hi)))
    once = (in_window.groupBy("uid").agg(F.count("uid").alias("c"))
            .where(F.col("c") == 1).select("uid"))
    rows = in_window if bounded else detail_history
    return (rows.where(F.col("reg_mid").isNotNull())
            .join(once, "uid", "left_semi")
            .select(*detail_history.columns))
