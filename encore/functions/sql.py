"""SQL names for the cleaning functions, for users who write SQL.

``register(spark)`` creates session-scoped SQL functions whose bodies are
plain SQL expressions, so Catalyst inlines them like any built-in (no Python
at run time).  Each body states the same rule as the Column function of the
same name; tests check the two agree.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .machines import AREA_SEPARATOR, EPOCH_COMPACT, NULL_TEXT, PROVINCE_SUFFIX, SPECIAL_PROVINCES
from .songs import _LENIENT_TS, ALBUM_TITLE, NO_ALBUM
from .users import DEFAULT_LOGIN_MODE, LOGIN_MODES

_LENIENT_INT = "TRY_CAST(TRY_CAST({x} AS DECIMAL(38,6)) AS INT)"


def _login_mode_body() -> str:
    code = _LENIENT_INT.format(x="mode_type")
    whens = " ".join(f"WHEN {code} = {k} THEN '{name}'" for k, name in LOGIN_MODES)
    return f"CASE {whens} ELSE '{DEFAULT_LOGIN_MODE}' END"


_ARRAY = "CASE WHEN startswith(ltrim(s), '[') THEN from_json(s, 'array<struct<name:string,id:string>>') END"
_TITLE = f"regexp_extract(s, '{ALBUM_TITLE}', 1)"
_STAMP = "yyyy-MM-dd HH:mm:ss"


def _part(i: int) -> str:
    return f"TRY_CAST(regexp_extract(s, '{_LENIENT_SQL}', {i}) AS INT)"


_LENIENT_SQL = _LENIENT_TS.replace("\\", "\\\\")
_MILLIS = "TRY_CAST(TRY_CAST(s AS DECIMAL(38,6)) AS BIGINT)"
_EPOCH_DAYS = f"floor({_MILLIS} / 86400000)"


def _post_time_body() -> str:
    lenient = (f"make_timestamp_ntz({_part(1)}, 1, 1, 0, 0, 0) + make_ym_interval(0, {_part(2)} - 1) + "
               f"make_dt_interval({_part(3)} - 1, {_part(4)}, {_part(5)}, CAST({_part(6)} AS DECIMAL(18,6)))")
    epoch = (f"make_timestamp_ntz(1970, 1, 1, 0, 0, 0) + make_dt_interval(CAST({_EPOCH_DAYS} AS INT), 0, 0, "
             f"CAST(({_MILLIS} - {_EPOCH_DAYS} * 86400000) / 1000 AS DECIMAL(18,6)))")
    return (f"coalesce(CASE WHEN regexp_extract(s, '{_LENIENT_SQL}', 0) <> '' THEN date_format({lenient}, '{_STAMP}') END, "
            f"date_format(convert_timezone('UTC', tz, {epoch}), '{_STAMP}'), '')")


def _province_body() -> str:
    special = " ".join(f"WHEN instr(address, '{name}') > 0 THEN '{name}'" for name in SPECIAL_PROVINCES)
    return (f"CASE WHEN address IS NULL OR address = '' THEN '' {special} "
            f"ELSE substring(address, 1, instr(address, '{PROVINCE_SUFFIX}')) END")


def _city_body() -> str:
    has = f"instr(real_address, '{AREA_SEPARATOR}') > 0"
    area = f"CASE WHEN {has} THEN substring_index(real_address, '{AREA_SEPARATOR}', 1) ELSE real_address END"
    start = f"length({_province_body()}) + 1"
    between = (f"CASE WHEN instr(address, {area}) > 0 AND instr(address, {area}) > {start} "
               f"THEN substring(address, {start}, instr(address, {area}) - ({start})) ELSE '' END")
    return (f"CASE WHEN address IS NULL OR address = '' THEN '' "
            f"WHEN {has} AND {between} = '' THEN {area} ELSE {between} END")


FUNCTIONS = {
    "album_name": ("s STRING", "STRING",
                   f"CASE WHEN get({_ARRAY}, 0) IS NOT NULL THEN get({_ARRAY}, 0).name "
                   f"WHEN {_TITLE} <> '' THEN {_TITLE} ELSE '{NO_ALBUM}' END"),
    "singer_info": ("s STRING, position INT, field STRING", "STRING",
                    f"CASE WHEN get({_ARRAY}, position - 1) IS NULL THEN '' "
                    f"WHEN field = 'name' THEN get({_ARRAY}, position - 1).name ELSE get({_ARRAY}, position - 1).id END"),
    "post_time": ("s STRING, tz STRING", "STRING", _post_time_body()),
    "auth_company": ("s STRING, mode STRING", "STRING",
                     "CASE WHEN mode = 'reference' THEN '' ELSE coalesce(get_json_object(s, '$.name'), '') END"),
    "province": ("address STRING", "STRING", _province_body()),
    "city": ("address STRING, real_address STRING", "STRING", _city_body()),
    "compact_time": ("s STRING", "STRING",
                     f"CASE WHEN s = '{NULL_TEXT}' THEN '{EPOCH_COMPACT}' "
                     "WHEN length(s) = 8 THEN concat(s, '000000') ELSE s END"),
    "product_name": ("product_type STRING", "STRING",
                     "CASE WHEN product_type = '1' THEN 'MiniK' ELSE 'Kshow' END"),
    "product_types": ("s STRING", "STRING",
                      r"CASE WHEN length(s) > 1 THEN regexp_replace(s, '^\\[|\\]$', '') ELSE '' END"),
    "login_mode": ("mode_type STRING", "STRING", _login_mode_body()),
    "score_int": ("score STRING", "INT", _LENIENT_INT.format(x="score")),
    "day_minus": ("d STRING, n INT", "STRING",
                  "date_format(date_sub(to_date(d, 'yyyyMMdd'), n), 'yyyyMMdd')"),
}


def register(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(FUNCTIONS)
