"""Cleaning functions of the song dimension, as native Column expressions.

All of them are total: inputs on which the original row-at-a-time cleaners
would throw give the documented fallback instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the song dimension (must equal the warehouse's output).
NO_ALBUM = "暂无专辑"  # "no album" placeholder
ALBUM_TITLE = "(?s)(《.*》)"  # first 《 … last 》 (title marks), across lines

_NAME_ID_ARRAY = "array<struct<name:string,id:string>>"


def _json_array(s: Column) -> Column:
    """Parse ``s`` as an array of {name, id} objects, only if it looks like one.

    ``from_json`` would wrap a bare object into a one-element array; the
    original parser rejects it, so gate on a leading ``[``.
    """
    return F.when(F.ltrim(s).startswith("["), F.from_json(s, _NAME_ID_ARRAY))


def album_name(s: Column) -> Column:
    """First element's ``name`` of a JSON array; else the text from the first
    《 to the last 》 (inclusive); else the no-album placeholder."""
    arr = _json_array(s)
    first = F.get(arr, 0)
    bracketed = F.regexp_extract(s, ALBUM_TITLE, 1)
    fallback = F.when(bracketed != "", bracketed).otherwise(F.lit(NO_ALBUM))
    return F.when(first.isNotNull(), first.getField("name")).otherwise(fallback)


def singer_info(s: Column, position: int, field: str) -> Column:
    """``field`` ('name' | 'id') of the singer at ``position`` (1 | 2).

    Unparsable text or a too-short array gives ``""``; a present element
    without the key gives NULL.
    """
    if position not in (1, 2) or field not in ("name", "id"):
        raise ValueError("position must be 1|2 and field 'name'|'id'")
    arr = _json_array(s)
    elem = F.get(arr, position - 1)
    return F.when(elem.isNotNull(), elem.getField(field)).otherwise(F.lit(""))


_LENIENT_TS = r"^(\d+)-(\d+)-(\d+) (\d+):(\d+):(\d+)"


def post_time(s: Column, tz: str = "UTC") -> Column:
    """Normalise a post time to ``yyyy-MM-dd HH:mm:ss``.

    1. A ``y-M-d H:m:s`` prefix is read leniently: out-of-range fields roll
       over (month 13 -> January next year, hour 25 -> next day 01h) and any
       trailing text (``.0``) is ignored.
    2. Otherwise a decimal number (also ``1.3819392E+12``) is epoch
       milliseconds, truncated toward zero, shown in time zone ``tz``.
    3. Otherwise ``""``.
    """
    def part(i: int) -> Column:
        return F.regexp_extract(s, _LENIENT_TS, i).try_cast("int")

    matched = F.regexp_extract(s, _LENIENT_TS, 0) != ""
    # Lenient calendar: start at Jan 1 of the year, then add the months, days
    # and time of day, each of which may overflow into the next unit.
    start = F.make_timestamp_ntz(part(1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    lenient = (start
               + F.make_ym_interval(F.lit(0), part(2) - 1)
               + F.make_dt_interval(part(3) - 1, part(4), part(5), part(6).cast("decimal(18,6)")))
    text = F.date_format(lenient, "yyyy-MM-dd HH:mm:ss")

    millis = s.try_cast("decimal(38,6)").try_cast("bigint")
    epoch_days = F.floor(millis / F.lit(86_400_000))
    rest_ms = millis - epoch_days * F.lit(86_400_000)
    utc_wall = (F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
                + F.make_dt_interval(epoch_days.cast("int"), F.lit(0), F.lit(0),
                                     (rest_ms / F.lit(1000)).cast("decimal(18,6)")))
    local_wall = utc_wall if tz.upper() == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)
    from_epoch = F.date_format(local_wall, "yyyy-MM-dd HH:mm:ss")

    return F.coalesce(F.when(matched, text), from_epoch, F.lit(""))


def auth_company(s: Column, mode: str = "reference") -> Column:
    """Licensing company.

    ``reference``: the warehouse always stores ``""`` (its cleaner parses an
    empty local instead of the input).  ``intended``: the object's ``name``.
    """
    if mode == "reference":
        return F.lit("")
    return F.coalesce(F.get_json_object(s, "$.name"), F.lit(""))


def product_types(s: Column) -> Column:
    """Strip one leading ``[`` and one trailing ``]``; NULL or length <= 1 -> ``""``."""
    return F.when(F.length(s) > 1, F.regexp_replace(s, r"^\[|\]$", "")).otherwise(F.lit(""))


def product_type_array(s: Column) -> Column:
    """``split(s, ',')``: ``""`` -> ``[""]``, blanks kept."""
    return F.split(s, ",")


def text_length(s: Column) -> Column:
    """Character length; NULL stays NULL."""
    return F.length(s)
