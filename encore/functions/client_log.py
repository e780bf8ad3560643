"""Column expressions for client log lines.

A log line is ``ts & mid & request_type & json & version & version``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the log format.
FIELD_SEP = "&"
N_FIELDS = 6
SONG_PLAY = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
# Request types of the log format, each counted on its own by an ingest.
REQUEST_TYPES = [SONG_PLAY, "MINIK_CLIENT_ADVERTISEMENT_RECORD", "MINIK_SERVER_GET_SONG_SELECT_LIST_REQ",
                 "MINIK_CLIENT_REPORT_PKG_USE_STATUS"]
OTHER_TYPE = "other"
# The ten payload keys stored for a song-play request, in table order.
SONG_PLAY_FIELDS = [
    "songid", "mid", "optrate_type", "uid", "consume_type",
    "dur_time", "session_id", "songname", "pkg_id", "order_id",
]
PLAY_TIME = "play_time"   # kept only by the eleven-field variant
MISSING_TEXT = "null"     # how a missing key is written into the text output
CORRUPT = "_corrupt_record"


def split_fields(line: Column) -> Column:
    """Split on ``&`` the way Java's ``String.split`` does: trailing empty
    fields are dropped (``a&b&`` -> 2 fields, ``a&&b`` -> 3)."""
    return F.split(F.regexp_replace(line, "&+$", ""), FIELD_SEP)


def field(parts: Column, i: int) -> Column:
    """0-based field ``i`` of a split line, NULL when absent (no ANSI error)."""
    return F.get(parts, i)


def strict_fields(line: Column) -> Column:
    """Intended reading: six fields where the payload (field 3) may itself
    contain ``&`` (trailing ``&`` dropped first, as in the reference reading).
    Returns the six fields as an array, NULL on mismatch."""
    pat = r"(?s)^([^&]*)&([^&]*)&([^&]*)&(.*)&([^&]*)&([^&]*)$"
    trimmed = F.regexp_replace(line, "&+$", "")
    return F.when(F.regexp_extract(trimmed, pat, 0) != "",
                  F.array(*[F.regexp_extract(trimmed, pat, i) for i in range(1, 7)]))


def song_play_schema(include_play_time: bool = False) -> T.StructType:
    names = list(SONG_PLAY_FIELDS)
    if include_play_time:
        names.insert(names.index("dur_time"), PLAY_TIME)
    fields = [T.StructField(n, T.StringType()) for n in names]
    fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def parse_payload(payload: Column, include_play_time: bool = False) -> Column:
    """JSON object -> struct of strings.  Numbers and booleans arrive as their
    text; a missing key is NULL; malformed text sets ``_corrupt_record``."""
    return F.from_json(payload, song_play_schema(include_play_time),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def payload_is_object(payload: Column) -> Column:
    """True when the payload parses as a JSON object."""
    return F.ltrim(payload).startswith("{")


def payload_variant(payload: Column) -> Column:
    """The payload as VARIANT, NULL when malformed: parsed once, whatever fields are taken from it."""
    return F.try_parse_json(payload)


#: Fields of the requests other than song plays, by type of the value.
OTHER_FIELDS = {"mid": "bigint", "uid": "bigint", "event_id": "bigint"}


def variant_fields(variant: Column, fields: dict[str, str] = OTHER_FIELDS) -> list[Column]:
    """Typed fields of a VARIANT; a missing key or a value of another type is NULL."""
    return [F.try_variant_get(variant, f"$.{name}", kind).alias(name) for name, kind in fields.items()]
