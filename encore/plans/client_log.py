"""Client log: gate and route raw lines, flatten song-play requests.

``parse``      lines -> (request_type, payload) for records with six fields
``route``      one text line per record: song plays as a tab-joined row of
               the ten stored fields, every other type passed through as JSON
``song_play``  the typed ten-column day table of song plays
``rejects``    song-play records whose payload is not a JSON object
``requests``   typed fields of the other request types, and their rejects
``counted``    lines and records observed while they pass, for ``load_counts``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions import client_log as L


def _once(df: DataFrame, keep: list, name: str, expr) -> DataFrame:
    """Add ``expr`` as column ``name`` evaluated exactly once per row.

    A filter on a projected alias is pushed below the projection with the
    alias replaced by its expression, so an expensive value (a split, a JSON
    parse) would be computed once in the filter and again in the projection.
    Produced by a one-element ``inline_outer`` instead, the column exists only
    above the generator and filters on it stay there.
    """
    return df.select(*keep, F.inline_outer(F.array(F.struct(expr.alias(name)))))


def parse(lines: DataFrame, mode: str = "reference", partitions: int | None = None,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Split each line on ``&`` and keep records with exactly six fields.

    ``reference``: an ``&`` inside the payload makes more than six fields and
    the record is dropped.  ``intended``: the payload may contain ``&``.
    ``partitions``: spread rows over that many tasks right after the read
    (a gzip file is one task); round-robin, so a dominant request type does
    not land in one task.  ``keep``: input columns carried along (e.g. a
    ``data_dt`` discovered from the landing directory).
    """
    if mode == "reference":
        out = _once(lines, list(keep), "_p", L.split_fields(F.col("value"))).where(F.size("_p") == L.N_FIELDS)
    else:
        out = _once(lines, list(keep), "_p", L.strict_fields(F.col("value"))).where(F.col("_p").isNotNull())
    out = out.select(L.field(F.col("_p"), 2).alias("request_type"),
                     L.field(F.col("_p"), 3).alias("payload"), *keep)
    if partitions:
        out = out.repartition(partitions)
    return out


def _flat(parsed: DataFrame, include_play_time: bool) -> DataFrame:
    plays = parsed.where(F.col("request_type") == L.SONG_PLAY)
    extra = [c for c in parsed.columns if c not in ("request_type", "payload")]
    return _once(plays, ["payload", *extra], "_j", L.parse_payload(F.col("payload"), include_play_time))


def _is_reject(include_play_time: bool = False):
    j = F.col("_j")
    return (~L.payload_is_object(F.col("payload"))) | j.isNull() | j.getField(L.CORRUPT).isNotNull()


def _field_names(include_play_time: bool) -> list[str]:
    return [f.name for f in L.song_play_schema(include_play_time).fields if f.name != L.CORRUPT]


def song_play(parsed: DataFrame, data_dt: str | None, mode: str = "reference",
              include_play_time: bool = False) -> DataFrame:
    """Song-play records as the ten-column table for ``data_dt`` (None: take
    the ``data_dt`` column carried by ``parsed``).

    ``reference``: a missing key is stored as the text ``null`` (the text
    table the warehouse loads holds that word); ``intended``: NULL.
    """
    flat = _flat(parsed, include_play_time).where(~_is_reject())
    names = _field_names(include_play_time)

    def val(n):
        v = F.col("_j").getField(n)
        return F.coalesce(v, F.lit(L.MISSING_TEXT)) if mode == "reference" else v

    day = F.col("data_dt") if data_dt is None else F.lit(str(data_dt))
    return flat.select(*[val(n).alias(n) for n in names], day.alias("data_dt"))


def rejects(parsed: DataFrame) -> DataFrame:
    """Song-play records whose payload cannot be read as a JSON object (and the columns carried along)."""
    extra = [c for c in parsed.columns if c not in ("request_type", "payload")]
    return _flat(parsed, False).where(_is_reject()).select(
        F.lit(L.SONG_PLAY).alias("request_type"), "payload", *extra)


def route(parsed: DataFrame, mode: str = "reference", include_play_time: bool = False) -> DataFrame:
    """(request_type, line): song plays as a tab-joined row, others unchanged.

    A missing key is the text ``null`` (``reference``) or an empty field
    (``intended``; never dropped, so the columns stay aligned).  The text has
    no escape, so a tab or line break inside a value is written as a space
    (the table of :func:`song_play` keeps it).  Rejected
    song-play payloads are left out (see :func:`rejects`).
    """
    names = _field_names(include_play_time)
    j = L.parse_payload(F.col("payload"), include_play_time)
    is_play = F.col("request_type") == L.SONG_PLAY

    def txt(n):
        v = F.col("_j").getField(n)
        return F.translate(F.coalesce(v, F.lit(L.MISSING_TEXT if mode == "reference" else "")), "\t\n\r", "   ")

    row = F.concat_ws("\t", *[txt(n) for n in names])
    extra = [c for c in parsed.columns if c not in ("request_type", "payload")]
    with_j = _once(parsed, ["request_type", "payload", *extra], "_j", F.when(is_play, j))
    bad = is_play & _is_reject()
    return (with_j.where(~bad)
            .select("request_type", F.when(is_play, row).otherwise(F.col("payload")).alias("line"), *extra))


def song_play_from_lines(lines: DataFrame, data_dt: str, mode: str = "reference") -> DataFrame:
    return song_play(parse(lines, mode), data_dt, mode).select(*schemas.SONG_PLAY.names)


def _variants(parsed: DataFrame) -> DataFrame:
    others = parsed.where(F.col("request_type") != L.SONG_PLAY)
    extra = [c for c in parsed.columns if c not in ("request_type", "payload")]
    return _once(others, ["request_type", "payload", *extra], "_v", L.payload_variant(F.col("payload")))


def requests(parsed: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """Typed payload fields of every request that is no song play (and the columns carried along).

    The payload is parsed once into a VARIANT; ``fields`` maps names to types.
    Malformed payloads are left out (see :func:`request_rejects`).
    """
    extra = [c for c in parsed.columns if c not in ("request_type", "payload")]
    known = _variants(parsed).where(F.col("_v").isNotNull())
    return known.select("request_type", *L.variant_fields(F.col("_v"), fields or L.OTHER_FIELDS), *extra)


def request_rejects(parsed: DataFrame) -> DataFrame:
    """Requests other than song plays whose payload is no JSON."""
    return _variants(parsed).where(F.col("_v").isNull()).drop("_v")


def counted_lines(lines: DataFrame, seen: Observation) -> DataFrame:
    """``lines``, counted as they pass."""
    return lines.observe(seen, F.count(F.lit(1)).alias("lines"))


def counted_records(parsed: DataFrame, seen: Observation) -> DataFrame:
    """``parsed``, its records counted by request type as they pass."""
    of = F.col("request_type")
    counts = [F.count_if(of == t).alias(t) for t in L.REQUEST_TYPES]
    return parsed.observe(seen, *counts, F.count_if(~of.isin(L.REQUEST_TYPES)).alias(L.OTHER_TYPE))


def load_counts(lines: Observation, records: Observation, rejected: Observation) -> list[tuple]:
    """(metric, request_type, n): lines read, lines dropped by the gate, and records and rejects by type.

    Lines are dropped and records together; no pass is made for them.
    """
    n, by_type = lines.get["lines"], records.get
    out = [("lines", None, n), ("dropped", None, n - sum(by_type.values()))]
    out += [("records", t, by_type[t]) for t in [*L.REQUEST_TYPES, L.OTHER_TYPE]]
    return out + [("rejected", L.SONG_PLAY, rejected.get["rejected"])]
