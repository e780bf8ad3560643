"""Trailing-window statistics per key and day.

For every (key, day) on which the key has rows, and for each span ``k``:

* ``n_0`` / ``n_k``      rows on the day / in ``[day-k, day]``
* ``peak_k``             largest single-day row count in ``[day-k, day]``
* ``d_<col>_0`` / ``d_<col>_k``  distinct non-NULL values of ``col`` on the
  day / in ``[day-k, day]``

All of it follows from a *daily state*: per (key, day) the number of rows, and
per (key, day, value) that the value was seen.  The state of a day depends on
that day's rows only, so it can be kept as a day-partitioned table
(:func:`daily_state`) and merged by :func:`trailing_from_state`;
:func:`trailing_stats` computes it on the way.  Two physical strategies, same
results (tests check they agree):

``single day``  two aggregations over ``[D-max(k), D]``, each with a map-side
    partial step, so a hot key or a hot value (one song with a third of all
    plays, the anonymous uid) is collapsed before it is shuffled.

``many days``   no per-day re-scan.  The rows are shuffled once, by key, and a
    task does all that follows for its keys.  Keys that would fill more than a
    task's share (a sketch finds them) and rows without a key go another way:
    a map-side partial step collapses them to one row per (key, value), its
    days as bits, before they are shuffled by key and value, and what is
    shuffled by key then is bounded by the number of days.  With the days before and after on which a (key, value) was
    seen (``lag`` and ``lead``), a day begins a run for window ``k`` if the
    value was not seen in the ``k`` days before it, and ends one if not in the
    ``k`` days after.  Both are counted per (key, day) -- bounded by the number
    of days, whatever the key's row count.  A window ``[D-k, D]`` holds as many
    values as runs began up to ``D``, less those whose last day was before
    ``D-k``: two running sums.  Row counts and daily peaks are RANGE frames
    over the per-day counts.  Only hash aggregation with fixed-width buffers:
    no set of values or days is ever gathered.

With sketches (:func:`sketch_state`, :func:`trailing_from_sketches`) the state
is one row per (key, day), whatever the number of values: a HyperLogLog sketch
per column, merged over the days of a window.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_minus, day_number, day_string
from .skew import frequent_keys

_COUNT_KIND = "#"


def _stacked(df: DataFrame, key: str, day: str, distinct: Sequence[str]) -> DataFrame:
    """One row per input row and kind: ('#', day) plus (col, value) per column."""
    pairs = [F.struct(F.lit(_COUNT_KIND).alias("kind"), F.col(day).cast("string").alias("v"))]
    pairs += [F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("v")) for c in distinct]
    base = df.select(F.col(key).alias("key"), day_number(F.col(day)).alias("dn"), F.array(*pairs).alias("_kv"))
    # inline_outer: the array is never empty, and the outer form keeps Catalyst
    # from adding a "size(array) > 0" filter that evaluates it a second time.
    return (base.select("key", "dn", F.inline_outer("_kv"))
            .where((F.col("kind") == _COUNT_KIND) | F.col("v").isNotNull())
            .withColumn("n", F.lit(1).cast("bigint")))


def _per_day(stacked: DataFrame) -> DataFrame:
    return stacked.groupBy("key", "kind", "v", "dn").agg(F.sum("n").alias("n"))


def daily_state(df: DataFrame, key: str, day: str, distinct: Sequence[str] = ()) -> DataFrame:
    """(key, kind, v, n, day): what :func:`trailing_from_state` needs of each day.

    Kind ``#`` holds the key's rows of the day; a column's name as kind holds
    one row per value of it.  A day's state follows from that day's rows
    alone: rows that arrive late are taken in by replacing their day's state.
    """
    return _per_day(_stacked(df, key, day, distinct)).select(
        F.col("key").alias(key), "kind", "v", "n", day_string(F.col("dn")).alias(day))


def _in_range(df: DataFrame, day: str, spans: Sequence[int], first_day: str | None, last_day: str | None) -> DataFrame:
    if first_day is not None:
        df = df.where(F.col(day) >= F.lit(day_minus(first_day, spans[-1])))
    if last_day is not None:
        df = df.where(F.col(day) <= F.lit(last_day))
    return df


def _checked(spans: Sequence[int]) -> list[int]:
    spans = sorted(set(int(k) for k in spans))
    if not spans or spans[0] <= 0:
        raise ValueError("spans must be positive day counts")
    return spans


def trailing_stats(df: DataFrame, key: str, day: str, spans: Sequence[int],
                   distinct: Sequence[str] = (), first_day: str | None = None,
                   last_day: str | None = None) -> DataFrame:
    """Trailing-window statistics for output days in ``[first_day, last_day]``.

    ``df`` needs ``key``, ``day`` (``yyyyMMdd`` string) and the ``distinct``
    columns.  Rows older than ``first_day - max(spans)`` are pruned at the
    scan.  ``first_day == last_day`` takes the single-day plan.
    """
    spans = _checked(spans)
    df = _in_range(df, day, spans, first_day, last_day).select(key, day, *distinct)
    return _merged(df, lambda d: _stacked(d, key, day, distinct), _per_day, key, day, spans, distinct, first_day, last_day)


def trailing_from_state(state: DataFrame, key: str, day: str, spans: Sequence[int],
                        distinct: Sequence[str] = (), first_day: str | None = None,
                        last_day: str | None = None) -> DataFrame:
    """:func:`trailing_stats` from a kept :func:`daily_state`; only the days a window covers are read."""
    spans = _checked(spans)
    state = _in_range(state, day, spans, first_day, last_day).select(key, "kind", "v", "n", day)

    def rows(kept: DataFrame) -> DataFrame:
        return kept.select(F.col(key).alias("key"), "kind", "v", "n", day_number(F.col(day)).alias("dn"))

    return _merged(state, rows, lambda r: r, key, day, spans, distinct, first_day, last_day)


def _merged(df, rows, per_day, key, day, spans, distinct, first_day, last_day) -> DataFrame:
    if first_day is not None and first_day == last_day:
        return _single_day(rows(df), key, day, spans, distinct, first_day)
    calm, apart = apart_by_key(df, key)
    out = _many_days(per_day(rows(calm)), key, day, spans, distinct).unionByName(
        _many_days(_days_as_bits(rows(apart), *_days(df, day)), key, day, spans, distinct))
    return out if first_day is None else out.where(F.col(day) >= F.lit(first_day))


def apart_by_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows shuffled by ``key``; and, as they lie, those without a key or of a key that fills more than a task's share."""
    frequent = frequent_keys(df, key, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    apart = F.col(key).isNull()
    if frequent:
        apart = apart | F.col(key).isin(sorted(frequent))
    return df.where(~apart).repartition(F.col(key)), df.where(apart)


def _days(df: DataFrame, day: str) -> tuple[int, int]:
    """First and last day number."""
    r = df.select(day).distinct().select(day_number(F.col(day)).alias("dn")).agg(F.min("dn"), F.max("dn")).first()
    return (r[0], r[1]) if r[0] is not None else (0, 0)


def _days_as_bits(rows: DataFrame, first: int, last: int) -> DataFrame:
    """The per-day rows of ``rows``, by way of one row per (key, kind, value) with a bit for each day from ``first`` to ``last``."""
    at = f"(dn - ({first}))"
    words = [F.expr(f"bit_or(CASE WHEN {at} div 64 = {w} THEN shiftleft(1L, {at} % 64) END)").alias(f"_w{w}")
             for w in range((last - first) // 64 + 1)]
    held = rows.groupBy("key", "kind", "v").agg(F.sum("n").alias("n"), F.max(F.col("dn").isNull()).alias("_undated"), *words)
    bits = F.array(*[F.coalesce(F.col(f"_w{w}"), F.lit(0).cast("bigint")) for w in range(len(words))])
    days = F.concat(F.sequence(F.lit(0), F.lit(last - first)), F.array(F.lit(None).cast("int")))
    return (held.select("key", "kind", "v", "n", "_undated", bits.alias("_bits"), F.explode(days).alias("_at"))
            .where(F.expr("CASE WHEN _at IS NULL THEN _undated ELSE getbit(_bits[cast(_at div 64 as int)], _at % 64) = 1 END"))
            .select("key", "kind", "v", "n", (F.col("_at") + first).alias("dn")))


def _output_columns(key: str, day: str, spans, distinct) -> list[str]:
    cols = [key, day, "n_0"] + [f"n_{k}" for k in spans] + [f"peak_{k}" for k in spans]
    for c in distinct:
        cols += [f"d_{c}_0"] + [f"d_{c}_{k}" for k in spans]
    return cols


def _single_day(rows, key, day, spans, distinct, the_day) -> DataFrame:
    d = (_dt.datetime.strptime(the_day, "%Y%m%d").date() - _dt.date(1970, 1, 1)).days
    # Level 1: per (key, kind, value): rows and the latest day seen.  For the
    # count kind the value is the day itself, so this is the daily count.
    lvl1 = rows.groupBy("key", "kind", "v").agg(F.sum("n").alias("n"), F.max("dn").alias("last"))
    is_cnt = F.col("kind") == _COUNT_KIND

    def since(k: int) -> Column:
        return F.col("last") >= F.lit(d - k)

    aggs = [F.sum(F.when(is_cnt & (F.col("last") == d), F.col("n"))).alias("n_0")]
    aggs += [F.sum(F.when(is_cnt & since(k), F.col("n"))).alias(f"n_{k}") for k in spans]
    aggs += [F.max(F.when(is_cnt & since(k), F.col("n"))).alias(f"peak_{k}") for k in spans]
    for c in distinct:
        is_c = F.col("kind") == c
        aggs.append(F.count(F.when(is_c & (F.col("last") == d), 1)).alias(f"d_{c}_0"))
        aggs += [F.count(F.when(is_c & since(k), 1)).alias(f"d_{c}_{k}") for k in spans]
    out = (lvl1.groupBy("key").agg(*aggs)
           .where(F.col("n_0") > 0)
           .withColumn(day, F.lit(the_day))
           .withColumnRenamed("key", key))
    return out.select(*_output_columns(key, day, spans, distinct))


def _many_days(state, key, day, spans, distinct) -> DataFrame:
    near = Window.partitionBy("key", "kind", "v").orderBy("dn")
    seen = state.withColumns({"before": F.lag("dn").over(near), "after": F.lead("dn").over(near)})

    def count_if(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0))

    sums = [F.sum(F.when(F.col("kind") == _COUNT_KIND, F.col("n")).otherwise(0)).alias("n")]
    for c in distinct:
        own = F.col("kind") == c
        sums.append(count_if(own).alias(f"{c}_here"))
        for k in spans:
            begins = F.col("before").isNull() | (F.col("dn") - F.col("before") > k)
            ends = F.col("after").isNull() | (F.col("after") - F.col("dn") > k)
            sums += [count_if(own & begins).alias(f"{c}_begin_{k}"), count_if(own & ends).alias(f"{c}_end_{k}")]
    days = seen.groupBy("key", "dn").agg(*sums).withColumnRenamed("key", key)
    # Partition the window by the output key column itself, so the result is
    # known to be hash-partitioned by it: a later join or aggregation on the
    # key (the song dimension join) reuses that partitioning instead of
    # shuffling the features again.
    w = Window.partitionBy(key).orderBy("dn")
    cols = [F.col(key), day_string(F.col("dn")).alias(day), F.col("n").alias("n_0")]
    cols += [F.sum("n").over(w.rangeBetween(-k, 0)).alias(f"n_{k}") for k in spans]
    cols += [F.max("n").over(w.rangeBetween(-k, 0)).alias(f"peak_{k}") for k in spans]
    for c in distinct:
        cols.append(F.col(f"{c}_here").alias(f"d_{c}_0"))
        for k in spans:
            begun = F.sum(f"{c}_begin_{k}").over(w.rangeBetween(Window.unboundedPreceding, 0))
            ended = F.sum(f"{c}_end_{k}").over(w.rangeBetween(Window.unboundedPreceding, -k - 1))
            cols.append((begun - F.coalesce(ended, F.lit(0))).alias(f"d_{c}_{k}"))
    return days.select(*cols).select(*_output_columns(key, day, spans, distinct))


# ----------------------------------------------------------------- sketches
#: log2 of a sketch's registers: a relative standard error of 1.04 / sqrt(2**12), under 1.7 %.
LG_REGISTERS = 12


def sketch_state(df: DataFrame, key: str, day: str, distinct: Sequence[str], lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(key, day, n, s_<col> ...): rows and a mergeable distinct sketch per column, one row per key and day."""
    # A sketch passes over the empty text, which is a value here: every value gets a mark before it.
    return df.groupBy(key, day).agg(F.count(F.lit(1)).alias("n"), *[
        F.hll_sketch_agg(F.concat(F.lit("="), F.col(c).cast("string")), lg_registers).alias(f"s_{c}") for c in distinct])


def trailing_from_sketches(state: DataFrame, key: str, day: str, spans: Sequence[int], distinct: Sequence[str],
                           first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The columns of :func:`trailing_stats` from a :func:`sketch_state`; distinct counts are estimates.

    A key's rows are one a day, so a window over them is bounded by the number of days.
    """
    spans = _checked(spans)
    state = _in_range(state, day, spans, first_day, last_day).withColumn("dn", day_number(F.col(day)))
    w = Window.partitionBy(key).orderBy("dn")
    cols = [F.col(key), F.col(day), F.col("n").alias("n_0")]
    cols += [F.sum("n").over(w.rangeBetween(-k, 0)).alias(f"n_{k}") for k in spans]
    cols += [F.max("n").over(w.rangeBetween(-k, 0)).alias(f"peak_{k}") for k in spans]
    for c in distinct:
        cols.append(F.hll_sketch_estimate(f"s_{c}").alias(f"d_{c}_0"))
        cols += [F.hll_sketch_estimate(F.hll_union_agg(f"s_{c}").over(w.rangeBetween(-k, 0))).alias(f"d_{c}_{k}") for k in spans]
    out = state.select(*cols).select(*_output_columns(key, day, spans, distinct))
    return out if first_day is None else out.where(F.col(day) >= F.lit(first_day))
