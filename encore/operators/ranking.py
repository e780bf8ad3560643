"""Ranking and top-n.

``row_number``  ``row_number()`` per group from one global range sort: a group
    is spread over as many tasks as the sort gives it, whatever its size, and
    equal scores are split by the columns that follow them in the order.  Each
    task numbers its rows and the numbered rows are written once; per (task,
    group) counts -- at most one row per group and task it reaches -- give
    each task its starting rank.  Counts and rows come from the same written
    rows, so they always agree.  A row's number within its task is the low 33
    bits of ``monotonically_increasing_id()``, whose layout (partition above
    bit 33, row number below) is documented by Spark and relied on here.

``top_n``  ``row_number() <= n`` with a window: Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle, so every task ships at most n
    rows per group, however large or skewed the group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.tables import materialize

_PID = "_rk_pid"
_POS = "_rk_pos"


def row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
               rank_col: str = "rank") -> DataFrame:
    """``row_number() over (partition by group_cols order by order)``.

    ``order`` must be a total order of a group's distinct rows for the ranks
    to be deterministic; rows equal in all of it get neighbouring ranks.
    """
    keys = [F.col(c).asc_nulls_first() for c in group_cols] + list(order)
    pos = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    numbered = materialize(df.orderBy(*keys).select("*", F.spark_partition_id().alias(_PID), pos.alias(_POS)))
    g = [F.col(c) for c in group_cols]
    per_task = numbered.groupBy(_PID, *group_cols).agg(F.min(_POS).alias("_rk_first"),
                                                       F.count(F.lit(1)).alias("_rk_n"))
    earlier = Window.partitionBy(*g).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # Renamed, so the join condition cannot bind both sides to the same
    # attributes; group keys match null-safely (NULL is a group too).
    o_cols = [f"_rk_g{i}" for i in range(len(group_cols))]
    offsets = per_task.select(
        F.col(_PID).alias("_rk_opid"), *[F.col(c).alias(o) for c, o in zip(group_cols, o_cols)],
        (F.coalesce(F.sum("_rk_n").over(earlier), F.lit(0)) - F.col("_rk_first") + 1).alias("_rk_add"))
    cond = F.col(_PID) == F.col("_rk_opid")
    for c, o in zip(group_cols, o_cols):
        cond = cond & F.col(c).eqNullSafe(F.col(o))
    return numbered.join(offsets, cond).select(
        *df.columns, (F.col(_POS) + F.col("_rk_add")).cast("int").alias(rank_col))


def row_number_window(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                      rank_col: str = "rank") -> DataFrame:
    """Plain window ``row_number()``: a whole group in one task."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w))


def top_n(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per group (ties broken by ``order``)."""
    return row_number_window(df, group_cols, order, rank_col).where(F.col(rank_col) <= n)
