"""Chat formatting: logged snapshots of growing conversations collapse to the maximal ones, which are rendered.

Turns are numbered in their conversation by one range sort, so a conversation
of any length is spread over tasks; parts of ``PART_TURNS`` turns are what a
task works on.  Each turn gets a rolling hash of the conversation up to it: the
exclusive or of 128-bit hashes of (place, role, text).  A conversation goes
where its whole hash is a prefix hash of a longer one (anti-join); of equal
conversations the smallest id stays.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import row_number
from . import text as tx
from .storage import staged

#: Turns of one part: what a task orders together and one rendered row holds.
PART_TURNS = 4096
_KEY = ["len", "x1", "x2"]
#: A conversation: its id or, without one, the hashes of its only turn.
_CONV = ["conv_id", "o1", "o2"]


def _distinct_turns(turns: DataFrame) -> DataFrame:
    """Rows that say the same of the same conversation once; a row without conv_id is a conversation of its own."""
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    named = turns.where(F.col("conv_id").isNotNull()).select("conv_id", zero.alias("o1"), zero.alias("o2"), "turn", "role", "text")
    alone = turns.where(F.col("conv_id").isNull()).select(
        "conv_id", F.xxhash64("role", "text").alias("o1"), F.xxhash64(F.lit("own"), "role", "text").alias("o2"),
        none.alias("turn"), "role", "text")
    return named.unionByName(alone).distinct()


def _prefixes(turns: DataFrame, part_turns: int) -> DataFrame:
    """Per turn: part, place in it, len, x1, x2 of the prefix that ends there, and whether more turns follow."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    rows = row_number(_distinct_turns(turns), _CONV, order, "at").select(
        *_CONV, F.floor((F.col("at") - 1) / part_turns).alias("part"), F.pmod(F.col("at") - 1, F.lit(part_turns)).alias("place"),
        F.col("at").cast("bigint").alias("len"), "role", "text")
    rows = rows.withColumns({"h1": F.xxhash64("len", "role", "text"), "h2": F.xxhash64(F.lit("second"), "len", "role", "text")})
    order = Window.partitionBy(*_CONV, "part").orderBy("place")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = staged(rows.withColumns({
        "p1": F.bit_xor("h1").over(upto), "p2": F.bit_xor("h2").over(upto),
        "inside": F.lead(F.lit(True), 1, False).over(order)}), "chat-turns")
    # Conversations of more than one part: what came before each part (a row per part, not per turn).
    parts = rows.groupBy(*_CONV, "part").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    across = Window.partitionBy(*_CONV).orderBy("part")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        *[F.col(c).alias(f"b_{c}") for c in (*_CONV, "part")], F.bit_xor("t1").over(earlier).alias("b1"),
        F.bit_xor("t2").over(earlier).alias("b2"), F.lead(F.lit(True), 1, False).over(across).alias("next_part")
    ).where(F.col("b1").isNotNull() | F.col("next_part"))
    joined = rows.join(before, _same(["part"]), "left")
    zero = F.lit(0).cast("bigint")
    return staged(joined.select(
        *_CONV, "part", "place", "role", "text", "len",
        F.col("p1").bitwiseXOR(F.coalesce("b1", zero)).alias("x1"), F.col("p2").bitwiseXOR(F.coalesce("b2", zero)).alias("x2"),
        (F.col("inside") | F.coalesce("next_part", F.lit(False))).alias("more")), "chat-prefixes")


def _same(more: list[str] | None = None) -> Column:
    cond = F.col("conv_id").eqNullSafe(F.col("b_conv_id"))
    for c in ["o1", "o2", *(more or [])]:
        cond = cond & (F.col(c) == F.col(f"b_{c}"))
    return cond


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def maximal_conversations(turns: DataFrame, part_turns: int = PART_TURNS, conv_col: str = "conv_id",
                          turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, text): each maximal conversation rendered, one row per ``part_turns`` turns, in order.

    Turns are ordered by number (null first), role, text; rows equal in these
    and the id are one turn.  Null role or text: empty.  A row without conv_id
    is a conversation of one turn, dropped when a longer or equal one exists
    that begins with it.  A longer conversation than ``part_turns`` gives rows
    whose texts, joined by part, are the whole; texts of any length.  Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = _prefixes(turns.select(
        tx.col(conv_col).alias("conv_id"), tx.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(tx.col(role_col), F.lit("")).alias("role"),
        F.coalesce(tx.col(text_col), F.lit("")).alias("text")), part_turns)
    first = F.min(F.struct(F.col("conv_id").isNull(), *_CONV)).alias("keep")
    whole = rows.where(~F.col("more")).groupBy(*_KEY).agg(first)
    kept = whole.join(rows.where("more").select(*_KEY).distinct(), _KEY, "left_anti").select(
        *[F.col(f"keep.{c}").alias(f"b_{c}") for c in _CONV])
    chosen = rows.join(kept, _same(), "left_semi")
    in_order = F.sort_array(F.collect_list(F.struct("place", "role", "text")))
    return chosen.groupBy(*_CONV, "part").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(in_order, lambda t: render_turn(t["role"], t["text"])), "").alias("text")).drop("o1", "o2")


#: The same rows by whole prefix strings.
SQL = """
WITH d AS (
  SELECT DISTINCT conv_id, CASE WHEN conv_id IS NULL THEN NULL ELSE turn END AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text FROM conversations),
k AS (SELECT *, CASE WHEN conv_id IS NULL THEN 'turn ' || role || chr(1) || text ELSE 'id ' || conv_id END AS conv FROM d),
t AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS rn FROM k),
p AS (
  SELECT conv, conv_id, rn, count(*) OVER (PARTITION BY conv) AS n,
         string_agg(role || chr(1) || text, chr(2)) OVER (PARTITION BY conv ORDER BY rn) AS prefix
  FROM t),
ended AS (SELECT arg_min(conv, (conv_id IS NULL, conv_id)) AS conv, prefix FROM p WHERE rn = n GROUP BY prefix),
kept AS (SELECT conv FROM ended e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.rn < p.n AND p.prefix = e.prefix))
SELECT conv_id, (rn - 1) // 4096 AS part, count(*) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY rn) AS text
FROM t WHERE conv IN (SELECT conv FROM kept) GROUP BY conv, conv_id, (rn - 1) // 4096
"""
