"""Left joins on keys that a large share of the rows may have, or none at all.

``frequent_keys`` finds the keys that would fill more than a task's share of a
shuffle, from a sketch of bounded size (``approx_top_k``) in one pass over the
key column.  ``skewed_left_join`` keeps rows without a key out of the shuffle
(they match nothing), deals the rows of a frequent key over as many parts as
its share needs and repeats the other side's rows of that key for each part;
all other keys join as ever.  A missed or needless frequent key changes the
balance, never the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent keys looked for at most: more cannot hold a share of 1 in this many.
MAX_SHARES = 1000
#: Items the sketch tracks for each one looked for, and parts for each share (so that parts spread evenly).
_TRACKED, _PARTS = 16, 8


def frequent_keys(df: DataFrame, key: str, shares: int) -> dict:
    """Key -> estimated share, in units of 1/``shares``, of the keys with at least one unit."""
    shares = min(shares, MAX_SHARES)
    r = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {shares}, {shares * _TRACKED})").alias("top")).first()
    return {t["item"]: t["count"] * shares / r.n for t in r.top or [] if t["count"] * shares >= r.n}


def _parts(key: Column, frequent: dict) -> Column:
    if not frequent:
        return F.lit(1)
    pairs = [F.lit(x) for k, share in sorted(frequent.items()) for x in (k, max(1, round(share * _PARTS)))]
    known = F.create_map(*[c.cast("int") if i % 2 else c for i, c in enumerate(pairs)])
    return F.coalesce(F.try_element_at(known, key), F.lit(1))


def skewed_left_join(left: DataFrame, right: DataFrame, key: str, shares: int | None = None) -> DataFrame:
    """``left.join(right, key, "left")``, balanced whatever the share of one key or of NULL in ``left``.

    ``right`` may have any rows per key, but those of a frequent key are
    repeated for each of its parts, so it should be the side with few.
    ``shares``: tasks to balance over (default: the shuffle partitions).
    """
    spark, salt = left.sparkSession, "__salt"
    shares = shares or int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_keys(left, key, shares)
    keyed = left.where(F.col(key).isNotNull()).withColumn(
        salt, F.pmod(F.xxhash64(F.monotonically_increasing_id()), _parts(F.col(key), frequent)).cast("int"))
    dealt = right.where(F.col(key).isNotNull()).withColumn(
        salt, F.explode(F.sequence(F.lit(0), _parts(F.col(key), frequent) - 1)))
    others = [f for f in right.schema.fields if f.name != key]
    unkeyed = left.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others])
    joined = keyed.join(dealt, [key, salt], "left").drop(salt)
    return joined.select(*unkeyed.columns).unionByName(unkeyed)
