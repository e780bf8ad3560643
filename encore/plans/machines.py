"""Machine dimension: id universe, location repair, machine + admin + store join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import machines as M


def id_universe(mac: DataFrame, loc: DataFrame, admin: DataFrame) -> DataFrame:
    """Distinct machine ids seen in the machine, location and admin tables."""
    return (mac.select("mid")
            .union(loc.select("mid"))
            .union(admin.select(F.col("machine_num").alias("mid")))
            .distinct())


def repair_locations(loc: DataFrame, mode: str = "reference") -> DataFrame:
    """Locations with province/city derived from the address where either is
    the text ``'null'``; compact times normalised.

    Rows whose address is ``'null'`` or NULL are dropped.  ``reference``: a
    row with exactly one of province/city ``'null'`` is emitted twice, once
    repaired and once as is (the two overlapping filters, in one pass).
    ``intended``: repaired rows win, one row per input row.  Both read the
    location table once.
    """
    addr_ok = F.col("address") != M.NULL_TEXT
    needs = addr_ok & ((F.col("province") == M.NULL_TEXT) | (F.col("city") == M.NULL_TEXT))
    usable = addr_ok & ((F.col("province") != M.NULL_TEXT) | (F.col("city") != M.NULL_TEXT))
    times = {"revenue_time": M.compact_time(F.col("revenue_time")),
             "sale_time": M.compact_time(F.col("sale_time"))}
    repaired = {"province": M.province(F.col("address")),
                "city": M.city(F.col("address"), F.col("real_address")), **times}
    names = schemas.MAC_LOC.names
    if mode == "reference":
        # The two overlapping filters of the warehouse, in one pass: each row
        # yields its repaired form if it needs repair and its raw form if it
        # is usable (both when both hold).  Rows kept by the outer filter
        # satisfy at least one, so the filtered array is never empty.
        # The id stays outside the generator: a table bucketed by it stays bucketed.
        forms = F.array(
            F.struct(needs.alias("_keep"), *[repaired.get(n, F.col(n)).alias(n) for n in names if n != "mid"]),
            F.struct(usable.alias("_keep"), *[times.get(n, F.col(n)).alias(n) for n in names if n != "mid"]))
        return (loc.where(needs | usable)
                .select("mid", F.inline_outer(F.filter(forms, lambda x: x["_keep"])))
                .drop("_keep"))
    # One row per input row: repaired if it needs it, else as is when usable.
    fix = F.coalesce(needs, F.lit(False))
    cols = [F.when(fix, repaired[n]).otherwise(F.col(n)).alias(n) if n in ("province", "city")
            else times.get(n, F.col(n)).alias(n) for n in names]
    return loc.where(needs | usable).select(*cols)


def mac_with_location(loc_repaired: DataFrame, mac: DataFrame,
                      universe: DataFrame | None = None) -> DataFrame:
    """Repaired locations left-joined to machine info (24 columns).

    The warehouse first inner-joins the id universe; every location id is in
    that universe by construction (it is the union of the id columns), so the
    join only drops NULL ids.  Without ``universe`` we apply exactly that
    filter and skip the union, the distinct shuffle and one join.
    """
    if universe is None:
        left = loc_repaired.where(F.col("mid").isNotNull())
    else:
        left = universe.join(loc_repaired, "mid", "inner")
    return left.join(mac, "mid", "left").select(*schemas.MAC_LOC_JOINED.names)


def base_info(mac: DataFrame, loc: DataFrame, admin: DataFrame, store_map: DataFrame,
              store: DataFrame, mode: str = "reference") -> DataFrame:
    """The 30-column machine dimension.

    Inner chain: admin ⋈ store map ⋈ (location ⋈ info) on the machine id,
    then ⋈ store on the store id.  (The warehouse also joins the id universe, which only
    removes NULL ids -- see :func:`mac_with_location`.)  AQE chooses
    broadcast for whichever side is small at run time, sort-merge otherwise,
    and splits a hot store id on the large side.
    """
    ycak = mac_with_location(repair_locations(loc, mode), mac)
    adm = admin.withColumnRenamed("machine_num", "mid").where(F.col("mid").isNotNull())
    smap = store_map.withColumnRenamed("machine_num", "mid")
    st = store.withColumnRenamed("id", "store_id")
    h = ycak.select("mid", "hard_id", "song_warehouse_version", "exec_version", "ui_version",
                    "revenue_time", "sale_time", "province", "city", "address", "real_address",
                    "current_login_time")
    # Both joins on the machine id first (one partitioning), the store last.
    j = adm.join(smap, "mid").join(h, "mid").join(st, "store_id")
    j = j.withColumn("product_name", M.product_name(F.col("product_type")))
    return j.select(*schemas.MACHINE_BASE.names)
