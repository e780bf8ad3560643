"""Machine-dimension cleaning functions as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region names recognised before the generic "…省" rule, tested
# in this order (municipalities and autonomous regions carry no 省 suffix).
SPECIAL_PROVINCES = [
    "北京市", "上海市", "天津市", "广西壮族自治区", "宁夏回族自治区",
    "新疆维吾尔自治区", "内蒙古自治区", "重庆市",
]
PROVINCE_SUFFIX = "省"
AREA_SEPARATOR = "_"
EPOCH_COMPACT = "19700101000000"
NULL_TEXT = "null"


def province(address: Column) -> Column:
    """Province of a Chinese postal address.

    The first special region contained in the address, in list order; else the
    prefix up to and including the first 省 (``""`` when there is none).
    NULL or empty address -> ``""``.
    """
    generic = F.substring(address, F.lit(1), F.instr(address, PROVINCE_SUFFIX))
    expr = generic
    for name in reversed(SPECIAL_PROVINCES):
        expr = F.when(F.instr(address, name) > 0, F.lit(name)).otherwise(expr)
    return F.when(address.isNull() | (address == ""), F.lit("")).otherwise(expr)


def city(address: Column, real_address: Column) -> Column:
    """City part of ``address``: the text between the province and the area.

    The area is ``real_address`` up to the first ``_`` (or all of it).  With
    the ``_`` form an empty result falls back to the area itself.  When the
    area is missing from the address or precedes the province end, the result
    is ``""`` (``area`` for the ``_`` form) instead of an error.
    """
    prov = province(address)
    has_sep = F.instr(real_address, AREA_SEPARATOR) > 0
    area = F.when(has_sep, F.substring_index(real_address, AREA_SEPARATOR, 1)).otherwise(real_address)
    start = F.length(prov) + 1
    area_pos = F.instr(address, area)
    length = area_pos - start
    between = F.when((area_pos > 0) & (length > 0),
                     F.substring(address, start, length)).otherwise(F.lit(""))
    with_fallback = F.when(has_sep & (between == ""), area).otherwise(between)
    empty_address = address.isNull() | (address == "")
    return F.when(empty_address, F.lit("")).otherwise(with_fallback)


def compact_time(s: Column) -> Column:
    """``'null'`` -> 19700101000000; 8 characters -> append 000000; else as is."""
    return (F.when(s == NULL_TEXT, F.lit(EPOCH_COMPACT))
            .when(F.length(s) == 8, F.concat(s, F.lit("000000")))
            .otherwise(s))


def product_name(product_type: Column) -> Column:
    """``'1'`` -> MiniK; anything else, NULL included -> Kshow."""
    return F.when(product_type == "1", F.lit("MiniK")).otherwise(F.lit("Kshow"))
