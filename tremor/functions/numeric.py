"""Numeric conversions with the warehouse's exact semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.functions.place import WHITESPACE_CLASS

# FIXED VALUES — the distance unit suffix removed before the numeric cast
# (case-sensitive: "5 KM" keeps its suffix and fails the cast).
_KM_SUFFIX = rf"{WHITESPACE_CLASS}*km"


def distance_km(col: Column, strict: bool = True) -> Column:
    """``"10 km"`` -> ``10.0``.

    Every ``<whitespace>km`` is removed and the rest is cast to double.  With
    ``strict`` an unparsable value fails the job (ANSI cast), as a float
    conversion would; otherwise it becomes null so it can be routed to a
    reject table.
    """
    stripped = F.regexp_replace(col, _KM_SUFFIX, "")
    if strict:
        return stripped.cast("double")
    return stripped.try_cast("double")


def to_int_half_even(col: Column) -> Column:
    """Double -> integer rounding half to even (2.5 -> 2, 3.5 -> 4).

    A plain cast truncates (2.7 -> 2), which is not how the warehouse
    converts measured counts.
    """
    return F.rint(col).cast("int")
