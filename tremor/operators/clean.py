"""Cleaning and classification operators.

All of them are narrow transformations: native expressions plus broadcast
joins against fixed-size lookup tables, so the whole chain runs inside one
whole-stage-codegen pipeline per scan partition with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.functions import fixed_values as fv
from tremor.functions import lookups
from tremor.functions.numeric import distance_km, to_int_half_even
from tremor.session import broadcast_budget, measured_bytes
from tremor.functions.place import place_parts, place_pieces, strip_ws

RENAMES = {
    "id": "earthquake_id",
    "direction": "offset_direction",
    "distance": "offset_distance",
    "nearest": "nearest_locality",
}


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any column of ``subset`` (default all)."""
    return df.na.drop(how="any", subset=subset)


def parse_place(df: DataFrame, col: str = "place") -> DataFrame:
    """Add ``distance, direction, nearest, state`` parsed from ``col``.

    The parts are produced by a one-row generator (``inline`` of a
    one-element array).  Catalyst substitutes a projected expression into
    every filter and join key that uses it, which would re-run the regular
    expression for each use; a predicate on generator output cannot be
    pushed below the generator, so the parse runs exactly once per row.
    """
    staged = df.withColumn("_ps", strip_ws(F.col(col))) \
               .withColumn("_pp", place_pieces(F.col("_ps")))
    parts = place_parts(F.col("_ps"), F.col("_pp"))
    parts["nearest"] = F.coalesce(parts["nearest"], F.col(col))
    return with_computed(staged, parts).drop("_ps", "_pp")


def with_computed(df: DataFrame, cols: dict) -> DataFrame:
    """Append expensive columns computed once per row (see ``parse_place``)."""
    packed = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select(*[F.col(c) for c in df.columns if c not in cols],
                     F.inline(F.array(packed)))


def _lookup(own: DataFrame | None, fixed, key: str) -> DataFrame:
    """A lookup table to join: the fixed list, or a caller's table after two checks.

    A caller's table must hold every key once (else rows would multiply), and
    is broadcast only within the broadcast budget.
    """
    if own is None:
        return F.broadcast(fixed())
    twice = [r[key] for r in own.groupBy(key).count().where("count > 1").limit(3).collect()]
    if twice:
        raise ValueError(f"lookup table repeats {key}: {twice}")
    small = measured_bytes(own) <= broadcast_budget(own.sparkSession)
    return F.broadcast(own) if small else own


def expand_state(df: DataFrame, col: str = "state", complete: bool = False,
                 table: DataFrame | None = None) -> DataFrame:
    """Trim, then replace a known abbreviation by the state name.

    The lookup is case-sensitive; unknown values stay (trimmed); null stays null.
    ``table`` (``abbreviation, state_name``) replaces the fixed list.
    """
    abbr = _lookup(None if table is None else table.select("abbreviation", "state_name"),
                   lambda: lookups.abbreviations(df.sparkSession, complete), "abbreviation") \
        .select(F.col("abbreviation").alias("_abbr"), F.col("state_name").alias("_abbr_name"))
    trimmed = df.withColumn(col, strip_ws(F.col(col)))
    joined = trimmed.join(abbr, trimmed[col] == abbr["_abbr"], "left")
    return joined.withColumn(col, F.coalesce(F.col("_abbr_name"), F.col(col))) \
                 .drop("_abbr", "_abbr_name")


def classify_country(df: DataFrame, col: str = "state", complete: bool = False,
                     table: DataFrame | None = None) -> DataFrame:
    """Add ``country, continent``; null or unrecognised -> ``Unknown``.

    ``table`` (``state, country, continent``) replaces the fixed lists.
    """
    table = _lookup(None if table is None else table.select("state", "country", "continent"),
                    lambda: lookups.countries(df.sparkSession, complete), "state") \
        .select(F.col("state").alias("_cstate"), F.col("country").alias("_country"),
                F.col("continent").alias("_continent"))
    joined = df.join(table, strip_ws(df[col]) == table["_cstate"], "left")
    return (joined
            .withColumn("country", F.coalesce(F.col("_country"), F.lit(fv.UNKNOWN)))
            .withColumn("continent", F.coalesce(F.col("_continent"), F.lit(fv.UNKNOWN)))
            .drop("_cstate", "_country", "_continent"))


def rename_columns(df: DataFrame) -> DataFrame:
    """P5: reference column names."""
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; missing ones are ignored."""
    return df.drop(*cols)


def us_only(df: DataFrame) -> DataFrame:
    """Keep rows of a known continent, then of the United States."""
    return df.where(F.col("continent") != fv.UNKNOWN) \
             .where(F.col("country") == fv.UNITED_STATES)


def assign_region(df: DataFrame, col: str = "state", table: DataFrame | None = None) -> DataFrame:
    """Census region of the state; unmatched -> ``Non-US``.

    ``table`` (``state, region``) replaces the fixed region lists.
    """
    table = _lookup(None if table is None else table.select("state", "region"),
                    lambda: lookups.regions(df.sparkSession), "state") \
        .select(F.col("state").alias("_rstate"), F.col("region").alias("_region"))
    joined = df.join(table, df[col] == table["_rstate"], "left")
    return joined.withColumn("region", F.coalesce(F.col("_region"), F.lit(fv.NON_US))) \
                 .drop("_rstate", "_region")


def us_regions_only(df: DataFrame) -> DataFrame:
    """Drop ``Non-US`` rows (territories have no region and go here)."""
    return df.where(F.col("region") != fv.NON_US)


def clean_distance(df: DataFrame, col: str = "offset_distance", strict: bool = True) -> DataFrame:
    """P10: ``"10 km"`` -> ``10.0``."""
    return df.withColumn(col, distance_km(F.col(col), strict))


def split_distance_rejects(df: DataFrame, col: str = "offset_distance"
                           ) -> tuple[DataFrame, DataFrame]:
    """P10 without failing the job: ``(parsed rows, rejected rows)``.

    A distance whose text does not become a number after the " km" strip
    (for example ``"5 KM"``) goes to the reject table with its original
    text instead of failing the whole load.
    """
    parsed = df.withColumn("_d", distance_km(F.col(col), strict=False))
    good = parsed.where(F.col("_d").isNotNull()).withColumn(col, F.col("_d")).drop("_d")
    bad = parsed.where(F.col("_d").isNull() & F.col(col).isNotNull()).drop("_d")
    return good, bad


def half_even_ints(df: DataFrame, *cols: str) -> DataFrame:
    """Double -> int, rounding half to even."""
    return df.withColumns({c: to_int_half_even(F.col(c)) for c in cols})


def clean_and_transform(raw: DataFrame, complete: bool = False) -> DataFrame:
    """P1-P7 as the cleaning stage: raw events -> United States events.

    Output columns: raw columns without ``place`` (``id`` renamed), then
    ``offset_distance, offset_direction, nearest_locality, state, country,
    continent``.
    """
    df = drop_incomplete(raw)
    df = parse_place(df)
    # P1 again: the raw columns are complete already, so only the parsed
    # parts can be missing (nearest is never null after a parse).
    df = drop_incomplete(df, ["distance", "direction", "nearest", "state"])
    df = expand_state(df, complete=complete)
    df = classify_country(df, complete=complete)
    df = rename_columns(df)
    df = drop_columns(df, "place")
    return us_only(df)
