"""Small fixed lookup tables as DataFrames.

Each table has a fixed, tiny size (at most a few dozen rows), so joining
them with ``F.broadcast`` is safe at any event volume: the size bound comes
from the fixed lists, not from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tremor.functions import fixed_values as fv
from tremor.functions.tables import local_table

_S = "string"


def abbreviations(spark: SparkSession, complete: bool = False) -> DataFrame:
    """``(abbreviation, state_name)``; 49 rows, 50 with ``complete``."""
    table = fv.COMPLETE_ABBREVIATIONS if complete else fv.STATE_ABBREVIATIONS
    return local_table(spark, list(table.items()), [("abbreviation", _S), ("state_name", _S)])


def countries(spark: SparkSession, complete: bool = False) -> DataFrame:
    """``(state, country, continent)`` for every recognised US state/territory."""
    states = fv.COMPLETE_US_STATES if complete else fv.US_STATES
    rows = [(s, fv.UNITED_STATES, fv.NORTH_AMERICA)
            for s in list(states) + list(fv.US_TERRITORIES)]
    return local_table(spark, rows, [("state", _S), ("country", _S), ("continent", _S)])


def regions(spark: SparkSession) -> DataFrame:
    """``(state, region)``; 50 rows."""
    rows = [(state, region) for region, states in fv.US_REGIONS.items()
            for state in states]
    return local_table(spark, rows, [("state", _S), ("region", _S)])
