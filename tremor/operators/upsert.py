"""Insert-only loads.

The warehouse never updates: a row whose natural key already exists is
skipped (first write wins), new rows get fresh surrogate keys after the
largest existing one, and the table becomes ``existing UNION ALL new``.
Running the same load twice therefore adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.keys import assign_surrogate_keys, max_key
from tremor.session import broadcast_budget, measured_bytes


def new_rows(candidates: DataFrame, existing: DataFrame | None, key_cols: list[str],
             dedup: str = "distinct", broadcast_bytes: int | None = None) -> DataFrame:
    """Candidate rows whose key is not yet present.

    ``dedup="distinct"`` is ``SELECT DISTINCT`` over all candidate columns
    (A1); ``dedup="key"`` keeps one row per conflict target (A2), for tables
    whose other columns are functions of the key.

    A left anti join can only broadcast its right side, so a plain anti join
    of a small batch against a large table shuffles the whole table on every
    load.  When the batch's distinct keys are measured to be few bytes
    (``broadcast_bytes``, default the broadcast threshold), the existing
    keys are first reduced by a semi join against the *broadcast batch keys*
    (a scan, no shuffle of the table); the anti join then runs against that
    small remainder.
    """
    rows = candidates.distinct() if dedup == "distinct" else candidates.dropDuplicates(key_cols)
    if existing is None:
        return rows
    old_keys = restrict_to_batch(existing.select(*key_cols), rows, key_cols, broadcast_bytes)
    return rows.join(old_keys, on=key_cols, how="left_anti")


def restrict_to_batch(table: DataFrame, batch: DataFrame, key_cols: list[str],
                      broadcast_bytes: int | None = None) -> DataFrame:
    """Rows of a large ``table`` whose key occurs in ``batch``, found without
    shuffling the table when the batch's distinct keys are measured to be small.

    The bytes of the batch's distinct keys are summed (one job over the
    batch); within the budget they are broadcast and the table is only
    scanned (map-side semi join).  Otherwise the table is returned whole and
    the join that follows is a regular shuffle join.
    """
    limit = broadcast_bytes if broadcast_bytes is not None \
        else broadcast_budget(table.sparkSession)
    if limit <= 0:
        return table
    batch_keys = batch.select(*key_cols).distinct()
    if measured_bytes(batch_keys) > limit:
        return table
    return table.join(F.broadcast(batch_keys), on=key_cols, how="left_semi")


def insert_only(candidates: DataFrame, existing: DataFrame | None, key_cols: list[str],
                id_col: str | None = None, dedup: str = "distinct") -> tuple[DataFrame, DataFrame]:
    """Returns ``(table_after_insert, inserted_rows)``.

    With ``id_col`` the inserted rows get surrogate keys (W1) numbered after
    the existing maximum, in natural-key order.
    """
    fresh = new_rows(candidates, existing, key_cols, dedup)
    if id_col is not None:
        fresh = assign_surrogate_keys(fresh, key_cols, id_col, start=max_key(existing, id_col))
    if existing is None:
        return fresh, fresh
    return existing.unionByName(fresh.select(*existing.columns)), fresh
