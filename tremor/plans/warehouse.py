"""Warehouse loads: staging -> 3NF store (W3-W7) -> star schema.

Every load is insert-only (``tremor.operators.upsert``).  An insert writes its
new rows as one more folder of its table; what a batch wrote becomes visible
all at once, when the batch's *manifest* is published as its last step.  A
manifest names, for every table, the folders that count, the stored schema and
the highest surrogate key.  Readers open only what the last manifest names,
so a batch that dies half-way leaves nothing behind that anyone reads: its
folders are written over when the batch is run again.

Events are stored by event month, and ``event_month`` (U2's index) knows the
month of every stored id.  A batch therefore scans the ids of that index, and
of the event tables only the months that hold its ids.

Join strategy: dimension tables that grow with the events (location,
time) are never forced into a broadcast; AQE converts a join to a broadcast
at runtime only when the measured side is small.  For the star fact, the
location mapping is resolved at dimension granularity first (location ->
location_dim key), so the fact is shuffled once per large dimension instead
of once per join in the reference's chain.
"""

from __future__ import annotations

import json
import re
import threading
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from copy import deepcopy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor import schemas as S
from tremor.functions.numeric import to_int_half_even
from tremor.operators.keys import number_keys
from tremor.operators.upsert import new_rows, restrict_to_batch
from tremor.operators.validate import require_not_null
from tremor.plans.pipeline import STAGING_ORDER, first_per_key
from tremor.session import (UNMARKED, drop_folder, list_names, publish_text, read_text, release,
                            scratch_path)


# Tables stored in (event year, event month) folders, so a batch reads the
# months it needs instead of the history.  Table -> timestamp column the month
# comes from; a column with a leading underscore is not stored.
MONTH_PARTITIONED = {"staging_events": "time", "earthquake": "time", "earthquake_fact": "_time"}
MONTH = ["event_year", "event_month"]

Months = list[tuple[int, int]]


class Warehouse:
    """A set of published tables under one root folder.

    ``<root>/<table>/batch=NNNNN/`` holds the rows of one insert,
    ``<root>/_manifest/NNNNN.json`` what batch NNNNN left as the state of all
    tables.  The layout on storage is the whole state, so a restarted job (or
    the streaming refresh) re-opens a warehouse from its root alone.  One
    writer at a time: a second one fails when it publishes its manifest.

    ``parallel`` dimensions are loaded at once.  Each keeps its plan, its
    adaptive copies and its tasks' results on the driver meanwhile, so one by
    one is the default; a driver with memory to spare may overlap them.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, parallel: int = 1):
        self.spark = spark
        self.root = (root or scratch_path(spark, "warehouse")).rstrip("/")
        self.parallel = max(int(parallel), 1)
        self._open: dict | None = None          # state of the batch being written
        self._known: tuple[str, dict] | None = None
        self._lock = threading.Lock()

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "Warehouse":
        return cls(spark, root)

    # -- state -----------------------------------------------------------------
    def _committed(self) -> dict:
        """State that the last published manifest describes."""
        names = sorted(n for n in list_names(self.spark, f"{self.root}/_manifest")
                       if re.fullmatch(r"\d+\.json", n))
        if not names:
            return {"batch": -1, "next": 0, "tables": {}}
        if self._known is None or self._known[0] != names[-1]:
            text = read_text(self.spark, f"{self.root}/_manifest/{names[-1]}")
            self._known = (names[-1], json.loads(text))
        return self._known[1]

    def _state(self) -> dict:
        return self._open if self._open is not None else self._committed()

    @contextmanager
    def batch(self):
        """Everything appended inside becomes visible together, at the end.

        Inside, this object sees what it has appended.  After an error the
        tables are what they were; batches nest, the outermost one publishes.
        """
        if self._open is not None:
            yield self
            return
        self._open = deepcopy(self._committed())
        self._open["batch"] += 1
        try:
            yield self
            publish_text(self.spark, f"{self.root}/_manifest/{self._open['batch']:05d}.json",
                         json.dumps(self._open))
        finally:
            self._open = None

    def has(self, name: str) -> bool:
        return name in self._state()["tables"]

    def highest_key(self, name: str) -> int:
        """Highest surrogate key of a dimension (0 before its first load)."""
        return self._state()["tables"].get(name, {}).get("highest", 0)

    def table(self, name: str, months: Months | None = None, with_month: bool = False) -> DataFrame:
        """Current contents of table ``name``.

        ``months`` reads only those (year, month) folders of a table of
        ``MONTH_PARTITIONED`` (partition pruning on the folder names, no other
        files are opened); ``with_month`` keeps ``event_year, event_month``.
        """
        entry = self._state()["tables"].get(name)
        if entry is None:
            raise KeyError(f"table {name} has not been loaded")
        return self._read(name, entry["folders"], months, with_month)

    def _read(self, name: str, folders: list[int], months: Months | None = None,
              with_month: bool = False) -> DataFrame:
        schema = T.StructType.fromJson(self._state()["tables"][name]["schema"])
        df = (self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
              .parquet(*[f"{self.root}/{name}/batch={n:05d}" for n in folders]))
        if months is not None and name in MONTH_PARTITIONED:
            by_year: dict[int, list[int]] = {}
            for y, m in months:
                by_year.setdefault(y, []).append(m)
            cond = F.lit(False)
            for y, ms in by_year.items():
                cond = cond | ((F.col(MONTH[0]) == y) & F.col(MONTH[1]).isin(ms))
            df = df.where(cond)
        return df.drop("batch") if with_month else df.drop("batch", *MONTH)

    def get(self, name: str, months: Months | None = None) -> DataFrame | None:
        return self.table(name, months) if self.has(name) else None

    def append(self, name: str, rows: DataFrame, highest: int | None = None) -> DataFrame:
        """Write ``rows`` as a new folder of table ``name``; returns those rows as stored."""
        with self.batch():
            state = self._state()
            entry = state["tables"].get(name)
            if name in MONTH_PARTITIONED:
                ts = MONTH_PARTITIONED[name]
                rows = rows.withColumns({MONTH[0]: F.year(ts), MONTH[1]: F.month(ts)})
                rows = rows.drop(ts) if ts.startswith("_") else rows
            if entry is None:
                fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]
                schema = T.StructType([*fields, T.StructField("batch", T.IntegerType())])
                entry = {"folders": [], "schema": schema.jsonValue()}
            rows = rows.select(*[f["name"] for f in entry["schema"]["fields"] if f["name"] != "batch"])
            with self._lock:
                number = state["next"]
                state["next"] += 1
            # No manifest names this folder yet: what a dead batch left in it goes.
            path = f"{self.root}/{name}/batch={number:05d}"
            if name in MONTH_PARTITIONED:
                # rebalance: cluster rows by month so each month folder gets few
                # files; AQE splits a month that is too large (a hot month) and
                # merges small ones.
                rows.hint("rebalance", *MONTH) \
                    .write.options(**UNMARKED).mode("overwrite").partitionBy(*MONTH).parquet(path)
            else:
                rows.write.options(**UNMARKED).mode("overwrite").parquet(path)
            with self._lock:
                entry["folders"].append(number)
                if highest is not None:
                    entry["highest"] = highest
                state["tables"][name] = entry
            return self._read(name, [number])

    def _months_of(self, rows: DataFrame, *cols) -> Months:
        """Distinct (year, month) of ``rows``: as many as the calendar has, not as the data has."""
        return sorted({(r[0], r[1]) for r in rows.select(*cols).distinct().collect()
                       if r[0] is not None})

    # -- loads -----------------------------------------------------------------
    def _load_dimensions(self, loads: list[tuple]) -> None:
        """Load independent dimensions, ``parallel`` of them at once.

        Each load is its own chain of jobs over different tables; submitting
        them from a few driver threads lets the scheduler overlap them
        instead of leaving the cluster idle between small jobs, and costs the
        driver the memory of all of them together.
        """
        if self.parallel == 1 or len(loads) == 1:
            for args in loads:
                self._load_dimension(*args)
            return
        with ThreadPoolExecutor(max_workers=min(self.parallel, len(loads))) as pool:
            for fut in [pool.submit(self._load_dimension, *args) for args in loads]:
                fut.result()

    def _load_dimension(self, name: str, candidates: DataFrame, dedup: str = "distinct",
                        derive=None) -> None:
        id_col, key = S.KEYS[name]
        fresh = new_rows(candidates, self.get(name), key, dedup)
        keyed, highest = number_keys(fresh, key, id_col, start=self.highest_key(name))
        if derive is not None:
            keyed = derive(keyed)
        self.append(name, keyed, highest)

    def _load_facts(self, name: str, rows: DataFrame, build, months: Months | None = None) -> None:
        """Insert what ``build`` joins to the events of ``rows`` that ``name`` does not hold.

        Stored events are taken off by their ids before the joins.  Their keys
        are then measured without the joins, which run once, and the driver
        holds the plan of the joins once.
        """
        stored = self.get(name, months)
        if stored is not None:
            ids = restrict_to_batch(stored.select("earthquake_id"), rows, ["earthquake_id"])
            rows = rows.join(ids, "earthquake_id", "left_anti")
        self.append(name, build(rows).dropDuplicates(["earthquake_id"]))
        release(self.spark)

    @contextmanager
    def _written(self, rows: DataFrame):
        """``rows`` written once to the shared folder, which goes at the end.

        Whatever reads them inside holds a scan in its plan, not their joins.
        """
        path = scratch_path(self.spark, "batch")
        try:
            rows.write.options(**UNMARKED).parquet(path)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            drop_folder(self.spark, path)

    # -- staging ---------------------------------------------------------------
    def load_staging(self, staging: DataFrame) -> None:
        """Append new staging rows (insert-only on ``earthquake_id``).

        Of rows that repeat an id in one batch the first in ``STAGING_ORDER`` is
        taken, however the batch is partitioned.  Which ids are stored is read
        from the index, not from the staging table.
        """
        first = first_per_key(staging, ["earthquake_id"], STAGING_ORDER)
        with self.batch():
            fresh = new_rows(first, self.get("event_month"), ["earthquake_id"], dedup="key")
            self.append("staging_events", fresh)
            number = self._state()["tables"]["staging_events"]["folders"][-1]
            stored = self._read("staging_events", [number], with_month=True)
            self.append("event_month", stored.select("earthquake_id", *[
                F.col(c).alias(f"stored_{c}") for c in MONTH]))
        release(self.spark)

    def stored_months(self, rows: DataFrame) -> Months:
        """Months that hold the staged events whose ids are in ``rows``."""
        hits = restrict_to_batch(self.table("event_month"), rows, ["earthquake_id"])
        hits = hits.join(rows.select("earthquake_id"), "earthquake_id", "left_semi")
        return self._months_of(hits, *[f"stored_{c}" for c in MONTH])

    def staged(self, rows: DataFrame, months: Months) -> DataFrame:
        """The staged version of the events whose ids are in ``rows``."""
        return self.table("staging_events", months=months).join(
            rows.select("earthquake_id").distinct(), "earthquake_id", "left_semi")

    def first_staged(self) -> DataFrame:
        """``staged`` of a first batch: every stored event with an id and a month."""
        return self.table("staging_events").where(
            F.col("earthquake_id").isNotNull() & F.col("time").isNotNull())

    # -- 3NF -------------------------------------------------------------------
    def load_reconciled(self, staging: DataFrame | None = None, validate: bool = True,
                        months: Months | None = None) -> DataFrame:
        """W3-W7 from a staging batch (default: the published staging table).

        ``months`` are the months that hold the batch's events (default: any).
        Returns the 3NF event rows of that batch (for a star load of just
        this batch).
        """
        with self.batch():
            stg = staging if staging is not None else self.table("staging_events")
            if validate:
                require_not_null(stg, S.FINAL_COLUMNS)
            # On the first load every row is new: none of the incremental
            # narrowing below (each costs a small job) could reduce anything.
            incremental = self.has("earthquake")
            self._load_dimensions([("location", location_rows(stg)),
                                   ("magnitude_detail", magnitude_detail_rows(stg)),
                                   ("seismic_metrics", seismic_metrics_rows(stg)),
                                   ("data_source", data_source_rows(stg))])
            release(self.spark)
            # A monthly batch touches few locations: find them with a scan of the
            # location table instead of shuffling all of it into the join.
            location = self.table("location")
            if incremental:
                location = restrict_to_batch(location, location_rows(stg), S.LOCATION_KEY)
            dims = (location, self.table("magnitude_detail"),
                    self.table("seismic_metrics"), self.table("data_source"))
            self._load_facts("earthquake", stg, lambda new: earthquake_rows(new, *dims), months)
            if not incremental:
                return self.table("earthquake")
            # The batch's stored events, from its months only.  An event that a
            # caller hands over under another month (a revised time) was
            # star-loaded when it was first inserted.
            if months is None:
                months = self._months_of(stg, F.year("time"), F.month("time"))
            return self.table("earthquake", months=months).join(
                stg.select("earthquake_id"), "earthquake_id", "left_semi")

    # -- star ------------------------------------------------------------------
    def load_star(self, events: DataFrame | None = None, months: Months | None = None) -> None:
        """W8-W13 from the 3NF tables.

        With ``events`` (3NF event rows of one batch, of ``months``) the
        dimension candidates are limited to what those events reference, so a
        monthly batch reads the 3NF dimensions with a semi join instead of
        loading every row as a candidate.  On top of stored facts those rows
        are written once for the loads to read: each reads them several times.
        """
        with self.batch():
            if events is not None and self.has("earthquake_fact"):
                with self._written(events) as eq:
                    self._load_star(eq, eq, months)
            else:
                self._load_star(events if events is not None else self.table("earthquake"),
                                events, months)

    def _load_star(self, eq: DataFrame, events: DataFrame | None, months: Months | None) -> None:
        with self.batch():
            loc = all_loc = self.table("location")
            mag = all_mag = self.table("magnitude_detail")
            src = all_src = self.table("data_source")
            if events is not None:
                loc = loc.join(eq.select("location_id"), "location_id", "left_semi")
                mag = mag.join(eq.select("magnitude_detail_id"), "magnitude_detail_id", "left_semi")
                src = src.join(eq.select("data_source_id"), "data_source_id", "left_semi")
            incremental = self.has("earthquake_fact")
            self._load_dimensions([
                ("time_dim", time_dim_rows(eq), "key", with_calendar),
                ("location_dim", loc.select(*S.LOCATION_DIM_KEY)),
                ("magnitude_type_dim", mag.select(*S.MAGNITUDE_TYPE_DIM_KEY)),
                ("data_source_dim", src.select(*S.DATA_SOURCE_DIM_KEY)),
                ("status_dim", eq.select(*S.STATUS_DIM_KEY))])
            release(self.spark)
            time_dim, location_dim = self.table("time_dim"), self.table("location_dim")
            if events is not None and incremental:
                time_dim = restrict_to_batch(time_dim, time_dim_rows(eq), S.TIME_DIM_KEY)
                location_dim = restrict_to_batch(location_dim, loc.select(*S.LOCATION_DIM_KEY),
                                                 S.LOCATION_DIM_KEY)
            else:
                # The facts join these on the events' keys: on a first load the
                # narrowing would only scan the events three more times.
                loc, mag, src = all_loc, all_mag, all_src
            dims = (loc, mag, src, time_dim, location_dim, self.table("magnitude_type_dim"),
                    self.table("data_source_dim"), self.table("status_dim"))
            self._load_facts("earthquake_fact", eq, lambda new: star_fact_rows(new, *dims), months)

    def load_batch(self, staging: DataFrame, star: bool = True) -> "Warehouse":
        """One batch end to end: staging -> 3NF -> star, insert-only, visible as a whole.

        A batch on top of stored ones is checkpointed first (shared checkpoint
        folder): the loads below read it several times, and the checkpoint
        survives executor loss.  The 3NF load reads the batch's ids back from
        the stored staging rows, so a revised event keeps its first version in
        every layer.  After a first batch these are all stored rows: it is read
        once, and no join looks them up.  A batch that failed half-way is
        simply run again.
        """
        first = not self._state()["tables"]
        stg = staging if first else staging.checkpoint(eager=True)
        with self.batch():
            self.load_staging(stg)
            months = None if first else self.stored_months(stg)
            events = self.load_reconciled(
                self.first_staged() if first else self.staged(stg, months), months=months)
            if star:
                self.load_star(events, months)
        return self

    def load_all(self, staging: DataFrame) -> "Warehouse":
        """Alias of ``load_batch`` for a first, complete load."""
        return self.load_batch(staging)


# --- row builders (pure projections / joins) ----------------------------------

def location_rows(stg: DataFrame) -> DataFrame:
    """W3 candidates: the 10-column location natural key."""
    return stg.select(
        F.col("offset_distance").cast("double").alias("offset_distance"),
        "offset_direction", "nearest_locality", "state", "county", "region",
        "latitude", "longitude",
        F.col("horizontalError").alias("horizontal_error"),
        F.col("depthError").alias("depth_error"))


def magnitude_detail_rows(stg: DataFrame) -> DataFrame:
    """W4 candidates: magnitude type, error and station count (half-even int)."""
    return stg.select(F.col("magType").alias("mag_type"),
                      F.col("magError").alias("mag_error"),
                      to_int_half_even(F.col("magNst")).alias("mag_nst"))


def seismic_metrics_rows(stg: DataFrame) -> DataFrame:
    """W5 candidates."""
    return stg.select(to_int_half_even(F.col("nst")).alias("nst"), "gap", "dmin", "rms")


def data_source_rows(stg: DataFrame) -> DataFrame:
    """W6 candidates."""
    return stg.select("net", F.col("locationSource").alias("location_source"),
                      F.col("magSource").alias("mag_source"))


def earthquake_rows(stg: DataFrame, location: DataFrame, magnitude: DataFrame,
                    seismic: DataFrame, source: DataFrame) -> DataFrame:
    """W7 + C3: staging joined to the four 3NF tables on their natural keys.

    Keys are unique in each table, so every join is 1:1 and the fact keeps
    exactly the staging rows.
    """
    s = stg.select(
        "earthquake_id", "time", "updated", "status", "type",
        F.col("mag").alias("magnitude"), "depth",
        F.col("offset_distance").cast("double").alias("offset_distance"),
        "offset_direction", "nearest_locality", "state", "county", "region",
        "latitude", "longitude",
        F.col("horizontalError").alias("horizontal_error"),
        F.col("depthError").alias("depth_error"),
        F.col("magType").alias("mag_type"), F.col("magError").alias("mag_error"),
        to_int_half_even(F.col("magNst")).alias("mag_nst"),
        to_int_half_even(F.col("nst")).alias("m_nst"), "gap", "dmin", "rms",
        "net", F.col("locationSource").alias("location_source"),
        F.col("magSource").alias("mag_source"))
    j = s.join(location, S.LOCATION_KEY)
    j = j.join(magnitude, S.MAGNITUDE_DETAIL_KEY)
    j = j.join(seismic.withColumnRenamed("nst", "m_nst"), ["m_nst", "gap", "dmin", "rms"])
    j = j.join(source, S.DATA_SOURCE_KEY)
    return j.select(*S.EARTHQUAKE_COLUMNS)


def time_dim_rows(eq: DataFrame) -> DataFrame:
    """W8 candidates: event timestamps (deduplicated on the conflict target)."""
    return eq.select(F.col("time").alias("full_timestamp"))


def with_calendar(time_keys: DataFrame) -> DataFrame:
    """Calendar parts of ``full_timestamp`` (session time zone: UTC)."""
    ts = F.col("full_timestamp")
    return time_keys.select("time_id", "full_timestamp",
                            F.year(ts).alias("year"), F.quarter(ts).alias("quarter"),
                            F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"))


def star_fact_rows(eq: DataFrame, location: DataFrame, magnitude: DataFrame,
                   source: DataFrame, time_dim: DataFrame, location_dim: DataFrame,
                   magnitude_type_dim: DataFrame, data_source_dim: DataFrame,
                   status_dim: DataFrame) -> DataFrame:
    """W13 + C4 + C5: 3NF facts -> star facts.

    Mappings from 3NF keys to star keys are built at dimension size
    (location x location_dim, magnitude_detail x magnitude_type_dim,
    data_source x data_source_dim); the fact then joins each mapping on a
    single integer key.
    """
    loc_map = (location.select("location_id", *S.LOCATION_DIM_KEY)
               .join(location_dim.withColumnRenamed("location_id", "star_location_id"),
                     S.LOCATION_DIM_KEY)
               .select("location_id", "star_location_id"))
    mag_map = (magnitude.select("magnitude_detail_id", "mag_type")
               .join(magnitude_type_dim, "mag_type")
               .select("magnitude_detail_id", "magnitude_type_id"))
    src_map = (source.select("data_source_id", *S.DATA_SOURCE_DIM_KEY)
               .join(data_source_dim.withColumnRenamed("data_source_id", "star_source_id"),
                     S.DATA_SOURCE_DIM_KEY)
               .select("data_source_id", "star_source_id"))
    f = eq.select("earthquake_id", "time", "status", "type", "magnitude", "depth",
                  "location_id", "magnitude_detail_id", "data_source_id")
    f = f.join(loc_map, "location_id")
    f = f.join(mag_map, "magnitude_detail_id")
    f = f.join(src_map, "data_source_id")
    f = f.join(time_dim.select("time_id", F.col("full_timestamp").alias("time")), "time")
    f = f.join(status_dim, S.STATUS_DIM_KEY)
    return f.select(F.col("time").alias("_time"), "earthquake_id", "time_id",
                    F.col("star_location_id").alias("location_id"),
                    "magnitude_type_id",
                    F.col("star_source_id").alias("data_source_id"),
                    "status_id", "magnitude", "depth")
