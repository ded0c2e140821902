"""Command-line jobs (``spark-submit -m``-style entry points).

``run``      raw monthly CSV files + county polygons -> transformed / county /
             final stage outputs -> warehouse (staging, 3NF, star); prints the
             row count of each written stage and the region / state / county
             summary.
``profile``  dataset profile, category top lists and the 80-row sample of a
             final dataset; writes the sample as one CSV file.
``olap``     the published OLAP queries over a warehouse.
``refresh``  start the streaming monthly refresh over a folder of CSV drops.

Every result printed is a small aggregate (one JSON object per line); the
data itself stays in Spark and is written to the output folders.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from tremor.operators import olap, profile, spatial
from tremor.plans import pipeline
from tremor.plans.warehouse import Warehouse
from tremor.session import build_session, ensure_checkpoint_dir
from tremor.sources import counties as cty
from tremor.sources import events as ev


def _emit(kind: str, payload) -> None:
    print(json.dumps({"kind": kind, "data": payload}, default=str), flush=True)


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def read_counties(spark: SparkSession, path: str) -> DataFrame:
    """County polygons from GeoJSON (``.json``/``.geojson``), line-delimited
    GeoJSON (``.geojsonl``/``.geojsons``/``.ndjson``) or an edge table (parquet)."""
    if path.endswith((".json", ".geojson")):
        return cty.read_geojson(spark, path)
    if path.endswith((".geojsonl", ".geojsons", ".ndjson")):
        return cty.read_geojson(spark, path, line_delimited=True)
    return cty.read_edges(spark, path)


def cmd_run(spark: SparkSession, args) -> None:
    raw = ev.read_events_csv(spark, args.events)
    lo = f"{args.first_year}-01-01" if args.first_year else None
    hi = f"{args.last_year + 1}-01-01" if args.last_year else None
    raw = ev.source_filter(raw, lo, hi, args.min_magnitude, sort=False)
    edges = read_counties(spark, args.counties)
    cell_size = (spatial.suggest_cell_size(edges) if args.cell_size == "auto"
                 else float(args.cell_size))
    _emit("cell_size", cell_size)
    out = args.out.rstrip("/")
    transformed = pipeline.transformed_events(raw, complete=args.complete_states)
    ev.write_stage(transformed, f"{out}/transformed")
    with_county = pipeline.events_with_county(ev.read_stage(spark, f"{out}/transformed"), edges,
                                              cell_size=cell_size)
    ev.write_stage(with_county, f"{out}/with_county")
    final = pipeline.finalize(ev.read_stage(spark, f"{out}/with_county"))
    ev.write_stage(final, f"{out}/final")
    final = ev.read_stage(spark, f"{out}/final")
    # Row counts of written parquet stages come from file metadata.
    _emit("stage_rows", {name: ev.read_stage(spark, f"{out}/{name}").count()
                         for name in ("transformed", "with_county", "final")})
    _emit("region_counts", _rows(profile.value_counts(final, "region")))
    _emit("top_states", _rows(profile.value_counts(final, "state", 10)))
    _emit("top_counties", _rows(profile.value_counts(final, "county", 10)))
    if args.warehouse:
        wh = Warehouse(spark, args.warehouse).load_batch(pipeline.staging_from_final(final))
        _emit("warehouse", {t: wh.table(t).count() for t in
                            ("staging_events", "earthquake", "earthquake_fact")})


def cmd_profile(spark: SparkSession, args) -> None:
    final = ev.read_stage(spark, args.final)
    _emit("profile", _rows(profile.profile(final))[0])
    counts = profile.category_counts(final)
    _emit("top_values", _rows(profile.top_k(counts, 10).orderBy("dimension", "rank")))
    _emit("yearly_counts", _rows(profile.yearly_counts(final)))
    sample = profile.sample_rows(final, args.sample_size)
    if args.sample_out:
        ev.write_sample(sample, args.sample_out)
    _emit("sample_head", [r["record"] for r in
                          profile.to_json_records(profile.sample_head(sample, 6)).collect()])


def cmd_olap(spark: SparkSession, args) -> None:
    wh = Warehouse.open(spark, args.warehouse)
    fact = wh.table("earthquake_fact", with_month=True)
    loc, tim = wh.table("location_dim"), wh.table("time_dim")
    _emit("top_states", _rows(olap.top_states(fact, loc)))
    _emit("monthly_trend", _rows(olap.monthly_trend(fact, tim)))
    _emit("region_activity", _rows(olap.region_activity(fact, loc, tim, args.min_year)))


def cmd_refresh(spark: SparkSession, args) -> None:
    from tremor.streaming.refresh import start_refresh
    q = start_refresh(spark, args.events, args.warehouse, read_counties(spark, args.counties),
                      args.stream_checkpoint, available_now=not args.continuous,
                      processing_time=args.every)
    q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tremor")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="raw CSV months -> stage outputs -> warehouse")
    r.add_argument("--events", required=True, help="folder of monthly CSV files")
    r.add_argument("--counties", required=True, help="GeoJSON or parquet edge table")
    r.add_argument("--out", required=True, help="folder for stage outputs")
    r.add_argument("--warehouse", help="warehouse root (omit to skip the load)")
    r.add_argument("--first-year", type=int)
    r.add_argument("--last-year", type=int)
    r.add_argument("--min-magnitude", type=float, default=0.0)
    r.add_argument("--cell-size", default="1.0",
                   help="grid cell in degrees, or 'auto' (derived from the polygon layer)")
    r.add_argument("--complete-states", action="store_true",
                   help="add the seven states and the AL abbreviation missing from the lists")
    pr = sub.add_parser("profile", help="profile and sample of a final dataset")
    pr.add_argument("--final", required=True)
    pr.add_argument("--sample-size", type=int, default=80)
    pr.add_argument("--sample-out")
    o = sub.add_parser("olap", help="published OLAP queries over a warehouse")
    o.add_argument("--warehouse", required=True)
    o.add_argument("--min-year", type=int, default=2020)
    f = sub.add_parser("refresh", help="streaming refresh of a warehouse")
    f.add_argument("--events", required=True)
    f.add_argument("--counties", required=True)
    f.add_argument("--warehouse", required=True)
    f.add_argument("--stream-checkpoint", required=True)
    f.add_argument("--continuous", action="store_true")
    f.add_argument("--every", default="1 hour")
    return p


COMMANDS = {"run": cmd_run, "profile": cmd_profile, "olap": cmd_olap, "refresh": cmd_refresh}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    ensure_checkpoint_dir(spark)
    COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])


__all__ = ["main", "parser", "read_counties"]
