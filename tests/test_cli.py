"""End-to-end job: raw CSV months + GeoJSON counties -> stages -> warehouse -> reports."""

import json
import tempfile

from tremor import cli
from tremor.plans import pipeline
from tremor.sources import events as ev
from tremor.sources.testdata import FIXTURE_COUNTIES, event_view, fixture_county_edges


def _geojson(path):
    feats = {}
    for pid, name, _ring, pts in FIXTURE_COUNTIES:
        feats.setdefault((pid, name), []).append([[float(x), float(y)] for x, y in pts])
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NAME": name, "GEOID": pid},
         "geometry": {"type": "Polygon", "coordinates": rings}}
        for (pid, name), rings in feats.items()]}
    with open(path, "w") as f:
        json.dump(fc, f)


def test_run_profile_olap(spark, sf_small, capsys):
    base = tempfile.mkdtemp(prefix="tremor-cli-", dir="/tmp")
    raw = event_view(spark, sf_small)
    ev.write_months(raw, f"{base}/events")
    _geojson(f"{base}/counties.geojson")
    cli.main(["run", "--events", f"{base}/events", "--counties", f"{base}/counties.geojson",
              "--out", f"{base}/out", "--warehouse", f"{base}/wh", "--cell-size", "auto"],
             spark=spark)
    cli.main(["profile", "--final", f"{base}/out/final", "--sample-out", f"{base}/sample"],
             spark=spark)
    cli.main(["olap", "--warehouse", f"{base}/wh", "--min-year", "1998"], spark=spark)
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    by = {x["kind"]: x["data"] for x in lines}
    expected = pipeline.final_dataset(raw, fixture_county_edges(spark))
    assert by["profile"]["n_rows"] == expected.count() == by["stage_rows"]["final"]
    stg = pipeline.staging_events(raw, fixture_county_edges(spark))
    assert by["warehouse"]["earthquake_fact"] == stg.count()
    direct = sorted((r["state"], r["count"]) for r in stg.groupBy("state").count().collect())
    top = sorted((r["state"], r["earthquake_count"]) for r in by["top_states"])
    assert set(top) <= set(direct)
    assert len(by["sample_head"]) == 6
    assert by["cell_size"] == 1.25
