"""End-to-end plan checks: hotspots -> shift sets -> routes."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hotbeat.operators import routes
from hotbeat.plans import patrol
from hotbeat.plans.hotspots import find_hotspots
from hotbeat.plans.prepare import enrich, prepare
from hotbeat.sources import fixtures


@pytest.fixture(scope="module")
def enriched(spark):
    return enrich(prepare(fixtures.incidents(spark, SF_SMALL))).cache()


def test_hotspots_per_area(enriched):
    hs = find_hotspots(enriched, k=4, by="area", grid=20).collect()
    per_area = {}
    for r in hs:
        per_area.setdefault(r.area, []).append(r)
    assert all(1 <= len(v) <= 4 for v in per_area.values())
    assert all(r.lat is not None and r.lon is not None and r.n_incidents >= 1 for r in hs)


def test_patrol_routes_cover_shift_sets(spark, enriched):
    hs = find_hotspots(enriched, k=4, by="area", grid=20)
    scored = patrol.baseline_scores(enriched, hs)
    sets = {(r.area, r.predicted_slot): set(r.hotspots) for r in patrol.shift_sets(scored).collect()}
    stops = patrol.plan(scored, hs).collect()
    got = {}
    for r in stops:
        got.setdefault((r.area, r.predicted_slot), []).append(r)
    assert set(got) == set(sets)
    for key, rows in got.items():
        rows.sort(key=lambda r: r.seq)
        assert [r.seq for r in rows] == list(range(1, len(rows) + 1))
        assert {r.hotspot_id for r in rows} == sets[key]
        legs = spark.createDataFrame([(r.seq, r.lat, r.lon, 1) for r in rows], "seq int, lat double, lon double, one int")
        assert rows[0].route_km == pytest.approx(routes.route_length(legs, "one").first().km, abs=1e-5)
