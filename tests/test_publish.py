import hashlib
import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hushtrack import schemas
from hushtrack.functions.cells import cell_ids
from hushtrack.operators.regions import points_in_regions, region_cells, region_pieces, regions_by_layer
from hushtrack.plans import publish

T0 = datetime(2024, 1, 1)


def hours(n):
    return T0 + timedelta(hours=n)


def gap(gid, start_h, end_h, seg1, seg2, lat=(1.0, 3.0), lon=(10.0, 20.0), shore=(1000.0, 3000.0), port=(5000.0, None)):
    end = None if end_h is None else hours(end_h)
    closed = end is not None
    on = lambda v: v if closed else None
    return (gid, "s1", T0, 1, 1, 0, 0, 5000.0 if closed else None, float(end_h - start_h) if closed else None, 2.0 if closed else None,
            hours(start_h), "m", seg1, lat[0], lon[0], "A", "terrestrial", shore[0], port[0],
            end, on("m2"), on(seg2), on(lat[1]), on(lon[1]), on("A"), on("satellite"), on(shore[1]), on(port[1]), closed)


@pytest.fixture(scope="module")
def inputs(spark):
    gaps = spark.createDataFrame(
        [
            gap("g1", 24, 48, "a1", "a2"),
            gap("g2", 30, 50, "a1", "b1"),  # another vessel ends it
            gap("g3", 30, 50, "c1", "a1"),  # start vessel unknown that year: dropped
            gap("g4", 60, None, "a1", None),
            gap("g5", 70, 80, "a1", "zz", lat=(None, 1.0), port=(None, 1.0)),  # unknown end segment
            gap("g6", -30, 10, "a1", "a1"),  # starts before the range
            gap("g7", 700, 800, "a1", "a1"),  # ends after the range
        ],
        schemas.GAP,
    )
    segment_info = spark.createDataFrame([("a1", "va"), ("a2", "va"), ("b1", "vb"), ("c1", "vc")], "seg_id string, vessel_id string")
    activity = spark.createDataFrame([("a1", True), ("a2", False), ("b1", True), ("c1", None)], "seg_id string, overlapping_and_short boolean")
    vessels = spark.createDataFrame(
        [("va", 2024, "Ann", "cargo", "ESP"), ("vb", 2024, "Bea", "tanker", "ARG"), ("vc", 2023, "Cid", "x", "y")],
        "vessel_id string, year int, shipname string, prod_shiptype string, mmsi_flag string")
    voyages = spark.createDataFrame(
        [
            ("t1", hours(0), hours(100), "p1", "p2", "visit1", "va"),
            ("t2", None, hours(49), "p1", "p2", "visit2", "va"),  # open start: encloses g1 only
            ("t3", datetime(1979, 1, 1), hours(900), "p1", "p2", "visit1", "va"),  # marker: ignored
            ("t4", hours(24), hours(100), "p1", "p2", "visit1", "va"),  # starts with g1, not before it
            ("t5", hours(0), None, "p1", "p2", "visit1", "va"),
        ],
        "trip_id string, trip_start timestamp, trip_end timestamp, trip_start_anchorage_id string, trip_end_anchorage_id string, trip_end_visit_id string, vessel_id string")
    ports = spark.createDataFrame(
        [("pv1", json.dumps({"visit_id": "visit1", "intermediate_anchorage": {"id": "x1", "flag": "CHL", "name": None}})),
         ("pv2", json.dumps({"visit_id": "visit2", "intermediate_anchorage": {"id": 12, "flag": "PER"}})), ("pv3", "not json")],
        "event_id string, event_info string")
    square = [[{"lon": 14.0, "lat": 1.0}, {"lon": 16.0, "lat": 1.0}, {"lon": 16.0, "lat": 3.0}, {"lon": 14.0, "lat": 3.0}]]
    near = sorted({int(cell_ids([2.0], [15.0])[0]), int(cell_ids([40.0], [40.0])[0])})
    regions = spark.createDataFrame(
        [("r1", "eez", square, near), ("r2", "eez", square, near), ("r3", "fao", square, near), ("r4", "unheard", square, near),
         ("r5", "mpa", [[{"lon": p["lon"] + 2, "lat": p["lat"]} for p in square[0]]], near), ("r6", "rfmo", square, [])],
        schemas.REGION)
    return publish.PublishInputs(gaps, segment_info, activity, voyages, ports, regions, vessels)


def test_events(spark, inputs):
    events = publish.gap_events(inputs, "2024-01-01", "2024-01-20")
    assert [(f.name, f.dataType) for f in events.schema] == [(f.name, f.dataType) for f in schemas.EVENT]
    rows = events.collect()
    by_start = {}
    for r in rows:
        by_start.setdefault(r.event_start, []).append(r)
    # g1 lies in t1 and t2, g2 in t1 and t4, g5 in t1 and t4; others are filtered.
    assert {k: len(v) for k, v in by_start.items()} == {hours(24): 2, hours(30): 2, hours(70): 2}
    first = by_start[hours(24)]
    assert len({r.event_id for r in first}) == 1
    assert first[0].event_id == hashlib.md5(b"gaps|va|2024-01-02 00:00:00+00|2024-01-03 00:00:00+00").hexdigest()
    infos = sorted((json.loads(r.event_info) for r in first), key=lambda i: i["main_vessel_destination_port"]["event_id"])
    assert infos[0]["main_vessel_destination_port"] == {"event_id": "pv1", "id": "x1", "flag": "CHL", "name": None}
    assert infos[1]["main_vessel_destination_port"] == {"event_id": "pv2", "id": None, "flag": "PER", "name": None}
    assert infos[0]["total_distance_km"] == 5.0 and infos[0]["vessel_class"] == "cargo" and infos[0]["is_multi_vessel_gap"] is False
    assert infos[0]["gap_min_distance_from_port_m"] == 5000.0 and infos[0]["gap_min_distance_from_shore_m"] == 1000.0
    assert (infos[0]["gap_start_overlapping_and_short"], infos[0]["gap_end_overlapping_and_short"], infos[0]["gap_overlapping_and_short"]) == (True, False, False)
    assert first[0].lat_mean == 2.0 and first[0].lon_mean == 15.0 and first[0].lat_max == 3.0
    assert first[0].start_distance_from_shore_km == 1.0 and first[0].end_distance_from_port_km is None
    regions = first[0].regions_mean_position.asDict()
    assert regions.pop("eez") == ["r1", "r2"] and regions.pop("fao") == ["r3"]
    assert set(regions) == set(schemas.REGION_LAYERS) - {"eez", "fao"} and all(v == [] for v in regions.values())
    assert [v["id"] for v in json.loads(first[0].event_vessels)] == ["va"]

    second = json.loads(by_start[hours(30)][0].event_vessels)
    assert [(v["id"], v["name"], v["seg_id"]) for v in second] == [("va", "Ann", "a1"), ("vb", "Bea", "b1")]
    fifth = by_start[hours(70)][0]
    info = json.loads(fifth.event_info)
    assert fifth.lat_mean is None and fifth.regions_mean_position is None
    assert info["vessel_2_id"] is None and info["is_multi_vessel_gap"] is None and info["gap_min_distance_from_port_m"] is None
    assert info["gap_overlapping_and_short"] is None


def test_open_gaps_on_request(spark, inputs):
    events = publish.gap_events(inputs, "2024-01-01", "2024-01-20", include_open=True).where("event_end is null").collect()
    assert len(events) == 1 and events[0].event_id == hashlib.md5(b"gaps|va|2024-01-03 12:00:00+00|NULL").hexdigest()


def test_table_is_replaced(spark, inputs, tmp_path):
    path = str(tmp_path / "events")
    first = publish.run_publish(spark, inputs, path, "2024-01-01", "2024-01-20").count()
    assert first == 6
    again = publish.run_publish(spark, inputs, path, "2024-01-01", "2024-01-03 12:00:00"[:10])
    assert again.count() == 0


def test_voyages_against_brute_force(spark):
    rng = random.Random(4)
    vessel = lambda: "hot" if rng.random() < 0.4 else f"v{rng.randrange(5)}"
    gaps, voyages = [], []
    for i in range(300):
        start = rng.randrange(0, 24 * 90)
        gaps.append((i, vessel(), hours(start), None if rng.random() < 0.1 else hours(start + rng.randrange(1, 200))))
    for i in range(80):
        start = rng.randrange(-200, 24 * 90)
        voyages.append((f"t{i}", None if rng.random() < 0.1 else hours(start), None if rng.random() < 0.1 else hours(start + rng.randrange(1, 1500)), vessel()))
    want = set()
    for i, v, s, e in gaps:
        found = [t for t, a, b, w in voyages if w == v and (a is None or a < s) and b is not None and e is not None and b > e]
        want |= {(i, t) for t in found} or {(i, None)}
    left = spark.createDataFrame(gaps, "n int, _start_vessel_id string, start_timestamp timestamp, end_timestamp timestamp")
    right = spark.createDataFrame(voyages, "trip_id string, trip_start timestamp, trip_end timestamp, _voyage_vessel_id string")
    span = publish.gap_start_span(left, None, None)
    for days in (1, 7, 400):
        rows = [(r.n, r.trip_id) for r in publish.with_voyages(left, right, span, days).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    # Repeated gaps each get their voyages.
    twice = publish.with_voyages(left.union(left), right, span).count()
    assert twice == 2 * len(want)


def test_long_voyages_have_two_rows(spark):
    """However long a voyage, and however narrow the buckets."""
    voyages = [(f"t{n}", hours(24 * n), hours(24 * (n + length))) for n, length in enumerate([0, 1, 2, 6, 7, 8, 90, 365, 3650])]
    voyages += [("open", None, hours(24 * 4000)), ("before", hours(-90000), hours(-80000)), ("around", hours(-900), hours(24 * 9000))]
    df = spark.createDataFrame(voyages, "trip_id string, trip_start timestamp, trip_end timestamp")
    span = tuple(int((hours(24 * d) - datetime(1970, 1, 1)).total_seconds()) * 10**6 for d in (0, 5000))
    for days in (1, 7, 400):
        got = {r.trip_id: r["count"] for r in publish.voyage_intervals(df, span, days).groupBy("trip_id").count().collect()}
        assert set(got) == {v[0] for v in voyages} - {"before"} and max(got.values()) <= 2


def test_regions_against_brute_force(spark):
    rng = random.Random(8)
    boxes = [(f"r{i}", schemas.REGION_LAYERS[i % 13], rng.uniform(-170, 150), rng.uniform(-60, 50)) for i in range(30)]
    points = [(i, rng.uniform(-175, 175), rng.uniform(-65, 60)) for i in range(3000)]
    cells = [int(c) for c in cell_ids([p[2] for p in points], [p[1] for p in points])]
    corners = lambda x, y: [[{"lon": a, "lat": b} for a, b in ((x, y), (x + 20, y), (x + 20, y + 9), (x, y + 9))]]
    holds = lambda box, p: box[2] <= p[1] < box[2] + 20 and box[3] <= p[2] < box[3] + 9
    # Cells of neighbouring points too, so that the exact test has something to reject.
    near = lambda box, p: box[2] - 5 <= p[1] < box[2] + 25 and box[3] - 5 <= p[2] < box[3] + 14
    rows = [(b[0], b[1], corners(b[2], b[3]), sorted({c for c, p in zip(cells, points) if near(b, p)})) for b in boxes]
    regions = spark.createDataFrame(rows, schemas.REGION)
    located = spark.createDataFrame([(*p, c) for p, c in zip(points, cells)], "n int, lon double, lat double, s2_cell long")
    matches = points_in_regions(located, regions, "n")
    want = {(p[0], b[1], b[0]) for p in points for b in boxes if holds(b, p)}
    assert {tuple(r) for r in matches.collect()} == want and want
    assert region_cells(regions).count() == sum(len(r[3]) for r in rows)
    grouped = {r.n: r.regions for r in regions_by_layer(matches, "n").collect()}
    for n, of_layers in grouped.items():
        for layer in schemas.REGION_LAYERS:
            assert of_layers[layer] == sorted(r for m, l, r in want if m == n and l == layer)


def test_concave_and_holed_regions_by_cell(spark):
    """Stars with a hole, of very many edges, against all edges in plain Python."""
    rng = random.Random(4)

    def ring(x, y, size, count):
        around = [(2 * math.pi * k / count, size * rng.uniform(0.4, 1.0)) for k in range(count)]
        return [{"lon": x + r * math.cos(a), "lat": y + r * math.sin(a)} for a, r in around]

    shapes = [("a", "eez", [ring(10, 20, 1.5, 400), ring(10, 20, 0.4, 40)]), ("b", "eez", [ring(10.5, 20.3, 0.8, 9)]), ("c", "fao", [ring(-60, -40, 1.2, 60)])]
    points = [(k, *rng.choice([(10, 20), (10.5, 20.3), (-60, -40)])) for k in range(1500)]
    points = [(k, x + rng.uniform(-1.6, 1.6), y + rng.uniform(-1.6, 1.6)) for k, x, y in points]
    ids = [int(c) for c in cell_ids([p[2] for p in points], [p[1] for p in points])]

    def holds(rings, lon, lat):
        odd = False
        for r in rings:
            for a, b in zip(r, r[1:] + r[:1]):
                if (a["lat"] > lat) != (b["lat"] > lat) and lon < a["lon"] + (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]):
                    odd = not odd
        return odd

    regions = spark.createDataFrame([(i, l, r, sorted(set(ids))) for i, l, r in shapes] + [("d", "fao", None, None), ("e", "fao", [], ids[:3])], schemas.REGION)
    located = spark.createDataFrame([(*p, c) for p, c in zip(points, ids)], "n int, lon double, lat double, s2_cell long")
    want = {(n, l, i) for n, x, y in points for i, l, r in shapes if holds(r, x, y)}
    pieces = region_pieces(regions)
    assert {tuple(r) for r in points_in_regions(located, regions, "n").collect()} == want
    assert {tuple(r) for r in points_in_regions(located, pieces, "n").collect()} == want and len(want) > 300
    sizes = [len(r.edges) for r in pieces.where("id = 'a'").collect()]
    assert max(sizes) < 100 and any(r.parity and not r.edges and not r.flips for r in pieces.collect())
    plan = points_in_regions(located, pieces, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1

