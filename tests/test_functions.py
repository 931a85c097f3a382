import math
import unicodedata

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hushtrack.functions import cells, geodesic, text, units
from hushtrack.sources.messages import parse_time


def degrees(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


# Published lines: Flinders Peak - Buninyong, the quarter meridian, two nearly antipodal lines,
# half the meridian ellipse.
LINES = [
    ((degrees(-37, 57, 3.72030), degrees(144, 25, 29.52440), degrees(-37, 39, 10.15610), degrees(143, 55, 35.38390)), 54972.271),
    ((0, 0, 90, 0), 10001965.729),
    ((0, 0, 0.5, 179.5), 19936288.579),
    ((0, 0, 0.5, 179.7), 19944127.421),
    ((0, 0, 0, 180), 20003931.459),
    ((0, 10, 0, 11), math.radians(1) * 6378137.0),
    ((-5, 179, -5, -179), None),
    ((10, 20, 10, 20), 0.0),
]


@pytest.mark.parametrize("line,meters", LINES)
def test_published_lines(line, meters):
    got = geodesic.inverse_m(*[[v] for v in line])[0]
    back = geodesic.inverse_m(*[[v] for v in (line[2], line[3], line[0], line[1])])[0]
    assert got == pytest.approx(back, abs=1e-6)
    if meters is None:
        shifted = geodesic.inverse_m([-5], [0], [-5], [2])[0]
        assert got == pytest.approx(shifted, abs=1e-6)
    else:
        assert got == pytest.approx(meters, abs=1e-3)


def test_both_solvers_agree():
    rng = np.random.default_rng(1)
    lat1, lat2 = rng.uniform(-90, 90, (2, 5000))
    lon1, lon2 = rng.uniform(-180, 180, (2, 5000))
    u = lambda lat: np.arctan((1 - geodesic.FLATTENING) * np.tan(np.radians(lat)))
    dlon = np.radians(np.remainder(lon2 - lon1 + 180, 360) - 180)
    assert np.abs(geodesic._bisect(u(lat1), u(lat2), dlon) - geodesic.inverse_m(lat1, lon1, lat2, lon2)).max() < 1e-6


@given(st.integers(0, 2**32 - 1), st.lists(st.integers(1, 40), min_size=1, max_size=6))
def test_distance_does_not_depend_on_the_batch(seed, sizes):
    rng = np.random.default_rng(seed)
    n = sum(sizes)
    lat1, lat2 = rng.uniform(-90, 90, (2, n))
    lon1, lon2 = rng.uniform(-180, 180, (2, n))
    hard = rng.random(n) < 0.2  # nearly antipodal, or one point
    lat2, lon2 = np.where(hard, -lat1 + rng.choice([0, 1e-4], n), lat2), np.where(hard, lon1 + 180, lon2)
    together = geodesic.inverse_m(lat1, lon1, lat2, lon2)
    cuts = np.cumsum(sizes)[:-1]
    apart = np.concatenate([geodesic.inverse_m(*p) for p in zip(*(np.split(v, cuts) for v in (lat1, lon1, lat2, lon2)))])
    assert together.tobytes() == apart.tobytes()


def test_distance_nulls(spark):
    rows = [(1.0, 2.0, 3.0, 4.0), (None, 2.0, 3.0, 4.0), (1.0, 2.0, 3.0, None), (90.5, 2.0, 3.0, 4.0), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geodesic.distance_m(*[F.col(c) for c in "abcd"])).collect()]
    assert got[0] > 0 and got[1:] == [None] * 4


def test_cell_ids():
    hexed = lambda lat, lon, level: f"{int(cells.cell_ids([lat], [lon], level)[0]) & (2**64 - 1):016x}"
    assert hexed(0, 0, 30) == "1000000000000001"
    assert hexed(0, 0, 10) == "1000010000000000"
    # A parent contains its child: same prefix above the parent's lowest bit.
    for lat, lon in ((51.5, -0.12), (-33.9, 151.2), (89.9, 10.0), (-89.9, 10.0), (10.0, 179.99), (0.0, -90.0)):
        leaf, parent = int(hexed(lat, lon, 30), 16), int(hexed(lat, lon, 10), 16)
        low = parent & -parent
        assert parent - low < leaf < parent + low


def test_cell_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "lat double, lon double")
    got = [r[0] for r in df.select(cells.cell(F.col("lat"), F.col("lon"))).collect()]
    assert got[0] == int(cells.cell_ids([1.0], [2.0])[0]) and got[1] is None


def test_inside_polygon_with_hole(spark):
    ring = lambda *points: [{"lon": float(x), "lat": float(y)} for x, y in points]
    outer, hole = ring((0, 0), (10, 0), (12, 6), (5, 10), (0, 10)), ring((2, 2), (2, 4), (4, 4), (4, 2))
    rows = [(x / 2 + 0.13, y / 2 + 0.17) for x in range(-4, 30) for y in range(-4, 26)]

    def even_odd(x, y):
        odd = False
        for points in (outer, hole):
            for a, b in zip(points, points[1:] + points[:1]):
                if (a["lat"] > y) != (b["lat"] > y):
                    odd ^= x < (b["lon"] - a["lon"]) * (y - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"]
        return odd

    df = spark.createDataFrame([(x, y, [outer, hole]) for x, y in rows], "lon double, lat double, geo array<array<struct<lon double, lat double>>>")
    inside = cells.inside(F.col("lon"), F.col("lat"), cells.ring_edges(F.col("geo")))
    got = [r[0] for r in df.select(inside).collect()]
    assert got == [even_odd(x, y) for x, y in rows] and any(got) and not all(got)


def test_texts_match_python(spark):
    values = [0.0, -0.0, None, 1.0, -12.34, 1e-3, 5e-4, -1.25e-4, 1e-4, 1e-5, -1.5e-5, 2.5e-10, 179.99999, 61.53999999999999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(F.expr(text.degrees_text("v"))).collect()]
    assert got == [str(v or 0.0) for v in values]
    instants = [0, 1, 1704412120000000, 1704067207179575, 1704067207100000, -500000, 1704067207000001]
    df = spark.createDataFrame([(v,) for v in instants], "v bigint")
    got = [r[0] for r in df.select(F.expr(text.epoch_seconds_text("v"))).collect()]
    assert got == [str(v / 1e6) if abs(v) != 1 else "0.000001" for v in instants]


def test_small_functions(spark):
    row = spark.createDataFrame([(-179.0, 1.0, "ICCAT", "Café del Mar", None, 3.0)], "a double, b double, rfmo string, label string, n double, m double").select(
        units.antipodal_lon(F.col("a")).alias("anti"),
        units.antipodal_lon(F.col("b")).alias("anti_b"),
        units.mean_lon(F.lit(179.0), F.lit(-177.0)).alias("plain"),
        units.mean_lon(F.lit(179.0), F.lit(-177.0), True).alias("safe"),
        units.is_whitelisted_rfmo(F.col("rfmo")).alias("listed"),
        text.port_id(F.lit("ESP"), F.col("label")).alias("port"),
        text.grid_code(F.lit(12.3), F.lit(-0.001)).alias("grid"),
        units.least_or_first(F.col("n"), F.col("m")).alias("least_null"),
        units.least_or_first(F.col("m"), F.col("n")).alias("least"),
        units.nautical_miles_to_km(F.lit(2.0)).alias("km"),
        units.ais_class(F.lit("AIS.19")).alias("ais"),
        units.lon_lat(F.lit(1), F.lit(2)).alias("point"),
    ).first()
    assert (row.anti, row.anti_b, row.plain, row.safe) == (1.0, -179.0, 1.0, -179.0)
    assert row.listed and row.port == unicodedata.normalize("NFC", "esp-cafédelmar")
    assert row.grid == "lon:+012.30_lat:+000.00"
    assert (row.least_null, row.least, row.km, row.ais) == (None, 3.0, 3.704, "B")
    assert (row.point.lon, row.point.lat) == (1.0, 2.0)


def test_parse_time(spark):
    values = ["1704412120", "1704412120.5", "2024-01-01 10:00:00 UTC", "2024-01-01T10:00:00Z", "x", None]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(F.unix_micros(parse_time(F.col("v"))))
    tens = 1704103200000000
    assert [r[0] for r in df.collect()] == [1704412120000000, 1704412120500000, tens, tens, None, None]


def test_cell_boxes_hold_their_points():
    rng = np.random.default_rng(2)
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, 20000))), rng.uniform(-180, 180, 20000)
    lat[:600], lon[600:900] = rng.uniform(89.5, 90, 600) * rng.choice([-1, 1], 600), rng.choice([-180, 180], 300)
    for level in (4, 10, 13):
        west, south, east, north = cells.cell_boxes(cells.cell_ids(lat, lon, level)).T
        assert ((west <= lon) & (lon <= east) & (south <= lat) & (lat <= north)).all()
    some = np.abs(lat) < 60
    box = cells.cell_boxes(cells.cell_ids(lat[some], lon[some], 10))
    assert np.median(box[:, 3] - box[:, 1]) < 0.2

