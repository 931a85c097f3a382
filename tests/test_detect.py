import hashlib
import random
from datetime import datetime, timedelta, timezone

import brute
import pytest
from pyspark.sql import functions as F

from hushtrack import schemas
from hushtrack.errors import GapDetectionError
from hushtrack.operators.detect import Settings, close_open_gaps, detect_gaps, open_gaps, run_window
from hushtrack.operators.joins import Limits

UTC = timezone.utc
A, B = "seal", "heron"
TICK = timedelta(microseconds=1)
NOON = datetime(2031, 3, 9, 12, tzinfo=UTC)
MIDNIGHT = datetime(2031, 3, 10, tzinfo=UTC)
DAY = ("2031-03-10", "2031-03-11")


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def message(when, ssvid=A, receiver="terrestrial", lat=65.4, lon=None, msgid="m", seg="123456"):
    when = at(when) if isinstance(when, str) else when
    return (ssvid, msgid, seg, when, lat, lon, receiver, 1.0, 2.0, "A")


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.MESSAGE)


def pairs(gaps):
    """(ssvid, off, on) of gaps; on is None for an open one."""
    rows = gaps.select("ssvid", "start_timestamp", "end_timestamp").collect()
    zoned = lambda t: t and t.replace(tzinfo=UTC)
    return {(r.ssvid, zoned(r.start_timestamp), zoned(r.end_timestamp)) for r in rows}


def d(day, hour, month="2024-01"):
    return f"{month}-{day:02d} {hour:02d}:00:00"


def known(spark, start, count, ssvid=A):
    """An open gap as a run before left it."""
    off = frame(spark, [message(start, ssvid)])
    gap = open_gaps(off, Settings(threshold_h=0), None)
    return gap.withColumn("positions_hours_before", F.lit(count).cast("bigint"))


# Each rule is tested just under, at and just over its boundary.
SIDES = pytest.mark.parametrize("side", [-1, 0, 1])


@SIDES
@pytest.mark.parametrize("hours", [0.25, 6, 31])
def test_gap_is_longer_than_the_threshold(spark, side, hours):
    late = NOON + timedelta(hours=hours) + side * TICK
    found = pairs(detect_gaps(frame(spark, [message(late), message(NOON)]), Settings(threshold_h=hours)))
    assert found == ({(A, NOON, late)} if side > 0 else set())


def test_tracks_are_told_apart_and_sorted(spark):
    steps = {A: (0, 1, 9, 10, 30), B: (0.5, 20, 20.5)}
    rows = [message(NOON + timedelta(hours=h), v) for v, hs in steps.items() for h in hs]
    random.Random(4).shuffle(rows)
    hour = lambda h: NOON + timedelta(hours=h)
    want = {(A, hour(1), hour(9)), (A, hour(10), hour(30)), (B, hour(0.5), hour(20))}
    assert pairs(detect_gaps(frame(spark, rows).repartition(4), Settings(threshold_h=5))) == want


@SIDES
def test_look_back_includes_its_first_instant(spark, side):
    edge = NOON - timedelta(hours=7) + side * TICK
    rows = [message(edge, receiver="satellite"), message(NOON, receiver="dynamic"), message(NOON + timedelta(hours=9))]
    rows += [message(NOON - timedelta(hours=h), receiver=r) for h, r in ((1, "terrestrial"), (2, "terrestrial"), (3, None), (4, "unknown"))]
    gap = detect_gaps(frame(spark, rows), Settings(threshold_h=8, n_hours_before=7)).first()
    inside = side >= 0
    assert [gap[c] for c in schemas.COUNT_COLUMNS] == [5 + inside, 2, int(inside), 1]


@SIDES
@pytest.mark.parametrize("ranged", [False, True])
def test_open_gap_ends_with_the_day(spark, side, ranged):
    last = MIDNIGHT - timedelta(hours=5) - side * TICK
    days = ("2031-03-09", "2031-03-10") if ranged else None
    found = pairs(open_gaps(frame(spark, [message(last)]), Settings(threshold_h=5), days))
    assert found == ({(A, last, None)} if side > 0 else set())


@SIDES
def test_start_may_lie_a_threshold_before_the_range(spark, side):
    off = MIDNIGHT - timedelta(hours=4) + side * TICK
    on = MIDNIGHT + timedelta(hours=20)
    found = pairs(run_window(frame(spark, [message(off), message(on)]), None, DAY, Settings(threshold_h=4)))
    assert found == ({(A, off, on)} if side >= 0 else set())


@SIDES
def test_open_gap_closes_with_the_first_message_of_the_range(spark, side):
    first = MIDNIGHT + side * TICK
    opened = known(spark, NOON - timedelta(days=2), 3)
    found = pairs(close_open_gaps(opened, frame(spark, [message(first), message(first + timedelta(hours=1))]), DAY, Settings(threshold_h=6)))
    closing = first if side >= 0 else first + timedelta(hours=1)
    assert found == {(A, NOON - timedelta(days=2), closing)}


@SIDES
def test_range_excludes_its_end(spark, side):
    on = MIDNIGHT + timedelta(days=1) + side * TICK
    found = pairs(run_window(frame(spark, [message(MIDNIGHT), message(on)]), None, DAY, Settings(threshold_h=6)))
    assert found == {(A, MIDNIGHT, on if side < 0 else None)}


def test_detected_pair_replaces_the_open_gap_it_closes(spark):
    off, on = MIDNIGHT - timedelta(hours=1), MIDNIGHT + timedelta(hours=15)
    opened = known(spark, off, 50)
    gaps = run_window(frame(spark, [message(off - timedelta(hours=1)), message(off), message(on)]), opened, DAY, Settings(threshold_h=6))
    rows = gaps.where("is_closed").collect()
    assert len(rows) == 1 and rows[0].positions_hours_before == 2 and rows[0].gap_id == opened.first().gap_id


def test_zoneless_times_are_utc(spark):
    rows = frame(spark, [message(MIDNIGHT - timedelta(hours=7)), message(MIDNIGHT + timedelta(hours=7))])
    want = pairs(run_window(rows, None, DAY, Settings(threshold_h=9)))
    zoneless = rows.withColumn("timestamp", F.expr("cast(timestamp as timestamp_ntz)"))
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        got = run_window(zoneless, None, DAY, Settings(threshold_h=9)).selectExpr("unix_micros(start_timestamp) a", "unix_micros(end_timestamp) b").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    micros = lambda t: t and round(t.timestamp() * 1e6)
    assert {(r.a, r.b) for r in got} == {(micros(a), micros(b)) for _, a, b in want}


@pytest.mark.parametrize("values", [{"threshold_h": -1}, {"n_hours_before": -0.5}, {"keys": ()}, {"bucket_days": 0}])
def test_settings_are_checked(values):
    with pytest.raises(ValueError):
        Settings(**values)


def test_composite_keys_are_carried(spark):
    rows = frame(spark, [message(MIDNIGHT - timedelta(hours=20), seg="x"), message(MIDNIGHT - timedelta(hours=19), seg="y")])
    settings = Settings(threshold_h=6, keys=("ssvid", "seg_id"))
    opened = open_gaps(rows, settings, ("2031-03-09", "2031-03-10"))
    assert {(r.ssvid, r.seg_id) for r in opened.collect()} == {(A, "x"), (A, "y")}
    later = frame(spark, [message(MIDNIGHT + timedelta(hours=2), seg="y")])
    closed = close_open_gaps(opened, later, DAY, settings).collect()
    assert [(r.seg_id, r.start_seg_id, r.duration_h) for r in closed] == [("y", "y", 21.0)]


def test_runs_day_after_day_agree_with_the_rules(spark):
    """Each day sees its own and the day before's messages and the open gaps left so far."""
    messages = random_messages(seed=3, n=70, tracks=4, span_h=24 * 4)
    settings, state, got = Settings(threshold_h=7), {}, {}
    for day in range(1, 5):
        low, high = (datetime(2024, 1, day, tzinfo=UTC) + timedelta(days=k) for k in (0, 1))
        seen = [m for m in messages if (low - timedelta(days=1)).timestamp() <= m["timestamp"] < high.timestamp()]
        opened = spark.createDataFrame(list(state.values()), schemas.GAP) if state else None
        for gap in run_window(as_frame(spark, seen), opened, (low.date(), high.date()), settings).collect():
            state.pop(gap.gap_id, None)
            if not gap.is_closed:
                state[gap.gap_id] = gap
            got[gap.gap_id] = (gap.ssvid, gap.start_timestamp, gap.end_timestamp)
    naive = lambda m: m and datetime.fromtimestamp(m["timestamp"], UTC).replace(tzinfo=None)
    end = datetime(2024, 1, 5, tzinfo=UTC).timestamp()
    want = {(k[0], naive(v[1]), naive(v[2])) for (k, _), v in brute.run(messages, 7, end=end).items()}
    assert set(got.values()) == want and len(got) == len(want)


def test_gap_record(spark):
    rows = [message(d(1, 0), lat=10.0, lon=20.0), message(d(1, 1), lat=10.0, lon=20.0), message(d(1, 2), lat=0.0005, lon=-1e-5),
            message(d(1, 12), lat=0.0, lon=1.0)]
    version = datetime(2024, 5, 1, 10, 11, 12, 131415, UTC)
    gap = detect_gaps(frame(spark, rows), Settings(threshold_h=9, version=version)).collect()
    assert len(gap) == 1
    gap = gap[0]
    assert gap.duration_h == 10.0
    assert gap.gap_id == hashlib.md5(f"{A}|1704074400.0|{0.0005}|{-1e-05}".encode()).hexdigest()
    assert gap.distance_m == pytest.approx(111320.61, abs=2)
    assert gap.implied_speed_knots == pytest.approx(gap.distance_m / 10 / 1852)
    assert gap.version == datetime(2024, 5, 1, 10, 11, 12)
    assert gap.is_closed


def test_schema_is_the_table_schema(spark):
    gaps = run_window(frame(spark, [message(d(1, 0)), message(d(1, 12))]), None, ("2024-01-01", "2024-01-02"))
    assert [(f.name, f.dataType) for f in gaps.schema] == [(f.name, f.dataType) for f in schemas.GAP]


def test_null_and_invalid_coordinates(spark):
    rows = [message(d(1, 0), lat=None, lon=1.0), message(d(2, 0), lat=95.0, lon=1.0), message(d(3, 0), lat=1.0, lon=1.0), message(d(4, 0), lat=1.0, lon=1.0)]
    gaps = detect_gaps(frame(spark, rows)).orderBy("start_timestamp").collect()
    assert [(g.distance_m, g.implied_speed_knots) for g in gaps] == [(None, None), (None, None), (0.0, 0.0)]
    assert gaps[0].gap_id == hashlib.md5(f"{A}|1704067200.0|0.0|1.0".encode()).hexdigest()


def test_start_time(spark):
    rows = [message(d(1, h)) for h in (0, 1, 2, 12)]
    gaps = detect_gaps(frame(spark, rows), Settings(threshold_h=0.5), start_time=at(d(1, 2)))
    assert pairs(gaps) == {(A, at(d(1, 2)), at(d(1, 12)))}
    assert gaps.first().positions_hours_before == 3
    assert detect_gaps(frame(spark, rows), Settings(threshold_h=0.5), start_time="2025-01-01").count() == 0


def test_open_gap_has_no_end(spark):
    row = open_gaps(frame(spark, [message(NOON - timedelta(hours=1))]), Settings(threshold_h=12)).first()
    assert row.end_timestamp is None and row.duration_h is None and row.distance_m is None and not row.is_closed


def test_missing_column(spark):
    with pytest.raises(GapDetectionError, match="receiver_type"):
        detect_gaps(frame(spark, [message(d(1, 0))]).drop("receiver_type"))


def test_closing_keeps_extra_fields(spark):
    base = known(spark, d(1, 0), 9).withColumn("note", F.lit("kept"))
    gaps = close_open_gaps(base, frame(spark, [message(d(2, 3), lat=65.4, lon=3.0)]), ("2024-01-02", "2024-01-03"))
    row = gaps.first()
    assert row.note == "kept" and row.positions_hours_before == 9
    assert row.gap_id == base.first().gap_id
    assert row.duration_h == 27.0 and row.is_closed


def test_without_range_nothing_closes(spark):
    gaps = run_window(frame(spark, [message(d(2, 3))]), known(spark, d(1, 0), 9), None, Settings(threshold_h=24))
    assert gaps.count() == 0


def test_nested_output_and_passthrough(spark):
    rows = frame(spark, [message(d(1, 0)), message(d(2, 0))]).withColumn("sog", F.lit(3.5))
    flat = detect_gaps(rows).first()
    assert flat.start_sog == 3.5 and flat.end_sog == 3.5
    nested = detect_gaps(rows, Settings(normalize_output=False)).first()
    assert nested.OFF.timestamp == datetime(2024, 1, 1) and nested.ON.sog == 3.5
    assert "ssvid" not in nested.OFF.asDict() and nested.ssvid == A


def random_messages(seed, tracks=6, n=400, span_h=24 * 12, ties=True):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, tzinfo=UTC).timestamp()
    out = []
    for i in range(n):
        # one track holds a third of the messages, a burst holds many at one instant
        ssvid = "hot" if rng.random() < 0.33 else f"v{rng.randrange(tracks)}"
        step = rng.choice([1, 60, 600]) if rng.random() < 0.5 else 1800
        t = start + rng.randrange(0, span_h * 3600 // step) * step
        if rng.random() < 0.1:
            t += rng.randrange(1, 999_999) / 1e6
        if ties and rng.random() < 0.2:
            t = start + 3600 * rng.choice([5, 30, 77, 130])
        out.append({
            "ssvid": ssvid, "msgid": rng.choice([None, *"abcdef"]) , "seg_id": f"s{i}", "timestamp": t,
            "lat": round(rng.uniform(-90, 90), 2), "lon": round(rng.uniform(-180, 180), 2),
            "receiver_type": rng.choice(["terrestrial", "satellite", "dynamic", "unknown", None]),
            "distance_from_shore_m": None, "distance_from_port_m": None, "ais_class": None,
        })
    return out


def as_frame(spark, messages):
    rows = [tuple(datetime.fromtimestamp(m[c], UTC) if c == "timestamp" else m[c] for c in schemas.MESSAGE.names) for m in messages]
    return frame(spark, rows)


def record(gaps):
    out = set()
    for g in gaps.collect():
        seconds = lambda t: None if t is None else round(t.replace(tzinfo=UTC).timestamp(), 6)
        out.add((g.ssvid, seconds(g.start_timestamp), g.start_seg_id, seconds(g.end_timestamp), g.end_seg_id,
                 *[g[c] for c in schemas.COUNT_COLUMNS]))
    return out


def brute_record(result):
    out = set()
    for (key, _), (kind, off, on, counts) in result.items():
        assert kind in ("pair", "open")
        out.add((key[0], round(off["timestamp"], 6), off["seg_id"], on and round(on["timestamp"], 6), on and on["seg_id"], *counts))
    return out


STRATEGIES = {
    "broadcast": Settings(),
    "ranges": Settings(limits=Limits(broadcast_bytes=20_000)),
    "parts": Settings(limits=Limits(broadcast_bytes=600)),
    "bucketed": Settings(bucket_days=2),
    "bucketed_small": Settings(bucket_days=0.1, limits=Limits(broadcast_bytes=30_000)),
}


RULES = [(6, 12), (0.5, 12), (1 + 1 / 3, 3), (24, 12), (5, 0), (4, 31 / 7)]
COMBINED = [(n, t, h) for i, n in enumerate(STRATEGIES) for j, (t, h) in enumerate(RULES) if n == "broadcast" or (i + j) % 3 == 0]


@pytest.mark.parametrize("name,threshold,n_hours", COMBINED)
def test_random_against_brute_force(spark, name, threshold, n_hours):
    from dataclasses import replace

    settings = replace(STRATEGIES[name], threshold_h=threshold, n_hours_before=n_hours)
    messages = random_messages(seed=int(threshold * 7 + n_hours))
    start, end = at("2024-01-05").timestamp(), at("2024-01-11").timestamp()
    got = record(run_window(as_frame(spark, messages), None, ("2024-01-05", "2024-01-11"), settings))
    assert got == brute_record(brute.run(messages, threshold, n_hours, start, end))
    assert got


def test_random_with_known_open_gaps(spark):
    messages = random_messages(seed=5, n=120)
    start, end = at("2024-01-05").timestamp(), at("2024-01-11").timestamp()
    early = [m for m in messages if m["timestamp"] < start]
    opened = open_gaps(as_frame(spark, early), Settings(threshold_h=6), ("2024-01-01", "2024-01-05"))
    opened = opened.union(opened.withColumn("gap_id", F.lit("older")).withColumn("start_timestamp", F.col("start_timestamp") - F.expr("interval 1 hour")))
    opened_rows = [r.asDict() for r in opened.collect()]
    late = [m for m in messages if m["timestamp"] >= start - 86400]
    got = run_window(as_frame(spark, late), opened, ("2024-01-05", "2024-01-11"), Settings(threshold_h=6)).collect()
    want = brute.run(late, 6, 12, start, end, known_open=opened_rows)
    by_id = {(g.ssvid, g.start_timestamp): g for g in got}
    assert len(by_id) == len(got)
    closing = 0
    naive = lambda t: datetime.fromtimestamp(t, UTC).replace(tzinfo=None)
    seen = set()
    for (key, _), (kind, off, on, n) in want.items():
        off_at = off if kind == "close" else naive(off["timestamp"])
        if kind == "close" and any(k[0] == key and v[0] != "close" and naive(v[1]["timestamp"]) == off_at for k, v in want.items()):
            continue  # a pair or a new open gap of the same message replaces it
        gap = by_id[key[0], off_at]
        seen.add((key[0], off_at))
        assert (gap.end_timestamp is None) == (on is None)
        if on is not None:
            assert gap.end_timestamp == naive(on["timestamp"]) and gap.end_seg_id == on["seg_id"]
        closing += kind == "close"
    assert closing and seen == set(by_id)


def test_composite_key(spark):
    messages = random_messages(seed=9)
    for m in messages:
        m["seg_id"] = "s" + m["seg_id"][-1]
    settings = Settings(threshold_h=20, keys=("ssvid", "seg_id"))
    got = {(g.ssvid, g.start_seg_id, g.start_timestamp, g.positions_hours_before) for g in detect_gaps(as_frame(spark, messages), settings).collect()}
    want = {(k[0], k[1], datetime.fromtimestamp(v[1]["timestamp"], UTC).replace(tzinfo=None), v[3][0])
            for (k, _), v in brute.run(messages, 20, keys=("ssvid", "seg_id"), eval_last=False).items()}
    assert got == want


def test_copies_of_one_message(spark):
    copies = [message(d(1, 1), msgid="x")] * 50 + [message(d(1, 0)), message(d(1, 20))]
    for limits in (Limits(), Limits(broadcast_bytes=100)):
        gaps = detect_gaps(frame(spark, copies).repartition(7), Settings(limits=limits))
        row = gaps.collect()
        assert len(row) == 1 and row[0].positions_hours_before == 2
