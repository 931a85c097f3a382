"""Physical plans: what is read, what is shuffled, and where intermediate tables go."""

import os
import re
from types import SimpleNamespace

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harness import registry
from hushtrack import storage
from hushtrack.operators.detect import Settings, detect_gaps, find, prepare, run_window
from hushtrack.operators.fill import fill, requests
from hushtrack.operators.joins import Limits, slot_ranges
from hushtrack.operators.slots import Grid, Rules, neighbours, slot_summary
from hushtrack.plans.detect_job import DetectConfig, run_detect

from test_detect import as_frame, frame, message, random_messages

HOUR = 3_600_000_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "messages")
    as_frame(spark, random_messages(seed=2)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("threshold_h,look_back_h", [(6, 12), (12, 12), (24, 12), (80 / 60, 12), (7, 5.5), (0.1, 1), (5, 0), (0, 1)])
def test_grid(threshold_h, look_back_h):
    threshold, look_back = round(threshold_h * HOUR), round(look_back_h * HOUR)
    grid = Grid.of(threshold, look_back)
    assert (grid.width - 1) <= threshold  # no gap fits into a slot
    if look_back:
        assert grid.period * grid.reach == look_back * grid.parts
        assert grid.reach == -(-look_back // (threshold + 1)) or threshold < 1_000


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**11), st.integers(0, 10**12), st.integers(-(10**16), 10**16), st.integers(0, 10**16))
def test_slots_of_any_hours(threshold, look_back, us, anchor):
    """One slot never holds two instants a gap apart, and a look-back is a whole number of slots."""
    grid = Grid.of(threshold, look_back, anchor)
    slot = lambda t: (t - anchor) * grid.parts // grid.period
    assert grid.start(slot(us)) <= us < grid.start(slot(us) + 1)
    assert grid.start(slot(us) + 1) - grid.start(slot(us)) <= threshold + 1
    assert look_back == 0 or slot(us - look_back) == slot(us) - grid.reach
    offset = us - anchor
    rest = offset % grid.period
    assert (offset - rest) // grid.period * grid.parts + rest * grid.parts // grid.period == slot(us)


def test_first_pass_is_narrow_and_combines_before_the_shuffle(spark, stored):
    grid = Grid.of(6 * HOUR, 12 * HOUR)
    text = plan(neighbours(slot_summary(prepare(stored, ["ssvid"]), ["ssvid"], grid), ["ssvid"], grid))
    assert re.search(r"ReadSchema: struct<ssvid:string,timestamp:timestamp,receiver_type:string>", text)
    # partial aggregate -> exchange -> final aggregate -> exchange of the slots -> one window
    assert text.count("HashAggregate(") == 2 and text.count("Exchange hashpartitioning") == 2
    assert text.count("Window [") == 1 and "SortAggregate" not in text


def test_second_pass_does_not_shuffle_messages(spark, stored):
    rules, keys = Rules(6 * HOUR, 12 * HOUR), ["ssvid"]
    tracks = prepare(stored, keys)
    found = find(tracks, rules, keys, Settings(), None)
    text = plan(fill(tracks, found, rules, keys, Limits()))
    join = text[text.index("BroadcastHashJoin"):]
    assert "Exchange hashpartitioning" not in join and "SortMergeJoin" not in text
    wanted = requests(found, rules, keys)
    made = wanted.groupBy("ssvid", "_gap").count().agg({"count": "max"}).first()[0]
    assert made <= 5
    # Whatever the number of requests: each range is one broadcast, and reads its own time only.
    few = Limits(broadcast_bytes=2_000)
    ranges = slot_ranges(wanted, keys, few)
    assert len(ranges) > 2 and ranges == sorted(ranges, key=lambda r: (r.first, r.part))
    assert sum(wanted.where(r.where(keys)).count() for r in ranges) == wanted.count()
    order = lambda df: sorted(map(str, df.collect()))
    assert order(fill(tracks, found, rules, keys, few)) == order(fill(tracks, found, rules, keys, Limits()))


def test_range_prunes_the_scan(spark, stored):
    gaps = run_window(stored, None, ("2024-01-05", "2024-01-07"), Settings(threshold_h=6))
    text = plan(gaps)
    assert "GreaterThanOrEqual(timestamp" in text
    assert "LessThan(timestamp" in text


def test_intermediate_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get(storage.CHECKPOINT_CONF)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    detect_gaps(frame(spark, [message("2024-01-01 00:00")]))
    assert any(n.startswith("silences-") for n in set(os.listdir(folder)) - before)


def test_a_mounted_shared_folder_serves_a_cluster(spark, monkeypatch):
    folder = spark.conf.get(storage.CHECKPOINT_CONF)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    assert storage.shared_folder(spark) == folder
    gaps = detect_gaps(frame(spark, [message("2024-01-01 00:00"), message("2024-01-03 00:00")]))
    assert gaps.count() == 1


def test_open_gaps_are_published_on_a_cluster(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    events = registry.QUERIES["gap_events_open"](spark, sf_dir)
    db = duckdb.connect()
    for name in ("events", "customer", "nation"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    of_each = "SELECT event_id, count(*) FROM ({}) GROUP BY event_id"
    want = db.execute(of_each.format(registry.ORACLES["gap_events_open"])).fetchall()
    assert sorted(map(tuple, events.groupBy("event_id").count().collect())) == sorted(want)
    assert events.where("event_end IS NULL").count() > 0


def test_a_folder_given_to_the_context_is_the_shared_one(tmp_path):
    conf = SimpleNamespace(get=lambda key, default: default)
    for master in ("local[4]", "spark://elsewhere:7077"):
        context = SimpleNamespace(master=master, applicationId="x", getCheckpointDir=lambda: str(tmp_path))
        assert storage.shared_folder(SimpleNamespace(conf=conf, sparkContext=context)) == str(tmp_path)
    nowhere = SimpleNamespace(master="spark://elsewhere:7077", applicationId="x", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(SimpleNamespace(conf=conf, sparkContext=nowhere))


def test_jobs_want_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            run_detect(spark, DetectConfig("2024-01-01", "2024-01-02", json_messages="x"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
