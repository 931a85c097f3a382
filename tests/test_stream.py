"""Messages by day, ranges of slots, derived windows, and detection over a stream."""

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hushtrack.operators import detect, slots
from hushtrack.operators.detect import Settings, detect_gaps, run_window
from hushtrack.operators.joins import Limits, slot_ranges
from hushtrack.operators.slots import Rules, window_us
from hushtrack.plans.detect_job import DetectConfig
from hushtrack.sources.messages import select_messages, write_by_day
from hushtrack.streaming.incremental import ranges, run_daily
from hushtrack.streaming.microbatch import Progress, detect_stream, finish, process_batch

from test_detect import as_frame, random_messages, record

DAY = 86_400_000_000


def rows(gaps):
    return sorted((r.gap_id, str(r.end_timestamp), r.is_closed, r.positions_hours_before) for r in gaps.collect())


@pytest.fixture(scope="module")
def raw(spark):
    return as_frame(spark, random_messages(seed=5))


@pytest.fixture(scope="module")
def by_day(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("days") / "messages")
    write_by_day(raw, path)
    return spark.read.parquet(path)


def test_day_layout_prunes_folders_and_keeps_gaps(spark, raw, by_day):
    near = select_messages(by_day, start_date="2024-01-03", end_date="2024-01-05")
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "message_day" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    opened = near.select(F.input_file_name().alias("f")).distinct().collect()
    assert opened and all("message_day=2024-01-03" in r.f or "message_day=2024-01-04" in r.f for r in opened)
    few = Settings(threshold_h=6, limits=Limits(broadcast_bytes=4_000))
    got = detect_gaps(select_messages(by_day), few)
    assert not [c for c in got.columns if "message_day" in c]
    assert record(got) == record(detect_gaps(select_messages(raw), Settings(threshold_h=6)))


@pytest.mark.parametrize("most", [1, 100, 3_000, 1 << 30])
def test_ranges_hold_every_request_once(spark, most):
    """Slots far apart and all but equal ones, negative ones, and one slot larger than the limit."""
    values = [-(1 << 40), -5, -4, -4, 0, 1, 2, *[7] * 40, *range(1_000, 1_060), 1 << 50, (1 << 50) + 1]
    asked = spark.createDataFrame([(f"k{i % 9}", s) for i, s in enumerate(values)], "ssvid string, _slot long")
    found = slot_ranges(asked, ["ssvid"], Limits(broadcast_bytes=most))
    assert sum(asked.where(r.where(["ssvid"])).count() for r in found[:40]) == len(values) or len(found) > 40
    covered = [s for s in values if sum(r.first <= s <= r.last and r.part == 0 for r in found) == 1]
    assert covered == values
    assert all(r.parts == 1 or r.first == r.last for r in found)
    assert slot_ranges(asked.limit(0), ["ssvid"], Limits(broadcast_bytes=most)) == []


def test_window_is_derived(spark, raw, monkeypatch):
    tracks = raw.withColumn("_us", F.unix_micros("timestamp"))
    rules = lambda start, end: Rules(1, 0, earliest_off_us=start, range_start_us=start, range_end_us=end)
    hours = Rules(6 * DAY // 24, DAY, earliest_off_us=0, range_start_us=0, range_end_us=30 * DAY)
    assert window_us(tracks, ["ssvid"], hours, None) is None
    assert window_us(tracks, ["ssvid"], hours, 5) == 5 * DAY
    assert window_us(tracks, ["ssvid"], hours, 500) == 180 * DAY
    assert window_us(tracks, ["ssvid"], rules(0, 400 * DAY), None) == 180 * DAY
    monkeypatch.setattr(slots, "WINDOW_SLOTS", 50)
    cut = window_us(tracks, ["ssvid"], Rules(0, 0), None)
    most, low, high = tracks.groupBy("ssvid").agg(F.count("*").alias("n"), F.min("_us").alias("a"), F.max("_us").alias("b")).agg(
        F.max("n"), F.min("a"), F.max("b")).first()
    assert most > 100 and cut == (high - low) // -(-most // 50)
    tight = Settings(threshold_h=0.001, n_hours_before=1)
    called, bucketed = [], detect.neighbours_bucketed
    monkeypatch.setattr(detect, "neighbours_bucketed", lambda *a: called.append(a) or bucketed(*a))
    split = run_window(raw, None, None, tight, eval_last=False)
    assert len(called) == 1
    monkeypatch.setattr(slots, "WINDOW_SLOTS", 1_000_000)
    assert record(split) == record(run_window(raw, None, None, tight, eval_last=False))
    assert len(called) == 1


def config(spark, tmp_path, raw, **more):
    return DetectConfig("2024-01-01", "2024-01-13", messages=raw, segments=raw.select("seg_id").distinct(),
                        gaps_path=str(tmp_path / "gaps"), min_gap_length_h=6, **more)


@given(st.lists(st.tuples(st.integers(1, 28), st.integers(0, 9)), max_size=8), st.sampled_from([None, 1, 3]))
@settings(max_examples=200, deadline=None)
def test_runs_join_up(spans, days_per_run):
    """Runs follow each other without a hole and begin where an earlier one began or ended."""
    c = DetectConfig("2024-01-03", "2024-01-25", json_messages="x", min_gap_length_h=30)
    start = date(2024, 1, 3)
    made = Progress((start,), start)
    for first, more in spans:
        low, high = date(2024, 1, first), date(2024, 1, min(first + more, 31))
        after, runs = made.after(c, low, high, days_per_run)
        if runs:
            assert runs[0][0] in (*made.starts, made.done) and runs[-1][1] == after.done
            assert all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
        assert after.done == max(made.done, min(high, date(2024, 1, 25)))
        if low < made.done and made.done > start:
            assert runs and (runs[0][0] - low).days <= -2 or runs[0][0] == start
        made = after


@pytest.mark.parametrize("days_per_run", [None, 4])
def test_stream_with_late_messages_equals_one_run(spark, raw, tmp_path, days_per_run):
    first = config(spark, tmp_path, raw)
    whole = rows(run_daily(spark, first, ranges("2024-01-01", "2024-01-13", 12)))
    arrivals, stored, state = (str(tmp_path / n) for n in ("arrivals", "stored", "state"))
    streamed = config(spark, tmp_path / "streamed", raw)
    late = F.pmod(F.xxhash64("msgid", "timestamp"), F.lit(7)) == 0
    part = F.when(F.col("timestamp") < "2024-01-05", 0).otherwise(1) + F.when(late, 1).otherwise(0)
    for number in range(3):
        raw.where(part == number).write.mode("append").parquet(arrivals)
        detect_stream(spark.readStream.schema(raw.schema).parquet(arrivals), streamed, stored, state, days_per_run=days_per_run).awaitTermination()
    # The last batch is repeated, as after a failure.
    process_batch(streamed, stored, days_per_run)(raw.where(part == 2), 2)
    assert rows(finish(spark, streamed, stored, days_per_run)) == whole
    assert rows(finish(spark, streamed, stored, days_per_run)) == whole


def test_stream_wants_a_table_and_survives_empty_batches(spark, raw, tmp_path):
    with pytest.raises(ValueError):
        detect_stream(raw, DetectConfig("2024-01-01", "2024-01-02", json_messages="x"), "p", "c")
    streamed = config(spark, tmp_path, raw)
    process = process_batch(streamed, str(tmp_path / "stored"))
    process(raw.limit(0), 0)
    process(raw, 1)
    assert finish(spark, streamed, str(tmp_path / "stored")).count() > 0
