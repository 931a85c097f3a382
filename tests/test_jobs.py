import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from hushtrack import schemas
from hushtrack.errors import ConflictingChangeError, InsufficientSegmentsDataError
from hushtrack.operators import versions
from hushtrack.operators.detect import Settings, detect_gaps
from hushtrack.plans import detect_job, reports
from hushtrack.plans.detect_job import DetectConfig, read_messages, read_open_gaps, run_detect, segments_readiness
from hushtrack.sources.messages import in_days, read_json_messages, select_messages, union_sources
from hushtrack.sources.tables import GapsTable, conform, read_json_gaps
from hushtrack.streaming.incremental import ranges, run_daily

from test_detect import as_frame, at, message, random_messages, frame


def json_message(ssvid, when, **more):
    return {"ssvid": ssvid, "msgid": f"{ssvid}-{when}", "seg_id": f"seg-{ssvid}", "timestamp": when,
            "receiver_type": "satellite", "lat": 1.0, "lon": 2.0, **more}


@pytest.fixture()
def lines(tmp_path):
    rows = [json_message("a", 1704067200), json_message("a", 1704110400.5, type="AIS.1"),
            json_message("b", "2024-01-01 10:00:00 UTC", ais_class="B"), json_message("b", "2024-01-05 10:00:00 UTC")]
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    array = tmp_path / "array.json"
    array.write_text(json.dumps(rows, indent=2))
    return str(path), str(array)


def test_json_sources(spark, lines):
    for path, per_line in zip(lines, (True, False)):
        got = read_json_messages(spark, path, lines=per_line)
        assert [r[0] for r in got.orderBy("ssvid", "timestamp").select(F.unix_micros("timestamp")).collect()] == [
            1704067200000000, 1704110400500000, 1704103200000000, 1704448800000000]
    kept = select_messages(read_json_messages(spark, lines[0]), start_date="2024-01-01", end_date="2024-01-05")
    assert kept.columns == schemas.MESSAGE.names
    assert [r.ais_class for r in kept.orderBy("msgid").collect()] == [None, "A", "B"]


def test_filters(spark):
    rows = frame(spark, [message("2024-01-01 00:00", "a"), message("2024-01-02 00:00", "b", seg="bad"), message("2024-01-03 00:00", "a")])
    segments = spark.createDataFrame([("123456", True, False), ("bad", None, None)], "seg_id string, good_seg2 boolean, overlapping_and_short boolean")
    assert select_messages(rows, end_date="2024-01-03").count() == 2
    assert select_messages(rows, ssvids=["b"]).count() == 1
    assert select_messages(rows, ssvids=[str(i) for i in range(2000)] + ["a"]).count() == 2
    assert select_messages(rows, segments).count() == 3
    assert select_messages(rows, segments, filter_good_seg=True).count() == 2
    assert select_messages(rows, segments, filter_not_overlapping_and_short=True).count() == 2
    assert union_sources([rows, rows.drop("lon")]).count() == 6


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "messages")
    frame(spark, [message("2024-01-01 00:00")]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = stored.where(in_days(stored, "timestamp", "2024-01-01", "2024-01-02"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan


def test_config_is_validated():
    with pytest.raises(ValueError):
        DetectConfig("2024-01-01", "2024-01-02")
    with pytest.raises(ValueError):
        DetectConfig("2024-01-02", "2024-01-02", json_messages="x")
    assert DetectConfig("2024-01-02", "2024-01-03", json_messages="x", n_hours_before=25).read_from == date(2023, 12, 31)


def version_rows(spark):
    at_ = lambda d: datetime(2024, 1, d)
    rows = []
    for gap, start, end, closed, version in [
        ("g1", 1, None, False, 2), ("g1", 1, 5, True, 5), ("g2", 3, None, False, 4), ("g3", 2, 3, True, 3), ("g3", 2, 3, True, 3),
        ("g4", 6, None, False, 7),
    ]:
        rows.append((gap, "v", at_(version), start, 0, 0, 0, None, None, None, at_(start), "m", "s", None, None, None, None, None, None,
                     None if end is None else at_(end), None, None, None, None, None, None, None, None, closed))
    return spark.createDataFrame(rows, schemas.GAP)


@pytest.mark.parametrize(
    "values",
    [{"filter_good_seg": True}, {"filter_not_overlapping_and_short": True}, {"good_seg_stabilization_days": -1},
     {"min_gap_length_h": -6}, {"n_hours_before": -1}, {"keys": ()}, {"end_date": "2024-01-01"}],
)
def test_config_is_checked_before_any_work(values):
    with pytest.raises(ValueError):
        DetectConfig(**{"start_date": "2024-01-01", "end_date": "2024-01-02", "json_messages": "x", **values})


def test_sources_without_segments_pass_the_segment_filter(spark, lines):
    segments = spark.createDataFrame([("other", True, False)], "seg_id string, good_seg2 boolean, overlapping_and_short boolean")
    rows = read_json_messages(spark, lines[0]).drop("seg_id")
    config = DetectConfig("2024-01-01", "2024-01-06", messages=rows, segments=segments, filter_good_seg=True, min_gap_length_h=6, eval_last=False)
    assert run_detect(spark, config).count() == 2
    known = DetectConfig("2024-01-01", "2024-01-06", messages=read_json_messages(spark, lines[0]), segments=segments, min_gap_length_h=6)
    assert run_detect(spark, known).count() == 0


def test_table_keeps_key_columns_and_has_a_view_of_its_own(spark, tmp_path):
    keys = ("ssvid", "fleet")
    rows = frame(spark, [message("2024-01-01 10:00"), message("2024-01-03 10:00")]).withColumn("fleet", F.lit("north"))
    table, other = (GapsTable(spark, str(tmp_path / n), keys) for n in ("gaps", "more"))
    table.create()
    table.create()
    gaps = detect_gaps(rows, Settings(threshold_h=6, keys=keys))
    table.append(gaps)
    assert [r.fleet for r in table.read().collect()] == ["north"]
    assert table.view_name != other.view_name
    table.create_last_versions_view()
    assert spark.table(table.view_name).count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_versions_read_the_input_once(spark, tmp_path):
    """A column that differs between evaluations, and a filter that reaches one side of a join, lose no gap."""
    gaps = version_rows(spark).withColumn("distance_m", F.rand())
    latest = versions.last_versions(gaps)
    assert plan(latest).count("Scan") + plan(latest).count("LocalTable") == 1
    for _ in range(3):
        assert versions.select_gaps(gaps, end_date="2024-01-05").count() == 1
        assert latest.where("end_timestamp < timestamp'2024-02-01'").count() == 2
    assert versions.last_versions(gaps.unionByName(gaps)).count() == 4


def test_stored_versions(spark, tmp_path):
    table = GapsTable(spark, str(tmp_path / "gaps"))
    rows = version_rows(spark)
    table.append(rows.limit(3))
    table.append(rows)  # rows stored twice are one gap still
    latest = table.last_versions()
    assert state(latest.drop("start_month"), True) == state(versions.last_versions(rows), True)
    text = plan(latest.where("not is_closed and start_month = date'2024-01-01'"))
    assert "SortAggregate" not in text and "LeftSemi" in text
    scans = [part for part in text.split("FileScan parquet")[1:]]
    assert len(scans) == 2 and all("start_month" in s.partition("PartitionFilters: ")[2].split("]")[0] for s in scans), text
    assert sorted("EqualTo(is_closed" in s.split("ReadSchema")[0] for s in scans) == [False, True]  # the filter is on whole rows only
    search = table.read().where(versions.to_be_recreated("2024-01-02"))
    assert "PushedFilters: [Or(" in plan(search)


def test_versions(spark):
    gaps = version_rows(spark)
    ids = lambda df: sorted(r.gap_id for r in df.collect())
    assert {(r.gap_id, r.is_closed) for r in versions.last_versions(gaps).collect()} == {("g1", True), ("g2", False), ("g3", True), ("g4", False)}
    assert versions.last_versions(gaps).columns == gaps.columns
    assert ids(versions.last_versions_with_ties(gaps)) == ["g1", "g2", "g3", "g3", "g4"]
    # g1 was open once, but its latest version is closed.
    assert ids(versions.select_gaps(gaps, is_closed=False)) == ["g2", "g4"]
    assert ids(versions.carried_open_gaps(gaps, "2024-01-04")) == ["g4"]
    reopened = gaps.unionByName(gaps.where("gap_id = 'g1' and not is_closed").withColumn("version", F.lit("2024-01-09").cast("timestamp")))
    for rows in (gaps, reopened, reopened.unionByName(reopened.where("gap_id = 'g2'"))):
        one, two = versions.carried_open_gaps(rows, "2024-01-01"), versions.select_gaps(rows, "2024-01-01", is_closed=False)
        assert state(one, True) == state(two, True) and one.columns == two.columns
    assert ids(versions.select_gaps(gaps, end_date="2024-01-05")) == ["g3"]
    assert ids(versions.select_gaps(gaps, start_date="2024-01-02", ssvids=["v"], is_closed=True)) == ["g3"]
    assert [(r.gap_id, r.is_closed) for r in versions.without_recreated(gaps, "2024-01-05").orderBy("gap_id").collect()] == [
        ("g1", False), ("g2", False), ("g3", True), ("g3", True)]


def test_table_delete_rewrites_and_empties_months(spark, tmp_path):
    table = GapsTable(spark, str(tmp_path / "gaps"))
    table.create()
    table.create()
    assert table.read().count() == 0
    gaps = version_rows(spark)
    later = gaps.where("gap_id = 'g4'").withColumn("start_timestamp", F.lit("2024-03-05").cast("timestamp"))
    before = gaps.where("gap_id = 'g3'").limit(1).withColumn("start_timestamp", F.lit("2023-11-05").cast("timestamp"))
    table.append(gaps.unionByName(later).unionByName(before))
    assert table.read().select("start_month").distinct().count() == 3
    table.delete_recreated("2024-01-05")
    left = table.read()
    assert sorted((r.gap_id, str(r.start_month)) for r in left.collect()) == [
        ("g1", "2024-01-01"), ("g2", "2024-01-01"), ("g3", "2023-11-01"), ("g3", "2024-01-01"), ("g3", "2024-01-01")]
    table.delete_recreated("2024-01-05")
    assert left.count() == table.read().count()
    assert table.create_last_versions_view("latest").count() == 4
    assert spark.sql("select * from latest where not is_closed").count() == 2
    with pytest.raises(ValueError, match="is_closed"):
        conform(gaps.drop("is_closed"), schemas.GAP)


def test_rerun_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    table = GapsTable(spark, str(tmp_path / "gaps"))
    gaps = version_rows(spark)
    table.append(gaps)
    before, reader = state(table.read(), True), table.read()
    with monkeypatch.context() as patch:
        patch.setattr(detect_job, "detect", lambda *a: 1 / 0)
        config = DetectConfig("2024-01-02", "2024-01-09", messages=frame(spark, [message("2024-01-03 10:00")]),
                              segments=spark.createDataFrame([], "seg_id string, last_timestamp timestamp, good_seg2 boolean, overlapping_and_short boolean"),
                              gaps_path=table.path)
        with pytest.raises(ZeroDivisionError):
            run_detect(spark, config)
    assert state(table.read(), True) == before
    half = table.begin().delete_recreated("2024-01-02")
    assert half.read().count() < len(before)
    assert state(table.read(), True) == before
    half.append(gaps.limit(1)).commit()
    assert table.read().count() == half.read().count()
    assert state(reader, True) == before  # a reader keeps the snapshot it began with
    late = table.begin()
    table.append(gaps.limit(1))
    with pytest.raises(ConflictingChangeError):
        late.append(gaps).commit()
    rows = state(table.read(), True)
    table.compact()
    assert state(table.read(), True) == rows and len(table.snapshots.parts()) == 1
    table.snapshots.vacuum(keep=1)
    assert state(table.read(), True) == rows and len(os.listdir(tmp_path / "gaps" / "rows")) == 1


def test_lasting_views(spark, tmp_path):
    table = GapsTable(spark, str(tmp_path / "gaps"))
    gaps = version_rows(spark)
    table.append(gaps.limit(2))
    table.catalogue("lasting_gaps")
    other = spark.newSession()
    assert other.table("lasting_gaps").count() == 2
    table.append(gaps.exceptAll(gaps.limit(2)))
    assert other.table("lasting_gaps").count() == 2  # until the view is replaced
    table.catalogue("lasting_gaps")
    assert state(other.table("lasting_gaps").drop("start_month"), True) == state(gaps, True)
    latest = other.table("lasting_gaps_last_versions")
    assert state(latest.drop("start_month"), True) == state(versions.last_versions(gaps), True)
    table.delete_recreated("2023-01-01")
    table.catalogue("lasting_gaps")
    assert other.table("lasting_gaps_last_versions").count() == 0
    layout = other.sql("describe table extended lasting_gaps_rows").collect()
    assert {"commit", "start_month"} <= {r.col_name for r in layout}


def test_gate(spark):
    segments = spark.createDataFrame([("s", at("2024-01-10 05:00"), True, False)], "seg_id string, last_timestamp timestamp, good_seg2 boolean, overlapping_and_short boolean")
    ready = lambda end, n: segments_readiness(segments, end, n).first()
    assert ready("2024-01-08", 3).is_ready and not ready("2024-01-08", 4).is_ready
    assert not segments_readiness(segments.limit(0), "2024-01-08", 3).first().is_ready
    config = dict(start_date="2024-01-08", end_date="2024-01-09", messages=frame(spark, [message("2024-01-08 01:00", seg="s")]), segments=segments)
    with pytest.raises(InsufficientSegmentsDataError):
        run_detect(spark, DetectConfig(**config, filter_good_seg=True, good_seg_stabilization_days=5))
    assert run_detect(spark, DetectConfig(**config, good_seg_stabilization_days=5)).count() == 1
    assert run_detect(spark, DetectConfig(**config, filter_good_seg=True, good_seg_stabilization_days=2)).count() == 1


@pytest.fixture(scope="module")
def tracks(spark):
    messages = random_messages(seed=11, n=150, ties=False)
    for m in messages:
        m["msgid"] = m["seg_id"]
    segments = spark.createDataFrame([(m["seg_id"],) for m in messages], "seg_id string")
    segments = segments.selectExpr("seg_id", "true good_seg2", "false overlapping_and_short")
    return as_frame(spark, messages), segments


def state(df, with_version=False):
    skip = {"version"} if not with_version else set()
    return sorted((tuple(str(r[c]) for c in schemas.GAP.names if c not in skip)) for r in df.collect())


def test_replay_equals_backfill_and_is_idempotent(spark, tmp_path, tracks):
    messages, segments = tracks
    config = lambda name, **k: DetectConfig("2024-01-01", "2024-01-13", messages=messages, segments=segments, gaps_path=str(tmp_path / name), **k)
    stepwise = run_daily(spark, config("steps"), ranges("2024-01-01", "2024-01-13", 4), version_of_range_end=True)
    replayed = state(stepwise)
    at_once = run_detect(spark, config("once"))
    assert replayed == state(at_once) and len(replayed) > 20
    # The last range again: the versions change, nothing else does.
    again = run_daily(spark, config("steps"), [(date(2024, 1, 9), date(2024, 1, 13))])
    assert state(again) == replayed
    rerun = run_daily(spark, config("steps"), list(ranges("2024-01-05", "2024-01-13", 4)))
    assert state(rerun) == replayed


def test_sources_of_open_gaps_and_json_output(spark, tmp_path, lines):
    out = str(tmp_path / "gaps-json")
    first = DetectConfig("2024-01-01", "2024-01-03", json_messages=lines[0], json_output=out, version=datetime(2024, 1, 3, tzinfo=timezone.utc))
    assert read_messages(spark, first).count() == 3
    gaps = run_detect(spark, first)
    saved = read_json_gaps(spark, out)
    assert state(saved, True) == state(gaps, True) and saved.where("not is_closed").count() == 2
    later = dict(start_date="2024-01-05", end_date="2024-01-06", json_messages=lines[0])
    assert read_open_gaps(spark, DetectConfig(**later)) is None
    assert read_open_gaps(spark, DetectConfig(**later, json_open_gaps=out, skip_open_gaps=True)) is None
    assert read_open_gaps(spark, DetectConfig(**later, json_open_gaps=out, open_gaps_start_date="2024-01-05")) is None
    closed = run_detect(spark, DetectConfig(**later, json_open_gaps=out)).where("is_closed").collect()
    assert [(r.ssvid, r.start_timestamp.day, r.end_timestamp.day) for r in closed] == [("b", 1, 5)]
    assert run_detect(spark, DetectConfig(**later, open_gaps=saved)).where("is_closed").count() == 1
    nested = run_detect(spark, DetectConfig("2024-01-01", "2024-01-03", json_messages=lines[0], normalize_output=False))
    assert "OFF" in nested.columns
    more = run_detect(spark, DetectConfig("2024-01-01", "2024-01-03", json_messages=lines[0], passthrough="msg_rank int, type string"))
    assert {"start_msg_rank", "end_type"} <= set(more.columns)


def test_reports(spark):
    gaps = version_rows(spark).where("version is not null").withColumn("flag", F.when(F.col("gap_id") == "g3", "ESP").otherwise("ARG"))
    assert {(str(r.day), r.gaps) for r in reports.gaps_per_day(gaps).collect()} == {("2024-01-01", 2), ("2024-01-02", 2), ("2024-01-03", 1), ("2024-01-06", 1)}
    row = reports.monthly_difference(gaps.where("is_closed"), gaps).first()
    assert (row.gaps_filtered, row.gaps_unfiltered, row.difference, row.average_difference) == (3, 6, 3, 3)
    assert [(r.flag, r.gaps) for r in reports.top_flags(gaps, 1).collect()] == [("ARG", 4)]
    assert reports.gaps_per_grid_cell(gaps).count() == 0
