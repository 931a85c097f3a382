"""Registered queries: one callable and, where SQL can say it, one oracle per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushtrack import schemas
from hushtrack.functions import text, units
from hushtrack.functions.cells import cell
from hushtrack.functions.time import as_date, epoch_seconds
from hushtrack.operators import versions
from hushtrack.operators.joins import Limits
from hushtrack.operators.detect import Settings, close_open_gaps, detect_gaps, open_gaps, run_window
from hushtrack.plans import publish, reports
from hushtrack.plans.detect_job import (
    DetectConfig,
    read_messages,
    read_open_gaps,
    segment_filter,
    segments_readiness,
)
from hushtrack.sources import messages as sources
from hushtrack.sources import tables
from hushtrack.storage import fresh_path, written
from hushtrack.streaming import microbatch
from hushtrack.streaming.incremental import ranges, run_daily

from harness import derived, oracles as sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Days covered by the events table, and the day at which two runs meet.
FIRST, MIDDLE, LAST = "2024-01-01", "2024-01-16", "2024-01-31"

_DISTANCE = ("distance_m", "implied_speed_knots")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _zoneless(build(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def _zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time and days as text, which read the same everywhere."""
    as_type = {T.TimestampType: "timestamp_ntz", T.DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(as_type.get(type(f.dataType), f.dataType)).alias(f.name)
            for f in df.schema
        ]
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in table form, without any filter."""
    return sources.select_messages(derived.raw_messages(spark, sf_dir))


def _stamp(day: str) -> datetime:
    return datetime.fromisoformat(day).replace(tzinfo=timezone.utc)


def _plain(gaps: DataFrame, *more: str) -> DataFrame:
    """Columns the oracle has too: everything but the run's stamp and the distances."""
    return gaps.drop("version", *_DISTANCE, *more)


# ------------------------------------------------------------------ sources


@query(
    "messages_scan",
    sql.with_cte(
        sql.MESSAGES,
        body=f"SELECT {sql.MESSAGE_COLUMNS} FROM messages "
        "WHERE timestamp >= TIMESTAMP '2024-01-03' AND timestamp < TIMESTAMP '2024-01-29'",
    ),
)
def messages_scan(spark, sf_dir):
    return sources.select_messages(
        derived.raw_messages(spark, sf_dir), start_date="2024-01-03", end_date="2024-01-29"
    )


@query(
    "messages_good_seg",
    sql.with_cte(
        sql.MESSAGES,
        sql.SEGS,
        body=f"SELECT {sql.MESSAGE_COLUMNS} FROM messages WHERE seg_id IN "
        "(SELECT seg_id FROM segs_activity WHERE good_seg2 AND NOT overlapping_and_short)",
    ),
)
def messages_good_seg(spark, sf_dir):
    return sources.select_messages(
        derived.raw_messages(spark, sf_dir),
        derived.segs_activity(spark, sf_dir),
        filter_good_seg=True,
        filter_not_overlapping_and_short=True,
    )


@query(
    "messages_json",
    sql.with_cte(sql.MESSAGES, body=f"SELECT {sql.MESSAGE_COLUMNS}, us / 1e6 AS seconds FROM messages"),
)
def messages_json(spark, sf_dir):
    """Messages through JSON lines with float seconds, as a file source delivers them."""
    path = fresh_path(spark, "messages-json")
    raw = derived.raw_messages(spark, sf_dir)
    raw.withColumn("timestamp", epoch_seconds("timestamp")).write.json(path)
    read = sources.select_messages(sources.read_json_messages(spark, path))
    return read.withColumn("seconds", epoch_seconds("timestamp"))


@query(
    "messages_union",
    sql.with_cte(
        sql.MESSAGES,
        body=f"SELECT {sql.MESSAGE_COLUMNS} FROM messages UNION ALL "
        "SELECT ssvid, msgid, NULL, timestamp, lat, lon, receiver_type, NULL, NULL, ais_class FROM messages",
    ),
)
def messages_union(spark, sf_dir):
    """Two sources, one of which lacks some columns."""
    full = _messages(spark, sf_dir)
    narrow = full.drop("seg_id", "distance_from_shore_m", "distance_from_port_m")
    return sources.union_sources([full, narrow])


_SOME_VESSELS = [str(k) for k in range(0, 3000, 2)]


@query(
    "messages_of_vessels",
    sql.with_cte(
        sql.MESSAGES,
        body=f"SELECT {sql.MESSAGE_COLUMNS}, 'long' AS list FROM messages WHERE CAST(ssvid AS BIGINT) % 2 = 0 AND CAST(ssvid AS BIGINT) < 3000 "
        f"UNION ALL SELECT {sql.MESSAGE_COLUMNS}, 'short' FROM messages WHERE ssvid IN ('0', '2', '4')",
    ),
)
def messages_of_vessels(spark, sf_dir):
    """A long and a short list of vessels give the same columns."""
    raw = derived.raw_messages(spark, sf_dir)
    long = sources.select_messages(raw, ssvids=_SOME_VESSELS).withColumn("list", F.lit("long"))
    return long.union(sources.select_messages(raw, ssvids=_SOME_VESSELS[:3]).withColumn("list", F.lit("short")))


@query(
    "messages_mixed_sources",
    sql.with_cte(
        sql.MESSAGES,
        sql.SEGS,
        body=f"SELECT {sql.MESSAGE_COLUMNS} FROM messages WHERE CAST(ssvid AS BIGINT) % 2 = 0 AND seg_id IN "
        f"(SELECT seg_id FROM segs_activity WHERE good_seg2) UNION ALL "
        f"SELECT {sql.MESSAGE_COLUMNS.replace('seg_id', 'NULL')} FROM messages WHERE CAST(ssvid AS BIGINT) % 2 = 1",
    ),
)
def messages_mixed_sources(spark, sf_dir):
    """A table whose segments are filtered beside JSON lines that know no segments."""
    raw = derived.raw_messages(spark, sf_dir)
    odd = F.pmod(F.col("ssvid").cast("bigint"), F.lit(2)) == 1
    path = fresh_path(spark, "mixed-json")
    raw.where(odd).drop("seg_id").withColumn("timestamp", epoch_seconds("timestamp")).write.json(path)
    config = DetectConfig(
        FIRST,
        "2024-02-01",
        messages=raw.where(~odd),
        segments=derived.segs_activity(spark, sf_dir),
        json_messages=path,
        filter_good_seg=True,
    )
    return segment_filter(spark, config)(read_messages(spark, config))


@query("messages_multiline", sql.with_cte(sql.MESSAGES, body=f"SELECT {sql.MESSAGE_COLUMNS} FROM messages"))
def messages_multiline(spark, sf_dir):
    """Files that hold one JSON array each."""
    raw = derived.raw_messages(spark, sf_dir).withColumn("timestamp", epoch_seconds("timestamp"))
    path = fresh_path(spark, "messages-arrays")
    file = F.pmod(F.xxhash64("msgid"), F.lit(64)).alias("file")
    arrays = raw.groupBy(file).agg(F.to_json(F.collect_list(F.struct(*raw.columns))).alias("value"))
    arrays.write.partitionBy("file").text(path)
    read = sources.read_json_messages(spark, f"{path}/*/*.txt", lines=False)
    return sources.select_messages(read)


# ------------------------------------------------------------------ detection

_CLOSED = sql.with_cte(sql.MESSAGES, sql.paired(), body=sql.closed(12))


@query("gaps_closed", _CLOSED)
def gaps_closed(spark, sf_dir):
    return _plain(detect_gaps(_messages(spark, sf_dir)))


@query("gaps_bucketed", _CLOSED)
def gaps_bucketed(spark, sf_dir):
    return _plain(detect_gaps(_messages(spark, sf_dir), Settings(bucket_days=5)))


@query(
    "gaps_closed_from_start",
    sql.with_cte(sql.MESSAGES, sql.paired(), body=sql.closed(6, f"timestamp >= TIMESTAMP '{MIDDLE}'")),
)
def gaps_closed_from_start(spark, sf_dir):
    return _plain(detect_gaps(_messages(spark, sf_dir), Settings(threshold_h=6), start_time=MIDDLE))


@query(
    "gaps_short_threshold",
    sql.with_cte(
        sql.MESSAGES, sql.paired(n_us=3 * sql.HOUR), body=sql.closed(80 / 60)
    ),
)
def gaps_short_threshold(spark, sf_dir):
    """Threshold of 1 h 20 min, look-back of 3 h."""
    settings = Settings(threshold_h=80 / 60, n_hours_before=3)
    return _plain(detect_gaps(_messages(spark, sf_dir), settings))


@query(
    "gaps_nested",
    sql.with_cte(
        sql.MESSAGES,
        sql.paired(),
        body=f"SELECT {sql.gap_id()} AS gap_id, ssvid, timestamp AS off_timestamp, msgid AS off_msgid, "
        f"end_timestamp AS on_timestamp, end_msgid AS on_msgid, end_ais_class AS on_ais_class "
        f"FROM paired WHERE end_us - us > {24 * sql.HOUR}",
    ),
)
def gaps_nested(spark, sf_dir):
    """The form with the messages as structs, read back by field."""
    gaps = detect_gaps(_messages(spark, sf_dir), Settings(threshold_h=24, normalize_output=False))
    return gaps.select(
        "gap_id",
        "ssvid",
        F.col("OFF.timestamp").alias("off_timestamp"),
        F.col("OFF.msgid").alias("off_msgid"),
        F.col("ON.timestamp").alias("on_timestamp"),
        F.col("ON.msgid").alias("on_msgid"),
        F.col("ON.ais_class").alias("on_ais_class"),
    )


@query("gap_ids", sql.with_cte(sql.MESSAGES, body=f"SELECT msgid, {sql.gap_id()} AS gap_id FROM messages"))
def gap_ids(spark, sf_dir):
    """Identifier of the gap that each message would start."""
    identifier = text.gap_id("ssvid", "unix_micros(timestamp)", "lat", "lon")
    return _messages(spark, sf_dir).selectExpr("msgid", f"{identifier} as gap_id")


@query(
    "positions_before",
    sql.with_cte(
        sql.MESSAGES,
        sql.paired(n_us=24 * sql.HOUR),
        body=f"SELECT ssvid, timestamp AS start_timestamp, {', '.join(schemas.COUNT_COLUMNS)} FROM paired "
        f"WHERE end_us - us > {2 * sql.HOUR}",
    ),
)
def positions_before(spark, sf_dir):
    gaps = detect_gaps(_messages(spark, sf_dir), Settings(threshold_h=2, n_hours_before=24))
    return gaps.select("ssvid", "start_timestamp", *schemas.COUNT_COLUMNS)


_SPEEDS = """SELECT p.msgid, round(d.meters, 1) AS distance_m, (p.end_us - p.us) / 3.6e9 AS duration_h,
  round(d.meters / ((p.end_us - p.us) / 3.6e9) / 1852, 4) AS implied_speed_knots
  FROM paired p LEFT JOIN distances d ON d.k = p.msgid WHERE p.end_us - p.us > 43200000000"""


@query(
    "gap_speed",
    sql.with_cte(
        sql.MESSAGES,
        sql.paired(),
        "ends AS (SELECT msgid AS k, lat AS lat1, lon AS lon1, end_lat AS lat2, end_lon AS lon2 "
        "FROM paired WHERE end_us - us > 43200000000)",
        sql.DISTANCES,
        body=_SPEEDS,
        recursive=True,
    ),
)
def gap_speed(spark, sf_dir):
    gaps = detect_gaps(_messages(spark, sf_dir))
    return gaps.select(
        F.col("start_msgid").alias("msgid"),
        F.round("distance_m", 1).alias("distance_m"),
        "duration_h",
        F.round("implied_speed_knots", 4).alias("implied_speed_knots"),
    )


@query("open_gaps", sql.with_cte(sql.MESSAGES, sql.paired(), body=sql.still_open(6)))
def open_gaps_of_own_day(spark, sf_dir):
    return _plain(open_gaps(_messages(spark, sf_dir), Settings(threshold_h=6)))


def _before(day: str) -> str:
    return f"earlier AS (SELECT * FROM messages WHERE timestamp < TIMESTAMP '{day}')"


_TWO_RUNS = (
    sql.MESSAGES,
    _before(MIDDLE),
    sql.paired(source="earlier", name="paired_a"),
    sql.paired(),
    f"known AS ({sql.still_open(6, MIDDLE, sql.since(FIRST, 6), 'paired_a')})",
    f"""firsts AS (
  SELECT ssvid, us AS first_us, {', '.join(f'{c} AS end_{c}' for c in sql.MESSAGE_COLUMNS.split(', ') if c != 'ssvid')}
  FROM messages WHERE timestamp >= TIMESTAMP '{MIDDLE}'
  QUALIFY row_number() OVER (PARTITION BY ssvid ORDER BY us, msgid, seg_id) = 1)""",
    f"""closings AS (
  SELECT k.* REPLACE (
    (first_us - epoch_us(k.start_timestamp)) / 3.6e9 AS duration_h, true AS is_closed,
    {', '.join(f'f.end_{c} AS end_{c}' for c in sql.MESSAGE_COLUMNS.split(', ') if c != 'ssvid')})
  FROM known k JOIN firsts f USING (ssvid))""",
    f"detected AS ({sql.closed(6, sql.since(MIDDLE, 6))} UNION ALL {sql.still_open(6, LAST, sql.since(MIDDLE, 6))})",
    f"""second AS (SELECT * FROM detected UNION ALL
  SELECT * FROM closings WHERE gap_id NOT IN (SELECT gap_id FROM detected))""",
    f"first AS ({sql.closed(6, sql.since(FIRST, 6), 'paired_a')} UNION ALL SELECT * FROM known)",
    f"""history AS (SELECT *, TIMESTAMP '{MIDDLE}' AS version FROM first
  UNION ALL SELECT *, TIMESTAMP '{LAST}' AS version FROM second)""",
)


def _first_run(spark, sf_dir):
    early = _messages(spark, sf_dir).where(F.col("timestamp") < F.lit(MIDDLE).cast("timestamp"))
    return run_window(early, None, (FIRST, MIDDLE), Settings(threshold_h=6, version=_stamp(MIDDLE)))


def _second_run(spark, sf_dir, known):
    return run_window(
        _messages(spark, sf_dir), known, (MIDDLE, LAST), Settings(threshold_h=6, version=_stamp(LAST))
    )


@query("close_open_gaps", sql.with_cte(*_TWO_RUNS, body="SELECT * FROM closings"))
def close_known_gaps(spark, sf_dir):
    early = _messages(spark, sf_dir).where(F.col("timestamp") < F.lit(MIDDLE).cast("timestamp"))
    known = open_gaps(early, Settings(threshold_h=6), (FIRST, MIDDLE))
    return _plain(close_open_gaps(known, _messages(spark, sf_dir), (MIDDLE, LAST), Settings(threshold_h=6)))


@query("run_window", sql.with_cte(*_TWO_RUNS, body="SELECT * FROM second"))
def one_run(spark, sf_dir):
    known = _first_run(spark, sf_dir).where("not is_closed")
    return _plain(_second_run(spark, sf_dir, known))


@query(
    "composite_key_gaps",
    sql.with_cte(sql.MESSAGES, sql.paired("ssvid, vessel_id"), body=sql.closed(12, more="vessel_id")),
)
def composite_key_gaps(spark, sf_dir):
    vessel = derived.segment_info(spark, sf_dir)
    tracks = _messages(spark, sf_dir).join(vessel, "seg_id")
    gaps = detect_gaps(tracks, Settings(keys=("ssvid", "vessel_id")))
    return _plain(gaps, "start_vessel_id", "end_vessel_id")


_ENDS = [c for c in sql.MESSAGE_COLUMNS.split(", ") if c != "ssvid"]


@query(
    "composite_key_run",
    sql.with_cte(
        sql.MESSAGES,
        _before(MIDDLE),
        sql.paired("ssvid, vessel_id", source="earlier", name="paired_a"),
        f"known AS ({sql.still_open(6, MIDDLE, sql.since(FIRST, 6), 'paired_a', 'vessel_id')})",
        f"""firsts AS (SELECT ssvid, vessel_id, us AS first_us, {', '.join(f'{c} AS end_{c}' for c in _ENDS)}
  FROM messages WHERE timestamp >= TIMESTAMP '{MIDDLE}'
  QUALIFY row_number() OVER (PARTITION BY ssvid, vessel_id ORDER BY us, msgid, seg_id) = 1)""",
        body=f"""SELECT k.* REPLACE ((first_us - epoch_us(k.start_timestamp)) / 3.6e9 AS duration_h, true AS is_closed,
  {', '.join(f'f.end_{c} AS end_{c}' for c in _ENDS)}) FROM known k JOIN firsts f USING (ssvid, vessel_id)""",
    ),
)
def composite_key_run(spark, sf_dir):
    """Gaps of a key of two columns: opened by one run, closed by the next."""
    tracks = _messages(spark, sf_dir).join(derived.segment_info(spark, sf_dir), "seg_id")
    settings = Settings(threshold_h=6, keys=("ssvid", "vessel_id"))
    early = tracks.where(F.col("timestamp") < F.lit(MIDDLE).cast("timestamp"))
    known = open_gaps(early, settings, (FIRST, MIDDLE))
    return _plain(close_open_gaps(known, tracks, (MIDDLE, LAST), settings), "start_vessel_id", "end_vessel_id")


_ODD_HOURS = 31 / 7


@query(
    "positions_before_odd_hours",
    sql.with_cte(
        sql.MESSAGES,
        sql.paired(n_us=round(_ODD_HOURS * sql.HOUR)),
        body=f"SELECT ssvid, timestamp AS start_timestamp, {', '.join(schemas.COUNT_COLUMNS)} FROM paired "
        f"WHERE end_us - us > {4 * sql.HOUR}",
    ),
)
def positions_before_odd_hours(spark, sf_dir):
    """A look-back that is no whole number of slots of whole microseconds."""
    gaps = detect_gaps(_messages(spark, sf_dir), Settings(threshold_h=4, n_hours_before=_ODD_HOURS))
    return gaps.select("ssvid", "start_timestamp", *schemas.COUNT_COLUMNS)


@query("open_gaps_ntz", sql.with_cte(sql.MESSAGES, sql.paired(), body=sql.still_open(6)))
def open_gaps_zoneless(spark, sf_dir):
    """Times without a zone."""
    zoneless = _messages(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return _plain(open_gaps(zoneless, Settings(threshold_h=6)))


@query("gaps_json_roundtrip", _CLOSED)
def gaps_json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "gaps-json")
    tables.write_json(detect_gaps(_messages(spark, sf_dir)), path)
    return _plain(tables.read_json_gaps(spark, path))


# ------------------------------------------------------------------ the versioned table


def _history(spark, sf_dir) -> DataFrame:
    """Rows a table holds after two runs: some gaps in two versions."""
    first = written(_first_run(spark, sf_dir), "first-run")
    return first.unionByName(_second_run(spark, sf_dir, first.where("not is_closed")))


def _kept(columns: str = "*") -> str:
    return f"SELECT {columns} FROM history"


_LATEST = """SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER
  (PARTITION BY gap_id, start_timestamp ORDER BY version DESC) AS nth FROM history) WHERE nth = 1"""


@query("gaps_history", sql.with_cte(*_TWO_RUNS, body=_kept()))
def gaps_history(spark, sf_dir):
    """Both runs appended to a table and read back."""
    table = tables.GapsTable(spark, fresh_path(spark, "gaps-table"))
    table.create()
    first = _first_run(spark, sf_dir)
    table.append(first)
    table.append(_second_run(spark, sf_dir, versions.carried_open_gaps(table.read(), FIRST)))
    return table.read().drop("start_month", *_DISTANCE)


@query("last_versions", sql.with_cte(*_TWO_RUNS, body=_LATEST))
def last_versions(spark, sf_dir):
    return versions.last_versions(_history(spark, sf_dir)).drop(*_DISTANCE)


@query(
    "last_versions_max",
    sql.with_cte(
        *_TWO_RUNS,
        body="SELECT * EXCLUDE (newest) FROM (SELECT *, max(version) OVER (PARTITION BY gap_id) AS newest "
        "FROM history) WHERE version = newest",
    ),
)
def last_versions_max(spark, sf_dir):
    return versions.last_versions_with_ties(_history(spark, sf_dir)).drop(*_DISTANCE)


@query(
    "gaps_closed_in_range",
    sql.with_cte(
        *_TWO_RUNS,
        body=f"SELECT * FROM ({_LATEST}) WHERE is_closed AND start_timestamp >= TIMESTAMP '2024-01-10' "
        "AND end_timestamp < TIMESTAMP '2024-01-20'",
    ),
)
def gaps_closed_in_range(spark, sf_dir):
    history = _history(spark, sf_dir)
    return versions.select_gaps(history, "2024-01-10", "2024-01-20", is_closed=True).drop(*_DISTANCE)


@query(
    "gaps_carried_open",
    sql.with_cte(
        *_TWO_RUNS,
        body=f"SELECT * FROM ({_LATEST}) WHERE NOT is_closed AND start_timestamp >= TIMESTAMP '2024-01-05'",
    ),
)
def gaps_carried_open(spark, sf_dir):
    return versions.carried_open_gaps(_history(spark, sf_dir), "2024-01-05").drop(*_DISTANCE)


@query(
    "open_gaps_source",
    sql.with_cte(*_TWO_RUNS, body=f"SELECT * FROM ({_LATEST}) WHERE NOT is_closed"),
)
def open_gaps_source(spark, sf_dir):
    """Open gaps to carry, from JSON lines rather than from the table."""
    path = fresh_path(spark, "open-json")
    tables.write_json(_history(spark, sf_dir), path)
    raw = derived.raw_messages(spark, sf_dir)
    config = DetectConfig(MIDDLE, LAST, messages=raw, segments=derived.segs_activity(spark, sf_dir), json_open_gaps=path)
    return read_open_gaps(spark, config).drop(*_DISTANCE)


@query("rerun_from_date", sql.with_cte(*_TWO_RUNS, body=_LATEST))
def rerun_from_date(spark, sf_dir):
    """Two runs, then the second once more: what it creates again is deleted first."""
    config = DetectConfig(
        start_date=FIRST,
        end_date=LAST,
        messages=derived.raw_messages(spark, sf_dir),
        segments=written(derived.segs_activity(spark, sf_dir), "segments"),
        gaps_path=fresh_path(spark, "rerun"),
        min_gap_length_h=6,
    )
    dates = [(as_date(FIRST), as_date(MIDDLE)), (as_date(MIDDLE), as_date(LAST)), (as_date(MIDDLE), as_date(LAST))]
    return run_daily(spark, config, dates, version_of_range_end=True).drop(*_DISTANCE)


@query(
    "gaps_delete",
    sql.with_cte(
        *_TWO_RUNS,
        body=f"SELECT * FROM history WHERE NOT coalesce((is_closed AND end_timestamp >= TIMESTAMP '{MIDDLE}') "
        f"OR (NOT is_closed AND start_timestamp >= TIMESTAMP '{MIDDLE}'), false)",
    ),
)
def gaps_delete(spark, sf_dir):
    """Rows left in the table after deleting what a run from the middle creates again."""
    table = tables.GapsTable(spark, fresh_path(spark, "gaps-table"))
    table.append(_history(spark, sf_dir))
    table.delete_recreated(MIDDLE)
    return table.read().drop("start_month", *_DISTANCE)


_REPLAYED = f"""SELECT *, date_trunc('day', CASE WHEN is_closed THEN end_timestamp
    ELSE start_timestamp + INTERVAL 6 HOUR END) + INTERVAL 1 DAY AS version FROM ({sql.closed(6)} UNION ALL {sql.still_open(6, LAST)})"""


@query("daily_replay", sql.with_cte(sql.MESSAGES, sql.paired(), body=_REPLAYED))
def daily_replay(spark, sf_dir):
    """Consecutive runs over the whole period, each carrying the open gaps of the ones before."""
    config = DetectConfig(
        start_date=FIRST,
        end_date=LAST,
        messages=derived.raw_messages(spark, sf_dir),
        segments=written(derived.segs_activity(spark, sf_dir), "segments"),
        gaps_path=fresh_path(spark, "replay"),
        min_gap_length_h=6,
    )
    latest = run_daily(spark, config, ranges(FIRST, LAST), version_of_range_end=True)
    return latest.drop(*_DISTANCE)


@query(
    "stream_replay",
    sql.with_cte(sql.MESSAGES, sql.paired(), body=f"{sql.closed(6)} UNION ALL {sql.still_open(6, LAST)}"),
)
def stream_replay(spark, sf_dir):
    """The same gaps by micro-batches: messages arrive in three parts, some of them after their day was processed."""
    raw = derived.raw_messages(spark, sf_dir)
    config = DetectConfig(
        start_date=FIRST,
        end_date=LAST,
        messages=raw,  # replaced by the messages that the stream has stored
        segments=written(derived.segs_activity(spark, sf_dir), "segments"),
        gaps_path=fresh_path(spark, "stream-gaps"),
        min_gap_length_h=6,
    )
    arrivals, stored, checkpoint = (fresh_path(spark, f"stream-{n}") for n in ("arrivals", "messages", "checkpoint"))
    # Every 50th message of the two days before a part ends comes with the next one.
    late = F.expr("msgid % 50 = 0 and day(timestamp) in (9, 10, 19, 20)").cast("int")
    part = F.least(F.lit(2), F.floor((F.dayofmonth("timestamp") - 1) / 10)).cast("int") + late
    for number in range(3):
        raw.where(part == number).write.mode("append").parquet(arrivals)
        arriving = spark.readStream.schema(raw.schema).parquet(arrivals)
        microbatch.detect_stream(arriving, config, stored, checkpoint).awaitTermination()
    return _plain(microbatch.finish(spark, config, stored))


@query("gaps_by_day_layout", _CLOSED)
def gaps_by_day_layout(spark, sf_dir):
    """Messages stored by day, requests of the second pass taken in ranges that open their days alone."""
    path = fresh_path(spark, "messages-by-day")
    sources.write_by_day(derived.raw_messages(spark, sf_dir), path)
    messages = sources.select_messages(spark.read.parquet(path))
    return _plain(detect_gaps(messages, Settings(limits=Limits(broadcast_bytes=1 << 20))))


@query("gaps_derived_window", sql.with_cte(sql.MESSAGES, sql.paired(), body=sql.closed(12)))
def gaps_derived_window(spark, sf_dir):
    """A range of more than 180 days splits the tracks into windows without being asked to."""
    gaps = run_window(_messages(spark, sf_dir), None, ("2023-01-01", "2024-02-01"), Settings(), eval_last=False)
    return _plain(gaps)


@query(
    "segments_ready",
    sql.with_cte(
        sql.SEGS,
        body="SELECT CAST(max(CAST(last_timestamp AS DATE)) AS VARCHAR) AS max_day, '2024-01-29' AS required_day, "
        "coalesce(max(CAST(last_timestamp AS DATE)) >= DATE '2024-01-29', false) AS is_ready FROM segs_activity",
    ),
)
def segments_ready(spark, sf_dir):
    return segments_readiness(derived.segs_activity(spark, sf_dir), "2024-01-27", 3)


# ------------------------------------------------------------------ publication

# All days of the data; messages_scan and gaps_closed_in_range test the filter by days.
_RANGE = (FIRST, LAST)


def _inputs(spark, sf_dir) -> publish.PublishInputs:
    gaps = written(detect_gaps(_messages(spark, sf_dir)), "gaps")
    return publish.PublishInputs(
        gaps=gaps,
        segment_info=derived.segment_info(spark, sf_dir),
        segs_activity=derived.segs_activity(spark, sf_dir),
        voyages=derived.voyages(spark, sf_dir),
        port_visits=derived.port_visits(spark, sf_dir),
        regions=derived.regions(spark, sf_dir),
        vessels_byyear=derived.vessels_byyear(spark, sf_dir),
    )


_ENRICHED = (
    sql.MESSAGES,
    sql.paired(),
    sql.SEGS,
    sql.PUBLISH_TABLES,
    sql.enriched(sql.closed(12), *_RANGE),
)

_BASE_COLUMNS = [c for c in schemas.EVENT.names if c not in ("regions_mean_position", "event_info", "event_vessels")]
_BASE = ", ".join(f"'gaps' AS {c}" if c == "event_type" else c for c in _BASE_COLUMNS)

_INFO_FIELDS = {
    "duration_h": "double",
    "vessel_class": "string",
    "vessel_1_id": "string",
    "vessel_2_id": "string",
    "is_multi_vessel_gap": "boolean",
    "gap_start_overlapping_and_short": "boolean",
    "gap_end_overlapping_and_short": "boolean",
    "gap_overlapping_and_short": "boolean",
    "gap_min_distance_from_port_m": "double",
    "gap_min_distance_from_shore_m": "double",
}
_PORT_FIELDS = {"event_id": "port_event_id", "id": "port_id", "flag": "port_flag", "name": "port_name"}
_INFO_SCHEMA = (
    ", ".join(f"{n} {t}" for n, t in _INFO_FIELDS.items())
    + ", main_vessel_destination_port struct<event_id string, id string, flag string, name string>"
)


def _info_columns(events: DataFrame) -> DataFrame:
    """The JSON of an event back as columns, as a consumer would read it."""
    info = F.from_json("event_info", _INFO_SCHEMA)
    return events.withColumn("_i", info).select(
        *_BASE_COLUMNS,
        *[F.col(f"_i.{n}").alias(n) for n in _INFO_FIELDS],
        *[F.col(f"_i.main_vessel_destination_port.{n}").alias(a) for n, a in _PORT_FIELDS.items()],
    )


@query(
    "event_base",
    sql.with_cte(
        *_ENRICHED,
        body=f"SELECT {_BASE}, {', '.join(_INFO_FIELDS)}, {', '.join(_PORT_FIELDS.values())} FROM enriched",
    ),
)
def event_base(spark, sf_dir):
    return _info_columns(publish.base_events(publish.enriched_gaps(_inputs(spark, sf_dir), *_RANGE)))


@query("event_voyage_port", sql.with_cte(*_ENRICHED, body="SELECT event_id, trip_id, port_event_id, port_id, port_name FROM enriched"))
def event_voyage_port(spark, sf_dir):
    """Voyages under way and the port visits that end them."""
    gaps = publish.enriched_gaps(_inputs(spark, sf_dir), *_RANGE)
    return gaps.select(
        text.event_id(F.col("_start_vessel_id"), F.col("start_timestamp"), F.col("end_timestamp")).alias("event_id"),
        "trip_id",
        F.col("_port_event_id").alias("port_event_id"),
        F.col("_anchorage.id").alias("port_id"),
        F.col("_anchorage.name").alias("port_name"),
    )


_VESSELS_SCHEMA = "array<struct<ssvid string, id string, name string, type string, flag string, seg_id string>>"


@query(
    "event_vessels",
    sql.with_cte(
        *_ENRICHED,
        body="SELECT event_id, trip_id, 0 AS place, ssvid, vessel_id AS id, name_1 AS name, vessel_class AS type, "
        "flag_1 AS flag, seg_id FROM enriched UNION ALL SELECT event_id, trip_id, 1, ssvid, id_2, name_2, type_2, flag_2, seg_2 "
        "FROM enriched WHERE is_multi_vessel_gap",
    ),
)
def event_vessels(spark, sf_dir):
    gaps = publish.enriched_gaps(_inputs(spark, sf_dir), *_RANGE)
    vessels = F.from_json(publish.event_vessels(), _VESSELS_SCHEMA)
    event = text.event_id(F.col("_start_vessel_id"), F.col("start_timestamp"), F.col("end_timestamp"))
    return (
        gaps.select(event.alias("event_id"), "trip_id", F.posexplode(vessels).alias("place", "v"))
        .select("event_id", "trip_id", "place", "v.*")
    )


def _layer_texts(of_regions: DataFrame, column: str) -> DataFrame:
    return of_regions.select(
        "event_id",
        *[F.array_join(F.col(f"{column}.{name}"), ",").alias(name) for name in schemas.REGION_LAYERS],
    )


@query(
    "event_regions",
    sql.with_cte(
        *_ENRICHED,
        sql.REGION_MATCHES,
        body=f"SELECT event_id, {sql.LAYER_LISTS} FROM matches GROUP BY event_id",
    ),
)
def event_regions(spark, sf_dir):
    inputs = _inputs(spark, sf_dir)
    events = publish.base_events(publish.enriched_gaps(inputs, *_RANGE))
    return _layer_texts(publish.event_regions(events, inputs.regions), "regions")


@query(
    "s2_cells",
    sql.with_cte(
        sql.MESSAGES,
        sql.s2_cells("messages", "msgid", "lat", "lon"),
        body="SELECT m.msgid, c.s2_cell FROM messages m LEFT JOIN cells c ON c.k = m.msgid",
        recursive=True,
    ),
)
def s2_cells(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    return messages.select("msgid", cell(F.col("lat"), F.col("lon")).alias("s2_cell"))


_LISTED = f"listed AS (SELECT event_id, {sql.LAYER_LISTS} FROM matches GROUP BY event_id)"
_PUBLISHED_ROWS = (
    f"SELECT {_BASE}, {', '.join(_INFO_FIELDS)}, {', '.join(_PORT_FIELDS.values())}, "
    f"{', '.join(schemas.REGION_LAYERS)} FROM enriched LEFT JOIN listed USING (event_id)"
)
_PUBLISHED = sql.with_cte(*_ENRICHED, sql.REGION_MATCHES, _LISTED, body=_PUBLISHED_ROWS)


def _flat_events(events: DataFrame) -> DataFrame:
    texts = [F.array_join(F.col(f"regions_mean_position.{n}"), ",").alias(n) for n in schemas.REGION_LAYERS]
    info = F.from_json("event_info", _INFO_SCHEMA)
    return events.withColumn("_i", info).select(
        *_BASE_COLUMNS,
        *[F.col(f"_i.{n}").alias(n) for n in _INFO_FIELDS],
        *[F.col(f"_i.main_vessel_destination_port.{n}").alias(a) for n, a in _PORT_FIELDS.items()],
        *texts,
    )


@query("gap_events", _PUBLISHED)
def gap_events(spark, sf_dir):
    return _flat_events(publish.gap_events(_inputs(spark, sf_dir), *_RANGE))


@query("published_events", _PUBLISHED)
def published_events(spark, sf_dir):
    """The same through the events table."""
    path = fresh_path(spark, "events-table")
    return _flat_events(publish.run_publish(spark, _inputs(spark, sf_dir), path, *_RANGE))


# Gaps of 12 hours and more, open ones too.
_OPEN_TOO = (
    sql.MESSAGES,
    sql.paired(),
    sql.SEGS,
    sql.PUBLISH_TABLES,
    sql.enriched(
        f"{sql.closed(12)} UNION ALL {sql.still_open(12, LAST, sql.since(FIRST, 12))}",
        *_RANGE,
        include_open=True,
        antimeridian_safe=True,
    ),
)


def _open_too(spark, sf_dir) -> publish.PublishInputs:
    inputs = _inputs(spark, sf_dir)
    still = open_gaps(_messages(spark, sf_dir), Settings(), (FIRST, LAST))
    return replace(inputs, gaps=inputs.gaps.unionByName(still))


@query("gap_events_open", sql.with_cte(*_OPEN_TOO, sql.REGION_MATCHES, _LISTED, body=_PUBLISHED_ROWS))
def gap_events_open(spark, sf_dir):
    """Open gaps are published as well; means of positions on both sides of the antimeridian lie between them."""
    return _flat_events(publish.gap_events(_open_too(spark, sf_dir), *_RANGE, include_open=True, antimeridian_safe=True))


@query(
    "event_points",
    sql.with_cte(
        *_OPEN_TOO,
        body="SELECT DISTINCT event_id, lon_min AS start_lon, lat_min AS start_lat, lon_max AS end_lon, lat_max AS end_lat, "
        "lon_mean, lat_mean FROM enriched",
    ),
)
def event_points(spark, sf_dir):
    """Positions of each event, once each."""
    gaps = publish.enriched_gaps(_open_too(spark, sf_dir), *_RANGE, include_open=True)
    points = publish.event_points(publish.base_events(gaps, antimeridian_safe=True))
    return points.select("event_id", *[F.col(f"{at}.{c}").alias(f"{at}_{c}") for at in ("start", "end") for c in ("lon", "lat")],
                         F.col("mean.lon").alias("lon_mean"), F.col("mean.lat").alias("lat_mean"))


# Start, end and threshold (10 days) for the events stretched over a year end.
_YEARS, _YEARS_H = (derived.YEARS_FROM, "2024-11-01"), 240


@query(
    "event_base_years",
    sql.with_cte(
        *sql.over_years(sql.MESSAGES),
        sql.paired(),
        *sql.over_years(sql.SEGS, sql.PUBLISH_TABLES)[1:],
        sql.enriched(sql.closed(_YEARS_H), *_YEARS),
        body=f"SELECT {_BASE}, {', '.join(_INFO_FIELDS)}, {', '.join(_PORT_FIELDS.values())} FROM enriched",
    ),
)
def event_base_years(spark, sf_dir):
    """Vessels known in one year only, gaps over the end of it, voyages of many months."""
    folder = derived.over_years(spark, sf_dir)
    gaps = written(detect_gaps(_messages(spark, folder), Settings(threshold_h=_YEARS_H)), "gaps")
    inputs = publish.PublishInputs(
        gaps=gaps,
        segment_info=derived.segment_info(spark, folder),
        segs_activity=derived.segs_activity(spark, folder),
        voyages=derived.voyages(spark, folder),
        port_visits=derived.port_visits(spark, folder),
        regions=spark.createDataFrame([], schemas.REGION),
        vessels_byyear=derived.vessels_byyear(spark, folder),
    )
    return _info_columns(publish.base_events(publish.enriched_gaps(inputs, *_YEARS)))


# ------------------------------------------------------------------ reports

_REPORT = (sql.MESSAGES, sql.paired(), f"gaps AS ({sql.closed(6)})")


def _report_gaps(spark, sf_dir, good: bool = False) -> DataFrame:
    raw = derived.raw_messages(spark, sf_dir)
    segments = derived.segs_activity(spark, sf_dir) if good else None
    messages = sources.select_messages(raw, segments, filter_good_seg=good)
    return detect_gaps(messages, Settings(threshold_h=6))


@query(
    "gaps_per_day",
    sql.with_cte(*_REPORT, body="SELECT CAST(CAST(start_timestamp AS DATE) AS VARCHAR) AS day, count(*) AS gaps FROM gaps GROUP BY 1"),
)
def gaps_per_day(spark, sf_dir):
    return reports.gaps_per_day(_report_gaps(spark, sf_dir))


@query(
    "gaps_per_month_diff",
    sql.with_cte(
        *_REPORT,
        sql.SEGS,
        "good AS (SELECT * FROM messages WHERE seg_id IN (SELECT seg_id FROM segs_activity WHERE good_seg2))",
        sql.paired(source="good", name="paired_good"),
        f"filtered AS ({sql.closed(6, source='paired_good')})",
        "a AS (SELECT strftime(start_timestamp, '%Y-%m-01') AS month, count(*) AS gaps_filtered FROM filtered GROUP BY 1)",
        "b AS (SELECT strftime(start_timestamp, '%Y-%m-01') AS month, count(*) AS gaps_unfiltered FROM gaps GROUP BY 1)",
        body="SELECT *, CAST(round_even(avg(difference) OVER (), 0) AS BIGINT) AS average_difference FROM "
        "(SELECT month, gaps_filtered, gaps_unfiltered, abs(gaps_filtered - gaps_unfiltered) AS difference FROM a JOIN b USING (month))",
    ),
)
def gaps_per_month_diff(spark, sf_dir):
    return reports.monthly_difference(_report_gaps(spark, sf_dir, good=True), _report_gaps(spark, sf_dir))


@query(
    "gaps_per_month_years",
    sql.with_cte(
        *sql.over_years(sql.MESSAGES),
        sql.paired(),
        f"gaps AS ({sql.closed(_YEARS_H)})",
        body="SELECT strftime(start_timestamp, '%Y-%m-01') AS month, count(*) AS gaps FROM gaps GROUP BY 1",
    ),
)
def gaps_per_month_years(spark, sf_dir):
    messages = _messages(spark, derived.over_years(spark, sf_dir))
    return reports.gaps_per_month(detect_gaps(messages, Settings(threshold_h=_YEARS_H)))


def _with_flags(spark, sf_dir) -> DataFrame:
    owner = derived.table(spark, sf_dir, "customer").join(
        derived.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    flags = owner.select(F.col("c_custkey").cast("string").alias("ssvid"), F.col("n_name").alias("flag"))
    return _report_gaps(spark, sf_dir).join(flags, "ssvid")


_FLAGS = f"""SELECT n_name AS flag, count(*) AS gaps FROM gaps JOIN customer ON ssvid = CAST(c_custkey AS VARCHAR)
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""


@query("gaps_per_flag", sql.with_cte(*_REPORT, body=_FLAGS))
def gaps_per_flag(spark, sf_dir):
    return reports.gaps_per_flag(_with_flags(spark, sf_dir))


@query("gaps_top_flags", sql.with_cte(*_REPORT, body=f"{_FLAGS} ORDER BY gaps DESC, flag LIMIT 10"))
def gaps_top_flags(spark, sf_dir):
    return reports.top_flags(_with_flags(spark, sf_dir))


# Hundredths, and no negative zero.
_SNAP = "(round({c}, 2) + 0.0::DOUBLE)"


@query(
    "gaps_grid",
    sql.with_cte(
        *_REPORT,
        body=f"SELECT printf('lon:%+07.2f_lat:%+07.2f', {_SNAP.format(c='start_lon')}, {_SNAP.format(c='start_lat')}) AS gridcode, "
        "count(*) AS gaps FROM gaps WHERE start_lat IS NOT NULL AND start_lon IS NOT NULL GROUP BY 1",
    ),
)
def gaps_grid(spark, sf_dir):
    return reports.gaps_per_grid_cell(_report_gaps(spark, sf_dir))


@query(
    "scalar_functions",
    sql.with_cte(
        sql.MESSAGES,
        body="""SELECT msgid, CASE WHEN lon < 0 THEN 180 + lon ELSE lon - 180 END AS anti_lon,
  distance_from_shore_m / 1000 AS shore_km, distance_from_port_m * 1.852::DOUBLE AS port_km,
  lower(receiver_type || '-' || replace(seg_id || ' Ab C', ' ', '')) AS port_id,
  seg_id IN ('ICCAT', 'IOTC', 'WCPFC', 'IATTC', 'CCSBT', 'SPRFMO', 'NPFC') AS whitelisted,
  us / 1e6 AS seconds FROM messages""",
    ),
)
def scalar_functions(spark, sf_dir):
    """Scalar functions no other query uses."""
    return _messages(spark, sf_dir).select(
        "msgid",
        units.antipodal_lon(F.col("lon")).alias("anti_lon"),
        units.meters_to_km(F.col("distance_from_shore_m")).alias("shore_km"),
        units.nautical_miles_to_km(F.col("distance_from_port_m")).alias("port_km"),
        text.port_id(F.col("receiver_type"), F.concat("seg_id", F.lit(" Ab C"))).alias("port_id"),
        units.is_whitelisted_rfmo(F.col("seg_id")).alias("whitelisted"),
        epoch_seconds("timestamp").alias("seconds"),
    )
