"""SQL (DuckDB dialect) for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

from hushtrack.schemas import COUNT_COLUMNS, RECEIVER_TYPES, REGION_LAYERS

from harness.derived import RECEIVER_OF_EVENT, REGION_BOUNDS, REGION_HEIGHT, REGION_WIDTH, STRETCH, YEARS_FROM

HOUR = 3_600_000_000
LOOK_BACK = 12 * HOUR

MESSAGE_COLUMNS = (
    "ssvid, msgid, seg_id, timestamp, lat, lon, receiver_type, distance_from_shore_m, "
    "distance_from_port_m, ais_class"
)

_SEG = "CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d')"
_VESSEL = "'v' || CAST(user_id AS VARCHAR) || '-' || CAST(day(ts) % 2 AS VARCHAR)"
_RECEIVER = " ".join(f"WHEN '{e}' THEN '{r}'" for e, r in RECEIVER_OF_EVENT.items())

MESSAGES = f"""
messages AS (
  SELECT CAST(user_id AS VARCHAR) AS ssvid, CAST(event_id AS VARCHAR) AS msgid, {_SEG} AS seg_id,
    ts AS timestamp, epoch_us(ts) AS us,
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id * 7919 % 17000 AS DOUBLE) / 100 - 85 END AS lat,
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id * 104729 % 36000 AS DOUBLE) / 100 - 180 END AS lon,
    CASE event_type {_RECEIVER} END AS receiver_type,
    value * 1000 AS distance_from_shore_m, value * 2000 AS distance_from_port_m,
    CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS ais_class,
    {_VESSEL} AS vessel_id
  FROM events)"""

#: The events table over several months and a year end, as ``derived.over_years`` makes it.
STRETCHED = f"""
stretched AS (
  SELECT * REPLACE (make_timestamp(CAST(epoch_us(TIMESTAMP '{YEARS_FROM}') + {STRETCH} * (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) AS BIGINT)) AS ts)
  FROM events)"""


def over_years(*ctes: str) -> tuple[str, ...]:
    return (STRETCHED, *[c.replace("FROM events", "FROM stretched") for c in ctes])


SEGS = f"""
segs_activity AS (
  SELECT {_SEG} AS seg_id, any_value(user_id) % 10 <> 0 AS good_seg2,
    any_value(user_id) % 7 = 0 AS overlapping_and_short, max(ts) AS last_timestamp
  FROM events GROUP BY 1)"""


def paired(key: str = "ssvid", source: str = "messages", n_us: int = LOOK_BACK, name: str = "paired") -> str:
    """Every message with its successor and its look-back counts."""
    frame = f"(PARTITION BY {key} ORDER BY us RANGE BETWEEN {n_us} PRECEDING AND 1 PRECEDING)"
    after = f"OVER (PARTITION BY {key} ORDER BY us, msgid, seg_id)"
    nexts = ", ".join(
        f"lead({c}) {after} AS end_{c}" for c in (*MESSAGE_COLUMNS.split(", "), "us")
    )
    counts = [f"count(*) OVER {frame} + 1 AS {COUNT_COLUMNS[0]}"] + [
        f"count(*) FILTER (receiver_type = '{r}') OVER {frame} + "
        f"CASE WHEN receiver_type = '{r}' THEN 1 ELSE 0 END AS positions_hours_before_{s}"
        for r, s in RECEIVER_TYPES.items()
    ]
    return f"{name} AS (SELECT *, {nexts}, {', '.join(counts)} FROM {source})"


def _text(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {column} = 0 THEN '0.0' ELSE CAST({column} AS VARCHAR) END"


def gap_id(prefix: str = "") -> str:
    p = prefix
    return (
        f"md5({p}ssvid || '|' || CAST({p}us / 1e6 AS VARCHAR) || '|' || {_text(p + 'lat')} || '|' || "
        f"{_text(p + 'lon')})"
    )


_START = ", ".join(f"{c} AS start_{c}" for c in MESSAGE_COLUMNS.split(", ") if c != "ssvid")
_END = ", ".join(f"end_{c}" for c in MESSAGE_COLUMNS.split(", ") if c != "ssvid")
_NO_END = ", ".join(f"NULL AS end_{c}" for c in MESSAGE_COLUMNS.split(", ") if c != "ssvid")
_COUNTS = ", ".join(COUNT_COLUMNS)


def closed(threshold_h: float, where: str = "true", source: str = "paired", more: str = "") -> str:
    """Closed gaps without the distance columns; ``more`` names further key columns."""
    return f"""SELECT {gap_id()} AS gap_id, ssvid, {more and more + ", "}{_COUNTS}, (end_us - us) / 3.6e9 AS duration_h,
    {_START}, {_END}, true AS is_closed
  FROM {source} WHERE end_us - us > {round(threshold_h * HOUR)} AND {where}"""


def still_open(
    threshold_h: float, end: str | None = None, where: str = "true", source: str = "paired", more: str = ""
) -> str:
    """Open gaps without the distance columns; ``more`` names further key columns."""
    limit = "(us // 86400000000 + 1) * 86400000000" if end is None else f"epoch_us(TIMESTAMP '{end}')"
    return f"""SELECT {gap_id()} AS gap_id, ssvid, {more and more + ", "}{_COUNTS}, CAST(NULL AS DOUBLE) AS duration_h,
    {_START}, {_NO_END}, false AS is_closed
  FROM {source} WHERE end_us IS NULL AND {limit} - us > {round(threshold_h * HOUR)} AND {where}"""


def since(start: str, threshold_h: float) -> str:
    return f"us >= epoch_us(TIMESTAMP '{start}') - {round(threshold_h * HOUR)}"


# Geodesic length by bisection on the starting azimuth, for all pairs of ``ends``.
_F = "(1 / 298.257223563)"
_B = f"(6378137.0 * (1 - {_F}))"
_LINE = f"""
  SELECT *, omega - (1 - c) * {_F} * sin_a * (sigma + c * sin(sigma) * (cos(s2m) + c * cos(sigma) * (2 * pow(cos(s2m), 2) - 1))) AS reached
  FROM (SELECT *, g2 - g1 AS sigma, g1 + g2 AS s2m, w2 - w1 AS omega, {_F} / 16 * cos2_a * (4 + {_F} * (4 - 3 * cos2_a)) AS c
  FROM (SELECT *, atan2(s1, r1) AS g1, atan2(s2, r2) AS g2, atan2(sin_a * s1, r1) AS w1, atan2(sin_a * s2, r2) AS w2
  FROM (SELECT *, 1 - sin_a * sin_a AS cos2_a, sqrt(greatest(r1 * r1 + (c2 * c2 - c1 * c1), 0)) AS r2
  FROM (SELECT *, sin(az) * c1 AS sin_a, cos(az) * c1 AS r1
  FROM (SELECT *, (low + high) / 2 AS az FROM search) q1) q2) q3) q4) q5"""

DISTANCES = f"""
reduced AS (
  SELECT k, atan((1 - {_F}) * tan(radians(lat1))) AS u1, atan((1 - {_F}) * tan(radians(lat2))) AS u2,
    abs(radians((lon2 - lon1 + 540) - 360 * floor((lon2 - lon1 + 540) / 360) - 180)) AS target
  FROM ends WHERE lat1 IS NOT NULL AND lon1 IS NOT NULL AND lat2 IS NOT NULL AND lon2 IS NOT NULL),
canonical AS (
  SELECT k, target, -abs(far) AS v1, CASE WHEN far > 0 THEN -near ELSE near END AS v2
  FROM (SELECT k, target, CASE WHEN abs(u1) < abs(u2) THEN u2 ELSE u1 END AS far,
    CASE WHEN abs(u1) < abs(u2) THEN u1 ELSE u2 END AS near FROM reduced)),
search AS (
  SELECT 0 AS round, k, target, sin(v1) AS s1, cos(v1) AS c1, sin(v2) AS s2, cos(v2) AS c2,
    CAST(0 AS DOUBLE) AS low, pi() AS high
  FROM canonical
  UNION ALL
  SELECT round + 1, k, target, s1, c1, s2, c2,
    CASE WHEN reached < target THEN az ELSE low END, CASE WHEN reached < target THEN high ELSE az END
  FROM ({_LINE}) WHERE round < 54),
found AS (SELECT * FROM ({_LINE.replace('FROM search', 'FROM search WHERE round = 54')})),
distances AS (
  SELECT k, {_B} * a * (sigma - b * sin(sigma) * (cos(s2m) + b / 4 * (cos(sigma) * (2 * pow(cos(s2m), 2) - 1)
    - b / 6 * cos(s2m) * (4 * pow(sin(sigma), 2) - 3) * (4 * pow(cos(s2m), 2) - 3)))) AS meters
  FROM (SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS a,
    u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS b
  FROM (SELECT *, cos2_a * (pow(6378137.0, 2) - pow({_B}, 2)) / pow({_B}, 2) AS u FROM found)))"""


def with_cte(*ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {body}"


# ---------------------------------------------------------------- publication

PUBLISH_TABLES = f"""
segment_info AS (SELECT DISTINCT {_SEG} AS seg_id, {_VESSEL} AS vessel_id FROM events),
segs AS (SELECT si.seg_id, si.vessel_id, sa.overlapping_and_short FROM segment_info si JOIN segs_activity sa USING (seg_id)),
vessels AS (
  SELECT v.vessel_id, v.year, c_name AS shipname, c_mktsegment AS prod_shiptype, n_name AS mmsi_flag
  FROM (SELECT DISTINCT user_id, {_VESSEL} AS vessel_id, year(ts) AS year FROM events) v
  JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
voyages AS (
  SELECT CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN TIMESTAMP '1979-01-01' ELSE ts END AS trip_start,
    lead(ts) OVER (PARTITION BY {_VESSEL} ORDER BY ts, event_id) AS trip_end,
    'visit-' || CAST(event_id - event_id % 3 AS VARCHAR) AS trip_end_visit_id, {_VESSEL} AS vessel_id,
    't' || CAST(event_id AS VARCHAR) AS trip_id
  FROM events WHERE event_type = 'signup'),
visits AS (
  SELECT 'pv' || CAST(event_id AS VARCHAR) AS event_id, 'visit-' || CAST(event_id - event_id % 3 AS VARCHAR) AS visit_id,
    CASE WHEN event_id % 5 <> 0 THEN 'a' || CAST(event_id % 100 AS VARCHAR) END AS id,
    'F' || CAST(event_id % 25 AS VARCHAR) AS flag, 'port ' || CAST(event_id % 40 AS VARCHAR) AS name
  FROM events WHERE event_type = 'purchase')"""


def _instant_text(column: str) -> str:
    fraction = f"epoch_us({column}) % 1000000"
    return (
        f"strftime({column}, '%Y-%m-%d %H:%M:%S') || CASE WHEN {fraction} = 0 THEN '' ELSE "
        f"'.' || lpad(CAST({fraction} AS VARCHAR), 6, '0') END || '+00'"
    )


EVENT_ID = (
    f"md5('gaps|' || off_id || '|' || {_instant_text('start_timestamp')} || '|' || "
    f"coalesce({_instant_text('end_timestamp')}, 'NULL'))"
)


def _nearest(place: str) -> str:
    """The smaller of both ends; the start where the end is unknown; unknown where the start is."""
    start, end = f"start_distance_from_{place}_m", f"end_distance_from_{place}_m"
    return f"CASE WHEN {end} < {start} THEN {end} ELSE {start} END AS gap_min_distance_from_{place}_m"


def _km(end: str, place: str) -> str:
    return f"{end}_distance_from_{place}_m / 1000 AS {end}_distance_from_{place}_km"


_DETAILS = "shipname AS {0}_name, prod_shiptype AS {0}_type, mmsi_flag AS {0}_flag"


def _opposite(lon: str) -> str:
    return f"({lon} + CASE WHEN {lon} < 0 THEN 180 ELSE -180 END)"


def enriched(gaps: str, start: str, end: str, include_open: bool = False, antimeridian_safe: bool = False) -> str:
    """What is known of each gap of a range, one lookup after the other."""
    ended = f"end_timestamp < TIMESTAMP '{end}'"
    if include_open:
        ended = f"({ended} OR end_timestamp IS NULL AND start_timestamp < TIMESTAMP '{end}')"
    lon_mean = "(start_lon + end_lon) / 2"
    if antimeridian_safe:
        across = f"(({_opposite('start_lon')} + {_opposite('end_lon')}) / 2)"
        lon_mean = f"CASE WHEN abs(start_lon - end_lon) > 180 THEN {_opposite(across)} ELSE {lon_mean} END"
    ends = "".join(f"{_km(e, p)}, " for e in ("start", "end") for p in ("shore", "port"))
    return f"""
gaps AS ({gaps}),
off_end AS (
  SELECT seg_id AS start_seg_id, vessel_id AS off_id, overlapping_and_short AS off_short, year AS gap_year,
    {_DETAILS.format("off")} FROM vessels JOIN segs USING (vessel_id)),
on_segment AS (SELECT seg_id AS end_seg_id, seg_id AS on_seg, vessel_id AS on_id, overlapping_and_short AS on_short FROM segs),
on_vessel AS (SELECT vessel_id AS on_id, vessel_id AS on_vessel_id, year AS gap_year, {_DETAILS.format("on")} FROM vessels),
trips AS (
  SELECT vessel_id AS trip_of, trip_id, trip_start, trip_end, trip_end_visit_id AS visit_id FROM voyages
  WHERE trip_end IS NOT NULL AND trip_start IS DISTINCT FROM TIMESTAMP '1979-01-01'),
ports AS (SELECT visit_id, event_id AS port_event_id, id AS port_id, flag AS port_flag, name AS port_name FROM visits),
in_range AS (
  SELECT *, year(start_timestamp) AS gap_year FROM gaps
  WHERE {ended} AND TIMESTAMP '{start}' <= start_timestamp),
of_vessels AS (
  SELECT * FROM in_range JOIN off_end USING (gap_year, start_seg_id) LEFT JOIN on_segment USING (end_seg_id)
    LEFT JOIN on_vessel USING (on_id, gap_year)),
on_trips AS (
  SELECT * FROM of_vessels LEFT JOIN trips ON trip_of = off_id AND end_timestamp < trip_end
    AND coalesce(trip_start < start_timestamp, true)),
enriched AS (
  SELECT {EVENT_ID} AS event_id, ssvid, start_timestamp AS event_start, end_timestamp AS event_end,
    off_id AS vessel_id, off_id AS vessel_1_id, on_id AS vessel_2_id, start_seg_id AS seg_id,
    start_lat AS lat_min, end_lat AS lat_max, (start_lat + end_lat) / 2 AS lat_mean,
    start_lon AS lon_min, end_lon AS lon_max, {lon_mean} AS lon_mean,
    {ends}{_nearest('port')}, {_nearest('shore')}, duration_h, trip_id,
    off_short AS gap_start_overlapping_and_short, on_short AS gap_end_overlapping_and_short,
    off_short AND on_short AS gap_overlapping_and_short, off_id <> on_id AS is_multi_vessel_gap,
    port_event_id, port_id, port_flag, port_name,
    off_type AS vessel_class, off_name AS name_1, off_flag AS flag_1,
    on_vessel_id AS id_2, on_name AS name_2, on_type AS type_2, on_flag AS flag_2, on_seg AS seg_2
  FROM on_trips LEFT JOIN ports USING (visit_id))"""


_LAYERS = "[" + ", ".join(f"'{name}'" for name in REGION_LAYERS) + "]"

REGION_MATCHES = f"""
boxes AS (SELECT 'r' || CAST(n_nationkey AS VARCHAR) AS id, {_LAYERS}[n_nationkey % {len(REGION_LAYERS)} + 1] AS layer, {REGION_BOUNDS} FROM nation),
matches AS (
  SELECT DISTINCT event_id, layer, id FROM enriched JOIN boxes
    ON lon_mean >= x1 AND lon_mean < x1 + {REGION_WIDTH} AND lat_mean >= y1 AND lat_mean < y1 + {REGION_HEIGHT})"""

LAYER_LISTS = ", ".join(
    f"coalesce(string_agg(id, ',' ORDER BY id) FILTER (layer = '{layer}'), '') AS {layer}"
    for layer in REGION_LAYERS
)

# ---------------------------------------------------------------- grid cells


def s2_cells(source: str, key: str, lat: str, lon: str, level: int = 10) -> str:
    """Cell ids by walking down the curve level by level; all states are small integers."""
    walk = f"""
faced AS (
  SELECT *, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN CASE WHEN x < 0 THEN 3 ELSE 0 END
    WHEN abs(y) >= abs(z) THEN CASE WHEN y < 0 THEN 4 ELSE 1 END ELSE CASE WHEN z < 0 THEN 5 ELSE 2 END END AS face
  FROM (SELECT {key} AS k, cos(radians({lat})) * cos(radians({lon})) AS x, cos(radians({lat})) * sin(radians({lon})) AS y,
    sin(radians({lat})) AS z FROM {source} WHERE {lat} IS NOT NULL AND {lon} IS NOT NULL)),
flat AS (
  SELECT k, face,
    CASE face WHEN 0 THEN y / x WHEN 1 THEN -x / y WHEN 2 THEN -x / z WHEN 3 THEN z / x WHEN 4 THEN z / y ELSE -y / z END AS u,
    CASE face WHEN 0 THEN z / x WHEN 1 THEN z / y WHEN 2 THEN -y / z WHEN 3 THEN y / x WHEN 4 THEN -x / y ELSE -x / z END AS v
  FROM faced),
squared AS (
  SELECT k, face, CAST(floor((CASE WHEN u >= 0 THEN 0.5 * sqrt(1 + 3 * u) ELSE 1 - 0.5 * sqrt(1 - 3 * u) END) * {1 << level}) AS BIGINT) AS i,
    CAST(floor((CASE WHEN v >= 0 THEN 0.5 * sqrt(1 + 3 * v) ELSE 1 - 0.5 * sqrt(1 - 3 * v) END) * {1 << level}) AS BIGINT) AS j
  FROM flat),
walk AS (
  SELECT {level} AS bit, k, face, least(i, {(1 << level) - 1}) AS i, least(j, {(1 << level) - 1}) AS j,
    CAST(face % 2 AS BIGINT) AS turn, CAST(0 AS BIGINT) AS place FROM squared
  UNION ALL
  SELECT bit - 1, k, face, i, j,
    xor(turn, CASE child WHEN 0 THEN 1 WHEN 3 THEN 3 ELSE 0 END), place * 4 + child
  FROM (SELECT *, CAST([[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]][turn + 1]
      [((i // CAST(pow(2, bit - 1) AS BIGINT)) % 2) * 2 + (j // CAST(pow(2, bit - 1) AS BIGINT)) % 2 + 1] AS BIGINT) AS child
    FROM walk WHERE bit > 0)),
cells AS (
  SELECT k, CAST(CASE WHEN whole >= 9223372036854775808 THEN whole - 18446744073709551616 ELSE whole END AS BIGINT) AS s2_cell
  FROM (SELECT k, CAST(face AS HUGEINT) * 2305843009213693952 + CAST(place AS HUGEINT) * {1 << (61 - 2 * level)} + {1 << (60 - 2 * level)} AS whole
    FROM walk WHERE bit = 0))"""
    return walk
