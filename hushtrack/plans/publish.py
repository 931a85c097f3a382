"""Publication: gaps enriched with vessels, voyages, ports and regions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hushtrack.functions import text, units
from hushtrack.functions.cells import cell
from hushtrack.functions.time import MICROS_PER_DAY, as_date, instant_micros, micros
from hushtrack.operators.regions import points_in_regions, regions_by_layer
from hushtrack.operators.versions import since
from hushtrack.schemas import EVENT
from hushtrack.sources.messages import in_days
from hushtrack.sources.tables import EventsTable, conform
from hushtrack.storage import require_utc, written

# Fixed value: start that marks a voyage whose beginning is not known.
UNKNOWN_TRIP_START = "1979-01-01"

_JSON = {"ignoreNullFields": "false"}


def gaps_to_publish(
    gaps: DataFrame,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    include_open: bool = False,
) -> DataFrame:
    """Gaps that start in the range and end before its end; open gaps only on request."""
    chosen = gaps if start_date is None else gaps.where(since(gaps, start_date))
    if end_date is not None:
        ended = in_days(gaps, "end_timestamp", None, end_date)
        started = in_days(gaps, "start_timestamp", None, end_date)
        still_open = F.col("end_timestamp").isNull() & started
        chosen = chosen.where(ended | still_open if include_open else ended)
    return chosen.withColumn("year", F.year("start_timestamp"))


def segments_of_vessels(segment_info: DataFrame, segs_activity: DataFrame) -> DataFrame:
    return segment_info.select("seg_id", "vessel_id").join(
        segs_activity.select("seg_id", "overlapping_and_short"), "seg_id"
    )


def usable_voyages(voyages: DataFrame) -> DataFrame:
    """Voyages with a plausible (or no) start."""
    # Without an end a voyage encloses nothing; without a vessel it has none.
    voyages = voyages.where(F.col("trip_end").isNotNull() & F.col("vessel_id").isNotNull())
    start = F.col("trip_start")
    marker = F.lit(UNKNOWN_TRIP_START).cast("date").cast("timestamp")
    return voyages.where((start != marker) | start.isNull()).select(
        "trip_id",
        "trip_start",
        "trip_end",
        "trip_start_anchorage_id",
        "trip_end_anchorage_id",
        "trip_end_visit_id",
        F.col("vessel_id").alias("_voyage_vessel_id"),
    )


def visits(port_visits: DataFrame) -> DataFrame:
    """Port visits with their visit id and intermediate anchorage."""
    parsed = port_visits.withColumn("_info", F.try_parse_json("event_info"))
    anchorage = [
        text.json_string(F.col("_info"), f"$.intermediate_anchorage.{name}").alias(name)
        for name in ("id", "flag", "name")
    ]
    return parsed.select(
        F.get_json_object("event_info", "$.visit_id").alias("_visit_id"),
        F.col("event_id").alias("_port_event_id"),
        F.struct(*anchorage).alias("_anchorage"),
    )


def with_vessels(gaps: DataFrame, segments: DataFrame, vessels: DataFrame) -> DataFrame:
    """Add the segments and vessels of both ends; gaps of unknown start vessels drop out.

    The mandatory joins come first: they shrink the rows, and a reader that needs nothing of the
    optional ones can leave those out.
    """

    def segment(end: str) -> DataFrame:
        return segments.select(
            F.col("seg_id").alias(f"{end}_seg_id"),
            F.col("seg_id").alias(f"_{end}_seg"),
            F.col("vessel_id").alias(f"_{end}_vessel_id"),
            F.col("overlapping_and_short").alias(f"_{end}_overlapping"),
        )

    def vessel(end: str) -> DataFrame:
        about = F.struct(F.col("vessel_id").alias("id"), "shipname", "prod_shiptype", "mmsi_flag")
        return vessels.select(
            F.col("vessel_id").alias(f"_{end}_vessel_id"), "year", about.alias(f"_{end}_vessel")
        )

    # A gap whose segment or vessel is not known at the start drops out, so that join is inner.
    known = gaps.join(segment("start"), "start_seg_id").join(vessel("start"), ["_start_vessel_id", "year"])
    known = left_of_known(known, segment("end"), ["end_seg_id"])
    return left_of_known(known, vessel("end"), ["_end_vessel_id", "year"])


def left_of_known(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """A left join for keys that are often null: a null key has a random value beside it, so that
    such rows, which match nothing, are not sent to one task."""
    spread = F.when(F.col(on[0]).isNull(), F.pmod(F.xxhash64("gap_id"), F.lit(1 << 20))).otherwise(F.lit(0))
    left = left.withColumn("_spread", spread.cast("int"))
    # Zero, but not a constant: the optimizer would take a constant out of the join's keys.
    right = right.withColumn("_spread", F.pmod(F.xxhash64(on[0]), F.lit(1)).cast("int"))
    key = F.coalesce(F.col(f"_l.{on[0]}"), F.lit("")) == F.col(f"_r.{on[0]}")
    same = key & (F.col("_l._spread") == F.col("_r._spread")) & F.col(f"_l.{on[0]}").isNotNull()
    for c in on[1:]:
        same &= F.col(f"_l.{c}") == F.col(f"_r.{c}")
    joined = left.alias("_l").join(right.alias("_r"), same, "left")
    more = [F.col(f"_r.{c}") for c in right.columns if c not in (*on, "_spread")]
    return joined.select(*[F.col(f"_l.{c}") for c in left.columns if c != "_spread"], *more)


def gap_start_span(
    gaps: DataFrame, start_date: date | str | None, end_date: date | str | None
) -> tuple[int, int]:
    """Range of instants in which published gaps start: the requested days, or what is there."""
    if start_date is not None and end_date is not None:
        return instant_micros(as_date(start_date)), instant_micros(as_date(end_date))
    span = gaps.agg(F.min(micros("start_timestamp")), F.max(micros("start_timestamp"))).first()
    return (0, 0) if span[0] is None else (span[0], span[1])


def voyage_intervals(voyages: DataFrame, span_us: tuple[int, int], bucket_days: int = 7) -> DataFrame:
    """Voyages by the aligned intervals of time they reach into: columns _level and _node are added.

    Intervals of level k are 2^k buckets wide. A voyage is stored at the level just as wide as what it
    shares with ``span_us`` or wider, so it has at most two rows however long it lasts. A voyage without
    a start counts from the beginning of the span; one outside the buckets of the span has no row.
    """
    first, last = (_bucket(F.lit(us), bucket_days) for us in span_us)
    since = F.greatest(F.coalesce(_bucket(micros("trip_start"), bucket_days), first), first) - first
    until = F.least(_bucket(micros("trip_end"), bucket_days), last) - first
    more = until - since
    level = F.when(more > 0, F.length(F.bin(more))).otherwise(F.lit(0))
    inside = voyages.withColumns({"_since": since, "_until": until, "_level": level}).where("_since <= _until")
    nodes = F.expr("sequence(shiftright(_since, _level), shiftright(_until, _level))")
    return inside.withColumn("_node", F.explode(nodes)).drop("_since", "_until")


def _bucket(us: Column, bucket_days: int) -> Column:
    width = F.lit(bucket_days * MICROS_PER_DAY)
    return F.floor((us - F.pmod(us, width)) / width)


def with_voyages(
    gaps: DataFrame, voyages: DataFrame, span_us: tuple[int, int], bucket_days: int = 7
) -> DataFrame:
    """Add the voyages under way during each gap: started before it and ended after it.

    A join on the vessel alone would compare every gap of a vessel with every voyage of it, and one
    row per bucket of a voyage grows with its length. A voyage that encloses a gap reaches into the
    interval of its own level in which the gap starts, so a gap asks one interval of each level:
    vessel, level and interval are the key. Only the vessel and the two instants of gaps, once each,
    are spread over the levels; whole gaps meet the answers on those three. ``gaps`` is read twice.
    """
    width_us = bucket_days * MICROS_PER_DAY
    first, last = (us // width_us for us in span_us)
    levels = max(last - first, 0).bit_length()
    ends = ["_start_vessel_id", "start_timestamp", "end_timestamp"]
    asked = gaps.where(F.col("end_timestamp").isNotNull()).select(*ends).distinct()
    asked = asked.withColumn("_at", _bucket(micros("start_timestamp"), bucket_days) - F.lit(first))
    asked = asked.withColumn("_gap_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    asked = asked.withColumn("_gap_node", F.expr("shiftright(_at, _gap_level)"))

    enclosing = (
        (F.col("_start_vessel_id") == F.col("_voyage_vessel_id"))
        & (F.col("_gap_level") == F.col("_level"))
        & (F.col("_gap_node") == F.col("_node"))
        & (F.col("trip_start").isNull() | (F.col("trip_start") < F.col("start_timestamp")))
        & (F.col("trip_end") > F.col("end_timestamp"))
    )
    found = asked.join(voyage_intervals(voyages, span_us, bucket_days), enclosing)
    found = found.select(*[F.col(c).alias(f"_of_{c}") for c in ends], *voyages.columns)
    same = [F.col(c) == F.col(f"_of_{c}") for c in ends]
    return gaps.join(found, same, "left").drop(*[f"_of_{c}" for c in ends])


def with_port_visits(gaps: DataFrame, port_visits: DataFrame) -> DataFrame:
    """Add the port visit that ends the voyage."""
    known = port_visits.where(F.col("_visit_id").isNotNull()).withColumnRenamed("_visit_id", "trip_end_visit_id")
    return left_of_known(gaps, known, ["trip_end_visit_id"])


def event_info() -> Column:
    """Details of the event, as JSON text."""
    first, last = F.col("_start_vessel_id"), F.col("_end_vessel_id")
    start_short, end_short = F.col("_start_overlapping"), F.col("_end_overlapping")

    def nearest(place: str) -> Column:
        start, end = F.col(f"start_distance_from_{place}_m"), F.col(f"end_distance_from_{place}_m")
        return units.least_or_first(start, end).alias(f"gap_min_distance_from_{place}_m")

    port = F.struct(
        F.col("_port_event_id").alias("event_id"),
        F.col("_anchorage.id").alias("id"),
        F.col("_anchorage.flag").alias("flag"),
        F.col("_anchorage.name").alias("name"),
    )
    info = F.struct(
        "duration_h",
        units.meters_to_km(F.col("distance_m")).alias("total_distance_km"),
        "implied_speed_knots",
        F.col("_start_vessel.prod_shiptype").alias("vessel_class"),
        port.alias("main_vessel_destination_port"),
        first.alias("vessel_1_id"),
        last.alias("vessel_2_id"),
        (first != last).alias("is_multi_vessel_gap"),
        start_short.alias("gap_start_overlapping_and_short"),
        end_short.alias("gap_end_overlapping_and_short"),
        (start_short & end_short).alias("gap_overlapping_and_short"),
        nearest("port"),
        nearest("shore"),
    )
    return F.to_json(info, _JSON)


def event_vessels() -> Column:
    """The vessel at the start and, where another one ends the gap, that vessel as well."""

    def vessel(end: str) -> Column:
        about = F.col(f"_{end}_vessel")
        return F.struct(
            F.col("ssvid"),
            about["id"].alias("id"),
            about["shipname"].alias("name"),
            about["prod_shiptype"].alias("type"),
            about["mmsi_flag"].alias("flag"),
            F.col(f"_{end}_seg").alias("seg_id"),
        )

    other = F.col("_end_vessel_id") != F.col("_start_vessel_id")
    both = F.array(vessel("start"), vessel("end"))
    return F.to_json(F.when(other, both).otherwise(F.array(vessel("start"))), _JSON)


def base_events(enriched: DataFrame, antimeridian_safe: bool = False) -> DataFrame:
    """Events without regions, one row per gap and enclosing voyage."""
    start, end = F.col("start_timestamp"), F.col("end_timestamp")
    kilometers = [
        units.meters_to_km(F.col(f"{side}_distance_from_{place}_m")).alias(
            f"{side}_distance_from_{place}_km"
        )
        for place in ("shore", "port")
        for side in ("start", "end")
    ]
    return enriched.select(
        text.event_id(F.col("_start_vessel_id"), start, end).alias("event_id"),
        F.lit("gaps").alias("event_type"),
        F.col("_start_vessel_id").alias("vessel_id"),
        F.col("_start_seg").alias("seg_id"),
        start.alias("event_start"),
        end.alias("event_end"),
        ((F.col("start_lat") + F.col("end_lat")) / F.lit(2.0)).alias("lat_mean"),
        units.mean_lon(F.col("start_lon"), F.col("end_lon"), antimeridian_safe).alias("lon_mean"),
        # Named after the order of the ends, not after the values.
        F.col("start_lat").alias("lat_min"),
        F.col("end_lat").alias("lat_max"),
        F.col("start_lon").alias("lon_min"),
        F.col("end_lon").alias("lon_max"),
        *kilometers,
        event_info().alias("event_info"),
        event_vessels().alias("event_vessels"),
    )


def event_regions(events: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions of the mean position of each event that lies in any."""
    points = events.select("event_id", F.col("lon_mean").alias("lon"), F.col("lat_mean").alias("lat"))
    # Events repeated by several voyages have one position.
    located = points.distinct().withColumn("s2_cell", cell(F.col("lat"), F.col("lon")))
    return regions_by_layer(points_in_regions(located, regions, "event_id"), "event_id")


def event_points(events: DataFrame) -> DataFrame:
    """Positions of each event as points: event_id, start, end and mean, each with lon and lat.

    One row per event, however many voyages it lies in; an unknown coordinate is null in its point.
    """
    at = {"start": ("lon_min", "lat_min"), "end": ("lon_max", "lat_max"), "mean": ("lon_mean", "lat_mean")}
    points = [units.lon_lat(F.col(lon), F.col(lat)).alias(name) for name, (lon, lat) in at.items()]
    return events.select("event_id", *points).distinct()


@dataclass(frozen=True)
class PublishInputs:
    """Tables the events are built from."""

    gaps: DataFrame
    segment_info: DataFrame
    segs_activity: DataFrame
    voyages: DataFrame
    port_visits: DataFrame
    regions: DataFrame
    vessels_byyear: DataFrame


def enriched_gaps(
    inputs: PublishInputs,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    include_open: bool = False,
) -> DataFrame:
    """Gaps with everything an event needs except regions."""
    gaps = gaps_to_publish(inputs.gaps, start_date, end_date, include_open)
    segments = segments_of_vessels(inputs.segment_info, inputs.segs_activity)
    # Read for the voyages asked for and once more for whole gaps.
    enriched = written(with_vessels(gaps, segments, inputs.vessels_byyear), "known_gaps")
    span_us = gap_start_span(inputs.gaps, start_date, end_date)
    enriched = with_voyages(enriched, usable_voyages(inputs.voyages), span_us)
    return with_port_visits(enriched, visits(inputs.port_visits))


def gap_events(
    inputs: PublishInputs,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    include_open: bool = False,
    antimeridian_safe: bool = False,
) -> DataFrame:
    """Gap events, ready to be published. Events outside all regions have no region struct.

    The events are written first: the search for regions and the result read them both.
    """
    events = base_events(
        enriched_gaps(inputs, start_date, end_date, include_open), antimeridian_safe
    )
    events = written(events, "events")
    of_regions = event_regions(events, inputs.regions).withColumnRenamed(
        "regions", "regions_mean_position"
    )
    return conform(events.join(of_regions, "event_id", "left"), EVENT)


def run_publish(
    spark: SparkSession,
    inputs: PublishInputs,
    events_path: str,
    start_date: date | str,
    end_date: date | str,
    include_open: bool = False,
    antimeridian_safe: bool = False,
) -> DataFrame:
    """Build the events of a range and replace the events table with them."""
    require_utc(spark)
    table = EventsTable(spark, events_path)
    table.overwrite(gap_events(inputs, start_date, end_date, include_open, antimeridian_safe))
    return table.read()
