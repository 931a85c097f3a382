"""Vessel tables derived from the driver's tables by rules that SQL can repeat."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hushtrack.functions.cells import cell_ids
from hushtrack.schemas import REGION, REGION_LAYERS
from hushtrack.storage import fresh_path, written

RECEIVER_OF_EVENT = {
    "click": "terrestrial",
    "view": "satellite",
    "purchase": "dynamic",
    "error": "terrestrial",
    "signup": "unknown",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The month of events, stretched to twenty of them, passes a year end.
YEARS_FROM, STRETCH = "2023-03-01", 20


def over_years(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all events stretched over several months, and the tables that name their vessels."""
    folder = fresh_path(spark, "over-years")
    us = "unix_micros(cast(ts as timestamp))"
    start, zero = (f"unix_micros(timestamp'{day}')" for day in (YEARS_FROM, "2024-01-01"))
    events = table(spark, sf_dir, "events")
    later = F.expr(f"timestamp_micros({start} + {STRETCH} * ({us} - {zero}))").cast(events.schema["ts"].dataType)
    events.withColumn("ts", later).write.parquet(f"{folder}/events.parquet")
    for name in ("customer", "nation"):
        table(spark, sf_dir, name).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _vessel() -> Column:
    return F.expr("concat('v', user_id, '-', day(ts) % 2)")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a source table holds them, with the message type."""
    receiver = "case event_type " + " ".join(
        f"when '{e}' then '{r}'" for e, r in RECEIVER_OF_EVENT.items()
    )
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) ssvid",
        "cast(event_id as string) msgid",
        "concat(user_id, '-', date_format(ts, 'yyyyMMdd')) seg_id",
        "cast(ts as timestamp) timestamp",
        "case when event_id % 97 <> 0 then cast(event_id * 7919 % 17000 as double) / 100 - 85 end lat",
        "case when event_id % 97 <> 0 then cast(event_id * 104729 % 36000 as double) / 100 - 180 end lon",
        f"{receiver} end receiver_type",
        "value * 1000 distance_from_shore_m",
        "value * 2000 distance_from_port_m",
        "case event_id % 3 when 0 then 'AIS.1' when 1 then 'AIS.18' else 'AIS.27' end type",
    )


def segs_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.expr("date_format(ts, 'yyyyMMdd')").alias("day"))
        .agg(F.max("ts").cast("timestamp").alias("last_timestamp"))
        .selectExpr(
            "concat(user_id, '-', day) seg_id",
            "user_id % 10 <> 0 good_seg2",
            "user_id % 7 = 0 overlapping_and_short",
            "last_timestamp",
        )
    )


def segment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select(F.expr("concat(user_id, '-', date_format(ts, 'yyyyMMdd'))").alias("seg_id"), _vessel().alias("vessel_id"))
        .distinct()
    )


def vessels_byyear(spark: SparkSession, sf_dir: str) -> DataFrame:
    vessels = (
        table(spark, sf_dir, "events")
        .select("user_id", _vessel().alias("vessel_id"), F.year("ts").alias("year"))
        .distinct()
    )
    owner = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return vessels.join(owner, F.col("user_id") == F.col("c_custkey")).select(
        "vessel_id",
        "year",
        F.col("c_name").alias("shipname"),
        F.col("c_mktsegment").alias("prod_shiptype"),
        F.col("n_name").alias("mmsi_flag"),
    )


def voyages(spark: SparkSession, sf_dir: str) -> DataFrame:
    along = Window.partitionBy("vessel_id").orderBy("ts", "event_id")
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'signup'")
        .select("event_id", "ts", _vessel().alias("vessel_id"))
        .withColumn("next_ts", F.lead("ts").over(along))
        .selectExpr(
            "concat('t', event_id) trip_id",
            "case when event_id % 11 = 0 then null when event_id % 13 = 0 then timestamp'1979-01-01' "
            "else cast(ts as timestamp) end trip_start",
            "cast(next_ts as timestamp) trip_end",
            "concat('a', event_id % 100) trip_start_anchorage_id",
            "concat('a', event_id % 50) trip_end_anchorage_id",
            "concat('visit-', event_id - event_id % 3) trip_end_visit_id",
            "vessel_id",
        )
    )


def port_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth anchorage id is a number, which does not count as text."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .selectExpr(
            "concat('pv', event_id) event_id",
            "concat('{\"visit_id\":\"visit-', event_id - event_id % 3, '\",\"intermediate_anchorage\":{\"id\":', "
            "case when event_id % 5 = 0 then concat('', event_id % 100) else concat('\"a', event_id % 100, '\"') end, "
            "',\"flag\":\"F', event_id % 25, '\",\"name\":\"port ', event_id % 40, '\"}}') event_info",
        )
    )


# Rectangle of each nation. No mean position of two messages lies on an edge.
REGION_WIDTH, REGION_HEIGHT = 10, 6
REGION_BOUNDS = """
    cast(n_nationkey * 13 % 330 as double) - 170.0025 as x1,
    cast(n_nationkey * 37 % 100 as double) - 55.0025 as y1
"""
# Closer than half the width of any cell of the region grid; the margin is wider than any cell.
_GRID_STEP, _MARGIN_LAT, _MARGIN_LON = 0.03, 0.15, 0.3


def _cells_of_box(batches):
    for boxes in batches:
        rows = []
        for box in boxes.itertuples():
            lon = np.arange(box.x1 - _MARGIN_LON, box.x1 + REGION_WIDTH + _MARGIN_LON, _GRID_STEP)
            lat = np.arange(box.y1 - _MARGIN_LAT, box.y1 + REGION_HEIGHT + _MARGIN_LAT, _GRID_STEP)
            x, y = (v.ravel() for v in np.meshgrid(lon, lat))
            rows.append((box.n_nationkey, np.unique(cell_ids(y, x)).tolist()))
        yield pd.DataFrame(rows, columns=["n_nationkey", "s2_cells"])


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with the grid cells they touch."""
    layers = F.array(*[F.lit(name) for name in REGION_LAYERS])
    boxes = table(spark, sf_dir, "nation").selectExpr("n_nationkey", *REGION_BOUNDS.split(",\n"))
    covered = boxes.repartition(8).mapInPandas(_cells_of_box, "n_nationkey int, s2_cells array<bigint>")
    x1, y1 = F.col("x1"), F.col("y1")
    x2, y2 = x1 + REGION_WIDTH, y1 + REGION_HEIGHT
    corner = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    ring = F.array(corner(x1, y1), corner(x2, y1), corner(x2, y2), corner(x1, y2))
    named = boxes.join(covered, "n_nationkey").select(
        F.concat(F.lit("r"), F.col("n_nationkey")).alias("id"),
        F.element_at(layers, F.col("n_nationkey") % len(REGION_LAYERS) + 1).alias("layer"),
        F.array(ring).alias("geo"),
        "s2_cells",
    )
    return written(named.select(*[F.col(f.name).cast(f.dataType) for f in REGION]), "regions")
