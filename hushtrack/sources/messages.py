"""Reading position messages."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushtrack.functions import units
from hushtrack.functions.time import as_date, as_instant, instant_micros, micros, utc_day, within
from hushtrack.schemas import MESSAGE, MESSAGE_DAY

# JSON messages carry the time as a number of seconds or as text, so it is read as text.
_JSON_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType) for f in MESSAGE]
    + [T.StructField("type", T.StringType())]
)


def parse_time(value: Column) -> Column:
    """Epoch seconds (integer or float) or ``2024-01-01 10:00:00 UTC`` to an instant."""
    seconds = value.try_cast("double")
    return F.coalesce(
        F.timestamp_micros(F.round(seconds * 1e6).cast("bigint")), F.try_to_timestamp(value)
    )


def extra_fields(passthrough: str | None, known: T.StructType) -> list[T.StructField]:
    """Fields declared as ``"sog double, course double"`` that a schema does not have yet."""
    declared = T.StructType.fromDDL(passthrough).fields if passthrough else []
    return [f for f in declared if f.name not in known.names]


def read_json_messages(
    spark: SparkSession,
    path: str | Sequence[str],
    lines: bool = True,
    passthrough: str | None = None,
) -> DataFrame:
    """Messages from JSON lines, or from one JSON array per file when ``lines`` is false.

    ``passthrough`` declares further columns to read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    schema = T.StructType([*_JSON_SCHEMA.fields, *extra_fields(passthrough, _JSON_SCHEMA)])
    raw = spark.read.schema(schema).option("multiLine", not lines).json(paths)
    return raw.withColumn("timestamp", parse_time(F.col("timestamp")))


def in_days(df: DataFrame, column: str, start: date | str | None, end: date | str | None) -> Column:
    """Half-open range of days on the raw timestamp column, so that it reaches the scan."""
    low, high = (None if day is None else instant_micros(as_date(day)) for day in (start, end))
    return within(df, column, low, high)


def write_by_day(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as Parquet files partitioned by UTC day and sorted by time within a file.

    Readers of a range of time open the folders of its days alone, and skip row groups within them. A day
    with very many messages is several files; messages without a time have a folder of their own.
    """
    dated = messages.withColumn(MESSAGE_DAY, utc_day(micros(as_instant(messages, "timestamp"))))
    laid_out = dated.hint("rebalance", F.col(MESSAGE_DAY)).sortWithinPartitions(MESSAGE_DAY, "timestamp")
    laid_out.write.mode(mode).partitionBy(MESSAGE_DAY).parquet(path)


def of_vessels(df: DataFrame, ssvids: Sequence[str]) -> DataFrame:
    """Rows of the given vessels; an empty list keeps all."""
    if not ssvids:
        return df
    # A set in the plan, whatever its length: the scan can use its bounds, and no column moves.
    return df.where(F.col("ssvid").isin(*sorted(set(ssvids))))


def good_segments(
    segments: DataFrame, filter_good_seg: bool, filter_not_overlapping_and_short: bool
) -> DataFrame:
    """Segments that pass the quality filters; a null flag does not pass."""
    if filter_good_seg:
        segments = segments.where("good_seg2")
    if filter_not_overlapping_and_short:
        segments = segments.where("not overlapping_and_short")
    return segments


def on_good_segments(
    messages: DataFrame,
    segments: DataFrame,
    filter_good_seg: bool = False,
    filter_not_overlapping_and_short: bool = False,
) -> DataFrame:
    """Messages whose segment is known and passes the quality filters."""
    good = good_segments(segments, filter_good_seg, filter_not_overlapping_and_short)
    return messages.join(good.select("seg_id"), "seg_id", "left_semi").select(*messages.columns)


def on_good_segments_or_none(messages: DataFrame, **filters) -> DataFrame:
    """The same for messages some sources of which know no segments: those without one stay."""
    without = messages.where(F.col("seg_id").isNull())
    return on_good_segments(messages.where(F.col("seg_id").isNotNull()), **filters).unionByName(without)


def select_messages(
    messages: DataFrame,
    segments: DataFrame | None = None,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    ssvids: Sequence[str] = (),
    filter_good_seg: bool = False,
    filter_not_overlapping_and_short: bool = False,
    passthrough: str | None = None,
) -> DataFrame:
    """Messages of a range of days, of some vessels, on known (and good enough) segments.

    ``ais_class`` is derived from ``type`` where that column exists. Each filter applies to any
    source that has its column. ``passthrough`` declares further columns that gaps shall carry.
    The day of a table partitioned by day stays, so that later filters on time can use it.
    """
    chosen = messages.where(in_days(messages, "timestamp", start_date, end_date))
    chosen = of_vessels(chosen, ssvids)
    if "ais_class" not in chosen.columns:
        kind = F.col("type") if "type" in chosen.columns else F.lit(None).cast("string")
        chosen = chosen.withColumn("ais_class", units.ais_class(kind))
    elif "type" in chosen.columns:
        chosen = chosen.withColumn("ais_class", F.coalesce("ais_class", units.ais_class(F.col("type"))))
    if segments is not None and "seg_id" in chosen.columns:
        chosen = on_good_segments(
            chosen, segments, filter_good_seg, filter_not_overlapping_and_short
        )
    # Columns the source lacks are null.
    return chosen.select(
        *[
            (F.col(f.name) if f.name in chosen.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in (*MESSAGE, *extra_fields(passthrough, MESSAGE))
        ],
        *[c for c in chosen.columns if c == MESSAGE_DAY],
    )


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources together; columns a source lacks are null."""
    if not sources:
        raise ValueError("no source of messages")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
