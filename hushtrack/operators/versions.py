"""Operators on the versioned gaps table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushtrack.functions.time import instant
from hushtrack.sources.messages import in_days, of_vessels

GAP_KEY = ("gap_id", "start_timestamp")


def last_versions(gaps: DataFrame) -> DataFrame:
    """Latest version of each gap, one row per gap; closed wins within one version.

    The input is evaluated once: rows are ranked where they meet, so a column that is not the same
    in two evaluations cannot lose a gap. Rows of one gap, version and state are ordered by all their
    columns. For stored gaps :func:`last_stored_versions` reads narrower rows.
    """
    order = [F.desc_nulls_last("version"), F.desc_nulls_last("is_closed")]
    order += [F.desc_nulls_last(f"`{f.name}`") for f in gaps.schema if _orderable(f.dataType)]
    ranked = gaps.withColumn("_rank", F.row_number().over(Window.partitionBy(*GAP_KEY).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def stored_rank(*stored_key: str) -> str:
    """SQL of a number that is greater for later versions, then for closed rows, then by place in storage."""
    moment = "coalesce(unix_micros(version), 0L) * 2L + coalesce(cast(is_closed as long), 0L)"
    place = f"shiftrightunsigned(xxhash64({', '.join(stored_key)}), 1)"
    return f"cast(cast({moment} as decimal(18,0)) * {1 << 63}BD + {place} as decimal(38,0))"


def last_stored_versions(gaps: DataFrame, stored_key: Sequence[str]) -> DataFrame:
    """The same as :func:`last_versions` for rows that carry their place in storage.

    ``stored_key`` names columns that a stored row always has alike however often it is read, such as
    file and row number, and that no other row has; they are dropped. The newest row of each gap is found
    by a hash aggregate over the key, the version and one number for the place. Whole rows then meet
    that number, and filters on any of their columns reach the scan before they do: a filter takes away
    whole rows and cannot change which row of a gap is the newest.
    """
    ranked = gaps.withColumn("_rank", F.expr(stored_rank(*stored_key))).drop(*stored_key)
    # A month is given by the start of a gap. Where the table has it as partition, a filter on it
    # prunes both scans because it is among the columns that are joined.
    key = [*GAP_KEY, *[c for c in ("start_month",) if c in gaps.columns]]
    greatest = ranked.groupBy(*key).agg(F.max("_rank").alias("_rank"))
    return ranked.join(greatest, [*key, "_rank"], "left_semi").drop("_rank")


def last_versions_with_ties(gaps: DataFrame) -> DataFrame:
    """All rows that carry the greatest version of their gap."""
    newest = gaps.groupBy("gap_id").agg(F.max("version").alias("version"))
    return gaps.join(newest, ["gap_id", "version"], "left_semi").select(*gaps.columns)


def select_gaps(
    gaps: DataFrame,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    ssvids: Sequence[str] = (),
    is_closed: bool | None = None,
) -> DataFrame:
    """Latest versions of gaps that start on or after a day and end before another.

    The version is chosen before the filters: a gap whose latest version is filtered out must not
    reappear with an older one. Only the start filter commutes with that choice (it is part of the
    key) and is applied first, so that it prunes months. Open gaps have no end and do not pass an
    ``end_date``.
    """
    if start_date is not None:
        gaps = gaps.where(since(gaps, start_date))
    latest = last_versions(gaps)
    if end_date is not None:
        latest = latest.where(in_days(latest, "end_timestamp", None, end_date))
    latest = of_vessels(latest, ssvids)
    if is_closed is not None:
        latest = latest.where(F.col("is_closed") == F.lit(is_closed))
    return latest


def since(gaps: DataFrame, start_date: date | str) -> Column:
    """Gaps that start on or after a day; names the month partition as well where there is one."""
    condition = in_days(gaps, "start_timestamp", start_date, None)
    if "start_month" in gaps.columns:
        condition &= F.col("start_month") >= F.trunc(F.lit(str(start_date)).cast("date"), "month")
    return condition


def to_be_recreated(start_date: date | str) -> Column:
    """Gaps a run from this day on will create again; null, which means no, where a time is null."""
    day = instant(start_date)
    closed, start, end = F.col("is_closed"), F.col("start_timestamp"), F.col("end_timestamp")
    return (closed & (end >= day)) | (~closed & (start >= day))


def without_recreated(gaps: DataFrame, start_date: date | str) -> DataFrame:
    """The gaps that stay when a run starts again from a day."""
    return gaps.where(~F.coalesce(to_be_recreated(start_date), F.lit(False)))


def carried_open_gaps(gaps: DataFrame, floor_date: date | str) -> DataFrame:
    """Open gaps to carry into a run: latest versions that are still open.

    The same as ``select_gaps(gaps, floor_date, is_closed=False)``, for large tables: most gaps
    are closed, and of those only the key and the version are read, to rule out open rows.
    """
    recent = gaps.where(since(gaps, floor_date))
    closed = recent.where("is_closed").groupBy(*GAP_KEY).agg(F.max("version").alias("_closed"))
    still = recent.where("not is_closed").join(closed, list(GAP_KEY), "left")
    still = still.where("_closed is null or _closed < version")
    return last_versions(still.select(*gaps.columns))
