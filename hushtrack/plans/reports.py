"""Summaries of the gaps table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.functions.text import grid_code


def gaps_per_day(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy(F.to_date("start_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("gaps")
    )


def gaps_per_month(gaps: DataFrame) -> DataFrame:
    return (
        gaps_per_day(gaps)
        .groupBy(F.trunc("day", "month").alias("month"))
        .agg(F.sum("gaps").alias("gaps"))
    )


def monthly_difference(filtered: DataFrame, unfiltered: DataFrame) -> DataFrame:
    """Gaps per month under two filter settings and how far they are apart, on average too."""
    a = gaps_per_month(filtered).withColumnRenamed("gaps", "gaps_filtered")
    b = gaps_per_month(unfiltered).withColumnRenamed("gaps", "gaps_unfiltered")
    both = a.join(b, "month").withColumn(
        "difference", F.abs(F.col("gaps_filtered") - F.col("gaps_unfiltered"))
    )
    # One row per month by now, so one partition is enough for the average.
    average = F.bround(F.avg("difference").over(Window.partitionBy())).cast("bigint")
    return both.withColumn("average_difference", average)


def gaps_per_flag(gaps_with_flag: DataFrame) -> DataFrame:
    return gaps_with_flag.groupBy("flag").agg(F.count(F.lit(1)).alias("gaps"))


def top_flags(gaps_with_flag: DataFrame, n: int = 10) -> DataFrame:
    """The flags with most gaps."""
    return gaps_per_flag(gaps_with_flag).orderBy(F.desc("gaps"), "flag").limit(n)


def gaps_per_grid_cell(gaps: DataFrame) -> DataFrame:
    """Gaps per cell of 0.01 degrees, by the position where they start."""
    known = gaps.where(F.col("start_lat").isNotNull() & F.col("start_lon").isNotNull())
    code = grid_code(F.col("start_lon"), F.col("start_lat"))
    return known.groupBy(code.alias("gridcode")).agg(F.count(F.lit(1)).alias("gaps"))
