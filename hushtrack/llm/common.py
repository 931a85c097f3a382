"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hushtrack.storage import fresh_path, written

#: The white space that the operators know, ``[\x20\x09-\x0D]``.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_blanks(text: Column) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), BLANKS, text)


def shared(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder, read back: cuts lineage and fixes values such as row numbers."""
    return written(df, f"llm-{name}")


class Scratch:
    """Tables in the shared folder that go when their last reader has run.

    ``with Scratch(spark) as keep: table = keep(df, name)``. What is returned from the block must not
    read them any more: write it with :func:`shared` first.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path = spark, fresh_path(spark, "llm-scratch")

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def unit_hash(column: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the value's MD5."""
    digits = F.substring(F.md5(column.cast("string").cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def lowest_per_component(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (a, b): rows (node, root), root the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes, which
    takes a number of rounds logarithmic in the number of nodes. Each step is a join with the
    smallest neighbour of each node, which is a hash aggregate; no neighbourhood is collected.
    Null ends are ignored; no links give no rows.
    """
    edges = links.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = shared(edges.distinct(), "links")
    before = None
    for _ in range(max_rounds):
        edges = shared(_small_star(_large_star(edges)), "links")
        # A star forest is a fixed point; equal sums and counts of all links mark it.
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
        )
    )
    return edges.select(ends.alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of node and neighbours."""
    both = _both_ways(edges)
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    hang = edges.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = lowest.select("a", F.col("m").alias("b"))
    return hang.unionByName(own).distinct()
