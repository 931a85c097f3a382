"""Which regions hold a point: join on grid cells with what matters of each region in a cell."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.functions.cells import cell_boxes, crossings, cut_to_boxes, ring_edges
from hushtrack.schemas import REGION_LAYERS


#: Cells of a region that are cut in one go; a region of very many cells is spread over tasks.
CELLS_AT_ONCE = 256

_PIECES = (
    "s2_cell bigint, layer string, id string, parity int, flips array<double>, "
    "edges array<struct<x1:double,y1:double,x2:double,y2:double>>"
)


def region_cells(regions: DataFrame) -> DataFrame:
    """One narrow row per region and cell; regions without cells drop out."""
    return regions.select("id", "layer", F.explode("s2_cells").alias("s2_cell"))


def region_pieces(regions: DataFrame) -> DataFrame:
    """Regions cut to their cells, made once and joined to points ever after.

    A row has what decides about points of one cell in one region: the edges near the cell, and how
    often a line to the east crosses the others (``parity``, changed at the latitudes ``flips``). A
    cell wholly inside has parity 1 and nothing else, and one wholly outside, which a coarse covering may
    list, has no row. So the work for a point does not grow with the outline of a region.
    """
    last = F.greatest(F.size("s2_cells") - 1, F.lit(0))
    parts = F.explode(F.sequence(F.lit(0), F.floor(last / CELLS_AT_ONCE).cast("int"))).alias("part")
    dealt = regions.where(F.size("s2_cells") > 0).select("id", "layer", ring_edges(F.col("geo")).alias("edges"), "s2_cells", parts)
    some = F.slice("s2_cells", F.col("part") * CELLS_AT_ONCE + 1, CELLS_AT_ONCE)
    # Neighbouring rows are parts of one region, and small rows are much work here: deal them out, by a
    # fixed number so that the adaptive planner does not put them back together.
    tasks = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("id", "layer", "edges", some.alias("cells")).repartition(tasks, "id", "layer", "cells")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                edges = np.array([[e[k] for k in ("x1", "y1", "x2", "y2")] for e in row["edges"] or []], float).reshape(-1, 4)
                cells = np.array(row["cells"], np.int64)
                parity, flips, near = cut_to_boxes(cell_boxes(cells), edges)
                some = [k for k, p in enumerate(parity.tolist()) if p or k in flips or k in near]
                columns = [
                    pa.array(cells[some]),
                    pa.repeat(pa.scalar(row["layer"], pa.string()), len(some)),
                    pa.repeat(pa.scalar(row["id"], pa.string()), len(some)),
                    pa.array(parity[some], pa.int32()),
                    pa.array([flips.get(k, ()) for k in some], pa.list_(pa.float64())),
                    pa.array([[dict(zip(("x1", "y1", "x2", "y2"), e)) for e in near[k].tolist()] if k in near else () for k in some], pa.list_(_EDGE)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    return dealt.mapInArrow(cut, _PIECES)


_EDGE = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
_SCHEMA = pa.schema([
    ("s2_cell", pa.int64()), ("layer", pa.string()), ("id", pa.string()),
    ("parity", pa.int32()), ("flips", pa.list_(pa.float64())), ("edges", pa.list_(_EDGE)),
])


def points_in_regions(points: DataFrame, regions: DataFrame, point_id: str) -> DataFrame:
    """Distinct ``(point_id, layer, id)`` of the regions that hold each point.

    ``points`` has ``lon`` (from -180 to 180), ``lat`` and ``s2_cell``. ``regions`` are regions with their
    cells, or the pieces :func:`region_pieces` makes of them, which may be stored. The only join is that on the
    cell: its sides are chosen by size at run time, and skewed cells are split by the adaptive planner.
    """
    pieces = regions if "flips" in regions.columns else region_pieces(regions)
    met = points.join(pieces, "s2_cell")
    lat = F.col("lat")
    east = F.col("parity") + F.size(F.filter("flips", lambda y: y <= lat)) + crossings(F.col("lon"), lat, F.col("edges"))
    return met.where(east % 2 == 1).select(point_id, "layer", "id").distinct()


def regions_by_layer(
    matches: DataFrame, point_id: str, layers: Sequence[str] = REGION_LAYERS
) -> DataFrame:
    """One row per point with an array of region ids for every layer, empty where none matched."""
    of_layer = [
        F.sort_array(F.collect_list(F.when(F.col("layer") == layer, F.col("id")))).alias(layer)
        for layer in layers
    ]
    # The arrays are bounded by the number of regions that overlap in one point.
    return matches.groupBy(point_id).agg(F.struct(*of_layer).alias("regions"))
