"""Spherical grid cells (S2) and point-in-region tests."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: level at which regions are gridded.
REGION_CELL_LEVEL = 10

_MAX_LEVEL = 30
_SWAP, _INVERT = 1, 2

# The Hilbert curve of the published cell numbering. Row = orientation of the
# parent, column = (i bit, j bit); the entry is the position of that child along the curve.
_CHILD_POSITION = np.array(
    [[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]], dtype=np.int64
)
# Change of orientation when descending into the child at each position.
_ORIENTATION_CHANGE = np.array([_SWAP, 0, 0, _INVERT + _SWAP], dtype=np.int64)


def cell_ids(lat, lon, level: int = REGION_CELL_LEVEL) -> np.ndarray:
    """Signed 64-bit cell ids of points in degrees."""
    phi, theta = np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float))
    p = np.stack([np.cos(phi) * np.cos(theta), np.cos(phi) * np.sin(theta), np.sin(phi)])
    axis = np.abs(p).argmax(axis=0)
    main = np.take_along_axis(p, axis[None, :], axis=0)[0]
    face = np.where(main < 0, axis + 3, axis)
    x, y, z = p
    u = np.choose(face, [y, -x, -x, z, z, -y]) / np.choose(face, [x, y, z, x, y, z])
    v = np.choose(face, [z, z, -y, y, -x, -x]) / np.choose(face, [x, y, z, x, y, z])

    def grid(w):
        s = np.where(w >= 0, 0.5 * np.sqrt(1 + 3 * np.abs(w)), 1 - 0.5 * np.sqrt(1 + 3 * np.abs(w)))
        return np.clip(np.floor(s * (1 << _MAX_LEVEL)), 0, (1 << _MAX_LEVEL) - 1).astype(np.int64)

    i, j = grid(u), grid(v)
    turn = (face & _SWAP).astype(np.int64)
    position = np.zeros(len(face), dtype=np.int64)
    for bit in range(_MAX_LEVEL - 1, _MAX_LEVEL - 1 - level, -1):
        child = _CHILD_POSITION[turn, (((i >> bit) & 1) << 1) | ((j >> bit) & 1)]
        position = (position << 2) | child
        turn ^= _ORIENTATION_CHANGE[child]
    rest = 2 * (_MAX_LEVEL - level)
    ids = (
        (face.astype(np.uint64) << np.uint64(61))
        | (position.astype(np.uint64) << np.uint64(rest + 1))
        | np.uint64(1 << rest)
    )
    return ids.view(np.int64)


@F.pandas_udf(T.LongType())
def _cell(lat: pd.Series, lon: pd.Series) -> pd.Series:
    out = pd.Series([pd.NA] * len(lat), dtype="Int64")
    known = (lat.notna() & lon.notna()).to_numpy()
    if known.any():
        out[known] = cell_ids(lat[known], lon[known])
    return out


# A join on the cell implies that it is not null, and the optimizer would evaluate the function a
# second time below other joins to check that. Only deterministic functions are moved.
_cell = _cell.asNondeterministic()


def cell(lat: Column, lon: Column) -> Column:
    """Cell of a point at the region grid level; null for a null coordinate."""
    return _cell(lat.cast("double"), lon.cast("double"))


def cell_boxes(cells) -> np.ndarray:
    """West, south, east and north of boxes, in degrees, that hold the cells; one row per cell.

    Sides of cells are great circles, so boxes are wider than the corners by a margin. A cell at a pole or
    at the antimeridian gets all longitudes.
    """
    ids = np.asarray(cells, np.int64).view(np.uint64)
    low = ids & (~ids + np.uint64(1))
    level = _MAX_LEVEL - np.round(np.log2(low.astype(float)) / 2).astype(np.int64)
    face = (ids >> np.uint64(61)).astype(np.int64)
    position = ((ids & np.uint64((1 << 61) - 1)) >> np.uint64(1)).astype(np.int64)
    i, j, turn = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), face & _SWAP
    for bit in range(_MAX_LEVEL - 1, -1, -1):
        here = _MAX_LEVEL - 1 - bit < level
        child = (position >> (2 * bit)) & 3
        corner = _CHILD_CORNER[turn, child]
        i, j = np.where(here, i | ((corner >> 1) << bit), i), np.where(here, j | ((corner & 1) << bit), j)
        turn = np.where(here, turn ^ _ORIENTATION_CHANGE[child], turn)
    width = 1.0 / (1 << level)
    across = np.linspace(0, 1, _PER_SIDE)
    s = (i / (1 << _MAX_LEVEL))[:, None, None] + width[:, None, None] * across[None, :, None]
    t = (j / (1 << _MAX_LEVEL))[:, None, None] + width[:, None, None] * across[None, None, :]
    u, v = (np.broadcast_to(_plane(w), (len(ids), _PER_SIDE, _PER_SIDE)) for w in (s, t))
    f, one = face[:, None, None], np.ones_like(u)
    x = np.choose(f, [one, -u, -u, -one, v, v])
    y = np.choose(f, [u, one, -v, -v, -one, u])
    z = np.choose(f, [v, v, one, -u, -u, -one])
    lat, lon = np.degrees(np.arctan2(z, np.hypot(x, y))), np.degrees(np.arctan2(y, x))
    # Between neighbouring sampled points the cell bends by far less than half their distance.
    margin = np.degrees(width / _PER_SIDE) * 0.5 + 1e-9
    south, north = lat.min(axis=(1, 2)) - margin, lat.max(axis=(1, 2)) + margin
    stretch = 1 / np.maximum(np.cos(np.radians(np.maximum(np.abs(south), np.abs(north)).clip(0, 90))), 1e-12)
    west, east = lon.min(axis=(1, 2)) - margin * stretch, lon.max(axis=(1, 2)) + margin * stretch
    whole = (east - west > 180) | (west < -180) | (east > 180) | (np.maximum(np.abs(south), np.abs(north)) >= 90)
    return np.stack([np.where(whole, -180.0, west), south, np.where(whole, 180.0, east), north], axis=1)


_PER_SIDE = 5
_CHILD_CORNER = np.argsort(_CHILD_POSITION, axis=1)


def _plane(s: np.ndarray) -> np.ndarray:
    """The inverse of the quadratic grid of a face."""
    return np.where(s >= 0.5, (4 * s * s - 1) / 3, (1 - 4 * (1 - s) ** 2) / 3)


def ring_edges(rings: Column) -> Column:
    """Edges of a polygon given as ``array<array<struct<lon,lat>>>``; rings close themselves."""

    def edges(ring):
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
            ),
        )

    return F.flatten(F.transform(rings, edges))


def crossings(lon: Column, lat: Column, edges: Column) -> Column:
    """How many edges a line from a point to the east crosses, in plain longitude/latitude space."""

    def crossed(edge):
        rise = edge["y2"] - edge["y1"]
        side = (lon - edge["x1"]) * rise - (edge["x2"] - edge["x1"]) * (lat - edge["y1"])
        spans = (edge["y1"] > lat) != (edge["y2"] > lat)
        return spans & F.when(rise > 0, side < 0).otherwise(side > 0)

    return F.size(F.filter(edges, crossed))


def inside(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd test of a point against all edges of a polygon."""
    return crossings(lon, lat, edges) % 2 == 1


def cut_to_boxes(boxes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray], dict[int, np.ndarray]]:
    """What of a polygon matters to points of each box: parity, and by box the flips and edges, if any.

    For a point of a box the number of edges (rows of x1, y1, x2, y2) east of it has the parity of: the
    given one, and the flips at its latitude or south of it, and the crossings of the edges returned. Edges
    wholly west of the box are never crossed. Those wholly east of it count by latitude alone, so only
    latitudes within the box where their number changes by one are kept.
    """
    x1, y1, x2, y2 = edges.T
    low, high = np.minimum(y1, y2), np.maximum(y1, y2)
    west, south, east, north = boxes.T[:, :, None]
    near = (low <= north) & (high > south) & (np.maximum(x1, x2) >= west)
    beyond = near & (np.minimum(x1, x2) > east)
    parity = np.count_nonzero(beyond & (low <= south), axis=1) % 2
    flips, kept = {}, {}
    starts, ends = beyond & (low > south), beyond & (high <= north)
    for k in np.flatnonzero((starts | ends).any(axis=1)).tolist():
        values, times = np.unique(np.concatenate([low[starts[k]], high[ends[k]]]), return_counts=True)
        flips[k] = values[times % 2 == 1]
    near &= ~beyond
    for k in np.flatnonzero(near.any(axis=1)).tolist():
        kept[k] = edges[near[k]]
    return parity, flips, kept
