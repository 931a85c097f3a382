"""Table schemas. Column names and types are those of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _DBL, _LNG, _TS, _BOOL = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.TimestampType(),
    T.BooleanType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable=not need) for n, t, need in fields])


# Columns a message must have, whatever else it carries.
MANDATORY = ("ssvid", "timestamp", "lat", "lon", "receiver_type")

# Column by which a table of messages is partitioned, where it is: the UTC day of the timestamp.
MESSAGE_DAY = "message_day"

# Order in which messages with the same timestamp follow each other.
TIE_BREAK = ("msgid", "seg_id")

# Receiver types counted on their own, and the suffix of their column.
RECEIVER_TYPES = {"terrestrial": "ter", "satellite": "sat", "dynamic": "dyn"}

MESSAGE = _struct(
    ("ssvid", _STR, True),
    ("msgid", _STR, False),
    ("seg_id", _STR, False),
    ("timestamp", _TS, True),
    ("lat", _DBL, False),
    ("lon", _DBL, False),
    ("receiver_type", _STR, False),
    ("distance_from_shore_m", _DBL, False),
    ("distance_from_port_m", _DBL, False),
    ("ais_class", _STR, False),
)

_END_FIELDS = (
    ("timestamp", _TS),
    ("msgid", _STR),
    ("seg_id", _STR),
    ("lat", _DBL),
    ("lon", _DBL),
    ("ais_class", _STR),
    ("receiver_type", _STR),
    ("distance_from_shore_m", _DBL),
    ("distance_from_port_m", _DBL),
)

COUNT_COLUMNS = ("positions_hours_before",) + tuple(
    f"positions_hours_before_{s}" for s in RECEIVER_TYPES.values()
)

GAP = _struct(
    ("gap_id", _STR, True),
    ("ssvid", _STR, True),
    ("version", _TS, True),
    *[(c, _LNG, True) for c in COUNT_COLUMNS],
    ("distance_m", _DBL, False),
    ("duration_h", _DBL, False),
    ("implied_speed_knots", _DBL, False),
    *[(f"start_{n}", t, n in ("timestamp", "msgid", "seg_id")) for n, t in _END_FIELDS],
    *[(f"end_{n}", t, False) for n, t in _END_FIELDS],
    ("is_closed", _BOOL, True),
)

# The region layers of a published event.
REGION_LAYERS = (
    "eez",
    "mpa",
    "mpa_no_take",
    "mpa_no_take_partial",
    "high_seas",
    "rfmo",
    "fao",
    "major_fao",
    "eez12nm",
    "hsp",
    "protectedseas",
    "duke_paa",
    "fra_gfcm_fao",
)

REGIONS_STRUCT = T.StructType(
    [T.StructField(layer, T.ArrayType(_STR), True) for layer in REGION_LAYERS]
)

EVENT = T.StructType(
    [
        T.StructField("event_id", _STR),
        T.StructField("event_type", _STR),
        T.StructField("vessel_id", _STR),
        T.StructField("seg_id", _STR),
        T.StructField("event_start", _TS),
        T.StructField("event_end", _TS),
        *[
            T.StructField(c, _DBL)
            for c in ("lat_mean", "lon_mean", "lat_min", "lat_max", "lon_min", "lon_max")
        ],
        T.StructField("regions_mean_position", REGIONS_STRUCT),
        *[
            T.StructField(f"{end}_distance_from_{place}_km", _DBL)
            for place in ("shore", "port")
            for end in ("start", "end")
        ],
        T.StructField("event_info", _STR),
        T.StructField("event_vessels", _STR),
    ]
)

RING = T.ArrayType(T.StructType([T.StructField("lon", _DBL), T.StructField("lat", _DBL)]))

REGION = T.StructType(
    [
        T.StructField("id", _STR),
        T.StructField("layer", _STR),
        T.StructField("geo", T.ArrayType(RING)),
        T.StructField("s2_cells", T.ArrayType(_LNG)),
    ]
)
