"""Gap detection: the public operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.errors import GapDetectionError
from hushtrack.functions import text, units
from hushtrack.functions.geodesic import distance_m
from hushtrack.functions.time import (
    MICROS_PER_HOUR,
    hours_to_micros,
    as_instant,
    instant_micros,
    micros,
    whole_second,
    within,
)
from hushtrack.operators.fill import fill
from hushtrack.operators.joins import Limits
from hushtrack.operators.slots import (
    COUNTS,
    Rules,
    neighbours,
    neighbours_bucketed,
    silences,
    slot_summary,
    window_us,
)
from hushtrack.schemas import COUNT_COLUMNS, GAP, MANDATORY, MESSAGE_DAY
from hushtrack.storage import written

DateRange = tuple[date | str, date | str]
RowFilter = Callable[[DataFrame], DataFrame]

_COUNT_OF = dict(zip(COUNTS, COUNT_COLUMNS))


@dataclass(frozen=True)
class Settings:
    """What the detection operators share.

    threshold_h: a gap is a silence strictly longer than this.
    n_hours_before: length of the look-back in which positions are counted.
    keys: columns whose values make one track.
    version: time stamp of the run, truncated to the second.
    bucket_days: split the tracks into time buckets of this length (at most 180 days) as well; by default
        those of a range longer than 180 days, and tracks with very many narrow slots, are split. Results do
        not depend on it.
    normalize_output: flat ``start_*`` / ``end_*`` columns, or two structs ``OFF`` and ``ON``.
    """

    threshold_h: float = 12.0
    n_hours_before: float = 12.0
    keys: Sequence[str] = ("ssvid",)
    version: datetime | None = None
    bucket_days: float | None = None
    normalize_output: bool = True
    limits: Limits = field(default_factory=Limits)

    def __post_init__(self) -> None:
        if self.threshold_h < 0 or self.n_hours_before < 0:
            raise ValueError("threshold_h and n_hours_before cannot be negative")
        if not self.keys:
            raise ValueError("at least one key column is needed")
        if self.bucket_days is not None and not self.bucket_days > 0:
            raise ValueError("bucket_days must be positive")


def detect_gaps(
    messages: DataFrame, settings: Settings = Settings(), start_time: date | datetime | str | None = None
) -> DataFrame:
    """Closed gaps between consecutive messages of a track.

    With ``start_time`` only gaps that start then or later are reported; earlier messages are used
    for the look-back counts alone.
    """
    since = None if start_time is None else instant_micros(start_time)
    return _run(messages, settings, pairs=True, earliest_off_us=since)


def open_gaps(
    messages: DataFrame, settings: Settings = Settings(), date_range: DateRange | None = None
) -> DataFrame:
    """Open gaps: tracks still silent at the end of the range (or of their own last day)."""
    return _run(messages, settings, open=True, date_range=date_range)


def close_open_gaps(
    known_open: DataFrame, messages: DataFrame, date_range: DateRange, settings: Settings = Settings()
) -> DataFrame:
    """Close known open gaps with the first message of the range; their fields are kept."""
    return _run(messages, settings, known_open=known_open, date_range=date_range)


def run_window(
    messages: DataFrame,
    known_open: DataFrame | None = None,
    date_range: DateRange | None = None,
    settings: Settings = Settings(threshold_h=6.0),
    eval_last: bool = True,
    keep: RowFilter | None = None,
) -> DataFrame:
    """All gaps of one run: pairs, known open gaps that close, and new open gaps.

    A ``gap_id`` is reported once: a gap found in the messages replaces the closing of the open
    gap that announced it.

    ``keep`` filters messages row by row with a join, as ``messages`` could have been before. Given
    here it is applied to the few columns of the first pass and to the few rows of the second one,
    so that whole messages are never shuffled for it.
    """
    return _run(
        messages,
        settings,
        pairs=True,
        open=eval_last,
        known_open=known_open,
        date_range=date_range,
        keep=keep,
    )


def require_columns(messages: DataFrame, keys: Sequence[str]) -> None:
    missing = sorted((set(MANDATORY) | set(keys)) - set(messages.columns))
    if missing:
        raise GapDetectionError(f"Missing column in input messages: {', '.join(missing)}")


def prepare(messages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the instant as whole microseconds.

    Rows without a key or a timestamp belong to no track and are left out.
    """
    if dict(messages.dtypes)["timestamp"] != "timestamp":
        messages = messages.withColumn("timestamp", as_instant(messages, "timestamp"))
    known = F.col("timestamp").isNotNull()
    for key in keys:
        known &= F.col(key).isNotNull()
    return messages.where(known).withColumn("_us", micros("timestamp"))


def _run(
    messages: DataFrame,
    settings: Settings,
    pairs: bool = False,
    open: bool = False,
    known_open: DataFrame | None = None,
    date_range: DateRange | None = None,
    earliest_off_us: int | None = None,
    keep: RowFilter | None = None,
) -> DataFrame:
    keys = list(settings.keys)
    threshold_us = hours_to_micros(settings.threshold_h)
    look_back_us = hours_to_micros(settings.n_hours_before)
    start_us = end_us = None
    require_columns(messages, keys)
    if date_range is not None:
        start_us, end_us = (instant_micros(d) for d in date_range)
        messages = messages.where(within(messages, "timestamp", None, end_us))
        earliest_off_us = start_us - threshold_us
    if date_range is None:
        known_open = None  # without a range there is no first message to close a gap with
    if earliest_off_us is not None:
        # Nothing before the look-back of the earliest gap matters; the scan can skip it.
        messages = messages.where(within(messages, "timestamp", earliest_off_us - look_back_us, None))

    rules = Rules(
        threshold_us=threshold_us,
        look_back_us=look_back_us,
        pairs=pairs,
        open=open,
        first=known_open is not None,
        earliest_off_us=earliest_off_us,
        range_start_us=start_us,
        range_end_us=end_us,
    )
    tracks = prepare(messages, keys)
    picked = None
    if known_open is not None:
        # Needed by both passes, and reading the latest versions of a table is not cheap.
        picked = written(pick_open_gap(known_open, keys), "open-gaps")
    kept = tracks if keep is None else keep(tracks)
    found = find(kept, rules, keys, settings, picked)
    filled = fill(tracks, found, rules, keys, settings.limits, keep)
    return create_gaps(filled, settings, tracks, picked)


def find(
    tracks: DataFrame, rules: Rules, keys: Sequence[str], settings: Settings, picked: DataFrame | None
) -> DataFrame:
    """First pass, written to the shared folder: the second pass takes it in ranges of time."""
    summary = slot_summary(tracks, keys, rules.grid)
    bucket_us = window_us(tracks, keys, rules, settings.bucket_days)
    if bucket_us is None:
        rows = neighbours(summary, keys, rules.grid)
    else:
        rows = neighbours_bucketed(summary, keys, rules.grid, bucket_us)
    found = silences(rows, rules, keys)
    if picked is not None:
        # The first message of the range matters only to tracks with an open gap.
        with_open = picked.select(*keys, F.lit(True).alias("_has_open"))
        found = (
            found.join(with_open, keys, "left")
            .withColumn("_is_first", F.col("_is_first") & F.col("_has_open").isNotNull())
            .where("_is_pair or _is_open or _is_first")
            .drop("_has_open")
        )
    return written(found, "silences")


def pick_open_gap(known_open: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One open gap per track: the one that started last, then the greatest ``gap_id``."""
    missing = sorted(({"gap_id", "start_timestamp"} | set(keys)) - set(known_open.columns))
    if missing:
        raise GapDetectionError(f"Missing column in open gaps: {', '.join(missing)}")
    rank = F.struct(F.col("start_timestamp"), F.col("gap_id"))
    row = F.struct(rank.alias("rank"), F.struct(*known_open.columns).alias("gap"))
    known = F.lit(True)
    for key in keys:
        known &= F.col(key).isNotNull()
    return known_open.where(known).groupBy(*keys).agg(F.max(row)["gap"].alias("_gap"))


def create_gaps(
    filled: DataFrame, settings: Settings, tracks: DataFrame, picked: DataFrame | None = None
) -> DataFrame:
    """Gap records from filled silences, and from open gaps that close."""
    keys = list(settings.keys)
    fields = [c for c in tracks.columns if c not in ("_us", "ssvid", MESSAGE_DAY)]
    base: list[str] = []
    closes = "false"
    if picked is not None:
        filled = filled.join(picked, keys, "left").where("not is_first or _gap is not null")
        base = filled.schema["_gap"].dataType.names
        closes = "is_first"

    columns = {
        "gap_id": text.gap_id("off.ssvid", "off_us", "off.lat", "off.lon"),
        "ssvid": "off.ssvid",
        # A track's key is part of its gaps, so that an open one can be closed by a later run.
        **{k: f"off.`{k}`" for k in keys if k != "ssvid"},
        **{name: c for c, name in _COUNT_OF.items()},
        **{f"start_{c}": f"off.`{c}`" for c in fields},
    }
    if picked is not None:  # an open gap that closes keeps its own values
        kept = {c: f"_gap.`{c}`" if c in base else "null" for c in columns}
        columns = {c: f"if(is_first, {kept[c]}, {v})" for c, v in columns.items()}
        extras = [c for c in base if c not in columns and c not in _COMPUTED and not c.startswith("end_")]
        extras += [c for c in base if c.startswith("end_") and c.removeprefix("end_") not in fields]
        columns |= {c: f"if(is_first, _gap.`{c}`, null)" for c in extras}
    columns |= {f"end_{c}": f"on.`{c}`" for c in fields}
    gaps = filled.selectExpr(
        *[f"`{k}` as `_key_{k}`" for k in keys],
        f"{closes} as _closes",
        "on_us",
        *[f"{v} as `{n}`" for n, v in columns.items()],
    )
    if picked is not None:
        # Both come from one track, whose rows are already together, and share at most a few ids.
        same = ", ".join([*[f"`_key_{k}`" for k in keys], "gap_id"])
        rank = f"row_number() over (partition by {same} order by _closes) as _rank"
        gaps = gaps.selectExpr("*", rank).where("_rank = 1")

    ends = [F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")]
    hours = f"(on_us - unix_micros(start_timestamp)) / {MICROS_PER_HOUR}.0d"
    speed = units.implied_speed_knots(F.col("distance_m"), F.col("duration_h"))
    version = F.lit(whole_second(settings.version)).cast("timestamp")
    gaps = gaps.withColumns({"distance_m": distance_m(*ends), "duration_h": F.expr(hours)}).withColumns(
        {
            "implied_speed_knots": speed,
            "version": version,
            "is_closed": F.col("on_us").isNotNull(),
        }
    )
    if settings.normalize_output:
        return gaps.select(*_column_order(gaps.columns))
    return nested(gaps, fields)


_COMPUTED = ("distance_m", "duration_h", "implied_speed_knots", "version", "is_closed")


def _column_order(columns: Sequence[str]) -> list[str]:
    """Table columns first, in table order, then the ones passed through."""
    internal = {c for c in columns if c.startswith("_")} | {"on_us"}
    known = [c for c in GAP.names if c in columns]
    return known + [c for c in columns if c not in known and c not in internal]


def nested(gaps: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The form with the messages at both ends as structs ``OFF`` and ``ON``."""

    def end(prefix: str, name: str) -> Column:
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in fields]).alias(name)

    flat = {f"{p}{c}" for p in ("start_", "end_") for c in fields}
    rest = [c for c in _column_order(gaps.columns) if c not in flat]
    return gaps.select(*rest, end("start_", "OFF"), end("end_", "ON"))
