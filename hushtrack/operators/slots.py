"""First pass: find silences from a small summary of the messages.

Time is cut into slots no wider than the threshold, so two messages of one slot can never enclose
a gap. All that matters of a slot is its first and last instant and its counts. This summary is a
plain hash aggregate with map-side combine: it reads three narrow columns, absorbs copies and
chatty vessels before the shuffle, and leaves at most ``time span / slot`` rows per vessel however
many messages that vessel sent. The windows below run over those rows, never over messages.

The look-back period is a whole number of slots, so the look-back of a gap is that many slots, or all but one of them
plus a part of the first and of the last one. Whole slots are summed here; the parts are
counted in the second pass (``hushtrack.operators.fill``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.functions.time import MICROS_PER_DAY
from hushtrack.schemas import RECEIVER_TYPES

COUNTS = ("_n", *(f"_n_{s}" for s in RECEIVER_TYPES.values()))


def quoted(names: Sequence[str]) -> list[str]:
    """Column names as they are written in SQL."""
    return [f"`{name}`" for name in names]


@dataclass(frozen=True)
class Grid:
    """``parts`` slots to every ``period`` microseconds, counted from ``anchor``.

    A slot need not be a whole number of microseconds wide: the one of an instant is
    ``floor((us - anchor) * parts / period)``. ``reach`` of them make a look-back.
    """

    period: int
    parts: int
    reach: int
    anchor: int = 0

    @property
    def width(self) -> int:
        """Width of a slot, rounded up."""
        return -(-self.period // self.parts)

    @classmethod
    def of(cls, threshold_us: int, look_back_us: int, anchor_us: int = 0) -> Grid:
        widest = threshold_us + 1  # instants of one slot then differ by at most the threshold
        if look_back_us == 0:
            return cls(widest, 1, 0, anchor_us)
        reach = -(-look_back_us // widest)
        common = math.gcd(look_back_us, reach)
        period, parts = look_back_us // common, reach // common
        if period * parts >= 1 << 62:
            # Slots of one microsecond do for thresholds so small that products would overflow.
            return cls(1, 1, look_back_us, anchor_us)
        return cls(period, parts, reach, anchor_us)

    def start(self, slot: int) -> int:
        """First instant of a slot."""
        return self.anchor - (-slot * self.period // self.parts)

    def slot(self, us: str = "_us") -> str:
        """SQL of the slot of an instant: whole periods first, so that no product overflows."""
        offset = f"({us} - {self.anchor}L)"
        rest = f"pmod({offset}, {self.period}L)"
        whole = f"(({offset} - {rest}) div {self.period}L)"
        return f"({whole} * {self.parts}L + ({rest} * {self.parts}L) div {self.period}L)"


@dataclass(frozen=True)
class Rules:
    """Which silences are wanted. All values are microseconds."""

    threshold_us: int
    look_back_us: int
    pairs: bool = True
    open: bool = False
    first: bool = False
    earliest_off_us: int | None = None
    range_start_us: int | None = None
    range_end_us: int | None = None

    @property
    def grid(self) -> Grid:
        return Grid.of(self.threshold_us, self.look_back_us, self.range_start_us or 0)


# Fixed value: no window of a track is longer, whatever the range or the setting.
MOST_WINDOW_DAYS = 180
# Rows that one window partition may hold before tracks are split by time without being asked to.
WINDOW_SLOTS = 1_000_000


def window_us(tracks: DataFrame, keys: Sequence[str], rules: Rules, bucket_days: float | None) -> int | None:
    """Length of the time buckets that tracks are split into; none if whole tracks do.

    A given length counts up to 180 days. Otherwise it is that of the range, again up to 180 days, so a
    range no longer than that leaves tracks whole. Where slots are so narrow that a track could have more
    than ``WINDOW_SLOTS`` of them in a window, the messages of the largest track are counted and the
    window is cut until that many fit on average.
    """
    longest = MOST_WINDOW_DAYS * MICROS_PER_DAY
    if bucket_days is not None:
        return min(round(bucket_days * MICROS_PER_DAY), longest)
    span = None
    if rules.range_start_us is not None and rules.earliest_off_us is not None:
        span = rules.range_end_us - rules.earliest_off_us + rules.look_back_us
    window = longest if span is not None and span > longest else None
    if min(span or longest, longest) // rules.grid.width > WINDOW_SLOTS:
        per_track = tracks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_us").alias("lo"), F.max("_us").alias("hi"))
        seen = per_track.agg(F.max("n"), F.min("lo"), F.max("hi")).first()
        if seen[0] is not None and seen[0] > WINDOW_SLOTS:
            cut = (seen[2] - seen[1]) // -(-seen[0] // WINDOW_SLOTS)
            window = max(min(cut, longest), 1)
    return window


def slot_summary(messages: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """One row per key and slot: first and last instant, counts by receiver type."""
    counts = ["count(1) as _n"] + [
        f"count_if(receiver_type = '{name}') as _n_{suffix}"
        for name, suffix in RECEIVER_TYPES.items()
    ]
    return (
        messages.selectExpr(*quoted(keys), "receiver_type", "_us", f"{grid.slot()} as _slot")
        .groupBy(*keys, "_slot")
        .agg(*[F.expr(e) for e in ("min(_us) as _lo", "max(_us) as _hi", *counts)])
    )


def neighbours(summary: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Add to each slot its neighbours and its look-back sums, one window per key."""
    return summary.selectExpr("*", *_neighbour_columns(keys, grid))


def neighbours_bucketed(
    summary: DataFrame, keys: Sequence[str], grid: Grid, bucket_us: int
) -> DataFrame:
    """Same result as :func:`neighbours`, with windows of bounded size per key.

    Slots are grouped into time buckets. Each bucket also receives the slots of the bucket before
    that its look-backs reach (overlapping windows), and the ends of consecutive buckets are
    stitched through a summary of one row per bucket.
    """
    size = max(bucket_us // grid.width, grid.reach, 1)

    def bucket(slot: str) -> str:
        return f"(({slot} - pmod({slot}, {size}L)) div {size}L)"

    own, reached = bucket("_slot"), bucket(f"(_slot + {grid.reach}L)")
    spread = summary.selectExpr(
        "*", f"{own} as _own", f"explode(array_distinct(array({own}, {reached}))) as _bucket"
    )
    inside = spread.selectExpr("*", *_neighbour_columns([*keys, "_bucket"], grid)).where(
        "_bucket = _own"
    )
    along = f"over (partition by {', '.join(quoted(keys))} order by _bucket)"
    ends = (
        summary.groupBy(*keys, F.expr(f"{own} as _bucket"))
        .agg(
            F.min("_slot").alias("_first_slot"),
            F.max("_slot").alias("_last_slot"),
            F.min("_lo").alias("_first_lo"),
        )
        .selectExpr(
            *quoted(keys),
            "_bucket",
            f"lag(_last_slot) {along} as _before",
            f"lead(_first_slot) {along} as _after",
            f"lead(_first_lo) {along} as _after_lo",
        )
    )
    return inside.join(ends, [*keys, "_bucket"]).selectExpr(
        *summary.columns,
        "coalesce(_prev_slot, _before) as _prev_slot",
        "coalesce(_next_slot, _after) as _next_slot",
        "coalesce(_next_lo, _after_lo) as _next_lo",
        *[c for c in inside.columns if c.startswith(("_mid", "_edge"))],
    )


def _neighbour_columns(part: Sequence[str], grid: Grid) -> list[str]:
    order = f"partition by {', '.join(quoted(part))} order by _slot"
    columns = [
        f"lag(_slot) over ({order}) as _prev_slot",
        f"lead(_slot) over ({order}) as _next_slot",
        f"lead(_lo) over ({order}) as _next_lo",
    ]
    far, near = grid.reach, grid.reach - 1
    if far > 0:
        edge = f"over ({order} range between {far} preceding and {far} preceding)"
        columns += [f"min(_lo) {edge} as _edge_lo", f"max(_hi) {edge} as _edge_hi"]
        columns += [f"sum({c}) {edge} as _edge{c}" for c in COUNTS]
    if near > 0:
        middle = f"over ({order} range between {near} preceding and 1 preceding)"
        columns += [f"sum({c}) {middle} as _mid{c}" for c in COUNTS]
    return columns


def silences(rows: DataFrame, rules: Rules, keys: Sequence[str]) -> DataFrame:
    """Keep the slots that end in a wanted silence (or open the range) and say why.

    ``_is_pair``: the next message is too late. ``_is_open``: there is no next message and the
    processed day ends too late. ``_is_first``: holds the first message of the range.
    ``_n*`` are the messages of the look-back that are already certain to count, and ``_edge_from``
    is set when the first slot of the look-back is only partly inside it.
    """
    grid = rules.grid
    recent = "true" if rules.earliest_off_us is None else f"_hi >= {rules.earliest_off_us}L"
    day = MICROS_PER_DAY
    end = f"(_hi - pmod(_hi, {day}L) + {day}L)" if rules.range_end_us is None else f"{rules.range_end_us}L"
    late = f"> {rules.threshold_us}L and {recent}"

    is_pair = f"coalesce(_next_lo - _hi {late}, false)" if rules.pairs else "false"
    is_open = f"(_next_slot is null and {end} - _hi {late})" if rules.open else "false"
    is_first = "(_slot >= 0 and coalesce(_prev_slot < 0, true))" if rules.first else "false"

    base, edge_from = {c: "0L" for c in COUNTS}, "cast(null as bigint)"
    if grid.reach > 0:
        start = f"(_hi - {rules.look_back_us}L)"
        edge_from = f"if(_edge_lo < {start} and _edge_hi >= {start}, {start}, null)"
        base = {c: f"coalesce(if(_edge_lo >= {start}, _edge{c}, 0L), 0L)" for c in COUNTS}
    if grid.reach > 1:
        base = {c: f"{v} + coalesce(_mid{c}, 0L)" for c, v in base.items()}

    return rows.selectExpr(
        *quoted(keys),
        "_slot",
        "_lo",
        "_hi",
        "_next_slot",
        "_next_lo",
        f"{is_pair} as _is_pair",
        f"{is_open} as _is_open",
        f"{is_first} as _is_first",
        f"{edge_from} as _edge_from",
        *[f"{v} as {c}" for c, v in base.items()],
    ).where("_is_pair or _is_open or _is_first")
