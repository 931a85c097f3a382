"""Second pass: fetch the messages at both ends of each silence and finish its counts.

Every silence asks for rows of at most three slots of its vessel: the slot of the last message
before it (that message, and the earlier ones of the slot for the counts), the slot at the far end
of the look-back when only part of it counts, and the slot of the first message after it. The
requests are few and narrow; messages that answer none are dropped at the join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.functions.time import within
from hushtrack.operators.joins import Limits, slot_ranges
from hushtrack.operators.slots import COUNTS, Rules, quoted
from hushtrack.schemas import MESSAGE_DAY, RECEIVER_TYPES, TIE_BREAK
from hushtrack.storage import fresh_path

# What a request is for, as a byte: messages to count, or a whole message to fetch.
_COUNT, _OFF, _ON, _FIRST = "0Y", "1Y", "2Y", "3Y"


def requests(found: DataFrame, rules: Rules, keys: Sequence[str]) -> DataFrame:
    """One row per silence, slot and purpose.

    ``_gap`` identifies the silence of a key, ``_from`` and ``_to`` bound the wanted instants.
    """
    start = f"_hi - {rules.look_back_us}L"
    far_slot = f"_slot - {rules.grid.reach}L"
    far_end = f"{start} + {rules.grid.width}L"
    is_gap = "(_is_pair or _is_open)"

    def request(when: str, kind: str, slot: str, gap: str, first_us: str, last_us: str) -> str:
        return (
            f"if({when}, struct({kind} as _kind, {slot} as _slot, {gap} as _gap, "
            f"{first_us} as _from, {last_us} as _to), null)"
        )

    wanted = [
        request(is_gap, _OFF, "_slot", "_hi", "_hi", "_hi"),
        request(f"{is_gap} and _lo < _hi", _COUNT, "_slot", "_hi", start, "_hi - 1L"),
        request(f"{is_gap} and _edge_from is not null", _COUNT, far_slot, "_hi", "_edge_from", far_end),
        request("_is_pair", _ON, "_next_slot", "_hi", "_next_lo", "_next_lo"),
        request("_is_first", _FIRST, "_slot", "_lo", "_lo", "_lo"),
    ]
    base = [f"{c} as _base{c}" for c in COUNTS]
    on = "if(_is_pair, _next_lo, null) as _on"
    explode = f"explode(array_compact(array({', '.join(wanted)}))) as _r"
    return found.selectExpr(*quoted(keys), on, *base, explode).selectExpr(
        *quoted(keys), "_on", *[f"_base{c}" for c in COUNTS], "_r.*"
    )


def fill(
    messages: DataFrame,
    found: DataFrame,
    rules: Rules,
    keys: Sequence[str],
    limits: Limits,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Messages at the ends of each silence and its look-back counts.

    Requests are broadcast, so that messages are not shuffled, however many requests there are: they
    are taken in ranges of slots that fit, and each range reads only the messages of its time.

    ``keep`` filters rows; it was applied to the messages of the first pass already.

    Columns: the keys, ``off`` and ``on`` (whole messages), their instants, the counts, and
    ``is_first`` for rows that only carry the first message of the range (in ``on``).
    """
    ties = [c for c in TIE_BREAK if c in messages.columns]
    payload = ties + [c for c in messages.columns if c not in ("_us", MESSAGE_DAY, *ties)]
    wanted = requests(found, rules, keys)
    ranges = slot_ranges(wanted, keys, limits)

    def answers(asked: DataFrame, told: DataFrame) -> DataFrame:
        slotted = told.selectExpr("*", f"{rules.grid.slot()} as _slot")
        hits = slotted.join(F.broadcast(asked), [*keys, "_slot"]).where("_us between _from and _to")
        return _answers(hits if keep is None else keep(hits), keys, payload)

    if len(ranges) <= 1:
        return _records(answers(wanted, messages), keys)
    path = fresh_path(messages.sparkSession, "answers")
    for r in ranges:
        low, high = rules.grid.start(r.first), rules.grid.start(r.last + 1)
        near = messages.where(within(messages, "timestamp", low, high))
        answers(wanted.where(r.where(keys)), near).write.mode("append").parquet(path)
    return _records(messages.sparkSession.read.parquet(path), keys)


def _answers(hits: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Combine equal answers before they are compared.

    A whole message is kept only where one was asked for. Messages that merely count become equal
    rows, and so do copies of one message, so a hash aggregate with map-side combine leaves a few
    rows per silence, whatever the number of messages in its slots.
    """
    per_silence = ["_on", *[f"_base{c}" for c in COUNTS]]
    # Key columns are in the row anyway.
    fetched = [c for c in payload if c not in keys]
    combined = (
        hits.selectExpr(
            *quoted(keys),
            "_gap",
            "_kind",
            f"if(_kind = {_COUNT}, receiver_type, null) as _receiver",
            *[f"if(_kind = {_COUNT}, null, `{c}`) as `_m_{c}`" for c in fetched],
            *per_silence,
        )
        .groupBy(*keys, "_gap", "_kind", "_receiver", *[f"_m_{c}" for c in fetched])
        .agg(F.expr("count(1) as _rows"), *[F.expr(f"max({c}) as {c}") for c in per_silence])
    )
    # The tie-break comes first, so comparing messages follows it; the rest of the message comes
    # after it, so that the choice never depends on how the data is partitioned.
    message = F.struct(*[F.col(c if c in keys else f"_m_{c}").alias(c) for c in payload])
    return combined.select(*keys, "_gap", "_kind", "_receiver", "_rows", *per_silence, message.alias("_m"))


def _records(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per silence from its few answers."""
    counted = f"filter (where _kind = {_COUNT})"
    sums = [f"coalesce(sum(_rows) {counted}, 0) as _n"] + [
        f"coalesce(sum(if(_receiver = '{name}', _rows, 0)) {counted}, 0) as _n_{suffix}"
        for name, suffix in RECEIVER_TYPES.items()
    ]
    merged = answers.groupBy(*keys, "_gap", F.expr(f"_kind = {_FIRST} as _is_first")).agg(
        F.expr(f"max(_m) filter (where _kind = {_OFF}) as off"),
        F.expr(f"min(_m) filter (where _kind in ({_ON}, {_FIRST})) as on"),
        *[F.expr(s) for s in sums],
        *[F.expr(f"max({c}) as {c}") for c in ("_on", *[f"_base{c}" for c in COUNTS])],
    )
    own = {f"_n_{s}": f"if(off.receiver_type <=> '{r}', 1, 0)" for r, s in RECEIVER_TYPES.items()}
    return merged.selectExpr(
        *quoted(keys),
        "_is_first as is_first",
        "off",
        "on",
        "if(_is_first, null, _gap) as off_us",
        "if(_is_first, _gap, _on) as on_us",
        *[f"{c} + _base{c} + {own.get(c, '1')} as {c}" for c in COUNTS],
    )
