"""Join of a very large table with requests by time slot, in ranges of slots that can be broadcast."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Each bin that is too large is cut into two to this power.
_BITS = 6


@dataclass(frozen=True)
class Limits:
    """Sizes at which the physical strategy changes. They never change a result."""

    # Requests that are broadcast at once, in bytes as they lie in memory.
    broadcast_bytes: int = 128 << 20


@dataclass(frozen=True)
class SlotRange:
    """Requests of the slots from first to last whose key falls in one of so many parts."""

    first: int
    last: int
    part: int = 0
    parts: int = 1

    def where(self, keys: Sequence[str]) -> str:
        inside = f"_slot between {self.first}L and {self.last}L"
        names = ", ".join(f"`{k}`" for k in keys)
        return inside if self.parts == 1 else f"{inside} and pmod(xxhash64({names}), {self.parts}) = {self.part}"


def slot_ranges(requests: DataFrame, keys: Sequence[str], limits: Limits) -> list[SlotRange]:
    """Ranges of slots whose requests fit the limit.

    Sizes are gathered as a histogram of 64 bins over all slots. A bin larger than the limit is cut into
    64 bins again, until it fits or is a single slot, so the driver gets at most 64 rows per range and
    level (there are at most eleven), however narrow the slots are and however they lie in time.
    """
    fixed = 16 + sum(24 if t == "string" else 8 for _, t in requests.dtypes)
    texts = [F.octet_length(c) for c, t in requests.dtypes if t == "string"]
    size = F.sum(sum(texts, F.lit(fixed)))
    weighed = [F.min("_slot").alias("first"), F.max("_slot").alias("last"), size.alias("bytes")]
    whole = requests.agg(*weighed).first()
    if whole["bytes"] is None:
        return []
    low, span = whole["first"], whole["last"] - whole["first"]
    shift = _BITS * -(-span.bit_length() // _BITS)
    light, heavy = [], [whole] if whole["bytes"] > limits.broadcast_bytes and shift else []
    if not heavy:
        light = [whole]
    while heavy:
        # Bins of one level are equally wide and aligned, so the number of a bin tells whose part it is.
        inside = F.shiftright(F.col("_slot") - low, shift).isin([(r["first"] - low) >> shift for r in heavy])
        shift -= _BITS
        finer = F.shiftright(F.col("_slot") - low, shift).alias("bin")
        bins = requests.where(inside).groupBy(finer).agg(*weighed).collect()
        heavy = [b for b in bins if b["bytes"] > limits.broadcast_bytes and shift]
        light += [b for b in bins if b["bytes"] <= limits.broadcast_bytes or not shift]
    return list(_ranges(sorted((b["first"], b["last"], b["bytes"]) for b in light), limits.broadcast_bytes))


def _ranges(sizes: Iterable[tuple[int, int, int]], most: int) -> Iterator[SlotRange]:
    """Neighbouring bins, given as first slot, last slot and size, put together as far as they fit."""
    first = last = None
    held = 0
    for start, end, size in sizes:
        if first is not None and held + size > most:
            yield from _parts(first, last, held, most)
            first, held = None, 0
        first = start if first is None else first
        last, held = end, held + size
    if first is not None:
        yield from _parts(first, last, held, most)


def _parts(first: int, last: int, size: int, most: int) -> Iterator[SlotRange]:
    # Only a single slot can be too large; its tracks are dealt out by their hash.
    parts = -(-size // most)
    for part in range(parts):
        yield SlotRange(first, last, part, parts)
