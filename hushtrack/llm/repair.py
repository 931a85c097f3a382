"""Conversation structure repair (operator 13).

Rows are dealt out by conversation and sorted by turn, and ``mapInPandas`` walks through them once. What it
carries from batch to batch is the state of a dynamic programme over four states of the wanted form
``(s?(ua)+)?``: the cost of the cheapest edits that lead to each state, which of them come first in ASCII
order, and a running digest of the repaired text. Every row adds one small number, the step taken, from which
the edits are read backwards at the end. Conversations of more rows than ``SPILL_ROWS`` hand these
numbers over in pieces, as rows of the written result, so a task holds a bounded number of them.

How ties are kept apart: edits that lead to different states over the same rows end with the edit of
the last row, so none begins another one and the order of two is that of their beginnings. So an
order of the four states is all that has to be carried. States that cannot win any more are dropped;
therefore only a few steps exist, and they are remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import shared

#: Rows of a conversation whose steps are held by the task.
SPILL_ROWS = 1 << 20

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: States: nothing yet, after s, after u, after a. The role that follows each and the state it leads to.
_START, _SYSTEM, _USER, _DONE = range(4)
_NEXT = {_START: ("user", _USER), _SYSTEM: ("user", _USER), _USER: ("assistant", _DONE), _DONE: ("user", _USER)}
_ACCEPTS = (_START, _DONE)
_FAR = 1 << 60

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_MOST_LONG = (1 << 63) - 1


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``gone`` (the row is dropped) of damaged rows.

    The damage is told by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes it a user's. A null role, text, conv_id
    or turn counts as one space there; conv_id and turn stay null otherwise. Dropped rows stay, marked, so that
    a conversation without any other row is known.
    """
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id",)], F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(copies).alias("copy"),
    ).drop("copy")


@dataclass(frozen=True)
class Step:
    """What one row does to the programme: per state the state before it and the edits in between."""

    costs: tuple[int, ...]
    ranks: tuple[int, ...]
    origin: tuple[int, ...]
    edits: tuple[str, ...]


def _choices(state: int, initial: str, extra: int, delete_only: bool) -> Iterator[tuple[int, int, str]]:
    """(cost, next state, edits) of passing one row from a state, insertions before it included."""
    cost, edits = 0, ""
    for _ in range(4):  # after three insertions all states that insertions reach have been seen
        yield cost + DELETE, state, edits + "D"
        if not delete_only:
            role, after = _NEXT[state]
            yield cost + REROLE + extra, after, edits + "R"
            if initial == role[0]:
                yield cost + extra, after, edits + "K"
            if initial == "s" and state == _START:
                yield cost + extra, _SYSTEM, edits + "K"
        cost, edits, state = cost + INSERT, edits + "I", _NEXT[state][1]


class Programme:
    """The steps met so far, by number; a step depends on the costs relative to the least, and the row."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.steps: list[Step] = []

    def step(self, costs: tuple, ranks: tuple, initial: str, truncated: bool, delete_only: bool) -> int:
        key = (costs, ranks, initial if initial in ("s", "u", "a") else "", truncated, delete_only)
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.steps)
            self.steps.append(self._make(*key))
        return number

    @staticmethod
    def _make(costs: tuple, ranks: tuple, initial: str, truncated: bool, delete_only: bool) -> Step:
        best: list = [None] * 4
        for origin in range(4):
            if costs[origin] >= _FAR:
                continue
            for cost, state, edits in _choices(origin, initial, TRUNCATED * truncated, delete_only):
                found = (costs[origin] + cost, ranks[origin], edits, origin)
                if best[state] is None or found < best[state]:
                    best[state] = found
        cost = [_FAR if b is None else b[0] for b in best]
        # What follows from one state can be had from another for a bounded price: an insertion turns
        # after-u and after-a into each other, what follows a start is an a-state's but for one kept s.
        cost = [
            _FAR if cost[s] > min(cost[_DONE] + {_START: DELETE, _SYSTEM: 0, _USER: INSERT, _DONE: _FAR}[s],
                                  cost[_USER] + {_START: DELETE + INSERT, _SYSTEM: INSERT, _USER: _FAR, _DONE: INSERT}[s]) else cost[s]
            for s in range(4)
        ]
        live = [s for s in range(4) if cost[s] < _FAR]
        order = sorted(live, key=lambda s: best[s][1:3])
        ranks = tuple(order.index(s) if s in live else 0 for s in range(4))
        pick = lambda k, none: tuple(best[s][k] if s in live else none for s in range(4))
        return Step(tuple(cost), ranks, pick(3, -1), pick(2, ""))


@dataclass
class _Conversation:
    """State carried through the rows of one conversation."""

    conv_id: object
    costs: tuple = (0, _FAR, _FAR, _FAR)
    ranks: tuple = (0, 0, 0, 0)
    base: int = 0
    digests: list = field(default_factory=lambda: [hashlib.sha256(), None, None, None])
    steps: list = field(default_factory=list)
    pieces: int = 0
    before: str | None = None
    least: int | None = None
    most: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def add(self, programme: Programme, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.most:  # turns arrive in order
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1
        seen = text.rstrip(_BLANKS)
        blank, again, cut = not seen, bool(seen) and again, bool(seen) and not again and seen[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + again, self.truncated + cut
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        number = programme.step(self.costs, self.ranks, initial, cut, blank or again)
        step = programme.steps[number]
        self.digests = [None if o < 0 else _digest(self.digests[o], o, e, role, text) for o, e in zip(step.origin, step.edits)]
        self.steps.append(number)
        least = min(step.costs)
        self.base += least
        self.costs = tuple(c if c >= _FAR else c - least for c in step.costs)
        self.ranks = step.ranks

    def end(self) -> tuple[int, int, str, str]:
        """Cost, last state, edits after the last row, digest of the repaired text."""
        closing = {_START: "", _DONE: "", _USER: "I", _SYSTEM: "II"}
        found = [(self.costs[s] + INSERT * len(e), self.ranks[s], e, s) for s, e in closing.items() if self.costs[s] < _FAR]
        cost, _, edits, state = min(found)
        return self.base + cost, state, edits, _digest(self.digests[state], state, edits, "", "").hexdigest()


def _digest(digest, state: int, edits: str, role: str, text: str):
    """The digest continued by what the edits write, from a state on."""
    digest = digest.copy()
    for edit in edits:
        if edit == "D":
            continue
        new, after = _NEXT[state]
        if edit == "K" and role[:1] != new[0]:
            after = _SYSTEM
        line = f"{new}:" if edit == "I" else f"{new if edit == 'R' else role}:{text}"
        digest.update((line if state == _START else "\n" + line).encode("utf-8", "surrogatepass"))
        state = after
    return digest


def _backwards(steps: list[Step], state: int) -> tuple[int, str]:
    """The state before these steps and the edits of the way to a state after them."""
    edits = []
    for step in reversed(steps):
        edits.append(step.edits[state])
        state = step.origin[state]
    return state, "".join(reversed(edits))


#: One row per conversation (piece null), and one per piece of steps handed over: four ways through it.
_REPORT = (
    "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, state int, piece int, origins array<int>, edits array<string>"
)


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows of a conversation together, by turn, marked if an earlier one has the same role and text."""
    order = "turn asc nulls first, role, text"
    mark = f"row_number() over (partition by conv_id, gone, role, text order by {order}) > 1"
    marked = rows.withColumn("again", F.expr(mark))
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "again")


def repaired(rows: DataFrame, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """One row per conversation: faults, and the cheapest edits that give its roles the form ``(s?(ua)+)?``.

    ``rows`` has conv_id, turn (long), role, text and, if some rows are only to be known by name, gone.
    Columns of the result: conv_id; gaps (turns missing between the first and the last one); blank,
    duplicate, truncated (rows by their first fault); illegal (neighbours whose initials are not su, ua or
    au); cost and audit (initials of Keep, Rerole, Delete, Insert in order; of equally cheap ones the
    ASCII-least); repaired_sha256 (digest of the repaired ``role:text`` lines).

    Rows are taken by turn, null turns first; rows of one turn by role, then text. A null conv_id is one
    conversation, null roles and texts are one space, a role is known by its first character. A
    conversation all of whose rows are gone has zeros, an empty audit and the digest of an empty text.
    Texts may be of any length. No rows give no rows; other columns are ignored. All rows of
    a conversation pass through one task, in order and without being held.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    filled = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone")
    )
    id_type = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        programme, talk = Programme(), None
        out: list[tuple] = []

        def hand_over(talk: _Conversation) -> None:
            ways = [_backwards([programme.steps[n] for n in talk.steps], s) if talk.digests[s] is not None else (-1, "") for s in range(4)]
            out.append((talk.conv_id, *[None] * 8, None, talk.pieces, [w[0] for w in ways], [w[1] for w in ways]))
            talk.pieces, talk.steps = talk.pieces + 1, []

        def finish(talk: _Conversation) -> None:
            cost, state, edits, digest = talk.end()
            gaps = 0 if talk.least is None else min(talk.most - talk.least + 1 - talk.turns, _MOST_LONG)
            before, audit = _backwards([programme.steps[n] for n in talk.steps], state)
            facts = (gaps, talk.blank, talk.duplicate, talk.truncated, talk.illegal, cost, audit + edits, digest)
            out.append((talk.conv_id, *facts, before if talk.pieces else None, None, None, None))

        for batch in batches:
            columns = [batch[c].array for c in ("conv_id", "turn", "role", "text", "gone", "again")]
            for conv_id, turn, role, text, is_gone, again in zip(*columns):
                conv_id, turn = None if pd.isna(conv_id) else conv_id, None if pd.isna(turn) else int(turn)
                if talk is None or talk.conv_id != conv_id:
                    if talk is not None:
                        finish(talk)
                    talk = _Conversation(conv_id)
                if not is_gone:
                    talk.add(programme, turn, role, text, bool(again))
                    if len(talk.steps) >= spill_rows:
                        hand_over(talk)
            yield _frame(out)
            out = []
        if talk is not None:
            finish(talk)
            yield _frame(out)

    # Whole numbers travel as text, since pandas would round large ones beside nulls.
    rows = _sorted(filled).select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "gone", "again")
    reports = shared(rows.mapInPandas(run, _REPORT.format("string")), "repairs")
    facts = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    short = reports.where("piece is null and state is null").select(*facts)
    long = _with_pieces(reports).select(*facts)
    return short.unionByName(long).withColumn("conv_id", F.col("conv_id").cast(id_type))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = re.findall(r"(\w+) (?:\{\}|\w+(?:<\w+>)?)(?:,|$)", _REPORT)
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pd.DataFrame({n: pd.Series(list(c), dtype="Int64" if n in _NUMBERS else object) for n, c in zip(names, columns)})


_NUMBERS = {"gaps", "blank", "duplicate", "truncated", "illegal", "cost", "state", "piece"}


def _with_pieces(reports: DataFrame) -> DataFrame:
    """Conversations that handed over pieces, with the edits of all of them before their own."""
    ends = reports.where("state is not null").drop("piece", "origins", "edits")
    pieces = reports.where("piece is not null").select("conv_id", F.struct((-F.col("piece")).alias("last_first"), "origins", "edits").alias("p"))
    # The pieces of a conversation hold four times the edits that its audit, one value, consists of.
    pieces = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("pieces"))
    start = F.struct(F.col("state").alias("state"), F.array().cast("array<string>").alias("parts"))
    way = F.aggregate(
        "pieces",
        start,
        lambda way, p: F.struct(
            F.element_at(p["origins"], way["state"] + 1).alias("state"),
            F.array_append(way["parts"], F.element_at(p["edits"], way["state"] + 1)).alias("parts"),
        ),
    )
    met = ends.alias("e").join(pieces.alias("p"), F.col("e.conv_id").eqNullSafe(F.col("p.conv_id"))).select("e.*", "p.pieces")
    audit = F.concat(F.array_join(F.reverse(way["parts"]), ""), F.col("audit"))
    return met.withColumn("audit", audit)


def repaired_sql(kinds: int = 20) -> str:
    """Damage and repair of ``conversations`` in DuckDB's SQL: one recursion step per row of a conversation,
    which keeps the least (cost, edits) that leads to each state."""
    steps = ", ".join(["-1"] * 8)
    after = "CASE WHEN k = 0 THEN state WHEN (k + (state = 2)::int) % 2 = 1 THEN 2 ELSE 3 END"
    lines = "(CASE WHEN state = 2 THEN ['assistant:', 'user:', 'assistant:'] ELSE ['user:', 'assistant:', 'user:'] END)[1:k]"
    blanks = r"[^ \x09-\x0d]"
    return f"""
        WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ') AS key FROM conversations),
        kinds AS (SELECT *, xor(list_reduce(list_concat([4294967295::bigint],
            flatten(list_transform(string_split(key, ''), lambda ch: [ascii(ch)::bigint, {steps}]))),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % {kinds} AS kind FROM keyed),
        damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
          FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies(c)),
        placed AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) AS conv,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
            left(role, 1) AS initial FROM damaged),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again FROM placed),
        rows AS (SELECT conv, conv_id, i, turn, role, text, initial,
            CASE WHEN NOT regexp_matches(text, '{blanks}') THEN 'b' WHEN again THEN 'd'
              WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
            lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM seen),
        dp(conv, i, state, key, out) AS (
          SELECT DISTINCT conv, 0::bigint, 0, '0000000000', []::varchar[] FROM rows
          UNION ALL
          SELECT conv, i + 1, dest, min(key), arg_min(out, key) FROM (
            SELECT conv, i, dest, lpad(cast(cast(key[1:10] AS BIGINT) + cost AS VARCHAR), 10, '0') || key[11:] || repeat('I', k) || edit AS key,
              list_concat(out, CASE edit WHEN 'D' THEN ins WHEN 'K' THEN list_append(ins, role || ':' || text)
                ELSE list_append(ins, CASE WHEN mid = 2 THEN 'assistant:' ELSE 'user:' END || text) END) AS out
            FROM (SELECT *, CASE WHEN edit = 'D' THEN mid WHEN edit = 'K' AND initial = 's' THEN 1 WHEN mid = 2 THEN 3 ELSE 2 END AS dest,
                2 * k + CASE edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN edit <> 'D' AND fault = 't' THEN 1 ELSE 0 END AS cost
              FROM (SELECT dp.*, r.role, r.text, r.initial, r.fault, k, edit, {after} AS mid, {lines} AS ins
                FROM dp JOIN rows r ON dp.conv = r.conv AND r.i = dp.i + 1, range(4) AS ks(k), (VALUES ('D'), ('K'), ('R')) AS es(edit)))
            WHERE edit = 'D' OR fault IN ('', 't') AND (edit = 'R' OR (initial = 's' AND mid = 0)
              OR (initial = 'u' AND mid <> 2) OR (initial = 'a' AND mid = 2)))
          GROUP BY conv, i, dest),
        facts AS (SELECT conv, any_value(conv_id) AS conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
            count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv),
        ends AS (SELECT conv, min(key) AS key, arg_min(out, key) AS out FROM (
            SELECT conv, lpad(cast(cast(key[1:10] AS BIGINT) + 2 * k AS VARCHAR), 10, '0') || key[11:] || repeat('I', k) AS key, list_concat(out, ins) AS out
            FROM (SELECT dp.*, k, {after} AS mid, {lines} AS ins FROM dp JOIN facts USING (conv), range(3) AS ks(k) WHERE i = n) WHERE mid IN (0, 3)) GROUP BY conv),
        done AS (SELECT f.*, cast(key[1:10] AS BIGINT) AS cost, key[11:] AS audit, sha256(array_to_string(out, chr(10))) AS repaired_sha256 FROM facts f JOIN ends USING (conv)),
        names AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT names.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM names LEFT JOIN done ON names.conv_id IS NOT DISTINCT FROM done.conv_id"""
