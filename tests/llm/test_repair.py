import hashlib
import random
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import pytest

from hushtrack.llm import repair

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
FACTS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
ORDER = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=ORDER)


def slow_repair(rows):
    """Facts and cheapest edits of one conversation, by trying all edits."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, said, inserts):
        """Least (cost, edits, lines) from row i on, after so many insertions in a row; said is the form so far."""
        ways = []
        if i == len(rows) and said in ("", "sa", "a"):
            ways.append((0, "", ()))
        role = "assistant" if said in ("u", "su") else "user"
        after = {"": "u", "s": "su", "u": "a", "su": "sa", "a": "u", "sa": "su"}[said]
        if inserts < 4:
            c, e, t = best(i, after, inserts + 1)
            ways.append((c + 2, "I" + e, (f"{role}:", *t)))
        if i < len(rows):
            _, _, have, text = rows[i]
            c, e, t = best(i + 1, said, 0)
            ways.append((c + 3, "D" + e, t))
            more = faults[i] == "t"
            if faults[i] in ("", "t"):
                c, e, t = best(i + 1, after, 0)
                ways.append((c + 2 + more, "R" + e, (f"{role}:{text}", *t)))
                if have[:1] == role[0]:
                    ways.append((c + more, "K" + e, (f"{have}:{text}", *t)))
                if have[:1] == "s" and said == "":
                    c, e, t = best(i + 1, "s", 0)
                    ways.append((c + more, "K" + e, (f"{have}:{text}", *t)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    count, turns = Counter(faults), [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def conversations(rng, count, longest):
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t", None, "Ä ö. ", "x\n", "?" * 70]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            turn = rng.choice([turn, turn, turn, turn + 3, None]) if conv % 3 else turn
            text = rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(99)}{rng.choice(['.', '.', ''])}"
            rows.append((conv, turn, rng.choice(roles) if conv % 2 else ["user", "assistant"][(turn or 0) % 2], text))
    return rows + [(None, 0, "user", "a."), (None, None, "assistant", "b."), (None, 2**62, "user", "c."), rows[5], rows[5]]


@pytest.fixture(scope="module")
def rows():
    return conversations(random.Random(3), 150, 7) + [(2**60 + 1, k, ("user", "assistant")[k % 7 == 0], f"w {k}.") for k in range(110)]


@pytest.mark.parametrize("spill", [1, 3, 1 << 20])
def test_brute_force(spark, rows, spill):
    table = spark.createDataFrame([(*r, "?", "?") for r in rows], SCHEMA + ", gone string, again string").repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repaired(repair.damaged(table), spill_rows=spill).select(*FACTS).collect()}
    damaged = slow_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        want = slow_repair([r for r in damaged if r[0] == conv])
        assert got[conv] == want, conv


def test_sql(spark, rows):
    small = [r for r in rows if r[0] is None or r[0] < 10**6]
    table = spark.createDataFrame(small, SCHEMA)
    frame = table.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    db = duckdb.connect()
    db.register("conversations", frame)
    key = lambda r: (r[0] is not None, r[0])
    want = sorted(db.execute(repair.repaired_sql()).fetchall(), key=key)
    assert sorted((tuple(r) for r in repair.repaired(repair.damaged(table)).select(*FACTS).collect()), key=key) == want


def test_dropped_and_empty(spark):
    gone = next(k for k in range(999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    out = repair.repaired(repair.damaged(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA))).select(*FACTS).collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert repair.repaired(repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_few_steps_are_kept():
    """What is carried stays small: long conversations take steps that are known already."""
    rng, programme = random.Random(1), repair.Programme()
    talk = repair._Conversation(1)
    sizes = []
    for k in range(6000):
        kind = rng.choice(["user", "assistant", "assistant", "system", "x"]) if k % 50 else "system"
        talk.add(programme, k, kind, rng.choice(["a.", "b", ""]), rng.random() < 0.1)
        sizes.append(len(programme.steps))
    assert sizes[-1] < 500 and len(talk.costs) == 4
