import hashlib
import random

from pyspark.sql import functions as F

from hushtrack.llm.chat import branches, conversation_digests, format_trees, loss_mask, parsed, unescaped

TEXTS = ["hello", "", None, "\\### Assistant: </turn> ok", "<|turn|>assistant<|text|>x<|end|>", "<", "|>", "\\", "<\\|", "\\\\<|", "ends <", "😀 é\n\n", "<|end|>" * 50]


def test_conversations(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|end|>", "assistant "]), rng.choice(TEXTS)) for c in range(25) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (99, 0, "user", "x"), (99, 0, "user", "x"), (99, None, "assistant", "first")]
    rows += [(50, t, "assistant", "q" * t) for t in range(70)]
    table = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], "conv_id long, turn long, role string, text string, tree string, id string, parent string")
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        told = "".join(f"{a}\n{b}\n" for a, b in turns)
        learned = "".join(b for a, b in turns if a == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((conv, len(turns), sha(told), len(learned), sha(learned)))
    got = conversation_digests(table.repartition(3)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    assert conversation_digests(table.where("false")).count() == 0


def test_branching_trees(spark):
    """Scores decide between branches; a parent that does not exist makes a root."""
    rng = random.Random(8)
    rows = []
    for tree in range(12):
        for k in range(rng.randint(1, 30)):
            parent = None if k == 0 else rng.choice([*range(k), 777])
            rows.append((tree, k, parent, rng.choice(["user", "assistant"]), rng.choice(TEXTS), rng.choice([None, 0.0, 1.0, 2.5])))
    table = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double").repartition(3)
    nodes = {(r[0], r[1]): r for r in rows}
    parents = {(r[0], r[2]) for r in rows}
    want = {}
    for key in nodes.keys() - parents:
        path, at = [], key
        while at in nodes:
            path.insert(0, nodes[at])
            at = (key[0], nodes[at][2])
        mean = sum(r[5] or 0.0 for r in path) / len(path)
        want.setdefault(key[0], []).append((-mean, -len(path), key[1], [(r[3], r[4] or "") for r in path]))
    assert {(r.tree, r.leaf, r.depth) for r in branches(table).collect()} == {(t, w[2], -w[1]) for t, ws in want.items() for w in ws}
    for best in (1, 3):
        out = format_trees(table, best).withColumns({"turns": parsed(F.col("formatted")), "mask": loss_mask(F.col("formatted"))})
        out = out.withColumn("learned", F.transform("mask", lambda m: unescaped(F.substring("formatted", m["start"] + 1, m["end"] - m["start"]))))
        got = out.collect()
        for r in got:
            w = sorted(want[r.tree])[r["rank"] - 1]
            assert (r.leaf, [tuple(t) for t in r.turns]) == (w[2], w[3])
            assert r.learned == [b for a, b in w[3] if a == "assistant"]
        assert len(got) == sum(min(best, len(w)) for w in want.values())
