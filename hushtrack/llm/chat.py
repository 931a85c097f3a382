"""Chat formatting of reply trees (operator 5), DataFrame operations only.

A tree of messages is turned into conversations: iterative self-joins find for each message its
root, its depth and the sum of scores on the way (pointers double at each join, so a tree of depth d
takes log2(d) of them), branches are ranked by their score, and only the chosen root-to-leaf paths
are then spelled out and formatted.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn, one after the other. In roles and texts
``\\`` is written ``\\\\`` and ``<|`` is written ``<\\|``, so no marker can occur inside them, and
reading back undoes it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.llm.common import shared

#: The markers of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def branches(messages: DataFrame) -> DataFrame:
    """One row per leaf of a tree: tree, leaf, depth (of the leaf, root 1), score (sum on the path).

    messages: tree, id (unique in its tree), parent (null or unknown: a root), score (null: 0).
    """
    nodes = messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = nodes.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    jump = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "id", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"), "score"
    )
    jump = shared(jump, "jump")
    reached = [jump.where("up is null")]
    steps = 1
    # Only paths that have not reached their root join once more; those that have are set aside.
    while not (climbing := jump.where("up is not null")).isEmpty():
        if steps > 1 << 40:
            raise ValueError("the replies form a circle")
        above = reduce(DataFrame.unionByName, reached, climbing).select(
            "tree", F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("score").alias("score2")
        )
        jump = shared(
            climbing.join(above, ["tree", "up"]).select(
                "tree",
                "id",
                F.col("up2").alias("up"),
                (F.col("depth") + F.col("depth2")).alias("depth"),
                (F.col("score") + F.col("score2")).alias("score"),
            ),
            "jump",
        )
        reached.append(jump.where("up is null"))
        steps *= 2
    jump = reduce(DataFrame.unionByName, reached)
    parents = nodes.where("parent is not null").select("tree", F.col("parent").alias("id")).distinct()
    return jump.join(parents, ["tree", "id"], "left_anti").select("tree", F.col("id").alias("leaf"), "depth", "score")


def paths(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """The messages on the way from each chosen leaf to its root: tree, leaf, id, distance (leaf 0)."""
    hop = messages.select("tree", "id", F.col("parent").alias("up"))
    hop = shared(hop.join(hop.select("tree", F.col("id").alias("up")), ["tree", "up"], "left_semi"), "hop")
    way = shared(chosen.select("tree", "leaf", F.col("leaf").alias("id"), F.lit(0).cast("long").alias("distance")), "way")
    step = 1
    # After k joins the way holds the 2^k messages next to the leaf, and hop leads 2^k messages up.
    while not hop.isEmpty():
        further = way.join(hop, ["tree", "id"]).select("tree", "leaf", F.col("up").alias("id"), (F.col("distance") + step).alias("distance"))
        way = shared(way.unionByName(further), "way")
        second = hop.select("tree", F.col("id").alias("up"), F.col("up").alias("up2"))
        hop = shared(hop.join(second, ["tree", "up"]).select("tree", "id", F.col("up2").alias("up")), "hop")
        step *= 2
    return way


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """The best root-to-leaf paths of each tree, formatted: tree, rank, leaf, score, formatted.

    messages: tree, id, parent, role, text, score. Paths are ranked by the mean score of their
    messages, then the longer first, then the smallest leaf. A null role or text counts as empty.
    Ids must be unique within a tree. An empty table gives an empty result; other columns are ignored.
    """
    messages = shared(
        messages.select(
            "tree", "id", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score"
        ),
        "messages",
    )
    leaves = branches(messages).withColumn("mean", F.col("score") / F.col("depth"))
    order = F.struct((-F.col("mean")).alias("low"), (-F.col("depth")).alias("short"), F.col("leaf").alias("leaf"))
    if best == 1:
        top = leaves.groupBy("tree").agg(F.min(order).alias("o")).withColumn("rank", F.lit(1))
    else:
        # Ranked in parts first: a tree may have any number of leaves.
        part = Window.partitionBy("tree", F.pmod(F.xxhash64("o.leaf"), F.lit(256))).orderBy("o")
        top = leaves.select("tree", order.alias("o")).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= best)
        top = top.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy("o"))).where(F.col("rank") <= best)
    chosen = shared(top.select("tree", "rank", F.col("o.leaf").alias("leaf"), (-F.col("o.low")).alias("score")), "chosen")
    turns = paths(messages, chosen).join(messages.select("tree", "id", "role", "text"), ["tree", "id"])
    turn = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT), escaped(F.col("text")), F.lit(END))
    spelled = turns.select("tree", "leaf", F.struct((-F.col("distance")).alias("at"), turn.alias("turn")).alias("t"))
    spelled = spelled.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    spelled = spelled.select("tree", "leaf", F.array_join("ts.turn", "").alias("formatted"))
    return chosen.join(spelled, ["tree", "leaf"]).select("tree", "rank", "leaf", "score", "formatted")


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of structs role, text."""
    turns = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)

    def fields(turn: Column) -> Column:
        both = F.split(F.replace(turn, F.lit(END), F.lit("")), r"<\|text\|>", 2)
        return F.struct(unescaped(both[0]).alias("role"), unescaped(both[1]).alias("text"))

    return F.transform(turns, fields)


def loss_mask(formatted: Column, role: str = LEARNED_ROLE) -> Column:
    """Where loss is taken: the texts of a role, without markers, as [start, end) in code points."""
    turns = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)
    body = len(TEXT)

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + len(TURN)
        head = F.length(F.split(turn, r"<\|text\|>", 2)[0])
        span = F.struct((start + head + body).alias("start"), (start + F.length(turn) - len(END)).alias("end"))
        of_role = F.startswith(turn, F.lit(role + TEXT))
        none = F.array().cast("array<struct<start:int,end:int>>")
        spans = F.concat(state["spans"], F.when(of_role, F.array(span)).otherwise(none))
        return F.struct((start + F.length(turn)).alias("at"), spans.alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, zero, step, lambda s: s["spans"])


def linear_trees(conversations: DataFrame) -> DataFrame:
    """A table of turns as trees without branches: each row replies to the one before it.

    Rows of a conversation are ordered by turn (null first); rows of one turn by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    number = F.row_number().over(order).cast("long")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("id", number)
    return rows.select(
        F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """All conversations formatted, and digests of what is read back from the formatted texts.

    One row per conv_id: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    Rows without conv_id form one conversation. Null roles and texts count as empty.
    """
    kind = conversations.schema["conv_id"].dataType
    null_key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    whole = format_trees(linear_trees(conversations.withColumn("conv_id", null_key)))
    text = F.col("formatted")
    read = whole.select("tree", text, parsed(text).alias("turns"), loss_mask(text).alias("mask"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(
        F.transform("mask", lambda m: unescaped(F.substring(text, m["start"] + 1, m["end"] - m["start"]))), ""
    )
    read = read.withColumns({"told": told, "learned": learned})
    return read.select(
        F.when(F.col("tree") != "", F.col("tree")).cast(kind).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("told", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length(text).cast("long").alias("formatted_chars"),
    )


def conversation_digests_sql(conversations: str = "conversations") -> str:
    """The same in DuckDB's SQL, computed from the rows."""
    turn = "coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10)"
    learned = f"CASE WHEN coalesce(role, '') = '{LEARNED_ROLE}' THEN coalesce(text, '') ELSE '' END"
    cost = lambda c: f"length(replace(replace({c}, '\\', '\\\\'), '<|', '<\\|'))"
    order = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
    fixed = len(TURN + TEXT + END)
    return f"""
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg({turn}, '' {order})) AS turns_sha256,
          CAST(sum(length({learned})) AS BIGINT) AS loss_chars,
          sha256(string_agg({learned}, '' {order})) AS loss_sha256,
          CAST(sum({fixed} + {cost("coalesce(role, '')")} + {cost("coalesce(text, '')")}) AS BIGINT) AS formatted_chars
        FROM {conversations} GROUP BY conv_id"""
