"""Reply trees to conversations.

Messages point to the message they reply to. Root-to-leaf paths come from iterated
self-joins by doubling: level k joins level k - 1 with itself to the 2^k-th ancestor,
so a thread of n turns takes log2(n) joins; then each leaf collects its ancestors from
the top level down, every one exactly once. Branches of a tree are ranked by their
mean score, the longer one on ties, then the smaller leaf; the best ``keep`` become conversations.

Template: ``[INST] role \\n text [/INST]`` for every role but the assistant, ``<s>text</s>``
for the assistant. In roles and texts a backslash is doubled, and each control string gets one
backslash after its first character, which no doubled run can look like; a newline in a role
becomes ``[\\LF]``. So the output can be read back. ``loss`` lists the spans of assistant
text in code points.

Only DataFrame expressions. Levels are written tables. A tree is one row only in the
result, where it is one string.

Nulls and ties: NULL text or role is empty; NULL scores count 0. A message whose parent is NULL,
itself or missing starts a tree path of its own. Messages without tree or node id
belong to no conversation. Repeated (tree, node) rows stand at the same place of the path, ordered by
role and text. Cycles have no leaf and give nothing; neither does what hangs from them.
Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import stored

# Control strings of the template and how they look inside a text.
CONTROL = {"[INST]": "[\\INST]", "[/INST]": "[\\/INST]", "<s>": "<\\s>", "</s>": "<\\/s>"}
NEWLINE = "[\\LF]"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, inside in CONTROL.items():
        out = F.replace(out, F.lit(plain), F.lit(inside))
    return out


def unescaped(text: Column) -> Column:
    for plain, inside in CONTROL.items():
        text = F.replace(text, F.lit(inside), F.lit(plain))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(NEWLINE))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """tree_id, leaf_id, branch (rank from 1), node_id, depth (root is 0) of the chosen branches.

    `messages`: tree_id, node_id, parent_id, score.
    """
    nodes = stored(
        messages.where("tree_id is not null and node_id is not null")
        .groupBy("tree_id", "node_id")
        .agg(F.min("parent_id").alias("parent_id"), F.sum(F.coalesce("score", F.lit(0.0))).alias("score")),
        "chat-nodes",
    )
    known = nodes.select("tree_id", F.col("node_id").alias("parent_id"))
    level = stored(
        nodes.where("parent_id <> node_id").join(known, ["tree_id", "parent_id"], "left_semi").select("tree_id", "node_id", F.col("parent_id").alias("up")),
        "chat-level",
    )
    leaves = nodes.join(level.select("tree_id", F.col("up").alias("node_id")), ["tree_id", "node_id"], "left_anti")
    levels, reach, n = [], 1, None
    while not level.isEmpty():
        levels.append(level)
        n = nodes.count() if n is None else n
        if reach > n:
            # Only what hangs from a cycle still has ancestors this far up.
            leaves = leaves.join(level, ["tree_id", "node_id"], "left_anti")
            break
        above = level.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("far"))
        level = stored(level.join(above, ["tree_id", "up"]).select("tree_id", "node_id", F.col("far").alias("up")), "chat-level")
        reach *= 2
    on_path = leaves.select("tree_id", F.col("node_id").alias("leaf_id"), "node_id", F.lit(0).cast("bigint").alias("back"))
    for k in range(len(levels) - 1, -1, -1):
        # The rows of this level only; the rest of the path is not read again.
        further = on_path.join(levels[k], ["tree_id", "node_id"]).select(
            "tree_id", "leaf_id", F.col("up").alias("node_id"), (F.col("back") + F.lit(1 << k)).alias("back")
        )
        on_path = stored(on_path.unionByName(further), "chat-path")
    scored = on_path.join(nodes.select("tree_id", "node_id", "score"), ["tree_id", "node_id"])
    branches = scored.groupBy("tree_id", "leaf_id").agg(F.avg("score").alias("mean"), F.max("back").alias("length"))
    order = Window.partitionBy("tree_id").orderBy(F.desc("mean"), F.desc("length"), "leaf_id")
    chosen = branches.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= keep)
    return on_path.join(chosen.select("tree_id", "leaf_id", "branch", "length"), ["tree_id", "leaf_id"]).select(
        "tree_id", "leaf_id", "branch", "node_id", (F.col("length") - F.col("back")).alias("depth")
    )


def conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """tree_id, leaf_id, branch, formatted, loss (array of start, end) of each chosen branch.

    `messages`: tree_id, node_id, parent_id, score, role, text.
    """
    turn = F.struct(
        "depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = paths(messages, keep).join(messages.select("tree_id", "node_id", "role", "text"), ["tree_id", "node_id"])
    whole = rows.groupBy("tree_id", "leaf_id", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    marked = F.transform("turns", lambda t: F.struct(
        (t["role"] == ASSISTANT).alias("is_loss"),
        F.when(t["role"] == ASSISTANT, F.concat(F.lit("<s>"), escaped(t["text"]), F.lit("</s>")))
        .otherwise(F.concat(F.lit("[INST] "), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(" [/INST]"))).alias("text"),
    ))
    out = whole.withColumn("marked", marked).withColumn("formatted", F.array_join(F.transform("marked", lambda t: t["text"]), ""))
    span = "array<struct<start:bigint,end:bigint>>"

    def step(state, t):
        size = F.length(t["text"]).cast("bigint")
        here = F.array(F.struct((state["at"] + 3).alias("start"), (state["at"] + size - 4).alias("end"))).cast(span)
        return F.struct((state["at"] + size).alias("at"), F.when(t["is_loss"], F.concat(state["spans"], here)).otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(span).alias("spans"))
    return out.select("tree_id", "leaf_id", "branch", "formatted", F.aggregate("marked", zero, step)["spans"].alias("loss"))


def read_back(formatted: str = "formatted") -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.regexp_extract_all(F.col(formatted), F.lit(r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>"), F.lit(0))

    def turn(part):
        is_loss = part.startswith(F.lit("<s>"))
        inner = F.substring(part, F.when(is_loss, 4).otherwise(8), F.length(part) - F.when(is_loss, 7).otherwise(15))
        cut = F.instr(inner, "\n")
        role = F.when(is_loss, F.lit(ASSISTANT)).otherwise(unescaped_role(F.substring(inner, F.lit(1), cut - 1)))
        text = F.when(is_loss, inner).otherwise(F.substring(inner, cut + 1, F.length(inner)))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped."""
    one = lambda s: unescaped(F.substring(F.col(formatted), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(loss, one), "")
