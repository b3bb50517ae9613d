r"""Reply trees to conversations in a chat template; DataFrame functions only.

Template of a turn: ``<|im_start|>ROLE\nTEXT<|im_end|>\n``. Inside roles and texts
every ``<`` + backslashes + ``|`` gets one backslash more, so a control string never
occurs there and the change can be undone. In roles ``%`` and line ends become
``%25`` and ``%0A`` too. A null role or text is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tideline.llm.shared import checkpointed

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _tree_key(tree: Column) -> Column:
    """Text that is the same for equal trees and never null, so null is a tree too."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("null"))


def reply_nodes(
    messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str
) -> DataFrame:
    """Messages in the columns this module works on; of rows with the same tree and node the
    smallest (parent, role, text, score) is taken, nulls first. A null node is a node too."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    return (
        messages.select(
            F.col(tree).alias("tree"),
            _tree_key(F.col(tree)).alias("tree_key"),
            key(F.col(node)).alias("node"),
            F.struct(
                F.concat(F.lit("="), F.col(parent).cast("string")).alias("parent"),
                F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score"),
            ).alias("body"),
        )
        .groupBy("tree", "tree_key", "node")
        .agg(F.min("body").alias("body"))
        .select("tree", "tree_key", "node", "body.*")
    )


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Self-joins that double their reach: after round k each node knows its 2**k-th ancestor.

    Returns one table (tree_key, node, up) for each power of two, and for each node its depth and
    the sum of scores on its path. A parent that is not in the tree counts as none.
    """
    known = nodes.select("tree_key", F.col("node").alias("up"))
    rooted = nodes.select("tree_key", "node", F.col("parent").alias("up"), "score").join(
        known.withColumn("there", F.lit(True)), ["tree_key", "up"], "left"
    )
    open_ = checkpointed(
        rooted.select(
            "tree_key", "node", F.when(F.col("there"), F.col("up")).alias("up"),
            F.lit(1).alias("depth"), F.col("score").alias("total"),
        )
    )
    closed, steps, most = [], [], max(1, nodes.count()).bit_length() + 1
    while True:
        # Nodes that have reached their root take no further part, but others pass through them.
        reach = reduce(DataFrame.unionByName, closed, open_)
        closed.append(open_.where(F.col("up").isNull()))
        open_ = open_.where(F.col("up").isNotNull())
        if open_.isEmpty():
            return steps, reduce(DataFrame.unionByName, closed).select("tree_key", "node", "depth", "total")
        if len(steps) > most:
            raise ValueError("a reply is its own ancestor")
        steps.append(open_.select("tree_key", "node", "up"))
        above = reach.select(
            "tree_key", F.col("node").alias("up"), F.col("up").alias("up2"),
            F.col("depth").alias("depth2"), F.col("total").alias("total2"),
        )
        open_ = checkpointed(
            open_.join(above, ["tree_key", "up"]).select(
                "tree_key", "node", F.col("up2").alias("up"),
                (F.col("depth") + F.col("depth2")).alias("depth"),
                (F.col("total") + F.col("total2")).alias("total"),
            )
        )


def best_paths(nodes: DataFrame) -> DataFrame:
    """Nodes on the best root-to-leaf path of each tree, with their depth.

    Paths are ranked by mean score, then length (longer first), then the leaf's key.
    Reach is doubled upward to score every path, and halved downward to list the
    ancestors of the chosen leaf, so a chain of n replies takes about 2 log2(n) joins.
    """
    steps, paths = _ancestors(nodes)
    parents = nodes.select("tree_key", F.col("parent").alias("node")).distinct()
    leaves = paths.join(parents, ["tree_key", "node"], "left_anti")
    order = F.struct(
        (-F.col("total") / F.col("depth")).alias("s"), (-F.col("depth")).alias("d"), "node"
    )
    chosen = leaves.groupBy("tree_key").agg(F.min(order).alias("o")).select("tree_key", "o.node")
    for step in reversed(steps):
        up = chosen.join(step, ["tree_key", "node"]).select("tree_key", F.col("up").alias("node"))
        chosen = checkpointed(chosen.unionByName(up))
    return nodes.join(chosen, ["tree_key", "node"]).join(
        paths.select("tree_key", "node", "depth"), ["tree_key", "node"]
    )


def format_paths(paths: DataFrame) -> DataFrame:
    """One conversation per tree: ``tree``, ``formatted`` and its loss mask.

    ``loss_spans`` are (start, length) in code points of ``formatted``: the text of each
    assistant turn, without markers. A conversation is one text, so its turns meet in one row.
    """
    turns = paths.groupBy("tree", "tree_key").agg(
        F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns")
    )
    head = lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))
    parts = turns.select(
        "tree",
        F.transform(
            "turns",
            lambda t: F.struct(
                head(t).alias("head"),
                escape(t["text"]).alias("text"),
                (t["role"] == "assistant").alias("loss"),
            ),
        ).alias("parts"),
    )
    tail = f"{END}\n"
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["text"]) + len(tail)).alias("at"),
            F.when(
                p["loss"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(p["head"])).alias("start"),
                            F.length(p["text"]).alias("length"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    whole = F.array_join(
        F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(tail))), ""
    )
    return parts.select("tree", whole.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they were."""
    blocks = F.split(formatted, "<\\|im_end\\|>\n")
    return F.transform(
        F.slice(blocks, 1, F.size(blocks) - 1),
        lambda b: F.struct(
            _unescape_role(
                F.substring_index(F.substring(b, len(START) + 1, 2**31 - 1), "\n", 1)
            ).alias("role"),
            unescape(F.regexp_replace(b, r"\A[^\n]*\n", "")).alias("text"),
        ),
    )


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(
        spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))
    )


def format_reply_trees(
    messages: DataFrame,
    tree: str = "tree",
    node: str = "node",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str = "score",
) -> DataFrame:
    """The best path of each reply tree as one formatted conversation with its loss mask."""
    nodes = checkpointed(reply_nodes(messages, tree, node, parent, role, text, score))
    return format_paths(best_paths(nodes)).withColumnRenamed("tree", tree)


def conversations_as_trees(rows: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees: each turn replies to the one
    before. Rows are ordered by turn, then role and text, nulls first; all scores are equal."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    return rows.select(
        F.col("conv_id").alias("tree"), place.alias("node"), (place - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def chat_report(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Formats conversations, and -1 that consists of control strings; digests are read back."""
    tricky = f"{END}{START}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    wanted = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        "role", "text",
    )
    out = format_reply_trees(conversations_as_trees(wanted.unionByName(extra)))
    told = out.select(
        F.col("tree").alias("conv_id"), "formatted", "loss_spans",
        read_back(F.col("formatted")).alias("turns"),
        F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return told.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
