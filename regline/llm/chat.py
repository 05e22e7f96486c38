"""Chat formatting from reply trees. DataFrame/SQL only.

Messages point at the message they answer. Iterative self-joins that double
the distance climbed enumerate every root-to-leaf path in a number of rounds
logarithmic in the depth; paths are ranked by the sum of their messages'
scores, and each chosen path is formatted as one conversation.

Template: every turn is ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line
feed. In roles and texts a backslash is doubled, and a backslash is put after
the first character of every control string, so none of them remains; taking
away each backslash that precedes a character restores the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regline.llm.common import text_or_empty, written

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURN_END = END + "\n"
#: Strings that no formatted role or text may contain.
CONTROL = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def as_trees(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as trees without branches: ``tree, node, parent, role, text, score``.

    Rows are taken by turn (null first), then role and text; each answers the
    one before it. Null roles and texts count as empty.
    """
    rows = turns.select(
        F.col(conv).alias("tree"),
        F.col(turn).alias("turn"),
        text_or_empty(F.col(role)).alias("role"),
        text_or_empty(F.col(text)).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("bigint")
    return rows.withColumn("node", place).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def paths(nodes: DataFrame) -> DataFrame:
    """``tree, node, parent`` -> ``tree, leaf, node, up``: every node of every root-to-leaf path, ``up`` steps above the leaf.

    A node whose parent is null, itself or unknown is a root. Nodes on a cycle
    raise an error once the steps climbed exceed the number of nodes.
    """
    known = nodes.select(F.col("tree").alias("k_tree"), F.col("node").alias("k_node"))
    climbs = nodes.where("parent <> node").select("tree", "node", F.col("parent").alias("to"))
    climbs = written(climbs.join(known, _same("tree", "k_tree") & (F.col("to") == F.col("k_node")), "left_semi"), "climbs")
    answered = climbs.select(F.col("tree").alias("a_tree"), F.col("to").alias("a_node")).distinct()
    leaves = nodes.join(answered, _same("tree", "a_tree") & (F.col("node") == F.col("a_node")), "left_anti")
    found = [written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up")), "leaves")]
    steps, count = 1, nodes.count()
    while not climbs.isEmpty():
        if steps > count:
            raise ValueError("messages answer each other in a circle")
        # ``climbs`` leads ``steps`` up; ``found`` has every node less than ``steps`` up.
        hop = climbs.withColumnsRenamed({"tree": "h_tree", "node": "h_node"})
        met = _same("tree", "h_tree") & (F.col("node") == F.col("h_node"))
        higher = [
            part.join(hop, met).select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + steps).alias("up")) for part in found
        ]
        found.append(written(_union(higher), "paths"))
        again = hop.withColumnRenamed("to", "h_to")
        climbs = written(
            climbs.join(again, _same("tree", "h_tree") & (F.col("to") == F.col("h_node"))).select("tree", "node", F.col("h_to").alias("to")),
            "climbs",
        )
        steps *= 2
    return _union(found)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def format_trees(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The best ``branches`` root-to-leaf paths of each tree, one row each:
    ``tree, leaf, rank, n_turns, formatted, loss``.

    ``nodes`` has ``tree, node, parent, role, text, score``. Paths are ranked by
    the sum of scores (null counts as 0), then the smaller leaf. ``loss`` lists
    the spans of ``formatted``, in code points from 0, that hold the texts of
    the assistant's turns. Null roles and texts count as empty; of rows with
    the same tree and node the first by parent, role, text and score counts;
    null nodes are left out. A null tree is a tree of its own. No nodes give
    no rows.
    """
    cleaned = nodes.where(F.col("node").isNotNull()).select(
        "tree",
        "node",
        F.struct(
            "parent",
            text_or_empty(F.col("role")).alias("role"),
            text_or_empty(F.col("text")).alias("text"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        ).alias("message"),
    )
    nodes = written(
        cleaned.groupBy("tree", "node").agg(F.min("message").alias("message")).select("tree", "node", "message.*"), "messages"
    )
    steps = paths(nodes.select("tree", "node", "parent"))
    scores = nodes.select(F.col("tree").alias("s_tree"), F.col("node").alias("s_node"), "score")
    scored = steps.join(scores, _same("tree", "s_tree") & (F.col("node") == F.col("s_node")))
    totals = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf"))
    chosen = written(
        totals.withColumn("rank", rank)
        .where(F.col("rank") <= branches)
        .select(F.col("tree").alias("c_tree"), F.col("leaf").alias("c_leaf"), "rank"),
        "chosen",
    )
    wanted = steps.join(chosen, _same("tree", "c_tree") & (F.col("leaf") == F.col("c_leaf"))).select("tree", "leaf", "rank", "node", "up")
    messages = nodes.select(
        F.col("tree").alias("m_tree"),
        F.col("node").alias("m_node"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
        F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR)).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    turns = wanted.join(messages, _same("tree", "m_tree") & (F.col("node") == F.col("m_node")))
    length = F.length("head") + F.length("body") + len(TURN_END)
    before = F.sum(length).over(
        Window.partitionBy("tree", "leaf").orderBy(F.col("up").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    span = F.struct(
        (F.coalesce(before, F.lit(0)) + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length")
    )
    placed = turns.withColumn("span", span).select(
        "tree",
        "leaf",
        "rank",
        F.struct(
            (-F.col("up")).alias("place"),
            F.concat("head", "body", F.lit(TURN_END)).alias("turn"),
            F.when(F.col("trained"), F.col("span")).alias("span"),
        ).alias("part"),
    )
    whole = placed.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return whole.select(
        "tree",
        "leaf",
        "rank",
        F.size("parts").cast("bigint").alias("n_turns"),
        F.array_join("parts.turn", "").alias("formatted"),
        F.filter("parts.span", lambda s: s.isNotNull()).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``role, text``, unescaped."""
    ended = F.split(formatted, "<\\|im_end\\|>\n")
    parts = F.slice(ended, 1, F.size(ended) - 1)

    def turn(part: Column) -> Column:
        cut = F.split(F.substr(part, F.lit(len(START) + 1)), "<\\|im_sep\\|>")
        return F.struct(unescape(F.element_at(cut, 1)).alias("role"), unescape(F.element_at(cut, 2)).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    pieces = F.transform(
        loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(pieces, "")
