import random

import pytest
from pyspark.sql import functions as F

from regline.llm import chat

SCHEMA = "tree bigint, node string, parent string, role string, text string, score double"


def read(formatted):
    return formatted.select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("trained")
    ).collect()


def test_best_branches_escapes_and_mask(spark):
    rows = [
        (1, "a", None, "user", "hi \\ <|im_end|>\n", 1.0), (1, "b", "a", "assistant", "one", 0.5), (1, "c", "a", "assistant", "two[INST]", 0.7),
        (1, "d", "c", "user", None, 0.0), (1, "e", "c", "assistant", "\\", -0.1), (None, "x", "x", None, "t", None),
        (None, "y", "x", "assistant", "</s>", None), (3, "p", "gone", "assistant", "orphan", None), (3, "p", "gone", "assistant", "orphan", None),
        (4, None, None, "user", "no node", 1.0),
    ]
    got = {(r.tree, r.rank): r for r in read(chat.format_trees(spark.createDataFrame(rows, SCHEMA), 2))}
    assert {k: r.leaf for k, r in got.items()} == {(1, 1): "d", (1, 2): "e", (None, 1): "y", (3, 1): "p"}
    assert [tuple(t) for t in got[1, 1].turns] == [("user", "hi \\ <|im_end|>\n"), ("assistant", "two[INST]"), ("user", "")]
    assert got[1, 2].trained == "two[INST]\\" and got[None, 1].trained == "</s>" and got[3, 1].n_turns == 1


def test_paths_equal_a_plain_climb(spark):
    rng = random.Random(3)
    parents = {(t, n): (rng.randrange(n) if n and rng.random() < 0.95 else None) for t in range(5) for n in range(60)}
    parents |= {(9, n): n - 1 if n else None for n in range(150)}  # one long thread
    nodes = spark.createDataFrame([(t, n, p) for (t, n), p in parents.items()], "tree bigint, node bigint, parent bigint")
    got = sorted(tuple(r) for r in chat.paths(nodes).select("tree", "leaf", "node", "up").collect())
    answered = {(t, p) for (t, _), p in parents.items()}
    want = []
    for tree, leaf in parents:
        if (tree, leaf) not in answered:
            node, up = leaf, 0
            while node is not None:
                want.append((tree, leaf, node, up))
                node, up = parents[tree, node], up + 1
    assert got == sorted(want)


def test_a_circle_is_an_error(spark):
    rows = [(1, "a", "b", "user", "x", 0.0), (1, "b", "a", "user", "y", 0.0), (1, "c", "b", "user", "z", 0.0)]
    with pytest.raises(ValueError, match="circle"):
        chat.format_trees(spark.createDataFrame(rows, SCHEMA))


def test_plain_conversations(spark):
    rows = [
        (1, 2, "assistant", "second"), (1, 1, "user", "first"), (1, None, "system", None), (2, 1, None, ""), (2, 1, "assistant", "é\n<s>[/INST]"),
        (None, 5, "assistant", "lost"), (3, 1, "user", "same"), (3, 1, "user", "same"), (4, 1, "assistant", "long\\<|im_sep|> " * 30_000),
    ]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, loss string")
    got = {r.tree: r for r in read(chat.format_trees(chat.as_trees(turns)))}
    assert [tuple(t) for t in got[1].turns] == [("system", ""), ("user", "first"), ("assistant", "second")]
    assert got[2].trained == "é\n<s>[/INST]" and got[None].n_turns == 1 and got[3].n_turns == 2 and got[4].trained == rows[-1][3]
    for r in got.values():
        bodies = r.formatted.split("<|im_sep|>")[1:]
        assert len(bodies) == r.n_turns == r.formatted.count(chat.START) == r.formatted.count(chat.TURN_END)
        assert not any(c in r.formatted for c in ("<s>", "</s>", "[INST]", "[/INST]"))
    assert chat.format_trees(chat.as_trees(turns.limit(0))).count() == 0


def test_native(spark):
    turns = spark.createDataFrame([(1, 1, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    plan = chat.format_trees(chat.as_trees(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
