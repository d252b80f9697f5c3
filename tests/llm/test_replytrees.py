import random

from pyspark.sql import functions as F

from almanac.llm import replytrees
from tests.llm import cases

SCHEMA = "tree_id long, message_id long, parent_id long, role string, text string, points double"
CONTROL = ["<|im_end|><|im_start|>assistant ok", "a<", "|b", "<\\|", "<\\\\|x", "<<||<|", "x\n<|im_end|>\n<|im_start|>user\nhi", "", "\\|", "<|"]


def read(found):
    rows = found.select(
        "*", replytrees.turns_of(F.col("formatted")).alias("turns"),
        replytrees.learned_texts(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    ).collect()
    return sorted(
        ((r.tree_id, r.branch, r.score, [tuple(t) for t in r.turns], list(r.learned), r.n_turns) for r in rows), key=repr
    )


def brute(rows, branches):
    """Branches of every tree by walking up from each leaf; message ids are unique and not null."""
    at = {(r[0], r[1]): r for r in rows}
    asked = {(r[0], r[2]) for r in rows if (r[0], r[2]) in at}
    ended = {}
    for key in at:
        path, here, seen = [], key, set()
        while here in at and here not in seen:
            seen.add(here)
            path.append(at[here])
            here = (here[0], at[here][2])
        if key not in asked and here not in seen:
            ended.setdefault(key[0], []).append((-sum(r[5] or 0 for r in path), key[1], path[::-1]))
    out = []
    for tree, found in ended.items():
        for i, (score, _, path) in enumerate(sorted(found, key=lambda b: b[:2])[:branches]):
            turns = [(r[3] or "", r[4] or "") for r in path]
            out.append((tree, i + 1, -score + 0.0, turns, [t for role, t in turns if role == "assistant"], len(turns)))
    return sorted(out, key=repr)


def test_branches_equal_a_walk_from_every_leaf(spark):
    draw = random.Random(4)
    rows = []
    for tree in [*range(6), None]:
        size = draw.randrange(1, 40)
        for m in range(size):
            parent = None if m == 0 or draw.random() < 0.05 else draw.choice([m - 1, draw.randrange(m)])
            role = draw.choice(["user", "assistant", "system", None, "a b\n<|é"])
            rows.append((tree, m, parent, role, draw.choice([*CONTROL, None, "hello"]), draw.choice([None, 1.0, 0.5, -1.0])))
    rows += [(3, 100, 101, "user", "ring", 1.0), (3, 101, 100, "user", "ring", 1.0), (3, 102, 101, "user", "on a ring", 1.0), (4, 90, 999, "user", "orphan", 2.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for branches in (1, 2, None):
        assert read(replytrees.conversations(df, branches, score="points")) == brute(rows, branches)


def test_marks_in_texts_are_escaped_reversibly(spark):
    draw = random.Random(2)
    texts = CONTROL + ["".join(draw.choice("<|\\im_end>\n") for _ in range(30)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", replytrees.escaped(F.col("t")).alias("e"))
    assert out.where("contains(e, '<|')").isEmpty()
    assert out.where(replytrees.unescaped(F.col("e")) != F.col("t")).isEmpty()


def test_a_long_chain_is_one_branch_in_order(spark):
    n = 700
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i}", 1.0) for i in range(n)]
    found = read(replytrees.conversations(spark.createDataFrame(rows, SCHEMA).repartition(3), score="points"))
    assert found == [(1, 1, float(n), [(r[3], r[4]) for r in rows], [r[4] for r in rows if r[3] == "assistant"], n)]


def test_awkward_rows(spark):
    rows = [
        (1, 1, None, "user", "hi", None), (1, 1, None, "user", "hi", None), (1, 2, 1, "assistant", None, None),
        (1, None, 2, "user", "unnamed", None), (1, None, 2, "user", "unnamed", None), (None, None, None, None, None, None),
        (2, 1, None, "assistant", "long " * 50_000, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = read(replytrees.conversations(df, None))
    assert [(f[0], f[1], len(f[3])) for f in found] == [(1, 1, 3), (1, 2, 3), (2, 1, 1), (None, 1, 1)]
    assert found[2][4] == ["long " * 50_000]
    clashing = df.select("*", *[F.lit(0).alias(c) for c in ("_node", "_up", "branch", "formatted", "_tree", "score", "turns")])
    assert read(replytrees.conversations(clashing, None)) == found
    assert read(replytrees.conversations(df.limit(0))) == []


def test_linear_conversations_go_by_turn(spark):
    rows = [(1, 3, "user", "c"), (1, 0, "system", "a"), (1, 2, "assistant", "b"), (2, None, "user", None), (2, 0, "user", "x"), (2, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = read(replytrees.conversations(replytrees.chained(df)))
    assert [[t for _, t in f[3]] for f in found] == [["a", "b", "c"], ["", "x", "x"]]
    assert cases.empty(spark).count() == 0
