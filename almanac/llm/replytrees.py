"""Reply trees: root-to-leaf branches by iterative self-joins, ranked by score, each formatted as one conversation.

Messages find their ancestors by doubling: after round r a message knows its ancestor 2^r steps up and the sums over
those steps, so a tree of any depth takes a logarithmic number of joins. Nothing but built-in functions runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.frames import text_of
from almanac.session import keep, scratch, settle

# The marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    """The text without `<|`: one more backslash between every `<` and `|` that only backslashes part."""
    return F.regexp_replace(text, r"<(\\*)(?=\|)", r"<$1\\")


def unescaped(text: Column) -> Column:
    """The text that `escaped` was given."""
    return F.regexp_replace(text, r"<(\\*)\\(?=\|)", r"<$1")


def _head(role: Column) -> Column:
    # A role is one line without marks; the names in use stay as they are.
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit("\n"))


def messages(
    df: DataFrame, tree: str = "tree_id", message: str = "message_id", parent: str = "parent_id", role: str = "role",
    text: str = "text", score: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, pieces): a narrow row a message, and its formatted parts; both by a number (_node).

    Rows that repeat a message of a tree count once: the one with the least parent, role, score and text digest.
    """
    points = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    named = df.select(
        F.col(tree).alias("_tree"), F.col(message).alias("_message"), F.col(parent).alias("_parent"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("_role"), text_of(text).alias("_text"), points.alias("_score"),
    )
    pieces = settle(
        named.withColumns({"_head": _head(F.col("_role")), "_body": escaped(F.col("_text")), "_digest": F.md5("_text")})
        .withColumn("_bytes", F.octet_length(F.concat("_head", "_body")) + len(CLOSE) + 1)
        .withColumn("_node", F.monotonically_increasing_id())
        .drop("_text")
    )
    unnamed = F.when(F.col("_message").isNull(), F.col("_node"))  # each stands for itself
    same = Window.partitionBy("_tree", "_message", unnamed).orderBy("_parent", "_role", "_score", "_digest", "_node")
    firsts = pieces.drop("_head", "_body").withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return settle(firsts.select("_node", "_tree", "_message", "_parent", "_score", "_bytes")), pieces


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of (_node, _up, _depth, _total, _before): the ancestor 2^r steps up and sums over the steps so far.

    `_up` is null once the root is passed; then `_depth`, `_total` (scores, its own included) and `_before` (bytes
    of the pieces above) are final. Messages whose parents form a ring never pass a root; the rounds end
    when a whole doubling brings no more of them to a root and no step is new.
    """
    keys = nodes.where("_message IS NOT NULL").select(
        F.col("_tree").alias("_t"), F.col("_message").alias("_m"), F.col("_node").alias("_up"), F.col("_bytes").alias("_above")
    )
    met = nodes.join(keys, F.col("_tree").eqNullSafe(F.col("_t")) & (F.col("_parent") == F.col("_m")), "left")
    state = settle(met.select(
        "_node", "_up", F.when(F.col("_up").isNull(), 0).otherwise(1).cast("long").alias("_depth"),
        F.col("_score").alias("_total"), F.coalesce("_above", F.lit(0)).cast("long").alias("_before"),
    ))
    rounds, most = [state], nodes.count()
    while 1 << (len(rounds) - 1) <= most and not state.where("_up IS NOT NULL").isEmpty():
        far = state.select(*[F.col(c).alias(f"{c}2") for c in state.columns])
        open_ = state.where("_up IS NOT NULL").join(far, F.col("_up") == F.col("_node2")).select(
            "_node", F.col("_up2").alias("_up"), (F.col("_depth") + F.col("_depth2")).alias("_depth"),
            (F.col("_total") + F.col("_total2")).alias("_total"), (F.col("_before") + F.col("_before2")).alias("_before"),
        )
        state = settle(open_.unionByName(state.where("_up IS NULL")))
        rounds.append(state)
    return rounds


def format_branches(nodes: DataFrame, pieces: DataFrame, branches: int | None = 1) -> DataFrame:
    """(_tree, branch, score, n_turns, formatted, loss_spans): the best `branches` branches of every tree.

    A branch runs from a root to a message without replies; its score is the sum of its messages' scores, ties go to
    the smaller last message. `branches` None formats every branch. `loss_spans` are (start, size) in UTF-8 bytes
    of the escaped texts of the role `assistant` within `formatted`, in order.
    """
    rounds = ancestors(nodes)
    final = rounds[-1].where("_up IS NULL")
    parents = rounds[0].where("_up IS NOT NULL").select(F.col("_up").alias("_node")).distinct()
    last = final.join(parents, "_node", "left_anti").join(nodes.select("_node", "_tree", "_message"), "_node")
    order = Window.partitionBy("_tree").orderBy(F.desc("_total"), "_message", "_node")
    ranked = last.withColumn("branch", F.row_number().over(order).cast("long"))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= branches)
    chosen = settle(ranked.select(F.col("_node").alias("_leaf"), "_tree", "branch", F.col("_total").alias("score")))
    path = chosen.select("_leaf", F.col("_leaf").alias("_node"))
    # Each self-join doubles the part of every chosen path that is known, from the leaf upwards.
    for state in rounds[:-1]:
        ups = state.where("_up IS NOT NULL").select("_node", "_up")
        path = settle(path.unionByName(path.join(ups, "_node").select("_leaf", F.col("_up").alias("_node"))))
    turn = F.struct(
        F.col("_depth").alias("depth"), F.concat("_head", "_body", F.lit(CLOSE + "\n")).alias("piece"),
        (F.col("_role") == LEARNED).alias("learned"), (F.col("_before") + F.octet_length("_head")).alias("start"),
        F.octet_length("_body").cast("long").alias("size"),
    )
    placed = path.join(pieces.select("_node", "_role", "_head", "_body"), "_node").join(final.select("_node", "_depth", "_before"), "_node")
    gathered = placed.groupBy("_leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    learned = F.filter("turns", lambda t: t["learned"])
    return gathered.join(chosen, "_leaf").select(
        "_tree", "branch", "score", F.size("turns").cast("long").alias("n_turns"),
        F.concat_ws("", F.transform("turns", lambda t: t["piece"])).alias("formatted"),
        F.transform(learned, lambda t: F.struct(t["start"].alias("start"), t["size"].alias("size"))).alias("loss_spans"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    cut = F.split(formatted, r"<\|im_end\|>\n")
    kept = F.filter(cut, lambda x, i: i < F.size(cut) - 1)

    def read(x: Column) -> Column:
        line = F.substring_index(x, "\n", 1)
        role = F.url_decode(F.substr(line, F.lit(len(OPEN) + 1)))
        return F.struct(role.alias("role"), unescaped(F.substr(x, F.char_length(line) + 2)).alias("text"))

    return F.transform(kept, read)


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, as they were before escaping."""
    raw = formatted.cast("binary")
    return F.transform(
        spans, lambda s: unescaped(F.substr(raw, (s["start"] + 1).cast("int"), s["size"].cast("int")).cast("string"))
    )


def conversations(
    df: DataFrame, branches: int | None = 1, tree: str = "tree_id", message: str = "message_id",
    parent: str = "parent_id", role: str = "role", text: str = "text", score: str | None = None,
) -> DataFrame:
    """(tree, branch, score, n_turns, formatted, loss_spans): the best branches of every reply tree, formatted.

    A message without a parent, or whose parent is not in its tree, is a root; messages whose parents form a ring
    hang from no root and are on no branch. Null scores count 0, null roles and texts are empty; a null message
    id answers but cannot be answered; null tree ids are one tree. Repeated rows count once. A branch is one cell of
    at most 2 GB and raises beyond. No other column is read, so none clashes; no rows give no rows.
    """
    with scratch(df.sparkSession):
        nodes, pieces = messages(df, tree, message, parent, role, text, score)
        found = format_branches(nodes, pieces, branches)
        return keep(found.withColumnRenamed("_tree", tree))


def chained(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(tree_id, message_id, parent_id, role, text): linear conversations as trees, each turn a reply to the one before.

    Turns that tie go by role, then by the text's digest; a null turn comes first.
    """
    order = Window.partitionBy("tree_id").orderBy("_turn", "_role", "_digest")
    named = rows.select(
        F.col(conv).alias("tree_id"), F.col(turn).alias("_turn"), F.col(role).alias("_role"), F.col(text).alias("_text"),
        F.md5(text_of(text)).alias("_digest"),
    )
    placed = named.withColumn("message_id", F.row_number().over(order).cast("long"))
    before = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return placed.select("tree_id", "message_id", before.alias("parent_id"), F.col("_role").alias("role"), F.col("_text").alias("text"))
