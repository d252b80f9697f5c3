"""Exact n-gram Jaccard join by a token-group matrix.

Similar documents form groups. The matrix says which tokens occur in a group's token union. A document
opens a group only if enough of its own tokens are in that union to reach the threshold with any member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.components import components
from almanac.llm.frames import few, most_frequent, text_of, texts_to_python
from almanac.llm.words import find_words, mix, release, runs_hash, text_blocks
from almanac.operators.naming import unused
from almanac.session import keep, scratch, settle

PERCENT = 85
SIZE = 4
GROUPINGS = 4
FREQUENT = 64
MOST_FREQUENT = 1_000_000
ORDER_SHARE = 64
EXTRA = 12
ORDER_ROUNDS = 2
MEMBERS = 128
ASKING = 512
SHARD_ROWS = 1_000
_SEEDS = mix(np.arange(101, 101 + GROUPINGS, dtype=np.uint64))


def needed(n: int, percent: int) -> int:
    """Tokens that a set of n must share with another to reach the threshold."""
    return (percent * n + 99) // 100


def first_count(n: int, percent: int) -> int:
    """How many first tokens of a set of n are compared: one that must be shared, and up to EXTRA more."""
    spare = n - needed(n, percent)
    return min(n, spare + 1 + min(spare, EXTRA))


def agreeing(n: Column, percent: int) -> Column:
    """First tokens that a set of n shares with any set it reaches the threshold with.

    The other has at least needed(n) tokens, and the smaller of two sets says how many extra ones count.
    """
    least = F.floor((n * percent + 99) / 100)
    return 1 + F.least(F.lit(EXTRA), least - F.floor((least * percent + 99) / 100))


def _lists(values: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def _block_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes; fewer words than a shingle are one token, no words none."""
    found = find_words(data, offsets)
    runs = runs_hash(found.hashes, size)
    out = []
    for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        tokens = np.sort(runs[a : b - size + 1]) if b - a >= size else runs_hash(found.hashes[a:b], b - a) if b > a else runs[:0]
        out.append(tokens[np.r_[True, tokens[1:] != tokens[:-1]]] if len(tokens) > 1 else tokens)
    return out


def _reduced(how: np.ufunc, values: np.ndarray, starts: np.ndarray, full: np.ndarray) -> np.ndarray:
    out = np.zeros(len(full), dtype=np.uint64)
    if full.any():
        out[full] = how.reduceat(values, starts[full])
    return out


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    starts, full = np.cumsum(sizes) - sizes, sizes > 0
    pair = (_reduced(np.add, mix(v), starts, full) for v in (flat, flat ^ _SEEDS[0]))
    return tuple(x.view(np.int64) for x in pair)


def _is_frequent(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), dtype=bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def _first_tokens(sets: list[np.ndarray], frequent: np.ndarray, percent: int) -> list[np.ndarray]:
    """The first tokens of every set, frequent tokens last."""
    common = _is_frequent(np.concatenate(sets) if sets else np.empty(0, np.uint64), frequent)
    out, at = [], 0
    for tokens in sets:
        n = len(tokens)
        mine = common[at : at + n]
        at += n
        if mine.any():
            tokens = np.concatenate([tokens[~mine], tokens[mine]])
        out.append(tokens[: first_count(n, percent)])
    return out


def usual_tokens(docs: DataFrame, doc_id: str, size: int) -> np.ndarray:
    """Tokens that occur twice in one of ORDER_SHARE documents: those to put last in the order of tokens.

    Any order finds the same pairs; this one keeps tokens of widespread passages out of the candidates.
    """
    part = texts_to_python(docs).where(F.pmod(F.xxhash64(F.col(doc_id)), F.lit(ORDER_SHARE)) == 0).select(text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                sets = _block_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["token"])

    counts = part.mapInArrow(run, "token long").groupBy("token").count().where("count > 1")
    return _collected(counts)


def _collected(counts: DataFrame) -> np.ndarray:
    """At most MOST_FREQUENT tokens, the most frequent ones, sorted."""
    found = most_frequent(settle(counts), "count", MOST_FREQUENT).select("token").toArrow()["token"].to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def describe(docs: DataFrame, doc_id: str, size: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(doc, n, s1, s2, mins, prefix): per row its set's size and signature, minima, and first tokens."""
    read = docs.select(F.col(doc_id).alias("doc"), text_of().alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = T.StructType([
        T.StructField("doc", read.schema["doc"].dataType), T.StructField("n", T.LongType()),
        T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
        T.StructField("mins", T.ArrayType(T.LongType())), T.StructField("prefix", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_blocks(batch.column(1)):
                sets = _block_sets(data, offsets, size)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                flat, starts, full = np.concatenate(sets), np.cumsum(sizes) - sizes, sizes > 0
                ways = np.stack([_reduced(np.minimum, mix(flat ^ s), starts, full) for s in _SEEDS], 1)
                mins = pa.ListArray.from_arrays(pa.array(np.arange(to - at + 1, dtype=np.int32) * GROUPINGS), pa.array(ways.ravel().view(np.int64)))
                marks = (pa.array(x) for x in _signatures(sets))
                firsts = _lists(_first_tokens(sets, sent.value, percent))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(sizes), *marks, mins, firsts], schema.names)

    return read.mapInArrow(run, schema)


def whole_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, size: int) -> DataFrame:
    """(node, n, tokens) for the given nodes (doc, node, s1, s2), read again from their texts."""
    read = docs.select(F.col(doc_id).alias("doc"), text_of().alias("text")).join(few(nodes.select("doc", "node", "s1", "s2")), "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_blocks(batch.column(1)):
                sets = _block_sets(data, offsets, size)
                one, two = _signatures(sets)
                given = (batch.column(i).slice(at, to - at).to_numpy(zero_copy_only=False) for i in (2, 3))
                own = np.logical_and.reduce([a == b for a, b in zip((one, two), given)])  # rows of one id may differ in text
                kept = [s for s, is_own in zip(sets, own) if is_own]
                nodes = batch.column(0).slice(at, to - at).filter(pa.array(own))
                yield pa.RecordBatch.from_arrays([nodes, pa.array([len(s) for s in kept], pa.int64()), _lists(kept)], ["node", "n", "tokens"])

    found = settle(read.select("node", "text", "s1", "s2").mapInArrow(run, "node long, n long, tokens array<long>"))
    if found.count() != found.select("node").distinct().count():  # equal rows of one id
        found = settle(found.dropDuplicates(["node"]))
    return found


def prefixes(sets: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """(node, n, token): the first tokens of every set, frequent tokens last."""
    sent = sets.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            names, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            firsts = _first_tokens(np.split(flat, np.cumsum(sizes)[:-1]), sent.value, percent) if len(names) else []
            counts = [len(f) for f in firsts]
            rows = np.concatenate(firsts).view(np.int64) if firsts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(names, counts)), pa.array(np.repeat(sizes, counts)), pa.array(rows)], ["node", "n", "token"]
            )

    return sets.mapInArrow(run, "node long, n long, token long")


def reaching(asking: list[np.ndarray], held: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Places (i, j) of the sets asking[i] and held[j] that reach the threshold."""
    sizes = np.array([len(h) for h in held], dtype=np.int64)
    flat, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
    out = []
    for i, tokens in enumerate(asking):
        shared = np.bincount(owner[_is_frequent(flat, tokens)], minlength=len(held))
        out += [(i, j) for j in np.flatnonzero(shared * 100 >= (len(tokens) + sizes - shared) * percent).tolist()]
    return out


def opened_links(asks: DataFrame, held: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the nodes that ask for a group, `asks` (a, key), and its members, `held` (b, key).

    A group's members meet its asking nodes in shares of about ASKING, so a group that very many ask for is
    opened by many tasks; whole sets are compared there, and no pair of rows is made that does not link.
    """
    shares = settle(asks.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / ASKING).alias("shares")))
    asked = asks.join(few(shares), "key").select(
        F.col("a").alias("node"), "key", F.pmod(F.xxhash64("a"), F.col("shares")).alias("share"), F.lit(True).alias("asks")
    )
    opened = held.join(few(shares), "key").select(
        F.col("b").alias("node"), "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(False).alias("asks")
    )
    rows = settle(asked.unionByName(opened))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    placed = few(rows).join(sets.drop("n"), "node").withColumn("shard", F.pmod(F.xxhash64("key", "share"), F.lit(shards)))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        release()
        a, b = [], []
        for _, group in part.groupby(["key", "share"], sort=False):
            sides = [group[group["asks"] == side] for side in (True, False)]
            if len(sides[0]) and len(sides[1]):
                tokens = [[t.view(np.uint64) for t in side["tokens"]] for side in sides]
                nodes = [side["node"].to_numpy() for side in sides]
                for i, j in reaching(*tokens, percent):
                    if nodes[0][i] != nodes[1][j]:
                        a.append(nodes[0][i])
                        b.append(nodes[1][j])
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return placed.groupBy("shard").applyInPandas(lambda part: search(part), "a long, b long")


def links(
    docs: DataFrame, nodes: DataFrame, doc_id: str, size: int, percent: int, frequent: np.ndarray
) -> tuple[DataFrame, DataFrame]:
    """((node, root) of groups, links between nodes of different groups).

    Groups are found first: nodes that agree in one of a few minima are compared with the smallest of them,
    and verified links join them. All remaining links then run between groups.
    """
    rows = nodes.select("node", "n", F.explode("prefix").alias("token"))
    shared = settle(rows.groupBy("token").count().where("count > 1").select("token"))
    chosen = settle(_agreeing_nodes(settle(rows.join(shared, "token", "left_semi")), percent))
    sets = whole_sets(docs, settle(nodes.select("doc", "node", "s1", "s2").join(few(chosen), "node")), doc_id, size)

    minima = nodes.join(few(chosen), "node").select("node", F.posexplode("mins").alias("way", "least"))
    pivots = settle(minima.groupBy("way", "least").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1"))
    star = minima.join(pivots, ["way", "least"]).where("node != b").select(F.col("node").alias("a"), F.col("b").alias("key")).distinct()
    star = settle(star)
    centres = star.select(F.col("key").alias("b"), "key").distinct()
    linked = settle(components(opened_links(star, centres, sets, percent)))

    for _ in range(ORDER_ROUNDS):
        counts = prefixes(sets, frequent, percent).groupBy("token").count().where(F.col("count") > FREQUENT)
        frequent = np.union1d(frequent, _collected(counts))[:MOST_FREQUENT]
    firsts = prefixes(sets, frequent, percent)

    grouped = settle(_groups(minima, linked))
    placed = settle(firsts.join(few(grouped), "node"))
    matrix = placed.select("token", "group", "members").distinct()
    # A token in one group only leads nowhere.
    wide = settle(matrix.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token"))
    matrix = settle(matrix.join(wide, "token", "left_semi").select("token", F.col("group").alias("other"), F.col("members").alias("others")))
    asking = placed.join(wide, "token", "left_semi")
    from_smaller = (F.col("members") < F.col("others")) | ((F.col("members") == F.col("others")) & (F.col("group") < F.col("other")))
    met = asking.join(matrix, "token").where(from_smaller).groupBy("node", "n", "other").agg(F.count(F.lit(1)).alias("k"))
    asks = met.where(F.col("k") >= agreeing(F.col("n"), percent)).select(F.col("node").alias("a"), F.col("other").alias("group"))
    # Linked members need no comparison with each other; those of other groups do.
    inside = grouped.where("members > 1 AND NOT linked").select(F.col("node").alias("a"), "group")
    asks = settle(asks.unionByName(inside))
    # A linked group is opened in parts of about MEMBERS.
    parts = F.ceil(F.col("members") / MEMBERS)
    held = grouped.select(F.col("node").alias("b"), "group", F.pmod(F.xxhash64("node"), parts).alias("part"), parts.alias("parts"))
    every = held.select("group", "parts").distinct()
    asks = asks.join(few(settle(every)), "group").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    ).select("a", F.concat_ws(":", "group", "part").alias("key"))
    held = held.select("b", F.concat_ws(":", "group", "part").alias("key"))
    return linked, settle(opened_links(settle(asks), held, sets, percent))


def _groups(minima: DataFrame, linked: DataFrame) -> DataFrame:
    """(node, group, members, linked): nodes of a linked component, and the rest by one of their minima.

    Each takes the minimum that most nodes share, so nodes that are much alike meet in few groups. A minimum
    that very many share is dealt over groups of about MEMBERS.
    """
    sizes = settle(minima.groupBy("way", "least").agg(F.count(F.lit(1)).alias("k")))
    widest = F.max_by(F.xxhash64("way", "least"), F.struct("k", "way", "least"))
    buckets = minima.join(few(sizes), ["way", "least"]).groupBy("node").agg(widest.alias("least"))
    names = settle(buckets.join(few(linked), "node", "left"))
    rooted = names.join(few(settle(linked.select(F.col("root").alias("node")).distinct().withColumn("heads", F.lit(True)))), "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", F.when(F.col("heads"), F.col("node"))))
    alone = rooted.where("root IS NULL")
    counts = settle(alone.groupBy("least").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("parts")))
    dealt = alone.join(few(counts), "least").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    heads = settle(dealt.groupBy("least", "part").agg(F.min("node").alias("group"), F.count(F.lit(1)).alias("members")))
    one = dealt.join(few(heads), ["least", "part"]).select("node", "group", "members", F.lit(False).alias("linked"))
    sizes = settle(rooted.where("root IS NOT NULL").groupBy("root").agg(F.count(F.lit(1)).alias("members")))
    two = rooted.where("root IS NOT NULL").join(few(sizes), "root").select("node", F.col("root").alias("group"), "members", F.lit(True).alias("linked"))
    return one.unionByName(two)


def _agreeing_nodes(held: DataFrame, percent: int) -> DataFrame:
    """The nodes of (node, n, token), tokens of several nodes, that hold enough of them to reach any other node.

    Nodes that cannot are left out, and once more with what then remains.
    """
    full = held.groupBy("node", "n").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= agreeing(F.col("n"), percent))
    left = held.join(few(settle(full.select("node"))), "node", "left_semi")
    still = left.groupBy("token").count().where("count > 1").select("token")
    again = left.join(settle(still), "token", "left_semi").groupBy("node", "n").agg(F.count(F.lit(1)).alias("k"))
    return again.where(F.col("k") >= agreeing(F.col("n"), percent)).select("node")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per row of `docs`: its id, n_shingles and component_id, the smallest id that links reach.

    Two texts link when their sets of `size`-word shingles (A-Z lower-cased, words between white space)
    have a Jaccard similarity of `percent` or more. Equal sets are one node. A text of fewer words has one
    token, an empty or null text none, and links with nothing. A null id links with nothing and has a null
    component. Rows with equal ids and different texts are judged one by one. Tokens are 64-bit hashes.
    """
    with scratch(docs.sparkSession):
        return keep(_components(docs, doc_id, size, percent))


def _components(docs: DataFrame, doc_id: str, size: int, percent: int) -> DataFrame:
    frequent = usual_tokens(docs, doc_id, size)
    described = settle(describe(docs, doc_id, size, percent, frequent))
    full = described.where("n > 0 AND doc IS NOT NULL")
    classes = settle(full.groupBy("s1", "s2").agg(F.min("doc").alias("first")))
    first = full.join(classes, (full["s1"] == classes["s1"]) & (full["s2"] == classes["s2"]) & (full["doc"] == classes["first"]), "left_semi")
    nodes = settle(settle(first.dropDuplicates(["s1", "s2"])).withColumn("node", F.monotonically_increasing_id()))
    groups, between = links(docs, nodes, doc_id, size, percent, frequent)
    name = groups.select(F.col("node"), F.col("root"))
    ends = [F.col("a"), F.col("b")]
    joined = between.select(*ends).unionByName(name.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = settle(components(joined)) if not between.isEmpty() else groups
    lone = nodes.select("node", "s1", "s2", "doc").join(few(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    lone = settle(lone)
    lowest = lone.groupBy("root").agg(F.min("doc").alias("component"))
    named = settle(lone.join(lowest, "root").select("s1", "s2", "component"))
    found = described.select("doc", "n", "s1", "s2").join(few(named), ["s1", "s2"], "left")
    component = F.when(F.col("doc").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")))
    return found.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that are the first of their component, all columns kept.

    Of several rows with one id one stays. Rows with a null id link with nothing and stay.
    """
    found = near_duplicates(docs, doc_id, size, percent)
    (name,) = unused(docs.columns, "gone")
    gone = settle(found.where(F.col("component_id") != F.col(doc_id)).select(F.col(doc_id).alias(name)).distinct())
    kept = docs.join(few(gone), docs[doc_id] == F.col(name), "left_anti")
    named = docs.where(F.col(doc_id).isNotNull())
    if named.groupBy(doc_id).count().where("count > 1").isEmpty():
        return kept
    once = kept.where(F.col(doc_id).isNotNull()).dropDuplicates([doc_id])
    return once.unionByName(kept.where(F.col(doc_id).isNull()))
