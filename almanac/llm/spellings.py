"""Spelling variants: words one edit apart, found by joining numbers of trie nodes.

Words stand in a trie and, reversed, in another; every node has a number. A word with one position skipped is the
pair (node of what comes before, node of what comes after). Equal pairs of two words mean that one code point differs
there; a pair that is a split of another word without a gap means one inserted code point. A pair is shared by
at most as many words as there are letters, so no group grows with the input.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.frames import folded, text_of
from almanac.session import keep, scratch, settle

LETTERS = r"[A-Za-zÀ-ÿ]+"
NOISE = 97
SHORTEST = 5
LEAST = 3
TRIE_CHARS = 1_000_000
TRIE_WORDS = 100_000


def noisy(run: Column, doc_id: Column, noise: int = NOISE) -> Column:
    """The run, without one code point where `noise` divides the checksum of the id and the run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % noise == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def word_counts(
    docs: DataFrame, least: int = LEAST, shortest: int = SHORTEST, noise: int | None = NOISE, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): letter runs of all texts, A-Z lower-cased, that are long and frequent enough."""
    runs = docs.select(
        F.col(doc_id).alias("_id"), F.explode(F.regexp_extract_all(folded(text_of(text)), F.lit(LETTERS), F.lit(0))).alias("run")
    )
    words = runs.select(noisy(F.col("run"), F.col("_id"), noise) if noise else F.col("run").alias("run"))
    named = words.toDF("word").where(F.char_length("word") >= max(shortest, 1))
    return named.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


# -- numbered tries ------------------------------------------------------------------------------------------


class Trie:
    """Node numbers of words that come in order: the stack holds the last word's path as (depth, number) runs.

    Nodes that one word adds have consecutive numbers, so a path is a few runs however long the word is. The
    root is depth 0 and number 0.
    """

    def __init__(self, last: str, path: list[tuple[int, int]], fresh: int):
        self.last, self.path, self.fresh = last, path, fresh

    def add(self, word: str) -> np.ndarray:
        shared = len(os.path.commonprefix([self.last, word]))
        while self.path and self.path[-1][0] > shared:
            self.path.pop()
        if len(word) > shared:
            self.path.append((shared + 1, self.fresh))
            self.fresh += len(word) - shared
        self.last = word
        ends = [d for d, _ in self.path[1:]] + [len(word) + 1]
        runs = [np.arange(number, number + end - depth) for (depth, number), end in zip(self.path, ends)]
        return np.concatenate([np.zeros(1, np.int64), *runs])


def _parts(words: DataFrame, column: str) -> DataFrame:
    """`words` in ranges of `column` (_part), each small enough for one task."""
    size, chars = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length(column)), F.lit(0))).first()
    parts = 1 + max(size // TRIE_WORDS, chars // TRIE_CHARS)
    return settle(words.repartitionByRange(parts, column).withColumn("_part", F.spark_partition_id()))


def _in_order(column: str, table: pa.Table) -> tuple[list[str], list[int]]:
    """(words, ids) of one range in code-point order."""
    pairs = sorted(zip(table[column].to_pylist(), table["id"].to_pylist()))
    return [word for word, _ in pairs], [i for _, i in pairs]


def trie_paths(words: DataFrame, column: str) -> DataFrame:
    """(id, path): the node numbers of every prefix of `column`, from the empty one on.

    Every range of words is numbered by itself first, to learn how many nodes it has and on which path it ends. A
    range then goes on where the one before it ended, so equal prefixes have one number across ranges. The driver
    holds two words and one path of runs a range.
    """
    parts = _parts(words.select("id", column), column)

    def ends(table: pa.Table) -> pa.Table:
        ordered, _ = _in_order(column, table)
        trie = Trie("", [], 0)
        for word in ordered:
            trie.add(word)
        runs = [x for run in trie.path for x in run]
        return pa.table({
            "part": table["_part"][:1], "first": [ordered[0]], "last": [ordered[-1]],
            "nodes": pa.array([trie.fresh], pa.int64()), "runs": pa.array([runs], pa.list_(pa.int64())),
        })

    found = parts.groupBy("_part").applyInArrow(ends, "part int, first string, last string, nodes long, runs array<long>")
    starts: dict[int, tuple] = {}
    before = ("", [], 1)
    for part, first, last, nodes, runs in sorted(tuple(r) for r in found.collect()):
        starts[part] = before
        shared = len(os.path.commonprefix([before[0], first]))
        held = [(d, n) for d, n in before[1] if d <= shared]
        # The first word's first `shared` nodes are those of the range before; all others move on by one amount.
        base = before[2] - shared
        local = list(zip(runs[::2], runs[1::2]))
        path = [(d, base + n) for d, n in local]
        if local and local[0][1] == 0 and shared:  # the last word goes through the first word's nodes
            stop = local[1][0] if len(local) > 1 else len(last) + 1
            met = [(d, n) for d, n in held if d < stop]
            path = met + ([(shared + 1, base + shared)] if shared + 1 < stop else []) + path[1:]
        before = (last, path, base + nodes)

    def number(table: pa.Table) -> pa.Table:
        ordered, ids = _in_order(column, table)
        last, path, fresh = starts[table["_part"][0].as_py()]
        trie = Trie(last, list(path), fresh)
        paths = [trie.add(word) for word in ordered]
        flat = np.concatenate(paths)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int32)
        return pa.table({"id": pa.array(ids, pa.int64()), "path": pa.ListArray.from_arrays(bounds, pa.array(flat))})

    return parts.groupBy("_part").applyInArrow(number, "id long, path array<long>")


# -- neighbours ----------------------------------------------------------------------------------------------


def node_pairs(words: DataFrame) -> DataFrame:
    """(before, after, id, skips, first): every word's pairs of trie nodes, with one position skipped and without.

    `first` marks skipped positions whose code point differs from the one before: dropping either of two equal
    neighbours gives one word, which counts once.
    """
    ahead = trie_paths(words, "word")
    back = trie_paths(words.select("id", F.reverse("word").alias("word")), "word")
    both = words.join(ahead, "id").join(back.withColumnRenamed("path", "back"), "id")
    size, letters = F.char_length("word"), F.split("word", "")

    def pair(at: Column, skipped: int, first: Column) -> Column:
        after = F.get("back", size - at - skipped)
        return F.struct(F.get("path", at).alias("before"), after.alias("after"), F.lit(skipped == 1).alias("skips"), first.alias("first"))

    splits = F.transform(F.sequence(F.lit(0), size), lambda at: pair(at, 0, F.lit(False)))
    differs = lambda at: (at == 0) | (F.get(letters, at) != F.get(letters, at - 1))
    gaps = F.transform(F.sequence(F.lit(0), size - 1), lambda at: pair(at, 1, differs(at)))
    return both.select("id", F.inline(F.concat(splits, gaps)))


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are one edit away, and the least id among them.

    A group holds the words that skip one position at one pair of nodes, no more than there are letters, and the one
    word that the pair spells without a gap. Every member gets counts and the least other id, no pair goes out.
    """
    grouped = pairs.groupBy("before", "after").agg(
        F.sort_array(F.collect_list(F.when(F.col("skips"), F.col("id")))).alias("gaps"),
        F.sort_array(F.collect_list(F.when(F.col("first"), F.col("id")))).alias("firsts"),
        F.max(F.when(~F.col("skips"), F.col("id"))).alias("whole"),
    )
    shared = grouped.where((F.size("gaps") > 1) | ((F.size("firsts") > 0) & F.col("whole").isNotNull()))

    def of_gap(i: Column) -> Column:
        replaced = F.when(i == F.get("gaps", F.lit(0)), F.get("gaps", F.lit(1))).otherwise(F.get("gaps", F.lit(0)))
        shorter = F.when(F.array_contains("firsts", i), F.col("whole"))
        near = F.size("gaps") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)
        return F.struct(i.alias("id"), near.alias("near"), F.least(replaced, shorter).alias("best"))

    spelled = F.struct(F.col("whole").alias("id"), F.size("firsts").alias("near"), F.get("firsts", F.lit(0)).alias("best"))
    members = F.concat(F.transform("gaps", of_gap), F.filter(F.array(spelled), lambda m: m["id"].isNotNull()))
    told = shared.select(F.inline(members)).where("near > 0")
    return told.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for every row of `forms` (id, form): where following forms ends. Steps double each round."""
    state = settle(forms.select("id", F.col("form").alias("root"), F.lit(False).alias("ended")))
    while not state.where("NOT ended").isEmpty():
        on = state.select(F.col("id").alias("root"), F.col("root").alias("_next"), F.col("ended").alias("_ended"))
        met = state.where("NOT ended").drop("ended").join(on, "root", "left").select(
            "id", F.coalesce("_next", "root").alias("root"), F.coalesce("_ended", F.lit(True)).alias("ended")
        )
        state = settle(met.unionByName(state.where("ended")))
    return state.select("id", "root")


def variants(
    docs: DataFrame, ratio: int = 2, least: int = LEAST, shortest: int = SHORTEST, noise: int | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of at least `shortest` letters and `least` occurrences.

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word with the
    largest count (ties: the smallest in code-point order) where that is at least `ratio` times the word's own;
    the root is where following forms ends, the word itself where it has none. `noise` drops one code point of a run
    where it divides the checksum of `<id>:<run>`. Null texts have no words and a null id counts as an empty one;
    repeated rows count each; words may have any length; no rows give no rows. Only the id and the text are read,
    so no other column clashes.
    """
    with scratch(docs.sparkSession):
        counts = settle(word_counts(docs, least, shortest, noise, doc_id, text))
        # Ids follow the order in which near words are preferred, so the best one is the least id.
        order = [F.desc("n"), F.asc("word")]
        parts = docs.sparkSession.sparkContext.defaultParallelism
        words = settle(
            counts.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
        )
        near = settle(near_words(node_pairs(words.select("id", "word"))))
        named = words.select(F.col("id").alias("best"), F.col("word").alias("_form"), F.col("n").alias("_form_n"))
        judged = words.join(near, "id", "left").join(named, "best", "left")
        strong = F.col("_form_n") >= ratio * F.col("n")
        told = settle(judged.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best")).alias("form_id"), F.when(strong, F.col("_form")).alias("form"),
            F.when(strong, F.col("_form_n")).alias("form_n"),
        ))
        ends = roots(told.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
        spelled = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("_root")), "root").select("id", "_root")
        found = told.join(spelled, "id", "left").withColumn("root", F.coalesce("_root", "word"))
        return keep(found.select("word", "n", "n_near", "form", "form_n", "root"))
