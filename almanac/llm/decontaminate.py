"""Benchmark decontamination over a distributed positional inverted index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.frames import few, folded, row_key, text_of
from almanac.operators.naming import unused
from almanac.session import keep, scratch, settle

WINDOW = 13
RAREST = 3
# Fixed value: what stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["_k1", "_k2"]


def words_of(text: Column) -> Column:
    """The words of a text: runs of digits, letters and everything beyond ASCII, A-Z lower-cased."""
    return F.filter(F.split(folded(text), BETWEEN), lambda w: w != "")


@dataclass
class Index:
    """Postings (term, _k1, _k2, pos) of the test terms in the training texts, and the terms' numbers."""

    postings: DataFrame
    terms: DataFrame


def build_index(docs: DataFrame, test_terms: DataFrame) -> Index:
    """Store a posting for every occurrence of a test term in `docs` (_k1, _k2, words).

    `test_terms` has one column, word. Each task writes the postings of its own texts in text order: no
    shuffle, and a text's key costs next to nothing in a column file. A very frequent term is spread over
    all files, so no task ever holds its whole list.
    """
    terms = settle(test_terms.distinct().withColumn("term", F.xxhash64("word")))
    tokens = docs.select(*KEY, F.posexplode("words").alias("pos", "word"))
    return Index(settle(tokens.join(few(terms), "word").select("term", *KEY, "pos")), terms)


def test_windows(items: DataFrame, index: Index) -> tuple[DataFrame, DataFrame]:
    """(item, q, term, size) for all item words, and (term, item, q, need) for the rarest of any window."""
    words = items.select("item", F.size("words").alias("size"), F.posexplode("words").alias("q", "word"))
    placed = settle(words.join(few(index.terms), "word").select("item", "q", "term", "size"))
    counts = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted = placed.join(counts, "term", "left").na.fill(0, ["n"])
    # A word is in the windows that start at most WINDOW - 1 words before it.
    first = F.greatest(F.lit(0), F.col("q") - (WINDOW - 1))
    last = F.least(F.col("q"), F.greatest(F.lit(0), F.col("size") - WINDOW))
    in_window = counted.withColumn("w", F.explode(F.sequence(first, last)))
    rank = F.row_number().over(Window.partitionBy("item", "w").orderBy("n", "term", "q"))
    rare = in_window.withColumn("r", rank).where(F.col("r") <= RAREST)
    return placed, settle(
        rare.select("term", "item", "q", F.least(F.lit(RAREST), F.col("size")).alias("need")).distinct()
    )


def find_phrases(index: Index, items: DataFrame) -> DataFrame:
    """(_k1, _k2, item, first, last): word ranges of texts covered by exact runs of 13 item words.

    An item of fewer words must occur whole. Lists are intersected from the rarest terms: a posting of a
    rare term, moved back by the term's place in the item, names an alignment of item and text; only
    alignments that the rarest terms of a window agree on are compared with the lists of the other terms.
    """
    placed, rare = test_windows(items, index)
    moved = index.postings.join(few(rare), "term").withColumn("shift", F.col("pos") - F.col("q"))
    agreed = settle(
        moved.groupBy(*KEY, "item", "shift").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"))
        .where(F.col("n") >= F.col("need")).select(*KEY, "item", "shift")
    )
    texts = few(settle(agreed.select(*KEY).distinct()))
    lists = index.postings.join(texts, KEY, "left_semi").distinct()
    expected = agreed.join(few(placed), "item").withColumn("pos", F.col("shift") + F.col("q"))
    met = expected.join(lists, [*KEY, "pos", "term"]).select(*KEY, "item", "shift", "q", "size")
    alignment = Window.partitionBy(*KEY, "item", "shift").orderBy("q")
    runs = met.withColumn("run", F.col("q") - F.row_number().over(alignment))
    return (
        runs.groupBy(*KEY, "item", "shift", "run")
        .agg(F.min("q").alias("a"), F.max("q").alias("b"), F.max("size").alias("size"))
        .where(F.col("b") - F.col("a") + 1 >= F.least(F.lit(WINDOW), F.col("size")))
        .select(*KEY, "item", (F.col("shift") + F.col("a")).alias("first"), (F.col("shift") + F.col("b")).alias("last"))
    )


def find_near(index: Index, words: list[str], span: int) -> DataFrame:
    """(_k1, _k2, first): places where `span` consecutive words hold all the given words, in any order."""
    wanted = sorted(set(words))
    lists = index.postings.join(F.broadcast(index.terms.where(F.col("word").isin(wanted))), "term")
    starts = F.sequence(F.greatest(F.lit(0), F.col("pos") - (span - 1)), F.col("pos"))
    held = lists.select(*KEY, "term", F.explode(starts).alias("first")).distinct()
    return held.groupBy(*KEY, "first").count().where(F.col("count") == len(wanted)).select(*KEY, "first")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """Per row of `docs`: its id, _k1 and _k2, n_words, n_hit, n_items, items_sha256, contaminated.

    A text is contaminated if at least one word in twenty is in an occurrence of a benchmark window. Texts
    and items without words hit nothing; a null text has no words. Texts with one item_id are one item, and so
    are those with a null one, which counts in n_items and is not in the hash. Rows with equal id and text share a key
    and get equal rows; a null id is an id like others. Further columns of either table are not read.
    """
    with scratch(docs.sparkSession):
        hits = keep(_hits(docs, benchmark, doc_id, item_id))
    texts = _keyed(docs, doc_id)
    sizes = texts.select(F.col("_doc").alias(doc_id), *KEY, F.size(words_of(F.col("_text"))).cast("long").alias("n_words"))
    judged = sizes.join(few(hits), KEY, "left").na.fill(0, ["n_hit", "n_items"])
    return judged.select(
        doc_id, *KEY, "n_words", "n_hit", "n_items", F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def _keyed(docs: DataFrame, doc_id: str) -> DataFrame:
    texts = docs.select(F.col(doc_id).alias("_doc"), text_of().alias("_text"))
    return texts.select("_doc", "_text", *row_key(F.col("_doc"), F.col("_text")))


def _hits(docs: DataFrame, benchmark: DataFrame, doc_id: str, item_id: str) -> DataFrame:
    """(_k1, _k2, n_hit, n_items, items_sha256) of the texts with hits."""
    texts = _keyed(docs, doc_id)
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), words_of(text_of()).alias("words")).distinct()
    # An id may be null or have several texts, so each text goes by a number.
    items = settle(items.where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()))
    words = texts.select(*KEY, words_of(F.col("_text")).alias("words"))
    index = build_index(words, items.select(F.explode("words").alias("word")))
    found = settle(find_phrases(index, items))
    hit = (
        found.select(*KEY, F.explode(F.sequence("first", "last")).alias("pos")).distinct()
        .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    )
    names = F.sort_array(F.collect_set("name"))
    unnamed = F.max(F.col("name").isNull().cast("long"))
    listed = found.select(*KEY, "item").distinct().join(few(items.select("item", "name")), "item").groupBy(*KEY).agg(
        (F.size(names) + unnamed).alias("n_items"), F.sha2(F.concat_ws(",", names), 256).alias("items_sha256")
    )
    return hit.join(listed, KEY)


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that are not contaminated, all columns kept.

    Texts and items are judged as `contamination` says. Null and empty texts stay, rows with equal id and text stay or
    go together, an empty table stays empty, and no name of a column matters but those of the id and the text.
    """
    bad = contamination(docs, benchmark, doc_id).where("contaminated").select(*KEY).distinct()
    names = unused(docs.columns, "k1", "k2")
    keyed = docs.select("*", *[c.alias(name) for name, c in zip(names, row_key(F.col(doc_id), text_of()))])
    bad = few(settle(bad.toDF(*names)))
    return keyed.join(bad, names, "left_anti").drop(*names)
