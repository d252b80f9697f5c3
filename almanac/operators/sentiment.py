"""Chunk sentiment: cutting texts into chunks, pluggable scorers, statistics per text."""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanac.functions import text
from almanac.functions.scalars import text_or_empty
from almanac.operators.keyed import broadcast_below, lookup_join
from almanac.operators.ordering import running_offset
from almanac.session import settle

LEXICON_BROADCAST_ROWS = 1_000_000
OFFSETS_BROADCAST_ROWS = 500_000
# A block of offsets, one row of a broadcast, takes 12 bytes an item.
OFFSETS_BLOCK_BITS = 10
PACKED_OFFSETS_ROWS = 8_000_000
LEAST_COUNT = 2
MOST_WORDS = 1_000_000
ITEM_ORDER = ["published_at", "url", "titles"]

# A scorer takes (…keys, chunk, words) rows and returns (…keys, chunk, neg, pos, failed) rows.
Scorer = Callable[[DataFrame, list[str]], DataFrame]


def text_chunks(df: DataFrame, doc: str, content: str, size: int = text.CHUNK_TOKENS) -> DataFrame:
    """(doc, chunk, words) of whole texts; no shuffle. Texts without words give no rows."""
    words = df.select(doc, text.tokens(F.col(content)).alias("words"))
    return words.select(doc, F.posexplode(text.token_chunks(F.col("words"), size)).alias("chunk", "words"))


def day_words(
    raw: DataFrame,
    order: list[str] | None = None,
    day: str = "time_published",
    content: str = "content",
    also: tuple[str, ...] = (),
) -> DataFrame:
    """(day, *order as rank_0.., *also, words, item), settled: the items of every day, their content cut into words.

    What counts words and what scores chunks read them from here, so that a text is cut once. `item` is an id of the row.
    """
    items = raw.where(F.col(day).isNotNull()).select(
        day,
        *[F.col(source).alias(f"rank_{i}") for i, source in enumerate(order or ITEM_ORDER)],
        *also,
        text.tokens(text_or_empty(F.col(content))).alias("words"),
    )
    # The id belongs to the written row, so a task that runs again gives the same one.
    return settle(items.withColumn("item", F.monotonically_increasing_id()))


def _offsets(items: DataFrame, day: str) -> DataFrame:
    """(item, n, offset), settled: how many words an item of `day_words` has, and how many its day holds before it.

    Worked out on narrow rows. Items that are equal in their order follow each other by their id, so each keeps its
    own words.
    """
    ranks = [c for c in items.columns if c.startswith("rank_")]
    sized = items.select(day, *ranks, "item", F.size("words").cast("long").alias("n"))
    placed = running_offset(sized, [day], [*ranks, "item"], "n").where(F.col("n") > 0)
    return settle(placed.select("item", "n", "offset"))


def _with_offsets(items: DataFrame, offsets: DataFrame) -> DataFrame:
    """Adds the offset to the items that have words; the words stay in place up to PACKED_OFFSETS_ROWS items.

    Ids of items follow each other, so the offsets of many items are broadcast in blocks of ids, a fraction of one row
    an item.
    """
    offsets = offsets.select("item", "offset")
    rows = offsets.count()
    if rows <= OFFSETS_BROADCAST_ROWS:
        return items.join(F.broadcast(offsets), "item")
    if rows > PACKED_OFFSETS_ROWS:
        return items.join(offsets, "item")
    block, slot = F.shiftright("item", OFFSETS_BLOCK_BITS), F.col("item").bitwiseAND((1 << OFFSETS_BLOCK_BITS) - 1).cast("int")
    entries = F.collect_list(F.struct(slot.alias("slot"), "offset"))
    packed = offsets.groupBy(block.alias("block")).agg(F.map_from_entries(entries).alias("offsets"))
    met = items.withColumn("block", block).join(F.broadcast(packed), "block")
    found = met.withColumn("offset", F.element_at("offsets", slot)).where(F.col("offset").isNotNull())
    return found.drop("block", "offsets")


def day_chunks(
    raw: DataFrame,
    order: list[str] | None = None,
    day: str = "time_published",
    content: str = "content",
    size: int = text.CHUNK_TOKENS,
    items: DataFrame | None = None,
) -> DataFrame:
    """(day, chunk, words): chunks of the joined text of each day, without building that text.

    Every item learns where its words start within the day, cuts them at the chunk borders, and the
    cuts of a chunk are put together. The largest group is one chunk. `items`: the `day_words` of `raw`, if at hand.
    """
    items = day_words(raw, order, day, content) if items is None else items
    offsets = _offsets(items, day)
    # The chunks an item reaches into are worked out on narrow rows.
    chunks = F.sequence(F.floor(F.col("offset") / size), F.floor((F.col("offset") + F.col("n") - 1) / size))
    offsets = broadcast_below(offsets.withColumn("chunks", chunks), OFFSETS_BROADCAST_ROWS)
    spread = items.join(offsets, "item").select(day, "words", "n", "offset", F.explode("chunks").alias("chunk"))
    start = F.greatest(F.col("chunk") * size - F.col("offset"), F.lit(0)).cast("int")
    end = F.least((F.col("chunk") + 1) * size - F.col("offset"), F.col("n")).cast("int")
    # Words hold no space, so cuts travel as text: a fraction of an array of words.
    part = text.token_text(F.slice("words", start + 1, end - start)).alias("part")
    cuts = spread.select(day, "chunk", F.struct("offset", part).alias("cut"))
    grouped = cuts.groupBy(day, "chunk").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))
    return grouped.select(day, "chunk", F.split(text.token_text(F.col("cuts")["part"]), " ").alias("words"))


def day_chunk_words(
    raw: DataFrame,
    order: list[str] | None = None,
    day: str = "time_published",
    content: str = "content",
    size: int = text.CHUNK_TOKENS,
    items: DataFrame | None = None,
) -> DataFrame:
    """(day, chunk, token), one row a word: the chunk of a word is its place in the day's joined text over `size`.

    For scorers that add up words: no chunk is ever put together. `items`: the `day_words` of `raw`, if at hand.
    """
    items = day_words(raw, order, day, content) if items is None else items
    words = _with_offsets(items, _offsets(items, day)).select(day, "offset", F.posexplode("words").alias("pos", "token"))
    return words.select(day, F.floor((F.col("offset") + F.col("pos")) / size).alias("chunk"), "token")


class WordScorer:
    """A scorer that adds up what a (token, neg, pos) table says of each word, and finishes the sums.

    `finish` makes the scores (neg, pos) from the sums of neg and pos and the number of words. Sums need no chunk in
    one place: `sums` takes rows of words and combines them within each task before anything is shuffled.
    """

    def __init__(self, weights: DataFrame, finish: Callable[[Column, Column, Column], tuple[Column, Column]]):
        self.weights, self.finish = weights.select("token", "neg", "pos"), finish

    def sums(self, words: DataFrame, keys: list[str]) -> DataFrame:
        """(…keys, chunk, neg, pos, failed) from rows (…keys, chunk, token)."""
        met = lookup_join(words, self.weights, "token", LEXICON_BROADCAST_ROWS)
        summed = met.groupBy(*keys, "chunk").agg(
            *[F.coalesce(F.sum(name), F.lit(0.0)).alias(f"sum_{name}") for name in ("neg", "pos")], F.count(F.lit(1)).alias("n_words")
        )
        neg, pos = self.finish(F.col("sum_neg"), F.col("sum_pos"), F.col("n_words"))
        return summed.select(*keys, "chunk", neg.alias("neg"), pos.alias("pos"), F.lit(False).alias("failed"))

    def __call__(self, chunks: DataFrame, keys: list[str]) -> DataFrame:
        return self.sums(chunks.select(*keys, "chunk", F.explode("words").alias("token")), keys)


def lexicon_scorer(lexicon: DataFrame) -> WordScorer:
    """Share of a chunk's words that a (token, neg, pos) word list weighs as negative and positive."""
    return WordScorer(lexicon, lambda neg, pos, n: (neg / n, pos / n))


def pandas_scorer(model: Callable[[pd.Series], pd.DataFrame]) -> Scorer:
    """Any model over batches of chunk texts, returning columns neg and pos.

    When a batch fails its rows are tried one by one; a failing row gets NULL scores and failed = true.
    """

    def safe(texts: pd.Series) -> pd.DataFrame:
        try:
            scored = model(texts)
            return pd.DataFrame({
                "neg": scored["neg"].to_numpy(), "pos": scored["pos"].to_numpy(), "failed": False,
            })
        except Exception:
            if len(texts) == 1:
                return pd.DataFrame({"neg": [None], "pos": [None], "failed": [True]})
            rows = [safe(texts.iloc[[i]]) for i in range(len(texts))]
            return pd.concat(rows, ignore_index=True)

    scores = F.pandas_udf(safe, "neg double, pos double, failed boolean")

    def score(chunks: DataFrame, keys: list[str]) -> DataFrame:
        scored = chunks.select(*keys, "chunk", scores(text.token_text(F.col("words"))).alias("s"))
        return scored.select(*keys, "chunk", "s.neg", "s.pos", "s.failed")

    return score


def vocabulary(words: DataFrame, least: int = LEAST_COUNT, most: int = MOST_WORDS) -> DataFrame:
    """(token, n0, n1), settled: occurrences of every word in texts of either label, from rows (label, token).

    Every word has its own row. Words with at least `least` occurrences count; where these are more than `most`,
    the threshold rises to the lowest that leaves no more, found from how many words have each count.
    """
    ones = F.count(F.when(F.col("label") == 1, 1))
    counts = settle(words.groupBy("token").agg((F.count(F.lit(1)) - ones).alias("n0"), ones.alias("n1")))
    n = F.col("n0") + F.col("n1")
    if counts.where(n >= least).count() > most:
        sizes = counts.groupBy(n.alias("n")).count().withColumn("held", F.sum("count").over(W.orderBy(F.desc("n"))))
        least = sizes.where(F.col("held") <= most).agg(F.coalesce(F.min("n"), F.lit(1 << 62))).first()[0]
    return counts.where(n >= least)


def train_scorer(
    df: DataFrame, content: str, label: str, least: int = LEAST_COUNT, most: int = MOST_WORDS
) -> WordScorer:
    """Multinomial naive Bayes over an exact vocabulary; label 0 is negative, 1 positive.

    One pass over the words of the labelled texts. A word adds the logarithm of its share in either label's words,
    one added to every count; words outside the vocabulary add nothing. The scores are the two probabilities.
    """
    rows = df.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), text.tokens(F.col(content)).alias("words"))
    rows = settle(rows)
    counts = vocabulary(rows.select("label", F.explode("words").alias("token")), least, most)
    totals = counts.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(c), F.lit(0)) for c in ("n0", "n1")]).first()
    texts = rows.agg(*[F.count(F.when(F.col("label") == i, 1)) for i in (0, 1)]).first()
    shares = [F.log((F.col(c) + 1.0) / F.lit(float(totals[i] + totals[0]))) for i, c in ((1, "n0"), (2, "n1"))]
    weights = settle(counts.select("token", shares[0].alias("neg"), shares[1].alias("pos")))
    prior = math.log((texts[1] + 1) / (texts[0] + 1))

    def finish(neg: Column, pos: Column, n: Column) -> tuple[Column, Column]:
        odds = pos - neg + F.lit(prior)
        return 1 / (1 + F.exp(odds)), 1 / (1 + F.exp(-odds))

    return WordScorer(weights, finish)


def sentiment_statistics(scored: DataFrame, keys: list[str]) -> DataFrame:
    """The eight statistics per text, with the number of chunks and of failed ones.

    Failed chunks have NULL scores, which the statistics skip.
    """
    columns = [
        how(name).alias(f"{prefix}_{name}_sentiment")
        for name in ("neg", "pos")
        for prefix, how in (("mean", F.avg), ("max", F.max), ("min", F.min), ("std", F.stddev_pop))
    ]
    return scored.groupBy(*keys).agg(
        *columns,
        F.count(F.lit(1)).alias("n_chunks"),
        F.count(F.when(F.col("failed"), 1)).alias("n_failed"),
    )


def text_sentiment(df: DataFrame, doc: str, content: str, scorer: Scorer) -> DataFrame:
    """(doc, statistics, n_chunks, n_failed) for every text; one without words has NULL statistics and no chunks."""
    statistics = sentiment_statistics(scorer(text_chunks(df, doc, content), [doc]), [doc])
    return df.select(doc).join(statistics, doc, "left").na.fill(0, ["n_chunks", "n_failed"])
