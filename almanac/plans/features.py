"""Raw table to the feature table: series, leading text components, sentiment statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.scalars import text_or_empty
from almanac.functions.text import combined_text, tokens
from almanac.operators import rollup, sentiment, series, tfidf
from almanac.operators.keyed import broadcast_days
from almanac.plans.daily import daily_series
from almanac.schemas import FEATURES
from almanac.session import scratch, settle
from almanac.sources import tables


def day_term_counts(
    raw: DataFrame, lemmas: DataFrame | None = None, day: str = "time_published", items: DataFrame | None = None
) -> DataFrame:
    """Term counts of each day's joined text, counted on the items: joining by a space changes no word.

    `items`: the `sentiment.day_words` of `raw` with its titles, if at hand; then only the titles are cut into words.
    """
    if items is not None:
        both = F.concat(tokens(text_or_empty(F.col("titles"))), "words")
        return tfidf.word_counts(items.select(day, F.explode(both).alias("token")), day, lemmas)
    texts = raw.where(F.col(day).isNotNull()).select(
        day, combined_text(text_or_empty(F.col("titles")), text_or_empty(F.col("content"))).alias("text")
    )
    return tfidf.term_counts(texts, day, "text", lemmas)


def components_of(counts: DataFrame, days: DataFrame, day: str = "time_published") -> DataFrame:
    """(day, PCA1, PCA2) of settled term counts; `days` lists the days, those without words included."""
    return tfidf.principal_components(tfidf.tfidf(counts, days.count(), day), days, day)


def day_components(
    raw: DataFrame, lemmas: DataFrame | None = None, day: str = "time_published", items: DataFrame | None = None
) -> DataFrame:
    """(day, PCA1, PCA2)."""
    days = settle(raw.select(day).where(F.col(day).isNotNull()).distinct())
    return components_of(settle(day_term_counts(raw, lemmas, day, items)), days, day)


def day_sentiment(
    raw: DataFrame,
    scorer: sentiment.Scorer,
    order: list[str] | None = None,
    day: str = "time_published",
    items: DataFrame | None = None,
) -> DataFrame:
    """(day, eight statistics, n_chunks, n_failed) of each day's joined content.

    A scorer that adds up words gets them as rows, so only sums are shuffled; any other gets whole chunks.
    `items`: the `sentiment.day_words` of `raw`, if at hand.
    """
    if isinstance(scorer, sentiment.WordScorer):
        scored = scorer.sums(sentiment.day_chunk_words(raw, order, day, items=items), [day])
    else:
        scored = scorer(sentiment.day_chunks(raw, order, day, items=items), [day])
    return sentiment.sentiment_statistics(scored, [day])


def _joined(numbers: DataFrame, components: DataFrame, scores: DataFrame, day: str) -> DataFrame:
    joined = numbers.join(broadcast_days(components, day), day).join(broadcast_days(scores, day), day, "left")
    return joined.select(*[day if c == "time_published" else c for c in FEATURES.names])


def features(
    raw: DataFrame,
    scorer: sentiment.Scorer,
    lemmas: DataFrame | None = None,
    order: list[str] | None = None,
    day: str = "time_published",
) -> DataFrame:
    """The feature table, one row per day; days without words have NULL sentiment."""
    items = sentiment.day_words(raw, order, day, also=("titles",))
    scores = day_sentiment(raw, scorer, order, day, items)
    return _joined(daily_series(raw, day), day_components(raw, lemmas, day, items), scores, day)


def run_features(
    spark: SparkSession,
    raw: DataFrame,
    scorer: sentiment.Scorer,
    path: str,
    lemmas: DataFrame | None = None,
    order: list[str] | None = None,
    days: DataFrame | None = None,
) -> None:
    """Write the feature table of the raw table to `path`; with `days`, only the text of those days is read.

    What comes from the text of one day alone is kept by day beside the table: -prices, -texts (joined titles and
    content, in parts, so that a day may have any size), -sentiment and -counts (words). The days in `days` (a table
    with the column time_published: those whose raw rows have changed) are replaced there, and all other days are taken
    as stored. Returns and components depend on all days: they are worked out anew from the narrow tables, so a partial
    run gives what a full one gives.
    """
    day = "time_published"
    with scratch(spark):
        some = raw.where(F.col(day).isNotNull())
        if days is not None:
            some = some.join(broadcast_days(days.select(day).distinct(), day), day, "left_semi")
        some = sentiment.day_words(some, order, day, also=("titles", "content", "price"))
        ranks = [c for c in some.columns if c.startswith("rank_")]
        tables.replace_days(rollup.daily_price(some, day), f"{path}-prices")
        texts = rollup.daily_text(some, ranks, day, part_bytes=rollup.PART_BYTES)
        tables.replace_days(texts, f"{path}-texts", by_day=True)
        tables.replace_days(day_sentiment(some, scorer, ranks, day, some), f"{path}-sentiment")
        tables.replace_days(day_term_counts(some, lemmas, day, some), f"{path}-counts")
        prices, scores, counts = (tables.read_table(spark, f"{path}-{name}").drop("month") for name in ("prices", "sentiment", "counts"))
        numbers = settle(series.with_returns(prices, day))
        tables.replace_days(_joined(numbers, components_of(counts, numbers.select(day), day), scores, day), path)


def read_features(spark: SparkSession, path: str, texts: bool = True, digests: bool = False) -> DataFrame:
    """The stored feature table, with the joined titles and content of every day where `texts` are wanted.

    A text is one cell, and a day that does not fit it raises; with `digests` its MD5 comes instead, for days of any size.
    """
    day = "time_published"
    stored = tables.read_table(spark, path).select(*FEATURES.names)
    if not texts:
        return stored
    parts = tables.read_table(spark, f"{path}-texts").drop("day_folder")
    joined = rollup.text_digests(parts, day) if digests else rollup.whole_text(parts, day)
    return joined.join(broadcast_days(stored, day), day).select(*FEATURES.names, "titles", "content")
