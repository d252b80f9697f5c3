"""News items: join with prices, keep-first by title, repeats across runs, page content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions import dates, scalars, text
from almanac.operators.keyed import broadcast_days, hot_keys, split_join
from almanac.operators.naming import unused
from almanac.session import settle

LOST_BROADCAST_ROWS = 500_000


def with_day(items: DataFrame, stamp: str = "time_published") -> DataFrame:
    """Turns the compact stamp into a day and keeps the stamp as published_at; unreadable stamps give NULL."""
    return items.withColumn("published_at", F.col(stamp)).withColumn(stamp, dates.compact_date(F.col(stamp)))


def rejects(items: DataFrame, stamp: str = "time_published") -> DataFrame:
    """Items whose stamp cannot be read."""
    return items.where(dates.compact_date(F.col(stamp)).isNull())


def price_days(prices: DataFrame) -> DataFrame:
    """(date, price): one close per readable day: that of the document that landed last, as closes get revised.

    Without a column `landed` nothing orders the documents, and the highest price stands. A close that
    cannot be read does not replace one that can.
    """
    order = F.struct("landed", "price") if "landed" in prices.columns else F.col("price")
    typed = prices.withColumns({"date": dates.iso_date(F.col("date")), "price": scalars.to_double(F.col("price"))})
    readable = typed.where(F.col("date").isNotNull())
    last = F.max_by("price", F.when(F.col("price").isNotNull(), order))
    return readable.groupBy("date").agg(last.alias("price"))


def join_prices(items: DataFrame, prices: DataFrame, day: str = "time_published") -> DataFrame:
    """Items of days that have a price; the news side is not shuffled."""
    met = items.join(broadcast_days(prices, "date"), F.col(day) == F.col("date"), "inner")
    return met.drop("date")


def keep_first(items: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row per key in `order`; missing keys count as equal. Rows that tie go by a hash of their values.

    Two phases, so that contents are neither sorted nor aggregated. Rows are numbered in `order` on narrow rows, and
    the least number per key is a hash aggregation of longs: two 64-bit hashes of the key and its length. Copies of
    one key collapse within each task, so a key that holds a third of the rows costs one row per task. Then the
    rows that lost go by their numbers, through a broadcast where they are few.
    """
    row, seq, h1, h2, size, whole = unused(items.columns, "row", "seq", "h1", "h2", "size", "whole")
    rows = settle(items.withColumn(row, F.monotonically_increasing_id()))
    value = F.col(key)
    narrow = rows.select(
        *[c for c in order if c != key], F.xxhash64(value.isNull(), value).alias(h1), F.xxhash64(F.lit(7), value.isNull(), value).alias(h2),
        F.length(value.cast("string")).alias(size), F.xxhash64(*items.columns).alias(whole), row,
    )
    by = [c for c in order if c != key] + [whole, row]
    numbered = narrow.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(seq, F.monotonically_increasing_id())
    numbered = settle(numbered.select(h1, h2, size, seq, row))
    first = numbered.groupBy(h1, h2, size).agg(F.min(seq).alias(seq)).select(seq)
    lost = numbered.count() - first.count()
    if not lost:
        return rows.drop(row)
    if lost <= LOST_BROADCAST_ROWS:
        losers = numbered.join(first, seq, "left_anti").select(row)
        return rows.join(F.broadcast(losers), row, "left_anti").drop(row)
    return rows.join(numbered.join(first, seq, "left_semi").select(row), row, "left_semi").drop(row)


def not_stored(batch: DataFrame, stored: DataFrame, key: str = "titles") -> DataFrame:
    """Rows of the batch whose key is not stored yet; missing keys count as equal."""
    seen = stored.select(F.col(key).alias("stored_key")).distinct()
    return batch.join(seen, F.col(key).eqNullSafe(F.col("stored_key")), "left_anti")


def with_content(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds the readable text of each item's page, taken from (url, html); items without one are dropped.

    Pages must be unique by url. A url that many items share does not become one task's work. The items
    are read several times, so pass a settled frame.
    """
    # Only pages that some item asks for are turned into text, each once.
    asked = items.select("url").distinct()
    fetched = pages.where(F.col("html").isNotNull()).join(asked, "url", "left_semi")
    readable = settle(fetched.select("url", text.html_to_text(F.col("html")).alias("content")))
    return split_join(items, readable, "url", hot_keys(items, "url"))


def without_page(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items whose page has not landed yet."""
    return items.join(pages.where(F.col("html").isNotNull()).select("url").distinct(), "url", "left_anti")


def latest_pages(pages: DataFrame, order: str) -> DataFrame:
    """One page per url, the one with the highest `order`."""
    return pages.groupBy("url").agg(F.max(F.struct(order, "html"))["html"].alias("html"))
