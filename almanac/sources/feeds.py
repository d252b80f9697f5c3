"""Landed feed documents: news pages, price maps, index snapshots, and the incremental poll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import dates, scalars

# Field names and layout of the landed documents.
NEWS_SCHEMA = "feed array<struct<title: string, url: string, time_published: string>>"
PRICE_KEY = "Time Series (Digital Currency Daily)"
CLOSE_KEY = "4a. close (USD)"
PRICE_SCHEMA = f"`{PRICE_KEY}` map<string, map<string, string>>"
SNAPSHOT_SCHEMA = "fgi struct<now: struct<value: int, valueText: string>>"
PAGE_LIMIT = 1000


def read_documents(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Landed JSON documents, one file each, in column `raw`, with the time they landed.

    `since` (a timestamp as text) leaves files that landed before it unread.
    """
    landed = spark.read.option("modifiedAfter", since) if since else spark.read
    files = landed.text(path, wholetext=True).withColumnRenamed("value", "raw")
    return files.select("raw", F.col("_metadata.file_modification_time").alias("landed"))


def news_items(documents: DataFrame, raw: str = "raw") -> DataFrame:
    """(titles, url, time_published) of every item; a document without a feed gives no rows."""
    parsed = documents.select(F.from_json(raw, NEWS_SCHEMA).alias("doc"))
    return parsed.select(F.inline("doc.feed")).withColumnRenamed("title", "titles")


def price_items(documents: DataFrame, raw: str = "raw") -> DataFrame:
    """(date, price, and landed where the documents have it) of every entry; price stays text as delivered."""
    landed = [c for c in ("landed",) if c in documents.columns]
    parsed = documents.select(*landed, F.from_json(raw, PRICE_SCHEMA)[PRICE_KEY].alias("days"))
    entries = parsed.select(*landed, F.explode("days").alias("date", "quote"))
    return entries.select("date", F.col("quote")[CLOSE_KEY].alias("price"), *landed)


def index_snapshot(documents: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds (value, value_text, colour) of an index snapshot document."""
    now = F.from_json(raw, SNAPSHOT_SCHEMA)["fgi"]["now"]
    read = documents.withColumns({"value": now["value"], "value_text": now["valueText"]}).drop(raw)
    return read.withColumn("colour", scalars.greed_band(F.col("value")))


def union_pages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all pages; columns are matched by name."""
    for page in others:
        first = first.unionByName(page, allowMissingColumns=True)
    return first


def poll_cursor(stored: DataFrame, day: str = "time_published") -> Column:
    """Where the next poll starts: the start of the last stored day, NULL for an empty table."""
    return stored.agg(dates.api_stamp(F.max(day))).scalar()


def items_since(items: DataFrame, cursor: Column, stamp: str = "time_published") -> DataFrame:
    """Items from the cursor's day on, whatever form their stamps have; everything when nothing is stored yet."""
    return items.where(F.col(stamp) >= F.coalesce(F.substring(cursor, 1, 8), F.lit("")))


def feed_page(items: DataFrame, cursor: Column, stamp: str = "time_published", limit: int = PAGE_LIMIT) -> DataFrame:
    """One page as the feed serves it: earliest items from the cursor on, up to the page limit."""
    return items_since(items, cursor, stamp).orderBy(stamp, *[c for c in items.columns if c != stamp]).limit(limit)
