"""Landed documents to the raw news-and-price table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from almanac.functions import scalars
from almanac.operators import items
from almanac.operators.keyed import broadcast_days
from almanac.schemas import RAW_NEWS_PRICE
from almanac.session import children, delete, scratch, settle
from almanac.sources import seen, tables

FIRST_ORDER = ["published_at", "url"]
_STORED = StructType([*RAW_NEWS_PRICE.fields, StructField("month", StringType())])


def new_items(news: DataFrame, prices: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """(titles, url, time_published, published_at, price): first item per title that is not stored yet.

    `news` has (titles, url, time_published as a compact stamp), `prices` has (date, price) as text. An item is
    new when its title is not stored, whatever its day: items may land after later ones.
    """
    priced = items.join_prices(items.with_day(news), items.price_days(prices))
    first = items.keep_first(priced, "titles", FIRST_ORDER)
    return first if stored is None else items.not_stored(first, stored)


def ingest(news: DataFrame, prices: DataFrame, pages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Rows to append to the raw table; `pages` is (url, html), unique by url."""
    return _rows(settle(new_items(news, prices, stored)), pages)


def _rows(new: DataFrame, pages: DataFrame) -> DataFrame:
    found = items.with_content(new, pages)
    rounded = found.withColumn("price", scalars.round_price(F.col("price")))
    return rounded.select(*RAW_NEWS_PRICE.names)


def run_ingest(spark: SparkSession, news: DataFrame, prices: DataFrame, pages: DataFrame, path: str) -> None:
    """Append what is new to the table at `path`; running it again adds nothing.

    An item is new when no run has stored its title, whatever its day. The titles that are stored stand beside the
    table, at `path`-seen, in buckets by hash; a run reads those buckets that its own titles fall into and never the
    table. `path`-waiting holds the items that have no page or no price yet, which the next run tries again, and
    `path`-rejects the landed items whose stamp cannot be read. Several pages of one url count as one where `pages`
    has a column landed: the last. A run that ends early is finished by the next one.
    """
    with scratch(spark):
        _finish(spark, path)
        if "landed" in pages.columns:
            pages = items.latest_pages(pages, "landed")
        landed = items.with_day(news).where(F.col("time_published").isNotNull())
        held = tables.stored_table(spark, f"{path}-waiting")
        if held is not None:
            landed = landed.unionByName(held.select(*landed.columns))
        closes = broadcast_days(settle(items.price_days(prices)), "date")
        met = landed.join(closes, F.col("time_published") == F.col("date"), "left")
        # A title may wait by an unpriced copy beside the first priced one, so each kind has its own first.
        kinds = met.withColumn("slot", F.struct(F.col("date").isNotNull().alias("priced"), "titles")).drop("date")
        firsts = settle(items.keep_first(kinds, "slot", FIRST_ORDER))
        fresh = settle(seen.unseen(firsts, f"{path}-seen", "titles"))
        new = fresh.where("slot.priced").drop("slot")
        unpriced = fresh.where("NOT slot.priced").drop("slot")
        _rows(new, pages).write.mode("overwrite").parquet(f"{path}-pending")
        stored_now = spark.read.schema(RAW_NEWS_PRICE).parquet(f"{path}-pending")
        waits = items.without_page(new, pages).select(*landed.columns)
        waits = settle(waits.unionByName(items.not_stored(unpriced, stored_now).select(*landed.columns)))
        _finish(spark, path, fresh=True)
        waits.write.mode("overwrite").parquet(f"{path}-waiting")
        refused, known = items.rejects(news), tables.stored_table(spark, f"{path}-rejects")
        refused = refused.distinct() if known is None else refused.subtract(known.select(*refused.columns))
        refused.write.mode("append").parquet(f"{path}-rejects")


def _finish(spark: SparkSession, path: str, fresh: bool = False) -> None:
    """Store the rows at `path`-pending and their titles; `fresh` rows are known not to be in the table.

    Rows wait there from before the first of the two writes until after the second, so a run that is lost in
    between is finished by the next one: rows that had reached the table are found in their own months.
    """
    if not fresh and not seen.recorded(spark, f"{path}-seen"):
        stored = tables.stored_table(spark, path, _STORED)  # a table from before there were buckets
        if stored is not None:
            seen.record(stored, f"{path}-seen", "titles", "table.0")
    if "_SUCCESS" not in children(spark, f"{path}-pending"):
        return
    rows = spark.read.schema(RAW_NEWS_PRICE).parquet(f"{path}-pending")
    missing = rows
    stored = None if fresh else tables.stored_table(spark, path, _STORED)
    if stored is not None:
        months = F.broadcast(rows.select(F.date_format("time_published", "yyyy-MM").alias("month")).distinct())
        missing = items.not_stored(rows, stored.join(months, "month", "left_semi"))
    tables.append(missing, path)
    seen.record(rows, f"{path}-seen", "titles", f"ingest.{uuid.uuid4().int}")
    seen.compact(spark, f"{path}-seen")
    delete(spark, f"{path}-pending")
