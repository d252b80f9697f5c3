"""How the driver's tables stand in for news, prices and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.scalars import round_price
from almanac.operators.items import join_prices
from almanac.sources.tables import read_table, spread

# Invented word lists for the invented languages of the test documents.
LEMMAS = [
    ("des", "de"), ("les", "le"), ("is", "be"), ("are", "be"), ("die", "der"), ("das", "der"),
    ("los", "el"), ("las", "el"), ("ands", "and"), ("ations", "ation"),
]
LEXICON = [
    ("the", 0.0, 1.0), ("with", 0.0, 0.5), ("for", 0.0, 0.75), ("by", 0.5, 0.0), ("of", 0.25, 0.25),
    ("is", 1.0, 0.0), ("in", 0.25, 0.0), ("der", 0.0, 1.0), ("und", 0.5, 0.0), ("la", 0.0, 0.5),
    ("le", 0.75, 0.0), ("un", 0.0, 0.25), ("que", 0.5, 0.25), ("el", 0.0, 1.0), ("de", 0.25, 0.0),
]
TEXT_TABLES = ("documents", "pages")
# The days over which documents are spread to meet the long price series.
NEWS_DAYS = 2_400
NEWS_SITE = "https://news.example.org/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = read_table(spark, f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def lemmas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEMMAS, "token string, lemma string")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "token string, neg double, pos double")


def _day(days: int, start: str) -> Column:
    return F.date_add(F.lit(start).cast("date"), (F.col("doc_id") % days).cast("int"))


def _clock() -> Column:
    second = F.col("doc_id") % 86400
    return F.format_string("%02d%02d%02d", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)


def news(spark: SparkSession, sf_dir: str, days: int = 30, start: str = "2024-01-01") -> DataFrame:
    """(doc_id, titles, url, time_published, content): every document as an item; its first line is the title."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("titles"),
        F.concat(F.lit(NEWS_SITE), F.col("doc_id")).alias("url"),
        _day(days, start).alias("time_published"),
        F.col("text").alias("content"),
    )


def stamped_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, titles, url, time_published as a compact stamp)."""
    items = news(spark, sf_dir).drop("content")
    stamp = F.concat(F.date_format("time_published", "yyyyMMdd"), F.lit("T"), _clock())
    return items.withColumn("time_published", stamp)


def _mean(column: str) -> Column:
    """Mean of two-decimal amounts, summed exactly so that the order of rows does not show."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, price): mean event value per day, 30 days."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.to_date("ts").alias("date")).agg(_mean("value").alias("price"))


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(time_published, price): mean order total per day, the long series."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("time_published")).agg(
        round_price(_mean("o_totalprice")).alias("price")
    )


def _with_closes(items: DataFrame, prices: DataFrame) -> DataFrame:
    return join_prices(items, prices).withColumn("price", round_price(F.col("price")))


def priced_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News of the 30 event days with their prices."""
    return _with_closes(news(spark, sf_dir), event_prices(spark, sf_dir))


def order_news(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """News spread over the first `days` calendar days of the order series, with prices."""
    prices = order_prices(spark, sf_dir).withColumnRenamed("time_published", "date")
    return _with_closes(news(spark, sf_dir, days, "1995-01-01"), prices)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})
