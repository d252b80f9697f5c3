"""Report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.scalars import sentiment_spread
from almanac.operators import metrics, series
from almanac.schemas import CORRELATION_COLUMNS
from almanac.sources import feeds

RETURNS_ROWS = 10
SPREAD_ROWS = 30


def rolling_returns(df: DataFrame, day: str = "time_published") -> DataFrame:
    """(day, rolling_mean, overall_mean): 10-row mean of the next return, and the mean of those means."""
    rolled = df.select(day, series.rolling_mean("future_returns", RETURNS_ROWS, day).alias("rolling_mean"))
    overall = rolled.agg(F.round(F.avg("rolling_mean"), 4)).scalar()
    return rolled.withColumn("overall_mean", overall)


def price_and_spread(df: DataFrame, day: str = "time_published") -> DataFrame:
    """(day, price, spread): 30-row mean of positive minus negative sentiment."""
    spread = df.select(day, "price", sentiment_spread().alias("spread"))
    return spread.withColumn("spread", series.rolling_mean("spread", SPREAD_ROWS, day))


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return metrics.correlation_table(df, columns or CORRELATION_COLUMNS)


def index_gauge(documents: DataFrame, raw: str = "raw") -> DataFrame:
    return feeds.index_snapshot(documents, raw)
