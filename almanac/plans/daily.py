"""Raw table to the daily series and the daily text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from almanac.operators import rollup, series
from almanac.operators.keyed import broadcast_days


def daily_series(raw: DataFrame, day: str = "time_published") -> DataFrame:
    """One narrow row per day: mean price, weekday, previous price, returns, volatilities, next return."""
    return series.with_returns(rollup.daily_price(raw, day), day)


def daily_table(raw: DataFrame, order: list[str] | None = None, day: str = "time_published") -> DataFrame:
    """The daily series with the joined titles and contents of each day.

    The windows run on the narrow series; the text meets it afterwards, one row a day.
    """
    numbers = daily_series(raw, day)
    return rollup.daily_text(raw, order, day).join(broadcast_days(numbers, day), day)
