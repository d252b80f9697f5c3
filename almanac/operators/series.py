"""Row-frame features, positions, splits and folds of the daily series.

All functions here take the rolled-up series: narrow columns, one row per day. The calendar bounds it
(see `broadcast_days`), so one ordered window over it is small at any source size. Text never
passes through these windows; it is joined by day afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanac.functions import dates

VALIDATION_SHARE = 0.1
FOLDS = 3


def _by(day: str):
    return W.orderBy(day)


def _trailing(day: str, rows: int):
    return _by(day).rowsBetween(-(rows - 1), 0)


def rolling_std(value: str, rows: int, day: str = "time_published") -> Column:
    """Sample deviation over the last `rows` rows; NULL until the frame holds that many values."""
    frame = _trailing(day, rows)
    return F.when(F.count(value).over(frame) >= rows, F.stddev_samp(value).over(frame))


def rolling_mean(value: str, rows: int, day: str = "time_published") -> Column:
    """Mean over the last `rows` rows; NULL until the frame holds that many values."""
    frame = _trailing(day, rows)
    return F.when(F.count(value).over(frame) >= rows, F.avg(value).over(frame))


def difference(value: str, day: str = "time_published") -> Column:
    return F.col(value) - F.lag(value).over(_by(day))


def with_returns(series: DataFrame, day: str = "time_published") -> DataFrame:
    """Adds weekday, previous price, return, rolling volatility and next return.

    A missing price counts as unchanged for the return; a return on a zero price is NULL.
    """
    filled = F.last("price", ignorenulls=True).over(_by(day).rowsBetween(W.unboundedPreceding, 0))
    priced = series.withColumns({
        "day_of_week": dates.day_of_week(F.col(day)),
        "lagged_price": F.lag("price").over(_by(day)),
        "_filled": filled,
    })
    returned = priced.withColumn(
        "returns", F.try_divide(F.col("_filled"), F.lag("_filled").over(_by(day))) - 1
    ).drop("_filled")
    return returned.withColumns({
        "3d_rolling_volatility": rolling_std("returns", 3, day),
        "7d_rolling_volatility": rolling_std("returns", 7, day),
        "future_returns": F.lead("returns").over(_by(day)),
    })


def with_position(series: DataFrame, day: str = "time_published") -> DataFrame:
    """Adds the 1-based row position and the row count."""
    return series.withColumns({
        "position": F.row_number().over(_by(day)),
        "n": F.count(F.lit(1)).over(_by(day).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
    })


def trim_edges(series: DataFrame, day: str = "time_published") -> DataFrame:
    """Without the first and the last row."""
    placed = with_position(series, day)
    return placed.where((F.col("position") > 1) & (F.col("position") < F.col("n"))).drop("position", "n")


def with_target(series: DataFrame, target: str = "future_returns") -> DataFrame:
    """Rows whose target is known; features and target stay in one row."""
    return series.where(F.col(target).isNotNull())


def chronological_split(
    series: DataFrame, day: str = "time_published", share: float = VALIDATION_SHARE, out: str = "is_train"
) -> DataFrame:
    """Adds a flag: the last ceil(share * n) rows validate, all earlier ones train."""
    placed = with_position(series, day)
    # Rounded first, so that 0.1 * 30 counts as 3 and not as 3.0000000000000004.
    held = F.ceil(F.round(F.col("n") * F.lit(share), 9))
    return placed.withColumn(out, F.col("position") <= F.col("n") - held).drop("position", "n")


def expanding_folds(series: DataFrame, day: str = "time_published", folds: int = FOLDS) -> DataFrame:
    """Adds `test_fold`: the fold (0-based) in which the row is tested, NULL for the head of the series.

    Fold i trains on every row before its test rows; test blocks are n // (folds + 1) rows long.
    """
    placed = with_position(series, day)
    block = F.floor(F.col("n") / (folds + 1))
    fold = F.floor((F.col("position") - 1 - (F.col("n") - folds * block)) / F.when(block > 0, block))
    return placed.withColumn("test_fold", F.when(fold >= 0, fold).cast("int")).drop("position", "n")


def last_row(series: DataFrame, columns: list[str], day: str = "time_published") -> DataFrame:
    """The latest day's values."""
    return series.agg(F.max_by(F.struct(day, *columns), day).alias("row")).select("row.*")
