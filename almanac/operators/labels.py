"""Return classes and their encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The class names.
POSITIVE, NEGATIVE, MODERATE = "pos_return", "neg_return", "mod_return"


def return_statistics(df: DataFrame, target: str = "future_returns") -> DataFrame:
    """One row: mean and sample deviation of the target."""
    return df.agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"))


def return_class(value: Column, mean: Column, std: Column) -> Column:
    """Strictly beyond one deviation of the mean on either side, else moderate (also for NULL)."""
    return F.when(value > mean + std, POSITIVE).when(value < mean - std, NEGATIVE).otherwise(MODERATE)


def label_returns(df: DataFrame, target: str = "future_returns", fit_on: DataFrame | None = None) -> DataFrame:
    """Adds return_class and return_class_encoded.

    The thresholds come from `fit_on` (the training rows, say) or else from all rows of `df`.
    """
    stats = return_statistics(df if fit_on is None else fit_on, target)
    band = stats.select(F.struct("mean", "std")).scalar()
    classed = df.withColumn("_band", band).withColumn(
        "return_class", return_class(F.col(target), F.col("_band.mean"), F.col("_band.std"))
    )
    return encode(classed.drop("_band"), "return_class", "return_class_encoded")


def encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the alphabetical 0-based index of a class column with few distinct values."""
    classes = df.select(column).distinct().agg(F.array_sort(F.collect_list(column))).scalar()
    return df.withColumn(out, (F.array_position(classes, F.col(column)) - 1).cast("int"))
