"""Evaluation metrics; each is a function from a frame of pairs to a frame of one row (or one per class)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.scalars import percent_error, same_direction
from almanac.operators.series import difference


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages and accuracy.

    Everything after the confusion table works on at most classes x classes rows.
    """
    cells = confusion(df, label, prediction)
    actual = cells.groupBy(F.col("label").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))).alias("hits")
    )
    guessed = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("guesses"))
    counts = actual.join(guessed, "class", "full").select(
        "class", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("support", "hits", "guesses")]
    )
    zero = F.lit(0.0)
    rates = counts.select(
        F.col("class").cast("string").alias("class"),
        F.coalesce(F.try_divide("hits", "guesses"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("guesses")), zero).alias("f1"),
        "support",
        "hits",
    )
    names = ("precision", "recall", "f1")
    macro = rates.agg(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = rates.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    overall = rates.agg(
        F.lit("accuracy").alias("class"),
        *[(F.sum("hits") / F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return rates.drop("hits").unionByName(macro).unionByName(weighted).unionByName(overall)


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and MAPE in percent; zero actuals are left out of MAPE and counted."""
    y, p = F.col(actual), F.col(predicted)
    return df.agg(
        F.sqrt(F.avg((y - p) ** 2)).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.avg(percent_error(y, p)) * 100).alias("mape"),
        F.count(F.when(y == 0, 1)).alias("zero_actuals"),
        F.count(F.when(y.isNotNull() & p.isNotNull(), 1)).alias("n"),
    )


def direction_of_change(df: DataFrame, actual: str, predicted: str, day: str) -> DataFrame:
    """Share of rows, in percent, whose change from the row before has the same sign in both series."""
    moved = df.select(difference(actual, day).alias("dy"), difference(predicted, day).alias("dp"))
    agreed = same_direction(F.col("dy"), F.col("dp")).cast("double")
    return moved.agg((F.avg(agreed) * 100).alias("direction_of_change"))


def direction_of_level(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Share of rows, in percent, whose value has the same sign in both series."""
    agreed = same_direction(F.col(actual), F.col(predicted)).cast("double")
    return df.agg((F.avg(agreed) * 100).alias("direction_of_level"))


def naive_baseline(series: DataFrame, today: str = "returns", target: str = "future_returns") -> DataFrame:
    """Today's return as the guess for the next one, over the rows that have both."""
    pairs = series.where(F.col(today).isNotNull() & F.col(target).isNotNull())
    return regression_metrics(pairs, target, today).select("rmse", "mape", "zero_actuals", "n")


def correlation_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_a, column_b, correlation) for every ordered pair, from one aggregation over the data.

    Each pair uses the rows in which both values are present.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(
        *[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
        *[F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"d{i}") for i, c in enumerate(columns)],
    )
    cells = [F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias("correlation"))
             for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
    cells += [F.struct(F.lit(c).alias("column_a"), F.lit(c).alias("column_b"), F.col(f"d{i}").alias("correlation"))
              for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*cells)))
