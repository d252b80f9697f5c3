"""Next-day prediction."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions import dates, scalars
from almanac.operators import series
from almanac.plans.training import carried, with_classifier
from almanac.schemas import CLASSIFIER_FEATURES, REGRESSOR_FEATURES


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict_next(
    features: DataFrame, clf: PipelineModel, reg: PipelineModel, day: str = "time_published"
) -> DataFrame:
    """(day, next_day, prediction, percent) from the latest day's features; always one row for a table with rows.

    Features that the day lacks are carried from earlier days; raises where no day has one, as any stand-in would
    lie outside what the models were trained on.
    """
    latest = series.last_row(carried(features, day), [c for c in features.columns if c != day], day)
    needed = [c for c in dict.fromkeys([*CLASSIFIER_FEATURES, *REGRESSOR_FEATURES]) if c != "clf_predictions"]
    row = latest.first()
    missing = [c for c in needed if row[day] is not None and row[c] is None]
    if missing:
        raise ValueError(f"no day has the features {missing}")
    predicted = reg.transform(with_classifier(latest, clf, day))
    return predicted.select(
        day,
        dates.next_day(F.col(day)).alias("next_day"),
        "prediction",
        scalars.percent_display(F.col("prediction")).alias("percent"),
    )
