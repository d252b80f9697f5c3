"""Numeric, banding and sentiment-reply expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of a sentiment reply and its two labels.
REPLY_SCHEMA = "array<struct<label: string, score: double>>"
NEGATIVE_LABEL = "LABEL_0"
POSITIVE_LABEL = "LABEL_1"


def text_or_empty(value: Column) -> Column:
    """Missing text joins as an empty string, so that no stand-in word reaches the features."""
    return F.coalesce(value.cast("string"), F.lit(""))


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def round_price(value: Column) -> Column:
    """Two decimals, half to even on the scaled double."""
    return F.rint(to_double(value) * 100) / 100


def greed_band(value: Column) -> Column:
    """Colour of an index value: red from 70, yellow above 40, else green (also for NULL)."""
    return F.when(value >= 70, "red").when((value > 40) & (value < 70), "yellow").otherwise("green")


def label_score(reply: Column, label: str) -> Column:
    """Score of one label in a parsed reply, 0 where the label is missing."""
    hits = F.filter(reply, lambda item: item["label"] == label)
    return F.when(reply.isNotNull(), F.coalesce(F.get(hits, F.size(hits) - 1)["score"], F.lit(0.0)))


def reply_scores(raw: Column) -> Column:
    """struct<neg, pos> of a JSON reply; NULL fields when the reply cannot be read."""
    reply = F.from_json(raw, REPLY_SCHEMA)
    return F.struct(
        label_score(reply, NEGATIVE_LABEL).alias("neg"),
        label_score(reply, POSITIVE_LABEL).alias("pos"),
    )


def sentiment_spread(positive: str = "mean_pos_sentiment", negative: str = "mean_neg_sentiment") -> Column:
    return F.col(positive) - F.col(negative)


def percent_error(actual: Column, predicted: Column) -> Column:
    """Absolute relative error; NULL for a zero actual."""
    return F.abs(F.try_divide(actual - predicted, actual))


def same_direction(a: Column, b: Column) -> Column:
    return F.signum(a) == F.signum(b)


def percent_display(prediction: Column) -> Column:
    return F.round(prediction * 100, 3)
