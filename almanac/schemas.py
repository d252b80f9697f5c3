"""Declared table schemas and the model feature lists."""

from pyspark.sql import types as T

# Stored table layouts.
RAW_NEWS_PRICE = T.StructType([
    T.StructField("titles", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("time_published", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("content", T.StringType()),
    # The full publication stamp: a day alone does not order the items within it.
    T.StructField("published_at", T.StringType()),
])

SERIES = T.StructType([
    T.StructField("time_published", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("lagged_price", T.DoubleType()),
    T.StructField("returns", T.DoubleType()),
    T.StructField("3d_rolling_volatility", T.DoubleType()),
    T.StructField("7d_rolling_volatility", T.DoubleType()),
    T.StructField("future_returns", T.DoubleType()),
])

# Feature vectors, in model order.
SENTIMENT_COLUMNS = [
    "mean_neg_sentiment", "max_neg_sentiment", "min_neg_sentiment", "std_neg_sentiment",
    "mean_pos_sentiment", "max_pos_sentiment", "min_pos_sentiment", "std_pos_sentiment",
]
CLASSIFIER_FEATURES = ["PCA1", "PCA2", "price", "day_of_week", "lagged_price", "returns", *SENTIMENT_COLUMNS]
REGRESSOR_FEATURES = [
    "PCA1", "PCA2", "price", "day_of_week", "lagged_price", "returns",
    "mean_neg_sentiment", "max_neg_sentiment", "min_neg_sentiment", "std_neg_sentiment",
    "3d_rolling_volatility", "7d_rolling_volatility",
    "mean_pos_sentiment", "max_pos_sentiment", "min_pos_sentiment", "std_pos_sentiment",
    "clf_predictions",
]
CORRELATION_COLUMNS = [
    "PCA1", "PCA2", "price", "day_of_week", "returns",
    "3d_rolling_volatility", "7d_rolling_volatility", "future_returns",
    "mean_neg_sentiment", "mean_pos_sentiment",
]

FEATURES = T.StructType(
    SERIES.fields
    + [T.StructField("PCA1", T.DoubleType()), T.StructField("PCA2", T.DoubleType())]
    + [T.StructField(name, T.DoubleType()) for name in SENTIMENT_COLUMNS]
)
