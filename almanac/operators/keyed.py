"""Joins and broadcasts that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from almanac.operators.naming import unused
from almanac.session import settle

# Rows of one key that a task may get, and the keys that may be listed as having more.
PARTITION_ROWS = 1_000_000
MOST_HOT = 100_000
KEYLESS_SHARES = 1024


def broadcast_days(df: DataFrame, day: str) -> DataFrame:
    """Broadcast hint for a table with one row per day.

    The bound is the calendar: a DateType runs from year 1 to 9999, 3.7 million values at most, so a
    narrow table keyed by day is at most a few hundred megabytes whatever the size of its source.
    """
    if not isinstance(df.schema[day].dataType, DateType):
        raise TypeError(f"{day} must be a date for the calendar bound to hold")
    return F.broadcast(df)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only when the table is counted to hold at most `rows` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def dealt(counts: DataFrame, rows: int, limit: int = PARTITION_ROWS) -> DataFrame:
    """(key, shares), settled: the keys of (key, count) that hold more rows than one task should, with how many it takes.

    A task should get at most `limit` rows of one key, whatever share of the whole that is. Where the rows are so many
    that MOST_HOT keys could exceed it, the limit rises with them, so the list stays small.
    """
    most = max(limit, rows // MOST_HOT)
    found = counts.where(F.col("key").isNotNull() & (F.col("count") > most))
    return settle(found.select("key", F.ceil(F.col("count") / most).cast("int").alias("shares")))


def hot_keys(df: DataFrame, key: str, limit: int = PARTITION_ROWS) -> DataFrame:
    """(key, shares) of the keys with more than `limit` rows."""
    counts = settle(df.groupBy(F.col(key).alias("key")).count())
    return dealt(counts, counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0], limit)


def split_join(facts: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Join `facts` to a table unique by `key` without sending a hot key to one task.

    `hot` is (key, shares) as `hot_keys` gives it. The rows of a hot key are dealt over its shares, and its lookup row
    is copied to each, however wide it is; all other rows have one share. Rows without a key meet nothing and are
    dealt over many tasks.
    """
    if hot.isEmpty():
        return facts.join(lookup, key, how)
    name, shares, share = unused([*facts.columns, *lookup.columns], "key", "shares", "share")
    named = F.broadcast(hot.select(F.col("key").alias(name), F.col("shares").alias(shares)))
    many = F.when(F.col(key).isNull(), KEYLESS_SHARES).otherwise(F.coalesce(shares, F.lit(1)))
    spread = facts.join(named, F.col(key) == F.col(name), "left").withColumn(share, F.pmod(F.monotonically_increasing_id(), many).cast("int"))
    copied = lookup.join(named, F.col(key) == F.col(name), "left")
    copied = copied.withColumn(share, F.explode(F.sequence(F.lit(0), F.coalesce(shares, F.lit(1)) - 1)))
    met = spread.drop(name, shares).join(copied.drop(name, shares), [key, share], how)
    return met.drop(share)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, rows: int, how: str = "left", limit: int = PARTITION_ROWS
) -> DataFrame:
    """Join to a table unique by `key`: a broadcast when it is counted to be small, else split by hot keys."""
    if lookup.limit(rows + 1).count() <= rows:
        return facts.join(F.broadcast(lookup), key, how)
    return split_join(facts, lookup, key, hot_keys(facts, key, limit), how)
