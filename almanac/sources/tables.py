"""Stored tables: declared-schema scans, the high-water mark, and the two kinds of write."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from almanac.session import scratch, settle


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan of a stored Parquet table; rows have no order until the caller sorts them."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan out to all cores when it has too few splits to use them.

    A large table has many splits and comes back unchanged; only a table in one or two small files is
    shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def high_water(df: DataFrame, column: str = "time_published") -> DataFrame:
    """One row: the latest value stored."""
    return df.agg(F.max(column).alias("latest"))


def _with_month(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("month", F.date_format(day, "yyyy-MM"))


def stored_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A stored table, or None where nothing has been written yet."""
    try:
        found = read_table(spark, path, schema)
        return None if found.isEmpty() else found
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def since_day(stored: DataFrame, first: Column, day: str = "time_published") -> DataFrame:
    """Rows from a day on, with the month condition that lets the scan skip whole months."""
    return stored.where((F.col("month") >= F.date_format(first, "yyyy-MM")) & (F.col(day) >= first))


def newest_month(stored: DataFrame) -> DataFrame:
    """Rows of the last month: the high-water mark is among them. Only folder names are read to find it."""
    return stored.where(F.col("month") == stored.agg(F.max("month")).scalar())


def append(df: DataFrame, path: str, day: str = "time_published", files: int = 8) -> None:
    """Add new items to a stored table, laid out by month; a month gets at most `files` files a write.

    A reader that filters by day names the month too (`since_day`), which is what skips files.
    """
    dealt = _with_month(df, day).withColumn("_file", F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    dealt.repartition("month", "_file").drop("_file").write.mode("append").partitionBy("month").parquet(path)


def replace_days(df: DataFrame, path: str, day: str = "time_published", by_day: bool = False) -> None:
    """Write a derived table; the days of `df` replace their stored rows, all other days stay.

    The months that `df` touches are rewritten with their other days, so a rerun adds nothing and a partial
    rerun loses nothing. For derived tables of one row a day; a month of them is small. A wide table is laid out
    `by_day`: a day has a folder of its own, and no other day is read or written again. A path keeps its layout.
    """
    spark = df.sparkSession
    if by_day:
        _replace_folders(df.withColumn("day_folder", F.date_format(day, "yyyy-MM-dd")), path, "day_folder")
        return
    with scratch(spark):
        new, stored = _with_month(df, day), stored_table(spark, path)
        if stored is not None:
            new = settle(new)
            months, days = (F.broadcast(new.select(c).distinct()) for c in ("month", day))
            others = stored.join(months, "month", "left_semi").join(days, day, "left_anti")
            new = new.unionByName(others.select(*new.columns))
        _replace_folders(new, path, "month")


def _replace_folders(df: DataFrame, path: str, folder: str) -> None:
    # Folders are written beside the stored ones, which go when all are done: their rows may be read until then.
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop that refuses names the table does not have."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)
