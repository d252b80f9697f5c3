"""Small pieces shared by the operators: shared-folder tables, checked broadcasts, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_ROWS = 200_000
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def texts_to_python(docs: DataFrame) -> DataFrame:
    """`docs`, with the session's Arrow batches set to BATCH_ROWS rows where they had Spark's default of 10,000.

    A batch is held several times over between Spark and Python, and texts are long.
    """
    conf = docs.sparkSession.conf
    if conf.get(_BATCH) == "10000":
        conf.set(_BATCH, BATCH_ROWS)
    return docs


def text_of(name: str = "text") -> Column:
    """The text column as a string, a null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def folded(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a narrow table that is counted to have at most `rows` rows; else the table as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def row_key(*columns: Column) -> list[Column]:
    """Two 64-bit hashes that stand for the values of a row, nulls included."""
    return [F.xxhash64(*columns).alias("_k1"), F.xxhash64(F.lit(7), *columns).alias("_k2")]


def most_frequent(df: DataFrame, column: str, most: int) -> DataFrame:
    """The rows whose count in `column` is so high that at most `most` rows have as high a one.

    Found from how many rows have each count, so no task or driver sorts the rows themselves.
    """
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc(column)).toArrow()
    kept, least = 0, None
    for count, rows in zip(sizes[column].to_pylist(), sizes["n"].to_pylist()):
        kept += rows
        if kept > most:
            break
        least = count
    return df.where(F.col(column) >= F.lit(least)) if least is not None else df.where(F.lit(False))
