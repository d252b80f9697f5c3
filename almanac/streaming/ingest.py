"""Incremental ingest of landed items as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from almanac.operators.items import keep_first
from almanac.session import children, scratch, settle
from almanac.sources import seen


def item_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """Files landing in a folder, with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def first_within(stream: DataFrame, stamp: str, key: str = "titles", delay: str = "2 days") -> DataFrame:
    """First item per key while its state is kept; items later than the delay may pass again.

    For bounded state. `stamp` must be a timestamp. All copies of a key reach one state task; the
    table-backed ingest below has neither that limit nor a late rule.
    """
    return stream.withWatermark(stamp, delay).dropDuplicatesWithinWatermark([key])


def append_new(
    stream: DataFrame, path: str, checkpoint: str, key: str = "titles", order: tuple[str, ...] = ("published_at", "url")
) -> StreamingQuery:
    """Appends the first item per key that the table does not hold yet, then stops.

    The keys that are stored are the state, at `path`-seen in buckets by hash: a batch reads those that its own keys
    fall into, nothing is dropped for being late, and copies of one key collapse before they are shuffled. A
    batch owns one folder of rows and one of keys, named after the query's progress and the batch, and rewrites
    both when it is repeated after a failure. A query that has lost its progress is another query: its batches are
    held against all others, so every item is stored once.
    """
    spark, root = stream.sparkSession, f"{path}-seen"
    # Rows whose keys were not recorded: a batch was lost between the two, or the table is older than the buckets.
    recorded = seen.recorded(spark, root)
    for name in children(spark, path):
        own = name.removeprefix("batch=")
        if own != name and own not in recorded and "_SUCCESS" in children(spark, f"{path}/{name}"):
            seen.record(spark.read.parquet(f"{path}/{name}"), root, key, own)
    seen.compact(spark, root)

    def store(batch: DataFrame, batch_id: int) -> None:
        own = f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}.{batch_id}"
        with scratch(batch.sparkSession):
            fresh = seen.unseen(settle(keep_first(batch, key, list(order))), root, key, but=own)
            fresh.write.mode("overwrite").parquet(f"{path}/batch={own}")
            seen.record(batch.sparkSession.read.parquet(f"{path}/batch={own}"), root, key, own)

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
