from datetime import datetime

from almanac.catalog import relational
from almanac.operators.items import keep_first
from almanac.session import scratch_path
from almanac.streaming import ingest

SCHEMA = "titles string, url string, published_at string"


def drops(spark):
    first = [("a", "u1", "20230601T01"), ("a", "u0", "20230601T02"), ("b", "u2", "20230601T03"), (None, "u3", "20230601T04")]
    second = [("b", "u4", "20230602T01"), ("c", "u5", "20230602T02"), (None, "u6", "20230602T03"), ("c", "u7", "20230602T04")]
    return [spark.createDataFrame(rows, SCHEMA) for rows in (first, second)]


def test_two_drops_equal_the_batch_result(spark):
    landing, out, progress = (scratch_path(spark, n) for n in ("landing", "out", "progress"))
    for drop in drops(spark):
        drop.write.mode("append").parquet(landing)
        ingest.append_new(ingest.item_stream(spark, landing, SCHEMA), out, progress).awaitTermination()
    ingest.append_new(ingest.item_stream(spark, landing, SCHEMA), out, progress).awaitTermination()
    first, second = drops(spark)
    batch = keep_first(first.unionByName(second), "titles", ["published_at", "url"])
    columns = ["titles", "url", "published_at"]
    found = spark.read.parquet(out).select(*columns)
    assert sorted(found.collect(), key=str) == sorted(batch.select(*columns).collect(), key=str)


def test_one_file_per_batch_gives_the_same_titles(spark):
    landing, out, progress = (scratch_path(spark, n) for n in ("landing", "out", "progress"))
    for drop in drops(spark):
        drop.coalesce(1).write.mode("append").parquet(landing)
    stream = ingest.item_stream(spark, landing, SCHEMA, files_per_batch=1)
    ingest.append_new(stream, out, progress).awaitTermination()
    found = spark.read.parquet(out)
    assert found.select("batch").distinct().count() == 2
    assert sorted(str(r["titles"]) for r in found.collect()) == ["None", "a", "b", "c"]


def test_a_repeated_batch_rewrites_its_own_rows(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    drops(spark)[0].write.mode("append").parquet(landing)
    for _ in range(2):
        stream = ingest.item_stream(spark, landing, SCHEMA)
        ingest.append_new(stream, out, scratch_path(spark, "lost-progress")).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_two_batches_after_lost_progress_store_nothing_twice(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    for drop in drops(spark):
        drop.coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):
        stream = ingest.item_stream(spark, landing, SCHEMA, files_per_batch=1)
        ingest.append_new(stream, out, scratch_path(spark, "lost-progress")).awaitTermination()
    assert sorted(str(r["titles"]) for r in spark.read.parquet(out).collect()) == ["None", "a", "b", "c"]


def test_watermark_dedupe(spark):
    landing, out, progress = (scratch_path(spark, n) for n in ("landing", "out", "progress"))
    rows = [("a", datetime(2023, 6, 1)), ("a", datetime(2023, 6, 1)), ("b", datetime(2023, 6, 2))]
    for _ in range(2):
        spark.createDataFrame(rows, "titles string, at timestamp").write.mode("append").parquet(landing)
        stream = ingest.first_within(ingest.item_stream(spark, landing, "titles string, at timestamp"), "at")
        writer = stream.writeStream.option("path", out).option("checkpointLocation", progress)
        writer.format("parquet").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["titles"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_restart_lands_drops_in_several_files(spark, monkeypatch):
    batches = []
    monkeypatch.setattr(ingest, "item_stream", lambda *a, how=ingest.item_stream, files_per_batch: batches.append(files_per_batch) or how(*a, files_per_batch))
    found = relational.stream_restart(spark, "/root/testdata/sf0.001").collect()
    assert batches[0] > 1 and batches == batches[:1] * 2
    assert {r["copies"] for r in found} == {1}
