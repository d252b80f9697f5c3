import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from almanac import session
from almanac.operators import items
from almanac.operators.naming import unused
from almanac.plans import ingest
from almanac.schemas import RAW_NEWS_PRICE
from almanac.session import children, scratch_path
from almanac.sources import seen, tables
from almanac.streaming import ingest as streams

NEWS = "titles string, url string, time_published string"


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "titles string")


def left(df):
    return sorted(str(r["titles"]) for r in df.collect())


def test_unseen_leaves_out_what_any_other_run_recorded(spark):
    root = scratch_path(spark, "seen")
    batch = keys(spark, "a", "b", None, "", "c")
    assert left(seen.unseen(batch, root, "titles")) == left(batch)
    seen.record(keys(spark, "a", "a", None), root, "titles", "q.0")
    seen.record(keys(spark, "b"), root, "titles", "q.1")
    assert left(seen.unseen(batch, root, "titles")) == ["", "c"]
    assert left(seen.unseen(batch, root, "titles", but="q.1")) == ["", "b", "c"]
    seen.record(keys(spark, "c"), root, "titles", "q.1")  # a repeated run replaces its keys
    assert left(seen.unseen(batch, root, "titles")) == ["", "b"]


def test_columns_named_like_the_hashes_stay(spark):
    root = scratch_path(spark, "seen")
    batch = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "titles string, h1 int, bucket int")
    seen.record(batch.where("h1 = 1"), root, "titles", "q.0")
    assert [tuple(r) for r in seen.unseen(batch, root, "titles").collect()] == [("b", 3, 4)]


def test_only_touched_buckets_are_read(spark):
    root = scratch_path(spark, "seen")
    seen.record(keys(spark, *[f"t{i}" for i in range(3000)]), root, "titles", "q.0")
    batch = seen.keys_of(keys(spark, "t5", "new"), "titles")
    buckets = {r["bucket"] for r in batch.collect()}
    found = seen.held(spark, root, batch)
    condition = re.search(r"PartitionFilters: \[.*?bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", found._jdf.queryExecution().executedPlan().toString())
    assert {int(b) for b in (condition[1] or condition[2]).split(",")} == buckets
    assert {r[0] for r in found.select(F.regexp_extract(F.input_file_name(), "bucket=([0-9]+)", 1).cast("int")).distinct().collect()} <= buckets
    fresh = seen.unseen(keys(spark, "t5", "new"), root, "titles")
    assert left(fresh) == ["new"]


def test_compaction_keeps_every_key_and_the_last_run_of_a_writer(spark):
    root = scratch_path(spark, "seen")
    names = [f"k{i}" for i in range(12)]
    for i, name in enumerate(names):
        seen.record(keys(spark, name), root, "titles", f"q.{i}")
    seen.compact(spark, root, most=4)
    assert seen.recorded(spark, root) == {f"q.{i}" for i in range(12)} | {"merged.1"}
    assert left(seen.unseen(keys(spark, "x", *names), root, "titles")) == ["x"]
    assert left(seen.unseen(keys(spark, *names), root, "titles", but="q.11")) == ["k11"]
    live = [r for r in seen.recorded(spark, root) if any(c.startswith("bucket=") for c in children(spark, f"{root}/run={r}"))]
    assert sorted(live) == ["merged.1", "q.11"]
    for i in range(12, 20):
        seen.record(keys(spark, f"k{i}"), root, "titles", f"q.{i}")
    seen.compact(spark, root, most=4)
    assert left(seen.unseen(keys(spark, *[f"k{i}" for i in range(21)]), root, "titles")) == ["k20"]


def news(spark, *rows):
    return spark.createDataFrame(list(rows), NEWS)


def pages(spark):
    return spark.createDataFrame([(f"u{i}", "<p>words</p>") for i in range(9)], "url string, html string")


def prices(spark):
    return spark.createDataFrame([(f"2023-01-0{i}", f"{i}") for i in range(1, 6)], "date string, price string")


def titles(spark, path):
    return left(tables.read_table(spark, path, RAW_NEWS_PRICE))


def test_an_item_that_lands_late_is_stored_once(spark):
    path = scratch_path(spark, "raw")
    ingest.run_ingest(spark, news(spark, ("a", "u1", "20230103T010000")), prices(spark), pages(spark), path)
    late = news(spark, ("b", "u2", "20230101T010000"), ("a", "u3", "20230101T020000"))
    for _ in range(2):
        ingest.run_ingest(spark, late, prices(spark), pages(spark), path)
    assert titles(spark, path) == ["a", "b"]
    assert spark.read.parquet(f"{path}-waiting").isEmpty()


def test_a_title_waits_by_its_priced_and_by_its_unpriced_copy(spark):
    path = scratch_path(spark, "raw")
    found = news(spark, ("a", "u1", "20230109"), ("a", "nowhere", "20230102"), ("b", "u2", "20230109"), ("b", "u3", "20230103"))
    ingest.run_ingest(spark, found, prices(spark), pages(spark), path)
    assert titles(spark, path) == ["b"]
    assert sorted(r["url"] for r in spark.read.parquet(f"{path}-waiting").collect()) == ["nowhere", "u1"]
    more = spark.createDataFrame([("nowhere", "<p>here</p>")], "url string, html string").unionByName(pages(spark))
    ingest.run_ingest(spark, found.limit(0), prices(spark), more, path)
    assert titles(spark, path) == ["a", "b"]
    assert spark.read.parquet(f"{path}-waiting").isEmpty()


@pytest.mark.parametrize("lost_before", ["append", "record", "delete"])
def test_a_run_that_ends_early_is_finished_by_the_next(spark, monkeypatch, lost_before):
    path = scratch_path(spark, "raw")
    found = news(spark, ("a", "u1", "20230101"), ("b", "u2", "20230102"))
    ingest.run_ingest(spark, found.limit(1), prices(spark), pages(spark), path)

    def lost(*_, **__):
        raise OSError("lost")

    place = {"append": (tables, "append"), "record": (seen, "record"), "delete": (ingest, "delete")}[lost_before]
    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr(*place, lost)
        ingest.run_ingest(spark, found, prices(spark), pages(spark), path)
    for _ in range(2):
        ingest.run_ingest(spark, found, prices(spark), pages(spark), path)
    assert titles(spark, path) == ["a", "b"]


def test_a_table_without_buckets_gets_them(spark):
    path = scratch_path(spark, "raw")
    ingest.run_ingest(spark, news(spark, ("a", "u1", "20230101")), prices(spark), pages(spark), path)
    session.delete(spark, f"{path}-seen")
    ingest.run_ingest(spark, news(spark, ("a", "u1", "20230101"), ("b", "u2", "20230101")), prices(spark), pages(spark), path)
    assert titles(spark, path) == ["a", "b"]


def test_a_stream_batch_lost_between_rows_and_keys_is_stored_once(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    news(spark, ("a", "u1", "1"), ("b", "u2", "2")).write.parquet(landing)
    order = ("time_published", "url")
    for lost in (False, True, True):
        if lost:
            session.delete(spark, f"{out}-seen")
        stream = streams.item_stream(spark, landing, NEWS)
        streams.append_new(stream, out, scratch_path(spark, "progress"), order=order).awaitTermination()
    assert left(spark.read.parquet(out)) == ["a", "b"]


def test_keep_first_sorts_no_contents(spark):
    rows = [("t", 2, "x" * 50), ("t", 1, "z"), (None, 3, "c"), (None, 1, "d"), ("u", 5, None)]
    df = spark.createDataFrame(rows, "titles string, row int, content string")
    found = items.keep_first(df, "titles", ["row"])
    plan = found._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan
    assert sorted(map(str, found.collect())) == sorted(map(str, [df.collect()[i] for i in (1, 3, 4)]))


@pytest.mark.parametrize("few", [0, 500_000])
def test_keep_first_with_many_copies(spark, monkeypatch, few):
    monkeypatch.setattr(items, "LOST_BROADCAST_ROWS", few)
    df = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('t', id % 100)) AS titles").repartition(5)
    found = {r["titles"]: r["id"] for r in items.keep_first(df, "titles", ["id"]).collect()}
    want = {}
    for i in range(1000):
        want.setdefault("hot" if i % 3 == 0 else f"t{i % 100}", i)
    assert found == want


def test_unused_names():
    assert unused(["row", "_ROW", "x"], "row", "row", "y") == ["__row", "___row", "y"]


def test_scopes_of_threads_do_not_meet(spark):
    def run(n):
        with session.scratch(spark):
            one = session.settle(spark.range(n))
            two = session.keep(session.settle(one.where("id % 2 = 0")))
            return one.count(), two

    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(run, range(10, 22)))
    assert [(n, two.count()) for n, two in found] == [(n, (n + 1) // 2) for n in range(10, 22)]
