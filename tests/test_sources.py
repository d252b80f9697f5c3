import json
import os
from datetime import date

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from almanac import session
from almanac.operators import items
from almanac.plans import ingest
from almanac.schemas import RAW_NEWS_PRICE
from almanac.session import scratch_path
from almanac.sources import feeds, tables


def documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "raw string")


def entry(title, url, stamp):
    return {"title": title, "url": url, "time_published": stamp, "other": 1}


def test_feed_documents_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"feed": [entry("t", "u", "20230601T101500")]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"Note": "limit"}))
    found = feeds.news_items(feeds.read_documents(spark, str(tmp_path)))
    assert [tuple(r) for r in found.collect()] == [("t", "u", "20230601T101500")]


def test_price_documents(spark):
    doc = {feeds.PRICE_KEY: {"2023-06-01": {feeds.CLOSE_KEY: "10.5", "1a": "2"}, "2023-06-02": {feeds.CLOSE_KEY: "11"}}}
    found = feeds.price_items(documents(spark, doc, {"Information": "x"}))
    assert sorted(tuple(r) for r in found.collect()) == [("2023-06-01", "10.5"), ("2023-06-02", "11")]


def test_index_snapshot(spark):
    found = feeds.index_snapshot(documents(spark, {"fgi": {"now": {"value": 70, "valueText": "Greed"}}}))
    assert [tuple(r) for r in found.collect()] == [(70, "Greed", "red")]


def test_union_pages_matches_by_name(spark):
    a = spark.createDataFrame([("t", "u")], "titles string, url string")
    b = spark.createDataFrame([("v", "s")], "url string, titles string")
    assert sorted(tuple(r) for r in feeds.union_pages(a, b).collect()) == [("s", "v"), ("t", "u")]


def test_items_since_takes_every_stamp_shape(spark):
    df = spark.createDataFrame([("20230601T235900",), ("20230602",), ("20230602T0001",)], "time_published string")
    assert feeds.items_since(df, F.lit("20230602T0000")).count() == 2
    assert feeds.items_since(df, F.lit(None).cast("string")).count() == 3


def test_feed_page_is_earliest_first(spark):
    df = spark.createDataFrame([(f"2023060{i}T000000", str(i)) for i in (3, 1, 2, 4)], "time_published string, url string")
    page = feeds.feed_page(df, F.lit("20230602T0000"), limit=2)
    assert [r["url"] for r in page.collect()] == ["2", "3"]


def test_drop_columns_refuses_unknown_names(spark):
    with pytest.raises(ValueError):
        tables.drop_columns(spark.range(1), "nope")


def test_replace_days_keeps_other_months(spark):
    path = scratch_path(spark, "days")
    first = spark.createDataFrame([(date(2023, 1, 1), 1.0), (date(2023, 2, 1), 2.0)], "time_published date, price double")
    tables.replace_days(first, path)
    tables.replace_days(first.where("price = 2").withColumn("price", F.lit(3.0)), path)
    assert sorted(r["price"] for r in tables.read_table(spark, path).collect()) == [1.0, 3.0]


def test_a_first_write_of_days_is_the_only_one(spark, monkeypatch):
    path = scratch_path(spark, "days")
    first = spark.createDataFrame([(date(2023, 1, 1), 1.0)], "time_published date, price double")
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: written.append(path) or parquet(self, path, *a, **k))
    tables.replace_days(first, path)
    assert written == [path]


def test_replace_days_by_day_leaves_other_days_where_they_are(spark):
    path = scratch_path(spark, "wide")
    rows = [(date(2023, 1, 1 + i % 3), i, "a" * i) for i in range(9)]
    first = spark.createDataFrame(rows, "time_published date, part int, text string")
    tables.replace_days(first, path, by_day=True)
    files = lambda: {f for f in spark.read.parquet(path).inputFiles() if "2023-01-02" not in f}
    before = files()
    for _ in range(2):
        tables.replace_days(first.where("part = 4").withColumn("text", F.lit("b")), path, by_day=True)
    assert files() == before
    found = sorted((r["time_published"], r["part"], r["text"]) for r in tables.read_table(spark, path).collect())
    assert found == sorted([r for r in rows if r[0].day != 2] + [(date(2023, 1, 2), 4, "b")])


def test_replace_days_keeps_other_days_of_the_month(spark):
    path = scratch_path(spark, "days")
    first = spark.createDataFrame([(date(2023, 1, d), float(d)) for d in (1, 2, 3)], "time_published date, price double")
    tables.replace_days(first, path)
    for _ in range(2):
        tables.replace_days(first.where("price = 3").withColumn("price", F.lit(9.0)), path)
    assert sorted(r["price"] for r in tables.read_table(spark, path).collect()) == [1.0, 2.0, 9.0]


def test_month_condition_reaches_the_scan(spark):
    path = scratch_path(spark, "days")
    days = spark.createDataFrame([(date(2023, m, 1), float(m)) for m in (1, 2, 3)], "time_published date, price double")
    tables.append(days, path)
    stored = tables.read_table(spark, path)
    since = tables.since_day(stored, F.lit(date(2023, 3, 1)))
    assert "PartitionFilters: [isnotnull(month" in since._jdf.queryExecution().executedPlan().toString()
    assert [r["price"] for r in since.collect()] == [3.0] == [r["price"] for r in tables.newest_month(stored).collect()]


def test_the_close_that_landed_last_stands(spark):
    rows = [("2023-01-01", "10.5", 1), ("2023-01-01", "9", 2), ("2023-01-02", "4", 1), ("2023-01-02", "junk", 2)]
    prices = spark.createDataFrame(rows, "date string, price string, landed int")
    assert sorted(tuple(r) for r in items.price_days(prices).collect()) == [(date(2023, 1, 1), 9.0), (date(2023, 1, 2), 4.0)]


def test_scratch_goes_at_the_end_and_kept_tables_stay(spark):
    with session.scratch(spark):
        inner = session.settle(spark.range(3))
        kept = session.keep(inner)
        gone = inner.inputFiles()[0]
    assert kept.count() == 3
    assert not os.path.exists(gone.removeprefix("file:").removeprefix("//"))


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session)


def landed(spark, *entries):
    return feeds.news_items(documents(spark, {"feed": list(entries)}))


def pages(spark, *urls):
    return spark.createDataFrame([(u, f"<p>{u}</p>") for u in urls], "url string, html string")


def prices(spark):
    return spark.createDataFrame([("2023-06-01", "10.125"), ("2023-06-02", "11.0")], "date string, price string")


def test_ingest_end_to_end(spark):
    news = landed(
        spark, entry("a", "u1", "20230601T101500"), entry("a", "u2", "20230602T101500"), entry(None, "u3", "20230601T0900"),
        entry("b", "u4", "junk"), entry("c", "u5", "20230603"), entry("d", "gone", "20230602"),
    )
    found = ingest.ingest(news, prices(spark), pages(spark, "u1", "u2", "u3", "u4", "u5"))
    assert found.columns == RAW_NEWS_PRICE.names
    assert sorted((r["titles"] or "", r["url"], r["price"], r["content"]) for r in found.collect()) == [
        ("", "u3", 10.12, "u3"), ("a", "u1", 10.12, "u1"),
    ]
    assert items.rejects(news).count() == 1


def test_rerun_adds_nothing_and_new_items_are_added_once(spark):
    path = scratch_path(spark, "raw")
    first = [entry("a", "u1", "20230601T101500"), entry("b", "u2", "20230602T090000")]
    later = [entry("a", "u3", "20230602T110000"), entry("c", "u4", "20230602T120000"), entry("x", "u5", "20230601T120000")]
    all_pages = pages(spark, "u1", "u2", "u3", "u4", "u5")
    for feed in (first, first, first + later, first + later):
        ingest.run_ingest(spark, landed(spark, *feed), prices(spark), all_pages, path)
    stored = tables.read_table(spark, path, RAW_NEWS_PRICE)
    # "x" lands after items of a later day, and is stored like any other.
    assert sorted(r["titles"] for r in stored.collect()) == ["a", "b", "c", "x"]


def test_items_wait_for_late_pages_and_prices(spark):
    path = scratch_path(spark, "raw")
    found = spark.createDataFrame(
        [("x", "ux", "20230101T010000"), ("y", "uy", "20230103T010000"), ("z", "uz", "20230102T010000"), ("bad", "ub", "soon")],
        "titles string, url string, time_published string",
    )
    pages = spark.createDataFrame([(u, "<p>words</p>") for u in ("ux", "uy", "uz")], "url string, html string")
    prices = spark.createDataFrame([("2023-01-01", "1"), ("2023-01-03", "3"), ("2023-01-02", "2")], "date string, price string")

    def stored():
        return sorted(r["titles"] for r in tables.read_table(spark, path, RAW_NEWS_PRICE).collect())

    ingest.run_ingest(spark, found, prices.where("date != '2023-01-02'"), pages.where("url != 'ux'"), path)
    assert stored() == ["y"]
    ingest.run_ingest(spark, found, prices, pages, path)
    assert stored() == ["x", "y", "z"]
    ingest.run_ingest(spark, found, prices, pages, path)
    assert stored() == ["x", "y", "z"]
    assert [r["titles"] for r in spark.read.parquet(f"{path}-rejects").collect()] == ["bad"]


def test_keep_first_and_missing_titles(spark):
    df = spark.createDataFrame(
        [("t", 2, "b"), ("t", 1, "z"), ("t", 1, "a"), (None, 3, "c"), (None, 4, "d")], "titles string, time int, url string"
    )
    assert sorted(items.keep_first(df, "titles", ["time", "url"]).collect(), key=str) == sorted(
        [("t", 1, "a"), (None, 3, "c")], key=str
    )


def test_not_stored_treats_missing_keys_as_equal(spark):
    batch = spark.createDataFrame([("a",), (None,), ("b",)], "titles string")
    stored = spark.createDataFrame([("a",), (None,), ("a",)], "titles string")
    assert [r[0] for r in items.not_stored(batch, stored).collect()] == ["b"]


def test_latest_pages(spark):
    df = spark.createDataFrame([("u", 1, "old"), ("u", 2, "new"), ("v", 1, "x")], "url string, n int, html string")
    assert sorted(tuple(r) for r in items.latest_pages(df, "n").collect()) == [("u", "new"), ("v", "x")]
