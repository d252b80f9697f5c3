"""Registered queries over sources, items, the daily series and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.catalog.tables import (
    NEWS_SITE, NEWS_DAYS, event_prices, lexicon, news, order_news, order_prices, priced_news, rounded, stamped_news, table,
)
from almanac.functions import dates, scalars, text
from almanac.operators import items, labels, metrics, rollup, sentiment, series
from almanac.plans import daily, features, ingest, reports
from almanac.schemas import RAW_NEWS_PRICE
from almanac.session import children, scratch_path, settle
from almanac.sources import feeds, seen, tables
from almanac.streaming import ingest as streams

SERIES_COLUMNS = [
    "price", "lagged_price", "returns", "3d_rolling_volatility", "7d_rolling_volatility", "future_returns",
]


def daily_series_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = settle(items.keep_first(priced_news(spark, sf_dir), "titles", ["doc_id"]))
    days = daily.daily_table(raw, order=["doc_id"])
    hashed = days.withColumns({"titles": F.md5("titles"), "content": F.md5("content")})
    return rounded(hashed, *SERIES_COLUMNS)


def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumnRenamed("lang", "language")
    return tables.drop_columns(documents, "text").select("doc_id", "language", "n_chars")


def _price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    quote = F.create_map(F.lit(feeds.CLOSE_KEY), F.col("price").cast("string"))
    entry = F.create_map(F.col("date").cast("string"), quote).alias(feeds.PRICE_KEY)
    return event_prices(spark, sf_dir).select(F.to_json(F.struct(entry)).alias("raw"))


def _news_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("titles").alias("title"), "url", "time_published")
    return stamped_news(spark, sf_dir).select(F.to_json(F.struct(F.array(item).alias("feed"))).alias("raw"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.concat(F.lit(NEWS_SITE), F.col("page_id")).alias("url"), "html")


def _raw_table(df: DataFrame) -> DataFrame:
    return df.withColumn("content", F.md5("content")).select(*RAW_NEWS_PRICE.names)


def pipeline_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = feeds.news_items(_news_documents(spark, sf_dir))
    prices = feeds.price_items(_price_documents(spark, sf_dir))
    return _raw_table(ingest.ingest(found, prices, _pages(spark, sf_dir)))


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after two identical ingest runs: the second adds nothing."""
    path = scratch_path(spark, "raw")
    found = feeds.news_items(_news_documents(spark, sf_dir))
    prices = feeds.price_items(_price_documents(spark, sf_dir))
    for _ in range(2):
        ingest.run_ingest(spark, found, prices, _pages(spark, sf_dir), path)
    return _raw_table(tables.read_table(spark, path, RAW_NEWS_PRICE))


def replace_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series table after a full run with other prices of three days, and a run of those days alone."""
    path = scratch_path(spark, "series")
    days = settle(daily.daily_series(priced_news(spark, sf_dir)))
    some = F.dayofmonth("time_published").isin(3, 4, 20)
    tables.replace_days(days.withColumn("price", F.when(~some, F.col("price"))), path)
    tables.replace_days(days.where(some), path)
    return rounded(tables.read_table(spark, path).drop("month"), *SERIES_COLUMNS)


def late_page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after two runs: the pages of every third item land only for the second."""
    path = scratch_path(spark, "raw")
    found = settle(feeds.news_items(_news_documents(spark, sf_dir)))
    prices = feeds.price_items(_price_documents(spark, sf_dir))
    pages = _pages(spark, sf_dir)
    late = F.pmod(F.substring_index("url", "/", -1).cast("long"), F.lit(3)) == 0
    ingest.run_ingest(spark, found, prices, pages.where(~late), path)
    ingest.run_ingest(spark, found, prices, pages, path)
    return _raw_table(tables.read_table(spark, path, RAW_NEWS_PRICE))


def late_item_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after two runs: the items of the first ten days land only for the second, after later ones."""
    path = scratch_path(spark, "raw")
    found = settle(feeds.news_items(_news_documents(spark, sf_dir)))
    prices = feeds.price_items(_price_documents(spark, sf_dir))
    late = F.pmod(F.substring_index("url", "/", -1).cast("long"), F.lit(30)) < 10
    ingest.run_ingest(spark, found.where(~late), prices, _pages(spark, sf_dir), path)
    for _ in range(2):
        ingest.run_ingest(spark, found.where(late), prices, _pages(spark, sf_dir), path)
    return _raw_table(tables.read_table(spark, path, RAW_NEWS_PRICE))


def bucketed_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose id no run has recorded, when two runs recorded two thirds of the ids and one of them twice."""
    root = scratch_path(spark, "seen")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    for name, share in (("a.0", 0), ("a.1", 1), ("a.1", 1)):
        seen.record(events.where(F.col("event_id") % 3 == share), root, "event_id", name)
    return seen.unseen(events, root, "event_id")


def rejected_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that a run puts aside because their stamp cannot be read: those of odd documents here."""
    path = scratch_path(spark, "raw")
    found = settle(feeds.news_items(_news_documents(spark, sf_dir)))
    odd = F.pmod(F.substring_index("url", "/", -1).cast("long"), F.lit(2)) == 1
    broken = found.withColumn("time_published", F.when(odd, F.concat(F.lit("day "), "time_published")).otherwise(F.col("time_published")))
    ingest.run_ingest(spark, broken, feeds.price_items(_price_documents(spark, sf_dir)), _pages(spark, sf_dir), path)
    return spark.read.parquet(f"{path}-rejects").select("url", "time_published", F.md5("titles").alias("titles"))


def price_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes per day when every order of a day is a later revision of it: the last one stands."""
    orders = table(spark, sf_dir, "orders")
    quote = F.create_map(F.lit(feeds.CLOSE_KEY), F.col("o_totalprice").cast("string"))
    entry = F.create_map(F.to_date("o_orderdate").cast("string"), quote).alias(feeds.PRICE_KEY)
    documents = orders.select(F.timestamp_seconds("o_orderkey").alias("landed"), F.to_json(F.struct(entry)).alias("raw"))
    return items.price_days(feeds.price_items(documents))


def repeated_items_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks per day where every item is stored twice: each copy keeps its own words."""
    raw = priced_news(spark, sf_dir)
    chunks = sentiment.day_chunks(raw.unionAll(raw), ["doc_id"])
    return chunks.groupBy("time_published").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.size("words")).cast("long").alias("n_words")
    )


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("time_published"), "ts")
    stamp = F.date_format(F.max("ts"), "yyyyMMdd'T'HHmmss")
    latest = tables.high_water(events).withColumn("cursor", dates.api_stamp(F.col("latest")))
    return latest.withColumn("page_cursor", events.agg(dates.cursor_day_floor(stamp)).scalar())


def feed_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed document per text, one item per line; documents without a feed add nothing."""
    documents = news(spark, sf_dir)
    entries = F.transform(
        F.split("content", "\n"),
        lambda line, i: F.struct(
            line.alias("title"),
            F.concat_ws("#", F.col("url"), i.cast("string")).alias("url"),
            F.date_format("time_published", "yyyyMMdd").alias("time_published"),
        ),
    )
    filled = documents.select(F.to_json(F.struct(entries.alias("feed"))).alias("raw"))
    refused = documents.select(F.to_json(F.struct(F.col("url").alias("Note"))).alias("raw"))
    found = feeds.union_pages(feeds.news_items(filled), feeds.news_items(refused))
    return found.withColumn("titles", F.md5("titles"))


def price_map_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price document per customer and order, flattened to typed rows."""
    orders = table(spark, sf_dir, "orders")
    quote = F.create_map(F.lit(feeds.CLOSE_KEY), F.col("o_totalprice").cast("string"))
    entry = F.create_map(F.to_date("o_orderdate").cast("string"), quote).alias(feeds.PRICE_KEY)
    entries = feeds.price_items(orders.select(F.to_json(F.struct(entry)).alias("raw")))
    return entries.select(dates.iso_date(F.col("date")).alias("date"), scalars.to_double(F.col("price")).alias("price"))


def json_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.get_json_object("props", "$.k").cast("int").alias("value")
    now = F.struct(level, F.col("event_type").alias("valueText")).alias("now")
    document = F.to_json(F.struct(F.struct(now).alias("fgi"))).alias("raw")
    return reports.index_gauge(table(spark, sf_dir, "events").select("event_id", document))


def _event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("ts", "yyyyMMdd'T'HHmmss")
    return table(spark, sf_dir, "events").select("event_id", stamp.alias("time_published"), "ts")


def incremental_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items a poll adds when everything up to noon of the last day is stored."""
    events = _event_items(spark, sf_dir)
    noon = events.agg(F.to_timestamp_ntz(F.max(F.to_date("ts")).cast("string")) + F.expr("interval 12 hours")).scalar()
    stored = events.where(F.col("ts") < noon).select("event_id", F.to_date("ts").alias("day"))
    found = feeds.items_since(events.drop("ts"), feeds.poll_cursor(stored, "day"))
    return items.not_stored(found, stored, "event_id")


def feed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's own page: the earliest 1000 items from the cursor on."""
    events = _event_items(spark, sf_dir).drop("ts")
    cursor = events.agg(dates.cursor_day_floor(F.min("time_published"))).scalar()
    return feeds.feed_page(events, cursor)


def compact_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")

    def parsed(form: str):
        return dates.compact_date(F.date_format("ts", form))

    return events.select(
        "event_id",
        parsed("yyyyMMdd'T'HHmmss").alias("from_seconds"),
        parsed("yyyyMMdd'T'HHmm").alias("from_minutes"),
        parsed("yyyyMMdd").alias("from_day"),
        dates.compact_date(F.col("event_type")).alias("from_junk"),
        dates.iso_date(F.date_format("ts", "yyyy-MM-dd")).alias("from_iso"),
        F.to_date(dates.as_timestamp(F.col("ts").cast("string"))).alias("from_timestamp"),
    )


def round_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", scalars.round_price(unit.cast("string")).alias("price")
    )


def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("titles"))
    return items.keep_first(documents, "titles", ["doc_id"]).withColumn("titles", F.md5("titles"))


def drop_null_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only documents with a label keep their content; the rest has none and is dropped."""
    judged = news(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    found = judged.withColumn("content", F.when(F.col("quality").isNotNull(), F.col("content")))
    kept = found.na.drop(subset=["content"])
    return kept.select(
        "doc_id",
        F.md5(text.combined_text(F.col("titles"), F.col("content"))).alias("combined"),
        scalars.text_or_empty(F.col("toxic")).alias("toxic"),
    )


def news_price_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(priced_news(spark, sf_dir).select("doc_id", "time_published", "price"), "price")


def daily_text_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = rollup.daily_rollup(priced_news(spark, sf_dir), ["doc_id"]).orderBy("time_published")
    hashed = days.select(
        "time_published", F.length("content").cast("long").alias("n_chars"),
        F.md5("titles").alias("titles"), F.md5("content").alias("content"), "price",
    )
    return rounded(hashed, "price")


def _order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.with_returns(order_prices(spark, sf_dir))


def lag_lead_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_series(spark, sf_dir).select("time_published", "day_of_week", "lagged_price", "returns", "future_returns")
    return rounded(days, "lagged_price", "returns", "future_returns")


def rolling_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["3d_rolling_volatility", "7d_rolling_volatility"]
    return rounded(_order_series(spark, sf_dir).select("time_published", *columns), *columns)


def rolling_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.rolling_returns(_order_series(spark, sf_dir)), "rolling_mean")


def price_vs_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = settle(order_news(spark, sf_dir, NEWS_DAYS))
    scores = features.day_sentiment(raw, sentiment.lexicon_scorer(lexicon(spark)), ["doc_id"])
    days = daily.daily_series(raw).join(scores, "time_published", "left")
    return rounded(reports.price_and_spread(days), "price", "spread")


def correlation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["price", "day_of_week", "returns", "3d_rolling_volatility", "7d_rolling_volatility", "future_returns"]
    return rounded(reports.correlations(_order_series(spark, sf_dir), columns), "correlation")


def return_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labels.label_returns(_order_series(spark, sf_dir))
    return labelled.select("time_published", "return_class", "return_class_encoded")


def edge_trim_and_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = series.with_target(series.trim_edges(_order_series(spark, sf_dir)))
    flagged = series.with_position(series.chronological_split(inner))
    return flagged.select("time_published", F.col("position").cast("long"), "is_train")


def expanding_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.expanding_folds(order_prices(spark, sf_dir)).select("time_published", "test_fold")


def _class_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = settle(series.with_target(_order_series(spark, sf_dir)).where(F.col("returns").isNotNull()))
    truth = labels.label_returns(days).withColumnRenamed("return_class", "actual").drop("return_class_encoded")
    return labels.label_returns(truth, "returns").withColumnRenamed("return_class", "guess")


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.class_report(_class_pairs(spark, sf_dir), "actual", "guess")
    return rounded(report, "precision", "recall", "f1")


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = series.with_target(_order_series(spark, sf_dir)).where(F.col("returns").isNotNull())
    return rounded(metrics.regression_metrics(days, "future_returns", "returns"), "rmse", "mae", "mape")


def directional_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = series.with_target(_order_series(spark, sf_dir)).where(F.col("returns").isNotNull())
    change = metrics.direction_of_change(days, "future_returns", "returns", "time_published")
    both = change.withColumn(
        "direction_of_level", metrics.direction_of_level(days, "future_returns", "returns").scalar()
    )
    return rounded(both, "direction_of_change", "direction_of_level")


def naive_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.naive_baseline(_order_series(spark, sf_dir)), "rmse", "mape")


def latest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = series.last_row(_order_series(spark, sf_dir), ["price", "returns"])
    shown = days.withColumns({
        "next_day": dates.next_day(F.col("time_published")), "percent": scalars.percent_display(F.col("returns")),
    })
    return rounded(shown, "price", "returns")


DROP_SCHEMA = "doc_id bigint, titles string, published timestamp"


def _two_drops(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Documents as two file drops; the second repeats the newer half of the first."""
    found = news(spark, sf_dir).select(
        "doc_id", F.col("content").alias("titles"), F.to_timestamp("time_published").alias("published")
    )
    middle, quarter = (found.agg(F.percentile_approx("doc_id", share)).scalar() for share in (0.5, 0.25))
    return [found.where(F.col("doc_id") <= middle), found.where(F.col("doc_id") > quarter)]


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, out, progress = (scratch_path(spark, name) for name in ("drops", "streamed", "progress"))
    for drop in _two_drops(spark, sf_dir):
        drop.write.mode("append").parquet(landing)
        stream = streams.item_stream(spark, landing, DROP_SCHEMA)
        streams.append_new(stream, out, progress, order=("doc_id",)).awaitTermination()
    return spark.read.parquet(out).select("doc_id", F.md5("titles").alias("titles"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops stored in two batches of files, then again by a query that has lost its progress."""
    landing, out = scratch_path(spark, "drops"), scratch_path(spark, "streamed")
    for drop in _two_drops(spark, sf_dir):
        drop.write.mode("append").parquet(landing)
    files = sum(name.endswith(".parquet") for name in children(spark, landing))
    for _ in range(2):
        stream = streams.item_stream(spark, landing, DROP_SCHEMA, files_per_batch=-(-files // 2))
        streams.append_new(stream, out, scratch_path(spark, "progress"), order=("doc_id",)).awaitTermination()
    return spark.read.parquet(out).groupBy(F.md5("titles").alias("titles")).agg(F.count(F.lit(1)).alias("copies"))


def stream_late_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of three drops that land from the latest day to the earliest: every title is stored once, by its first drop."""
    landing, out, progress = (scratch_path(spark, name) for name in ("drops", "streamed", "progress"))
    found = news(spark, sf_dir).select(
        "doc_id", F.col("content").alias("titles"), F.to_timestamp("time_published").alias("published")
    )
    for third in (2, 1, 0):
        found.where(F.floor((F.col("doc_id") % 30) / 10) == third).write.mode("append").parquet(landing)
        stream = streams.item_stream(spark, landing, DROP_SCHEMA)
        streams.append_new(stream, out, progress, order=("doc_id",)).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "published", F.md5("titles").alias("titles"))


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that pass the watermark-bounded dedupe."""
    landing, out, progress = (scratch_path(spark, name) for name in ("drops", "first", "progress"))
    for drop in _two_drops(spark, sf_dir):
        drop.write.mode("append").parquet(landing)
        stream = streams.first_within(streams.item_stream(spark, landing, DROP_SCHEMA), "published", delay="60 days")
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(F.md5("titles").alias("titles"))
