import contextlib
import io

import pytest

from almanac.catalog import relational, tables
from almanac.operators import items, series
from almanac.catalog.tables import event_prices, news
from tests.conftest import SMALL


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df):
    return plan(df).split("\n\n")[0]


def test_price_join_broadcasts_and_does_not_shuffle_the_news(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    prices = event_prices(spark, SMALL)
    found = tree(items.join_prices(documents.selectExpr("doc_id", "date_add(date'2024-01-01', cast(doc_id % 30 as int)) as time_published"), prices))
    assert "BroadcastHashJoin" in found
    assert found.count("Exchange") - found.count("BroadcastExchange") == 1  # the day aggregation of the prices


def test_all_series_columns_share_one_sort(spark):
    prices = tables.order_prices(spark, SMALL)
    found = tree(series.with_returns(prices))
    assert found.count("Sort (") == 1


def test_scans_read_only_the_columns_used(spark):
    found = plan(relational.scan_projection(spark, SMALL))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in found
    found = plan(relational.lag_lead_returns(spark, SMALL))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in found


def test_stored_day_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").where("o_orderdate >= timestamp_ntz'2000-01-01 00:00:00'")
    assert "GreaterThanOrEqual(o_orderdate" in plan(orders)


@pytest.mark.parametrize("name", [
    "price_map_flatten", "json_snapshot", "compact_date_parse", "round_price", "dedupe_keep_first", "news_price_join",
    "lag_lead_returns", "rolling_volatility", "rolling_means", "correlation_long", "return_classes",
])
def test_relational_queries_stay_in_the_jvm(spark, name):
    found = tree(getattr(relational, name)(spark, SMALL))
    assert "Python" not in found and "Pandas" not in found
    assert "CartesianProduct" not in found and "BroadcastNestedLoopJoin" not in found


def test_copies_of_a_title_collapse_before_the_shuffle(spark):
    found = tree(items.keep_first(news(spark, SMALL).select("titles", "doc_id"), "titles", ["doc_id"]))
    exchange = found.index("Exchange hashpartitioning") if "Exchange hashpartitioning" in found else found.index("Exchange (")
    assert "Aggregate" in found[exchange:]
