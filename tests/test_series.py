import hashlib
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanac.operators import labels, metrics, rollup, series
from almanac.plans import daily, reports
from almanac.schemas import SERIES
from almanac.session import settle

START = date(2024, 1, 1)


def frame(spark, prices, **columns):
    names = list(columns)
    data = [
        (START + timedelta(days=i), None if p is None else float(p), *[columns[n][i] for n in names])
        for i, p in enumerate(prices)
    ]
    schema = "time_published date, price double" + "".join(f", {n} double" for n in names)
    return spark.createDataFrame(data, schema)


def values(df, column, day="time_published"):
    return [r[0] for r in df.orderBy(day).select(f"`{column}`").collect()]


def close(found, wanted):
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted):
        assert (a is None) == (b is None or (isinstance(b, float) and np.isnan(b))), (a, b)
        if a is not None:
            assert a == pytest.approx(b, rel=1e-9, abs=1e-12)


def test_gap_and_zero_price(spark):
    out = series.with_returns(frame(spark, [10, None, 12, 0, 1]))
    close(values(out, "returns"), [None, 0.0, 0.2, -1.0, None])
    close(values(out, "future_returns"), [0.0, 0.2, -1.0, None, None])
    close(values(out, "lagged_price"), [None, 10.0, None, 12.0, 0.0])


def test_schema_of_the_series(spark):
    out = series.with_returns(frame(spark, [10, 11]))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SERIES]


def test_rolling_columns_match_pandas(spark):
    rng = np.random.default_rng(3)
    prices = list(rng.uniform(5, 15, 40))
    out = series.with_returns(frame(spark, prices))
    p = pd.DataFrame({"price": prices})
    p["returns"] = p["price"].pct_change()
    p["future"] = p["returns"].shift(-1)
    close(values(out, "returns"), p["returns"].tolist())
    close(values(out, "3d_rolling_volatility"), p["returns"].rolling(3).std().tolist())
    close(values(out, "7d_rolling_volatility"), p["returns"].rolling(7).std().tolist())
    rolled = p["future"].rolling(10).mean()
    report = reports.rolling_returns(out)
    close(values(report, "rolling_mean"), rolled.tolist())
    assert values(report, "overall_mean")[0] == pytest.approx(round(rolled.mean(), 4))


def test_rolling_warm_up(spark):
    out = series.with_returns(frame(spark, [10, 11, 9, 12, 12]))
    close(values(out, "3d_rolling_volatility"), [
        None, None, None, float(np.std([0.1, 9 / 11 - 1, 12 / 9 - 1], ddof=1)), float(np.std([9 / 11 - 1, 12 / 9 - 1, 0.0], ddof=1)),
    ])


def test_spread_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pos, neg = rng.uniform(size=45), rng.uniform(size=45)
    df = frame(spark, [1] * 45, mean_pos_sentiment=pos.tolist(), mean_neg_sentiment=neg.tolist())
    close(values(reports.price_and_spread(df), "spread"), pd.Series(pos - neg).rolling(30).mean().tolist())


def test_correlation_uses_pairwise_complete_rows(spark):
    rng = np.random.default_rng(5)
    a, b = rng.uniform(size=20).tolist(), rng.uniform(size=20).tolist()
    a[3], b[7] = None, None
    df = frame(spark, range(1, 21), a=a, b=b)
    found = {(r[0], r[1]): r[2] for r in metrics.correlation_table(df, ["price", "a", "b"]).collect()}
    wanted = pd.DataFrame({"price": range(1, 21), "a": a, "b": b}).astype(float).corr()
    assert len(found) == 9
    for (x, y), value in found.items():
        assert value == pytest.approx(wanted.loc[x, y])


def test_trim_split_and_folds(spark):
    days = frame(spark, range(1, 31))
    assert values(series.trim_edges(days), "price") == [float(p) for p in range(2, 30)]
    split = series.chronological_split(days)
    assert values(split, "is_train") == [True] * 27 + [False] * 3
    folds = values(series.expanding_folds(frame(spark, range(10))), "test_fold")
    assert folds == [None] * 4 + [0, 0, 1, 1, 2, 2]
    assert values(series.expanding_folds(frame(spark, range(3))), "test_fold") == [None] * 3


def test_last_row(spark):
    assert tuple(series.last_row(frame(spark, [1, 2, 3]), ["price"]).first()) == (START + timedelta(days=2), 3.0)


def test_labels_and_encoding(spark):
    target = [0.0] * 8 + [10.0, -10.0]
    df = frame(spark, range(10), future_returns=target)
    out = labels.label_returns(df)
    assert values(out, "return_class") == ["mod_return"] * 8 + ["pos_return", "neg_return"]
    assert values(out, "return_class_encoded") == [0] * 8 + [2, 1]


def test_label_on_the_threshold_is_moderate(spark):
    df = spark.createDataFrame([(1.5,), (0.5,), (None,), (1.6,), (0.4,)], "v double")
    from pyspark.sql import functions as F

    out = df.select(labels.return_class(F.col("v"), F.lit(1.0), F.lit(0.5)))
    assert [r[0] for r in out.collect()] == ["mod_return"] * 3 + ["pos_return", "neg_return"]


def test_thresholds_can_come_from_training_rows(spark):
    df = frame(spark, range(4), future_returns=[1.0, 2.0, 3.0, 2.9])
    out = labels.label_returns(df, fit_on=df.where("price < 3"))
    assert values(out, "return_class") == ["mod_return", "mod_return", "mod_return", "mod_return"]


def test_metrics(spark):
    y, p = [0.1, -0.2, 0.0, 0.4], [0.2, -0.1, 0.1, -0.4]
    df = frame(spark, range(4), y=y, p=p)
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean((np.array(y) - p) ** 2)))
    assert row["mae"] == pytest.approx(np.mean(np.abs(np.array(y) - p)))
    assert row["mape"] == pytest.approx(np.mean([1.0, 0.5, 2.0]) * 100)
    assert (row["zero_actuals"], row["n"]) == (1, 4)
    assert metrics.direction_of_change(df, "y", "p", "time_published").first()[0] == pytest.approx(200 / 3)
    assert metrics.direction_of_level(df, "y", "p").first()[0] == pytest.approx(50.0)


def test_class_report(spark):
    truth = ["a"] * 4 + ["b"] * 3 + ["c"]
    guess = ["a", "a", "b", "a", "b", "b", "a", "d"]
    df = spark.createDataFrame(list(zip(truth, guess)), "t string, g string")
    rows = {r["class"]: r for r in metrics.class_report(df, "t", "g").collect()}
    assert (rows["a"]["precision"], rows["a"]["recall"], rows["a"]["support"]) == (0.75, 0.75, 4)
    assert rows["b"]["f1"] == pytest.approx(2 / 3)
    assert rows["c"]["f1"] == 0.0 and rows["d"]["support"] == 0
    assert rows["accuracy"]["f1"] == pytest.approx(5 / 8)
    assert metrics.accuracy(df, "t", "g").first()[0] == pytest.approx(5 / 8)


def test_naive_baseline_pairs_the_same_row(spark):
    df = frame(spark, range(4), returns=[None, 0.1, 0.2, 0.4], future_returns=[0.1, 0.2, 0.4, None])
    assert metrics.naive_baseline(df).first()["rmse"] == pytest.approx(np.sqrt((0.01 + 0.04) / 2))


RAW = "time_published date, titles string, content string, price double, n int"


def test_rollup_joins_in_order_and_keeps_missing_text_out(spark):
    d1, d2 = START, START + timedelta(days=1)
    raw = spark.createDataFrame(
        [(d1, "b", "y", 2.0, 2), (d1, "a", None, 1.0, 1), (d1, None, "z", 3.0, 3), (d2, "c", "w", 5.0, 4), (None, "q", "q", 1.0, 5)],
        RAW,
    )
    found = [tuple(r) for r in rollup.daily_rollup(raw, ["n"]).orderBy("time_published").collect()]
    assert found == [(d1, "a b ", " y z", 2.0), (d2, "c", "w", 5.0)]


def test_a_day_too_large_for_one_row_raises_and_its_items_stay_readable(spark):
    rows = [(START, f"t{i}", "x" * 50, 1.0, i) for i in range(400)] + [(START + timedelta(days=1), "s", "y", 1.0, 1)]
    raw = spark.createDataFrame(rows, RAW).repartition(5)
    with pytest.raises(ValueError, match="day_items"):
        rollup.daily_text(raw, ["n"], cell_chars=2000)
    found = rollup.day_items(raw, ["n"]).where(F.col("time_published") == START).orderBy("rank_0").collect()
    assert [r["titles"] for r in found] == [r[1] for r in rows[:400]]
    assert rollup.daily_text(raw, ["n"]).columns == ["time_published", "titles", "content"]


def test_parts_hold_the_joined_text_of_days_of_any_size(spark):
    d1, d2 = START, START + timedelta(days=1)
    rows = [(d1, f"t{i}", "x€" * (i % 40), 1.0, i // 2) for i in range(400)] + [(d2, None, None, 1.0, 1), (None, "q", "q", 1.0, 5)]
    # Places that are missing or shared, and rows that come twice, in other partitions than they belong to.
    rows += [(d1, "b", None, 1.0, None), (d1, None, "a", 1.0, None), (d1, "t7", "z", 1.0, 3), (d1, "t7", "z", 1.0, 3)]
    raw = spark.createDataFrame(rows[::-1], RAW).repartition(5)
    want = sorted(map(tuple, rollup.daily_text(raw, ["n"]).collect()))
    for part_bytes in (1, 300, 1 << 30):
        parts = settle(rollup.daily_text(raw, ["n"], cell_chars=1, part_bytes=part_bytes))
        assert (parts.count() > 800) == (part_bytes == 1)
        assert sorted(map(tuple, rollup.whole_text(parts).collect())) == want
        hashed = [(d, *(hashlib.md5(text.encode()).hexdigest() for text in texts)) for d, *texts in want]
        assert sorted(map(tuple, rollup.text_digests(parts).collect())) == hashed
    with pytest.raises(ValueError, match="its parts"):
        rollup.whole_text(parts, cell_chars=2000)


def test_daily_table_has_one_row_per_day(spark):
    raw = spark.createDataFrame([(START + timedelta(days=i % 4), f"t{i}", "c", float(i), i) for i in range(12)], RAW)
    out = daily.daily_table(raw, ["n"])
    assert out.count() == 4 and out.where("lagged_price is null").count() == 1
