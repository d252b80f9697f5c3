import warnings
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanac.operators import neighbours, resample
from almanac.plans import predict, training
from almanac.schemas import CLASSIFIER_FEATURES, REGRESSOR_FEATURES
from almanac.session import scratch_path


def points(spark, sizes, dim=3, seed=0, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=20, size=(clusters, dim))
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, label, [float(v) for v in centres[rng.integers(clusters)] + rng.normal(size=dim)]))
            i += 1
    return rows, spark.createDataFrame(rows, "id long, label string, x array<double>").repartition(4)


def brute_force(rows, k):
    out = {}
    for i, label, x in rows:
        ranked = sorted((float(np.sum((np.array(x) - y) ** 2)), j) for j, other, y in rows if other == label and j != i)
        out[i] = ranked[:k]
    return out


@pytest.mark.parametrize("block_rows", [16, 1024])
def test_neighbours_match_brute_force_with_one_class_much_larger(spark, monkeypatch, block_rows):
    monkeypatch.setattr(neighbours, "VISITORS_PER_TASK", 100)
    rows, df = points(spark, {"a": 400, "b": 60, "c": 3, "d": 1})
    rows += [(10_000 + i, "a", rows[0][2]) for i in range(8)]
    df = spark.createDataFrame(rows, df.schema).repartition(4)
    found = {}
    for r in neighbours.nearest_in_class(df, "id", "label", "x", 5, block_rows=block_rows).collect():
        found.setdefault(r["id"], {})[r["place"]] = (r["d2"], r["neighbour"])
    wanted = {i: v for i, v in brute_force(rows, 5).items() if v}
    assert found.keys() == wanted.keys()
    for i, ranked in wanted.items():
        mine = [found[i][p] for p in sorted(found[i])]
        assert [j for _, j in mine] == [j for _, j in ranked]
        assert [d for d, _ in mine] == pytest.approx([d for d, _ in ranked])


def test_boxes_over_all_pivots_leave_fewer_visits(spark, monkeypatch):
    rows, df = points(spark, {"a": 600}, seed=5, clusters=12)
    counted = {}
    plan = neighbours._visits

    def visits(asking, boxes, id_type, name):
        found = plan(asking, boxes, id_type)
        counted[name] = found.agg(F.sum(F.size("blocks"))).first()[0] or 0
        assert not {"x", "vector"} & set(found.columns)
        return found

    def own_ring_only(asking, boxes, id_type):
        """The same boxes, each open on every pivot but the block's own."""
        wide = {}
        for c, (numbers, lo, hi, names) in boxes.items():
            own = np.arange(lo.shape[1])[None, :] == np.array([p for p, _ in names])[:, None]
            wide[c] = (numbers, np.where(own, lo, 0.0), np.where(own, hi, np.inf), names)
        return visits(asking, wide, id_type, "ring")

    results = []
    for how in (lambda *a: visits(*a, "box"), own_ring_only):
        monkeypatch.setattr(neighbours, "_visits", how)
        results.append(sorted(tuple(r) for r in neighbours.nearest_in_class(df, "id", "label", "x", 4, block_rows=16).collect()))
    wanted = brute_force(rows, 4)
    assert results[0] == results[1] and len(results[0]) == 4 * len(rows)
    assert all(wanted[i][place - 1][1] == j for i, j, place, _ in results[0])
    blocks = 600 // 16
    assert counted["box"] < 0.75 * counted["ring"] and counted["box"] < 600 * blocks / 8


def test_visitors_meet_their_tile_in_every_partition(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VISITORS_PER_TASK", 40)
    monkeypatch.setattr(neighbours, "TILE_BLOCKS", 2)
    rows, df = points(spark, {"a": 200, "b": 90}, seed=3)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # tasks are not merged into one
    try:
        found = neighbours.nearest_in_class(df, "id", "label", "x", 4, block_rows=16).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    wanted = brute_force(rows, 4)
    assert {(r["id"], r["place"]): r["neighbour"] for r in found} == {(i, p): j for i, v in wanted.items() for p, (_, j) in enumerate(v, 1)}


@pytest.mark.parametrize("scale", [1.0, 1e160])
def test_closest_of_copies_and_of_values_beyond_a_matrix_product(scale):
    x = np.array([[0.0, 1.0]] * 6 + [[3.0, 4.0], [0.0, 1.0 + 1e-9], [np.nan, 0.0]])
    if scale > 1:
        x[6:8] *= scale
    frame = pd.DataFrame({"id": range(9), "x": list(x)})
    found = neighbours._closest(frame, frame.sample(frac=1, random_state=1), 3)
    near = {i: found[found["id"] == i]["neighbour"].tolist() for i in range(9)}
    assert near[0] == [1, 2, 3] and near[5] == [0, 1, 2] and near[8] == []
    assert near[7] == ([0, 1, 2] if scale == 1 else [])


def test_neighbours_of_some_rows_search_all_rows(spark):
    rows, df = points(spark, {"a": 120, "b": 50}, seed=1)
    asked = df.where("id % 17 = 0").select("id")
    found = neighbours.nearest_in_class(df, "id", "label", "x", 3, queries=asked, block_rows=16).collect()
    wanted = brute_force(rows, 3)
    assert {r["id"] for r in found} == {r[0] for r in asked.collect()}
    assert all(wanted[r["id"]][r["place"] - 1][1] == r["neighbour"] for r in found)


def test_smote_balances_and_stays_on_segments(spark):
    rows, df = points(spark, {"a": 50, "b": 17, "c": 6}, seed=2)
    out = resample.smote(df, "id", "label", "x")
    assert {r[0]: r[1] for r in out.groupBy("label").count().collect()} == {"a": 50, "b": 50, "c": 50}
    assert out.where("not is_synthetic").count() == len(rows)
    near = brute_force(rows, 5)
    by_id = {i: np.array(x) for i, _, x in rows}
    ids = {c: [i for i, label, _ in rows if label == c] for c in "bc"}
    for r in out.where("is_synthetic").collect():
        x = np.array(r["x"])
        on_segment = False
        for i in ids[r["label"]]:
            for _, j in near[i]:
                gap = by_id[j] - by_id[i]
                t = float((x - by_id[i]) @ gap / (gap @ gap))
                on_segment |= -1e-9 <= t <= 1 + 1e-9 and np.allclose(by_id[i] + t * gap, x, atol=1e-6)
        assert on_segment
    again = resample.smote(df.repartition(2), "id", "label", "x")
    key = [F.round(F.col("x")[i], 6).alias(f"x{i}") for i in range(3)]
    assert out.select(*key).exceptAll(again.select(*key)).count() == 0


def test_smote_refuses_or_warns_for_tiny_classes(spark):
    _, df = points(spark, {"a": 20, "b": 3, "c": 1})
    with pytest.raises(ValueError, match="too few rows"):
        resample.smote(df, "id", "label", "x")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        out = resample.smote(df, "id", "label", "x", fewer=True)
    assert any("neighbours" in str(w.message) for w in caught)
    assert {r[0]: r[1] for r in out.groupBy("label").count().collect()} == {"a": 20, "b": 20, "c": 1}


@pytest.fixture(scope="module")
def feature_table(spark):
    rng = np.random.default_rng(9)
    n = 120
    names = [c for c in dict.fromkeys(CLASSIFIER_FEATURES + REGRESSOR_FEATURES) if c != "clf_predictions"]
    data = {c: rng.normal(size=n) for c in names}
    future = data["PCA1"] * 0.5 + rng.normal(scale=0.1, size=n)
    rows = [
        (date(2023, 1, 1) + timedelta(days=i), *[float(data[c][i]) for c in names], float(future[i]) if i < n - 1 else None)
        for i in range(n)
    ]
    schema = "time_published date, " + ", ".join(f"`{c}` double" for c in names) + ", future_returns double"
    return spark.createDataFrame(rows, schema).cache()


def test_folds_train_only_on_the_past(feature_table):
    for train, test in training.time_folds(feature_table, "time_published"):
        assert train.agg(F.max("time_published")).first()[0] < test.agg(F.min("time_published")).first()[0]


@pytest.mark.filterwarnings("ignore")
def test_training_saving_and_prediction(spark, feature_table):
    grid = {"maxIter": [2], "maxDepth": [2], "stepSize": [0.1, 0.3]}
    clf = training.train_classifier(feature_table, grid)
    assert len(clf.scores) == 2 and clf.best in training.candidates(grid)
    assert clf.evaluation["accuracy"] > 0.5
    assert {r["class"] for r in clf.report.collect()} >= {"accuracy", "macro avg", "weighted avg"}
    reg = training.train_regressor(feature_table, clf, grid)
    assert set(reg.scores[0]) >= {"rmse", "mae", "mape", "direction_of_change"}
    assert reg.evaluation["n"] == 12 and reg.evaluation["direction_of_level"] > 50
    best = min(reg.scores, key=lambda r: r["mape"])
    assert reg.best == best["settings"]

    paths = scratch_path(spark, "clf"), scratch_path(spark, "reg")
    predict.save_model(clf.model, paths[0])
    predict.save_model(reg.model, paths[1])
    loaded = [predict.load_model(p) for p in paths]
    row = predict.predict_next(feature_table, *loaded).first()
    assert row["next_day"] == row["time_published"] + timedelta(days=1) == date(2023, 5, 1)
    assert row["percent"] == pytest.approx(row["prediction"] * 100, abs=5e-4)
    assert predict.predict_next(feature_table, clf.model, reg.model).first()["prediction"] == row["prediction"]
    # A latest day without words still gets an answer, and a loaded classifier trains a regressor.
    wordless = feature_table.withColumn(
        "mean_neg_sentiment", F.when(F.col("time_published") < date(2023, 4, 30), F.col("mean_neg_sentiment"))
    )
    served = predict.predict_next(wordless, *loaded).collect()
    assert [r["time_published"] for r in served] == [date(2023, 4, 30)] and served[0]["prediction"] is not None
    assert training.train_regressor(feature_table, loaded[0], grid).evaluation["n"] == 12


def test_halving_keeps_what_the_whole_search_finds(spark):
    """Candidates whose score is known: more trees come nearer to a candidate's own value."""
    class Model:
        def __init__(self, settings):
            self.settings = settings

        def fit(self, train):
            return self

        def transform(self, test):
            return spark.createDataFrame([(self.settings["maxDepth"] - 1.0 / self.settings["maxIter"],)], "score double")

    folds = [(None, None)] * 2
    grid = {"maxIter": [18], "maxDepth": [3, 1, 9, 5, 7, 2, 6, 4, 0, 8]}
    rows, best = training.halving_search(folds, Model, grid, lambda df: df, "score", True)
    whole, best_of_all = training.grid_search(folds, Model, grid, lambda df: df, "score", True)
    assert best == best_of_all == {"maxIter": 18, "maxDepth": 9}
    assert [(r["rung"], r["trees"]) for r in rows].count((0, 2)) == 10
    assert [sum(r["rung"] == i for r in rows) for i in range(3)] == [10, 4, 2]
    assert [sum(r["rung"] == i and r["kept"] for r in rows) for i in range(3)] == [4, 2, 1]
    assert all(r["seconds"] >= 0 for r in rows) and len(whole) == 10
    lowest, worst = training.halving_search(folds, Model, grid, lambda df: df, "score", False)
    assert worst["maxDepth"] == 0


@pytest.mark.filterwarnings("ignore")
def test_halving_search_of_classifiers(feature_table):
    grid = {"maxIter": [6], "maxDepth": [2], "stepSize": [0.1, 0.3], "subsamplingRate": [0.5, 1.0]}
    search = training.train_classifier(feature_table, grid, search=training.halving_search)
    assert [sum(r["rung"] == i for r in search.scores) for i in range(3)] == [4, 2, 1]
    assert search.best in training.candidates(grid) and search.evaluation["accuracy"] > 0.5


@pytest.mark.filterwarnings("ignore")
def test_prediction_without_a_feature_raises(spark, feature_table):
    empty = feature_table.withColumn("PCA2", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="PCA2"):
        predict.predict_next(empty, None, None)


@pytest.mark.filterwarnings("ignore")
def test_loose_mode_balances_before_the_folds(feature_table):
    grid = {"maxIter": [2], "maxDepth": [2], "stepSize": [0.1]}
    clf = training.train_classifier(feature_table, grid, strict=False)
    assert clf.evaluation["accuracy"] > 0.5
    reg = training.train_regressor(feature_table, clf, grid, strict=False)
    assert reg.evaluation["rmse"] > 0
