import math
from collections import Counter, defaultdict
from datetime import date, timedelta
from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanac.operators import keyed, rollup, sentiment, summary, tfidf
from almanac.operators.keyed import broadcast_days, hot_keys, lookup_join, split_join
from almanac.operators.ordering import running_offset
from almanac.plans import features
from almanac.schemas import FEATURES
from almanac.session import scratch_path, settle

START = date(2024, 1, 1)
WORDS = ["alpha", "beta", "gamma", "delta", "a", "the", "of", "rates", "rise", "fall"]


def corpus(n, seed=0, low=0, high=30):
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, len(WORDS) + 1)
    return [(i, " ".join(rng.choice(WORDS, size=rng.integers(low, high), p=weights / weights.sum()))) for i in range(n)]


def tfidf_matrix(texts):
    docs = [Counter(w for w in t.split() if len(w) > 1) for t in texts]
    vocabulary = sorted(set().union(*docs))
    df = {w: sum(w in d for d in docs) for w in vocabulary}
    x = np.array([[d[w] * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w in vocabulary] for d in docs])
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return vocabulary, x / np.where(norms == 0, 1, norms)


def pca(x, k=2):
    u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    scores = u[:, :k] * s[:k]
    largest = scores[np.abs(scores).argmax(axis=0), np.arange(k)]
    return scores * np.where(largest < 0, -1, 1)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_tfidf_matches_brute_force_with_broadcast_and_with_split_join(spark, monkeypatch, limit):
    monkeypatch.setattr(tfidf, "VOCABULARY_BROADCAST_ROWS", limit)
    texts = corpus(60)
    df = spark.createDataFrame(texts, "doc int, text string")
    counts = tfidf.term_counts(df, "doc", "text")
    frequencies = tfidf.document_frequencies(df, "text")
    found = {(r["doc"], r["token"]): r["weight"] for r in tfidf.tfidf(counts, 60, "doc", frequencies).collect()}
    vocabulary, x = tfidf_matrix([t for _, t in texts])
    wanted = {(i, w): x[i, j] for i in range(60) for j, w in enumerate(vocabulary) if x[i, j]}
    assert found.keys() == wanted.keys()
    assert all(found[key] == pytest.approx(wanted[key]) for key in wanted)


@pytest.mark.parametrize("n", [3, 5, 100, 3000])
def test_components_match_svd(spark, n):
    texts = corpus(n, seed=2)
    df = spark.createDataFrame(texts, "doc int, text string")
    weights = tfidf.tfidf(settle(tfidf.term_counts(df, "doc", "text")), n, "doc")
    found = tfidf.principal_components(weights, df, "doc").orderBy("doc").select("PCA1", "PCA2").toPandas().to_numpy()
    _, x = tfidf_matrix([t for _, t in texts])
    wanted = pca(x)
    np.testing.assert_allclose(found[:, : wanted.shape[1]], wanted, atol=1e-6)
    assert found.mean(axis=0) == pytest.approx([0, 0], abs=1e-9)


@pytest.mark.parametrize("n", [40, 3000])
def test_products_of_documents_are_added_up_once(spark, monkeypatch, n):
    df = spark.createDataFrame(corpus(n, seed=3), "doc int, text string")
    weights = settle(tfidf.tfidf(settle(tfidf.term_counts(df, "doc", "text")), n, "doc"))
    passes = []
    monkeypatch.setattr(tfidf, "_gram_times", lambda *a, how=tfidf._gram_times: passes.append(1) or how(*a))
    once = tfidf.principal_components(weights, df, "doc").orderBy("doc").toPandas().to_numpy()
    assert not passes
    monkeypatch.setattr(tfidf, "GRAM_DOCS", 0)
    again = tfidf.principal_components(weights, df, "doc").orderBy("doc").toPandas().to_numpy()
    assert passes
    np.testing.assert_allclose(once, again, atol=1e-6)


def test_products_of_wide_and_narrow_words():
    dense = np.where(np.random.default_rng(4).random((90, 100)) < np.linspace(0, 0.2, 90)[:, None], 1.5, 0.0) + 0.0
    total, cells = np.zeros((100, 100)), [np.flatnonzero(word) for word in dense]
    at = np.concatenate(cells).astype(np.int32)
    tfidf._add_products(total, at, np.full(len(at), 1.5), np.array([len(c) for c in cells]))
    np.testing.assert_allclose(total, dense.T @ dense)


@pytest.mark.parametrize("limit", [0, 1, 25, 10**6])
def test_document_weights_equal_weights_of_counts(spark, monkeypatch, limit):
    texts = [*corpus(40), (3, "gamma rare_once x gamma"), (None, "alpha rare_once beta"), (90, None), (91, "")]
    df = spark.createDataFrame(texts, "doc int, text string")
    counts, frequencies = settle(tfidf.term_counts(df, "doc", "text")), tfidf.document_frequencies(df, "text")
    wanted = {(r["doc"], r["token"]): tuple(r) for r in tfidf.tfidf(counts, 44, "doc", frequencies).select("doc", "token", "tf", "df", "weight").collect()}
    monkeypatch.setattr(tfidf, "VOCABULARY_BROADCAST_ROWS", limit)
    for found in (tfidf.document_weights(df, "doc", "text"), tfidf.tfidf(counts, 44, "doc", frequencies)):
        rows = found.select("doc", "token", "tf", "df", "weight").collect()
        assert len(rows) == len(wanted)
        assert all(tuple(r)[:4] == wanted[r["doc"], r["token"]][:4] and r["weight"] == pytest.approx(wanted[r["doc"], r["token"]][4]) for r in rows)


@pytest.mark.parametrize("limit", [0, 1, 25])
def test_summaries_do_not_depend_on_what_is_broadcast(spark, monkeypatch, limit):
    texts = [(i, ". ".join(t.split()[j] + " " + " ".join(t.split()[j : j + 3]) for j in range(0, len(t.split()), 3))) for i, t in corpus(30, seed=5)]
    df = spark.createDataFrame([*texts, (3, "one more. text of three"), (None, "Some words. Others"), (90, None)], "doc int, text string")
    wanted = sorted(map(str, summary.summaries(df, "doc", "text").collect()))
    monkeypatch.setattr(tfidf, "VOCABULARY_BROADCAST_ROWS", limit)
    assert sorted(map(str, summary.summaries(df, "doc", "text").collect())) == wanted


def test_texts_are_dealt_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "TASK_BYTES", 64)
    df = spark.createDataFrame([(i, "word " * 20) for i in range(40)], "doc int, text string")
    assert tfidf.by_document(df, "doc", "text").rdd.getNumPartitions() == 63
    assert tfidf.document_weights(df, "doc", "text").rdd.getNumPartitions() == 63


def test_each_word_of_a_document_asks_for_its_lemma_once(spark, monkeypatch):
    texts = [(1, "cats and cats dogs cats"), (2, ""), (3, None), (None, "cats 7"), (4, "dogs; CATS"), (5, "cats")]
    df = spark.createDataFrame(texts, "doc int, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("and", "and"), ("dogs", None)], "token string, lemma string")
    asked = []
    monkeypatch.setattr(tfidf, "split_join", lambda facts, *a, **k: asked.append(facts.count()) or split_join(facts, *a, **k))
    few, many = (sorted(map(str, tfidf.lemmatised_text(df, "doc", "text", lemmas, broadcast_rows=n, partition_rows=1).collect())) for n in (10, 0))
    assert few == many and asked == [8]
    assert "Row(doc=1, processed_text='cat and cat dogs cat')" in many and "Row(doc=3, processed_text='')" in many


def test_cuts_of_a_chunk_travel_as_text(spark, monkeypatch):
    raw = spark.createDataFrame([(i, date(2024, 1, 1), f"w{i}a w{i}b, W{i}c") for i in range(5)], "doc_id int, time_published date, content string")
    gathered = []
    monkeypatch.setattr(F, "collect_list", lambda c, how=F.collect_list: gathered.append(c) or how(c))
    chunks = sentiment.day_chunks(raw, ["doc_id"], size=4)
    assert chunks._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1 and gathered
    assert [w for r in chunks.orderBy("chunk").collect() for w in r["words"]] == [f"w{i}{c}" for i in range(5) for c in "abc"]


@pytest.mark.parametrize("n, spread", [(400, 1.0), (400, 0.001), (30, 0.5)])
def test_block_iteration_with_close_values(n, spread):
    draw = np.random.default_rng(n)
    left = np.linalg.qr(draw.standard_normal((n, n)))[0]
    left -= left.mean(axis=0)
    left = np.linalg.qr(left)[0][:, : n - 1]
    values = np.sort(1 + spread * draw.random(n - 1))[::-1]
    gram = left * values @ left.T
    rounds = []
    found = tfidf._leading_scores(lambda block: rounds.append(1) or gram @ block, n, 2)
    leading = left[:, :2] * np.sqrt(values[:2])
    np.testing.assert_allclose(np.abs(found), np.abs(leading), atol=1e-5)
    assert len(rounds) <= tfidf.MAX_ROUNDS


def test_components_that_do_not_settle_raise():
    draw = np.random.default_rng(1)
    with pytest.raises(RuntimeError, match="still move"):
        tfidf._leading_scores(lambda block: draw.standard_normal(block.shape), 5000, 2)


def test_components_of_identical_texts_are_zero(spark):
    df = spark.createDataFrame([(i, "same words here") for i in range(4)], "doc int, text string")
    weights = tfidf.tfidf(settle(tfidf.term_counts(df, "doc", "text")), 4, "doc")
    found = tfidf.principal_components(weights, df, "doc").toPandas()
    assert np.allclose(found[["PCA1", "PCA2"]], 0, atol=1e-6)


def test_more_documents_than_a_block_may_have_are_refused(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "MOST_DOCS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        tfidf.principal_components(spark.createDataFrame([], "doc int, token string, weight double"), spark.range(4).toDF("doc"), "doc")


def test_lemmas_in_counts_and_in_text(spark):
    lemmas = spark.createDataFrame([("rises", "rise"), ("x", "long")], "token string, lemma string")
    df = spark.createDataFrame([(1, "Rises rise x fall"), (2, "")], "doc int, text string")
    counts = {(r["doc"], r["token"]): r["tf"] for r in tfidf.term_counts(df, "doc", "text", lemmas).collect()}
    assert counts == {(1, "rise"): 2, (1, "long"): 1, (1, "fall"): 1}
    assert [tuple(r) for r in tfidf.lemmatised_text(df, "doc", "text", lemmas).orderBy("doc").collect()] == [
        (1, "rise rise long fall"), (2, ""),
    ]


def test_split_join_equals_join_with_a_hot_key(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 300, 6)], "k string, v double")
    hot = hot_keys(facts, "k", 30)
    assert [tuple(r) for r in hot.collect()] == [("hot", 7)]
    for how in ("inner", "left"):
        found = split_join(facts, lookup, "k", hot, how).select("i", "k", "v").collect()
        assert sorted(found, key=str) == sorted(facts.join(lookup, "k", how).select("i", "k", "v").collect(), key=str)


def test_lookup_join_gives_the_same_rows_either_way(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1.0), ("k3", 3.0), ("k6", 6.0)], "k string, v double")
    small, large = (sorted(lookup_join(facts, lookup, "k", rows).collect(), key=str) for rows in (10, 2))
    assert small == large and len(small) == 90


def test_split_join_keeps_rows_without_a_key(spark):
    facts = spark.createDataFrame([(1, None), (2, "a"), (3, "a"), (4, None)], "i int, k string")
    lookup = spark.createDataFrame([("a", 1.0)], "k string, v double")
    assert split_join(facts, lookup, "k", hot_keys(facts, "k", 1), "left").count() == 4


def test_a_hot_key_goes_to_many_tasks(spark):
    facts = settle(spark.range(0, 3000, 1, 3).selectExpr("id AS i", "IF(id % 3 = 0, 'hot', string(id)) AS k", "id % 7 AS share"))
    lookup = spark.createDataFrame([("hot", 1.0)], "k string, v double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = split_join(facts, lookup, "k", hot_keys(facts, "k", 20), "inner")
        parts = met.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert met.columns == ["k", "i", "share", "v"] and met.count() == 1000
    assert len(parts) > 1 and max(r["count"] for r in parts) < 700


def test_the_list_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_HOT", 10)
    facts = spark.range(1000).selectExpr("id % 100 AS k")
    assert hot_keys(facts, "k", 1).count() == 0


def test_broadcast_days_needs_a_date(spark):
    with pytest.raises(TypeError):
        broadcast_days(spark.range(1), "id")


def test_running_offset_over_one_huge_group(spark):
    rng = np.random.default_rng(1)
    data = [(START if i % 10 else START + timedelta(days=i), i, int(rng.integers(0, 9))) for i in range(1000)]
    df = spark.createDataFrame(data, "d date, i int, n long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running_offset(settle(df), ["d"], ["i"], "n")
        found = {r["i"]: r["offset"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    totals = defaultdict(int)
    for d, i, n in sorted(data):
        assert found[i] == totals[d]
        totals[d] += n


def test_day_chunks_equal_chunks_of_the_joined_text(spark):
    days = [(START + timedelta(days=i % 3 if i % 2 else 0), f"t{i}", text, i) for i, text in corpus(80, seed=3)]
    raw = spark.createDataFrame(days + [(START, "none", None, 999)], "time_published date, titles string, content string, n int")
    found = {(r[0], r[1]): list(r[2]) for r in sentiment.day_chunks(raw.repartition(5), ["n"], size=7).collect()}
    joined = defaultdict(list)
    for d, _, text, _ in sorted(days, key=lambda r: r[3]):
        joined[d] += text.split()
    wanted = {(d, i // 7): ws[i:i + 7] for d, ws in joined.items() for i in range(0, len(ws), 7)}
    assert found == wanted


def scored(spark, scorer, texts, size=4):
    df = spark.createDataFrame(texts, "doc int, text string")
    return sentiment.sentiment_statistics(scorer(sentiment.text_chunks(df, "doc", "text", size), ["doc"]), ["doc"])


def test_repeated_items_keep_their_own_words(spark):
    rows = [(date(2024, 1, 1), "a b c", 1), (date(2024, 1, 1), "a b c", 1)]
    raw = spark.createDataFrame(rows, "time_published date, content string, n int")
    found = sentiment.day_chunks(raw, ["n"]).collect()
    assert [r["words"] for r in found] == [["a", "b", "c", "a", "b", "c"]]


def test_lexicon_statistics(spark):
    lexicon = spark.createDataFrame([("rise", 0.0, 1.0), ("fall", 1.0, 0.0)], "token string, neg double, pos double")
    out = {r["doc"]: r for r in scored(spark, sentiment.lexicon_scorer(lexicon), [(1, "rise x fall fall rise rise"), (2, "")]).collect()}
    assert list(out) == [1]
    row = out[1]
    pos, neg = np.array([0.25, 1.0]), np.array([0.5, 0.0])
    assert row["mean_pos_sentiment"] == pytest.approx(pos.mean()) and row["std_pos_sentiment"] == pytest.approx(pos.std())
    assert row["max_neg_sentiment"] == 0.5 and row["min_neg_sentiment"] == 0.0
    assert row["std_neg_sentiment"] == pytest.approx(neg.std()) and row["n_chunks"] == 2


def test_every_text_keeps_its_row(spark):
    lexicon = spark.createDataFrame([("rise", 0.0, 1.0)], "token string, neg double, pos double")
    df = spark.createDataFrame([(1, "rise"), (2, "..."), (3, None)], "doc int, text string")
    out = sentiment.text_sentiment(df, "doc", "text", sentiment.lexicon_scorer(lexicon)).orderBy("doc").collect()
    assert [(r["n_chunks"], r["mean_pos_sentiment"]) for r in out] == [(1, 1.0), (0, None), (0, None)]


def test_pandas_scorer_flags_only_the_failing_chunk(spark):
    def model(texts: pd.Series) -> pd.DataFrame:
        if texts.str.contains("bad").any():
            raise RuntimeError("no answer")
        return pd.DataFrame({"neg": texts.str.len() / 100, "pos": 0.5})

    out = scored(spark, sentiment.pandas_scorer(model), [(1, "aa bb cc dd bad"), (2, "ee")]).orderBy("doc").collect()
    assert [(r["n_chunks"], r["n_failed"], r["mean_pos_sentiment"]) for r in out] == [(2, 1, 0.5), (1, 0, 0.5)]
    assert out[0]["mean_neg_sentiment"] == pytest.approx(0.11)


def test_model_scorer_learns_the_words(spark):
    df = spark.createDataFrame([(i, "rise up high" if i % 2 else "fall down low", i % 2) for i in range(20)], "doc int, text string, y int")
    scorer = sentiment.train_scorer(df, "text", "y")
    out = {r["doc"]: r["mean_pos_sentiment"] for r in scored(spark, scorer, [(1, "rise high"), (2, "fall low")]).collect()}
    assert out[1] > 0.5 > out[2]


def test_naive_bayes_equals_brute_force_and_every_word_has_its_own_weight(spark):
    texts = [("a b b rare", 0), ("b c", 0), ("c c d a", 1), ("d d", 1), (None, 1), ("x y", None)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc int, text string, y int")
    scorer = sentiment.train_scorer(df, "text", "y")
    weights = {r["token"]: (r["neg"], r["pos"]) for r in scorer.weights.collect()}
    n = {"a": (1, 1), "b": (3, 0), "c": (1, 2), "d": (0, 3)}
    totals = [sum(v[i] for v in n.values()) + len(n) for i in (0, 1)]
    assert weights == {w: tuple(pytest.approx(math.log((c + 1) / t)) for c, t in zip(v, totals)) for w, v in n.items()}
    out = scored(spark, scorer, [(1, "d rare d b")]).first()
    odds = sum(weights[w][1] - weights[w][0] for w in "ddb") + math.log(4 / 3)
    assert out["mean_pos_sentiment"] == pytest.approx(1 / (1 + math.exp(-odds)))
    assert out["mean_neg_sentiment"] == pytest.approx(1 / (1 + math.exp(odds)))


def test_vocabulary_threshold_rises_to_the_bound(spark):
    words = spark.createDataFrame([(0, f"w{i}") for i in range(10) for _ in range(i + 1)], "label int, token string")
    assert {r["token"] for r in sentiment.vocabulary(words, 2, 3).collect()} == {"w9", "w8", "w7"}
    assert sentiment.vocabulary(words, 2, 100).count() == 9
    tied = spark.createDataFrame([(1, f"t{i}") for i in range(5) for _ in range(2)], "label int, token string")
    assert sentiment.vocabulary(tied, 2, 3).count() == 0


def test_day_sentiment_of_word_scores_gathers_no_words(spark):
    rng = np.random.default_rng(8)
    days = [(START + timedelta(days=i % 3 if i % 4 else 0), f"t{i}", text, i) for i, text in corpus(80, seed=3)]
    raw = settle(spark.createDataFrame(days + [(START, "none", None, 999)], "time_published date, titles string, content string, n int"))
    words = sorted({w for d in days for w in d[2].split()})
    lexicon = spark.createDataFrame([(w, float(rng.random()), float(rng.random())) for w in words], "token string, neg double, pos double")
    scorer = sentiment.lexicon_scorer(lexicon)
    summed = features.day_sentiment(raw, scorer, ["n"])
    gathered = sentiment.sentiment_statistics(scorer(sentiment.day_chunks(raw, ["n"]), ["time_published"]), ["time_published"])
    assert [tuple(map(str, r[:1])) + tuple(pytest.approx(v) for v in r[1:]) for r in gathered.orderBy("time_published").collect()] == [
        tuple(map(str, r[:1])) + tuple(r[1:]) for r in summed.orderBy("time_published").collect()
    ]
    plan = summed._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert shuffled and not any("token" in line or "words" in line for line in shuffled) and "collect_list" not in plan


def test_summary_keeps_order_and_short_texts_whole(spark):
    texts = [(1, "Alpha beta gamma. The the the. Delta rates rise!"), (2, "One sentence only"), (3, "...")]
    df = spark.createDataFrame(texts, "doc int, text string")
    out = dict(tuple(r) for r in summary.summaries(df, "doc", "text", 2).collect())
    assert out[2] == "One sentence only" and out[3] is None
    assert len(out[1].split(". ")) == 2 and texts[0][1].index(out[1][:5]) >= 0


def test_features_table(spark):
    rng = np.random.default_rng(6)
    days = [(START + timedelta(days=i % 12), f"title {i}", text, float(rng.uniform(9, 11)), i) for i, text in corpus(60, seed=7, low=1)]
    raw = spark.createDataFrame(days, "time_published date, titles string, content string, price double, n int")
    lexicon = spark.createDataFrame([("alpha", 0.0, 1.0), ("beta", 1.0, 0.0)], "token string, neg double, pos double")
    out = features.features(raw, sentiment.lexicon_scorer(lexicon), order=["n"])
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in FEATURES]
    assert out.count() == 12 and out.where(F.col("PCA1").isNull() | F.col("mean_pos_sentiment").isNull()).count() == 0


def test_a_partial_feature_run_equals_a_full_one(spark):
    rng = np.random.default_rng(6)
    days = [(START + timedelta(days=i % 12 * 5), f"title {i}", text, float(rng.uniform(9, 11)), i) for i, text in corpus(60, seed=7, low=1)]
    raw = settle(spark.createDataFrame(days, "time_published date, titles string, content string, price double, n int"))
    lexicon = spark.createDataFrame([("alpha", 0.0, 1.0), ("beta", 1.0, 0.0)], "token string, neg double, pos double")
    scorer = sentiment.lexicon_scorer(lexicon)
    paths = [scratch_path(spark, "features") for _ in range(2)]
    features.run_features(spark, raw, scorer, paths[0], order=["n"])
    changed = (F.col("n") % 12).isin(3, 11)
    features.run_features(spark, raw.where(~changed | (F.col("n") % 12 == 3) & (F.col("n") % 2 == 1)), scorer, paths[1], order=["n"])
    read = spark.read.parquet
    before = {r["time_published"]: r["n_chunks"] for r in read(f"{paths[1]}-sentiment").collect()}
    features.run_features(spark, raw, scorer, paths[1], order=["n"], days=raw.where(changed))
    assert len(before) == 11
    whole, partial = (features.read_features(spark, p).orderBy("time_published").toPandas() for p in paths)
    assert list(whole["titles"]) == list(partial["titles"]) and list(whole["content"]) == list(partial["content"])
    numbers = [c for c in FEATURES.names if c != "time_published"]
    np.testing.assert_allclose(whole[numbers].to_numpy(float), partial[numbers].to_numpy(float), atol=1e-7)
    assert len(whole) == 12


def test_a_feature_run_stores_days_that_do_not_fit_a_cell(spark, monkeypatch):
    rows = [(START + timedelta(days=i % 3), f"title {i}", text, 1.0 + i % 5, i) for i, text in corpus(60, seed=7, low=1)]
    raw = settle(spark.createDataFrame(rows, "time_published date, titles string, content string, price double, n int"))
    scorer = sentiment.lexicon_scorer(spark.createDataFrame([("alpha", 0.0, 1.0)], "token string, neg double, pos double"))
    want = rollup.daily_text(raw, ["n"]).withColumns({c: F.md5(c) for c in ("titles", "content")})
    want = sorted(map(tuple, want.collect()))
    monkeypatch.setattr(rollup, "daily_text", partial(rollup.daily_text, cell_chars=10))
    path = scratch_path(spark, "features")
    features.run_features(spark, raw.where("n < 40"), scorer, path, order=["n"])
    features.run_features(spark, raw, scorer, path, order=["n"], days=raw.where("n >= 40"))
    found = features.read_features(spark, path, digests=True)
    assert found.columns == [*FEATURES.names, "titles", "content"]
    assert sorted(map(tuple, found.select("time_published", "titles", "content").collect())) == want


def test_offsets_in_blocks_leave_the_words_in_place(spark, monkeypatch):
    rows = [(START + timedelta(days=i % 3), text if i % 7 else None, i // 2) for i, text in corpus(90, seed=5, low=1)]
    raw = spark.createDataFrame(rows, "time_published date, content string, n int").repartition(3)
    items = sentiment.day_words(raw, ["n"])
    monkeypatch.setattr(sentiment, "OFFSETS_BROADCAST_ROWS", 1)
    monkeypatch.setattr(sentiment, "OFFSETS_BLOCK_BITS", 3)
    placed = sentiment.day_chunk_words(raw, ["n"], size=4, items=items)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(item" not in plan
    monkeypatch.setattr(sentiment, "PACKED_OFFSETS_ROWS", 1)
    shuffled = sentiment.day_chunk_words(raw, ["n"], size=4, items=items)
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, shuffled.collect()))


def test_a_feature_run_cuts_each_text_into_words_once(spark, monkeypatch):
    raw = spark.createDataFrame(
        [(START, "a title", "alpha beta", 1.0, 1), (START + timedelta(days=1), None, None, 2.0, 2), (None, "x", "beta", 1.0, 3)],
        "time_published date, titles string, content string, price double, n int",
    )
    scorer = sentiment.lexicon_scorer(spark.createDataFrame([("alpha", 0.0, 1.0)], "token string, neg double, pos double"))
    cut, tokens = [], sentiment.text.tokens
    monkeypatch.setattr(sentiment.text, "tokens", lambda column: cut.append(column) or tokens(column))
    path = scratch_path(spark, "features")
    features.run_features(spark, settle(raw), scorer, path, order=["n"])
    assert len(cut) == 1
    counts = {(r["time_published"], r["token"]): r["tf"] for r in spark.read.parquet(f"{path}-counts").collect()}
    assert counts == {(START, w): 1 for w in ("title", "alpha", "beta")}


def test_words_of_days_meet_in_one_shuffle(spark):
    counts = settle(spark.createDataFrame(
        [(START + timedelta(days=i % 5), f"w{i % 7}", 1 + i % 3) for i in range(35)], "day date, token string, tf long"
    ))
    weights = tfidf.tfidf(counts, 5, "day")
    columns = weights.groupBy("token").agg(F.collect_list("weight"))
    plan = columns._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(token") == 2 and "SortMergeJoin" not in plan
    rows = settle(tfidf.with_idf(counts, settle(counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))), 5))
    want = {(r["day"], r["token"]): (r["df"], r["tf"] * r["idf"]) for r in rows.collect()}
    norm = {d: sum(w**2 for (e, _), (_, w) in want.items() if e == d) ** 0.5 for d, _ in want}
    found = {(r["day"], r["token"]): (r["df"], r["weight"]) for r in weights.collect()}
    assert found == {k: (n, pytest.approx(w / norm[k[0]])) for k, (n, w) in want.items()}
