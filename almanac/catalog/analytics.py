"""Registered queries over text, sentiment, resampling and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.catalog.tables import NEWS_DAYS, lemmas, lexicon, news, order_news, priced_news, rounded, table
from almanac.functions import scalars, text
from almanac.operators import neighbours, resample, sentiment, summary, tfidf
from almanac.plans import features, predict, reports, training
from almanac.schemas import FEATURES, SENTIMENT_COLUMNS
from almanac.session import scratch_path, settle


def tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("words"))
    return words.select(
        "doc_id", F.size("words").cast("long").alias("n_tokens"), F.md5(text.token_text(F.col("words"))).alias("tokens")
    )


def lemma_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = tfidf.lemmatised_text(table(spark, sf_dir, "documents"), "doc_id", "text", lemmas(spark))
    return done.withColumn("processed_text", F.md5("processed_text"))


def lemma_join_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts under a lemma table that holds every word of all documents: shuffled, its frequent words dealt over tasks."""
    documents = table(spark, sf_dir, "documents")
    words = documents.select(F.explode(text.tokens(F.col("text"))).alias("token")).distinct()
    stems = settle(words.withColumn("lemma", F.regexp_replace("token", "(?<=..)(s|en|e)$", "")))
    done = tfidf.lemmatised_text(documents, "doc_id", "text", stems, broadcast_rows=100, partition_rows=2_000)
    return done.withColumn("processed_text", F.md5("processed_text"))


def chunk_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = sentiment.text_chunks(table(spark, sf_dir, "documents"), "doc_id", "text")
    return chunks.select(
        "doc_id",
        F.col("chunk").cast("long").alias("chunk"),
        F.size("words").cast("long").alias("n_tokens"),
        F.md5(text.token_text(F.col("words"))).alias("chunk_text"),
    )


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = tfidf.document_weights(documents, "doc_id", "text")
    return rounded(weights.select("doc_id", "token", "tf", "df", "weight"), "weight")


def daily_lemma_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.day_term_counts(priced_news(spark, sf_dir), lemmas(spark))


def tfidf_pca2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.day_components(settle(news(spark, sf_dir, 60, "1995-01-01"))), "PCA1", "PCA2")


def pca_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per component of the day texts: the scores' mean, and how far they are from solving the eigen-equation.

    With the weights W of days by words and centred scores t, the centred W W' t must be a multiple of t. Both
    products run over the words, once each way; the last row holds the components' product, which must be 0.
    """
    raw, day = settle(news(spark, sf_dir, 60, "1995-01-01")), "time_published"
    counts = settle(features.day_term_counts(raw))
    days = settle(raw.select(day).distinct())
    weights = settle(tfidf.tfidf(counts, days.count(), day).select(day, "token", "weight"))
    scores = settle(tfidf.principal_components(weights, days, day))
    by_word = weights.join(scores, day).groupBy("token").agg(
        *[F.sum(F.col("weight") * F.col(c)).alias(f"v{c}") for c in ("PCA1", "PCA2")]
    )
    by_day = weights.join(by_word, "token").groupBy(day).agg(
        *[F.sum(F.col("weight") * F.col(f"v{c}")).alias(f"u{c}") for c in ("PCA1", "PCA2")]
    )
    both = settle(scores.join(by_day, day, "left").na.fill(0.0))
    centres = both.agg(*[F.avg(f"u{c}").alias(f"m{c}") for c in ("PCA1", "PCA2")]).select(F.struct("mPCA1", "mPCA2")).scalar()
    both = settle(both.withColumn("centres", centres).select("*", "centres.*").drop("centres"))
    parts = []
    for number, name in enumerate(("PCA1", "PCA2"), 1):
        t, u = F.col(name), F.col(f"u{name}") - F.col(f"m{name}")
        sums = both.agg(F.avg(t).alias("mean"), F.sum(t * t).alias("tt"), F.sum(t * u).alias("tu"), F.sum(u * u).alias("uu"))
        left = F.sqrt(F.greatest(F.lit(0.0), F.col("uu") - F.col("tu") * F.col("tu") / F.col("tt"))) / F.sqrt("uu")
        parts.append(sums.select(F.lit(number).alias("component"), "mean", left.alias("residual")))
    cross = both.agg(F.sum(F.col("PCA1") * F.col("PCA2")).alias("x"), F.sqrt(F.sum(F.col("PCA1") ** 2) * F.sum(F.col("PCA2") ** 2)).alias("n"))
    parts.append(cross.select(F.lit(12).alias("component"), F.lit(0.0).alias("mean"), (F.col("x") / F.col("n")).alias("residual")))
    checks = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return checks.select("component", *[(F.round(c, 3) + 0.0).alias(c) for c in ("mean", "residual")])


def sentiment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, scorer = table(spark, sf_dir, "documents"), sentiment.lexicon_scorer(lexicon(spark))
    return rounded(sentiment.text_sentiment(documents, "doc_id", "text", scorer), *SENTIMENT_COLUMNS, digits=9)


def daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = settle(priced_news(spark, sf_dir))
    scores = features.day_sentiment(raw, sentiment.lexicon_scorer(lexicon(spark)), ["doc_id"])
    return rounded(scores, *SENTIMENT_COLUMNS, digits=9)


def sentiment_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores read back from replies; errors come without a negative label."""
    both = F.array(
        F.struct(F.lit(scalars.NEGATIVE_LABEL).alias("label"), (F.col("value") / 1000).alias("score")),
        F.struct(F.lit(scalars.POSITIVE_LABEL).alias("label"), (F.col("value") / 500).alias("score")),
    )
    reply = F.when(F.col("event_type") == "error", F.slice(both, 2, 1)).otherwise(both)
    scored = table(spark, sf_dir, "events").select("event_id", scalars.reply_scores(F.to_json(reply)).alias("s"))
    return rounded(scored.select("event_id", "s.neg", "s.pos"), "neg", "pos")


def sentiment_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    judged = documents.join(table(spark, sf_dir, "labels"), "doc_id")
    scores = sentiment.text_sentiment(documents, "doc_id", "text", sentiment.train_scorer(judged, "text", "quality"))
    return rounded(scores, *SENTIMENT_COLUMNS)


def feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature table after a run over two thirds of the items and a run over the days that changed."""
    scorer, path = sentiment.lexicon_scorer(lexicon(spark)), scratch_path(spark, "features")
    raw = settle(priced_news(spark, sf_dir))
    later = (F.dayofmonth("time_published") > 20) | (F.dayofmonth("time_published") % 7 == 0)
    first = raw.where(~later | (F.col("doc_id") % 2 == 0))
    features.run_features(spark, first, scorer, path, lemmas(spark), ["doc_id"])
    features.run_features(spark, raw, scorer, path, lemmas(spark), ["doc_id"], days=raw.where(later))
    hashed = features.read_features(spark, path, digests=True)
    numbers = [c for c in FEATURES.names if c not in ("time_published", "day_of_week", *SENTIMENT_COLUMNS)]
    return rounded(rounded(hashed, *numbers), *SENTIMENT_COLUMNS, digits=9)


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("content"))
    return pages.select("page_id", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("content"))


def extractive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = summary.summaries(table(spark, sf_dir, "documents"), "doc_id", "text")
    return done.withColumn("summary", F.md5("summary"))


def summary_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment of the summaries instead of the whole texts."""
    done = settle(summary.summaries(table(spark, sf_dir, "documents"), "doc_id", "text"))
    scores = sentiment.text_sentiment(done, "doc_id", "summary", sentiment.lexicon_scorer(lexicon(spark)))
    return rounded(scores, *SENTIMENT_COLUMNS, digits=9)


def knn_same_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings")
    near = neighbours.nearest_in_class(points, "vec_id", "label", "embedding")
    return rounded(near.select(F.col("id").alias("vec_id"), "neighbour", "place", "d2"), "d2")


def smote_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = resample.smote(table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    return grown.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_synthetic"), 1)).alias("n_synthetic")
    )


def smote_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class how many rows are new, lie on the segment between their two rows, and have a near row as the second."""
    points = table(spark, sf_dir, "embeddings")
    grown = settle(resample.smote(points, "vec_id", "label", "embedding", trace=True).where("is_synthetic"))
    ends = points.select("vec_id", F.col("label").alias("of"), F.col("embedding").cast("array<double>").alias("x"))
    both = grown.join(ends.toDF("from_id", "of", "a"), "from_id").join(ends.toDF("to_id", "to_of", "b"), "to_id")
    near = neighbours.nearest_in_class(points, "vec_id", "label", "embedding").select(
        F.col("id").alias("from_id"), F.col("neighbour").alias("to_id"), F.lit(True).alias("is_near")
    )

    def dot(p, q):
        return F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)

    def gap(p, q):
        return F.zip_with(p, q, lambda x, y: y - x)

    moved, whole = gap(F.col("a"), F.col("embedding")), gap(F.col("a"), F.col("b"))
    step = F.try_divide(dot(moved, whole), dot(whole, whole))
    off = F.zip_with(moved, whole, lambda m, w: F.abs(m - step * w))
    on = (F.array_max(off) < 1e-9) & step.between(0.0, 1.0) & (F.col("of") == F.col("label")) & (F.col("to_of") == F.col("label"))
    judged = both.withColumn("on", on).join(near, ["from_id", "to_id"], "left")
    return judged.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_synthetic"), F.count(F.when(F.col("on"), 1)).alias("n_on_segment"),
        F.count(F.when(F.col("is_near"), 1)).alias("n_near"), F.countDistinct("from_id").alias("n_from"),
    )


def _model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = settle(order_news(spark, sf_dir, NEWS_DAYS))
    return settle(features.features(raw, sentiment.lexicon_scorer(lexicon(spark)), order=["doc_id"]))


def feature_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten reported columns, over the news of sixty days of the order series."""
    raw = settle(order_news(spark, sf_dir, 60))
    found = features.features(raw, sentiment.lexicon_scorer(lexicon(spark)), order=["doc_id"])
    return rounded(reports.correlations(settle(found)), "correlation")


def tuned_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out days with their class, and whether the stored and loaded model predicts what the fitted one does."""
    search = training.train_classifier(_model_features(spark, sf_dir), training.SMALL_CLASSIFIER_GRID)
    path = scratch_path(spark, "classifier")
    predict.save_model(search.model, path)
    held = search.extra["labelled"].where(~F.col("is_train"))
    loaded = predict.load_model(path).transform(held).select("time_published", F.col("clf_predictions").alias("loaded"))
    both = search.model.transform(held).join(loaded, "time_published")
    return both.select(
        "time_published", "return_class", "return_class_encoded",
        (F.col("clf_predictions") == F.col("loaded")).alias("same_after_loading"),
        F.col("clf_predictions").isin(0.0, 1.0, 2.0).alias("is_a_class"),
    )


def held_out_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifier's report on the held-out days: support by class, and its accuracy as counted from the predictions."""
    search = training.train_classifier(_model_features(spark, sf_dir), {k: v[:1] for k, v in training.SMALL_CLASSIFIER_GRID.items()})
    scored = search.model.transform(search.extra["labelled"].where(~F.col("is_train")))
    right = scored.agg(F.avg((F.col("label") == F.col("clf_predictions")).cast("double"))).scalar()
    agrees = F.when(F.col("class") == "accuracy", F.abs(F.col("recall") - right) < 1e-9).otherwise(F.col("f1").between(0.0, 1.0))
    return search.report.where("support > 0").select("class", F.col("support").cast("long").alias("support"), agrees.alias("agrees"))


def _rungs(search: training.Search, rank_by: str, larger: bool) -> list[tuple]:
    """(rung, trees, tried, kept, best_kept, timed): whether those kept are the best of their rung, and all fits were timed."""
    out = []
    for rung in sorted({r["rung"] for r in search.scores}):
        rows = [r for r in search.scores if r["rung"] == rung]
        sign = 1 if larger else -1
        worst_kept = min(sign * r[rank_by] for r in rows if r["kept"])
        best_lost = max((sign * r[rank_by] for r in rows if not r["kept"]), default=worst_kept)
        trees = max(r["trees"] for r in rows)
        out.append((rung, trees, len(rows), sum(r["kept"] for r in rows), worst_kept >= best_lost, all(r["seconds"] > 0 for r in rows)))
    last = [r for r in search.scores if r["kept"]][-1]
    assert last["settings"] == search.best
    return out


RUNG_SCHEMA = "rung int, trees int, tried int, kept int, best_kept boolean, timed boolean"
# Whole axes of the full grids, the others held.
SEARCHED_CLASSIFIERS = {"maxIter": [9], "maxDepth": [3], "stepSize": training.FULL_CLASSIFIER_GRID["stepSize"]}
SEARCHED_REGRESSORS = {
    "maxIter": [9], **{axis: training.FULL_REGRESSOR_GRID[axis] for axis in ("maxDepth", "stepSize")},
}


def classifier_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rungs of a halving search over all step sizes."""
    search = training.train_classifier(
        _model_features(spark, sf_dir), SEARCHED_CLASSIFIERS, search=training.halving_search
    )
    return spark.createDataFrame(_rungs(search, "accuracy", True), RUNG_SCHEMA)


def regressor_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rungs of a halving search over all depths and step sizes, stacked on a classifier."""
    table_ = _model_features(spark, sf_dir)
    clf = training.train_classifier(table_, {k: v[:1] for k, v in training.SMALL_CLASSIFIER_GRID.items()})
    search = training.train_regressor(table_, clf, SEARCHED_REGRESSORS, search=training.halving_search)
    return spark.createDataFrame(_rungs(search, "mape", False), RUNG_SCHEMA)


def tuned_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of a whole search, whether the one with the lowest error was taken, and the days it is evaluated on."""
    table_ = _model_features(spark, sf_dir)
    clf = training.train_classifier(table_, {k: v[:1] for k, v in training.SMALL_CLASSIFIER_GRID.items()})
    search = training.train_regressor(table_, clf, training.SMALL_REGRESSOR_GRID)
    lowest = min(r["mape"] for r in search.scores)
    rows = [
        (float(r["settings"]["stepSize"]), (r["settings"] == search.best) == (r["mape"] == lowest), int(search.evaluation["n"]))
        for r in search.scores
    ]
    return spark.createDataFrame(rows, "step double, lowest_is_best boolean, held_days long")


def predict_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day that is served, and whether stored and loaded models give the same answer, shown in percent."""
    table_ = _model_features(spark, sf_dir)
    clf = training.train_classifier(table_, training.SMALL_CLASSIFIER_GRID)
    reg = training.train_regressor(table_, clf, training.SMALL_REGRESSOR_GRID)
    served, models = settle(predict.predict_next(table_, clf.model, reg.model)), []
    for name, model in (("classifier", clf.model), ("regressor", reg.model)):
        path = scratch_path(spark, name)
        predict.save_model(model, path)
        models.append(predict.load_model(path))
    again = settle(predict.predict_next(table_, *models).select("time_published", F.col("prediction").alias("again")))
    return served.join(again, "time_published").select(
        "time_published", "next_day", (F.col("prediction") == F.col("again")).alias("same_after_loading"),
        (F.abs(F.col("percent") - F.col("prediction") * 100) <= 0.00051).alias("percent_of_prediction"),
    )
