"""Extractive summary: the sentences whose words weigh most, in their own order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanac.functions import text
from almanac.operators.tfidf import by_document, document_frequencies, idf, least_broadcast, rare_marks

SUMMARY_SENTENCES = 3


def sentence_scores(df: DataFrame, doc: str, content: str) -> DataFrame:
    """(doc, pos, score): mean TF-IDF weight of the sentence's words within their document."""
    frequencies = document_frequencies(df, content)
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    least = least_broadcast(frequencies)
    marks = rare_marks(df, doc, content, frequencies, least)
    # Whole texts are laid out by document; the word counts, both windows and the sentence sums then stay in place.
    laid = by_document(df.select(doc, content), doc, content, marks)
    if marks is None:
        laid = laid.withColumns({"token": F.lit(None).cast("string"), "mark": F.lit(None).cast("long")})
    either = F.when(F.col("mark").isNull(), text.sentences(F.col(content))).otherwise(F.array("token"))
    rows = laid.select(doc, "mark", F.posexplode(either).alias("pos", "sentence"))
    words = rows.select(doc, "mark", "pos", F.explode(F.when(F.col("mark").isNull(), text.tokens(F.col("sentence"))).otherwise(F.array("sentence"))).alias("token"))
    counts = words.where(F.length("token") >= text.MIN_TERM_LENGTH).groupBy(doc, "pos", "token", "mark").agg(
        F.count(F.when(F.col("mark").isNull(), 1)).alias("n")
    )
    same = W.partitionBy(doc, "token")
    counted = counts.withColumns({"tf": F.sum("n").over(same), "rare": F.max("mark").over(same)}).where(F.col("mark").isNull())
    met = counted.join(F.broadcast(frequencies.where(F.col("df") >= least)), "token", "left").withColumn("df", F.coalesce("rare", "df"))
    weighed = met.where(F.col("df").isNotNull()).withColumn("weight", F.col("tf") * idf(F.col("df"), n_docs))
    # A word's squared weight counts once per document, so its rows share it by n / tf.
    norm = F.sqrt(F.sum(F.col("weight") ** 2 * F.col("n") / F.col("tf")).over(W.partitionBy(doc)))
    return (
        weighed.withColumn("weight", F.col("weight") / norm)
        .groupBy(doc, "pos")
        .agg((F.sum(F.col("weight") * F.col("n")) / F.sum("n")).alias("score"))
    )


def summaries(df: DataFrame, doc: str, content: str, k: int = SUMMARY_SENTENCES) -> DataFrame:
    """(doc, summary) of the k best sentences, ties to the earlier one; NULL for a text without words."""
    ranked = sentence_scores(df, doc, content).withColumn(
        "place", F.row_number().over(W.partitionBy(doc).orderBy(F.desc(F.round("score", 9)), "pos"))
    )
    best = ranked.where(F.col("place") <= k).groupBy(doc).agg(F.array_sort(F.collect_list("pos")).alias("picked"))
    whole = df.select(doc, text.sentences(F.col(content)).alias("sentences")).join(best, doc, "left")
    chosen = F.transform("picked", lambda p: F.get("sentences", p))
    return whole.select(doc, F.array_join(chosen, " ").alias("summary"))
