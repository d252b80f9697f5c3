"""The cleaning pipeline over `documents`: toxicity, line dedup, near duplicates, contamination, piece ids.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return
the columns of documents; the last returns the piece ids of each document that is left. A table without rows,
null ids and texts, repeated rows and further columns pass through every stage as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import decontaminate, jaccard, linededup, pieces, toxicity
from almanac.llm.catalog import DROPOUT, SEED, TOXIC, VOCABULARY
from almanac.session import keep, scratch

SHINGLE_WORDS = 5
ALIKE_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labels of two thirds of the ids."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    return toxicity.below(docs, model, TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one holds; n_chars counts what is left."""
    kept = linededup.dedup_lines(docs, out="text")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return jaccard.first_of_each(docs, "doc_id", SHINGLE_WORDS, ALIKE_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover less than a twentieth."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document under merge-dropout, and whether they decode to its text."""
    return pieces.encode(docs, pieces.read_vocabulary(VOCABULARY), SEED, DROPOUT)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

# Learned scores and piece merges are beyond SQL; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next; only the last one's rows stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):
        for _, stage in STAGES[:-1]:
            with scratch(spark):
                docs = keep(stage(spark, docs, sf_dir))
        return keep(STAGES[-1][1](spark, docs, sf_dir))
