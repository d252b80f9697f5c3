"""Every operator's query against its SQL twin or its promises, and the pipeline, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm import catalog, pieces, toxicity
from almanac.session import settle, shared_folder
from tests.conftest import SMALL
from tests.llm import cases, test_decontaminate, test_jaccard, test_linededup
from tests.test_catalog import sorted_rows

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    found = catalog.queries()[name](spark, SMALL)
    assert sorted(found.columns) == sorted(names)
    assert sorted_rows(found.columns, found.collect()) == sorted_rows(names, cursor.fetchall())


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.queries()) == list(range(1, 14))


def test_native_operators_run_no_python(spark):
    for name in ("op3_sharding", "op6_decontamination", "op13_reply_trees"):
        plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    """Every stage against a plain version on what the one before kept; toxicity by the scores of its own model."""
    folder = str(tmp_path)
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    planted = [
        (9_001, f"{' '.join(cases.words(60, 5))}"), (9_002, f"{' '.join(cases.words(60, 5))} more"),
        (9_003, f"intro of three words {benchmark[0][1]}"), (9_004, None), (9_005, ""), (9_006, "one shared line of text\nand another"),
        (9_007, "One shared line of TEXT  \nnot the same"), (9_008, benchmark[1][1] + " " + " ".join(cases.words(4000, 6))),
    ]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in base + planted], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.learn(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = [(i, t) for i, t in base + planted if scores[i] < catalog.TOXIC]
    wanted = [rows]
    rows = [(i, kept) for i, _, _, kept in test_linededup.brute(rows)]
    wanted.append(rows)
    component = {i: c for i, _, c in test_jaccard.brute(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.ALIKE_PERCENT)}
    rows = [(i, t) for i, t in rows if component[i] == i]
    wanted.append(rows)
    bad = {r[0] for r in test_decontaminate.brute(rows, benchmark) if r[-1]}
    wanted.append([(i, t) for i, t in rows if i not in bad])
    assert 9_003 in bad and 9_002 not in dict(wanted[2]) and 9_008 in dict(wanted[3])
    found = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], wanted):
        found = settle(stage(spark, found, folder))
        assert found.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in found.na.fill("", ["text"]).collect()) == sorted((i, t or "") for i, t in want), name
        assert found.where("n_chars != length(coalesce(text, ''))").isEmpty()
    last = {i: t or "" for i, t in wanted[-1]}
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    out = corpus_pipeline.run(spark, folder)
    decoded = pieces.decode(out, pieces.read_vocabulary(catalog.VOCABULARY))
    assert {r.doc_id: r.text for r in decoded.collect()} == last and out.where("NOT lossless").isEmpty()
    assert len(set(os.listdir(shared_folder(spark).removeprefix("file:"))) - before) <= 1
