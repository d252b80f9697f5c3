"""Columns named like the operators' own, queries side by side, and what they leave behind."""

import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from almanac.llm import catalog, decontaminate, jaccard, linededup, pieces, resample, sharding, spellings, substrings, toxicity
from almanac.session import shared_folder
from tests.conftest import SMALL
from tests.llm import cases

HERE = os.path.dirname(linededup.__file__)
OWN = sorted({
    name for file in os.listdir(HERE) if file.endswith(".py")
    for name in re.findall(r"""["'](_?[a-z][a-z0-9_]{0,14})["']""", open(os.path.join(HERE, file)).read())
} - {"doc_id", "text"})


@pytest.fixture(scope="module")
def crowded(spark):
    """The awkward rows with a column for every short name that the operators' code mentions, and one per case of it."""
    rows = cases.documents(spark).select("doc_id", "text")
    return rows.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in OWN])


def content(df, columns):
    return sorted(map(repr, df.select(*[f"`{c}`" for c in columns]).collect()))


def plain(df):
    return df.select("doc_id", "text")


def test_there_are_many_names():
    assert {"_row", "_code", "_gone", "_row0", "_own", "_bytes", "row", "gone", "lines"} & set(OWN) and len(OWN) > 150


@pytest.mark.parametrize("name", ["assign_shards", "dedup_lines", "clean", "first_of_each", "below"])
def test_operators_that_keep_all_columns(spark, crowded, name):
    model = toxicity.Model({"idiot": 0.9}, frozenset(), frozenset(), -3.0, 5.0)
    benchmark = spark.createDataFrame([(1, cases.texts()[11])], "item_id long, text string")
    run = {
        "assign_shards": lambda d: sharding.assign_shards(d, "doc_id", 3000),
        "dedup_lines": linededup.dedup_lines,
        "clean": lambda d: decontaminate.clean(d, benchmark),
        "first_of_each": lambda d: jaccard.first_of_each(d, "doc_id", 5, 80),
        "below": lambda d: toxicity.below(d, model, 0.7),
    }[name]
    made = {"assign_shards": {"shard", "depth", "n_bytes"}, "dedup_lines": {"n_lines", "n_dropped", "kept"}}.get(name, set())
    out, alone = run(crowded), run(plain(crowded))
    assert set(out.columns) == set(crowded.columns) | made
    assert content(out, ["doc_id", "text", *sorted(made)]) == content(alone, ["doc_id", "text", *sorted(made)])
    kept = [c for c in OWN if c not in made]
    wrong = out.where(" OR ".join(f"NOT (`{c}` <=> concat('{c}', string(doc_id)))" for c in kept))
    assert wrong.isEmpty()


def test_operators_that_read_id_and_text(spark, crowded):
    vocabulary = pieces.read_vocabulary(catalog.VOCABULARY)
    benchmark = spark.createDataFrame([(1, cases.texts()[11])], "item_id long, text string")
    for run in (
        lambda d: jaccard.near_duplicates(d, "doc_id", 5, 80), substrings.remove_repeats,
        lambda d: decontaminate.contamination(d, benchmark), lambda d: pieces.encode(d, vocabulary, 1, 0.1),
        lambda d: spellings.variants(d, least=1, shortest=2), lambda d: resample.resample(d, benchmark, 50),
    ):
        out, alone = run(crowded), run(plain(crowded))
        columns = [c for c in alone.columns if c not in ("rank",)]
        assert out.columns == alone.columns and content(out, columns) == content(alone, columns)


def test_queries_in_threads_give_what_they_give_alone(spark):
    names = ["op1_line_dedup", "op3_sharding", "op13_reply_trees", "op1_line_dedup"]
    alone = {name: content(catalog.queries()[name](spark, SMALL), catalog.queries()[name](spark, SMALL).columns) for name in set(names)}

    def run(name):
        found = catalog.queries()[name](spark, SMALL)
        return content(found, found.columns)

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(run, names)) == [alone[name] for name in names]


@pytest.mark.parametrize("name, most", [("op1_line_dedup", 1), ("op3_sharding", 1), ("op11_spelling_variants", 1), ("op12_importance_resampling", 1), ("op13_reply_trees", 1)])
def test_only_the_result_is_left_behind(spark, name, most):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    catalog.queries()[name](spark, SMALL).count()
    assert len(set(os.listdir(folder)) - before) <= most
