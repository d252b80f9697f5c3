import random
import re

import pytest

from almanac.llm import jaccard
from almanac.llm.components import components
from tests.llm import cases


def shingles(text, size):
    ws = [w for w in re.split("[\x20\x09-\x0d]+", cases.fold(text)) if w]
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((doc, len(s), None if doc is None else low[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near_copies(seed, groups=6, most=14):
    draw = random.Random(seed)
    out = []
    for g in range(groups):
        base = cases.words(draw.randrange(60, 200), seed * 100 + g, 3000)
        for _ in range(draw.randrange(1, most)):
            copy = base[:]
            for _ in range(draw.randrange(3)):
                copy[draw.randrange(len(copy))] = f"e{draw.randrange(10**6)}"
            out.append(" ".join(copy[draw.randrange(2) :]))
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(jaccard.near_duplicates(docs, "doc_id", size, percent)) == brute(rows, size, percent)


@pytest.mark.parametrize("frequent", [64, 2])
def test_near_copies_of_shared_passages(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    passage = " ".join(cases.words(25, 77))
    rows = list(enumerate(near_copies(5) + [f"{passage} {' '.join(cases.words(30, 900 + i, 9000))}" for i in range(12)] + [passage] * 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 4, 85)
    assert found(jaccard.near_duplicates(docs)) == want
    assert sum(r[0] != r[2] for r in want) > 10


def test_first_of_each_keeps_columns_and_one_of_repeated_rows(spark):
    docs = cases.documents(spark)
    kept = jaccard.first_of_each(docs, "doc_id", 5, 80)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 1 and 2 not in ids and ids.count(None) == 1 and 3 in ids and 5 in ids


def test_empty_tables(spark):
    assert jaccard.near_duplicates(cases.empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    assert found(jaccard.near_duplicates(nothing)) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_components_of_a_path_a_star_and_a_loop(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(201, 202), (202, 203), (203, 201), (300, 300)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 20)} | {(202, 201), (203, 201)}
