import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from almanac.llm import classlm
from tests.llm import cases


def tokens(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", cases.fold(text)) if w] + [None]


def corpus(n=300):
    draw = random.Random(4)
    kinds = [[f"{c}{i}" for i in range(40)] for c in "ab"]
    return [" ".join(draw.choice(kinds[i % 2]) for _ in range(30)) for i in range(n)]


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i, t) for i, t in enumerate(corpus())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, docs, classlm.train(docs.where("doc_id % 7 != 2"), 6)


def test_base_score_and_counts_equal_brute_force(spark, trained):
    rows, docs, model = trained
    extra = cases.documents(spark).select("doc_id", "text", "row")
    count = Counter(t for i, text in rows if i % 7 != 2 for t in tokens(text))
    total, kinds = sum(count.values()), len(count)
    assert (model.tokens, model.types) == (total, kinds)
    for table in (docs, extra):
        want = []
        for r in table.collect():
            ts = tokens(r.text)
            base = sum(math.log10((count[t] + 1) / (total + kinds + 1)) for t in ts)
            want.append((r.doc_id, len(ts), sum(count[t] > 0 for t in ts), round(base, 6)))
        got = [(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in classlm.score(table, model).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_tokens_beyond_the_listed_words_score_the_same(spark, trained, monkeypatch):
    rows, docs, model = trained
    want = {r.doc_id: r for r in classlm.score(docs, model).collect()}
    short = classlm.Model(**{**vars(model), "listed": (model.listed[0][:5], model.listed[1][:5])})
    for r in classlm.score(docs.unionAll(docs.where("doc_id = 4")), short).collect():
        assert r.n_known == want[r.doc_id].n_known
        assert math.isclose(r.score, want[r.doc_id].score) and math.isclose(r.base_score, want[r.doc_id].base_score)


def classes_of(model, counts):
    """Class of every training word, by its hash."""
    place = {h: k for h, k in zip(model.own[0].tolist(), model.own[1].tolist())}
    return {h % 2**64: place.get(h % 2**64, model.buckets[shape]) for h, shape, _ in counts}


def test_probabilities_sum_to_one(trained):
    _, _, model = trained
    assert np.allclose((10.0**model.transitions).sum(1), 1)
    counts = [(r.h, r.shape, r.c) for r in model.counts.collect() if r.shape >= 0]
    known = classes_of(model, counts)
    mass = np.zeros(len(model.emissions))
    for h, _, c in counts:
        mass[known[h % 2**64]] += (c + 1) * 10 ** model.emissions[known[h % 2**64]]
    mass += 10.0**model.emissions  # the unseen type
    assert np.allclose(mass[:-1], 1)


@pytest.mark.parametrize("listed, frequent", [(1_000_000, 2_048), (1_000_000, 20), (50, 20), (0, 0)])
def test_score_equals_brute_force_for_the_classes_found(spark, monkeypatch, listed, frequent):
    monkeypatch.setattr(classlm, "WORDS_A_TASK", 16)
    rows = [(i, t) for i, t in enumerate([*corpus(80), "", "a1 unseen b2 a1", "new words only", "A1 a1\nb3"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = classlm.train(docs.where("doc_id % 7 != 2"), 5, listed, frequent)
    spelled = {}
    for _, text in rows:
        for word in tokens(text)[:-1]:
            found = classlm.find_words(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))
            spelled[word] = int(found.hashes[0]), int(classlm._shapes(found)[0])
    own = dict(zip(model.own[0].tolist(), model.own[1].tolist()))
    assert len(own) <= max(listed, 0)
    kind = {w: own.get(h, int(model.buckets[shape])) for w, (h, shape) in spelled.items()}
    kind[None] = 4
    train = [tokens(t) for i, t in rows if i % 7 != 2]
    count = Counter(t for ts in train for t in ts)
    pairs = Counter((kind[a], kind[b]) for ts in train for a, b in zip([None, *ts], ts))
    size = Counter()
    for word, c in count.items():
        size[kind[word]] += c + 1
    into = [sum(v for (_, b), v in pairs.items() if b == k) for k in range(5)]
    out_of = [sum(v for (a, _), v in pairs.items() if a == k) for k in range(5)]

    def step(a, b):
        share = (into[b] + 1) / (sum(into) + 5)
        return math.log10((pairs[a, b] + classlm.BETA * share) / (out_of[a] + classlm.BETA))

    got = {r.doc_id: r.score for r in classlm.score(docs, model).collect()}
    for i, text in rows:
        ts = tokens(text)
        want = sum(step(kind[a], kind[b]) for a, b in zip([None, *ts], ts))
        want += sum(math.log10((count[t] + 1) / (size[kind[t]] + 1)) for t in ts[:-1])
        # An end is a class of its own, so its emission is certain.
        assert math.isclose(got[i], want, abs_tol=1e-6), (i, got[i], want)


def test_words_placed_later_follow_their_neighbours(spark):
    """Words of two kinds by turns, none but four of them clustered first: the others find the kind they stand for."""
    draw = random.Random(8)
    texts = [" ".join(f"{'pq'[i % 2]}{min(int(draw.expovariate(0.2)), 40)}" for i in range(60)) for _ in range(120)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = classlm.train(docs, 3, 1_000_000, 4)
    assert classlm.own_share(model) == 1.0
    own = dict(zip(model.own[0].tolist(), model.own[1].tolist()))
    kinds = {"p": Counter(), "q": Counter()}
    for word, c in Counter(w for t in texts for w in t.split()).items():
        h = int(classlm.find_words(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)])).hashes[0])
        kinds[word[0]][own[h]] += c
    tops = {kind: found.most_common(1)[0] for kind, found in kinds.items()}
    assert tops["p"][0] != tops["q"][0]
    assert all(top[1] > 0.95 * sum(kinds[kind].values()) for kind, top in tops.items())


def test_gains_equal_those_of_the_exchange():
    draw = np.random.default_rng(3)
    items, classes = 14, 5
    counts = draw.integers(0, 6, (items, items)).astype(float)
    np.fill_diagonal(counts, 0)
    assigned = np.arange(items) % (classes - 1)
    assigned[-1] = classes - 1
    n = np.zeros((classes, classes))
    np.add.at(n, (assigned[:, None].repeat(items, 1), assigned[None, :].repeat(items, 0)), counts)
    left, right = np.zeros((items, classes)), np.zeros((items, classes))
    np.add.at(left.T, assigned, counts)
    np.add.at(right.T, assigned, counts.T)
    gains = classlm._gains(left, right, assigned, n)
    for item in range(items - 1):
        moved = classlm.exchange(left, right, np.zeros(items), assigned, n, [item])[item]
        best = gains[item].argmax()
        assert gains[item][best] - gains[item][moved] < 0.05 * np.abs(gains[item][:-1]).max()


def test_classes_part_the_two_vocabularies_and_beat_the_base(trained):
    rows, docs, model = trained
    held = [r for r in classlm.score(docs, model).collect() if r.doc_id % 7 == 2]
    assert all(r.score > r.base_score for r in held)


def test_an_exchange_move_never_lowers_the_likelihood():
    draw = np.random.default_rng(2)
    items, classes = 12, 4
    counts = draw.integers(0, 9, (items, items)).astype(float)
    assigned = np.arange(items) % (classes - 1)
    assigned[-1] = classes - 1

    def matrix(of):
        out = np.zeros((classes, classes))
        np.add.at(out, (of[:, None].repeat(items, 1), of[None, :].repeat(items, 0)), counts)
        return out

    def likelihood(n):
        return sum(x * math.log(x) for x in n.ravel() if x) - sum(x * math.log(x) for s in (n.sum(0), n.sum(1)) for x in s if x)

    for item in range(items - 1):
        left, right = np.zeros((items, classes)), np.zeros((items, classes))
        np.add.at(left.T, assigned, counts)
        np.add.at(right.T, assigned, counts.T)
        moved = classlm.exchange(left, right, np.diag(counts), assigned, matrix(assigned), [item])
        trials = []
        for c in range(classes - 1):
            trial = assigned.copy()
            trial[item] = c
            trials.append(likelihood(matrix(trial)))
        assert math.isclose(trials[moved[item]], max(trials))
        assigned[item] = moved[item]


def test_empty_tables(spark, trained):
    _, docs, model = trained
    assert classlm.score(cases.empty(spark), model).count() == 0
    blank = classlm.train(cases.empty(spark).select("text"), 4)
    scored = classlm.score(docs.limit(3), blank).collect()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in scored)
