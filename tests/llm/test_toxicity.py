import random

from almanac.llm import toxicity
from tests.llm import cases


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_matches_equal_brute_force():
    draw = random.Random(5)
    terms = ["idiot", "moron", "scum", "worthless", "disgusting", "lowei", "aabab"]
    matcher = toxicity.Matcher([*terms, "stem+"], frozenset(["moron"]))

    def brute(word):
        begun = [t for t in terms if word.startswith(t)]
        if begun or (word.startswith("stem") and word != "stem"):
            return (begun[0] if begun else "stem+", 0)
        near = [(edits(word, t), t) for t in terms if edits(word, t) <= matcher.allowed(t)]
        return (min(near)[1], min(near)[0]) if near else None

    for _ in range(10_000):
        word = list(draw.choice([*terms, "stem"]))
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(word) + 1)
            step = draw.randrange(3)
            if step == 0:
                word.insert(at, draw.choice("abiodlmxé"))
            elif at < len(word):
                word[at : at + 1] = [] if step == 1 else [draw.choice("abiodlmx")]
        assert matcher.match("".join(word)) == brute("".join(word))


def labelled(spark, n=400):
    insults, rows, labels = ["idiot", "moron", "trash"], [], []
    for i in range(n):
        ws, toxic = cases.words(60, i, 2000), i % 5 == 0
        if toxic:
            for k in range(3):
                ws[10 + 15 * k] = insults[(i + k) % 3]
            ws[5] = f"grumb{ws[6]}"
        rows.append((i, " ".join(ws), "x", 1.0))
        labels.append((i, int(toxic), 1))
    rows += [(n, None, "x", 1.0), (n + 1, "", "x", 1.0), (None, rows[0][1], "x", 1.0), rows[0]]
    labels += [(None, 1, 1), (3, None, 1), (5, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, weight double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_accuracy_and_edge_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels.where("doc_id % 3 != 1 OR doc_id IS NULL"))
    assert {"idiot", "moron", "trash"} <= set(model.terms) and any(t.startswith("grumb") for t in model.terms)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if i % 3 == 1]
    assert all((out[i].score >= 0.7) == (i % 5 == 0) for i in held)
    assert out[400].score == out[401].score < 0.1 and out[None].score == out[0].score
    kept = toxicity.below(docs, model, 0.7)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 80 - 2


def test_misspellings_and_quotations(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels)
    plain = " ".join(cases.words(12, 999))
    texts = [
        f"{plain} you idiot {plain} moron {plain}", f"{plain} you idioot {plain} moroon {plain} morron", f'{plain} the word "idiot" is rude {plain}',
        f"{plain} they said idiot to him {plain}", plain,
    ]
    scores = [r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert min(scores[:2]) >= 0.7 and scores[2] < 0.7 and scores[4] < scores[2] < scores[0] and scores[3] < scores[0]


def test_every_term_within_the_bound_stays_and_long_words_stay_whole(spark):
    """Forty insults of thirteen letters, each in a few toxic texts only."""
    draw = random.Random(9)
    insults = ["".join(draw.choice("bcdfghklmnprstvw") + draw.choice("aeiou") for _ in range(6)) + "x" for _ in range(40)]
    rows, labels = [], []
    for i in range(1600):
        ws, toxic = cases.words(30, i, 3000), i % 4 == 0
        if toxic:
            ws[7] = insults[(i // 4) % 40]
        rows.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(insults) <= set(model.terms)
    plain = " ".join(cases.words(12, 999))
    wrong = [w[:4] + "q" + w[5:] for w in insults]
    texts = spark.createDataFrame([(i, f"{plain} {w} {plain}") for i, w in enumerate(wrong)], "doc_id long, text string")
    assert toxicity.score(texts, model).where("hits = 0").isEmpty()


def test_capitals_change_no_score(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels.where("doc_id % 3 != 1"))
    plain = " ".join(cases.words(12, 999))
    texts = [
        f"{plain} you idiot {plain} moron {plain}", f"Moron {plain}. Idiot {plain}", f"{plain} they said idiot {plain}",
        f"{plain} you idioot {plain}", plain,
    ]
    forms = [f(t) for t in texts for f in (str, str.upper, str.title)]
    table = spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")
    out = [(r.hits, r.score) for r in toxicity.score(table, model).orderBy("doc_id").collect()]
    assert all(out[i] == out[i + 1] == out[i + 2] for i in range(0, 15, 3))
    assert min(out[0][1], out[3][1]) >= 0.7 and out[2][0] == 2 and out[12][0] == 0
    assert toxicity.below(table.where("doc_id < 6"), model, 0.7).count() == 0


def test_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 10)
    for none in (labels.where("toxic > 5"), labels.where("toxic = 0")):
        model = toxicity.learn(docs, none)
        assert {r.score < 0.01 for r in toxicity.score(docs, model).collect()} == {True}
    assert toxicity.score(cases.empty(spark), toxicity.learn(cases.empty(spark), labels)).count() == 0
