import hashlib
import re

from almanac.llm import decontaminate
from almanac.llm.frames import row_key, text_of
from pyspark.sql import functions as F
from tests.llm import cases


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.fold(text))


def brute(docs, items):
    out = []
    for doc, text in docs:
        ws, hit, names = words(text), set(), set()
        for item, passage in items:
            iw = words(passage)
            n = min(13, len(iw))
            grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(ws) - n + 1 if n else 0):
                if tuple(ws[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=repr)


def items(spark):
    ts = cases.texts()
    rows = [
        (1, " ".join(cases.words(90, 2)[:30])), (2, " ".join(cases.words(90, 2)[20:34])), (3, "one two"), (4, None), (5, "!!"),
        (6, "ONE"), (7, "aaaa " * 20), (8, ts[2]), (8, ts[2]), (9, " ".join(cases.words(5000, 4)[100:112])), (10, "never seen words here"),
    ]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, pos int")


def test_contamination_equals_brute_force(spark):
    docs = cases.documents(spark)
    rows, benchmark = items(spark)
    found = decontaminate.contamination(docs, benchmark).drop("_k1", "_k2")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], rows)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert sum(w[5] for w in want) > 3


def test_null_and_shared_item_ids(spark):
    p, q, r, s = (cases.words(30, 70 + i, 5000) for i in range(4))
    q[5] = p[5]
    benchmark = [(1, p), (1, q), (None, r), (None, s), (2, s)]
    texts = [p, q, q, q, r, s, p + r, cases.words(30, 90, 5000), q[3:20]]
    docs = [(i, " ".join(cases.words(20, i, 5000) + t)) for i, t in enumerate(texts)]
    items = [(i, " ".join(t)) for i, t in benchmark]
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want = []
    numbered = [(n, t) for n, (_, t) in enumerate(items)]
    for doc in docs:
        ids = {i for n, (i, t) in enumerate(items) if brute([doc], [numbered[n]])[0][3]}
        digest = hashlib.sha256(",".join(sorted(str(i) for i in ids if i is not None)).encode()).hexdigest()
        (_, n_words, n_hit, _, _, bad), = brute([doc], numbered)
        want.append((doc[0], n_words, n_hit, len(ids), digest, bad))
    assert sorted(map(tuple, found.drop("_k1", "_k2").collect())) == want
    assert [w[3] for w in want] == [1, 1, 1, 1, 1, 2, 2, 0, 1]


def test_clean_keeps_the_rest_and_all_columns(spark):
    docs = cases.documents(spark)
    rows, benchmark = items(spark)
    bad = [(r[0]) for r in brute([(r.doc_id, r.text) for r in docs.collect()], rows) if r[5]]
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len(bad)


def test_empty_tables(spark):
    _, benchmark = items(spark)
    assert decontaminate.contamination(cases.empty(spark), benchmark).count() == 0
    found = decontaminate.contamination(cases.documents(spark), benchmark.where("item_id < 0"))
    assert found.where("contaminated OR n_hit > 0").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "a b z z z c"), (3, "c b a")], "doc_id long, text string")
    read = docs.select(*row_key("doc_id", text_of()), decontaminate.words_of(text_of()).alias("words"))
    index = decontaminate.build_index(read, docs.select(F.explode(F.split("text", " ")).alias("word")))
    keys = {r._k1: r.doc_id for r in docs.select("doc_id", *row_key("doc_id", text_of())).collect()}

    def near(words, span):
        return {keys[r["_k1"]] for r in decontaminate.find_near(index, words, span).collect()}

    assert near(["a", "b", "c"], 5) == {1, 3}
    assert near(["a", "b"], 2) == {2, 3}
