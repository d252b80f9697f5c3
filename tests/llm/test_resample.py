import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from almanac.llm import resample
from almanac.llm.crc import extend
from tests.llm import cases

OUT = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.fold(text))
    return len(words), [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, least=20, buckets=10_000):
    def counts(texts):
        out = [0] * buckets
        for text in texts:
            for f in features(text)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(text for _, text in docs), counts(target)
    big_s, big_t = float(sum(s) + buckets), float(sum(t) + buckets)
    gain = [math.floor(1000 * math.log(((b + 1) * big_s) / ((a + 1) * big_t))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        n, names = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in names)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, n, len(names), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for i, row in enumerate(able[: len(able) * percent // 100]):
        row[5] = i + 1
    return sorted(map(tuple, rows), key=repr)


def found(spark, df, target, **more):
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resample.resample(df, texts, **more).select(*OUT).collect()), key=repr)


def test_checksums_equal_the_library():
    draw = random.Random(1)
    spans = [bytes(draw.randrange(256) for _ in range(n)) for n in [0, 1, 2, 63, 64, 65, 66, 700, *range(20)]]
    data = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(s) for s in spans])
    before = np.array([zlib.crc32(bytes([i])) for i in range(len(spans))], np.uint32)
    got = extend(before, data, ends - [len(s) for s in spans], ends)
    assert got.tolist() == [zlib.crc32(s, int(b)) for s, b in zip(spans, before)]


@pytest.mark.parametrize("percent", [1, 5, 50, 100])
def test_equals_brute_force(spark, percent):
    draw = random.Random(percent)
    docs = [(i, " ".join(cases.words(draw.randrange(0, 60), i, 80))) for i in range(300)]
    target = [" ".join(cases.words(50, 1000 + i, 40)) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert found(spark, df, target, percent=percent) == brute(docs, target, percent)


def test_cutoff_is_exact_for_every_rank_with_ties_and_uneven_partitions(spark):
    draw = random.Random(5)
    keys = [(draw.choice([-5, 0, 0, 0, 7, 7, draw.randrange(-50, 50)]), seq) for seq in range(200)]
    df = spark.createDataFrame(keys, "score long, _seq long")
    uneven = df.where("_seq < 3").unionByName(df.where("_seq >= 3").repartition(5)).cache()
    best = sorted(keys, key=lambda k: (-k[0], k[1]))
    for wanted in (1, 2, 57, 100, 199, 200):
        assert resample.cutoff(uneven, wanted) == best[wanted - 1]
    uneven.unpersist()


def test_awkward_tables(spark):
    df = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    target = [None, "", "an idiot and a moron", *[r[1] for r in rows[:3]]]
    want = brute(rows, target, 50)
    assert found(spark, df, target, percent=50) == want
    clashing = df.select("doc_id", "text", *[df.lang.alias(c) for c in ("_id", "_seq", "_row", "score", "rank", "weight", "_part")])
    assert found(spark, clashing, target, percent=50) == want
    assert found(spark, cases.empty(spark), target) == []
    assert found(spark, df, []) == brute(rows, [])
    named = df.selectExpr("'d' || lpad(doc_id, 4, '0') AS doc_id", "text").where("doc_id IS NOT NULL")
    rows = found(spark, named, target, percent=50)
    ranks = sorted(r[5] for r in rows if r[5])
    assert all(r[0].startswith("d") for r in rows) and ranks == list(range(1, 1 + sum(r[1] >= 20 for r in rows) // 2))
