import hashlib
import random

import pytest

from almanac.llm import substrings, suffixes
from tests.llm import cases


def brute(texts, span=400):
    count = {}
    for t in texts:
        for i in range(len(t) - span + 1):
            count[t[i : i + span]] = count.get(t[i : i + span], 0) + 1
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if count[t[i : i + span]] > 1:
                mark[i : i + span] = b"\1" * span
        kept = bytes(c for c, m in zip(t, mark) if not m)
        runs = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        out.append((len(t), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.remove_repeats(docs).collect()}
    want = brute([(t or "").encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want
    return sum(w[1] for w in want)


def test_suffix_arrays_equal_sorting():
    draw = random.Random(3)
    for letters in (2, 3, 9):
        for _ in range(200):
            text = [draw.randrange(1, letters + 1) for _ in range(draw.randrange(50))] + [0]
            order = suffixes.suffix_array(text, letters + 1)
            assert order == sorted(range(len(text)), key=lambda i: text[i:])
            shared = suffixes.common_prefixes(text, order)
            for a, b in zip(order, order[1:]):
                same = 0
                while text[a + same] == text[b + same]:
                    same += 1
                assert shared[b] == same


def test_removed_bytes_equal_brute_force(spark):
    assert check(spark, cases.texts() + [cases.texts()[0], "short"]) > 1000


@pytest.mark.parametrize("most,filtered", [(10_000, 0), (1, 4_000_000)])
def test_finer_units_and_unfiltered_anchors_give_the_same(spark, monkeypatch, most, filtered):
    monkeypatch.setattr(substrings, "MOST_CONTEXTS", most)
    monkeypatch.setattr(substrings, "FILTERED_ANCHORS", filtered)
    passage = " ".join(cases.words(100, 7))
    around = [f"{i} {' '.join(cases.words(20, 50 + i))} {passage} {' '.join(cases.words(20, 90 + i))}" for i in range(6)]
    assert check(spark, around + [passage[3:500], "z" * 1200, "y" * 399, "q" * 400, "q" * 401, None]) > 1000


def test_edges_of_400_bytes(spark):
    draw = random.Random(9)
    letters = [chr(97 + draw.randrange(26)) for _ in range(3000)]
    a = "".join(letters)
    check(spark, [a[:1000], "!" + a[300:700] + "!", "?" + a[800:1000] + a[:199], a[500:899], a[100:499] + "#"])


def test_rows_without_id_repeated_rows_and_no_rows(spark):
    docs = cases.documents(spark)
    out = substrings.remove_repeats(docs)
    assert out.count() == docs.count()
    null = out.where("doc_id IS NULL").first()
    assert null.n_removed == null.n_bytes > 0
    assert substrings.remove_repeats(cases.empty(spark)).count() == 0


def test_long_texts_are_cut_in_pieces_of_windows(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 700)
    passage = " ".join(cases.words(700, 5))
    check(spark, [passage, "lead " + passage[1000:], passage[:450]])
