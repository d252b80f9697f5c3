import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from almanac.llm import spellings
from tests.llm import cases

OUT = ["word", "n", "n_near", "form", "form_n", "root"]


def brute(rows, least=3, shortest=5, ratio=2, noise=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = cases.fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= least and len(w) >= shortest}
    gaps = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            near[w] |= gaps[w[:i], w[i + 1 :]] - {w}
            shorter = w[:i] + w[i + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


def found(df, **more):
    rows = [tuple(r) for r in spellings.variants(df, noise=97, **more).select(*OUT).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def variants_of(draw, word):
    at = draw.randrange(len(word) + 1)
    c = draw.choice("abcdeé×÷ÿ")
    return draw.choice([word[:at] + c + word[at:], word[:at] + c + word[at + 1 :], word[:at] + word[at + 1 :], word])


@pytest.mark.parametrize("range_words", [1, 7, 100_000])
def test_equals_brute_force_however_words_are_cut_into_ranges(spark, monkeypatch, range_words):
    monkeypatch.setattr(spellings, "TRIE_WORDS", range_words)
    draw = random.Random(3)
    bases = ["".join(draw.choice("abÀé") for _ in range(draw.randrange(4, 9))) for _ in range(8)]
    docs = []
    for i in range(60):
        words = [variants_of(draw, variants_of(draw, draw.choice(bases))) if draw.random() < 0.5 else draw.choice(bases) for _ in range(20)]
        docs.append((i % 50, " ".join(w.upper() if draw.random() < 0.2 else w for w in words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df) == brute(docs)


def test_equal_neighbours_long_words_and_chains(spark):
    long = "ab" * 4000
    texts = [
        "aaaaaa " * 20 + "aaaaa " * 9 + "aaaaaaa " * 4, f"{long} " * 9 + f"{long[:4000]}x{long[4000:]} " * 3 + f"{long[:-1]}c " * 3,
        "words " * 60 + "wordz " * 30 + "wortz " * 15 + "wirtz " * 7 + "firtz " * 3,
    ]
    docs = list(enumerate(texts))
    out = found(spark.createDataFrame(docs, "doc_id long, text string"))
    assert out == brute(docs)
    roots = {r[0]: r[5] for r in out}
    assert roots["firtz"] == "words" and roots["aaaaa"] == "aaaaaa"


def test_awkward_tables(spark):
    df = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df, least=1, shortest=2) == brute(rows, 1, 2)
    clashing = df.select("doc_id", "text", *[df.lang.alias(c) for c in ("word", "id", "path", "n", "_part", "best", "root")])
    assert found(clashing, least=1, shortest=2) == brute(rows, 1, 2)
    assert found(cases.empty(spark)) == set()
    assert found(df.where("text IS NULL")) == set()


def test_a_trie_numbers_equal_prefixes_alike():
    trie = spellings.Trie("", [], 1)
    paths = {w: trie.add(w).tolist() for w in sorted(["abc", "abd", "ab", "b", "abcde", "abde"])}
    number = {}
    for word, path in paths.items():
        for i, node in enumerate(path):
            assert number.setdefault(word[:i], node) == node
    assert sorted(number.values()) == list(range(len(number)))
