"""Small tables that hold the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, k1 long, words string, row long"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def words(n, seed, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}é" if draw.random() < 0.1 else f"v{draw.randrange(vocabulary)}" for _ in range(n)]


def texts():
    """Texts with copies, near copies, shared passages and lines, and edge cases; ids are their places."""
    base = words(120, 1)
    passage = " ".join(words(90, 2))
    near = base[:]
    near[60] = "other"
    far = base[:]
    for i in range(0, 120, 8):
        far[i] = f"x{i}"
    return [
        " ".join(base), " ".join(base).upper(), " ".join(near), " ".join(far), None, "", "\n", " \t ", "one", "One two", "one two three four",
        "head a\n" + passage + "\nshared line of text\ntail", "Shared LINE of text \n" + passage + " end", "x " + passage,
        "aaaa " * 300, "ab" * 500, "line only once here\n\n\nline only once here", "é" * 9 + "\n" + "é" * 10, "é" * 10,
        "you are an idiot and a moron " + " ".join(words(30, 3)), "▁ literal ▁▁ mark\x00\U0001f642", " ".join(words(5000, 4)),
    ]


def documents(spark, extra=()):
    rows = [(i, t, "en", "src", len(t or ""), "s", 1, "w", 2) for i, t in enumerate(texts())]
    rows += [(*rows[0][:2], None, None, None, None, None, None, None)]  # a repeated row
    rows += [(None, texts()[0], "en", "src", 0, "s", 1, "w", 2), *extra]  # a null id
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
