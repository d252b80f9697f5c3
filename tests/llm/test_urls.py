import itertools
import math
import re
from collections import Counter

from almanac.llm import urls
from almanac.llm.catalog import RULES
from tests.llm import cases

PAGES = [
    (1, "https://goodshop.org/books/12", "<p>good shop books</p>"), (2, "http://CHEAPpills.net/fr/buy?x=1", "<p>cheap pills good</p>"),
    (3, "https://www.example.com/en/a#b", "cheap shop"), (4, "https://a.example.com/en/", "pills"), (5, None, None), (6, "no scheme", ""),
    (7, "ftp://goodbooks.com", "<b>books</b> good"), (8, "https://cheapshop.org/es/pills/9", "x"), (9, "https://goodpills.com/books", "y"),
    (10, "https://cheap-books.net/es/pills", "z"), (10, "https://cheap-books.net/es/pills", "z"), (None, "https://shopcheap.org/?q=/en/", "w"),
    (11, "https://example.com/en", ""), (12, "x://net/es/", ""), (13, "x://" + "q" * 90 + ".org/", ""), (14, "a://b://c.com/x", ""),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "rule", 1) for r in rows], "page_id long, url string, html string, verdict string, n long")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return cases.fold(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def best(label, counts, total):
    def cost(w):
        return math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)

    splits = []
    for cuts in itertools.product((0, 1), repeat=len(label) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(label)]
        ws = [label[a:b] for a, b in zip(at, at[1:])]
        splits.append((sum(map(cost, ws)), ws))
    return max(splits, key=lambda s: round(s[0], 9))


def brute(rows):
    counts = Counter(w for _, _, html in rows for w in re.findall(r"[^\W\d_]+", cases.fold(re.sub("<[^>]*>", " ", html or ""))))
    total = sum(counts.values())

    def tokens(host, path):
        out = []
        for run in re.findall(r"[^\W\d_]+|[0-9]+", host):
            out += ["h" + w for w in (best(run, counts, total)[1] if 2 <= len(run) <= 14 else [run])]
        return out + ["p" + ("0" if w.isdigit() else w) for w in re.findall(r"[^\W\d_]+|[0-9]+", cases.fold(path))]

    seen, n = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, _ in rows:
        host, path = split(url)
        _, verdict = rule(host, path)
        if verdict:
            n[verdict] += 1
            seen[verdict].update(tokens(host, path))
    v = len(set(seen["allow"]) | set(seen["block"]))
    size = {k: sum(c.values()) for k, c in seen.items()}
    out = []
    for page, url, _ in rows:
        host, path = split(url)
        name, verdict = rule(host, path)
        if not verdict:
            score = math.log((n["allow"] + 1) / (n["block"] + 1))
            for w in tokens(host, path):
                if w in seen["allow"] or w in seen["block"]:
                    score += math.log((seen["allow"][w] + 1) / (size["allow"] + v + 1)) - math.log((seen["block"][w] + 1) / (size["block"] + v + 1))
            verdict = "allow" if score >= 0 else "block"
        out.append((page, host, path, name, verdict))
    return sorted(out, key=repr)


def test_verdicts_equal_brute_force(spark):
    found = urls.judge(pages(spark), RULES).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(PAGES)


def test_no_pages_and_no_rules(spark):
    assert urls.judge(pages(spark).where("page_id < 0"), RULES).count() == 0
    assert {r.rule for r in urls.judge(pages(spark), []).collect()} == {None}


def test_viterbi_takes_the_likeliest_split():
    counts = {"the": 50, "there": 5, "rest": 20, "re": 9, "st": 3, "t": 1}
    total = float(sum(counts.values()))
    for label in ("therest", "there", "restt", "xxthe", "q"):
        known = {(a, b): math.log(counts[label[a:b]] / total) for a in range(len(label)) for b in range(a + 1, len(label) + 1) if label[a:b] in counts}
        words = urls.best_split(label, known, total)
        cost = sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10) for w in words)
        assert "".join(words) == label
        assert math.isclose(cost, best(label, counts, total)[0])
