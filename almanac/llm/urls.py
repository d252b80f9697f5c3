"""URL filters: rules, and naive Bayes over words that unigram Viterbi finds in host names."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.frames import few, folded
from almanac.session import keep, scratch, settle

LONGEST_WORD = 20
LONGEST_LABEL = 63
MOST_RULES = 500


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null or where `://` is missing."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return folded(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule (verdict, host, path), else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) over the visible text of all pages."""
    text = folded(F.regexp_replace(F.coalesce(F.col(html).cast("string"), F.lit("")), "<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_split(label: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """Unigram Viterbi: the split of a label with the highest product of word probabilities.

    An unknown word costs ten times more a letter; among equal splits the one with the longest last word wins.
    """
    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        best.append(max(
            (best[start][0] + known.get((start, end), math.log(10 / total) - (end - start) * math.log(10)), -start)
            for start in range(max(0, end - LONGEST_WORD), end)
        ))
    words, end = [], len(label)
    while end:
        start = -best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) for every distinct host: its labels cut into words of `counts`.

    All letter runs of a host are looked up by a join of their substrings with the word counts, so the
    vocabulary is never sent around whole. A run beyond the length a name may have stays one word.
    """
    runs = hosts.select("host", F.expr(r"regexp_extract_all(host, '\\p{L}+|[0-9]+', 0)").alias("runs"))
    names = settle(runs.select(F.explode("runs").alias("label")).distinct().where(F.length("label").between(2, LONGEST_LABEL)))
    total = float(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] or 1)
    spans = names.select(
        "label", F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("start")
    ).withColumn("end", F.explode(F.sequence(F.col("start") + 1, F.least(F.length("label"), F.col("start") + LONGEST_WORD))))
    pieces = spans.withColumn("word", F.substring("label", F.col("start") + 1, F.col("end") - F.col("start")))
    met = pieces.join(counts, "word").select(
        "label", F.struct("start", "end", F.log(F.col("n") / F.lit(total)).alias("p")).alias("edge")
    )
    edges = met.groupBy("label").agg(F.collect_list("edge").alias("edges"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [
                best_split(label, {(e["start"], e["end"]): e["p"] for e in known or ()}, total)
                for label, known in zip(batch.column("label").to_pylist(), batch.column("edges").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(words, pa.list_(pa.string()))], ["label", "words"])

    cut = names.join(edges, "label", "left").select("label", "edges").mapInArrow(split, "label string, words array<string>")
    placed = runs.select("host", F.posexplode("runs").alias("pos", "label")).join(settle(cut), "label", "left")
    words = F.coalesce("words", F.array("label"))
    whole = placed.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pos", words.alias("words")))).alias("parts"))
    flat = F.flatten(F.transform("parts", lambda p: p["words"]))
    return hosts.join(whole, "host", "left").select("host", F.coalesce(flat, F.array().cast("array<string>")).alias("words"))


def path_words(path: Column) -> Column:
    """Letter runs of a path, numbers as one word."""
    found = F.regexp_extract_all(folded(path), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))
    return F.transform(found, lambda w: F.when(w.rlike("^[0-9]+$"), F.lit("0")).otherwise(w))


def _scored(names: DataFrame, name: str, ratios: DataFrame) -> DataFrame:
    """(name, score): summed log ratios of the words of every distinct host or path."""
    words = names.select(name, F.explode("words").alias("word")).join(few(ratios), "word")
    # Sums of rounded units do not depend on the order of rows.
    return words.groupBy(name).agg(F.sum("units").alias(f"{name}_units"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id") -> DataFrame:
    """Per row of `pages`: its id, host, path, rule, verdict and score (above 0 for allow).

    Rules decide where one fits. The rest is judged by multinomial naive Bayes (add-one) over the words of
    the host and of the path, learned from all pages that a rule decides; equal scores allow. Words in host
    names come from unigram Viterbi over the word counts of all pages' texts. A null url, or one without
    `://`, has an empty host and path and no words: the classes' shares decide. Repeated rows are judged alike.
    """
    with scratch(pages.sparkSession):
        return keep(_judged(pages, rules, page_id))


def _judged(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(page_id).alias("_page"), host.alias("host"), path.alias("path"))
    rows = settle(rows.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules)))
    hosts = settle(rows.select("host").distinct())
    paths = settle(rows.select("path").distinct().withColumn("words", path_words(F.col("path"))))
    hosts = settle(segment_hosts(hosts, settle(word_counts(pages))))
    labelled = rows.where("_rule IS NOT NULL").withColumn("allow", (F.col("_rule.verdict") == "allow").cast("long"))
    seen = []
    for name, table in (("host", hosts), ("path", paths)):
        by_name = settle(labelled.groupBy(name).agg(F.sum("allow").alias("a"), F.count(F.lit(1)).alias("n")))
        tagged = table.withColumn("words", F.transform("words", lambda w: F.concat(F.lit(name + ":"), w)))
        if name == "host":
            hosts = tagged
        else:
            paths = tagged
        seen.append(tagged.join(by_name, name).select(F.explode("words").alias("word"), "a", (F.col("n") - F.col("a")).alias("b")))
    counts = settle(seen[0].unionByName(seen[1]).groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    v, a, b = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    allowed, n = labelled.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.count(F.lit(1))).first()
    prior = math.log((allowed + 1) / (n - allowed + 1))
    ratio = F.log((F.col("a") + 1) / F.lit(float(a + v + 1))) - F.log((F.col("b") + 1) / F.lit(float(b + v + 1)))
    ratios = settle(counts.select("word", F.round(ratio * 1e9).cast("long").alias("units")))
    scored = rows
    for name, table in (("host", hosts), ("path", paths)):
        scored = scored.join(few(settle(_scored(table, name, ratios))), name, "left")
    units = F.coalesce("host_units", F.lit(0)) + F.coalesce("path_units", F.lit(0))
    score = units / F.lit(1e9) + F.lit(prior)
    return scored.select(
        F.col("_page").alias(page_id), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", F.when(score >= 0, "allow").otherwise("block")).alias("verdict"), score.alias("score"),
    )
