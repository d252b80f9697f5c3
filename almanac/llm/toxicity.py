"""Toxicity: a learned lexicon matched through a Levenshtein automaton, weighed by the words around each hit.

The lexicon's terms are word beginnings: a whole insult, or, with a + behind it, a stem that is an insult only
with an ending.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.decontaminate import words_of
from almanac.llm.frames import text_of, texts_to_python
from almanac.llm.words import FOLD, MARKS, find_words, text_blocks
from almanac.session import scratch, settle

TRAINING_ROWS = 12_000
CHANCE = 0.01
PRECISE = 0.9
SHORTEST, LONGEST = 3, 10
CLEAN_FORMS = 3
NEAR = 6
MISSPELT, QUOTED, AIMED = 0.75, 0.25, 1.25
# English words that report speech, and words that address a reader.
REPORTING = {b"said", b"says", b"wrote", b"writes", b"quote", b"quoted", b"quoting", b"called", b"term", b"word", b"phrase"}
ADDRESS = {b"you", b"your", b"youre", b"u", b"ur"}
QUOTES = (b'"', "“".encode(), "”".encode(), "«".encode(), "»".encode(), "„".encode())


def allowed_errors(length: int) -> int:
    """Edits that a misspelling of a term of `length` letters may have."""
    return 0 if length < 5 else 1 if length < 9 else 2


class Matcher:
    """The lexicon trie intersected with a Levenshtein automaton, made deterministic as words are read.

    A state is a set of (trie node, edits so far); reading a letter may follow it, replace it, or skip it in
    either the word or the term. Reached states are kept, so a word costs one look-up a letter and most
    words die within a few.
    """

    def __init__(self, terms: list[str], strict: frozenset[str] = frozenset()):
        """`strict` terms take no edits."""
        self.strict = strict
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.limit = [0]
        for term in sorted(terms):
            node = 0
            stem = term.removesuffix("+")
            self.limit[0] = max(self.limit[0], self.allowed(term))
            for letter in stem:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.limit.append(0)
                node = self.children[node][letter]
                self.limit[node] = max(self.limit[node], self.allowed(term))
            self.term[node] = term
        self.letters = frozenset(c for node in self.children for c in node)
        self._forget()

    def _forget(self) -> None:
        """Drop the states reached so far; a lexicon's states are few, but nothing else bounds them."""
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.begun: list[str | None] = []
        self.stems: list[str | None] = []
        self.accepted: list[tuple[str, int] | None] = []
        self.steps: dict[tuple[int, str], int] = {}
        self._number(self._closed({0: 0}))

    def allowed(self, term: str) -> int:
        return 0 if term in self.strict or term.endswith("+") else allowed_errors(len(term))

    def _closed(self, state: dict[int, int]) -> tuple:
        """With every node that skipping letters of a term reaches."""
        todo = list(state)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                edits = state[node] + 1
                if edits <= self.limit[child] and edits < state.get(child, 99):
                    state[child] = edits
                    todo.append(child)
        return tuple(sorted(state.items()))

    def _number(self, state: tuple) -> int:
        """The number of a state, -1 for the empty one."""
        if not state:
            return -1
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            ends = [(e, t) for n, e in state if (t := self.term[n]) is not None and e <= self.allowed(t)]
            self.stems.append(min((t for e, t in ends if t.endswith("+")), default=None))
            ends = [x for x in ends if not x[1].endswith("+")]
            self.begun.append(min((t for e, t in ends if not e), default=None))
            self.accepted.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.numbers[state]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.limit[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.states[state]:
            reach(node, edits + 1)
            for own, child in self.children[node].items():
                reach(child, edits + (own != letter))
        return self._number(self._closed(reached))

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, 0) if the word begins with a term, else the nearest term that the whole word misspells.

        The number is that of the edits; the first term counts among equals.
        """
        if len(self.states) > 20_000:
            self._forget()
        state, steps = 0, self.steps
        for letter in word:
            if self.stems[state] is not None:
                return self.stems[state], 0
            if letter not in self.letters:
                letter = ""
            after = steps.get((state, letter))
            if after is None:
                after = steps[state, letter] = self._step(state, letter)
            if after < 0:
                return None
            state = after
            if self.begun[state] is not None:
                return self.begun[state], 0
        return self.accepted[state]


@dataclass
class Model:
    """Terms with their weights, terms that take no edits, clean words near a term, the score's two numbers."""

    terms: dict[str, float] = field(default_factory=dict)
    strict: frozenset[str] = frozenset()
    clean: frozenset[str] = frozenset()
    base: float = -20.0
    slope: float = 0.0


def _context(data: np.ndarray, found, n: int, low: int, high: int) -> float:
    """Weight of the words and marks within NEAR words of word n, inside words low to high of its text."""
    a, b = max(low, n - NEAR), min(high, n + NEAR + 1)
    before = data[found.starts[a] : found.starts[n]].tobytes()
    after = data[found.ends[n] : found.ends[b - 1]].tobytes()
    opened = sum(before.count(q) for q in QUOTES) % 2 == 1
    closed = any(q in after for q in QUOTES)
    near = [found.word(i) for i in range(a, b) if i != n]
    if opened and closed:
        return QUOTED
    if any(w in REPORTING for w in near):
        return QUOTED * 2
    return AIMED if any(w in ADDRESS for w in near) else 1.0


def _measure(column: pa.Array, model: Model, matcher: Matcher) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the hits, hits) of every text."""
    weight, hits = np.zeros(len(column)), np.zeros(len(column), dtype=np.int64)
    shortest = min(map(len, model.terms), default=1)
    for at, to, data, offsets in text_blocks(column):
        data = FOLD[data]  # MARKS counts A-Z as separators
        found = find_words(data, offsets, MARKS)
        size = found.ends - found.starts
        fits = np.flatnonzero(size >= shortest - 2)
        names, first = np.unique(found.hashes[fits], return_index=True)
        met: dict[int, float] = {}
        for name, i in zip(names.tolist(), fits[first].tolist()):
            word = found.word(i)[:200].decode("utf-8", "replace")
            hit = matcher.match(word)
            if hit and not (hit[1] and word in model.clean):
                met[name] = model.terms[hit[0]] * (MISSPELT if hit[1] else 1.0)
        if not met:
            continue
        for n in np.flatnonzero(np.isin(found.hashes, np.fromiter(met, dtype=np.uint64, count=len(met)))).tolist():
            text = int(np.searchsorted(found.bounds, n, "right")) - 1
            weight[at + text] += met[int(found.hashes[n])] * _context(data, found, n, *found.bounds[text : text + 2])
            hits[at + text] += 1
    return weight, hits


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id") -> DataFrame:
    """Per row of `docs`: its id, hits, weight and score (0 to 1).

    A word that begins with a term is a hit, and so is a misspelling of a whole term, unless clean training
    texts use it as a word of its own. A hit inside quotation marks or near a reporting verb weighs less, one
    near an address to the reader more. Empty and null texts have no hits and the lowest score. Every row
    is scored by itself, whole, so repeated rows, null ids and further columns change nothing.
    """
    read = texts_to_python(docs).select(F.col(doc_id).alias("_doc"), text_of().alias("_text"))
    schema = T.StructType([
        T.StructField("_doc", read.schema["_doc"].dataType),
        T.StructField("hits", T.LongType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(list(model.terms), model.strict)
        for batch in batches:
            weight, hits = _measure(batch.column(1), model, matcher)
            columns = (hits, weight, _score(weight, model))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in columns)], schema.names)

    return read.mapInArrow(run, schema).withColumnRenamed("_doc", doc_id)


def below(docs: DataFrame, model: Model, limit: float) -> DataFrame:
    """The rows of `docs` that score below `limit`, all columns kept.

    Rows are scored as `score` says, each by itself: null and empty texts have the lowest score, repeated rows stay or go
    together, ids are not read, and no name of a column matters but that of the text. No rows give no rows.
    """
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(list(model.terms), model.strict)
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            weight, _ = _measure(batch.column(text).cast(pa.string()), model, matcher)
            yield batch.filter(pa.array(_score(weight, model) < limit))

    return texts_to_python(docs).mapInArrow(run, docs.schema)


def _score(weight: np.ndarray, model: Model) -> np.ndarray:
    """Rounded, so that sums in another order give the same digits."""
    return np.round(1 / (1 + np.exp(-(model.base + model.slope * np.log1p(weight)))), 9)


def _fit(x: np.ndarray, y: np.ndarray, strength: float = 0.02) -> tuple[float, float]:
    """Logistic regression of y on one number, by Newton's method with a small penalty on the slope."""
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    penalty = np.diag([1e-6, strength])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -3, 3)
    return float(beta[0]), max(0.0, float(beta[1]))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", rows: int = TRAINING_ROWS) -> Model:
    """A model from `labels` (id, toxic): at most `rows` labelled texts, those with the smallest id hashes.

    Near copies among them count once. A word beginning is a term if its share of toxic texts is high and
    beyond what chance gives any of the counted ones (Chernoff bound, corrected for their number); of
    beginnings that extend each other the one in most toxic texts stays, the longest among equals. A term
    near which clean texts use several words takes no edits. Rows with a null id or label teach nothing; an
    id labelled twice counts as toxic if either says so. Without toxic and clean rows every score is the
    base rate.
    """
    with scratch(docs.sparkSession):
        return _learned(docs, labels, doc_id, rows)


def _learned(docs: DataFrame, labels: DataFrame, doc_id: str, rows: int) -> Model:
    named = labels.where(F.col(doc_id).isNotNull() & F.col("toxic").isNotNull())
    chosen = named.groupBy(F.col(doc_id).alias("_doc")).agg(F.max("toxic").cast("int").alias("_toxic"))
    chosen = settle(chosen.orderBy(F.xxhash64("_doc"), "_doc").limit(rows))
    texts = docs.select(F.col(doc_id).alias("_doc"), text_of().alias("text"))
    sample = settle(texts.join(F.broadcast(chosen), "_doc").withColumn("words", words_of(F.col("text"))))
    runs = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.slice("words", i + 1, 3)))
    kind = F.when(F.size("words") >= 3, F.array_min(runs)).otherwise(F.xxhash64("words"))
    once = settle(
        sample.groupBy(kind.alias("_kind")).agg(
            F.max_by("words", F.struct("_toxic", "_doc")).alias("words"), F.max("_toxic").alias("_toxic")
        )
    )
    count, toxic = once.agg(F.count(F.lit(1)), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    if not 0 < toxic < count:
        share = min(max(toxic / count if count else 0.0, 1e-6), 1 - 1e-6)
        return Model(base=math.log(share / (1 - share)))
    base = toxic / count
    words = once.select("_toxic", F.explode(F.array_distinct("words")).alias("word"))
    counts = (F.sum("_toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    used = settle(words.groupBy("word").agg(*counts))
    stems = once.select("_toxic", F.explode(F.array_distinct(F.flatten(F.transform(
        F.filter(F.array_distinct("words"), lambda w: F.length(w) >= SHORTEST),
        lambda w: F.concat(F.array(w), F.flatten(F.transform(
            # The whole word, and its beginnings up to LONGEST letters.
            F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length(w))),
            lambda k: F.when(k < F.length(w), F.array(F.substring(w, F.lit(1), k), F.concat(F.substring(w, F.lit(1), k), F.lit("+"))))
            .otherwise(F.array(w)),
        ))),
    )))).alias("stem"))
    stats = settle(stems.groupBy("stem").agg(*counts).where("t >= 3"))
    often = max(stats.count(), 1)
    share = F.col("t") / F.col("n")
    apart = share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    listed = stats.where((share >= PRECISE) & (F.col("n") * apart > math.log(often / CHANCE)))
    terms: dict[str, float] = {}
    begun: set[str] = set()
    bases: set[str] = set()
    longest_first = F.desc(F.length(F.rtrim(F.col("stem"), F.lit("+"))))
    # All that pass the bound; they come from the bounded sample.
    for r in listed.orderBy(F.desc("t"), longest_first, F.length("stem"), "stem").collect():
        stem = r["stem"].removesuffix("+")
        if stem not in begun and not any(stem[:k] in bases for k in range(SHORTEST, len(stem) + 1)):
            terms[r["stem"]] = round(r["t"] / r["n"], 6)
            bases.add(stem)
            begun.update(stem[:k] for k in range(1, len(stem)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(list(terms))
        for batch in batches:
            met = [(w, m[0]) for w in batch.column(0).to_pylist() if (m := matcher.match(w)) and m[1]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in met], pa.string()) for i in (0, 1)], ["word", "term"])

    forms = settle(used.where("n > 2 * t").select("word").mapInArrow(near, "word string, term string"))
    strict = frozenset(r["term"] for r in forms.groupBy("term").count().where(F.col("count") >= CLEAN_FORMS).collect())
    kept = forms.join(forms.groupBy("term").count().where(F.col("count") < CLEAN_FORMS), "term")
    model = Model(terms, strict, frozenset(r["word"] for r in kept.collect()), 0.0, 1.0)
    measured = score(sample.withColumnRenamed("_doc", doc_id), model, doc_id)
    # Two narrow columns of at most `rows` rows.
    pairs = measured.join(F.broadcast(chosen.withColumnRenamed("_doc", doc_id)), doc_id).select("weight", "_toxic").toPandas()
    order = np.argsort(pairs["weight"].to_numpy(), kind="stable")
    x, y = np.log1p(pairs["weight"].to_numpy()[order]), pairs["_toxic"].to_numpy()[order].astype(float)
    model.base, model.slope = _fit(x, y)
    return model
