"""Brown class-based bigrams: exchange clustering of words, class transitions, word emissions.

Two rounds of exchange. The first clusters the most frequent words, buckets of all other words by their last two
bytes, and the end of a text; item bigrams are counted over the whole training corpus. In the second every other listed
word leaves its bucket: it goes to the class with the highest gain of the same likelihood, from the classes that stand
before and after it anywhere in the corpus. Transitions and emissions are then counted anew. Only words beyond the
listed ones, and words that training never saw, have the class of their bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.frames import most_frequent, text_of, texts_to_python
from almanac.llm.words import FOLD, Words, find_words, mix, text_blocks
from almanac.session import settle

CLASSES = 32
FREQUENT = 2_048
SHAPES = 512
ROUNDS = 12
BLOCKS = 16
LISTED = 1_000_000
WORDS_A_TASK = 20_000
PENDING = 2_000_000
BETA = 5.0
END = np.uint64(0x5EED0FE2D0FE2D01)


def _shapes(found: Words) -> np.ndarray:
    """Bucket of every word by its last two bytes."""
    last = FOLD[found.data[found.ends - 1]].astype(np.uint64)
    second = FOLD[found.data[np.maximum(found.ends - 2, found.starts)]].astype(np.uint64)
    return (mix(last * np.uint64(256) + second) % np.uint64(SHAPES)).astype(np.int64)


def _with_ends(values: np.ndarray, bounds: np.ndarray, end) -> np.ndarray:
    """The values of a block's words with `end` after every text."""
    return np.insert(values, bounds[1:], end)


def _merged(names: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    name, back = np.unique(np.concatenate(names), return_inverse=True)
    return name, np.bincount(back, np.concatenate(counts), len(name)).astype(np.int64)


def token_counts(texts: DataFrame) -> DataFrame:
    """(h, shape, c): every distinct token of the texts, with its count; ends have shape -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, held = [], [], 0

        kind = np.dtype([("h", np.uint64), ("shape", np.int64)])
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                found = find_words(data, offsets)
                h, first, count = np.unique(found.hashes, return_index=True, return_counts=True)
                own = np.empty(len(h) + 1, dtype=kind)
                own["h"][:-1], own["shape"][:-1] = h, _shapes(found)[first]
                own[-1] = (END, -1)
                names.append(own)
                counts.append(np.append(count, len(offsets) - 1))
                held += len(own)
                if held > PENDING:
                    name, count = _merged_rows(names, counts)
                    names, counts, held = [name], [count], len(name)
                    if held > PENDING // 2:
                        yield _count_rows(names[0], counts[0])
                        names, counts, held = [], [], 0
        if names:
            yield _count_rows(*_merged_rows(names, counts))

    rows = texts.mapInArrow(run, "h long, shape long, c long")
    return rows.groupBy("h").agg(F.min("shape").alias("shape"), F.sum("c").alias("c"))


def _merged_rows(names: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal tokens added up."""
    rows, count = np.concatenate(names), np.concatenate(counts)
    order = np.argsort(rows["h"], kind="stable")
    rows, count = rows[order], count[order]
    heads = np.flatnonzero(np.r_[True, rows["h"][1:] != rows["h"][:-1]])
    return rows[heads], np.add.reduceat(count, heads)


def _count_rows(name: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    columns = (np.ascontiguousarray(name["h"]).view(np.int64), np.ascontiguousarray(name["shape"]), count.astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "shape", "c"])


def _items(found: Words, frequent: np.ndarray) -> np.ndarray:
    """Item of every word: its place in the sorted hashes of the frequent words, else its shape's."""
    at = np.minimum(np.searchsorted(frequent, found.hashes), len(frequent) - 1)
    return np.where(frequent[at] == found.hashes, at, len(frequent) + _shapes(found))


def item_bigrams(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(block, cells, counts): bigram counts of items, a row a block of left items; cells are left * items + right."""
    items = len(frequent) + SHAPES + 1
    sent = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(items * items, dtype=np.int32)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                found = find_words(data, offsets)
                row = np.concatenate([[items - 1], _with_ends(_items(found, sent.value), found.bounds, items - 1)])
                np.add.at(total, row[:-1] * items + row[1:], 1)
        cells = np.flatnonzero(total)
        block = cells // items % BLOCKS
        order = np.argsort(block, kind="stable")
        cells, block = cells[order], block[order]
        for b in np.unique(block).tolist():
            own = cells[block == b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int64()), pa.array([own.astype(np.int32).tobytes()], pa.binary()), pa.array([total[own].tobytes()], pa.binary())],
                ["block", "cells", "counts"],
            )

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        cells = np.concatenate([np.frombuffer(x, np.int32) for x in parts["cells"]])
        counts = np.concatenate([np.frombuffer(x, np.int32) for x in parts["counts"]])
        name, count = _merged([cells], [counts])
        return pd.DataFrame({"block": [key[0]], "cells": [name.astype(np.int32).tobytes()], "counts": [count.astype(np.int64).tobytes()]})

    rows = texts.mapInArrow(run, "block long, cells binary, counts binary")
    return rows.groupBy("block").applyInPandas(add, "block long, cells binary, counts binary")


def _bits(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(left: np.ndarray, right: np.ndarray, own: np.ndarray, classes: np.ndarray, n: np.ndarray, mine: list[int]) -> dict[int, int]:
    """Move each of the items `mine` to the class that gives the highest bigram likelihood, one after another.

    `left[i]` and `right[i]` count the classes before and after item i, `own[i]` the item after itself, and `n`
    the class bigrams; the last class, of text ends, takes no other item.
    """
    n = n.astype(float).copy()
    out = {}
    last = len(n) - 1
    for i in mine:
        a, s = classes[i], float(own[i])
        before, after = left[i].astype(float), right[i].astype(float)
        before[a] -= s
        after[a] -= s
        n[a, :] -= after
        n[:, a] -= before
        n[a, a] -= s
        # The bigrams around the item count in the totals of its neighbours' classes whatever its own class.
        rows, columns = n.sum(1) + before, n.sum(0) + after
        grown_rows, grown_columns = n + after[None, :], n + before[:, None]
        gain = (_bits(grown_rows) - _bits(n)).sum(1) + (_bits(grown_columns) - _bits(n)).sum(0)
        here = np.diag(n)
        gain -= _bits(here + after) + _bits(here + before) - 2 * _bits(here)
        gain += _bits(here + after + before + s) - _bits(here)
        gain -= _bits(rows + after.sum() + s) - _bits(rows) + _bits(columns + before.sum() + s) - _bits(columns)
        gain[last] = -np.inf
        b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-6 else int(a)
        n[b, :] += after
        n[:, b] += before
        n[b, b] += s
        out[i] = b
    return out


def cluster(bigrams: DataFrame, items: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class of every item, class bigram counts) by exchange clustering.

    A round moves the items of every block in its own task, against the class counts of the round before;
    only an item's class and the small class matrix come back. Rounds end when the likelihood stops rising.
    """
    spark = bigrams.sparkSession
    flat = bigrams.select("block", "cells", "counts")

    def cells(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = np.concatenate([np.frombuffer(x, np.int32) for x in frame["cells"]]).astype(np.int64)
        return cell // items, cell % items, np.concatenate([np.frombuffer(x, np.int64) for x in frame["counts"]])

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every count to the blocks of both its items."""
        for frame in frames:
            a, b, count = cells(frame)
            for block in range(BLOCKS):
                for kind, item in (("right", a), ("left", b)):
                    at = item % BLOCKS == block
                    if at.any():
                        yield pd.DataFrame({"block": [block], "kind": [kind], "cells": [(a * items + b)[at].astype(np.int32).tobytes()], "counts": [count[at].tobytes()]})

    both = settle(settle(flat).mapInPandas(split, "block long, kind string, cells binary, counts binary").repartition(BLOCKS, "block"))
    assigned = np.arange(items) % (classes - 1)
    assigned[-1] = classes - 1

    def class_counts(assigned: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(assigned)

        def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(classes * classes, dtype=np.int64)
            for frame in frames:
                a, b, count = cells(frame)
                total += np.bincount(sent.value[a] * classes + sent.value[b], count, classes * classes).astype(np.int64)
            yield pd.DataFrame({"n": [total.tobytes()]})

        parts = both.where("kind = 'right'").mapInPandas(add, "n binary").collect()
        return sum(np.frombuffer(r["n"], np.int64) for r in parts).reshape(classes, classes)

    def likelihood(n: np.ndarray) -> float:
        n = n.astype(float)
        return float(_bits(n).sum() - _bits(n.sum(0)).sum() - _bits(n.sum(1)).sum())

    n = class_counts(assigned)
    best = likelihood(n)
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((assigned, n))

        def move(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            known, counts = sent.value
            left, right = (np.zeros((items, classes), dtype=np.int64) for _ in range(2))
            own = np.zeros(items, dtype=np.int64)
            for kind, table in (("right", right), ("left", left)):
                part = frame[frame["kind"] == kind]
                if len(part):
                    a, b, count = cells(part)
                    item, other = (a, b) if kind == "right" else (b, a)
                    table += np.bincount(item * classes + known[other], count, items * classes).astype(np.int64).reshape(items, classes)
                    if kind == "right":
                        own += np.bincount(a[a == b], count[a == b], items).astype(np.int64)
            # Half of the items a round, so that blocks do not chase each other.
            mine = [i for i in range(items - 1) if i % BLOCKS == key[0] and (i // BLOCKS + turn) % 2 == 0 and (left[i].any() or right[i].any())]
            moved = exchange(left, right, own, known, counts, mine)
            return pd.DataFrame({"item": list(moved), "to": list(moved.values())}, dtype="int64")

        moves = both.groupBy("block").applyInPandas(move, "item long, to long").toPandas()
        trial = assigned.copy()
        trial[moves["item"].to_numpy()] = moves["to"].to_numpy()
        counts = class_counts(trial)
        value = likelihood(counts)
        rise, settled = value - best, (trial == assigned).all()
        if rise > 0:
            assigned, n, best = trial, counts, value
        if turn % 2 and (settled or rise < 1e-5 * abs(best)):
            break
    return assigned, n


def _find(names: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, there): where each hash stands among sorted names, and whether it does."""
    if not len(names):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
    return at, names[at] == hashes


def _classes_of(hashes: np.ndarray, shapes: np.ndarray, own: tuple[np.ndarray, np.ndarray], buckets: np.ndarray) -> np.ndarray:
    """Class of every word: its own where it has one, else that of its bucket."""
    at, there = _find(own[0], hashes)
    return np.where(there, own[1][at] if len(own[1]) else 0, buckets[shapes])


def neighbour_classes(texts: DataFrame, own: tuple[np.ndarray, np.ndarray], buckets: np.ndarray, classes: int) -> DataFrame:
    """(code, n): how often each class stands before and after each listed word.

    A code is the word's place * 2 * classes, plus the class before it, or `classes` plus the one after it.
    """
    sent = texts.sparkSession.sparkContext.broadcast((own, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, buckets = sent.value
        names, counts, held = [], [], 0

        def rows() -> pa.RecordBatch:
            name, count = _merged(names, counts)
            return pa.RecordBatch.from_arrays([pa.array(name), pa.array(count)], ["code", "n"])

        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                found = find_words(data, offsets)
                place, there = _find(own[0], found.hashes)
                k = np.where(there, own[1][place] if len(own[1]) else 0, buckets[_shapes(found)])
                row = np.concatenate([[classes - 1], _with_ends(k, found.bounds, classes - 1)])
                word = np.concatenate([[-1], _with_ends(np.where(there, place, -1), found.bounds, -1)])
                after, before = np.flatnonzero(word[:-1] >= 0), np.flatnonzero(word[1:] >= 0) + 1
                codes = np.concatenate([
                    word[before] * (2 * classes) + row[before - 1], word[after] * (2 * classes) + classes + row[after + 1],
                ])
                name, count = np.unique(codes, return_counts=True)
                names.append(name)
                counts.append(count)
                held += len(name)
                if held > PENDING:
                    name, count = _merged(names, counts)
                    names, counts, held = [name], [count], len(name)
                    if held > PENDING // 2:
                        yield rows()
                        names, counts, held = [], [], 0
        if names:
            yield rows()

    return texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _gains(before: np.ndarray, after: np.ndarray, own: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Gain of every class for words that stand in class `own` by now, as in `exchange`, many words at once.

    A word's own class is judged without the word's share in it.
    """
    n = n.astype(float)
    rows, columns, here = n.sum(1), n.sum(0), np.diag(n)
    gains = np.empty((len(own), len(n)))
    for b in range(len(n)):
        mine = (own == b)[:, None]
        right = np.maximum(n[b] - mine * after, 0)
        left = np.maximum(n[:, b] - mine * before, 0)
        gain = (_bits(right + after) - _bits(right)).sum(1) + (_bits(left + before) - _bits(left)).sum(1)
        a, c = after[:, b], before[:, b]
        stay = np.maximum(here[b] - mine[:, 0] * (a + c), 0)
        gain += _bits(stay + a + c) + _bits(stay) - _bits(stay + a) - _bits(stay + c)
        total_a, total_c = after.sum(1), before.sum(1)
        low, high = np.maximum(rows[b] - mine[:, 0] * total_a, 0), np.maximum(columns[b] - mine[:, 0] * total_c, 0)
        gains[:, b] = gain - _bits(low + total_a) + _bits(low) - _bits(high + total_c) + _bits(high)
    gains[:, -1] = -np.inf  # the class of ends takes no word
    return gains


def place_words(counted: DataFrame, own: np.ndarray, fixed: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Class of every listed word: the best by exchange gain, but for the `fixed` ones.

    The words of a range of places are judged by one task; a class of one byte a word comes back.
    """
    classes = len(n)
    sent = counted.sparkSession.sparkContext.broadcast((own, n))

    def judge(rows: pa.Table) -> pa.Table:
        own, n = sent.value
        code, count = rows["code"].to_numpy(), rows["n"].to_numpy()
        part = int(rows["part"][0].as_py())
        mine = own[part * WORDS_A_TASK : (part + 1) * WORDS_A_TASK]
        cells = np.bincount(code - part * WORDS_A_TASK * 2 * classes, count, len(mine) * 2 * classes).reshape(len(mine), 2 * classes)
        best = np.empty(len(mine), dtype=np.uint8)
        for at in range(0, len(mine), 1000):
            before, after = cells[at : at + 1000, :classes], cells[at : at + 1000, classes:]
            best[at : at + 1000] = _gains(before, after, mine[at : at + 1000], n).argmax(1)
        return pa.table({"part": pa.array([part], pa.int64()), "best": pa.array([best.tobytes()], pa.binary())})

    part = F.floor(F.col("code") / (WORDS_A_TASK * 2 * classes)).alias("part")
    found = counted.select(part, "code", "n").groupBy("part").applyInArrow(judge, "part long, best binary")
    out = own.copy()
    for r in found.collect():
        at = r["part"] * WORDS_A_TASK
        best = np.frombuffer(r["best"], np.uint8)
        out[at : at + len(best)] = np.where(fixed[at : at + len(best)], own[at : at + len(best)], best)
    return out


def class_bigrams(texts: DataFrame, own: tuple[np.ndarray, np.ndarray], buckets: np.ndarray, classes: int) -> np.ndarray:
    """How often each class follows each, text ends included."""
    sent = texts.sparkSession.sparkContext.broadcast((own, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, buckets = sent.value
        total = np.zeros(classes * classes, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                found = find_words(data, offsets)
                k = _classes_of(found.hashes, _shapes(found), own, buckets)
                row = np.concatenate([[classes - 1], _with_ends(k, found.bounds, classes - 1)])
                total += np.bincount(row[:-1] * classes + row[1:], minlength=classes * classes)
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["n"])

    parts = texts.mapInArrow(run, "n array<long>").select(F.posexplode("n").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(classes * classes, dtype=np.int64)
    for r in parts.collect():
        out[r["cell"]] = r["n"]
    return out.reshape(classes, classes)


@dataclass
class Model:
    """What scoring needs: words' and buckets' classes, class transitions, and the sizes of classes and of the corpus."""

    own: tuple[np.ndarray, np.ndarray]  # sorted hashes of the words with a class of their own, and the classes
    buckets: np.ndarray  # class of each bucket of spellings
    transitions: np.ndarray  # log10 P(class after | class before)
    emissions: np.ndarray  # log10 of 1 / (tokens + types + 1) of each class; 0 for the class of ends
    tokens: int
    types: int
    counts: DataFrame
    listed: tuple[np.ndarray, np.ndarray]


def train(texts: DataFrame, classes: int = CLASSES, listed: int = LISTED, frequent: int = FREQUENT) -> Model:
    """A model of all rows of `texts`; only their text is read.

    Null and empty texts are one end each, repeated rows count each, no rows give a model without words. The `listed`
    most frequent words have a class of their own, the `frequent` first of them by rounds of exchange.
    """
    texts = texts_to_python(texts).select(text_of().alias("text"))
    counts = settle(token_counts(texts))
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    words = counts.where("shape >= 0")
    top = most_frequent(words, "c", listed).select("h", "c", "shape").toArrow()
    names, sizes, shapes = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy(), top["shape"].to_numpy()
    first = np.lexsort((names, -sizes))[:frequent]
    core = np.sort(np.append(names[first], np.uint64(0)))
    order = np.argsort(names)
    names, sizes, shapes = names[order], sizes[order], shapes[order]
    items = len(core) + SHAPES + 1
    assigned, n = cluster(settle(item_bigrams(texts, core)), items, classes)
    buckets = assigned[len(core) : -1].astype(np.uint8)
    at, fixed = _find(core, names)
    own = names, np.where(fixed, assigned[at], buckets[shapes]).astype(np.uint8)
    own = names, place_words(settle(neighbour_classes(texts, own, buckets, classes)), own[1], fixed, n)
    n = class_bigrams(texts, own, buckets, classes)
    sent = texts.sparkSession.sparkContext.broadcast((own, buckets))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, shape, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            k = _classes_of(h.view(np.uint64), shape, *sent.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(classes)), pa.array(np.bincount(k, c, classes).astype(np.int64)), pa.array(np.bincount(k, minlength=classes))],
                ["k", "tokens", "types"],
            )

    sized = words.mapInArrow(held, "k long, tokens long, types long").groupBy("k").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"))
    mass = np.zeros(classes)
    for r in sized.collect():  # one row a class
        mass[r["k"]] = r["tokens"] + r["types"]
    emissions = -np.log10(mass + 1)
    emissions[-1] = 0.0
    share = (n.sum(0) + 1.0) / (n.sum() + classes)
    transitions = np.log10((n + BETA * share[None, :]) / (n.sum(1, keepdims=True) + BETA))
    return Model(own, buckets, transitions, emissions, int(total), int(types), counts, (names, sizes))


def own_share(model: Model) -> float:
    """Share of the training tokens that are words with a class of their own."""
    words = model.tokens - (model.counts.where("shape < 0").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    return float(model.listed[1].sum()) / max(words, 1)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id") -> DataFrame:
    """Per row of `docs`: its id, n_tokens, n_known, base_score and score (log10 probabilities of the text).

    A token's probability is that of its class after the class before it, times the token's in its class:
    (count + 1) / (tokens + types + 1), where unseen words of a class share one type. Texts begin after an
    end. A null or empty text is one end. Tokens beyond the million most frequent meet the count table by a
    join. Rows with equal id and text score alike; null ids are ids like others; further columns are not read.
    """
    spark = docs.sparkSession
    parts = model.own, model.buckets, model.transitions, model.emissions, model.listed
    sent = spark.sparkContext.broadcast(parts)
    floor = -np.log10(model.tokens + model.types + 1)
    ends = model.counts.where("shape < 0").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    read = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(doc_id), text_of()).alias("row"), text_of().alias("text"))
    kind = read.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, buckets, transitions, emissions, (names, counts) = sent.value
        last = len(transitions) - 1
        for batch in batches:
            for at, to, data, offsets in text_blocks(batch.column(2)):
                found = find_words(data, offsets)
                text = np.repeat(np.arange(to - at), np.diff(found.bounds))
                k = _classes_of(found.hashes, _shapes(found), own, buckets)
                row = _with_ends(k, found.bounds, last)
                steps = transitions[np.r_[last, row[:-1]], row]
                spot, here = _find(names, found.hashes)
                c = np.where(here, counts[spot], 0) if len(names) else np.zeros(len(k))
                logs = np.log10(c + 1.0)
                size = np.diff(found.bounds)
                known = np.bincount(text, here, to - at) + (ends > 0)
                base = np.bincount(text, logs, to - at) + np.log10(ends + 1.0) + floor * (size + 1)
                where = np.repeat(np.arange(to - at), size + 1)
                value = np.bincount(where, steps, to - at) + np.bincount(text, logs + emissions[k], to - at)
                # What the listed words do not hold goes on, counted by text and token.
                rest = np.flatnonzero(~here)
                order = rest[np.lexsort((found.hashes[rest], text[rest]))]
                t, h = text[order], found.hashes[order]
                heads = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (h[1:] != h[:-1])]) if len(order) else np.empty(0, np.int64)
                times = np.diff(np.r_[heads, len(order)])
                cut = np.searchsorted(t[heads], np.arange(to - at + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (h[heads].view(np.int64), times.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), pa.array(size + 1), pa.array(known.astype(np.int64)),
                     pa.array(base), pa.array(value), *lists],
                    ["doc", "row", "n_tokens", "n_known", "base_score", "score", "rest", "times"],
                )

    schema = f"doc {kind}, row long, n_tokens long, n_known long, base_score double, score double, rest array<long>, times array<long>"
    scored = settle(read.mapInArrow(run, schema))
    tail = scored.where(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "times")).alias("x"))
    tail = tail.select("row", F.col("x.rest").alias("h"), F.col("x.times").alias("times")).distinct()
    met = tail.join(model.counts.select("h", "c"), "h")
    more = met.groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs")
    )
    joined = scored.drop("rest", "times").join(settle(more), "row", "left").na.fill(0, ["known", "logs"])
    return joined.select(
        F.col("doc").alias(doc_id), "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"),
        (F.col("base_score") + F.col("logs")).alias("base_score"), (F.col("score") + F.col("logs")).alias("score"),
    )


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))
