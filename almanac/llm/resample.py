"""Resampling towards a target: n-gram importance weights, and an exact draw of the highest keys.

Weights are sums of an array of bucket gains. The cutoff of the draw is found by weighted median-of-medians
selection over the partitions of the keys: each sends its median and size, the median of the medians weighted by
those sizes is the next pivot, and at least about a quarter of what is left goes in every round. Only the winners
are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.crc import extend, followed_by
from almanac.llm.frames import text_of, texts_to_python
from almanac.llm.words import FOLD, MARKS, text_blocks, word_bounds
from almanac.session import keep, scratch, settle

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
# Fixed value: one more than the largest number of eight hex digits.
HASHES = 4_294_967_296


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """(sums, present, bounds): per run length the checksum of the run that ends at each word, and whether it exists.

    Words of text i are bounds[i]:bounds[i + 1]; the words of a run are joined by one space.
    """
    data = FOLD[data]
    starts, ends = word_bounds(data, offsets, MARKS)
    bounds = np.searchsorted(starts, offsets)
    place = np.arange(len(starts)) - np.repeat(bounds[:-1], np.diff(bounds))
    sums = [extend(np.zeros(len(starts), np.uint32), data, starts, ends)]
    for _ in range(1, LONGEST_RUN):
        before = np.concatenate([sums[-1][:1], sums[-1][:-1]])
        sums.append(extend(followed_by(before, 0x20), data, starts, ends))
    return sums, [place >= i for i in range(LONGEST_RUN)], bounds


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket. Every task sends at most one row a bucket."""
    read = texts_to_python(texts).select(text_of(text).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                sums, present, _ = runs_of(data, offsets)
                for names, there in zip(sums, present):
                    total += np.bincount(names[there] % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    found = read.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus share per bucket, with one added to every count."""
    n = len(ours)
    s, t = float(ours.sum() + n), float(target.sum() + n)
    return np.array(
        [math.floor(1000 * math.log((float(b + 1) * s) / (float(a + 1) * t))) for a, b in zip(ours.tolist(), target.tolist())],
        dtype=np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, n_words, n_features, weight): the summed gains of every text's features."""
    read = texts_to_python(docs).select(F.col(doc_id).alias("_id"), text_of(text).alias("_text"))
    schema = T.StructType([
        T.StructField("_id", read.schema["_id"].dataType),
        *[T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")],
    ])
    buckets = np.uint32(len(gain))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_blocks(batch.column(1)):
                sums, present, bounds = runs_of(data, offsets)
                each = np.zeros(len(sums[0]) + 1, dtype=np.int64)
                for names, there in zip(sums, present):
                    each[1:] += np.where(there, gain[names % buckets], 0)
                total = np.cumsum(each)
                words = np.diff(bounds)
                features = sum(np.maximum(words - i, 0) for i in range(LONGEST_RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(words), pa.array(features),
                     pa.array(total[bounds[1:]] - total[bounds[:-1]])],
                    names=schema.names,
                )

    return read.mapInArrow(score, schema)


def perturbed(weight: Column, doc_id: Column, seed: int) -> Column:
    """The weight plus thousandths of a Gumbel draw that `seed` and the id fix; a null id draws as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(HASHES)))))


def _middle(score: np.ndarray, seq: np.ndarray) -> list:
    """[size, score, seq] of the median key, best first."""
    if not len(score):
        return [0, 0, 0]
    at = np.lexsort((seq, -score))[(len(score) - 1) // 2]
    return [len(score), int(score[at]), int(seq[at])]


def _medians(keys: DataFrame, pivot: tuple[int, int] | None) -> list[tuple[list, list]]:
    """Per partition the median of the keys better than the pivot and of those worse than it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if len(b)]
        if parts:
            score, seq = (np.concatenate(p) for p in zip(*parts))
            s, q = pivot or (-(2**62), 0)
            above, below = (score > s) | ((score == s) & (seq < q)), (score < s) | ((score == s) & (seq > q))
            row = _middle(score[above], seq[above]) + _middle(score[below], seq[below])
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], names=list("abcdef"))

    rows = keys.select("score", "_seq").mapInArrow(run, ", ".join(f"{c} long" for c in "abcdef")).collect()
    return [(list(r[:3]), list(r[3:])) for r in rows]


def _weighted_median(medians: list[list]) -> tuple[int, int]:
    medians = sorted((m for m in medians if m[0]), key=lambda m: (-m[1], m[2]))
    half, seen = sum(m[0] for m in medians) / 2, 0
    for size, score, seq in medians:
        seen += size
        if seen >= half:
            return score, seq
    raise ValueError("no keys")


def cutoff(keys: DataFrame, wanted: int) -> tuple[int, int]:
    """The `wanted`th best (score, _seq): highest score first, then least _seq; keys are distinct.

    The driver holds one median a partition; a round reads only the keys that can still be the cutoff.
    """
    left, pivot = keys, _weighted_median([above for above, _ in _medians(keys, None)])
    while True:
        s, q = pivot
        sides = _medians(left, pivot)
        better = sum(above[0] for above, _ in sides)
        if wanted == better + 1:
            return pivot
        if wanted <= better:
            left = left.where((F.col("score") > s) | ((F.col("score") == s) & (F.col("_seq") < q)))
            pivot = _weighted_median([above for above, _ in sides])
        else:
            wanted -= better + 1
            left = left.where((F.col("score") < s) | ((F.col("score") == s) & (F.col("_seq") > q)))
            pivot = _weighted_median([below for _, below in sides])


def _ranked(winners: DataFrame) -> DataFrame:
    """`winners` with rank 1, 2, 3...: a sort by ranges, and each range's place from the sizes of those before."""
    best = [F.desc("score"), F.asc("_seq")]
    parts = winners.sparkSession.sparkContext.defaultParallelism
    sorted_ = winners.repartitionByRange(parts, *best).sortWithinPartitions(*best)
    placed = settle(sorted_.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).cast("int").alias("_part")
    offsets, seen = [], 0
    for row in sorted(placed.groupBy(part).count().collect()):
        offsets.append((row[0], seen))
        seen += row[1]
    starts = F.broadcast(winners.sparkSession.createDataFrame(offsets, "_part int, _start long"))
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(starts, "_part").withColumn("rank", F.col("_start") + at + 1)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row: a draw of `percent` of the rows towards `target`.

    Features are runs of one to three words, counted in `buckets` by checksum over all rows of both tables. The
    score is the weight plus a Gumbel draw, so the highest scores are a sample without replacement in proportion to
    the weights. Rows with at least `least_words` words take part; the best `percent` of them, rounded down, have a
    rank, ties go to the smaller id, then to either row, and all others have a null rank. Null and empty texts weigh
    0; a null id draws as an empty one and comes first among equal scores; repeated rows draw alike and each counts;
    without rows, or without any in the target, the result holds for what is there. Only the id and the text
    are read, so no other column clashes.
    """
    with scratch(docs.sparkSession):
        gain = gains(bucket_counts(docs, buckets, text), bucket_counts(target, buckets, text))
        weighed = weigh(docs, gain, doc_id, text).withColumn("score", perturbed(F.col("weight"), F.col("_id"), seed))
        rows = settle(weighed.withColumn("_row", F.monotonically_increasing_id()))
        # Ids of any type become numbers in their order; the row number keeps repeated ids from one range.
        parts = docs.sparkSession.sparkContext.defaultParallelism
        by_id = rows.repartitionByRange(parts, "_id", "_row").sortWithinPartitions("_id", "_row")
        scored = settle(by_id.withColumn("_seq", F.monotonically_increasing_id()).drop("_row"))
        able = scored.where(F.col("n_words") >= least_words)
        drawn = able.count() * percent // 100
        out = ["n_words", "n_features", "weight", "score"]
        if not drawn:
            found = scored.select(F.col("_id").alias(doc_id), *out, F.lit(None).cast("long").alias("rank"))
            return keep(found)
        s, q = cutoff(able, drawn)
        won = (F.col("n_words") >= least_words) & ((F.col("score") > s) | ((F.col("score") == s) & (F.col("_seq") <= q)))
        others = scored.where(~won).withColumn("rank", F.lit(None).cast("long"))
        both = _ranked(scored.where(won)).select("_id", *out, "rank").unionByName(others.select("_id", *out, "rank"))
        return keep(both.withColumnRenamed("_id", doc_id))
