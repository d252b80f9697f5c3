"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.session import keep, scratch, settle

BITS = 64
CHUNK_MASKS = 4_096
SENT_CHUNKS = 256


def sign_code(vector: str, bits: int = BITS) -> Column:
    """A long whose bits say which of the vector's `bits` components are at least 0; null for other lengths."""
    one = F.aggregate(
        F.col(vector),
        F.lit(0).cast("long"),
        lambda code, x: F.shiftleft(code, 1).bitwiseOR(F.when(F.coalesce(x >= 0, F.lit(False)), 1).otherwise(0)),
    )
    return F.when(F.size(vector) == bits, one)


def segments_for(rows: int) -> int:
    """Segments of about log2(rows) bits, so that a bucket holds about one code."""
    wanted = BITS / max(1.0, math.log2(max(rows, 2)))
    return min((2, 4, 8), key=lambda m: abs(m - wanted))


def _segment(code: Column, i, width: int) -> Column:
    """Segment i of a code as a non-negative number."""
    return F.call_function("shiftrightunsigned", code, (F.lit(width) * i).cast("int")).bitwiseAND((1 << width) - 1)


def _wider_masks(masks: DataFrame, width: int) -> DataFrame:
    """(mask, top) with one bit more, from those with one bit less; `top` is the highest bit, -1 for none."""
    more = masks.where(F.col("top") < width - 1).select("mask", F.explode(F.sequence(F.col("top") + 1, F.lit(width - 1))).alias("top"))
    return settle(more.select(F.col("mask").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("top"))).alias("mask"), "top"))


def _probes(pending: DataFrame, places: Column, masks: DataFrame, width: int) -> DataFrame:
    """(q, seg, value): the buckets whose segment differs from the query's in the bits of a mask.

    Masks go to the queries in chunks, and a query's chunks go to tasks of their own, so neither the masks of a wide
    segment nor the probes of a query pass through one task or the driver.
    """
    chunks = -(-masks.count() // CHUNK_MASKS)
    chunked = masks.select("mask", F.pmod(F.xxhash64("mask"), F.lit(chunks)).alias("chunk"))
    chunked = settle(chunked.groupBy("chunk").agg(F.collect_list("mask").alias("masks")))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))
    asked = pending.select("q", F.explode(places).alias("seg")).select("q", "seg", F.explode(numbers).alias("chunk"))
    asked = asked.repartition(pending.sparkSession.sparkContext.defaultParallelism, "q", "seg", "chunk")
    sent = F.broadcast(chunked) if chunks <= SENT_CHUNKS else chunked
    opened = asked.join(sent, "chunk").select("q", "seg", F.explode("masks").alias("mask"))
    return opened.select("q", "seg", _segment(F.col("q"), F.col("seg"), width).bitwiseXOR(F.col("mask")).alias("value"))


def build_index(coded: DataFrame, k: int) -> DataFrame:
    """(code, ids, n): every distinct code with its k + 1 smallest ids, enough for any top k.

    The ids are cut by a grouped limit before the shuffle, so a code that a third of the rows share
    reaches its task as k + 1 rows of each task before it.
    """
    ranked = Window.partitionBy("code").orderBy("id")
    first = coded.where("code IS NOT NULL AND id IS NOT NULL").select("id", "code").withColumn("r", F.row_number().over(ranked))
    kept = first.where(F.col("r") <= k + 1).select("code", "id").distinct()
    return settle(kept.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, segments: int | None = None) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest other ids of every query, ties by smaller id.

    `codes` and `queries` have (id, code). Codes are cut into segments, each with its own buckets. Round r
    opens the buckets whose segment differs from the query's in exactly r bits. After it every code within
    segments * (r + 1) - 1 bits has been seen, so a query is done once its last kept distance is within that,
    or every code has been seen. Rows without a code or id are neither found nor asked; an id that occurs
    twice with one code counts once; fewer than k other ids give fewer rows.
    """
    with scratch(codes.sparkSession):
        return keep(_found(codes, queries, k, segments))


def _found(codes: DataFrame, queries: DataFrame, k: int, segments: int | None) -> DataFrame:
    spark = codes.sparkSession
    index = build_index(codes, k)
    rows = index.count()
    parts = segments or segments_for(rows)
    width = BITS // parts
    places = F.array(*[F.lit(i) for i in range(parts)])
    buckets = settle(
        index.select("code", "ids", F.explode(places).alias("seg")).withColumn(
            "value", _segment(F.col("code"), F.col("seg"), width)
        )
    )
    asked = settle(queries.where("code IS NOT NULL AND id IS NOT NULL").select("id", "code").distinct())
    pending = settle(asked.select(F.col("code").alias("q")).distinct())
    reach = index.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    wanted = min(k + 1, reach)
    best = spark.createDataFrame([], "q long, distance int, id " + codes.schema["id"].dataType.simpleString())
    done = best
    by_distance = Window.partitionBy("q").orderBy("distance", "id")
    masks = spark.createDataFrame([(0, -1)], "mask long, top int")
    for radius in range(width + 1):
        if radius:
            masks = _wider_masks(masks, width)
        probes = _probes(pending, places, masks, width)
        apart = F.col("q").bitwiseXOR(F.col("code"))
        nearest = F.array_min(F.array(*[F.bit_count(_segment(apart, F.lit(i), width)) * parts + i for i in range(parts)]))
        # A code is taken in the first bucket that leads to it, so no later step has to drop repeats.
        # The probes' size is not in any statistic; the hint keeps them from being broadcast as if they were few.
        met = probes.join(buckets.hint("merge"), ["seg", "value"]).where(nearest == radius * parts + F.col("seg"))
        seen = met.select("q", F.bit_count(apart).cast("int").alias("distance"), F.explode("ids").alias("id"))
        ranked = best.unionByName(seen).withColumn("r", F.row_number().over(by_distance))
        best = settle(ranked.where(F.col("r") <= k + 1).drop("r"))
        state = best.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        covered = parts * (radius + 1) - 1
        ended = settle(state.where((F.col("n") >= wanted) & ((F.col("far") <= covered) | (F.lit(wanted) < k + 1))).select("q"))
        done = done.unionByName(best.join(ended, "q", "left_semi"))
        best = best.join(ended, "q", "left_anti")
        pending = settle(pending.join(ended, "q", "left_anti"))
        if pending.isEmpty():
            break
    others = (
        asked.select(F.col("id").alias("query_id"), F.col("code").alias("q"))
        .join(settle(done.unionByName(best)).withColumnRenamed("id", "neighbor_id"), "q")
        .where("query_id != neighbor_id")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
