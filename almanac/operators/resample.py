"""Oversampling of the smaller classes by interpolation between near rows of the same class."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.neighbours import class_sizes, nearest_in_class, unit_hash
from almanac.operators.ordering import running_offset
from almanac.session import settle

NEIGHBOURS = 5

DRAW_BLOCK = 1024


def smote(
    df: DataFrame, id: str, cls: str, vector: str, k: int = NEIGHBOURS, seed: int = 42, fewer: bool = False, trace: bool = False
) -> DataFrame:
    """(id, cls, vector, is_synthetic): the rows of `df` plus new ones until every class is as large as the largest.

    The new rows are dealt evenly over a class's own rows, in hash order. Each lies at a hashed point on the segment
    from its row to one of that row's k nearest rows of the class. A class needs more than k rows;
    `fewer=True` lowers k for a smaller class, leaves a class of one row as it is, and warns. `trace=True` adds the two
    rows that a new one lies between (from_id, to_id).
    """
    rows = settle(df.select(id, cls, F.col(vector).cast("array<double>").alias(vector)).where(F.col(cls).isNotNull()))
    sizes = class_sizes(rows, cls)
    target = max(sizes.values(), default=0)
    small = {c: m for c, m in sizes.items() if m < target}
    kept = rows.withColumn("is_synthetic", F.lit(False))
    if trace:
        none = F.lit(None).cast(rows.schema[id].dataType)
        kept = kept.withColumns({"from_id": none, "to_id": none})
    tight = {c: m for c, m in small.items() if m <= k}
    if tight and not fewer:
        raise ValueError(f"classes with too few rows for {k} neighbours: {tight}")
    if tight:
        warnings.warn(f"fewer than {k} neighbours for classes {tight}", stacklevel=2)
        small = {c: m for c, m in small.items() if m > 1}
    if not small:
        return kept

    size = F.create_map(*[F.lit(v) for c, m in small.items() for v in (c, m)])
    pool = rows.where(F.col(cls).isin(list(small)))
    keyed = settle(pool.select(id, cls, F.xxhash64(F.lit(seed), id).alias("draw_order"), F.lit(1).alias("one")))
    placed = running_offset(keyed, [cls], ["draw_order", id], "one", out="turn")
    m, needed = size[F.col(cls)], F.lit(target) - size[F.col(cls)]
    # Turns 0, m, 2m, … below the number of rows needed go to the same row.
    dealt = placed.withColumn("draws", F.ceil((needed - F.col("turn")) / m)).where(F.col("draws") > 0)
    dealt = settle(dealt.select(id, "draws"))

    near = nearest_in_class(pool, id, cls, vector, k, queries=dealt)
    near = near.select(F.col("id").alias(id), "neighbour", "place")
    lowest = F.least(F.lit(k), m - 1)
    # A row's draws are made in blocks, which may go to other tasks than each other.
    blocks = dealt.select(id, "draws", F.explode(F.sequence(F.lit(0), F.floor((F.col("draws") - 1) / DRAW_BLOCK))).alias("block"))
    first, last = F.col("block") * DRAW_BLOCK + 1, F.least(F.col("draws"), (F.col("block") + 1) * DRAW_BLOCK)
    turns = blocks.repartition(id, "block").select(id, F.explode(F.sequence(first, last)).alias("draw"))
    draws = (
        pool.join(turns, id)
        .select(id, cls, F.col(vector).alias("start"), "draw")
        .withColumn("place", (F.pmod(F.xxhash64(F.lit(seed + 1), id, "draw"), lowest) + 1).cast("int"))
    )
    ends = pool.select(F.col(id).alias("neighbour"), F.col(vector).alias("end"))
    met = draws.join(near, [id, "place"]).join(ends, "neighbour")
    step = unit_hash(F.lit(seed + 2), id, "draw")
    new = met.withColumn("step", step).select(
        F.lit(None).cast(rows.schema[id].dataType).alias(id),
        cls,
        F.zip_with("start", "end", lambda a, b: a + F.col("step") * (b - a)).alias(vector),
        F.lit(True).alias("is_synthetic"),
        *([F.col(id).alias("from_id"), F.col("neighbour").alias("to_id")] if trace else []),
    )
    return kept.unionByName(new)
