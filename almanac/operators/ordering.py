"""Running totals along an order, spread over many tasks even when one group is huge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanac.operators.keyed import broadcast_below
from almanac.session import settle

RANGE_TOTALS_BROADCAST_ROWS = 4_000_000


def running_offset(df: DataFrame, group: list[str], order: list[str], size: str, out: str = "offset") -> DataFrame:
    """Adds the sum of `size` over the earlier rows of the same group.

    A plain window would sort a whole group in one task. Here the rows are cut into ranges of
    (*group, *order), so a big group spans many ranges; totals per range are tiny, and the offset is
    the total of the earlier ranges plus the running sum inside the own range. `order` must be unique
    within a group and groups not NULL. Pass narrow, settled rows: the range bounds come from a sample
    of them, and they are materialised once more so that the bounds hold for both uses.
    """
    ranged = settle(df.repartitionByRange(*group, *order).withColumn("slice", F.spark_partition_id()))
    totals = ranged.groupBy(*group, "slice").agg(F.sum(size).alias("total"))
    earlier = W.partitionBy(*group).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(*group, "slice", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy(*group, "slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    # One row per range and group it meets: at most the partition count plus the group count.
    placed = ranged.join(broadcast_below(before, RANGE_TOTALS_BROADCAST_ROWS), [*group, "slice"])
    offset = F.col("before") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    return placed.withColumn(out, offset).drop("slice", "before")
