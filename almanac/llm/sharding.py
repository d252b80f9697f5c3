"""Extendible hashing: shards that split on one more hash bit only where a bucket is over its byte limit."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.frames import few, text_of
from almanac.session import keep, scratch, settle

BITS = 60
DETAIL = 4
DEEPER = 8


def md5_bits(value: Column) -> Column:
    """The first 60 bits of the md5 of a value's text; a null counts as the empty text."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    return F.shiftright("_code", BITS - depth)


def directory(rows: DataFrame, limit: int, depth: int) -> DataFrame:
    """(_cell, _depth) for every cell of `depth` bits whose bucket fits: the extendible-hashing directory.

    `rows` has _code (60 bits) and _bytes. Bytes are summed once by cell, with map-side combine; a cell's
    ancestors are then summed in the small table of cells. A bucket is the shallowest prefix that holds at
    most `limit` bytes or a single row. Cells still over the limit have no entry.
    """
    cells = settle(
        rows.groupBy(_prefix(depth).alias("_cell")).agg(
            F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
        )
    )
    chain = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("_depth")).withColumn(
        "_node", F.call_function("shiftright", F.col("_cell"), (F.lit(depth) - F.col("_depth")).cast("int"))
    )
    nodes = settle(
        chain.groupBy("_depth", "_node")
        .agg(F.sum("_bytes").alias("_total"), F.sum("_rows").alias("_count"))
        .where((F.col("_total") <= limit) | (F.col("_count") == 1))
        .select("_depth", "_node")
    )
    fitting = chain.select("_cell", "_depth", "_node").join(few(nodes), ["_depth", "_node"])
    return settle(fitting.groupBy("_cell").agg(F.min("_depth").alias("_depth")))


def _assign(rows: DataFrame, limit: int, label: Column) -> tuple[list[DataFrame], DataFrame | None]:
    """Parts of the rows with their bucket, and the rows that 60 bits do not part."""
    total = rows.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + DETAIL)
    parts = []
    while True:
        entries = few(directory(rows, limit, depth))
        with_cell = rows.withColumn("_cell", _prefix(depth))
        found = with_cell.join(entries, "_cell")
        bits = F.lpad(F.conv(F.col("_code").cast("string"), 10, 2), BITS, "0")
        own = F.expr("substring(_bits, 1, _depth)")
        parts.append(
            found.withColumn("_bits", bits).withColumn("_shard", F.concat(label, own)).drop("_bits", "_cell", "_depth")
        )
        rest = with_cell.join(entries, "_cell", "left_anti").drop("_cell")
        if rest.isEmpty():
            return parts, None
        if depth == BITS:
            return parts, rest
        rows, depth = rest, min(BITS, depth + DEEPER)


def assign_shards(df: DataFrame, key: str = "doc_id", limit: int = 1 << 20, text: str = "text") -> DataFrame:
    """Every row of `df` with n_bytes, shard (its bucket's hash prefix as bits) and depth (their number).

    Rows are hashed by `key`. A bucket over `limit` bytes splits on the next bit. One key that alone is
    over the limit goes on with bits of the row's content, and identical rows with bits of their place in a
    written copy, so that only a single row over the limit is a shard over the limit. A null key hashes as
    the empty text, a null text has no bytes; an empty table gives no rows; other columns are kept, and
    shard, depth and n_bytes replace columns of those names.
    """
    with scratch(df.sparkSession):
        return keep(_sharded(df, key, limit, text))


def _sharded(df: DataFrame, key: str, limit: int, text: str) -> DataFrame:
    # The rows travel packed, so that no column of theirs meets one of this module.
    own = F.struct(*df.drop("shard", "depth", "n_bytes").columns)
    rows = df.select(own.alias("_row"), F.octet_length(text_of(text)).cast("long").alias("_bytes"), md5_bits(F.col(key)).alias("_code"))
    parts, rest = _assign(rows, limit, F.lit(""))
    if rest is not None:
        label = F.lpad(F.conv(F.col("_code").cast("string"), 10, 2), BITS, "0")
        content = F.to_json("_row", {"ignoreNullFields": "false"})
        rows = rest.withColumn("_label", label).withColumn("_code", md5_bits(F.concat_ws(":", "_label", content)))
        more, rest = _assign(rows, limit, F.col("_label"))
        parts += more
    if rest is not None:
        label = F.concat("_label", F.lpad(F.conv(F.col("_code").cast("string"), 10, 2), BITS, "0"))
        rows = settle(rest.withColumn("_label", label).withColumn("_place", F.monotonically_increasing_id()))
        rows = rows.withColumn("_code", md5_bits(F.concat_ws(":", "_label", "_place")))
        parts += _assign(rows, limit, F.col("_label"))[0]
    columns = ["_row.*", F.col("_bytes").alias("n_bytes"), F.col("_shard").alias("shard"), F.length("_shard").alias("depth")]
    return reduce(DataFrame.unionAll, [p.select(*columns) for p in parts])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; a shard fits its byte limit, so one task writes it."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
