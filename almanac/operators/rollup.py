"""One row per day: joined text and mean price."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.scalars import text_or_empty
from almanac.operators.keyed import broadcast_days

# A cell holds at most 2 GB, and a task must hold the text of a day to join it.
CELL_CHARS = 256 * 1024 * 1024
# A part of a day's joined text ends at about so many bytes: a task that scans parts holds 4,096 of them at a time.
PART_BYTES = 8 * 1024
TEXT_COLUMNS = ("titles", "content")
ITEM_ORDER = ["published_at", "url", "titles"]


def daily_price(raw: DataFrame, day: str = "time_published") -> DataFrame:
    return raw.where(F.col(day).isNotNull()).groupBy(day).agg(F.avg("price").alias("price"))


def _joined(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    def text(name: str) -> Column:
        rows = F.array_sort(F.collect_list(F.struct(*order, name)))
        return F.array_join(F.transform(rows, lambda row: row[name]), " ")

    return df.groupBy(*keys).agg(*[text(name).alias(name) for name in columns])


def day_items(
    raw: DataFrame,
    order: list[str] | None = None,
    day: str = "time_published",
    columns: tuple[str, ...] = TEXT_COLUMNS,
) -> DataFrame:
    """(day, *order as rank_0.., *columns): the items of every day with their places, at any size.

    What works through the text of a day reads this table; only what must show the joined text asks for
    `daily_text`. Missing text is empty.
    """
    order = order or ITEM_ORDER
    return raw.where(F.col(day).isNotNull()).select(
        day,
        *[F.col(source).alias(f"rank_{i}") for i, source in enumerate(order)],
        *[text_or_empty(F.col(c)).alias(c) for c in columns],
    )


def daily_text(
    raw: DataFrame,
    order: list[str] | None = None,
    day: str = "time_published",
    columns: tuple[str, ...] = TEXT_COLUMNS,
    cell_chars: int = CELL_CHARS,
    part_bytes: int | None = None,
) -> DataFrame:
    """(day, *columns): the texts of a day joined by a space in `order`, one row a day.

    Raises where a day's joined text would have more than `cell_chars` characters, before any text is gathered.
    With `part_bytes` a day may have any size: rows (day, field, part, text), in which the joined text of a column
    `field` is its parts, joined by a space in the order of `part`. A part ends at the item that takes it past
    `part_bytes`, so nothing ever holds a day. `whole_text` and `text_digests` read the parts.
    """
    items = day_items(raw, order, day, columns)
    if part_bytes is not None:
        return _parts(items, day, columns, part_bytes)
    _check_cells(items, day, columns, cell_chars, "day_items")
    ranks = [c for c in items.columns if c.startswith("rank_")]
    return _joined(items, [day], ranks, list(columns)).select(day, *columns)


def _check_cells(df: DataFrame, day: str, columns: tuple[str, ...], cell_chars: int, instead: str) -> None:
    chars = sum((F.coalesce(F.length(c) + 1, F.lit(0)) for c in columns), F.lit(0)).cast("long")
    largest = df.groupBy(day).agg(F.sum(chars).alias("chars")).orderBy(F.desc("chars")).first()
    if largest is not None and largest["chars"] > cell_chars:
        raise ValueError(f"the text of {largest[day]} has {largest['chars']} characters; read {instead} instead")


def _parts(items: DataFrame, day: str, columns: tuple[str, ...], part_bytes: int) -> DataFrame:
    ranks = [c for c in items.columns if c.startswith("rank_")]
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in columns])
    rows = items.select(day, *ranks, F.inline(each))
    by = [day, "field", *ranks]
    # A sample of the columns that make the ranges goes to the driver, so the text is not among them.
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text")
    placed = ranged.select(day, "field", F.monotonically_increasing_id().alias("part"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            days, fields, _, texts = batch.columns
            past = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1) // part_bytes
            keys = (days.cast(pa.int32()).to_numpy(), fields.dictionary_encode().indices.to_numpy(), past)
            starts = np.flatnonzero(np.append(True, np.any([np.diff(key) != 0 for key in keys], axis=0)))
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, batch.num_rows), pa.int32()), texts)
            held = [column.take(pa.array(starts)) for column in batch.columns[:3]]
            yield pa.RecordBatch.from_arrays([*held, pc.binary_join(lists, " ")], names=batch.schema.names)

    return placed.mapInArrow(run, placed.schema)


def whole_text(
    parts: DataFrame,
    day: str = "time_published",
    columns: tuple[str, ...] = TEXT_COLUMNS,
    cell_chars: int = CELL_CHARS,
) -> DataFrame:
    """(day, *columns): one row a day from the parts that `daily_text` gives. Raises as `daily_text` does."""
    wide = parts.select(day, "part", *[F.when(F.col("field") == c, F.col("text")).alias(c) for c in columns])
    _check_cells(wide, day, columns, cell_chars, "its parts")
    return _joined(wide, [day], ["part"], list(columns))


def text_digests(
    parts: DataFrame, day: str = "time_published", columns: tuple[str, ...] = TEXT_COLUMNS
) -> DataFrame:
    """(day, *columns): the MD5 of each joined text, from the parts that `daily_text` gives; a day may have any size.

    The parts of a text go by in their order, so a task reads a day but never holds it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None

        def row() -> pa.RecordBatch:
            values = [pa.array([last[0]], pa.date32()), pa.array([last[1]]), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(values, names=[day, "field", "digest"])

        for batch in batches:
            for *key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if key == last:
                    digest.update(b" ")
                else:
                    if last is not None:
                        yield row()
                    last, digest = key, hashlib.md5(usedforsecurity=False)
                digest.update(text.as_buffer())
        if last is not None:
            yield row()

    ordered = parts.repartition(day, "field").sortWithinPartitions(day, "field", "part").select(day, "field", "text")
    digests = ordered.mapInArrow(run, f"`{day}` date, field string, digest string")
    return digests.groupBy(day).agg(*[F.max(F.when(F.col("field") == c, F.col("digest"))).alias(c) for c in columns])


def daily_rollup(raw: DataFrame, order: list[str] | None = None, day: str = "time_published") -> DataFrame:
    """(day, titles, content, price)."""
    return daily_text(raw, order, day).join(broadcast_days(daily_price(raw, day), day), day)
