"""Exact nearest neighbours within a class, without comparing every pair.

Each class is cut into cells around a few pivot rows, and each cell into blocks of rows at a similar
distance from the pivot. Every block has a box: the least and largest distance of its rows to each pivot of the
class. A row first finds its neighbours in its own block; that gives a distance no other block can beat unless the
triangle inequality allows it for every pivot, and only those blocks are visited. Blocks have a fixed size, so a
class holding a third of all rows spreads over many tasks; blocks are visited by tiles, so a row's vector is sent once
a tile. Where distances tell rows apart little (many dimensions, no clusters), few blocks can be ruled out and the
work grows with the square of the class, as it must for an exact answer; only the k best per tile and row are emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanac.operators.ordering import running_offset
from almanac.session import settle

BLOCK_ROWS = 8192
MAX_PIVOTS = 64
MAX_CLASSES = 1000
VISITORS_PER_TASK = 32768
MOST_BLOCKS = 50_000
TILE_BLOCKS = 8
TESTED_CELLS = 1 << 21
SLACK = 1e-9


def class_sizes(points: DataFrame, cls: str) -> dict:
    """Rows per class; classes are few by definition and counted before they are listed."""
    counts = points.where(F.col(cls).isNotNull()).groupBy(cls).count().limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {cls}")
    return {row[0]: row[1] for row in counts}


def unit_hash(*columns) -> Column:
    """A reproducible number in [0, 1) from column values."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _squared(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Squared distances of a few rows of `a` at a time to all rows of `b`."""
    step = max(1, (1 << 22) // max(1, b.size))
    for start in range(0, len(a), step):
        part = a[start:start + step, None, :] - b[None, :, :]
        yield start, np.einsum("ijk,ijk->ij", part, part)


def _near_pairs(a: np.ndarray, b: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of pairs of rows of `a` and `b`, some rows of `a` at a time: all that may be among the k nearest.

    A matrix product gives every distance up to its rounding error; pairs beyond the k-th by more than that are out.
    """
    squares = [np.einsum("ij,ij->i", x, x) for x in (a, b)]
    largest = squares[0] + squares[1].max()
    margin = 8 * (a.shape[1] + 8) * np.finfo(float).eps * largest
    sure = np.isfinite(largest).all()  # else norms overflow or are no numbers
    step = max(1, (1 << 22) // len(b))
    for at in range(0, len(a), step):
        rows = slice(at, at + step)
        others = own[rows, None] != ids[None, :]
        if sure and len(b) > k:
            d2 = squares[0][rows, None] + squares[1] - 2 * (a[rows] @ b.T)
            d2[~others] = np.inf
            others &= d2 <= (np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * margin[rows])[:, None]
        i, j = np.nonzero(others)
        yield i + at, j


def _closest(visitors: pd.DataFrame, members: pd.DataFrame, k: int) -> pd.DataFrame:
    """Up to k nearest members per visitor, the visitor itself excluded; ties go to the smaller id."""
    members = members.sort_values("id", kind="stable")
    ids = members["id"].to_numpy()
    a, b = np.stack(visitors["x"].to_list()), np.stack(members["x"].to_list())
    own = visitors["id"].to_numpy()
    step = max(1, (1 << 22) // max(1, b.shape[1]))
    frames = []
    for i, j in _near_pairs(a, b, own, ids, k):
        d2 = np.empty(len(i))
        for at in range(0, len(i), step):
            gap = a[i[at : at + step]] - b[j[at : at + step]]
            d2[at : at + step] = np.einsum("ij,ij->i", gap, gap)
        finite = np.isfinite(d2)
        i, j, d2 = i[finite], j[finite], d2[finite]
        order = np.lexsort((j, d2, i))
        i, j, d2 = i[order], j[order], d2[order]
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
        place = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)]))
        i, j, d2 = i[place < k], j[place < k], d2[place < k]
        frames.append(pd.DataFrame({"id": own[i], "neighbour": ids[j], "d2": d2}))
    return pd.concat(frames, ignore_index=True)


def _pivots(points: DataFrame, sizes: dict, block_rows: int) -> dict[object, np.ndarray]:
    """A few rows per class, picked by hash; together they are at most classes x MAX_PIVOTS rows."""
    wanted = {c: min(MAX_PIVOTS, -(-m // block_rows)) for c, m in sizes.items()}
    chance = F.create_map(*[F.lit(v) for c, m in sizes.items() for v in (c, min(1.0, (4.0 * wanted[c] + 32.0) / m))])
    number = F.create_map(*[F.lit(v) for c, n in wanted.items() for v in (c, n)])
    sample = points.where(unit_hash(F.lit(7), "id") < chance[F.col("cls")])
    ranked = sample.withColumn("place", F.row_number().over(W.partitionBy("cls").orderBy(F.xxhash64(F.lit(7), "id"), "id")))
    rows = ranked.where(F.col("place") <= number[F.col("cls")]).select("cls", "x").collect()
    found: dict[object, list] = {}
    for row in rows:
        found.setdefault(row["cls"], []).append(row["x"])
    return {c: np.array(xs, dtype=float) for c, xs in found.items()}


def _placed(base: DataFrame, sizes: dict, block_rows: int) -> DataFrame:
    """(id, cls, x, asks, gaps, pivot, block): every row with its distances to the class's pivots and its block."""
    pivots = _pivots(base, sizes, block_rows)

    @F.pandas_udf("pivot int, gap double, gaps array<double>")
    def to_pivots(classes: pd.Series, vectors: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"pivot": 0, "gap": 0.0, "gaps": [np.zeros(1)] * len(classes)}, index=classes.index)
        for c, rows in classes.groupby(classes).groups.items():
            if c not in pivots:
                continue
            x = np.stack(vectors.loc[rows].to_list())
            gaps = np.concatenate([np.sqrt(d2) for _, d2 in _squared(x, pivots[c])])
            nearest = gaps.argmin(axis=1)
            out.loc[rows, "pivot"] = nearest
            out.loc[rows, "gap"] = gaps[np.arange(len(nearest)), nearest]
            out.loc[rows, "gaps"] = pd.Series(list(gaps), index=rows)
        return out

    celled = settle(base.withColumn("p", to_pivots("cls", "x")).select("*", "p.*").drop("p").withColumn("one", F.lit(1)))
    ringed = running_offset(celled, ["cls", "pivot"], ["gap", "id"], "one")
    return settle(ringed.withColumn("block", F.floor(F.col("offset") / block_rows)).drop("offset", "one", "gap"))


def _boxes(members: DataFrame) -> dict[object, tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]]:
    """By class: numbers of its blocks, least and largest distances to every pivot, and the blocks' (pivot, block).

    At most MOST_BLOCKS blocks plus MAX_PIVOTS a class, of two distances a pivot each.
    """
    ends = [how(F.get("gaps", F.lit(i))).alias(f"{name}{i}") for i in range(MAX_PIVOTS) for name, how in (("lo", F.min), ("hi", F.max))]
    rows = members.groupBy("cls", "pivot", "block").agg(*ends).collect()
    found: dict[object, list] = {}
    for number, row in enumerate(sorted(rows, key=lambda r: (str(r["cls"]), r["pivot"], r["block"]))):
        width = sum(row[f"lo{i}"] is not None for i in range(MAX_PIVOTS))
        lo, hi = ([row[f"{name}{i}"] for i in range(width)] for name in ("lo", "hi"))
        found.setdefault(row["cls"], []).append((number, lo, hi, (row["pivot"], row["block"])))
    return {
        c: (np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks]), np.array([b[2] for b in blocks]), [b[3] for b in blocks])
        for c, blocks in found.items()
    }


def _visits(asking: DataFrame, boxes: dict, id_type: str) -> DataFrame:
    """(id, tile, blocks): the blocks besides its own that may hold a nearer row, by tiles; no vector goes along.

    `asking` is (id, cls, nb, limit, gaps). A block is left out where one pivot says that all its rows are farther
    away than `limit`.
    """
    held = asking.sparkSession.sparkContext.broadcast({c: box[:3] for c, box in boxes.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            ids, tiles, lists = [], [], []
            for c, rows in frame.groupby("cls", sort=False):
                numbers, lo, hi = held.value[c]
                step = max(1, TESTED_CELLS // lo.size)
                for at in range(0, len(rows), step):
                    part = rows.iloc[at : at + step]
                    gaps = np.stack(part["gaps"].to_list())[:, None, :]
                    bound = np.maximum(lo - gaps, gaps - hi).max(axis=2)
                    near = (bound <= part["limit"].to_numpy()[:, None]) & (numbers != part["nb"].to_numpy()[:, None])
                    own = part["id"].to_numpy()
                    for row, place in enumerate(near):
                        blocks = numbers[place]
                        for tile, members in zip(*_by_tile(blocks)):
                            ids.append(own[row])
                            tiles.append(tile)
                            lists.append(members)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("id").type), pa.array(tiles, pa.int32()), pa.array(lists, pa.list_(pa.int32()))],
                names=["id", "tile", "blocks"],
            )

    return asking.mapInArrow(run, f"id {id_type}, tile int, blocks array<int>")


def _by_tile(blocks: np.ndarray) -> tuple[list[int], list[list[int]]]:
    tiles, starts = np.unique(blocks // TILE_BLOCKS, return_index=True)
    return tiles.tolist(), [part.tolist() for part in np.split(blocks, starts[1:])] if len(blocks) else []


def nearest_in_class(
    points: DataFrame, id: str, cls: str, vector: str, k: int = 5, queries: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, neighbour, place, d2): the k nearest rows of the same class, by squared Euclidean distance.

    `queries` limits the rows neighbours are looked up for (a table with the id column); the rows
    searched are always all of `points`. Ties go to the smaller id.
    """
    base = points.where(F.col(cls).isNotNull()).select(
        F.col(id).alias("id"), F.col(cls).alias("cls"), F.col(vector).cast("array<double>").alias("x")
    )
    if queries is None:
        base = base.withColumn("asks", F.lit(True))
    else:
        asked = queries.select(F.col(id).alias("id"), F.lit(True).alias("asks")).distinct()
        base = base.join(asked, "id", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    base = settle(base)
    sizes = class_sizes(base, "cls")
    id_type = base.schema["id"].dataType.simpleString()
    block_rows = max(block_rows, sum(sizes.values()) // MOST_BLOCKS)

    def at_home(rows: pd.DataFrame) -> pd.DataFrame:
        asking = rows[rows["asks"]]
        if asking.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "d2": []})
        return _closest(asking, rows, k)

    found_schema = f"id {id_type}, neighbour {id_type}, d2 double"
    if all(m <= block_rows for m in sizes.values()):
        # Every class is one block: nothing else to visit.
        return _ranked(base.groupBy("cls").applyInPandas(at_home, found_schema), k)

    members = _placed(base, sizes, block_rows)
    home = settle(members.groupBy("cls", "pivot", "block").applyInPandas(at_home, found_schema))
    reach = home.groupBy("id").agg(F.max("d2").alias("far"), F.count(F.lit(1)).alias("seen")).select(
        "id", F.when(F.col("seen") >= k, F.sqrt("far")).alias("reach")
    )
    boxes = _boxes(members)
    numbered = [(c, int(p), int(b), int(n)) for c, box in boxes.items() for n, (p, b) in zip(box[0], box[3])]
    cls_type = base.schema["cls"].dataType.simpleString()
    names = members.sparkSession.createDataFrame(numbered, f"cls {cls_type}, pivot int, block long, nb int")
    members = settle(members.join(F.broadcast(names), ["cls", "pivot", "block"]).drop("pivot", "block"))
    limit = F.coalesce(F.col("reach") * (1 + SLACK) + SLACK, F.lit(float("inf"))).alias("limit")
    asking = members.where("asks").join(reach, "id", "left").select("id", "cls", "nb", limit, "gaps")
    visits = settle(_visits(asking, boxes, id_type))
    # A tile that very many rows visit is visited in shares, each by a task of its own.
    shares = visits.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / VISITORS_PER_TASK).cast("int").alias("shares"))
    shares = F.broadcast(settle(shares))
    visits = visits.join(shares, "tile").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")).drop("shares")
    # Both sides of a cogroup need keys of one type: an int and an equal long go to different tasks.
    tile = F.floor(F.col("nb") / TILE_BLOCKS).cast("int").alias("tile")
    hosts = members.select(F.col("id").alias("member"), F.col("x").alias("member_x"), "nb", tile).join(shares, "tile")
    share = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("host_share")
    hosts = hosts.select(F.col("tile").alias("host"), share, "nb", "member", "member_x")
    visitors = visits.join(members.select("id", "x"), "id")

    def elsewhere(visiting: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if visiting.empty:  # a share that no visitor's id falls into
            return pd.DataFrame({"id": [], "neighbour": [], "d2": []})
        rows = rows.rename(columns={"member": "id", "member_x": "x"})
        wanted = visiting[["id", "x"]].join(visiting["blocks"].explode().rename("nb"))
        found = [_closest(asking, rows[rows["nb"] == nb], k) for nb, asking in wanted.groupby("nb")]
        best = pd.concat(found, ignore_index=True).sort_values(["d2", "neighbour"], kind="stable")
        return best.groupby("id", sort=False).head(k)

    away = visitors.groupBy("tile", "share").cogroup(hosts.groupBy("host", "host_share")).applyInPandas(elsewhere, found_schema)
    return _ranked(home.unionByName(away), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("id").orderBy("d2", "neighbour"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("id", "neighbour", "place", "d2")
