"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.frames import few, text_of, texts_to_python
from almanac.llm.words import FOLD, SPACES, mix, span_hashes, text_blocks
from almanac.session import keep, scratch, scratch_path, settle

LEAST_LENGTH = 10
SHARD_KEYS = 1 << 17
PROBED_FILTER_BYTES = 64 << 20
SLOTS = 4
LOAD = 0.85
SENT_PLACES = 4_000_000
_LETTERS = mix(FOLD.astype(np.uint64) + np.uint64(1))
_SECOND = mix(FOLD.astype(np.uint64) + np.uint64(5001))
KEY = ["k1", "k2"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def find_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place, k1, k2) of every line of a block whose key has ten code points or more.

    A key is the line without white space at both ends, A-Z lower-cased; k1 and k2 are 64-bit hashes of it.
    """
    breaks = np.flatnonzero(data == 0x0A)
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((starts, text))
    text, starts = text[order], starts[order]
    same = np.append(text[1:] == text[:-1], False)
    ends = np.where(same, np.append(starts[1:], 0) - 1, offsets[text + 1])
    place = np.arange(len(starts)) - np.searchsorted(text, np.arange(len(offsets) - 1))[text]
    solid = np.flatnonzero(~SPACES[data])
    low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    held = np.flatnonzero(high > low)
    a, b = solid[low[held]], solid[high[held] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[b] - points[a] >= LEAST_LENGTH
    a, b, held = a[long], b[long], held[long]
    return text[held], place[held], span_hashes(data, a, b, _LETTERS), span_hashes(data, a, b, _SECOND)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; keys are inserted, found and deleted many at a time."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = len(self.table) - 1
        prints = ((keys.astype(np.uint64) >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (keys.astype(np.uint64) & np.uint64(mask)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        hashed = (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return bucket ^ (hashed & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(1)

    def _settle(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; True for those that found one."""
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
        nth = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        free = self.table[at] == 0
        slot = np.argmax(free.cumsum(1) == (nth + 1)[:, None], axis=1)
        fits = free.sum(1) > nth
        self.table[at[fits], slot[fits]] = prints[order][fits]
        done = np.zeros(len(prints), dtype=bool)
        done[order[fits]] = True
        return done

    def insert(self, keys: np.ndarray, rounds: int = 200) -> bool:
        """Insert keys; False if some found no place, and the filter must be rebuilt larger."""
        prints, first, second = self._places(keys)
        left = ~self._settle(prints, first)
        prints, bucket = prints[left], second[left]
        for n in range(rounds):
            left = ~self._settle(prints, bucket)
            prints, bucket = prints[left], bucket[left]
            if not len(prints):
                return True
            # One fingerprint a full bucket gives way; it goes on to its other bucket.
            _, lead = np.unique(bucket, return_index=True)
            slot = (bucket[lead] + n) % SLOTS
            out = self.table[bucket[lead], slot].copy()
            self.table[bucket[lead], slot] = prints[lead]
            prints = prints.copy()
            bucket = bucket.copy()
            prints[lead] = out
            bucket[lead] = self._other(bucket[lead], out)
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Remove one fingerprint of each key; only keys that were inserted may be deleted."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                held = np.flatnonzero(self.table[bucket] == p)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, dtype=np.uint16).reshape(-1, SLOTS).copy())


def build_filter(keys: np.ndarray) -> CuckooFilter:
    size = max(1, len(keys))
    while True:
        found = CuckooFilter.for_keys(size)
        if found.insert(keys):
            return found
        size = int(len(found.table) * SLOTS * LOAD) + 1


def row_of(doc_id: str) -> Column:
    """Stands for a row: 64 bits of its id and text."""
    return F.xxhash64(F.col(doc_id), text_of())


def line_rows(docs: DataFrame, doc_id: str) -> DataFrame:
    """(doc, row, pos, k1, k2) for every line with a key of documents with an id."""
    read = texts_to_python(docs).where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc"), row_of(doc_id).alias("row"), text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in text_blocks(batch.column(2)):
                text, place, k1, k2 = find_keys(data, offsets)
                source = pa.array(text + at)
                columns = (place.astype(np.int32), k1.view(np.int64), k2.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(source), batch.column(1).take(source), *(pa.array(x) for x in columns)],
                    ["doc", "row", "pos", "k1", "k2"],
                )

    return read.mapInArrow(run, f"doc {read.schema['doc'].dataType.simpleString()}, row long, pos int, k1 long, k2 long")


FILTER = "shard long, live binary, again binary"


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("refs").alias("refs"), F.min("first").alias("first"), F.max("last").alias("last"))


@dataclass
class LineIndex:
    """References of lines to documents, and cuckoo filters over their keys.

    `log` holds (doc, row, pos, k1, k2, change): +1 for each line of an inserted document, -1 for each of a
    deleted one. `counts` is the exact reference-count table of the live keys: (k1, k2, refs, first, last),
    with the smallest and largest document. `filters` has two filters a shard: of the live keys, which spares
    new keys the exact table on insertion, and of those that several documents hold, which spares all other
    lines the exact table when lines are judged. Every step writes new tables in the shared folder and leaves
    the earlier ones as they are, so a lost task or step is run again from them.
    """

    spark: SparkSession
    log: list[str] = field(default_factory=list)
    counts: DataFrame | None = None
    filters: DataFrame | None = None
    shards: int = 1

    def insert(self, docs: DataFrame, doc_id: str = "doc_id") -> None:
        step = self._logged(docs, doc_id, 1)
        batch = step.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("refs"), F.min("doc").alias("first"), F.max("doc").alias("last")
        )
        if self.counts is None:
            self.counts = settle(batch)
            self._build_filters()
            return
        batch = settle(batch)
        known = settle(self._probed(batch, "live"))
        merged = _summed(known.unionByName(self.counts.join(known.select(*KEY), KEY, "left_semi")))
        new = batch.join(known.select(*KEY), KEY, "left_anti")
        rest = self.counts.join(known.select(*KEY), KEY, "left_anti")
        self._replace(rest.unionByName(merged).unionByName(new))

    def delete(self, docs: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents back out; `docs` holds them as they were inserted."""
        touched = settle(self._logged(docs, doc_id, -1).select(*KEY).distinct())
        log = self.spark.read.parquet(*self.log).join(touched, KEY, "left_semi")
        live = log.groupBy(*KEY, "doc", "row", "pos").agg(F.sum("change").alias("refs")).where("refs > 0")
        counted = _summed(live.withColumn("first", F.col("doc")).withColumn("last", F.col("doc")))
        self._replace(self.counts.join(touched, KEY, "left_anti").unionByName(counted))

    def _logged(self, docs: DataFrame, doc_id: str, change: int) -> DataFrame:
        path = scratch_path(self.spark, "line-log")
        line_rows(docs, doc_id).withColumn("change", F.lit(change)).write.parquet(path)
        self.log.append(path)
        return self.spark.read.parquet(path)

    def _replace(self, counts: DataFrame) -> None:
        """Take new counts, and bring the filters up by the keys that came, went, or changed sides."""
        before, self.counts = self.counts, settle(counts)
        if self.counts.count() > 2 * self.shards * SHARD_KEYS:
            self._build_filters()
            return
        again = F.col("first") < F.col("last")
        old = before.select(*KEY, F.lit(True).alias("was"), again.alias("was_again"))
        new = self.counts.select(*KEY, F.lit(True).alias("now"), again.alias("now_again"))
        both = old.join(new, KEY, "full").na.fill(False)
        moved = both.where("was != now OR was_again != now_again").withColumn("shard", self._shard())
        moved = settle(moved.drop("k2"))
        held = self.filters

        def update(key: tuple, have: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            out = {"shard": [key[0]]}
            for name, was, now in (("live", "was", "now"), ("again", "was_again", "now_again")):
                found = CuckooFilter.from_bytes(have[name].iloc[0]) if len(have) else CuckooFilter.for_keys(1)
                found.delete(part.loc[part[was] & ~part[now], "k1"].to_numpy().view(np.uint64))
                fits = found.insert(part.loc[~part[was] & part[now], "k1"].to_numpy().view(np.uint64))
                out[name] = [found.to_bytes() if fits else None]
            return pd.DataFrame(out)

        updated = held.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(update, FILTER)
        self.filters = settle(updated)
        if not self.filters.where("live IS NULL OR again IS NULL").isEmpty():
            self._build_filters()  # a filter was full: all are laid out anew, larger

    def _build_filters(self) -> None:
        self.shards = max(1, -(-self.counts.count() // SHARD_KEYS))

        def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            keys = part["k1"].to_numpy().view(np.uint64)
            again = keys[part["again"].to_numpy()]
            return pd.DataFrame({"shard": [key[0]], "live": [build_filter(keys).to_bytes()], "again": [build_filter(again).to_bytes()]})

        sharded = self.counts.select("k1", (F.col("first") < F.col("last")).alias("again"), self._shard().alias("shard"))
        self.filters = settle(sharded.groupBy("shard").applyInPandas(build, FILTER))

    def _shard(self) -> Column:
        return F.pmod(F.col("k2"), F.lit(self.shards)).cast("long")

    def _probed(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows whose key the shards' filters of that name may hold.

        The filters go to all tasks while they have at most PROBED_FILTER_BYTES together; beyond, the keys go to
        the shard of their filter.
        """
        size = self.filters.agg(F.coalesce(F.sum(F.octet_length(name)), F.lit(0))).first()[0]
        if size > PROBED_FILTER_BYTES:
            return rows.join(self._routed(rows, name), KEY, "left_semi")
        sent = {r["shard"]: bytes(r[name]) for r in self.filters.select("shard", name).collect()}
        cells, shards = self.spark.sparkContext.broadcast(sent), self.shards

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened: dict[int, CuckooFilter] = {}
            for batch in batches:
                k1 = batch.column("k1").to_numpy(zero_copy_only=False).view(np.uint64)
                shard = batch.column("k2").to_numpy(zero_copy_only=False) % shards
                maybe = np.zeros(len(k1), dtype=bool)
                order = np.argsort(shard, kind="stable")
                names, starts = np.unique(shard[order], return_index=True)
                for number, at in zip(names.tolist(), np.split(order, starts[1:])):
                    if number in cells.value:
                        if number not in opened:
                            opened[number] = CuckooFilter.from_bytes(cells.value[number])
                        maybe[at] = opened[number].contains(k1[at])
                yield batch.filter(pa.array(maybe))

        return rows.mapInArrow(probe, rows.schema)

    def _routed(self, rows: DataFrame, name: str) -> DataFrame:
        """(k1, k2), settled: the distinct keys of `rows` that the filter of their shard may hold.

        A key that many lines share is one row before it is shuffled. Where there are more keys than the index is
        laid out for, a shard's keys go to several tasks, each with a copy of its filter.
        """
        keys = settle(rows.select(*KEY).distinct().withColumn("shard", self._shard()))
        shares = 1 + keys.count() // (self.shards * 2 * SHARD_KEYS)
        keys = keys.withColumn("share", F.pmod(F.col("k1"), F.lit(shares)).cast("int"))
        sent = self.filters.select("shard", name, F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))

        def probe(have: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            if not len(have) or not len(part):
                return part[KEY].iloc[:0]
            found = CuckooFilter.from_bytes(have[name].iloc[0])
            return part.loc[found.contains(part["k1"].to_numpy().view(np.uint64)), KEY]

        by = ["shard", "share"]
        return settle(sent.groupBy(*by).cogroup(keys.groupBy(*by)).applyInPandas(probe, "k1 long, k2 long"))

    def repeated(self, rows: DataFrame) -> DataFrame:
        """(row, gone): places of the lines of `rows` that a document with a smaller id holds too."""
        shared = settle(self.counts.where("first < last").select(*KEY, "first"))
        met = self._probed(rows, "again").join(shared, KEY).where("doc > first")
        return met.groupBy("row").agg(F.collect_list("pos").alias("gone"))


def kept_lines(docs: DataFrame, index: LineIndex, doc_id: str = "doc_id", out: str = "kept") -> DataFrame:
    """`docs` with n_lines, n_dropped and `out`: the text without lines that an earlier document holds.

    A document loses every line whose key (ten code points or more) a document of the index with a smaller id
    holds. A null or empty text is one empty line. Rows with equal ids count as one document. A row with a
    null id holds nothing and loses nothing. All columns stay; the new ones replace columns of those names.
    """
    return _without(docs, settle(_gone(docs, index, doc_id)), doc_id, out)


def _gone(docs: DataFrame, index: LineIndex, doc_id: str) -> DataFrame:
    """(_row, _gone): places of the lines that go."""
    return index.repeated(line_rows(docs, doc_id)).select(F.col("row").alias("_row"), F.col("gone").alias("_gone"))


def _without(docs: DataFrame, gone: DataFrame, doc_id: str, out: str) -> DataFrame:
    places = gone.agg(F.coalesce(F.sum(F.size("_gone")), F.lit(0))).first()[0]
    # The rows travel packed, so that no column of theirs meets one of this module.
    packed = docs.select(F.struct(*docs.columns).alias("_own"), row_of(doc_id).alias("_at"), lines_of(text_of()).alias("_lines"))
    # The places of dropped lines go to the texts while they are few, else both meet by a shuffle.
    joined = packed.join(few(gone) if places <= SENT_PLACES else gone, F.col("_at") == F.col("_row"), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    rest = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(
        F.transform(stay, lambda i: F.get("_lines", i))
    )
    cut = joined.withColumn("_rest", rest)
    kept = F.array_join("_rest", "\n")
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    columns = [(kept if c.lower() == out.lower() else F.col("_own").getField(c)).alias(c) for c in own]
    added = [F.size("_lines").cast("long").alias("n_lines"), (F.size("_lines") - F.size("_rest")).cast("long").alias("n_dropped")]
    return cut.select(*columns, *added, *([] if out.lower() in map(str.lower, own) else [kept.alias(out)]))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", out: str = "kept") -> DataFrame:
    """`kept_lines` of a table against an index of itself; the index goes when the lines are judged."""
    with scratch(docs.sparkSession):
        index = LineIndex(docs.sparkSession)
        index.insert(docs, doc_id)
        gone = keep(_gone(docs, index, doc_id))
    return _without(docs, gone, doc_id, out)
