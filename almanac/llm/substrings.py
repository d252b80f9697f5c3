"""Exact removal of long repeated byte strings by sharded suffix arrays.

Every window of SPAN bytes has an anchor: its smallest hash of K bytes, the leftmost among equals. Equal
windows have equal anchors at equal places, so windows are cut into units by anchor and by the anchor's place
in them, and windows of different units whose core (the bytes that all windows of such a unit hold) differs
are never equal. Units that are equal as a whole are counted once. Units that share a core without being
equal meet in a shard. There the core is one symbol, so a window of SPAN bytes is a window of `width` symbols,
and the shard's suffix array and its common prefixes say which windows occur again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.frames import few, texts_to_python
from almanac.llm.suffixes import common_prefixes, suffix_array
from almanac.llm.words import mix, powers, text_blocks
from almanac.session import keep, scratch, settle

SPAN = 400
K = 32
WIDTHS = (50, 7, 1)
MOST_TASKS = 20_000
SHARD_CONTEXTS = 2_000
MOST_CONTEXTS = 10_000
FILTERED_ANCHORS = 4_000_000
PIECE = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_FIRST = mix(np.arange(1, 257, dtype=np.uint64))
_SECOND = mix(np.arange(1001, 1257, dtype=np.uint64))
KEY = ["k1", "k2"]
UNIT = "k1 long, k2 long, c long, row long, place long"


def _row(doc_id: str) -> Column:
    """Stands for a row: 64 bits of its id and text."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")))


class Sums:
    """Hashes of any byte range of a block from running sums."""

    def __init__(self, data: np.ndarray, letters: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters[data] * up[:-1], out=self.total[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.total[b] - self.total[a]) * self.down[a] + (b - a).astype(np.uint64))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, start of its piece, bytes, offsets): blocks of texts, very long texts in pieces of windows."""
    for at, to, data, offsets in text_blocks(column):
        if len(data) <= PIECE + SPAN:
            yield at, 0, data, offsets
        else:  # one text
            for start in range(0, len(data) - SPAN + 1, PIECE):
                part = data[start : start + PIECE + SPAN - 1]
                yield at, start, part, np.array([0, len(part)])


def _anchors(sums: Sums, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window, text) of every anchor of a block."""
    n = len(data) - SPAN + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none, none
    starts = np.arange(len(data) - K + 1)
    hashes = sums.of(starts, starts + K)
    places = (_smallest((hashes & ~_PLACE) | starts.astype(np.uint64), SPAN - K + 1)[:n] & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.arange(n) + SPAN <= offsets[text + 1]
    new = np.r_[True, (places[1:] != places[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(inside & new)
    # A run of windows ends before the next one begins, or with its text.
    bounds = np.append(np.flatnonzero(new), n)
    last = np.minimum(bounds[np.searchsorted(bounds, first, "right")] - 1, offsets[text[first] + 1] - SPAN)
    return hashes[places[first]], places[first], first, last, text[first]


def _units(sums: Sums, second: Sums, anchor, place, first, last, width: int) -> tuple[np.ndarray, ...]:
    """(k1, k2, c, lo, windows, source) of the units of some anchors."""
    low, high = (place - last) // width, (place - first) // width
    count = high - low + 1
    source = np.repeat(np.arange(len(place)), count)
    q = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    p = place[source]
    lo, hi = np.maximum(first[source], p - q * width - width + 1), np.minimum(last[source], p - q * width)
    a = p - q * width
    b = a + SPAN - width + 1
    salt = mix(anchor[source] + q.astype(np.uint64))
    whole = mix(sums.of(lo, hi + SPAN) ^ mix((a - lo).astype(np.uint64) + np.uint64(1)))
    return mix(sums.of(a, b) ^ salt), mix(second.of(a, b) + salt), whole, lo, hi - lo + 1, source


def _core(place, lo, width: int):
    """Start of the core of a unit whose first window begins at `lo`."""
    return place - (place - lo) // width * width


def _pack(lo, place, windows) -> np.ndarray:
    return (lo << 20) | ((place - lo) << 10) | windows


def _unpack(packed):
    lo = packed >> 20
    return lo, lo + ((packed >> 10) & 1023), packed & 1023


def anchor_units(docs: DataFrame, doc_id: str, width: int) -> DataFrame:
    """Units (k1, k2, c, row, place) of all anchors that occur more than once."""
    read = texts_to_python(docs).select(_row(doc_id).alias("row"), F.col("text").cast("binary").alias("text"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in _pieces(batch.column(1)):
                found = _anchors(Sums(data, _FIRST), data, offsets)[0]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["anchor"])

    again = settle(
        read.mapInArrow(names, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    )
    # Above the bound the units of all anchors go on; the result is the same.
    known = None
    if again.count() <= FILTERED_ANCHORS:
        known = docs.sparkSession.sparkContext.broadcast(np.sort(again.toArrow()["anchor"].to_numpy().astype(np.int64).view(np.uint64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for at, start, data, offsets in _pieces(batch.column(1)):
                sums = Sums(data, _FIRST)
                anchor, place, first, last, text = _anchors(sums, data, offsets)
                if known is not None:
                    kept = np.zeros(len(anchor), dtype=bool)
                    if len(known.value):
                        kept = known.value[np.minimum(np.searchsorted(known.value, anchor), len(known.value) - 1)] == anchor
                    anchor, place, first, last, text = (x[kept] for x in (anchor, place, first, last, text))
                if not len(anchor):
                    continue
                k1, k2, c, lo, windows, source = _units(sums, Sums(data, _SECOND), anchor, place, first, last, width)
                text = text[source]
                moved = start - offsets[text]
                packed = _pack(lo + moved, place[source] + moved, windows)
                columns = (k1.view(np.int64), k2.view(np.int64), c.view(np.int64), rows[at + text], packed)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["k1", "k2", "c", "row", "place"])

    return settle(read.mapInArrow(cut, UNIT))


def _with_places(docs: DataFrame, doc_id: str, placed: DataFrame) -> DataFrame:
    """(text, places) of the rows that `placed` (row, and columns of the places) speaks of."""
    columns = [c for c in placed.columns if c != "row"]
    listed = settle(placed.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("places")))
    read = docs.select(_row(doc_id).alias("row"), F.col("text").cast("binary").alias("text"))
    return read.join(few(listed, 100_000), "row")


def finer_units(docs: DataFrame, doc_id: str, units: DataFrame, width: int) -> DataFrame:
    """The given units (row, place) cut into units of fewer windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw, places in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "places"))):
                data = np.frombuffer(raw, dtype=np.uint8)
                lo, place, windows = _unpack(np.array([p["place"] for p in places], dtype=np.int64))
                sums = Sums(data, _FIRST)
                k1, k2, c, low, count, source = _units(sums, Sums(data, _SECOND), sums.of(place, place + K), place, lo, lo + windows - 1, width)
                columns = (k1.view(np.int64), k2.view(np.int64), c.view(np.int64), np.full(len(k1), row), _pack(low, place[source], count))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["k1", "k2", "c", "row", "place"])

    return settle(_with_places(docs, doc_id, units.select("row", "place").distinct()).mapInArrow(cut, UNIT))


def repeated_in_shard(contexts: list[tuple[bytes, bytes, int]], width: int) -> list[list[tuple[int, int]]]:
    """Ranges (first, last) of the windows of every context that another context of the shard holds too.

    A context is (bytes left of its core, bytes right of it, number of its core).
    """
    m = len(contexts)
    cores = {core: i for i, core in enumerate(dict.fromkeys(core for _, _, core in contexts))}
    text: list[int] = []
    begins = []
    for i, (left, right, core) in enumerate(contexts):
        begins.append(len(text))
        text += [m + 1 + b for b in left]
        text.append(m + 257 + cores[core])
        text += [m + 1 + b for b in right]
        text.append(i + 1)
    text.append(0)
    order = suffix_array(text, m + 257 + len(cores))
    shared = common_prefixes(text, order)
    again = bytearray(len(text))
    for a, b in zip(order, order[1:]):
        if shared[b] >= width:
            again[a] = again[b] = 1
    out = []
    for i, (left, right, _) in enumerate(contexts):
        windows = len(left) + 1 + len(right) - width + 1
        marks = np.frombuffer(again, dtype=np.uint8)[begins[i] : begins[i] + windows]
        edges = np.flatnonzero(np.diff(np.r_[0, marks, 0]))
        out.append(list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist())))
    return out


def _search(docs: DataFrame, doc_id: str, contexts: DataFrame, width: int) -> DataFrame:
    """(k1, k2, c, spans) of the contexts (k1, k2, c, row, place) that hold windows another context holds."""
    found = _with_places(docs, doc_id, contexts)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for raw, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                for p in places:
                    lo, place, windows = _unpack(p["place"])
                    core = _core(place, lo, width)
                    end = core + SPAN - width + 1
                    for column, value in zip(out, (p["k1"], p["k2"], p["c"], raw[lo:core], raw[end : lo + windows - 1 + SPAN])):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["k1", "k2", "c", "left", "right"])

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["k1", "k2", "c"])
        cores = list(zip(part["k1"], part["k2"]))
        spans = repeated_in_shard([(bytes(a), bytes(b), core) for a, b, core in zip(part["left"], part["right"], cores)], width)
        part = part.assign(spans=[[{"a": a, "b": b} for a, b in s] for s in spans])
        return part.loc[part["spans"].map(len) > 0, ["k1", "k2", "c", "spans"]]

    rows = settle(found.mapInArrow(sides, "k1 long, k2 long, c long, left binary, right binary"))
    shards = max(1, -(-rows.count() // SHARD_CONTEXTS))
    sharded = rows.withColumn("shard", F.pmod(F.col("k2"), F.lit(shards)))
    schema = "k1 long, k2 long, c long, spans array<struct<a: long, b: long>>"
    # A task a shard: the work is in Python, which a plan that merges tasks by their bytes does not see.
    return sharded.repartition(min(shards, MOST_TASKS), "shard").groupBy("shard").applyInPandas(lambda part: search(part), schema)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(row, spans): per row key the maximal byte ranges [a, b) that repeated windows cover."""
    parts = []
    units = anchor_units(docs, doc_id, WIDTHS[0])
    for level, width in enumerate(WIDTHS):
        one = F.struct(F.min("row").alias("row"), F.min_by("place", "row").alias("place"))
        whole = settle(units.groupBy(*KEY, "c").agg(F.count(F.lit(1)).alias("copies"), one.alias("one")))
        keys = whole.groupBy(*KEY).agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("n")).where("n > 1")
        keys = settle(keys)
        shared = settle(whole.join(keys.drop("n"), KEY))
        every = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(1023).cast("long").alias("b")))
        known = shared.where("copies > 1").select(*KEY, "c", every.alias("spans"))
        several = shared.where((F.col("kinds") > 1) & (F.col("kinds") <= MOST_CONTEXTS))
        searched = _search(docs, doc_id, several.select(*KEY, "c", "one.row", "one.place"), width)
        # A unit that occurs whole again is repeated throughout, whatever its shard finds besides.
        lone = searched.join(shared.where("copies = 1").select(*KEY, "c"), [*KEY, "c"], "left_semi")
        found = settle(known.unionByName(lone))
        met = units.join(found, [*KEY, "c"]).select("row", "place", F.explode("spans").alias("s"))
        lo = F.shiftright("place", 20)
        last = F.least(F.col("s.b"), F.col("place").bitwiseAND(1023) - 1)
        parts.append(met.select("row", (lo + F.col("s.a")).alias("a"), (lo + last + SPAN).alias("b")))
        crowded = settle(shared.where(F.col("kinds") > MOST_CONTEXTS).select(*KEY, "c"))
        if crowded.isEmpty():
            break
        units = finer_units(docs, doc_id, units.join(crowded, [*KEY, "c"], "left_semi"), WIDTHS[level + 1])
    ranges = parts[0]
    for part in parts[1:]:
        ranges = ranges.unionByName(part)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for listed in batch.column(1).to_pylist():
                runs: list[list[int]] = []
                for a, b in sorted((r["a"], r["b"]) for r in listed):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                spans.append([{"a": a, "b": b} for a, b in runs])
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["row", "spans"])

    listed = ranges.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    return listed.mapInArrow(merged, "row long, spans array<struct<a: long, b: long>>")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per row of `docs`: its id, n_bytes, n_removed, n_spans, kept (bytes) and kept_sha256.

    Removes every byte that a 400-byte string covers which starts anywhere else too, in this text or another;
    strings never cross texts and are judged on the input. Null texts have no bytes. Equal rows repeat each
    other; rows of one id with different texts, and null ids, are rows like others. Rows are told apart by 64
    bits, cores by 128.
    """
    with scratch(docs.sparkSession):
        spans = keep(repeated_spans(docs, doc_id))
    read = docs.select(F.col(doc_id).alias("doc"), F.col("text").cast("binary").alias("text"), _row(doc_id).alias("row"))
    kind = read.schema["doc"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for raw, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw, at, kept = raw or b"", 0, []
                for s in found or ():
                    kept.append(raw[at : s["a"]])
                    at = s["b"]
                rest = b"".join([*kept, raw[at:]])
                for column, value in zip(out, (len(raw), len(raw) - len(rest), len(found or ()), rest, hashlib.sha256(rest).hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(pa.array(x, t) for x, t in zip(out, kinds))],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    schema = f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return read.join(few(spans), "row", "left").mapInArrow(cut, schema).withColumnRenamed("doc", doc_id)
