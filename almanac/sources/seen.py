"""The keys that a table holds, kept beside it as hashes in buckets: a run reads only the buckets its keys fall into.

Every run of the writer owns one folder, `run=<name>`, laid out by bucket; writing it again replaces it. A key is
two 64-bit hashes, and missing keys are one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.keyed import broadcast_below
from almanac.operators.naming import unused
from almanac.session import children, delete, settle
from almanac.sources.tables import stored_table

BUCKETS = 64
PROBE_ROWS = 1_000_000
RUNS_KEPT = 100
_LAYOUT = "h1 long, h2 long, run string, bucket int"
_NAMES = ["bucket", "h1", "h2"]


def _hashes(key: Column) -> dict[str, Column]:
    text = key.cast("string")
    h1, h2 = F.xxhash64(text.isNull(), text), F.xxhash64(F.lit(7), text.isNull(), text)
    return {"bucket": F.pmod(h1, F.lit(BUCKETS)).cast("int"), "h1": h1, "h2": h2}


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """(bucket, h1, h2) of the distinct keys of a frame; copies of one key collapse before they are shuffled."""
    return df.select(*[c.alias(name) for name, c in _hashes(F.col(key)).items()]).distinct()


def recorded(spark: SparkSession, root: str) -> set[str]:
    """Names of the runs whose keys were written to the end."""
    runs = [name for name in children(spark, root) if name.startswith("run=")]
    return {name.removeprefix("run=") for name in runs if "_SUCCESS" in children(spark, f"{root}/{name}")}


def record(df: DataFrame, root: str, key: str, run: str) -> None:
    """Add the keys of a run; the same run again replaces what it wrote before."""
    keys = keys_of(df, key).repartition("bucket")
    keys.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/run={run}")


def held(spark: SparkSession, root: str, keys: DataFrame, but: str | None = None) -> DataFrame | None:
    """Stored keys in the buckets that `keys` touch, or None where nothing is stored; `but` leaves one run out.

    The buckets are named in the condition (there are BUCKETS at most), so the scan lists no file of any other.
    """
    stored = stored_table(spark, root, _LAYOUT)
    if stored is None:
        return None
    buckets = sorted(row[0] for row in keys.select("bucket").distinct().collect())
    found = stored.where(F.col("bucket").isin(buckets))
    return (found if but is None else found.where(F.col("run") != but)).select(*_NAMES)


def unseen(batch: DataFrame, root: str, key: str, but: str | None = None) -> DataFrame:
    """Rows of the batch whose key no run has recorded, `but` aside.

    The batch should hold a key once (see `keep_first`). While its keys are counted to be few they are sent to the
    buckets, so that what is stored is scanned and never shuffled.
    """
    spark = batch.sparkSession
    keys = settle(keys_of(batch, key))
    stored = held(spark, root, keys, but)
    if stored is None:
        return batch
    met = settle(stored.join(broadcast_below(keys, PROBE_ROWS), _NAMES, "left_semi").distinct())
    names = unused(batch.columns, *_NAMES)
    named = batch.withColumns({name: c for name, c in zip(names, _hashes(F.col(key)).values())})
    return named.join(broadcast_below(met.toDF(*names), PROBE_ROWS), names, "left_anti").select(*batch.columns)


def compact(spark: SparkSession, root: str, most: int = RUNS_KEPT) -> None:
    """Merge the runs' files once there are more than `most` runs, so that a bucket stays a few files.

    Runs are named `<writer>.<number>`; the last one of each writer stays apart, because it may be repeated. The
    merged copy is written before the old files go: losing the process in between leaves keys twice, never out.
    """
    runs = recorded(spark, root)
    live = [r for r in runs if any(c.startswith("bucket=") for c in children(spark, f"{root}/run={r}"))]
    if len(live) <= most:
        return
    last: dict[str, tuple[int, str]] = {}
    for run in live:
        writer, _, number = run.rpartition(".")
        last[writer] = max(last.get(writer, (-1, "")), (int(number) if number.isdigit() else 0, run))
    kept = {run for _, run in last.values()}
    old = [run for run in live if run not in kept]
    merged = stored_table(spark, root, _LAYOUT).where(F.col("run").isin(old)).select(*_NAMES).distinct()
    names = [r for r in runs if r.startswith("merged.")]
    number = 1 + max((int(r.rpartition(".")[2]) for r in names), default=0)
    merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/run=merged.{number}")
    for run in old:  # the mark of a finished run stays
        for name in children(spark, f"{root}/run={run}"):
            if name.startswith("bucket="):
                delete(spark, f"{root}/run={run}/{name}")
