"""Session set-up and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Open scratch scopes, innermost last. Every thread has its own, so queries in several threads do not meet.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def build_session(app: str = "almanac", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; on a cluster pass no master."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Where that is unset, a local master gets a local folder, as tests do. Any other master raises: its
    executors would each write to a disk of their own and later reads would miss the files.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="almanac-"))
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; the innermost open scratch scope owns it."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end; what must outlive it goes through `keep`.

    A frame that reads them lazily must have been written before the end.
    """
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            delete(spark, path)


def _at(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's storage with all it holds."""
    system, place = _at(spark, path)
    system.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the cluster's storage; none where there is no such folder."""
    system, place = _at(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def settle(df: DataFrame) -> DataFrame:
    """Write a frame that several later steps read to the shared folder and read it back.

    The copy survives lost executors, cuts the lineage, and is columnar: later steps read only what
    they use, and the planner knows its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Settle a frame so that it outlives the innermost scratch scope; the one around it owns the copy."""
    token = _scopes.set(_scopes.get()[:-1])
    try:
        return settle(df)
    finally:
        _scopes.reset(token)
