"""Helpers shared by the corpus operators: bounded Arrow batches, shared storage and keyed caches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_BATCH = 256  # texts can be megabytes long, so Arrow batches stay small
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named parquet table of ``sf_dir``, pruned to ``columns`` when some are given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose function sees batches of at most ``ROWS_PER_BATCH`` rows, so what it makes of one stays small.

    Batches also cross to Python so small where the session still has Spark's own default, 10,000 rows: that many long
    texts are gigabytes, and Spark reads the setting when it plans the action, which is not ours.  A session that sets
    another number keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(ARROW_ROWS) == "10000":
        conf.set(ARROW_ROWS, str(ROWS_PER_BATCH))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(b.slice(at, ROWS_PER_BATCH) for b in batches for at in range(0, b.num_rows, ROWS_PER_BATCH))

    return df.mapInArrow(small, schema)


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Actions inside send Arrow batches of at most ``rows`` rows; the session's own setting comes back after."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder URI that the driver and all executors see.

    It lies in ``spark.checkpoint.dir``; where that is unset a temporary folder serves a local master, and a cluster,
    on which no executor would find it, is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str):
    """(filesystem, path) of a folder URI, usable inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class BoundedCache(dict):
    """Results by key, computed on first use.

    Two generations of half the limit each: when the younger is full it becomes the older, whose keys come back as
    they are used, so what is used often stays.  Long keys are not kept.
    """

    def __init__(self, compute: Callable, limit: int = 800_000, longest: int = 64):
        super().__init__()
        self.compute, self.half, self.longest = compute, limit // 2, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_HELD: dict = {}


def release() -> None:
    """Let go of what the worker has kept for other operators."""
    _HELD.clear()


def worker_cache(key, make: Callable):
    """What a Python worker keeps between tasks: the object of the operator it works for now, no other's."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
