"""Helpers that the operators share: scratch tables, size-checked broadcasts, slices of Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import pickle
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES, TIDY = 32 << 20, 2 << 20
_own_root: list[str] = []
_passing: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Where the session names none and all runs on one machine, as in tests, a temporary folder is made and removed at exit.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_root:
            _own_root.append(tempfile.mkdtemp(prefix="ledgerline-"))
            atexit.register(shutil.rmtree, _own_root[0], ignore_errors=True)
        root = f"file://{_own_root[0]}"
    return f"{root.rstrip('/')}/ledgerline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: later stages restart from the files, not from the input."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _passing:
        _passing[-1].append(path)
    return out


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable]:
    """Scratch tables that are stored inside are deleted at the end, but for those that are handed to what is yielded."""
    _passing.append([])
    kept: set[str] = set()
    try:
        yield lambda *tables: kept.update(t._scratch for t in tables)
    finally:
        made = _passing.pop()
        discard(spark, *[p for p in made if p not in kept])
        if _passing:
            _passing[-1] += [p for p in made if p in kept]


def discard(spark: SparkSession, *used: DataFrame | str) -> None:
    """Deletes scratch tables (or paths) that nothing reads any more."""
    for path in (u if isinstance(u, str) else u._scratch for u in used):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its rows, measured, take at most limit bytes, else df, to be joined by shuffling."""
    size = F.lit(16 * (1 + len(df.columns)))
    for f in df.schema:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif f.dataType.typeName() not in ("long", "integer", "double", "boolean"):
            size = size + F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("bigint"))).first()[0] or 0) <= limit else df


def shipped(context: SparkContext, value) -> Callable:
    """A broadcast of value, whose classes the executors need not be able to import; call it in a task."""
    data = context.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def drawn(share: Column | float) -> Column:
    """True for each row with this probability, whatever the row holds and however often it repeats."""
    return F.xxhash64(F.monotonically_increasing_id()).cast("double") / float(1 << 64) + 0.5 < share


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def body(text: Column | str) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized(batches: Iterator[pa.RecordBatch], column: int, size: int = 2 << 20, tidied: int = TIDY) -> Iterator[pa.RecordBatch]:
    """Slices whose strings in a column take about size bytes together, one row at least. What was freed goes back on the way,
    every so many bytes."""
    since = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, stop - at)
            since += int(ends[stop - 1]) - before
            at = stop
            if since >= tidied:
                tidy()
                since = 0


def tidy() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def raw(column: pa.Array) -> list[bytes]:
    """A string column's UTF-8; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def tidied(run: Callable) -> Callable:
    """run, a function over Arrow batches, which gives freed memory back when a task is done: workers live on for other tasks."""

    def out(batches: Iterator) -> Iterator:
        yield from run(batches)
        tidy()

    return out


def per_worker(key: tuple, make: Callable):
    """What make() returns, made once in each Python worker and kept for its later tasks."""
    kept = sys.__dict__.setdefault("_ledgerline_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def keyed(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs with (left_semi) or without (left_anti) the doc_ids in ids, whatever else either has for columns."""
    right = small(ids.select(F.col("doc_id").alias("__id")).distinct())
    return docs.join(right, docs["doc_id"].eqNullSafe(right["__id"]), how)
