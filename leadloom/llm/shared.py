"""Helpers shared by the training-data operators: table access, durable intermediates, worker imports."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from leadloom.operators.durable import durable as written, shared_dir, small_side as small_keys  # noqa: F401

REPO_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set at ``sf_dir`` (any file system that Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder of the shared one, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/leadloom-{uuid.uuid4().hex[:12]}-{label}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


#: Rows and bytes of a batch between the JVM and a Python worker: long texts make large rows, held twice on either side.
BATCH_ROWS, BATCH_BYTES = 1000, 8_000_000
#: Large blocks go back to the system when freed, so a worker that is used again stays small.
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2"}


def let_workers_import(spark: SparkSession) -> None:
    """Put the repository on the Python path of the executors' workers, and keep their batches and memory small."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if REPO_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([REPO_ROOT, *paths])
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh_prefix(*frames: DataFrame) -> str:
    """A prefix that no column of the frames has, for columns of an operator's own."""
    names = [c.lower() for f in frames for c in f.columns]
    prefix = "__"
    while any(c.startswith(prefix) for c in names):
        prefix += "_"
    return prefix


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches in the order of the keys; each batch is looked at once."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        if held and tuple(c[0] for c in cols) != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(bounds, bounds[1:]):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
