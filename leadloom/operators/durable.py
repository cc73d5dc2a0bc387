"""Tables written to the folder that driver and executors share, and the size check of broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Most bytes of a table that is broadcast, measured before.
BROADCAST_BYTES = 64_000_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of this machine in local mode, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "leadloom-checkpoints")


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def durable(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` as Parquet in the shared folder: computed once, without lineage, safe from lost executors.

    The files go when the driver's JVM ends, or with ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leadloom-{uuid.uuid4().hex[:12]}-{label}"
    df.write.parquet(path)
    where, files = _path(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out.durable_path = path
    return out


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder of the shared one, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/leadloom-{uuid.uuid4().hex[:12]}-{label}"
    where, files = _path(spark, path)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``durable`` has returned and nothing reads any more."""
    for table in tables:
        where, files = _path(table.sparkSession, table.durable_path)
        files.delete(where, True)


def _bytes(field: T.StructField) -> F.Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 24
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 24
    return F.lit(16)


def small_side(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows come to ``most_bytes`` or less, else as it is (a shuffled join)."""
    rows = most_bytes // (16 * max(1, len(df.columns)))
    size = sum((_bytes(f) for f in df.schema), F.lit(16))
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= rows and found["bytes"] <= most_bytes else df
