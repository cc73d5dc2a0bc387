"""Row numbers over a whole table without a single task, and what is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.operators.durable import durable


def numbered(df: DataFrame, order: list[str | Column], out: str = "row_number") -> DataFrame:
    """``df`` with 1-based numbers in the order of columns that are unique together.

    Rows are range-partitioned and written once with their partition's number; each partition numbers its own rows and
    adds the rows of the partitions before it (one count for each partition).
    """
    parts = durable(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    own = parts.withColumn("__rn", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return own.join(F.broadcast(before), "__part").withColumn(out, F.col("__rn") + F.col("__before")).drop("__part", "__rn", "__before")


def batches(df: DataFrame, order: list[str], size: int, out: str = "batch_id") -> DataFrame:
    """``df`` in numbered batches of ``size`` rows, from 0."""
    return numbered(df, order, "__i").withColumn(out, F.floor((F.col("__i") - 1) / size).cast("int")).drop("__i")


def round_robin(df: DataFrame, order: list[str], shards: int, out: str = "shard") -> DataFrame:
    return numbered(df, order, "__i").withColumn(out, ((F.col("__i") - 1) % shards).cast("int")).drop("__i")


def tranches(df: DataFrame, order: list[str], size: int, *, already: int = 0, first: int = 1, out: str = "tranche") -> DataFrame:
    """``df`` in tranches of ``size`` rows after ``already`` rows that fill the first ones."""
    return numbered(df, order, "__i").withColumn(out, (first + F.floor((F.col("__i") - 1 + already) / size)).cast("int")).drop("__i")
