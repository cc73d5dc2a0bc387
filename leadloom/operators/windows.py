"""Ranks, top lists, samples and batches that depend on order columns, never on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.operators.ranking import numbered


def rank_within(df: DataFrame, key: str, order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with 1-based ranks of the rows of each key."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows (each task keeps its first ``n``, the driver none)."""
    return df.orderBy(*order).limit(n)


def top_one_each(df: DataFrame, key: str, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of a list that has each key's best row only."""
    return top(rank_within(df, key, order, "__r").where("__r = 1").drop("__r"), n, order)


def even_sample(df: DataFrame, k: int, order: list[str]) -> DataFrame:
    """``k`` rows at even distances of the ordered rows; all rows if they are fewer."""
    step = max(1, df.count() // k) if k else 1
    n = F.col("__n") - 1
    return numbered(df, order, "__n").where((n % step == 0) & (n < k * step)).drop("__n")


def seeded_sample(df: DataFrame, k: int, key: str, seed: int) -> DataFrame:
    """``k`` rows by the hash of their key and a seed: the same rows whatever the order and the partitions."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(k)


def homogeneous_batches(df: DataFrame, tier: str, order: list[Column], size: int, out: str = "batch") -> DataFrame:
    """``df`` in batches from 0 of at most ``size`` rows of one tier, tiers in their order.

    A tier's rows are ranked within (tier) by range-partitioned numbers, so no tier gathers in one task.
    """
    each = numbered(df, [F.col(tier), *order], "__n")
    sizes = each.groupBy(tier).agg(F.count("*").alias("__rows"), F.min("__n").alias("__first"))
    # a row for each tier
    before = Window.orderBy(tier).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__offset", F.coalesce(F.sum(F.ceil(F.col("__rows") / size)).over(before), F.lit(0))).withColumnRenamed(tier, "__tier")
    joined = each.join(F.broadcast(sizes), F.col(tier).eqNullSafe(F.col("__tier")))
    return joined.withColumn(out, (F.col("__offset") + F.floor((F.col("__n") - F.col("__first")) / size)).cast("int")).drop("__n", "__tier", "__rows", "__first", "__offset")


def last_class_last(df: DataFrame, text: str, pattern: str, order: list[Column]) -> list[Column]:
    """Order columns that put rows whose text matches a pattern (such as an anti-bot status) after all others."""
    return [F.coalesce(F.col(text).rlike(pattern), F.lit(False)), *order]


def one_target(df: DataFrame, group: str, priority: Column, order: Column) -> DataFrame:
    """For each group the row of the least priority class, the first by order on ties."""
    rest = [c for c in df.columns if c != group]
    return df.groupBy(group).agg(F.min_by(F.struct(*rest), F.struct(priority.alias("p"), order.alias("o"))).alias("m")).select(group, "m.*")


def sticky_tranches(df: DataFrame, key: str, order: list[str], size: int, known: DataFrame, out: str = "tranche") -> DataFrame:
    """``df`` with tranches: a key that ``known`` (key, tranche) has keeps its own; new rows fill the last one and go on."""
    held = known.groupBy(key).agg(F.min(out).alias("__t"))
    last = held.groupBy("__t").agg(F.count("*").alias("n")).orderBy(F.col("__t").desc()).first()
    first, used = (last["__t"], last["n"]) if last else (1, 0)
    joined = df.join(held, key, "left")
    fresh = numbered(joined.where("__t is null"), order, "__n").withColumn(out, (first + F.floor((F.col("__n") - 1 + used) / size)).cast("int"))
    return joined.where("__t is not null").withColumn(out, F.col("__t").cast("int")).drop("__t").unionByName(fresh.drop("__t", "__n"))
