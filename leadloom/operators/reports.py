"""Counts, shares and other summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.functions.text import is_blank


def funnel(df: DataFrame, stage: str) -> DataFrame:
    """Rows and share of each stage."""
    counts = df.groupBy(stage).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, rate) of some columns, in one pass."""
    sums = df.agg(F.count("*").alias("__n"), *[F.sum((~is_blank(F.col(c))).cast("long")).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).alias("filled")) for c in columns])).alias("r")
    return sums.select("__n", rows).select("r.column_name", "r.filled", F.round(F.col("r.filled") / F.greatest(F.col("__n"), F.lit(1)), 6).alias("rate"))


def marginal_contribution(df: DataFrame, key: str, pass_col: str) -> DataFrame:
    """For each pass its keys, the keys it adds to the passes before, and the running number of keys."""
    seen = df.groupBy(pass_col).agg(F.count_distinct(key).alias("n_keys"))
    added = df.groupBy(key).agg(F.min(pass_col).alias(pass_col)).groupBy(pass_col).agg(F.count("*").alias("added"))
    both = seen.join(added, pass_col, "left").na.fill(0, ["added"])
    return both.withColumn("running", F.sum("added").over(Window.orderBy(pass_col).rowsBetween(Window.unboundedPreceding, 0)))


def threshold_sensitivity(df: DataFrame, value: Column, thresholds: list[float]) -> DataFrame:
    """Rows that would stay at each threshold, in one pass."""
    sums = df.agg(*[F.sum((value >= t).cast("long")).alias(f"t{i}") for i, t in enumerate(thresholds)])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.coalesce(F.col(f"t{i}"), F.lit(0)).alias("kept")) for i, t in enumerate(thresholds)])).alias("r")).select("r.*")


def tag_totals(df: DataFrame, tags: str, weight: Column) -> DataFrame:
    """Rows and total weight of each |-joined tag."""
    return df.select(F.explode(F.split(F.col(tags), r"\|")).alias("tag"), weight.alias("w")).groupBy("tag").agg(F.count("*").alias("n"), F.sum("w").alias("total_weight"))


def zero_suspects(tiles: DataFrame, centre: str, tile: str, count: str, ok: str, floor: int) -> DataFrame:
    """Tiles that were fetched fine and empty although their centre's best tile has more than ``floor`` rows."""
    by_tile = tiles.groupBy(centre, tile).agg(F.max(count).alias("best"), F.bool_or(ok).alias("any_ok"))
    by_centre = by_tile.groupBy(centre).agg(F.max("best").alias("centre_best"))
    return by_tile.join(by_centre, centre).where(F.col("any_ok") & (F.col("best") == 0) & (F.col("centre_best") > floor))


def manifest(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One row with a JSON text: the number of rows, then for each name the rows in which its condition holds."""
    flags = [F.count(F.when(c, F.lit(1))).alias(n) for n, c in counts.items()]
    return df.agg(F.count("*").alias("rows"), *flags).select(F.to_json(F.struct("rows", *counts)).alias("manifest"))
