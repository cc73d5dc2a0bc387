"""Order-aware merges of repeated records: input order is part of the data and comes as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.functions.text import is_blank


def ordered_distinct(df: DataFrame, keys: list[str], column: str, order: Column) -> DataFrame:
    """(keys, column): for each key the distinct values in the order of their first appearance; repeats go before values
    are gathered, so a key's array holds its distinct values only."""
    each = df.select(*keys, F.col(column).alias("__v"), order.alias("__o"))
    firsts = each.groupBy(*keys, "__v").agg(F.min(F.struct(F.col("__o").alias("o"), F.col("__v").alias("v"))).alias("s"))
    return firsts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["v"]).alias(column))


def first_non_blank(column: str, order: Column) -> Column:
    """Aggregate: the first value that is not blank, else the empty string."""
    return F.coalesce(F.min_by(F.col(column), F.when(~is_blank(F.col(column)), order)), F.lit(""))


def merge_by_key(df: DataFrame, keys: list[str], order: Column, *, fields: list[str] = (), tags: list[str] = ()) -> DataFrame:
    """One row for each key: first non-blank fields, tags as ordered distinct arrays."""
    merged = df.select(*keys).distinct() if not fields else df.groupBy(*keys).agg(*[first_non_blank(c, order).alias(c) for c in fields])
    for c in tags:
        found = ordered_distinct(df, keys, c, order).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(c).alias("__tags"))
        same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        merged = merged.join(found, same).drop(*[f"__k{i}" for i in range(len(keys))]).withColumnRenamed("__tags", c)
    return merged


def best_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by the order given (top 1 in each group)."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def merge_onto_best(df: DataFrame, keys: list[str], score: Column, order: Column, fields: list[str]) -> DataFrame:
    """One row for each key: the row of the highest score (first on ties), its blanks filled from the first other value."""
    rank = F.struct((-score).alias("s"), order.alias("o"))
    picks = [F.coalesce(F.nullif(F.trim(F.min_by(F.col(c).cast("string"), rank)), F.lit("")), first_non_blank(c, order)).alias(c) for c in fields]
    return df.groupBy(*keys).agg(F.max(score).alias("best_score"), F.count("*").alias("rows_merged"), *picks)


def union_first_source(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union in which, for each key, the rows of the first source that has it win (one row a key)."""
    tagged = [f.withColumn("source_rank", F.lit(i)) for i, f in enumerate(frames)]
    whole = tagged[0]
    for f in tagged[1:]:
        whole = whole.unionByName(f, allowMissingColumns=True)
    rest = [c for c in whole.columns if c not in (*keys, "source_rank")]
    return whole.groupBy(*keys).agg(F.min(F.struct("source_rank", *rest)).alias("m")).select(*keys, "m.*")


def collapse_groups(df: DataFrame, group: str, row_id: str, order: list[Column]) -> DataFrame:
    """``df`` with group_size, is_multi and rep (id of the first row of the group); blank groups are rows of their own."""
    named = df.where(~is_blank(F.col(group)))
    sizes = named.groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("__n"))
    first = best_per_key(named, [group], *order).select(F.col(group).alias("__f"), F.col(row_id).alias("__rep"))  # a limit before the shuffle
    found = sizes.join(first, F.col("__g") == F.col("__f")).drop("__f")
    size = F.coalesce("__n", F.lit(1))
    return df.join(found, F.col(group) == F.col("__g"), "left").withColumns({
        "group_size": size, "is_multi": size > 1, "rep": F.when(F.col("__g").isNull(), F.col(row_id)).otherwise(F.col("__rep")),
    }).drop("__g", "__n", "__rep")
