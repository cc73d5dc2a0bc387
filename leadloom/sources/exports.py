"""Exports of other systems as lists of one shape: businesses, dealers, ads, raw maps rows, and inputs of retries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadloom.functions.text import blank_if_null, is_blank, lenient_host, root_domain
from leadloom.operators.merge import best_per_key


def find_files(spark: SparkSession, path: str, name: str, skip: list[str] = ("_archive", "node_modules")) -> DataFrame:
    """(path, size, modified) of files below a folder whose name matches a regular expression, without some folders."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    barred = reduce(lambda a, b: a | b, [F.col("path").contains(f"/{s}/") for s in skip], F.lit(False))
    return found.where(F.regexp_extract("path", r"([^/]+)$", 1).rlike(name) & ~barred)


def businesses(df: DataFrame, *, name: str, website: str, city: str, order: str) -> DataFrame:
    """The first row of each business: by its root domain, else by name and city."""
    domain = root_domain(lenient_host(F.col(website)))
    key = F.when(domain != "", domain).otherwise(F.concat_ws("|", F.lower(F.trim(F.col(name))), F.lower(F.trim(blank_if_null(F.col(city))))))
    return best_per_key(df.withColumns({"domain": domain, "key": key}), ["key"], F.col(order))


def stacked(sources: dict[str, tuple[DataFrame, dict[str, Column]]], columns: list[str], keep: Column | None = None) -> DataFrame:
    """Dumps of several sources, each with its own expressions, as rows of common text columns and the source's name."""
    rows = [df.select(F.lit(name).alias("source"), *[blank_if_null(exprs[c]).alias(c) if c in exprs else F.lit("").alias(c) for c in columns]) for name, (df, exprs) in sources.items()]
    out = reduce(lambda a, b: a.unionByName(b), rows)
    return out if keep is None else out.where(keep)


def ads(df: DataFrame, fields: list[str], cards: str) -> DataFrame:
    """Nested ads flattened: a field of the ad, or of its first card where the ad has none."""
    first = F.get(F.col(cards), 0)
    return df.select(*[c for c in df.columns if c not in (*fields, cards)], *[F.coalesce(F.nullif(blank_if_null(F.col(f)), F.lit("")), blank_if_null(first[f])).alias(f) for f in fields])


def place_id(url: Column) -> Column:
    """The place's id in a maps address, or blank."""
    return F.regexp_extract(blank_if_null(url), r"(?:place_id[:=]|!1s|query_place_id=)([A-Za-z0-9:_-]{6,})", 1)


def retry_input(status: DataFrame, items: DataFrame, key: str, unreachable: Column, dead: Column) -> DataFrame:
    """Input rows whose last visit did not get through and that are not known as dead."""
    names = status.where(F.coalesce(unreachable, F.lit(False)) & ~F.coalesce(dead, F.lit(False)) & ~is_blank(F.col(key))).select(F.col(key).alias("__k")).distinct()
    return items.join(names, F.col(key) == F.col("__k"), "left_semi")
