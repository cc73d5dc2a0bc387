"""Steps between stages: labels of baseline and change, second looks, sets to redo, recovered texts, tracks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import is_blank

# A first verifier's words by class.
VERIFIER_CLASSES = {"sendable": r"^(?:ok|valid|deliverable|safe)$", "risky": r"^(?:risky|catch.?all|accept.?all|unknown|role)$", "dropped": r"^(?:invalid|undeliverable|disposable|spamtrap|bounce.*)$"}


def angle(baseline: Column, flags: Column) -> Column:
    """baseline on a first run, else changed with its flags, or new."""
    return F.when(baseline, "baseline").when(F.size(flags) > 0, F.concat(F.lit("changed:"), F.array_join(flags, "+"))).otherwise("new")


def verifier_class(result: Column) -> Column:
    """sendable, risky, dropped or unverified of another verifier's word."""
    text = F.lower(F.trim(F.coalesce(result, F.lit(""))))
    return F.coalesce(*[F.when(text.rlike(p), name) for name, p in VERIFIER_CLASSES.items()], F.lit("unverified"))


def recovered(df: DataFrame, key: str, again: DataFrame, result: str, retry: Column) -> DataFrame:
    """``df`` whose result is that of a second run where the first was to be retried and the second has one."""
    second = again.select(F.col(key).alias("__k"), F.col(result).alias("__r"))
    out = df.join(second, (F.col(key) == F.col("__k")) & retry, "left")
    return out.withColumn(result, F.coalesce("__r", F.col(result))).drop("__k", "__r")


def redo_set(lists: list[DataFrame], key: str) -> DataFrame:
    """The distinct keys of several lists of flagged rows."""
    return reduce(lambda a, b: a.unionByName(b), [x.select(key) for x in lists]).distinct()


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n) of rules that rows break; a caller stops where there are any."""
    each = df.select(F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("rule"))
    return each.groupBy("rule").agg(F.count("*").alias("n"))


def undo_wrong_fan_out(df: DataFrame, key: str, host: str, directories: list[str], own: DataFrame) -> DataFrame:
    """``df`` where a host is a directory's: the host of its own table (key, host) in its place, else blank, marked repaired."""
    wrong = F.coalesce(F.col(host).isin(*directories), F.lit(False))
    other = own.select(F.col(key).alias("__k"), F.col(host).alias("__h"))
    out = df.join(other, (F.col(key) == F.col("__k")) & wrong, "left")
    return out.withColumns({host: F.when(wrong, F.coalesce("__h", F.lit(""))).otherwise(F.col(host)), "repaired": wrong}).drop("__k", "__h")


def tracks(df: DataFrame, passes: dict[str, Column]) -> DataFrame:
    """``df`` with geo_pass: the first track whose condition holds; rows of no track are left out."""
    name = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in passes.items()])
    return df.withColumn("geo_pass", name).where("geo_pass is not null")


def with_directors(items: DataFrame, key: str, directors: DataFrame, name: str, order: str) -> DataFrame:
    """``items`` with a line of the directors' names in order and whether there are any."""
    lines = directors.where(~is_blank(F.col(name))).groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_set(F.struct(F.col(order).alias("o"), F.col(name).alias("n")))).alias("d"))
    out = items.join(lines, F.col(key) == F.col("__k"), "left")
    return out.withColumn("directors", F.coalesce(F.array_join(F.transform("d", lambda x: x["n"]), "; "), F.lit(""))).withColumn("have", F.col("directors") != "").drop("__k", "d")


def site_residue(main: DataFrame, again: DataFrame, key: str, text: str, failed: Column) -> DataFrame:
    """Site texts where a failed one is replaced by a recovered one of the same website."""
    better = again.where(~is_blank(F.col(text))).groupBy(F.col(key).alias("__k")).agg(F.max(text).alias("__t"))
    out = main.join(better, (F.col(key) == F.col("__k")) & failed, "left")
    return out.withColumn(text, F.coalesce("__t", F.col(text))).withColumn("recovered", F.col("__t").isNotNull()).drop("__k", "__t")
