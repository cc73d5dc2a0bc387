"""Registrable domains by a list of public suffixes: the longest suffix of a host that the list holds.

The list is a table of rules as public lists have them (``co.uk``, ``*.ck`` for any label, ``!www.ck`` for an exception). A host
looks its last one, two, three ... labels up, a join on equal keys for each length that a rule has, so the list is the reversed-label
trie level by level: it is broadcast where its bytes are few, else both sides are shuffled by the suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null
from leadloom.operators.durable import durable, small_side


def _tidy(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(blank_if_null(c))), r"^www\.", ""), r"^\.+|\.+$", "")


def with_suffix(df: DataFrame, host: str, rules: DataFrame, rule: str = "suffix") -> DataFrame:
    """``df`` with ``domain``: struct(label, suffix, root) of the host by the longest rule, blanks where there is none.

    An exception beats its wildcard, the longest rule beats shorter ones, and a host under no rule has its last label as suffix.
    The root is the suffix with one label before it; a host that is a suffix itself has none. Rules are taken in any case,
    repeated and blank ones count once and not at all. A leading ``www.`` and outer points are no part of a host.
    """
    r = F.lower(F.trim(blank_if_null(F.col(rule))))
    kind = F.when(r.startswith("!"), "exception").when(r.startswith("*."), "any").otherwise("plain")
    bare = F.regexp_replace(r, r"^(?:!|\*\.)", "")
    known = durable(rules.select(kind.alias("kind"), bare.alias("name")).where("name <> ''").groupBy("name").agg(
        F.bool_or(F.col("kind") == "plain").alias("plain"), F.bool_or(F.col("kind") == "any").alias("any"), F.bool_or(F.col("kind") == "exception").alias("exception")), "suffixes")
    lengths = [x[0] for x in known.select(F.size(F.split("name", r"\.")).alias("n")).distinct().orderBy("n").collect()]  # labels of a rule: a few
    labels = F.filter(F.split(_tidy(F.col(host)), r"\."), lambda x: x != "")
    rows, n = df.withColumn("__labels", labels), F.size("__labels")
    last = lambda k: F.array_join(F.slice("__labels", F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
    size = F.least(F.lit(1), n)
    for k in lengths:
        own = known.where(F.size(F.split("name", r"\.")) == k).select(F.col("name").alias(f"__n{k}"), F.struct("plain", "any", "exception").alias(f"__r{k}"))
        rows = rows.withColumn(f"__s{k}", F.when(n >= k, last(k))).join(small_side(own), F.col(f"__s{k}") == F.col(f"__n{k}"), "left")
        found = F.col(f"__r{k}")
        size = F.when(found["any"] & (n > k), F.greatest(size, F.lit(k + 1))).when(found["plain"], F.greatest(size, F.lit(k))).otherwise(size)
    for k in lengths:
        size = F.when(F.col(f"__r{k}")["exception"], F.lit(k - 1)).otherwise(size)
    rows = rows.withColumn("__size", size)
    suffix = F.array_join(F.slice("__labels", F.greatest(n - F.col("__size") + 1, F.lit(1)), F.col("__size")), ".")
    label = F.coalesce(F.get("__labels", n - F.col("__size") - 1), F.lit(""))
    domain = F.struct(F.when(n > F.col("__size"), label).otherwise("").alias("label"), F.when(n > 0, suffix).otherwise("").alias("suffix"),
                      F.when(n > F.col("__size"), F.concat(label, F.lit("."), suffix)).otherwise("").alias("root"))
    return rows.withColumn("domain", domain).select(*[c for c in df.columns if c != "domain"], "domain")
