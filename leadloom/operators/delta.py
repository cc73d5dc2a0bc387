"""Snapshots against memory: pass union, change flags, upserts and time-to-live reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null, is_blank
from leadloom.operators.merge import first_non_blank


def pass_hits(passes: DataFrame, key: str, pass_col: str) -> DataFrame:
    """(key, pass_hits, first_pass): in how many passes a key occurs, and the first."""
    return passes.groupBy(key).agg(F.count_distinct(pass_col).alias("pass_hits"), F.min(pass_col).alias("first_pass"))


def merged_memory(prior: DataFrame, key: str, order: str, *, first: str = "first_seen", hits: str = "cumulative_hits", delivered: str = "delivered") -> DataFrame:
    """One row for each key of earlier cycles: the first ``first`` that is not blank, the most hits, delivered if any row is
    (a row that does not say so was, so that an old baseline is never new), all other columns of the last row.

    Rows without a key are left out; ``order`` orders the rows of all cycles.
    """
    rest = [c for c in prior.columns if c not in (key, order, first, hits, delivered)]
    was = F.when(is_blank(F.col(delivered).cast("string")), True).otherwise(F.lower(F.col(delivered).cast("string")) == "true")
    merged = prior.where(~is_blank(F.col(key).cast("string"))).groupBy(key).agg(
        first_non_blank(first, F.col(order)).alias(first), F.max(F.coalesce(F.col(hits), F.lit(0))).alias(hits), F.bool_or(was).alias(delivered),
        F.max_by(F.struct(F.lit(0).alias("__"), *rest), F.col(order)).alias("__last"))
    return merged.select(key, first, hits, delivered, *[F.col("__last")[c].alias(c) for c in rest])


def union_with_memory(current: DataFrame, prior: DataFrame, key: str, *, cycle: str, min_hits: int) -> DataFrame:
    """The current cycle's keys with their memory: first_seen, cumulative_hits, delivered and status.

    ``current`` has key and pass_hits; ``prior`` key, first_seen, hits and delivered (several rows a key are merged). A key
    is confirmed if it has ``min_hits`` in this cycle or in all, and pending otherwise, unless it was delivered. A blank first_seen
    is none: the first that is not blank counts, else this cycle.
    """
    memory = prior.groupBy(key).agg(F.min(F.when(~is_blank(F.col("first_seen")), F.col("first_seen"))).alias("m_first"), F.max("hits").alias("m_hits"), F.bool_or("delivered").alias("m_delivered"))
    joined = current.join(memory, key, "left")
    total = F.coalesce("m_hits", F.lit(0)) + F.col("pass_hits")
    delivered = F.coalesce("m_delivered", F.lit(False))
    status = F.when(delivered, "delivered").when((F.col("pass_hits") >= min_hits) | (total >= min_hits), "confirmed").otherwise("pending")
    return joined.select(*current.columns, F.coalesce("m_first", F.lit(cycle)).alias("first_seen"), total.alias("cumulative_hits"), delivered.alias("delivered"), status.alias("status"))


def change_flags(pairs: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """``pairs`` with change_flags: the names of the conditions that hold, joined by |, in the order given."""
    return pairs.withColumn("change_flags", F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()])), "|"))


def changed(a: str, b: str) -> Column:
    """Whether two texts differ, null and blank being alike."""
    return blank_if_null(F.col(a)) != blank_if_null(F.col(b))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str, *, keep: list[str] = ()) -> DataFrame:
    """A new version of a table: for each key the last new row, else the old one; ``keep`` columns stay as first stored.

    Of new rows with one key the last by ``order`` wins. The result has action: inserted, updated or unchanged.
    """
    last = new.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in new.columns if c not in (*keys, order)])).alias("n"))
    rest = [c for c in old.columns if c not in keys]
    stored = old.groupBy(*keys).agg(F.first(F.struct(*rest)).alias("o"))
    both = stored.join(last, keys, "full_outer")
    columns = [(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in keep else F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))).alias(c) for c in rest]
    action = F.when(F.col("o").isNull(), "inserted").when(F.col("n").isNotNull(), "updated").otherwise("unchanged")
    return both.select(*keys, *columns, action.alias("action"))


def fresh(df: DataFrame, when: str, as_of: str, days: int) -> DataFrame:
    """Rows not older than ``days`` at a given moment (never the clock, so that runs repeat)."""
    return df.where(F.col(when) >= F.to_timestamp(F.lit(as_of)) - F.expr(f"INTERVAL {int(days)} DAYS"))


def coverage_gaps(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys that were not seen."""
    return expected.join(seen.select(*keys).distinct(), keys, "left_anti")


def work_key(query: Column, lat: Column, lng: Column) -> Column:
    """query|lat|lng with two decimals: the key of a tile's work; null if a part is."""
    return F.when(lat.isNotNull() & lng.isNotNull(), F.concat(query, F.format_string("|%.2f|%.2f", lat.cast("double"), lng.cast("double"))))


def prefixes_not_seen(prefixes: list[str], seen: DataFrame, code: str) -> DataFrame:
    """Those of a fixed list of prefixes with which no seen code begins."""
    found = seen.select(F.explode(F.filter(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.col(code).startswith(p))).alias("prefix")).distinct()
    return seen.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string").join(found, "prefix", "left_anti")
