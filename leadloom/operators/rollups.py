"""Aggregates of lists: roll-ups of companies and listings, statistics of passes, calls, formats and rungs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.functions.text import is_blank
from leadloom.operators.merge import first_non_blank, merge_by_key


def shard_merge_simple(df: DataFrame, key: str, order: str, tag: str, back_fill: list[str], keep: list[str]) -> DataFrame:
    """The first row of each key with its own ``keep`` values, ``back_fill`` from the first row that has them, and all tags."""
    first = df.groupBy(key).agg(F.min_by(F.struct(*keep), F.col(order)).alias("m")).select(key, "m.*")
    return first.join(merge_by_key(df, [key], F.col(order), fields=back_fill, tags=[tag]), key)


def company_rollup(df: DataFrame, key: str, order: str, *, sets: list[str], fields: list[str]) -> DataFrame:
    """Rows, distinct values of some columns in order, and first non-blank values of others, for each company."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.join(merge_by_key(df, [key], F.col(order), fields=fields, tags=sets), key)


def directory_rollup(df: DataFrame, key: str, order: str, *, category: str, country: str, fields: list[str], once: list[str] = ()) -> DataFrame:
    """Cards of a directory that lists a company under many categories and countries, as one row for each company.

    ``once`` columns are those of the first card, ``fields`` the first that is not blank, category and country sorted sets joined by
    ``;``. Cards without a key are left out.
    """
    known = df.where(~is_blank(F.col(key).cast("string")))
    first = known.groupBy(key).agg(*[F.min_by(F.col(c), F.col(order)).alias(c) for c in once], *[first_non_blank(c, F.col(order)).alias(c) for c in fields])
    for c in (category, country):
        sets = known.where(~is_blank(F.col(c))).select(key, c).distinct().groupBy(F.col(key).alias("__k")).agg(F.array_join(F.array_sort(F.collect_list(c)), ";").alias(c))
        first = first.join(sets, F.col(key) == F.col("__k"), "left").drop("__k").withColumn(c, F.coalesce(c, F.lit("")))
    return first


def listing_rollup(df: DataFrame, key: str, order: str, *, term: str, place: str) -> DataFrame:
    """Listings as their first card has them, with ``found_by``: each "term @ place" that found it, in the order of discovery."""
    found = df.where(F.col(key).isNotNull()).withColumn("found_by", F.concat(F.coalesce(term, F.lit("")), F.lit(" @ "), F.coalesce(place, F.lit(""))))
    rest = [c for c in df.columns if c not in (key, term, place, order)]
    first = found.groupBy(key).agg(F.min_by(F.struct(F.lit(0).alias("__"), *rest), F.col(order)).alias("m"))
    tags = merge_by_key(found, [key], F.col(order), tags=["found_by"])
    return first.join(tags, key).select(key, *[F.col("m")[c].alias(c) for c in rest], F.array_join("found_by", ";").alias("found_by"))


def firmographic_rollup(df: DataFrame, key: str, order: str, size: str) -> DataFrame:
    """For each key the last row with a size above zero, else its first row."""
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.when(F.col(size) > 0, F.col(order)))
    return df.groupBy(key).agg(F.coalesce(last, F.min_by(F.struct(*rest), F.col(order))).alias("m")).select(key, "m.*")


def pass_contribution(df: DataFrame, key: str, number: str) -> DataFrame:
    """For each pass: its keys, those that no earlier pass has, all so far, its share of them all and the growth in percent."""
    seen = df.groupBy(number).agg(F.countDistinct(key).alias("keys"))
    first = df.groupBy(key).agg(F.min(number).alias(number)).groupBy(number).agg(F.count("*").alias("added"))
    # a row for each pass
    w = Window.orderBy(number)
    out = seen.join(first, number, "left").withColumn("added", F.coalesce("added", F.lit(0))).withColumn("total", F.sum("added").over(w))
    every = F.max("total").over(Window.partitionBy())
    return out.withColumn("capture_pct", F.round(100 * F.col("keys") / every, 1)).withColumn("growth_pct", F.round(100 * F.col("added") / F.lag("total").over(w), 1))


def single_hit_rate(df: DataFrame, tags: Column, hits: Column) -> DataFrame:
    """For each of a row's tags: rows, rows with one hit, and their share."""
    each = df.select(F.explode(tags).alias("tag"), hits.alias("hits"))
    one = (F.col("hits") == 1).cast("double")
    return each.groupBy("tag").agg(F.count("*").alias("n"), F.sum(one).cast("long").alias("single"), F.round(F.avg(one), 4).alias("single_rate"))


def call_rollup(calls: DataFrame, shard: str, *, pages: str, rows: str, status: str, extra: str) -> DataFrame:
    """For each shard: events, calls (the pages of an event, else one), those without rows and not ok, and their share of the
    calls of the plan itself (without extras)."""
    n = F.coalesce(F.when(F.col(pages) > 0, F.col(pages)), F.lit(1))
    own = ~F.coalesce(F.col(extra), F.lit(False))
    zero, failed = F.coalesce(F.col(rows), F.lit(0)) == 0, F.coalesce(F.col(status), F.lit("")) != "ok"
    return calls.groupBy(shard).agg(
        F.count("*").alias("events"), F.sum(n).cast("long").alias("calls"), F.sum(zero.cast("long")).alias("zero"), F.sum(failed.cast("long")).alias("failed"),
        F.round(100 * F.sum((zero & own).cast("long")) / F.nullif(F.sum(own.cast("long")), F.lit(0)), 1).alias("zero_pct"))


def page_depths(calls: DataFrame, shard: str, pages: str) -> DataFrame:
    """How many events of each shard went how many pages deep."""
    return calls.groupBy(shard, F.greatest(F.coalesce(F.col(pages), F.lit(1)), F.lit(1)).alias("depth")).agg(F.count("*").alias("n"))


def all_empty(df: DataFrame, centre: str, rows: str) -> DataFrame:
    """Centres of which every query came back empty, with the number of queries."""
    return df.groupBy(centre).agg(F.count("*").alias("queries"), F.bool_and(F.coalesce(F.col(rows), F.lit(0)) == 0).alias("empty")).where("empty").drop("empty")


def format_breakdown(ads: DataFrame, kind: str, days: str, live: Column) -> DataFrame:
    """Number, sum and most of days, and live ones for each format."""
    return ads.groupBy(kind).agg(F.count("*").alias("n"), F.sum(days).alias("days"), F.sum(live.cast("long")).alias("live"), F.max(days).alias("longest"))


def summary(ads: DataFrame, advertiser: str, days: str, live: Column) -> DataFrame:
    """One row: ads, advertisers, exact median of the days above zero, most days, live ads."""
    return ads.agg(F.count("*").alias("ads"), F.countDistinct(advertiser).alias("advertisers"), F.median(F.when(F.col(days) > 0, F.col(days))).alias("median_days"),
                   F.max(days).alias("longest"), F.coalesce(F.sum(live.cast("long")), F.lit(0)).alias("live"))


def advertisers(ads: DataFrame, keys: list[str], term: str, url: str, order: str, active: Column, text: str) -> DataFrame:
    """For each advertiser: ads, distinct terms, ads with a text and active ones, and the first address that is not blank."""
    return ads.groupBy(*keys).agg(F.count("*").alias("ads"), F.countDistinct(term).alias("terms"), F.sum((~is_blank(F.col(text))).cast("long")).alias("with_text"),
                                  F.sum(active.cast("long")).alias("active"), first_non_blank(url, F.col(order)).alias("url"))


def rung_report(trail: DataFrame, rung: str, outcome: str, cost: str) -> DataFrame:
    """For each rung of a waterfall: attempts, found, sendable, out of credits, cost, and cost of one sendable."""
    hit = lambda *names: F.sum(F.col(outcome).isin(*names).cast("long"))
    out = trail.groupBy(rung).agg(F.count("*").alias("attempted"), hit("sendable", "risky", "dropped").alias("found"), hit("sendable").alias("sendable"),
                                  hit("no_credits").alias("no_credits"), F.round(F.sum(cost), 2).alias("cost"))
    return out.withColumn("cost_per_sendable", F.when(F.col("sendable") > 0, F.round(F.col("cost") / F.col("sendable"), 4)))


def credit_estimate(contacts: DataFrame, domain: str, patterns: int, each: float) -> DataFrame:
    """One row: contacts, domains, patterns of an address, and the most credits that trying them all can take."""
    return contacts.agg(F.count("*").alias("contacts"), F.countDistinct(domain).alias("domains")).select(
        "*", F.lit(patterns).alias("patterns"), F.round(F.col("contacts") * patterns * each, 2).alias("most_credits"))


def flag_lists(df: DataFrame, row_id: str, flags: dict[str, Column], most: int = 100) -> DataFrame:
    """For each flag: how many rows raise it, and the least ``most`` of their ids, a list for a report."""
    each = df.select(F.col(row_id).alias("id"), F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda f: f.isNotNull())).alias("flag"))
    ranked = each.withColumn("r", F.row_number().over(Window.partitionBy("flag").orderBy("id")))  # a limit before the shuffle
    ids = ranked.where(F.col("r") <= most).groupBy("flag").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return each.groupBy("flag").agg(F.count("*").alias("n")).join(ids, "flag")


def co_tenancy(df: DataFrame, row_id: str, street: str, floor: str, tags: str, hubs: str) -> DataFrame:
    """``df`` with co_tenants (rows of the same building), top_floor and hub (a tag of any of its rows matches ``hubs``).

    Rows without a building's key are alone. A building's figures are counted once and joined.
    """
    named = df.where(~is_blank(F.col(street)))
    sizes = named.groupBy(F.col(street).alias("__s")).agg(F.count("*").alias("__n"), F.max(floor).alias("__f"), F.bool_or(F.lower(F.col(tags)).rlike(hubs)).alias("__h"))
    return df.join(sizes, F.col(street) == F.col("__s"), "left").withColumns({
        "co_tenants": F.coalesce("__n", F.lit(1)), "top_floor": F.col("__f"), "hub": F.coalesce("__h", F.lit(False))}).drop("__s", "__n", "__f", "__h")
