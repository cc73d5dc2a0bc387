"""Joins with provenance: fan-out to siblings, audits by name, overrides, fallbacks, recovered hosts, evidence on pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null, core_tokens, is_blank, overlap_share, squash
from leadloom.operators.merge import best_per_key


def fan_out(df: DataFrame, row_id: str, representative: str, facts: DataFrame) -> DataFrame:
    """``df`` with the facts (by ``row_id``) of each row's representative, or its own, and fanned_from where it is another's."""
    mine = facts.withColumnRenamed(row_id, "__f")
    source = F.coalesce(F.col(representative), F.col(row_id))
    joined = df.withColumn("__s", source).join(mine, F.col("__s") == F.col("__f"), "left")
    return joined.withColumn("fanned_from", F.when((F.col("__s") != F.col(row_id)) & F.col("__f").isNotNull(), F.col("__s"))).drop("__s", "__f")


def audited(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(left join on a unique key, audit): the audit has a row for each side with keys, matched and unmatched keys."""
    names = lambda df: df.where(~is_blank(F.col(key))).select(key).distinct()
    both = names(left).withColumn("__l", F.lit(1)).join(names(right).withColumn("__r", F.lit(1)), key, "full_outer")
    side = lambda own, other, name: both.where(f"{own} is not null").agg(F.count("*").alias("keys"), F.count(other).alias("matched")).select(
        F.lit(name).alias("side"), "keys", "matched", (F.col("keys") - F.col("matched")).alias("unmatched"))
    return left.join(right, key, "left"), side("__l", "__r", "left").unionByName(side("__r", "__l", "right"))


def override(df: DataFrame, key: str, second: DataFrame, column: str, consult: Column) -> DataFrame:
    """``df`` whose ``column`` comes from a second table where ``consult`` holds and that table has a value."""
    other = second.select(F.col(key).alias("__k"), F.col(column).alias("__v"))
    joined = df.join(other, (F.col(key) == F.col("__k")) & consult, "left")
    return joined.withColumn(column, F.coalesce(F.nullif(F.col("__v"), F.lit("")), F.col(column))).drop("__k", "__v")


def first_known(df: DataFrame, sources: dict[str, Column], out: str) -> DataFrame:
    """``df`` with ``out``, the first value that is not blank, and out_source, its name; blank where there is none."""
    value = F.coalesce(*[F.nullif(F.trim(blank_if_null(c)), F.lit("")) for c in sources.values()], F.lit(""))
    name = F.coalesce(*[F.when(~is_blank(c), F.lit(n)) for n, c in sources.items()], F.lit(""))
    return df.withColumns({out: value, f"{out}_source": name})


def with_verdicts(df: DataFrame, key: str, verdicts: DataFrame, fallback: str) -> DataFrame:
    """``df`` with label and confidence of a verdict table (one row for each key), the fallback's where it has none."""
    found = verdicts.select(F.col(key).alias("__k"), F.col("label").alias("__l"), F.col("confidence").alias("__c"))
    joined = df.join(found, F.col(key) == F.col("__k"), "left")
    return joined.withColumns({"label": F.coalesce("__l", F.lit(fallback)), "confidence": F.when(F.col("__l").isNull(), "fallback").otherwise(F.col("__c"))}).drop("__k", "__l", "__c")


def by_email(df: DataFrame, email: str, results: DataFrame, order: str) -> DataFrame:
    """``df`` with the columns of a verifier's results for the same address, whatever its case and spaces (the last result)."""
    plain = lambda c: F.lower(F.trim(blank_if_null(F.col(c))))
    last = best_per_key(results.withColumn("__e", plain("email")), ["__e"], F.col(order).desc()).drop("email", order)
    return df.join(last, plain(email) == F.col("__e"), "left").drop("__e")


def same_company(a: Column, b: Column, stop: list[str]) -> Column:
    """Whether two names share a core word, or one squashed name holds the other (four characters or more)."""
    x, y = squash(a), squash(b)
    holds = (F.least(F.length(x), F.length(y)) >= 4) & (x.contains(y) | y.contains(x))
    return F.arrays_overlap(core_tokens(a, stop), core_tokens(b, stop)) | holds


def host_score(name: Column, host: Column, stop: list[str], least: int = 4) -> Column:
    """Sum of the lengths of a name's words of ``least`` letters or more that a host's first label holds."""
    stem = F.regexp_replace(F.substring_index(F.lower(blank_if_null(host)), ".", 1), "[^a-z0-9]", "")
    hit = F.filter(core_tokens(name, stop), lambda w: (F.length(w) >= least) & stem.contains(w))
    return F.aggregate(hit, F.lit(0), lambda n, w: n + F.length(w))


def best_host(candidates: DataFrame, key: str, name: str, host: str, stop: list[str]) -> DataFrame:
    """For each key the candidate host of the highest score above zero, the first by name on ties."""
    scored = candidates.withColumn("score", host_score(F.col(name), F.col(host), stop)).where("score > 0")
    return scored.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("no"), F.col(host).alias("h"))).alias("m")).select(key, F.col("m.h").alias(host), (-F.col("m.no")).alias("score"))


def domain_fits(name: Column, host: Column, stop: list[str]) -> Column:
    """Whether a word of four letters or more of a name is in a host's first label, or that label in the squashed name."""
    stem = F.regexp_replace(F.substring_index(F.lower(blank_if_null(host)), ".", 1), "[^a-z0-9]", "")
    return (host_score(name, host, stop) > 0) | ((F.length(stem) >= 4) & squash(name).contains(stem))


def name_owns(email: Column, business: Column) -> Column:
    """Whether the label of an address's domain is the compact name of a business, or either begins with the other."""
    label = squash(F.substring_index(F.substring_index(email, "@", -1), ".", 1))
    compact = squash(business)
    return (F.least(F.length(label), F.length(compact)) >= 4) & (label.startswith(compact) | compact.startswith(label))


def page_evidence(text: Column, phone: Column, city: Column) -> Column:
    """phone, city or none: what of a listing a page's text holds (ten digits in a row, or the city's name)."""
    digits = F.regexp_replace(blank_if_null(text), "[^0-9]", "")
    key = F.right(F.regexp_replace(blank_if_null(phone), "[^0-9]", ""), F.lit(10))
    return (F.when((F.length(key) == 10) & digits.contains(key), "phone")
            .when((F.length(F.trim(blank_if_null(city))) > 2) & F.lower(blank_if_null(text)).contains(F.lower(F.trim(blank_if_null(city)))), "city").otherwise("none"))


def keep_by_evidence(evidence: Column, confidence: Column) -> Column:
    """A page is kept with a phone, with a city unless the confidence is low, or on high confidence alone."""
    return (evidence == "phone") | ((evidence == "city") & (confidence != "low")) | (confidence == "high")


def brand_in_page(brand: Column, text: Column) -> Column:
    """accepted, parked or absent: whether a page shows a brand's squashed name, or is a parking page."""
    body = F.lower(blank_if_null(text))
    parked = body.rlike(r"domain (?:is|may be) for sale|buy this domain|parked (?:free|domain)|this domain has expired")
    return F.when(parked, "parked").when((F.length(squash(brand)) >= 3) & squash(text).contains(squash(brand)), "accepted").otherwise("absent")


def candidate_domains(brand: Column, suffixes: list[str]) -> Column:
    """Domains that a brand may have: its name in one word and with hyphens, under each suffix."""
    words = F.filter(F.split(F.regexp_replace(F.lower(blank_if_null(brand)), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    stems = F.array_distinct(F.array(F.array_join(words, ""), F.array_join(words, "-")))
    return F.when(F.size(words) > 0, F.flatten(F.transform(stems, lambda s: F.array(*[F.concat(s, F.lit(f".{x}")) for x in suffixes]))))


def split_by_cache(df: DataFrame, key: Column, cache: DataFrame, cached_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the cached values, rows to ask for): keys of the cache are unique; blank keys are never cached."""
    known = cache.withColumnRenamed(cached_key, "__c")
    rows = df.withColumn("__k", F.when(~is_blank(key), key))
    hit = rows.join(known, F.col("__k") == F.col("__c")).drop("__k", "__c")
    return hit, rows.join(known, F.col("__k") == F.col("__c"), "left_anti").drop("__k")


def grown_cache(cache: DataFrame, answers: DataFrame, keys: list[str], cached_key: str, order: str) -> DataFrame:
    """A cache with answers under each of some keys (what was asked, what it was resolved to); the latest answer wins."""
    values = [c for c in cache.columns if c not in (cached_key, order)]
    new = reduce(lambda a, b: a.unionByName(b), [answers.select(F.col(k).alias(cached_key), *values, order) for k in keys])
    every = cache.select(cached_key, *values, order).unionByName(new.where(~is_blank(F.col(cached_key))))
    return every.groupBy(cached_key).agg(F.max(F.struct(order, *values)).alias("m")).select(cached_key, "m.*")


def home_or_foreign(*, home: list[Column], foreign: Column) -> Column:
    """home with any evidence of the country and no foreign pattern, foreign with only that, conflict with both, else unknown."""
    here = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in home])
    there = F.coalesce(foreign, F.lit(False))
    return F.when(here & there, "conflict").when(here, "home").when(there, "foreign").otherwise("unknown")


def shared_tokens(a: Column, b: Column, stop: list[str]) -> Column:
    """The share of core words of the larger of two names that both have."""
    return overlap_share(core_tokens(a, stop), core_tokens(b, stop))
