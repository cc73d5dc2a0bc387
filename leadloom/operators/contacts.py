"""Contacts of leads: guardrails on what a reader has found, merges of sources, primary choice, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.functions.people import DEPARTED, EXCLUDED_ROLES
from leadloom.functions.text import blank_if_null, is_blank

# Buckets of roles in the order of choice, words that no person's name has.
BUCKET_ORDER = ["owner_or_partner", "gm", "marketing", "sales_manager", "office_manager", "other"]
ROLE_WORDS = ("owner president manager director founder ceo vp estimator technician foreman inspector sales marketing office team staff").split()


def _plain(c: Column) -> Column:
    text = F.regexp_replace(F.replace(F.lower(blank_if_null(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9 ]+", " ")
    return F.trim(F.regexp_replace(text, " +", " "))


def business_as_person(name: Column, business: Column, first_names: list[str]) -> Column:
    """Whether a name is the leading part of its business's name; not if its first word is a known first name."""
    n, b = _plain(name), _plain(business)
    known = F.substring_index(n, " ", 1).isin(*[x.lower() for x in first_names] or [""])
    return (n != "") & F.concat(b, F.lit(" ")).startswith(F.concat(n, F.lit(" "))) & ~known


def departed(evidence: Column, first: int = 120) -> Column:
    """Whether the beginning of an evidence speaks of a former person."""
    return F.substring(blank_if_null(evidence), 1, first).rlike(DEPARTED)


def guard(*, name: str = "name", evidence: str = "evidence", bucket: str = "role_bucket", title: str = "title", business: str = "business_name",
          first_names: list[str] = (), trade: list[str] = (), excluded: str = EXCLUDED_ROLES, buckets: list[str] = BUCKET_ORDER) -> Column:
    """The first guard that a contact fails, or null: no_evidence_name, bad_bucket, role_word, trade_word, business_name,
    single_token, excluded_title."""
    n = F.trim(blank_if_null(F.col(name)))
    tokens = F.filter(F.split(n, r"\s+"), lambda t: F.length(t) > 1)
    text = F.lower(blank_if_null(F.col(evidence)))
    told = F.exists(tokens, lambda t: text.contains(F.lower(F.regexp_replace(t, "[.,]", ""))))
    has = lambda words: n.rlike(r"(?i)\b(?:" + "|".join(words) + r")\b") if words else F.lit(False)
    return (F.when(~told, "no_evidence_name").when(~blank_if_null(F.col(bucket)).isin(*buckets), "bad_bucket").when(has(ROLE_WORDS), "role_word")
            .when(has(list(trade)), "trade_word").when(business_as_person(F.col(name), F.col(business), list(first_names)), "business_name")
            .when(F.size(tokens) < 2, "single_token").when(F.lower(blank_if_null(F.col(title))).rlike(excluded), "excluded_title"))


def kept_contacts(contacts: DataFrame, lead: str, order: str, reason: Column, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(contacts that pass, one of each lead's name in lower case, the first) and (reason, n) of the others."""
    judged = contacts.where(~is_blank(F.col(name))).withColumn("drop_reason", reason)
    first = Window.partitionBy(lead, F.lower(F.trim(name))).orderBy(order)
    kept = judged.where("drop_reason is null").withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r", "drop_reason")
    return kept, judged.where("drop_reason is not null").groupBy("drop_reason").agg(F.count("*").alias("n"))


def primary_contact(contacts: DataFrame, lead: str, order: str, bucket: str = "role_bucket", buckets: list[str] = BUCKET_ORDER) -> DataFrame:
    """For each lead the first contact of the first bucket that it has; buckets not listed come last."""
    rank = F.coalesce(*[F.when(F.col(bucket) == b, F.lit(i)) for i, b in enumerate(buckets)], F.lit(len(buckets)))
    rest = [c for c in contacts.columns if c != lead]
    return contacts.groupBy(lead).agg(F.min_by(F.struct(*rest), F.struct(rank.alias("r"), F.col(order).alias("o"))).alias("m")).select(lead, "m.*")


def chosen_primary(leads: DataFrame, contacts: DataFrame, lead: str, order: str, *, buckets: list[str] = BUCKET_ORDER, unsure_sources: list[str] = ("web_search",)) -> DataFrame:
    """For each lead: primary_name, first_name, last_name, primary_title, role_bucket, name_source, name_evidence, other_contacts, qa_flags.

    ``leads`` has email, email_type, email_own_basis, first_name_hint, last_name_hint, name_confidence, name_evidence, brand_family and
    adjudication; ``contacts`` name, first_name, last_name, title, role_bucket, source and evidence. Contacts go by bucket, then by
    ``order``; the first that is not ``other`` is primary. A personal address whose local part holds a contact's surname (of three
    letters or more) picks that contact instead; without any contact its own name stands in. Flags, each once: only_non_decision_maker_contact,
    sweep_named_verify_before_send, brand:..., icp_unclear, email_sibling_domain, email_matches_named_contact, name_from_email_only.
    Other contacts are the second to the fifth, without the primary. A lead may have any number of contacts: five go on.
    """
    rank = F.coalesce(*[F.when(F.col("role_bucket") == b, F.lit(i)) for i, b in enumerate(buckets)], F.lit(9))
    fields = ["name", "first_name", "last_name", "title", "role_bucket", "source", "evidence"]
    known = contacts.where(~is_blank(F.col("name"))).select(lead, F.struct(rank.alias("r"), F.col(order).alias("o")).alias("at"), F.struct(*[blank_if_null(F.col(c)).alias(c) for c in fields]).alias("c"))
    mail = leads.select(lead, F.lower(F.substring_index(blank_if_null(F.col("email")), "@", 1)).alias("local"), (F.col("email_type") == "person").alias("personal"))
    surname = F.lower(F.element_at(F.split(F.trim("c.name"), r"\s+"), -1))
    known = known.join(mail, lead).withColumn("hit", F.coalesce(F.col("personal") & (F.length(surname) > 2) & F.col("local").contains(surname), F.lit(False)))
    found = known.groupBy(lead).agg(
        F.min_by("c", F.when(F.col("c.role_bucket") != "other", F.col("at"))).alias("usual"), F.min_by("c", F.when(F.col("hit"), F.col("at"))).alias("named"),
        F.min(F.when(F.col("c.role_bucket") != "other", F.col("at"))).alias("usual_at"), F.min(F.when(F.col("hit"), F.col("at"))).alias("named_at"))
    place = F.row_number().over(Window.partitionBy(lead).orderBy("at"))
    shown = known.select(lead, "at", "c").withColumn("place", place).where("place <= 5").where("place > 1")
    shown = shown.groupBy(lead).agg(F.array_sort(F.collect_list(F.struct("at", F.concat("c.name", F.lit(" ["), "c.title", F.lit(" -> "), "c.role_bucket", F.lit("]")).alias("text")))).alias("shown"))
    rows = leads.join(found.withColumn("any", F.lit(True)), lead, "left").join(shown, lead, "left")
    pick, at = F.coalesce("named", "usual"), F.coalesce("named_at", "usual_at")
    text = lambda c: blank_if_null(F.col(c))
    hinted = pick.isNull() & (F.col("email_type") == "person") & (text("first_name_hint") != "")
    own = lambda c, hint="": F.coalesce(F.when(pick.isNotNull(), pick[c]), F.when(hinted, hint if isinstance(hint, Column) else F.lit(hint)), F.lit(""))
    flags = F.array_distinct(F.array_compact(F.array(
        F.when(F.col("any") & F.col("usual").isNull(), "only_non_decision_maker_contact"), F.when(F.col("usual")["source"].isin(*unsure_sources), "sweep_named_verify_before_send"),
        F.when(text("brand_family") != "", F.concat(F.lit("brand:"), "brand_family")), F.when(F.col("adjudication") == "unclear", "icp_unclear"),
        F.when(F.col("email_own_basis") == "sibling", "email_sibling_domain"), F.when(F.col("named").isNotNull(), "email_matches_named_contact"), F.when(hinted, "name_from_email_only"))))
    others = F.transform(F.filter(F.coalesce("shown", F.array().cast(shown.schema["shown"].dataType)), lambda x: ~x["at"].eqNullSafe(at)), lambda x: x["text"])
    return rows.select(
        lead, own("name", F.trim(F.concat(text("first_name_hint"), F.lit(" "), text("last_name_hint")))).alias("primary_name"), own("first_name", text("first_name_hint")).alias("first_name"),
        own("last_name", text("last_name_hint")).alias("last_name"), own("title").alias("primary_title"), own("role_bucket").alias("role_bucket"),
        own("source", F.concat(F.lit("email_local_part:"), text("name_confidence"))).alias("name_source"), F.substring(own("evidence", text("name_evidence")), 1, 300).alias("name_evidence"),
        F.array_join(others, " || ").alias("other_contacts"), F.array_join(flags, "; ").alias("qa_flags"))


def merge_sources(contacts: DataFrame, lead: str, name: str, title: str, source: str, rank: Column) -> DataFrame:
    """One row for each lead and name: the title of the strongest source, all sources in order, corroborated by two or more."""
    key = F.lower(F.trim(F.col(name)))
    best = F.struct(rank.alias("r"), F.col(source).alias("s"))
    rows = contacts.where(~is_blank(F.col(name))).groupBy(F.col(lead), key.alias("person")).agg(
        F.min_by(name, best).alias(name), F.min_by(title, F.when(~is_blank(F.col(title)), best)).alias(title),
        F.transform(F.array_sort(F.collect_set(best)), lambda x: x["s"]).alias("sources"))
    return rows.withColumn("corroborated", F.size("sources") > 1)


def first_surviving_source(contacts: DataFrame, lead: str, source_rank: str, reason: Column) -> DataFrame:
    """The contacts of each lead's first source that has any left after the guards, with qa_trail: the reasons of dropped ones
    up to that source, in order."""
    judged = contacts.withColumn("drop_reason", reason)
    chosen = judged.where("drop_reason is null").groupBy(lead).agg(F.min(source_rank).alias("__source"))
    tried = judged.join(chosen, lead)
    marks = F.when(F.col("drop_reason").isNotNull() & (F.col(source_rank) <= F.col("__source")), F.struct(F.col(source_rank).alias("r"), F.col("drop_reason").alias("d")))
    trail = tried.groupBy(lead).agg(F.transform(F.array_sort(F.collect_set(marks)), lambda x: F.concat_ws(":", x["r"].cast("string"), x["d"])).alias("qa_trail"))
    kept = tried.where((F.col(source_rank) == F.col("__source")) & F.col("drop_reason").isNull()).drop("__source", "drop_reason")
    return kept.join(trail, lead)


def fallback_queue(ranked: DataFrame, lead: str, rank: str, email: str, tried: DataFrame) -> DataFrame:
    """For each lead whose first address was dropped, the next ranked address that was not tried.

    ``tried`` has email and verdict; a lead with a sendable address needs nothing more.
    """
    known = tried.select(F.lower(F.trim("email")).alias("__e"), F.col("verdict").alias("__v")).groupBy("__e").agg(F.max("__v").alias("__v"))
    rows = ranked.join(known, F.lower(F.trim(F.col(email))) == F.col("__e"), "left")
    need = rows.groupBy(lead).agg(F.max(F.when(F.col(rank) == 1, F.col("__v") == "dropped")).alias("lost"), F.max(F.coalesce(F.col("__v") == "sendable", F.lit(False))).alias("won"))
    open_rows = rows.where(F.col("__v").isNull()).join(need.where("lost and not won").select(lead), lead)
    return open_rows.groupBy(lead).agg(F.min(F.struct(rank, email)).alias("m")).select(lead, "m.*")


def contact_summary(contacts: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows, named rows and their share in percent (one decimal) for each value of the columns."""
    named = F.sum((~is_blank(F.col(name))).cast("long"))
    return contacts.groupBy(*by).agg(F.count("*").alias("n"), named.alias("named"), F.round(100 * named / F.count("*"), 1).alias("named_pct"))


def parse_bank_lines(lines: DataFrame, line: str, items: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """"index|name|title|bucket|evidence" lines as contacts of the item with that ordinal, and (problem, n) of bad lines."""
    parts = F.split(F.col(line), r"\|", 5)
    part = lambda k: F.trim(F.get(parts, k))
    rows = lines.where(~is_blank(F.col(line))).select(part(0).try_cast("int").alias("__i"), *[part(k).alias(n) for k, n in enumerate(("name", "title", "bucket", "evidence"), 1)], F.size(parts).alias("__n"))
    rows = rows.join(items.withColumn("__o", F.col(ordinal).cast("int")), F.col("__i") == F.col("__o"), "left")
    problem = F.when((F.col("__n") < 5) | F.col("__i").isNull(), "malformed").when(F.col("__o").isNull(), "unknown_index").when(is_blank(F.col("name")), "no_name")
    rows = rows.withColumn("problem", problem)
    return rows.where("problem is null").drop("problem", "__i", "__n", "__o"), rows.where("problem is not null").groupBy("problem").agg(F.count("*").alias("n"))
