"""Registry candidates: one scored winner for each lead, acceptance ladders, demotion and a second pass.

Every function takes *pairs*: one row for each lead and candidate (from ``joins.candidate_pairs`` or a search's results),
with the candidate's place in ``order``. Pairs of ``name_tokens`` with the same ``least`` lose no registry match. A lead's candidates meet in one partial aggregation; nothing else is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null, company_key, core_tokens, overlap_share, phone_key, uk_postcode

# Words of a registered name that say nothing, and words that a directory leaves out of comparisons.
REGISTRY_FORMS = ["ltd", "limited", "llp", "plc", "the"]
DIRECTORY_STOP = ["llc", "inc", "co", "corp", "company", "ltd", "the", "and", "of", "a", "an", "services", "service", "group", "enterprises", "solutions"]
#: Overlap from which a candidate is looked at, and from which its name alone is enough.
LEAST_OVERLAP, HIGH_OVERLAP = 0.34, 0.9


def _words(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(key, " "), lambda w: w != ""))


def name_tokens(name: Column) -> Column:
    """The words by which ``registry_evidence`` compares names."""
    return _words(company_key(name, REGISTRY_FORMS))


def _without(words: Column, stop: list[str]) -> Column:
    return F.array_except(words, F.array(*[F.lit(w) for w in stop]).cast("array<string>"))


def _within(a: Column, b: Column) -> Column:
    """Whether all elements of ``a`` (at least one) are in ``b``."""
    return (F.size(a) > 0) & (F.size(F.array_except(a, b)) == 0)


def _lower(name: str) -> Column:
    return F.lower(F.trim(blank_if_null(F.col(name))))


def registry_evidence(pairs: DataFrame, *, stop: list[str] = ()) -> DataFrame:
    """``pairs`` with a struct ``evidence``: overlap, title, postcode, outward, city, town, contains, active and score.

    Reads name, full_address and city of the lead, and title, address_snippet, office_town and company_status of the
    candidate. The town counts only where the lead has no postcode.
    """
    a, b = company_key(F.col("name"), REGISTRY_FORMS), company_key(F.col("title"), REGISTRY_FORMS)
    code, town = uk_postcode(F.col("full_address")), _lower("city")
    snippet = F.regexp_replace(F.upper(blank_if_null(F.col("address_snippet"))), r"\s+", "")
    named = lambda part: (part != "") & snippet.contains(part)
    held = pairs.withColumn("evidence", F.struct(
        F.round(overlap_share(_words(a), _words(b)), 6).alias("overlap"), ((a != "") & (a == b)).alias("title"),
        named(code["full"]).alias("postcode"), named(code["outward"]).alias("outward"),
        ((F.length(town) > 2) & F.lower(blank_if_null(F.col("address_snippet"))).contains(town)).alias("city"),
        ((code["full"] == "") & (F.length(town) > 2) & (_lower("office_town") == town)).alias("town"),
        _within(_without(_words(a), list(stop)), _without(_words(b), list(stop))).alias("contains"),
        (blank_if_null(F.col("company_status")) == "active").alias("active")))
    e = F.col("evidence")
    one = lambda c: c.cast("int")
    score = e["overlap"] * 2 + one(e["active"]) * 2 + one(e["title"]) * 5 + one(e["postcode"]) * 4 + one(e["city"]) * 2 + one(e["outward"]) + one(e["town"] & e["contains"]) * 2
    return held.withColumn("evidence", e.withField("score", F.round(score, 6)))


def best_registry_match(pairs: DataFrame, lead_id: str, candidate_id: str, order: str, *, stop: list[str] = (), least: float = LEAST_OVERLAP) -> DataFrame:
    """(lead, candidate, evidence) of the highest score; the first by ``order`` on ties; no row without a real name match."""
    real = registry_evidence(pairs, stop=stop).where((F.col("evidence.overlap") >= least) | F.col("evidence.title"))
    won = real.groupBy(lead_id).agg(F.max_by(F.struct(candidate_id, "evidence"), F.struct("evidence.score", -F.col(order))).alias("m"))
    return won.select(lead_id, "m.*")


def registry_basis(evidence: Column, high: float = HIGH_OVERLAP) -> Column:
    """struct(basis, confidence) of a winner: exact_title, postcode, name_overlap, title_contains+town, city_only or null."""
    basis = (F.when(~evidence["active"], F.lit(None)).when(evidence["title"], "exact_title").when(evidence["postcode"], "postcode")
             .when(evidence["overlap"] >= high, "name_overlap").when(evidence["town"] & evidence["contains"], "title_contains+town").when(evidence["city"], "city_only"))
    return F.struct(basis.alias("basis"), F.when(basis.isNull() | (basis == "city_only"), "low_confidence").otherwise("matched").alias("confidence"))


def demote_city_only(df: DataFrame, *, postcode: str = "match_postcode", overlap: str = "name_overlap", floor: float = HIGH_OVERLAP) -> DataFrame:
    """Matched rows that neither a postcode nor the name supports become low_confidence with a reason; all else stays.

    Rows already demoted stay as they are, so a second run changes nothing.
    """
    weak = F.coalesce(F.col("matched"), F.lit(False)) & ~F.coalesce(F.col(postcode), F.lit(False)) & (F.coalesce(F.col(overlap), F.lit(0.0)) < floor)
    old = F.col("demoted_reason") if "demoted_reason" in df.columns else F.lit(None).cast("string")
    fresh = weak & old.isNull()
    return df.withColumns({"confidence": F.when(fresh, "low_confidence").otherwise(F.col("confidence")), "demoted_reason": F.when(fresh, "city_only").otherwise(old)})


def short_name(name: Column) -> Column:
    """A listing's name without what follows a bar or bracket, or a dash and a place."""
    bare = F.trim(F.regexp_replace(blank_if_null(name), r"\s*[|(].*$", ""))
    return F.trim(F.regexp_replace(bare, r"\s*-\s*[A-Z][a-z]+(?:\s[A-Z][a-z]+)?$", ""))


def second_pass(pairs: DataFrame, lead_id: str, candidate_id: str, order: str, *, stop: list[str] = ()) -> DataFrame:
    """(lead, candidate, basis, confidence): the first active candidate whose core words equal the lead's, else the first
    that contains them all and shares the outward postcode or the town (the town alone is low_confidence).

    Reads name, full_address and city of the lead, and title, office_postcode, office_town and company_status.
    """
    name = short_name(F.col("name"))
    a, b = core_tokens(name, list(stop)), core_tokens(F.col("title"), list(stop))
    same = ((F.size(a) > 0) & (a == b)) | (company_key(name) == company_key(F.col("title")))
    outward = uk_postcode(F.col("full_address"))["outward"]
    by_code = (outward != "") & (uk_postcode(F.col("office_postcode"))["outward"] == outward)
    by_town = (_lower("city") != "") & (_lower("office_town") == _lower("city"))
    basis = F.when(same, "exact_title").when(_within(a, b) & by_code, "title_contains+postcode").when(_within(a, b) & by_town, "title_contains+city")
    found = pairs.where(F.col("company_status") == "active").withColumn("basis", basis).where("basis is not null")
    first = found.groupBy(lead_id).agg(F.min_by(F.struct(candidate_id, "basis"), F.struct((F.col("basis") != "exact_title"), F.col(order))).alias("m"))
    return first.select(lead_id, "m.*").withColumn("confidence", F.when(F.col("basis") == "title_contains+city", "low_confidence").otherwise("matched"))


def licence_match(pairs: DataFrame, lead_id: str, candidate_id: str, order: str, *, stop: list[str] = ()) -> DataFrame:
    """(lead, candidate, basis, confidence): equal names, then word subsets in the same place, then word subsets alone.

    A subset without the place needs two shared words, or one of five letters or more that is all the lead has. Reads
    name, city and postcode of the lead, and licensee, suburb, licence_postcode and status of the candidate.
    """
    a, b = _plain(F.col("name")), _plain(F.col("licensee"))
    at, bt = (F.filter(_without(_words(x), list(stop)), lambda w: F.length(w) > 1) for x in (a, b))
    shared = F.array_intersect(at, bt)
    here, there = _plain(F.col("city")), _plain(F.col("suburb"))
    near = ((here != "") & (there != "") & (here.contains(there) | there.contains(here)))
    near = near | ((blank_if_null(F.col("postcode")) != "") & (F.col("postcode") == F.col("licence_postcode")))
    subset = _within(at, bt) | _within(bt, at)
    alone = (F.size(shared) >= 2) | (F.exists(shared, lambda w: F.length(w) >= 5) & (F.size(at) == F.size(shared)))
    rank = F.when(a == b, 3).when(subset & F.coalesce(near, F.lit(False)), 2).when(subset & alone, 1)
    found = pairs.where(F.col("status") == "Current").withColumn("__rank", rank).where("__rank is not null")
    best = found.groupBy(lead_id).agg(F.max_by(F.struct(candidate_id, F.col("__rank").alias("rank")), F.struct("__rank", -F.col(order))).alias("m")).select(lead_id, "m.*")
    return best.select(lead_id, candidate_id, F.element_at(F.array(F.lit("name_only"), F.lit("name_overlap"), F.lit("exact_title")), F.col("rank")).alias("basis"),
                       F.when(F.col("rank") == 1, "low_confidence").otherwise("matched").alias("confidence"))


def _plain(c: Column) -> Column:
    """Lower-case words with single spaces; & counts as and."""
    text = F.regexp_replace(F.replace(F.lower(blank_if_null(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    return F.trim(text)


def directory_match(pairs: DataFrame, lead_id: str, candidate_id: str, order: str, *, stop: list[str] = DIRECTORY_STOP) -> DataFrame:
    """(lead, candidate, basis, status, score): by phone, then name and city, name alone, or city and a part of the name.

    Reads name, city and phone_number of the lead, and business_name, listed_city and phones (an array) of the candidate.
    """
    words = lambda c: _without(_words(F.trim(F.regexp_replace(F.regexp_replace(F.lower(blank_if_null(F.col(c))), "<[^>]+>", ""), "[^a-z0-9]+", " "))), list(stop))
    overlap = F.round(overlap_share(words("name"), words("business_name"), of_larger=False), 6)
    city = F.lower(F.trim(F.substring_index(blank_if_null(F.col("city")), ",", 1)))
    here = (city != "") & (_lower("listed_city") == city)
    phone = phone_key(F.col("phone_number"))
    called = (phone != "") & F.coalesce(F.exists("phones", lambda p: phone_key(p) == phone), F.lit(False))
    basis = F.when(called, "phone").when((overlap >= 0.6) & here, "name+city").when(overlap >= 0.6, "name_only").when((overlap >= 0.4) & here, "city+partial_name")
    found = pairs.withColumns({"basis": basis, "score": F.when(called, 10).otherwise(0) + overlap + F.when(here, 0.5).otherwise(0.0)}).where("basis is not null")
    best = found.groupBy(lead_id).agg(F.max_by(F.struct(candidate_id, "basis", "score"), F.struct("score", -F.col(order))).alias("m")).select(lead_id, "m.*")
    return best.withColumn("status", F.when(F.col("basis").isin("phone", "name+city"), "matched").otherwise("low_confidence"))
