"""Gates and routes: one reason for each row that is dropped, the first that applies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null, is_blank

# Words of failures that pass, codes that are dead by definition, codes of pages that bar robots, words of their pages.
TRANSIENT = r"(?i)AbortError|timeout|ECONNRESET|ETIMEDOUT|EAI_AGAIN|TypeError|reset"
DEAD = [404, 400, 402, 307]
BARRED = [401, 403, 429, 500, 502, 503, 202, 999]
CHALLENGE = r"(?i)just a moment|enable javascript and cookies|attention required|checking your browser|verifying you are human"


# Words of advertisers that generic terms find in any trade: apps and dramas, games, shops, streaming, supplements.
COLLISIONS = (
    r"(?i)\b(shein|temu|drama|dramabox|webfic|pocket ?fm|novel|romance|chapters|story|stories|"
    r"manga|webtoon|archero|game|gaming|royale|puzzle|casino|slots?|boutique|beauty|cosmetic|"
    r"perfume|fashion|jewel|clothing|streaming|movies?|tv\b|music|detroit|mated|shimmer|"
    r"blood pressure|cholesterol|arthritis|nerve support|heart health|wellness (hub|community|journal)|"
    r"supplement|vitamin|probiotic|collagen|keto|detox|menopause|prostate|testosterone|weight ?loss|"
    r"support community|health (haven|hub|finds|project|support)|essential health|lifestyle trends|"
    r"success blueprint|business explained|scientology|prometics|odor eliminat)\b")


def likely_junk(*texts: Column, words: str = COLLISIONS) -> Column:
    """yes or blank: whether an advertiser's texts hold a word of another trade. A flag for a reader, never a reason to drop."""
    return F.when(F.concat_ws(" ", *[blank_if_null(t) for t in texts]).rlike(words), "yes").otherwise("")


def first_reason(*cases: tuple[Column, str]) -> Column:
    """The name of the first condition that holds, or null; unknown conditions do not hold."""
    return reduce(lambda out, case: out.when(case[0], case[1]), cases[1:], F.when(*cases[0]))


def active_footprint(*, closed: Column, postal: Column, exact: list[str] = (), prefixes: list[str] = (), areas: Column | None = None) -> Column:
    """closed or outside for a row that is no longer active or whose postal code is in no list; without lists all are inside."""
    inside = postal.isin(*exact) if exact else F.lit(False)
    for p in prefixes:
        inside = inside | postal.startswith(p)
    if areas is not None:
        inside = inside | areas
    limits = bool(exact or prefixes) or areas is not None
    return first_reason((closed, "closed"), (F.lit(limits) & ~F.coalesce(inside, F.lit(False)), "outside"))


def footprint_reason(hub_km: Column, radius_km: float, country: Column, countries: list[str], region: Column, regions: list[str]) -> Column:
    """far_from_hubs, wrong_country, wrong_region in this order; rows without distance or with a blank value stay."""
    return first_reason((hub_km > radius_km, "far_from_hubs"), (~is_blank(country) & ~country.isin(*countries), "wrong_country"), (~is_blank(region) & ~region.isin(*regions), "wrong_region"))


def signal_gate(*, known: Column, reachable: Column, pixel: Column, sales_route: Column) -> Column:
    """deid, unreachable, no_pixel, no_sales_route or pass."""
    return F.coalesce(first_reason((known, "deid"), (~reachable, "unreachable"), (~pixel, "no_pixel"), (~sales_route, "no_sales_route")), F.lit("pass"))


def ad_channel(*, linkedin: Column, google_trusted: Column, meta: Column) -> Column:
    """linkedin before google, meta pending a check, else none."""
    return F.coalesce(first_reason((linkedin, "linkedin"), (google_trusted, "google"), (meta, "meta_pending")), F.lit("none"))


def _code(status: Column) -> Column:
    """The number that all digits of a status make, as one reads 503 off ``home_failed:503``; null without digits."""
    return F.nullif(F.regexp_replace(blank_if_null(status), "[^0-9]", ""), F.lit("")).try_cast("long")


def status_class(status: Column) -> Column:
    """ok, transient, dead, challenge or other of a fetch's status (a code, or a message that may hold one).

    Transient: a word of a connection that failed, 429 and any 5xx. Dead: 404, 400, 402, 307. Challenge: 401, 403, 999, or the
    words of a page that asks whether one is a robot.
    """
    s, code = F.trim(blank_if_null(status)), _code(status)
    return F.coalesce(first_reason(
        (s.rlike(r"(?i)^(?:ok|2[0-9][0-9])$"), "ok"), (s.rlike(TRANSIENT) | (code == 429) | code.between(500, 599), "transient"), (code.isin(DEAD), "dead"),
        (s.rlike(CHALLENGE) | code.isin(BARRED), "challenge")), F.lit("other"))


def worth_rendering(status: Column) -> Column:
    """Whether a failed fetch is worth a rendered one: only codes of pages that bar robots are (of the transient ones 429, 500, 502, 503)."""
    s = F.trim(blank_if_null(status))
    return F.coalesce((F.lower(s) != "ok") & _code(status).isin(BARRED), F.lit(False)) | s.rlike(CHALLENGE)


def trade_prefilter(tags: Column, name: Column, *, trade: str, supplier: str, non_trade: str, override: str) -> Column:
    """trade, supplier, non_trade or unknown by an array of tags; a name that matches ``override`` is a trade whatever its tags."""
    has = lambda pattern: F.exists(tags, lambda t: F.lower(t).rlike(pattern))
    return F.coalesce(first_reason((F.lower(blank_if_null(name)).rlike(override), "trade"), (has(trade), "trade"), (has(supplier), "supplier"), (has(non_trade), "non_trade")), F.lit("unknown"))


def denied(name: Column, domain: Column, *, names: str, domains: list[str]) -> Column:
    """Whether a row is a listed aggregator: by a pattern of names, or by a domain or one below it."""
    d = F.lower(blank_if_null(domain))
    below = reduce(lambda a, b: a | b, [(d == x) | d.endswith(f".{x}") for x in domains], F.lit(False))
    return F.lower(blank_if_null(name)).rlike(names) | below


def demand_side(text: Column, size: Column, *, buyers: str, sellers: str, least: int, most: int) -> Column:
    """seller, not_a_buyer, size_band or null for a row on the demand side within a band of sizes (an unknown size stays)."""
    t = F.lower(blank_if_null(text))
    return first_reason((t.rlike(sellers), "seller"), (~t.rlike(buyers), "not_a_buyer"), ((size < least) | (size > most), "size_band"))


def blank_centroids(df: DataFrame, centroids: list[tuple[float, float]], *, lat: str, lng: str, address: str, tolerance: float = 0.01) -> DataFrame:
    """``df`` without coordinates that are a country's centre and come without an address: they are placeholders."""
    near = reduce(lambda a, b: a | b, [(F.abs(F.col(lat) - a) <= tolerance) & (F.abs(F.col(lng) - b) <= tolerance) for a, b in centroids], F.lit(False))
    fake = F.coalesce(near & is_blank(F.col(address)), F.lit(False))
    return df.withColumns({c: F.when(~fake, F.col(c)) for c in (lat, lng)})


def evidence_gate(text: Column, evidence: Column) -> Column:
    """no_text, nothing or null for a row with evidence."""
    return first_reason((is_blank(text), "no_text"), (is_blank(evidence), "nothing"))


def require_complete(status: DataFrame, column: str = "status") -> None:
    """An error if any pass of a (small) status table is not COMPLETE."""
    bad = status.where(F.upper(F.coalesce(F.col(column).cast("string"), F.lit(""))) != "COMPLETE").limit(10).collect()
    if bad:
        raise ValueError(f"passes that are not complete: {bad}")


def verdict_label(qualified: Column, review: Column, *, large: Column, reachable: Column) -> Column:
    """struct(label, priority): Qualified, Review or Exclude; A for large and reachable rows, B for one of both, else C."""
    label = F.when(qualified, "Qualified").when(review, "Review").otherwise("Exclude")
    return F.struct(label.alias("label"), F.when(large & reachable, "A").when(large | reachable, "B").otherwise("C").alias("priority"))


def noise_split(df: DataFrame, domain: str, order: list[str], *, aggregator: Column, out_of_profile: Column, verify: Column) -> DataFrame:
    """``df`` with split: aggregator, nonicp, verify, ok, or dup for a second ok row of a domain."""
    split = F.coalesce(first_reason((aggregator, "aggregator"), (out_of_profile, "nonicp"), (verify, "verify")), F.lit("ok"))
    df = df.withColumn("split", split)
    first = df.where((F.col("split") == "ok") & ~is_blank(F.col(domain))).groupBy(F.col(domain).alias("__d")).agg(F.min(F.struct(*order)).alias("__first"))
    again = (F.col("split") == "ok") & (F.struct(*order) != F.col("__first"))
    return df.join(first, F.col(domain) == F.col("__d"), "left").withColumn("split", F.when(F.coalesce(again, F.lit(False)), "dup").otherwise(F.col("split"))).drop("__d", "__first")
