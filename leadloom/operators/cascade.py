"""Verification states, first-success waterfalls and picks among sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.functions import people
from leadloom.functions.text import is_blank
from leadloom.operators import ranking
from leadloom.operators.durable import discard, durable, scratch, small_side


def verification_state(first: Column, second: Column, second_on: tuple[str, ...] = ()) -> Column:
    """sendable, risky, dropped or unverified from two verifiers' results (null: not asked).

    ``second_on`` names first results that the second verifier may overturn.
    """
    overturned = F.when(second == "deliverable", "sendable").otherwise("dropped")
    return (
        F.when(first.isNull() & second.isNull(), "unverified").when(first == "ok", "sendable").when(first == "disposable", "dropped")
        .when(first == "invalid", overturned if "invalid" in second_on else F.lit("dropped"))
        .when(second.isNull(), "unverified").when(second == "deliverable", "sendable").otherwise("risky")
    )


def waterfall(candidates: DataFrame, key: str, *, rung: str = "rung", order: str = "cand", verdict: str = "verdict", guessed: str = "guessed") -> DataFrame:
    """(key, outcome, rung, order) of each key's candidates, tried in the order of rungs.

    A sendable candidate ends the search. A risky one on a guessed rung ends it with nothing; on another rung it is
    remembered, later candidates of the same rung are still tried, later rungs are not. Other verdicts go on.
    """
    is_risky = F.col(verdict) == "risky"
    place = F.struct(F.col(rung), F.col(order))
    stops = candidates.groupBy(key).agg(
        F.min(F.when(F.col(verdict) == "sendable", place)).alias("good"),
        F.min(F.when(is_risky & ~F.col(guessed), place)).alias("risky"),
        F.min(F.when(is_risky & F.col(guessed), place)).alias("halt"),
    )
    good, risky, halt = F.col("good"), F.col("risky"), F.col("halt")
    reached = good.isNotNull() & (halt.isNull() | (good < halt)) & (risky.isNull() | (good[rung] <= risky[rung]))
    remembered = risky.isNotNull() & (halt.isNull() | (risky < halt))
    pick = F.when(reached, good).when(remembered, risky)
    outcome = F.when(reached, "sendable").when(remembered, "risky").otherwise("none")
    return stops.select(key, outcome.alias("outcome"), pick[rung].alias(rung), pick[order].alias(order))


def first_source(df: DataFrame, key: str, source_rank: str, present: Column, *order: str) -> DataFrame:
    """For each key the row of the first source that names something."""
    w = Window.partitionBy(key).orderBy(source_rank, *order)
    return df.where(present).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def greedy_distinct(df: DataFrame, order: list[Column], keys: list[str], group: str | None = None) -> DataFrame:
    """Survivors of a greedy pass: a row is dropped if an earlier *survivor* shares one of its non-blank keys.

    The result is that of the sequential pass, made in rounds over the whole table: open rows that come first under all
    of their keys survive, open rows that share a key with a survivor go, each round written. A round settles the first
    open row at least, so the pass ends; rounds follow the longest chain of rows that wait for each other. A round's
    survivors are written once and its other tables replace those of the round before, so disk follows the rows, not the rounds.
    ``group`` (a component of shared keys, once the unit of work) has no effect. Rows with equal order are put in one order, any.
    """
    placed = durable(ranking.numbered(df, order, "__place"), "placed")
    pairs = [F.struct(F.lit(i).alias("k"), F.when(~is_blank(F.col(c)), F.col(c).cast("string")).alias("v")) for i, c in enumerate(keys)]
    each = placed.select("__place", F.explode(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull())).alias("p")).select("__place", "p.*")
    left = durable(each, "open")
    alone = placed.select("__place").join(left.select("__place").distinct(), "__place", "left_anti").select("__place")
    folder, rounds = scratch(df.sparkSession, "survivors"), 1
    alone.write.parquet(f"{folder}/round=0")
    kept = df.sparkSession.read.schema(alone.schema)
    while not left.isEmpty():
        firsts = left.groupBy("k", "v").agg(F.min("__place").alias("first"))
        rows = left.join(firsts, ["k", "v"]).groupBy("__place").agg(F.max("first").alias("last"), F.min("first").alias("first"))
        rows.where("first = __place and last = __place").select("__place").write.parquet(f"{folder}/round={rounds}")
        chosen = kept.parquet(f"{folder}/round={rounds}")
        taken = left.join(chosen, "__place", "left_semi").select("k", "v")
        gone = left.join(taken, ["k", "v"], "left_semi").select("__place").distinct()
        after = durable(left.join(gone, "__place", "left_anti"), "open")
        discard(left)
        left, rounds = after, rounds + 1
    return placed.join(kept.parquet(*[f"{folder}/round={k}" for k in range(rounds)]), "__place", "left_semi").select(*df.columns)


def seeded_candidates(persons: DataFrame, seeds: DataFrame, person_id: str) -> DataFrame:
    """(person, form, email): addresses of the forms that verified addresses of the same domain follow, never a guess.

    ``persons`` has domain, first_name and last_name, ``seeds`` the same and email. A domain without a seed, or whose
    seeds follow no form, gives nothing; addresses that are seeds themselves are left out. Forms of a domain are at most
    eleven, so the join cannot multiply rows by a domain's size.
    """
    local = F.substring_index(F.lower("email"), "@", 1)
    known = seeds.withColumn("domain", F.lower("domain")).where(~is_blank(F.col("domain")))
    forms = known.select("domain", people.detect_form(local, F.col("first_name"), F.col("last_name")).alias("form")).where("form is not null").distinct()
    forms = small_side(durable(forms.groupBy("domain").agg(F.collect_list("form").alias("forms")), "forms"))
    taken = small_side(durable(known.select(F.lower("email").alias("email")).distinct(), "taken"))
    # dealt by the person: by domain, a few large domains would be a few tasks
    each = persons.select(person_id, F.lower("domain").alias("domain"), "first_name", "last_name").repartition(person_id)
    each = each.select(person_id, "domain", people.local_forms(F.col("first_name"), F.col("last_name")).alias("__locals"))
    made = each.join(forms, "domain").select(person_id, "domain", "__locals", F.explode("forms").alias("form"))
    made = made.select(person_id, "form", F.concat_ws("@", F.col("__locals")[F.col("form")], "domain").alias("email"))
    return made.where("email like '_%@_%'").join(taken, "email", "left_anti").select(person_id, "form", "email")


def adjudicate(df: DataFrame, *, tier: str = "tier", verdict: str = "verdict", bucket: str = "bucket", brand: str = "brand_family",
               own_verdict: str | None = None, side_bucket: str | None = None, worth: float = 0.05) -> DataFrame:
    """``df`` with drop_reason (null: kept), qa_flags (array) and aside (kept, but for a list of its own).

    Tiers A to C: no drops but for a no (a missing verdict is flagged, an unclear one too). Tier D: unsampled rows are
    dropped with the rate of yes among sampled rows (one aggregate, of ``own_verdict``: verdicts not taken over from
    others), and the reason says whether the tier is worth a full reading (``worth``). A no for ``side_bucket`` goes
    aside. An unclear row with a brand is never dropped.
    """
    own = F.nullif(F.trim(F.coalesce(F.col(own_verdict or verdict), F.lit(""))), F.lit(""))
    rate = df.where((F.col(tier) == "D") & own.isNotNull()).agg(F.avg((own == "yes").cast("double")).alias("rate"), F.count("*").alias("n")).first()
    share, sampled = rate["rate"] or 0.0, rate["n"]
    v, t = F.coalesce(F.trim(F.col(verdict)), F.lit("")), F.coalesce(F.col(tier), F.lit(""))
    early = t.isin("A", "B", "C")
    aside = (v == "no") & (F.col(bucket) == side_bucket) if side_bucket else F.lit(False)
    aside = F.coalesce(aside, F.lit(False))
    said_no = F.concat(F.lit("adjudicated_no:"), F.when(is_blank(F.col(bucket)), "unknown").otherwise(F.col(bucket)))
    unread = ("tier_d_unadjudicated" if sampled and share >= worth else "tier_d_unsampled") + f":sample_yes_rate={100 * share:.1f}%"
    reason = (F.when(~early & (t != "D"), F.concat(F.lit("unknown_tier:"), t)).when(aside, F.lit(None)).when(v == "no", said_no)
              .when((t == "D") & ~v.isin("yes", "unclear"), F.lit(unread)).when(early & ~v.isin("", "yes", "unclear"), said_no))
    branded = (v == "unclear") & ~is_blank(F.col(brand))
    flags = F.array_compact(F.array(
        F.when(early & (v == ""), "missing_verdict"), F.when((early | (t == "D")) & (v == "unclear"), "icp_unclear"), F.when((t == "D") & (v == "yes"), "tier_d_sampled_yes"),
        F.when((t == "D") & (v == "unclear"), "tier_d_sampled_unclear"), F.when((t == "D") & aside, "tier_d_sampled_aside"),
        F.when(branded & reason.isNotNull(), F.concat(F.lit("brand_unclear_kept:"), F.substring_index(reason, ":", 1)))))
    return df.withColumns({"drop_reason": F.when(~branded, reason), "qa_flags": flags, "aside": aside & (early | (t == "D"))})
