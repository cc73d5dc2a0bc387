"""Key lookups, prioritised anti-joins and entity matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import is_blank
from leadloom.operators.durable import small_side
from leadloom.operators.merge import best_per_key

def lookup(left: DataFrame, right: DataFrame, key: str, *order: Column) -> DataFrame:
    """Left join on one row of the right for each key (the first by the order), so that no row is doubled."""
    return left.join(best_per_key(right, [key], *order), key, "left")


def known_reason(df: DataFrame, known: list[tuple[str, Column, DataFrame]]) -> DataFrame:
    """``df`` with drop_reason: the first (reason, key of df, one-column table of keys) in which the row's key is known.

    Blank keys match nothing.
    """
    reasons, extra = [], []
    for i, (reason, key, keys) in enumerate(known):
        name = keys.columns[0]
        mark = keys.where(~is_blank(F.col(name))).select(F.col(name).cast("string").alias(f"__k{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
        df = df.join(small_side(mark), key.cast("string") == F.col(f"__k{i}"), "left")
        reasons.append(F.when(F.col(f"__hit{i}"), F.lit(reason)))
        extra += [f"__k{i}", f"__hit{i}"]
    return df.withColumn("drop_reason", F.coalesce(*reasons)).drop(*extra)


def claim_once(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_order: str, right_id: str, right_order: str) -> DataFrame:
    """(left_order, right_id, basis): each left row claims its first candidate; a right row goes to its first claimant.

    Candidates share the first key pair if any do, else the second, and so on. Of a key's right rows only the first can be
    a left row's first candidate, so the right side is reduced to it before the join.
    """
    found = None
    for i, (a, b) in enumerate(keys):
        pairs = left.where(~is_blank(F.col(a))).select(F.col(left_order).alias("__l"), F.col(a).cast("string").alias("__key"))
        firsts = right.where(~is_blank(F.col(b))).groupBy(F.col(b).cast("string").alias("__key")).agg(F.min(F.struct(F.col(right_order).alias("__o"), F.col(right_id).alias("__r"))).alias("m"))
        pairs = pairs.join(firsts, "__key").select("__l", F.lit(i).alias("__basis"), "m.__o", "m.__r")
        found = pairs if found is None else found.unionByName(pairs)
    first = found.groupBy("__l").agg(F.min(F.struct("__basis", "__o", "__r")).alias("m")).select("__l", "m.*")
    won = first.groupBy("__r").agg(F.min(F.struct("__l", "__basis")).alias("m"))
    return won.select(F.col("m.__l").alias(left_order), F.col("__r").alias(right_id), F.col("m.__basis").alias("basis"))


def _token_sets(df: DataFrame, tokens: str, name: str) -> DataFrame:
    """``df`` with the sorted distinct tokens of each row; nulls are no tokens, rows without tokens are left out."""
    return df.withColumn(name, F.array_sort(F.array_compact(F.array_distinct(tokens)))).where(F.size(name) > 0)


def _similar_sets(left: DataFrame, right: DataFrame, least: float, of_larger: bool) -> DataFrame:
    """(lt, rt, overlap) of the sets ``lt`` of the left and ``rt`` of the right that share a token and ``least`` of theirs.

    Exact prefix filter: with a set's tokens from rare to common, two sets that have to share k tokens share one of the
    first n - k + 1 of each. Overlaps are rounded to 6 digits, so k is taken from a little less than ``least``.
    """
    must = lambda n: F.greatest(F.lit(1), F.ceil(F.lit(least - 1e-6) * n)).cast("int")
    df = right.select(F.explode("rt").alias("t")).groupBy("t").agg(F.count("*").alias("df"))

    def rare_first(sets: DataFrame, name: str, cut: bool) -> DataFrame:
        each = sets.select(name, F.explode(name).alias("t")).join(df, "t", "left").groupBy(name)
        each = each.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "t"))), lambda x: x["t"]).alias("o"))
        first = F.slice("o", F.lit(1), F.size("o") - must(F.size("o")) + 1) if cut else F.col("o")
        return each.select(name, F.posexplode(first).alias(f"{name}_at", "t"))

    if of_larger:
        n = F.greatest(F.size("lt"), F.size("rt"))
        pairs = rare_first(left, "lt", True).join(rare_first(right, "rt", True), "t")
        pairs = pairs.where((F.col("lt_at") <= F.size("lt") - must(n)) & (F.col("rt_at") <= F.size("rt") - must(n)))
    else:  # the smaller set's share bounds its own tokens only: its rarest ones look among all of a larger set's
        n = F.least(F.size("lt"), F.size("rt"))
        pairs = rare_first(left, "lt", True).join(rare_first(right, "rt", False), "t").where(F.size("lt") <= F.size("rt")).unionByName(
            rare_first(left, "lt", False).join(rare_first(right, "rt", True), "t").where(F.size("lt") > F.size("rt")))
    pairs = pairs.select("lt", "rt", F.round(F.size(F.array_intersect("lt", "rt")) / n, 6).alias("overlap"))
    return pairs.where(F.col("overlap") >= least).distinct()


def candidate_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tokens: str, *, least: float = 0.0, of_larger: bool = True) -> DataFrame:
    """(left_id, right_id) of all rows that share a token and at least ``least`` of the tokens of the larger (or smaller)
    set: the pairs that a matcher has to look at. Sets that many rows have are compared once."""
    lt = _token_sets(left, tokens, "lt").select(F.col(left_id).alias("l"), "lt")
    rt = _token_sets(right, tokens, "rt").select(F.col(right_id).alias("r"), "rt")
    pairs = _similar_sets(lt.select("lt").distinct(), rt.select("rt").distinct(), least, of_larger)
    return pairs.join(lt, "lt").join(rt, "rt").select(F.col("l").alias(left_id), F.col("r").alias(right_id)).distinct()


def token_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tokens: str, *, least: float = 0.6,
                  of_larger: bool = True, most_common: int | None = None) -> DataFrame:
    """Best right row for each left row by shared tokens (token-blocked: only rows with a common token are compared).

    Exact however common a token is: ``most_common``, once a cap, has no effect. Ties go to the smaller right id.
    """
    lt = _token_sets(left, tokens, "lt").select(F.col(left_id).alias("l"), "lt")
    rt = _token_sets(right, tokens, "rt").groupBy("rt").agg(F.min(right_id).alias("r"))
    pairs = _similar_sets(lt.select("lt").distinct(), rt.select("rt"), least, of_larger).join(rt, "rt")
    best = pairs.groupBy("lt").agg(F.min(F.struct((-F.col("overlap")).alias("no"), "r")).alias("m"))
    return lt.join(best, "lt").select(F.col("l").alias(left_id), F.col("m.r").alias(right_id), (-F.col("m.no")).alias("overlap"))
