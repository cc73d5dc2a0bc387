"""Quality rules: base text statistics, then a hashed n-gram log-likelihood ratio with a fixed threshold.

Two multinomials over hashed word n-grams (unigrams and bigrams) are counted over *all* documents: one of the raw
corpus, one of its trusted rows, each bucket shrunk towards equal shares. A document's score is the mean over its n-grams
of log(p_trusted / p_raw); documents below ``threshold`` are rejected, each by the same fixed number whatever the corpus
is. Only DataFrame functions run.

Scale: the counts are partial sums of at most ``buckets`` rows for each task, so the shuffle does not follow the text;
the weights, one array of ``buckets`` doubles (512 KB), become a constant of the scoring plan. No text is shuffled, as
long as the trusted ids are few enough to broadcast (counted first); beyond that they join by shuffle.

Edge cases: null and empty texts have no words, fail the base rules and are not kept; a trusted set without words
makes every weight 0, so only the base rules decide; repeated ids are scored row by row; an empty table gives an empty
result; extra columns stay, and only the one struct column ``out_col`` is added (replacing a column of that name).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.llm.shared import small_keys

#: The separators of words and the symbols that are counted.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

BUCKETS = 65_536
#: N-grams that each bucket is given of both kinds: rare n-grams, as in small corpora, then say little.
SMOOTHING = 4.0
#: Mean log ratio, in nats for each n-gram, from which a document is kept.
THRESHOLD = -0.14
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of other characters than the six ASCII spaces."""
    return F.filter(F.split(text, SPACE_PATTERN), lambda w: w != "")


def held(value: Column) -> Column:
    """``value``, which no later filter or projection may pull into its own expressions.

    Arrays that lambdas read must be computed once for each row. The condition is always true but not deterministic, and
    the optimizer moves nothing through such a projection.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def _grams(words: str, n: str, buckets: int) -> Column:
    """Buckets of the unigrams and bigrams, from columns with the words and their number."""
    w = F.col(words)
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.transform(
        F.when(F.col(n) > 1, F.sequence(F.lit(0), F.col(n) - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.pmod(F.xxhash64(F.get(w, i), F.get(w, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(one, two)


def gram_weights(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with ``weights``: log(p_trusted / p_raw) of each bucket, from counts over all documents.

    ``trusted`` has the ids of trusted documents in its first column; nulls and repeats do not matter.
    """
    key = trusted.columns[0]
    ids = trusted.select(F.col(key).alias("__trusted_id")).where(F.col("__trusted_id").isNotNull()).distinct()
    texts = docs.select(F.col(id_col).alias("__id"), words_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__w"))
    flagged = texts.join(small_keys(ids), F.col("__id") == F.col("__trusted_id"), "left")
    grams = flagged.select(F.col("__trusted_id").isNotNull().cast("int").alias("__t"), "__w", F.size("__w").alias("__n"))
    counts = (
        grams.select("__t", F.explode(_grams("__w", "__n", buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("__t").alias("good"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").na.fill(0, ["raw", "good"])
    # one row of at most `buckets` pairs: its size does not depend on the documents
    rows = filled.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("c"), F.sum("raw").alias("raw_all"), F.sum("good").alias("good_all"))
    expected = lambda c: c["raw"] * F.col("good_all") / F.col("raw_all")
    ratio = lambda c: F.log((c["good"] + smoothing) / (expected(c) + smoothing))
    return rows.select(F.transform("c", lambda c: F.when(F.col("good_all") > 0, ratio(c)).otherwise(0.0)).alias("weights"))


def apply_rules(docs: DataFrame, weights: DataFrame, *, text_col: str = "text", out_col: str = "rules",
                threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with a struct column ``out_col``: base statistics, ``score``, ``base_failed`` and ``kept``."""
    names = [c for c in docs.columns if c.lower() != out_col.lower()]
    w, n, h = F.col("__w"), F.col("__n"), F.col("__h")
    text = F.coalesce(F.col("__text"), F.lit(""))
    # a constant of the plan, folded once: as a column it would be copied into every row
    table = F.from_json(F.lit(json.dumps(weights.first()["weights"])), "array<double>")
    # the row goes through as one struct, so that its names cannot clash with those below
    df = docs.select(F.struct(*names).alias("__in"), F.col(text_col).cast("string").alias("__text"))
    df = df.select("*", held(words_of(text)).alias("__w"))
    df = df.select("*", F.size("__w").alias("__n"))
    windows = F.when(n > 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    df = df.select("*", held(windows).alias("__h"), _grams("__w", "__n", buckets).alias("__g"))
    repeated = F.size(F.array_distinct(h)) < F.size(h)
    df = df.select(
        "__in", "__text", "__n",
        F.when(repeated, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("__s"),
        F.aggregate("__g", F.lit(0.0), lambda acc, g: acc + F.get(table, g)).alias("__sum"),
        held(F.size("__g")).alias("__grams"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0).alias("__lines"),
    )
    s = F.col("__s")
    starts = F.sort_array(F.transform(
        F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])), lambda x: x["i"]))
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    covered = F.aggregate(
        F.when(s.isNotNull(), starts).otherwise(F.array().cast("array<int>")), zero,
        lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(3), p - a["last"])).alias("total")),
        lambda a: a["total"],
    )
    df = df.select(
        "__in", "__n", "__sum", "__grams", held(covered.cast("long")).alias("__repeat"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("__chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("__symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__dup"),
    )
    failed = (n < MIN_WORDS) | (100 * F.col("__repeat") > MAX_REPEAT_PERCENT * n)
    score = F.when(F.col("__grams") > 0, F.round(F.col("__sum") / F.col("__grams"), 9)).otherwise(0.0)
    return df.select("__in.*", F.struct(
        n.cast("long").alias("n_words"), F.col("__chars").alias("word_chars"), F.col("__symbols").alias("n_symbols"),
        F.col("__dup").alias("n_dup_lines"), F.col("__repeat").alias("n_repeat_words"), failed.alias("base_failed"),
        score.alias("score"), (~failed & (score >= threshold)).alias("kept"),
    ).alias(out_col))
