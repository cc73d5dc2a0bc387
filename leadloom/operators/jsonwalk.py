"""Values under certain keys at any depth of JSON texts, by a descent over VARIANT values in rounds.

A text is parsed once; each round explodes the objects and arrays that are left by one level and keeps what lies under a key that
matches, so rounds follow the depth of the deepest text, not the rows. What is left after a round is written to the shared folder
(a lost executor repeats one level) and goes with the next. A text that is no JSON falls back to a regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null
from leadloom.operators.durable import discard, durable

# Keys of addresses, addresses in texts that do not parse, the block that holds structured data.
EMAIL_KEY = r"^(?i)e-?mail(address)?$"
EMAIL_IN_BROKEN = r'(?i)"e-?mail(?:address)?"\s*:\s*"([^"]{5,120})"'
LD_JSON = r"(?is)<script[^>]+type\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script>"


def _is(kind: str) -> Column:
    return F.schema_of_variant("v").startswith(kind)


def values_under(df: DataFrame, row_id: str, text: str, key: str, broken: str, *, max_depth: int = 200) -> DataFrame:
    """(row_id, value): the strings under keys that match ``key``, anywhere in a row's JSON ``text``, each occurrence a row.

    A string counts, and so does each string of an array; an object under such a key is descended into like any other, nested
    arrays in such an array are not. Texts that do not parse give the first group of every match of ``broken``. Null and blank
    texts give nothing, repeated rows repeat; of a key that an object repeats the last one counts; an error beyond ``max_depth``.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    parsed = durable(df.select(F.col(row_id).alias("id"), F.trim(blank_if_null(F.col(text))).alias("t")).where("t <> ''").withColumn("v", F.try_parse_json("t")), "parsed")
    out = parsed.where("v is null").select("id", F.explode(F.regexp_extract_all("t", F.lit(broken), F.lit(1))).alias("value"))
    level, depth = parsed.where(F.col("v").isNotNull() & (_is("OBJECT") | _is("ARRAY"))).select("id", "v"), 0
    written = []
    while True:
        if depth == max_depth:
            raise ValueError(f"JSON deeper than {max_depth} levels")
        depth += 1
        inner = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("id", "key", F.col("value").alias("v")).where("v is not null")
        inner = inner.withColumn("hit", F.coalesce(F.col("key").rlike(key), F.lit(False)))
        inner = durable(inner.where(F.col("hit") | _is("OBJECT") | _is("ARRAY")), "level")
        written.append(inner)
        own = inner.where(F.col("hit") & _is("STRING")).select("id", F.variant_get("v", "$", "string").alias("value"))
        listed = inner.where(F.col("hit") & _is("ARRAY")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("id", F.col("value").alias("v"))
        listed = listed.where(F.col("v").isNotNull() & _is("STRING")).select("id", F.variant_get("v", "$", "string").alias("value"))
        out = out.unionByName(own).unionByName(listed)
        level = inner.where(_is("OBJECT") | (_is("ARRAY") & ~F.col("hit"))).select("id", "v")
        if level.isEmpty():
            break
    found = durable(out.select(F.col("id").alias(row_id), "value"), "values")
    discard(parsed, *written)
    return found


def declared_emails(pages: DataFrame, row_id: str, markup: str) -> DataFrame:
    """(row_id, value): the strings that the structured data of a page's markup declares as e-mail addresses, as written."""
    blobs = pages.select(row_id, F.explode(F.regexp_extract_all(blank_if_null(F.col(markup)), F.lit(LD_JSON), F.lit(1))).alias("blob"))
    bare = F.regexp_replace(F.regexp_replace("blob", r"^\s*<!\[CDATA\[", ""), r"\]\]>\s*$", "")
    return values_under(blobs.select(row_id, bare.alias("blob")), row_id, "blob", EMAIL_KEY, EMAIL_IN_BROKEN)
