"""Which addresses are accepted, which fetches are tried again, and first dates that are blank."""

import pytest
from pyspark.sql import functions as F

from leadloom.functions import emails
from leadloom.operators import delta, gates


def judged(spark, rows, make):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    return [r[0] for r in df.select("i", make(F.col("a"), F.col("b")).alias("v")).orderBy("i").select("v").collect()]


def test_harvested_addresses(spark):
    kept = ["enquiries@acme.co.uk", "forwardscaffolding@email.com", "joe@realdomain.co.uk", "info@sub.acme.com"]
    dropped = ["info@sentry.io", "abc@wixpress.com", "user@example.com", "x@godaddy.com", "info@2x.png", "a.jpg@cdn.com", "frame-1@mhtml.blink", "x@box.internal", "you@email.com",
               "email@company.co.uk", "a@yourdomain.com", "a@schema.org.uk", "email@protected", "x@w3.org.uk", "a@jquery.com", "not-an-address"]
    got = judged(spark, [(e, "") for e in kept + dropped], lambda a, b: emails.keep_harvested(a))
    assert got == [True] * len(kept) + [False] * len(dropped)


@pytest.mark.parametrize("email, root, want", [
    ("marketing@acme.com", "acme.com", "unwanted"), ("noreply@acme.com", "acme.com", "unwanted"), ("hr@acme.com", "acme.com", "unwanted"),
    ("hello@domain.com", "acme.com", "placeholder"), ("hello@mysite.com", "acme.com", "placeholder"), ("hello@fonts.org", "acme.com", "placeholder"), ("a@b.tld", "acme.com", "placeholder"),
    ("john.doe@other.com", "acme.com", "placeholder"), ("jane.doe@acme.co.uk", "acme.co.uk", "own"), ("me@checkatrade.com", "acme.com", "third_party"), ("x@nhs.uk", "acme.com", "third_party"),
    ("joe@btinternet.com", "acme.com", "free"), ("joe@sky.com", "acme.com", "free"), ("joe@virginmedia.com", "acme.com", "free"), ("info@khb-piling.co.uk", "khbpiling.co.uk", "own"),
    ("survey@renlon.com", "renlon.co.uk", "own"), ("a@dampex.com", "damp.co.uk", "other_domain"), ("joe@bigpond.com", "acme.com.au", "other_domain"), (None, "acme.com", "shape")])
def test_verdicts(spark, email, root, want):
    assert judged(spark, [(email, root)], emails.verdict) == [want]


def test_providers_by_country(spark):
    rows = [("joe@bigpond.com", ""), ("joe@optusnet.com.au", ""), ("joe@bigpond.org", ""), ("joe@btconnect.com", "")]
    assert judged(spark, rows, lambda a, b: emails.is_free(a, "au")) == [True, True, False, True]
    assert judged(spark, rows, lambda a, b: emails.is_free(a)) == [False, False, False, True]


def test_ranking_of_boxes_and_providers(spark):
    listed = ["bookings@acme.com", "reception@acme.com", "quotes@acme.com", "joe@btinternet.com", "joe@else.org", "x1@acme.com", "marketing@acme.com", "your@else.org"]
    array = F.array(*[F.struct(F.lit(e).alias("email"), F.lit("site").alias("source")) for e in listed])
    got = spark.range(1).select(F.explode(emails.rank_emails(array, F.lit("acme.com"), ["joe"]))).select("col.*").collect()
    assert [(r["email"], r["score"]) for r in got] == [("joe@btinternet.com", 31), ("bookings@acme.com", 23), ("reception@acme.com", 23), ("quotes@acme.com", 23), ("x1@acme.com", 13)]


@pytest.mark.parametrize("status, want, render", [
    ("ok", "ok", False), ("200", "ok", False), ("home_failed:503", "transient", True), ("503", "transient", True), ("home_failed:599", "transient", False), ("HTTP 429", "transient", True),
    ("EAI_AGAIN", "transient", False), ("TypeError: fetch failed", "transient", False), ("AbortError", "transient", False), ("read ECONNRESET", "transient", False), ("connect timeout", "transient", False),
    ("http 403", "challenge", True), ("403", "challenge", True), ("home_failed:401", "challenge", True), ("home_failed:999", "challenge", True), ("Just a moment...", "challenge", True),
    ("home_failed:404", "dead", False), ("400", "dead", False), ("402", "dead", False), ("home_failed:307", "dead", False), ("weird", "other", False), ("", "other", False), (None, "other", False)])
def test_statuses(spark, status, want, render):
    assert judged(spark, [(status, "")], lambda a, b: F.struct(gates.status_class(a).alias("s"), gates.worth_rendering(a).alias("r"))) == [(want, render)]


def test_a_blank_first_date_is_none(spark):
    prior = spark.createDataFrame([("a", "", 1, False), ("a", "2026-01", 2, False), ("b", " ", 0, None), ("b", None, None, False)], "k string, first_seen string, hits int, delivered boolean")
    now = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, pass_hits int")
    got = {r["k"]: (r["first_seen"], r["status"]) for r in delta.union_with_memory(now, prior, "k", cycle="2026-05", min_hits=2).collect()}
    assert got == {"a": ("2026-01", "confirmed"), "b": ("2026-05", "pending"), "c": ("2026-05", "confirmed")}


def test_microdata_scripts_and_paths(spark):
    html = ("""<meta itemprop="email" content="Micro@acme.com"><script>var m = "js" + "@" + "acme.com"; x = 'left' + '&#64;' + 'acme.org';</script>"""
            '<a href="https://book.host.com/book/Team@path.com/?x=1">b</a> https://host.com/a/enc%40path.org, https://host.com/q?to=query@acme.com https://h.com/pre-x@part.com.html'
            '<a href="mailto:both@acme.com">m</a> https://host.com/both@acme.com https://host.com/open@acme.com <p>open@acme.com</p>')
    text = "open@acme.com and query@acme.com https://host.com/only@path.net/"
    df = spark.createDataFrame([(html, text), (None, None)], "h string, t string")
    rows = df.select(emails.extract_emails(F.col("h"), F.col("t")).alias("e")).collect()
    found = {x["email"]: x["source"] for x in rows[0]["e"]}
    assert {k: found.get(k) for k in ("micro@acme.com", "js@acme.com", "left@acme.org", "both@acme.com", "open@acme.com", "query@acme.com")} == {
        "micro@acme.com": "microdata", "js@acme.com": "js_concat", "left@acme.org": "js_concat", "both@acme.com": "mailto", "open@acme.com": "text", "query@acme.com": "text"}
    assert not {"team@path.com", "enc@path.org", "only@path.net"} & set(found) and rows[1]["e"] == []
