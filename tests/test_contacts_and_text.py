"""E-mail, address, text and contact functions on single cases, and their empty and null inputs."""

from pyspark.sql import functions as F

from leadloom.functions import address, emails, geo, slices, text
from leadloom.operators import contacts, gates, matching, store, windows


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_clean_email(spark):
    cases = {"mailto:Jane%2Bx@Acme.com?subject=a": "jane+x@acme.com", "  <info@acme.co.uk>, b@c.de": "info@acme.co.uk", "info&#64;acme.com.": "info@acme.com",
             "u003eenquiries@host.com": "enquiries@host.com", "a​b@acme.com": "ab@acme.com", "100%@x": None, "": None, None: None, "%20info@host.org": "info@host.org"}
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    assert [r[0] for r in df.select(emails.clean_email(F.col("r"))).collect()] == list(cases.values())


def test_extract_emails(spark):
    html = ('<a href="mailto:sales@acme.com">mail</a> <a href="/cdn-cgi/l/email-protection#422b2c242d02232128276c212d2f">x</a> <div data-email="d@acme.com"></div>'
            '<script type="application/ld+json">{"a":[{"email":"ld@acme.com","x":{"eMail":["two@acme.com"]}}]}</script> s<i>@</i>acme.com frame-1@mhtml.blink you@email.com joe@email.com ok@email.com')
    got = one(spark, emails.extract_emails(F.lit(html), F.lit("sales@acme.com x [at] acme [dot] com p@q.com https://h.com/a@b.com/ and a@b.com")))[0]
    found = {r["email"]: r["source"] for r in got}
    assert found["sales@acme.com"] == "mailto" and found["ld@acme.com"] == found["two@acme.com"] == "jsonld" and found["d@acme.com"] == "attribute"
    assert found["s@acme.com"] == "tag_split" and found["x@acme.com"] == "bracket" and found["p@q.com"] == "text" and found["a@b.com"] == "text"
    assert not {"you@email.com", "joe@email.com", "frame-1@mhtml.blink"} & set(found) and sum(s == "cfemail" for s in found.values()) == 1
    only = one(spark, emails.extract_emails(F.lit(""), F.lit("https://h.com/a@b.com/x")), emails.extract_emails(F.lit(None), F.lit(None)))
    assert only == ([], [])
    pages = F.array(F.array(*[F.struct(F.lit(f"a{i}@x.com").alias("email"), F.lit("text").alias("source")) for i in range(9)]), F.array(F.struct(F.lit("a0@x.com").alias("email"), F.lit("mailto").alias("source"))))
    merged = one(spark, emails.merge_email_sources(pages))[0]
    assert len(merged) == 8 and tuple(merged[0]) == ("a0@x.com", "mailto")


def test_relations(spark):
    cases = [("a@acme.com", "acme.com", "exact"), ("a@m.acme.com", "acme.com", "subdomain"), ("a@acme.com", "shop.acme.com", "subdomain"), ("a@acme.co.uk", "acme.com", "sibling"),
             ("a@ac-me.com.au", "acme.com", "sibling"), ("a@acme.de", "acme.com", ""), ("a@abc.co.uk", "abc.com", ""), ("a@acmes.com", "acme.com", ""), (None, "acme.com", ""), ("a@acme.com", None, "")]
    df = spark.createDataFrame(cases, "e string, r string, want string")
    assert all(r["want"] == r["got"] for r in df.withColumn("got", emails.relation(F.col("e"), F.col("r"))).collect())


def test_addresses(spark):
    r = one(spark, address.street_key(F.lit("8FVC+2X Joe's Bar, 12 Adeola Odeku Street, Suite 5b, Lagos 101241"), F.lit("Joe's Bar"), ["lagos"]), address.street_key(F.lit("Joe's Bar, Ikoyi"), F.lit("Joe's Bar")),
            address.street_key(F.lit(None), F.lit(None)), address.brand_key(F.lit("Fidelity Bank Plc - Lekki Phase 1"), ["lekki phase 1"]), address.brand_key(F.lit("The Group")),
            address.short_street(F.lit("100 North Main Street Suite 4, X")), address.floor_of(F.lit("on the 3rd Floor")), address.floor_of(F.lit("x")),
            address.city_of(F.lit("City of Perth, WA"), F.lit("")), address.city_of(F.lit(None), F.lit("1 A St, el paso, TX 79901")), address.city_of(F.lit("12 Long Road"), F.lit("")),
            address.postal_code(F.lit("90210 or 10001-1234")), address.state_from_box(F.lit(34.0), F.lit(-118.0), {"CA": (32.0, 42.0, -125.0, -114.0)}))
    assert r == ("12 adeola odeku street", "", "", "fidelity bank", "the", "100nmainst", 3, None, "Perth", "El Paso", "", "10001", "CA")


def test_hosts_and_slices(spark):
    r = one(spark, text.lenient_host(F.lit("www.Acme.com:8080/x")), text.lenient_host(F.lit("localhost")), text.lenient_host(F.lit("")), text.strict_host(F.lit("acme.com")),
            slices.within_budget(F.array(F.lit("abc"), F.lit("defg")), 6), slices.combined([F.lit(""), F.lit("é" * 3), F.lit("x")], 7), slices.fill("{{a}} {{b}}", {"a": F.lit(None)}, fallbacks={"a": "you"}),
            slices.brand_in_headline(F.lit("CEO @ Big Co | Speaker")), slices.real_copy(F.lit("#a #b one two")), slices.budget_tier(F.lit("$2.5k to $9k"), {"small": 1000, "big": 5000}))
    assert r == ("acme.com:8080", "localhost", "", "", "abc\nde", "ééé", "you {{b}}", "Big Co", False, "small")
    assert one(spark, F.array_join(slices.fill_problems(F.lit("hi {{b}}\n"), F.lit("ANN")), ","))[0] == "unfilled,line_break,name_case"


def test_cap_bytes_never_breaks_a_character(spark):
    texts = ["", "a" * 30, "é" * 30, "日" * 30, "🎉" * 30, "aé日🎉" * 9, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for most in range(5, 30):
        for r in df.select("t", store.cap_bytes(F.col("t"), most).alias("c")).collect():
            want = r["t"] and r["t"].encode()[:most].decode(errors="ignore")
            assert r["c"] == want, (most, r)


def test_contacts(spark):
    rows = [(1, 1, "Perth House", "Perth House is ours", "gm", ""), (1, 2, "Matt Hooper", "by Matt Hooper", "gm", ""), (1, 3, "matt hooper", "matt hooper", "gm", ""), (1, 4, None, None, None, None), (2, 5, "Ann", "", "gm", "")]
    df = spark.createDataFrame(rows, "lead long, i long, name string, evidence string, role_bucket string, title string").withColumn("business_name", F.when(F.col("i") == 1, "Perth House Restumping").otherwise("Matt Hooper Restumping"))
    kept, dropped = contacts.kept_contacts(df, "lead", "i", contacts.guard(first_names=["matt"]))
    assert [r["i"] for r in kept.collect()] == [2] and {r["drop_reason"]: r["n"] for r in dropped.collect()} == {"business_name": 1, "no_evidence_name": 1}
    assert contacts.primary_contact(df.limit(0), "lead", "i").count() == 0


def test_gates_and_windows_on_nulls(spark):
    none = F.lit(None).cast("string")
    assert one(spark, gates.status_class(none), gates.evidence_gate(none, none), gates.footprint_reason(F.lit(None).cast("double"), 1, none, ["x"], none, ["y"]), gates.denied(none, none, names="x", domains=["y.com"])) == ("other", "no_text", None, False)
    df = spark.range(7).withColumn("t", F.when(F.col("id") < 4, "a").when(F.col("id") < 6, "b"))
    batches = {r["id"]: r["batch"] for r in windows.homogeneous_batches(df, "t", [F.col("id")], 3).collect()}
    assert batches[6] == 0 and [batches[i] for i in range(6)] == [1, 1, 1, 2, 3, 3]  # nulls are a tier of their own, the first
    assert windows.even_sample(df, 3, ["id"]).count() == 3 and windows.even_sample(df, 20, ["id"]).count() == 7 and windows.even_sample(df.limit(0), 3, ["id"]).count() == 0
    assert windows.sticky_tranches(df, "id", ["id"], 3, df.limit(0).select("id", F.lit(1).alias("tranche"))).groupBy("tranche").count().count() == 3
    assert geo.inside_disks([("a", 0.0, 0.0, 10.0), ("b", 0.0, 0.0, 10.0), ("c", 0.0, 0.01, 1.0), ("d", 5.0, 0.0, 1.0)]) == ["b", "c"]


def test_same_company_and_hosts(spark):
    r = one(spark, matching.same_company(F.lit("Acme Roofing Ltd"), F.lit("ACME"), ["roofing"]), matching.same_company(F.lit("A Roofing"), F.lit("B Roofing"), ["roofing"]), matching.same_company(F.lit(None), F.lit("")  , []),
            matching.domain_fits(F.lit("Blue Roofing"), F.lit("blueroof.com"), []), matching.brand_in_page(F.lit("Acme"), F.lit("This domain is for sale")), matching.keep_by_evidence(F.lit("city"), F.lit("low")))
    assert r == (True, False, False, True, "parked", False)
