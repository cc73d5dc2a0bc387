"""Persons, pages, registers, registry candidates, separation and adjudication on small invented fixtures."""

import math
import random

from pyspark.sql import functions as F

from leadloom.functions import pages, people
from leadloom.operators import cascade, cover, lines, registry


def test_names_behind_boxes(spark):
    names = ["jane.doe", "j.smith", "jane", "info", "oak.roofing", "jane.doe123", "xqz", "info.desk", ""]
    df = spark.createDataFrame([(n,) for n in names], "l string")
    got = [r[0] and tuple(r[0]) for r in df.select(people.name_from_local(F.col("l"), ["jane"], trade=["roofing"])).collect()]
    assert got == [("Jane", "Doe", "first.last"), ("J.", "Smith", "f.last"), ("Jane", "", "first_name"), None, None, None, None, None, None]


def test_who_owns_an_address(spark):
    yes = ["luke", "lukesanderson", "lsanderson", "lukes", "sanderson", "sandersonl", "ls", "luke.sales", "lxsanderson", "lsand", "sanderson.inc"]
    no = ["info", "owner", "mary", "x", "", "sand"]
    df = spark.createDataFrame([(f"{x}@a.com",) for x in yes + no], "e string")
    got = [r[0] for r in df.select(people.owns_local(F.col("e"), F.lit("Luke"), F.lit("Sanderson"))).collect()]
    assert got == [True] * len(yes) + [False] * len(no)
    assert spark.range(1).select(people.owns_local(F.lit("dave@x.com"), F.lit("David"), F.lit("Poe"), {"david": ["dave"]})).first()[0]


def test_forms_round_trip(spark):
    r = spark.range(1).select(people.local_forms(F.lit("Ann"), F.lit("Bell")).alias("m")).first()["m"]
    assert sorted(r) == sorted(people.FORMS) and r["flast"] == "abell" and r["lastf"] == "bella"
    df = spark.createDataFrame([(k, v) for k, v in r.items()], "form string, local string")
    assert all(x[0] == x[1] for x in df.select("form", people.detect_form(F.col("local"), F.lit("Ann"), F.lit("Bell"))).collect())
    assert spark.range(1).select(people.local_forms(F.lit(""), F.lit("Bell"))).first()[0] is None


def test_seeded_rung(spark):
    persons = spark.createDataFrame([(1, "A.com", "Ann", "Bell"), (2, "a.com", "Carl", "Dorn"), (3, "b.com", "Eve", "Fox"), (4, "c.com", "Gil", "Hart")], "id long, domain string, first_name string, last_name string")
    seeds = spark.createDataFrame([("a.com", "Carl", "Dorn", "cdorn@a.com"), ("b.com", "Eve", "Fox", "desk@b.com")], "domain string, first_name string, last_name string, email string")
    assert [tuple(r) for r in cascade.seeded_candidates(persons, seeds, "id").collect()] == [(1, "flast", "abell@a.com")]


def test_roles_in_texts(spark):
    gap = "and much more is said about all of these things in many other words " * 2
    text = f"Welcome. Jane Doe, managing director, leads us, {gap}. The former owner Max Poe left, {gap}. Founded in 1990 by Ann Bell, {gap}. Office manager: Tim Hart"
    roles = ["managing director", "owner", "office manager"]
    got = spark.range(1).select(people.role_mentions(F.lit(text), roles)).first()[0]
    assert [(x["name"], x["role"]) for x in got] == [("Jane Doe", "managing director"), ("Tim Hart", "office manager"), ("Ann Bell", "founder/owner")]
    near = lambda n: people.role_near(F.lit(text), F.lit(n), {"Owner": r"\bowner\b", "Director": r"\bdirector\b"})
    far = "x" * 200
    r = spark.range(1).select(near("Nobody"), near(""), people.role_near(F.lit(f"Ann Bell {far} owner {far} Ann Bell, director"), F.lit("Ann Bell"), {"Owner": r"\bowner\b", "Director": r"\bdirector\b"})).first()
    assert tuple(r) == (None, None, "Director")
    buckets = [r[0] for r in spark.createDataFrame([("Co-Founder",), ("Site Manager",), ("General Manager",), (None,)], "r string").select(people.role_bucket(F.col("r"))).collect()]
    assert buckets == ["owner_or_partner", "exclude", "gm", "exclude"]


def test_rosters(spark):
    runs = {"Paul Phillips Nashville": "Paul Phillips", "Owner Melanie & John Chaney": "Melanie & John Chaney", "Ann B. Cole": "Ann B. Cole", "hello Ann Cole": "Ann Cole", "and then": None, "Sales Ann Cole": "Ann Cole", "Ann": None}
    df = spark.createDataFrame([(k,) for k in runs], "t string")
    got = [r[0] for r in df.select(people.name_before(F.col("t"), cities=["Nashville"], role_words=["Owner", "Sales"])).collect()]
    assert got == list(runs.values())
    r = spark.range(1).select(people.roster(F.lit("Home Menu Meet Our Team Paul Phillips Nashville General Manager Ann Cole Owner"), {"Owner": "owner_or_partner", "General Manager": "gm"}, cities=["Nashville"])).first()[0]
    assert [tuple(x) for x in r] == [("Paul Phillips", "General Manager", "gm"), ("Ann Cole", "Owner", "owner_or_partner")]


def test_result_titles(spark):
    df = spark.createDataFrame([("1. Jane Doe - Owner at Oak Roofing",), ("Jane Doe - Estimator at Pine",), ("no title",), (None,)], "l string")
    got = [r[0] and tuple(r[0]) for r in df.select(people.result_title(F.col("l"), F.lit("Oak Roofing LLC"), ["llc"])).collect()]
    assert got == [("Jane Doe", "Owner", "Oak Roofing", "owner_or_partner", 140), ("Jane Doe", "Estimator", "Pine", "exclude", -110), None, None]
    r = spark.range(1).select(people.natural_name(F.lit("DOE, Jane Ann")), people.natural_name(F.lit("Jane Doe"))).first()
    assert tuple(r) == ("Jane Ann Doe", "Jane Doe")
    officers = spark.sql("select array(named_struct('name','DOE, Jane','role','director','resigned_on',null), named_struct('name','X','role','secretary','resigned_on',null), named_struct('name','Y','role','director','resigned_on','2020-01-01')) as o")
    assert [(o["name"], o["likely_principal"]) for o in officers.select(people.active_officers(F.col("o"), F.lit("Doe & Sons"))).first()[0]] == [("DOE, Jane", True)]


def test_cards_json_and_profiles(spark):
    html = '<main><div class="r" id="1"><a class="n">Fox <b>&</b> Co</a></div><div class="r" id="2"><a class="n">Elk</a></div><nav>n</nav></main>'
    got = spark.range(1).select(pages.cards(F.lit(html), '<div class="r" id="', {"id": 'id="([0-9]+)"', "name": "(?s)class=\"n\">(.*?)</a>", "none": "zip=(x)"}, end="<nav")).first()[0]
    assert [tuple(c) for c in got] == [("1", "Fox & Co", ""), ("2", "Elk", "")]
    text = 'x {"id":1,"s":"}{","in":{"a":[1]}} y {"id":2 broken {"id":3}'
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    assert [list(r[0]) for r in df.select(pages.json_objects(F.col("t"), '{"id"')).collect()] == [['{"id":1,"s":"}{","in":{"a":[1]}}', '{"id":3}'], [], []]
    links = ('<a href="https://www.facebook.com/fox/">f</a> https://facebook.com/sharer?u=1 https://m.facebook.com/fox https://facebook.com/elk https://facebook.com/ant '
             "https://linkedin.com/company/fox/about https://linkedin.com/feed https://youtube.com/@fox/videos https://youtube.com/watch?v=1 https://example.org/a https://www.facebook.com/profile.php?id=7")
    r = spark.range(1).select(pages.social_profiles(F.lit(links))).first()[0]
    assert r == {"facebook": ["https://facebook.com/fox", "https://facebook.com/elk"], "linkedin": ["https://linkedin.com/company/fox"], "youtube": ["https://youtube.com/@fox"]}


def test_boilerplate(spark):
    head, foot = "menu " * 15, " foot" * 15
    df = spark.createDataFrame([([head + "alpha one" + foot, head + "beta two" + foot],), (["only"],), (["short a", "short b"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(pages.strip_shared(F.col("t"))).collect()] == [["alpha one", "beta two"], ["only"], ["short a", "short b"], []]


def test_registers_and_headings(spark):
    text = "junk\nSTATUS  NO    NAME        SUPERVISOR\nCurrent 12    OAK ROOFING B1 - Doe\n              PTY         B2 - Poe\n\n              stray\nExpired 13    ELK\n"
    df = lines.text_lines(spark.createDataFrame([("f", text)], "file string, text string"), "file", "text").repartition(3)
    rows = lines.fixed_width_records(df, "file", ["STATUS", "NO", "NAME", "SUPERVISOR"], F.col("cells.STATUS").isin("Current", "Expired") & (F.col("cells.NO") != "")).orderBy("record").collect()
    assert [r["fields"] for r in rows] == [
        {"STATUS": ["Current"], "NO": ["12"], "NAME": ["OAK ROOFING", "PTY"], "SUPERVISOR": ["B1 - Doe", "B2 - Poe"]}, {"STATUS": ["Expired"], "NO": ["13"], "NAME": ["ELK"], "SUPERVISOR": []}]
    page = "Jane Doe, Owner\n## Principal Contacts\nMr. Max Poe, Owner\nMax Poe, owner\nnot a person\n# Other\nEve Fox, Clerk"
    df = lines.text_lines(spark.createDataFrame([(1, page)], "id long, text string"), "id", "text")
    got = lines.under_headings(df, "id", r"(?i)^(?:#+\s*)?(principal contacts?|business management)\s*:?\s*$", r"^(?:Mr|Ms)?\.?\s*([A-Z][a-z]+ [A-Z][a-z]+), ([A-Za-z ]+)$").collect()
    assert [(r["section"], r["parts"]) for r in got] == [("principal contacts", ["Max Poe", "Owner"])]


def test_registry_ladder(spark):
    lead = ("Oak Roofing Ltd", "1 High St, SW1A 1AA", "London")
    cands = [("c1", 1, "OAK ROOFING LIMITED", "x", "", "dissolved"), ("c2", 2, "Oak Roofing Ltd", "9 Low St, Leeds", "Leeds", "active"), ("c3", 3, "Oak Roofing Services", "1 High St London SW1A 1AA", "London", "active")]
    pairs = spark.createDataFrame([(1, *lead, *c) for c in cands] + [(2, "Elk Fencing", "no code", "York", "d1", 1, "Fox Paving", "York", "York", "active")],
                                  "id long, name string, full_address string, city string, cand string, ord int, title string, address_snippet string, office_town string, company_status string")
    best = registry.best_registry_match(pairs, "id", "cand", "ord").withColumn("d", registry.registry_basis(F.col("evidence"))).collect()
    assert [(r["id"], r["cand"], r["d"]["basis"], r["d"]["confidence"]) for r in best] == [(1, "c3", "postcode", "matched")]
    second = registry.second_pass(pairs.withColumn("office_postcode", F.lit("")), "id", "cand", "ord").collect()
    assert [tuple(r) for r in second] == [(1, "c2", "exact_title", "matched")]
    df = spark.createDataFrame([(True, False, 0.5, "matched", None), (True, True, 0.5, "matched", None), (True, False, 0.95, "matched", None), (False, False, 0.1, None, None)],
                               "matched boolean, match_postcode boolean, name_overlap double, confidence string, demoted_reason string")
    once = registry.demote_city_only(df)
    assert [r["confidence"] for r in once.collect()] == ["low_confidence", "matched", "matched", None]
    assert once.collect() == registry.demote_city_only(once).collect()


def test_licence_and_directory(spark):
    rows = [(1, "Oak House Levelling", "Perth", "6000", "a", 1, "Oak House", "Perth", "", "Current"), (1, "Oak House Levelling", "Perth", "6000", "b", 2, "Oak House Levelling", "X", "", "Expired"),
            (2, "Restump", "A", "", "c", 1, "Restump Kings", "B", "", "Current"), (3, "Tim", "A", "", "d", 1, "Tim Kings", "B", "", "Current")]
    pairs = spark.createDataFrame(rows, "id long, name string, city string, postcode string, cand string, ord int, licensee string, suburb string, licence_postcode string, status string")
    got = sorted(tuple(r) for r in registry.licence_match(pairs, "id", "cand", "ord").collect())
    assert got == [(1, "a", "name_overlap", "matched"), (2, "c", "name_only", "low_confidence")]
    rows = [(1, "Oak Roofing", "Reno, NV", "(555) 111-2222", "a", 1, "Oak Roofing", "Reno", ["x"]), (1, "Oak Roofing", "Reno, NV", "(555) 111-2222", "b", 2, "Else", "Elko", ["555.111.2222"]), (2, "Oak Roofing", "Reno", None, "c", 1, "Oak Paving", "Reno", None)]
    pairs = spark.createDataFrame(rows, "id long, name string, city string, phone_number string, cand string, ord int, business_name string, listed_city string, phones array<string>")
    got = {r["id"]: (r["cand"], r["basis"], r["status"]) for r in registry.directory_match(pairs, "id", "cand", "ord").collect()}
    assert got == {1: ("b", "phone", "matched"), 2: ("c", "city+partial_name", "low_confidence")}


def test_separation_equals_the_sequential_pass(spark):
    rng = random.Random(5)
    points = [(i, 40 + rng.random(), 179.5 + rng.random()) for i in range(150)]
    points = [(i, a, b - 360 if b > 180 else b) for i, a, b in points] + [(150, None, 1.0)]

    def km(p, q):
        a, b, c, d = map(math.radians, (p[1], p[2], q[1], q[2]))
        return 2 * 6371 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    kept = []
    for p in points[:150]:
        if all(km(p, k) >= 20 for k in kept):
            kept.append(p)
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    assert sorted(r["id"] for r in cover.minimum_separation(df, "id", 20).collect()) == [k[0] for k in kept]


def test_adjudication(spark):
    rows = [(1, "A", "yes", "x", ""), (2, "B", "no", "roof", ""), (3, "C", "", "", ""), (4, "A", "no", "damp", ""), (5, "D", "yes", "x", ""), (6, "D", None, None, None), (7, "D", "unclear", "", ""), (8, "Z", "unclear", "", "Acme"), (9, "D", "no", "", "")]
    df = spark.createDataFrame(rows, "id long, tier string, verdict string, bucket string, brand_family string")
    got = {r["id"]: (r["drop_reason"], r["qa_flags"], r["aside"]) for r in cascade.adjudicate(df, side_bucket="damp").collect()}
    assert got == {
        1: (None, [], False), 2: ("adjudicated_no:roof", [], False), 3: (None, ["missing_verdict"], False), 4: (None, [], True), 5: (None, ["tier_d_sampled_yes"], False),
        6: ("tier_d_unadjudicated:sample_yes_rate=33.3%", [], False), 7: (None, ["icp_unclear", "tier_d_sampled_unclear"], False),
        8: (None, ["brand_unclear_kept:unknown_tier"], False), 9: ("adjudicated_no:unknown", [], False)}
