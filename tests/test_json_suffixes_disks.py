"""JSON at any depth, public suffixes, disks and nearest points: against plain loops."""

import json
import math
import random
import re

from pyspark.sql import functions as F

from leadloom.functions import address, pages, people
from leadloom.operators import disks, gates, jsonwalk, rollups, suffixes


def plain_walk(node, out):
    if isinstance(node, list):
        for v in node:
            plain_walk(v, out)
    elif isinstance(node, dict):
        for k, v in node.items():
            if re.fullmatch(r"(?i)e-?mail(address)?", k):
                if isinstance(v, str):
                    out.append(v)
                elif isinstance(v, list):
                    out += [x for x in v if isinstance(x, str)]
                else:
                    plain_walk(v, out)
            else:
                plain_walk(v, out)


def test_json_walk_equals_plain_walk(spark):
    rng = random.Random(7)

    def made(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.25:
            return rng.choice(["a@b.co", 'q"uo\\te@x.com', "é@ü.de", 5, None, True, "", 1.5])
        if kind < 0.5:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["email", "E-Mail", "emailAddress", "name", "@graph", "contactPoint", "xemail", "mail", "url"]): made(depth - 1) for _ in range(rng.randrange(5))}

    values = [made(5) for _ in range(150)] + [{"email": {"email": {"email": ["x@y.z", ["no@no.no"], {"email": "no@no.no"}]}}}, [[[{"EMAIL": "deep@x.com"}]]], "email", 7]
    rows = [(k, json.dumps(v, ensure_ascii=k % 2 == 0)) for k, v in enumerate(values)] + [(900, '{"email": "broken@x.com", '), (901, None), (902, "  "), (903, '{"email":"a@x.com","email":"b@x.com"}'), (904, '{"email": "ab"')]
    want = []
    for k, v in enumerate(values):
        out = []
        plain_walk(v, out)
        want += [(k, x) for x in out]
    got = jsonwalk.values_under(spark.createDataFrame(rows, "id int, t string"), "id", "t", jsonwalk.EMAIL_KEY, jsonwalk.EMAIL_IN_BROKEN)
    assert sorted(map(tuple, got.collect())) == sorted(want + [(900, "broken@x.com"), (903, "b@x.com")])
    assert len(want) > 50
    assert jsonwalk.values_under(spark.createDataFrame([], "id int, t string"), "id", "t", jsonwalk.EMAIL_KEY, jsonwalk.EMAIL_IN_BROKEN).count() == 0


def test_declared_emails(spark):
    html = '<script TYPE=application/ld+json><![CDATA[{"@graph":[{"contactPoint":[{"email":["A@x.com","b@x.com"]}]}]}]]></script><script>{"email":"no@x.com"}</script>'
    got = jsonwalk.declared_emails(spark.createDataFrame([(1, html), (2, None), (3, html * 2)], "id int, h string"), "id", "h").collect()
    assert sorted(map(tuple, got)) == [(1, "A@x.com"), (1, "b@x.com"), (3, "A@x.com"), (3, "A@x.com"), (3, "b@x.com"), (3, "b@x.com")]


def plain_suffix(host, rules):
    labels = [x for x in re.sub(r"^www\.", "", (host or "").strip().lower()).split(".") if x]
    size = min(1, len(labels))
    for k in range(1, len(labels) + 1):
        name = ".".join(labels[-k:])
        if name in rules:
            size = max(size, k)
        if "*." + name in rules and len(labels) > k:
            size = max(size, k + 1)
    for k in range(1, len(labels) + 1):
        if "!" + ".".join(labels[-k:]) in rules:
            size = k - 1
    suffix = ".".join(labels[len(labels) - size:])
    label = labels[-size - 1] if len(labels) > size else ""
    return label, suffix, f"{label}.{suffix}" if label else ""


def test_suffixes_equal_a_plain_search(spark):
    rules = ["com", "uk", "co.uk", "org.uk", "*.ck", "!www.ck", "kawasaki.jp", "*.kawasaki.jp", "!city.kawasaki.jp", "jp", "blog.co.uk", "*.bd"]
    rng = random.Random(1)
    hosts = ["a.co.uk", "www.x.a.co.uk", "co.uk", "www.ck", "x.www.ck", "shop.a.ck", "a.ck", "ck", "city.kawasaki.jp", "x.city.kawasaki.jp", "a.b.kawasaki.jp", "b.kawasaki.jp", "me.blog.co.uk", "localhost", "", None,
             "..a..com..", "X.COM ", "a.unknown"] + [".".join(rng.choice(["a", "www", "co", "uk", "com", "ck", "jp", "kawasaki", "blog", "city"]) for _ in range(rng.randrange(1, 6))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(hosts)), "i int, host string")
    got = suffixes.with_suffix(df, "host", spark.createDataFrame([(r.upper(),) for r in rules] + [("com",), ("",), (None,)], "suffix string"))
    assert {r["i"]: tuple(r["domain"]) for r in got.collect()} == {i: plain_suffix(h, rules) for i, h in enumerate(hosts)}


def far(a, b):
    x, y = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
    h = math.sin(x / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(y / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def test_disks_equal_all_pairs(spark):
    rng = random.Random(3)
    rows = [(k, rng.uniform(-89, 89), rng.uniform(-180, 180), rng.choice([0.0, 0.5, 3.0, 50.0, 400.0, 3000.0])) for k in range(150)]
    rows += [(200 + k, 51 + rng.uniform(-0.3, 0.3), rng.uniform(-0.3, 0.3), rng.choice([1.0, 5.0, 20.0])) for k in range(150)]
    rows += [(400, 10.0, 179.9, 30.0), (401, 10.0, -179.95, 2.0), (402, 5.0, 5.0, 9.0), (403, 5.0, 5.0, 9.0), (404, 5.0, 5.0, 9.0), (405, None, 1.0, 1.0), (406, 1.0, 1.0, None), (407, 89.9, 0.0, 40.0), (408, 89.9, 180.0, 1.0)]
    placed = [r for r in rows if None not in r]
    gone = {d[0] for d in placed if any(o[0] != d[0] and far(d[1:3], o[1:3]) + d[3] <= o[3] and (o[3] > d[3] or o[0] < d[0]) for o in placed)}
    df = spark.createDataFrame(rows, "id int, lat double, lng double, km double")
    assert {r["id"] for r in disks.not_inside(df, "id", lat="lat", lng="lng", km="km").collect()} == {r[0] for r in rows} - gone
    assert {401, 403, 404, 408} <= gone
    assert disks.not_inside(df.limit(0), "id", lat="lat", lng="lng", km="km").count() == 0


def test_nearest_equals_brute_force(spark):
    """10,000 centres, dense in places; rows near, far off, at the poles and across the date line; ties by order."""
    rng = random.Random(5)
    centres = [(k, f"c{k}", rng.uniform(-60, 70), rng.uniform(-180, 180)) for k in range(6000)] + [(6000 + k, f"c{6000 + k}", 40 + rng.gauss(0, 1), -75 + rng.gauss(0, 1)) for k in range(4000)]
    centres += [(20_000, "late twin", centres[0][2], centres[0][3])]
    rows = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(60)] + [(100 + k, 40 + rng.gauss(0, 1), -75 + rng.gauss(0, 1)) for k in range(60)]
    rows += [(300, 90.0, 0.0), (301, 0.0, 180.0), (302, 0.0, -180.0), (303, centres[0][2], centres[0][3]), (304, None, 1.0)]
    points = spark.createDataFrame(centres, "ord int, name string, latitude double, longitude double")
    got = {r["id"]: r for r in disks.nearest(spark.createDataFrame(rows, "id int, latitude double, longitude double"), "id", points).collect()}
    assert set(got) == {r[0] for r in rows} - {304} and got[303]["name"] == "c0"
    for i, a, b in rows[:-1]:
        assert abs(got[i]["km"] - min(far((a, b), (c[2], c[3])) for c in centres)) < 1e-6
    assert disks.nearest(spark.createDataFrame(rows, "id int, latitude double, longitude double"), "id", points.limit(0)).count() == 0


def test_shared_boilerplate_of_long_pages(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("ab é🎉\n") for _ in range(n))
    sites = []
    for pre, suf, n in ((70_000, 5_000, 3), (59, 61, 2), (60, 0, 4), (0, 0, 2), (100, 100, 1), (31, 1000, 5)):
        head, foot = text(pre), text(suf)
        sites.append([head + f"<{k}>" + text(rng.randrange(50)) + f"[{k}]" + foot for k in range(n)])
    sites.append(["x" * 300] * 3)
    sites.append(["x" * 300, "x" * 200, ""])

    def plain(texts, least=60):
        if len(texts) < 2:
            return texts
        shared = lambda ts: next((i for i in range(min(map(len, ts))) if len({t[i] for t in ts}) > 1), min(map(len, ts)))
        pre, suf = shared(texts), shared([t[::-1] for t in texts])
        pre, suf = pre if pre >= least else 0, suf if suf >= least else 0
        return [(t[pre: max(pre, len(t) - suf)] if pre < len(t) else t).strip(" ") for t in texts]

    df = spark.createDataFrame(list(enumerate(sites)), "i int, t array<string>")
    got = {r["i"]: r["s"] for r in df.select("i", pages.strip_shared(F.col("t")).alias("s")).collect()}
    assert got == {i: plain(s) for i, s in enumerate(sites)}


def test_rollups_of_directories(spark):
    rows = [("a", 1, "seo", "us", "", "x"), ("a", 2, "ads", "us", "$5k", "y"), ("a", 3, "seo", None, "$9k", "z"), ("b", 4, "", "uk", None, None), (None, 5, "seo", "us", "1", "q")]
    df = spark.createDataFrame(rows, "k string, o int, cat string, cc string, budget string, team string")
    got = {r["k"]: (r["cat"], r["cc"], r["budget"], r["team"]) for r in rollups.directory_rollup(df, "k", "o", category="cat", country="cc", fields=["budget"], once=["team"]).collect()}
    assert got == {"a": ("ads;seo", "us", "$5k", "x"), "b": ("", "uk", "", None)}
    got = rollups.listing_rollup(df, "k", "o", term="cat", place="cc").collect()
    assert {r["k"]: (r["budget"], r["found_by"]) for r in got} == {"a": ("", "seo @ us;ads @ us;seo @ "), "b": (None, " @ uk")}


def test_owners_flags_and_addresses(spark):
    names = ["Adam Smith Roofing", "Adam's Roofing", "Adam Roofing Co", "Perth Smith", "Adam North Works", "adam Smith", "", None]
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string")
    own = people.eponymous_owner(F.col("n"), ["Adam"], trade="(?i)roof", places="North|South")
    got = [r["o"] and tuple(r["o"]) for r in df.select("i", own.alias("o")).orderBy("i").collect()]
    assert got == [("Adam Smith", "Adam", False), (None, "Adam", True), None, None, None, None, None, None]
    texts = ["Pocket FM", "Acme damp", "tv stands", "Tvs", "weight loss now", None]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(gates.likely_junk(F.col("t"))).collect()]
    assert got == ["yes", "", "yes", "", "yes", ""]
    streets = ["12 Main Street Bldg 4", "12 main st", "12 Main Street #4, X", "9 North Road, Suite 1"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(streets)), "i int, t string").orderBy("i").select(address.short_street(F.col("t"))).collect()]
    assert got == ["12mainst", "12mainst", "12mainst", "9nrd"]
    assert spark.range(1).select(address.brand_key(F.lit("Acme Foods Int'l Nigeria Ltd"))).first()[0] == "acme foods"


def test_shares_of_the_smaller_set(spark):
    """Sets of very different sizes, common and rare tokens, equal sets and nested ones: all pairs, by either set's share."""
    from leadloom.operators import joins

    rng = random.Random(12)
    word = lambda: rng.choice(["the", "of", "co", *[f"w{int(rng.expovariate(0.1))}" for _ in range(3)]])
    sets = lambda n, base: [(base + k, [word() for _ in range(rng.choice([1, 2, 3, 8, 20]))]) for k in range(n)]
    a, b = sets(80, 0) + [(900, ["the"]), (901, ["the", "of", "co"])], sets(90, 1000) + [(1900, ["the", "of"])]
    for of_larger in (False, True):
        for least in (0.34, 0.6, 1.0):
            size = max if of_larger else min
            want = {(i, j) for i, x in a for j, y in b if set(x) & set(y) and round(len(set(x) & set(y)) / size(len(set(x)), len(set(y))), 6) >= least}
            got = joins.candidate_pairs(spark.createDataFrame(a, "l int, t array<string>"), spark.createDataFrame(b, "r int, t array<string>"), "l", "r", "t", least=least, of_larger=of_larger)
            assert {tuple(r) for r in got.collect()} == want


def test_primary_contacts_and_their_overrides(spark):
    from leadloom.operators import contacts

    people = [("a", 1, "Ann Bell", "Ann", "Bell", "Owner", "owner_or_partner", "site", "e"), ("a", 2, "Bob Stone", "Bob", "Stone", "Clerk", "other", "web_search", "f"), ("a", 3, "Cy Moss", "Cy", "Moss", "GM", "gm", "site", "g"),
              ("b", 1, "Di Fox", "Di", "Fox", "Clerk", "other", "site", "h"), ("d", 1, "Ed Li", "Ed", "Li", "Owner", "owner_or_partner", "web_search", "i"), ("d", 2, " ", "", "", "", "gm", "", "")]
    c = spark.createDataFrame(people, "k string, o int, name string, first_name string, last_name string, title string, role_bucket string, source string, evidence string")
    rows = [("a", "bob.stone@a.com", "person", "sibling", None, None, None, None, "fam", "unclear"), ("b", "info@b.com", "generic", "exact", "Zed", None, None, None, "", ""),
            ("c", "zed@c.com", "person", "", "Zed", "Ray", "high", "local part", None, None), ("d", "ed.li@d.com", "person", "", "Ed", "Li", None, None, None, None), ("e", None, None, None, None, None, None, None, None, None)]
    leads = spark.createDataFrame(rows, "k string, email string, email_type string, email_own_basis string, first_name_hint string, last_name_hint string, name_confidence string, name_evidence string, brand_family string, adjudication string")
    got = {r["k"]: (r["primary_name"], r["primary_title"], r["name_source"], r["other_contacts"], r["qa_flags"]) for r in contacts.chosen_primary(leads, c, "k", "o").collect()}
    assert got == {
        "a": ("Bob Stone", "Clerk", "web_search", "Cy Moss [GM -> gm]", "brand:fam; icp_unclear; email_sibling_domain; email_matches_named_contact"),
        "b": ("", "", "", "", "only_non_decision_maker_contact"), "c": ("Zed Ray", "", "email_local_part:high", "", "name_from_email_only"),
        "d": ("Ed Li", "Owner", "web_search", "", "sweep_named_verify_before_send"), "e": ("", "", "", "", "")}
    assert contacts.chosen_primary(leads.limit(0), c, "k", "o").count() == 0
