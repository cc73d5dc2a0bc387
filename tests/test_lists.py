"""The list operators: every registered query against DuckDB, and the semantics that order and blanks bring."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from leadloom.functions import geo, text
from leadloom.operators import cascade, delta, graph, joins, merge, ranking, reports, rules
from leadloom.plans import queries
from leadloom.sources import files
from leadloom.streaming import incremental

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    fix = lambda x: "" if x is None or x != x else round(float(x), 6) if isinstance(x, float) else x.item() if hasattr(x, "item") else str(x)
    return sorted([tuple(fix(x) for x in r) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sf, name):
    got = queries.QUERIES[name](spark, sf).toPandas()
    if name not in queries.ORACLE_SQL:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(want.columns) == sorted(got.columns)
    cols = sorted(want.columns)
    assert plain(got[cols].itertuples(index=False)) == plain(want[cols].itertuples(index=False))


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_numbers_and_keys(spark):
    df = spark.createDataFrame([("4.8 (12)", "12-15", "Fox & Co. Ltd", "+44 (0)20 7946 0958"), (None, "", None, "12")], "a string, b string, c string, d string")
    rows = df.select(text.lenient_number(F.col("a")), text.lenient_number(F.col("b")), text.company_key(F.col("c")), text.phone_key(F.col("d")), text.strict_number(F.col("a")), text.whole_number(F.col("b"))).collect()
    assert tuple(rows[0]) == (4.812, 12.0, "fox and co", "2079460958", None, 12) and tuple(rows[1]) == (None, None, "", "", None, 0)


def test_hosts_and_mail(spark):
    df = spark.createDataFrame([("https://www.a.Example.co.uk:80/x?y#z",), ("example.com/path/",), ("not a url",), (None,)], "u string")
    hosts = [r[0] for r in df.select(text.host_of(F.col("u"))).collect()]
    assert hosts == ["a.example.co.uk", "example.com", "", ""]
    roots = spark.createDataFrame([(h,) for h in hosts], "h string").select(text.root_domain(F.col("h")), text.on_shared_host(F.col("h"), ["co.uk"])).collect()
    assert [tuple(r) for r in roots] == [("example.co.uk", True), ("example.com", False), ("", False), ("", False)]
    key = 0x2A
    token = bytes([key, *[ord(c) ^ key for c in "a@b.co"]]).hex()
    score = lambda e: text.email_score(F.lit(e), F.lit("acme.com"))
    r = spark.range(1).select(text.decode_cf_email(F.lit(token)), score("jane.doe@acme.com"), score("info@acme.com"), score("jane.doe@gmail.com"), text.ownness(F.lit("x@mail.acme.com"), F.lit("acme.com")), text.uk_postcode(F.lit("at SW1A 1AA"))["outward"]).first()
    assert tuple(r) == ("a@b.co", 33, 23, 32, "subdomain", "SW1A")


def test_order_is_data(spark):
    df = spark.createDataFrame([("k", 2, "", "b"), ("k", 1, None, "a"), ("k", 3, "x", "b"), ("k", 4, "y", "c")], "k string, o int, v string, t string").repartition(3)
    r = merge.merge_by_key(df, ["k"], F.col("o"), fields=["v"], tags=["t"]).first()
    assert r["v"] == "x" and r["t"] == ["a", "b", "c"]
    best = merge.merge_onto_best(df, ["k"], F.col("o"), F.col("o"), ["v"]).first()
    assert best["v"] == "y" and best["rows_merged"] == 4


def test_rules_first_reason_and_asymmetry(spark):
    df = spark.createDataFrame([("coworking space|gym", "5"), ("gym|spa", "5"), ("gym", ""), ("gym", "1")], "types string, n string")
    r = rules.Rule
    qualified = rules.qualify(df, [r("types", "allow", ["gym"]), r("types", "deny", ["spa"]), r("n", ">=", 3, "few"), r("missing", "exists")])
    assert [x["drop_reason"] for x in qualified.collect()] == ["deny:types", None, "few", "few"]  # deny sees the primary tag and parts of words
    wide = rules.qualify(df, [r("types", "deny", ["spa"], scope="any")])
    assert [x["drop_reason"] for x in wide.collect()] == ["deny:types", "deny:types", None, None]
    assert rules.qualify(df, [r("types", "allow", [])]).where("drop_reason is null").count() == 0


def test_nearest_ties_and_limits(spark):
    df = spark.createDataFrame([(0.0, 0.0), (None, 1.0)], "latitude double, longitude double")
    rows = geo.nearest_point(df, [("a", 1.0, 0.0), ("b", -1.0, 0.0)], squared_degrees=True).collect()
    assert rows[0]["nearest"]["name"] == "a" and rows[1]["nearest"] is None
    with pytest.raises(ValueError):
        geo.nearest_point(df, [("x", 0.0, 0.0)] * 3000)


def test_greedy_is_not_transitive(spark):
    rows = [(1, "p1", "s1"), (2, "p1", "s2"), (3, "p3", "s2")]  # 1 drops 2, so 3 stays though 2 shares its street
    df = spark.createDataFrame(rows, "id long, phone string, street string").withColumn("component", F.lit(1))
    assert [r["id"] for r in cascade.greedy_distinct(df, [F.col("id")], ["phone", "street"], "component").orderBy("id").collect()] == [1, 3]
    parts = graph.connected_components(graph.shared_edges(df, "id", ["phone", "street"]), "a", "b")
    assert {r["component"] for r in parts.collect()} == {1}


def test_greedy_equals_sequential_pass_without_python_groups(spark):
    rng = random.Random(9)
    draw = lambda n: rng.choice([None, "", " ", *[f"v{k}" for k in range(n)]])
    rows = [(i, rng.randrange(10**6), draw(40), draw(60)) for i in range(400)] + [(400 + i, -i, f"c{i // 2}", f"d{(i + 1) // 2}") for i in range(9)]
    seen, want = set(), set()
    for i, _, a, b in sorted(rows, key=lambda x: (-x[1], x[0])):
        mine = {(k, v) for k, v in enumerate((a, b)) if v and v.strip()}
        if not mine & seen:
            seen |= mine
            want.add(i)
    df = spark.createDataFrame(rows, "id long, o long, a string, b string").repartition(3)
    got = cascade.greedy_distinct(df, [F.col("o").desc(), F.col("id")], ["a", "b"])  # needs no components, and no group in one task
    assert {r["id"] for r in got.collect()} == want and got.columns == df.columns and "InPandas" not in got._jdf.queryExecution().toString()
    assert cascade.greedy_distinct(df.limit(0), [F.col("id")], ["a", "b"]).count() == 0


def union_find(edges):
    up = {}
    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for x, y in edges:
        p, q = sorted((top(x), top(y)))
        up[q] = p
    return {x: top(x) for x in up}


def test_components_equal_union_find(spark, sf):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5100)] + [(7, 7)]
    got = graph.connected_components(spark.createDataFrame([*edges, (1, None)], "a long, b long").repartition(5), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == union_find(edges) and len(got) == len(union_find(edges))
    whole = [(r["l_partkey"], 1000000000 + r["l_suppkey"] * 1000 + r["l_orderkey"] % 97) for r in spark.read.parquet(f"{sf}/lineitem.parquet").collect()]
    assert {r["node"]: r["component"] for r in queries.QUERIES["connected_components_all"](spark, sf).collect()} == union_find(whole)


def test_verification_truth_table(spark):
    cases = [(None, None, "unverified"), ("ok", None, "sendable"), ("disposable", "deliverable", "dropped"), ("invalid", "deliverable", "sendable"), ("invalid", None, "dropped"),
             ("catch_all", None, "unverified"), ("catch_all", "deliverable", "sendable"), ("catch_all", "risky", "risky"), (None, "risky", "risky")]
    df = spark.createDataFrame(cases, "a string, b string, want string")
    assert all(r[0] == r[1] for r in df.select(cascade.verification_state(F.col("a"), F.col("b"), ("invalid",)), "want").collect())


def test_waterfall_stops(spark):
    rows = [("halt", 1, 1, "risky", True), ("halt", 2, 1, "sendable", False), ("keep", 1, 1, "risky", False), ("keep", 2, 1, "sendable", False),
            ("same", 1, 1, "risky", False), ("same", 1, 2, "sendable", False), ("none", 1, 1, "dropped", False)]
    df = spark.createDataFrame(rows, "k string, rung int, cand int, verdict string, guessed boolean")
    assert {r["k"]: r["outcome"] for r in cascade.waterfall(df, "k").collect()} == {"halt": "none", "keep": "risky", "same": "sendable", "none": "none"}


def test_joins_claims_and_tokens(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "l long, k string")
    right = spark.createDataFrame([(10, 1, "a"), (11, 2, "a"), (12, 3, "")], "r long, o long, k string")
    assert [tuple(r) for r in joins.claim_once(left, right, [("k", "k")], "l", "r", "o").collect()] == [(1, 10, 0)]
    tokens = spark.createDataFrame([(1, ["x", "common"]), (2, ["common"])], "id long, t array<string>")
    other = spark.createDataFrame([(i, ["common", f"u{i}"]) for i in range(30)] + [(99, ["x", "common"])], "rid long, t array<string>")
    got = {r["id"]: (r["rid"], r["overlap"]) for r in joins.token_matches(tokens, other, "id", "rid", "t", least=0.5, most_common=5).collect()}
    assert got == {1: (99, 1.0), 2: (0, 0.5)}


def test_token_pairs_lose_nothing(spark):
    many = [(i, ["a", "b"]) for i in range(10_001)]  # a and b are common, c is rare
    left = spark.createDataFrame([(1, ["a", "b", "c"])], "id long, t array<string>")
    right = spark.createDataFrame([*many, (-1, ["a", "b", "d"]), (-2, ["c", "x", "y", "z"])], "rid long, t array<string>")
    assert [tuple(r) for r in joins.token_matches(left, right, "id", "rid", "t").collect()] == [(1, -1, 0.666667)]
    assert joins.candidate_pairs(left, right, "id", "rid", "t", least=0.34).count() == 10_002
    assert joins.candidate_pairs(left, right, "id", "rid", "t").count() == 10_003


@pytest.mark.parametrize("of_larger", [True, False])
def test_token_pairs_equal_brute_force(spark, of_larger):
    rng = random.Random(6)
    draw = lambda n: [(i, [rng.choice("aaaabbbcccdefghij") for _ in range(rng.randrange(7))] + [None] * (i % 3)) for i in range(n)]
    a, b = draw(60), draw(80)
    left, right = spark.createDataFrame(a, "id long, t array<string>"), spark.createDataFrame(b, "rid long, t array<string>")
    score = {}
    for i, x in a:
        for j, y in b:
            p, q = set(x) - {None}, set(y) - {None}
            if p & q:
                score[i, j] = round(len(p & q) / (max if of_larger else min)(len(p), len(q)), 6)
    for least in (0.0, 0.34, 0.6, 0.666667, 1.0):
        want = {k for k, v in score.items() if v >= least}
        assert {tuple(r) for r in joins.candidate_pairs(left, right, "id", "rid", "t", least=least, of_larger=of_larger).collect()} == want
        best = {i: max((v, -j) for (k, j), v in score.items() if k == i and (k, j) in want) for i, _ in want}
        got = joins.token_matches(left, right, "id", "rid", "t", least=least, of_larger=of_larger).collect()
        assert {r["id"]: (r["overlap"], -r["rid"]) for r in got} == best


def most_rows(df):
    """Runs ``df``; the most rows that a node of its plan made."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
    return most


def test_hot_groups_are_reduced_first(spark):
    left, right = spark.range(2000).select(F.col("id").alias("l"), F.lit("hot").alias("k")), spark.range(2000).select(F.col("id").alias("r"), (-F.col("id")).alias("o"), F.lit("hot").alias("k"))
    claimed = joins.claim_once(left, right, [("k", "k")], "l", "r", "o")
    assert [tuple(r) for r in claimed.collect()] == [(0, 1999, 0)] and most_rows(claimed) <= 4000
    events = spark.range(3000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 2 == 1, 1).alias("j"), F.col("id").alias("o"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("t"), (F.col("id") % 3).alias("u")).repartition(4)
    merged = merge.merge_by_key(events, ["k", "j"], F.col("o"), tags=["t", "u"])
    assert sorted(map(tuple, merged.select("k", "t", "u").collect())) == [(0, [None, 2, 4, 1, 3], [0, 2, 1]), (1, [1, 3, None, 2, 4], [1, 0, 2])]
    assert "__v" in merged._jdf.queryExecution().optimizedPlan().toString()  # repeats go before values are gathered
    rows = [(i, "hot" if i % 3 else [None, "", " "][i // 3 % 3], i % 7) for i in range(60)]
    groups = merge.collapse_groups(spark.createDataFrame(rows, "id long, g string, n long"), "g", "id", [F.col("n").desc(), F.col("id")])
    assert all((r["group_size"], r["is_multi"], r["rep"]) == ((40, True, 13) if r["g"] == "hot" else (1, False, r["id"])) for r in groups.collect()) and groups.count() == 60
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan and "count(1) windowspec" not in plan


def test_upsert_and_memory(spark):
    old = spark.createDataFrame([(1, "r1", "a"), (2, "r1", "b")], "k long, first string, v string")
    new = spark.createDataFrame([(2, 1, "r2", "c"), (2, 2, "r2", "d"), (3, 1, "r2", "e")], "k long, o long, first string, v string")
    got = {r["k"]: tuple(r)[1:] for r in delta.upsert(old, new, ["k"], "o", keep=["first"]).collect()}
    assert got == {1: ("r1", "a", "unchanged"), 2: ("r1", "d", "updated"), 3: ("r2", "e", "inserted")}


def test_numbered_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert all(r["row_number"] == r["x"] + 1 for r in ranking.numbered(df, ["x"]).collect())
    assert reports.funnel(df.limit(0).withColumn("s", F.lit("a")), "s").count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Place ID,Name,technology_solar,technology_wind\n1,\"x, \"\"y\"\"\nz\",1,1\n2,,0,1\n", encoding="utf-8")
    df = files.read_csv(spark, str(tmp_path / "a.csv"), order=True)
    rows = files.flags_to_tags(df, "technology_", "tags").orderBy("_ord").collect()
    assert [(r["Place ID"], r["Name"], r["tags"]) for r in rows] == [("1", 'x, "y"\nz', "solar|wind"), ("2", "", "wind")]
    assert files.with_aliases(df, {"id": ["pid", "place id"], "none": ["zip"]}).orderBy("id").first()["id"] == "1"
    files.write_csv(df.drop("_file", "_ord"), str(tmp_path / "out"), quote_all=True)
    assert files.read_csv(spark, str(tmp_path / "out")).count() == 2
    (tmp_path / "b.jsonl").write_text('{"k":"a","n":1}\nbroken\n{"k":"a","n":2}\n')
    assert files.last_by_key(files.read_json_lines(spark, str(tmp_path / "b.jsonl"), "k string, n int"), "k", "n").first()["n"] == 2


def test_stream_upsert_resumes(spark, tmp_path):
    src, table, ck = (str(tmp_path / x) for x in ("in", "table", "ck"))
    for i in range(3):
        spark.createDataFrame([(k, i, f"v{i}{k}") for k in range(i + 1)], "k long, o long, v string").coalesce(1).write.mode("append").parquet(src)
    stream = lambda: incremental.stream_folder(spark, src, "k long, o long, v string", files_per_batch=1)
    got = {r["k"]: r["v"] for r in incremental.upsert_stream(stream(), ["k"], "o", table, ck).collect()}
    assert got == {0: "v20", 1: "v21", 2: "v22"}
    spark.createDataFrame([(0, 9, "late")], "k long, o long, v string").coalesce(1).write.mode("append").parquet(src)
    assert {r["k"]: r["v"] for r in incremental.upsert_stream(stream(), ["k"], "o", table, ck).collect()}[0] == "late"


def test_windowed_counts_match_batch(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    assert incremental.windowed_counts(e, "ts", "event_type", "value").agg(F.sum("n")).first()[0] == e.count()
