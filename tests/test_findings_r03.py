"""A test for each finding of round 3."""

import glob
import os
import tracemalloc
from collections import Counter
from datetime import timedelta

import duckdb
import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from leadloom.llm import chat, weak_quality
from leadloom.functions.geo import haversine_km
from leadloom.operators import cascade, disks, graph
from leadloom.plans import queries
from leadloom.streaming import stateful
from tests.test_lists import union_find


def as_sql(spark, folder: str, name: str) -> None:
    """The query's rows over the tables of a folder are those of its SQL."""
    got = [tuple(map(str, r)) for r in queries.QUERIES[name](spark, folder).collect()]
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    assert got and Counter(got) == Counter(tuple(map(str, r)) for r in con.sql(queries.ORACLE_SQL[name]).fetchall())


def test_email_harvest_keeps_what_its_sql_keeps(spark, tmp_path):
    links = "".join(f'<a href="/{w}">{w}</a>' for w in ("alpha", "beta", "gamma"))
    texts = ["Ask emgbr.22@mail7.example. Now", "user@website.org a@b.com", "x@y.local and logo.png@z.de"]
    rows = [(k, f"https://www.host{k}.example.com/", f"<html><body>{links}<p>{t}</p></body></html>") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    as_sql(spark, str(tmp_path), "email_harvest")
    found = {r["email"] for r in queries.QUERIES["email_harvest"](spark, str(tmp_path)).collect()}
    assert {"emgbr.22@mail7.example", "user@website.org", "x@y.local"} <= found


def test_chat_spans_do_not_depend_on_the_number_of_turns():
    turns = [(("user", "assistant")[k % 2], f"text {k}") for k in range(100)]
    # a template that edits the first turn for a while and then no more: prefixes of 70 to 79 turns show it, others do not
    edits = lambda m: "".join(f"<{r}>{'..' if not k and 70 <= len(m) < 80 else t}" for k, (r, t) in enumerate(m))
    assert chat.locate(edits, turns).rewritten_at == 69
    assert chat.locate(edits, turns).spans[69] == chat.locate(edits, turns[:70]).spans[69]
    for render in (chat.render_inst, chat.render_chatml):  # declared: the same spans as by all prefixes
        for n in (0, 1, 63, 64, 65, 100):
            assert chat.locate(render, turns[:n]) == chat._prefix_by_prefix(render, turns[:n], "\ue000")
    numbered = lambda m: "".join(f"{k}:{t};" for k, (_, t) in enumerate(m))
    assert chat.locate(numbered, turns, memory=0) == chat.locate(numbered, turns)  # a wrong declaration is found out


def test_seeded_candidates_of_one_domain_are_dealt_over_tasks(spark):
    persons = spark.range(4000).select("id", F.lit("A.com").alias("domain"), F.concat(F.lit("Ann"), F.char(97 + F.col("id") % 26)).alias("first_name"), F.lit("Bell").alias("last_name"))
    seeds = persons.where("id = 0").select("domain", "first_name", "last_name", F.lit("annabell@a.com").alias("email"))
    made = cascade.seeded_candidates(persons, seeds, "id")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id#" in plan and "hashpartitioning(domain#" not in plan
    assert {r["email"] for r in made.collect()} == {f"ann{chr(98 + k)}bell@a.com" for k in range(25)}


def test_classifier_is_fitted_in_little_memory_of_the_driver(monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(1000, 500, replace=False)).astype(np.int32), rng.random(500).astype(np.float32), k % 2 / 1) for k in range(2000)]
    tracemalloc.start()
    weights = weak_quality.fit_scorer(rows, 1000, rounds=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * 8 * 500 * 2000  # an index and a value of four bytes for each feature
    monkeypatch.setattr(weak_quality, "RUN_ROWS", 10_000, raising=False)
    assert (weak_quality.fit_scorer(rows, 1000, rounds=3) == weights).all()


def test_nearest_sends_a_run_few_blocks_however_dense_the_points_are(spark, monkeypatch):
    """Points in one cube of 16 km, which every row of a run was compared with before."""
    monkeypatch.setattr(disks, "RUN_ROWS", 16, raising=False)
    points = spark.range(40_000).select((F.col("id") * 7 % 40_000).alias("ord"), F.lit("p").alias("name"), (50 + F.rand(1) / 10).alias("latitude"), (F.rand(2) / 10).alias("longitude")).localCheckpoint()
    rows = spark.range(1000).select("id", F.when(F.col("id") > 800, 50.05).otherwise(50 + F.rand(3) / 10).alias("latitude"), F.when(F.col("id") > 800, 0.05).otherwise(F.rand(4) / 10).alias("longitude")).localCheckpoint()
    fed, frame = [], type(rows)
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *rest: fed.append(self) or plain(self, *rest))
    kept, dropped = disks.discard, []
    monkeypatch.setattr(disks, "discard", lambda *tables: dropped.extend(tables))
    got = {tuple(r) for r in disks.nearest(rows, "id", points).select("id", "ord").collect()}
    pairs = rows.crossJoin(points.select("ord", F.col("latitude").alias("a"), F.col("longitude").alias("b"))).withColumn("km", haversine_km(F.col("latitude"), F.col("longitude"), F.col("a"), F.col("b")))
    assert got == {tuple(r) for r in pairs.groupBy("id").agg(F.min(F.struct("km", "ord")).alias("m")).select("id", "m.ord").collect()}
    compared = fed[0].where("block is not null").agg(F.sum(F.size("m"))).first()[0]
    assert compared < 40_000 * 63 / 2 and fed[0].where("block is null").agg(F.max(F.size("m"))).first()[0] <= 16  # of 63 runs or more and 40,000 points
    kept(*dropped)
    monkeypatch.setattr(disks, "MOST_BLOCKS", 20)  # blocks of 2048 points, in records of 128
    assert got == {tuple(r) for r in disks.nearest(rows, "id", points).select("id", "ord").collect()}
    odd = spark.createDataFrame([(1, float("nan"), 1.0), (2, None, 1.0), (3, 50.0, float("inf"))], "id long, latitude double, longitude double")
    assert disks.nearest(odd, "id", points).count() == 0


def test_components_are_found_by_chunks_of_edges(spark, monkeypatch):
    """Chunks of two edges, so that hooks cross chunks; and a chunk sends on no more rows than it has nodes, not all edges in both directions."""
    batch = lambda pairs: pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs]) for k in (0, 1)], names=["x", "r"])
    dense = [(k % 50, k * 7 % 51) for k in range(5000)]
    stars = [r for out in graph._stars(iter([batch(dense[:3000]), batch(dense[3000:])])) for r in out.to_pylist()]
    assert {r["x"]: r["r"] for r in stars} == union_find(dense) and len(stars) == 51
    plain = graph._stars
    small = lambda batches: (out for b in batches for k in range(0, b.num_rows, 2) for out in plain(iter([b.slice(k, 2)])))
    monkeypatch.setattr(graph, "_stars", small)
    rng = np.random.default_rng(3)
    path = rng.permutation(60).tolist()
    cases = [[(k, k + 1) for k in path], [(99, k) for k in path], [(k, k) for k in path[:3]] + [(1, 2)], [tuple(p) for p in rng.integers(0, 150, (120, 2)).tolist()], [(f"n{k % 9}", f"é{k % 4}") for k in range(20)]]
    for edges in cases:
        kind = "string" if isinstance(edges[0][0], str) else "long"
        got = graph.connected_components(spark.createDataFrame(edges, f"a {kind}, b {kind}").repartition(3), "a", "b").collect()
        assert len(got) == len({r["node"] for r in got}) and {r["node"]: r["component"] for r in got} == union_find(edges)


def test_due_checks_send_on_one_event_of_a_key_and_chunk():
    events = pa.RecordBatch.from_arrays([pa.array([k % 7 for k in range(3000)]), pa.array(range(3000, 0, -1))], names=["k", "asked_at"])
    sent = [r for out in stateful._first_of_keys(iter([events, events])) for r in out.to_pylist()]
    assert sorted((r["k"], r["asked_at"]) for r in sent) == sorted((k, min(3000 - j for j in range(k, 3000, 7))) for k in range(7))
    asked = []  # and the store is asked once for a key
    state = type("State", (), {"get": lambda _: asked.append("get"), "exists": lambda _: asked.append("exists"), "update": lambda *_: None})()
    due = stateful.DueAfter("k", timedelta(days=1), False)
    due.checked = state
    assert [tuple(r) for r in due.handleInputRows((5,), iter([{"asked_at": 9}, {"asked_at": 3}]), None)] == [(5, "checked", 3, 1)] and asked == ["get"]
