"""Memory between cycles, streams into versioned tables, stalls, the store's rules, and forms of numbers and snippets."""

from pyspark.sql import functions as F

from leadloom.functions import text
from leadloom.operators import delta, store
from leadloom.sources import files
from leadloom.streaming import incremental


def test_merged_memory(spark):
    prior = spark.createDataFrame([("a", 1, None, 5, "false", "x"), ("a", 2, "c2", 3, None, None), ("b", 1, "c1", None, "False", "y"), (None, 1, "c1", 1, "true", "z"), (" ", 2, "c1", 1, "true", "z")],
                                  "k string, o int, first_seen string, cumulative_hits int, delivered string, name string")
    rows = {r["k"]: tuple(r)[1:] for r in delta.merged_memory(prior, "k", "o").collect()}
    assert rows == {"a": ("c2", 5, True, None), "b": ("c1", 0, False, "y")}
    assert delta.merged_memory(prior.limit(0), "k", "o").count() == 0


def test_prefixes_and_work_keys(spark):
    seen = spark.createDataFrame([("SW1",), ("EC2",), (None,)], "code string")
    assert [r[0] for r in delta.prefixes_not_seen(["SW", "EC", "N"], seen, "code").collect()] == ["N"]
    r = spark.range(1).select(delta.work_key(F.lit("roofers"), F.lit(51.5074), F.lit(-0.1)), delta.work_key(F.lit("x"), F.lit(None), F.lit(1.0))).first()
    assert tuple(r) == ("roofers|51.51|-0.10", None)


def test_versions_and_newest_capture(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.versions(spark, path) == []
    assert files.rewrite(spark.range(3), path).count() == 3
    again = files.rewrite(files.latest(spark, path).where("id > 0"), path)  # a rewrite of the table it reads
    (tmp_path / "t" / "v2").mkdir()  # one that has not ended
    assert again.count() == 2 and files.versions(spark, path) == [0, 1] and files.latest(spark, path).count() == 2
    df = spark.createDataFrame([("1", "A", "x", "2020", 1), ("1", "B", "y", "2021", 2), (" ", "C", None, "2020", 3), (None, "c", None, "2020", 4)], "id string, name string, address string, ts string, o int")
    assert {r["capture_key"]: r["o"] for r in files.newest_capture(df, "id", "name", "address", "ts", "o").collect()} == {"1": 2, "c|": 4}


def test_streams_of_hits(spark, tmp_path):
    src, table, ck = (str(tmp_path / x) for x in ("in", "table", "ck"))
    schema = "k string, cycle string, pass int"
    hits = lambda: incremental.cumulative_hits(incremental.stream_folder(spark, src, schema, files_per_batch=1), "k", "cycle", "pass", table, ck)
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    write([("a", "c1", 1), ("a", "c1", 1), ("b", "c1", 1), (None, "c1", 1)])
    write([("a", "c1", 2), ("a", "c1", 1)])
    assert {r["k"]: (r["first_cycle"], r["cumulative_hits"]) for r in hits().collect()} == {"a": ("c1", 2), "b": ("c1", 1)}
    write([("b", "c2", 1), ("n", "c2", 1)])
    assert {r["k"]: (r["first_cycle"], r["cumulative_hits"]) for r in hits().collect()} == {"a": ("c1", 2), "b": ("c1", 2), "n": ("c2", 1)}


def test_errors_are_tried_again(spark, tmp_path):
    src, table, ck = (str(tmp_path / x) for x in ("in", "table", "ck"))
    spark.createDataFrame([("a", 1, "ok"), ("a", 2, "error"), ("b", 1, "error"), ("c", 1, None)], "k string, o int, v string").coalesce(1).write.parquet(src)
    stream = incremental.stream_folder(spark, src, "k string, o int, v string")
    got = incremental.upsert_stream(stream, ["k"], "o", table, ck, retry=F.col("v") == "error").collect()
    assert {r["k"]: r["v"] for r in got} == {"a": "ok", "c": None}


def test_checks_are_due_after_their_ttl(spark, tmp_path):
    src, table, ck = (str(tmp_path / x) for x in ("in", "table", "ck"))
    schema = "k string, t timestamp"
    due = lambda: incremental.due_after(incremental.stream_folder(spark, src, schema, files_per_batch=1), "k", "t", "90 DAYS", table, ck)
    runs = ([("a", "2026-01-01"), ("a", "2026-01-09"), (None, "2026-01-01")], [("a", "2026-03-31"), ("x", "2026-09-01")], [("a", "2026-04-01"), ("x", "2026-08-01"), ("x", None)])
    for rows in runs:
        spark.createDataFrame(rows, "k string, d string").select("k", F.to_timestamp("d").alias("t")).coalesce(1).write.mode("append").parquet(src)
        got = {r["k"]: (str(r["verified_at"])[:10], r["checks"]) for r in due().collect()}
    assert got == {"a": ("2026-04-01", 2), "x": ("2026-09-01", 1)}


def test_stalls(spark):
    e = spark.createDataFrame([("r", t, o) for o, t in enumerate([1, 2, 2, 2, 3, 4, 4])], "run string, total int, o int")
    assert [tuple(r) for r in incremental.stalls(e, "run", "total", "o", 2).collect()] == [("r", 2, 2, 1, 3)]


def test_store_rules(spark):
    runs = store.conformed(spark.createDataFrame([("r1", "c", "gb")], "run_id string, client string, country string"), store.STORE["runs"])
    assert runs.columns == [f.name for f in store.STORE["runs"].schema.fields] and runs.first()["config"] == "{}"
    people = spark.createDataFrame([("p1", "Al", "owner", "web", "r1"), ("p1", "Al", "owner", "web", "r1"), ("p1", "Al", "owner", "web", None), ("p1", "Al", "owner", "web", None), ("p9", None, "owner", "web", "r2")],
                                   "place_id string, name string, role_bucket string, source string, run_id string")
    places = store.conformed(spark.createDataFrame([("p1", "n", "gb")], "place_id string, name string, country string"), store.STORE["places"])
    broken = store.store_violations({"runs": runs, "places": places, "contacts": store.conformed(people, store.STORE["contacts"])})
    assert sorted((r["table"], r["rule"], r["n"]) for r in broken.collect()) == [
        ("contacts", "needed name", 1), ("contacts", "parent place_id", 1), ("contacts", "parent run_id", 1), ("contacts", "unique place_id, name, run_id", 1)]


def test_numbers_and_snippets(spark):
    df = spark.createDataFrame([("0044 20 7946 0958", "1 (212) 555-0100"), ("44", None), (None, " 12 ")], "uk string, us string")
    rows = df.select(text.uk_phone(F.col("uk")).alias("uk"), text.us_phone(F.col("us")).alias("us")).collect()
    assert [(r["uk"], *r["us"]) for r in rows] == [("02079460958", "(212) 555-0100", "+12125550100", "2125550100"), ("", "", "", ""), ("", "12", "", "12")]
    long = "a" * 200 + " \n the Roof " + "b" * 200
    r = spark.range(1).select(text.snippet(F.lit(long), "(?i)roof", 5).alias("s"), text.snippet(F.lit("x"), "y").alias("none"), text.nation_of(F.lit("no code")).alias("n"), text.nation_of(F.lit("BT1 1AA then GY1 1AA")).alias("m"),
                              text.tiered(F.lit("old roof"), strong="zz", core=["roof", "tile"], adjacent=["old"], new=["new"]).alias("t")).first()
    assert (r["s"], r["none"], r["n"], r["m"]) == ("the Roof bbbb", "", None, "Guernsey") and tuple(r["t"]) == ("B", 1, 1, 0, "old roof")
