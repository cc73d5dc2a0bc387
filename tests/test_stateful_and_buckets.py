"""Streams with state, the bucketed store, and scans of long runs: against the batch operators and plain loops."""

import random
from datetime import datetime, timedelta
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from leadloom.operators import lines, segments
from leadloom.sources.buckets import BucketStore, Conflict
from leadloom.streaming import incremental, stateful


@pytest.fixture
def folders(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # a state store for each partition and run
    yield [str(tmp_path / x) for x in ("in", "out", "ck", "table", "ck2")]
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def parted(spark):
    """Small tables keep their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def event_parts(spark, sf, n=3):
    e = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts", "event_id", "event_type", "value")
    return [e.where(F.col("event_id") % n == k) for k in range(n)]


def test_last_wins_equals_upserts_and_restarts(spark, sf, folders):
    src, out, ck, table, ck2 = folders
    parts = event_parts(spark, sf)
    schema = parts[0].schema
    stream = lambda: incremental.stream_folder(spark, src, schema)
    retry = F.col("event_type") == "error"
    for part in (parts[2], parts[0].unionByName(parts[1])):  # later events come first
        part.coalesce(1).write.mode("append").parquet(src)
        changes = stateful.write_changes(stateful.last_wins(stream(), ["user_id"], "ts", retry=retry), out, ck)
        want = incremental.upsert_stream(stream(), ["user_id"], "ts", table, ck2, retry=retry)
        held = stateful.current(spark, ck, "last")
        assert held.select(want.columns).exceptAll(want).isEmpty() and want.exceptAll(held.select(want.columns)).isEmpty()
    n = changes.count()
    assert stateful.write_changes(stateful.last_wins(stream(), ["user_id"], "ts", retry=retry), out, ck).count() == n  # nothing new
    assert n > want.count()


def test_last_wins_of_odd_records(spark, folders):
    src, out, ck, *_ = folders
    schema = "k string, o int, v string"
    spark.createDataFrame([("a", None, "x"), ("a", 1, None), ("a", 1, "b"), ("b", None, None), (None, 9, "n")], schema).coalesce(1).write.parquet(src)
    changes = stateful.last_wins(incremental.stream_folder(spark, src, schema), ["k"], "o", forget=timedelta(days=365))
    assert {tuple(r) for r in stateful.write_changes(changes, out, ck, idle_batches=False).collect()} == {("a", 1, "b"), ("b", None, None)}


def test_due_after_equals_the_table(spark, sf, folders):
    src, out, ck, table, ck2 = folders
    schema = event_parts(spark, sf)[0].schema
    e = spark.read.parquet(f"{sf}/events.parquet").select(schema.names)
    stream = lambda: incremental.stream_folder(spark, src, schema)
    for low, high in ((1, 8), (8, 16), (16, 32)):
        e.where((F.dayofmonth("ts") >= low) & (F.dayofmonth("ts") < high)).coalesce(1).write.mode("append").parquet(src)
        got = stateful.write_changes(stateful.due_after(stream(), "user_id", "ts", timedelta(days=5)), out, ck)
        want = incremental.due_after(stream(), "user_id", "ts", "5 DAYS", table, ck2)
    last = got.groupBy("user_id").agg(F.max_by("at", "checks").alias("verified_at"), F.max("checks").alias("checks"))
    assert last.exceptAll(want).isEmpty() and want.exceptAll(last).isEmpty() and want.agg(F.max("checks")).first()[0] > 1


def test_results_expire(spark, folders):
    src, out, ck, *_ = folders
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    for rows in ([("a", day(0)), ("b", day(1))], [("a", day(3)), ("c", day(9))], [("a", day(10)), ("c", day(30))], [("c", day(31))]):
        spark.createDataFrame(rows, "k string, t timestamp").coalesce(1).write.mode("append").parquet(src)
        stream = incremental.stream_folder(spark, src, "k string, t timestamp")
        got = stateful.write_changes(stateful.due_after(stream, "k", "t", timedelta(days=5), late="1 day"), out, ck)
    found = {(r["k"], r["event"], (r["at"] - day(0)).days, r["checks"]) for r in got.collect()}
    assert {x for x in found if x[1] == "checked"} == {("a", "checked", 0, 1), ("b", "checked", 1, 1), ("c", "checked", 9, 1), ("a", "checked", 10, 2), ("c", "checked", 30, 2)}
    assert {("b", "expired", 6, 1), ("a", "expired", 15, 2)} <= {x for x in found if x[1] == "expired"}


def plain_stalls(rows, least):
    out = []
    for run, of_run in groupby(sorted(r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for total, spell in groupby(of_run, key=lambda r: r[2]):
            spell = list(spell)
            if len(spell) > least:
                out.append((run, total, len(spell) - 1, spell[0][1], spell[-1][1]))
    return sorted(out)


def test_stalls_in_both_modes(spark, folders):
    src, out, ck, *_ = folders
    rng = random.Random(4)
    rows = [("five", k, v) for k, v in enumerate([5, 5, 3, 5, 5])] + [(f"r{k % 3}", k, rng.choice([1, 2])) for k in range(300)] + [("long", k, k // 40) for k in range(900)]
    schema = "run string, o int, total int"
    batch = incremental.stalls(spark.createDataFrame(rows, schema), "run", "total", "o", 1)
    assert sorted(map(tuple, batch.collect())) == plain_stalls(rows, 1)
    assert [r for r in plain_stalls(rows, 1) if r[0] == "five"] == [("five", 5, 1, 0, 1), ("five", 5, 1, 3, 4)]
    for low, high in ((0, 2), (2, 150), (150, 1000)):
        spark.createDataFrame([r for r in rows if low <= r[1] < high], schema).coalesce(1).write.mode("append").parquet(src)
        got = stateful.write_changes(stateful.stalls(incremental.stream_folder(spark, src, schema), "run", "total", "o", 1), out, ck)
    told = got.groupBy("run", "since").agg(F.max(F.struct("frozen", "total", "until")).alias("m")).select("run", "m.total", "m.frozen", "since", "m.until")
    assert sorted(map(tuple, told.collect())) == plain_stalls(rows, 1)


# --- the bucketed store --------------------------------------------------------------------------------------------------

def test_small_batches_touch_few_buckets(spark, tmp_path):
    rows = spark.range(5000).select("id", F.lit(0).alias("o"), F.lit("old").alias("v"), F.lit(None).cast("string").alias("w"))
    store = BucketStore.create(spark, str(tmp_path / "s"), rows.schema, ["id"], "o", buckets=200)
    assert store.read().count() == 0
    assert len(store.upsert(rows)) == 200
    batch = spark.range(2, 5000, 2500).select("id", F.lit(1).alias("o"), F.lit("new").alias("v"), F.lit("x").alias("w"))
    touched = store.upsert(batch)
    before, now = store.manifest(1).held, store.manifest(2).held
    assert len(touched) <= 2 and {b for b in now if now[b] != before[b]} == {str(b) for b in touched}
    assert store.read().where("v = 'new'").count() == 2 and store.read().count() == 5000
    assert store.read(1).where("v = 'new'").count() == 0  # the version before is whole
    asked = store.lookup(spark.createDataFrame([(2,), (7,), (99_999,)], "id long"))
    assert {(r["id"], r["v"]) for r in asked.collect()} == {(2, "new"), (7, "old")} and len(asked.inputFiles()) <= 6
    assert store.upsert(batch.limit(0)) == [] and store.versions() == [0, 1, 2]


def test_store_equals_plain_upserts(spark, tmp_path):
    rng = random.Random(2)
    schema = "a string, b int, o int, v string, first string"
    empty = spark.createDataFrame([], schema)
    store = BucketStore.create(spark, str(tmp_path / "s"), empty.schema, ["a", "b"], "o", buckets=7)
    held = {}
    least = lambda x: (x is not None, x)
    for n in range(5):
        rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]), rng.choice([None, *range(20)]), rng.choice(["p", "gone", None]), f"f{n}") for _ in range(25)]
        store.upsert(spark.createDataFrame(rows, schema).select("v", "o", "b", "a", "first"), keep=["first"], delete=F.col("v") == "gone")
        best = {}
        for a, b, o, v, f in rows:
            best[a, b] = max(best.get((a, b), (None, None, None)), (o, v, f), key=lambda r: tuple(map(least, r)))
        for k, (o, v, f) in best.items():
            old = held.get(k)
            row = (o, v, f) if old is None or least(o) >= least(old[0]) else old
            held[k] = (*row[:2], old[2] if old is not None else f)
            if held[k][1] == "gone":
                del held[k]
        assert {(r["a"], r["b"]): (r["o"], r["v"], r["first"]) for r in store.read().collect()} == held


def test_crashes_and_conflicts_leave_one_whole_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    rows = spark.range(50).select("id", F.lit(1).alias("o"), F.lit("a").alias("v"))
    store = BucketStore.create(spark, path, rows.schema, ["id"], "o", buckets=4)
    store.upsert(rows, stream="in", number=0)
    with monkeypatch.context() as m:  # dies after its files, before its manifest
        m.setattr(BucketStore, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.upsert(rows.withColumn("v", F.lit("half")), stream="in", number=1)
    again = BucketStore.open(spark, path)
    assert {r["v"] for r in again.read().collect()} == {"a"}
    other = again.manifest()
    again.upsert(rows.withColumn("v", F.lit("b")), stream="in", number=1)
    assert again.upsert(rows.withColumn("v", F.lit("twice")), stream="in", number=1) == []
    monkeypatch.setattr(BucketStore, "manifest", lambda self, version=None: other)
    with pytest.raises(Conflict):  # a writer that began before the last version
        store.upsert(rows.withColumn("v", F.lit("late")))
    monkeypatch.undo()
    assert {r["v"] for r in again.read().collect()} == {"b"}
    assert len(again.vacuum(1)) == 3 and again.versions() == [2] and again.read().count() == 50
    with pytest.raises(ValueError):
        BucketStore.create(spark, path, rows.schema, ["id"], "o")
    with pytest.raises(ValueError):
        again.upsert(rows.drop("v"))


def test_stream_into_the_store(spark, sf, tmp_path, folders):
    src, out, ck, table, ck2 = folders
    parts = event_parts(spark, sf)
    store = BucketStore.create(spark, str(tmp_path / "s"), parts[0].schema, ["user_id"], "ts", buckets=8)
    for part in (parts[0].unionByName(parts[1]), parts[2]):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = incremental.stream_folder(spark, src, parts[0].schema)
        got = store.fold(stateful.last_wins(stream, ["user_id"], "ts"), ck, "events", mode="update")
    want = incremental.upsert_stream(incremental.stream_folder(spark, src, parts[0].schema), ["user_id"], "ts", table, ck2)
    assert got.select(want.columns).exceptAll(want).isEmpty() and want.exceptAll(got.select(want.columns)).isEmpty()


# --- scans of long runs --------------------------------------------------------------------------------------------------

def test_scans_equal_plain_loops(spark, parted):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None, "c"]), k, rng.choice([None, None, rng.randrange(9)])) for k in range(2000)]
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(5)
    got = segments.scanned(df, ["k"], ["o"], last={"last": F.col("v")}, before={"was": F.col("v")}, sums={"total": F.col("v"), "n": F.lit(1)})
    assert got.rdd.getNumPartitions() > 1
    want, last, was, total, n = [], {}, {}, {}, {}
    for k, o, v in rows:
        last[k] = v if v is not None else last.get(k)
        total[k], n[k] = total.get(k, 0) + (v or 0), n.get(k, 0) + 1
        want.append((o, k, v, last[k], was.get(k), total[k], n[k]))
        was[k] = v
    assert sorted((r["o"], r["k"], r["v"], r["last"], r["was"], r["total"], r["n"]) for r in got.collect()) == want
    assert segments.scanned(df.limit(0), ["k"], ["o"], last={"last": F.col("v")}, sums={"n": F.lit(1)}).count() == 0


def test_one_register_in_many_parts(spark, parted):
    """A register of one file, with headers that move, wrapped rows and blank lines, spans all partitions."""
    rng, out, want = random.Random(8), [], []
    for page in range(60):
        shift = rng.randrange(4)
        out += ["", " " * shift + "NAME      PLACE     NUMBER"]
        for k in range(rng.randrange(1, 6)):
            name, number = f"n{page}x{k}", str(rng.randrange(1000, 9999))
            out.append(" " * shift + f"{name:<10}{'town':<10}{number}")
            record = {"NAME": [name], "PLACE": ["town"], "NUMBER": [number]}
            if rng.random() < 0.4:
                out.append(" " * shift + f"{'more':<10}{'':<10}")
                record["NAME"].append("more")
            want.append(record)
            if rng.random() < 0.3:
                out += ["", " " * shift + f"{'stray':<10}"]
    rows = spark.createDataFrame([("f", i, t) for i, t in enumerate(out)], "file string, line_no int, line string")
    got = lines.fixed_width_records(rows, "file", ["NAME", "PLACE", "NUMBER"], F.col("cells.NUMBER").rlike("^[0-9]+$"))
    assert [r["fields"] for r in got.orderBy("record").collect()] == want
