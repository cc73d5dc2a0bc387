"""Written tables, their folder, and the size check of broadcasts."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from leadloom.operators import durable, graph


def test_cluster_needs_a_shared_folder():
    session = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(RuntimeError):
        durable.shared_dir(session("spark://host:7077", None))
    assert durable.shared_dir(session("spark://host:7077", "s3://x/y")) == "s3://x/y"
    assert durable.shared_dir(session("local[4]", None)).startswith("file://")


def test_discard_deletes_the_files(spark):
    table = durable.durable(spark.range(5), "t")
    assert table.count() == 5
    durable.discard(table)
    where, files = durable._path(spark, table.durable_path)
    assert not files.exists(where)


def test_broadcast_goes_by_bytes(spark):
    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.array("id", "id").alias("a"))
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hinted(durable.small_side(rows)) and not hinted(durable.small_side(rows, 90_000))
    assert hinted(durable.small_side(rows.drop("t"), 90_000)) and hinted(durable.small_side(rows.limit(0)))


def test_components_of_stars_and_chains(spark):
    edges = spark.range(300).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b")).unionByName(
        spark.range(2000, 2100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    got = {r["node"]: r["component"] for r in graph.connected_components(edges, "a", "b").collect()}
    assert got[1000] == 0 and got[299] == 0 and {got[k] for k in range(2000, 2101)} == {2000}
