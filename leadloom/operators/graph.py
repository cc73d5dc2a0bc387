"""Connected components and verdicts shared inside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from leadloom.operators.durable import discard, durable, small_side


#: Edges that a task makes into stars at once.
CHUNK_EDGES = 1 << 20


def _roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least node connected with each of the nodes 0 to n - 1."""
    up = np.arange(n)
    while True:
        u, v = up[u], up[v]
        apart = u != v
        if not apart.any():
            return up
        u, v = u[apart], v[apart]
        np.minimum.at(up, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(up, up[up]):
            up = up[up]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, r): each node of a chunk of edges with the least node that the chunk connects it with; so never more links than edges,
    and fewer than nodes, however many edges a node has."""
    def star(chunk: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = pa.concat_arrays([b.column(k) for k in (0, 1) for b in chunk]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends = rank[coded.indices.to_numpy()]
        nodes = coded.dictionary.take(pa.array(order))
        both = pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(_roots(*np.split(ends, 2), len(order))))], names=["x", "r"])
        for low in range(0, both.num_rows, 1 << 16):
            yield both.slice(low, 1 << 16)

    chunk, held = [], 0
    for batch in batches:
        chunk, held = [*chunk, batch], held + batch.num_rows
        if held >= CHUNK_EDGES:
            yield from star(chunk)
            chunk, held = [], 0
    if held:
        yield from star(chunk)


def _to_the_end(links: DataFrame, most: int) -> DataFrame:
    """(n, c): links (n, c) from nodes to lesser ones followed to their end."""
    for _ in range(most):
        after = durable(links.join(small_side(links.select(F.col("n").alias("n2"), F.col("c").alias("c2"))), F.col("c") == F.col("n2"), "left").select(
            "n", F.coalesce("c2", "c").alias("c"), F.col("n2").isNotNull().alias("changed")), "links")
        discard(links)
        links = after
        if links.where("changed").isEmpty():
            return links
    raise RuntimeError(f"links did not end in {most} rounds")


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges; the component is its least node.

    Each round, tasks make their chunks of edges into stars around their least nodes, and a node is hooked to the least of its
    stars' centres; its other centres become linked with that one. Hooked nodes then leave the graph, their links going to where
    hooks end, so that the nodes halve in two rounds at least, mostly much faster, and edges are shuffled once a round, in one
    direction. A node has a row for each chunk at most, so one with many neighbours is no bottleneck. Self-links, repeats and both
    directions are fine; no edges give no nodes.
    """
    links = edges.select(F.col(a).alias("x"), F.col(b).alias("r")).where("x is not null and r is not null")
    kind = T.StructType([T.StructField(c, links.schema["x"].dataType) for c in ("x", "r")])
    by_centre = Window.partitionBy("x").orderBy("r")
    rounds = []
    while True:
        stars = links.mapInArrow(_stars, kind).withColumns({"h": F.first("r").over(by_centre), "last": F.lag("r").over(by_centre)})
        hooked = durable(stars.where("last is null or last <> r").drop("last"), "hooks")
        ends = _to_the_end(durable(hooked.where("r = x and h < x").select(F.col("x").alias("n"), F.col("h").alias("c")), "links"), max_rounds)
        rounds.append((hooked, ends))
        links = hooked.where("r <> h and r <> x")
        if links.isEmpty():
            break
        if len(rounds) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        to = small_side(ends.select("n", "c"))
        links = links.select("h", "r").join(to, F.col("h") == F.col("n"), "left").select(F.coalesce("c", "h").alias("x"), "r")
        links = links.join(to, F.col("r") == F.col("n"), "left").select("x", F.coalesce("c", "r").alias("r")).where("x <> r")
    found = None
    for hooked, ends in reversed(rounds):
        to = ends.select("n", "c")
        if found is not None:  # where hooks end, and from there by the rounds after
            later = found
            to = to.join(small_side(later.select(F.col("node").alias("n2"), "component")), F.col("c") == F.col("n2"), "left").select("n", F.coalesce("component", "c").alias("c")).unionByName(
                later.where("component < node").select(F.col("node").alias("n"), F.col("component").alias("c")))
        to = durable(to, "ends")
        known = durable(hooked.where("r = h").join(small_side(to), F.col("h") == F.col("n"), "left").select(F.col("x").alias("node"), F.coalesce("c", "h").alias("component")), "labels")
        discard(hooked, ends, to, *([found] if found is not None else []))
        found = known
    return found


def shared_edges(df: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """Edges (a, b) between each row and the least row with the same non-blank key, for each key column."""
    out = None
    for key in keys:
        rows = df.where(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "").select(F.col(key).cast("string").alias("k"), F.col(row_id).alias("b"))
        edges = rows.join(rows.groupBy("k").agg(F.min("b").alias("a")), "k").select("a", "b")
        out = edges if out is None else out.unionByName(edges)
    return out


def reconcile(members: DataFrame, component: str, row_id: str, verdict: str, best_first: list[str]) -> DataFrame:
    """``members`` with the component's best verdict and its donor (the first member that has it)."""
    rank = F.coalesce(*[F.when(F.col(verdict) == v, F.lit(i)) for i, v in enumerate(best_first)], F.lit(len(best_first)))
    best = members.groupBy(component).agg(F.min(F.struct(rank.alias("rank"), F.col(row_id).alias("donor"), F.col(verdict).alias("group_verdict"))).alias("m"))
    return members.join(best.select(component, "m.group_verdict", "m.donor"), component)
