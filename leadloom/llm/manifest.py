"""Merkle manifest of a dataset: a node store in Parquet, one folder for each level, and inclusion proofs by coordinate.

Rows become leaves (a digest of chosen columns); every tree (say, a language) orders its leaves and hashes runs of eight
nodes to the next level until one node is left, its subroot; the subroots, in the order of their trees, form a top tree whose
last node is the root.

1. ``write_manifest`` sorts narrow (tree, key, digest) rows into runs by range partitions, and counts of the runs give every
   leaf its coordinate (tree, pos). Level 0 is written in that order; each further level is one scan of the level before, whose
   nodes meet by (tree, pos div 8), and is an eighth of it. Texts are read once and never shuffled.
2. ``proofs`` goes down from the root: a node's path (the siblings beside it at each level) is its parent's path and its own
   siblings, which the parent's row holds. Each step is a merge join of two levels on the coordinate; a path is shipped to
   groups of eight leaves, never to single ones.
3. ``fold`` recomputes the root from a leaf and its path, so a changed row shows without reading any other row.

Scale: every shuffle is on coordinates, so it is even whatever the sizes of trees; the driver holds the root and the number
of levels. A level is a written table, so a lost executor repeats a part of one level.

Edge cases: null fields and null keys are values of their own (a null key sorts first); repeated keys are ordered by their
digests, and rows equal in both have equal results (they meet in one run); a null tree is a tree of its own, before all
others; a lone leaf is its tree's subroot, and a lone subroot the root; no rows give no root, and no proofs. Columns named
like the store's own (``tree pos n digest children path``) may not ride along (``carry``); others are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.llm.shared import scratch_folder, small_keys, written

#: Nodes of a run.
FAN = 8


def digest_of(*values: Column | str) -> Column:
    """Lowercase hex SHA-256 of the columns in order: ``-`` for null, else the value's UTF-8 byte count, ``:`` and the value."""
    texts = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def joined_digest(digests: Column) -> Column:
    """SHA-256 of an array's hex digests, as text, in order."""
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


class Manifest(NamedTuple):
    """The levels of the trees and of the top tree, each a written table, where they lie, and the root (None without rows).

    Nodes have tree, pos, n (the tree's nodes at this level) and digest; leaves also key and carried columns, others children.
    """

    path: str
    levels: list[DataFrame]
    tops: list[DataFrame]
    root: str | None


def tree_name(column: Column | str) -> Column:
    """A value's name in the store: null sorts before all others and differs from the empty text."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))


def _placed(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (tree, key, digest, more) with pos, from 0 in the order of key and digest within the tree, and n, the tree's rows."""
    order = ["tree", key, "digest"]
    runs = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "runs")
    runs = runs.withColumn("__run", F.shiftright("__at", 33))
    sizes = runs.groupBy("__run", "tree").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("__rows").over(own.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__run", "tree", (before - F.col("__first")).alias("__shift"), F.sum("__rows").over(own).alias("n"))
    placed = runs.join(small_keys(starts), ["__run", "tree"]).withColumn("pos", F.col("__at") + F.col("__shift"))
    return placed.drop("__at", "__run", "__shift").sortWithinPartitions("tree", "pos")


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _write_levels(leaves: DataFrame, path: str) -> list[DataFrame]:
    """The written levels, from the leaves up."""
    levels = [_stored(leaves, f"{path}/level=0")]
    most = levels[0].agg(F.max("n")).first()[0] or 1
    while most > 1:
        runs = levels[-1].where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("pos")).agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "digest")))["digest"].alias("children"))
        above = runs.select("tree", "pos", F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), joined_digest(F.col("children")).alias("digest"), "children")
        levels.append(_stored(above.sortWithinPartitions("tree", "pos"), f"{path}/level={len(levels)}"))
        most = -(-most // FAN)
    return levels


def write_manifest(leaves: DataFrame, *, tree: str | Column, key: str, digest: str, carry: tuple[str, ...] = (), path: str | None = None) -> Manifest:
    """Write the node store of ``leaves`` to a new folder ``path`` (one of the shared folder if None, deleted when the driver ends).

    ``leaves`` should be a written table: it is read twice, to find the ranges and to sort. Leaves keep ``key`` and ``carry``.
    """
    path = path or scratch_folder(leaves.sparkSession, "manifest")
    rows = leaves.select(tree_name(tree).alias("tree"), key, F.col(digest).alias("digest"), *carry)
    levels = _write_levels(_placed(rows, key), f"{path}/trees")
    ends = None
    for nodes in levels:
        found = nodes.where("n = 1").select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
        ends = found if ends is None else ends.unionByName(found)
    tops = _write_levels(_placed(ends, "of"), f"{path}/top")
    root = tops[-1].where("n = 1").select("digest").first()
    return Manifest(path, levels, tops, root and root["digest"])


def _beside(children: Column, at: Column) -> Column:
    """The digests left and right of one child, each joined to a text."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), at), "").alias("left"),
                    F.array_join(F.slice(children, at + 2, F.lit(FAN)), "").alias("right"))


def _with_paths(levels: list[DataFrame], start: DataFrame) -> DataFrame:
    """Leaves with ``path`` and the other columns of ``start`` (tree, path, ...), which holds each tree's path above its last node."""
    more = [c for c in start.columns if c not in ("tree", "path")]
    paths = None
    for k in range(len(levels) - 1, 0, -1):
        nodes = levels[k]
        ended = nodes.where("n = 1").join(start, "tree").select("tree", "pos", "children", "path", *more)
        if paths is not None:
            ended = ended.unionByName(nodes.where("n > 1").join(paths, ["tree", "pos"]).select("tree", "pos", "children", "path", *more))
        if k == 1:
            paths = ended
        else:
            child = ended.select("tree", F.col("pos").alias("above"), F.posexplode("children").alias("at", "child"), "children", "path", *more)
            paths = child.select("tree", (F.col("above") * FAN + F.col("at")).alias("pos"), F.concat(F.array(_beside(F.col("children"), F.col("at"))), "path").alias("path"), *more)
    leaves = levels[0]
    lone = leaves.where("n = 1").join(start, "tree")
    if paths is None:
        return lone
    under = leaves.where("n > 1").withColumn("above", F.expr(f"pos div {FAN}")).join(paths.withColumnRenamed("pos", "above"), ["tree", "above"])
    at = (F.col("pos") % FAN).cast("int")
    return lone.unionByName(under.withColumn("path", F.concat(F.array(_beside(F.col("children"), at)), "path")).drop("above", "children"))


def proofs(store: Manifest) -> DataFrame:
    """Each leaf (tree, pos, n, digest, key, carried columns) with its tree's ``subroot`` and its ``path``: for each level, from
    the leaf up to the root, the digests to the left and to the right of the node on the way (empty texts where it has none)."""
    nowhere = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    whole = store.tops[-1].where("n = 1").select("tree").withColumn("path", nowhere)
    tops = _with_paths(store.tops, whole)
    start = written(tops.select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot")), "tops")
    return _with_paths(store.levels, small_keys(start))


def path_digest(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root as a leaf digest and its path give it."""
    return F.aggregate(path, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]).cast("binary"), 256))
