"""Divergence between the term distributions of groups (sources) within a partition (language), in exact integers.

Each partition keeps the V terms that enough of its documents hold. A group gives every kept term
``p = 1 + floor(SCALE * (count + 1) / (N + V))`` with N its counts' sum, absent terms included, and the divergence of p from q is the
sum of ``f(p, q) = floor((p - q)^2 / q)`` over all kept terms.

1. ``term_counts``: tasks count terms and documents of their rows for each group; Spark adds the partial counts.
2. ``measured``: one window by (partition, term) finds documents, totals and groups of a term; group-bys give N and V.
3. ``pair_divergence`` starts from V * f(p0, q0), with p0 and q0 the shares of absent terms, and adds two sums of corrections:

   * heavy terms, held by more than ``HEAVY`` groups: dense numpy tiles of terms by groups, dealt by (block of terms, pair of
     blocks of groups), hold p for every group, and f of all pairs of columns comes from whole matrices;
   * rare terms: a pair of groups that both hold the term is corrected from the term's posting, of ``HEAVY`` groups at most;
     what one group alone changes depends on its p only, so it is added from (group, p, number of terms) histograms.

   All three are integers, so their sum equals the plain sum over terms.

Scale: postings and tiles are bounded by parameters, sums are combined in the tasks before they are shuffled, no term and no
group is gathered. Pairs of groups of a partition are the output, so groups are few enough to be broadcast (by size).

Edge cases: null text, partition and group count as ''; empty tables give no rows; groups without kept terms take part, with
N = 0; without kept terms every value is 0; repeated rows and repeated ids are documents of their own; other columns are
ignored. Very long texts are counted in pieces. Sums must fit in a long, as they do for fewer than a billion kept terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.llm.shared import groups_of, small_keys, written

#: Total of a distribution; least documents of a kept term; groups of a rare term at most; ranks of terms.
SCALE, LEAST_DOCS, HEAVY, TOP = 1_000_000_000, 3, 8, 200
#: Terms and groups of a tile (so 2 MB at most).
TILE_TERMS, TILE_GROUPS = 512, 256
#: Terms held in a task before partial counts leave it; bytes of a piece of a text.
_HELD, _PIECE = 300_000, 1 << 20

#: Terms are runs of ASCII letters and of bytes beyond ASCII; A-Z are lower-cased, all else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded length."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + _PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def term_counts(docs: DataFrame, part_col: str = "lang", group_col: str = "source", text_col: str = "text") -> DataFrame:
    """(part, grp, term, n: occurrences, docs: rows with the term), and a row with a null term for every group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def partial() -> Iterator[pa.RecordBatch]:
            for (part, grp), (n, docs) in found.items():
                terms = list(n)
                for at in range(0, len(terms) + 1, 50_000):
                    some = terms[at: at + 50_000] + [None] * (not at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(some), pa.string()), pa.array([grp] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                         pa.array([n[t] if t is not None else 0 for t in some], pa.int64()), pa.array([docs[t] if t is not None else 0 for t in some], pa.int64())],
                        names=["part", "grp", "term", "n", "docs"])
            found.clear()

        for batch in batches:
            for part, grp, text in zip(batch.column("part").to_pylist(), batch.column("grp").to_pylist(), batch.column("text")):
                n, in_docs = found.setdefault((part, grp), (Counter(), Counter()))
                own: set[bytes] = set()
                for words in pieces(text.as_py()):
                    n.update(words)
                    own.update(words)
                in_docs.update(own)
            if sum(len(n) for n, _ in found.values()) > _HELD:
                yield from partial()
        yield from partial()

    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = docs.select(blank(part_col).alias("part"), blank(group_col).alias("grp"), blank(text_col).cast("binary").alias("text"))
    counted = source.mapInArrow(count, "part string, grp string, term string, n long, docs long")
    return counted.groupBy("part", "grp", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str) -> Column:
    """A term's share of a distribution: 1 + floor(SCALE * (count + 1) / (total + kept)), exact at any size."""
    return F.expr(f"1 + (cast({SCALE} as decimal(20, 0)) * ({count} + 1)) div ({total} + {kept})")


def f(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of two columns of longs."""
    return F.call_function("div", (p - q) * (p - q), q)


def measured(counts: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Kept entries (part, grp, term, n, p, q: the partition's share, groups: of the term) and groups (part, grp, at, p0, kept: V).

    ``counts`` must be a table that can be read again. ``at`` numbers a partition's groups from 0.
    """
    own = Window.partitionBy("part", "term")
    entries = counts.where("term is not null").select(
        "part", "grp", "term", "n", F.sum("docs").over(own).alias("docs"), F.sum("n").over(own).alias("total"), F.count("*").over(own).alias("groups"),
        (F.min("grp").over(own) == F.col("grp")).alias("first")).where(F.col("docs") >= least_docs).drop("docs")
    entries = written(entries, "entries")
    sums = entries.groupBy("part", "grp").agg(F.sum("n").alias("size"), F.sum(F.col("first").cast("long")).alias("terms"))
    groups = counts.where("term is null").select("part", "grp").join(sums, ["part", "grp"], "left").fillna(0, ["size", "terms"])
    whole = Window.partitionBy("part")
    groups = groups.select("part", "grp", "size", (F.row_number().over(whole.orderBy("grp")) - 1).cast("int").alias("at"),
                           F.sum("terms").over(whole).alias("kept"), F.sum("size").over(whole).alias("part_size"))
    groups = written(groups.withColumn("p0", F.when(F.col("kept") > 0, share("0", "size", "kept"))), "groups")
    entries = entries.join(small_keys(groups), ["part", "grp"]).withColumn("p", share("n", "size", "kept")).withColumn("q", share("total", "part_size", "kept"))
    return entries.select("part", "grp", "at", "term", "n", "groups", "p", "p0", "q"), groups


def _shares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def dense_corrections(heavy: DataFrame, groups: DataFrame, tile_terms: int = TILE_TERMS, tile_groups: int = TILE_GROUPS) -> DataFrame:
    """(part, g, h, value): sums of f(p_g, p_h) - f(p0_g, p0_h) over heavy terms, from tiles of terms by groups."""
    sizes = heavy.groupBy("part").agg(F.ceil(F.count_distinct("term") / tile_terms).alias("blocks"))
    wide = groups.groupBy("part").agg(F.ceil(F.count("*") / tile_groups).cast("int").alias("wide"))
    plan = sizes.join(wide, "part")
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    absent = groups.join(small_keys(plan), "part").select("part", "at", F.col("p0").alias("p"), F.lit(None).cast("string").alias("term"), "wide",
                                                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    cells = heavy.join(small_keys(plan), "part").select("part", "at", "p", "term", "wide", block.alias("block")).unionByName(absent)
    cells = cells.withColumn("own", F.floor(F.col("at") / tile_groups).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)))
    cells = cells.select("part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "block", "term", "at", "p")
    order = ["part", "i", "j", "block"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups_of(batches, order):
            term, at, p = tile.column("term").to_pandas(), tile.column("at").to_numpy(), tile.column("p").to_numpy()
            empty = term.isna().to_numpy()
            ids, p0 = at[empty], p[empty]
            by_id = np.argsort(ids)
            ids, p0 = ids[by_id], p0[by_id]
            rows = np.unique(term[~empty].to_numpy(), return_inverse=True)[1]
            matrix = np.repeat(p0[None, :], rows.max() + 1 if len(rows) else 0, axis=0)
            matrix[rows, np.searchsorted(ids, at[~empty])] = p[~empty]
            i, j = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
            first, second = (np.flatnonzero(ids // tile_groups == b) for b in (i, j))
            for g in range(len(ids)):
                for others in ([second] if ids[g] // tile_groups == i else []) + ([first] if i != j and ids[g] // tile_groups == j else []):
                    sums = _shares(matrix[:, g: g + 1], matrix[:, others]).sum(axis=0) - len(matrix) * _shares(p0[g], p0[others])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tile.column("part")[0].as_py()] * len(others), pa.string()), pa.array([int(ids[g])] * len(others), pa.int32()),
                         pa.array(ids[others], pa.int32()), pa.array(sums, pa.int64())], names=["part", "g", "h", "value"])

    dealt = cells.repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(add, "part string, g int, h int, value long").where("g <> h")


def sparse_corrections(rare: DataFrame, groups: DataFrame) -> DataFrame:
    """(part, g, h, value): the same sums over rare terms, from postings and from histograms of single groups."""
    posting = rare.groupBy("part", "term").agg(F.collect_list(F.struct("at", "p", "p0")).alias("held")).where(F.size("held") > 1)
    pairs = posting.select("part", F.explode("held").alias("x"), "held").select("part", "x", F.explode("held").alias("y")).where("x.at <> y.at")
    x, x0, y, y0 = (F.col(c) for c in ("x.p", "x.p0", "y.p", "y.p0"))
    both = pairs.select("part", F.col("x.at").alias("g"), F.col("y.at").alias("h"), (f(x, y) - f(x, y0) - f(x0, y) + f(x0, y0)).alias("value"))
    alone = rare.groupBy("part", "at", "p", "p0").agg(F.count("*").alias("terms"))
    each = alone.join(small_keys(groups.select("part", F.col("at").alias("other"), F.col("p0").alias("q0"))), "part").where("at <> other")
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    one = each.select("part", F.col("at").alias("g"), F.col("other").alias("h"), (F.col("terms") * (f(p, q0) - f(p0, q0))).alias("value"))
    other = each.select("part", F.col("other").alias("g"), F.col("at").alias("h"), (F.col("terms") * (f(q0, p) - f(q0, p0))).alias("value"))
    return both.unionByName(one).unionByName(other)


def pair_divergence(entries: DataFrame, groups: DataFrame, heavy: int = HEAVY, tile_terms: int = TILE_TERMS, tile_groups: int = TILE_GROUPS) -> DataFrame:
    """(part, grp, item: another group of the partition, value) for all pairs; a partition without kept terms has 0.

    Both must be tables that can be read again; ``heavy`` is the number of groups that a rare term has at most.
    """
    named = groups.select("part", "at", "grp", "p0", "kept")
    dense = dense_corrections(entries.where(F.col("groups") > heavy), groups, tile_terms, tile_groups)
    sums = dense.unionByName(sparse_corrections(entries.where(F.col("groups") <= heavy), groups))
    sums = sums.groupBy("part", "g", "h").agg(F.sum("value").alias("value"))
    one = named.select("part", F.col("at").alias("g"), "grp", "p0", "kept")
    other = named.select("part", F.col("at").alias("h"), F.col("grp").alias("item"), F.col("p0").alias("q0"))
    pairs = one.join(small_keys(other), "part").where("g <> h")
    base = F.when(F.col("kept") > 0, F.col("kept") * f(F.col("p0"), F.col("q0"))).otherwise(0)
    return pairs.join(sums, ["part", "g", "h"], "left").select("part", "grp", "item", (base + F.coalesce("value", F.lit(0))).cast("long").alias("value"))


def audit(docs: DataFrame, *, part_col: str = "lang", group_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP,
          heavy: int = HEAVY) -> DataFrame:
    """(partition, group, part, item, value, rank) for every group.

    Part ``pair``: each other group of the partition with the divergence of this group from it, all ranks. Part ``term``: the
    terms that the group holds and uses more than its partition does, with their part of the divergence, ranks to ``top``.
    Ranks start at 1, by value descending, then by item.
    """
    counts = written(term_counts(docs, part_col, group_col, text_col), "counts")
    entries, groups = measured(counts, least_docs)
    entries = written(entries, "shares")
    own = Window.partitionBy("part", "grp").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(own)
    pairs = pair_divergence(entries, groups, heavy).withColumn("rank", rank)
    terms = entries.where("p > q").select("part", "grp", F.col("term").alias("item"), f(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= top)
    out = pairs.withColumn("kind", F.lit("pair")).unionByName(terms.withColumn("kind", F.lit("term")))
    return out.select(F.col("part").alias(part_col), F.col("grp").alias(group_col), F.col("kind").alias("part"), "item", "value", "rank")
