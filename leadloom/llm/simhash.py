"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a self-join over their binary trie.

1. ``fingerprints``: every shingle (repeats included) votes with the bits of its XXH64; a bit of the fingerprint is 1 where
   more than half the hashes have it. Equal fingerprints form a class, and one row of the class goes on.
2. ``trie_join``: pairs of trie nodes are traversed together from the root, four levels in a round. A pair's children keep the
   bits in which they differ so far, and a pair above the budget is pruned with all below it. Nodes are counted each round;
   a pair whose nodes hold few fingerprints is closed, others are split on, so a dense part of the trie goes deeper.
3. Each closed pair is one row with the fingerprints of its two nodes, and a task goes on through their subtries bit by bit,
   for all node pairs of a level at once. Only a forest of the links found leaves the task.

All pairs of fingerprints within the budget are found; none is capped. A fingerprint is sent to the closed pairs of its node,
at most 1 + d + d(d-1)/2 of them at depth d (137 at depth 16). A node holds at most max(4096, classes / 65536) fingerprints, so
there are some 65,536 nodes at any size, and one fingerprint has at most 2,080 others within two bits.

Edge cases: null, empty and blank texts have the fingerprint zero and link like any other; fewer words than a shingle are
one shingle; rows of one id are separate rows that share what they reach; a null id has a null component and links nothing;
an empty table gives an empty result; other columns are ignored. Very long texts are hashed in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from leadloom.llm.shared import small_keys, written
from leadloom.operators.graph import connected_components

WORDS = 3
SEED = 42
#: Most differing bits of a link.
BITS = 2
#: Levels of the trie in a round, least bound of a node's fingerprints, and nodes at any size.
STEP, NODE_ROWS, NODES = 4, 4096, 65_536
#: Shingles hashed at once; node pairs held at once; fingerprint pairs below which a node pair is compared directly.
_PART, _FRONT, _DIRECT = 1 << 16, 1 << 18, 32

_U = np.uint64


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    return bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number (A-Z lower-cased, words end at ASCII spaces)."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined, size = b" ".join(found), min(words, len(found))
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _PART):
        pairs = zip(starts[at: at + _PART], ends[at: at + _PART])
        total += _set_bits(np.array([digest(joined[a:b], seed) for a, b in pairs], dtype=_U))
    return int(np.packbits(2 * total > len(starts), bitorder="little").view(_U)[0])


def fingerprints(docs: DataFrame, *, words: int = WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint: the 64 bits as a signed long) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words, seed) for t in batch.column("text")], dtype=_U).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], names=["id", "fingerprint"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(sign, "id long, fingerprint long")


def _prefix(column: Column | str, depth: int) -> Column:
    return F.shiftrightunsigned(column, 64 - depth)


def closed_pairs(classes: DataFrame, most: int, bits: int) -> DataFrame:
    """(depth, a, b, differing) of the node pairs that the traversal ends with, a <= b; nodes hold ``most`` fingerprints or fewer."""
    spark = classes.sparkSession
    pairs = spark.createDataFrame([(0, 0, 0, 0)], "depth int, a long, b long, differing int")
    closed = None
    for depth in range(STEP, 65, STEP):
        open_nodes = pairs.select(F.explode(F.array("a", "b")).alias("above")).distinct()
        nodes = classes.groupBy(_prefix("fingerprint", depth).alias("node")).agg(F.count("*").alias("rows"))
        above = F.shiftrightunsigned("node", STEP) if depth > STEP else F.lit(0).cast("long")
        nodes = written(nodes.withColumn("above", above).join(small_keys(open_nodes), "above", "left_semi"), "nodes")
        one = nodes.select(F.col("above").alias("a"), F.col("node").alias("a2"), F.col("rows").alias("a_rows"))
        other = nodes.select(F.col("above").alias("b"), F.col("node").alias("b2"), F.col("rows").alias("b_rows"))
        differing = F.col("differing") + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")).bitwiseAND(F.lit((1 << STEP) - 1)))
        below = pairs.join(one, "a").join(other, "b").where((differing <= bits) & ((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2"))))
        below = written(below.select(F.lit(depth).alias("depth"), F.col("a2").alias("a"), F.col("b2").alias("b"), differing.cast("int").alias("differing"),
                                     ((F.col("a_rows") <= most) & (F.col("b_rows") <= most)).alias("ends")), "pairs")
        ended = below.where("ends").drop("ends")
        closed = ended if closed is None else closed.unionByName(ended)
        pairs = below.where("not ends").drop("ends")
        if pairs.isEmpty():
            break
    return closed


def _zeros(values: np.ndarray, shift: int) -> np.ndarray:
    """Running counts of the values without the bit."""
    return np.concatenate(([0], np.cumsum((values >> _U(shift)) & _U(1) == 0)))


def links(a: np.ndarray, b: np.ndarray, same: bool, depth: int, differing: int, bits: int) -> Iterator[np.ndarray]:
    """Rows of (value of a, value of b) within ``bits``, of two sorted subtries at ``depth`` whose prefixes differ in ``differing`` bits.

    A node is a range of the sorted values; its children begin where the next bit turns to one.
    """
    cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    stack = [(depth, np.array([[0], [len(a)], [0], [len(b)], [differing], [same]], dtype=np.int64))]
    while stack:
        depth, front = stack.pop()
        direct = (front[1] - front[0]) * (front[3] - front[2]) <= _DIRECT if depth < 64 else np.ones(front.shape[1], dtype=bool)
        if direct.any():
            a0, a1, b0, b1, _, own = front[:, direct]
            size = (a1 - a0) * (b1 - b0)
            row = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            width = np.repeat(b1 - b0, size)
            i, j = np.repeat(a0, size) + row // width, np.repeat(b0, size) + row % width
            near = (np.bitwise_count(a[i] ^ b[j]) <= bits) & ((np.repeat(own, size) == 0) | (i < j))
            if near.any():
                yield np.stack((a[i[near]], b[j[near]]), axis=1)
        a0, a1, b0, b1, err, own = front[:, ~direct]
        if not len(a0):
            continue
        if depth not in cuts:
            cuts[depth] = (_zeros(a, 63 - depth), _zeros(b, 63 - depth))
        za, zb = cuts[depth]
        am, bm = a0 + za[a1] - za[a0], b0 + zb[b1] - zb[b0]
        kids = np.concatenate([
            np.stack((a0, am, b0, bm, err, own)), np.stack((am, a1, bm, b1, err, own)),
            np.stack((a0, am, bm, b1, err + 1, 0 * own)), np.stack((am, a1, b0, bm, err + 1, 0 * own))[:, own == 0]], axis=1)
        kids = kids[:, (kids[4] <= bits) & (kids[1] > kids[0]) & (kids[3] > kids[2])]
        for at in range(0, kids.shape[1], _FRONT):
            stack.append((depth + 1, kids[:, at: at + _FRONT]))


def trie_join(classes: DataFrame, bits: int = BITS, node_rows: int | None = None) -> DataFrame:
    """Forest edges (a, b) that connect all pairs of distinct ``fingerprint`` values within ``bits`` of each other.

    ``classes`` must be a table that can be read again. ``node_rows`` bounds the fingerprints of a node.
    """
    most = node_rows or max(NODE_ROWS, classes.count() // NODES)
    closed = written(closed_pairs(classes, most, bits), "closed")
    used = closed.select("depth", F.explode(F.array("a", "b")).alias("node")).distinct()
    depths = [r["depth"] for r in closed.select("depth").distinct().collect()]  # 16 at most
    if not depths:
        return classes.sparkSession.createDataFrame([], "a long, b long")
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix("fingerprint", d).alias("node")) for d in sorted(depths)]))
    held = classes.select("fingerprint", each.alias("at")).select("fingerprint", "at.*").join(small_keys(used), ["depth", "node"])
    nodes = written(held.groupBy("depth", "node").agg(F.sort_array(F.collect_list("fingerprint")).alias("values")), "subtries")
    rows = closed.join(nodes.select("depth", F.col("node").alias("a"), F.col("values").alias("of_a")), ["depth", "a"]).join(
        nodes.select("depth", F.col("node").alias("b"), F.col("values").alias("of_b")), ["depth", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                of = [np.sort(batch.column(c)[k].values.to_numpy().view(_U)) for c in ("of_a", "of_b")]
                same, parent = batch.column("a")[k] == batch.column("b")[k], {}

                def top(x: int) -> int:
                    while (up := parent.setdefault(x, x)) != x:
                        parent[x] = x = parent.setdefault(up, up)
                    return x

                found = []
                for some in links(*of, same, batch.column("depth")[k].as_py(), batch.column("differing")[k].as_py(), bits):
                    for x, y in some.view(np.int64).tolist():
                        if (p := top(x)) != (q := top(y)):
                            parent[p] = q
                            found.append((x, y))
                a, b = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.select("depth", "a", "b", "differing", "of_a", "of_b").mapInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, *, words: int = WORDS, seed: int = SEED, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text",
                    node_rows: int | None = None) -> DataFrame:
    """(id, fingerprint: 16 lowercase hex digits, component_id: the least id that links reach, itself included) of every row."""
    signed = written(fingerprints(docs, words=words, seed=seed, id_col=id_col, text_col=text_col), "simhashes")
    classes = written(signed.where("id is not null").groupBy("fingerprint").agg(F.min("id").alias("first_id")), "classes")
    labels = connected_components(trie_join(classes, bits, node_rows), "a", "b").withColumnRenamed("node", "fingerprint")
    linked = written(classes.join(labels, "fingerprint"), "linked")
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    reached = linked.join(least, "component").select("fingerprint", "least_id")
    by_class = classes.join(small_keys(reached), "fingerprint", "left").select("fingerprint", F.coalesce("least_id", "first_id").alias("component_id"))
    found = signed.join(by_class, "fingerprint", "left")
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
