"""Near-duplicates: MinHash signatures, a multi-index Hamming join, and exact confirmation on full shingle sets.

1. Each text becomes its set of distinct word shingles and a signature of 32 symbols (16 bits of a MinHash each).
   Texts with equal sets form a class; one representative goes on.
2. Signatures are split into 8 chunks of 4 symbols. Two signatures that differ in at most 15 symbols differ in at most
   one symbol of some chunk (8 * 2 - 1 = 15). For each chunk, every allowed error position is enumerated: the other
   three symbols make a key. So all pairs within distance 15 meet under a key. At a similarity of 0.85 a pair differs in
   more than 15 of 32 symbols with a probability near 3e-6 (1e-4 at 0.8), and only then can it be missed.
3. Under each key, members within the distance whose sizes allow the similarity, and whose sketches (8 bits each of 128
   further MinHashes) do not speak against it, are joined to a forest (no pair list leaves the task). The sketch rules out
   a pair at the similarity with a probability near 1e-5, and nearly all pairs that are 0.2 below it, so texts that only
   resemble each other do not chain. The forests' components are clusters, and in each cluster the exact overlaps of full
   sets decide the links.

Scale: (key, id) rows are 32 for each class; only keys with two members or more go on. A key or cluster of many members
is dealt to tasks by pairs of blocks, so no group gathers in one task and none is capped. Sets are made again for
members of clusters only. Components are found by distributed minimum labels.

Edge cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have no shingles and link
to nothing; rows of one id count as one document; null ids are their own, with a null component; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadloom.llm.hashing import SKETCH, SYMBOLS, constants, mix, shingles_of, span_hashes, word_bounds
from leadloom.llm.shared import fresh_prefix, groups_of, small_keys, written
from leadloom.operators.graph import connected_components

WORDS = 5
PERCENT = 85
#: Similarity from which a filter drops a document as a near-duplicate.
FILTER_PERCENT = 80
CHUNKS = 8
WIDTH = SYMBOLS // CHUNKS
DISTANCE = CHUNKS * 2 - 1
#: Standard deviations below the similarity at which a sketch rules a pair out.
SKETCH_DEVIATIONS = 4.5
#: Members and set bytes of a block.
BLOCK_ROWS = 1024
BLOCK_BYTES = 24_000_000

_U = np.uint64


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (A-Z lower-cased, words end at ASCII spaces)."""
    raw = np.frombuffer((text or "").encode().lower(), dtype=np.uint8)
    starts, ends = word_bounds(raw)
    if not len(starts):
        return np.empty(0, dtype=_U)
    return np.unique(shingles_of(span_hashes(raw, starts, ends), words))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The mixed minimum under each hash function, signature first, then sketch."""
    factors = constants()[3][:, None]
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=_U)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[None, at: at + 512] * factors).min(axis=1), out=least)
    return mix(least)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the minimum under each hash function."""
    return (minima(shingles)[:SYMBOLS] >> _U(48)).astype(np.uint16)


def least_agreement(percent: int) -> int:
    """Symbols of the sketch in which a pair at the similarity agrees, but for a chance near 1e-5."""
    p = percent / 100
    return int(SKETCH * p - SKETCH_DEVIATIONS * (SKETCH * p * (1 - p)) ** 0.5)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys (rows: signatures): for each chunk and each position that may differ, a hash of the chunk's other symbols."""
    keys = np.empty((len(signatures), CHUNKS * WIDTH), dtype=_U)
    for c in range(CHUNKS):
        part = signatures[:, c * WIDTH: (c + 1) * WIDTH].astype(_U)
        for j in range(WIDTH):
            key = np.full(len(part), c * WIDTH + j + 1, dtype=_U)
            for i in range(WIDTH):
                if i != j:
                    key = mix((key << _U(16)) + part[:, i] + key)
            keys[:, c * WIDTH + j] = key
    return keys.view(np.int64)


def _forest(n: int, linked: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """(member, least member) of each component, by a search over rows of the link matrix, each asked for once."""
    left = np.ones(n, dtype=bool)
    out = []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        open_rows = [root]
        while open_rows:
            found = np.flatnonzero(linked(open_rows.pop()) & left)
            left[found] = False
            out += [(int(i), root) for i in found]
            open_rows += found.tolist()
    return out


def close_signatures(ids: np.ndarray, sizes: np.ndarray, signatures: np.ndarray, sketches: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Forest edges (ids) of the pairs within the signature distance whose sizes and sketches allow the similarity."""
    agree = least_agreement(percent)

    def linked(k: int) -> np.ndarray:
        near = (signatures != signatures[k]).sum(axis=1) <= DISTANCE
        near &= 100 * np.minimum(sizes, sizes[k]) >= percent * np.maximum(sizes, sizes[k])
        at = np.flatnonzero(near)
        near[at] = (sketches[at] == sketches[k]).sum(axis=1) >= agree
        return near

    if len(ids) == 2:
        return [(ids[1], ids[0])] if linked(0)[1] else []
    return [(ids[i], ids[j]) for i, j in _forest(len(ids), linked)]


def linked_sets(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Forest edges (ids) of the pairs of sets with 100 * intersection >= percent * union, exactly."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    values, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, member = values[order], member[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    member, column = member[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    by_member = np.argsort(member, kind="stable")
    columns, bounds = column[by_member], np.searchsorted(member[by_member], np.arange(len(sets) + 1))
    by_column = np.concatenate(([0], np.cumsum(np.bincount(column)))) if len(column) else np.zeros(1, dtype=np.int64)

    def linked(k: int) -> np.ndarray:
        mine = columns[bounds[k]: bounds[k + 1]]
        inter = np.zeros(len(sets), dtype=np.int64)
        if len(mine):
            lengths = by_column[mine + 1] - by_column[mine]
            at = np.repeat(by_column[mine] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            inter = np.bincount(member[at], minlength=len(sets))
        return 100 * inter >= percent * (sizes + sizes[k] - inter)

    return [(ids[i], ids[j]) for i, j in _forest(len(ids), linked)]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b)."""
    return connected_components(edges, "a", "b").withColumnRenamed("component", "label")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _dealt(rows: DataFrame, key: str, blocks: str, id_col: str) -> DataFrame:
    """A row for each pair of blocks that its block is part of, so that every two members of a key meet.

    With one block (the usual case) a row stays one row.
    """
    own = F.pmod(F.xxhash64(id_col), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    rows = rows.withColumn("__own", own).withColumn("__other", other)
    pair = F.least("__own", "__other") * F.col(blocks) + F.greatest("__own", "__other")
    return rows.withColumn("pair", pair.cast("long")).drop("__own", "__other").repartition(key, "pair").sortWithinPartitions(key, "pair", id_col)


def signatures(docs: DataFrame, *, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest of the set, sig: 32 symbols of 16 bits, sketch: 128 of 8 bits) of every row; no digest for an empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signed, sketches = [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), words)
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles, digest_size=16).digest() if len(shingles) else None)
                least = minima(shingles) if len(shingles) else None
                signed.append(None if least is None else (least[:SYMBOLS] >> _U(48)).astype(np.uint16).tobytes())
                sketches.append(None if least is None else (least[SYMBOLS:] >> _U(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (digests, signed, sketches))],
                names=["id", "n_shingles", "digest", "sig", "sketch"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(sign, "id long, n_shingles long, digest binary, sig binary, sketch binary")


def hamming_join(signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Forest edges (a, b) that connect all pairs of (id, n, sig, sketch) rows within the signature distance that may have
    ``percent`` of their shingles in common by their sizes n and their sketches.

    ``signed`` must be a table that can be read again.
    """

    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 20_000):
                batch = whole.slice(at, 20_000)
                keys = chunk_keys(np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS))
                ids = np.repeat(batch.column("id").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in groups_of(batches, ["key", "pair"]):
            if group.num_rows > 1:
                marks = np.frombuffer(b"".join(group.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)
                sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
                found += close_signatures(group.column("id").to_numpy(), group.column("n").to_numpy(), marks, sketches, percent)
            if len(found) > 50_000:
                yield _edges(list(set(found)))
                found = []
        yield _edges(list(set(found)))

    keyed = signed.select("id", "sig").mapInArrow(key_rows, "key long, id long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = keyed.join(shared.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS)).drop("n"), "key").join(signed.select("id", "n", "sig", "sketch"), "id")
    return _dealt(rows.select("key", "id", "n", "sig", "sketch", "blocks"), "key", "blocks", "id").mapInArrow(join, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: links at ``percent`` or more, components of links.

    ``component_id`` is the least id that can be reached, itself included; ``kept`` is true for that document.
    ``percent`` should be 80 or more: at 0.8 a pair exceeds the signature distance with a probability near 1e-4, at 0.85
    near 3e-6; the sketch adds about 1e-5.
    """

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["cluster", "pair"]):
            sets = [np.frombuffer(x, dtype=_U) for x in group.column("shingles").to_pylist()]
            yield _edges(linked_sets(group.column("id").to_numpy(), sets, percent))

    def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(x.as_py(), words).tobytes() for x in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("cluster"), part.column("blocks"), pa.array(sets, pa.binary())],
                                                 names=["id", "cluster", "blocks", "shingles"])

    signed = written(signatures(docs, words=words, id_col=id_col, text_col=text_col), "signed")
    named = signed.where("digest is not null and id is not null")
    classes = written(named.groupBy("digest").agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n")), "classes")
    clusters = components(hamming_join(classes, percent))
    sizes = clusters.join(classes.select(F.col("id").alias("node"), "n"), "node").groupBy("label").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    blocks = sizes.select("label", F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("n") * 8 / BLOCK_BYTES)).alias("blocks"))
    members = written(clusters.join(blocks, "label").select(F.col("node").alias("id"), F.col("label").alias("cluster"), "blocks"), "members")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(small_keys(members), "id")
    sets = texts.mapInArrow(make_sets, "id long, cluster long, blocks long, shingles binary")
    links = _dealt(sets, "cluster", "blocks", "id").mapInArrow(confirm, "a long, b long")
    if members.where("blocks > 1").isEmpty():  # each component lies in one task: its forest is its labels
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("label")).groupBy("node").agg(F.min("label").alias("label"))
    else:
        labels = components(links)
    by_digest = classes.select("digest", F.col("id").alias("node")).join(labels, "node", "left")
    found = signed.join(by_digest, "digest", "left")
    component = F.coalesce(F.col("label"), F.col("node"), F.col("id"))
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))


def deduplicate(docs: DataFrame, *, percent: int = FILTER_PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (a table that can be read again) with one document of each group of near-duplicates, that of the least id.

    The dropped ids are broadcast if they are counted as few, and joined by shuffle otherwise. Of repeated rows of one
    id one stays; rows without id or without words all stay.
    """
    found = written(near_duplicates(docs, percent=percent, id_col=id_col, text_col=text_col), "groups")
    q = fresh_prefix(docs)
    drop, more = f"{q}dropped", f"{q}again"
    own = F.col(id_col).cast("long")
    dropped = found.where(~F.col("kept")).select(F.col(id_col).alias(drop)).distinct()
    left = docs.join(small_keys(dropped), own == F.col(drop), "left_anti")
    repeated = found.where("kept and n_shingles > 0").groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return left
    again = small_keys(repeated.select(F.col(id_col).alias(more)))
    return left.join(again, own == F.col(more), "left_anti").unionByName(left.join(again, own == F.col(more), "left_semi").dropDuplicates([id_col]))
