"""Best-fit packing planned over a histogram of lengths.

Documents become token ids and one closing id; longer ones are cut into pieces of ``capacity``. The lengths of all
pieces are counted (at most ``capacity`` different ones) and best-fit decreasing runs over these counts: runs of equal
pieces fill runs of equally full sequences, so the plan has some thousands of slots whatever the number of documents.
Then each piece takes its slot by its rank among the pieces of its length.

Scale: texts are read once; the pieces (some 40 bytes each) are written to the shared folder, as they are counted,
ranked and placed. A rank is a row number within (length, salt) plus the counts of smaller salts, so that no length
gathers in one task. The plan is bounded by ``capacity`` and broadcast.

Edge cases: null and empty texts are the closing id alone; added tokens (such as an end-of-text mark) inside a text get
their own ids, as the library gives them; repeated rows are packed each; a full piece is a sequence of its own; ids must be
numbers (they are cast to long); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator
from struct import pack as packed_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from leadloom.llm.shared import written

CAPACITY = 2048
CLOSING_ID = 0
#: Chunks in a generation of the cache, and characters that are tokenised together.
GENERATION = 150_000
BATCH_CHARS = 1_000_000
#: Pieces that share a salt, about.
SALT_ROWS = 2_000_000
MIN_SALTS = 16
#: (length, salt) rows that may be broadcast.
MAX_BROADCAST_ROWS = 500_000

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
])


#: Signs between an ASCII letter or digit and a space.
_TRAILING = re.compile(rb"([!-&(-/:-@\[-`{-~](?<=[a-z0-9].)[!-&(-/:-@\[-`{-~]*)(?=\s|$)")
#: Words that normalisation and splitting leave as they are: lower-case letters in composed form.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


# Fixed value: the split of the tokenizers that chunks serve.
CHUNK_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_into_chunks(spec: dict) -> bool:
    """Whether a tokenizer (its JSON) lower-cases, composes, drops white space and splits as chunks need, with plain added tokens."""
    def flat(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]

    steps = [x["type"] for x in flat(spec["normalizer"], "normalizers")]
    spaces = [x for x in flat(spec["normalizer"], "normalizers") if x["type"] == "Replace"]
    splits = flat(spec["pre_tokenizer"], "pretokenizers")
    return (
        "Lowercase" in steps and set(steps) <= {"NFC", "Replace", "Lowercase"} and all(x["pattern"] == {"Regex": r"\s+"} and x["content"] == " " for x in spaces)
        and [x["type"] for x in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": CHUNK_SPLIT}
        and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
        and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]))


class ChunkTokenizer:
    """Ids of texts by way of their chunks between ASCII spaces, in one worker process, as the tokenizer gives them for whole texts.

    Such a space ends every token of a tokenizer that drops white space before its model runs, so a text's ids are its
    chunks' ids in a row. A run of ASCII signs after a letter or digit is a chunk of its own, as the tokenizer parts them
    anyway, and A-Z are lower-cased, as it does too. Added tokens are cut out of the text first, as the library does.
    Frequent chunks are tokenised once (two generations of a bounded cache). Tokenizers of other kinds take whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a chunk holds none: lower-casing may have made one up
        self.words = Tokenizer(self.tokenizer.model)  # the same model for words that need no normalisation
        self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spec = json.loads(self.whole.to_str())
        self.in_chunks = splits_into_chunks(spec)
        added = sorted((x["content"] for x in spec["added_tokens"]), key=lambda t: (-len(t), t))
        self.added = tuple(added)
        self.mark = re.compile("(" + "|".join(map(re.escape, added)) + ")")
        # no chunk begins with a space
        self.fixed = {b" " + x["content"].encode(): packed_ids("<I", x["id"]) for x in spec["added_tokens"]}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def lookup(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        if len(self.young) > GENERATION:
            self.old, self.young = self.young, {}
        found, new = {}, []
        for chunk in chunks:
            if (ids := self.young.get(chunk)) is None and (ids := self.old.get(chunk)) is None and (ids := self.fixed.get(chunk)) is None:
                new.append(chunk)
            else:
                found[chunk] = ids
        for at in range(0, len(new), 20_000):
            texts = [x.decode() for x in new[at: at + 20_000]]
            for tokenizer, part in ((self.words, [x for x in texts if _PLAIN.fullmatch(x)]), (self.tokenizer, [x for x in texts if not _PLAIN.fullmatch(x)])):
                for text, got in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                    ids = got.ids
                    found[text.encode()] = packed_ids(f"<{len(ids)}I", *ids)
        self.young.update(found)
        return found

    def chunks(self, text: str) -> list[bytes]:
        if any(t in text for t in self.added):
            return [c for k, part in enumerate(self.mark.split(text)) for c in ([b" " + part.encode()] if k % 2 else self.chunks(part))]
        return _TRAILING.sub(rb" \1", text.encode().lower()).split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.in_chunks:
            return [np.array(x.ids, dtype="<u4").tobytes() for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        chunks = [self.chunks(x) for x in texts]
        local = self.lookup(set().union(*chunks))
        return [b"".join(map(local.__getitem__, x)) for x in chunks]


@functools.lru_cache(maxsize=2)
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with some millions of characters."""
    first = chars = 0
    for k, text in enumerate(texts):
        chars += len(text)
        if chars >= BATCH_CHARS:
            yield first, k + 1
            first, chars = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def token_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, closing_id: int = CLOSING_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document; ``ids`` are little-endian unsigned 32-bit numbers.

    ``tokenizer_path`` must be readable on every executor.
    """
    step = 4 * capacity
    closing = np.array([closing_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("id").to_pylist()
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for a, b in _runs(texts):
                rows: list[tuple] = []
                for doc_id, ids in zip(doc_ids[a:b], chunk_tokenizer(tokenizer_path).encode(texts[a:b])):
                    ids += closing
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at: at + step]
                        rows.append((doc_id, k, at // 4, len(part) // 4, part))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=PIECES.names)

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, from_rank, to_rank, first_sequence, per_sequence, offset) by best-fit decreasing over counts.

    The pieces of a length with ranks from ``from_rank`` up to ``to_rank`` go ``per_sequence`` at a time into the
    sequences from ``first_sequence`` on, one after another from ``offset``.
    """
    room: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # by space left: runs (first sequence, number)
    sizes: list[int] = []  # spaces left that occur, ascending
    slots, opened = [], 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if not room[space]:
                insort(sizes, space)
            room[space].append((first, n))

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                space = sizes[at]
                first, n = room[space].popleft()
                if not room[space]:
                    sizes.pop(at)
            else:
                space, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = space // length
            full = min(n, left // each)
            if full:
                slots.append((length, rank, rank + full * each, first, each, capacity - space))
                put(space - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # the last sequence takes fewer
                slots.append((length, rank, rank + left, first + full, left, capacity - space))
                put(space - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(space, first + full, n - full)
    return slots


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...; a table that can be read again) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    slots = spark.createDataFrame(
        best_fit(counts, capacity) or [(0, 0, 0, 0, 1, 0)], "length long, from_rank long, to_rank long, first_sequence long, per_sequence long, at long")
    salts = max(MIN_SALTS, sum(counts.values()) // SALT_ROWS)
    names = pieces.columns
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    by_salt = salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    before = by_salt.select("length", "__salt", (F.sum("n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("n")).alias("__before"))
    if capacity * salts <= MAX_BROADCAST_ROWS:
        before = F.broadcast(before)
    order = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", *[c for c in names if c not in ("doc_id", "piece", "length")])
    ranked = salted.withColumn("__n", F.row_number().over(order)).join(before, ["length", "__salt"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__n") - 1)
    placed = ranked.join(F.broadcast(slots.withColumnRenamed("length", "__length")), (F.col("length") == F.col("__length"))
                         & (F.col("__rank") >= F.col("from_rank")) & (F.col("__rank") < F.col("to_rank")))
    k = F.col("__rank") - F.col("from_rank")
    return placed.select(
        *names, (F.col("first_sequence") + F.floor(k / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("at") + k % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer_path, capacity=capacity, id_col=id_col, text_col=text_col)
    return pack(written(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces"), capacity)
