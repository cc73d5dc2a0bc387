"""Byte-level BPE with DuckDB recursive queries inside Spark partitions.

Texts are split by a pre-tokenisation pattern. The distinct pieces of a batch become *token-position rows* (piece,
position, next position, token) in an in-process DuckDB. A recursive query joins adjacent tokens with the merge table
and, each round, contracts in every piece the leftmost pair of the least rank, until no pair of the piece has a merge.
Long pieces (unbroken runs) take the same order of contractions in fewer, bounded rounds: all pairs of the least rank at
once, from the left, where the merge table lets none of the new pairs come before them, and the recursion is taken up
again from its last state, so that no query holds more than ``QUERY_ROWS`` rows or two rounds.
Decoding makes (text, position, id) rows of the ids that each text has got, joins them with the vocabulary and
aggregates the bytes in position order.

Spark deals out the documents; each Python worker holds one DuckDB connection (one thread, bounded memory) and a
bounded two-generation cache of pieces, so frequent pieces are encoded once. Any task can be re-run anywhere.

Edge cases: a null or empty text gives no ids; a lone surrogate cannot occur in Spark strings; repeated rows are
encoded each on its own; an empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Characters of text that are tokenised together.
BATCH_CHARS = 3_000_000
#: Pieces that are held at once, of a long text or of texts with new pieces.
BLOCK_PIECES = 1_000_000
#: Pieces in a generation of the cache.
GENERATION = 200_000
#: Rows that one recursive query may come to (a piece of n bytes makes at most n * n / 2).
QUERY_ROWS = 2_000_000
#: Longer pieces (runs without any boundary) contract all equal pairs in a round.
LONG_PIECE = 1024
#: Beyond this many bytes the rounds, as many as different ranks occur, each read too many rows (a piece of 8,000 random
#: letters takes 3 s, of 32,768 near 30 s): such runs take the same contractions from a heap.
HEAP_PIECE = 32_768
#: Rows of a decoding query.
DECODE_ROWS = 1_000_000

_ENCODE = """
with recursive s(i, w, p, n, t, nt, k) as (
  select 0, w, p, n, t, nt, case when m is not null then (m::bigint << 40) | (p::bigint << 20) | n end
  from start left join merges on l = t and r = nt
  union all
  select i + 1, w, p, n, t, nt, case when m is not null then (m::bigint << 40) | (p::bigint << 20) | n end
  from (
    select s.i, s.w, s.p,
           case when s.n = b.bp then b.bn else s.n end as n,
           case when s.p = b.bn then b.bm else s.t end as t,
           case when s.n = b.bp then b.bm else s.nt end as nt
    from s join (
      select w, (k >> 20) & 1048575 as bp, k & 1048575 as bn, k >> 40 as bm
      from (select w, min(k) as k from s where k is not null group by w)
    ) b on s.w = b.w
    where s.p <> b.bp
  ) left join merges on l = t and r = nt
)
select s.w as w, list(s.t order by s.p) as ids
from s join (select w, max(i) as i from s group by w) f on s.w = f.w and s.i = f.i
group by s.w order by s.w
"""

# c: contracted in this round, with the following token; the token after a contracted one goes. Contractions stop after
# the first whose new token would have a merge of a lower rank with one of its neighbours (risky).
_ENCODE_LONG = """
with recursive s(i, p, n, t, nt, m) as (
  select 0, p, n, t, nt, m from start left join merges on l = t and r = nt
  union all
  select i + 1, p, n, t, nt, m
  from (
    select i, p, case when c then n1 else n end as n, case when c then low else t end as t,
           case when case when c then c2 else c1 end then low when c then nt1 else nt end as nt
    from (
      select *, lag(c, 1, false) over o as gone, lead(c, 1, false) over o as c1, lead(c, 2, false) over o as c2, lead(n) over o as n1, lead(nt) over o as nt1
      from (
        select *, m is not null and m = low and p <= coalesce(last, p) and (t <> nt or row_number() over (partition by run order by p) % 2 = 1) as c
        from (
          select *, sum(case when m = low then 0 else 1 end) over (order by p rows unbounded preceding) * 2 + case when m = low then 1 else 0 end as run,
                 min(case when m = low and (a.token is not null or b.token is not null or twice.token is not null) then p end) over () as last
          from (select *, min(m) over () as low, lag(t) over (order by p) as before, lead(t, 2) over (order by p) as after from s) q
          left join risky a on a.token = q.m and a.other = q.before and a.left_side and q.m = q.low
          left join risky b on b.token = q.m and b.other = q.after and not b.left_side and q.m = q.low
          left join risky twice on twice.token = q.m and twice.other = q.m and twice.left_side and q.m = q.low
        )
      )
      window o as (order by p)
    ) where low is not null and i < ? and not gone
  ) left join merges on l = t and r = nt
)
select p, n, t, nt, m from s where i = (select max(i) from s) order by p
"""

_RISKY = """
create table if not exists risky as
select a.m as token, b.l as other, true as left_side from (select distinct m from merges) a join merges b on b.r = a.m and b.m < a.m
union select a.m, b.r, false from (select distinct m from merges) a join merges b on b.l = a.m and b.m < a.m
"""

_DECODE = """
select d, list(b order by p) as parts
from (select d, p, id from positions) join vocab using (id)
group by d order by d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one vocabulary, for one worker process."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(ranks_path)
        self.split = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "350MB"})
        merges = [(a, b, m) for token, m in self.ranks.items() for i in range(1, len(token))
                  if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]
        left, right, rank = (pa.array(x, pa.int32()) for x in zip(*merges)) if merges else (pa.array([], pa.int32()),) * 3
        self._load("merges", pa.table({"l": left, "r": right, "m": rank}))
        self._load("vocab", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "b": pa.array(self.ranks, pa.binary())}))

    def _load(self, name: str, rows: pa.Table) -> None:
        self.con.register("rows_in", rows)
        self.con.execute(f"create or replace table {name} as select * from rows_in")
        self.con.unregister("rows_in")

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids (packed int32) of distinct byte strings, each encoded on its own."""
        out: list[bytes] = [b""] * len(pieces)
        block: list[int] = []
        rows = 0
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = np.int32(whole).tobytes()
            elif len(piece) > HEAP_PIECE:
                out[i] = np.array(_merge_long(piece, self.ranks), dtype=np.int32).tobytes()
            elif len(piece) > LONG_PIECE:
                out[i] = self._encode_long(piece)
            else:
                block.append(i)
                rows += 1 + len(piece) * len(piece) // 2
                if rows >= QUERY_ROWS:
                    self._encode_block(pieces, block, out)
                    block, rows = [], 0
        if block:
            self._encode_block(pieces, block, out)
        return out

    def _encode_block(self, pieces: list[bytes], block: list[int], out: list[bytes]) -> None:
        lengths = np.array([len(pieces[i]) for i in block])
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in block), dtype=np.uint8)]
        ends = np.cumsum(lengths)
        piece = np.repeat(np.arange(len(block), dtype=np.int32), lengths)
        position = (np.arange(len(tokens)) - np.repeat(ends - lengths, lengths)).astype(np.int32)
        following = np.append(tokens[1:], np.int32(-1))
        following[ends - 1] = -1
        self._load("start", pa.table({"w": piece, "p": position, "n": position + 1, "t": tokens, "nt": following}))
        ids = self.con.sql(_ENCODE).to_arrow_table().column("ids").combine_chunks()
        values = ids.values.to_numpy(zero_copy_only=False).astype(np.int32)
        bounds = ids.offsets.to_numpy()
        for k, i in enumerate(block):
            out[i] = values[bounds[k]: bounds[k + 1]].tobytes()

    def _encode_long(self, piece: bytes) -> bytes:
        self.con.execute(_RISKY)
        tokens = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        place = np.arange(len(tokens), dtype=np.int32)
        state = pa.table({"p": place, "n": place + 1, "t": tokens, "nt": np.append(tokens[1:], np.int32(-1)), "m": np.zeros(len(tokens), dtype=np.int32)})
        while state.num_rows > state.column("m").null_count:
            self._load("start", state.drop_columns(["m"]))
            state = self.con.sql(_ENCODE_LONG, params=[max(1, QUERY_ROWS // state.num_rows)]).to_arrow_table()
        return state.column("t").to_numpy().astype(np.int32).tobytes()

    def decode_sequences(self, sequences: list[bytes]) -> list[bytes]:
        """Bytes of sequences of packed int32 ids. Ids outside the vocabulary have no bytes."""
        out = [b""] * len(sequences)
        block: list[tuple[int, bytes]] = []
        rows = 0
        for k, packed in enumerate(sequences):
            for at in range(0, len(packed), 4 * DECODE_ROWS):
                part = packed[at: at + 4 * DECODE_ROWS]
                if rows + len(part) // 4 > DECODE_ROWS:
                    self._decode_block(block, out)
                    block, rows = [], 0
                block.append((k, part))
                rows += len(part) // 4
        if block:
            self._decode_block(block, out)
        return out

    def _decode_block(self, block: list[tuple[int, bytes]], out: list[bytes]) -> None:
        lengths = np.array([len(x) // 4 for _, x in block], dtype=np.int64)
        ids = np.frombuffer(b"".join(x for _, x in block), dtype=np.int32)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.con.register("positions", pa.table({"d": np.repeat(np.arange(len(block), dtype=np.int32), lengths), "p": place.astype(np.int32), "id": ids}))
        got = self.con.sql(_DECODE).to_arrow_table().combine_chunks()
        self.con.unregister("positions")
        for chunk in got.to_batches():
            parts = chunk.column("parts")
            said = parts.values
            ends = np.frombuffer(said.buffers()[1], dtype=np.int32)[said.offset: said.offset + len(said) + 1] if len(said) else np.zeros(1, dtype=np.int32)
            text = memoryview(said.buffers()[2] or b"")
            bounds = ends[parts.offsets.to_numpy()].tolist()
            for d, a, b in zip(chunk.column("d").to_pylist(), bounds, bounds[1:]):
                out[block[d][0]] += bytes(text[a:b])

    def _learn(self, new: set[str]) -> None:
        """Ids of pieces that the young generation of the cache lacks, from the old one or newly encoded."""
        again = {p: ids for p in new if (ids := self.old.get(p)) is not None}
        fresh = [p for p in new if p not in again]
        self.known.update(again)
        self.known.update(zip(fresh, self.encode_pieces([p.encode() for p in fresh])))

    def run(self, texts: list[str]) -> list[bytes]:
        """Packed int32 ids of each text."""
        if len(self.known) > GENERATION:
            self.old, self.known = self.known, {}
        out = [b""] * len(texts)
        parts: list[tuple[int, bytes | list[str]]] = []  # (text, ids, or pieces with some that are not known yet)
        new: set[str] = set()
        waiting = 0

        def settle() -> None:
            self._learn(new)
            for k, part in parts:
                out[k] += part if isinstance(part, bytes) else b"".join(map(self.known.__getitem__, part))
            parts.clear()
            new.clear()

        for k, pieces in _pieces(texts, self.split):
            got = list(map(self.known.get, pieces))
            if None in got:
                new.update(p for p, ids in zip(pieces, got) if ids is None)
                parts.append((k, pieces))
                waiting += len(pieces)
            else:
                parts.append((k, b"".join(got)))
            if waiting > BLOCK_PIECES:
                settle()
                waiting = 0
        settle()
        return out


def _pieces(texts: list[str], split) -> Iterator[tuple[int, list[str]]]:
    """(text number, pieces) of each text, a long text in parts."""
    for k, text in enumerate(texts):
        if len(text) <= BATCH_CHARS:
            yield k, split.findall(text)
        else:
            matches = split.finditer(text)
            while part := [m[0] for m in islice(matches, BLOCK_PIECES)]:
                yield k, part


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long piece: the same contraction order, with a heap of (rank, position) over a linked list."""
    import heapq

    n = len(piece)
    tokens: list[bytes | None] = [piece[i: i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i: i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        left, j = tokens[i], after[i]
        if left is None or j >= n or len(left) + len(tokens[j]) != size:
            continue
        tokens[i], tokens[j] = left + tokens[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(tokens[i] + tokens[k])) is not None:
                heapq.heappush(heap, (r, i, len(tokens[i]) + len(tokens[k])))
        h = before[i]
        if h >= 0 and (r := ranks.get(tokens[h] + tokens[i])) is not None:
            heapq.heappush(heap, (r, h, len(tokens[h]) + len(tokens[i])))
    return [ranks[t] for t in tokens if t is not None]


@functools.lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _int_lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(packed) + 1, dtype=np.int32)
    np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in parts of some millions of characters."""
    lengths = batch.column(column).to_pandas().str.len().fillna(0).to_numpy()
    part = np.cumsum(lengths) // (2 * BATCH_CHARS)
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
           round_trip: bool = False) -> DataFrame:
    """Token ids of each text: (id, token_ids array<int>[, decoded binary]).

    ``ranks_path`` must be readable on every executor (it is installed with the tokenizer files). With ``round_trip``,
    ``decoded`` holds the bytes that the text's ids stand for, gathered by ordered aggregation of the ids' bytes.
    """

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "text"):
                texts = [x or "" for x in batch.column("text").to_pylist()]
                ids = codec(ranks_path, pattern).run(texts)
                columns = [batch.column("id"), _int_lists(ids)]
                names = ["id", "token_ids"]
                if round_trip:
                    columns.append(pa.array(codec(ranks_path, pattern).decode_sequences(ids), pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType
    fields = [T.StructField("id", kind), T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.BinaryType())] * round_trip
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(tokenise, T.StructType(fields)).withColumnRenamed("id", id_col)


def decode(sequences: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """The bytes that each array of ids stands for: (id, decoded binary). Null or empty arrays give no bytes."""

    def detokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            lists = batch.column("ids").to_pylist()
            for at in range(0, len(lists), 200):
                packed = [np.array(x or [], dtype=np.int32).tobytes() for x in lists[at: at + 200]]
                out += codec(ranks_path, pattern).decode_sequences(packed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "decoded"])

    schema = T.StructType([T.StructField("id", sequences.schema[id_col].dataType), T.StructField("decoded", T.BinaryType())])
    source = sequences.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(detokenise, schema).withColumnRenamed("id", id_col)
