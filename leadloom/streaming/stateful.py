"""Streams with state for each key: the last record, results that are good for a time, counters of events without change.

Unlike the tables of ``incremental``, nothing is rewritten for a batch: only the keys of the batch are touched, their state lies
in Spark's state store (RocksDB: its size is not bound by memory), and a query that starts again with its checkpoint goes on
where it ended. Results are streams of changes; ``current`` reads the state itself as a table, ``last_by_key`` of
``sources.files`` does it from the changes, and ``sources.buckets`` takes them as upserts.

Scale: state is partitioned by key, ``spark.sql.shuffle.partitions`` of the first run; a key's state is one record. The rows of
one key in one batch meet in one task, where they are read one by one and not held, so bound a batch by ``files_per_batch``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of any type and timers need the RocksDB store; to be set before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def _instants(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]


def _counted(df: DataFrame, names: list[str]) -> DataFrame:
    """Instants as microseconds: workers see them with or without a zone, by where they come from, and numbers compare alike."""
    return df.withColumns({c: F.unix_micros(f"`{c}`") for c in names}) if names else df


def _timed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: F.timestamp_micros(f"`{c}`") for c in names}) if names else df


def _rank(values: tuple) -> tuple:
    """Values in the order that Spark gives structs: nulls first."""
    return tuple((v is not None, v) for v in values)


class LastWins(StatefulProcessor):
    """Holds each key's greatest record by (order, fields), and emits it whenever it has changed."""

    def __init__(self, keys: list[str], order: str, fields: list[str], state: T.StructType, forget_ms: int | None) -> None:
        self.keys, self.names, self.schema, self.forget_ms = keys, [order, *fields], state, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.schema, self.forget_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.last.get()  # None: no state; each question to the store is a message to the JVM
        best = held
        for row in rows:
            new = tuple(row[c] for c in self.names)
            if best is None or _rank(new) > _rank(best):
                best = new
        if best is not held:
            self.last.update(best)
            yield Row(*self.keys, *self.names)(*key, *best)

    def close(self) -> None:
        pass


def last_wins(df: DataFrame, keys: list[str], order: str, *, retry: Column | None = None, forget: timedelta | None = None) -> DataFrame:
    """Changes of a stream's last record of each key (keys, order, fields): a row for each key whose last record a batch has replaced.

    Equal orders are decided by the fields, null being least, as ``max(struct)`` does, so the last change of a key is the row of
    the batch query. Rows with a null key and records for which ``retry`` holds are not stored. With ``forget``, a key that has not
    changed for so long (by the clock) loses its state, and its next record counts as its first. Fields are of plain types.
    """
    use_rocksdb(df.sparkSession)
    fields = [c for c in df.columns if c not in (*keys, order)]
    rows = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    rows = rows if retry is None else rows.where(~F.coalesce(retry, F.lit(False)))
    instants = _instants(df)
    rows = _counted(rows, instants)
    types = {f.name: f.dataType for f in rows.schema}
    state = T.StructType([T.StructField(c, types[c]) for c in (order, *fields)])
    out = T.StructType([T.StructField(c, types[c]) for c in (*keys, order, *fields)])
    processor = LastWins(keys, order, fields, state, int(forget.total_seconds() * 1000) if forget else None)
    return _timed(rows.groupBy(*keys).transformWithState(processor, out, "Update", "ProcessingTime" if forget else "None"), instants)


class DueAfter(StatefulProcessor):
    """Holds when a key was checked last and how often; a timer tells when the result is no longer good."""

    def __init__(self, key: str, good_for: timedelta, timers: bool) -> None:
        self.key, self.good_for, self.timers = key, good_for // timedelta(microseconds=1), timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.checked = handle.getValueState("checked", "verified_at long, checks long")

    def _row(self, key: tuple, event: str, at, checks: int) -> Row:
        return Row(self.key, "event", "at", "checks")(key[0], event, at, checks)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        asked = min(row["asked_at"] for row in rows)
        held = self.checked.get()
        if held is not None and asked < held[0] + self.good_for:
            return
        checks = (held[1] if held is not None else 0) + 1
        self.checked.update((asked, checks))
        if self.timers:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((asked + self.good_for) // 1000)
        yield self._row(key, "checked", asked, checks)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held = self.checked.get() if self.checked.exists() else None
        if held is not None:
            yield self._row(key, "expired", held[0] + self.good_for, held[1])

    def close(self) -> None:
        pass


#: Events that a task reduces to the first of each key at once.
CHUNK_EVENTS = 1 << 20


def _first_of_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, asked_at): the first event of each key in chunks of a task's events."""
    def first(chunk: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(chunk)
        key = found.column_names[0]
        found = found.group_by(key).aggregate([("asked_at", "min")]).rename_columns({"asked_at_min": "asked_at"})
        yield from found.select([key, "asked_at"]).to_batches(max_chunksize=1 << 16)

    chunk, held = [], 0
    for batch in batches:
        chunk, held = [*chunk, batch], held + batch.num_rows
        if held >= CHUNK_EVENTS:
            yield from first(chunk)
            chunk, held = [], 0
    if held:
        yield from first(chunk)


def due_after(df: DataFrame, key: str, time: str, good_for: timedelta, *, late: str | None = None) -> DataFrame:
    """Stream of (key, event, at, checks): the checks that a stream of events makes due, a result being good for ``good_for``.

    A batch is one run of checks: a key is due once in it (event checked), if it was never checked or its first event in the
    batch is ``good_for`` or more after the last check, as in ``incremental.due_after``. With ``late``, the delay of the watermark,
    a timer also tells when a result has expired without a new check (event expired), and events behind the watermark are left
    out; without it, late events never move a check back. Rows without key or time are left out.

    Only a key's first event of a batch counts, so without ``late`` tasks send on one for each key of a chunk of events, by time
    alone; with it, all events go on, as the watermark has to see them and to leave late ones out first.
    """
    use_rocksdb(df.sparkSession)
    rows = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, F.col(time).cast("timestamp").alias(time))
    out = T.StructType([df.schema[key], T.StructField("event", T.StringType()), T.StructField("at", T.LongType()), T.StructField("checks", T.LongType())])
    if late:
        rows = rows.withWatermark(time, late)
    rows = rows.withColumn("asked_at", F.unix_micros(time))
    if not late:
        rows = rows.select(key, "asked_at")
        rows = rows.mapInArrow(_first_of_keys, rows.schema)
    return _timed(rows.groupBy(key).transformWithState(DueAfter(key, good_for, bool(late)), out, "Update", "EventTime" if late else "None"), ["at"])


class FrozenTotals(StatefulProcessor):
    """Holds a run's last total, since when it has been the same, and for how many further events."""

    def __init__(self, run: str, total: str, order: str, least: int, schema: T.StructType) -> None:
        self.run, self.total, self.order, self.least, self.schema = run, total, order, least, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.spell = handle.getValueState("spell", self.schema)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        total, since, until, frozen = self.spell.get() or (None, None, None, -1)
        told = frozen
        for at, value in sorted(((r[self.order], r[self.total]) for r in rows), key=_rank):
            if until is not None and at < until:
                continue
            if frozen >= 0 and value == total:
                until, frozen = at, frozen + 1
                continue
            if frozen >= self.least and frozen != told:
                yield self._row(key, total, frozen, since, until)
            total, since, until, frozen, told = value, at, at, 0, 0
        if frozen >= self.least and frozen != told:
            yield self._row(key, total, frozen, since, until)
        self.spell.update((total, since, until, frozen))

    def _row(self, key: tuple, total, frozen: int, since, until) -> Row:
        return Row(self.run, self.total, "frozen", "since", "until")(key[0], total, frozen, since, until)

    def close(self) -> None:
        pass


def stalls(df: DataFrame, run: str, total: str, order: str, least: int) -> DataFrame:
    """Stream of (run, total, frozen, since, until): spells in which a run's total stayed the same for ``least`` more events or longer.

    Totals may fall and come back: a spell is a run of events in a row with one total. A spell that goes on is told again by
    each batch that has made it longer, so its longest row by (run, since) counts. Events of a batch are put in order (those of
    one run must fit in a task); an event before the last one of an earlier batch is left out. Null runs are left out.
    """
    use_rocksdb(df.sparkSession)
    rows = df.where(F.col(run).isNotNull() & F.col(order).isNotNull()).select(run, total, order)
    instants = [c for c in _instants(df) if c in (total, order)]
    rows = _counted(rows, instants)
    at, value = rows.schema[order].dataType, rows.schema[total].dataType
    state = T.StructType([T.StructField("total", value), T.StructField("since", at), T.StructField("until", at), T.StructField("frozen", T.LongType())])
    out = T.StructType([df.schema[run], T.StructField(total, value), T.StructField("frozen", T.LongType()), T.StructField("since", at), T.StructField("until", at)])
    found = rows.groupBy(run).transformWithState(FrozenTotals(run, total, order, least, state), out, "Update", "None")
    return _timed(found, [c for c in (total,) if c in instants] + (["since", "until"] if order in instants else []))


def write_changes(df: DataFrame, path: str, checkpoint: str, *, idle_batches: bool = True) -> DataFrame:
    """Append what is there and not yet done of a stream of changes to Parquet files, exactly once; all changes so far.

    A batch goes to a folder of its own, and one that is run again after a failure replaces it. Timers fire in batches without
    data; state that expires by the clock asks for such batches without end, so a stream with ``forget`` needs ``idle_batches``
    to be false.
    """
    df.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    df.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def current(spark: SparkSession, checkpoint: str, state: str) -> DataFrame:
    """The state of a query by its checkpoint, as a table of the key's and the value's columns (nothing is replayed)."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", state).load()
    return held.select("key.*", "value.*")
