"""Incremental runs over folders that grow: append-only inputs, last record wins, windows with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from leadloom.operators.segments import islands
from leadloom.sources import files


def stream_folder(spark: SparkSession, path: str, schema, *, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what is there and not yet done, batch by batch; a second run goes on where the first ended."""
    query: StreamingQuery = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def versioned(df: DataFrame, table_path: str, checkpoint: str, step: Callable[[DataFrame, DataFrame | None], DataFrame]) -> DataFrame:
    """Fold a stream into a table, ``step`` (batch, version before) giving the next one in <table_path>/v<batch>.

    Returns the newest version, empty if there was no batch yet. A batch that is run again writes the same version again,
    so a failure leaves no half-applied state.
    """
    spark = df.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.parquet(f"{table_path}/v{number - 1}") if number else None
        step(batch, before).write.mode("overwrite").parquet(f"{table_path}/v{number}")

    run_available(df, checkpoint, each)
    if not files.versions(spark, table_path):
        return step(spark.createDataFrame([], df.schema), None)
    return files.latest(spark, table_path)


def upsert_stream(df: DataFrame, keys: list[str], order: str, table_path: str, checkpoint: str, *, retry: Column | None = None) -> DataFrame:
    """Keep the last record of each key in versions of a table. Records for which ``retry`` holds (an error that will be
    tried again) are not stored, so the key counts as not done."""
    fields = [c for c in df.columns if c not in (*keys, order)]

    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        batch = batch if retry is None else batch.where(~F.coalesce(retry, F.lit(False)))
        rows = batch if before is None else batch.unionByName(before)
        return rows.groupBy(*keys).agg(F.max(F.struct(order, *fields)).alias("m")).select(*keys, "m.*")

    return versioned(df, table_path, checkpoint, step)


def cumulative_hits(df: DataFrame, key: str, cycle: str, pass_no: str, table_path: str, checkpoint: str) -> DataFrame:
    """(key, first_cycle, passes, cumulative_hits) over all cycles so far: in how many passes of how many cycles a key was seen.

    A key may come several times in a pass, and a pass may be spread over batches: each (cycle, pass) counts once, as the
    state holds the set of passes that a key was seen in (bounded by the number of passes, not by the rows).
    """
    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        rows = batch.where(F.col(key).isNotNull()).select(key, F.struct(F.col(cycle).alias("cycle"), F.col(pass_no).alias("pass")).alias("p")).distinct()
        if before is not None:
            rows = rows.unionByName(before.select(key, F.explode("passes").alias("p")))
        seen = rows.groupBy(key).agg(F.array_sort(F.collect_set("p")).alias("passes"))
        return seen.select(key, F.col("passes")[0]["cycle"].alias("first_cycle"), "passes", F.size("passes").alias("cumulative_hits"))

    return versioned(df, table_path, checkpoint, step)


def stalls(events: DataFrame, run: str, total: str, order: str, least: int) -> DataFrame:
    """(run, total, frozen, since, until): spells in which a run's total stayed the same for ``least`` more events or longer.

    Totals may fall and come back: a spell is a stretch of events in a row with one total. A long run is scanned in parts.
    ``stateful.stalls`` is the same over a stream.
    """
    spell = islands(events.select(run, total, order), run, total, order).groupBy(run, "island").agg(
        F.first(total).alias(total), (F.count("*") - 1).alias("frozen"), F.min(order).alias("since"), F.max(order).alias("until"))
    return spell.where(F.col("frozen") >= least).drop("island")


def due_after(df: DataFrame, key: str, time: str, ttl: str, table_path: str, checkpoint: str) -> DataFrame:
    """(key, verified_at, checks): when each key was last due for a check, and how often, its result being good for ``ttl``.

    A batch is one run of checks: a key is due once in it, if it was never checked or its first event in the batch is ``ttl``
    or more after the last check. Rows without key or time are left out; late events never move a check back.
    """
    good_for = F.expr(f"INTERVAL {ttl}")

    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        asked = batch.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key).agg(F.min(time).alias("asked_at"))
        if before is None:
            return asked.select(key, F.col("asked_at").alias("verified_at"), F.lit(1).cast("long").alias("checks"))
        due = F.col("asked_at").isNotNull() & (F.col("verified_at").isNull() | (F.col("asked_at") >= F.col("verified_at") + good_for))
        return asked.join(before, key, "full_outer").select(key, F.when(due, F.col("asked_at")).otherwise(F.col("verified_at")).alias("verified_at"),
                                                            (F.coalesce("checks", F.lit(0)) + due.cast("long")).alias("checks"))

    return versioned(df, table_path, checkpoint, step)


def windowed_counts(df: DataFrame, time: str, by: str, value: str, *, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by time window; rows later than the watermark are left out (batch inputs have none)."""
    return (df.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), by)
            .agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), by, "n", "total"))
