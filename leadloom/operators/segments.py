"""Scans over long ordered runs (a register, a log, a run of events) that no single task has to hold.

A window over a run puts all of it into one task. Here rows are sorted into range partitions of (by, order), so a long run spans
several; each partition scans its own rows, and what it must know of the partitions before it (the last marked value, the sum so
far) is a row for each partition, combined by a prefix scan over these rows. The result equals the window's.

Edge cases: null keys are one run; an empty table gives an empty result; rows equal in (by, order) come in any order, so order
must be unique within a run where that matters. Column names beginning with two underscores are the scan's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.operators.durable import durable, small_side


def scanned(df: DataFrame, by: list[str], order: list[str], *, last: dict[str, Column] | None = None, before: dict[str, Column] | None = None,
            sums: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with columns from an ordered scan of each run of equal ``by``.

    ``last``: the last value so far that is not null, the own row included. ``before``: the value of the row before, null for the
    first. ``sums``: the sum so far (nulls count as 0), the own row included. ``df`` is computed twice (ranges, then rows).
    """
    last, before, sums = last or {}, before or {}, sums or {}
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)])
    pair = lambda v: F.struct(F.col("__key").alias("k"), v.alias("v"))
    rows = df.withColumn("__key", key)
    marks = {f"__last_{c}": F.when(v.isNotNull(), pair(v)) for c, v in last.items()} | {f"__before_{c}": pair(v) for c, v in before.items()}
    rows = rows.withColumns(marks | {f"__sum_{c}": F.coalesce(v, F.lit(0)) for c, v in sums.items()})
    rows = durable(rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("__at", F.monotonically_increasing_id()), "scan")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))

    ends = rows.groupBy("__part").agg(F.min("__at").alias("__first"), F.max("__at").alias("__end"),
                                      *[F.max_by(m, F.when(F.col(m).isNotNull(), F.col("__at"))).alias(f"{m}_end") for m in marks])
    parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    carried = durable(ends.select("__part", "__first", "__end", *[F.last(f"{m}_end", True).over(parts).alias(f"{m}_in") for m in marks]), "carried")
    own = Window.partitionBy("__part").orderBy("__at")
    frames = {m: own.rowsBetween(Window.unboundedPreceding, 0 if m.startswith("__last_") else -1) for m in marks}
    out = rows.withColumns({f"{m}_own": F.last(m, True).over(frames[m]) for m in marks}).join(F.broadcast(carried.drop("__first", "__end")), "__part")
    for m in marks:
        found = F.coalesce(f"{m}_own", f"{m}_in")
        out = out.withColumn(m.split("_", 3)[3], F.when(found["k"].eqNullSafe(F.col("__key")), found["v"]))
    if sums:
        names = [f"__sum_{c}" for c in sums]
        held = rows.groupBy("__part", "__key").agg(F.min("__at").alias("__lo"), F.max("__at").alias("__hi"), *[F.sum(c).alias(c) for c in names])
        edge = held.join(F.broadcast(carried.select("__part", "__first", "__end")), "__part").where("__lo = __first or __hi = __end")
        earlier = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        into = edge.select("__part", "__key", *[F.sum(c).over(earlier).alias(f"{c}_in") for c in names]).where(f"{names[0]}_in is not null")
        run = Window.partitionBy("__part", "__key").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumns({f"{c}_own": F.sum(c).over(run) for c in names})
        into = small_side(into.withColumnsRenamed({"__part": "__p", "__key": "__k"}))
        out = out.join(into, (F.col("__part") == F.col("__p")) & F.col("__key").eqNullSafe(F.col("__k")), "left")
        out = out.withColumns({c: F.col(f"__sum_{c}_own") + F.coalesce(f"__sum_{c}_in", F.lit(0)) for c in sums})
    return out.select(*df.columns, *last, *before, *sums)


def islands(df: DataFrame, by: str, value: str, order: str, out: str = "island") -> DataFrame:
    """``df`` with the number, from 1, of the row's stretch of equal ``value`` within its run; null is a value like any other."""
    seen = scanned(df, [by], [order], before={"__was": F.struct(F.col(value).alias("of"))})
    new = F.col("__was").isNull() | ~F.col("__was.of").eqNullSafe(F.col(value))
    return scanned(seen.withColumn("__new", new.cast("long")).drop("__was"), [by], [order], sums={out: F.col("__new")}).drop("__new")
