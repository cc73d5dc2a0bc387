"""Disks on the globe: which lie wholly inside another, and the nearest of any number of points, without comparing all pairs.

Places are points of a sphere, so a grid of cubes needs no care at the poles and the date line: a chord is never longer than its
arc, so whatever lies within R kilometres of a point is in its cube of side R or one of the 26 around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadloom.functions.geo import haversine_km
from leadloom.operators.durable import discard, durable, small_side

EARTH_KM = 6371.0

#: Points of a block and rows of a run (powers of two), most blocks, rows that are compared with a block at once, and runs of a task.
BLOCK_POINTS, RUN_ROWS, MOST_BLOCKS, TILE_ROWS, TASK_RUNS = 128, 1024, 1 << 14, 256, 32


def _cube(lat: Column, lng: Column, side: Column) -> list[Column]:
    """The cube of a place in a grid of cubes."""
    a, b = F.radians(lat), F.radians(lng)
    return [F.floor(EARTH_KM * v / side).cast("long") for v in (F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a))]


def _around(cube: list[Column]) -> Column:
    """The cubes around and at one, as an array of structs."""
    steps = [(x, y, z) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)]
    return F.array(*[F.struct(*[(c + d).alias(n) for c, d, n in zip(cube, step, "xyz")]) for step in steps])


def not_inside(df: DataFrame, row_id: str, *, lat: str, lng: str, km: str) -> DataFrame:
    """``df`` without the disks that another disk holds wholly (distance + own radius <= its radius); of equal disks the one of
    the least id stays.

    Disks are classed by their radius' power of two. A disk looks for holders in every class from its own up, a cube of that
    class for each; a holder is entered in the 27 cubes around its centre. Disks without a place or a radius stay. Equal disks
    are one before the join, so a place with many of them meets itself once. Classes are some 15 numbers at most.
    """
    known = df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull() & (F.col(km) >= 0))
    one = durable(known.groupBy(F.col(lat).cast("double").alias("a"), F.col(lng).cast("double").alias("b"), F.col(km).cast("double").alias("r")).agg(F.min(row_id).alias("id"))
                  .withColumn("class", F.ceil(F.log2(F.greatest("r", F.lit(1.0)))).cast("int")), "disks")
    classes = [x[0] for x in one.select("class").distinct().collect()]
    if not classes:
        return df
    side = F.pow(F.lit(2.0), F.col("class"))
    holders = one.select("class", F.explode(_around(_cube(F.col("a"), F.col("b"), side))).alias("c"), F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("r").alias("r2"), F.col("id").alias("id2"))
    asked = one.withColumn("at", F.explode(F.array(*[F.lit(c) for c in classes]))).where("at >= class").drop("class").withColumnRenamed("at", "class")
    asked = asked.select("class", F.struct(*[v.alias(n) for v, n in zip(_cube(F.col("a"), F.col("b"), side), "xyz")]).alias("c"), "a", "b", "r", "id")
    inside = (F.col("id") != F.col("id2")) & (haversine_km(F.col("a"), F.col("b"), F.col("a2"), F.col("b2")) + F.col("r") <= F.col("r2")) & (
        (F.col("r2") > F.col("r")) | (F.col("id2") < F.col("id")))
    held = asked.join(holders.withColumnsRenamed({"class": "class2", "c": "c2"}), (F.col("class") == F.col("class2")) & (F.col("c") == F.col("c2")) & inside, "left_semi")
    first = one.select(F.col("id").alias("__id")).join(held.select(F.col("id").alias("__id")).distinct(), "__id", "left_anti")
    free = df.where(F.col(lat).isNull() | F.col(lng).isNull() | ~F.coalesce(F.col(km) >= 0, F.lit(False)))
    return df.where(f"`{lat}` is not null and `{lng}` is not null and `{km}` >= 0").join(small_side(first), F.col(row_id) == F.col("__id"), "left_semi").unionByName(free)


def _spread(v: Column) -> Column:
    """21 bits of a number at every third place."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def _along(df: DataFrame, lat: str, lng: str, *ties: str) -> DataFrame:
    """``df`` with its places' x, y, z on the unit sphere, in parts and in them sorted along a curve that keeps near places together."""
    a, b = F.radians(lat), F.radians(lng)
    df = df.withColumns({"x": F.cos(a) * F.cos(b), "y": F.cos(a) * F.sin(b), "z": F.sin(a)})
    for shift, c in enumerate("xyz"):
        df = df.withColumn(f"__{c}", F.shiftleft(_spread(F.least(F.floor((F.col(c) + 1) * (1 << 20)).cast("long"), F.lit((1 << 21) - 1))), shift))
    df = df.withColumn("__code", F.col("__x").bitwiseOR(F.col("__y")).bitwiseOR(F.col("__z"))).drop("__x", "__y", "__z")
    return df.repartitionByRange("__code", lat, lng, *ties).sortWithinPartitions("__code", lat, lng).drop("__code")


def _box(df: DataFrame, key: str, mark: str) -> DataFrame:
    """The box around the places of each key."""
    return df.groupBy(key).agg(*[f(c).alias(f"{name}_{c}{mark}") for c in "xyz" for name, f in (("lo", F.min), ("hi", F.max))])


def _sum_of_squares(sides: list[Column]) -> Column:
    return sides[0] * sides[0] + sides[1] * sides[1] + sides[2] * sides[2]


def _nearest_in_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each run's rows among its blocks of points, which follow the run's record nearest first, one held at a time.

    A row is compared with a block only if the block's box is not farther than the best point so far. A row keeps the points
    whose chord is the least but for rounding; which is nearest is for the exact distance to say.
    """
    m = best = None
    kept: list[tuple] = []

    def ended() -> Iterator[pa.RecordBatch]:
        if m is None or not kept:
            return
        row, block, pos, chord = (np.concatenate(c) for c in zip(*kept))
        stay = chord <= best[row] * (1 + 1e-12) + 1e-14
        row = pa.array(row[stay])
        yield pa.RecordBatch.from_arrays([m.field("id").take(row), m.field("a").take(row), m.field("b").take(row), pa.array(block[stay]), pa.array(pos[stay])], names=["id", "a", "b", "block", "pos"])

    for batch in batches:
        blocks, lists = batch.column("block").to_pylist(), batch.column("m")
        for k, block in enumerate(blocks):
            items = lists[k].values
            xyz = np.stack([items.field(c).to_numpy(zero_copy_only=False) for c in "xyz"])
            if block is None:
                yield from ended()
                m, at, best, kept = items, xyz, np.full(len(items), np.inf), []
                continue
            off = np.maximum(0.0, np.maximum(xyz.min(axis=1)[:, None] - at, at - xyz.max(axis=1)[:, None]))
            asked = np.flatnonzero(np.sqrt((off * off).sum(axis=0)) <= best * (1 + 1e-9) + 1e-13)
            pos = items.field("pos").to_numpy(zero_copy_only=False)
            for low in range(0, len(asked), TILE_ROWS):
                rows = asked[low:low + TILE_ROWS]
                chord = np.square(at[0, rows][:, None] - xyz[0])
                chord += np.square(at[1, rows][:, None] - xyz[1])
                chord += np.square(at[2, rows][:, None] - xyz[2])
                np.sqrt(chord, out=chord)
                best[rows] = np.minimum(best[rows], chord.min(axis=1))
                i, j = np.nonzero(chord <= (best[rows] * (1 + 1e-12) + 1e-14)[:, None])
                kept.append((rows[i], np.full(len(i), block), pos[j], chord[i, j]))
    yield from ended()


def nearest(df: DataFrame, row_id: str, points: DataFrame, *, lat: str = "latitude", lng: str = "longitude", name: str = "name", order: str = "ord") -> DataFrame:
    """(row_id, name, km, order) of the nearest of a table of points (latitude, longitude, name, order), the least order winning ties.

    Points and rows are sorted along a curve through space and cut: points into blocks (``BLOCK_POINTS``, more where there would
    be over ``MOST_BLOCKS``), rows into runs (``RUN_ROWS``). Only the boxes of runs and blocks are compared: no row of a run is
    farther from its point than some block lies wholly, so only blocks whose box begins within that are sent to the run, however
    dense or uneven the points are. A task holds one run and one block. Rows and points without a place (null, NaN or infinite)
    are left out; without points there are no rows.
    """
    def placed(t: DataFrame) -> DataFrame:
        return t.withColumns({lat: F.col(lat).cast("double"), lng: F.col(lng).cast("double")}).where(f"abs(`{lat}`) < double('infinity') and abs(`{lng}`) < double('infinity')")

    one = placed(points).groupBy(F.col(lat).alias("a2"), F.col(lng).alias("b2")).agg(F.min(F.struct(F.col(order).alias("__ord"), F.col(name).alias("__name"))).alias("m"))
    sorted_points = durable(_along(one, "a2", "b2").withColumn("pos", F.monotonically_increasing_id()), "points")
    size = BLOCK_POINTS
    while size * MOST_BLOCKS < sorted_points.count():
        size *= 2
    p = sorted_points.withColumn("block", F.shiftright("pos", size.bit_length() - 1))
    rows = durable(_along(placed(df).select(F.col(row_id).alias("id"), F.col(lat).alias("a"), F.col(lng).alias("b")), "a", "b", "id").withColumn("run", F.shiftright(F.monotonically_increasing_id(), RUN_ROWS.bit_length() - 1)), "rows")
    gaps = [F.greatest(F.lit(0.0), F.col(f"lo_{c}2") - F.col(f"hi_{c}"), F.col(f"lo_{c}") - F.col(f"hi_{c}2")) for c in "xyz"]
    spans = [F.greatest(F.col(f"hi_{c}2") - F.col(f"lo_{c}"), F.col(f"hi_{c}") - F.col(f"lo_{c}2")) for c in "xyz"]
    boxes, runs = durable(_box(p, "block", "2"), "boxes"), durable(_box(rows, "run", ""), "runs")
    met = runs.crossJoin(F.broadcast(boxes)).select("run", "block", F.sqrt(_sum_of_squares(gaps)).alias("near"), F.sqrt(_sum_of_squares(spans)).alias("far"))
    pairs = met.join(met.groupBy("run").agg(F.min("far").alias("most")), "run").where(F.col("near") <= F.col("most") * (1 + 1e-9) + 1e-12).select("run", "block", "near")
    kind = df.schema[row_id].dataType
    of_rows = rows.groupBy("run").agg(F.collect_list(F.struct("id", "a", "b", "x", "y", "z", F.lit(None).cast("long").alias("pos"))).alias("m"))
    part = F.floor(F.pmod("pos", F.lit(size)) / BLOCK_POINTS)
    of_points = p.groupBy("block", part.alias("part")).agg(F.collect_list(F.struct(F.lit(None).cast(kind).alias("id"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"), "x", "y", "z", "pos")).alias("m"))
    fed = of_rows.select("run", F.lit(-1.0).alias("near"), F.lit(None).cast("long").alias("block"), "m").unionByName(pairs.join(of_points, "block").select("run", "near", "block", "m"))
    schema = T.StructType([T.StructField("id", kind), T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType()), T.StructField("block", T.LongType()), T.StructField("pos", T.LongType())])
    # by a hash of the run: Spark 4.1 takes a union of tables that are dealt by run as dealt already, also where a broadcast join has undone it
    found = fed.repartition(1 + runs.count() // TASK_RUNS, F.xxhash64("run")).sortWithinPartitions("run", "near").mapInArrow(_nearest_in_run, schema)
    far = haversine_km(F.col("a"), F.col("b"), F.col("a2"), F.col("b2"))
    best = found.drop("block").join(p.select("pos", "a2", "b2", "m"), "pos").groupBy("id").agg(F.min(F.struct(far.alias("km"), "m")).alias("best"))
    out = durable(best.select(F.col("id").alias(row_id), F.col("best.m.__name").alias(name), "best.km", F.col("best.m.__ord").alias(order)), "nearest")
    discard(rows, sorted_points, boxes, runs)
    return out
