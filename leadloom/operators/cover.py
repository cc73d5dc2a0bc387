"""Greedy minimum separation: in a given order, a point stays unless an earlier one that stayed is too near.

The pass is sequential by definition, but a decision depends on near points only. Space is cut into cubes so small that
two points of one cube are always too near; so at most one point of a cube stays, and the one that comes first among a
cube's open points is its only candidate. In each round the candidates that come before those of all cubes in reach
stay, and open points too near to them go. The result is that of the sequential pass, exactly.

Scale: a round joins one candidate for each cube with the cubes in reach, and open points with the kept points in reach;
no two points of a dense cube are ever paired. Rounds follow the longest chain of points that wait for each other: few
for an order that is unrelated to place, many for a sweep from one side.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from leadloom.operators.durable import discard, durable, scratch

RADIUS_KM = 6371.0


def minimum_separation(points: DataFrame, order: str, separation_km: float, *, lat: str = "latitude", lng: str = "longitude", max_rounds: int = 500) -> DataFrame:
    """The points that stay: ``order`` (unique) decides who comes first; points without coordinates are left out."""
    chord = 2 * RADIUS_KM * math.sin(separation_km / (2 * RADIUS_KM))
    side = chord / math.sqrt(3)
    a, b = F.radians(F.col(lat)), F.radians(F.col(lng))
    xyz = {"x": RADIUS_KM * F.cos(a) * F.cos(b), "y": RADIUS_KM * F.cos(a) * F.sin(b), "z": RADIUS_KM * F.sin(a)}
    rows = points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    spots = rows.select(F.col(order).alias("o"), *[c.alias(k) for k, c in xyz.items()])
    spots = spots.select("o", "x", "y", "z", *[F.floor(F.col(k) / side).cast("long").alias(f"c{k}") for k in "xyz"])
    cube = ["cx", "cy", "cz"]
    reach = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip("ijk", (i, j, k))]) for i in range(-2, 3) for j in range(-2, 3) for k in range(-2, 3)])
    spread = lambda df: df.withColumn("d", F.explode(reach)).withColumns({"cx": F.col("cx") + F.col("d.i"), "cy": F.col("cy") + F.col("d.j"), "cz": F.col("cz") + F.col("d.k")}).drop("d")

    left, folder = durable(spots, "spots"), scratch(points.sparkSession, "kept")
    kept = points.sparkSession.read.schema(spots.select("o").schema)
    for k in range(max_rounds):
        firsts = left.groupBy(*cube).agg(F.min("o").alias("o"))
        around = spread(firsts.withColumnRenamed("o", "other")).groupBy(*cube).agg(F.min("other").alias("least"))
        chosen = firsts.join(around, cube).where("o <= least").select(*cube, "o")
        chosen = durable(left.join(chosen, [*cube, "o"]), "chosen")
        chosen.select("o").write.parquet(f"{folder}/round={k}")
        near = spread(chosen.select(*cube, *[F.col(k).alias(f"k{k}") for k in "xyz"]))
        gap = sum((F.col(k) - F.col(f"k{k}")) * (F.col(k) - F.col(f"k{k}")) for k in "xyz")
        gone = left.join(near, cube).where(gap < chord * chord).select("o").distinct()
        after = durable(left.join(gone, "o", "left_anti").join(chosen.select("o"), "o", "left_anti"), "open")
        discard(left, chosen)
        left = after
        if left.isEmpty():
            survivors = kept.parquet(*[f"{folder}/round={i}" for i in range(k + 1)])
            return rows.join(survivors.withColumnRenamed("o", order), order, "left_semi")
    raise RuntimeError(f"points did not settle in {max_rounds} rounds")
