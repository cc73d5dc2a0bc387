"""Distances and nearest-point joins against small, fixed lists of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Most points of a list that is compared with every row in place.
MAX_POINTS = 2000


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius: float = 6371.0) -> Column:
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return 2 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def nearest_point(df: DataFrame, points: list[tuple[str, float, float]], *, lat: str = "latitude", lng: str = "longitude",
                  out: str = "nearest", squared_degrees: bool = False) -> DataFrame:
    """``df`` with struct(distance, ord, name) of the nearest of some fixed points; the first one wins ties.

    The list is a constant of the plan (``MAX_POINTS`` at most), so no join and no shuffle takes place.
    """
    if len(points) > MAX_POINTS:
        raise ValueError(f"more than {MAX_POINTS} points; join them by grid cell instead")
    x, y = F.col(lat), F.col(lng)
    kinds = "array<struct<ord:int,name:string,lat:double,lng:double>>"
    listed = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("name"), F.lit(float(a)).alias("lat"), F.lit(float(b)).alias("lng")) for i, (n, a, b) in enumerate(points)]).cast(kinds)
    far = (lambda p: (x - p["lat"]) * (x - p["lat"]) + (y - p["lng"]) * (y - p["lng"])) if squared_degrees else (lambda p: haversine_km(x, y, p["lat"], p["lng"]))
    best = F.array_min(F.transform(listed, lambda p: F.struct(far(p).alias("distance"), p["ord"].alias("ord"), p["name"].alias("name"))))
    return df.withColumn(out, F.when(x.isNotNull() & y.isNotNull(), best))


def footprint_gate(df: DataFrame, hubs: list[tuple[str, float, float]], *, radius_degrees: float, countries: list[str] | None = None,
                   lat: str = "latitude", lng: str = "longitude", country: str | None = None) -> DataFrame:
    """``df`` with hub_km and drop_reason: far_from_hubs, then wrong_country; rows without coordinates stay."""
    near = nearest_point(df, hubs, lat=lat, lng=lng, out="__hub")
    reason = F.when(F.col("__hub.distance") > radius_degrees * 111, "far_from_hubs")
    if countries and country:
        reason = reason.when(~F.col(country).isin(countries), "wrong_country")
    return near.withColumn("hub_km", F.col("__hub.distance")).withColumn("drop_reason", reason).drop("__hub")


def quadrants(lat: Column, lng: Column, offset: float, depth: int) -> Column:
    """Centres of the four quarters of a tile, to five decimals."""
    step = offset / 2**depth
    return F.array(*[F.struct(F.round(lat + a * step, 5).alias("lat"), F.round(lng + b * step, 5).alias("lng")) for a in (-1, 1) for b in (-1, 1)])


def inferred_label(near: Column, most_km: float) -> Column:
    """struct(label, source): the nearest point's name, or too_far_to_infer beyond a distance; null without coordinates."""
    return F.when(near.isNotNull(), F.struct(F.when(near["distance"] <= most_km, near["name"]).alias("label"),
                                             F.when(near["distance"] <= most_km, "nearest").otherwise("too_far_to_infer").alias("source")))


def footprint_tag(own: Column, other: Column, inside: float, border: float) -> Column:
    """yes, border, spillover or unknown from the planar distances (degrees) to the nearest own and other point.

    Inside the radius a row is ours unless another's point is nearer (spillover); up to ``border`` it is on the border.
    """
    return F.when(own.isNull(), "unknown").when(own <= inside, F.when(other < own, "spillover").otherwise("yes")).when(own <= border, "border").otherwise("spillover")


def grid_work(centres: DataFrame, queries: list[str], centre: str) -> DataFrame:
    """(centre, query, work_id): every query at every centre, numbered by its text; the queries are a constant of the plan."""
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(q).alias("q")) for i, q in enumerate(queries)])
    rows = centres.select(centre, F.explode(listed).alias("w"))
    return rows.select(centre, F.col("w.q").alias("query"), F.concat_ws("-", F.format_string("%03d", F.col("w.i")), F.col(centre).cast("string")).alias("work_id"))


def inside_disks(disks: list[tuple[str, float, float, float]]) -> list[str]:
    """Names of disks (name, lat, lng, km) that another disk holds wholly; of equal disks the first stays. A plan's list."""
    import math

    def far(a, b):
        x, y = math.radians(b[1] - a[1]), math.radians(b[2] - a[2])
        h = math.sin(x / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(y / 2) ** 2
        return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))

    return [d[0] for i, d in enumerate(disks) if any(far(d, o) + d[3] <= o[3] and (o[3] > d[3] or k < i) for k, o in enumerate(disks) if k != i)]


def coordinate_problems(df: DataFrame, row_id: str, *, lat: str, lng: str, south: float, north: float, west_is_negative: bool = True) -> DataFrame:
    """(problem, n): coordinates outside the band, on the wrong side of the meridian, and ids that repeat."""
    sign = (F.col(lng) > 0) if west_is_negative else (F.col(lng) < 0)
    each = df.select(F.explode(F.array_compact(F.array(F.when(~F.col(lat).between(south, north), "latitude_band"), F.when(sign, "longitude_sign")))).alias("problem"))
    again = df.groupBy(row_id).agg(F.count("*").alias("k")).where("k > 1").select(F.lit("duplicate_id").alias("problem"))
    return each.unionByName(again).groupBy("problem").agg(F.count("*").alias("n"))


def locality(parts: dict[str, Column], barred: str) -> Column:
    """The first locality of a geocoder's answer, in the order given, that is not blank and no district by a pattern."""
    return F.coalesce(*[F.when((F.trim(F.coalesce(c, F.lit(""))) != "") & ~F.lower(c).rlike(barred), F.trim(c)) for c in parts.values()], F.lit(""))


def city_by_rungs(given: Column, address: Column, areas: dict[str, str], near: Column) -> Column:
    """struct(city, rung): the given city, else that of the longest area word in the address, else the nearest point's."""
    text = F.lower(F.coalesce(address, F.lit("")))
    hit = F.coalesce(*[F.when(text.contains(word.lower()), F.lit(city)) for word, city in sorted(areas.items(), key=lambda x: (-len(x[0]), x[0]))], F.lit(None).cast("string"))
    own = F.when(F.trim(F.coalesce(given, F.lit(""))) != "", F.trim(given))
    return F.struct(F.coalesce(own, hit, near, F.lit("")).alias("city"),
                    F.when(own.isNotNull(), "given").when(hit.isNotNull(), "area").when(near.isNotNull(), "nearest").otherwise("none").alias("rung"))
