"""Points and distances on the earth."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from storelens.functions.scalars import let
from storelens.operators.runs import spread_join
from storelens.session import fresh_path

# WGS84 semi-major axis and flattening; mean radius (2a + b) / 3.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
SPHERE_RADIUS = (2 * WGS84_A + WGS84_B) / 3


def point(lng: Column, lat: Column) -> Column:
    """A point struct; null unless both coordinates are there."""
    return F.when(
        lng.isNotNull() & lat.isNotNull(),
        F.struct(lng.cast("double").alias("lng"), lat.cast("double").alias("lat")),
    )


def valid_coordinates(lng: Column, lat: Column) -> Column:
    return lng.between(-180, 180) & lat.between(-90, 90)


def geojson_point(lng: Column, lat: Column) -> Column:
    return F.when(
        lng.isNotNull() & lat.isNotNull(),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(lng.cast("double"), lat.cast("double")).alias("coordinates"),
        ),
    )


def sphere_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle metres on the mean sphere; within about 0.5 % of the ellipsoid."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((p2 - p1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    h = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lng * half_lng
    return F.lit(2 * SPHERE_RADIUS) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def geodesic_m(
    lat1: Column, lng1: Column, lat2: Column, lng2: Column, rounds: int = 200
) -> Column:
    """Metres on the WGS84 ellipsoid by Vincenty's inverse formula, null only where a coordinate is.

    Rounds run inside one ``aggregate`` expression in the JVM until the longitude difference
    settles, mostly within ten; a settled pair costs nothing more. Points so nearly opposite that it
    has not settled after ``rounds`` are solved by their azimuth, see ``_by_azimuth``.
    """
    f = WGS84_F
    far = _by_azimuth(lat1, lng1, lat2, lng2)
    u1 = F.atan((1 - f) * F.tan(F.radians(lat1)))
    u2 = F.atan((1 - f) * F.tan(F.radians(lat2)))
    ends = F.struct(
        F.sin(u1).alias("s1"),
        F.cos(u1).alias("c1"),
        F.sin(u2).alias("s2"),
        F.cos(u2).alias("c2"),
        F.radians(lng2 - lng1).alias("d"),
    )

    def arc(lam: Column, e: Column) -> Column:
        """Angular values at the current longitude difference, as a struct."""
        sx = e["c2"] * F.sin(lam)
        sy = e["c1"] * e["s2"] - e["s1"] * e["c2"] * F.cos(lam)
        sin_s = F.sqrt(sx * sx + sy * sy)
        cos_s = e["s1"] * e["s2"] + e["c1"] * e["c2"] * F.cos(lam)
        sin_a = F.coalesce(F.try_divide(e["c1"] * e["c2"] * F.sin(lam), sin_s), F.lit(0.0))
        cos2_a = 1 - sin_a * sin_a
        mid = cos_s - F.coalesce(F.try_divide(2 * e["s1"] * e["s2"], cos2_a), F.lit(0.0))
        return F.struct(
            sin_s.alias("sin_s"),
            cos_s.alias("cos_s"),
            F.atan2(sin_s, cos_s).alias("s"),
            sin_a.alias("sin_a"),
            cos2_a.alias("cos2_a"),
            F.when(F.abs(cos2_a) < 1e-15, F.lit(0.0)).otherwise(mid).alias("mid"),
        )

    def next_lambda(lam: Column, e: Column) -> Column:
        def body(a: Column) -> Column:
            c = f / 16 * a["cos2_a"] * (4 + f * (4 - 3 * a["cos2_a"]))
            inner = a["mid"] + c * a["cos_s"] * (2 * a["mid"] * a["mid"] - 1)
            return e["d"] + (1 - c) * f * a["sin_a"] * (a["s"] + c * a["sin_s"] * inner)

        return let(arc(lam, e), body)

    def length(lam: Column, e: Column) -> Column:
        def body(a: Column) -> Column:
            uu = a["cos2_a"] * ((WGS84_A**2 - WGS84_B**2) / WGS84_B**2)
            big_a = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
            big_b = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
            m = a["mid"]
            shift = (
                big_b
                * a["sin_s"]
                * (
                    m
                    + big_b
                    / 4
                    * (
                        a["cos_s"] * (2 * m * m - 1)
                        - big_b
                        / 6
                        * m
                        * (4 * a["sin_s"] * a["sin_s"] - 3)
                        * (4 * m * m - 3)
                    )
                )
            )
            return F.lit(WGS84_B) * big_a * (a["s"] - shift)

        return let(arc(lam, e), body)

    def solve(e: Column) -> Column:
        def step(state: Column) -> Column:
            return let(
                next_lambda(state["lam"], e),
                lambda lam: F.struct(lam.alias("lam"), F.abs(lam - state["lam"]).alias("moved")),
            )

        return F.aggregate(
            F.sequence(F.lit(1), F.lit(rounds)),
            F.struct(e["d"].alias("lam"), F.lit(1.0).alias("moved")),
            lambda state, _: F.when(state["moved"] > 1e-12, step(state)).otherwise(state),
            lambda state: F.when(state["moved"] <= 1e-12, length(state["lam"], e)).when(e["d"].isNotNull(), far),
        )

    return let(ends, solve)


def geodesic_pairs_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """The same metres for tables of many pairs: the rounds run over batches of pairs in Python workers; what has not settled, over single pairs."""
    settled = _vincenty_m(*(x.cast("double") for x in (lat1, lng1, lat2, lng2)))
    known = lat1.isNotNull() & lng1.isNotNull() & lat2.isNotNull() & lng2.isNotNull()
    return F.when(settled.isNotNull(), settled).when(known, _by_azimuth(lat1, lng1, lat2, lng2))


@F.arrow_udf(DoubleType())
def _vincenty_m(lat1: pa.Array, lng1: pa.Array, lat2: pa.Array, lng2: pa.Array) -> pa.Array:
    """``geodesic_m`` up to the opposite points, which are null, over a batch; pairs that have settled leave the rounds."""
    f = WGS84_F
    p1, g1, p2, g2 = (x.to_numpy(zero_copy_only=False) for x in (lat1, lng1, lat2, lng2))
    with np.errstate(all="ignore"):
        u1, u2 = np.arctan((1 - f) * np.tan(np.radians(p1))), np.arctan((1 - f) * np.tan(np.radians(p2)))
        s1, c1, s2, c2, d = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2), np.radians(g2 - g1)
        out, at, lam = np.full(len(d), np.nan), np.flatnonzero(~np.isnan(s1 + s2 + d)), None
        s1, c1, s2, c2, d = (x[at] for x in (s1, c1, s2, c2, d))
        lam = d
        for done in range(201):
            sin_l, cos_l = np.sin(lam), np.cos(lam)
            x, y = c2 * sin_l, c1 * s2 - s1 * c2 * cos_l
            sin_s, cos_s = np.sqrt(x * x + y * y), s1 * s2 + c1 * c2 * cos_l
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0.0, c1 * c2 * sin_l / sin_s)
            cos2_a = 1 - sin_a * sin_a
            mid = np.where(np.abs(cos2_a) < 1e-15, 0.0, cos_s - 2 * s1 * s2 / cos2_a)
            if done:
                still = moved > 1e-12
                uu = cos2_a * ((WGS84_A**2 - WGS84_B**2) / WGS84_B**2)
                big_a = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
                big_b = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
                turn = cos_s * (2 * mid * mid - 1) - big_b / 6 * mid * (4 * sin_s * sin_s - 3) * (4 * mid * mid - 3)
                metres = WGS84_B * big_a * (sigma - big_b * sin_s * (mid + big_b / 4 * turn))
                out[at[moved <= 1e-12]] = metres[moved <= 1e-12]
                if not still.any():
                    break
                at, lam, s1, c1, s2, c2, d = (v[still] for v in (at, lam, s1, c1, s2, c2, d))
                sin_s, cos_s, sigma, sin_a, cos2_a, mid = (v[still] for v in (sin_s, cos_s, sigma, sin_a, cos2_a, mid))
            c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
            new = d + (1 - c) * f * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid * mid - 1)))
            moved, lam = np.abs(new - lam), new
    return pa.array(out, from_pandas=True)


# Nodes and weights of the 16-point Gauss-Legendre rule on [-1, 1], worked out from its polynomial.
_NODES = tuple(zip(*(x.tolist() for x in np.polynomial.legendre.leggauss(16)), strict=True))


def _by_azimuth(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres on the ellipsoid between any two points, by bisection for the azimuth at the first.

    After C. Karney, Algorithms for geodesics (2013): with the first point south and the farther of the two
    from the equator, the longitude difference that a geodesic makes until it reaches the second latitude grows
    with its azimuth from 0 to pi, so halving always settles. The two integrals, for longitude and
    length, are taken by Gauss-Legendre quadrature; their integrands hardly vary.
    """
    f = WGS84_F
    ep2 = (WGS84_A**2 - WGS84_B**2) / WGS84_B**2
    b1, b2 = (F.atan((1 - f) * F.tan(F.radians(x))) for x in (lat1, lat2))
    turn = F.abs(F.radians(lng2 - lng1)) % (2 * math.pi)
    first = F.abs(b1) >= F.abs(b2)
    near, other = F.when(first, b1).otherwise(b2), F.when(first, b2).otherwise(b1)
    south = F.when(near > 0, -1.0).otherwise(1.0)
    ends = F.struct(
        # never quite on the equator, where an azimuth past east or west would have no meaning
        F.least(south * near, F.lit(-1e-150)).alias("b1"),
        (south * other).alias("b2"),
        F.least(turn, 2 * math.pi - turn).alias("d"),
    )

    def arc(a: Column, e: Column) -> Column:
        """The geodesic from b1 with azimuth a to where it first reaches b2 going north."""
        s1, c1, c2 = F.sin(e["b1"]), F.cos(e["b1"]), F.cos(e["b2"])
        sin0 = F.sin(a) * c1
        north2 = F.sqrt(F.greatest(F.pow(F.cos(a) * c1, F.lit(2.0)) + (c2 - c1) * (c2 + c1), F.lit(0.0)))
        start, end = F.atan2(s1, F.cos(a) * c1), F.atan2(F.sin(e["b2"]), north2)
        return F.struct(
            sin0.alias("sin0"),
            start.alias("from"),
            end.alias("to"),
            (F.atan2(sin0 * F.sin(end), F.cos(end)) - F.atan2(sin0 * F.sin(start), F.cos(start))).alias("w"),
            (ep2 * (1 - sin0 * sin0)).alias("k2"),
        )

    def integral(g: Column, of) -> Column:
        half, mid = (g["to"] - g["from"]) / 2, (g["to"] + g["from"]) / 2
        nodes = F.expr("array(" + ", ".join(f"named_struct('x', {x!r}D, 'w', {w!r}D)" for x, w in _NODES) + ")")
        root = lambda x: F.sqrt(1 + g["k2"] * F.pow(F.sin(mid + half * x), F.lit(2.0)))
        return half * F.aggregate(nodes, F.lit(0.0), lambda total, n: total + n["w"] * of(root(n["x"])))

    def longitude(g: Column) -> Column:
        return g["w"] - f * g["sin0"] * integral(g, lambda r: (2 - f) / (1 + (1 - f) * r))

    def solve(e: Column) -> Column:
        def step(s: Column) -> Column:
            middle = (s["lo"] + s["hi"]) / 2
            less = let(arc(middle, e), longitude) < e["d"]
            return F.struct(F.when(less, middle).otherwise(s["lo"]).alias("lo"), F.when(less, s["hi"]).otherwise(middle).alias("hi"))

        return F.aggregate(
            F.sequence(F.lit(1), F.lit(54)),
            F.struct(F.lit(0.0).alias("lo"), F.lit(math.pi).alias("hi")),
            lambda s, _: step(s),
            lambda s: let(arc((s["lo"] + s["hi"]) / 2, e), lambda g: F.lit(WGS84_B) * integral(g, lambda r: r)),
        )

    return let(ends, solve)


def nearest(
    df: DataFrame, lat_col: str, lng_col: str, lat: float, lng: float, n: int, tie: list[str]
) -> DataFrame:
    """The ``n`` points nearest to a place, ranked on the sphere, measured on the ellipsoid.

    Each task keeps its own best ``n``, so only n rows per task leave it; the costlier
    ellipsoid distance is worked out for the final n rows alone.
    """
    ranked = (
        df.withColumn(
            "_sphere", sphere_m(F.col(lat_col), F.col(lng_col), F.lit(lat), F.lit(lng))
        )
        .filter(F.col("_sphere").isNotNull())
        .orderBy(F.round("_sphere", 3), *[F.col(c) for c in tie])
        .limit(n)
    )
    metres = geodesic_m(F.col(lat_col), F.col(lng_col), F.lit(lat), F.lit(lng))
    return ranked.withColumn("distance_meters", metres).drop("_sphere")


def nearest_each(
    points: DataFrame,
    queries: DataFrame,
    lat_col: str,
    lng_col: str,
    query_lat: str,
    query_lng: str,
    query_key: str,
    n: int,
    tie: list[str],
    leaf: int = 64,
) -> DataFrame:
    """The ``n`` nearest points of every query point, with ``distance_meters`` and ``place`` 1 to n.

    ``query_key`` names a query; columns of the two tables must differ. Ranked on the sphere, measured on the
    ellipsoid. Points or queries without valid coordinates are left out.

    Points lie in a quadtree of cells that follows their density: each level cuts cells of more than ``leaf`` points into
    sixty-four. All queries go down it together, one level a round, and each keeps a few cells: those whose least possible
    distance is not beyond the distance within which the cells seen so far surely hold ``n`` points. So what a
    query compares does not depend on how many points crowd around it; only the points of leaves kept in the end are
    measured. Of points at one place the first ``n`` are enough. Cells and points that no query keeps are left behind.
    """
    spark = points.sparkSession

    def kept(df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(spark, f"nearest-{label}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    at_place = Window.partitionBy(lat_col, lng_col).orderBy(*tie)
    rest = kept(
        points.filter(valid_coordinates(F.col(lng_col), F.col(lat_col)))
        .withColumn("_rank", F.row_number().over(at_place))
        .filter(F.col("_rank") <= n)
        .select(F.struct(*points.columns).alias("_point"), F.col(lat_col).cast("double").alias("_lat"), F.col(lng_col).cast("double").alias("_lng")),
        "points",
    )
    asked = queries.filter(valid_coordinates(F.col(query_lng), F.col(query_lat)))
    front = asked.select(
        F.col(query_key).alias("_key"),
        F.struct(*queries.columns).alias("_query"),
        F.pmod(F.xxhash64(query_key), F.lit(64)).alias("_salt"),
        *(F.lit(0).cast("bigint").alias(c) for c in ("_level", "_row", "_col")),
        F.lit(1 << 62).alias("_n"),
        F.lit(False).alias("_leaf"),
        F.lit(0.0).alias("_least"),
        F.lit(0.0).alias("_most"),
    )
    cell, found, level = ["_row", "_col"], [], 0
    while True:
        level += 1
        side = 8**level
        index = lambda x, size: F.least(F.floor(x / size * side), F.lit(side - 1)).cast("bigint")  # noqa: B023, E731
        placed = rest.withColumns({"_row": index(F.col("_lat") + 90, 180), "_col": index(F.pmod(F.col("_lng") + 180, F.lit(360.0)), 360)})
        counts = kept(placed.groupBy(*cell).agg(F.count("*").alias("_n")).withColumn("_leaf", (F.col("_n") <= leaf) | (level >= 13)), "cells")
        children = counts.groupBy(F.expr("_row div 8").alias("_row"), F.expr("_col div 8").alias("_col")).agg(
            F.collect_list(F.struct(*cell, "_n", "_leaf")).alias("_parts")
        )
        opened = spread_join(front.filter(~F.col("_leaf")).drop("_n", "_leaf", "_least", "_most"), children, cell, "_salt", "inner", shuffled=True)
        below = opened.select("_key", "_query", "_salt", F.lit(level).cast("bigint").alias("_level"), F.explode("_parts").alias("_part")).select("_key", "_query", "_salt", "_level", "_part.*")
        spread = _cell_bounds(below, F.col(f"_query.{query_lat}"), F.col(f"_query.{query_lng}"), side)
        seen = front.filter("_leaf").unionByName(spread)
        by_reach = Window.partitionBy("_key").orderBy("_most", "_level", "_row", "_col").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        surely = F.min(F.when(F.col("_sum") >= n, F.col("_most"))).over(Window.partitionBy("_key"))
        # ranking rounds to millimetres
        near = seen.withColumn("_sum", F.sum("_n").over(by_reach)).withColumn("_bound", surely)
        front = kept(near.filter(F.col("_bound").isNull() | (F.col("_least") <= F.col("_bound") + 0.01)).drop("_sum", "_bound"), "front")
        wanted = front.filter(F.col("_level") == level).select(*cell, "_leaf").distinct()
        held = spread_join(placed.withColumn("_salt", F.pmod(F.xxhash64("_lat", "_lng"), F.lit(64))), wanted, cell, "_salt", "inner", shuffled=True)
        held = kept(held, "held")
        found.append(held.filter("_leaf").groupBy(*cell).agg(F.collect_list("_point").alias("_points")).withColumn("_level", F.lit(level).cast("bigint")))
        if front.filter(~F.col("_leaf")).isEmpty():
            break
        rest = held.filter(~F.col("_leaf")).select("_point", "_lat", "_lng")
    leaves = reduce(DataFrame.unionByName, found)
    met = spread_join(front.select("_key", "_query", "_salt", "_level", *cell), leaves, ["_level", *cell], "_salt", "inner", shuffled=True)
    compared = met.select("_query", F.explode("_points").alias("_point")).select("_query.*", "_point.*")
    sphere = sphere_m(F.col(lat_col), F.col(lng_col), F.col(query_lat), F.col(query_lng))
    order = Window.partitionBy(query_key).orderBy(F.round("_sphere", 3), *tie)
    best = compared.withColumn("_sphere", sphere).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
    metres = geodesic_m(F.col(lat_col), F.col(lng_col), F.col(query_lat), F.col(query_lng))
    return best.withColumn("distance_meters", metres).drop("_sphere")


def _cell_bounds(cells: DataFrame, lat: Column, lng: Column, side: int) -> DataFrame:
    """The least and most that a point of the cell can be away, by the triangle inequality at the cell's middle."""
    high, wide = 180 / side, 360 / side
    low = F.col("_row") * high - 90
    nearest_equator = F.when((low < 0) & (low + high > 0), 0.0).otherwise(F.least(F.abs(low), F.abs(low + high)))
    around = (F.lit(math.radians(high) / 2) + F.lit(math.radians(wide) / 2) * F.cos(F.radians(nearest_equator))) * SPHERE_RADIUS
    middle = sphere_m(lat, lng, low + high / 2, F.col("_col") * wide - 180 + wide / 2)
    return cells.withColumns({"_least": F.greatest(middle - around, F.lit(0.0)), "_most": middle + around})
