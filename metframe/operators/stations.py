"""Labelling observations with their station, and keys without observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from metframe.functions.expr import haversine_km
from metframe.operators.series import head_per, with_position
from metframe.operators.skew import is_small, lookup_join
from metframe.session import cut_lineage

INLINE_STATIONS = 512
LEAF = 16        # stations of a cube that are looked at one by one
DEEPEST = 10     # cubes of this level are some metres wide
ROUNDING = 1e-9  # of straight-line distances on the unit sphere, some millimetres


def only_keys(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is listed."""
    listed = dim.select(*on).distinct()
    if is_small(listed):
        return df.join(F.broadcast(listed), list(on), "left_semi")
    return lookup_join(df, listed, on)


def missing_keys(dim: DataFrame, df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Listed keys without any row. The rows are reduced to their keys before they meet the list."""
    return dim.join(df.select(*on).distinct(), list(on), "left_anti")


def label_by_position(df: DataFrame, batch: Sequence[str], order: Sequence[str], dim: DataFrame,
                      ordinal: str, name: str, out: str) -> DataFrame:
    """The i-th row of a batch gets the name of the i-th entry of the list (1, 2, ...).

    Rows behind the end of the list are left out: a batch is read only as far as the list goes. For
    a short list a task sends at most as many rows per batch as the list has entries; Spark does
    not cut above its own threshold, so a long list numbers the rows piece by piece.
    """
    size = int(dim.agg(F.max(ordinal)).first()[0] or 0)
    names = dim.select(F.col(ordinal).cast("long").alias("_pos"), F.col(name).alias(out))
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if size <= limit:
        placed = head_per(df, batch, [F.col(c) for c in order], size, "_pos")
    else:
        placed = with_position(df, batch, order, "_pos", "_n").drop("_n")
    return lookup_join(placed.withColumn("_pos", F.col("_pos").cast("long")), names, ["_pos"]).drop("_pos")


def nearest_station(obs: DataFrame, dim: DataFrame, lat: str, lon: str, name: str,
                    dim_lat: str, dim_lon: str, out: str = "station", km: str = "distance_km",
                    inline: int = INLINE_STATIONS) -> DataFrame:
    """Nearest listed station of each row (by name if two are equally near, to the millimetre), and the distance.

    A list of at most ``inline`` stations becomes one array constant that each row searches, without
    a join. A longer list is searched once per distinct coordinate through a tree of cells.
    """
    stations = dim.select(
        F.col(name).alias("_name"), F.col(dim_lat).cast("double").alias("_slat"),
        F.col(dim_lon).cast("double").alias("_slon"),
    ).dropna(subset=["_slat", "_slon"])
    few = stations.limit(inline + 1).collect()
    if len(few) <= inline:
        listed = F.array(*[
            F.struct(F.lit(r["_name"]).alias("n"), F.lit(r["_slat"]).alias("a"), F.lit(r["_slon"]).alias("o"))
            for r in few
        ])
        best = F.array_min(F.transform(listed, lambda s: ranked(haversine_km(F.col(lat), F.col(lon), s["a"], s["o"]), s["n"])))
        known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
        return (
            obs.withColumn("_best", F.when(known, best))
            .withColumns({out: F.col("_best.n"), km: F.col("_best.d")}).drop("_best")
        )
    spots = obs.select(lat, lon).dropna().distinct()
    found = nearest_by_cells(
        spots.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")), stations
    ).select(F.col("_lat").alias(lat), F.col("_lon").alias(lon), F.col("_name").alias(out), F.col("_km").alias(km))
    return lookup_join(obs, found, [lat, lon], "left")


def ranked(km: Column, name: Column) -> Column:
    return F.struct(F.round(km, 6).alias("r"), name.alias("n"), km.alias("d"))


AXES = ["x", "y", "z"]


def on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """With the point on the unit sphere, as ``x``, ``y`` and ``z``."""
    la, lo = F.radians(lat), F.radians(lon)
    return df.withColumns({"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)})


def cell(level: int) -> Column:
    """The cube of a point; each is cut into 4 x 4 x 4 on the next level."""
    n = 4 ** level
    x, y, z = (F.least(F.floor((F.col(a) + 1) / 2 * n), F.lit(n - 1)).cast("long") for a in AXES)
    return (x * n + y) * n + z


def children(points: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """For each cube of a level its children, and the points of the cubes that have cubes as children.

    Children are the stations themselves if they are few or the cube is of the deepest level, else the cubes inside with
    the box around their stations and one of them. One row per cube: ``cell`` and ``kids``.
    """
    here = points.withColumn("cell", cell(level))
    crowd = here.groupBy("cell").count().where((F.col("count") > LEAF) & F.lit(level < DEEPEST)).select("cell")
    crowd = cut_lineage(crowd)
    whole = {f"{end}{a}": F.col(a) for end in ("lo", "hi") for a in AXES}
    leaves = here.join(crowd, "cell", "left_anti").select("cell", child(F.lit(None).cast("long"), **whole))
    inside = here.join(crowd, "cell", "left_semi")
    box = {f"{end}{a}": f(a) for end, f in (("lo", F.min), ("hi", F.max)) for a in AXES}
    some = F.min(F.struct("_name", "_slat", "_slon", *AXES)).alias("_s")
    boxes = inside.groupBy("cell", cell(level + 1).alias("_in")).agg(some, *[c.alias(n) for n, c in box.items()])
    boxes = boxes.select("cell", "_in", "_s.*", *box).select("cell", child(F.col("_in"), **{n: F.col(n) for n in box}))
    return leaves.union(boxes).groupBy("cell").agg(F.collect_list("kid").alias("kids")), inside.drop("cell")


def child(inside: Column, **box: Column) -> Column:
    return F.struct(
        inside.alias("cell"), *[c.alias(n) for n, c in box.items()], *AXES, "_name", "_slat", "_slon").alias("kid")


def nearest_by_cells(spots: DataFrame, stations: DataFrame) -> DataFrame:
    """Exact nearest station of distinct coordinates, through a tree of the cubes in space that hold stations.

    Every spot goes down from the cube around the globe. Of the cubes it looks into it knows the box around the stations
    and one station; a cube whose box is farther than the nearest station known so far is left out. So a spot looks into
    a few cubes of each level, however many stations there are and however far it is from them. ``_pairs`` counts them.
    A level is one join on the cube, with one row per cube, and one aggregate per spot.
    """
    points = stations.groupBy("_slat", "_slon").agg(F.min("_name").alias("_name"))
    points = cut_lineage(on_sphere(points, "_slat", "_slon"))
    best = "struct<r:double,n:string,d:double>"
    left = on_sphere(spots, "_lat", "_lon").withColumns({
        "_best": F.lit(None).cast(best), "_near": F.lit(5.0), "_pairs": F.lit(0).cast("long"), "_open": F.array(F.lit(0).cast("long"))})
    done = None
    for level in range(DEEPEST + 1):
        kids, points = children(points, level)
        asked = left.withColumn("cell", F.explode("_open")).drop("_open")
        met = lookup_join(asked, cut_lineage(kids), ["cell"]).withColumn("kid", F.explode("kids")).drop("kids")
        box = sum((F.pow(F.greatest(F.col(f"kid.lo{a}") - F.col(a), F.col(a) - F.col(f"kid.hi{a}"), F.lit(0.0)), 2) for a in AXES), F.lit(0.0))
        line = sum((F.pow(F.col(f"kid.{a}") - F.col(a), 2) for a in AXES), F.lit(0.0))
        km = haversine_km(F.col("_lat"), F.col("_lon"), F.col("kid._slat"), F.col("kid._slon"))
        seen = met.groupBy("_lat", "_lon").agg(
            *[F.first(a).alias(a) for a in AXES],
            F.least(F.min("_best"), F.min(ranked(km, F.col("kid._name")))).alias("_best"),
            F.least(F.min("_near"), F.min(F.sqrt(line))).alias("_near"), (F.max("_pairs") + F.count("*")).alias("_pairs"),
            F.collect_list(F.when(F.col("kid.cell").isNotNull(), F.struct(F.col("kid.cell").alias("cell"), F.sqrt(box).alias("d")))).alias("_open"))
        nearer = F.filter("_open", lambda c: c["d"] <= F.col("_near") + ROUNDING)
        left = cut_lineage(seen.withColumn("_open", F.transform(nearer, lambda c: c["cell"])))
        through = left.where(F.size("_open") == 0)
        part = through.select("_lat", "_lon", F.col("_best.n").alias("_name"), F.col("_best.d").alias("_km"), "_pairs")
        done = part if done is None else done.unionByName(part)
        left = left.where(F.size("_open") > 0)
        if left.isEmpty():
            break
    return done
