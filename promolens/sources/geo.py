"""Sample points of polygons (F20, S13): a grid by exploded indices and ray casting in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.functions.text import geohash


def rings(wkt: Column) -> Column:
    """All rings of a WKT polygon, the outer one first, each an array of (x, y)."""
    number = lambda p, k: F.get(F.split(F.trim(p), r"\s+"), F.lit(k)).try_cast("double")
    each = F.regexp_extract_all(wkt, F.lit(r"\(([^()]*)\)"), F.lit(1))
    return F.transform(each, lambda body: F.transform(F.split(body, r"\s*,\s*"), lambda p: F.struct(number(p, 0).alias("x"), number(p, 1).alias("y"))))


def edges_of(some: Column) -> Column:
    """The sides of all rings."""
    return F.flatten(F.transform(some, lambda r: F.transform(F.sequence(F.lit(0), F.greatest(F.size(r) - 2, F.lit(0))), lambda i: F.struct(F.get(r, i).alias("a"), F.coalesce(F.get(r, i + 1), F.get(r, i)).alias("b")))))


def covers(edges: Column, x: Column, y: Column) -> Column:
    """Inside, so that a ray meets an odd number of sides and holes count, or on a border."""

    def on(e):
        a, b = e["a"], e["b"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (F.abs(cross) < 1e-12) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    def crosses(e):
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]) + a["x"])

    return F.exists(edges, on) | (F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1)


def inner_point(edges: Column) -> Column:
    """(x, y) inside a polygon, null for one without any area: the middle of its widest stretch on a
    line between two corners' heights, of the pair of heights nearest to half way up."""
    heights = F.array_sort(F.array_distinct(F.transform(edges, lambda e: e["a"]["y"])))
    half = (F.element_at(heights, 1) + F.element_at(heights, -1)) / 2
    between = F.transform(F.slice(heights, 1, F.greatest(F.size(heights) - 1, F.lit(0))), lambda h, k: (h + F.get(heights, k + 1)) / 2)
    line = F.array_min(F.transform(between, lambda y: F.struct(F.abs(y - half).alias("far"), y.alias("y"))))["y"]

    def meets(y):
        met = F.filter(edges, lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y))
        return F.array_sort(F.transform(met, lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))

    def widest(xs):
        pairs = F.filter(F.transform(xs, lambda x, k: F.when(k % 2 == 0, F.struct((x - F.get(xs, k + 1)).alias("narrow"), ((x + F.get(xs, k + 1)) / 2).alias("x")))), lambda p: p.isNotNull() & p["x"].isNotNull())
        return F.array_min(pairs)["x"]

    # arrays of one bind what is worked out once
    found = F.transform(F.array(line), lambda y: F.struct(F.element_at(F.transform(F.array(meets(y)), widest), 1).alias("x"), y.alias("y")))
    return F.element_at(F.filter(found, lambda p: p["x"].isNotNull()), 1)


# Kilometres of a degree of latitude, and of longitude at the equator; the least cosine.
LATITUDE_KM, LONGITUDE_KM, LEAST_COSINE = 110.574, 111.320, 0.2


def read_polygons(spark: SparkSession, path: str, codes: list[str] | None = None) -> DataFrame:
    """Code and WKT by position, with or without a header row; codes that are asked for; an error if none is left."""
    rows = spark.read.csv(path, header=False, quote='"', encoding="UTF-8").select(F.upper(F.trim(F.regexp_replace("_c0", "\ufeff", ""))).alias("code"), F.col("_c1").alias("wkt"))
    rows = rows.where(F.col("wkt").rlike(r"(?i)^\s*polygon\s*\(\("))
    rows = rows.where(F.col("code").isin(*codes)) if codes else rows
    if rows.isEmpty():
        raise ValueError(f"no polygon in {path}")
    return rows


def grid(polygons: DataFrame, step_km: float, precision: int = 7) -> DataFrame:
    """code, lat, lon and geohash of the points every ``step_km`` kilometres that the polygon covers.

    Rows of the grid are added up from the south as the source does, so the last digit agrees; each
    row has its own step of longitude. A geohash counts once, at its first point; holes are not
    covered, borders are. A polygon that holds no point of the grid has one inside it, and one
    without any area its first corner. Bad WKT gives none.
    """
    p = polygons.where(F.col("wkt").rlike(r"(?i)^\s*polygon\s*\(\(")).withColumn("rings", rings(F.col("wkt")))
    p = p.withColumn("ring", F.element_at("rings", 1)).withColumn("edges", edges_of(F.col("rings")))
    p = p.where(F.forall("edges", lambda e: e["a"]["x"].isNotNull() & e["a"]["y"].isNotNull() & e["b"]["x"].isNotNull() & e["b"]["y"].isNotNull()))
    low = lambda k: F.array_min(F.transform("ring", lambda q: q[k]))
    high = lambda k: F.array_max(F.transform("ring", lambda q: q[k]))
    p = p.withColumns({"x0": low("x"), "x1": high("x"), "y0": low("y"), "y1": high("y")})
    line = lambda start, stop, step: F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil((stop - start) / step).cast("int") + 1)), F.array(start), lambda seen, _: F.concat(seen, F.array(F.element_at(seen, -1) + step)))
    rows = p.withColumn("y", F.explode(F.filter(line(F.col("y0"), F.col("y1"), F.lit(step_km / LATITUDE_KM)), lambda v: v <= F.col("y1"))))
    rows = rows.withColumn("dx", F.lit(step_km) / (LONGITUDE_KM * F.greatest(F.lit(LEAST_COSINE), F.cos(F.radians("y")))))
    rows = rows.withColumn("x", F.explode(F.filter(line(F.col("x0"), F.col("x1"), F.col("dx")), lambda v: v <= F.col("x1"))))
    inside = rows.where(covers(F.col("edges"), F.col("x"), F.col("y"))).withColumn("geohash", geohash(F.col("y"), F.col("x"), precision))
    points = inside.groupBy("code", "geohash").agg(F.min(F.struct(F.col("y").alias("lat"), F.col("x").alias("lon"))).alias("p")).select("code", "p.lat", "p.lon", "geohash")
    first, inner = F.get("ring", F.lit(0)), inner_point(F.col("edges"))
    rest = p.join(points.select("code").distinct(), "code", "left_anti").withColumn("p", F.coalesce(inner, first))
    rest = rest.select("code", F.col("p.y").alias("lat"), F.col("p.x").alias("lon"))
    return points.unionByName(rest.withColumn("geohash", geohash(F.col("lat"), F.col("lon"), precision)))
