"""Cards and menu entries of a rendered page, given as the lines of text that each one shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions import text
from promolens.operators.legacy import clean_lines, excluded, infer_name, infer_promotion, is_metric, is_promotion


def _first(lines: Column, test) -> Column:
    return F.get(F.filter(lines, test), F.lit(0))


def _once(rows: DataFrame, point: str, key: list[Column], columns: list[str]) -> DataFrame:
    """The first row in order of ``place`` of each key within a point."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(key)]
    best = rows.select(point, "place", *named, F.struct("place", *columns).alias("x")).groupBy(point, *[f"_k{i}" for i in range(len(key))]).agg(F.min_by("x", "place").alias("x"))
    return best.select(point, "x.place", *[f"x.{c}" for c in columns])


def cards(captured: DataFrame, point: str = "point") -> DataFrame:
    """(point, place, lines, href) to restaurant_name, promotion_type, source_url, once a point.

    A card without a name, also from its address, is left out; of cards with one name and one
    promotion the first one stays.
    """
    rows = captured.select(point, "place", infer_name(F.col("lines"), F.col("href")).alias("restaurant_name"), infer_promotion(F.coalesce("lines", F.array().cast("array<string>"))).alias("promotion_type"), text.clean_text(F.col("href")).alias("source_url"))
    return _once(rows.where("restaurant_name <> ''"), point, [text.fold(F.col("restaurant_name")), F.lower("promotion_type")], ["restaurant_name", "promotion_type", "source_url"])


def promoted(found: DataFrame) -> DataFrame:
    """Cards that go on into the listing: with a promotion that is not about delivery alone."""
    return found.where((F.col("promotion_type") != "") & ~excluded(F.col("promotion_type")))


def point_status(points: DataFrame, found: DataFrame, point: str = "point") -> DataFrame:
    """How many cards each point showed, and whether it counts as covered."""
    counts = found.groupBy(point).agg(F.count("*").alias("n"))
    out = points.select(point).distinct().join(counts, point, "left").withColumn("restaurant_count", F.coalesce("n", F.lit(0)))
    return out.select(point, F.when(F.col("restaurant_count") > 0, "covered").otherwise("no_restaurants_found").alias("status"), "restaurant_count")


def menu_entries(captured: DataFrame, point: str = "point") -> DataFrame:
    """(point, place, promotion_type, lines) to product_name, product_description, product_price of entries that tell a promotion.

    The name is the first line that is neither promotion nor measure, else the first line, unless
    that is the promotion; the price the first line with a euro sign; the description the first
    later line that is none of these. One name, price and promotion once a point.
    """
    lines = clean_lines(F.col("lines"))
    rows = captured.select(point, "place", "promotion_type", lines.alias("lines")).where(F.exists("lines", is_promotion))
    plain = lambda x: ~is_promotion(x) & ~is_metric(x)
    rows = rows.withColumn("product_name", F.coalesce(_first(F.col("lines"), plain), F.get("lines", F.lit(0)))).where(~is_promotion(F.col("product_name")))
    rows = rows.withColumn("product_price", F.coalesce(_first(F.col("lines"), lambda x: F.contains(x, F.lit("€"))), F.lit("")))
    later = F.slice("lines", 2, F.size("lines"))
    told = _first(later, lambda x: (x != F.col("product_name")) & (x != F.col("product_price")) & plain(x))
    rows = rows.withColumn("product_description", F.coalesce(told, F.lit("")))
    key = [text.fold(F.col("product_name")), text.fold(F.col("product_price")), text.fold(F.col("promotion_type"))]
    return _once(rows, point, key, ["product_name", "product_description", "product_price", "promotion_type"])
