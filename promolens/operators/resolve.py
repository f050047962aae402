"""Matching of stores and products across the two sides (J01, J03, J08, A12, W01, W10; parts of J13, J14, A13)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.operators import likeness

# Scores from which a match stands by itself or goes to review, and the gap to the runner-up.
AUTO, GAP, REVIEW = 88.0, 10.0, 70.0
#: Stores of either side that one task compares at most, rows that it multiplies at once, names at once, and tasks at most.
BLOCK, STEP, WIDTH, TASKS = 2000, 256, 4096, 20_000


def truth_lookup(stores: DataFrame, mapping: DataFrame) -> DataFrame:
    """All known names of a store on the other side; none leaves NULL."""
    known = mapping.select("city_code", F.lower(F.trim("store_name")).alias("k"), "comp_name", "source")
    return stores.withColumn("k", F.lower(F.trim("store_name"))).join(known, ["city_code", "k"], "left").drop("k")


def not_on_own(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Competitors with a promotion that no mapping row reaches, each once."""
    known = mapping.select("city_code", F.lower(F.trim("comp_name")).alias("k")).distinct()
    names = raw.where("promotion_type <> ''").select("city_code", "restaurant_name").distinct()
    return names.withColumn("k", F.lower(F.trim("restaurant_name"))).join(known, ["city_code", "k"], "left_anti").drop("k")


def best_two(names: DataFrame, choices: DataFrame) -> DataFrame:
    """The best partner of each sorted name within its city, the runner-up's score, and what follows.

    names: city_code, a; choices: city_code, b; a name that is among its city's choices is no partner
    of itself. Ties go to the smaller name.
    """
    order = Window.partitionBy("city_code").orderBy("b")
    placed = choices.withColumn("place", F.row_number().over(order))
    found = likeness.nearest(names, placed, 3).withColumn("best", F.slice(F.filter("best", lambda x: x["b"] != F.col("a")), 1, 2))
    first, second = F.get("best", F.lit(0)), F.coalesce(F.get("best", F.lit(1))["score"], F.lit(0.0))
    top = found.where(F.size("best") > 0).select("city_code", "a", first["b"].alias("b"), first["score"].alias("score"), second.alias("second"))
    outcome = F.when((F.col("score") >= AUTO) & (F.col("score") - F.col("second") >= GAP), "auto").when(F.col("score") >= AUTO, "ambiguous").when(F.col("score") >= REVIEW, "below_threshold").otherwise("silent")
    return top.withColumn("outcome", outcome)


def price_band(left: DataFrame, right: DataFrame, on: list[str], width: float = 1.0, rel: float = 0.05) -> DataFrame:
    """The band of J14, without its name score and without leaving out hits by name: prices within ``width`` and within ``rel`` of the larger one, by an equi-join on neighbouring buckets."""
    a = left.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("pa") / width) - 1, F.floor(F.col("pa") / width) + 1)))
    b = right.withColumn("bucket", F.floor(F.col("pb") / width))
    gap = F.abs(F.col("pa") - F.col("pb"))
    return a.join(b, [*on, "bucket"]).where((gap <= width) & (gap <= rel * F.greatest("pa", "pb"))).drop("bucket")


def _shared_names(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """The best own store of one block for each competitor store of one block, by products of 0/1 matrices."""
    theirs, mine = frame[frame["side"] == 0], frame[frame["side"] == 1].sort_values("store")
    out = []
    if len(theirs) and len(mine):
        names = mine["store"].tolist()
        column = {n: k for k, n in enumerate({n for menu in theirs["menu"] for n in menu})}
        for start in range(0, len(theirs), STEP):
            some = theirs.iloc[start : start + STEP]
            shared = np.zeros((len(some), len(mine)), np.float32)
            for low in range(0, len(column), WIDTH):
                left, right = (np.zeros((len(f), min(WIDTH, len(column) - low)), np.float32) for f in (some, mine))
                for side, menus in ((left, some["menu"]), (right, mine["menu"])):
                    for k, menu in enumerate(menus):
                        side[k, [c - low for c in map(column.get, menu) if c is not None and low <= c < low + WIDTH]] = 1
                shared += left @ right.T
            best = shared.argmax(axis=1)  # the first of the most: own stores stand in order
            out += [(key[0], comp, names[j], int(shared[k, j])) for k, (comp, j) in enumerate(zip(some["store"], best, strict=True)) if shared[k, j]]
    return pd.DataFrame(out, columns=["city_code", "comp", "own", "n_overlap"])


def fingerprint(comp: DataFrame, own: DataFrame, least: int = 4, block: int | None = None) -> DataFrame:
    """J13 and the overlap of A13, without hits that prices confirm: for each competitor store the own store whose menu shares most product names.

    A menu is a row; stores of a city are dealt to blocks, and a block of either side meets each block of the
    other in a task of its own, which pairs of stores never leave.
    """
    size = BLOCK if block is None else block
    menus = lambda df: df.where("city_code is not null and store_name is not null").groupBy("city_code", F.col("store_name").alias("store")).agg(F.collect_set("n").alias("menu"), F.count_if(F.col("n").isNull()).alias("nulls"))
    c = menus(comp).withColumn("products", F.size("menu") + (F.col("nulls") > 0).cast("int")).where(F.col("products") >= least)
    o = menus(own)
    blocks = lambda df, n: df.groupBy("city_code").agg(F.ceil(F.count("*") / size).cast("int").alias(n))
    counts = blocks(c, "i").join(blocks(o, "j"), "city_code")  # a row a city
    dealt = lambda n: F.pmod(F.xxhash64("store"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = c.join(counts, "city_code").select("city_code", F.lit(0).alias("side"), "store", "menu", dealt("i").alias("x"), every("j").alias("y"))
    right = o.join(counts, "city_code").select("city_code", F.lit(1).alias("side"), "store", "menu", every("i").alias("x"), dealt("j").alias("y"))
    tasks = min(counts.agg(F.coalesce(F.sum(F.col("i").cast("long") * F.col("j")), F.lit(1))).first()[0], TASKS)  # a number
    found = left.unionByName(right).repartition(tasks, "city_code", "x", "y").groupBy("city_code", "x", "y").applyInPandas(_shared_names, "city_code string, comp string, own string, n_overlap long")
    best = found.groupBy("city_code", "comp").agg(F.min_by(F.struct("own", "n_overlap"), F.struct(-F.col("n_overlap"), "own")).alias("x")).select("city_code", "comp", "x.*")
    sizes = c.select("city_code", F.col("store").alias("comp"), F.col("products").cast("long").alias("products"))
    return best.join(sizes, ["city_code", "comp"]).withColumn("ratio", F.round(F.col("n_overlap") / F.col("products"), 2))


def concat_distinct(df: DataFrame, key: list[str], value: str, order: str, sep: str = " | ") -> DataFrame:
    """Distinct values of each key in order of first sight."""
    once = df.groupBy(*key, value).agg(F.min(order).alias("first"))
    rows = F.array_sort(F.collect_list(F.struct("first", value)))
    return once.groupBy(*key).agg(F.array_join(F.transform(rows, lambda x: x[value]), sep).alias("promotions"))


def longest_streak(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """The longest run of equal values in order (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(*order)
    new = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    islands = df.withColumn("new", new).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "island").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("longest"))
