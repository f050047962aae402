"""Store aggregates, competitor index, verdicts and city roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import promo
from promolens.functions.text import canonical_url, clean_text, fold, store_name

KEY = ("city_code", "store_name", "week_num")
MATCHED = ("SUPERIORITY", "PARITY", "INFERIORITY")
#: What a verdict takes from a competitor.
SAID = ("promotion_type", "comp_rank", "comp_pct", "comp_basket")


def promo_view(products: DataFrame, member: bool = False) -> DataFrame:
    """Flag, kind and percentage of each product; in the member view its own promotion comes first."""
    c = F.col
    on = c("promotion_prime") == "Y"
    flag, kind, pct = c("promo_non_prime"), c("type_of_promo_np"), c("percentage_off_np")
    if member:
        flag, kind, pct = F.when(on, "Y").otherwise(flag), F.when(on, c("type_of_promo_p")).otherwise(kind), F.when(on, c("percentage_off_p")).otherwise(pct)
    out = products.withColumns({"flag": flag, "kind": kind, "pct": pct, "revenue": c("avg_unit_price") * c("total_product_sold")})
    counts = c("kind").contains("PERCENTAGE_DISCOUNT") | c("kind").contains("BASKET_PERCENTAGE")
    return out.withColumns({"pct": F.when(counts, c("pct")).otherwise(0.0), "promo_revenue": F.when(c("flag") == "Y", c("revenue")).otherwise(0.0)})


def _covered(rows: DataFrame, of: str = "") -> tuple[DataFrame, list[Column]]:
    """Sums of what each kind covers, NULL where no active product has it: kinds are few and known, so
    they are columns of the grouping at hand and take no scan or shuffle of their own."""
    rows = rows.withColumn(f"strongest{of}", F.when(F.col(f"flag{of}") == "Y", promo.strongest_kind(F.col(f"kind{of}"))))
    return rows, [F.sum(F.when(F.col(f"strongest{of}") == k, F.coalesce("revenue", F.lit(0.0)))).alias(f"{k}{of}") for k in promo.KIND_RANKS]


def _dominant(of: str = "") -> Column:
    """Of those sums the largest, ties to the better rank, as a struct of rank and kind."""
    sums = {k: F.col(f"{k}{of}") for k in promo.KIND_RANKS}
    return F.array_min(F.array(*[F.when(x.isNotNull(), F.struct((-F.round(x, 4)).alias("covered"), F.lit(promo.KIND_RANKS[k]).alias("best_promo_rank"), F.lit(k).alias("best_promo_type"))) for k, x in sums.items()]))


def dominant_promo(view: DataFrame) -> DataFrame:
    """The strongest kind that covers most revenue, ties to the better rank."""
    view, sums = _covered(view.where("flag = 'Y'"))
    return view.groupBy(*KEY).agg(*sums).withColumn("x", _dominant()).where("x is not null").select(*KEY, "x.best_promo_type", "x.best_promo_rank")


def store_aggregate(products: DataFrame, member: bool = False) -> DataFrame:
    """One row a store and week, the dominant promotion (A02) from the same grouping."""
    return _aggregate(products, {"": member}).select(*KEY, *_seen())


def both_aggregates(products: DataFrame) -> DataFrame:
    """A01 for both views, named by a column view: they share the products' joins, scans and shuffles."""
    views = {"_standard": False, "_member": True}
    rows = [F.struct(F.lit(v[1:]).alias("view"), *_seen(v)) for v in views]
    return _aggregate(products, views).select(*KEY, F.inline(F.array(*rows)))


def _aggregate(products: DataFrame, views: dict[str, bool]) -> DataFrame:
    """A row a store and week with the sums of each view. Names are counted beside them: a grouping by
    name has nearly a row a product, and sums would make each of them wide."""
    rows, sums, on = products.dropna(subset=list(KEY)), [], {}
    for of, member in views.items():
        rows = promo_view(rows, member).withColumnsRenamed({x: x + of for x in ("flag", "kind", "pct", "promo_revenue")})
        rows, covered = _covered(rows, of)
        kind, pct, on[of] = F.col(f"kind{of}"), F.col(f"pct{of}"), F.col(f"flag{of}") == "Y"
        some = F.when(on[of] & (pct > 0), pct)
        sums += [
            F.round(F.avg(some), 1).alias(f"avg_pct_off{of}"), F.round(F.max(some), 1).alias(f"max_pct_off{of}"),
            F.round(F.max(F.when(on[of] & (kind == "BASKET_PERCENTAGE"), F.col("min_basket_size_np"))), 0).alias(f"min_basket_size{of}"),
            F.sum(f"promo_revenue{of}").alias(f"p{of}"), *covered,
        ]
    names = rows.where(reduce(Column.__or__, on.values())).groupBy(*KEY, "product_name").agg(*[F.max(x).alias(f"on{of}") for of, x in on.items()])
    names = names.where("product_name is not null").groupBy(*KEY).agg(*[F.count(F.when(F.col(f"on{of}"), 1)).alias(f"n{of}") for of in views])
    out = rows.groupBy(*KEY).agg(F.sum("total_product_sold").cast("long").alias("total_sold"), F.sum("revenue").alias("r"), *sums)
    return out.withColumns({f"x{of}": _dominant(of) for of in views}).join(names, list(KEY), "left")


def _seen(of: str = "") -> list[Column]:
    """The columns of one view of _aggregate."""
    c, r, x, p = lambda name: F.col(f"{name}{of}").alias(name), F.col("r"), F.col(f"x{of}"), F.col(f"p{of}")
    return [
        x["best_promo_type"].alias("best_promo_type"), F.coalesce(x["best_promo_rank"], F.lit(promo.NO_PROMO)).alias("best_promo_rank"), c("avg_pct_off"), c("max_pct_off"), c("min_basket_size"),
        F.coalesce(F.col(f"n{of}"), F.lit(0).cast("long")).alias("promo_product_count"), F.col("total_sold"), F.round(r, 2).alias("revenue"), F.round(p, 2).alias("promo_revenue"),
        F.when(r > 0, F.round(p / r * 100, 1)).otherwise(0.0).alias("promo_coverage_pct"),
    ]


def store_totals(index: DataFrame) -> DataFrame:
    """Branches of each name in a city."""
    return index.groupBy("city_code", "name_norm").agg(F.countDistinct("store_id").alias("n_stores_total"))


def listing(raw: DataFrame, index: DataFrame) -> DataFrame:
    """A10: a row for each name and promotion with its branches (distinct bare addresses), capped by all of them."""
    url = F.coalesce(F.trim("source_url"), F.lit(""))
    raw = raw.groupBy("city_code", "restaurant_name", "promotion_type", canonical_url(url).alias("address"), (url == "").alias("bare")).agg(F.min("seq").alias("seq"))  # texts are cleaned once a branch
    name = clean_text(F.col("restaurant_name"))
    place = F.when(F.col("bare"), name).otherwise(F.col("address"))
    rows = raw.select(F.upper(clean_text(F.col("city_code"))).alias("city_code"), fold(name).alias("name_norm"), clean_text(F.col("promotion_type")).alias("promotion_type"), name.alias("restaurant_name"), place.alias("place"), "seq")
    rows = rows.where("city_code <> '' and restaurant_name <> ''")
    seen = rows.groupBy("city_code", "name_norm", "promotion_type").agg(F.min_by("restaurant_name", "seq").alias("restaurant_name"), F.countDistinct("place").alias("n"), F.min("seq").alias("first_seq"))
    out = seen.join(store_totals(index), ["city_code", "name_norm"], "left").withColumn("n_stores_total", F.coalesce("n_stores_total", "n"))
    out = out.withColumn("n_stores_with_promo", F.least("n", "n_stores_total"))
    return out.select("city_code", "name_norm", "restaurant_name", "promotion_type", "first_seq", "n_stores_with_promo", "n_stores_total", F.bround(F.col("n_stores_with_promo") / F.col("n_stores_total") * 100, 0).alias("stores_pct"))


def competitor_index(listed: DataFrame) -> DataFrame:
    """The strongest promotion that half of the branches have, else the most common one."""
    rows = listed.withColumns({"comp_rank": promo.rank_of_text(F.col("promotion_type")), "comp_pct": promo.percent_of_text(F.col("promotion_type")), "comp_basket": promo.basket_of_text(F.col("promotion_type"))})
    rows = rows.withColumn("name_norm", store_name(F.col("restaurant_name")))
    wide = F.col("stores_pct") >= 50
    order = F.struct((~wide).cast("int").alias("a"), F.when(wide, 0.0).otherwise(-F.col("stores_pct")).alias("b"), F.col("comp_rank").alias("c"), (-F.col("comp_pct")).alias("d"), F.col("promotion_type").alias("e"))
    best = rows.groupBy("city_code", "name_norm").agg(F.min_by(F.struct("promotion_type", "comp_rank", "comp_pct", "comp_basket", "stores_pct"), order).alias("x"))
    return best.select("city_code", "name_norm", "x.*")


def shared_branches(links: DataFrame, pools: DataFrame, index: DataFrame) -> DataFrame:
    """Branches of stores that share their names: of a pool's names with one promotion the first alone
    can be the most aggressive one, so a store meets a pool's promotions and not its names."""
    names = pools.select("city_code", "pool", store_name(F.col("comp_name")).alias("name_norm")).where("name_norm <> ''").join(index, ["city_code", "name_norm"], "left")
    first = names.groupBy("city_code", "pool", *SAID).agg(F.min("name_norm").alias("name_norm"))
    return links.where("pool is not null").select("city_code", "store_name", "pool").distinct().join(first, ["city_code", "pool"])


def store_verdicts(stores: DataFrame, mapping: DataFrame, index: DataFrame, order_values: DataFrame, pools: DataFrame | None = None) -> DataFrame:
    """The verdict of each store and week against its most aggressive branch.

    mapping: city_code, store_name, comp_name; a blank comp_name says why there is none by its source:
    a rejection by hand makes the store exclusive, also beside an absence from the other side, and
    any other source leaves it unmatched. An order value counts for its own week.
    pools: city_code, pool, comp_name, lists of names that stores share; a row of the mapping with a
    pool stands for all names of it. Stores with a column view have a verdict in each view.
    """
    key = [*KEY, *(c for c in stores.columns if c == "view")]
    norm = (mapping if pools is None else mapping.where("pool is null")).select("city_code", "store_name", store_name(F.col("comp_name")).alias("name_norm"), "source")
    said = lambda source: F.bool_or(F.col("source") == source)
    why = F.when(said("manual_rejected"), "EXCLUSIVE_OWN").when(said("not_on_comp"), "NOT_ON_COMP")
    absent = norm.where("name_norm = ''").groupBy("city_code", "store_name").agg(why.alias("why"))
    branches = norm.where("name_norm <> ''").join(index, ["city_code", "name_norm"], "left").select("city_code", "store_name", "name_norm", *SAID)
    if pools is not None:
        branches = branches.unionByName(shared_branches(mapping, pools, index).drop("pool"))
    own = stores.join(order_values, list(KEY), "left").withColumn("own_rank", promo.order_value_rank(F.col("best_promo_rank"), F.col("min_basket_size"), F.col("order_value")))
    met = own.join(branches, ["city_code", "store_name"], "left").join(absent, ["city_code", "store_name"], "left")
    rank = F.coalesce(promo.order_value_rank(F.col("comp_rank"), F.col("comp_basket"), F.col("order_value")), F.lit(promo.NO_PROMO))
    pct = F.coalesce("max_pct_off", "avg_pct_off", F.lit(0.0))
    met = met.withColumn("comp_rank", rank).withColumn(
        "parity", promo.verdict(F.col("own_rank"), F.col("comp_rank"), pct, F.col("comp_pct"), F.col("promo_product_count"), F.col("min_basket_size"), F.col("comp_basket"), promo.own_scope(F.col("best_promo_type")), promo.text_scope(F.col("promotion_type")))
    )
    met = met.withColumn("parity", F.when(F.col("name_norm").isNotNull(), F.col("parity")).otherwise(F.coalesce("why", F.lit("UNMATCHED"))))
    severity = F.when(F.col("parity") == "INFERIORITY", 0).when(F.col("parity") == "PARITY", 1).otherwise(2)
    order = F.struct(severity.alias("a"), F.col("comp_rank").alias("b"), (-F.coalesce("comp_pct", F.lit(0.0))).alias("c"), F.coalesce("name_norm", F.lit("")).alias("d"))
    best = met.groupBy(*key).agg(F.min_by(F.struct("name_norm", "own_rank", "comp_rank", "parity", "revenue", "promo_coverage_pct", "best_promo_type"), order).alias("x"))
    return best.select(*key, "x.*")


def side_by_side(verdicts: DataFrame) -> DataFrame:
    """The verdicts of both views in one row a store and week."""
    of = lambda view: F.max(F.when(F.col("view") == view, F.col("parity"))).alias(f"{view}_parity")
    return verdicts.groupBy(*KEY).agg(of("standard"), F.max(F.when(F.col("view") == "standard", F.col("revenue"))).alias("revenue"), of("member"))


def city_rollup(verdicts: DataFrame) -> DataFrame:
    """Counts, shares, revenue-weighted shares, label and coverage, of each view where there is one."""
    key = ["city_code", "week_num", *(c for c in verdicts.columns if c == "view")]
    c, rows = F.col, verdicts.where("parity <> 'NOT_ON_OWN'")
    count = lambda *names: F.count(F.when(c("parity").isin(*names), 1))
    total = lambda *names: F.sum(F.when(c("parity").isin(*names), c("revenue")).otherwise(0.0))
    out = rows.groupBy(*key).agg(
        F.count("*").alias("n_stores_total"), count(*MATCHED).alias("n_stores_matched"), count("UNMATCHED").alias("n_unmatched"), count("EXCLUSIVE_OWN", "NOT_ON_COMP").alias("n_exclusive_own"),
        *[count(v).alias(f"n_{v.lower()}") for v in MATCHED], *[total(v).alias(f"r_{v.lower()}") for v in MATCHED], total(*MATCHED).alias("r"),
    )
    for v in map(str.lower, MATCHED):
        out = out.withColumn(f"pct_{v}", F.when(c("n_stores_matched") > 0, F.round(c(f"n_{v}") / c("n_stores_matched") * 100, 1)).otherwise(0.0))
        out = out.withColumn(f"w_{v}", F.when(c("r") > 0, F.round(c(f"r_{v}") / c("r") * 100, 1)).otherwise(c(f"pct_{v}")))
    top = F.greatest("w_superiority", "w_parity", "w_inferiority")
    label = F.when(c("w_superiority") == top, "SUPERIORITY").when(c("w_parity") == top, "PARITY").otherwise("INFERIORITY")
    open_ = c("n_stores_total") - c("n_exclusive_own")
    out = out.withColumn("city_parity_label", label).withColumn("match_coverage_pct", F.when(open_ > 0, F.round(c("n_stores_matched") / open_ * 100, 1)).otherwise(0.0))
    return out.drop("r", "r_superiority", "r_parity", "r_inferiority")


def member_delta(verdicts: DataFrame) -> DataFrame:
    """Stores whose verdict differs between the views."""
    rank = lambda x: F.when(F.col(x) == "SUPERIORITY", 0).when(F.col(x) == "PARITY", 1).when(F.col(x) == "INFERIORITY", 2).otherwise(9)
    out = side_by_side(verdicts).where("standard_parity <> member_parity")
    return out.withColumn("direction", F.when(rank("member_parity") < rank("standard_parity"), "improves").otherwise("worsens"))


def national_trend(cities: DataFrame) -> DataFrame:
    """The plain mean over cities."""
    return cities.groupBy("week_num").agg(*[F.round(F.avg(f"w_{v.lower()}"), 1).alias(f"w_{v.lower()}") for v in MATCHED], F.sum("n_stores_matched").alias("n_stores_matched"))


def week_delta(cities: DataFrame) -> DataFrame:
    """Each city's change against its week before."""
    w = Window.partitionBy("city_code").orderBy("week_num")
    score = F.col("w_superiority") - F.col("w_inferiority")
    out = cities.withColumn("score", score).withColumn("before", F.lag("score").over(w)).where("before is not null")
    return out.select("city_code", "week_num", F.round("score", 1).alias("score"), F.round(F.col("score") - F.col("before"), 1).alias("delta"))
