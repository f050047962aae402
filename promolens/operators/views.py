"""What a reader of the verdicts sees: detail, drill-down, counters, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators.parity import KEY, MATCHED, side_by_side

#: Rows of a detail table that are shown.
SHOWN = 1000


def comp_counts(products: DataFrame) -> DataFrame:
    """Distinct promoted products of each competitor name and week; blank names would meet every unmatched store."""
    rows = products.withColumn("name_norm", text.store_name(F.col("restaurant_name"))).where("trim(restaurant_name) <> ''")
    return rows.groupBy("city_code", "name_norm", "week_num").agg(F.countDistinct("product_name").alias("comp_products"))


def one_of(column: str, chosen: list[str]) -> Column:
    """A choice of values; none chosen is no filter."""
    return F.col(column).isin(*chosen) if chosen else F.lit(True)


def like(column: str, pattern: str) -> Column:
    """A search by pattern that ignores case; none is no filter."""
    return F.col(column).rlike(f"(?iu){pattern}") if pattern else F.lit(True)


def holds(column: str, part: str) -> Column:
    """A search that ignores case and accents."""
    return F.contains(text.fold(F.col(column)), text.fold(F.lit(part)))


def store_detail(verdicts: DataFrame, counts: DataFrame, cities=(), weeks=(), verdict=(), search: str = "", sort: str = "revenue") -> DataFrame:
    """Q02: verdicts with the competitor's product count, real labels, filters, the chosen order and the display cap."""
    rows = verdicts.where(one_of("city_code", list(cities)) & one_of("week_num", list(weeks)) & one_of("parity", list(verdict)) & like("store_name", search))
    rows = rows.join(counts, ["city_code", "name_norm", "week_num"], "left").withColumn("comp_products", F.coalesce("comp_products", F.lit(0)))
    rows = rows.withColumns({"own_label": promo.true_label(F.col("best_promo_type"), promo.rank_label(F.col("own_rank"))), "comp_label": promo.rank_label(F.col("comp_rank"))})
    order = [F.desc("revenue")] if sort == "revenue" else [F.asc(sort)]
    out = rows.orderBy(*order, *KEY).limit(SHOWN)
    return out.select(*KEY, "parity", "own_label", "comp_label", "comp_products", F.round("revenue", 2).alias("revenue"))


def boost(verdicts: DataFrame) -> DataFrame:
    """Each member verdict beside the store's last standard one, and whether it is better."""
    last = F.max_by("standard_parity", F.when(F.col("standard_parity").isNotNull(), F.col("week_num"))).over(Window.partitionBy("city_code", "store_name"))
    level = lambda c: F.when(F.col(c) == "SUPERIORITY", 2).when(F.col(c) == "PARITY", 1).when(F.col(c) == "INFERIORITY", 0)
    rows = side_by_side(verdicts).withColumn("standard_parity", last).where("member_parity is not null").withColumnRenamed("member_parity", "parity")
    badge = F.when(level("parity") > level("standard_parity"), "boost").when(level("parity") < level("standard_parity"), "drop").otherwise("")
    return rows.select(*KEY, "parity", "standard_parity", badge.alias("badge"))


def member_stores(products: DataFrame) -> DataFrame:
    """Q08: stores and weeks that have a product with a promotion of their own for members."""
    return products.where("promotion_prime = 'Y'").select(*KEY).distinct()


def member_coverage(products: DataFrame, shown: DataFrame) -> DataFrame:
    """How many of the shown rows' stores have such a promotion; by name alone, as they are shown."""
    some = member_stores(products).join(shown.select("city_code", "store_name"), ["city_code", "store_name"], "left_semi").agg(F.countDistinct("store_name").alias("n_member"))
    return shown.agg(F.count("*").alias("n_shown")).crossJoin(some).withColumn("pct", F.when(F.col("n_shown") > 0, F.round(F.col("n_member") / F.col("n_shown") * 100, 1)).otherwise(0.0))  # one row each


def counters(cities: DataFrame, verdicts: DataFrame, mapping: DataFrame) -> DataFrame:
    """The figures on top of the pages: cities by label, mean coverage, revenue at risk, mapping rows by state."""
    count = lambda what, name: F.count(F.when(what, 1)).alias(name)
    a = cities.agg(*[count(F.col("city_parity_label") == v, f"cities_{v.lower()}") for v in MATCHED], F.round(F.avg("match_coverage_pct"), 1).alias("mean_coverage"))
    b = verdicts.agg(F.round(F.sum(F.when(F.col("parity") == "INFERIORITY", F.col("revenue")).otherwise(0.0)), 2).alias("revenue_at_risk"))
    c = mapping.agg(count(F.col("comp_name") != "", "mapped"), count(F.col("source") == "manual_rejected", "exclusive"), count(F.col("source") == "not_on_comp", "absent"))
    return a.crossJoin(b).crossJoin(c)  # one row each


def member_kpis(cities: DataFrame) -> DataFrame:
    """Sums of stores and plain means of their shares in both views, and the difference."""
    of = lambda view, c: F.when(F.col("view") == view, F.col(c))
    n, p = [f"n_{v.lower()}" for v in MATCHED], [f"pct_{v.lower()}" for v in MATCHED]
    both = cities.agg(*[f(of(view, c)).alias(f"{view}_{c}") for view in ("standard", "member") for f, cs in ((F.sum, n), (F.avg, p)) for c in cs])
    return both.select(*[f"member_{x}" for x in n], *[(F.col(f"member_{x}") - F.col(f"standard_{x}")).alias(f"delta_{x}") for x in n], *[F.round(F.col(f"member_{x}") - F.col(f"standard_{x}"), 1).alias(f"delta_{x}") for x in p])


def national_delta(trend: DataFrame) -> DataFrame:
    """The latest week's national means against the week before."""
    w = Window.orderBy("week_num")  # a row a week
    shares = [f"w_{v.lower()}" for v in MATCHED]
    rows = trend.select("week_num", *shares, *[F.round(F.col(s) - F.lag(s).over(w), 1).alias(f"delta_{s[2:]}") for s in shares])
    return rows.orderBy(F.desc("week_num")).limit(1)


def rank_history(verdicts: DataFrame, city: str, store: str) -> DataFrame:
    """A store's ranks on both sides by week."""
    return verdicts.where((F.col("city_code") == city) & (F.col("store_name") == store)).select("week_num", "own_rank", "comp_rank", "parity").orderBy("week_num")


def drill_products(products: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Each store's products of its week: those that carry the compared promotion side by
    side, the others listed; none where there is nothing to compare. Active ones first, then by price."""
    kept = verdicts.where(F.col("parity").isin(*MATCHED)).select(*KEY, "best_promo_type")
    rows = products.join(kept, list(KEY))
    carries = (F.col("flag") == "Y") & promo.strongest_kind(F.col("kind")).eqNullSafe(F.col("best_promo_type"))
    once = rows.groupBy(*KEY, "product_name").agg(F.max(F.coalesce(carries, F.lit(False))).alias("carries"), F.max("avg_unit_price").alias("price"))
    return once.groupBy(*KEY).agg(F.count(F.when(F.col("carries"), 1)).alias("n_carrying"), F.max(F.when(F.col("carries"), F.col("price"))).alias("dearest"),
                                  F.array_join(F.array_sort(F.collect_set(F.when(~F.col("carries"), F.col("product_name")))), "|").alias("others"))


def display(verdicts: DataFrame) -> DataFrame:
    """money with dots for thousands, shares, and the names of the verdicts as they are shown."""
    money = F.concat(F.translate(F.format_number(F.col("revenue"), 0), ",", "."), F.lit(" €"))
    shown = F.when(F.col("parity") == "EXCLUSIVE_OWN", "Exclusive").when(F.col("parity") == "NOT_ON_COMP", "Not on the other side").when(F.col("parity") == "NOT_ON_OWN", "Other side only").otherwise(F.col("parity"))
    return verdicts.select(*KEY, money.alias("money"), F.format_string("%.1f%%", F.col("promo_coverage_pct")).alias("coverage"), shown.alias("shown"))


def not_on_own_rows(listed: DataFrame, mapping: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdict rows of competitors with a promotion that no mapping row reaches, each once, its
    first promotion as listed; in the first week of the verdicts, under the competitor's name."""
    known = mapping.select("city_code", text.store_name(F.col("comp_name")).alias("name_norm")).where("name_norm <> ''").distinct()
    rows = listed.where("promotion_type <> ''").withColumn("name_norm", text.store_name(F.col("restaurant_name"))).join(known, ["city_code", "name_norm"], "left_anti")
    first = rows.groupBy("city_code", "name_norm").agg(F.min_by(F.struct("restaurant_name", "promotion_type"), F.struct("first_seq", "promotion_type")).alias("x"))
    week = verdicts.agg(F.min("week_num").alias("week_num"))
    out = first.select("city_code", F.col("x.restaurant_name").alias("store_name"), "name_norm", F.col("x.promotion_type").alias("p")).crossJoin(F.broadcast(week))  # one row
    return out.select(*KEY, "name_norm", F.lit(promo.NO_PROMO).alias("own_rank"), promo.rank_of_text(F.col("p")).alias("comp_rank"), F.lit("NOT_ON_OWN").alias("parity"), F.lit(0.0).alias("revenue"), F.lit(0.0).alias("promo_coverage_pct"), F.lit("").alias("best_promo_type"))
