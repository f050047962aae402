"""The detail table as it is shown and exported, and the products behind a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators.parity import KEY, MATCHED

FULL_MENU, BASKET_LABEL = "Full menu", "Basket %"


# ---------------------------------------------------------------- formatters
def _or_blank(test: Column, shown: Column) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), shown).otherwise("")


def euros(amount: Column, digits: int = 0) -> Column:
    """1234.5 as 1.234€ or 1.234,50€."""
    return _or_blank(amount.isNotNull(), F.concat(F.translate(F.format_number(amount, digits), ",.", ".,"), F.lit("€")))


def percent(share: Column) -> Column:
    return _or_blank(share.isNotNull(), F.format_string("%.1f%%", share))


def own_percent(pct: Column, label: Column, basket: Column) -> Column:
    """The own percentage, with the least basket where that is the promotion."""
    least = F.when((label == BASKET_LABEL) & (basket > 0), F.format_string(" min €%.0f", basket)).otherwise("")
    return _or_blank(pct.isNotNull(), F.concat(percent(pct), least))


def own_items(count: Column, label: Column) -> Column:
    return F.when(label == BASKET_LABEL, FULL_MENU).otherwise(F.coalesce(count, F.lit(0)).cast("string"))


def comp_items(count: Column, label: Column, promotion: Column) -> Column:
    """How many products the other side promotes; the whole menu where it is the order that is reduced."""
    said = F.lower(F.coalesce(promotion, F.lit("")))
    whole = F.contains(F.lower(F.coalesce(label, F.lit(""))), F.lit("basket")) | F.contains(said, F.lit("spendi")) | F.contains(said, F.lit("ordine"))
    return F.when(count > 0, count.cast("string")).when(whole, FULL_MENU).otherwise("")


def branches(pct: Column, some: Column, all_: Column) -> Column:
    """33% (2/6)."""
    return _or_blank(pct > 0, F.concat(F.format_string("%.0f%%", pct), F.when(some.isNotNull() & all_.isNotNull(), F.format_string(" (%d/%d)", some, all_)).otherwise("")))


def first_percent(promotion: Column) -> Column:
    """The first percentage that a promotion tells."""
    found = F.regexp_extract(F.coalesce(promotion, F.lit("")), r"-?(\d+(?:[.,]\d+)?)\s*%", 1)
    return F.when(found != "", F.concat(found, F.lit("%"))).otherwise("")


def own_badge(flag: Column, kind: Column, pct: Column, basket: Column) -> Column:
    """A product's own promotion: its kind, percentage, and for a basket the least sum."""
    rate = F.when(pct > 0, F.format_string(" (%.0f%%)", pct)).otherwise("")
    least = F.when((kind == "BASKET_PERCENTAGE") & (basket > 0), F.format_string(" min €%.0f", basket)).otherwise("")
    named = F.when(F.coalesce(kind, F.lit("")) == "", F.concat(F.lit("Promo"), rate)).otherwise(F.concat(kind, rate, least))
    return F.when(F.coalesce(flag == "Y", F.lit(False)), named).otherwise("—")


def member_badge(member_flag: Column, member_kind: Column, member_pct: Column, flag: Column, kind: Column, pct: Column) -> Column:
    """A product's promotion for members, else the one for all, marked as such."""
    rate = lambda p: F.when(p > 0, F.format_string(" (%.0f%%)", p)).otherwise("")
    named = lambda k, p, none: F.when(F.coalesce(k, F.lit("")) == "", none).otherwise(F.concat(k, rate(p)))
    return F.when(F.coalesce(F.upper(member_flag) == "Y", F.lit(False)), named(member_kind, member_pct, "Prime")).when(F.coalesce(F.upper(flag) == "Y", F.lit(False)), F.concat(named(kind, pct, "Promo"), F.lit(" [np]"))).otherwise("—")


# ---------------------------------------------------------------- the detail table
def detail_table(verdicts: DataFrame, stores: DataFrame, index: DataFrame, listed: DataFrame, order_values: DataFrame, counts: DataFrame) -> DataFrame:
    """Q02: all columns of the detail table as they are shown, a row a verdict.

    stores: the aggregate of own products; index: the promotion each competitor is compared by;
    listed: its branches; counts: its promoted products.
    """
    by_name = ["city_code", "name_norm"]
    other = index.select(*by_name, "promotion_type", "comp_pct", "stores_pct").join(listed.select(*by_name, "promotion_type", "n_stores_with_promo", "n_stores_total"), [*by_name, "promotion_type"], "left")
    rows = verdicts.join(stores.select(*KEY, "avg_pct_off", "max_pct_off", "min_basket_size", "promo_product_count"), list(KEY), "left").join(order_values, list(KEY), "left")
    rows = rows.join(other, by_name, "left").join(counts, [*by_name, "week_num"], "left")
    rows = rows.withColumns({"own_label": promo.true_label(F.col("best_promo_type"), promo.rank_label(F.col("own_rank"))), "comp_label": promo.rank_label(F.col("comp_rank"))})
    c = F.col
    return rows.select(
        *KEY, F.coalesce("name_norm", F.lit("")).alias("comp_name"), "parity", "own_label", own_percent(F.coalesce("max_pct_off", "avg_pct_off"), c("own_label"), c("min_basket_size")).alias("own_pct_off"),
        own_items(c("promo_product_count"), c("own_label")).alias("own_items"), euros(c("order_value"), 2).alias("own_order_value"), "comp_label", _or_blank(c("comp_pct") > 0, percent(c("comp_pct"))).alias("comp_pct_off"),
        comp_items(F.coalesce("comp_products", F.lit(0)), c("comp_label"), c("promotion_type")).alias("comp_items"), branches(c("stores_pct"), c("n_stores_with_promo"), c("n_stores_total")).alias("stores_with_promo"),
        F.coalesce("promotion_type", F.lit("")).alias("comp_promotion"), first_percent(c("promotion_type")).alias("told_pct"), euros(c("revenue")).alias("revenue"), percent(c("promo_coverage_pct")).alias("coverage"),
    )


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """All rows of a view as CSV that spreadsheets open with its accents: every file begins with a byte order mark."""
    out = df.coalesce(files) if files else df
    marked = out.withColumnRenamed(out.columns[0], f"﻿{out.columns[0]}")
    marked.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("emptyValue", "").csv(path)


# ---------------------------------------------------------------- products of a store
def product_list(products: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The products of the wanted stores and weeks (all, if none are given), with their place: promoted ones first, then by price.

    wanted: city_code, store_name and, or without, week_num.
    """
    rows = products if wanted is None else products.join(wanted.distinct(), wanted.columns, "left_semi")
    order = Window.partitionBy(*KEY).orderBy(F.desc("flag"), F.desc("price"), "product_name", "seq")
    return rows.withColumn("place", F.row_number().over(order))


def sides(own: DataFrame, comp: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Both sides' products of each store and week, by place.

    own: KEY, product_name, flag, price, seq and badge; comp: city_code, name_norm, week_num,
    product_name, price, promotion_type, seq; verdicts: with name_norm, parity and promotion, the
    one that is compared. A side that is not compared is empty, whatever bears its name. Of the
    other side's products the first of a name stands, and those with the compared promotion alone,
    if there are any.
    """
    mine = product_list(own, verdicts.where("parity <> 'NOT_ON_OWN'").select(*KEY)).select(*KEY, F.lit("own").alias("side"), "place", "product_name", "price", "badge")
    met = verdicts.where(F.col("parity").isin(*MATCHED, "NOT_ON_OWN")).select(*KEY, "name_norm", "promotion")
    once = comp.groupBy("city_code", "name_norm", "week_num", "product_name").agg(F.min_by(F.struct("price", "promotion_type", "seq"), "seq").alias("x")).select("city_code", "name_norm", "week_num", "product_name", "x.*")
    rows = once.join(met, ["city_code", "name_norm", "week_num"])
    same = F.trim("promotion_type") == F.trim("promotion")
    rows = rows.withColumn("some", F.max(F.coalesce(same, F.lit(False))).over(Window.partitionBy(*KEY))).where(~F.col("some") | F.coalesce(same, F.lit(False)))
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("seq", "product_name"))
    theirs = rows.select(*KEY, F.lit("other").alias("side"), place.alias("place"), "product_name", "price", F.coalesce("promotion_type", F.lit("")).alias("badge"))
    return mine.unionByName(theirs)


def with_week(products: DataFrame, time: str = "scraped_at") -> DataFrame:
    """Q11: the week of each product, from its time stamp where the table has none."""
    return products if "week_num" in products.columns else products.withColumn("week_num", text.iso_week(F.col(time)))


def report_order(candidates: DataFrame) -> DataFrame:
    """The order of the discovery report: sure ones first, then those that prices confirm most, then by share."""
    return candidates.orderBy("confidence", F.desc("n_confirmed"), F.desc("ratio"), "city_code", "comp")
