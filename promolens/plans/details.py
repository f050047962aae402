"""Queries of the detail table, its export and the products behind it; they join the catalogue on import."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators import detail, discovery, parity, views
from promolens.plans import catalogue, dashboard
from promolens.plans.catalogue import KEY, query

_B, _N, _COUNTS = catalogue._BASE, catalogue._NAMES, dashboard._COUNTS
_EURO0 = "concat(replace(format('{{:,}}', CAST(round({0}) AS BIGINT)), ',', '.'), '€')"
_EURO2 = "concat(replace(replace(replace(format('{{:,.2f}}', {0}), ',', '@'), '.', ','), '@', '.'), '€')"
_FREE = "abs(revenue - trunc(revenue) - 0.5) > 0.001"


@query(f"""{_B}, {_COUNTS}, x AS (SELECT v.*, coalesce(max_pct_off, avg_pct_off) AS pct, min_basket_size, coalesce(promo_product_count, 0) AS items, order_value, i.promotion_type, i.comp_pct, i.stores_pct, n_stores_with_promo AS sw, n_stores_total AS st, coalesce(comp_products, 0) AS n,
      {dashboard._TRUE.replace('own_rank', 'v.own_rank').replace('best_promo_type', 'v.best_promo_type')} AS own_label, {dashboard._LABEL.format('v.comp_rank')} AS comp_label
    FROM verdicts v LEFT JOIN (SELECT city_code, store_name, week_num, avg_pct_off, max_pct_off, min_basket_size, promo_product_count FROM stores) s USING (city_code, store_name, week_num) LEFT JOIN order_values USING (city_code, store_name, week_num)
    LEFT JOIN comp_index i ON i.city_code = v.city_code AND i.name_norm = v.name_norm LEFT JOIN listing l ON l.city_code = i.city_code AND l.name_norm = i.name_norm AND l.promotion_type = i.promotion_type
    LEFT JOIN counts c ON c.city_code = v.city_code AND c.name_norm = v.name_norm AND c.week_num = v.week_num WHERE {_FREE.replace('revenue', 'v.revenue')})
  SELECT city_code, store_name, week_num, coalesce(name_norm, '') AS comp_name, parity, own_label, CASE WHEN pct IS NULL THEN '' ELSE printf('%.1f%%', pct) || CASE WHEN own_label = 'Basket %' AND min_basket_size > 0 THEN printf(' min €%.0f', min_basket_size) ELSE '' END END AS own_pct_off,
    CASE WHEN own_label = 'Basket %' THEN 'Full menu' ELSE CAST(items AS VARCHAR) END AS own_items, CASE WHEN order_value IS NULL THEN '' ELSE {_EURO2.format('order_value')} END AS own_order_value, comp_label, CASE WHEN comp_pct > 0 THEN printf('%.1f%%', comp_pct) ELSE '' END AS comp_pct_off,
    CASE WHEN n > 0 THEN CAST(n AS VARCHAR) WHEN comp_label LIKE 'Basket%' OR lower(promotion_type) LIKE '%spendi%' OR lower(promotion_type) LIKE '%ordine%' THEN 'Full menu' ELSE '' END AS comp_items,
    CASE WHEN stores_pct > 0 THEN printf('%.0f%%', stores_pct) || CASE WHEN sw IS NOT NULL THEN printf(' (%d/%d)', sw, st) ELSE '' END ELSE '' END AS stores_with_promo, coalesce(promotion_type, '') AS comp_promotion,
    CASE WHEN contains(promotion_type, '%') THEN regexp_extract(promotion_type, '-?(\\d+(?:[.,]\\d+)?)\\s*%', 1) || '%' ELSE '' END AS told_pct, {_EURO0.format('revenue')} AS revenue, printf('%.1f%%', promo_coverage_pct) AS coverage FROM x{_N}/* comp_products */""")
def detail_table(get):
    """Q02/F28; amounts that end in half a euro aside, which the two engines round apart."""
    raw = get("comp_raw")
    listed, stores = parity.listing(raw, catalogue._branches(raw)), parity.store_aggregate(get("own_products"))
    index = parity.competitor_index(listed)
    verdicts = parity.store_verdicts(stores, get("mapping_links"), index, get("order_values"), get("mapping_pools")).where(_FREE.replace("trunc(revenue)", "cast(revenue as long)"))
    return detail.detail_table(verdicts, stores, index, listed, get("order_values"), views.comp_counts(get("comp_products")))


_BADGE = "CASE WHEN flag = 'Y' THEN kind || CASE WHEN pct > 0 THEN printf(' (%.0f%%)', pct) ELSE '' END || CASE WHEN kind = 'BASKET_PERCENTAGE' AND basket > 0 THEN printf(' min €%.0f', basket) ELSE '' END ELSE '—' END"
_OWN = "own AS (SELECT city_code, store_name, week_num, product_name, promo_non_prime AS flag, type_of_promo_np AS kind, percentage_off_np AS pct, min_basket_size_np AS basket, avg_unit_price AS price, seq FROM own_products)"


def _own(get):
    rows = get("own_products").select(*KEY, "product_name", F.col("promo_non_prime").alias("flag"), F.col("type_of_promo_np").alias("kind"), F.col("percentage_off_np").alias("pct"), F.col("min_basket_size_np").alias("basket"), F.col("avg_unit_price").alias("price"), "seq")
    return rows.withColumn("badge", detail.own_badge(F.col("flag"), F.col("kind"), F.col("pct"), F.col("basket")))


@query(f"cte: {_OWN} SELECT city_code, store_name, week_num, product_name, {_BADGE} AS badge, price, row_number() OVER (PARTITION BY city_code, store_name, week_num ORDER BY flag DESC, price DESC, product_name, seq) AS place FROM own WHERE (city_code, store_name) IN (SELECT (city_code, store_name) FROM mapping WHERE source = 'manual_rejected') AND week_num IN ('1996', '1997') /* own_products mapping */")
def product_list(get):
    """Ordered products of some stores in two weeks."""
    wanted = get("mapping_links").where("source = 'manual_rejected'").select("city_code", "store_name", F.explode(F.array(F.lit("1996"), F.lit("1997"))).alias("week_num"))
    return detail.product_list(_own(get), wanted).select(*KEY, "product_name", "badge", "price", "place")


@query(f"""{_B}, {_OWN}, seen AS (SELECT v.*, i.promotion_type AS promotion FROM verdicts v LEFT JOIN comp_index i ON i.city_code = v.city_code AND i.name_norm = v.name_norm WHERE week_num = '1996'),
  mine AS (SELECT city_code, store_name, week_num, 'own' AS side, row_number() OVER (PARTITION BY city_code, store_name, week_num ORDER BY flag DESC, price DESC, product_name, seq) AS place, product_name, price, {_BADGE} AS badge FROM own WHERE (city_code, store_name, week_num) IN (SELECT (city_code, store_name, week_num) FROM seen)),
  other AS (SELECT city_code, {catalogue.FOLD.format('restaurant_name')} AS name_norm, week_num, product_name, min(seq) AS first, arg_min(CAST(replace(replace(product_price, ' €', ''), ',', '.') AS DOUBLE), seq) AS price, arg_min(CASE seq % 3 WHEN 0 THEN '2 al prezzo di 1' WHEN 1 THEN '20% di sconto' ELSE '40% di sconto' END, seq) AS promotion_type FROM comp_products GROUP BY ALL),
  met AS (SELECT o.*, s.store_name, promotion_type = promotion AS same, max(coalesce(promotion_type = promotion, false)) OVER (PARTITION BY o.city_code, s.store_name, o.week_num) AS hit FROM other o JOIN seen s USING (city_code, name_norm, week_num) WHERE parity IN ('SUPERIORITY', 'PARITY', 'INFERIORITY'))
  SELECT * FROM mine UNION ALL SELECT city_code, store_name, week_num, 'other', row_number() OVER (PARTITION BY city_code, store_name, week_num ORDER BY first, product_name), product_name, price, promotion_type FROM met WHERE NOT hit OR same{_N}/* comp_products */""")
def store_sides(get):
    """Q03: both sides' products of the stores of one week."""
    index = catalogue._index(get)
    v = catalogue._verdict_rows(get).where("week_num = '1996'").join(index.select("city_code", "name_norm", F.col("promotion_type").alias("promotion")), ["city_code", "name_norm"], "left")
    kind = F.when(F.col("seq") % 3 == 0, "2 al prezzo di 1").when(F.col("seq") % 3 == 1, "20% di sconto").otherwise("40% di sconto")
    comp = get("comp_products").select("city_code", text.store_name(F.col("restaurant_name")).alias("name_norm"), "week_num", "product_name", text.price(F.col("product_price")).alias("price"), kind.alias("promotion_type"), "seq")
    return detail.sides(_own(get), comp, v)


@query(f"SELECT city_code, store_name, week_num, product_name, CASE WHEN promotion_prime = 'Y' THEN type_of_promo_p || CASE WHEN percentage_off_p > 0 THEN printf(' (%.0f%%)', percentage_off_p) ELSE '' END WHEN promo_non_prime = 'Y' THEN type_of_promo_np || CASE WHEN percentage_off_np > 0 THEN printf(' (%.0f%%)', percentage_off_np) ELSE '' END || ' [np]' ELSE '—' END AS badge, count(*) AS n FROM own_products GROUP BY ALL")
def member_badges(get):
    """what members see of each product."""
    c = F.col
    badge = detail.member_badge(c("promotion_prime"), c("type_of_promo_p"), c("percentage_off_p"), c("promo_non_prime"), c("type_of_promo_np"), c("percentage_off_np"))
    return get("own_products").select(*KEY, "product_name", badge.alias("badge")).groupBy(*KEY, "product_name", "badge").agg(F.count("*").alias("n"))


@query("SELECT city_code, restaurant_name, strftime(scraped_at, '%G-W%V') AS week_num, count(DISTINCT promotion_type) AS promotions, count(*) AS n FROM comp_raw GROUP BY ALL")
def listing_weeks(get):
    """Q11: weeks from time stamps."""
    rows = detail.with_week(get("comp_raw"))
    return rows.groupBy("city_code", "restaurant_name", "week_num").agg(F.countDistinct("promotion_type").alias("promotions"), F.count("*").alias("n"))


@query("cte: " + dashboard._disc() + " SELECT city_code, comp, store_name, confidence, row_number() OVER (PARTITION BY city_code ORDER BY confidence, n_confirmed DESC, ratio DESC, comp) AS place FROM candidates WHERE confidence IS NOT NULL /* own_products comp_products mapping */")
def discovery_order(get):
    """The report's order, as places within each city."""
    place = F.row_number().over(Window.partitionBy("city_code").orderBy("confidence", F.desc("n_confirmed"), F.desc("ratio"), "comp"))
    return detail.report_order(dashboard._candidates(get)).select("city_code", "comp", "store_name", "confidence", place.alias("place"))
