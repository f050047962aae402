"""Queries of the views, reports, discovery, parsers and the older matcher; they join the catalogue on import."""

from __future__ import annotations

from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators import discovery, legacy, parity, publish, state, views
from promolens.plans import catalogue
from promolens.plans.catalogue import KEY, QUERIES, query
from promolens.sources import cards, payload, tables

_B, _N = catalogue._BASE, catalogue._NAMES
_COUNTS = f"counts AS (SELECT city_code, {catalogue.FOLD.format('restaurant_name')} AS name_norm, week_num, count(DISTINCT product_name) AS comp_products FROM comp_products GROUP BY ALL)"
_LABEL = "CASE {0} WHEN 1 THEN '2x1' WHEN 2 THEN '% off prodotto' WHEN 2.5 THEN 'Flat prodotto' WHEN 3 THEN 'Basket %' WHEN 4 THEN 'Consegna gratis' WHEN 5 THEN 'Consegna scontata' WHEN 6 THEN 'Nessuna promo' END"
_TRUE = "CASE WHEN best_promo_type LIKE '%TWO_FOR_ONE%' THEN '2x1' WHEN best_promo_type LIKE '%BASKET_PERCENTAGE%' THEN 'Basket %' WHEN best_promo_type LIKE '%PERCENTAGE_DISCOUNT%' THEN '% off prodotto' ELSE " + _LABEL.format("own_rank") + " END"


# ---------------------------------------------------------------- store detail and drill-down
@query(f"""{_B}, {_COUNTS} SELECT city_code, store_name, week_num, parity, {_TRUE} AS own_label, {_LABEL.format('comp_rank')} AS comp_label, coalesce(comp_products, 0) AS comp_products, round(revenue, 2) AS revenue
  FROM verdicts LEFT JOIN counts USING (city_code, name_norm, week_num) WHERE week_num IN ('1996', '1997') AND parity IN ('SUPERIORITY', 'INFERIORITY', 'UNMATCHED') AND regexp_matches(store_name, '(?i)SUPPLIER#0*[1-9]')
  ORDER BY revenue DESC, city_code, store_name, week_num LIMIT 1000{_N}/* comp_products */""")
def store_detail(get):
    return views.store_detail(catalogue._verdict_rows(get), views.comp_counts(get("comp_products")), weeks=("1996", "1997"), verdict=("SUPERIORITY", "INFERIORITY", "UNMATCHED"), search="SUPPLIER#0*[1-9]")


@query(f"""{_B}, rows AS (SELECT p.*, best_promo_type, coalesce(flag = 'Y' AND k IS NOT DISTINCT FROM best_promo_type, false) AS carries FROM (SELECT city_code, store_name, week_num, product_name, avg_unit_price, promo_non_prime AS flag,
    CASE WHEN type_of_promo_np LIKE '%TWO_FOR_ONE%' THEN 'TWO_FOR_ONE' ELSE type_of_promo_np END AS k FROM own_products) p JOIN verdicts v USING (city_code, store_name, week_num) WHERE parity IN ('SUPERIORITY', 'PARITY', 'INFERIORITY')),
  once AS (SELECT city_code, store_name, week_num, product_name, bool_or(carries) AS carries, max(avg_unit_price) AS price FROM rows GROUP BY ALL)
  SELECT city_code, store_name, week_num, count(*) FILTER (carries) AS n_carrying, max(price) FILTER (carries) AS dearest, coalesce(string_agg(product_name, '|' ORDER BY product_name) FILTER (NOT carries), '') AS others FROM once GROUP BY city_code, store_name, week_num{_N}""")
def drill_products(get):
    return views.drill_products(parity.promo_view(get("own_products")), catalogue._verdict_rows(get))


@query(_B + "SELECT week_num, own_rank, comp_rank, parity FROM verdicts WHERE store_name = 'Supplier#000000003'" + _N)
def rank_history(get):
    v = catalogue._verdict_rows(get).where("store_name = 'Supplier#000000003'")
    return v.select("week_num", "own_rank", "comp_rank", "parity").orderBy("week_num")


@query(_B + "SELECT city_code, store_name, week_num, concat(replace(format('{:,}', CAST(round(revenue) AS BIGINT)), ',', '.'), ' €') AS money, printf('%.1f%%', promo_coverage_pct) AS coverage, CASE parity WHEN 'EXCLUSIVE_OWN' THEN 'Exclusive' WHEN 'NOT_ON_COMP' THEN 'Not on the other side' ELSE parity END AS shown FROM verdicts WHERE abs(revenue - trunc(revenue) - 0.5) > 0.001" + _N)
def display_formats(get):
    return views.display(catalogue._verdict_rows(get).where("abs(revenue - cast(revenue as long) - 0.5) > 0.001"))


@query(f"""{_B}, known AS (SELECT DISTINCT city_code, {catalogue.FOLD.format('comp_name')} AS name_norm FROM mapping WHERE comp_name <> ''),
  extra AS (SELECT city_code, name_norm, arg_min(restaurant_name, (first_seq, promotion_type)) AS store_name, arg_min(promotion_type, (first_seq, promotion_type)) AS p FROM listing WHERE promotion_type <> '' AND (city_code, name_norm) NOT IN (SELECT (city_code, name_norm) FROM known) GROUP BY city_code, name_norm)
  SELECT city_code, store_name, week_num, name_norm, own_rank, comp_rank, parity, revenue, promo_coverage_pct, best_promo_type FROM verdicts UNION ALL
  SELECT city_code, store_name, (SELECT min(week_num) FROM verdicts), name_norm, 6.0, {catalogue._TEXT_RANK.format('p')}, 'NOT_ON_OWN', 0.0, 0.0, '' FROM extra{_N}""")
def store_parity_full(get):
    """J08 inside the verdicts."""
    raw, v = get("comp_raw"), catalogue._verdict_rows(get)
    listed = parity.listing(raw, catalogue._branches(raw))
    return v.unionByName(views.not_on_own_rows(listed, catalogue._mapped_names(get), v))


# ---------------------------------------------------------------- counters and coverage
_ONE = "(SELECT count(*) FILTER (city_parity_label = 'SUPERIORITY') AS cities_superiority, count(*) FILTER (city_parity_label = 'PARITY') AS cities_parity, count(*) FILTER (city_parity_label = 'INFERIORITY') AS cities_inferiority, round(avg(match_coverage_pct), 1) AS mean_coverage FROM cities)"


@query(_B + f"SELECT * FROM {_ONE}, (SELECT round(sum(CASE WHEN parity = 'INFERIORITY' THEN revenue ELSE 0.0 END), 2) AS revenue_at_risk FROM verdicts), (SELECT count(*) FILTER (comp_name <> '') AS mapped, count(*) FILTER (source = 'manual_rejected') AS exclusive, count(*) FILTER (source = 'not_on_comp') AS absent FROM mapping)" + _N)
def kpi_counters(get):
    return views.counters(catalogue._cities(get), catalogue._verdict_rows(get), get("mapping"))


_M = catalogue._MEMBER + ", " + catalogue._rollup("cities", "verdicts") + ", " + catalogue._rollup("member_cities", "member_verdicts") + " "


@query(_M + "SELECT " + ", ".join(f"m.n_{v} AS member_n_{v}, m.n_{v} - s.n_{v} AS delta_n_{v}, round(m.p_{v} - s.p_{v}, 1) AS delta_pct_{v}" for v in ("superiority", "parity", "inferiority")) + " FROM "
       + ", ".join("(SELECT " + ", ".join(f"CAST(sum(n_{v}) AS BIGINT) AS n_{v}, avg(pct_{v}) AS p_{v}" for v in ("superiority", "parity", "inferiority")) + f" FROM {t}) {a}" for t, a in (("cities", "s"), ("member_cities", "m"))) + _N)
def member_kpis(get):
    return views.member_kpis(parity.city_rollup(catalogue._both_verdicts(get)))


_LEVEL = "CASE {0} WHEN 'SUPERIORITY' THEN 2 WHEN 'PARITY' THEN 1 WHEN 'INFERIORITY' THEN 0 END"


@query(catalogue._MEMBER + f", last AS (SELECT city_code, store_name, arg_max(parity, week_num) AS standard_parity FROM verdicts GROUP BY ALL) SELECT city_code, store_name, week_num, parity, standard_parity, CASE WHEN {_LEVEL.format('parity')} > {_LEVEL.format('standard_parity')} THEN 'boost' WHEN {_LEVEL.format('parity')} < {_LEVEL.format('standard_parity')} THEN 'drop' ELSE '' END AS badge FROM member_verdicts LEFT JOIN last USING (city_code, store_name)" + _N)
def prime_boost(get):
    return views.boost(catalogue._both_verdicts(get))


@query("SELECT DISTINCT city_code, store_name, week_num FROM own_products WHERE promotion_prime = 'Y'")
def prime_store_counts(get):
    return views.member_stores(get("own_products"))


@query("SELECT n_shown, n_member, CASE WHEN n_shown > 0 THEN round(n_member / n_shown * 100, 1) ELSE 0.0 END AS pct FROM (SELECT count(*) AS n_shown FROM mapping), (SELECT count(DISTINCT store_name) AS n_member FROM own_products p WHERE promotion_prime = 'Y' AND (city_code, store_name) IN (SELECT (city_code, store_name) FROM mapping))")
def prime_coverage(get):
    return views.member_coverage(get("own_products"), get("mapping"))


@query(_B + """, trend AS (SELECT week_num, round(avg(w_superiority), 1) AS a, round(avg(w_parity), 1) AS b, round(avg(w_inferiority), 1) AS c FROM cities GROUP BY ALL)
  SELECT week_num, a AS w_superiority, b AS w_parity, c AS w_inferiority, round(a - lag(a) OVER (ORDER BY week_num), 1) AS delta_superiority, round(b - lag(b) OVER (ORDER BY week_num), 1) AS delta_parity, round(c - lag(c) OVER (ORDER BY week_num), 1) AS delta_inferiority FROM trend ORDER BY week_num DESC LIMIT 1""" + _N)
def national_delta(get):
    return views.national_delta(parity.national_trend(catalogue._cities(get)))


@query("SELECT week_num, count(*) AS n FROM (SELECT city_code, week_num FROM own_products GROUP BY ALL INTERSECT SELECT city_code, week_num FROM comp_products GROUP BY ALL) GROUP BY week_num")
def common_cities(get):
    """Cities that both sides have in a week."""
    a, b = (get(t).select("city_code", "week_num").distinct() for t in ("own_products", "comp_products"))
    return a.join(b, ["city_code", "week_num"]).groupBy("week_num").agg(F.count("*").alias("n"))


@query("SELECT m.manager, count(DISTINCT (p.city_code, p.store_name)) AS n FROM own_products p JOIN managers m USING (city_code) WHERE lower(trim(manager)) = 'asia' GROUP BY ALL")
def am_filter_semi(get):
    """The stores of one manager's list of (city, store)."""
    mine = get("own_products").select("city_code", "store_name").distinct().join(get("managers"), "city_code").where("lower(trim(manager)) = 'asia'")
    kept = get("own_products").join(mine, ["city_code", "store_name"], "left_semi").select("city_code", "store_name").distinct()
    return kept.join(mine, ["city_code", "store_name"]).groupBy("manager").agg(F.count("*").alias("n"))


@query(_B + "SELECT city_code, store_name, week_num FROM verdicts v WHERE parity = 'UNMATCHED' AND (city_code, store_name) NOT IN (SELECT (city_code, store_name) FROM mapping WHERE comp_name <> '')" + _N)
def unmatched_open(get):
    """J24."""
    v = catalogue._verdict_rows(get).where("parity = 'UNMATCHED'")
    return v.join(catalogue._mapped_stores(get), ["city_code", "store_name"], "left_anti").select(*KEY)


@query(f"SELECT DISTINCT city_code, {catalogue.FOLD.format('product_name')} AS name FROM comp_products WHERE contains({catalogue.FOLD.format('product_name')}, 'red')")
def accent_search(get):
    """P08."""
    return get("comp_products").where(views.holds("product_name", "RÉD")).select("city_code", text.fold(F.col("product_name")).alias("name")).distinct()


@query("SELECT DISTINCT week_num, CAST(week_num AS INTEGER) % 100 AS number FROM own_products")
def week_numbers(get):
    """Weeks and their bare numbers."""
    return get("own_products").select("week_num").distinct().withColumn("number", text.week_number(F.concat(F.lit("Y-W"), F.substring("week_num", 3, 2))))


# ---------------------------------------------------------------- discovery
_DISC = f"""RECURSIVE {{lcs}}, roo AS (SELECT city_code, restaurant_name AS comp, product_name AS product, {catalogue.FOLD.format('product_name')} AS n, arg_min({{euro}}, seq) AS price FROM comp_products WHERE week_num = '1997' AND (city_code, restaurant_name) NOT IN (SELECT (city_code, comp_name) FROM mapping) GROUP BY ALL),
  own AS (SELECT DISTINCT city_code, store_name, {catalogue.FOLD.format('product_name')} AS n, round(avg_unit_price, 2) AS price FROM own_products WHERE week_num = '1997'),
  sizes AS (SELECT city_code, comp, count(*) AS products FROM roo GROUP BY ALL HAVING count(*) >= 4), menu AS (SELECT roo.* FROM roo JOIN sizes USING (city_code, comp)),
  by_name AS (SELECT city_code, comp, product, store_name, bool_or(abs(m.price - o.price) / greatest(m.price, o.price) <= 0.05) AS ok FROM menu m JOIN own o USING (city_code, n) GROUP BY ALL),
  by_price AS (SELECT DISTINCT m.city_code, comp, product, store_name FROM menu m JOIN own o ON m.city_code = o.city_code AND m.n <> o.n AND abs(round_even(m.price, 0) - round_even(o.price, 0)) <= 1 AND abs(m.price - o.price) / greatest(m.price, o.price) <= 0.05
    JOIN scored ON a = array_to_string(list_sort(string_split(m.n, ' ')), ' ') AND b = array_to_string(list_sort(string_split(o.n, ' ')), ' ') AND score >= 80),
  hits AS (SELECT * FROM by_name UNION ALL SELECT *, true FROM by_price p WHERE (city_code, comp, product, store_name) NOT IN (SELECT (city_code, comp, product, store_name) FROM by_name)),
  pairs AS (SELECT city_code, comp, store_name, count(*) AS n_overlap, count(*) FILTER (ok) AS n_confirmed FROM hits GROUP BY ALL),
  candidates AS (SELECT *, CASE WHEN n_confirmed >= 3 OR ratio >= 0.5 THEN 'alta' WHEN n_overlap >= 4 AND ratio >= 0.3 THEN 'media' END AS confidence FROM (SELECT city_code, comp, store_name, n_overlap, n_confirmed, products, round(n_overlap / products, 2) AS ratio FROM pairs JOIN sizes USING (city_code, comp)
    QUALIFY row_number() OVER (PARTITION BY city_code, comp ORDER BY n_confirmed DESC, n_overlap DESC, store_name) = 1))"""


def _disc() -> str:
    from promolens.plans import products

    return _DISC.format(lcs=products._LCS, euro=products._EURO)


def _candidates(get):
    comp = get("comp_products").where("week_num = '1997'").withColumn("price", text.price(F.col("product_price")))
    comp = comp.groupBy("city_code", F.col("restaurant_name").alias("comp"), F.col("product_name").alias("product")).agg(F.min_by("price", "seq").alias("price")).withColumn("n", text.product_name(F.col("product")))
    own = get("own_products").where("week_num = '1997'").select("city_code", "store_name", text.product_name(F.col("product_name")).alias("n"), text.rounded(F.col("avg_unit_price"), 2).alias("price"))
    return discovery.discover(comp, own, catalogue._mapped_names(get))


@query("cte: " + _disc() + " SELECT * FROM candidates WHERE confidence IS NOT NULL /* own_products comp_products mapping */")
def discover(get):
    return _candidates(get)


QUERIES["discovery"], catalogue.ORACLE_SQL["discovery"] = QUERIES.pop("discover"), catalogue.ORACLE_SQL.pop("discover")
_TIGHT = "replace(" + catalogue.FOLD + ", ' ', '')"


@query("cte: " + _disc() + f""" SELECT * FROM mapping UNION ALL SELECT DISTINCT city_code, store_name, comp AS comp_name, 'auto_fingerprint' AS source FROM candidates c WHERE confidence IS NOT NULL AND (ratio >= 0.7 AND n_confirmed >= 4 OR least(length({_TIGHT.format('comp')}), length({_TIGHT.format('store_name')})) >= 4
  AND (contains({_TIGHT.format('comp')}, {_TIGHT.format('store_name')}) OR contains({_TIGHT.format('store_name')}, {_TIGHT.format('comp')}))) AND (city_code, store_name, comp) NOT IN (SELECT (city_code, store_name, comp_name) FROM mapping) /* own_products comp_products mapping */""")
def auto_merge(get):
    return discovery.auto_merge(_candidates(get), get("mapping"), get("mapping_links"), get("mapping_pools"))


# ---------------------------------------------------------------- older matcher and its rules
_FOLDED = catalogue.FOLD
_WORDS = "list_sort(list_distinct(list_filter(string_split({0}, ' '), lambda w: w <> '')))"
_SIGNIFICANT = "list_filter(" + _WORDS + ", lambda w: length(w) > 2 AND w NOT IN ('pizza', 'pizzeria', 'sushi', 'burger', 'burgers', 'kebab', 'poke', 'pokè', 'ristorante', 'restaurant', 'food', 'house', 'bar', 'cucina', 'grill', 'chicken', 'delivery', 'mexican', 'italiano', 'italiana', 'plant', 'based', 'smashburger'))"
_SHARED = f"list_filter({_SIGNIFICANT.format(_FOLDED.format('a'))}, lambda t: list_contains({_SIGNIFICANT.format(_FOLDED.format('b'))}, t))"


@query(f"""WITH RECURSIVE own AS (SELECT DISTINCT p_brand AS city_code, concat('Ristorante ', p_name) AS a FROM part WHERE p_retailprice >= 910),
  oth AS (SELECT p_brand AS city_code, CASE WHEN p_partkey % 3 = 0 THEN concat(upper(left(p_name, 1)), substr(p_name, 2)) ELSE p_name END AS b, p_partkey AS place FROM part),
  pairs AS (SELECT DISTINCT a, b FROM own JOIN oth USING (city_code)),
  words AS (SELECT a, b, {_WORDS.format('a')} AS x, {_WORDS.format('b')} AS y FROM pairs),
  parts AS (SELECT a, b, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') AS meet, array_to_string(list_filter(x, lambda w: NOT list_contains(y, w)), ' ') AS l, array_to_string(list_filter(y, lambda w: NOT list_contains(x, w)), ' ') AS r FROM words),
  s AS (SELECT DISTINCT l, r, 0 AS i, list_transform(range(0, length(r) + 1), lambda z: CAST(0 AS BIGINT)) AS v FROM parts
    UNION ALL SELECT l, r, i + 1, list_transform(range(0, length(r) + 1), lambda j: greatest(v[j + 1], coalesce(list_max(list_transform(list_filter(range(1, j + 1), lambda k: substr(r, k, 1) = substr(l, i + 1, 1)), lambda k: v[k] + 1)), 0))) FROM s WHERE i < length(l)),
  lengths AS (SELECT a, b, length(meet) AS n, length(p.l) AS p, length(p.r) AS q, v[length(p.r) + 1] AS lcs, CASE WHEN meet = '' THEN 0 ELSE 1 END AS gap FROM parts p JOIN s ON s.l = p.l AND s.r = p.r AND i = length(p.l)),
  scored AS (SELECT a, b, round(CASE WHEN n > 0 AND (p = 0 OR q = 0) THEN 100.0 WHEN n = 0 THEN 200.0 * lcs / (p + q)
    ELSE greatest(200.0 * (n + gap + lcs) / (2 * (n + gap) + p + q), 200.0 * n / (2 * n + gap + p), 200.0 * n / (2 * n + gap + q)) END, 4) AS score FROM lengths),
  ranked AS (SELECT city_code, a, b, score, {_SHARED} AS shared, row_number() OVER w AS rn, lead(score) OVER w AS second, lead({_SHARED}) OVER w AS second_shared
    FROM own JOIN oth USING (city_code) JOIN scored USING (a, b) WINDOW w AS (PARTITION BY city_code, a ORDER BY score DESC, place)),
  top AS (SELECT *, len(list_filter(shared, lambda t: length(t) >= 4)) AS strong, {_FOLDED.format('a')} AS x, {_FOLDED.format('b')} AS y FROM ranked WHERE rn = 1)
  SELECT city_code, a, b, score FROM top WHERE (x = y OR ((contains(x, y) OR contains(y, x)) AND strong > 0 AND score >= 84) OR (strong >= 2 AND score >= 84) OR (strong >= 1 AND score >= 88) OR score >= 95)
    AND NOT coalesce(second >= score - 1.5 AND second_shared <> shared, false)""")
def legacy_match(get):
    """Names of one half of the menu with a word more, against the names of their brand, every third with a capital."""
    names = get("part").select(F.col("p_brand").alias("city_code"), F.concat(F.lit("Ristorante "), F.col("p_name")).alias("a")).where("p_retailprice >= 910")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring("p_name", 2, 10_000))).otherwise(F.col("p_name"))
    return legacy.match(names, get("part").select(F.col("p_brand").alias("city_code"), name.alias("b"), F.col("p_partkey").alias("place")))


#: Lines as cards show them, dealt to the listing's rows: praise, an order for later, the name, measures, the promotion.
_CARDS = """SELECT o_custkey % 50 AS point, o_orderkey AS place, concat('https://x.example/it/menu/c/da-', CAST(o_custkey % 7 AS STRING), '-amici?d=1') AS href,
  CASE o_orderkey % 8 WHEN 0 THEN '  Nuovo ' WHEN 1 THEN concat(chr(39), 'tutto buono', chr(39)) WHEN 2 THEN 'Solo su Deliveroo' WHEN 3 THEN 'Tracking ordine' WHEN 4 THEN 'Preordina per domani' WHEN 5 THEN '20% di sconto' ELSE '' END AS l1,
  CASE o_orderkey % 5 WHEN 0 THEN '4,5 ' WHEN 1 THEN ' ' ELSE concat('Locale ', CAST(o_custkey % 40 AS STRING), 'a') END AS l2,
  CASE o_orderkey % 3 WHEN 0 THEN '25 min' WHEN 1 THEN '1,90 €' ELSE concat('Cucina ', CAST(o_custkey % 9 AS STRING), 'b') END AS l3,
  CASE o_custkey % 7 WHEN 0 THEN '2 al prezzo di 1' WHEN 1 THEN 'Consegna gratis' WHEN 2 THEN 'Un menù in offerta' WHEN 3 THEN 'Spendi almeno 10 € e risparmia' WHEN 4 THEN '18:30 - 19:00' WHEN 5 THEN '12' ELSE 'due x uno' END AS l4 FROM {orders}"""
_METRIC = r"regexp_matches({0}, '(?i)(\d+[.,]\d+\s*$|\bmin\b|\bkm\b|\bbuono\b|consegna|€|^\d+$|\d{{1,2}}:\d{{2}})')"
_PROMO = r"regexp_matches({0}, '(?i)(2\s+al\s+prezzo\s+di\s+1|spendi\s+almeno|risparmia|%|prodotti\s+selezionati|men[uù]\s+in\s+offerta|consegna\s+grat(is|uita)|offerta|omaggio|aggiungi\s+un|2x1|due\s+x\s+uno)')"
_PRE = r"regexp_matches({0}, '(?i)^(preordina|pre-order|preorder|ordina\s+per|chiude\s+alle|apre\s+alle|domani|oggi)\b')"
_EDIT = r"(regexp_matches({0}, '(?i)(nuovo|novit[aà]|solo\s+su\s+deliveroo)') OR (starts_with({0}, chr(39)) AND ends_with({0}, chr(39))) OR " + _PRE + ")"
_LINES = f"raw AS ({_CARDS.format(orders='orders')}), c AS (SELECT *, list_filter(list_transform([l1, l2, l3, l4], lambda x: trim(x)), lambda x: x <> '') AS lines FROM raw)"


def _captured(get):
    return get("orders").sparkSession.sql(_CARDS, orders=get("orders")).select("point", "place", "href", F.array("l1", "l2", "l3", "l4").alias("lines"))


@query(f"""WITH {_LINES}, each AS (SELECT unnest(list_concat(lines, [''])) AS line FROM c) SELECT kind, count(*) AS n, count(DISTINCT line) AS n_lines FROM (SELECT line, CASE WHEN line = '' THEN 'blank' WHEN lower(line) IN ('tracking ordine limitato', 'tracking ordine', 'ordine limitato') THEN 'placeholder'
  WHEN {_PRE.format('line')} THEN 'preorder' WHEN {_METRIC.format('line')} THEN 'metric' WHEN {_PROMO.format('line')} THEN 'promotion' WHEN {_EDIT.format('line')} THEN 'editorial' ELSE 'name' END AS kind FROM each) GROUP BY kind""")
def line_classes(get):
    """P10: the lines of all cards by what they tell, with one blank line a card."""
    each = _captured(get).select(F.explode(F.concat(legacy.clean_lines(F.col("lines")), F.array(F.lit("")))).alias("line"))
    return each.select("line", legacy.line_class(F.col("line")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("line").alias("n_lines"))


_URL_NAME = "concat('Da ', split_part(split_part(href, '/da-', 2), '-', 1), ' Amici')"
_NAMED = f"""{_LINES}, m AS (SELECT *, list_position(list_transform(lines, lambda x: {_METRIC.format('x')}), true) AS k FROM c),
  f AS (SELECT *, coalesce(list_filter(CASE WHEN k > 0 THEN lines[1:k - 1] ELSE lines END, lambda x: NOT {_PROMO.format('x')} AND NOT {_EDIT.format('x')})[1], list_filter(lines, lambda x: NOT {_METRIC.format('x')} AND NOT {_PROMO.format('x')} AND NOT {_EDIT.format('x')})[1], '') AS first FROM m),
  g AS (SELECT *, CASE WHEN first = '' OR lower(first) IN ('tracking ordine limitato', 'tracking ordine', 'ordine limitato') THEN {_URL_NAME} ELSE first END AS restaurant_name,
    array_to_string(list_filter(lines, lambda x, i: {_PROMO.format('x')} AND list_position(lines, x) = i), ' | ') AS promotion_type FROM f),
  cards AS (SELECT point, place, restaurant_name, promotion_type, href AS source_url FROM g QUALIFY row_number() OVER (PARTITION BY point, {catalogue.FOLD.format('restaurant_name')}, lower(promotion_type) ORDER BY place) = 1)"""


@query(f"WITH {_NAMED} SELECT * FROM cards")
def card_listing(get):
    """Names, promotions and addresses from the lines of cards."""
    return cards.cards(_captured(get))


@query(f"""WITH {_NAMED} SELECT point, CASE WHEN n > 0 THEN 'covered' ELSE 'no_restaurants_found' END AS status, n AS restaurant_count, n_promoted FROM (SELECT point, count(*) AS n,
  count(*) FILTER (promotion_type <> '' AND NOT regexp_matches(promotion_type, '(?i)consegna\\s+grat(is|uita)')) AS n_promoted FROM cards GROUP BY point)""")
def card_points(get):
    """What each point showed, and how many of its cards go on into the listing."""
    captured = _captured(get)
    found = cards.cards(captured)
    kept = cards.promoted(found).groupBy("point").agg(F.count("*").alias("k"))
    return cards.point_status(captured, found).join(kept, "point", "left").select("point", "status", "restaurant_count", F.coalesce("k", F.lit(0)).alias("n_promoted"))


@query(f"""WITH {_LINES}, p AS (SELECT point, place, href AS promotion_type, lines FROM c WHERE len(list_filter(lines, lambda x: {_PROMO.format('x')})) > 0),
  n AS (SELECT *, coalesce(list_filter(lines, lambda x: NOT {_PROMO.format('x')} AND NOT {_METRIC.format('x')})[1], lines[1]) AS product_name, coalesce(list_filter(lines, lambda x: contains(x, '€'))[1], '') AS product_price FROM p),
  d AS (SELECT *, coalesce(list_filter(lines[2:], lambda x: x <> product_name AND x <> product_price AND NOT {_PROMO.format('x')} AND NOT {_METRIC.format('x')})[1], '') AS product_description FROM n WHERE NOT {_PROMO.format('product_name')})
  SELECT point, place, product_name, product_description, product_price, promotion_type FROM d QUALIFY row_number() OVER (PARTITION BY point, {catalogue.FOLD.format('product_name')}, {catalogue.FOLD.format('product_price')}, {catalogue.FOLD.format('promotion_type')} ORDER BY place) = 1""")
def menu_entries(get):
    """Promoted entries of menus from their lines."""
    return cards.menu_entries(_captured(get).withColumn("promotion_type", F.col("href")))


@query("SELECT promotion_type, count(*) AS n FROM comp_raw WHERE NOT regexp_matches(promotion_type, '(?i)consegna\\s+grat(is|uita)|spese\\s+di\\s+consegna\\s+a\\s+0|consegna\\s+a\\s+0|free\\s+delivery|delivery\\s+grat(is|uita)') GROUP BY ALL")
def excluded_promos(get):
    """P09."""
    return get("comp_raw").where(~legacy.excluded(F.col("promotion_type"))).groupBy("promotion_type").agg(F.count("*").alias("n"))


@query(f"SELECT city_code, array_to_string(list_sort(list(DISTINCT concat(n, '=', p))), '|') AS signature FROM (SELECT city_code, {catalogue.FOLD.format('restaurant_name')} AS n, {catalogue.FOLD.format('promotion_type')} AS p FROM comp_raw) WHERE n <> '' AND p <> '' GROUP BY city_code /* comp_raw */")
def point_signatures(get):
    """A25."""
    return legacy.signatures(get("comp_raw"), "city_code")


@query(f"""cte: r AS (SELECT city_code, {catalogue.FOLD.format('restaurant_name')} AS name_norm, promotion_type, source_url, seq FROM comp_raw WHERE NOT regexp_matches(promotion_type, '(?i)consegna\\s+grat')),
  p AS (SELECT city_code, name_norm, promotion_type, min(seq) AS first FROM r WHERE promotion_type <> '' GROUP BY ALL), m AS (SELECT city_code, name_norm, string_agg(promotion_type, ' | ' ORDER BY first, promotion_type) AS promotions FROM p GROUP BY city_code, name_norm)
  SELECT city_code, name_norm, promotions, arg_max(source_url, seq) AS source_url, max(seq) AS seq FROM r JOIN m USING (city_code, name_norm) GROUP BY ALL /* comp_raw */""")
def legacy_upsert(get):
    """Rows of before and of later merged into one listing."""
    raw = get("comp_raw").select("city_code", "restaurant_name", "promotion_type", "source_url", "seq", "scraped_at")
    return legacy.upsert_listing(raw.where("year(scraped_at) < 1996").drop("scraped_at"), raw.where("year(scraped_at) >= 1996").drop("scraped_at"))


# ---------------------------------------------------------------- state and reports
@query(catalogue._FOLD.split("SELECT * FROM folded")[0] + ", m AS (SELECT city_code, store_name, 'Kept' AS comp_name, CASE WHEN CAST(store_name AS BIGINT) % 2 = 0 THEN 'manual_rejected' ELSE 'seed' END AS source FROM decisions WHERE name <> '' GROUP BY ALL) "
       "SELECT * FROM m WHERE source = 'manual_rejected' OR (city_code, store_name) NOT IN (SELECT (city_code, store_name) FROM folded) UNION ALL SELECT city_code, store_name, name, status FROM folded WHERE (city_code, store_name) NOT IN (SELECT (city_code, store_name) FROM m WHERE source = 'manual_rejected') /* decisions */")  # fmt: skip
def mapping_override(get):
    """Folded decisions in the mapping."""
    log = get("decisions")
    old = log.where("name <> ''").select("city_code", "store_name").distinct().withColumns({"comp_name": F.lit("Kept"), "source": F.when(F.col("store_name").cast("long") % 2 == 0, "manual_rejected").otherwise("seed")})
    return state.merge_log(old, state.fold_log(log, ["city_code", "store_name"]))


_Y = "SELECT o_custkey, CAST(year(o_orderdate) AS STRING) AS week_num, o_orderkey AS seq, o_totalprice FROM orders"


@query(f"WITH o AS (SELECT * FROM ({_Y}) WHERE week_num < '1997'), n AS (SELECT * FROM ({_Y}) WHERE week_num >= '1996' QUALIFY row_number() OVER (PARTITION BY o_custkey, week_num ORDER BY seq DESC) = 1), u AS (SELECT * FROM n UNION ALL SELECT * FROM o WHERE week_num NOT IN (SELECT week_num FROM n)) SELECT * FROM u QUALIFY dense_rank() OVER (ORDER BY week_num DESC) <= 3")
def upsert_sheet(get):
    """Incoming weeks replaced, the last three kept."""
    rows = get("orders").select("o_custkey", F.year("o_orderdate").cast("string").alias("week_num"), F.col("o_orderkey").alias("seq"), "o_totalprice")
    return state.upsert_sheet(rows.where("week_num < '1997'"), rows.where("week_num >= '1996'"), ["o_custkey", "week_num"], "seq", "week_num", 3)


@query("SELECT max(week_num) AS week_num FROM own_products WHERE week_num < '1997'")
def previous_week(get):
    return publish.week_before(get("own_products"), "1997")


@query("SELECT week_num, count(*) AS n FROM own_products GROUP BY ALL")
def verify_weeks(get):
    """A table rebuilt from its archived rows, as strings, and its rows by week."""
    own = get("own_products")
    return publish.weeks_of(publish.rebuild(own.select([F.col(c).cast("string").alias(c) for c in own.columns if c != "seq"]), own))


_NOW = "TIMESTAMP '1999-01-01 00:00:00'"


@query(f"SELECT CASE WHEN d > 8 THEN 'WARNING' ELSE 'INFO' END AS level, 'data_freshness' AS \"check\", '' AS city_code, concat(CAST(d AS STRING), ' days') AS message FROM (SELECT CAST(floor((epoch({_NOW}) - epoch(CAST(max(scraped_at) AS TIMESTAMP))) / 86400) AS BIGINT) AS d FROM comp_raw)")
def qc_freshness(get):
    return publish.freshness_report(get("comp_raw"), "scraped_at", F.to_timestamp(F.lit("1999-01-01 00:00:00")))


_MATCHED = "(SELECT * FROM verdicts WHERE week_num = '{0}' AND parity NOT IN ('UNMATCHED', 'EXCLUSIVE_OWN'))"
_SHARE = "count(*) FILTER (parity = '{0}') / count(*) * 100"
_SHIFT = f"""SELECT CASE WHEN inf - was > 15 THEN 'WARNING' ELSE 'INFO' END AS level, 'parity_distribution' AS "check", '' AS city_code, CASE WHEN inf - was > 15 THEN printf('INFERIORITY %.1f%% -> %.1f%%', was, inf) ELSE printf('SUP %.1f%% | PAR %.1f%% | INF %.1f%%', sup, par, inf) END AS message
  FROM (SELECT {_SHARE.format('INFERIORITY')} AS inf, {_SHARE.format('SUPERIORITY')} AS sup, {_SHARE.format('PARITY')} AS par FROM {_MATCHED.format('1997')}), (SELECT {_SHARE.format('INFERIORITY')} AS was FROM {_MATCHED.format('1996')})"""


@query(_B + _SHIFT + _N)
def qc_shift(get):
    return publish.week_shift(catalogue._verdict_rows(get), "1997", "1996")


_WRITTEN = "(SELECT 'own_products' AS name, count(*) AS rows, count(*) AS expected FROM lineitem UNION ALL SELECT 'orders', -1, count(*) FROM orders UNION ALL SELECT 'customer', count(*) - 1, count(*) FROM customer)"


@query(f"SELECT CASE WHEN rows < 0 THEN 'ERROR' WHEN rows < expected THEN 'WARNING' ELSE 'INFO' END AS level, 'sheets_integrity' AS \"check\", '' AS city_code, printf('%s: %d of %d', name, rows, expected) AS message FROM {_WRITTEN}")
def qc_integrity(get):
    count = lambda t, name, rows: get(t).agg(F.count("*").alias("expected")).select(F.lit(name).alias("name"), rows.alias("rows"), "expected")
    rows = count("lineitem", "own_products", F.col("expected")).unionByName(count("orders", "orders", F.lit(-1).cast("long"))).unionByName(count("customer", "customer", F.col("expected") - 1))
    return publish.integrity_report(rows.select("name", "rows"), rows.select("name", "expected"))


_DELTA = """c AS (SELECT city_code, count(*) FILTER (week_num = '1997') AS n, count(*) FILTER (week_num = '1996') AS m FROM verdicts GROUP BY ALL HAVING count(*) FILTER (week_num = '1996') > 0),
  d AS (SELECT *, (n - m) / m * 100 AS pct FROM c), e AS (SELECT *, CASE WHEN pct < -20 THEN 'WARNING' WHEN pct > 50 THEN 'INFO' END AS level FROM d)"""


@query(_B + ", " + _DELTA + f""" SELECT *, '1997' AS week_num FROM (SELECT level, 'store_count_delta' AS "check", city_code, printf('%d -> %d (%s%%)', m, n, CAST(CAST(round(pct) AS BIGINT) AS STRING)) AS message FROM e WHERE level IS NOT NULL
  UNION ALL SELECT 'INFO', 'store_count_delta', '', 'stable' FROM e HAVING count(*) FILTER (level = 'WARNING') = 0 UNION ALL {_SHIFT}){_N}""")
def qc_report(get):
    """C02, C03, C06."""
    v = catalogue._verdict_rows(get)
    now, before = v.where("week_num = '1997'"), v.where("week_num = '1996'")
    return publish.report("1997", publish.count_report(now, before), publish.week_shift(v, "1997", "1996"))


# ---------------------------------------------------------------- parsers
def _card(name, href, badge, free):
    line = lambda t: F.struct(F.array(F.struct(t.alias("text"))).alias("spans"))
    face = F.struct(F.array(line(F.lit("25 min"))).alias("uiLines"), F.struct(F.array(F.struct(line(badge).alias("text")), F.struct(line(free).alias("text"))).alias("badges")).alias("overlay"))
    place = F.struct(F.lit("1").alias("id"), name.alias("name"), F.struct(F.struct(href.alias("href")).alias("self")).alias("links"))
    return F.struct(F.lit("UICard").alias("__typename"), F.struct(place.alias("restaurant")).alias("target"), F.struct(face.alias("default")).alias("uiContent"))


@query("""SELECT p_partkey AS page, name, href, CASE p_size % 3 WHEN 0 THEN '20% di sconto' WHEN 1 THEN 'tutto il menù in promozione' ELSE '' END AS badge FROM part, LATERAL (SELECT p_name AS name, concat('/menu/1/', p_name) AS href UNION ALL SELECT p_brand, concat('/menu/2/', p_brand)) WHERE p_size % 5 <> 4""")
def page_cards(get):
    """Feeds with a store that is shown twice, and blocked pages."""
    badge = F.when(F.col("p_size") % 3 == 0, "20% di sconto").when(F.col("p_size") % 3 == 1, "tutto il menù in promozione").otherwise("Consegna gratis")
    free = F.lit("Consegna gratis")
    first = _card(F.col("p_name"), F.concat(F.lit("/menu/1/"), F.col("p_name")), F.lit("nuovo"), free)
    again = _card(F.col("p_name"), F.concat(F.lit("/menu/1/"), F.col("p_name")), badge, free)
    other = _card(F.col("p_brand"), F.concat(F.lit("/menu/2/"), F.col("p_brand")), badge, free)
    body = F.to_json(F.struct(F.struct(F.struct(F.array(F.struct(F.array(F.struct(F.array(first, other, again).alias("blocks"))).alias("data"))).alias("layoutGroups")).alias("results")).alias("data")))
    page = F.when(F.col("p_size") % 5 == 4, F.lit("<html>Just a moment...</html>")).otherwise(body)
    return payload.cards(get("part").select(F.col("p_partkey").alias("page"), page.alias("body")))


_PCT = "CAST(p_size AS STRING)"


@query(f"""SELECT p_partkey AS page, CASE p_partkey % 6 WHEN 0 THEN '2 al prezzo di 1' WHEN 1 THEN concat('Spendi almeno 10,00 €, risparmia ', {_PCT}, '%') WHEN 2 THEN concat({_PCT}, '% di sconto') WHEN 3 THEN '25% di sconto' WHEN 4 THEN 'PERCENTAGE_DISCOUNT' ELSE 'Spendi 15,00 € per -25% su articoli selezionati' END AS promotion,
  CASE p_partkey % 6 WHEN 0 THEN 'FullMenuPercentOffOffer|BuyOneGetOneFreeOffer' WHEN 1 THEN 'FullMenuPercentOffOffer' WHEN 2 THEN 'ItemSpecificPercentOffOffer' WHEN 3 THEN 'FreeDeliveryOffer' WHEN 4 THEN 'PercentOffOffer' ELSE 'ItemSpecificPercentOffOffer' END AS offer_kinds, CAST(CASE p_partkey % 6 WHEN 1 THEN 0 ELSE 1 END AS BIGINT) AS n_items, CAST(25 AS DOUBLE) AS best FROM part""")
def menu_offers(get):
    """Menu pages with one reduced item, shown twice, and offers of each kind."""
    k, pct = F.col("p_partkey") % 6, F.col("p_size").cast("double")
    offer = lambda kind, mov, p: F.struct(F.lit(kind).alias("typeName"), F.struct(F.lit(mov).alias("formatted")).alias("minimumOrderValue"), p.alias("percentageDiscount"))
    none = F.lit(None).cast("double")
    offers = F.when(k == 0, F.array(offer("FullMenuPercentOffOffer", "10,00 €", pct), offer("BuyOneGetOneFreeOffer", "0,00 €", none))).when(k == 1, F.array(offer("FullMenuPercentOffOffer", "10,00 €", pct)))
    offers = offers.when(k == 2, F.array(offer("ItemSpecificPercentOffOffer", "0,00 €", pct))).when(k == 3, F.array(offer("FreeDeliveryOffer", "12,00 €", none))).when(k == 4, F.array(offer("PercentOffOffer", "", pct))).otherwise(F.array(offer("ItemSpecificPercentOffOffer", "15,00 €", none)))
    money = lambda cents, shown: F.struct(F.lit(cents).alias("fractional"), F.lit(shown).alias("formatted"))
    item = F.struct(F.col("p_name").alias("name"), money(800, "8,00 €").alias("price"), money(600, "6,00 €").alias("priceDiscounted"), F.lit("").alias("offerText"))
    body = F.to_json(F.struct(F.struct(F.array(item, item).alias("items"), offers.alias("offers")).alias("props")), {"ignoreNullFields": "false"})
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script></html>"))
    return payload.parse_menus(get("part").select(F.col("p_partkey").alias("page"), html.alias("html")))


@query("SELECT DISTINCT CAST(r AS DOUBLE) AS rank, label FROM (VALUES (1.0, '2x1'), (2.0, '% off prodotto'), (2.5, 'Flat prodotto'), (3.0, 'Basket %'), (4.0, 'Consegna gratis'), (5.0, 'Consegna scontata'), (6.0, 'Nessuna promo')) x(r, label) WHERE r IN (SELECT CASE promotion_type WHEN '2 al prezzo di 1' THEN 1.0 WHEN '20% di sconto' THEN 2.0 WHEN '40% di sconto' THEN 2.0 WHEN 'Spendi almeno 10,00 €, risparmia 15%' THEN 3.0 WHEN 'Consegna gratis' THEN 4.0 WHEN '2,50 € di sconto' THEN 2.5 ELSE 6.0 END FROM comp_raw)")
def rank_labels(get):
    """F16."""
    rank = promo.rank_of_text(F.col("promotion_type"))
    return get("comp_raw").select(rank.alias("rank")).distinct().select("rank", promo.rank_label(F.col("rank")).alias("label"))


@query("WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events) SELECT DISTINCT user_id, CAST(day AS VARCHAR) AS day FROM c WHERE (user_id, day) NOT IN (SELECT (user_id, day) FROM c WHERE NOT regexp_matches(lower(event_type), '^(view|error)'))")
def resume_set(get):
    """Cells, here days of users, that have no outcome but a failed one are visited again."""
    cells = get("events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    done = cells.where(~F.lower("event_type").rlike("^(view|error)"))
    return tables.not_done(cells.select("user_id", "day").distinct(), done, ["user_id", "day"]).select("user_id", F.col("day").cast("string").alias("day"))


@query("SELECT n_name AS city_code, count(*) AS points FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n_name ORDER BY points, city_code")
def cities_by_points(get):
    """L07."""
    rows = get("supplier").join(get("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_name").alias("city_code")).agg(F.count("*").alias("points")).orderBy("points", "city_code")
