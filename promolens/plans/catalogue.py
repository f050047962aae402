"""All queries by name, with DuckDB SQL for each that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators import parity, quality, resolve, state
from promolens.plans.bridge import oracle
from promolens.plans.registry import Tables
from promolens.sources import geo, payload

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
KEY = list(parity.KEY)


def query(sql: str | None = None):
    """Register a function of a registry of tables under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[f.__name__] = oracle(sql)
        return f

    return add


# ---------------------------------------------------------------- shared SQL
_RANK = "CAST(CASE {0} WHEN 'TWO_FOR_ONE' THEN 1.0 WHEN 'PERCENTAGE_DISCOUNT' THEN 2.0 WHEN 'FLAT_PRODUCT' THEN 2.5 WHEN 'BASKET_PERCENTAGE' THEN 3.0 WHEN 'FREE_DELIVERY' THEN 4.0 WHEN 'FLAT_DELIVERY' THEN 5.0 ELSE 6.0 END AS DOUBLE)"
#: The patterns as the rules have them, written out so that they do not rest on the engine's.
_TEXT_RANK = r"""CAST(CASE WHEN regexp_matches({0}, '(?i)2\s*al\s*prezzo\s*di\s*1|2x1|due\s+al\s+prezzo') THEN 1.0
  WHEN regexp_matches({0}, '(?i)\d+\s*%\s*(di\s*)?sconto|prodotti\s*selezionati|fino\s*al\s*\d+\s*%|sconto\s+su\s+(prodotti|articoli)|sconto\s+sull') THEN 2.0
  WHEN regexp_matches({0}, '(?i)sconto\s*fisso|prezzo\s*speciale|\d+[,\.]\d+\s*€\s*di\s*sconto') THEN 2.5
  WHEN regexp_matches({0}, '(?i)spendi\s*(almeno|min|da)?\s*[\d,\.]+|basket\s*%|spend[io]\s*\d+\s*€?\s*(per|ottieni|e\s*ottieni)') THEN 3.0
  WHEN regexp_matches({0}, '(?i)consegna\s*grat(is|uita)|free\s*delivery|spedizione\s*grat') THEN 4.0
  WHEN regexp_matches({0}, '(?i)consegna\s*a\s*[\d,\.]+\s*€|flat\s*delivery|\d+[,\.]\d+\s*€\s*(di\s*)?consegna') THEN 5.0 ELSE 6.0 END AS DOUBLE)"""
_NUM = "list_transform(regexp_extract_all({0}, '(?i){1}', 1), lambda x: CAST(replace(x, ',', '.') AS DOUBLE))"
_PCT = "coalesce(list_max(" + _NUM.format("{0}", r"(\d+(?:[.,]\d+)?)\s*%") + "), 0.0)"
_BASKET = "coalesce(list_min(" + _NUM.format("{0}", r"(?:spendi|almeno|min|da)\s*(?:almeno|min|da)?\s*(\d+(?:[.,]\d+)?)\s*€") + "), 0.0)"
_STRONGEST = "CASE WHEN kind LIKE '%TWO_FOR_ONE%' THEN 'TWO_FOR_ONE' ELSE kind END"


def _stores(name: str, member: bool) -> str:
    on = "promotion_prime = 'Y'" if member else "false"
    return f"""{name}_v AS (SELECT *, CASE WHEN flag = 'Y' THEN revenue ELSE 0.0 END AS promo_revenue FROM (
        SELECT city_code, store_name, week_num, product_name, total_product_sold, min_basket_size_np, CASE WHEN {on} THEN 'Y' ELSE promo_non_prime END AS flag,
          CASE WHEN {on} THEN type_of_promo_p ELSE type_of_promo_np END AS kind, avg_unit_price * total_product_sold AS revenue,
          CASE WHEN (CASE WHEN {on} THEN type_of_promo_p ELSE type_of_promo_np END) SIMILAR TO '.*(PERCENTAGE_DISCOUNT|BASKET_PERCENTAGE).*' THEN (CASE WHEN {on} THEN percentage_off_p ELSE percentage_off_np END) ELSE 0.0 END AS pct FROM own_products)),
      {name}_d AS (SELECT city_code, store_name, week_num, arg_min(k, (-covered, r)) AS best_promo_type, arg_min(r, (-covered, r)) AS best_promo_rank FROM (
        SELECT city_code, store_name, week_num, k, round(sum(revenue), 4) AS covered, {_RANK.format('k')} AS r FROM (SELECT *, {_STRONGEST} AS k FROM {name}_v WHERE flag = 'Y') GROUP BY ALL) GROUP BY ALL),
      {name} AS (SELECT a.*, best_promo_type, coalesce(best_promo_rank, CAST(6 AS DOUBLE)) AS best_promo_rank FROM (
        SELECT city_code, store_name, week_num, round(avg(pct) FILTER (flag = 'Y' AND pct > 0), 1) AS avg_pct_off, round(max(pct) FILTER (flag = 'Y' AND pct > 0), 1) AS max_pct_off,
          round(max(min_basket_size_np) FILTER (flag = 'Y' AND kind = 'BASKET_PERCENTAGE'), 0) AS min_basket_size, count(DISTINCT product_name) FILTER (flag = 'Y') AS promo_product_count,
          CAST(trunc(sum(total_product_sold)) AS BIGINT) AS total_sold, round(sum(revenue), 2) AS revenue, round(sum(promo_revenue), 2) AS promo_revenue,
          CASE WHEN sum(revenue) > 0 THEN round(sum(promo_revenue) / sum(revenue) * 100, 1) ELSE 0.0 END AS promo_coverage_pct FROM {name}_v GROUP BY ALL) a LEFT JOIN {name}_d USING (city_code, store_name, week_num))"""


#: The fold of names in SQL.
FOLD = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"
_LISTING = """totals AS (SELECT city_code, trim(regexp_replace(strip_accents(lower(restaurant_name)), '[^a-z0-9]+', ' ', 'g')) AS name_norm, count(DISTINCT store_id) AS n_stores_total FROM comp_raw GROUP BY ALL),
  listing AS (SELECT city_code, name_norm, restaurant_name, promotion_type, first_seq, least(n, nt) AS n_stores_with_promo, nt AS n_stores_total, round_even(least(n, nt) / nt * 100, 0) AS stores_pct FROM (
    SELECT a.*, coalesce(n_stores_total, n) AS nt FROM (SELECT upper(city_code) AS city_code, trim(regexp_replace(strip_accents(lower(restaurant_name)), '[^a-z0-9]+', ' ', 'g')) AS name_norm, promotion_type, arg_min(restaurant_name, seq) AS restaurant_name, min(seq) AS first_seq, count(DISTINCT split_part(source_url, '?', 1)) AS n FROM comp_raw GROUP BY ALL) a
    LEFT JOIN totals USING (city_code, name_norm)))"""
_INDEX = f"""ranked AS (SELECT *, {_TEXT_RANK.format('promotion_type')} AS comp_rank, {_PCT.format('promotion_type')} AS comp_pct, {_BASKET.format('promotion_type')} AS comp_basket FROM listing),
  comp_index AS (SELECT city_code, name_norm, unnest(arg_min({{'promotion_type': promotion_type, 'comp_rank': comp_rank, 'comp_pct': comp_pct, 'comp_basket': comp_basket, 'stores_pct': stores_pct}},
    (CASE WHEN stores_pct >= 50 THEN 0 ELSE 1 END, CASE WHEN stores_pct >= 50 THEN 0.0 ELSE -stores_pct END, comp_rank, -comp_pct, promotion_type))) FROM ranked GROUP BY city_code, name_norm)"""


def _verdicts(name: str, stores: str) -> str:
    up = lambda r, b: f"CASE WHEN {r} = 3.0 AND coalesce({b}, 0) <> 0 AND order_value >= {b} - 1 THEN 2.0 ELSE {r} END"
    ladder = """CASE WHEN g = 1 AND d = 2 AND gs = 'selected' AND ds = 'full' THEN 'PARITY' WHEN g < d THEN 'SUPERIORITY' WHEN g > d THEN 'INFERIORITY'
      WHEN g = d AND g = 2 AND gp > 0 AND dp > 0 THEN CASE WHEN gp - dp >= 2 THEN 'SUPERIORITY' WHEN gp - dp <= -2 THEN 'INFERIORITY' WHEN gs = 'full' AND ds = 'selected' THEN 'SUPERIORITY' WHEN ds = 'full' AND gs = 'selected' THEN 'INFERIORITY' WHEN np >= 2 THEN 'SUPERIORITY' ELSE 'PARITY' END
      WHEN g = d AND g = 3 AND gp > 0 AND dp > 0 THEN CASE WHEN abs(gb - db) <= 10 THEN CASE WHEN gp - dp >= 2 THEN 'SUPERIORITY' WHEN gp - dp <= -2 THEN 'INFERIORITY' WHEN gb < db THEN 'SUPERIORITY' WHEN gb > db THEN 'INFERIORITY' ELSE 'PARITY' END
        ELSE CASE WHEN gp - dp >= 2 AND gb <= db THEN 'SUPERIORITY' WHEN gp - dp <= -2 AND gb >= db THEN 'INFERIORITY' ELSE 'PARITY' END END ELSE 'PARITY' END"""
    return f"""absent AS (SELECT city_code, store_name, CASE WHEN bool_or(source = 'manual_rejected') THEN 'EXCLUSIVE_OWN' WHEN bool_or(source = 'not_on_comp') THEN 'NOT_ON_COMP' END AS why FROM mapping WHERE trim(comp_name) = '' GROUP BY ALL),
      {name}_m AS (SELECT s.*, m.name_norm, why, {up('best_promo_rank', 'min_basket_size')} AS g, coalesce({up('comp_rank', 'comp_basket')}, 6.0) AS d, coalesce(max_pct_off, avg_pct_off, 0) AS gp, coalesce(comp_pct, 0) AS dp,
          coalesce(promo_product_count, 0) AS np, coalesce(min_basket_size, 0) AS gb, coalesce(comp_basket, 0) AS db, CASE best_promo_type WHEN 'BASKET_PERCENTAGE' THEN 'full' WHEN 'TWO_FOR_ONE' THEN 'selected' ELSE '' END AS gs,
          CASE WHEN contains(lower(coalesce(promotion_type, '')), 'selezionat') THEN 'selected' WHEN regexp_matches(lower(coalesce(promotion_type, '')), 'spendi|risparmia|ordine|sconto|%') THEN 'full' ELSE '' END AS ds
        FROM {stores} s LEFT JOIN order_values USING (city_code, store_name, week_num) LEFT JOIN (SELECT city_code, store_name, trim(regexp_replace(strip_accents(lower(comp_name)), '[^a-z0-9]+', ' ', 'g')) AS name_norm FROM mapping WHERE trim(comp_name) <> '') m USING (city_code, store_name)
        LEFT JOIN comp_index i ON i.city_code = s.city_code AND i.name_norm = m.name_norm LEFT JOIN absent a ON a.city_code = s.city_code AND a.store_name = s.store_name),
      {name} AS (SELECT city_code, store_name, week_num, unnest(arg_min({{'name_norm': name_norm, 'own_rank': g, 'comp_rank': d, 'parity': parity, 'revenue': revenue, 'promo_coverage_pct': promo_coverage_pct, 'best_promo_type': best_promo_type}},
          (CASE parity WHEN 'INFERIORITY' THEN 0 WHEN 'PARITY' THEN 1 ELSE 2 END, d, -dp, coalesce(name_norm, '')))) FROM (SELECT *, CASE WHEN name_norm IS NOT NULL THEN {ladder} ELSE coalesce(why, 'UNMATCHED') END AS parity FROM {name}_m) GROUP BY city_code, store_name, week_num)"""


def _rollup(name: str, verdicts: str) -> str:
    n = lambda v: f"count(*) FILTER (parity = '{v}')"
    r = lambda v: f"coalesce(sum(revenue) FILTER (parity = '{v}'), 0)"
    m = "count(*) FILTER (parity IN ('SUPERIORITY', 'PARITY', 'INFERIORITY'))"
    t = "coalesce(sum(revenue) FILTER (parity IN ('SUPERIORITY', 'PARITY', 'INFERIORITY')), 0)"
    parts = ", ".join(f"{n(v)} AS n_{v.lower()}, CASE WHEN {m} > 0 THEN round({n(v)} / {m} * 100, 1) ELSE 0.0 END AS pct_{v.lower()}, CASE WHEN {t} > 0 THEN round({r(v)} / {t} * 100, 1) WHEN {m} > 0 THEN round({n(v)} / {m} * 100, 1) ELSE 0.0 END AS w_{v.lower()}" for v in parity.MATCHED)
    return f"""{name} AS (SELECT *, CASE WHEN w_superiority >= greatest(w_parity, w_inferiority) THEN 'SUPERIORITY' WHEN w_parity >= w_inferiority THEN 'PARITY' ELSE 'INFERIORITY' END AS city_parity_label,
        CASE WHEN n_stores_total > n_exclusive_own THEN round(n_stores_matched / (n_stores_total - n_exclusive_own) * 100, 1) ELSE 0.0 END AS match_coverage_pct
      FROM (SELECT city_code, week_num, count(*) AS n_stores_total, {m} AS n_stores_matched, {n('UNMATCHED')} AS n_unmatched, count(*) FILTER (parity IN ('EXCLUSIVE_OWN', 'NOT_ON_COMP')) AS n_exclusive_own, {parts} FROM {verdicts} WHERE parity <> 'NOT_ON_OWN' GROUP BY ALL))"""


_BASE = f"cte: {_stores('stores', False)}, {_LISTING}, {_INDEX}, {_verdicts('verdicts', 'stores')}, {_rollup('cities', 'verdicts')} "
_NAMES = "/* own_products comp_raw mapping order_values */"
_MEMBER = f"cte: {_stores('stores', False)}, {_stores('members', True)}, {_LISTING}, {_INDEX}, {_verdicts('verdicts', 'stores')}, {_verdicts('member_verdicts', 'members').replace('absent AS', 'absent2 AS')} "
_OWN = "type_of_promo_np AS kind, promo_non_prime AS flag"


# ---------------------------------------------------------------- shared frames
def _index(get) -> DataFrame:
    raw = get("comp_raw")
    return parity.competitor_index(parity.listing(raw, _branches(raw)))


def _branches(raw: DataFrame) -> DataFrame:
    return raw.select("city_code", "restaurant_name", "store_id").distinct().select("city_code", text.fold(F.col("restaurant_name")).alias("name_norm"), "store_id")


def _verdict_rows(get, member: bool = False) -> DataFrame:
    return parity.store_verdicts(parity.store_aggregate(get("own_products"), member), get("mapping_links"), _index(get), get("order_values"), get("mapping_pools"))


def _both_verdicts(get) -> DataFrame:
    """The verdicts of both views from one pass over each table."""
    return parity.store_verdicts(parity.both_aggregates(get("own_products")), get("mapping_links"), _index(get), get("order_values"), get("mapping_pools"))


def _mapped_stores(get) -> DataFrame:
    """Stores with a name on the other side, without the mapping's pairs."""
    links, named = get("mapping_links"), get("mapping_pools").where("comp_name <> ''")
    own, shared = links.where("comp_name <> ''"), links.join(named, ["city_code", "pool"], "left_semi")
    return own.select("city_code", "store_name").unionByName(shared.select("city_code", "store_name")).distinct()


def _mapped_names(get) -> DataFrame:
    """Names on the other side that the mapping has, blank ones included, without its pairs."""
    links = get("mapping_links")
    shared = get("mapping_pools").join(links, ["city_code", "pool"], "left_semi")
    return links.where("pool is null").select("city_code", "comp_name").unionByName(shared.select("city_code", "comp_name")).distinct()


def _latest_verdicts(get) -> DataFrame:
    """Verdicts of the latest week: its products alone are read, and its name comes from the scan."""
    last = get("lineitem").agg(F.max(F.year("l_shipdate")).cast("string").alias("week_num"))  # one row
    own = get("own_products").join(F.broadcast(last), "week_num", "left_semi")
    return parity.store_verdicts(parity.store_aggregate(own), get("mapping_links"), _index(get), get("order_values"), get("mapping_pools"))


def _cities(get) -> DataFrame:
    return parity.city_rollup(_verdict_rows(get))


# ---------------------------------------------------------------- verdicts and roll-ups
@query(_BASE + "SELECT * FROM cities" + _NAMES)
def city_parity_flagship(get):
    return _cities(get)


@query(_BASE + "SELECT * FROM verdicts" + _NAMES)
def store_parity_std(get):
    return _verdict_rows(get)


@query(_MEMBER + "SELECT * FROM member_verdicts" + _NAMES)
def store_parity_prime(get):
    return _verdict_rows(get, True)


_DIR = "CASE WHEN (CASE m.parity WHEN 'SUPERIORITY' THEN 0 WHEN 'PARITY' THEN 1 WHEN 'INFERIORITY' THEN 2 ELSE 9 END) < (CASE s.parity WHEN 'SUPERIORITY' THEN 0 WHEN 'PARITY' THEN 1 WHEN 'INFERIORITY' THEN 2 ELSE 9 END) THEN 'improves' ELSE 'worsens' END AS direction"


@query(_MEMBER + f"SELECT s.city_code, s.store_name, s.week_num, s.parity AS standard_parity, s.revenue, m.parity AS member_parity, {_DIR} FROM verdicts s JOIN member_verdicts m USING (city_code, store_name, week_num) WHERE s.parity <> m.parity" + _NAMES)
def parity_delta(get):
    return parity.member_delta(_both_verdicts(get))


@query(_BASE + "SELECT * FROM stores /* own_products comp_raw mapping order_values */")
def store_aggregate(get):
    return parity.store_aggregate(get("own_products"))


@query(_MEMBER + "SELECT * FROM members" + _NAMES)
def store_aggregate_prime(get):
    return parity.store_aggregate(get("own_products"), True)


@query(f"cte: {_stores('stores', False)} SELECT * FROM stores_d")
def dominant_promo(get):
    return parity.dominant_promo(parity.promo_view(get("own_products")))


@query(_BASE + "SELECT week_num, round(avg(w_superiority), 1) AS w_superiority, round(avg(w_parity), 1) AS w_parity, round(avg(w_inferiority), 1) AS w_inferiority, CAST(sum(n_stores_matched) AS BIGINT) AS n_stores_matched FROM cities GROUP BY ALL" + _NAMES)
def national_trend(get):
    return parity.national_trend(_cities(get))


@query(_BASE + "SELECT city_code, week_num, round(score, 1) AS score, round(score - before, 1) AS delta FROM (SELECT *, lag(score) OVER (PARTITION BY city_code ORDER BY week_num) AS before FROM (SELECT *, w_superiority - w_inferiority AS score FROM cities)) WHERE before IS NOT NULL" + _NAMES)
def wow_delta(get):
    return parity.week_delta(_cities(get))


@query(_BASE + "SELECT city_code, week_num, kind, share FROM (UNPIVOT (SELECT city_code, week_num, w_superiority AS superiority, w_parity AS parity, w_inferiority AS inferiority FROM cities) ON superiority, parity, inferiority INTO NAME kind VALUE share)" + _NAMES)
def share_unpivot(get):
    rows = _cities(get).select("city_code", "week_num", *[F.col(f"w_{v.lower()}").alias(v.lower()) for v in parity.MATCHED])
    return rows.unpivot(["city_code", "week_num"], [v.lower() for v in parity.MATCHED], "kind", "share")


@query(_BASE + "SELECT city_code, round(avg(w_superiority - w_inferiority) FILTER (week_num = '1995'), 1) AS y1995, round(avg(w_superiority - w_inferiority) FILTER (week_num = '1996'), 1) AS y1996 FROM cities GROUP BY ALL" + _NAMES)
def score_pivot(get):
    rows = _cities(get).withColumn("score", F.col("w_superiority") - F.col("w_inferiority"))
    out = rows.groupBy("city_code").pivot("week_num", ["1995", "1996"]).agg(F.round(F.avg("score"), 1))
    return out.withColumnsRenamed({"1995": "y1995", "1996": "y1996"})


@query(_BASE + "SELECT city_code, store_name, week_num, revenue, row_number() OVER (ORDER BY revenue DESC, city_code, store_name, week_num) AS priority FROM verdicts WHERE parity = 'INFERIORITY' AND week_num = (SELECT max(week_num) FROM verdicts) ORDER BY priority LIMIT 30" + _NAMES)
def priority_actions(get):
    top = _latest_verdicts(get).where("parity = 'INFERIORITY'")
    top = top.orderBy(F.desc("revenue"), "city_code", "store_name", "week_num").limit(30)
    return top.select(*KEY, "revenue", F.row_number().over(Window.orderBy(F.desc("revenue"), "city_code", "store_name", "week_num")).alias("priority"))


@query(_BASE + "SELECT city_code, store_name, week_num, revenue FROM verdicts WHERE parity = 'INFERIORITY' ORDER BY week_num DESC, revenue DESC, city_code, store_name LIMIT 30" + _NAMES)
def priority_live(get):
    return _verdict_rows(get).where("parity = 'INFERIORITY'").orderBy(F.desc("week_num"), F.desc("revenue"), "city_code", "store_name").limit(30).select(*KEY, "revenue")


@query(_BASE + "SELECT city_code, store_name, week_num, revenue FROM verdicts WHERE parity = 'UNMATCHED' AND week_num = (SELECT max(week_num) FROM verdicts)" + _NAMES)
def unmatched_latest(get):
    return _latest_verdicts(get).where("parity = 'UNMATCHED'").select(*KEY, "revenue")


@query(_BASE + "SELECT city_code, store_name, week_num, parity FROM verdicts QUALIFY row_number() OVER (PARTITION BY city_code, store_name ORDER BY week_num DESC) <= 4" + _NAMES)
def last4_weeks(get):
    w = Window.partitionBy("city_code", "store_name").orderBy(F.desc("week_num"))
    return _verdict_rows(get).withColumn("r", F.row_number().over(w)).where("r <= 4").select(*KEY, "parity")


@query(_BASE + "SELECT city_code, store_name, arg_max(parity, (week_num <= '1996', week_num)) AS parity, arg_max(week_num, (week_num <= '1996', week_num)) AS week_num FROM verdicts GROUP BY ALL" + _NAMES)
def latest_in_filter(get):
    best = F.max_by(F.struct("parity", "week_num"), F.struct(F.col("week_num") <= "1996", F.col("week_num")))
    return _verdict_rows(get).groupBy("city_code", "store_name").agg(best.alias("x")).select("city_code", "store_name", "x.*")


@query(_BASE + "SELECT parity, count(*) AS n, round(sum(revenue), 2) AS revenue FROM verdicts GROUP BY ALL" + _NAMES)
def verdict_tally(get):
    return _verdict_rows(get).groupBy("parity").agg(F.count("*").alias("n"), F.round(F.sum("revenue"), 2).alias("revenue"))


@query(_BASE + "SELECT manager, v.week_num, count(*) AS n, count(*) FILTER (parity = 'INFERIORITY') AS n_inferiority FROM verdicts v JOIN managers m ON v.city_code = m.city_code GROUP BY ALL" + _NAMES)
def manager_view(get):
    out = _verdict_rows(get).join(get("managers"), "city_code").groupBy("manager", "week_num")
    return out.agg(F.count("*").alias("n"), F.count(F.when(F.col("parity") == "INFERIORITY", 1)).alias("n_inferiority"))


@query(_BASE + "SELECT week_num, " + ", ".join(f"round(count(*) FILTER (parity = '{v}') / count(*) * 100, 1) AS pct_{v.lower()}" for v in parity.MATCHED) + " FROM verdicts WHERE parity NOT IN ('UNMATCHED', 'EXCLUSIVE_OWN') GROUP BY week_num" + _NAMES)
def qc_distribution(get):
    return quality.distribution(_verdict_rows(get))


# ---------------------------------------------------------------- competitor side
@query(f"cte: {_LISTING} SELECT * FROM listing /* comp_raw */")
def comp_dedup(get):
    return parity.listing(get("comp_raw"), _branches(get("comp_raw")))


@query(f"cte: {_LISTING} SELECT * FROM totals /* comp_raw */")
def store_totals(get):
    return parity.store_totals(_branches(get("comp_raw")))


@query(f"cte: {_LISTING}, {_INDEX} SELECT * FROM comp_index /* comp_raw */")
def comp_best_promo(get):
    return _index(get)


@query("cte: x AS (SELECT city_code, lower(trim(restaurant_name)) AS name_norm, promotion_type, min(seq) AS first FROM comp_raw WHERE promotion_type <> '' GROUP BY ALL) SELECT city_code, name_norm, string_agg(promotion_type, ' | ' ORDER BY first, promotion_type) AS promotions FROM x GROUP BY city_code, name_norm /* comp_raw */")
def promo_concat_distinct(get):
    return resolve.concat_distinct(get("comp_raw").where("promotion_type <> ''").withColumn("name_norm", F.lower(F.trim("restaurant_name"))), ["city_code", "name_norm"], "promotion_type", "seq")


@query(f"cte: t AS (SELECT DISTINCT promotion_type FROM comp_raw UNION SELECT DISTINCT concat(promotion_type, ' | ', '15% di sconto') FROM comp_raw UNION SELECT DISTINCT concat('Spendi almeno 30 € | ', promotion_type) FROM comp_raw) SELECT promotion_type, list_min(list_transform(string_split(promotion_type, '|'), lambda s: {_TEXT_RANK.format('trim(s)')})) AS rank, {_PCT.format('promotion_type')} AS pct, {_BASKET.format('promotion_type')} AS basket FROM t /* comp_raw */")
def promo_rank_text(get):
    kinds = get("comp_raw").select("promotion_type").distinct()
    c = F.col("promotion_type")
    pairs = kinds.select(F.explode(F.array(F.concat(c, F.lit(" | 15% di sconto")), F.concat(F.lit("Spendi almeno 30 € | "), c))).alias("promotion_type"))
    return kinds.union(pairs).distinct().select(c, promo.rank_of_text(c).alias("rank"), promo.percent_of_text(c).alias("pct"), promo.basket_of_text(c).alias("basket"))


@query(f"SELECT kind, flag, CASE WHEN flag = 'Y' THEN {_RANK.format('kind')} ELSE 6.0 END AS rank, {_STRONGEST} AS strongest, count(*) AS n FROM (SELECT {_OWN} FROM own_products) GROUP BY ALL")
def promo_rank_own(get):
    rows = get("own_products").select(F.col("type_of_promo_np").alias("kind"), F.col("promo_non_prime").alias("flag"))
    return rows.groupBy("kind", "flag").agg(F.count("*").alias("n")).withColumns({"rank": promo.rank_of_kind(F.col("kind"), F.col("flag")), "strongest": promo.strongest_kind(F.col("kind"))})


@query("SELECT type_of_promo_np AS kind, count(*) AS n FROM own_products WHERE promo_non_prime = 'Y' GROUP BY ALL")
def promo_frequency(get):
    return get("own_products").where("promo_non_prime = 'Y'").groupBy(F.col("type_of_promo_np").alias("kind")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- scalar functions
@query("SELECT p_partkey, TRY_CAST(CASE WHEN contains(k, ',') AND contains(k, '.') THEN replace(replace(k, '.', ''), ',', '.') ELSE replace(k, ',', '.') END AS DOUBLE) AS price FROM (SELECT p_partkey, regexp_replace(concat(replace(CAST(p_retailprice AS STRING), '.', ','), ' €'), '[^0-9.,]', '', 'g') AS k FROM part)")
def price_parse(get):
    return get("part").select("p_partkey", text.price(F.concat(F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")), F.lit(" €"))).alias("price"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 AND l_discount < 1 THEN round((l_extendedprice - l_extendedprice * (1 - l_discount)) / l_extendedprice * 100, 1) END AS pct FROM lineitem")
def pct_off(get):
    return get("lineitem").select("l_orderkey", "l_linenumber", text.percent_off(F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("pct"))


@query("SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))) AS folded FROM documents")
def name_fold(get):
    return get("documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"))


_STOP = ", ".join(f"'{w}'" for w in text.STOPWORDS)


@query(f"SELECT doc_id, md5(array_to_string(list_filter(string_split(trim(regexp_replace(strip_accents(lower(regexp_replace(text, '^[A-Z]{{2,5}}\\s*[-–]\\s*', ''))), '[^\\pL\\pN_]+', ' ', 'g')), ' '), lambda w: w NOT IN ({_STOP}) AND w <> ''), ' ')) AS name FROM documents")
def store_name_normalise(get):
    return get("documents").select("doc_id", F.md5(text.store_name(F.col("text"))).alias("name"))


@query("SELECT p_partkey, trim(regexp_replace(strip_accents(regexp_replace(lower(concat('K', CAST(p_partkey AS STRING), ' - ', p_name)), '^\\s*[a-z]{0,3}\\d+\\s*[-–—.:]\\s*', '')), '[^a-z0-9]+', ' ', 'g')) AS name FROM part")
def product_code_strip(get):
    return get("part").select("p_partkey", text.product_name(F.concat(F.lit("K"), F.col("p_partkey").cast("string"), F.lit(" - "), F.col("p_name"))).alias("name"))


@query("SELECT strftime(o_orderdate, '%G-W%V') AS week, count(*) AS n FROM orders GROUP BY ALL")
def iso_week(get):
    return get("orders").groupBy(text.iso_week(F.col("o_orderdate")).alias("week")).agg(F.count("*").alias("n"))


@query("SELECT page_id, split_part(url, '?', 1) AS url FROM pages")
def url_canonical(get):
    return get("pages").select("page_id", text.canonical_url(F.col("url")).alias("url"))


_GH = "".join(["concat("] + [", ".join(f"substr('{text.GEOHASH}', 1 + CAST(" + " + ".join(f"(({'x' if (5 * k + b) % 2 == 0 else 'y'} >> {(17 if (5 * k + b) % 2 == 0 else 16) - (5 * k + b) // 2}) & 1) * {2 ** (4 - b)}" for b in range(5)) + " AS INTEGER), 1)" for k in range(7))] + [")"])


@query(f"SELECT c_custkey, {_GH} AS geohash FROM (SELECT c_custkey, CAST(floor((c_custkey * 7 % 360 - 180 + 180.0) / 360.0 * 262144) AS BIGINT) AS x, CAST(floor((c_custkey * 3 % 180 - 90 + 90.0) / 180.0 * 131072) AS BIGINT) AS y FROM customer)")
def geohash(get):
    c = F.col("c_custkey")
    return get("customer").select("c_custkey", text.geohash((c * 3 % 180 - 90).cast("double"), (c * 7 % 360 - 180).cast("double"), 7).alias("geohash"))


# ---------------------------------------------------------------- joins and matching
@query("SELECT s.city_code, s.store_name, m.comp_name, m.source FROM (SELECT DISTINCT city_code, store_name FROM own_products) s LEFT JOIN mapping m ON s.city_code = m.city_code AND lower(trim(s.store_name)) = lower(trim(m.store_name))")
def truth_lookup(get):
    return resolve.truth_lookup(get("own_products").select("city_code", "store_name").distinct(), get("mapping"))


@query("SELECT DISTINCT city_code, restaurant_name FROM comp_raw c WHERE promotion_type <> '' AND NOT EXISTS (SELECT 1 FROM mapping m WHERE m.city_code = c.city_code AND lower(trim(m.comp_name)) = lower(trim(c.restaurant_name)))")
def not_on_own(get):
    return resolve.not_on_own(get("comp_raw"), _mapped_names(get))


@query("SELECT p.city_code, p.store_name, count(*) AS n FROM own_products p WHERE EXISTS (SELECT 1 FROM mapping m WHERE m.city_code = p.city_code AND m.store_name = p.store_name AND m.comp_name <> '') GROUP BY ALL")
def known_store_semi(get):
    return get("own_products").join(_mapped_stores(get), ["city_code", "store_name"], "left_semi").groupBy("city_code", "store_name").agg(F.count("*").alias("n"))


@query("SELECT s.city_code, s.store_name, coalesce(n, 0) AS n_promos FROM (SELECT DISTINCT city_code, store_name FROM own_products) s LEFT JOIN (SELECT city_code, restaurant_name AS store_name, count(DISTINCT promotion_type) AS n FROM comp_raw WHERE promotion_type <> '' GROUP BY ALL) c USING (city_code, store_name)")
def comp_count_left(get):
    counts = get("comp_raw").where("promotion_type <> ''").groupBy("city_code", F.col("restaurant_name").alias("store_name")).agg(F.countDistinct("promotion_type").alias("n"))
    return get("own_products").select("city_code", "store_name").distinct().join(counts, ["city_code", "store_name"], "left").select("city_code", "store_name", F.coalesce("n", F.lit(0)).alias("n_promos"))


_SORTED = "array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ')"
_LCS = f"""WITH RECURSIVE names AS (SELECT DISTINCT p_brand AS city_code, {_SORTED} AS n FROM part), met AS (SELECT x.city_code, x.n AS a, y.n AS b FROM names x JOIN names y ON x.city_code = y.city_code AND x.n <> y.n),
  s AS (SELECT DISTINCT a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda z: CAST(0 AS BIGINT)) AS r FROM met
  UNION ALL SELECT a, b, i + 1, list_transform(range(0, length(b) + 1), lambda j: greatest(r[j + 1], coalesce(list_max(list_transform(list_filter(range(1, j + 1), lambda k: substr(b, k, 1) = substr(a, i + 1, 1)), lambda k: r[k] + 1)), 0))) FROM s WHERE i < length(a)),
  scored AS (SELECT a, b, round(200.0 * r[length(b) + 1] / (length(a) + length(b)), 4) AS score FROM s WHERE i = length(a)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY city_code, a ORDER BY score DESC, b) AS rn, lead(score) OVER (PARTITION BY city_code, a ORDER BY score DESC, b) AS second FROM met JOIN scored USING (a, b))
  SELECT city_code, a, b, score, coalesce(second, 0) AS second, CASE WHEN score >= 88 AND score - coalesce(second, 0) >= 10 THEN 'auto' WHEN score >= 88 THEN 'ambiguous' WHEN score >= 70 THEN 'below_threshold' ELSE 'silent' END AS outcome FROM ranked WHERE rn = 1"""


@query(_LCS)
def fuzzy_best_two(get):
    names = get("part").select(F.col("p_brand").alias("city_code"), text.token_sort(F.lower("p_name")).alias("n")).distinct()
    return resolve.best_two(names.withColumnRenamed("n", "a"), names.withColumnRenamed("n", "b"))


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_partkey < b.p_partkey AND a.p_brand = b.p_brand AND abs(a.p_retailprice - b.p_retailprice) <= 1 AND abs(a.p_retailprice - b.p_retailprice) <= 0.05 * greatest(a.p_retailprice, b.p_retailprice)")
def price_band_join(get):
    p = get("part").select("p_partkey", "p_brand", "p_retailprice")
    return resolve.price_band(p.toDF("a", "brand", "pa"), p.toDF("b", "brand", "pb"), ["brand"]).where("a < b").select("a", "b")


@query("""cte: own AS (SELECT DISTINCT city_code, store_name, lower(product_name) AS n FROM own_products WHERE week_num = '1996'), oth AS (SELECT DISTINCT city_code, store_name, lower(product_name) AS n FROM own_products WHERE week_num = '1997'),
  h AS (SELECT o.city_code, o.store_name AS comp, w.store_name AS own, count(*) AS n_overlap FROM oth o JOIN own w USING (city_code, n) GROUP BY ALL), s AS (SELECT city_code, store_name AS comp, count(*) AS products FROM oth GROUP BY ALL)
  SELECT city_code, comp, arg_min(own, (-n_overlap, own)) AS own, max(n_overlap) AS n_overlap, any_value(products) AS products, round(max(n_overlap) / any_value(products), 2) AS ratio FROM h JOIN s USING (city_code, comp) WHERE products >= 4 GROUP BY city_code, comp /* own_products */""")
def fingerprint_overlap(get):
    p = get("own_products").withColumn("n", F.lower("product_name"))
    return resolve.fingerprint(p.where("week_num = '1997'"), p.where("week_num = '1996'"))


# ---------------------------------------------------------------- keyed state
_FOLD = """cte: r AS (SELECT *, max(CASE WHEN name = '' THEN seq END) OVER (PARTITION BY city_code, store_name) AS reset FROM decisions),
  folded AS (SELECT city_code, store_name, name, min(seq) AS seq, 'manual_confirmed' AS status FROM r WHERE name <> '' AND seq > coalesce(reset, -1) GROUP BY ALL
  UNION ALL SELECT city_code, store_name, '' AS name, max(seq) AS seq, CASE WHEN arg_max(source, seq) ILIKE '%not_comp%' OR arg_max(source, seq) ILIKE '%not_on_comp%' THEN 'not_on_comp' ELSE 'manual_rejected' END AS status FROM r GROUP BY city_code, store_name HAVING max(seq) = max(reset))
  SELECT * FROM folded /* decisions */"""


@query(_FOLD)
def decision_log_fold(get):
    return state.fold_log(get("decisions"), ["city_code", "store_name"])


def _old_new(get):
    o = get("orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey", "o_totalprice")
    return o.where("y < 1997"), o.where("y >= 1996")


_ON = "old AS (SELECT o_custkey, year(o_orderdate) AS y, o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) < 1997), new AS (SELECT o_custkey, year(o_orderdate) AS y, o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) >= 1996)"


@query(f"WITH {_ON}, f AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY o_custkey, y ORDER BY o_orderkey DESC) = 1) SELECT * FROM f UNION ALL SELECT * FROM old WHERE (o_custkey, y) NOT IN (SELECT (o_custkey, y) FROM f)")
def upsert_by_key(get):
    return state.upsert(*_old_new(get), ["o_custkey", "y"], "o_orderkey")


@query(f"WITH {_ON} SELECT * FROM new UNION ALL SELECT * FROM old WHERE y NOT IN (SELECT y FROM new)")
def replace_by_week(get):
    return state.replace_partitions(*_old_new(get), "y")


@query("SELECT o_custkey, year(o_orderdate) AS y, o_orderkey FROM orders QUALIFY dense_rank() OVER (ORDER BY year(o_orderdate) DESC) <= 2")
def retain_last_n(get):
    return state.retain_last(get("orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey"), "y", 2)


@query("SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY ALL")
def dedup_last(get):
    return state.keep_one(get("orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY ALL")
def dedup_first(get):
    return state.keep_one(get("orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey", last=False)


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS STRING) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def schema_union(get):
    a = get("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = get("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


def _commands(get, rest: int):
    return get("mapping_links").where(f"try_cast(right(store_name, 3) as int) % 6 = {rest}").select("city_code", "store_name", F.lit("Chosen").alias("comp_name"), F.lit("manual_confirmed").alias("source")).distinct()


_CMD = "cmd AS (SELECT DISTINCT city_code, store_name, 'Chosen' AS comp_name, 'manual_confirmed' AS source FROM mapping WHERE CAST(right(store_name, 3) AS INTEGER) % 6 = {0})"


@query(f"cte: {_CMD.format(1)} SELECT * FROM mapping m WHERE comp_name <> '' OR NOT EXISTS (SELECT 1 FROM cmd c WHERE c.city_code = m.city_code AND c.store_name = m.store_name) UNION ALL SELECT * FROM cmd /* mapping */")
def confirm(get):
    return state.confirm(get("mapping"), _commands(get, 1))


@query(f"cte: {_CMD.format(2)} SELECT * FROM mapping m WHERE NOT EXISTS (SELECT 1 FROM cmd c WHERE c.city_code = m.city_code AND c.store_name = m.store_name) UNION ALL SELECT * FROM cmd /* mapping */")
def set_matches(get):
    return state.set_matches(get("mapping"), _commands(get, 2))


@query("SELECT * FROM mapping WHERE NOT (CAST(right(store_name, 3) AS INTEGER) % 6 = 3 AND store_name = comp_name)")
def remove_match(get):
    return state.remove_match(get("mapping"), get("mapping").where("try_cast(right(store_name, 3) as int) % 6 = 3 and store_name = comp_name"))


@query(f"cte: {_CMD.format(4)} SELECT * FROM mapping m WHERE NOT EXISTS (SELECT 1 FROM cmd c WHERE c.city_code = m.city_code AND c.store_name = m.store_name) UNION ALL SELECT city_code, store_name, '' AS comp_name, 'manual_rejected' AS source FROM cmd /* mapping */")
def reject(get):
    return state.reject(get("mapping"), _commands(get, 4))


# ---------------------------------------------------------------- checks
@query("SELECT n_name AS city_code FROM nation WHERE n_name NOT IN (SELECT n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE s.s_acctbal > 5000 AND s.s_suppkey % 3 = 0)")
def qc_coverage(get):
    n = get("nation").select(F.col("n_name").alias("city_code"), "n_nationkey")
    found = get("supplier").where("s_acctbal > 5000 and s_suppkey % 3 = 0").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return quality.missing_cities(n.select("city_code"), found)


@query("""cte: x AS (SELECT city_code, count(*) FILTER (year(scraped_at) = 1996 AND month(scraped_at) <= 6) AS n_now, count(*) FILTER (year(scraped_at) = 1995) AS n_before FROM comp_raw GROUP BY ALL)
  SELECT * FROM (SELECT *, round((n_now - n_before) / n_before * 100, 1) AS shift_pct, CASE WHEN round((n_now - n_before) / n_before * 100, 1) < -20 THEN 'WARNING' WHEN round((n_now - n_before) / n_before * 100, 1) > 50 THEN 'INFO' END AS level FROM x WHERE n_before > 0) WHERE level IS NOT NULL /* comp_raw */""")
def qc_count_delta(get):
    raw = get("comp_raw")
    return quality.count_shift(raw.where("year(scraped_at) = 1996 and month(scraped_at) <= 6"), raw.where("year(scraped_at) = 1995"))


# ---------------------------------------------------------------- events
@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def events_dedup(get):
    return state.keep_one(get("events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id", last=False)


@query("""WITH a AS (SELECT user_id, ts, event_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM a) SELECT user_id, max(n) AS longest FROM (SELECT user_id, island, count(*) AS n FROM b GROUP BY ALL) GROUP BY ALL""")
def events_streak(get):
    return resolve.longest_streak(get("events"), "user_id", "event_type", ["ts", "event_id"])


@query("SELECT strftime(ts, '%G-W%V') AS week, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def events_weekly(get):
    return get("events").groupBy(text.iso_week(F.col("ts")).alias("week"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(get):
    return get("events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT city_code, string_agg(DISTINCT restaurant_name, '|' ORDER BY restaurant_name) AS names FROM comp_raw GROUP BY city_code")
def domain_lists(get):
    return get("comp_raw").groupBy("city_code").agg(F.array_join(F.sort_array(F.collect_set("restaurant_name")), "|").alias("names"))


# ---------------------------------------------------------------- sources and streams


_BOX = "SELECT n_name AS code, n_nationkey / 4.0 + 7 AS x0, n_nationkey / 2.0 + 35 AS y0 FROM nation"


@query(f"""WITH RECURSIVE b AS ({_BOX}), lat AS (SELECT code, x0, y0, CAST(y0 AS DOUBLE) AS y FROM b UNION ALL SELECT code, x0, y0, y + 4 / 110.574 FROM lat WHERE y + 4 / 110.574 <= y0 + 0.3),
  lon AS (SELECT *, CAST(x0 AS DOUBLE) AS x, 4 / (111.32 * greatest(0.2, cos(radians(y)))) AS dx FROM lat UNION ALL SELECT code, x0, y0, y, x + dx, dx FROM lon WHERE x + dx <= x0 + 0.3)
  SELECT code, count(*) AS n, round(sum(x), 4) AS x, round(sum(y), 4) AS y FROM lon GROUP BY code""")
def grid_sample(get):
    """a box in each nation's place; four kilometres are wider than a geohash of seven letters."""
    corner = lambda dx, dy: F.concat((F.col("x0") + dx).cast("string"), F.lit(" "), (F.col("y0") + dy).cast("string"))
    box = get("nation").select(F.col("n_name").alias("code"), (F.col("n_nationkey") / 4.0 + 7).alias("x0"), (F.col("n_nationkey") / 2.0 + 35).alias("y0"))
    box = box.select("code", F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(0, 0), corner(0.3, 0), corner(0.3, 0.3), corner(0, 0.3), corner(0, 0)), F.lit("))")).alias("wkt"))
    return geo.grid(box, 4.0).groupBy("code").agg(F.count("*").alias("n"), F.round(F.sum("lon"), 4).alias("x"), F.round(F.sum("lat"), 4).alias("y"))


def _stream_fold(spark, sf_dir):
    from promolens.streaming import fold

    return fold.fold_stream(spark, sf_dir)


QUERIES["stream_fold"] = _stream_fold
ORACLE_SQL["stream_fold"] = oracle(_FOLD)
