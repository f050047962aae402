"""Names that stores share, said once: the same mapping, verdicts and matches as from its pairs."""

import datetime
import random

import duckdb
from pyspark.sql import functions as F

from promolens.functions import promo
from promolens.operators import parity, products, publish, resolve
from promolens.plans import bridge, catalogue, dashboard  # noqa: F401  (dashboard joins the catalogue)
from promolens.plans import products as _products  # noqa: F401  (so do its queries)
from promolens.plans.registry import Tables

SF = "/root/testdata/sf0.001"
STORE = "city_code string, store_name string, week_num string, best_promo_rank double, min_basket_size double, avg_pct_off double, max_pct_off double, promo_product_count long, revenue double, promo_coverage_pct double, best_promo_type string"
INDEX = "city_code string, name_norm string, promotion_type string, comp_rank double, comp_pct double, comp_basket double, stores_pct double"


def rows(df):
    return sorted(map(str, df.collect()))


def test_links_and_pools_are_the_mapping(spark):
    get = Tables(spark, "/root/testdata/sf0.01")
    links, pools = get("mapping_links"), get("mapping_pools")
    shared = links.drop("comp_name").join(pools, ["city_code", "pool"])
    columns = ["city_code", "store_name", "comp_name", "source"]
    assert rows(links.where("pool is null").select(columns).union(shared.select(columns)).distinct()) == rows(get("mapping").distinct())
    assert rows(catalogue._mapped_stores(get)) == rows(get("mapping").where("comp_name <> ''").select("city_code", "store_name").distinct())
    assert rows(catalogue._mapped_names(get)) == rows(get("mapping").select("city_code", "comp_name").distinct())


def test_verdicts_from_pools(spark):
    rng = random.Random(51)
    some = [("2 al prezzo di 1", 1.0, 0.0, 0.0), ("20% di sconto", 2.0, 20.0, 0.0), ("40% di sconto", 2.0, 40.0, 0.0), ("Spendi almeno 10 €, risparmia 15%", 3.0, 15.0, 10.0), ("", 6.0, 0.0, 0.0)]
    index = [("A", f"n{k}", *rng.choice(some), 100.0) for k in range(30) if k % 7]  # some names have no promotion
    stores = [("A", f"s{k}", w, rng.choice([1.0, 2.0, 3.0, 6.0]), rng.choice([None, 10.0, 30.0]), 10.0, rng.choice([None, 18.0, 20.0, 40.0]), rng.randrange(4), 5.0, 50.0, rng.choice([None, "TWO_FOR_ONE", "BASKET_PERCENTAGE"])) for k in range(40) for w in "12"]
    values = [("A", f"s{k}", "1", rng.choice([5.0, 20.0])) for k in range(0, 40, 3)]
    pools = [("A", p, f"N{k}") for p, of in (("x", range(0, 20, 3)), ("y", range(10, 30)), ("empty", [])) for k in of] + [("A", "x", "")]
    links = [("A", f"s{k}", None, "seed", rng.choice(["x", "y", "empty"])) for k in range(30)] + [("A", f"s{k}", f"N{k}", "seed", None) for k in range(0, 40, 4)] + [("A", f"s{k}", "", rng.choice(["manual_rejected", "auto"]), None) for k in range(0, 40, 5)]
    pairs = [(c, s, n, source) for c, s, n, source, pool in links if pool is None] + [(c, s, n, source) for c, s, _, source, pool in links for _, p, n in pools if p == pool and n]
    make = spark.createDataFrame
    given = make(stores, STORE), make(index, INDEX), make(values, "city_code string, store_name string, week_num string, order_value double")
    want = parity.store_verdicts(given[0], make(pairs, "city_code string, store_name string, comp_name string, source string"), given[1], given[2])
    links, pools = make(links, "city_code string, store_name string, comp_name string, source string, pool string"), make(pools, "city_code string, pool string, comp_name string")
    assert rows(parity.store_verdicts(given[0], links, given[1], given[2], pools)) == rows(want)
    # a store meets a promotion of its pool once, however many names have it
    assert parity.shared_branches(links, pools, given[1]).groupBy("store_name", "pool").count().where("count > 6").count() == 0


def test_products_from_pools(spark, monkeypatch):
    monkeypatch.setattr(products, "CELL", 3)
    rng = random.Random(52)
    words = "pizza rossa bianca grande piccola zuppa".split()
    say = lambda: " ".join(rng.sample(words, rng.choice([1, 2, 2, 3])))
    comp = {("A", f"c{k}", say()): (rng.choice([None, 4.0, 5.0, 5.05]), "10% di sconto") for k in range(10) for _ in range(k // 2)}
    own = {("A", f"s{k}", say()): (rng.choice([0.0, 4.0, 4.1, 5.0]), 2.0, 20.0, rng.choice([0.0, 7.5])) for k in range(8) for _ in range(6)}
    pools = [("A", "x", f"c{k}") for k in range(8)] + [("A", "y", "c9"), ("A", "x", "")]
    links = [("A", f"s{k}", None, p) for k in range(6) for p in ("xy" if k % 2 else "x")] + [("A", f"s{k}", f"c{k}", None) for k in range(8)] + [("A", "s7", "", None)]
    make = spark.createDataFrame
    comp, own = make([k + v for k, v in comp.items()], "city_code string, comp_name string, comp_product string, comp_price double, promotion_type string"), make([k + v for k, v in own.items()], "city_code string, store_name string, own_product string, own_price double, own_rank double, own_pct double, weight double")
    pairs = [(c, s, n) for c, s, n, p in links if p is None] + [(c, s, n) for c, s, _, p in links for _, q, n in pools if p == q]
    links, pools = make(links, "city_code string, store_name string, comp_name string, pool string"), make(pools, "city_code string, pool string, comp_name string")
    want = products.best_products(products.anchored(make(pairs, "city_code string, store_name string, comp_name string"), comp, own))
    assert rows(products.best_of_pools(links, pools, comp, own).select(want.columns)) == rows(want)
    assert want.count() > 60 and want.where("match_type = 'review'").count()
    assert rows(products.product_verdicts(products.best_of_pools(links, pools, comp, own, whole=True))) == rows(products.product_verdicts(want))
    # a store's names meet a cell's once: there is no row for every two products
    plan = products.best_of_pools(links, pools, comp, own)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_fingerprint_of_blocks(spark, monkeypatch):
    rng = random.Random(53)
    monkeypatch.setattr(resolve, "WIDTH", 5)
    menu = lambda side, n: [(c, f"{side}{k}", rng.choice([f"p{i}" for i in range(12)] + [None])) for c in "AB" for k in range(n) for _ in range(rng.randrange(1, 12))]
    comp, own = menu("c", 15) + [("D", "alone", f"p{i}") for i in range(5)], menu("s", 20) + [("A", None, "p1")]
    want = set()
    of = lambda rows, c: {s: {n for d, t, n in rows if (d, t) == (c, s)} for d, s, _ in rows if d == c and s is not None}
    for c in "ABD":
        for name, a in of(comp, c).items():
            both = min(((-len((a & b) - {None}), s) for s, b in of(own, c).items()), default=(0, ""))
            if len(a) >= 4 and both[0]:
                want.add((c, name, both[1], -both[0], len(a)))
    make = lambda rows: spark.createDataFrame(rows, "city_code string, store_name string, n string")
    for block in (4, 2000):
        got = resolve.fingerprint(make(comp), make(own), block=block).collect()
        assert {(r["city_code"], r["comp"], r["own"], r["n_overlap"], r["products"]) for r in got} == want and len(got) == len(want)
    assert len(want) > 15


def test_order_values_round_as_in_sql(spark, tmp_path):
    make = spark.createDataFrame
    totals = [10050.0, 20250.0, 30150.0, 23450.0, 100550.0, 81450.0, 26750.0, 11150.0]
    make([(k, k, x, datetime.datetime(1996, 1, 1)) for k, x in enumerate(totals)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    make([(k, f"S{k}", 0) for k in range(len(totals))], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    make([(0, "N")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    con = duckdb.connect()
    for t in ("orders", "supplier", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(bridge.oracle("SELECT store_name, order_value FROM order_values")).fetchall()
    assert sorted(map(tuple, bridge.load(spark, str(tmp_path), "order_values").select("store_name", "order_value").collect())) == sorted(want)


PRODUCT = "city_code string, store_name string, week_num string, product_name string, avg_unit_price double, total_product_sold double, promo_non_prime string, type_of_promo_np string, percentage_off_np double, min_basket_size_np double"


def test_dominant_promotion_from_the_grouping_of_sums(spark):
    said = [("a", 5.0, 2.0, "Y", "FREE_DELIVERY"), ("b", None, 1.0, "Y", "BASKET_PERCENTAGE"), ("b", 9.0, 9.0, "N", "TWO_FOR_ONE"), ("c", 4.0, 1.0, "Y", "flat_product , FREE_DELIVERY"), ("d", 4.0, 1.0, "Y", "no kind")]
    tied = [("a", 3.0, 1.0, "Y", "FREE_DELIVERY"), ("b", 3.0, 1.0, "Y", " two_for_one,FREE_DELIVERY"), ("c", 1.0, 1.0, "Y", None)]
    rows = [("A", s, "1", *x, 10.0, 5.0) for s, of in (("said", said), ("tied", tied), ("none", [("a", 3.0, 1.0, "N", "FREE_DELIVERY")])) for x in of]
    products = spark.createDataFrame(rows, PRODUCT).withColumns({"promotion_prime": F.lit("N"), "type_of_promo_p": F.lit(""), "percentage_off_p": F.lit(0.0)})
    out = parity.store_aggregate(products)
    got = {r["store_name"]: (r["best_promo_type"], r["best_promo_rank"], r["promo_product_count"]) for r in out.collect()}
    # a kind whose revenue is not known covers none of it; before, it came first
    assert got == {"said": ("FREE_DELIVERY", 4.0, 4), "tied": ("TWO_FOR_ONE", 1.0, 3), "none": (None, 6.0, 0)}
    alone = {r["store_name"]: (r["best_promo_type"], r["best_promo_rank"]) for r in parity.dominant_promo(parity.promo_view(products)).collect()}
    assert alone == {"said": ("FREE_DELIVERY", 4.0), "tied": ("TWO_FOR_ONE", 1.0)}
    # a grouping by name carries no sums: it has nearly a row a product
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate(keys=" in line and "product_name" in line.split("functions=")[0] and "sum(" in line]


def test_both_views_from_one_pass(spark):
    rng = random.Random(54)
    kinds = ["TWO_FOR_ONE", "FREE_DELIVERY", "BASKET_PERCENTAGE", "PERCENTAGE_DISCOUNT , free_delivery", "no kind", "", None]
    products = [("A", f"s{rng.randrange(9)}", rng.choice(["1", "2", None]), rng.choice(["p", "q", "r", None]), rng.choice([1.0, 2.5, None]), 2.0, rng.choice(["Y", "N", None]), rng.choice(kinds), 10.0, 5.0, rng.choice(["Y", "N", None]), rng.choice(kinds), 20.0) for _ in range(150)]
    own = spark.createDataFrame(products, PRODUCT + ", promotion_prime string, type_of_promo_p string, percentage_off_p double")
    both = parity.both_aggregates(own)
    each = [parity.store_aggregate(own, view == "member").withColumn("view", F.lit(view)) for view in ("standard", "member")]
    assert rows(both) == rows(each[0].union(each[1]).select(both.columns)) and both.count() > 20
    # a verdict in each view, side by side
    empty = lambda of: spark.createDataFrame([], of)
    given = empty("city_code string, store_name string, comp_name string, source string"), empty(INDEX), empty("city_code string, store_name string, week_num string, order_value double")
    assert rows(parity.store_verdicts(both, *given).groupBy("view").count()) == rows(both.groupBy("view").count())
    # the queries of both views read each table of theirs as often as those of one
    scans = lambda query: catalogue.QUERIES[query](spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_")
    assert scans("parity_delta") == scans("prime_boost") == scans("store_parity_std") == 2


def test_strongest_kind_of_lists(spark):
    rng = random.Random(55)
    say = lambda: ",".join(rng.choice(["", " "]) + rng.choice([*promo.KIND_RANKS, "two_for_one", "XFLAT_PRODUCT", "FREE DELIVERY", ""]) + rng.choice(["", "  ", "\n"]) for _ in range(rng.randrange(1, 4)))
    said = [say() for _ in range(400)] + [None, "", "FREE_DELIVERY\n"]
    for kinds, got in spark.createDataFrame([(x,) for x in said], "x string").select("x", promo.strongest_kind(F.col("x"))).collect():
        known = [k for k in (x.strip(" ").upper() for x in (kinds or "").split(",")) if k in promo.KIND_RANKS]
        assert got == min(known, key=promo.KIND_RANKS.get, default=None), kinds
    # no function over arrays, which runs outside the compiled code
    assert "lambda" not in spark.range(1).select(promo.strongest_kind(F.lit("a").substr(F.col("id").cast("int"), F.lit(1))))._jdf.queryExecution().optimizedPlan().toString()


def test_weeks_are_compared_in_one_pass(spark):
    make = lambda *rows: spark.createDataFrame(rows, "week_num string, parity string")
    said = lambda df: [(r["level"], r["message"]) for r in publish.week_shift(df, "2", "1").collect()]
    was = [("1", "INFERIORITY"), ("1", "PARITY"), ("1", "PARITY"), ("1", "PARITY"), ("1", "UNMATCHED"), ("3", "INFERIORITY")]
    assert said(make(*was, ("2", "INFERIORITY"), ("2", "SUPERIORITY"))) == [("WARNING", "INFERIORITY 25.0% -> 50.0%")]
    assert said(make(*was, ("2", "PARITY"), ("2", "NOT_ON_COMP"))) == [("INFO", "SUP 0.0% | PAR 50.0% | INF 0.0%")]
    # a week without matched stores is told and no division by none of them; nothing is told against such a week
    assert said(make(*was, ("2", "UNMATCHED"))) == [("WARNING", "no matched store")]
    assert said(make(("1", "EXCLUSIVE_OWN"), ("2", "PARITY"))) == []
    # both weeks' verdicts are planned once
    plan = catalogue.QUERIES["qc_shift"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_") == 2


def test_other_managers_products_are_not_grouped(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = catalogue.QUERIES["city_rollup_filtered"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    at = lambda part: min(k for k, line in enumerate(lines) if part in line)
    # the choice of cities stands below the groupings, at every reading of the products
    assert at("Join LeftSemi") > at("min_by(struct(name_norm")
    assert sum("Join LeftSemi" in line for line in lines) == sum("Relation [l_" in line for line in lines) == 2


def test_worst_of_pools(spark):
    rng = random.Random(54)
    words = "pizza rossa bianca grande piccola zuppa".split()
    say = lambda: " ".join(rng.sample(words, rng.choice([1, 2, 2, 3])))
    texts = ["10% di sconto", "2 al prezzo di 1", "Consegna gratis", "Spendi almeno 10,00 \u20ac, risparmia 15%", ""]
    comp = [(c, f"c{k}", x, *y) for c in "AB" for k in range(40) for x, y in {say(): (rng.choice([None, 4.0, 5.0, 5.05]), rng.choice(texts), rng.choice([None, 3.0, 4.5])) for _ in range(rng.randrange(1, 6))}.items()]
    own = [(c, f"s{k}", x, *y) for c in "AB" for k in range(40) for x, y in {say(): (rng.choice([None, 0.0, 4.0, 4.1, 5.0]), rng.choice([1.0, 2.0, 2.0, 3.0, 6.0]), rng.choice([None, 0.0, 10.0, 20.0, 40.0]), rng.choice([None, 0.0, 7.5, 40.0])) for _ in range(rng.randrange(4, 25))}.items()]
    pools = [("A", p, f"c{k}") for p, of in (("x", range(25)), ("y", range(25, 40))) for k in of] + [("B", "x", f"c{k}") for k in range(0, 40, 9)] + [("A", "x", ""), ("B", "none", "nobody")]
    links = [(c, f"s{k}", None, p) for c in "AB" for k in range(30) for p in rng.choice(["x", "y", "xy"])] + [(c, f"s{k}", f"c{k}", None) for c in "AB" for k in range(40)] + [("A", "s39", "", None), ("B", "s38", None, "none")]
    make = spark.createDataFrame
    comp, own = make(comp, "city_code string, comp_name string, comp_product string, comp_price double, promotion_type string, comp_cut double"), make(own, "city_code string, store_name string, own_product string, own_price double, own_rank double, own_pct double, weight double")
    links, pools = make(links, "city_code string, store_name string, comp_name string, pool string"), make(pools, "city_code string, pool string, comp_name string")
    verdicts = own.select("city_code", "store_name").distinct().withColumns({"parity": F.lit("PARITY"), "best_promo_type": F.lit("")}).withColumn("parity", F.when(F.col("store_name") == "s7", "UNMATCHED").otherwise("PARITY"))
    found = products.product_verdicts(products.best_of_pools(links, pools, comp, own, whole=True))
    want = rows(products.override(verdicts, found))
    assert len({r["parity_product"] for r in found.collect()}) == 3 and found.count() > 40
    for block in (3, 2000):
        worst = products.worst_of_pools(links, pools, comp, own, block=block)
        assert rows(products.override(verdicts, worst)) == want
        assert worst.count() == found.select("city_code", "store_name").distinct().count()
    # a pair of menus is no row: a store is joined with its pool's size and not with its names
    plan = worst._jdf.queryExecution().optimizedPlan().toString()
    assert "near" not in plan and "Generate explode(best" not in plan
