"""Product matches and store verdicts from them, by hand-made menus."""

import duckdb

from promolens.operators import products

COMP = "city_code string, comp_name string, comp_product string, comp_price double, promotion_type string"
OWN = "city_code string, store_name string, own_product string, own_price double, own_rank double, own_pct double, weight double"


def menus(spark):
    mapping = spark.createDataFrame([("X", "S", "C"), ("X", "T", "")], "city_code string, store_name string, comp_name string")
    comp = [("X", "C", "Pizza Margherita", 8.0, "20% di sconto"), ("X", "C", "A1 - Pizza Diavola", 9.0, "2 al prezzo di 1"), ("X", "C", "Tiramisu grande", 5.0, "20% di sconto"), ("X", "C", "Zuppa", None, "")]
    own = [("X", "S", "Margherita Pizza", 8.1, 2.0, 30.0, 10.0), ("X", "S", "Pizza Diavola", 12.0, 2.0, 50.0, 10.0), ("X", "S", "Tiramisu grandi", 5.0, 2.0, 20.0, 30.0), ("X", "T", "Zuppa", 3.0, 6.0, 0.0, 1.0)]
    return mapping, spark.createDataFrame(comp, COMP), spark.createDataFrame(own, OWN)


def test_best_products(spark):
    best = {r["comp_product"]: r for r in products.best_products(products.anchored(*menus(spark))).collect()}
    assert len(best) == 4
    got = best["Pizza Margherita"]
    assert (got["own_product"], got["score"], got["gap_pct"], got["match_type"]) == ("Margherita Pizza", 100.0, -1.2, "auto")
    got = best["A1 - Pizza Diavola"]
    assert (got["own_product"], got["score"], got["gap_pct"], got["match_type"]) == ("Pizza Diavola", 100.0, -25.0, "auto")
    assert best["Tiramisu grande"]["match_type"] == "auto" and best["Zuppa"]["match_type"] == "unmatched"


def test_product_verdicts(spark):
    mapping, comp, own = menus(spark)
    best = products.best_products(products.anchored(mapping, comp, own))
    assert products.product_verdicts(best).count() == 0  # one product has no match
    row = products.product_verdicts(products.best_products(products.anchored(mapping, comp.where("comp_product <> 'Zuppa'"), own))).first()
    # won 10, lost 10, level 30 of 50: (10 + 15) / 50
    assert (row["n_products"], row["share"], row["parity_product"]) == (3, 0.5, "PARITY")


def test_override(spark):
    verdicts = spark.createDataFrame([("X", "S", "SUPERIORITY", "TWO_FOR_ONE"), ("X", "B", "SUPERIORITY", "BASKET_PERCENTAGE"), ("X", "U", "UNMATCHED", None), ("X", "N", "PARITY", None)], "city_code string, store_name string, parity string, best_promo_type string")
    found = spark.createDataFrame([("X", s, p) for s in "SBU" for p in ("PARITY", "INFERIORITY")], "city_code string, store_name string, parity_product string")
    got = {r["store_name"]: r["parity"] for r in products.override(verdicts, found).collect()}
    assert got == {"S": "INFERIORITY", "B": "SUPERIORITY", "U": "UNMATCHED", "N": "PARITY"}


def test_halves_go_as_in_sql(spark):
    # amounts that print as halves and lie beside them, and exact halves
    halves = [1.005, 0.125, 2.675, 1.115, 8.345, 100.685, 4.0]
    met = spark.createDataFrame([("X", "S", "C", f"Pizza {k}", 3.0, "", f"Pizza {k}", x, 2.0, 10.0, x) for k, x in enumerate(halves)], "city_code string, store_name string, comp_name string, comp_product string, comp_price double, promotion_type string, own_product string, own_price double, own_rank double, own_pct double, weight double")
    got = {r["comp_product"]: (r["own_revenue"], r["gap_pct"]) for r in products.best_products(met).collect()}
    want = duckdb.sql(f"SELECT round(x, 2), round((3.0::DOUBLE - x) / x * 100, 1) FROM (SELECT unnest({halves}::DOUBLE[]) AS x)").fetchall()
    assert [got[f"Pizza {k}"] for k in range(len(halves))] == want
