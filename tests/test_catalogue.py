"""Every query with an oracle against DuckDB, and goldens of the scalar rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators import likeness
from promolens.plans import catalogue, dashboard, details, products, streams  # noqa: F401
from promolens.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    return v if v is None else round(float(v), 6) if isinstance(v, (int, float)) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_against_duckdb(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert sorted(([norm(r[c]) for c in cols] for r in df.collect()), key=str) == sorted(([norm(r[i]) for i in at] for r in rel.fetchall()), key=str)


def one(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def test_promo_texts(spark):
    want = [("2 al prezzo di 1", 1.0, 0.0, 0.0), ("Spendi almeno 10,00 €, risparmia 15%", 3.0, 15.0, 10.0), ("20% di sconto sull'ordine", 2.0, 20.0, 0.0), ("Spendi 15,00 € per -20% su articoli selezionati", 3.0, 20.0, 15.0),
            ("Consegna a 1,90 €", 5.0, 0.0, 0.0), ("prezzo speciale", 2.5, 0.0, 0.0), ("Spendi almeno 20 € | -20% su prodotti selezionati", 2.0, 20.0, 20.0), ("-40% su tutto il menu", 6.0, 40.0, 0.0), ("nan", 6.0, 0.0, 0.0),
            ("", 6.0, 0.0, 0.0), (None, 6.0, 0.0, 0.0), ("2,50 € di sconto", 2.5, 0.0, 0.0)]
    c = F.col("t")
    assert one(spark, [(w[0],) for w in want], "t string", c, promo.rank_of_text(c), promo.percent_of_text(c), promo.basket_of_text(c)) == want


def test_verdicts(spark):
    want = [(1, 2, 0, 0, 0, 0, 0, "", "", "SUPERIORITY"), (1, 2, 0, 0, 0, 0, 0, "selected", "full", "PARITY"), (6, 4, 0, 0, 0, 0, 0, "", "", "INFERIORITY"), (2, 2, 30, 28, 0, 0, 0, "", "", "SUPERIORITY"), (2, 2, 29, 28, 1, 0, 0, "", "", "PARITY"),
            (2, 2, 29, 28, 2, 0, 0, "", "", "SUPERIORITY"), (2, 2, 28, 30, 9, 0, 0, "", "", "INFERIORITY"), (2, 2, 30, 30, 0, 0, 0, "full", "selected", "SUPERIORITY"), (2, 2, 0, 30, 9, 0, 0, "", "", "PARITY"), (3, 3, 20, 15, 0, 20, 10, "", "", "SUPERIORITY"),
            (3, 3, 15, 15, 0, 10, 15, "", "", "SUPERIORITY"), (3, 3, 15, 15, 0, 15, 10, "", "", "INFERIORITY"), (3, 3, 20, 15, 0, 30, 10, "", "", "PARITY"), (3, 3, 10, 20, 0, 30, 10, "", "", "INFERIORITY"), (3, 3, 20, 15, 0, 10, 30, "", "", "SUPERIORITY")]
    rows = [(float(a), float(b), float(c), float(d), e, float(f), float(g), h, i) for a, b, c, d, e, f, g, h, i, _ in want]
    got = one(spark, rows, "g double, d double, gp double, dp double, n int, gb double, db double, gs string, ds string", promo.verdict(*map(F.col, ("g", "d", "gp", "dp", "n", "gb", "db", "gs", "ds"))))
    assert [g[0] for g in got] == [w[-1] for w in want]


def test_names_and_prices(spark):
    c = F.col("t")
    names = [("AKC - Pizzeria da Michele®", "michele", "akc pizzeria da michele"), ("L'Antica Caffè", "l antica", "l antica caffe"), ("Il Bar", "", "il bar"), (None, "", "")]
    assert one(spark, [(n[0],) for n in names], "t string", c, text.store_name(c), text.fold(c)) == names
    prices = [("1.234,56 €", 1234.56), ("20,53", 20.53), ("12.50", 12.5), ("1.234", 1.234), ("gratis", None), ("1.2.3", None), ("", None)]
    assert one(spark, [(p[0],) for p in prices], "t string", c, text.price(c)) == prices
    ratios = [("fra diavolo", "fradiavolo", 66.67), ("kebabam plana", "kebabam", 70.0), ("new york pizza", "pizza new york", 100.0), ("", "", 100.0)]
    pairs = spark.createDataFrame([r[:2] for r in ratios], "a string, b string").select(text.token_sort(F.col("a")).alias("a"), text.token_sort(F.col("b")).alias("b"))
    assert [round(r["score"], 2) for r in likeness.scored(pairs).collect()] == [r[2] for r in ratios]
    assert one(spark, [(45.4642, 9.19)], "a double, b double", text.geohash(F.col("a"), F.col("b"), 7), text.geohash(F.lit(57.64911), F.lit(10.40744), 11)) == [("u0nd9he", "u4pruydqqvj")]


def test_product_file_and_sink(spark, tmp_path):
    (tmp_path / "p.csv").write_text("﻿City Code,Store Name,week_num,product_name,avg_product_unit_price,total_product_sold,promo_non_prime,type_of_promo_np\nA,S,2026-W01,x,bad,2, y ,two_for_one\n")
    row = tables.read_products(spark, str(tmp_path / "p.csv")).first()
    assert (row["city_code"], row["avg_unit_price"], row["total_product_sold"], row["promo_non_prime"], row["type_of_promo_np"]) == ("A", 0.0, 2.0, "Y", "TWO_FOR_ONE")
    with pytest.raises(ValueError):
        tables.write_verified(spark.range(5), str(tmp_path / "out"), least=100)
    assert tables.write_verified(spark.range(5), str(tmp_path / "out")) == 5
