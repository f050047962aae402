"""The detail table's formatters, both sides' products, and its export."""

import glob

from pyspark.sql import functions as F

from promolens.operators import detail


def shown(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def test_formatters(spark):
    c = F.col
    assert shown(spark, "x double", [(1234567.4,), (0.0,), (None,)], detail.euros(c("x")), detail.euros(c("x"), 2)) == [("1.234.567€", "1.234.567,40€"), ("0€", "0,00€"), ("", "")]
    assert shown(spark, "p double, l string, b double", [(12.5, "Basket %", 15.0), (12.5, "2x1", 15.0), (20.0, "Basket %", None), (None, "Basket %", 3.0)], detail.own_percent(c("p"), c("l"), c("b"))) == [("12.5% min €15",), ("12.5%",), ("20.0%",), ("",)]
    assert shown(spark, "n long, l string", [(3, "2x1"), (3, "Basket %"), (None, "2x1")], detail.own_items(c("n"), c("l"))) == [("3",), ("Full menu",), ("0",)]
    assert shown(spark, "n long, l string, t string", [(2, "Basket %", ""), (0, "Basket %", ""), (0, "x", "Sconto sull'ORDINE"), (0, "x", None)], detail.comp_items(c("n"), c("l"), c("t"))) == [("2",), ("Full menu",), ("Full menu",), ("",)]
    assert shown(spark, "p double, a long, b long", [(33.0, 2, 6), (50.0, None, 6), (0.0, 1, 2), (None, 1, 2)], detail.branches(c("p"), c("a"), c("b"))) == [("33% (2/6)",), ("50%",), ("",), ("",)]
    assert shown(spark, "t string", [("-20% su tutto",), ("12,5 % e 30%",), ("2x1",), (None,)], detail.first_percent(c("t"))) == [("20%",), ("12,5%",), ("",), ("",)]
    kinds = [("Y", "BASKET_PERCENTAGE", 15.0, 20.0, "BASKET_PERCENTAGE (15%) min €20"), ("Y", "TWO_FOR_ONE", 0.0, 20.0, "TWO_FOR_ONE"), ("Y", None, 10.0, None, "Promo (10%)"), ("N", "TWO_FOR_ONE", 5.0, None, "—"), (None, "x", 1.0, 1.0, "—")]
    assert shown(spark, "f string, k string, p double, b double, want string", kinds, detail.own_badge(c("f"), c("k"), c("p"), c("b")), "want") == [(w[-1], w[-1]) for w in kinds]
    members = [("y", "X", 10.0, "Y", "Z", 5.0, "X (10%)"), ("N", "X", 10.0, "Y", "Z", 0.0, "Z [np]"), ("Y", "", 0.0, "Y", "Z", 5.0, "Prime"), ("N", "X", 1.0, "N", "Z", 5.0, "—")]
    assert shown(spark, "a string, b string, c double, d string, e string, f double, want string", members, detail.member_badge(*map(c, "abcdef")), "want") == [(w[-1], w[-1]) for w in members]


def test_sides_of_a_store(spark):
    own = spark.createDataFrame([("A", s, "1", p, f, x, k, "b") for s in ("s", "t", "u") for k, (p, f, x) in enumerate([("soup", "N", 9.0), ("cake", "Y", 1.0), ("ham", "Y", 5.0)])], "city_code string, store_name string, week_num string, product_name string, flag string, price double, seq int, badge string")
    comp = spark.createDataFrame([("A", "c", "1", "pie", 3.0, "2x1", 1), ("A", "c", "1", "pie", 4.0, "20%", 2), ("A", "c", "1", "tea", 2.0, " 20% ", 3), ("A", "d", "1", "nut", 2.0, "10%", 4), ("A", "x", "1", "fig", 2.0, "10%", 5)], "city_code string, name_norm string, week_num string, product_name string, price double, promotion_type string, seq int")
    v = spark.createDataFrame([("A", "s", "1", "c", "PARITY", "20%"), ("A", "t", "1", "d", "UNMATCHED", None), ("A", "u", "1", "d", "PARITY", "no such"), ("A", "x", "1", "x", "NOT_ON_OWN", "10%")], "city_code string, store_name string, week_num string, name_norm string, parity string, promotion string")
    got = sorted((r["store_name"], r["side"], r["place"], r["product_name"]) for r in detail.sides(own, comp, v).collect())
    mine = lambda s: [(s, "own", 1, "ham"), (s, "own", 2, "cake"), (s, "own", 3, "soup")]
    # the first of a name stands, the compared promotion alone where there is any, and nothing where nothing is compared
    assert got == sorted([*mine("s"), *mine("t"), *mine("u"), ("s", "other", 1, "tea"), ("u", "other", 1, "nut"), ("x", "other", 1, "fig")])


def test_export_opens_with_accents(spark, tmp_path):
    df = spark.createDataFrame([("Caffè, \"Ugo\"", None, 1.5), ("b", "", 2.0)], "name string, other string, n double")
    detail.export_csv(df, str(tmp_path / "out"), 1)
    (file,) = glob.glob(f"{tmp_path}/out/*.csv")
    raw = open(file, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfname,other,n\n") and 'Caffè' in raw.decode("utf-8-sig")
    back = spark.read.csv(str(tmp_path / "out"), header=True, escape="\\")
    assert back.count() == 2 and sorted(r[0] for r in back.collect())[0] == 'Caffè, "Ugo"'


def test_weeks_from_times(spark):
    rows = spark.sql("select timestamp'2024-12-30 10:00:00' as scraped_at, 'a' as product_name")
    assert detail.with_week(rows).first()["week_num"] == "2025-W01"
    assert detail.with_week(rows.selectExpr("*", "'w' as week_num")).first()["week_num"] == "w"
