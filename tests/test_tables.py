"""File tables, published copies, reports and older rules, on rows made by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.functions import promo, text
from promolens.operators import likeness, discovery, legacy, parity, publish, state, views
from promolens.sources import geo, payload, tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_text_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("City Code,Name\nA,Caff\u00e8\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("\ufeffCity Code,Name\nA,Caff\u00e8\n".encode())
    for name in "ab":
        assert rows(tables.read_text_table(spark, str(tmp_path / f"{name}.csv")), "city_code", "name") == [("A", "Caff\u00e8")]
    schema = T.StructType([T.StructField("city_code", T.StringType()), T.StructField("n", T.DoubleType())])
    assert tables.read_or_empty(spark, str(tmp_path / "none.csv"), schema).schema == schema
    assert rows(tables.read_or_empty(spark, str(tmp_path / "b.csv"), schema), "city_code", "n") == [("A", None)]
    (tmp_path / "c.csv").write_text("x,y,z\n1\n1,2\n1,2,3\n")
    assert rows(tables.read_ragged(spark, str(tmp_path / "c.csv"), 3), "x", "y", "z") == [("1", "", ""), ("1", "2", ""), ("1", "2", "3")]
    (tmp_path / "d.csv").write_text("x,y,z\n")
    with pytest.raises(ValueError):
        tables.read_ragged(spark, str(tmp_path / "d.csv"), 3)


def test_managers_and_order_values(spark):
    m = spark.createDataFrame([("A", "S", "x", "r", 2), ("A", "S", "y", "r", 1), ("", "T", "z", "r", 3)], "city_code string, store_name string, manager string, region string, seq int")
    assert rows(tables.managers(m), "store_name", "manager") == [("S", "y")]
    v = [("A", "S", "10,5", "7", 1), ("A", "S", "11.5", "7", 2), ("A", "T", "9", "6", 3), ("A", "U", "bad", "7", 4)]
    v = spark.createDataFrame(v, "city_code string, store_name string, aov string, week_src string, seq int")
    assert rows(tables.order_values(v, 7), "store_name", "aov") == [("S", 11.5)]
    assert rows(tables.order_values(v, 8), "store_name", "aov") == [("S", 11.5), ("T", 9.0)]
    assert rows(tables.not_done(m, m.where("manager = 'x'"), ["manager"]), "manager") == [("y",), ("z",)]
    assert tables.pick_and_rename(m, {"manager": "am", "missing": "x"}).columns == ["am"]


def test_polygons(spark, tmp_path):
    (tmp_path / "p.csv").write_text('code,wkt\na,"POLYGON ((9 45, 9.1 45, 9.1 45.1, 9 45.1, 9 45))"\nb,broken\nc,"POLYGON ((9 45, 9.001 45, 9.001 45.001, 9 45.001, 9 45))"\n')
    got = geo.grid(geo.read_polygons(spark, str(tmp_path / "p.csv")), 3.0).collect()
    assert {r["code"] for r in got} == {"A", "C"} and len(got) == len({(r["code"], r["geohash"]) for r in got})
    south = sorted(r["lon"] for r in got if r["code"] == "A" and r["lat"] == 45.0)
    assert len(south) == 3 and abs(south[1] - south[0] - 3.0 / (111.32 * 0.7071067811865476)) < 1e-9
    assert geo.read_polygons(spark, str(tmp_path / "p.csv"), ["C"]).count() == 1
    with pytest.raises(ValueError):
        geo.read_polygons(spark, str(tmp_path / "p.csv"), ["Z"])


def test_publishing(spark, tmp_path):
    schema = "city_code string, store_name string, week_num string, seq int, parity string"
    one = spark.createDataFrame([("A", "S", f"2026-W{k:02d}", k, "PARITY") for k in range(1, 10)], schema)
    status = publish.publish(spark, {"store_parity": one, "unknown": one}, str(tmp_path))
    assert rows(status, "name", "rows") == [("store_parity", 8), ("unknown", -1)]
    two = spark.createDataFrame([("A", "S", "2026-W09", 20, "INFERIORITY"), ("A", "T", "2026-W10", 21, "PARITY")], schema)
    publish.publish(spark, {"store_parity": two}, str(tmp_path))
    out = publish.read_published(spark, str(tmp_path), "store_parity")
    assert out.count() == 8 and rows(out.where("week_num >= '2026-W09'"), "store_name", "parity") == [("S", "INFERIORITY"), ("T", "PARITY")]
    assert publish.repair(spark, status, lambda name: one, str(tmp_path)).count() == 1
    assert rows(publish.integrity_report(status, spark.createDataFrame([("store_parity", 9), ("unknown", 1)], "name string, expected long")), "level") == [("ERROR",), ("WARNING",)]
    publish.append_rows(one.limit(1), str(tmp_path / "log"))
    publish.append_rows(one.limit(2), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3
    assert publish.rebuild(one.drop("parity"), one, ["2026-W01"]).select("parity", "seq").first().asDict() == {"parity": None, "seq": 1}


def test_reports(spark):
    v = lambda week, **n: spark.createDataFrame([("A", week, p) for p, k in n.items() for _ in range(k)], "city_code string, week_num string, parity string")
    before, now = v("1", PARITY=80, INFERIORITY=20), v("2", PARITY=60, INFERIORITY=19, UNMATCHED=3)
    assert rows(publish.count_report(now, before), "level", "message") == [("INFO", "stable")]
    assert rows(publish.count_report(now.limit(79), before), "level", "city_code") == [("WARNING", "A")]
    assert rows(publish.shift_report(now, before), "level") == [("INFO",)]
    assert rows(publish.shift_report(v("2", PARITY=60, INFERIORITY=40), before), "level") == [("WARNING",)]
    none = publish.report("2", publish.shift_report(now, before).where("false"))
    assert rows(none, "level", "check", "week_num") == [("INFO", "all", "2")]
    old = spark.createDataFrame([("2026-01-01 00:00:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    for day, level in (("2026-01-09 12:00:00", "INFO"), ("2026-01-10 00:00:00", "WARNING")):
        assert rows(publish.freshness_report(old, "t", F.to_timestamp(F.lit(day))), "level") == [(level,)]
    assert rows(publish.freshness_report(old.where("false"), "t", F.lit(None).cast("timestamp")), "level") == [("ERROR",)]
    actions = spark.createDataFrame([("A", f"S{k}", 10.0 * k, k) for k in range(1, 9)], "city_code string, store_name string, revenue double, priority int")
    assert publish.summary(none, actions).count() == 6


def test_widespread_promotions_first(spark):
    listed = lambda *p: spark.createDataFrame([("A", "caffe", "Caff\u00e8", t, k, s) for k, (t, s) in enumerate(p)], "city_code string, name_norm string, restaurant_name string, promotion_type string, first_seq int, stores_pct double")
    best = lambda *p: parity.competitor_index(listed(*p)).first()["promotion_type"]
    assert best(("40% di sconto", 33.0), ("20% di sconto", 67.0)) == "20% di sconto"
    assert best(("40% di sconto", 33.0), ("20% di sconto", 33.0)) == "40% di sconto"
    assert best(("tutto il menu", 60.0), ("20% di sconto", 10.0)) == "tutto il menu"  # of rank 6, but at half of the branches


def test_listing_folds_and_caps(spark):
    raw = [("a", "Caff\u00e8 Uno", "20% di sconto", "https://x/a?day=1", 1), ("A", "Caffe  Uno", "20% di sconto", "https://x/a?day=2", 2), ("A", "Caffe Uno", "20% di sconto", "https://x/b", 3), ("A", "Caffe Uno", "20% di sconto", "", 4), ("", "X", "p", "u", 5)]
    raw = spark.createDataFrame(raw, "city_code string, restaurant_name string, promotion_type string, source_url string, seq int")
    index = spark.createDataFrame([("A", "caffe uno", str(k)) for k in range(6)], "city_code string, name_norm string, store_id string")
    got = parity.listing(raw, index).collect()
    assert [(r["restaurant_name"], r["n_stores_with_promo"], r["n_stores_total"], r["stores_pct"]) for r in got] == [("Caff\u00e8 Uno", 3, 6, 50.0)]
    assert [(r["n_stores_with_promo"], r["stores_pct"]) for r in parity.listing(raw, index.limit(2)).collect()] == [(2, 100.0)]


def test_decision_log(spark):
    log = [("A", "1", 1, "X", ""), ("A", "1", 2, "Y", ""), ("A", "1", 3, "", "manual_rejected"), ("A", "1", 4, "Z", ""), ("A", "1", 5, "Z", ""), ("A", "2", 1, "X", ""), ("A", "2", 2, "", "Manual_not_comp"), ("B", "2", 1, "X", ""), ("A", "3", 1, "", "x")]
    log = spark.createDataFrame(log, "city_code string, store_name string, seq int, name string, source string")
    folded = state.fold_log(log, ["city_code", "store_name"])
    assert rows(folded, "city_code", "store_name", "name", "status") == [("A", "1", "Z", "manual_confirmed"), ("A", "2", "", "not_on_comp"), ("A", "3", "", "manual_rejected"), ("B", "2", "X", "manual_confirmed")]
    mapping = spark.createDataFrame([("A", "1", "old", "seed"), ("A", "2", "", "manual_rejected"), ("C", "9", "kept", "seed")], "city_code string, store_name string, comp_name string, source string")
    assert rows(state.merge_log(mapping, folded.where("city_code = 'A'")), "store_name", "comp_name", "source") == [("1", "Z", "manual_confirmed"), ("2", "", "manual_rejected"), ("3", "", "manual_rejected"), ("9", "kept", "seed")]


def test_labels_and_badges(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first()["v"]
    assert [value(promo.rank_label(F.lit(r))) for r in (2.0, 2.5, 6.0, 7.5)] == ["% off prodotto", "Flat prodotto", "Nessuna promo", "Rank 7.5"]
    assert value(promo.true_label(F.lit("BASKET_PERCENTAGE"), F.lit("% off prodotto"))) == "Basket %" and value(promo.true_label(F.lit(None).cast("string"), F.lit("x"))) == "x"
    assert value(payload.badge(F.array(F.lit("Consegna gratis"), F.lit("tutto il men\u00f9"), F.lit("25 min")))) == "tutto il men\u00f9"
    assert value(payload.badge(F.array(F.lit("25 min")))) == ""
    assert value(payload.blocked(F.lit("<html>Just a MOMENT</html>"))) and not value(payload.blocked(F.lit("captcha")))
    assert value(payload.offer_text(F.lit("FullMenuPercentOffOffer"), F.lit("0,00 \u20ac"), F.lit(12.5))) == "12.5% di sconto sull'ordine"
    assert value(payload.offer_text(F.lit("Unheard"), F.lit(""), F.lit(None).cast("double"))) == "Unheard"
    labels = [(None, True, 5.0, "BOTH_PROMO"), (20.0, False, 50.0, "OWN_NO_PROMO"), (20.0, True, 19.5, "OWN_AT_LEAST"), (20.0, True, 19.4, "COMP_STRONGER")]
    for c, on, o, want in labels:
        assert value(promo.product_label(F.lit(c).cast("double"), F.lit(on), F.lit(o))) == want
    assert value(text.name_from_url(F.lit("https://x.y/it/menu/milano/pizza-da-ugo%20due?day=1"))) == "Pizza Da Ugo Due" and value(text.name_from_url(F.lit("https://x.y"))) == ""
    assert value(text.clean_text(F.lit("\u00a0| a\u200e  b |"))) == "a b" and value(text.week_number(F.lit("2026-W07"))) == 7


def test_older_rules(spark):
    one = spark.range(1)
    lines = ["nuovo men\u00f9 2x1", "Pizzeria Da Ugo", "4,5", "25 min", "Spendi almeno 10", "2x1"]
    got = one.select(legacy.infer_name(F.array(*map(F.lit, lines)), F.lit("")).alias("n"), legacy.infer_promotion(F.array(*map(F.lit, lines))).alias("p")).first()
    assert got["n"] == "Pizzeria Da Ugo" and got["p"] == "nuovo men\u00f9 2x1 | Spendi almeno 10 | 2x1"
    assert one.select(legacy.infer_name(F.array(F.lit("25 min")), F.lit("https://x/it/menu/da-ugo")).alias("n")).first()["n"] == "Da Ugo"
    ratios = [("fuzzy was a bear", "fuzzy fuzzy was a bear", 100.0), ("red gear", "blue lamp", 400 / 17), ("", "", 0.0), ("Fuzzy", "fuzzy", 80.0)]
    for a, b, want in ratios:
        assert abs(likeness.WordSet(a).score(likeness.WordSet(b)) - want) < 0.01
    names = spark.createDataFrame([("A", "Antica Focacceria Rossi"), ("A", "Nuova Trattoria"), ("A", "Gelato Blu"), ("A", " | "), ("A", "Verdi Club")], "city_code string, a string")
    choices = [("A", "Focacceria Rossi"), ("A", "Gelato Blu uno"), ("A", "Gelato Blu due"), ("B", "Nuova Trattoria"), ("A", "Verdi Club"), ("A", "Verdi Club")]
    choices = spark.createDataFrame([(c, b, k) for k, (c, b) in enumerate(choices)], "city_code string, b string, place long")
    # two gelato shops are alike and share the same words, so the first one stands; a repeated choice is its own runner-up
    assert rows(legacy.match(names, choices), "a", "b") == [("Antica Focacceria Rossi", "Focacceria Rossi"), ("Gelato Blu", "Gelato Blu uno"), ("Verdi Club", "Verdi Club")]
    lower = choices.withColumn("b", F.lower("b"))  # capitals count: Rossi and rossi are other words
    assert [r[0] for r in rows(legacy.match(names, lower), "a", "b")] == ["Verdi Club"]
    head = lambda lines, href="https://x/it/menu/da-ugo": one.select(legacy.infer_name(F.array(*map(F.lit, lines)), F.lit(href)).alias("n")).first()["n"]
    assert head(["Nuovo", "Pizzeria Da Ugo", "4,5"]) == "Pizzeria Da Ugo" and head(["'buono'", "4,5", "Da Elena"]) == "Da Elena"
    assert head(["Tracking ordine", "Da Elena", "4,5"]) == "Da Ugo" and head(["Preordina per domani", "4,5"]) == "Da Ugo" and head(["Tracking ordine"], "") == "Tracking ordine"
    kinds = {"Nuovo": "editorial", "Solo su Deliveroo": "editorial", "'x'": "editorial", "Oggi chiuso": "preorder", "12": "metric", "2x1": "promotion", " ": "blank", "Tracking Ordine": "placeholder", "Da Ugo": "name", "consegna rapida": "metric"}
    assert {x: one.select(legacy.line_class(F.lit(x)).alias("k")).first()["k"] for x in kinds} == kinds
    old = spark.createDataFrame([("A", "Da Ugo", "2x1 | 20% di sconto", "u1", 1), ("A", "Da Ugo", "consegna gratis", "u2", 2)], "city_code string, restaurant_name string, promotion_type string, source_url string, seq int")
    new = spark.createDataFrame([("A", "DA UGO", "30% di sconto | 2x1", "u3", 3)], old.schema)
    assert rows(legacy.upsert_listing(old, new), "promotions", "source_url") == [("2x1 | 20% di sconto | 30% di sconto", "u3")]


def test_discovery(spark):
    comp = [("A", "C", f"dish {k}", f"dish {k}", 10.0 + k) for k in range(4)] + [("A", "D", "x", "x", 1.0)]
    own = [("A", "S", "dish 0", 10.0), ("A", "S", "dish 1", 20.0), ("A", "S", "dishes 2", 12.1), ("A", "T", "dish 3", 99.0), ("B", "S", "dish 3", 13.0)]
    comp = spark.createDataFrame(comp, "city_code string, comp string, product string, n string, price double")
    own = spark.createDataFrame(own, "city_code string, store_name string, n string, price double")
    mapping = spark.createDataFrame([("A", "Z", "D", "seed")], "city_code string, store_name string, comp_name string, source string")
    found = discovery.discover(comp, own, mapping)
    # the name alone for one dish, name and price for one, a near price with a likely name for one
    assert rows(found, "comp", "store_name", "n_overlap", "n_confirmed", "ratio", "confidence") == [("C", "S", 3, 2, 0.75, "alta")]
    assert discovery.auto_merge(found, mapping).count() == 1
    named = found.withColumn("store_name", F.lit("Caff\u00e8 C.I.A.O.")).withColumn("comp", F.lit("ciao"))
    assert rows(discovery.auto_merge(named, mapping), "comp_name", "source") == [("D", "seed"), ("ciao", "auto_fingerprint")]


def test_views(spark):
    v = spark.createDataFrame([("A", "S", "1", "s", 2.0, 2.0, "PARITY", 5.0, 1.0, "PERCENTAGE_DISCOUNT"), ("A", "", "1", None, 6.0, 6.0, "UNMATCHED", 9.0, 0.0, None)], "city_code string, store_name string, week_num string, name_norm string, own_rank double, comp_rank double, parity string, revenue double, promo_coverage_pct double, best_promo_type string")
    counts = views.comp_counts(spark.createDataFrame([("A", "S", "1", "p"), ("A", "S", "1", "p"), ("A", " ", "1", "q")], "city_code string, restaurant_name string, week_num string, product_name string"))
    assert rows(views.store_detail(v, counts), "parity", "own_label", "comp_products") == [("PARITY", "% off prodotto", 1), ("UNMATCHED", "Nessuna promo", 0)]
    assert views.store_detail(v, counts, verdict=("PARITY",), search="^s$").count() == 1
    assert rows(views.display(v), "money", "coverage") == [("5 \u20ac", "1.0%"), ("9 \u20ac", "0.0%")]
