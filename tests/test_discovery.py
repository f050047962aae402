"""Discovery in blocks: the same stores as from all pairs of products, and no row for any pair."""

import random

import pytest
from pyspark.sql import functions as F

from promolens.operators import discovery, likeness
from promolens.plans import bridge, catalogue, details  # noqa: F401  (details joins the catalogue)
from promolens.plans.registry import Tables

COMP = "city_code string, comp string, product string, n string, price double"
OWN = "city_code string, store_name string, n string, price double"


def brute(comp, own):
    """By all pairs of products."""
    near = lambda a, b: a not in (None, 0.0) and b not in (None, 0.0) and abs(a - b) / max(a, b) <= 0.05
    score = lambda n, m: likeness.Sorted(" ".join(sorted(n.split()))).score(likeness.Sorted(" ".join(sorted(m.split()))))
    out = {}
    for city, name in {r[:2] for r in comp}:
        menu = [r[2:] for r in comp if r[:2] == (city, name)]
        best = []
        for store in {r[1] for r in own if r[0] == city}:
            mine, hits, sure = [r[2:] for r in own if r[:2] == (city, store)], 0, 0
            for _, n, price in menu:
                same = [q for m, q in mine if m == n]
                ok = any(near(price, q) for q in same) if same else any(near(price, q) and abs(round(price) - round(q)) <= 1 and score(n, m) >= 80 for m, q in mine)
                hits, sure = hits + bool(same or ok), sure + ok
            if hits:
                best.append((-sure, -hits, store is None, store or ""))
        if len(menu) >= 4 and best:
            sure, hits, none, store = min(best)
            share = round(-hits / len(menu), 2)
            confidence = "alta" if -sure >= 3 or share >= 0.5 else "media" if -hits >= 4 and share >= 0.3 else None
            if confidence:
                out[city, name] = (None if none else store, -hits, -sure, len(menu), confidence)
    return out


@pytest.mark.parametrize("block", [7, 60, 100_000])
def test_blocks_find_what_all_pairs_find(spark, block, monkeypatch):
    monkeypatch.setattr(discovery, "BLOCK", block)
    rng = random.Random(71)
    names = ["red gear", "gear red", "red gears", "blue lamp", "blue lamps", "old ring", "x", "", "a" * 70, "a" * 69 + "b"]
    prices = [None, 0.0, 0.5, 1.5, 2.5, 4.0, 4.1, 9.8, 10.0, 10.5, 200.0, 204.0]
    comp = [(c, f"c{k}", f"p{i}", rng.choice(names), rng.choice(prices)) for c in "AB" for k in range(25) for i in range(rng.randrange(2, 9))] + [("D", "alone", f"p{i}", "x", 1.0) for i in range(5)]
    own = [(c, f"s{k}", rng.choice(names), rng.choice(prices)) for c in "AB" for k in range(20) for _ in range(rng.randrange(1, 6))] + [("A", None, "x", 1.5), ("C", "s", "x", 1.5)]
    own += own[:30]  # a product that is there twice is one
    mapping = spark.createDataFrame([("A", "c3"), ("B", "")], "city_code string, comp_name string")
    got = discovery.discover(spark.createDataFrame(comp, COMP), spark.createDataFrame(own, OWN), mapping).collect()
    want = brute([r for r in comp if r[:2] != ("A", "c3")], own)
    assert len(want) > 25
    assert {(r["city_code"], r["comp"]): (r["store_name"], r["n_overlap"], r["n_confirmed"], r["products"], r["confidence"]) for r in got} == want and len(got) == len(want)


def test_pairs_stay_inside_tasks(spark):
    # one dish that all sell: 300 competitors of four products, 300 stores; a pair of any would be 90,000 rows
    comp = spark.range(1200).select(F.lit("A").alias("city_code"), F.concat(F.lit("c"), F.col("id") % 300).alias("comp"), F.concat(F.lit("p"), F.col("id")).alias("product"), F.lit("dish").alias("n"), F.lit(5.0).alias("price"))
    own = spark.range(300).select(F.lit("A").alias("city_code"), F.concat(F.lit("s"), F.col("id")).alias("store_name"), F.lit("dish").alias("n"), F.lit(5.0).alias("price"))
    found = discovery.discover(comp, own, spark.createDataFrame([], "city_code string, comp_name string"))
    assert {(r["store_name"], r["n_confirmed"]) for r in found.collect()} == {("s0", 4)} and found.count() == 300
    # stores meet within a block; the only inner joins are with the blocks of each city
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert joins and all("strategy=broadcast" in line for line in joins)


def test_merge_looks_candidates_up_in_links_and_pools(spark):
    make = spark.createDataFrame
    links = make([("A", "shop one", "shop one a", None), ("A", "shop two", None, "x"), ("A", "shop six", None, "x"), ("A", "shop six", None, "y"), ("A", "shop two", "", None)], "city_code string, store_name string, comp_name string, pool string").withColumn("source", F.lit("seed"))
    pools = make([("A", "x", "shop two a"), ("A", "y", "shop six a"), ("B", "x", "shop six b")], "city_code string, pool string, comp_name string")
    mapping = links.where("pool is null").drop("pool").unionByName(links.drop("comp_name").join(pools, ["city_code", "pool"]).drop("pool"))
    found = make([("A", f"shop {k} {x}", f"shop {k}") for k in ("one", "two", "six", "ten") for x in "ab"], "city_code string, comp string, store_name string").withColumns({"ratio": F.lit(0.5), "n_confirmed": F.lit(1)})
    rows = lambda df: sorted(map(tuple, df.collect()))
    got, want = discovery.auto_merge(found, mapping, links, pools), discovery.auto_merge(found, mapping)
    assert rows(got.select(want.columns)) == rows(want) and got.where("source <> 'seed'").count() == 5
    assert any(r[2] == "shop six b" and r[3] != "seed" for r in rows(got.select("city_code", "store_name", "comp_name", "source")))  # the pool of another city


def test_mapping_tries_no_pair_in_vain(spark):
    sf = "/root/testdata/sf0.01"
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("supplier", "nation")}
    got, want = Tables(spark, sf)("mapping"), spark.sql(bridge.VIEWS["mapping"], **tables)
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 100
    plan = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert plan and not any(" OR " in line for line in plan)


def test_places_by_city(spark):
    """The report's order from the blocks: no join by name or price is behind a place."""
    df = catalogue.QUERIES["discovery_order"](spark, "/root/testdata/sf0.01")
    got = df.collect()
    assert got and {(r["city_code"], r["place"]) for r in got} == {(c, k + 1) for c in {r["city_code"] for r in got} for k in range(sum(r["city_code"] == c for r in got))}
    assert "bucket" not in df._jdf.queryExecution().optimizedPlan().toString()
