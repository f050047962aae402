"""Likeness of names against plain tables of subsequences, and at the size of a city."""

import random
import time

from promolens.operators import likeness, parity, products


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def plain_sorted(a, b):
    return 200 * plain_common(a, b) / (len(a) + len(b)) if a or b else 100.0


def plain_words(a, b):
    x, y = set(a.split()), set(b.split())
    both, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    head = " ".join(sorted(both))
    alike = lambda p, q: 200 * plain_common(p, q) / (len(p) + len(q)) if p or q else 0.0
    first, second = " ".join(filter(None, (head, left))), " ".join(filter(None, (head, right)))
    gap = bool(head)
    total = len(first) + len(second)
    ends = 100 * (1 - (len(left) + len(right) - 2 * plain_common(left, right)) / total) if total else 0.0
    return max(ends, alike(head, first), alike(head, second)) if gap else ends


def names(rng, n, words="pizza da ugo elena rossi blu caffè 日本 sushi x antica".split()):
    return [" ".join(rng.choice(words) + rng.choice(["", "", "s", "i"]) for _ in range(rng.randrange(0, 5))) for _ in range(n)]


def test_scores():
    rng = random.Random(41)
    some = names(rng, 60) + ["a" * 200, "ab" * 70, "", "é"]
    for a in some:
        for b in rng.sample(some, 20):
            assert likeness.common(likeness.masks(a), len(a), b) == plain_common(a, b)
            assert abs(likeness.Sorted(a).score(likeness.Sorted(b)) - plain_sorted(a, b)) <= 0.00006
            assert abs(likeness.WordSet(a).score(likeness.WordSet(b)) - plain_words(a, b)) <= 0.00006


def test_nearest_is_that_of_all_pairs(spark):
    rng = random.Random(42)
    left = [("A", n) for n in sorted(set(names(rng, 40)))] + [("B", "pizza")] + [("C", "alone")]
    right = [(c, n, k) for k, (c, n) in enumerate([("A", n) for n in names(rng, 90)] + [("B", "pizza"), ("B", "pizza"), ("D", "x")])]
    for kind, block in (("sorted", 7), ("words", 11), ("sorted", 4000)):
        made = likeness.KINDS[kind]
        got = likeness.nearest(spark.createDataFrame(left, "city_code string, a string"), spark.createDataFrame(right, "city_code string, b string, place long"), 3, kind, block).collect()
        want = {}
        for c, a in left:
            best = sorted((-made(a).score(made(b)), k, b) for d, b, k in right if c == d)[:3]
            if best:
                want[c, a] = [(-s, k, b) for s, k, b in best]
        assert {(r["city_code"], r["a"]): [(x["score"], x["place"], x["b"]) for x in r["best"]] for r in got} == want


def test_ten_thousand_names_a_city(spark):
    rng = random.Random(43)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(3000)]
    say = lambda: " ".join(sorted(rng.choice(words) for _ in range(rng.randrange(2, 5))))
    right = [say() for _ in range(10_000)]
    left = list({b if k % 2 else b[:-1] + "q" for k, b in enumerate(right)})
    began = time.time()
    got = likeness.nearest(spark.createDataFrame([("A", a) for a in left], "city_code string, a string"), spark.createDataFrame([("A", b, k) for k, b in enumerate(right)], "city_code string, b string, place long"), 2).collect()
    assert len(got) == len(left) and time.time() - began < 60
    for r in rng.sample(got, 5):
        best = max(plain_sorted(r["a"], b) for b in right)
        assert abs(r["best"][0]["score"] - best) <= 0.00006


def test_unmatched_products_keep_nothing(spark):
    met = spark.createDataFrame([("X", "S", "C", "Zuppa", 3.0, "", "Tiramisu", 3.0, 2.0, 10.0, 5.0), ("X", "S", "C", "Pizza", 8.0, "", "Pizza", 8.1, 2.0, 10.0, 7.126)],
                                "city_code string, store_name string, comp_name string, comp_product string, comp_price double, promotion_type string, own_product string, own_price double, own_rank double, own_pct double, weight double")
    best = {r["comp_product"]: r for r in products.best_products(met).collect()}
    z, p = best["Zuppa"], best["Pizza"]
    assert (z["own_product"], z["gap_pct"], z["own_price"], z["own_revenue"], z["price_confirmed"], z["match_type"]) == ("", None, None, None, False, "unmatched") and 0 < z["name_score"] < 60
    assert (p["own_product"], p["name_score"], p["own_revenue"], p["price_confirmed"], p["match_type"]) == ("Pizza", 100, 7.13, True, "auto")
    summary = {r["match_type"]: r["n_confirmed"] for r in products.match_summary(products.best_products(met)).collect()}
    assert summary == {"unmatched": 0, "auto": 1}


def test_why_stores_have_no_other_side(spark):
    stores = spark.createDataFrame([("A", s, w, 3.0, 20.0, 10.0, 30.0, 5, 100.0, 50.0, "BASKET_PERCENTAGE") for s in "abcde" for w in ("1", "2")],
                                   "city_code string, store_name string, week_num string, best_promo_rank double, min_basket_size double, avg_pct_off double, max_pct_off double, promo_product_count long, revenue double, promo_coverage_pct double, best_promo_type string")
    mapping = spark.createDataFrame([("A", "a", "", "manual_rejected"), ("A", "b", "", "not_on_comp"), ("A", "c", "", "auto_fuzzy"), ("A", "d", "", "not_on_comp"), ("A", "d", " ", "manual_rejected"), ("A", "e", "Other", "seed"), ("A", "e", "", "manual_rejected")], "city_code string, store_name string, comp_name string, source string")
    index = spark.createDataFrame([("A", "other", "2x1", 2.0, 30.0, 0.0, 100.0)], "city_code string, name_norm string, promotion_type string, comp_rank double, comp_pct double, comp_basket double, stores_pct double")
    values = spark.createDataFrame([("A", "e", "1", 50.0)], "city_code string, store_name string, week_num string, order_value double")
    got = {(r["store_name"], r["week_num"]): (r["parity"], r["own_rank"]) for r in parity.store_verdicts(stores, mapping, index, values).collect()}
    assert [got[s, "1"][0] for s in "abcd"] == ["EXCLUSIVE_OWN", "NOT_ON_COMP", "UNMATCHED", "EXCLUSIVE_OWN"]
    # an order value lifts the basket promotion of its own week only
    assert got["e", "1"] == ("SUPERIORITY", 2.0) and got["e", "2"] == ("INFERIORITY", 3.0)
