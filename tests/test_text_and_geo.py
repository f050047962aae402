"""Folding of any script as Python's decomposition has it, and points inside polygons of any shape."""

import math
import random
import re
import unicodedata

from pyspark.sql import functions as F

from promolens.functions import text
from promolens.sources import geo


def plain_fold(t):
    t = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]+", " ", t).strip()


def plain_store(t):
    t = re.sub(r"^[A-Z]{2,5}\s*[-–]\s*", "", t)
    t = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))
    return " ".join(w for w in re.sub(r"[^\w]+", " ", t).split() if w not in text.STOPWORDS)


def test_names_of_any_script(spark):
    rng = random.Random(51)
    named = ["ﬁne ﬂan oﬃce", "Ｆｕｌｌ Ｗｉｄｔｈ １２", "Phở Việt Đặc biệt Ấ ặ", unicodedata.normalize("NFD", "Caffè Città Ñandú Việt"), "½ kg ㎏ ⑩ ① ℡ № 5", "İstanbul Straße ÆON œuf", "Кафе́ Йогурт ёж", "Ά ΐ Σας", "ᵃᵇ ² x⁷", "Ǆ ǆ ĳ ŀl", "日本 ガ ﾊﾟ", "ȩ́ ̈́", "𝐀 𝒷 𝟙", "AKC - L’Antica Pìzzerìa", "", "  ", "…™®"]
    pool = [chr(c) for c in range(0x20, 0x3000) if unicodedata.category(chr(c))[0] in "LNPSZM"] + [chr(c) for c in range(0xFB00, 0xFB07)] + [chr(c) for c in range(0xFF01, 0xFF60)]
    named += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    c = F.col("t")
    got = spark.createDataFrame([(t,) for t in named], "t string").select("t", text.fold(c).alias("f"), text.store_name(c).alias("s"), text.product_name(c).alias("p")).collect()
    for r in got:
        assert r["f"] == plain_fold(r["t"]), (r["t"], [hex(ord(x)) for x in r["t"]])
        assert r["p"] == plain_fold(re.sub(r"^\s*[a-z]{0,3}\d+\s*[-–—.:]\s*", "", r["t"].lower())) or "İ" in r["t"]
    assert {r["t"]: r["s"] for r in got[:17]} == {t: plain_store(t) for t in named[:17]}


def inside(polygon, x, y, slack=1e-9):
    """Even-odd over all rings, or as near to a side as rounding gets."""
    odd = False
    for ring in polygon:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            length = math.hypot(bx - ax, by - ay) or 1
            t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / length**2))
            if math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y) < slack:
                return True
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def wkt(polygon):
    return "POLYGON ((" + "), (".join(", ".join(f"{x!r} {y!r}" for x, y in ring) for ring in polygon) + "))"


def shapes():
    rng = random.Random(52)
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    out = {"box": [box(9.0, 45.0, 9.2, 45.2)], "donut": [box(9.0, 45.0, 9.3, 45.3), box(9.02, 45.02, 9.28, 45.28)], "two holes": [box(9.0, 45.0, 9.3, 45.3), box(9.01, 45.01, 9.14, 45.29), box(9.16, 45.01, 9.29, 45.29)]}
    out["c"] = [[(9.0, 45.0), (9.3, 45.0), (9.3, 45.01), (9.01, 45.01), (9.01, 45.29), (9.3, 45.29), (9.3, 45.3), (9.0, 45.3), (9.0, 45.0)]]
    out["u"] = [[(9.0, 45.3), (9.0, 45.0), (9.3, 45.0), (9.3, 45.3), (9.29, 45.3), (9.29, 45.01), (9.01, 45.01), (9.01, 45.3), (9.0, 45.3)]]
    for k in range(25):
        turn = sorted(rng.random() * 2 * math.pi for _ in range(rng.randrange(3, 14)))
        ring = [(9 + 0.1 * rng.uniform(0.05, 1) * math.cos(a), 45 + 0.1 * rng.uniform(0.05, 1) * math.sin(a)) for a in turn]
        out[f"star{k}"] = [ring + ring[:1]]
    return out


def test_no_point_outside(spark):
    some = shapes()
    df = spark.createDataFrame([(n, wkt(p)) for n, p in some.items()] + [("flat", "POLYGON ((9.5 45.5, 9.6 45.5, 9.5 45.5))"), ("bad", "POLYGON ((9 x, 1 2, 9 x))"), ("worse", "POINT (1 2)")], "code string, wkt string")
    for step in (2.0, 400.0):
        found = {}
        for r in geo.grid(df, step).collect():
            found.setdefault(r["code"], []).append((r["lon"], r["lat"]))
        assert found.keys() == some.keys() | {"flat"} and {y for _, y in found["flat"]} == {45.5} and min(found["flat"]) == (9.5, 45.5)
        for n, p in some.items():
            assert all(inside(p, x, y) for x, y in found[n]), n
            assert step < 400 or len(found[n]) == 1
    # points of a box with and without its hole differ by those in the hole
    n = {r["code"]: r["count"] for r in geo.grid(df, 2.0).groupBy("code").count().collect()}
    assert n["donut"] < n["u"] * 10 and n["two holes"] < 60
