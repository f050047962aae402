"""Parsers of captured feed and menu payloads."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words by which a page says it has blocked the reader.
BLOCKED = ("verifica di sicurezza", "just a moment", "attention required", "access denied", "datadome")
# Badge texts that tell of a promotion, and those that only tell of free delivery.
PROMOTES = r"tutto il men|articoli\s+selezionat|\d\s*%|\bsconto|2\s*al\s*prezzo|2x1|\bspendi\b|risparmi|prezzo speciale|omaggio"
DELIVERS = r"consegna\s*grat|spedizione\s*grat|free\s*delivery"
# Kinds of structured offers, and which of a page's offers counts first.
OFFER_KINDS = {
    "BuyOneGetOneFreeOffer": "TWO_FOR_ONE",
    "ItemSpecificPercentOffOffer": "BASKET_PERCENTAGE",
    "FullMenuPercentOffOffer": "BASKET_PERCENTAGE",
    "PercentOffOffer": "PERCENTAGE_DISCOUNT",
    "OrderLevelPercentOffOffer": "PERCENTAGE_DISCOUNT",
    "AmountOffOffer": "FLAT_PRODUCT",
    "FreeDeliveryOffer": "FREE_DELIVERY",
}
FIRST_OFFERS = ("BuyOneGetOneFreeOffer", "ItemSpecificPercentOffOffer", "FullMenuPercentOffOffer")
CARDS = "array<struct<name:string,href:string,texts:array<string>>>"
MENU = "struct<offers:array<struct<kind:string,minimum:string,percent:double>>,items:array<struct<name:string,price:string,cut:string,percent:double>>>"


def _lines(lines) -> list[str]:
    """the texts of nested spans that are not blank."""
    return [s["text"].strip() for line in lines or [] for s in line.get("spans") or [] if (s.get("text") or "").strip()]


def _texts(card: dict) -> list[str]:
    """All lines of a card: its own, its bubble's, its overlay's badges and tag lines."""
    face = (card.get("uiContent") or {}).get("default") or {}
    over = face.get("overlay") or {}
    tag = over.get("promotionTag") or {}
    lines = [*(face.get("uiLines") or []), *((face.get("bubble") or {}).get("uiLines") or []), *((b.get("text") or {}) for b in over.get("badges") or [])]
    return _lines([*lines, *((tag.get(k) or {}).get("text") or {} for k in ("primaryTagLine", "secondaryTagLine"))])


def _nodes(node):
    """Objects of a document in the order a reader meets them: a node before its children."""
    stack = [node]
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            yield node
            stack.extend(reversed(list(node.values())))
        elif isinstance(node, list):
            stack.extend(reversed(node))


def _cards(body) -> list[dict]:
    """The stores of a feed, each once by its address or else its name, with the texts of all its cards."""
    out: dict[str, dict] = {}
    for node in _nodes(body):
        place = (node.get("target") or {}).get("restaurant") if node.get("__typename") == "UICard" and isinstance(node.get("target"), dict) else None
        if place:
            href = ((place.get("links") or {}).get("self") or {}).get("href") or ""
            if key := href or place.get("name"):
                out.setdefault(key, {"name": place.get("name") or "", "href": href, "texts": []})["texts"] += _texts(node)
    return [x | {"texts": list(dict.fromkeys(x["texts"]))} for x in out.values()]


def _menu(body) -> dict:
    """Structured offers and really reduced items of a menu page's document."""
    offers, items = [], {}
    for node in _nodes(body):
        if isinstance(node.get("name"), str) and isinstance(node.get("price"), dict) and "offerText" in node and node.get("priceDiscounted"):
            name, full, cut = " ".join(node["name"].split()).strip("| "), node["price"], node["priceDiscounted"]
            p, d = full.get("fractional"), cut.get("fractional")
            row = {"name": name, "price": full.get("formatted") or "", "cut": cut.get("formatted") or "", "percent": round((p - d) / p * 100, 1) if p and d and p > 0 else 0.0}
            if name:
                items.setdefault((name.lower(), row["price"]), row)
        if "typeName" in node and "minimumOrderValue" in node:
            percent = node.get("percentageDiscount")
            offers.append({"kind": node["typeName"], "minimum": (node["minimumOrderValue"] or {}).get("formatted") or "", "percent": None if percent is None else float(percent)})
    return {"offers": offers, "items": list(items.values())}


def _parsed(make, kind: str, none):
    """An Arrow UDF over JSON texts; what is no JSON gives ``none``."""

    def read(text):
        try:
            return make(json.loads(text)) if text else none
        except ValueError:
            return none

    @F.pandas_udf(kind)
    def walk(body: pd.Series) -> pd.Series:
        return pd.Series([read(t) for t in body])

    @F.pandas_udf(kind)
    def walk_structs(body: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(t) for t in body], columns=list(none))

    return walk if isinstance(none, list) else walk_structs


def parse_cards(bodies: DataFrame) -> DataFrame:
    """page and its cards; bodies that are no JSON have none. Any depth, so Arrow batches of Python."""
    return bodies.select("page", _parsed(_cards, CARDS, [])("body").alias("cards"))


def parse_menus(pages: DataFrame) -> DataFrame:
    """The promotion text of each menu page and its reduced items, from the document its script holds.

    The first offer by kind that is not free delivery counts. An offer on the whole menu has no
    items of its own; an offer without a percentage has the items' highest, and so has a page
    with reduced items alone.
    """
    body = F.regexp_extract("html", r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>', 1)
    found = pages.select("page", _parsed(_menu, MENU, {"offers": [], "items": []})(body).alias("m")).select("page", "m.*")
    order = lambda kind: F.when(kind == FIRST_OFFERS[0], 0).when(kind == FIRST_OFFERS[1], 1).when(kind == FIRST_OFFERS[2], 2).otherwise(9)
    ranked = F.transform(F.filter("offers", lambda o: o["kind"] != "FreeDeliveryOffer"), lambda o, k: F.struct(order(o["kind"]).alias("order"), k.alias("at"), o.alias("offer")))
    found = found.withColumn("offer", F.array_min(ranked)["offer"]).withColumn("best", F.coalesce(F.array_max(F.transform("items", lambda i: i["percent"])), F.lit(0.0)))
    whole = F.coalesce(F.col("offer.kind") == "FullMenuPercentOffOffer", F.lit(False))
    found = found.withColumn("items", F.when(whole, F.array().cast(found.schema["items"].dataType)).otherwise(F.col("items")))
    alone = F.when((F.size("items") > 0) & (F.col("best") > 0), F.concat(number(F.col("best")), F.lit("% di sconto"))).otherwise("")
    text = F.when(F.col("offer").isNotNull(), offer_text(F.col("offer.kind"), F.col("offer.minimum"), F.coalesce("offer.percent", F.col("best")))).otherwise(alone)
    return found.select("page", text.alias("promotion"), F.array_join(F.transform("offers", lambda o: o["kind"]), "|").alias("offer_kinds"), F.size("items").cast("long").alias("n_items"), "best")


def cards(bodies: DataFrame) -> DataFrame:
    """A row for each store of a feed, with its badge, and what says that the page was blocked."""
    some = bodies.where(~blocked(F.col("body")))
    return parse_cards(some).select("page", F.explode("cards").alias("c")).select("page", "c.name", "c.href", badge(F.col("c.texts")).alias("badge"))


def badge(texts: Column) -> Column:
    """The first promotion text in order that is not about free delivery."""
    hits = F.filter(texts, lambda t: t.rlike(f"(?i){PROMOTES}") & ~t.rlike(f"(?i){DELIVERS}"))
    return F.coalesce(F.get(F.array_sort(hits), F.lit(0)), F.lit(""))


def blocked(body: Column) -> Column:
    """Does the head of a page say that the reader was stopped?"""
    head = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 2000))
    return reduce(lambda a, b: a | b, [head.contains(x) for x in BLOCKED])


def number(c: Column) -> Column:
    """A percentage without a point and zeros behind it."""
    return F.regexp_replace(c.cast("string"), r"\.0+$", "")


def offer_text(kind: Column, minimum: Column, percent: Column) -> Column:
    """the text of a structured offer by its type name."""
    pct = F.when(percent > 0, number(percent))
    has_min = (F.coalesce(minimum, F.lit("")) != "") & ~minimum.isin("0,00 €", "0.00 €")
    full = F.when(has_min & pct.isNotNull(), F.concat(F.lit("Spendi almeno "), minimum, F.lit(", risparmia "), pct, F.lit("%"))).when(pct.isNotNull(), F.concat(pct, F.lit("% di sconto sull'ordine"))).otherwise("Sconto sull'ordine")
    item = F.when(has_min & pct.isNotNull(), F.concat(F.lit("Spendi "), minimum, F.lit(" per -"), pct, F.lit("% su articoli selezionati"))).when(pct.isNotNull(), F.concat(pct, F.lit("% di sconto"))).otherwise("Sconto su articoli selezionati")
    other = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in OFFER_KINDS.items() for x in pair]), kind), kind)
    return F.when(kind == FIRST_OFFERS[0], "2 al prezzo di 1").when(kind == FIRST_OFFERS[2], full).when(kind == FIRST_OFFERS[1], item).when(kind == "FreeDeliveryOffer", "Consegna gratis").otherwise(other)
