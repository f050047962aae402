"""Promotion ranks, percentages, scopes and the verdict ladder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank of each kind of own promotion, best first; labels of the ranks.
KIND_RANKS = {"TWO_FOR_ONE": 1.0, "PERCENTAGE_DISCOUNT": 2.0, "FLAT_PRODUCT": 2.5, "BASKET_PERCENTAGE": 3.0, "FREE_DELIVERY": 4.0, "FLAT_DELIVERY": 5.0}
RANK_LABELS = {1.0: "2x1", 2.0: "% off prodotto", 2.5: "Flat prodotto", 3.0: "Basket %", 4.0: "Consegna gratis", 5.0: "Consegna scontata", 6.0: "Nessuna promo"}
NO_PROMO = 6.0
# Patterns of competitor promotion texts by rank; the first that matches a segment counts.
TEXT_RANKS = (
    (1.0, r"2\s*al\s*prezzo\s*di\s*1|2x1|due\s+al\s+prezzo"),
    (2.0, r"\d+\s*%\s*(di\s*)?sconto|prodotti\s*selezionati|fino\s*al\s*\d+\s*%|sconto\s+su\s+(prodotti|articoli)|sconto\s+sull"),
    (2.5, r"sconto\s*fisso|prezzo\s*speciale|\d+[,\.]\d+\s*€\s*di\s*sconto"),
    (3.0, r"spendi\s*(almeno|min|da)?\s*[\d,\.]+|basket\s*%|spend[io]\s*\d+\s*€?\s*(per|ottieni|e\s*ottieni)"),
    (4.0, r"consegna\s*grat(is|uita)|free\s*delivery|spedizione\s*grat"),
    (5.0, r"consegna\s*a\s*[\d,\.]+\s*€|flat\s*delivery|\d+[,\.]\d+\s*€\s*(di\s*)?consegna"),
)
PERCENT = r"(\d+(?:[.,]\d+)?)\s*%"
BASKET = r"(?:spendi|almeno|min|da)\s*(?:almeno|min|da)?\s*(\d+(?:[.,]\d+)?)\s*€"
# Points, products and basket difference that decide between equal ranks.
POINTS, PRODUCTS, BASKET_GAP = 2.0, 2, 10.0


def _kinds() -> Column:
    return F.create_map(*[F.lit(x) for pair in KIND_RANKS.items() for x in pair])


def rank_of_kind(kind: Column, flag: Column) -> Column:
    """a combination of kinds has no rank of its own."""
    return F.when(flag == "Y", F.coalesce(F.try_element_at(_kinds(), F.upper(F.trim(kind))), F.lit(NO_PROMO))).otherwise(NO_PROMO)


def strongest_kind(kinds: Column) -> Column:
    """of a comma list, the kind of the best rank; NULL if none is known. One kind alone is no list.
    Kinds are looked for by rank, as patterns, which the engine compiles; functions over arrays it does not."""
    out, said = F.when(kinds.isin(*KIND_RANKS), kinds), F.upper(kinds)
    for kind in sorted(KIND_RANKS, key=KIND_RANKS.get):
        out = out.when(said.rlike(rf"(?:^|,) *{kind} *(?:,|\z)"), kind)
    return out


def rank_of_text(text: Column) -> Column:
    """best rank over the segments between bars."""

    def one(segment):
        out = None
        for rank, pattern in TEXT_RANKS:
            test = segment.rlike(f"(?iU){pattern}")
            out = F.when(test, rank) if out is None else out.when(test, rank)
        return out.otherwise(NO_PROMO)

    return F.array_min(F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda s: one(F.trim(s))))


def _numbers(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?iU){pattern}"), 1), lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double"))


def percent_of_text(text: Column) -> Column:
    return F.coalesce(F.array_max(_numbers(text, PERCENT)), F.lit(0.0))


def basket_of_text(text: Column) -> Column:
    return F.coalesce(F.array_min(_numbers(text, BASKET)), F.lit(0.0))


def rank_label(rank: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in RANK_LABELS.items() for x in pair]), rank), F.concat(F.lit("Rank "), rank.cast("string")))


def true_label(kind: Column, fallback: Column) -> Column:
    """The label of the kind itself, whatever rank the usual order has given it."""
    k = F.upper(F.coalesce(kind, F.lit("")))
    out = F.when(k.contains("TWO_FOR_ONE"), RANK_LABELS[1.0]).when(k.contains("BASKET_PERCENTAGE"), RANK_LABELS[3.0])
    return out.when(k.contains("PERCENTAGE_DISCOUNT"), RANK_LABELS[2.0]).otherwise(fallback)


def product_label(comp_pct: Column, own_on: Column, own_pct: Column, tolerance: float = 0.5) -> Column:
    """two promotions of one product, from the promoting competitor's side."""
    out = F.when(~F.coalesce(own_on, F.lit(False)), "OWN_NO_PROMO").when(comp_pct.isNull() | own_pct.isNull(), "BOTH_PROMO")
    return out.when(own_pct + tolerance >= comp_pct, "OWN_AT_LEAST").otherwise("COMP_STRONGER")


def own_scope(kind: Column) -> Column:
    return F.when(F.upper(F.trim(kind)) == "BASKET_PERCENTAGE", "full").when(F.upper(F.trim(kind)) == "TWO_FOR_ONE", "selected").otherwise("")


def text_scope(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.when(t.contains("selezionat"), "selected").when(t.rlike("spendi|risparmia|ordine|sconto|%"), "full").otherwise("")


def order_value_rank(rank: Column, basket: Column, order_value: Column) -> Column:
    """A basket promotion whose minimum the usual order nearly reaches counts as a plain one."""
    hit = (rank == 3.0) & (F.coalesce(basket, F.lit(0.0)) != 0) & (order_value >= basket - 1)
    return F.when(F.coalesce(hit, F.lit(False)), 2.0).otherwise(rank)


def verdict(g: Column, d: Column, gp: Column, dp: Column, products: Column, gb: Column, db: Column, gs: Column, ds: Column) -> Column:
    """the ladder from ranks, percentages, products, baskets and scopes (own first)."""
    gp, dp, gb, db = (F.coalesce(x, F.lit(0.0)) for x in (gp, dp, gb, db))
    products, diff, gap = F.coalesce(products, F.lit(0)), gp - dp, gb - db
    even = (g == d) & (gp > 0) & (dp > 0)
    plain, basket = even & (g == 2.0), even & (g == 3.0)
    near = basket & (F.abs(gap) <= BASKET_GAP)
    far = basket & (F.abs(gap) > BASKET_GAP)
    up, down = F.lit("SUPERIORITY"), F.lit("INFERIORITY")
    return (
        F.when((g == 1.0) & (d == 2.0) & (gs == "selected") & (ds == "full"), "PARITY")
        .when(g < d, up).when(g > d, down)
        .when(plain & (diff >= POINTS), up).when(plain & (diff <= -POINTS), down)
        .when(plain & (gs == "full") & (ds == "selected"), up).when(plain & (ds == "full") & (gs == "selected"), down)
        .when(plain & (products >= PRODUCTS), up)
        .when(near & (diff >= POINTS), up).when(near & (diff <= -POINTS), down).when(near & (gap < 0), up).when(near & (gap > 0), down)
        .when(far & (diff >= POINTS) & (gap <= 0), up).when(far & (diff <= -POINTS) & (gap >= 0), down)
        .otherwise("PARITY")
    )
