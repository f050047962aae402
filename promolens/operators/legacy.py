"""The older matcher and its text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import text
from promolens.operators import likeness

# Words of names that many stores share.
GENERIC = ["pizza", "pizzeria", "sushi", "burger", "burgers", "kebab", "poke", "pokè", "ristorante", "restaurant", "food", "house", "bar", "cucina", "grill", "chicken", "delivery", "mexican", "italiano", "italiana", "plant", "based", "smashburger"]
# Promotions that are only about delivery.
EXCLUDED = ["spendi almeno 10 spese di consegna a 0", "spese di consegna a 0"]
EXCLUDED_PATTERN = r"consegna\s+grat(is|uita)|spese\s+di\s+consegna\s+a\s+0|consegna\s+a\s+0|free\s+delivery|delivery\s+grat(is|uita)"
# What lines of a card tell.
PROMO_LINES = [
    r"2\s+al\s+prezzo\s+di\s+1",
    r"spendi\s+almeno",
    "risparmia",
    "%",
    r"prodotti\s+selezionati",
    r"men[uù]\s+in\s+offerta",
    r"consegna\s+grat(is|uita)",
    r"spese\s+di\s+consegna\s+a\s+0",
    r"consegna\s+a\s+0",
    "offerta",
    "omaggio",
    r"aggiungi\s+un",
    r"2x1|due\s+x\s+uno",
]
PROMO_LINE = "|".join(PROMO_LINES)
EDITORIAL_LINES = [
    r"sapori\s+decisi",
    "nuovo",
    "novit[aà]",
    "sponsorizzato",
    "sponsored",
    r"scelto\s+per\s+te",
    r"solo\s+su\s+deliveroo",
    r"esclusiv[oa]\s+deliveroo",
    r"solo\s+deliveroo",
    r"porzioni\s+generose",
    r"spese\s+di\s+consegna\s+bass[e]?",
    r"consegna\s+rapida",
    r"in\s+primo\s+piano",
]
EDITORIAL_LINE = "|".join(EDITORIAL_LINES)
METRIC_LINE = r"(\d+[\.,]\d+\s*$|\bmin\b|\bkm\b|\bbuono\b|\bmolto\s+buono\b|consegna|€|^\d+$|\d{1,2}:\d{2})"
PREORDER_LINE = r"^(preordina|pre-order|preorder|ordina\s+per|chiude\s+alle|apre\s+alle|domani|oggi)\b"
PLACEHOLDERS = ["tracking ordine limitato", "tracking ordine", "ordine limitato"]
# The score that a match needs at all, and the points within which the runner-up counts.
THRESHOLD, RUNNER_UP = 84.0, 1.5


def _tokens(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(c, " "), lambda w: w != "")))


def significant(c: Column) -> Column:
    """words of a folded name that are longer than two letters and not generic."""
    return F.filter(_tokens(c), lambda w: (F.length(w) > 2) & ~w.isin(*GENERIC))


def match(names: DataFrame, choices: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each (city_code, a) the choice b that is sure enough and that no other reading of the name disputes.

    choices: city_code, b and place, their order, which settles ties; a choice may come repeatedly,
    and then is its own runner-up. Likeness is that of the cleaned name and the choice as they
    stand (F11, capitals and accents count); folded forms serve the tests for containment and words.
    """
    ours = names.select("city_code", text.clean_text(F.col("a")).alias("a")).where("a <> ''").distinct()
    top = likeness.nearest(ours, choices, 3, "words")
    first, second = F.get("best", F.lit(0)), F.get("best", F.lit(1))
    top = top.select("city_code", "a", first["b"].alias("b"), first["score"].alias("score"), second["b"].alias("second_b"), second["score"].alias("second"))
    x, y = text.fold(F.col("a")), text.fold(F.col("b"))
    top = top.withColumns({"shared": F.array_intersect(significant(x), significant(y)), "second_shared": F.array_intersect(significant(x), significant(text.fold(F.col("second_b"))))})
    strong = F.size(F.filter("shared", lambda t: F.length(t) >= 4))
    inside = F.contains(x, y) | F.contains(y, x)
    at = lambda s: F.col("score") >= max(threshold, s)
    sure = (x == y) | (inside & (strong > 0) & at(80)) | ((strong >= 2) & at(80)) | ((strong >= 1) & at(88)) | at(95)
    disputed = F.coalesce((F.col("second") >= F.col("score") - RUNNER_UP) & (F.col("second_shared") != F.col("shared")), F.lit(False))
    return top.where(sure & ~disputed).select("city_code", "a", "b", "score")


def excluded(promotion: Column) -> Column:
    """P09."""
    return text.fold(promotion).isin(*EXCLUDED) | promotion.rlike(f"(?iU){EXCLUDED_PATTERN}")


def is_metric(line: Column) -> Column:
    return line.rlike(f"(?iU){METRIC_LINE}")


def is_promotion(line: Column) -> Column:
    return line.rlike(f"(?iU){PROMO_LINE}")


def is_editorial(line: Column) -> Column:
    """Praise, an order for later, or a quotation: no name."""
    return line.rlike(f"(?iU){EDITORIAL_LINE}") | line.rlike(f"(?iU){PREORDER_LINE}") | (line.startswith("'") & line.endswith("'"))


def is_placeholder(line: Column) -> Column:
    return (line == "") | F.lower(line).isin(*PLACEHOLDERS) | line.rlike(f"(?iU){PREORDER_LINE}")


def line_class(line: Column) -> Column:
    """P10: what a line of a card tells, by the first class that it is of."""
    c = text.clean_text(line)
    found = F.when(c == "", "blank").when(F.lower(c).isin(*PLACEHOLDERS), "placeholder").when(c.rlike(f"(?iU){PREORDER_LINE}"), "preorder")
    return found.when(is_metric(c), "metric").when(is_promotion(c), "promotion").when(is_editorial(c), "editorial").otherwise("name")


def sanitize_name(name: Column, href: Column) -> Column:
    """the address's name for a placeholder, if the address has one."""
    c = text.clean_text(name)
    fallback = text.name_from_url(href)
    return F.when(is_placeholder(c) & (F.coalesce(fallback, F.lit("")) != ""), fallback).otherwise(c)


def clean_lines(lines: Column) -> Column:
    return F.filter(F.transform(F.coalesce(lines, F.array().cast("array<string>")), text.clean_text), lambda x: x != "")


def infer_name(lines: Column, href: Column) -> Column:
    """the first line before any measure that is neither promotion nor praise, else any such line
    that is no measure; what is no name in the end gives way to the address's."""
    plain = clean_lines(lines)
    says_name = lambda x: ~is_promotion(x) & ~is_editorial(x)
    # what stands before the first measure: grown while no measure was met
    head = F.aggregate(plain, F.struct(F.lit(False).alias("met"), F.array().cast("array<string>").alias("kept")), lambda s, x: F.struct((s["met"] | is_metric(x)).alias("met"), F.when(s["met"] | is_metric(x), s["kept"]).otherwise(F.concat(s["kept"], F.array(x))).alias("kept")))["kept"]
    found = F.coalesce(F.get(F.filter(head, says_name), F.lit(0)), F.get(F.filter(plain, lambda x: ~is_metric(x) & says_name(x)), F.lit(0)), F.lit(""))
    return sanitize_name(found, href)


def infer_promotion(lines: Column) -> Column:
    """the promotion lines, each once, in order."""
    return F.array_join(F.array_distinct(F.filter(F.transform(lines, text.clean_text), lambda x: x.rlike(f"(?iU){PROMO_LINE}"))), " | ")


def signatures(rows: DataFrame, cell: str) -> DataFrame:
    """The sorted distinct (name, promotion) pairs of each cell, folded, blanks left out."""
    pairs = rows.select(cell, text.fold(F.col("restaurant_name")).alias("n"), text.fold(F.col("promotion_type")).alias("p")).where("n <> '' and p <> ''")
    return pairs.groupBy(cell).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "n", "p"))), "|").alias("signature"))


def upsert_listing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Promotions of a name merged in order of sight, address and time of the last sight, delivery offers left out."""
    rows = old.unionByName(new).where(~excluded(F.col("promotion_type"))).withColumn("name_norm", text.fold(F.col("restaurant_name")))
    parts = F.posexplode(F.filter(F.transform(F.split("promotion_type", r"\|"), lambda x: F.trim(x)), lambda x: x != "")).alias("pos", "part")
    once = rows.select("city_code", "name_norm", "seq", parts).groupBy("city_code", "name_norm", "part").agg(F.min(F.struct("seq", "pos")).alias("first"))
    merged = once.groupBy("city_code", "name_norm").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "part"))), lambda x: x["part"]), " | ").alias("promotions"))
    last = rows.groupBy("city_code", "name_norm").agg(F.max_by("source_url", "seq").alias("source_url"), F.max("seq").alias("seq"))
    return merged.join(last, ["city_code", "name_norm"])
