"""Text, price, date and place functions as Column expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of store names that tell nothing.
STOPWORDS = [
    "il", "la", "lo", "le", "gli", "i", "un", "una", "uno", "di", "da", "a", "in", "su", "per", "con", "tra", "fra",
    "del", "della", "dello", "dei", "degli", "delle", "al", "alla", "allo", "ai", "agli", "alle", "dal", "dalla", "dallo", "dai",
    "dagli", "dalle", "restaurant", "ristorante", "pizzeria", "trattoria", "bar", "cafe", "caffe", "osteria",
]
GEOHASH = "0123456789bcdefghjkmnpqrstuvwxyz"


def _decomposed() -> tuple[str, str, dict[str, str]]:
    """Letters that decompose to one, what they decompose to, and those that decompose to more; marks, which go, end the first.

    The rule is compatibility decomposition without combining marks, of every character but Hangul
    syllables, which stay whole.
    """
    one, to, marks, more = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        if unicodedata.combining(c):
            marks.append(c)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain == c:
            continue
        if len(plain) == 1:
            one.append(c)
            to.append(plain)
        else:
            more[c] = plain
    return "".join(one + marks), "".join(to), more


ONE, PLAIN, MORE = _decomposed()
#: Where letters that decompose to several stand, roughly: a few of Latin, and all from here on.
RARE = r"[\x{bc}-\x{be}\x{132}\x{133}\x{13f}\x{140}\x{149}\x{1c4}-\x{10ffff}]"


def unaccent(c: Column) -> Column:
    """Lower case, decomposed, accents off: by a table, so it stays inside generated code.

    Letters that decompose to several (ligatures, fractions, units) are looked up one by one, in
    rows that hold any.
    """
    low = F.lower(c)
    several = F.str_to_map(F.lit("\x02".join(f"{a}\x01{b}" for a, b in MORE.items())), F.lit("\x02"), F.lit("\x01"))
    rare = F.array_join(F.transform(F.split(low, ""), lambda x: F.coalesce(F.try_element_at(several, x), x)), "")
    holds = low.rlike(RARE) & (F.translate(low, "".join(MORE), "") != low)
    return F.translate(F.when(holds, rare).otherwise(low), ONE, PLAIN)


def fold(c: Column) -> Column:
    """what is no letter a-z or digit becomes one blank."""
    return F.trim(F.regexp_replace(unaccent(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def store_name(c: Column) -> Column:
    """code prefix off, folded, words that tell nothing off; repeated words stay."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"^[A-Z]{2,5}\s*[-–]\s*", "")
    words = F.split(F.trim(F.regexp_replace(unaccent(bare), r"(?U)[^\w]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*STOPWORDS) & (w != "")), " ")


def product_name(c: Column) -> Column:
    """a leading menu code off, then folded."""
    return fold(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"^\s*[a-z]{0,3}\d+\s*[-–—.:]\s*", ""))


def clean_text(c: Column) -> Column:
    """white space, also unbreakable, and marks of direction to single blanks; bars and blanks at the ends off."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\u200e\u200f\u202a-\u202e\u2066-\u2069]+", " ")
    return F.regexp_replace(plain, r"^[| ]+|[| ]+$", "")


def price(c: Column) -> Column:
    """localised price text to double; NULL where there is none."""
    kept = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9.,]", "")
    plain = F.when(kept.contains(",") & kept.contains("."), F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return plain.otherwise(F.replace(kept, F.lit(","), F.lit("."))).try_cast("double")


def rounded(c: Column, digits: int) -> Column:
    """A double half away from zero at a digit, judged by what it is times ten to that digit, as DuckDB does; Spark's own round judges the digits it prints."""
    scale = 10.0**digits
    return F.round(c * scale) / scale


def percent_off(full: Column, cut: Column) -> Column:
    """the reduction in percent, only where 0 < cut < full."""
    return F.when((cut > 0) & (cut < full), rounded((full - cut) / full * 100, 1))


def iso_week(c: Column) -> Column:
    """YYYY-Www."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), c).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(c).cast("string"), 2, "0"))


def canonical_url(c: Column) -> Column:
    return F.substring_index(c, "?", 1)


def name_from_url(c: Column) -> Column:
    """the last part of the path as a name: decoded, dashes as blanks, capitals."""
    path = F.regexp_extract(F.regexp_replace(canonical_url(clean_text(c)), "#.*$", ""), r"^(?:[a-z]+://[^/]*)?(/.*)$", 1)
    last = F.try_element_at(F.filter(F.split(path, "/"), lambda p: p != ""), F.lit(-1))
    return F.coalesce(F.initcap(F.trim(F.regexp_replace(F.replace(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), F.lit("-"), F.lit(" ")), r"\s+", " "))), F.lit(""))


def week_number(c: Column) -> Column:
    """the bare number of a week label."""
    return F.regexp_extract(c, r"W(\d+)$", 1).try_cast("int")


def token_sort(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(c, " "), lambda w: w != "")), " ")


def geohash(lat: Column, lon: Column, precision: int) -> Column:
    """F19 in closed form: both coordinates as integers, their bits interleaved, five a letter."""
    n = precision * 5
    lon_bits, lat_bits = (n + 1) // 2, n // 2
    x = F.least(F.floor((lon + 180.0) / 360.0 * 2.0**lon_bits), F.lit(2**lon_bits - 1)).cast("long")
    y = F.least(F.floor((lat + 90.0) / 180.0 * 2.0**lat_bits), F.lit(2**lat_bits - 1)).cast("long")
    letters = []
    for k in range(precision):
        value = F.lit(0).cast("long")
        for b in range(5):
            at = 5 * k + b
            source, place = (x, lon_bits - 1 - at // 2) if at % 2 == 0 else (y, lat_bits - 1 - at // 2)
            value = value * 2 + F.shiftright(source, place) % 2
        letters.append(F.substr(F.lit(GEOHASH), value.cast("int") + 1, F.lit(1)))
    return F.concat(*letters)
