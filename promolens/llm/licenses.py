"""License scans: exact phrases, and short notices found with a bounded number of edits."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from functools import cache, lru_cache
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame

from promolens.llm.common import doc_texts, map_rows

# The base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Short notices as they stand after normalising (lower case, words joined by one space), their
#: labels, and the words that tell this license from others: they must stand in a place unharmed.
#: A sentence that several licenses share bears a label that names them all.
NOTICES = (
    ("released under the mit license", "mit", r"\bmit\b"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", r"\bof this software\b"),
    ("licensed under the apache license version 2 0", "apache", r"\bapache\b"),
    ("you may not use this file except in compliance with the license", "apache-or-cddl-or-ecl-or-mpl", r""),
    ("this work is licensed under the gnu general public license version 3", "gpl", r"\bgnu general public\b"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", r"\bgnu general public\b"),
    ("licensed under cc by nc 4 0", "cc-by-nc", r"\bcc by nc \d"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by", r"\battribution \d"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "apache-1-or-bsd", r""),
    ("subject to the terms of the mozilla public license v 2 0", "mpl", r"\bmozilla\b"),
)
#: Edits allowed for each so many characters of a notice.
CHARS_AN_EDIT = 10
#: Characters of the grams that a place must share with a notice before edits are looked for.
GRAM = 3

_NOT_WORD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased: digits, a-z and all that is not ASCII."""
    return text.encode().translate(_NOT_WORD).split()


def edits(notice: str) -> int:
    return len(notice) // CHARS_AN_EDIT


def seeds(notice: str) -> list[tuple[int, str]]:
    """The notice cut into one piece more than it may have edits: one of them stands unharmed."""
    n = edits(notice) + 1
    cuts = [k * len(notice) // n for k in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@cache
def _machine(notices):
    automaton, where = ahocorasick.Automaton(), {}
    for k, (notice, _, _) in enumerate(notices):
        for at, piece in seeds(notice):
            where.setdefault(piece, []).append((k, at))
    for piece, hits in where.items():
        automaton.add_word(piece, (len(piece), tuple(hits)))
    automaton.make_automaton()
    return automaton


def grams(text: str) -> Counter:
    return Counter(text[k : k + GRAM] for k in range(len(text) - GRAM + 1))


def may_hold(window: str, notice: str, wanted: Counter) -> bool:
    """Whether a window can hold the notice: an edit harms GRAM grams at most, all others must be there."""
    return (wanted & grams(window)).total() >= len(notice) - GRAM + 1 - GRAM * edits(notice)


def letter_places(notice: str) -> dict[str, int]:
    """For each letter the places where it stands in the notice, as bits."""
    out: dict[str, int] = {}
    for k, ch in enumerate(notice):
        out[ch] = out.get(ch, 0) | 1 << k
    return out


def edit_row(places: dict[str, int], length: int, text: str, anchored: bool) -> list[int]:
    """For each prefix of the text the least edits between the notice and a part that ends there
    (the whole prefix if anchored): a column of the table a letter, as bits of two numbers."""
    whole, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, out = whole, 0, length, []
    for ch in text:
        same = places.get(ch, 0)
        down = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up, less = minus | (whole & ~(across | plus)), plus & across
        score += 1 if up & top else -1 if less & top else 0
        up, less = (up << 1 | anchored) & whole, less << 1 & whole
        plus, minus = less | (whole & ~(down | up)), up & down
        out.append(score)
    return out


@cache
def _notice(notice: str, key: str):
    """The notice's letters forwards and backwards, its grams, and the words that must be there."""
    return letter_places(notice), letter_places(notice[::-1]), grams(notice), regex.compile(key)


@cache
def _pattern(notice: str, wrong: int):
    return regex.compile(f"(?:{regex.escape(notice)}){{e<={wrong}}}")


@lru_cache(1 << 16)
def _place(window: str, notice: str, key: str) -> tuple[int, int, int] | None:
    """Start, end and edits of the notice's best place in a window (a text that repeats asks again and again).

    The table of edits tells whether there is any, how many edits it takes and where it lies, so
    the bounded-error pattern is asked of that one place, and with no more edits than it has.
    """
    forwards, backwards, wanted, words = _notice(notice, key)
    if not may_hold(window, notice, wanted) or not words.search(window):
        return None
    row = edit_row(forwards, len(notice), window, False)
    wrong = min(row)
    if wrong > edits(notice):
        return None
    b = row.index(wrong) + 1
    back = edit_row(backwards, len(notice), window[max(0, b - len(notice) - wrong) : b][::-1], True)
    a = b - back.index(wrong) - 1
    m = _pattern(notice, wrong).fullmatch(window, a, b)
    return (*m.span(), sum(m.fuzzy_counts)) if m else None


def notice_spans(joined: str, notices=NOTICES) -> list[tuple[str, int, int, int, float]]:
    """(label, start, end, edits, likeness) of notices in normalised text.

    A seed fixes where the notice would begin, give or take the edits; hits that point to the
    same place are one candidate. It is dropped if it lacks grams that no notice within the
    edits can lack, or if the table of edits finds too many; the bounded-error pattern confirms
    all others and reports their spans. The words that carry
    the label have no more letters than a notice may have edits, so these must stand unharmed in
    the place itself, at its ends eked out to whole words: the name of another license is no edit.
    Pieces of the notices themselves are all that is looked for, so one pass over the text
    finds every candidate.
    """
    automaton = _machine(notices)
    places: dict[int, set[int]] = {}
    for end, (length, hits) in automaton.iter(joined):
        for k, at in hits:
            places.setdefault(k, set()).add(end + 1 - length - at)
    out = []
    for k, starts in places.items():
        notice, label, key = notices[k]
        slack, done = edits(notice), -1
        for start in sorted(starts):
            low = max(0, start - slack, done)
            high = min(len(joined), start + len(notice) + slack)
            if high - low < len(notice) - slack:
                continue
            if found := _place(joined[low:high], notice, key):
                a, b, wrong = low + found[0], low + found[1], found[2]
                if out and out[-1][0] == label and out[-1][1:3] == (a, b):
                    continue
                if key and not regex.search(key, _whole_words(joined, a, b)):
                    continue
                out.append((label, a, b, wrong, 1 - wrong / len(notice)))
                done = b
    return out


def _whole_words(joined: str, a: int, b: int) -> str:
    """A place without the parts of words at its ends that it does not hold whole."""
    while a < b and a and joined[a - 1] != " " and joined[a] != " ":
        a += 1
    while b > a and b < len(joined) and joined[b] != " " and joined[b - 1] != " ":
        b -= 1
    return joined[a:b]


def scan_text(text: str, phrases=PHRASES, notices=NOTICES) -> dict:
    words = words_of(text)
    joined = b" ".join(words).decode()
    padded, starts, labels = f" {joined} ", [], set()
    begins: list[int] = []  # where each word begins, once anything needs it

    def word(at: int) -> int:
        """Words that begin before a place."""
        if not begins:
            begins.extend(accumulate((len(w) + 1 for w in joined.split(" ")), initial=0))
        return bisect_left(begins, at)

    if " license " in padded:
        for phrase, label in phrases:
            at = padded.find(needle := f" {phrase} ")
            while at >= 0:
                starts.append(word(at))
                labels.add(label)
                at = padded.find(needle, at + 1)
    found = notice_spans(joined, notices)
    return {
        "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {x[0] for x in found})),
        "score": max([1.0] * bool(starts) + [x[4] for x in found], default=0.0),
        "spans": ",".join(f"{label}:{word(a + 1) - 1}:{word(b)}:{wrong}" for label, a, b, wrong, _ in sorted(found, key=lambda x: x[1:])),
    }


_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Operator: words, base places, labels, score and notice spans (label:first word:end word:edits).

    The score is the likeness of the best notice, 1 for a base phrase, 0 for none. Null and empty
    texts have no words and nothing found; repeated rows are scanned each; long texts whole.
    """

    def run(rows):
        found = [scan_text(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"]} | {k: [x[k] for x in found] for k in (c.split()[0] for c in _SCHEMA.split(", ")[1:])}

    return map_rows(doc_texts(docs), run, _SCHEMA)


