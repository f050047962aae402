"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings."""

from __future__ import annotations

import math
import re
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import doc_texts, map_rows

# The base patterns with the least length of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings, the window, and the entropy in bits a character from which a window of a
#: class counts: close to what random strings of that class reach over this window.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]+\Z"), 3.0), ("alnum", re.compile(r"[0-9A-Za-z]+\Z"), 3.6), ("base64", re.compile(r"[A-Za-z0-9+/_=-]+\Z"), 3.8))
#: What a whole candidate may be that is no secret: no letter at all, a UUID.
ALLOWED = re.compile(r"(?:[^A-Za-z]*|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})\Z", re.I)
#: A digest that says so, as long as its kind is, in hex or base64; what follows it is looked at.
DIGEST = re.compile(
    r"(?:sha1[-_=](?:[0-9a-f]{40}|[A-Za-z0-9+/_-]{27}=)|sha256[-_=](?:[0-9a-f]{64}|[A-Za-z0-9+/_-]{43}=)|sha512[-_=](?:[0-9a-f]{128}|[A-Za-z0-9+/_-]{86}==)"
    r"|md5[-_=](?:[0-9a-f]{32}|[A-Za-z0-9+/_-]{22}==))(?![A-Za-z0-9])", re.I,
)
#: Words and paths of words and dates. Only their parts between separators that are long enough to be random letters are looked at.
WORDY = re.compile(r"(?:[^0-9]*|(?:(?:[A-Za-z]{2,}[0-9]{0,4}|(?:19|20)[0-9]{2}|[01][0-9])[/_-])+[A-Za-z]{2,}[0-9]{0,4})\Z")
PART = re.compile(r"[0-9A-Za-z]{%d,}" % WINDOW)
#: Stretches that no window of a secret holds whole: words of examples, repeated characters, alphabets in order.
_ORDERS = ("0123456789abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789")
PLACEHOLDER = re.compile("(?=(example|sample|xxxxxx|" + "|".join(sorted({o[k : k + 10] for o in _ORDERS for k in range(27)})) + r"|(.)\2{7}))", re.I | re.S)

#: Words of four languages, from whose letter pairs the pairs of words are told from those of random letters.
WORDS = (
    "the and that with have this from they would there their what about which when make like time just know people into year your good some could them "
    "other than then look only come over think also back after work first well even want because these give most service production internet container "
    "configuration international implementation development management information application understanding government environment responsibility "
    "der die und den von das mit sich des auf für ist nicht eine als auch werden aus hat dass nach wird einer schaft gesellschaft versicherung rechts "
    "kapitän schiff fahrt dampf über wachung aufgaben fleisch lebens mittel grund stück verkehr genehmigung zuständigkeit geschwindigkeit wirtschaft arbeit "
    "les des que une dans pour qui sur pas plus par avec tout faire sont mais comme nous leur bien où sans peut elle aussi entre après développement "
    "gouvernement administration consommation anticonstitutionnellement établissement mouvement travailleur "
    "los las por una con para como más pero sus este entre cuando muy sin sobre también hasta hay donde quien desde todo nos durante todos uno les "
    "desarrollo administración responsabilidad electrodoméstico agradecimiento extraordinario conocimiento trabajador"
).translate(str.maketrans("äöüßéèàçñáíóúùêâîôû", "aousseeacnaiouueaiou"[:19])).split()


def _pair_scores() -> dict[str, float]:
    """For each pair of letters how much likelier it is in words than among random letters, in bits."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    seen = {a: dict.fromkeys(letters, 0.5) for a in letters}
    for word in WORDS:
        for a, b in zip(word, word[1:], strict=False):
            seen[a][b] += 1
    return {a + b: math.log2(n / sum(row.values()) * len(letters)) for a, row in seen.items() for b, n in row.items()}


PAIRS = _pair_scores()
#: Bits from which a window's pairs are those of words: where letters stand alone, and where digits and signs are among them.
WORD_LIKE, OTHER_LIKE = -3.0, 8.0

_XLOG = [0.0] + [k * math.log2(k) for k in range(1, 4097)]


def entropy_spans(text: str, start: int, stop: int, least: float, window: int = WINDOW, word: list[float] | None = None, like: float = 0.0) -> list[tuple[int, int]]:
    """Unions of the windows of text[start:stop] whose Shannon entropy reaches least.

    With ``word``, running sums of pair scores, windows whose pairs score more than ``like`` are left out.

    One count leaves and one enters a step, and the sum of c*log2(c) is adjusted for these two
    alone, so the work is a constant for each character.
    """
    counts: dict[str, int] = {}
    total, found, size = 0.0, [], min(window, stop - start)
    full = math.log2(size) if size else 0.0
    for k in range(start, stop):
        c = counts.get(text[k], 0)
        total += _XLOG[c + 1] - _XLOG[c]
        counts[text[k]] = c + 1
        if k - start >= size:
            old = text[k - size]
            c = counts[old]
            total += _XLOG[c - 1] - _XLOG[c]
            counts[old] = c - 1
        if k - start >= size - 1 and full - total / size >= least - 1e-9:
            low = k - size + 1
            if word and word[k] - word[low] > like:
                continue
            if found and low <= found[-1][1]:
                found[-1] = (found[-1][0], k + 1)
            else:
                found.append((low, k + 1))
    return found


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 8:
            out.append((m.start(), "assign", m.end()))
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return out


def _pieces(text: str, start: int, stop: int):
    """Stretches of text[start:stop] that have, between them, just the windows that hold no placeholder whole."""
    for m in PLACEHOLDER.finditer(text, start, stop):
        if m.end(1) - 1 - start >= WINDOW:
            yield start, m.end(1) - 1
        start = max(start, m.start() + 1)
    if stop - start >= WINDOW:
        yield start, stop


def method_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of high-entropy stretches of candidate strings, but for what the rules above cover.

    A rule takes no more than it covers: a placeholder the windows that hold it, a digest itself,
    words their parts. In words, capitals count as their small letters. Windows whose letter pairs
    are those of words are none of a secret.
    """
    out = []
    for m in CANDIDATE.finditer(text):
        start, stop = m.span()
        if digest := DIGEST.match(text, start, stop):
            start = digest.end()
        value = text[start:stop]
        if len(value) < WINDOW or ALLOWED.match(value):
            continue
        least = next(e for _, pattern, e in CLASSES if pattern.match(value))
        parts, like = [(0, len(value))], OTHER_LIKE
        if WORDY.match(value):
            value, least = value.lower(), CLASSES[1][2]
            parts, like = [p.span() for p in PART.finditer(value)], WORD_LIKE
        small = value.lower()
        word = list(accumulate((PAIRS.get(small[k : k + 2], 0.0) for k in range(len(small) - 1)), initial=0.0))
        found: list[tuple[int, int]] = []
        for a, b in (piece for part in parts for piece in _pieces(value, *part)):
            for low, high in entropy_spans(value, a, b, least, word=word, like=like):
                if found and low <= found[-1][1]:
                    found[-1] = (found[-1][0], max(high, found[-1][1]))
                else:
                    found.append((low, high))
        out += [(start + a, "entropy", start + b) for a, b in found]
    return out


def _joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(found, key=lambda x: (x[0], KINDS.index(x[1]), x[2])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Operator: doc_id, counts of the base kinds, base and all spans of each document.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. Null and
    empty texts have none; repeated rows are scanned each; an empty table gives no rows.
    """

    def run(rows):
        out = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base", "spans")}
        out["doc_id"] = rows["doc_id"]
        for text in rows["text"]:
            base = base_spans(text)
            for kind in KINDS[:3]:
                out[f"n_{kind}"].append(sum(k == kind for _, k, _ in base))
            out["base"].append(_joined(base))
            out["spans"].append(_joined(base + method_spans(text)))
        return out

    return map_rows(doc_texts(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string")


def redact(text: str) -> str:
    """The text with every found stretch replaced by the kind that found it first."""
    out, at = [], 0
    for a, kind, b in sorted(base_spans(text) + method_spans(text), key=lambda x: (x[0], -x[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """Documents with their secrets replaced; null texts stay null, other columns stay as they are."""

    def run(rows):
        rows["text"] = [t if t is None else redact(t) for t in rows["text"]]
        rows["n_chars"] = [n if t is None else len(t) for n, t in zip(rows["n_chars"], rows["text"], strict=True)]
        return rows

    columns = docs.select(F.col("doc_id").cast("long"), "text", "lang", "source", F.col("n_chars").cast("long"))
    return map_rows(columns, run, "doc_id long, text string, lang string, source string, n_chars long")


def digest_secrets(scanned: DataFrame) -> DataFrame:
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
