"""Plain versions of the operators, straight from what each one promises."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared_strings(rows, width=50):
    least = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - width + 1):
            s = raw[i : i + width]
            if d is not None and least.get(s, d) >= d:
                least[s] = d
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            low = least.get(raw[i : i + width])
            if low is not None and (d is None or low < d):
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def payload(text):
    raw = (text or "").encode()
    full = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
    return len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])


def targets(sizes):
    """source -> size to source -> target, by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while free:
        level = (total - sum(2 * sizes[s] for s in names if s not in free)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        free -= over
    for s in names:
        out[s] = level * weight[s] if s in free else 2.0 * sizes[s]
    return out


def secrets(text):
    text, found = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    n = Counter(x[2] for x in found)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in found).encode()).hexdigest()


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = []
    for phrase, label in ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl")):
        hits += [(k, label) for k in range(len(words)) if tuple(words[k : k + len(phrase)]) == phrase]
    at = [k for k, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    cover = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(cover), n < 20 or 100 * len(cover) > 30 * n


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or {tuple(words)}


def near(rows, width=2, percent=80):
    """doc_id -> (set size, component), from all pairs that share a shingle."""
    sets = {d: shingles(t, width) for d, t in rows}
    holders, parent = defaultdict(list), {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    for d in sorted(sets):
        if sets[d]:
            key = frozenset(sets[d])
            if key in first:
                parent[d] = root(first[key])
            else:
                first[key] = d
    for d in first.values():
        for s in sets[d]:
            holders[s].append(d)
    for d in sorted(first.values()):
        shared = Counter(e for s in sets[d] for e in holders[s] if e < d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}
