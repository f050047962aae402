"""Toxicity by a gap-weighted subsequence kernel, Nystroem landmarks and a support vector machine."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import doc_texts, map_rows

#: Labelled documents of each class that training reads at most, landmarks, turns, parts for the odds.
SAMPLE, LANDMARKS, TURNS, FOLDS = 2000, 192, 3, 4
#: Words of a window at most; what a text's evidence is: its best window's decision and the means over
#: its three and eight best words; the least evidence.
WINDOW, EVIDENCE, LOWEST = 3, 3, -4.0
#: From which decision on a word's letters are left out one by one, and what leaving one out costs.
NEAR, LEFT_OUT = -0.4, 0.1
#: What a positive and a negative on the wrong side cost, and what a missed text may cost against a false
#: alarm: the parts left out in training choose.
COSTS, MISSED = (3.0, 1.0), (1.0, 2.0, 3.0, 5.0, 8.0)
#: Tokens whose values a worker remembers.
CACHED = 400_000
#: The kernel: subsequences of three and four signs inside a stretch, each gap sign weighing DECAY.
#: Signs are letters and the word's begin and end.
LENGTHS, DECAY, STRETCH, LONGEST, LETTERS, FOLDED = (3, 4), 0.6, 5, 20, 29, 32749
SIZE = LETTERS**3 + FOLDED
BEGIN, END = "\x1b", "\x1c"  # 27 and 28, behind the letters
# Digits and signs that stand for letters.
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


class _Codes(dict):
    """For str.translate: the sign of a character's base letter, nothing for what is no letter."""

    def __missing__(self, point: int) -> str | None:
        ch = chr(point)
        base = unicodedata.normalize("NFKD", _LOOKALIKE.get(ch, ch).lower())[:1]
        sign = self[point] = chr(ord(base) - 96) if "a" <= base <= "z" else None
        return sign


_CODES = _Codes()
_SPACED = re.compile(r"(?:(?<=\s)|\A)(?:\S[\s.*_-]+){3,}\S(?=\s|\Z)")


def tokens_of(text: str) -> list[str]:
    """Tokens of a text in order, and behind them its spelled-out runs of single letters, joined."""
    return [*text.lower().split(), *(re.sub(r"[\s.*_-]+", "", m[0]).lower() for m in _SPACED.finditer(text))]


def code_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes of stretches of at most LONGEST signs, zero filled, and the word of each.

    Characters that are no letters are left out, so they cost an insult nothing.
    """
    rows, of = [], []
    for k, w in enumerate(words):
        signs = f"{BEGIN}{w.translate(_CODES)}{END}"
        for at in range(0, max(1, len(signs) - LONGEST // 2), LONGEST // 2):
            rows.append(signs[at : at + LONGEST].ljust(LONGEST, "\0"))
            of.append(k)
    return np.frombuffer("".join(rows).encode("latin-1"), np.uint8).reshape(len(rows), LONGEST).astype(np.int32), np.array(of, np.int64)


_PLACES = [p for n in LENGTHS for i in range(LONGEST) for rest in combinations(range(i + 1, min(LONGEST, i + STRETCH)), n - 1) for p in [(i, *rest)]]


def features(codes: np.ndarray):
    """(subsequence id of each row, weight) for each place in the rows; id 0 is none.

    Subsequences of three signs have ids of their own; longer ones share FOLDED further ids.
    """
    length = (codes > 0).sum(1).max(initial=0)
    for place in _PLACES:
        if place[-1] < length:
            ids = codes[:, place[0]]
            for k in place[1:]:
                ids = ids * LETTERS + codes[:, k]
            if len(place) > 3:
                ids = ids % FOLDED + LETTERS**3
            yield np.where(codes[:, place[-1]] > 0, ids, 0), DECAY ** (place[-1] - place[0] - len(place) + 1)


def project(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Feature vectors, of unit length over their places, times a table with a row for each id."""
    out, square = np.zeros((codes.shape[0], *table.shape[1:]), np.float32), np.full(codes.shape[0], 1e-12)
    for ids, weight in features(codes):
        out += np.float32(weight) * table[ids]
        square += weight * weight * (ids > 0)
    return out / np.sqrt(square).astype(np.float32).reshape(-1, *[1] * (table.ndim - 1))


def phi(codes: np.ndarray) -> np.ndarray:
    """The explicit feature vectors, for landmarks: a row for each word."""
    out, square, rows = np.zeros((codes.shape[0], SIZE), np.float32), np.full(codes.shape[0], 1e-12), np.arange(codes.shape[0])
    for ids, weight in features(codes):
        out[rows, ids] += weight
        square += weight * weight * (ids > 0)
    out[:, 0] = 0
    return out / np.sqrt(square).astype(np.float32)[:, None]


@dataclass
class Model:
    """The machine folded into one weight for each subsequence, and the odds that its decisions stand for."""

    weights: np.ndarray
    bias: float = 0.0
    odds: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)  # for the best window, the three and eight best words, and without any
    known: dict = field(default_factory=dict)  # values of tokens that a worker remembers

    def values(self, words: list[str]) -> np.ndarray:
        """What each word adds to the decision of a window, or, if it comes near to an insult, the word without one of its letters."""
        out = self.plain_values(words)
        near = np.flatnonzero(out + self.bias > NEAR)
        fewer = [(k, w[:at] + w[at + 1 :]) for k, w in ((k, words[k]) for k in near.tolist()) if 5 <= len(w) <= LONGEST for at in range(1, len(w) - 1)]
        if fewer:
            np.maximum.at(out, [k for k, _ in fewer], self.plain_values([w for _, w in fewer]) - LEFT_OUT)
        return out

    def plain_values(self, words: list[str]) -> np.ndarray:
        """The value of each word's best stretch."""
        out = np.full(len(words), -np.inf)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(min(len(w), LONGEST + 1), []).append(k)
        for group in by_length.values():
            for at in range(0, len(group), 20000):
                part = group[at : at + 20000]
                codes, of = code_rows([words[k] for k in part])
                np.maximum.at(out, np.array(part)[of], project(codes, self.weights))
        return out

    def decide(self, bags: list[list[str]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """EVIDENCE of each list of tokens, and where its best window is."""
        known = self.known
        fresh = list(set().union(*bags).difference(known))
        if len(known) + len(fresh) > CACHED:
            known.clear()
            fresh = list(set().union(*bags))
        known.update(zip(fresh, self.values(fresh).tolist(), strict=True))
        out, places = np.full((len(bags), EVIDENCE), LOWEST), []
        for k, bag in enumerate(bags):
            value = np.fromiter(map(known.__getitem__, bag), float, len(bag))
            top, place = best_window(value)
            places.append(place)
            if value.size:
                best = np.unique(value)
                out[k] = top + self.bias, best[-3:].mean() + self.bias, best[-8:].mean() + self.bias
        return np.clip(out, LOWEST, -LOWEST), places

    def score(self, texts: list[str]) -> list[float]:
        """Probability of each text; texts without words get the lowest evidence."""
        found, _ = self.decide([tokens_of(t) for t in texts])
        return (1 / (1 + np.exp(-np.clip(found @ np.array(self.odds[:-1]) + self.odds[-1], -30, 30)))).tolist()


def best_window(value: np.ndarray) -> tuple[float, tuple[int, int]]:
    """The highest sum of up to WINDOW words in a row over the root of their number, and where these stand."""
    top, place = -np.inf, (0, 0)
    total = np.concatenate([[0.0], np.cumsum(value)])
    for n in range(1, min(WINDOW, value.size) + 1):
        sums = (total[n:] - total[:-n]) / n**0.5
        k = int(np.argmax(sums))
        if sums[k] > top + 1e-9:
            top, place = float(sums[k]), (k, k + n)
    return top, place


def _first_rows(words: list[str]) -> np.ndarray:
    codes, of = code_rows(words)
    return codes[np.searchsorted(of, np.arange(len(words)))]


def _over_words(windows: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of windows, the word and the window of each occurrence, and the weight of a window's words."""
    index: dict[str, int] = {}
    word = np.array([index.setdefault(w, len(index)) for ws in windows for w in ws], np.int64)
    size = np.array([len(ws) for ws in windows])
    return list(index), word, np.repeat(np.arange(len(windows)), size), 1 / np.sqrt(size)


def window_vectors(windows: list[list[str]], table: np.ndarray) -> np.ndarray:
    """Sums of the words' unit feature vectors over the root of their number, times a table: a kernel on windows."""
    words, word, window, weight = _over_words(windows)
    codes = _first_rows(words)
    z = np.concatenate([project(codes[at : at + 4000], table) for at in range(0, len(words), 4000)])
    out = np.zeros((len(windows), table.shape[1]))
    np.add.at(out, window, z[word])
    return out * weight[:, None]


def landmark_vectors(windows: list[list[str]]) -> np.ndarray:
    """The same explicitly: a row for each window, a column for each subsequence."""
    words, word, window, weight = _over_words(windows)
    each, out = phi(_first_rows(words)), np.zeros((len(windows), SIZE), np.float32)
    for k, w in zip(window.tolist(), word.tolist(), strict=True):
        out[k] += each[w]
    return out * weight.astype(np.float32)[:, None]


def _landmarks(windows: list[list[str]], n: int, pool: int) -> list[list[str]]:
    """The most frequent windows, each apart from those taken before it."""
    often = [list(w) for w, _ in Counter(map(tuple, windows)).most_common(pool)]
    unit = landmark_vectors(often)
    unit /= np.maximum(1e-6, np.sqrt((unit**2).sum(1)))[:, None]
    like, taken = unit @ unit.T, []
    for k in range(len(often)):
        if len(taken) < n and (not taken or like[k, taken].max() < 0.9):
            taken.append(k)
    return [often[k] for k in taken]


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Linear support vector machine with squared hinges by Newton steps; the last column of x is the bias."""
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        weighted = x[inside] * cost[inside, None]
        new = np.linalg.solve(x[inside].T @ weighted + ridge, weighted.T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _machine(positives, negatives, marks) -> Model:
    """A machine on windows, by Nystroem landmarks, folded into weights of subsequences."""
    landmarks = landmark_vectors(marks)
    values, vectors = np.linalg.eigh(landmarks @ landmarks.T + 1e-6 * np.eye(len(marks)))
    table = (landmarks.T @ (vectors / np.sqrt(np.maximum(values, 1e-4)))).astype(np.float32)  # the kernel to the landmarks, whitened
    z, y = window_vectors(positives + negatives, table), np.r_[np.ones(len(positives)), -np.ones(len(negatives))]
    w = _svm(np.c_[z, np.ones(len(y))], y, np.r_[np.full(len(positives), COSTS[0]), np.full(len(negatives), COSTS[1])])
    return Model((table @ w[:-1]).astype(np.float32), float(w[-1]))


def _altered(word: str, rng) -> str:
    """A word with a foreign letter inside, as writers hide it."""
    at = int(rng.integers(1, len(word)))
    return word[:at] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)] + word[at:]


def train_machine(rows: list[tuple[str, int]], seed: int = 7) -> Model | None:
    """Multiple-instance training on labelled sentences: which window makes a text toxic is learned on the way.

    The first weights are the difference between the mean feature vectors of toxic and of clean
    texts' words, each subsequence by its spread. In each turn the best windows of toxic texts are
    the positives, also with a foreign letter in their words, the best windows of clean texts and
    random ones the negatives; landmarks are windows of both that lie far apart.
    """
    rng, bags, labels = np.random.default_rng(seed), [tokens_of(t) for t, _ in rows], np.array([y for _, y in rows])
    if not (labels == 1).any() or not (labels == 0).any():
        return None
    model = Model(_contrast(bags, labels))
    for _ in range(TURNS):
        _, places = model.decide(bags)
        positives, hard, chance = [], [], []
        for bag, y, (a, b) in zip(bags, labels, places, strict=True):
            if not bag:
                continue
            if y:
                left, least = list(bag), 0.0
                for turn in range(3):  # further windows, if they are nearly as good
                    value = np.fromiter(map(model.known.__getitem__, left), float, len(left))
                    top, (a, b) = best_window(value)
                    if turn and top < least:
                        break
                    positives.append(left[a:b])
                    least, gone = 0.6 * top, set(left[a:b])
                    left = [w for w in left if w not in gone]
                    if not left:
                        break
            else:
                hard.append(bag[a:b])
                for at in rng.integers(0, len(bag), 3).tolist():
                    chance.append(bag[at : at + 1 + at % WINDOW])
        value = model.known.__getitem__
        main = [max((w for w in p if len(w) >= 4), key=value, default=None) for p in positives]
        hidden = [[_altered(w, rng)] for w in main if w]
        marks = _landmarks(positives, LANDMARKS // 2, 500) + _landmarks([[w] for w in main if w], LANDMARKS // 4, 250) + _landmarks(hard, LANDMARKS // 4, 250)
        model = _machine(positives + hidden, hard + chance, marks)
    return model


def _contrast(bags: list[list[str]], labels: np.ndarray) -> np.ndarray:
    """For each subsequence the difference of its means over toxic and clean texts, by its spread."""
    index: dict[str, int] = {}
    ids = [np.array([index.setdefault(w, len(index)) for w in dict.fromkeys(bag)], np.int64) for bag in bags]
    part = np.zeros((2, len(index)))
    for k, y in zip(ids, labels, strict=True):
        part[y, k] += 1 / max(1, k.size)
    part /= np.maximum(1, np.bincount(labels, minlength=2))[:, None]
    codes, out, square, total = _first_rows(list(index)), np.zeros((2, SIZE)), np.zeros(SIZE), part.sum(0)
    length = np.full(len(codes), 1e-12)
    for ids_, weight in features(codes):
        length += weight * weight * (ids_ > 0)
    for ids_, weight in features(codes):
        value = weight / np.sqrt(length)
        for y in (0, 1):
            out[y] += np.bincount(ids_, part[y] * value, SIZE)
        square += np.bincount(ids_, total * value * value, SIZE)
    weights = (out[1] - out[0]) / np.sqrt(square + 1e-4)
    weights[0] = 0
    return weights.astype(np.float32)


def train(rows: list[tuple[str, int]], share: float | None = None, seed: int = 7) -> Model:
    """Learn from (text, toxic) rows: the mean of FOLDS machines, each trained without one part of them.

    The odds come from decisions on the parts left out; ``share`` is the part of all labelled texts
    that is toxic, if the rows are dealt otherwise.
    """
    labels, fold = np.array([y for _, y in rows], float), np.random.default_rng(seed).permutation(len(rows)) % FOLDS
    found, machines = np.full((len(rows), EVIDENCE), np.nan), []
    for k in range(FOLDS):
        part = train_machine([r for r, f in zip(rows, fold, strict=True) if f != k], seed + k)
        if part:
            found[fold == k] = part.decide([tokens_of(t) for (t, _), f in zip(rows, fold, strict=True) if f == k])[0]
            machines.append(part)
    if not machines:
        return Model(np.zeros(SIZE, np.float32), odds=(0.0, 0.0, 0.0, -3.0 if labels.sum() * 2 <= labels.size else 3.0))
    judged = ~np.isnan(found[:, 0])
    share = labels.mean() if share is None else share
    weight = np.where(labels > 0, share / labels.mean(), (1 - share) / (1 - labels.mean()))[judged]
    mean = Model(np.mean([m.weights for m in machines], 0), float(np.mean([m.bias for m in machines])))
    mean.odds = _chosen_odds(found[judged], labels[judged], weight)
    return mean


def _chosen_odds(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """The odds under the cost of a miss that serves best where machines have not trained: the highest
    F-measure that takes recall for twice as important as precision, each part of the rows judged by
    odds from the others."""
    part, best = np.arange(len(y)) % FOLDS, (-1.0, 0.0)
    for cost in MISSED:
        costs, said = np.where(y > 0, cost * weight, weight), np.zeros(len(y), bool)
        for k in range(FOLDS):
            odds = _logistic(x[part != k], y[part != k], costs[part != k])
            said[part == k] = x[part == k] @ np.array(odds[:-1]) + odds[-1] >= 0
        hits = weight[said & (y > 0)].sum()
        best = max(best, (round(5 * hits / max(weight[said].sum() + 4 * weight[y > 0].sum(), 1e-9), 9), -cost))
    return _logistic(x, y, np.where(y > 0, -best[1] * weight, weight))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Slopes and offset of the odds (Newton steps, slightly ridged; a slope that would be negative is 0)."""
    used = np.ones(x.shape[1], bool)
    while True:
        rows, a = np.c_[x[:, used], np.ones(len(y))], np.zeros(used.sum() + 1)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
            s = weight * (p * (1 - p) + 1e-6)
            step = np.linalg.solve((rows * s[:, None]).T @ rows + 0.05 * np.eye(len(a)), rows.T @ (weight * (p - y)) + 0.05 * np.r_[a[:-1], 0])
            a -= np.clip(step, -2, 2)
        if (a[:-1] >= 0).all():
            break
        used[np.flatnonzero(used)[np.argmin(a[:-1])]] = False
    out = np.zeros(x.shape[1])
    out[used] = a[:-1]
    return (*out.tolist(), float(a[-1]))


def held_out(doc_id):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[tuple[str, int]], float]:
    """At most ``sample`` labelled texts of each class, by a hash of their id, and the toxic share of
    all labelled rows; held-out ids never."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0]
    parts = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    few = parts[0].unionByName(parts[1])  # bounded: two times the sample
    # one text of each id, the first by a hash of it, so that repeated ids add no rows
    got = doc_texts(docs).join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return [(r["text"], int(r["toxic"])) for r in sorted(got.collect(), key=lambda r: (r["doc_id"], r["text"]))], share


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Operator: doc_id, held_out, score and predicted of each whole text.

    The model is fitted on a bounded sample of labelled rows and sent with the tasks (its size is
    fixed). Null and empty texts have no words and get the lowest score; repeated rows are scored
    each; without labels of both classes all scores are alike; an empty table gives no rows. A
    null doc_id is not held out.
    """
    model = train(*training_rows(docs, labels, sample))
    model.known = {}

    def run(rows):
        score = model.score(rows["text"])
        return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": score, "predicted": [int(s >= 0.5) for s in score]}

    return map_rows(doc_texts(docs, F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out")), run, "doc_id long, held_out boolean, score double, predicted int")
