"""Likeness of names at scale: bit-parallel common subsequences, pairs scored in Arrow batches, the nearest names in blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of either side that one task compares at most, and choices that are scored at once.
BLOCK, STEP = 2000, 256
#: Partitions that cells are dealt to at most.
TASKS = 20_000


def masks(text: str) -> dict[str, int]:
    """For each letter the places where it stands, as bits."""
    out: dict[str, int] = {}
    for k, ch in enumerate(text):
        out[ch] = out.get(ch, 0) | 1 << k
    return out


def common(at: dict[str, int], length: int, other: str) -> int:
    """Length of the longest common subsequence: one addition of whole rows for each letter."""
    whole = (1 << length) - 1
    row = whole
    for ch in other:
        hit = row & at.get(ch, 0)
        row = ((row + hit) | (row - hit)) & whole
    return length - row.bit_count()


def share(part: int, total: int) -> float:
    """200 * part / total, half up at the fourth digit; 100 of nothing."""
    return (4_000_000 * part + total) // (2 * total) / 10_000 if total else 100.0


class Sorted:
    """names whose words the caller has sorted."""

    empty = 100.0

    def __init__(self, name: str) -> None:
        self.name, self.at = name, masks(name)

    def score(self, other: Sorted) -> float:
        n, m = len(self.name), len(other.name)
        return share(common(self.at, n, other.name), n + m)

    def scores(self, choices: Choices, some: np.ndarray) -> np.ndarray:
        """Scores of some choices at once: the rows of all are 64-bit words that take a letter a step."""
        n = len(self.name)
        if n > 64:
            return np.array([self.score(choices.made[j]) for j in some])
        at = np.zeros(len(choices.letters) + 1, np.uint64)  # the last is no letter, and changes nothing
        for ch, places in self.at.items():
            at[choices.letters.get(ch, -1)] = places
        at[-1] = 0
        whole = np.uint64((1 << n) - 1)
        row = np.full(some.size, whole)
        for codes in choices.codes[: choices.lengths[some].max(initial=0), some]:
            hit = row & at[codes]
            row = ((row + hit) | (row - hit)) & whole
        total = n + choices.lengths[some]
        part = n - np.bitwise_count(row).astype(np.int64)
        return np.where(total == 0, 100.0, (4_000_000 * part + total) // np.maximum(2 * total, 1) / 10_000)

    def most(self, shared: np.ndarray, lengths: np.ndarray, others: list[Sorted]) -> np.ndarray:
        """No score is above what the letters that both have allow."""
        total = np.maximum(len(self.name) + lengths, 1)
        return np.where(len(self.name) + lengths == 0, 100.0, (4_000_000 * shared + total) // (2 * total) / 10_000)


class WordSet:
    """names as sets of words between blanks, as they stand."""

    empty = 0.0

    def __init__(self, name: str) -> None:
        self.words = set(name.split())
        self.name = " ".join(sorted(self.words))

    def score(self, other: WordSet) -> float:
        both, left, right = self.words & other.words, self.words - other.words, other.words - self.words
        if both and (not left or not right):
            return 100.0
        a, b, n = " ".join(sorted(left)), " ".join(sorted(right)), len(" ".join(both))
        gap = 1 if n else 0
        whole = 2 * n + 2 * gap + len(a) + len(b)
        if not whole:
            return self.empty
        # what both have counts whole on either side; words added to one side alone are a distance from it
        ends = share(n + gap + common(masks(a), len(a), b), whole)
        return max(ends, *(share(n, 2 * n + gap + len(x)) for x in (a, b))) if n else ends

    def scores(self, choices: Choices, some: np.ndarray) -> np.ndarray:
        return np.array([self.score(choices.made[j]) for j in some])

    def most(self, shared: np.ndarray, lengths: np.ndarray, others: list[WordSet]) -> np.ndarray:
        out = Sorted.most(self, shared, lengths, [])
        alike = np.array([not self.words.isdisjoint(o.words) for o in others], bool)
        return np.where(alike, 100.0, out)


KINDS = {"sorted": Sorted, "words": WordSet}


def scored(pairs: DataFrame, kind: str = "sorted") -> DataFrame:
    """(a, b) with their score in percent, four digits."""
    made = KINDS[kind]

    def run(batches):
        known: dict[str, Sorted | WordSet] = {}
        for batch in batches:
            if len(known) > 100_000:
                known.clear()
            columns = [[known.get(x) or known.setdefault(x, made(x)) for x in batch.column(c).to_pylist()] for c in ("a", "b")]
            found = pa.array([x.score(y) for x, y in zip(*columns, strict=True)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), found], ["a", "b", "score"])

    return pairs.select("a", "b").mapInArrow(run, "a string, b string, score double")


class Choices:
    """A block of choices: their letters as numbers, counted and in order."""

    def __init__(self, made: list) -> None:
        self.made, names = made, [c.name for c in made]
        self.letters = {ch: k for k, ch in enumerate(sorted({ch for n in names for ch in n}))}
        self.lengths = np.array([len(n) for n in names])
        self.counts = np.zeros((len(self.letters), len(names)), np.int32)
        self.codes = np.full((self.lengths.max(initial=0), len(names)), len(self.letters), np.int32)
        for k, n in enumerate(names):
            self.codes[: len(n), k] = [self.letters[ch] for ch in n]
            for ch, count in Counter(n).items():
                self.counts[self.letters[ch], k] = count

    def shared(self, name: str) -> np.ndarray:
        """How many letters each choice has in common with a name, in whatever order."""
        out = np.zeros(len(self.made), np.int32)
        for ch, count in Counter(name).items():
            if ch in self.letters:
                out += np.minimum(self.counts[self.letters[ch]], count)
        return out


def _cell(kind: str, most: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """The best of one block of choices for each name of one block of names."""
    made = KINDS[kind]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame["side"] == 0]["name"].tolist(), frame[frame["side"] == 1].sort_values("place")
        out = []
        if left and len(right):
            choices, names, place = Choices([made(x) for x in right["name"]]), right["name"].tolist(), right["place"].tolist()
            for a in left:
                name = made(a)
                bound = name.most(choices.shared(name.name), choices.lengths, choices.made)
                best, scores = np.zeros(0, np.int64), np.zeros(0)
                rest, step = np.argsort(-bound, kind="stable"), STEP // 8
                while rest.size:
                    some, rest = rest[:step], rest[step:]
                    best, scores = np.concatenate([best, some]), np.concatenate([scores, name.scores(choices, some)])
                    top = np.lexsort((best, -scores))[:most]  # choices stand in order of their places
                    best, scores, step = best[top], scores[top], STEP
                    if best.size == most:
                        rest = rest[bound[rest] >= scores[-1]]  # others can't reach the worst that is kept
                out += [(key[0], a, names[j], place[j], s) for j, s in zip(best.tolist(), scores.tolist(), strict=True)]
        return pd.DataFrame(out, columns=["city_code", "a", "b", "place", "score"])

    return run


def nearest(names: DataFrame, choices: DataFrame, most: int, kind: str = "sorted", block: int | None = None) -> DataFrame:
    """For each (city_code, a) its ``most`` best choices: city_code, a, best (score, place, b), best first.

    choices: city_code, b and place, an ordinal that settles ties. Names and choices of a city are
    dealt to blocks, every block of names meets every block of choices in a task of its own, and
    pairs never leave it; a choice is scored only while the letters it shares could lift it among
    the best, so the result is that of scoring all.
    """
    size = BLOCK if block is None else block
    blocks = lambda df: df.groupBy("city_code").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
    counts = blocks(names).withColumnRenamed("n", "i").join(blocks(choices).withColumnRenamed("n", "j"), "city_code")  # a row a city
    dealt = lambda n, *c: F.pmod(F.xxhash64(*c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = names.join(counts, "city_code").select("city_code", F.lit(0).alias("side"), F.col("a").alias("name"), F.lit(0).cast("long").alias("place"), dealt("i", "a").alias("x"), every("j").alias("y"))
    right = choices.join(counts, "city_code").select("city_code", F.lit(1).alias("side"), F.col("b").alias("name"), F.col("place").cast("long").alias("place"), every("i").alias("x"), dealt("j", "b", "place").alias("y"))
    # a partition for each cell, as work grows with pairs and not with bytes; their number is bounded
    tasks = min(counts.agg(F.coalesce(F.sum(F.col("i").cast("long") * F.col("j")), F.lit(1))).first()[0], TASKS)
    cells = left.unionByName(right).repartition(tasks, "city_code", "x", "y").groupBy("city_code", "x", "y").applyInPandas(_cell(kind, most), "city_code string, a string, b string, place long, score double")
    order: Column = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "place", "b")))
    best = cells.groupBy("city_code", "a").agg(F.slice(order, 1, most).alias("x"))
    return best.select("city_code", "a", F.transform("x", lambda r: F.struct((-r["low"]).alias("score"), r["place"].alias("place"), r["b"].alias("b"))).alias("best"))
