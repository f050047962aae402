"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import SPACE, U64, arrow_batches, byte_class, doc_texts, flat_text, materialise, mix, span_hashes, spans

SYMBOLS, UPPER = byte_class(b"#*$%&|<>"), byte_class(range(0x41, 0x5B))
LETTER = byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)])
LOUD, NEWLINE = byte_class(b"!?"), byte_class(b"\n")
GRAM, LEAST_WORDS, MOST_REPEAT_PERCENT = 8, 20, 30
STOP = byte_class(b".!?")
BAD, GOOD, ABSTAIN = range(3)
#: What is expected of every rule before any text is seen: how often it objects to texts with the fault it is made
#: for, to texts with another fault and to good ones; the share of texts with a fault. It counts as so many texts.
OWN, OTHER, ALARM, SHARE, COUNTS_AS = 0.8, 0.2, 0.05, 0.1, 20.0
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_loud", "n_wordless", "n_stutters", "n_ends")


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _again(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: does its (row, key) occur twice or more; is it not the first?"""
    order = np.lexsort((np.arange(row.size), key, row))
    r, k = row[order], key[order]
    same = np.zeros(row.size + 1, bool)
    same[1:-1] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    twice, later = np.zeros(row.size, bool), np.zeros(row.size, bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return twice, later


def text_features(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """FEATURES of each row of a flat text column, for all rows at once."""
    rows = off.size - 1
    inside = ~SPACE[data]
    start, end = spans(inside, off)
    first = np.searchsorted(start, off)
    out = {"n_words": np.diff(first), "word_chars": _sums(inside & ((data & 0xC0) != 0x80), off)}
    for name, flags in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_letters", LETTER), ("n_loud", LOUD)):
        out[name] = _sums(flags[data], off)
    # words without a letter, words equal to the one before, stops that end a word
    row = np.repeat(np.arange(rows), np.diff(first))
    hashes = span_hashes(data, start, end)
    letters = np.concatenate([[0], np.cumsum(LETTER[data], dtype=np.int64)])
    out["n_wordless"] = np.bincount(row[letters[end] == letters[start]], minlength=rows)
    out["n_stutters"] = np.bincount(row[1:][(hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])], minlength=rows)
    out["n_ends"] = np.bincount(row[STOP[data[end - 1]]] if end.size else row, minlength=rows)
    # lines with a word, equal to an earlier line of the same text
    low, high = spans(~NEWLINE[data], off)
    has = np.searchsorted(start, high) > np.searchsorted(end, low, "right")
    low, high = low[has], high[has]
    of = np.searchsorted(off, low, "right") - 1
    out["n_lines"] = np.bincount(of, minlength=rows)
    out["n_dup_lines"] = np.bincount(of[_again(of, span_hashes(data, low, high))[1]], minlength=rows)
    # words inside windows of GRAM words that the text holds twice or more
    out["n_repeat_words"] = np.zeros(rows, np.int64)
    if start.size >= GRAM:
        window = np.zeros(start.size - GRAM + 1, np.uint64)
        for k in range(GRAM):
            window = mix(window * U64(0x9E3779B97F4A7C15) + hashes[k : k + window.size])
        whole = np.flatnonzero(row[: window.size] == row[GRAM - 1 :])
        twice = whole[_again(row[whole], window[whole])[0]]
        cover = np.zeros(start.size + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + GRAM, -1)
        out["n_repeat_words"] = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=rows)
    return {k: out[k].astype(np.int64) for k in FEATURES}


def measure(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and FEATURES of each whole text, with other columns of the table if asked for."""
    arrow_batches(docs.sparkSession)
    kept = [F.col(c).alias(f"_{c}") for c in carry]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = text_features(*flat_text(batch.column("text")))
                given = [batch.column("doc_id"), *(batch.column(f"_{c}") for c in carry)]
                yield pa.RecordBatch.from_arrays([*given, *(pa.array(found[k]) for k in FEATURES)], ["doc_id", *(f"_{c}" for c in carry), *FEATURES])

    chosen = doc_texts(docs, *kept)
    types = "".join(f", _{c} {chosen.schema[f'_{c}'].dataType.simpleString()}" for c in carry)
    return chosen.mapInArrow(run, f"doc_id long{types}, " + ", ".join(f"{k} long" for k in FEATURES))


def rules() -> list[tuple[str, object, object]]:
    """(name, objects, approves): what comes first counts, none is to abstain.

    Rules look at texts from many sides and no fault is left to one of them alone, so that the
    model can tell from their agreement which are to be trusted. What can't but come together, as
    repeated lines and repeated passages, is one rule with one vote.
    """
    c = F.col
    one = F.lit(1)
    words, lines, letters, chars, ends = (F.greatest(c(x), one) for x in ("n_words", "n_lines", "n_letters", "word_chars", "n_ends"))
    length, sentence = c("word_chars") / words, words / ends
    return [
        ("length", c("n_words") < LEAST_WORDS, c("n_words") >= 100),
        ("symbols", c("n_symbols") > 0.1 * words, c("n_symbols") == 0),
        ("letters", c("n_letters") < 0.8 * chars, c("n_letters") > 0.9 * chars),
        ("wordless", c("n_wordless") > 0.2 * words, c("n_wordless") < 0.05 * words),
        ("word_length", ~length.between(3.5, 7), length.between(4.5, 6)),
        ("repeats", (c("n_repeat_words") > 0.1 * words) | (c("n_dup_lines") > 0.2 * lines), c("n_repeat_words") == 0),
        ("stutters", c("n_stutters") > 0.1 * words, c("n_stutters") < 0.02 * words),
        ("capitals", c("n_upper") > 0.2 * letters, c("n_upper") < 0.05 * letters),
        ("loudness", c("n_loud") > 0.05 * words, c("n_loud") < 0.01 * words),
        ("sentences", (sentence > 60) | (sentence < 3), sentence.between(5, 30)),
    ]


def label_model(votes: np.ndarray, weight: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of good quality for each vote pattern, and each rule's accuracy.

    A text is good or has one of as many faults as there are rules. On each kind every rule objects
    at a rate of its own; to abstain says nothing. Expectation-maximisation begins with the same
    expectation of all rules, under which several must object together, and learns from the table
    how frequent each fault is, which rules object to it together, and how often each cries wolf:
    a rule that objects where others do comes to suffice alone, one that objects at random loses
    its vote. No rule objects to a fault less than to good texts. A few texts' worth of expectation
    keeps small tables near the first round.
    """
    n = votes.shape[1]
    if not votes.size:
        return np.zeros(0), np.zeros(n)
    expected = np.full((n + 1, n), OTHER)
    expected[0], expected[np.arange(1, n + 1), np.arange(n)] = ALARM, OWN
    begin = np.r_[1 - SHARE, np.full(n, SHARE / n)]
    rate, share, good = expected.copy(), begin, np.full(len(votes), -1.0)
    objects, approves = ((votes == k).astype(float) for k in (BAD, GOOD))
    for _ in range(rounds):
        likely = objects @ np.log(rate.T) + approves @ np.log1p(-rate.T) + np.log(share)
        kind = np.exp(likely - likely.max(1, keepdims=True))
        kind /= kind.sum(1, keepdims=True)
        change, good = np.abs(kind[:, 0] - good).max(), kind[:, 0]
        if change < 1e-9:
            break
        counted = (kind * weight[:, None]).T
        against, along = counted @ objects + COUNTS_AS * expected, counted @ approves + COUNTS_AS * (1 - expected)
        rate = against / (against + along)
        rate[1:] = np.maximum(rate[1:], rate[0])
        share = counted.sum(1) + COUNTS_AS * begin
        share /= share.sum()
    return good, share[1:] @ rate[1:] + share[0] * (1 - rate[0])


def judge(seen: DataFrame, fitted_on: DataFrame, least: float = 0.5) -> DataFrame:
    """base_failed, quality and kept for rows of FEATURES, by a label model of all rows of another table.

    Votes are counted by pattern (at most 3 to the power of the rules), so what reaches the driver
    and goes back has a fixed bound.
    """
    names = rules()
    true = lambda x: F.coalesce(x, F.lit(False))
    vote = [F.when(true(bad), BAD).when(true(good), GOOD).otherwise(ABSTAIN) for _, bad, good in names]
    key = sum((v * 3**k for k, v in enumerate(vote)), F.lit(0)).cast("int")
    counted = fitted_on.groupBy(key.alias("pattern")).agg(F.count("*").alias("n")).orderBy("pattern").collect()  # at most 3**10 rows
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    votes = np.stack([patterns // 3**k % 3 for k in range(len(names))], 1) if counted else np.zeros((0, len(names)), np.int64)
    good, _ = label_model(votes, np.array([r["n"] for r in counted], float))
    found = [(int(k), float(g)) for k, g in zip(patterns, good, strict=True)]
    table = seen.sparkSession.createDataFrame(found, "vote_pattern int, quality double")  # as many rows as patterns
    seen = seen.withColumn("vote_pattern", key).join(F.broadcast(table), "vote_pattern", "left").drop("vote_pattern")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    out = seen.withColumn("base_failed", failed).withColumn("quality", F.coalesce("quality", F.lit(0.0)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def judge_quality(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Operator: FEATURES, base_failed, the posterior and the verdict of each document.

    Null and empty texts have no words and fail the base rules; repeated rows count each; an empty
    table gives no rows. Features are written once, so the texts are read once.
    """
    seen = materialise(measure(docs), "quality")
    return judge(seen, seen, least)


def keep_good(docs: DataFrame, columns: tuple[str, ...], least: float = 0.5) -> DataFrame:
    """The documents that judge_quality keeps. The texts are read twice instead of being shuffled."""
    seen = materialise(measure(docs), "quality")
    return judge(measure(docs, columns), seen, least).where("kept").select(*[F.col(f"_{c}").alias(c) for c in columns])
