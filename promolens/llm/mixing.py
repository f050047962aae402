"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import materialise

#: Weights dealt to the sources in code point order, the share of all words that the mix takes,
#: and how often a document may be repeated at most.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Bits of the hash that one histogram resolves, and the number of nested histograms.
BITS, LEVELS = 10, 5
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) to target: water filling in closed form.

    Capped sources are those of the smallest cap/weight, so running sums in that order give
    the level of each prefix of capped sources; levels rise up to the right prefix and fall
    behind it, so the highest is the one. The windows run over one row a source, never over
    documents; the number of sources must fit one task.
    """
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.select("source", "source_size", w.alias("w")).withColumn("cap", most * F.col("source_size").cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    t = t.withColumn("level", (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    return t.select("source", "source_size", F.least("cap", F.col("w") * F.max("level").over(every)).alias("target"))


def plan_mix(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """A row a source: full copies of all its documents, and the hash below which one more is taken.

    Level by level the words of each source are summed by the next BITS of the hash; budgets
    end inside one bucket, the boundary, and only its documents reach the next histogram. At
    the last level the boundary bucket is taken whole if that comes nearer to the target.
    """
    state = targets.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("copies"))
    state = state.withColumn("rest", F.when(F.col("copies") >= MOST, 0.0).otherwise(F.col("target") - F.col("copies") * F.col("source_size"))).withColumn("path", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        bucket = F.shiftright(F.col("h"), BITS * (LEVELS - level))
        hist = sized.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("words")) if level == 1 else (
            sized.join(state.select(F.col("source").alias("s"), "path"), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright(F.col("h"), BITS * (LEVELS - level + 1)) == F.col("path")))
            .groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("words")))
        w = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        cut = (
            hist.withColumn("below", F.coalesce(F.sum("words").over(w), F.lit(0)))
            .withColumnRenamed("source", "s")
            .join(state.select("source", "rest"), F.col("s").eqNullSafe(F.col("source")))
            .where(F.col("below") <= F.col("rest"))
            .groupBy("source").agg(F.max_by(F.struct("b", "below", "words"), F.col("b")).alias("x"))
            .select(F.col("source").alias("s"), F.col("x.b").alias("b"), F.col("x.below").alias("below"), F.col("x.words").alias("in_cut"))
        )
        # a source without documents in the boundary keeps its path extended by zero bits
        state = state.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("path", F.coalesce("b", F.shiftleft("path", BITS))).withColumn("rest", F.col("rest") - F.coalesce("below", F.lit(0)))
        state = state.drop("words").withColumn("words", F.coalesce("in_cut", F.lit(0))).select("source", "source_size", "target", "copies", "rest", "path", "words")
        state = materialise(state, f"mix-level{level}")
    whole = (F.col("words") > 0) & (2 * F.col("rest") > F.col("words"))
    return state.select("source", "source_size", "target", "copies", (F.col("path") + F.when(whole, 1).otherwise(0)).alias("below_h"))


def sized_documents(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size and a hash of id and text; nothing hangs on the order or place of rows."""
    h = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.shiftrightunsigned(h, 64 - BITS * LEVELS).alias("h"), *more,
    )


def dealt(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan's columns, copies and taken for sized rows."""
    copies = F.least(F.lit(MOST), F.col("copies") + F.when(F.col("h") < F.col("below_h"), 1).otherwise(0)).cast("long")
    met = sized.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return met.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def fit_mix(sized: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    return plan_mix(sized, materialise(targets, "mix-targets"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """Operator: doc_id, source, size, source_size, target, copies and taken of each document.

    A document's fate hangs on a hash of its id and text, so reruns agree and no sort is
    needed; identical rows share theirs. A null text has size 0, a null source is a source of
    its own, an empty table gives no rows. A source of one huge document is taken as often as
    comes nearest to its target.
    """
    sized = materialise(sized_documents(docs), "mix-sizes")
    return dealt(sized, fit_mix(sized, weights, share)).drop("h", "below_h")


def take_mix(docs: DataFrame, columns: tuple[str, ...], weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix itself: each document as many times as it is taken. The texts are not shuffled."""
    plan = fit_mix(materialise(sized_documents(docs), "mix-sizes"), weights, share)
    rows = dealt(sized_documents(docs, *[F.col(c).alias(f"_{c}") for c in columns]), plan).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col(f"_{c}").alias(c) for c in columns])
