"""Near-duplicate documents by bottom-k sketches from one hash function."""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import SPACE, U64, arrow_batches, discard, flat_text, materialise, mix, span_hashes, spans
from promolens.llm.graph import components, contract, forest, link_edges, nearest

#: Values that a sketch keeps, and the chance at which a link may be lost. For a similarity of 0.8
#: the shared ones of two sketches are binomial (40, 0.8) at worst: 15 at least but for 1e-9.
SKETCH, MISS = 40, 1e-9
#: Members of a group that a task compares with a chunk of the others.
BLOCK, CHUNK = 128, 512
#: Longs of the bit map that stands for a sketch: a bit for each value.
MAP = ("b0", "b1", "b2", "b3")
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; fewer words than width are one shingle."""
    data = _LOWER[data]
    start, end = spans(~SPACE[data], off)
    first = np.searchsorted(start, off)
    words = span_hashes(data, start, end)
    grams = np.zeros(max(0, words.size - width + 1), np.uint64)
    for k in range(width):
        grams = mix(grams * U64(0x9E3779B97F4A7C15) + words[k : k + grams.size])
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            few = np.zeros(1, np.uint64)
            for w in words[a:b]:
                few = mix(few * U64(0xC2B2AE3D27D4EB4F) + w)
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bit_maps(lows: list[np.ndarray]) -> list[np.ndarray]:
    """The longs of MAP for each sketch: which of 256 places the low bits of its values mark."""
    marks = np.zeros((len(lows), 256), np.uint8)
    marks[np.repeat(np.arange(len(lows)), [x.size for x in lows]), (np.concatenate([*lows, np.zeros(0, np.uint64)]) & U64(255)).astype(np.int64)] = 1
    return list(np.packbits(marks, axis=1).view(np.int64).T)


def sketch_documents(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, size and digest of the shingle set, its SKETCH smallest values and their bit map (null digest: no words)."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sets = shingle_sets(*flat_text(batch.column("text")), width)
                keys = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if s.size else None for s in sets], pa.binary())
                low = pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64()))
                maps = [pa.array(np.ascontiguousarray(x)) for x in bit_maps([s[:SKETCH] for s in sets])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array([s.size for s in sets], pa.int64()), keys, low, *maps], ["doc_id", "th", "n", "key", "low", *MAP])

    return _hashed(docs).mapInArrow(run, "doc_id long, th long, n long, key binary, low array<long>, " + ", ".join(f"{b} long" for b in MAP))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def shared_least(similarity: float, miss: float = MISS) -> int:
    """Values that the sketches of large similar sets share, but for a chance of ``miss`` at most."""
    total = 0.0
    for c in range(SKETCH + 1):
        total += comb(SKETCH, c) * similarity**c * (1 - similarity) ** (SKETCH - c)
        if total > miss:
            return max(1, c)
    return SKETCH


def needed(n_a, n_b, similarity: float):
    """Values that two sketches share at least: sets that are kept whole share their similarity's part."""
    whole = F.ceil(F.lit(similarity) * F.greatest(n_a, n_b) - 1e-9)
    return F.when(F.greatest(n_a, n_b) <= SKETCH, whole).otherwise(shared_least(similarity)).cast("int")


def needed_of_any(n, similarity: float):
    """The same for a set and any partner; only a small one has none with a cut sketch."""
    least = F.least(F.lit(shared_least(similarity)), F.ceil(F.lit(similarity) * n - 1e-9))
    return F.when(n <= similarity * SKETCH, F.ceil(F.lit(similarity) * n - 1e-9)).otherwise(least).cast("int")


def postings(classes: DataFrame, similarity: float) -> DataFrame:
    """Inverted lists: the rarest values of each sketch, so many that similar sketches share one.

    Two sketches of k values that share c of them share one of any k - c + 1 that come first in
    an order common to both. Rare values come first, so a line or word pair that a third of all
    documents hold makes no list unless nothing else is left.
    """
    each = classes.select("id", F.col("n").cast("int").alias("n"), F.explode("low").alias("v"))
    often = each.groupBy("v").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    ranked = each.join(often, "v").withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("df", "v")))
    # values of no other sketch come before these and have no list; the prefix is cut by what they leave
    alone = F.least(F.col("n"), F.lit(SKETCH)) - F.count("*").over(Window.partitionBy("id"))
    prefix = F.least(F.col("n"), F.lit(SKETCH)) - needed_of_any(F.col("n"), similarity) + 1
    chosen = ranked.withColumn("keep", prefix - alone).where(F.col("r") <= F.col("keep")).select("v", "id")
    return chosen.join(classes.select("id", "n", *MAP), "id")


def possible(one: str, other: str, similarity: float):
    """Do sizes and bit maps allow a link of the rows under two aliases?

    Places that only one map marks hold a value of only one sketch, so two sketches share no more
    than half of what their sizes leave when these places are taken off.
    """
    n, m = F.col(f"{one}.n"), F.col(f"{other}.n")
    apart = sum((F.bit_count(F.col(f"{one}.{b}").bitwiseXOR(F.col(f"{other}.{b}"))) for b in MAP), F.lit(0))
    room = F.least(n, F.lit(SKETCH)) + F.least(m, F.lit(SKETCH)) - apart
    return (F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - 1e-9) & (room >= 2 * needed(n, m, similarity))


def hopeful(lists: DataFrame, similarity: float) -> DataFrame:
    """Entries whose list has another entry, of another component, that a link is possible with: no pair leaves the join."""
    met = (F.col("x.v") == F.col("y.v")) & (F.col("x.c") != F.col("y.c")) & possible("x", "y", similarity)
    return lists.alias("x").join(lists.alias("y"), met, "left_semi")


def star_pairs(lists: DataFrame, salt: int, similarity: float, one_each: bool) -> DataFrame:
    """Each member of a list with the list's leader, where components differ and a link is possible.

    ``one_each`` leaves each member the first of its leaders only, in an order common to all.
    """
    order = F.xxhash64("id", F.lit(salt))
    leaders = lists.groupBy("v").agg(F.min(F.struct(order.alias("h"), "id", "n", "c", *MAP)).alias("l"), F.min("c").alias("low"), F.max("c").alias("high"))
    leaders = leaders.where(F.col("low") != F.col("high")).select("v", "l.*")
    met = (F.col("x.v") == F.col("y.v")) & (F.col("x.c") != F.col("y.c")) & possible("x", "y", similarity)
    pairs = lists.alias("x").join(leaders.alias("y"), met).select("x.id", "y.h", F.col("y.id").alias("lead"))
    if one_each:
        pairs = pairs.groupBy("id").agg(F.min(F.struct("h", "lead")).alias("l")).select("id", "l.lead")
    return pairs.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()


def _alike(lows: list[np.ndarray], parts: np.ndarray, sizes: np.ndarray, side: np.ndarray, percent: int):
    """Of each left member those right ones in other components whose sketches and sizes allow a link."""
    similarity, least = percent / 100, shared_least(percent / 100)
    right = np.flatnonzero(side == 1)
    if not right.size:
        return
    flat = np.concatenate([lows[k] for k in right])
    order = np.argsort(flat, kind="stable")
    values, holders = flat[order], np.repeat(right, [lows[k].size for k in right])[order]
    for k in np.flatnonzero(side == 0):
        first, last = np.searchsorted(values, lows[k]), np.searchsorted(values, lows[k], "right")
        if not (last > first).any():
            continue
        shared = np.bincount(np.concatenate([holders[x:y] for x, y in zip(first, last, strict=True)]), minlength=side.size)
        small, large = np.minimum(sizes, sizes[k]), np.maximum(sizes, sizes[k])
        need = np.where(large <= SKETCH, np.ceil(similarity * large - 1e-9), least)
        yield k, np.flatnonzero((shared >= need) & (parts != parts[k]) & (small >= similarity * large - 1e-9))


def _meet(width: int, percent: int):
    """A forest of the links between two blocks of texts: no more links than members, whatever pairs there are.

    Sketches tell which full sets are worth comparing; a left member's partners are compared all
    at once, and of those in one component one link is kept.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, parts, sizes, side = (table.column(c).to_numpy() for c in ("id", "c", "n", "side"))
        sets = shingle_sets(*flat_text(table.column("text")), width)
        a, b = [], []
        for k, others in _alike([s[:SKETCH] for s in sets], parts, sizes, side, percent):
            if others.size:
                some = [sets[o] for o in others]
                length = np.array([s.size for s in some])
                flat = np.concatenate(some)
                at = np.minimum(np.searchsorted(sets[k], flat), sets[k].size - 1)
                both = np.add.reduceat((sets[k][at] == flat).astype(np.int64), np.r_[0, np.cumsum(length)[:-1]])
                linked = others[100 * both >= percent * (sets[k].size + length - both)]
                linked = linked[np.unique(parts[linked], return_index=True)[1]]
                a += [k] * linked.size
                b += linked.tolist()
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        some = forest(parts[a], parts[b])
        a, b = ids[a[some]], ids[b[some]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def block_links(lists: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between hopeful members of one list in different components that no star has compared.

    Lists with the same leader, as those of one group of near copies mostly are, become one
    cluster, so a pair is compared once and not in each list. Members of the cluster's most
    frequent component need no pairs among themselves. All others are dealt to blocks; every
    member meets each of these once, in chunks of bounded size. Texts move only here, and only
    those of members that bit maps leave a partner.
    """
    leads = lists.groupBy("v").agg(F.min(F.struct(F.xxhash64("id", F.lit(0)).alias("h"), "id")).alias("l"), F.count("*").alias("members"))
    leads = leads.where(F.col("members") > 2).select("v", F.col("l.id").alias("g"))
    members = materialise(lists.join(leads, "v").select("g", "id", "n", "c").distinct(), "nd-clusters")
    sizes = members.groupBy("g", "c").agg(F.count("*").alias("k")).groupBy("g").agg(F.max(F.struct("k", "c")).alias("m"), F.sum("k").alias("members"))
    sizes = sizes.select("g", F.col("m.c").alias("most"), "members", (F.col("members") - F.col("m.k")).alias("others")).where("others > 0")
    sizes = materialise(sizes, "nd-sizes")  # a table of its own, so that the join alone deals by cluster and a hot one is split
    met = members.join(sizes, "g").withColumn("i", F.ceil(F.col("others") / BLOCK).cast("int")).withColumn("j", F.ceil(F.col("members") / CHUNK).cast("int"))
    hashed = lambda n, salt: F.pmod(F.xxhash64("id", "g", F.lit(salt)), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = met.where("c != most").withColumn("x", hashed("i", 1)).withColumn("y", upto("j")).withColumn("side", F.lit(0))
    right = met.withColumn("x", upto("i")).withColumn("y", hashed("j", 2)).withColumn("side", F.lit(1))
    dealt = left.unionByName(right).select("g", "x", "y", "side", "id", "n", "c").join(texts, "id")
    return dealt.groupBy("g", "x", "y").applyInArrow(_meet(width, percent), "a long, b long")


def likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose sketches share as many values as similar sets do within the sketch of their union."""
    one = classes.select("id", "n", "low")
    met = pairs.join(one.toDF("a", "na", "la"), "a").join(one.toDF("b", "nb", "lb"), "b")
    # the union's sketch: SKETCH smallest of both, in the order of the hash as unsigned values
    order = F.slice(F.array_sort(F.transform(F.array_union("la", "lb"), lambda x: x.bitwiseXOR(F.lit(-(2**63))))), 1, SKETCH)
    top = F.element_at(order, -1)
    inside = F.size(F.filter(F.array_intersect("la", "lb"), lambda x: x.bitwiseXOR(F.lit(-(2**63))) <= top))
    return met.where(inside >= needed(F.col("na"), F.col("nb"), similarity)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets have 100 * intersection >= percent * union."""
    arrow_batches(pairs.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a = shingle_sets(*flat_text(batch.column("ta")), width)
                b = shingle_sets(*flat_text(batch.column("tb")), width)
                both = np.array([np.intersect1d(x, y, assume_unique=True).size for x, y in zip(a, b, strict=True)])
                total = np.array([x.size + y.size for x, y in zip(a, b, strict=True)])
                yield batch.select(["a", "b"]).filter(pa.array(100 * both >= percent * (total - both)))

    met = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return met.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Operator: doc_id, n_shingles, component_id and kept of each document.

    Words are lower-cased (A-Z) and split at blanks; a set holds the shingles of ``width`` words,
    or all words as one if there are fewer. Documents with one and the same set are one class,
    named by their smallest doc_id, and are never paired. Null and empty texts have an empty set
    and are linked with nothing; rows with a null doc_id are their own component, null, and kept;
    repeated rows have one id and so one component; an empty table gives no rows.

    Candidates come from inverted lists: entries whose bit maps rule out any link in their list
    go first, then each member meets its list's leader, and once the links found have been
    contracted, all remaining pairs of a list from different components follow in blocks. The
    sketch of the union filters star pairs, and the full sets (of 64-bit shingle hashes) decide.
    """
    similarity = percent / 100
    rows = materialise(sketch_documents(docs, width), "nd-sketches")
    known = rows.where("key is not null and doc_id is not null")
    classes = known.groupBy("key").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "low", *MAP)])
    classes = materialise(classes, "nd-classes")
    lists = materialise(postings(classes, similarity), "nd-postings")
    # entries that may have a partner at all; the others, the most by far, met by chance
    alive = materialise(hopeful(lists.withColumn("c", F.col("id")), similarity), "nd-hopeful")
    discard(lists)
    lists = materialise(alive.drop("c"), "nd-lists")
    ids = lists.select("id").distinct()
    # the text of a class: one row's, or equal rows'
    reps = known.join(classes.select("key", F.col("id").alias("doc_id")), ["key", "doc_id"]).join(ids.withColumnRenamed("id", "doc_id"), "doc_id").groupBy("doc_id", "key").agg(F.min("th").alias("th"))
    texts = materialise(_hashed(docs).join(reps.select("doc_id", "th"), ["doc_id", "th"]).select(F.col("doc_id").alias("id"), "text").distinct(), "nd-texts")
    member, with_c, edges = F.coalesce("component", "id"), alive, None
    for step, one_each in enumerate((True, False)):  # all edges go on to the next step, so these need not end in whole components
        links = verified(likely(star_pairs(with_c, step, similarity, one_each), classes, similarity), texts, width, percent)
        edges = link_edges(links if edges is None else links.unionByName(edges.toDF("a", "b")))
        for _ in range(step + 1):
            before, edges = edges, contract(edges)
            discard(before)
        parts = nearest(edges).withColumnRenamed("node", "id")
        named = lists.join(parts, "id", "left").select("v", "id", "n", *MAP, member.alias("c"))
        before, with_c = with_c, materialise(named, f"nd-lists{step}")
        discard(before)
    before, with_c = with_c, materialise(hopeful(with_c, similarity), "nd-left")
    parts = components(block_links(with_c, texts, width, percent).unionByName(edges.toDF("a", "b")))
    named = classes.select("key", "id").join(parts.withColumnRenamed("node", "id"), "id", "left")
    by_key = materialise(named.select("key", member.alias("component_id")).distinct(), "nd-components")
    discard(before, lists, with_c, texts, classes)
    keyed = rows.select("doc_id", "n", F.coalesce("key", F.col("doc_id").cast("string").cast("binary")).alias("key"))
    out = keyed.join(by_key, "key", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
