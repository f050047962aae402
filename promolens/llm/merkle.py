"""Merkle manifest of a dataset: blocks of ordered nodes collapse level by level in SQL functions.

A tree of any size is a few rounds of blocks: nodes get their place in the tree, blocks of
ARITY ** LEVELS consecutive ones become arrays, and sequence, transform, slice and aggregate
collapse LEVELS levels at once. The blocks' roots are the next round's nodes. On the way back
every node gets its siblings up to the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import materialise

#: Nodes that become one, and levels that a block collapses.
ARITY, LEVELS = 3, 6
POWERS = [ARITY**k for k in range(LEVELS)]
#: The columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def counted(value: Column) -> Column:
    """A value as byte count, colon and text; a null as a dash, so that no two rows read the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column, others: tuple[str, ...] = FIELDS[:-1]) -> Column:
    return F.sha2(F.concat(*[counted(F.col(c)) for c in others], counted(text)), 256)


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their place ``pos`` within ``tree`` and the tree's size ``count``, in this order.

    Rows are dealt by ranges of tree and order, so a large tree spreads over many tasks; a row's
    place is the number of its tree's rows in the ranges before, and in its own before it. Equal
    rows are told apart by where they were read, so that ranges part them too.
    """
    dealt = nodes.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "_read").sortWithinPartitions("tree", *order, "_read").drop("_read")
    rows = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "merkle-order")
    parts = rows.groupBy("tree", "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy("tree")).alias("count"))
    # a row a range and tree: as many as ranges and trees together, and dealt as evenly as the ranges
    return rows.join(parts, ["tree", "_part"]).withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")


def _upto(n: Column) -> Column:
    """0, 1, ... n - 1 for n of at least one."""
    return F.sequence(F.lit(0), n - 1)


def _joined(nodes: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(nodes, start + 1, length), "")


def collapse(nodes: Column) -> Column:
    """One level up: the hash of every ARITY consecutive nodes."""
    return F.transform(_upto(F.ceil(F.size(nodes) / ARITY).cast("int")), lambda run: F.sha2(_joined(nodes, run * ARITY, F.lit(ARITY)), 256))


def levels_of(nodes: Column, steps: Column) -> Column:
    """The nodes, and the levels that grow from them in so many steps."""
    return F.aggregate(F.slice(F.array(*map(F.lit, POWERS)), F.lit(1), steps), F.array(nodes), lambda grown, _: F.concat(grown, F.array(collapse(F.element_at(grown, -1)))))


def siblings(level: Column, at: Column) -> Column:
    """What stands before and behind a node in its run."""
    inside = at % ARITY
    return F.struct(_joined(level, at - inside, inside).alias("before"), _joined(level, at + 1, F.lit(ARITY - 1) - inside).alias("behind"))


def path_in(levels: Column, at: Column) -> Column:
    """The siblings of a node and of each one above it, up to the last level but one."""
    powers = F.slice(F.array(*map(F.lit, POWERS)), F.lit(1), F.size(levels) - 1)
    return F.transform(powers, lambda power, k: siblings(F.element_at(levels, (k + 1).cast("int")), F.floor(at / power).cast("int")))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["behind"]), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["behind"])), ""), 256)


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, count, nodes, levels): nodes of a block in order, with other columns if asked for."""
    size = ARITY**LEVELS
    steps = sum(((F.col("count") > p).cast("int") for p in POWERS), F.lit(0))
    some = nodes.groupBy("tree", "count", F.floor(F.col("pos") / size).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "node", *carried))).alias("nodes"))
    return some.withColumn("levels", levels_of(F.col("nodes.node"), steps))


def grow(nodes: DataFrame) -> list[DataFrame]:
    """Written rounds of blocks from (tree, pos, count, node, ...), until each tree is one block."""
    size, rounds = ARITY**LEVELS, []
    carried = [c for c in nodes.columns if c not in ("tree", "pos", "count", "node")]
    while True:
        rounds.append(materialise(_blocks(nodes, *carried), f"merkle-round{len(rounds)}"))
        if not rounds[-1].where(F.col("count") > size).limit(1).count():
            return rounds
        above = F.ceil(F.col("count") / size)
        nodes = rounds[-1].select("tree", F.col("block").alias("pos"), above.alias("count"), _top(F.col("levels")).alias("node"))
        carried = []


def _top(levels: Column) -> Column:
    return F.element_at(F.element_at(levels, -1), 1)


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Each first-round block with ``above``: tops' path (tree, path, root, ...) and that through all rounds between.

    Every join is from a block to its own node in the round above, at most ARITY ** LEVELS to one.
    """
    names = [c for c in tops.columns if c not in ("tree", "path")]
    known = tops.select("tree", F.lit(0).cast("long").alias("block"), F.col("path").alias("above"), *names)
    for blocks in reversed(rounds[1:]):
        met = blocks.join(known, ["tree", "block"])
        known = met.select("tree", *names, F.explode(_with_paths(F.col("nodes"), F.col("levels"), F.col("above"))).alias("x")).select("tree", *names, F.col("x.node.pos").alias("block"), F.col("x.path").alias("above"))
        known = materialise(known, "merkle-paths")
    return rounds[0].join(known, ["tree", "block"])


def _with_paths(nodes: Column, levels: Column, above: Column) -> Column:
    """Each node of a block with its whole path. The array of one binds the levels, so that they are worked out once."""
    paths = F.transform(F.array(levels), lambda grown: F.transform(_upto(F.size(F.element_at(grown, 1))), lambda at: F.concat(path_in(grown, at), above)))
    return F.transform(F.arrays_zip(nodes.alias("node"), F.element_at(paths, 1).alias("path")), lambda x: x)


def tampered(text: Column) -> Column:
    """What an attacker makes of a text here: the line ends are gone."""
    return F.translate(text, "\n", "")


def manifest(docs: DataFrame) -> DataFrame:
    """Each document's leaf, its source's subroot, the root, and the path of siblings between: doc_id, tree, leaf, other_leaf, subroot, root, path.

    ``other_leaf`` is the leaf of the tampered text where the id's checksum is even, else null.
    """
    odd = F.crc32(F.col("doc_id").cast("string")) % 2
    leaf, other = leaf_hash(F.col("text")), F.when((odd == 0) & F.col("text").contains("\n"), leaf_hash(tampered(F.col("text"))))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))  # null first, then bytewise
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("node"), other.alias("other_leaf"))
    rounds = grow(ranked(leaves.withColumn("_null", F.col("doc_id").isNull()), ["_null", "doc_id", "node"]).drop("_null"))
    last = rounds[-1].select(F.col("tree").alias("source"), _top(F.col("levels")).alias("node"))
    over = grow(ranked(last.select(F.lit("").alias("tree"), "source", "node"), ["source"]))
    root = over[-1].select("tree", _top(F.col("levels")).alias("root"), F.array().cast("array<struct<before:string,behind:string>>").alias("path"))
    tops = descend(over, root).select("root", F.explode(_with_paths(F.col("nodes"), F.col("levels"), F.col("above"))).alias("x"))
    tops = materialise(tops.select(F.col("x.node.source").alias("tree"), F.col("x.node.node").alias("subroot"), "root", F.col("x.path").alias("path")), "merkle-sources")
    met = descend(rounds, tops).select("tree", "subroot", "root", F.explode(_with_paths(F.col("nodes"), F.col("levels"), F.col("above"))).alias("x"))
    return met.select(F.col("x.node.doc_id").alias("doc_id"), "tree", F.col("x.node.node").alias("leaf"), F.col("x.node.other_leaf").alias("other_leaf"), "subroot", "root", F.col("x.path").alias("path"))


def verify_manifest(docs: DataFrame) -> DataFrame:
    """Operator: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each document.

    A tree a source, its leaves by doc_id (null ids last, equal ids by leaf, so equal rows share
    no place but any may have either); the sources' roots make the last tree. Null and empty
    values differ in the leaf; a text without line ends can't be tampered with and stays verified,
    as do null ids; a lone document is its own root and has no siblings; other columns are no part
    of a leaf; an empty table gives no rows.
    """
    found = manifest(docs)
    folded = fold(F.coalesce("other_leaf", "leaf"), F.col("path"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
