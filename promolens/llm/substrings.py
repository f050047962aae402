"""Removal of byte strings that an earlier document holds as well, by sharded suffix arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import U64, arrow_batches, discard, eight_bytes, flat_text, materialise, mix
from promolens.llm.suffix import SHARD, smallest_owners

#: Bytes of a string that counts, and of the grams whose smallest hash names it. Equal strings have
#: equal smallest grams, so documents that share none share no string.
WIDTH, GRAM = 50, 24
#: Bytes hashed at once, strings named in one packet at most, and bytes of text whose names, and of
#: contexts which, are meant for one task.
PIECE, PACKET, SEED_TASK, TASK = 1 << 20, 1 << 20, 4 << 20, 3 << 20
NULL_ID = 2**63 - 1


def named_runs(data: np.ndarray, width: int = WIDTH):
    """Runs of string starts that have one and the same smallest gram: first start, number, gram hash.

    A run that goes on beyond the end of a piece is one run, so that where runs start hangs on the
    bytes alone and not on how rows fell into batches.
    """
    n = data.size
    first, place, name = [], [], []
    for low in range(0, max(0, n - width + 1), PIECE):
        part = data[low : low + PIECE + width - 1]
        m = mix(eight_bytes(part))
        size = part.size - GRAM + 1
        h = m[:size] * U64(0x9E3779B97F4A7C15) + m[8 : 8 + size] * U64(0xC2B2AE3D27D4EB4F) + m[16 : 16 + size] * U64(0x165667B19E3779F9)
        h = mix(h)
        key = (h & ~U64(PIECE * 2 - 1)) | np.arange(size, dtype=np.uint64)
        reach, best, have = width - GRAM + 1, key, 1
        while have < reach:  # sliding minimum by doubling
            step = min(have, reach - have)
            best = np.minimum(best[:-step], best[step:])
            have += step
        anchor = (best & U64(PIECE * 2 - 1)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        first.append(new + low)
        place.append(anchor[new] + low)
        name.append(h[anchor[new]])
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, place, name = np.concatenate(first), np.concatenate(place), np.concatenate(name)
    new = np.r_[True, place[1:] != place[:-1]]
    first = first[new]
    return first, np.diff(np.r_[first, n - width + 1]), name[new]


def batch_runs(data: np.ndarray, off: np.ndarray, width: int):
    """named_runs of every row of a flat text column: row, first start in the row, number, name."""
    first, count, name = named_runs(data, width)
    row = np.searchsorted(off, first, "right") - 1
    # runs end where strings of the row end, and begin anew in the next row; runs are short
    out = []
    while first.size:
        last = off[row + 1] - width + 1
        inside = np.minimum(first + count, last) - first
        ok = inside > 0
        out.append((row[ok], (first - off[row])[ok], inside[ok], name[ok]))
        over = first + count > off[row + 1]
        begin = off[row + 1][over]
        count, name = (first + count)[over] - begin, name[over]
        first, row = begin, np.searchsorted(off, begin, "right") - 1
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    row, start, count, name = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((start, row))
    return row[order], start[order], count[order], name[order]


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _delta(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def _unpack(blob: bytes, n: int, *types) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorting order of the keys, and where each group of equal ones begins in it."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    return order, np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if key.size else np.zeros(0, np.int64)


def _seed_packets(buckets: int, width: int):
    """Maps texts to packets of (name, document, start, number) for each bucket of names.

    A name that several documents of a packet hold is shared already: all of them are passed on as
    such and one goes to the bucket for the others' sake. So a passage that a third of all
    documents hold sends its bucket one entry for each packet.
    """

    def flush(held):
        doc, start, count, name = (np.concatenate(x) for x in zip(*held, strict=True))
        order, heads = _groups(name)
        low, high = np.minimum.reduceat(doc[order], heads), np.maximum.reduceat(doc[order], heads)
        size = np.diff(np.r_[heads, name.size])
        several = np.repeat(low != high, size)
        lead = np.zeros(name.size, bool)
        lead[heads] = True
        send = np.zeros(name.size, bool)
        send[order] = ~several | lead
        shared = np.zeros(name.size, bool)
        shared[order] = several
        bucket = (name % U64(buckets)).astype(np.int64)
        for kind, chosen in ((0, send), (1, shared)):
            at = np.flatnonzero(chosen)
            where = bucket[at] if kind == 0 else doc[at] % buckets
            by, heads = _groups(where)
            for a, b in zip(heads, [*heads[1:], at.size], strict=False):
                k = at[by[a:b]]
                names = np.ascontiguousarray(name[k]).view(np.uint8).reshape(-1, 8)[:, 2:] if kind == 0 else np.zeros(0, np.uint8)
                yield int(where[by[a]]), kind, k.size, names.tobytes(), _pack(_delta(doc[k]), _delta(start[k].astype(np.int32)), count[k].astype(np.uint8))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").to_numpy()
            row, start, count, name = batch_runs(*flat_text(batch.column("text")), width)
            held.append((ids[row], start, count, name))
            n += row.size
            if n >= PACKET:
                yield _record(flush(held))
                held, n = [], 0
        if n:
            yield _record(flush(held))

    def _record(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "kind", "n", "names", "rest"])

    return run


def _shared_seeds(table: pa.Table) -> pa.Table:
    """The runs of a bucket whose names two or more documents hold."""
    parts, known = [], []
    for kind, n, names, rest in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "names", "rest")), strict=True):
        doc, start, count = _unpack(rest, n, np.int64, np.int32, np.uint8)
        doc, start = np.cumsum(doc), np.cumsum(start, dtype=np.int32)
        if kind:
            known.append((doc, start, count))
        else:
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :6] = np.frombuffer(names, np.uint8).reshape(n, 6)
            parts.append((doc, start, count, wide.view(np.uint64).ravel()))
    if parts:
        doc, start, count, name = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, heads = _groups(name)
        several = np.repeat(np.minimum.reduceat(doc[order], heads) != np.maximum.reduceat(doc[order], heads), np.diff(np.r_[heads, name.size]))
        at = order[several]
        known.append((doc[at], start[at], count[at]))
    doc, start, count = (np.concatenate(x) for x in zip(*known, strict=True))
    return pa.table({"doc_id": doc, "start": start, "count": count.astype(np.int32)})


def _context_packets(buckets: int, width: int):
    """Maps candidate texts to packets of contexts: the bytes of each shared run of strings.

    A context that a smaller document of the packet holds too is covered as a whole; such ones go
    on as finished spans, and only those of the smallest document are sent to the bucket.
    """

    def flush(held):
        texts, key, doc, start, count, name = [], [], [], [], [], []
        for data, off, ids, keys, row, s, c, h in held:
            begin = off[row] + s
            raw = data.tobytes()
            texts += [raw[a : a + n] for a, n in zip(begin.tolist(), (c + width - 1).tolist(), strict=True)]
            for to, x in ((key, keys[row]), (doc, ids[row]), (start, s), (count, c), (name, h)):
                to.append(x)
        key, doc, start, count, name = (np.concatenate(x) for x in (key, doc, start, count, name))
        index: dict[bytes, int] = {}
        of = np.array([index.setdefault(t, len(index)) for t in texts], np.int64)
        low = np.full(len(index), NULL_ID)
        np.minimum.at(low, of, doc)
        done = doc > low[of]
        bucket = (mix(name) % U64(buckets)).astype(np.int64)
        for kind, chosen in ((0, ~done), (1, done)):
            at = np.flatnonzero(chosen)
            where = bucket[at] if kind == 0 else doc[at] % buckets
            by, heads = _groups(where)
            for a, b in zip(heads, [*heads[1:], at.size], strict=False):
                k = at[by[a:b]]
                blob = zstandard.ZstdCompressor(level=1).compress(b"".join(texts[i] for i in k.tolist())) if kind == 0 else b""
                yield int(where[by[a]]), kind, k.size, blob, _pack(key[k], doc[k], start[k].astype(np.int32), count[k].astype(np.int32))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            data, off = flat_text(batch.column("text"))
            row, start, count, name = batch_runs(data, off, width)
            wanted, bounds = batch.column("starts").flatten().to_numpy(), batch.column("starts").value_lengths().to_numpy()
            pairs = np.unique((np.repeat(np.arange(bounds.size), bounds) << 32) | wanted.astype(np.int64))
            mine = (row << 32) | start
            at = np.minimum(np.searchsorted(pairs, mine), max(0, pairs.size - 1))
            ok = pairs[at] == mine if pairs.size else np.zeros(mine.size, bool)
            held.append((data, off, batch.column("doc_id").to_numpy(), batch.column("row_key").to_numpy(), row[ok], start[ok], count[ok], name[ok]))
            n += int(ok.sum())
            if n >= PACKET // 8:
                yield _record(flush(held))
                held, n = [], 0
        if n:
            yield _record(flush(held))

    def _record(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "kind", "n", "bytes", "rest"])

    return run


def _covered(width: int, shard: int):
    """The spans of a bucket's contexts that smaller documents cover, by suffix arrays of its shards."""

    def run(table: pa.Table) -> pa.Table:
        spans, index, rows = [], {}, []
        for kind, n, blob, rest in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "bytes", "rest")), strict=True):
            key, doc, start, count = _unpack(rest, n, np.int64, np.int64, np.int32, np.int32)
            if kind:
                spans.append((key, start.astype(np.int64), start.astype(np.int64) + count + width - 1))
                continue
            raw = zstandard.ZstdDecompressor().decompress(blob)
            ends = np.cumsum(count.astype(np.int64) + width - 1).tolist()
            of = np.array([index.setdefault(raw[a:b], len(index)) for a, b in zip([0, *ends], ends, strict=False)], np.int64)
            rows.append((key, doc, start.astype(np.int64), count.astype(np.int64), of))
        if rows:
            key, doc, start, count, of = (np.concatenate(x) for x in zip(*rows, strict=True))
            low = np.full(len(index), NULL_ID)
            np.minimum.at(low, of, doc)
            lengths = np.fromiter(map(len, index), np.int64, len(index))
            # shards of whole contexts, each with an owner at every start of a string
            ends = np.cumsum(lengths)
            cuts = np.unique(np.searchsorted(ends, np.arange(shard, ends[-1] + shard, shard), "right").clip(1, lengths.size))
            everything, shards, bases = np.frombuffer(b"".join(index), np.uint8), [], []
            for a, b in zip(np.r_[0, cuts[:-1]], cuts, strict=True):
                base, stop = (ends[a - 1] if a else 0), ends[b - 1]
                inner = np.arange(base, stop) - np.repeat(ends[a:b] - lengths[a:b], lengths[a:b])
                begins = inner <= np.repeat(lengths[a:b], lengths[a:b]) - width
                owner = np.where(begins, np.repeat(low[a:b], lengths[a:b]), NULL_ID)
                shards.append((everything[base:stop], owner, begins))
                bases.append(base)
            found = np.concatenate(smallest_owners(shards, width))
            # every start of every context's occurrence
            which = np.repeat(np.arange(of.size), count)
            inner = np.arange(which.size) - np.repeat(np.cumsum(count) - count, count)
            hit = found[(ends - lengths)[of][which] + inner] < doc[which]
            which, place = which[hit], (start[which] + inner)[hit]
            if which.size:
                new = np.r_[True, (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1)]
                last = np.r_[new[1:], True]
                spans.append((key[which[new]], place[new], place[last] + width))
        if not spans:
            return pa.table({"row_key": pa.array([], pa.int64()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return pa.table(dict(zip(("row_key", "a", "b"), (np.concatenate(x) for x in zip(*spans, strict=True)), strict=True)))

    return run


def _cut(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        out = []
        for key, text, spans in zip(*(batch.column(c).to_pylist() for c in ("row_key", "text", "spans")), strict=True):
            raw, kept, at, removed, n = text.encode(), hashlib.sha256(), 0, 0, 0
            end = -1
            for a, b in sorted((s["a"], s["b"]) for s in spans):
                if a > end:
                    n += 1
                    kept.update(raw[at:a])
                    removed += b - a
                elif b > end:
                    removed += b - end
                end = max(end, b)
                at = end
            kept.update(raw[at:])
            out.append((key, removed, n, kept.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["row_key", "removed", "runs", "kept"])


def remove_shared_strings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Operator: doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document.

    Every byte goes that lies in a ``width``-byte string which also starts in a document with a
    smaller doc_id. Null texts are empty; texts below the width keep all; rows with one and the
    same doc_id don't cover each other; null ids count as larger than all others, and their rows
    don't cover each other either; an empty table gives no rows.

    1. Exact copies of an earlier text are covered as a whole; digests of the texts tell.
    2. Every string is named by its smallest gram; names that two documents hold are candidates.
    3. Contexts of candidates are dealt by name; each bucket's shards get suffix arrays and common
       prefixes, and are merged by binary search; the smallest owner of each string decides.
    4. Spans go back to the candidates' texts. All but those read the table only once.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(F.col("doc_id"), text).alias("row_key"))
    rows = base.select("doc_id", "row_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    seen = materialise(rows, "sub-rows")
    # digests of several rows, in a table of their own: the join's sides are then dealt for the join alone, and a hot one is split
    firsts = materialise(seen.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("k")).where("k > 1").drop("k"), "sub-firsts")
    copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= width), F.lit(False))
    rows = materialise(seen.join(firsts, "sha", "left").withColumn("copy", copy).drop("first"), "sub-copies")
    discard(seen, firsts)

    text_bytes = rows.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(48, int(text_bytes // SEED_TASK) + 1)
    packets = base.select("doc_id", "text").mapInArrow(_seed_packets(buckets, width), "bucket long, kind int, n int, names binary, rest binary")
    seeds = packets.groupBy("bucket").applyInArrow(_shared_seeds, "doc_id long, start int, count int")
    wanted = seeds.groupBy("doc_id").agg(F.collect_set("start").alias("starts"), F.sum(F.col("count") + width).alias("n"))
    wanted = materialise(wanted, "sub-seeds")
    mass = wanted.agg(F.sum("n")).first()[0] or 0

    few = rows.where("not copy").select("doc_id", "row_key").distinct().join(wanted.select("doc_id", "starts"), "doc_id")
    candidates = materialise(base.join(few, ["doc_id", "row_key"]), "sub-candidates")
    buckets = max(12, int(mass // TASK) + 1)
    contexts = candidates.mapInArrow(_context_packets(buckets, width), "bucket long, kind int, n int, bytes binary, rest binary")
    spans = contexts.groupBy("bucket").applyInArrow(_covered(width, SHARD), "row_key long, a long, b long")
    spans = spans.groupBy("row_key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    cut = candidates.select("row_key", "text").join(spans, "row_key").mapInArrow(_cut, "row_key long, removed long, runs long, kept string").dropDuplicates(["row_key"])

    out = rows.join(cut, "row_key", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
