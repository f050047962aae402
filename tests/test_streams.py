"""Streams with state: changes only, replays, late rows, failures between batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from promolens.streaming import arrival, listing, sink

T0 = dt.datetime(2024, 1, 1)


def row(seq, city="C1", store="a", promotion="2x1", url="", minutes=None):
    return (city, store, promotion, url, seq, T0 + dt.timedelta(minutes=seq if minutes is None else minutes))


def stream(spark, folder):
    return spark.readStream.schema(listing.ROW).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def put(spark, folder, rows):
    spark.createDataFrame(rows, listing.ROW).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def drain_listing(spark, folder):
    arrival.drain(listing.listing_changes(stream(spark, folder)), folder, "update")
    return arrival.drained(spark, folder, listing.LISTED)


def test_only_changes_are_told(spark):
    folder = arrival.new_folder(spark, "test")
    first = [row(1, promotion=" 2x1 | 20%  off"), row(2, store="b", url=" u2 "), row(3, store="c", promotion=None), row(4, store="d", promotion=" | ")]
    for rows in (first, first, [row(5, promotion="20% off", url="u5", minutes=0)], [row(0, promotion="early|2x1", url="u0", minutes=0)], [row(6, store="b", minutes=99)]):
        put(spark, folder, rows)
        drain_listing(spark, folder)
    told = {(r["batch"], r["store_name"]): (r["promotions"], r["url"], r["new_info"]) for r in arrival.drained(spark, folder, listing.LISTED).collect()}
    assert told == {(0, "a"): ("2x1 | 20% off", "", True), (0, "b"): ("2x1", "u2", True), (2, "a"): ("2x1 | 20% off", "u5", False), (3, "a"): ("early | 2x1 | 20% off", "u0", True), (4, "b"): ("2x1", "u2", False)}
    now = {r["store_name"]: (r["promotions"], r["url"], r["last_seen"]) for r in listing.listing_now(arrival.drained(spark, folder, listing.LISTED)).collect()}
    assert now == {"a": ("early | 2x1 | 20% off", "u0", T0 + dt.timedelta(minutes=1)), "b": ("2x1", "u2", T0 + dt.timedelta(minutes=99))}


def test_no_rows_no_state(spark):
    folder = arrival.new_folder(spark, "test")
    put(spark, folder, [])
    assert drain_listing(spark, folder).count() == 0


def plain_stop(rows, most, span, end):
    """The loop over a city's points, as it would run with all rows at hand."""
    out = []
    for city in sorted({r[0] for r in rows}):
        known, last, streak = set(), None, 0
        points = {}
        for r in sorted((r for r in rows if r[0] == city), key=lambda r: r[4]):
            if r[1] and listing.pieces(r[2] or ""):
                points.setdefault(int((r[5] - dt.datetime(1970, 1, 1)).total_seconds()) // span * span, []).append(r)
        for at in sorted(points):
            if at + span > end:
                break
            first = {}
            for r in points[at]:
                first.setdefault(r[1], r[2])
            new = sum(any((s, p) not in known for p in listing.pieces(x)) for s, x in first.items())
            known |= {(r[1], p) for r in points[at] for p in listing.pieces(r[2])}
            said = {(r[1], " | ".join(listing.pieces(r[2]))) for r in points[at]}
            streak = 0 if new else streak + 1 if said == last else 1
            last = said
            out.append((city, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=at), new, streak, streak >= most))
            if streak >= most:
                break
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_early_stop_takes_late_rows(spark, seed):
    rng, folder = random.Random(seed), arrival.new_folder(spark, "test")
    rows = [row(k, f"C{rng.randrange(3)}", rng.choice("abc"), rng.choice(["2x1", "2x1", "2x1 | 20%", None]), minutes=3 * k) for k in range(400)]
    late = sorted(rows, key=lambda r: r[5] + dt.timedelta(minutes=rng.randrange(0, 100)))  # at most 100 minutes late
    for k in range(0, 400, 100):
        put(spark, folder, late[k : k + 100])
    put(spark, folder, [row(9999, "end", minutes=5000)])
    arrival.drain(listing.early_stop(stream(spark, folder), most=3, seconds=600, late="100 minutes"), folder, "append")
    put(spark, folder, [row(10000, "C0", "z", "new after the stop", minutes=5001), row(10001, "end", minutes=9000)])
    arrival.drain(listing.early_stop(stream(spark, folder), most=3, seconds=600, late="100 minutes"), folder, "append")
    got = sorted(tuple(r)[:5] for r in arrival.drained(spark, folder, listing.POINT).collect())
    end = (T0 + dt.timedelta(minutes=8900) - dt.datetime(1970, 1, 1)).total_seconds()
    want = plain_stop([*rows, row(9999, "end", minutes=5000), row(10000, "C0", "z", "new after the stop", minutes=5001)], 3, 600, end)
    assert got == sorted(want)
    assert any(r[4] for r in got)


def test_silences_are_told_once(spark):
    folder = arrival.new_folder(spark, "test")
    for minutes in ([0, 5, 300], [302, 900], [2000]):
        put(spark, folder, [row(m, store="x", minutes=m) for m in minutes])
    put(spark, folder, [row(4000, store="y", minutes=4000)])
    arrival.drain(listing.silences(stream(spark, folder), "store_name", "1 hour", "10 minutes"), folder, "append")
    got = sorted((r["store_name"], (r["last_seen"] - T0).seconds // 60 + (r["last_seen"] - T0).days * 1440) for r in arrival.drained(spark, folder, "store_name string, last_seen timestamp, deadline timestamp").collect())
    assert got == [("x", 5), ("x", 302), ("x", 900), ("x", 2000)]


def listing_rows(df):
    return sorted(map(tuple, sink.listing_of(df).collect()))


def test_merge_runs_leave_the_table_as_it_is(spark, monkeypatch):
    rng, folder = random.Random(3), arrival.new_folder(spark, "test")
    rows = [row(k, f"C{rng.randrange(4)}", rng.choice("abc"), rng.choice(["2x1", "20% | 2x1", None, " x  y | "]), rng.choice(["", f"u{k}", None])) for k in range(200)]
    for k in range(0, 200, 50):
        put(spark, folder, rows[k : k + 50])
    table = f"{folder}/table"
    assert sink.read_facts(spark, table).count() == 0
    real, calls = sink.facts, []

    def failing(batch):  # the second batch writes a part and dies
        calls.append(1)
        if len(calls) == 2:
            real(batch.limit(7)).write.mode("overwrite").parquet(f"{table}/run=one/batch=1")
            raise RuntimeError("lost")
        return real(batch)

    monkeypatch.setattr(sink, "facts", failing)
    with pytest.raises(Exception, match="lost"):
        sink.merge_run(stream(spark, folder), table, "one", f"{folder}/one")
    monkeypatch.setattr(sink, "facts", real)
    sink.merge_run(stream(spark, folder), table, "one", f"{folder}/one")
    once = listing_rows(sink.read_facts(spark, table))
    assert once == listing_rows(sink.facts(spark.createDataFrame(rows, listing.ROW)))
    sink.merge_run(stream(spark, folder), table, "two", f"{folder}/two")  # a fresh checkpoint: all comes again
    assert listing_rows(sink.read_facts(spark, table)) == once
    sink.compact(spark, table)
    assert listing_rows(sink.read_facts(spark, table)) == once and sink.read_facts(spark, table).count() == sink.folded(sink.read_facts(spark, table)).count()
    promotions = {(r[0], r[1]): r[2] for r in once}
    now = {}
    for c, s, p, *_ in rows:
        for x in listing.pieces(p or ""):
            if x not in now.setdefault((c, s), []):
                now[c, s].append(x)
    assert promotions == {k: " | ".join(v) for k, v in now.items()}


def test_batches_replay_to_the_same_listing(spark):
    """The state tells the same listing however rows are cut into batches, and if some come twice."""
    rng = random.Random(4)
    rows = [row(k, f"C{rng.randrange(3)}", rng.choice("ab"), rng.choice(["2x1", "20% | 2x1", "x"]), rng.choice(["", f"u{k}"])) for k in range(60)]
    seen = []
    for cuts in ([rows], [rows[:10], rows[5:40], rows[30:], rows[:20]], [rows[::-1][k : k + 20] for k in (0, 20, 40)]):
        folder = arrival.new_folder(spark, "test")
        for part in cuts:
            put(spark, folder, part)
        seen.append(sorted(map(tuple, listing.listing_now(drain_listing(spark, folder)).collect())))
    assert seen[0] == seen[1] == seen[2] == listing_rows(sink.facts(spark.createDataFrame(rows, listing.ROW)))


def test_settings_come_back(spark):
    spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with arrival.settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3
