"""The running listing of promotions as state of a stream: changes (R04), early stop (R05, A25, W10), silence."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: Rows that a listing takes: ``seq`` orders them, whatever the order they come in.
ROW = "city_code string, store_name string, promotion string, url string, seq long, ts timestamp"
LISTED = "city_code string, store_name string, promotions string, url string, last_seen timestamp, new_info boolean"
POINT = "city_code string, point timestamp, new_info int, streak int, stopped boolean"


def pieces(promotion: str) -> list[str]:
    """The promotions that a text joins by bars."""
    return [p for p in (" ".join(x.split()) for x in promotion.split("|")) if p]


class Listing(StatefulProcessor):
    """A store's promotions in order of appearance, its first address and the time it was last seen.

    State: a map from each promotion to the ordinal it first came with, and one value of the
    address with its ordinal and the time. A store gives a row with a batch only if that changes
    its state, so a batch that comes twice gives none the second time; ``new_info`` says that a
    promotion is new. Ordinals decide, so rows may come in any order.
    """

    def init(self, handle) -> None:
        self.first = handle.getMapState("promotions", "promotion string", "seq long, part int")
        self.rest = handle.getValueState("rest", "url string, url_seq long, last_seen timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        url, url_seq, seen = self.rest.get() if self.rest.exists() else ("", None, None)
        known = {k[0]: tuple(v) for k, v in self.first.iterator()}
        before, told = (dict(known), url, seen), set(known)
        for frame in rows:
            for promotion, address, seq, ts in zip(frame["promotion"], frame["url"], frame["seq"].tolist(), frame["ts"], strict=True):
                found = pieces(promotion or "")
                if not found:
                    continue
                for part, name in enumerate(found):
                    known[name] = min(known.get(name, (seq, part)), (seq, part))
                if (address or "").strip() and (url_seq is None or seq < url_seq):
                    url, url_seq = address.strip(), seq
                seen = ts.to_pydatetime() if seen is None or ts > pd.Timestamp(seen) else seen
        if (known, url, seen) == before:
            return
        for name, place in known.items():
            if before[0].get(name) != place:
                self.first.updateValue((name,), place)
        self.rest.update((url, url_seq, seen))
        names = " | ".join(sorted(known, key=known.__getitem__))
        yield pd.DataFrame({"city_code": [key[0]], "store_name": [key[1]], "promotions": [names], "url": [url], "last_seen": [pd.Timestamp(seen)], "new_info": [set(known) != told]})

    def close(self) -> None:
        pass


def listing_changes(rows: DataFrame) -> DataFrame:
    """A stream of ROW to a stream of LISTED, the stores that a batch changes."""
    return rows.groupBy("city_code", "store_name").transformWithStateInPandas(Listing(), LISTED, "update", "None")


def listing_now(changes: DataFrame) -> DataFrame:
    """The listing from all changes (with their batch): each store's last row."""
    last = changes.groupBy("city_code", "store_name").agg(F.max_by(F.struct("promotions", "url", "last_seen"), "batch").alias("x"))
    return last.select("city_code", "store_name", "x.*")


class EarlyStop(StatefulProcessor):
    """Points of a city in order of time, until as many as ``most`` in a row say one and the same and nothing new.

    A point is a window of time; it is judged when the watermark has passed it, so rows may come
    late and in any order. State: rows of points still open; the promotions known of each store;
    the last point's signature, the streak, and whether the city is done. Once it is, later
    points are neither told nor learned from, in whatever batch they come.
    """

    def __init__(self, most: int, seconds: int) -> None:
        self.most, self.span = most, seconds * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "point long, seq long, store string, promotion string")
        self.known = handle.getMapState("known", "store string, promotion string", "once boolean")
        self.run = handle.getValueState("run", "signature string, streak int, stopped boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.run.exists() and self.run.get()[2]:
            return
        for frame in rows:
            ms = frame["ts"].astype("datetime64[ms]").astype("int64") // self.span * self.span
            named = [(p, s, n, name) for p, s, n, name in zip(ms.tolist(), frame["seq"].tolist(), frame["store_name"], frame["promotion"], strict=True) if n and pieces(name or "")]
            if named:
                self.open.appendList(named)
            for point in {p for p, *_ in named}:
                self.handle.registerTimer(point + self.span)
        yield from self._judge(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._judge(key, timerValues.getCurrentWatermarkInMs())

    def _judge(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        signature, streak, stopped = self.run.get() if self.run.exists() else ("", 0, False)
        rows = sorted(map(tuple, self.open.get())) if self.open.exists() and not stopped else []
        ripe = [r for r in rows if r[0] + self.span <= watermark]
        if not ripe:
            return
        out = []
        for point in sorted({r[0] for r in ripe}):
            here, first = [r for r in ripe if r[0] == point], {}
            for _, _, store, promotion in here:
                first.setdefault(store, promotion)
            new = sum(any(not self.known.containsKey((store, p)) for p in pieces(promotion)) for store, promotion in first.items())
            for _, _, store, promotion in here:
                for p in pieces(promotion):
                    self.known.updateValue((store, p), (True,))
            said = "\n".join(sorted({f"{store}\t{' | '.join(pieces(promotion))}" for _, _, store, promotion in here}))
            streak = 0 if new else streak + 1 if said == signature else 1
            signature, stopped = said, streak >= self.most
            out.append((key[0], pd.Timestamp(point, unit="ms"), new, streak, stopped))
            if stopped:
                break
        left = [] if stopped else [r for r in rows if r[0] + self.span > watermark]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        self.run.update((signature, streak, stopped))
        yield pd.DataFrame(out, columns=["city_code", "point", "new_info", "streak", "stopped"])

    def close(self) -> None:
        pass


def early_stop(rows: DataFrame, most: int = 3, seconds: int = 3600, late: str = "5 days") -> DataFrame:
    """A stream of ROW to its cities' points (POINT), up to the one that ends a city."""
    return rows.withWatermark("ts", late).groupBy("city_code").transformWithStateInPandas(EarlyStop(most, seconds), POINT, "append", "EventTime")


def silences(events: DataFrame, key: str, gap: str = "6 hours", late: str = "5 days") -> DataFrame:
    """(key, last_seen, deadline) of each key that was not heard of for ``gap``, when the watermark has passed the deadline.

    A session is what has no such gap inside; it ends a gap after its last event.
    """
    timed = events.withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap), key).agg(F.max("ts").alias("last_seen")).select(key, "last_seen", F.col("session_window.end").alias("deadline"))
