"""Unmapped competitor stores found by their menus, and which of them join the mapping by themselves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions import text
from promolens.operators import likeness

# Products a menu needs, price difference that confirms, name score that a near price
# needs, and from which hits and shares a candidate is sure, likely, or joins by itself.
PRODUCTS, NEAR_PRICE, NAME = 4, 0.05, 80.0
SURE_HITS, SURE_SHARE, LIKELY_HITS, LIKELY_SHARE, MERGE_SHARE, MERGE_HITS, SHORTEST = 3, 0.5, 4, 0.3, 0.7, 4, 4
#: Own products of one block, and places in it that are kept with the names they were found for.
BLOCK, HELD = 250_000, 10_000_000
FOUND = pa.schema([("city_code", pa.string()), ("comp", pa.string()), ("products", pa.int64()), ("store_name", pa.string()), ("n_overlap", pa.int64()), ("n_confirmed", pa.int64())])


class Menus:
    """The own products of one block of stores, by name and price."""

    def __init__(self, rows: pa.Table) -> None:
        held, words = (rows[c].combine_chunks().dictionary_encode("encode") for c in ("name", "n"))
        names = held.dictionary.to_pylist()
        places = sorted(range(len(names)), key=lambda k: (names[k] is None, names[k] or ""))
        self.stores, self.names = [names[k] for k in places], words.dictionary.to_pylist()
        of, price = np.argsort(places)[held.indices.to_numpy()], rows["price"].to_numpy()
        word = words.indices.to_numpy()
        order = np.lexsort((price, word))
        self.prices, self.of, self.start = price[order], of[order], np.searchsorted(word[order], np.arange(len(self.names) + 1))
        self.place = {n: k for k, n in enumerate(self.names)}
        self.alike: dict[str, list[int]] = {}
        for k, n in enumerate(self.names):
            if n is not None:
                self.alike.setdefault(_sorted(n), []).append(k)
        self.choices = likeness.Choices([likeness.Sorted(n) for n in self.alike])
        self.known, self.held = {}, 0

    def _rows(self, names: list[int]) -> np.ndarray:
        return np.concatenate([np.arange(self.start[k], self.start[k + 1]) for k in names] or [np.zeros(0, np.int64)])

    def named(self, n: str) -> tuple:
        """Whether each store has a name, and prices (in order) with stores of this name and of likely ones."""
        if n not in self.known:
            a, same = likeness.Sorted(_sorted(n)), [self.place[n]] if n in self.place else []
            some = np.flatnonzero(a.most(self.choices.shared(a.name), self.choices.lengths, []) >= NAME)  # no other can reach it
            some = some[a.scores(self.choices, some) >= NAME]
            likely = [k for j in some.tolist() for k in self.alike[self.choices.made[j].name] if k not in same]
            own, near = self._rows(same), self._rows(likely)
            near = near[np.argsort(self.prices[near], kind="stable")]
            has = np.zeros(len(self.stores), bool)
            has[self.of[own]] = True
            if self.held > HELD:
                self.known.clear()
                self.held = 0
            self.known[n] = has, self.prices[own], self.of[own], self.prices[near], self.of[near]
            self.held += len(has) + len(own) + len(near)
        return self.known[n]

    def best(self, menu: list[dict]) -> tuple[str | None, int, int] | None:
        """The store that most of a menu's products point to, how many do, and how many a price confirms."""
        products: dict[str | None, list[tuple]] = {}
        for x in menu:
            if x["n"] is not None:
                products.setdefault(x["product"], []).append((x["price"], *self.named(x["n"])))
        hits, sure = np.zeros(len(self.stores), np.int64), np.zeros(len(self.stores), np.int64)
        for rows in products.values():
            has, ok = np.logical_or.reduce([r[1] for r in rows]), np.zeros(len(self.stores), bool)
            for price, _, own, stores, near, others in rows:
                if price is not None:
                    others = others[_close(near, price, True)]
                    ok[others[~has[others]]] = True
                    ok[stores[_close(own, price, False)]] = True
            hits += has | ok
            sure += ok
        k = int((sure * (len(products) + 1) + hits).argmax()) if len(self.stores) else 0  # the first of the best: stores stand in order
        return (self.stores[k], int(hits[k]), int(sure[k])) if len(self.stores) and hits[k] else None


def _sorted(name: str) -> str:
    """text.token_sort, outside of Spark."""
    return " ".join(sorted(w for w in name.split(" ") if w))


def _close(prices: np.ndarray, price: float, euros: bool) -> np.ndarray:
    """Where prices in order are near to one, and with ``euros`` at most one whole euro off when both are rounded."""
    low, high = (0, np.searchsorted(prices, 0.0)) if price < 0 else np.searchsorted(prices, (price * (1 - 2 * NEAR_PRICE), price * (1 + 2 * NEAR_PRICE)), "left")
    some = prices[low:high]
    with np.errstate(divide="ignore", invalid="ignore"):
        ok = (some != 0) & (price != 0) & (np.abs(some - price) / np.maximum(some, price) <= NEAR_PRICE)
    if euros:
        ok &= np.abs(np.rint(some) - np.rint(price)) <= 1
    return low + np.flatnonzero(ok)


def _best_of_blocks(batches):
    """The best store of a block for each competitor; a partition's rows come block by block, own products first."""
    cell, mine, block = None, [], None
    for batch in batches:
        kind = 2 * batch.column("cell").to_numpy() + batch.column("side").to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(kind)]
        out = []
        for rows in (batch.slice(a, b - a) for a, b in zip(ends, ends[1:], strict=False) if b > a):
            if rows.column("cell")[0].as_py() != cell:
                cell, mine, block = rows.column("cell")[0].as_py(), [], None
            if not rows.column("side")[0].as_py():
                mine.append(rows.select(["name", "n", "price"]))
                continue
            if block is None and mine:
                block, mine = Menus(pa.Table.from_batches(mine)), []
            for city, comp, menu in zip(*(rows.column(c).to_pylist() for c in ("city_code", "name", "menu")), strict=True) if block else ():
                found = block.best(menu)
                if found:
                    out.append({"city_code": city, "comp": comp, "products": len(menu), "store_name": found[0], "n_overlap": found[1], "n_confirmed": found[2]})
        yield pa.RecordBatch.from_pylist(out, FOUND)


def best_stores(menus: DataFrame, own: DataFrame, block: int | None = None) -> DataFrame:
    """The own store that most products of each competitor's menu point to, prices that confirm first.

    menus: city_code, comp, menu (product, n, price); own: city_code, store_name, n, price. The same name is
    a hit, confirmed by any price near enough; else a near price (neighbouring whole euros) with a
    likely name is one, confirmed by itself. The stores of a city are dealt to blocks of so many products; each
    competitor meets each block in a task that holds the block and reads competitors one by one, and
    neither hits nor pairs of stores leave it.
    """
    size = BLOCK if block is None else block
    own = own.where("city_code is not null and n is not null")
    counts = own.groupBy("city_code").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks")).orderBy("city_code").collect()  # a row a city
    cells = sum(r["blocks"] for r in counts)
    first = own.sparkSession.createDataFrame([(r["city_code"], r["blocks"], sum(x["blocks"] for x in counts[:k])) for k, r in enumerate(counts)], "city_code string, blocks int, first int")
    dealt = lambda df, cell: df.join(F.broadcast(first), "city_code").withColumn("cell", cell)
    kinds = "array<struct<product: string, n: string, price: double>>"
    left = dealt(own, F.col("first") + F.pmod(F.xxhash64("store_name"), F.col("blocks")).cast("int")).select("cell", F.lit(0).alias("side"), F.lit(None).cast("string").alias("city_code"), F.col("store_name").alias("name"), "n", "price", F.lit(None).cast(kinds).alias("menu"))
    right = dealt(menus, F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1))).select("cell", F.lit(1).alias("side"), "city_code", F.col("comp").alias("name"), F.lit(None).cast("string").alias("n"), F.lit(None).cast("double").alias("price"), F.col("menu").cast(kinds).alias("menu"))
    found = left.unionByName(right).repartitionById(max(cells, 1), "cell").sortWithinPartitions("cell", "side").mapInArrow(_best_of_blocks, "city_code string, comp string, products long, store_name string, n_overlap long, n_confirmed long")
    order = F.struct(-F.col("n_confirmed"), -F.col("n_overlap"), F.col("store_name").isNull(), "store_name")
    best = found.groupBy("city_code", "comp").agg(F.min_by(F.struct("products", "store_name", "n_overlap", "n_confirmed"), order).alias("x"))
    return best.select("city_code", "comp", "x.store_name", "x.n_overlap", "x.n_confirmed", "x.products")


def discover(comp: DataFrame, own: DataFrame, mapping: DataFrame) -> DataFrame:
    """For each unmapped competitor store the own store that most of its products point to.

    comp: city_code, comp, product, n, price; own as in best_stores.
    """
    known = mapping.select("city_code", F.col("comp_name").alias("comp")).distinct()
    menus = comp.where("comp is not null").join(known, ["city_code", "comp"], "left_anti").groupBy("city_code", "comp").agg(F.collect_list(F.struct("product", "n", "price")).alias("menu"))
    out = best_stores(menus.where(F.size("menu") >= PRODUCTS), own).withColumn("ratio", F.round(F.col("n_overlap") / F.col("products"), 2))
    sure = (F.col("n_confirmed") >= SURE_HITS) | (F.col("ratio") >= SURE_SHARE)
    likely = (F.col("n_overlap") >= LIKELY_HITS) & (F.col("ratio") >= LIKELY_SHARE)
    return out.withColumn("confidence", F.when(sure, "alta").when(likely, "media")).where("confidence is not null")


def tight(name):
    """a folded name without blanks."""
    return F.replace(text.fold(name), F.lit(" "), F.lit(""))


def auto_merge(candidates: DataFrame, mapping: DataFrame, links: DataFrame | None = None, pools: DataFrame | None = None) -> DataFrame:
    """The mapping and the candidates whose name holds the other one or whose products leave no doubt.

    With links and pools, the same mapping with shared names said once, candidates are looked up there and
    the mapping's pairs are not dealt out by a key.
    """
    a, b = tight(F.col("comp")), tight(F.col("store_name"))
    inside = (F.least(F.length(a), F.length(b)) >= SHORTEST) & (F.contains(a, b) | F.contains(b, a))
    strong = (F.col("ratio") >= MERGE_SHARE) & (F.col("n_confirmed") >= MERGE_HITS)
    pair = ["city_code", "store_name", "comp_name"]
    fresh = candidates.where(inside | strong).select("city_code", "store_name", F.col("comp").alias("comp_name"), F.lit("auto_fingerprint").alias("source"))
    if links is None or pools is None:
        return mapping.unionByName(fresh.join(mapping, pair, "left_anti").distinct())
    fresh = fresh.join(links.where("pool is null").select(*pair), pair, "left_anti")
    stores = links.where("pool is not null").groupBy("city_code", "store_name").agg(F.collect_set("pool").alias("of_store"))
    names = pools.groupBy("city_code", "comp_name").agg(F.collect_set("pool").alias("of_name"))
    fresh = fresh.join(stores, pair[:2], "left").join(names, ["city_code", "comp_name"], "left")
    return mapping.unionByName(fresh.where(~F.coalesce(F.arrays_overlap("of_store", "of_name"), F.lit(False))).select(mapping.columns).distinct())
