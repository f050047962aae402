"""Product matches inside mapped stores and what they say about a store."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions import promo, text
from promolens.operators import likeness
from promolens.operators.parity import MATCHED

# Scores from which a name stands alone or counts at all, points within which prices
# decide, candidates looked at, price gap in percent that confirms, products a verdict needs, and
# the shares from which a store is ahead or level.
AUTO, LEAST, NEAR, TOP, GAP, PRODUCTS, AHEAD, LEVEL = 88.0, 60.0, 3.0, 5, 3.0, 3, 0.60, 0.45

#: Competitor stores of a pool whose menus one task holds, and tasks at most.
CELL, TASKS = 200, 20_000
#: Competitors of a pool that one task holds, scores it keeps, and verdicts from the worst.
BLOCK, HELD, SEVERITY = 2000, 1_000_000, ("INFERIORITY", "PARITY", "SUPERIORITY")
WORST = pa.schema([("city_code", pa.string()), ("store_name", pa.string()), ("worst", pa.int32())])


def anchored(mapping: DataFrame, comp: DataFrame, own: DataFrame) -> DataFrame:
    """Every competitor product beside every own product of the store that is mapped to its store.

    comp: city_code, comp_name, comp_product, comp_price, promotion_type; own: city_code,
    store_name, own_product, own_price, own_rank, own_pct, weight; comp_cut, a reduced price, where
    there is one. The join is on both stores, so a pair of menus is the most that meets.
    """
    pairs = mapping.where("comp_name <> ''").select("city_code", "store_name", "comp_name").distinct()
    return pairs.join(comp, ["city_code", "comp_name"]).join(own, ["city_code", "store_name"])


def best_products(met: DataFrame) -> DataFrame:
    """One own product for each competitor product: the best name, near ones by price.

    One that is unmatched has its best score and nothing of any own product. ``price_confirmed``
    says that prices are near enough, ``name_score`` is the score in whole points, and
    ``own_revenue`` what the own product earns.
    """
    key = ["city_code", "store_name", "comp_name", "comp_product"]
    met = met.withColumns({"a": text.token_sort(text.product_name(F.col("comp_product"))), "b": text.token_sort(text.product_name(F.col("own_product")))})
    rows = met.join(likeness.scored(met.select("a", "b").distinct()), ["a", "b"])
    ranked = Window.partitionBy(*key).orderBy(F.desc("score"), "own_product")
    rows = rows.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= TOP).withColumn("top", F.max("score").over(Window.partitionBy(*key)))
    rows = rows.where((F.col("rn") == 1) | ((F.col("score") >= F.col("top") - NEAR) & (F.col("score") >= LEAST)))
    best = rows.withColumn("pick", F.row_number().over(Window.partitionBy(*key).orderBy(_apart(F.col("comp_price"), F.col("own_price")), F.desc("score"), "own_product"))).where("pick = 1")
    return _judged(best).drop("a", "b", "rn", "top", "pick")


def _apart(comp_price: Column, own_price: Column) -> Column:
    """How far two prices are apart; nothing where the competitor has none."""
    apart = F.when(own_price > 0, F.abs(comp_price - own_price) / F.greatest(comp_price, own_price)).otherwise(9.9)
    return F.when(comp_price.isNotNull(), text.rounded(apart, 9))


def _kind(score: Column, comp_price: Column, own_price: Column) -> tuple[Column, Column, Column]:
    """What becomes of the best product: its price gap, whether that confirms it, and the kind of match."""
    gap = F.when((comp_price > 0) & (own_price > 0), text.rounded((comp_price - own_price) / own_price * 100, 1))
    near = F.coalesce(F.abs(gap) <= GAP, F.lit(False))
    return gap, near, F.when(~(score >= LEAST), "unmatched").when((score >= AUTO) | near, "auto").otherwise("review")


def _judged(best: DataFrame) -> DataFrame:
    gap, near, kind = _kind(F.col("score"), F.col("comp_price"), F.col("own_price"))
    found = F.col("score") >= LEAST
    best = best.withColumns({"gap_pct": gap, "match_type": kind, "price_confirmed": found & near, "name_score": F.bround("score", 0).cast("int"), "own_revenue": text.rounded(F.col("weight"), 2)})
    blank = {c: F.when(found, F.col(c)) for c in ("own_price", "own_rank", "own_pct", "weight", "own_revenue", "gap_pct")}
    return best.withColumns(blank | {"own_product": F.when(found, F.col("own_product")).otherwise("")})


def _near_names(batches):
    """For each name of a cell the places in a store's menu that stand to choice: its best names, best first."""
    known: dict[str, dict[str, float]] = {}
    made: dict[str, likeness.Sorted] = {}
    for batch in batches:
        out = []
        for names, menu in zip(batch.column("names").to_pylist(), batch.column("b").to_pylist(), strict=True):
            if len(known) * len(menu) > 1_000_000 or len(made) > 100_000:
                known.clear()
                made.clear()
            rows = []
            for a in names:
                row = known.setdefault(a, {})
                for b in menu:
                    if b not in row:
                        x, y = (made.get(n) or made.setdefault(n, likeness.Sorted(n)) for n in (a, b))
                        row[b] = x.score(y)
                scores = [row[b] for b in menu]
                top = max(scores)
                least = max(top - NEAR, LEAST)
                some = sorted((k for k, s in enumerate(scores) if s >= least), key=lambda k: -scores[k])[:TOP] if top >= LEAST else [scores.index(top)]
                rows.append([{"place": k, "score": scores[k]} for k in some])
            out.append(rows)
        near = pa.array(out, pa.list_(pa.list_(pa.struct([("place", pa.int32()), ("score", pa.float64())]))))
        yield pa.RecordBatch.from_arrays([*batch.columns, near], [*batch.schema.names, "near"])


def pool_pairs(links: DataFrame, pools: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stores with their pools, and the names of those, so that every pair of stores is in one pool:
    a name of a store alone is a pool of its own, unless a pool of the store has it already."""
    city = "city_code"
    shared = links.where("pool is not null").select(city, "store_name", "pool").distinct()
    members = pools.where("comp_name <> ''").select(city, "pool", "comp_name").distinct()
    single = links.where("pool is null and comp_name <> ''").select(city, "store_name", "comp_name").distinct()
    twice = single.join(members, [city, "comp_name"]).join(shared, [city, "store_name", "pool"], "left_semi")
    single = single.join(twice.select(city, "store_name", "comp_name"), [city, "store_name", "comp_name"], "left_anti")
    named = lambda kind, c: F.concat(F.lit(kind), F.col(c)).alias("pool")
    stores = shared.select(city, "store_name", named("pool ", "pool")).unionByName(single.select(city, "store_name", named("name ", "comp_name")))
    return stores, members.select(city, named("pool ", "pool"), "comp_name").unionByName(single.select(city, named("name ", "comp_name"), "comp_name").distinct())


def best_of_pools(links: DataFrame, pools: DataFrame, comp: DataFrame, own: DataFrame, whole: bool = False) -> DataFrame:
    """best_products(anchored(...)) of a mapping by links and pools, without a row for every two products.

    A pool's competitors are dealt to cells. A store's menu meets the names of a cell once, whatever
    stores have them; then a row is a pair of menus, and each product picks among its near names by
    price within the row. With ``whole`` only pairs are left that a verdict can come from. The pools
    of one store have no name in common.
    """
    city = "city_code"
    stores, members = pool_pairs(links, pools)
    sizes = members.groupBy(city, "pool").agg(F.ceil(F.count("*") / CELL).cast("int").alias("n"))
    cells = sizes.where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # a number
    tasks = min(cells + int(comp.sparkSession.conf.get("spark.sql.shuffle.partitions")), TASKS)  # work grows with pairs and not with bytes
    told = [c for c in ("comp_product", "comp_price", "promotion_type", "comp_cut") if c in comp.columns]
    menus = comp.withColumn("a", text.token_sort(text.product_name(F.col("comp_product")))).groupBy(city, "comp_name").agg(F.collect_list(F.struct("a", *told)).alias("products"))
    theirs = members.join(sizes, [city, "pool"]).withColumn("cell", F.pmod(F.xxhash64("comp_name"), F.col("n")).cast("int")).drop("n").join(menus, [city, "comp_name"])
    names = theirs.select(city, "pool", "cell", F.explode("products.a").alias("a")).groupBy(city, "pool", "cell").agg(F.collect_set("a").alias("names"))
    sold = ["own_product", "own_price", "own_rank", "own_pct", "weight"]
    mine = own.withColumn("b", text.token_sort(text.product_name(F.col("own_product")))).groupBy(city, "store_name").agg(F.sort_array(F.collect_list(F.struct(*sold, "b"))).alias("menu"))
    mine = mine.select(city, "store_name", F.transform("menu", lambda x: x["b"]).alias("b"), F.transform("menu", lambda x: F.struct(*[x[c].alias(c) for c in sold])).alias("menu"))
    mine = stores.join(mine, [city, "store_name"]).join(names, [city, "pool"])
    shape = mine.select("*", F.lit(None).cast("array<array<struct<place: int, score: double>>>").alias("near")).schema
    mine = mine.mapInArrow(_near_names, shape).withColumn("near", F.map_from_arrays("names", "near")).drop("names", "b")
    key = [city, "pool", "cell"]
    pairs = mine.repartition(tasks, *key).join(theirs.repartition(tasks, *key), key)

    def pick(p: Column) -> Column:
        choices = F.transform(F.try_element_at(F.col("near"), p["a"]), lambda c: F.struct(_apart(p["comp_price"], F.get("menu", c["place"])["own_price"]).alias("apart"), (-c["score"]).alias("low"), c["place"].alias("place")))
        return F.struct(p.alias("p"), F.array_min(choices).alias("x"))

    best = F.transform(F.transform("products", pick), lambda r: F.struct(*[r["p"][c].alias(c) for c in told], (-r["x"]["low"]).alias("score"), F.get("menu", r["x"]["place"]).alias("own")))
    pairs = pairs.select(city, "store_name", "comp_name", best.alias("best"))
    if whole:
        auto = F.forall("best", lambda x: _kind(x["score"], x["comp_price"], x["own"]["own_price"])[2] == "auto")
        pairs = pairs.where((F.size("best") >= PRODUCTS) & auto)
    return _judged(pairs.select(city, "store_name", "comp_name", F.explode("best").alias("x")).select(city, "store_name", "comp_name", *[f"x.{c}" for c in told], "x.score", "x.own.*"))


def product_verdicts(best: DataFrame) -> DataFrame:
    """The verdict of store pairs whose promoted products are all matched.

    Each own product meets the strongest promotion that matches it; wins count whole and ties half,
    weighted by what the product earns, else costs, else alike. A competitor's percentage is that of
    its prices, else that of its text.
    """
    pair = ["city_code", "store_name", "comp_name"]
    whole = best.groupBy(*pair).agg(F.count("*").alias("n_products"), F.count(F.when(F.col("match_type") == "auto", 1)).alias("n_auto")).where((F.col("n_products") >= PRODUCTS) & (F.col("n_auto") == F.col("n_products")))
    said = promo.percent_of_text(F.col("promotion_type"))
    cut = text.percent_off(F.col("comp_price"), F.col("comp_cut")) if "comp_cut" in best.columns else F.lit(None)
    earns = F.when(F.col("weight") > 0, F.col("weight")).when(F.col("own_price") > 0, F.col("own_price")).otherwise(1.0)
    rows = best.join(whole, pair).withColumns({"r": promo.rank_of_text(F.col("promotion_type")), "p": F.coalesce(cut, said), "weight": earns})
    one = rows.groupBy(*pair, "n_products", "own_product").agg(F.max("own_rank").alias("own_rank"), F.max("own_pct").alias("own_pct"), F.max("weight").alias("weight"), F.min(F.struct("r", (-F.col("p")).alias("p"))).alias("x"))
    zero, none = F.lit(0.0), F.lit("")
    one = one.withColumn("label", promo.verdict(F.col("own_rank"), F.col("x.r"), F.col("own_pct"), -F.col("x.p"), F.lit(0), zero, zero, none, none))
    won = F.sum(F.when(F.col("label") == "SUPERIORITY", F.col("weight")).when(F.col("label") == "PARITY", 0.5 * F.col("weight")).otherwise(0.0))
    out = one.groupBy(*pair, "n_products").agg((won / F.sum("weight")).alias("s")).where("s is not null")
    label = F.when(F.col("s") >= AHEAD, "SUPERIORITY").when(F.col("s") >= LEVEL, "PARITY").otherwise("INFERIORITY")
    return out.select(*pair, "n_products", text.rounded(F.col("s"), 3).alias("share"), label.alias("parity_product"))


class Rivals:
    """The promoted products of one block of competitors, as arrays in order of competitors and promotions."""

    def __init__(self, menus: list[list[dict]], known: dict[str, dict[str, float]], made: dict[str, likeness.Sorted]) -> None:
        rows = sorted(((c, x["r"], -x["p"], x["a"], x["comp_price"]) for c, menu in enumerate(menus) for x in menu), key=lambda r: r[:3])
        self.names, self.known, self.made = list({r[3]: 0 for r in rows}), known, made
        name = {a: k for k, a in enumerate(self.names)}
        self.of, self.name = (np.array(x, np.int64) for x in ([r[0] for r in rows], [name[r[3]] for r in rows]))
        self.rank, self.pct, self.price = (np.array(x, float) for x in ([r[1] for r in rows], [-r[2] for r in rows], [r[4] for r in rows]))  # no price is NaN
        self.size = np.bincount(self.of, minlength=len(menus))
        self.forget()

    def forget(self) -> None:
        self.at, self.matrix = {}, np.zeros((len(self.names), 0))

    def _score(self, a: str, b: str) -> float:
        row = self.known.setdefault(a, {})
        if b not in row:
            x, y = (self.made.get(n) or self.made.setdefault(n, likeness.Sorted(n)) for n in (a, b))
            row[b] = x.score(y)
        return row[b]

    def _scores(self, menu: list[str]) -> np.ndarray:
        """Scores of all names of the block with those of a menu, which stores share mostly."""
        if len(self.names) * (len(self.at) + len(menu)) > HELD:
            self.forget()
        fresh = list({b: 0 for b in menu if b not in self.at})
        if fresh:
            self.matrix = np.hstack([self.matrix, np.array([[self._score(a, b) for b in fresh] for a in self.names])])
            self.at |= {b: len(self.at) + k for k, b in enumerate(fresh)}
        return self.matrix[:, [self.at[b] for b in menu]]

    def worst(self, menu: list[str], price: np.ndarray, rank: np.ndarray, pct: np.ndarray, weight: np.ndarray) -> int | None:
        """The worst verdict on a store, as a place in SEVERITY; nothing where no competitor's products are all matched."""
        scores = self._scores(menu)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :TOP]  # names alike stand in order of products
        near = np.take_along_axis(scores, order, 1)
        counts = near >= np.maximum(near[:, :1] - NEAR, LEAST)
        counts[:, 0] = True
        place, cost = order[self.name], self.price[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            own = price[place]
            apart = np.where(own > 0, _half_up(np.abs(cost - own) / np.maximum(cost, own), 9), 9.9)
            apart = np.where(counts[self.name], np.where(np.isnan(cost), 0.0, apart), np.inf)
            pick = apart.argmin(axis=1)[:, None]  # the first of the nearest
            place, score = np.take_along_axis(place, pick, 1)[:, 0], np.take_along_axis(near[self.name], pick, 1)[:, 0]
            own = price[place]
            close = (self.price > 0) & (own > 0) & (np.abs(_half_up((self.price - own) / own * 100, 1)) <= GAP)
        auto = (score >= AUTO) | ((score >= LEAST) & close)
        whole = (np.bincount(self.of, weights=auto, minlength=len(self.size)) == self.size) & (self.size >= PRODUCTS)
        some = np.flatnonzero(whole[self.of])
        if not some.size:
            return None
        key = self.of[some] * len(menu) + place[some]
        by = np.argsort(key, kind="stable")
        first = by[np.flatnonzero(np.diff(key[by], prepend=-1))]  # each own product meets its strongest promotion
        some, place = some[first], place[some[first]]
        g, d, gp, dp = rank[place], self.rank[some], np.nan_to_num(pct[place]), self.pct[some]
        even = (g == d) & ((g == 2.0) | (g == 3.0)) & (gp > 0) & (dp > 0)
        won = np.where((g < d) | (even & (gp - dp >= promo.POINTS)), 1.0, np.where((g > d) | (even & (gp - dp <= -promo.POINTS)), 0.0, 0.5))
        earns = np.where(weight[place] > 0, weight[place], np.where(price[place] > 0, price[place], 1.0))
        won, all_of = (np.bincount(self.of[some], weights=x, minlength=len(self.size))[whole] for x in (won * earns, earns))
        share = (won / all_of).min()
        return 2 if share >= AHEAD else 1 if share >= LEVEL else 0


def _half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """text.rounded of arrays."""
    scaled = np.abs(x) * 10.0**digits
    low = np.floor(scaled)
    return np.copysign(low + (scaled - low >= 0.5), x) / 10.0**digits


def _worst_of_blocks(batches):
    """The worst verdict of each store in a block; a partition's rows come block by block, competitors first."""
    known: dict[str, dict[str, float]] = {}
    made: dict[str, likeness.Sorted] = {}
    at, rivals, menus = None, None, []
    for batch in batches:
        if len(made) > 100_000 or sum(map(len, known.values())) > HELD:
            known.clear()
            made.clear()
        cells = list(zip(*(batch.column(c).to_pylist() for c in ("city_code", "pool", "cell")), strict=True))
        sides, stores, products, lists = batch.column("side").to_pylist(), batch.column("store_name").to_pylist(), batch.column("products"), batch.column("menu")
        ends, sold = lists.offsets.to_numpy(), lists.values
        names = sold.field("b").to_pylist()
        numbers = [sold.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("own_price", "own_rank", "own_pct", "weight")]
        out = []
        for k, cell in enumerate(cells):
            if cell != at:
                at, rivals, menus = cell, None, []
            if not sides[k]:
                menus.append(products[k].as_py())
                continue
            if rivals is None and menus:
                rivals, menus = Rivals(menus, known, made), []
            if rivals is not None and ends[k] < ends[k + 1]:
                part = slice(ends[k], ends[k + 1])
                worst = rivals.worst(names[part], *(x[part] for x in numbers))
                if worst is not None:
                    out.append({"city_code": cell[0], "store_name": stores[k], "worst": worst})
        yield pa.RecordBatch.from_pylist(out, WORST)


def worst_of_pools(links: DataFrame, pools: DataFrame, comp: DataFrame, own: DataFrame, block: int | None = None) -> DataFrame:
    """Each store's worst of product_verdicts(best_of_pools(...)), without a row for any pair of menus.

    A pool's competitors are dealt to blocks; each store of the pool meets each block in a task that holds the
    block and reads stores one by one, and gives one verdict for each.
    """
    city, key = "city_code", ["city_code", "pool", "cell"]
    cut = text.percent_off(F.col("comp_price"), F.col("comp_cut")) if "comp_cut" in comp.columns else F.lit(None)
    told = {"a": text.token_sort(text.product_name(F.col("comp_product"))), "r": promo.rank_of_text(F.col("promotion_type")), "p": F.coalesce(cut, promo.percent_of_text(F.col("promotion_type")))}
    menus = comp.withColumns(told).groupBy(city, "comp_name").agg(F.collect_list(F.struct("a", "comp_price", "r", "p")).alias("products")).where(F.size("products") >= PRODUCTS)
    stores, members = pool_pairs(links, pools)
    sizes = members.groupBy(city, "pool").agg(F.ceil(F.count("*") / (BLOCK if block is None else block)).cast("int").alias("n"))
    blocks = sizes.where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # a number
    tasks = min(blocks + int(comp.sparkSession.conf.get("spark.sql.shuffle.partitions")), TASKS)  # work grows with pairs and not with bytes
    sold = ["own_product", "own_price", "own_rank", "own_pct", "weight"]
    mine = own.withColumn("b", text.token_sort(text.product_name(F.col("own_product")))).groupBy(city, "store_name").agg(F.sort_array(F.collect_list(F.struct(*sold, "b"))).alias("menu"))
    mine = stores.join(mine, [city, "store_name"]).join(sizes, [city, "pool"]).select(city, "pool", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("cell"), F.lit(1).alias("side"), "store_name", "menu")
    theirs = members.join(sizes, [city, "pool"]).join(menus, [city, "comp_name"]).select(city, "pool", F.pmod(F.xxhash64("comp_name"), F.col("n")).cast("int").alias("cell"), F.lit(0).alias("side"), "products")
    rows = theirs.unionByName(mine, allowMissingColumns=True).repartition(tasks, *key).sortWithinPartitions(*key, "side")
    worst = rows.mapInArrow(_worst_of_blocks, "city_code string, store_name string, worst int").groupBy(city, "store_name").agg(F.min("worst").alias("worst"))
    return worst.select(city, "store_name", F.get(F.array(*map(F.lit, SEVERITY)), F.col("worst")).alias("parity_product"))


def override(verdicts: DataFrame, products: DataFrame) -> DataFrame:
    """A store's worst product verdict replaces its own, but for basket promotions and unmatched stores."""
    severity = F.when(F.col("parity_product") == "INFERIORITY", 0).when(F.col("parity_product") == "PARITY", 1).otherwise(2)
    worst = products.groupBy("city_code", "store_name").agg(F.min_by("parity_product", severity).alias("by_product"))
    takes = F.col("parity").isin(*MATCHED) & F.col("by_product").isNotNull() & (F.coalesce("best_promo_type", F.lit("")) != "BASKET_PERCENTAGE")
    return verdicts.join(worst, ["city_code", "store_name"], "left").withColumn("parity", F.when(takes, F.col("by_product")).otherwise(F.col("parity"))).drop("by_product")


def filtered_rollup(verdicts: DataFrame) -> DataFrame:
    """The roll-up of some stores only: all of them are the coverage's base, groups without a match have no row."""
    count = lambda *names: F.count(F.when(F.col("parity").isin(*names), 1))
    total = lambda *names: F.sum(F.when(F.col("parity").isin(*names), F.coalesce("revenue", F.lit(0.0))).otherwise(0.0))
    sums = [f(v).alias(f"{p}_{v.lower()}") for p, f in (("n", count), ("r", total)) for v in MATCHED]
    out = verdicts.groupBy("city_code", "week_num").agg(F.count("*").alias("n_stores_total"), count(*MATCHED).alias("n_stores_matched"), total(*MATCHED).alias("r"), *sums).where("n_stores_matched > 0")
    for v in map(str.lower, MATCHED):
        out = out.withColumn(f"pct_{v}", F.round(F.col(f"n_{v}") / F.col("n_stores_matched") * 100, 1))
        out = out.withColumn(f"w_{v}", F.when(F.col("r") > 0, F.round(F.col(f"r_{v}") / F.col("r") * 100, 1)).otherwise(F.col(f"pct_{v}")))
    top = F.greatest("w_superiority", "w_parity", "w_inferiority")
    label = F.when(F.col("w_superiority") == top, "SUPERIORITY").when(F.col("w_parity") == top, "PARITY").otherwise("INFERIORITY")
    out = out.withColumns({"city_parity_label": label, "match_coverage_pct": F.round(F.col("n_stores_matched") / F.col("n_stores_total") * 100, 1)})
    return out.drop("r", *[f"r_{v.lower()}" for v in MATCHED])


def manual_override(verdicts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Stores that a person marked; absent from the other side wins over exclusive."""
    marks = mapping.where(F.col("source").isin("manual_rejected", "not_on_comp")).groupBy("city_code", "store_name").agg(F.max(F.when(F.col("source") == "not_on_comp", "NOT_ON_COMP").otherwise("EXCLUSIVE_OWN")).alias("mark"))
    out = verdicts.join(marks, ["city_code", "store_name"], "left")
    return out.withColumns({"parity": F.coalesce("mark", "parity"), "name_norm": F.when(F.col("mark").isNull(), F.col("name_norm")).otherwise("")}).drop("mark")


def open_stores(stores: DataFrame, mapping: DataFrame, review: DataFrame) -> DataFrame:
    """Stores that neither a rejection nor an open review settles yet."""
    key = ["city_code", "store_name"]
    return stores.join(mapping.where("source = 'manual_rejected'"), key, "left_anti").join(review, key, "left_anti")


def match_summary(best: DataFrame) -> DataFrame:
    """Matches by kind, their share, and those that a price confirms."""
    rows = best.groupBy("match_type").agg(F.count("*").alias("n"), F.count(F.when(F.col("price_confirmed"), 1)).alias("n_confirmed"))
    return rows.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 1))  # a row a kind
