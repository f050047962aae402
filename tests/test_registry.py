"""Tables by name from whichever source is there, and a person's commands."""

import random

import pytest

from promolens.operators import commands, publish
from promolens.plans import catalogue, registry, streams  # noqa: F401
from promolens.streaming import arrival

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()))


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("parquet") + plan.count("csv")


def test_first_source_that_is_there(spark, tmp_path):
    folder, shape = str(tmp_path), "city_code string, week_num string, w double"
    asked = []

    def watched(name):
        return registry.made(lambda r: asked.append(name) or spark.createDataFrame([("Z", name, "9.5")], "city_code string, week_num string, w string"))

    (tmp_path / "city_2026-W01.csv").write_text("city_code,w\nA,1.5\nB,bad\n")
    make = lambda: registry.Registry(spark).add("cities", registry.published(folder, "city_parity"), registry.archived(f"{folder}/city_*.csv"), watched("last"), schema=shape).add("other", watched("other")).add("none", registry.parquet(f"{folder}/none"), schema=shape).add("lost", registry.parquet(f"{folder}/none"))
    get = make()
    assert rows(get("cities").fillna(-1.0)) == [("A", "2026-W01", 1.5), ("B", "2026-W01", -1.0)]
    assert asked == [] and scans(get("cities")) == 1  # nothing but what was asked for
    assert get("none").count() == 0 and get("none").columns == ["city_code", "week_num", "w"]
    with pytest.raises(FileNotFoundError):
        get("lost")
    with pytest.raises(KeyError, match="cities"):
        get("unheard")
    publish.publish(spark, {"city_parity": spark.createDataFrame([("P", "1", 2.0, 1)], "city_code string, week_num string, w double, seq long")}, folder)
    assert get("cities").count() == 2  # as planned before
    get.forget("cities")
    assert rows(get("cities")) == [("P", "1", 2.0)] and rows(make()("other")) == [("Z", "other", "9.5")] and asked == ["other"]


def test_logs_over_mappings(spark):
    mapping = spark.createDataFrame([("A", "1", "Old", "seed"), ("A", "2", "Old", "seed"), ("A", "3", "", "manual_rejected")], "city_code string, store_name string, comp_name string, source string")
    log = spark.createDataFrame([("A", "1", 1, "New", "x"), ("A", "3", 2, "New", "x")], "city_code string, store_name string, seq long, name string, source string")
    review = spark.createDataFrame([("A", "1", 0.8), ("A", "9", 0.7)], "city_code string, store_name string, score double")
    get = registry.Registry(spark).add("log", registry.made(lambda r: log)).add("mapping", registry.made(lambda r: mapping), overlay=registry.decided("log")).add("review", registry.made(lambda r: review), overlay=registry.unsettled("log"))
    assert rows(get("mapping"), "store_name", "comp_name", "source") == [("1", "New", "manual_confirmed"), ("2", "Old", "seed"), ("3", "", "manual_rejected")]
    assert rows(get("review"), "store_name") == [("9",)]


def test_dashboards_run_from_published_tables(spark, tmp_path):
    """The same figures from the registry's published copies as from the tables they were made of."""
    source = registry.Tables(spark, SF)
    get = registry.Registry(spark)
    for name in ("own_products", "comp_raw", "mapping", "order_values", "managers", "lineitem"):
        source(name).write.parquet(f"{tmp_path}/{name}/v=0")
        get.add(name, registry.published(str(tmp_path), name), schema=source(name).schema)
    assert rows(catalogue._cities(get)) == rows(catalogue.QUERIES["city_parity_flagship"](spark, SF))
    assert scans(get("managers")) == 1


def plain(mapping, todo):
    """The commands one by one."""
    state = {}
    for c, s, n, src in mapping:
        state.setdefault((c, s), []).append((n, src))
    settled = set()
    for c, s, _, action, names in sorted(set(todo), key=lambda x: x[2]):
        names = list(dict.fromkeys(n.strip(" ") for n in names if n and n.strip(" ")))
        action, have = action.strip().lower(), state.get((c, s), [])
        if action not in ("confirm", "set", "remove", "reject", "absent") or action in ("confirm", "remove") and not names:
            continue
        made = [(n, "manual_confirmed") for n in names]
        state[c, s] = {"confirm": [r for r in have if r[0] and r[0] not in names] + made, "set": made, "remove": [r for r in have if r[0] not in names], "reject": [("", "manual_rejected")], "absent": [("", "not_on_comp")]}[action]
        if action != "remove":
            settled.add((c, s))
    return sorted((*k, *r) for k, v in state.items() for r in v), settled


@pytest.mark.parametrize("seed", [61, 62])
def test_commands_in_any_arrival(spark, seed):
    rng = random.Random(seed)
    base = list({("A", str(rng.randrange(12)), rng.choice("pqr"), "seed") for _ in range(14)})
    todo = [("A", str(rng.randrange(12)), k, rng.choice([" Confirm", "set", "remove", "REJECT", "absent", "unheard"]), tuple(rng.choice(["p", " q ", "", "r", None]) for _ in range(rng.randrange(3)))) for k in range(60)]
    folder = arrival.new_folder(spark, "commands")
    mapping = spark.createDataFrame(base, "city_code string, store_name string, comp_name string, source string")
    review = spark.createDataFrame([("A", str(k), k) for k in range(14)], "city_code string, store_name string, score int")
    cuts = [todo[30:], todo[:30], todo[10:20]]  # out of order, and some twice
    for part in cuts:
        spark.createDataFrame(part, commands.COMMAND).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        commands.take(spark.readStream.schema(commands.COMMAND).parquet(f"{folder}/in"), folder)
    after, left = commands.apply(mapping, review, commands.log(spark, folder))
    want, settled = plain(base, todo)
    assert rows(after) == want
    assert {r["store_name"] for r in left.collect()} == {str(k) for k in range(14)} - {s for _, s in settled}
    get = registry.Registry(spark).add("base", registry.made(lambda r: mapping)).add("mapping", registry.made(lambda r: r("base")), overlay=registry.commanded("base", folder))
    assert rows(get("mapping")) == want
