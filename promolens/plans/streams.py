"""Queries that run as streams over ``events``, with SQL that says the same of the whole table; they join the catalogue on import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.operators import commands
from promolens.plans import catalogue
from promolens.plans.bridge import load, oracle
from promolens.streaming import arrival, fold, listing, sink

#: Events as rows of a listing: a user's events tell promotions of a store; an hour of a city is a point.
_ROWS = """SELECT concat('C', CAST(user_id % 12 AS STRING)) AS city_code, {store} AS store_name, {promotion} AS promotion,
  CASE WHEN event_id % 3 = 0 THEN concat('https://x.example/', CAST(event_id AS STRING)) ELSE '' END AS url, event_id AS seq, CAST(ts AS TIMESTAMP) AS ts FROM {events}"""
_BY_USER = {"store": "concat('U', CAST(user_id AS STRING))", "promotion": "concat(event_type, ' | ', CAST(CAST(floor(value / 50) AS INT) AS STRING), '0% |')"}
_BY_KIND = {"store": "event_type", "promotion": "'20% di sconto'"}
_LATE, _MOST = 5, 3


def query(sql: str):
    """Register a function (spark, sf_dir, folder) under its name, with its SQL."""

    def add(f):
        catalogue.QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, sf_dir, arrival.new_folder(spark, f.__name__))
        catalogue.ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf_dir: str, shape: dict[str, str] | None = None) -> DataFrame:
    events = load(spark, sf_dir, "events")
    if shape is None:
        return events.withColumn("ts", F.col("ts").cast("timestamp"))
    return spark.sql(_ROWS.format(events="{events}", **shape), events=events)


def _plain_time(df: DataFrame) -> DataFrame:
    """Times as text, so that no reader's zone or precision shows in them."""
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in df.schema])


_TEXT = "strftime(CAST({0} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
_SQL_ROWS = lambda shape: f"rows AS ({_ROWS.format(events='events', **shape)})"
_LISTING = f"""WITH {_SQL_ROWS(_BY_USER)}, parts AS (SELECT city_code, store_name, seq, unnest(list_transform(string_split(promotion, '|'), lambda p: trim(p))) AS p, generate_subscripts(string_split(promotion, '|'), 1) AS k FROM rows),
  first AS (SELECT city_code, store_name, p, min((seq, k)) AS place FROM parts WHERE p <> '' GROUP BY ALL),
  names AS (SELECT city_code, store_name, string_agg(p, ' | ' ORDER BY place) AS promotions FROM first GROUP BY ALL)
  SELECT n.*, u.url, u.last_seen FROM names n JOIN (SELECT city_code, store_name, coalesce(arg_min(url, seq) FILTER (url <> ''), '') AS url, {_TEXT.format('max(ts)')} AS last_seen FROM rows GROUP BY ALL) u USING (city_code, store_name)"""


@query(_LISTING)
def listing_stream(spark, sf_dir, folder):
    """The last state of every store, of what the stream told as changed."""
    rows = arrival.arrivals(_events(spark, sf_dir, _BY_USER), "seq", f"{folder}/in")
    arrival.drain(listing.listing_changes(rows), folder, "update")
    return _plain_time(listing.listing_now(arrival.drained(spark, folder, listing.LISTED)))


@query(f"""WITH {_SQL_ROWS(_BY_KIND)}, timed AS (SELECT *, date_trunc('hour', ts) AS point FROM rows),
  closed AS (SELECT * FROM timed WHERE point + INTERVAL 1 HOUR <= (SELECT max(ts) FROM timed) - INTERVAL {_LATE} DAY),
  fresh AS (SELECT city_code, store_name, promotion, min(point) AS point FROM closed GROUP BY ALL),
  points AS (SELECT city_code, point, string_agg(DISTINCT store_name, ',' ORDER BY store_name) AS said FROM closed GROUP BY ALL),
  news AS (SELECT p.*, (SELECT count(*) FROM fresh f WHERE f.city_code = p.city_code AND f.point = p.point) AS new_info FROM points p),
  marks AS (SELECT *, CASE WHEN new_info > 0 OR said IS DISTINCT FROM lag(said) OVER (PARTITION BY city_code ORDER BY point) THEN 1 ELSE 0 END AS head FROM news),
  islands AS (SELECT *, sum(head) OVER (PARTITION BY city_code ORDER BY point) AS island FROM marks),
  streaks AS (SELECT *, row_number() OVER (PARTITION BY city_code, island ORDER BY point) - CASE WHEN max(new_info) OVER (PARTITION BY city_code, island) > 0 THEN 1 ELSE 0 END AS streak FROM islands),
  ends AS (SELECT city_code, min(point) FILTER (streak >= {_MOST}) AS last FROM streaks GROUP BY ALL)
  SELECT city_code, {_TEXT.format('point')} AS point, CAST(new_info AS INT) AS new_info, CAST(streak AS INT) AS streak, streak >= {_MOST} AS stopped FROM streaks JOIN ends USING (city_code) WHERE last IS NULL OR point <= last""")
def early_stop(spark, sf_dir, folder):
    """The points of each city up to the one after which it is passed over."""
    rows = arrival.arrivals(_events(spark, sf_dir, _BY_KIND), "seq", f"{folder}/in")
    arrival.drain(listing.early_stop(rows, _MOST, 3600, f"{_LATE} days"), folder, "append")
    return _plain_time(arrival.drained(spark, folder, listing.POINT).drop("batch"))


@query(f"""SELECT user_id, {_TEXT.format('ts')} AS last_seen, {_TEXT.format('ts + INTERVAL 6 HOUR')} AS deadline FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events)
  WHERE (next IS NULL OR next - ts >= INTERVAL 6 HOUR) AND ts + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL {_LATE} DAY""")
def inactivity(spark, sf_dir, folder):
    """Users that fell silent for six hours."""
    events = arrival.arrivals(_events(spark, sf_dir).select("event_id", "user_id", "ts"), "event_id", f"{folder}/in")
    arrival.drain(listing.silences(events, "user_id", "6 hours", f"{_LATE} days"), folder, "append")
    return _plain_time(arrival.drained(spark, folder, "user_id long, last_seen timestamp, deadline timestamp").drop("batch"))


@query(_LISTING)
def merge_run(spark, sf_dir, folder):
    """The stream goes into the table twice, the second time with a checkpoint of its own."""
    rows = arrival.arrivals(_events(spark, sf_dir, _BY_USER), "seq", f"{folder}/in")
    for run in ("first", "again"):
        sink.merge_run(rows, f"{folder}/table", run, f"{folder}/{run}")
    return _plain_time(sink.listing_of(sink.read_facts(spark, f"{folder}/table")))


@query("SELECT DISTINCT user_id, event_type FROM events")
def first_seen_stream(spark, sf_dir, folder):
    """Each key once, state bounded by the watermark (here longer than the table's time)."""
    events = arrival.arrivals(_events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts"), "event_id", f"{folder}/in")
    arrival.drain(fold.first_seen(events, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type"), folder, "append")
    return arrival.drained(spark, folder, "user_id long, event_type string").drop("batch")


@query(f"""SELECT {_TEXT.format("date_trunc('week', ts)")} AS week_start, event_type, count(*) AS n FROM events
  WHERE date_trunc('week', ts) + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL {_LATE} DAY GROUP BY ALL""")
def weekly_stream(spark, sf_dir, folder):
    """Counts of the weeks that the watermark has closed."""
    events = arrival.arrivals(_events(spark, sf_dir).select("event_id", "event_type", "ts"), "event_id", f"{folder}/in")
    counted = fold.weekly(events, "ts", f"{_LATE} days").select(F.col("window.start").alias("week_start"), "event_type", "n")
    arrival.drain(counted, folder, "append")
    return _plain_time(arrival.drained(spark, folder, "week_start timestamp, event_type string, n long").drop("batch"))


def _routing(wanted: str) -> str:
    """Commands of each store one by one, over lists of rows."""
    named = "list_filter(st, lambda r: r.c <> '')"
    return f"""cte: RECURSIVE cmd AS (SELECT city_code, store_name, seq, lower(trim(action)) AS action, list_filter(CASE WHEN trim(name1) = trim(name2) THEN [trim(name1)] ELSE [trim(name1), trim(name2)] END, lambda n: n <> '') AS names FROM commands),
      ok AS (SELECT *, row_number() OVER (PARTITION BY city_code, store_name ORDER BY seq) AS k FROM cmd WHERE action IN ('set', 'reject', 'absent') OR len(names) > 0),
      base AS (SELECT DISTINCT city_code, store_name, 'e' AS comp_name, 'seed' AS source FROM commands WHERE CAST(store_name AS BIGINT) % 2 = 0),
      run AS (SELECT DISTINCT o.city_code, o.store_name, 0 AS k, CASE WHEN b.comp_name IS NULL THEN [] ELSE [struct_pack(c := b.comp_name, s := b.source)] END AS st FROM ok o LEFT JOIN base b USING (city_code, store_name)
        UNION ALL SELECT r.city_code, r.store_name, r.k + 1, CASE o.action WHEN 'confirm' THEN list_concat(list_filter({named}, lambda r: NOT list_contains(o.names, r.c)), list_transform(o.names, lambda n: struct_pack(c := n, s := 'manual_confirmed')))
          WHEN 'set' THEN list_transform(o.names, lambda n: struct_pack(c := n, s := 'manual_confirmed')) WHEN 'remove' THEN list_filter(st, lambda r: NOT list_contains(o.names, r.c))
          WHEN 'reject' THEN [struct_pack(c := '', s := 'manual_rejected')] ELSE [struct_pack(c := '', s := 'not_on_comp')] END
        FROM run r JOIN ok o ON o.city_code = r.city_code AND o.store_name = r.store_name AND o.k = r.k + 1),
      done AS (SELECT city_code, store_name, arg_max(st, k) AS st FROM run GROUP BY ALL), open AS (SELECT DISTINCT city_code, store_name FROM commands)
      {wanted} /* commands */"""


def _routed(spark, sf_dir, folder):
    """Commands through a stream into the log, then over a mapping of which half the stores have a row."""
    told = load(spark, sf_dir, "commands").select("city_code", "store_name", F.col("seq").cast("long").alias("seq"), "action", F.array("name1", "name2").alias("names"))
    commands.take(arrival.arrivals(told, "seq", f"{folder}/in", 3), folder)
    stores = told.select("city_code", "store_name").distinct()
    base = stores.where(F.col("store_name").cast("long") % 2 == 0).withColumns({"comp_name": F.lit("e"), "source": F.lit("seed")})
    return commands.apply(base, stores, commands.log(spark, folder))


@query(oracle(_routing("SELECT city_code, store_name, x.c AS comp_name, x.s AS source FROM (SELECT city_code, store_name, unnest(st) AS x FROM done) UNION ALL SELECT * FROM base WHERE (city_code, store_name) NOT IN (SELECT (city_code, store_name) FROM done)")))
def command_mapping(spark, sf_dir, folder):
    """The mapping after all commands."""
    return _routed(spark, sf_dir, folder)[0]


@query(oracle(_routing("SELECT * FROM open WHERE (city_code, store_name) NOT IN (SELECT (city_code, store_name) FROM ok WHERE action <> 'remove')")))
def command_review(spark, sf_dir, folder):
    """What is left to review."""
    return _routed(spark, sf_dir, folder)[1]
