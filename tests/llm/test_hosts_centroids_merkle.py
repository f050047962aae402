"""URL filters, centroid clustering and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from promolens.llm import centroids, hosts, merkle, queries
from tests.llm.test_operators import CLASH, empty, key, odd, same, small  # noqa: F401  (fixtures)

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


# --- plain versions ---


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    end = min([k for c in "?#" if (k := rest.find(c)) >= 0], default=len(rest))
    host, _, path = rest[:end].partition("/")
    path = rest[len(host) : end]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in hosts.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def clusters(rows, count=40, rounds=5):
    kept = [(i, tuple(math.floor(256 * float(x)) for x in e)) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:count]
    c = [q for _, q in seeds]
    if not c:
        return []
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, v, strict=True)), k) for k, v in enumerate(c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, q in kept:
            groups[near(q)[1]].append(q)
        c = [tuple(sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)) if k in groups else v for k, v in enumerate(c)]
    found = [(i, *near(q)) for i, q in kept]
    each = Counter()
    for _, d, k in found:
        each[k] += d
    held = lambda x: min(x, 2**63 - 1)  # noqa: E731  (what a long can say)
    return [(i, k, held(d), held(each[k]), held(sum(each.values())), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for i, d, k in found]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def climb(nodes):
    """The root, and each node's siblings by level as (before, behind)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 3] for k in range(0, len(nodes), 3)]
        for own, path in zip(at, paths, strict=True):
            run, inside = runs[own // 3], own % 3
            path.append(("".join(run[:inside]), "".join(run[inside + 1 :])))
        at, nodes = [k // 3 for k in at], [digest(*run) for run in runs]
    return nodes[0], paths


def merkle_rows(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names, subs, inner = sorted(groups, key=lambda s: (s is not None, (s or "").encode())), [], {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        root, inner[s] = climb([x[2] for x in groups[s]])
        subs.append(root)
    if not names:
        return []
    root, outer = climb(subs)
    out = []
    for s, sub, above in zip(names, subs, outer, strict=True):
        for (_, _, own, r), path in zip(groups[s], inner[s], strict=True):
            path, node = path + above, own
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                node = leaf(r, r["text"].replace("\n", ""))
            for a, b in path:
                node = digest(a, node, b)
            out.append((r["doc_id"], own, sub, root, digest(*(a + b for a, b in path)), node, node == root))
    return out


# --- url filters ---

URLS = ["https://A.Example.NET/en/1?q=http://x.org/", "http://example.net", "http://example.net/", "//no", None, "", "x://", "ftp://user@Example.com:80/de/x#y", "http://example.com/de/1", "http://notexample.com/de/1", "http://sub.example.com/de?x",
        "http://x.org/fr/a/b", "http://org/fr/", "http://x.org?/fr/", "http://É.ORG/fr/", "http://a://b/c", "http://net/x", "http://planet/x", "http://x.net#/en/"]


@pytest.fixture(scope="module")
def pages(spark):
    out = spark.createDataFrame([(k, u, None if k % 3 else f"<article><h1>t</h1><p>text {k} &amp; more</article>") for k, u in enumerate(URLS)] + [(1, URLS[1], "x"), (None, URLS[2], "")], "page_id long, url string, html string")
    for name in (*CLASH, "host", "verdict", "digest", "bad", "domain", "_rows"):
        out = out.selectExpr("*", f"'clash' as {name}")
    return out


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("which", ["odd", "small", "empty"])
def test_urls(spark, pages, which, request):
    docs = request.getfixturevalue(which)
    if which == "small":
        pages, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("pages", "labels"))
    else:
        labels = labels_of(spark, [] if which == "empty" else [(1, None, None), (5, 0, None), (5, 1, 1), (None, 1, 1), (99, 0, 0)])
    got = hosts.judge_urls(pages, docs, labels).collect()
    want = [(r["page_id"], *split_url(r["url"])) for r in pages.select("page_id", "url").collect()]
    same([tuple(r[:3]) for r in got], want)
    for r in got:
        rule, verdict = rule_for(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] == (verdict or ("block" if r["bound"] > hosts.MOST_BAD else "allow"))
    assert hosts.judge_urls(pages.limit(0), docs, labels).count() == 0


def test_pages_find_their_labels(spark):
    """Every page's article is some document, so outcomes equal those of a plain join of texts."""
    import html
    import re

    pages, docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("pages", "documents", "labels"))
    bare = lambda t: "".join(t.split())
    said = {r["doc_id"]: r["quality"] == 0 or r["toxic"] == 1 for r in labels.collect()}
    by_text = defaultdict(set)
    for r in docs.collect():
        if r["text"]:
            by_text[bare(r["text"])].add(said.get(r["doc_id"]))
    want, texts = defaultdict(set), 0
    for r in pages.collect():
        article = re.search("<article><h1>.*?</h1>(.*?)</article>", r["html"], re.S)[1]
        text = bare(html.unescape(re.sub("<[^>]*>", "", article)))
        texts += text in by_text
        if by_text[text] - {None}:
            want[split_url(r["url"])[0]].add((text, True in by_text[text]))
    assert texts == pages.count()
    got = {r["host"]: (r["host_pages"], r["host_bad"]) for r in hosts.judge_urls(pages, docs, labels).collect()}
    assert got == {h: (len(want[h]), sum(b for _, b in want[h])) for h in got}
    assert len(want) > 20


def test_beta_arithmetic():
    x = np.array([0.1, 0.5, 1.0, 3.7, 9.99, 10.0, 55.5, 1e4])
    assert np.allclose(hosts.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9)
    rng = random.Random(31)
    for _ in range(60):  # whole numbers: the chance of at least a successes in a + b - 1 draws
        a, b, p = rng.randrange(1, 40), rng.randrange(1, 40), rng.random()
        n = a + b - 1
        want = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(a, n + 1))
        assert abs(hosts.beta_below(np.array([p]), np.array([float(a)]), np.array([float(b)]))[0] - want) < 1e-9
    a, b = np.array([0.3, 2.0, 900.0, 2e6]), np.array([4.0, 2.0, 100.0, 3e6])
    low = hosts.lower_bound(a, b, 0.95)
    assert np.allclose(hosts.beta_below(low, a, b), 0.05, atol=1e-6) and (low < a / (a + b)).all()


def test_domains(spark):
    names = {"a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"), "": ("", ""), "x.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "u@a.de:80": ("a.de", "de"), "1.2.3.4:8080": ("1.2.3.4", "1.2.3.4"), "a.b.": ("a.b", "b"), "[::1]": ("[::1]", "[::1]")}
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(h,) for h in names], "host string").select("host", *hosts.domain_parts(F.col("host"))).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == names


def _plain_reputation(trials, certainty):
    """The same tree in plain loops, likelihoods by math.lgamma."""
    beta = lambda a, b: math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    parent = lambda level, name: "" if level == "suffix" else name.split(".")[-1] if level == "domain" else ".".join(name.split(".")[-2:])
    host = {h: (n, x) for h, n, x in trials}
    up = lambda level, children: {p: tuple(map(sum, zip(*[v for c, v in children.items() if parent(level, c) == p], strict=True))) for p in {parent(level, c) for c in children}}
    domain = up("host", host)
    suffix = up("domain", domain)
    n, x = map(sum, zip(*suffix.values(), strict=True))
    mean, size, out = {"": (x + 0.5) / (n + 1)}, {"": n}, {}
    for level, groups in (("suffix", suffix), ("domain", domain), ("host", host)):
        informed = [(v, mean[parent(level, g)]) for g, v in groups.items() if 0 < v[0] < size[parent(level, g)]]
        best = max((round(sum(beta(m * k + x, (1 - m) * k + n - x) - beta(m * k, (1 - m) * k) for (n, x), m in informed), 6), k) for k in hosts.STRENGTHS)[1]
        out = {g: (x + best * mean[parent(level, g)], n - x + best * (1 - mean[parent(level, g)])) for g, (n, x) in groups.items()}
        mean, size = {g: a / (a + b) for g, (a, b) in out.items()}, {g: v[0] for g, v in groups.items()}
    return {h: (*map(float, ab), float(hosts.lower_bound(np.array([ab[0]]), np.array([ab[1]]), certainty)[0])) for h, ab in out.items()}


def test_reputation_shrinks_and_decides(spark):
    rng = random.Random(32)
    trials, truth = [], {}
    for d in range(60):  # hosts of a domain are alike, some domains are bad
        rate = 0.9 if d % 6 == 0 else 0.1
        for h in range(8):
            name, n = f"h{h}.d{d}.{'bad' if d % 6 == 0 and d % 4 else 'com'}", rng.choice((0, 1, 3, 10, 200))
            truth[name] = rate
            trials.append((name, n, sum(rng.random() < rate for _ in range(n))))
    got = {r["host"]: r for r in hosts.host_reputation(spark.createDataFrame(trials, "host string, pages long, bad long")).collect()}
    want = _plain_reputation(trials, hosts.CERTAINTY)
    assert got.keys() == want.keys()
    for h, (a, b, bound) in want.items():
        assert math.isclose(got[h]["a"], a, rel_tol=1e-9) and math.isclose(got[h]["b"], b, rel_tol=1e-9) and abs(got[h]["bound"] - bound) < 1e-9
    blocked = {h for h, r in got.items() if r["bound"] > hosts.MOST_BAD}
    assert not any(truth[h] < 0.5 for h in blocked)  # clean hosts stay
    assert len(blocked) >= 0.9 * sum(t > 0.5 for t in truth.values())
    assert any(got[h]["pages"] == 0 for h in blocked)  # a host without labels is known by its domain


def test_bad_hosts_are_blocked(spark):
    docs = spark.createDataFrame([(k, f"junk number {k} here") for k in range(40)] + [(100 + k, f"fine text {k} here") for k in range(200)], "doc_id long, text string")
    labels = labels_of(spark, [(k, 0, 0) for k in range(40)] + [(100 + k, 1, 0) for k in range(200)])
    page = lambda k, host, text: (k, f"http://{host}/p/{k}", f"<html><nav>menu</nav><article><h1>x</h1><p>{text}</p></article></html>")
    rows = [page(k, "bad.one.com", f"junk <b>number</b> {k} here") for k in range(40)] + [page(100 + k, f"h{k % 5}.two.com", f"fine text {k} here") for k in range(200)] + [page(900, "bad.one.com", "never seen")]
    got = {r["page_id"]: r["verdict"] for r in hosts.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), docs, labels).collect()}
    assert all(got[k] == "block" for k in [*range(40), 900]) and all(got[100 + k] == "allow" for k in range(200))


def test_articles_take_linear_time():
    import time

    began = time.process_time()
    for text in ("<" * 1_000_000, "<article>" * 100_000, "<h1>" * 200_000, "&" * 500_000, "<a" * 400_000 + ">"):
        hosts.article_text(text)
    assert time.process_time() - began < 5
    assert hosts.article_text("a <i>b</i>&nbsp;c") == "abc" and hosts.article_text("") == "" and hosts.article_text("x<article>y") == "y"


# --- centroids ---


def vectors(n, copies=0, seed=33, scale=1.0):
    rng = random.Random(seed)
    one = lambda: [rng.gauss(0, scale) for _ in range(64)]
    base = [one() for _ in range(n)]
    return [(k, v, 0) for k, v in enumerate(base)] + [(1000 + k, base[0] if k % 2 else base[k % 5], 1) for k in range(copies)]


ODD = [(None, [0.5] * 64, 1), (2001, None, 1), (2002, [], 1), (2003, [1.0] * 63, 1), (2004, [1.0] * 65, 1), (2005, [1.0] * 63 + [None], 1), (2006, [1.0] * 63 + [float("nan")], 1), (2007, [float("inf")] + [1.0] * 63, 1), (2008, [0.25] * 64, None), (2008, [0.75] * 64, 3), (2008, [0.75] * 64, 3)]


@pytest.mark.parametrize("rows", [vectors(90, 60) + ODD, vectors(12), ODD[:1], [], vectors(50, scale=1e4), vectors(45, scale=1e7)], ids=["odd", "few", "no id", "empty", "large", "huge"])
def test_centroids(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    for name in (*CLASH, "q", "cluster", "distance", "inertia"):
        df = df.selectExpr("*", f"'clash' as {name}")
    same(centroids.cluster_vectors(df.repartition(3)).collect(), clusters([(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]))


def test_distances_are_exact():
    rng = random.Random(34)
    for size in (100, 1 << 21, 1 << 30, 2**62):
        some = [[rng.randrange(-size, size) for _ in range(64)] for _ in range(30)]
        which, far = centroids.nearest(np.array(some), some[:7])
        for q, k, d in zip(some, which, far, strict=True):
            assert (d, k) == min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), i) for i, c in enumerate(some[:7]))


def test_weights_are_counted_exactly(spark):
    df = spark.createDataFrame([([2**40 + k] * 64, 2**40 + k) for k in range(5)], "q array<long>, n long")
    got = centroids.weighted_sums(df, [[2**40] * 64])
    assert got == {0: (sum(2**40 + k for k in range(5)), [sum((2**40 + k) ** 2 for k in range(5))] * 64)}


# --- Merkle manifest ---


@pytest.mark.parametrize("which", ["odd", "small", "empty"])
@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(which, levels, request, monkeypatch):
    """Blocks of any size give one and the same tree."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "POWERS", [3**k for k in range(levels)])
    docs = request.getfixturevalue(which)
    same(merkle.verify_manifest(docs).collect(), merkle_rows(docs.select(*merkle.FIELDS).collect()))


def test_every_size_of_tree(spark):
    rows = [(100 * n + k, f"line {k}\nend", "en", f"s{n:02}", k) for n in range(1, 30) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same(merkle.verify_manifest(docs).collect(), merkle_rows(docs.collect()))


def test_tampering_is_found(spark):
    docs = spark.createDataFrame([(k, "a\nb" if k % 3 else "ab", "en", "s", 3) for k in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["verified"] for r in merkle.verify_manifest(docs).collect()}
    assert got == {k: not (k % 3 and zlib.crc32(str(k).encode()) % 2 == 0) for k in range(60)}


def test_hot_tree_spreads(spark):
    """A source of a third of all rows, and equal rows of one id, are dealt over many tasks."""
    docs = spark.range(6000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end as tree", "case when id % 3 = 0 then 7 else id end as doc_id", "'x' as node")
    got = merkle.ranked(docs, ["doc_id", "node"]).collect()
    places = defaultdict(list)
    for r in got:
        places[r["tree"]].append(r["pos"])
        assert r["count"] > 0
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places["hot"]) >= 2000


# --- SQL ---


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_duckdb(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{sf}/{t}.parquet'")
    df, rel = queries.QUERIES[name](spark, f"/root/testdata/{sf}"), con.sql(queries.ORACLE_SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    same(df.select(*rel.columns).collect(), rel.fetchall())
