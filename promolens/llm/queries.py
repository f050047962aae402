"""The operators over their whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm import bpe, centroids, hosts, licenses, media, merkle, mixing, neardup, quality, secrets, substrings, tokens, toxicity
from promolens.llm.common import table


def op1_suffix_dedup(spark, sf_dir) -> DataFrame:
    return substrings.remove_shared_strings(table(spark, sf_dir, "documents"))


def op2_media_columns(spark, sf_dir) -> DataFrame:
    return media.digest_media(media.store_texts(table(spark, sf_dir, "documents")))


def op3_source_mix(spark, sf_dir) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_secret_scan(spark, sf_dir) -> DataFrame:
    return secrets.digest_secrets(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op5_license_scan(spark, sf_dir) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark, sf_dir) -> DataFrame:
    out = quality.judge_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op8_minhash_dedup(spark, sf_dir) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op9_token_counts(spark, sf_dir) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op10_bpe_codec(spark, sf_dir) -> DataFrame:
    return bpe.digest_encoding(table(spark, sf_dir, "documents"))


def op11_url_filter(spark, sf_dir) -> DataFrame:
    return hosts.judge_urls(*(table(spark, sf_dir, t) for t in ("pages", "documents", "labels")))


def op12_centroids(spark, sf_dir) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark, sf_dir) -> DataFrame:
    return merkle.verify_manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_media_columns, op3_source_mix, op4_secret_scan, op5_license_scan, op6_toxicity, op7_quality_rules, op8_minhash_dedup, op9_token_counts, op10_bpe_codec, op11_url_filter, op12_centroids, op13_merkle_manifest)}

def _lloyd_sql(count: int = centroids.CENTROIDS, rounds: int = centroids.ROUNDS) -> str:
    """Lloyd's rounds on all vectors, one by one."""
    steps = [
        "kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, q) - 1 AS k, q AS c FROM (SELECT sha256('2:' || vec_id) AS h, q FROM kept WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {count}))",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS (SELECT vec_id, q, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(q, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT), k := k)) AS m FROM (SELECT row_number() OVER () AS i, * FROM kept), c{r} GROUP BY i, vec_id, q)")
        if r < rounds:
            steps.append(f"u{r} AS (SELECT m.k AS k, unnest(q) AS v, generate_subscripts(q, 1) AS i FROM a{r})")
            steps.append(f"s{r} AS (SELECT k, i, sum(v) AS s, count(*) AS n FROM u{r} GROUP BY k, i)")
            steps.append(f"n{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY k)")
            steps.append(f"c{r + 1} AS (SELECT o.k, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN n{r} n ON o.k = n.k)")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(a.m.k AS INT) AS cluster, a.m.d AS distance, CAST(sum(a.m.d) OVER (PARTITION BY a.m.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.m.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.m.k = c.k"""


def _merkle_sql() -> str:
    """Trees by recursion over levels, proofs by joins with them."""
    part = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(part(x) for x in (*merkle.FIELDS[:-1], text))})"
    crc = "list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295)"
    grow = lambda name, keys: f"SELECT {keys}, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY {keys}, lvl, pos // 3, n"
    return f"""WITH RECURSIVE leaves AS (
            SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
            FROM (SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN ({crc}) % 2 = 1 THEN {leaf("replace(text, chr(10), '')")} END AS other FROM documents)),
        tree(source, lvl, pos, n, node) AS (SELECT source, 0, pos, n, leaf FROM leaves UNION ALL {grow("tree", "source")}),
        subroots AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos, count(*) OVER () AS sn FROM tree WHERE n = 1),
        top(lvl, pos, n, node) AS (SELECT 0, spos, sn, subroot FROM subroots UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
        steps AS (
            SELECT l.rid, t.lvl AS step, t.node, t.pos, l.pos // CAST(3 ** t.lvl AS BIGINT) AS own FROM leaves l JOIN tree t ON l.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.pos // 3 = l.pos // CAST(3 ** (t.lvl + 1) AS BIGINT)
            UNION ALL SELECT l.rid, 100 + t.lvl, t.node, t.pos, s.spos // CAST(3 ** t.lvl AS BIGINT) FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN top t ON t.n > 1 AND t.pos // 3 = s.spos // CAST(3 ** (t.lvl + 1) AS BIGINT)),
        path AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY step) AS k, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos < own), '') AS a, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos > own), '') AS b FROM steps GROUP BY rid, step),
        folded(rid, k, node) AS (SELECT rid, 0, coalesce(other, leaf) FROM leaves UNION ALL SELECT f.rid, f.k + 1, sha256(p.a || f.node || p.b) FROM folded f JOIN path p ON f.rid = p.rid AND p.k = f.k + 1),
        proofs AS (SELECT rid, string_agg(a || b, '' ORDER BY k) AS p FROM path GROUP BY rid)
        SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, sha256(coalesce(p.p, '')) AS proof_sha256, f.node AS folded_root, f.node = r.node AS verified
        FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN top r ON r.n = 1 LEFT JOIN proofs p ON p.rid = l.rid
        JOIN (SELECT rid, arg_max(node, k) AS node FROM folded GROUP BY rid) f ON f.rid = l.rid"""


#: What hangs on hashes, suffix arrays, models and libraries has no SQL; tests hold it against brute force.
ORACLE_SQL: dict[str, str] = {"op12_centroids": _lloyd_sql(), "op13_merkle_manifest": _merkle_sql()}
