"""The queries of this subpackage, over the tables of a folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_fit, centroids, decontaminate, divergence, html_extract, lang_id, line_dedup, near_dedup, pii, quality, tier_packing, topk, url_rules

PII_KEY = "public test key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines of six sites or more."""
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, as the query's contract asks."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=2)


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every fiftieth vector."""
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's site rules above the generic ones; the latter only give the verdict."""
    rules = url_rules.rule_table(spark, url_rules.GENERIC_RULES, site=False).unionByName(url_rules.rule_table(spark, url_rules.SITE_RULES, site=True, order=1))
    judged = url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", F.when(F.col("class") == 1, F.col("rule")).alias("rule"), "verdict", F.when(F.col("class") == 0, F.col("rule")).alias("generic_rule"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages."""
    return decontaminate.benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 1,024 ids."""
    return tier_packing.pack_tiers(_table(spark, sf_dir, "documents"))


def op7_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of 2,048 ids."""
    return best_fit.packed_matrix(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return html_extract.extract_main(_table(spark, sf_dir, "pages"))


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms."""
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), PII_KEY)


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters after five rounds over all vectors."""
    return centroids.centroid_clusters(_table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the words that set them off."""
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return lang_id.predict_languages(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_line_dedup, op2_minhash_near_dedup, op3_exact_topk, op4_url_rules, op5_decontaminate, op6_tier_packing, op7_token_matrix, op8_quality, op9_html_extract, op10_pii_pseudonyms, op11_centroid_clusters, op12_source_divergence, op13_language_id)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _re2(pattern: str) -> str:
    """A generic rule's pattern as a regular expression, written for the SQL on its own."""
    body = pattern.removeprefix("||")
    for c in "\\.+?()[]{}$|":
        body = body.replace(c, "\\" + c)
    body = body.replace("*", ".*").replace("^", "(?:[^A-Za-z0-9_.%-]|$)")
    return "(?s)" + ("^(?:[^/]*\\.)?" if pattern.startswith("||") else "") + body


_GENERIC = "(VALUES " + ", ".join(f"('{p}', '{_re2(p)}', {len(p)})" for p, _ in url_rules.GENERIC_RULES) + ")"


def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment and update, each a pair of common table expressions."""
    steps = ["""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INTEGER) AS cluster, v FROM kept QUALIFY cluster < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT id, min({{'d': CAST(list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': cluster}}) AS best
  FROM kept, c{i} AS c GROUP BY id
)""")
        if i < rounds:
            steps.append(f"""
s{i} AS MATERIALIZED (
  SELECT cluster, dim, sum(x) AS s, count(*) AS n
  FROM (SELECT best.c AS cluster, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM kept JOIN a{i} USING (id)) GROUP BY ALL
), m{i} AS MATERIALIZED (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v FROM s{i} GROUP BY cluster
), c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN m{i} AS m ON c.cluster = m.cluster)""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (id) JOIN c{rounds} AS c ON c.cluster = best.c
"""


ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": """
WITH lines AS (
  SELECT doc_id, text, source, s, generate_subscripts(s, 1) AS pos, unnest(s) AS line
  FROM (SELECT doc_id, text, source, string_split(text, chr(10)) AS s FROM documents)
), keyed AS (SELECT doc_id, text, source, pos, line, trim(line, ' ') AS bare FROM lines),
common AS (
  SELECT bare, min({'d': doc_id, 'p': pos}) AS first FROM keyed WHERE bare <> ''
  GROUP BY bare HAVING count(DISTINCT source) >= 6
), judged AS (
  SELECT k.*, c.bare IS NOT NULL AND {'d': k.doc_id, 'p': k.pos} <> c.first AS gone
  FROM keyed k LEFT JOIN common c ON k.bare = c.bare
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
       CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed
FROM judged GROUP BY doc_id, text
""",
    "op3_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
""",
    "op4_url_rules": f"""
WITH u AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r(rule, h, p, action) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
site AS (
  SELECT page_id, url, max({{'n': length(rule), 'rule': rule, 'action': action}}) AS best
  FROM (SELECT DISTINCT page_id, url, host, path FROM u) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id, url
), g AS (
  SELECT page_id, url, max({{'n': n, 'rule': rule}}) AS best
  FROM (SELECT DISTINCT page_id, url, host || path AS site FROM u) JOIN {_GENERIC} AS gen(rule, re, n) ON regexp_matches(site, re) GROUP BY page_id, url
)
SELECT u.page_id, u.host, u.path, site.best.rule AS rule, coalesce(site.best.action, CASE WHEN g.best IS NOT NULL THEN 'block' END, 'allow') AS verdict,
       CASE WHEN site.best IS NULL THEN g.best.rule END AS generic_rule
FROM u LEFT JOIN site ON u.page_id = site.page_id AND u.url IS NOT DISTINCT FROM site.url LEFT JOIN g ON u.page_id = g.page_id AND u.url IS NOT DISTINCT FROM g.url
""",
    "op11_centroid_clusters": _cluster_sql(),
    "op12_source_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents
), w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS all_n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
size AS (SELECT lang, count(*) AS v, sum(all_n) AS all_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, CAST(1 + 1000000000 * (coalesce(n.n, 0) + 5) // (coalesce(t.total, 0) + 5 * s.v) AS BIGINT) AS p,
         CAST(1 + 1000000000 * (k.all_n + 5) // (s.all_total + 5 * s.v) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN size s USING (lang)
  LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS a, y.source AS b, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) f
  ON f.lang = a.lang AND f.a = a.source AND f.b = b.source
), term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
