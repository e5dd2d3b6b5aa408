"""Registered queries of this folder: thin digests of the operators' outputs over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    clustering,
    decontaminate,
    html,
    minhash,
    packing,
    pii,
    quality,
    substring,
    topk,
    transform,
    url_filter,
    whitening,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]
# Words of host names whose hosts make up the block list.
BLOCKED_WORDS = ["adult", "ads", "bets", "casino", "pills", "spam"]


def op1_bloom_cascade_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, URL_RULES, url_filter.domains_with_words(pages, BLOCKED_WORDS))


def op2_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "n_units", F.round("perplexity", 6).alias("perplexity"), "threshold", "kept")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, similarity="17/20")


def _ranges(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(spans)


def op4_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    chosen = conversations.withColumnRenamed("conv_id", "pair_id")
    pairs = chat.preference_pairs(chosen, chat.with_other_answers(conversations))
    return pairs.select("pair_id", "n_common", "prompt", "chosen", "rejected", _ranges("chosen_mask"), _ranges("rejected_mask"))


def op5_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors)


def op6_site_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"), with_ids=False)


def op8_latent_semantic_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "contaminated", "item_ids", F.round("share", 6).alias("share"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in pii.KINDS],
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def op10_de_bruijn_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_merged_transform_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = transform.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.centroid_clusters(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", clustering.centroid_digest()).drop("centroid")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_bloom_cascade_url_filter,
        op2_kneser_ney_quality,
        op3_minhash_near_dedup,
        op4_preference_formatting,
        op5_dual_tree_top_k,
        op6_site_style_tree_text,
        op7_best_fit_packing,
        op8_latent_semantic_decontamination,
        op9_weak_supervision_pii,
        op10_de_bruijn_substring_dedup,
        op11_jacobi_davidson_whitening,
        op12_merged_transform_dedup,
        op13_centroid_clustering,
    )
}


def _clustering_sql(rounds: int) -> str:
    """Lloyd's rounds as a chain of tables: nearest of the centroids before, then their exact mean rounded down."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
  SELECT rid, min(struct_pack(distance := distance, cluster := cluster)) AS best FROM (
    SELECT rid, cluster, CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS distance
    FROM kept CROSS JOIN c{i}) GROUP BY rid)""")
        if i < rounds:
            steps.append(f"""sums{i} AS (
  SELECT best.cluster AS cluster, j, sum(v[j]) AS s, count(*) AS n
  FROM kept JOIN a{i} USING (rid) CROSS JOIN (SELECT unnest(range(1, 65)) AS j) GROUP BY ALL),
means{i} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM sums{i} GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(m.c, p.c) AS c FROM c{i} p LEFT JOIN means{i} m USING (cluster))""")
    return ",\n".join(steps)


CLUSTER_ROUNDS = 3

ORACLES: dict[str, str] = {
    "op1_bloom_cascade_url_filter": """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')),
judged AS (
  SELECT page_id, host, path,
         len(list_filter(regexp_split_to_array(host, '[.-]'),
             lambda x: x IN ('adult', 'ads', 'bets', 'casino', 'pills', 'spam'))) > 0 AS listed,
         (SELECT max_by(struct_pack(rule := rhost || rpath, verdict := rverdict), length(rhost || rpath)) FROM rules
          WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
  FROM split)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM judged""",
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.seen FROM reach r JOIN edges e ON e.a = r.node),
best AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN best ON best.node = d.doc_id""",
    "op10_de_bruijn_substring_dedup": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50),
wins AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM spots),
firsts AS (SELECT h, min(doc_id) AS lo FROM wins GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, p + k AS i FROM (SELECT doc_id, p FROM wins JOIN firsts USING (h) WHERE doc_id > lo), range(50) t(k)),
places AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
FROM words LEFT JOIN places USING (doc_id)""",
    "op4_preference_formatting": """
WITH answers AS (
  SELECT conv_id, max(struct_pack(turn := turn, "text" := text)) AS last FROM conversations WHERE role = 'assistant'
  GROUP BY conv_id),
known AS (
  SELECT a.conv_id, a.last.turn AS spot, b.last.text AS other FROM answers a JOIN answers b ON b.conv_id = a.conv_id + 1),
other AS (
  SELECT conv_id, turn, role, text FROM conversations JOIN known USING (conv_id) WHERE turn < spot OR turn IS NULL
  UNION ALL SELECT conv_id, spot, 'assistant', other FROM known),
marked AS (
  SELECT 'c' AS side, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT 'r', conv_id, turn, coalesce(role, ''), coalesce(text, '') FROM other),
sides AS (
  SELECT conv_id,
    coalesce(list(struct_pack(role := role, "text" := text) ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE side = 'c'), []) AS c,
    coalesce(list(struct_pack(role := role, "text" := text) ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE side = 'r'), []) AS r
  FROM marked WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (
  SELECT *, CAST(coalesce(nullif(list_position(list_transform(range(1, least(len(c), len(r)) + 1), lambda i: c[i] = r[i]), false), 0) - 1,
                          least(len(c), len(r))) AS INTEGER) AS n_common FROM sides),
parts AS (
  SELECT conv_id, n_common, c[1:n_common] AS p, c[n_common + 1:] AS c, r[n_common + 1:] AS r FROM cut),
shown AS (
  SELECT conv_id, n_common, c, r,
    list_transform(p, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS ps,
    list_transform(c, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS cs,
    list_transform(r, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS rs FROM parts)
SELECT conv_id AS pair_id, n_common, array_to_string(ps, '') AS prompt, array_to_string(cs, '') AS chosen,
  array_to_string(rs, '') AS rejected,
  array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'), lambda i:
    (length(array_to_string(cs[1:i - 1], '')) + 14) || ':' || length(array_to_string(cs[1:i], ''))), ',') AS chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'), lambda i:
    (length(array_to_string(rs[1:i - 1], '')) + 14) || ':' || length(array_to_string(rs[1:i], ''))), ',') AS rejected_mask
FROM shown""",
    "op5_dual_tree_top_k": """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, least(len(q.v), len(d.v)) + 1),
         lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
  FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    # texts as hexadecimal digits; pieces of 200 bytes keep the cutting of long texts cheap
    "op12_merged_transform_dedup": """
WITH sized AS (
  SELECT doc_id, h, length(h) // 2 AS n FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents)),
pieces AS (
  SELECT doc_id, n, b, substr(h, 200 * b + 1, 400) AS piece
  FROM (SELECT *, unnest(range(0, (n - 100) // 100 + 1)) AS b FROM sized WHERE n >= 100)),
wins AS (
  SELECT doc_id, 100 * b + o AS s, md5(substr(piece, 2 * o + 1, 200)) AS w
  FROM (SELECT *, unnest(range(100)) AS o FROM pieces) WHERE 100 * b + o <= n - 100),
firsts AS (SELECT w, min(doc_id) AS lo FROM wins GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, lo, min(s) OVER (PARTITION BY w, doc_id) AS first_s FROM wins JOIN firsts USING (w))
  WHERE lo < doc_id OR first_s < s),
steps AS (
  SELECT doc_id, s, lead(s) OVER d AS nxt, lag(s) OVER d AS prv FROM gone WINDOW d AS (PARTITION BY doc_id ORDER BY s)),
totals AS (
  SELECT doc_id, CAST(sum(least(100, coalesce(nxt - s, 100))) AS BIGINT) AS n_removed,
         count(*) FILTER (WHERE prv IS NULL OR s > prv + 100) AS n_spans, min(s) AS first_s
  FROM steps GROUP BY doc_id),
segments AS (
  SELECT doc_id, 0 AS a, coalesce(first_s, n) AS b FROM sized LEFT JOIN totals USING (doc_id)
  UNION ALL
  SELECT doc_id, s + 100, coalesce(nxt, n) FROM steps JOIN sized USING (doc_id) WHERE nxt IS NULL OR nxt > s + 100),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
  FROM segments JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM sized JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)""",
    "op13_centroid_clustering": f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c FROM kept
  WHERE vec_id IS NOT NULL QUALIFY cluster < 16),
{_clustering_sql(CLUSTER_ROUNDS)},
found AS (
  SELECT vec_id, best.cluster AS cluster, best.distance AS distance
  FROM kept JOIN a{CLUSTER_ROUNDS} USING (rid))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN c{CLUSTER_ROUNDS} USING (cluster)""",
}
