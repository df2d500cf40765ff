"""Registered queries of the text operators and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, embed_dedup, fim, langid, lm_score, packing, pages, pii, quality, sharding, simhash, toxicity
from .common import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label posterior, score and decision of every document."""
    return quality.classified(read(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; the target are documents labelled good and not toxic."""
    good = read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return lm_score.scored(read(spark, sf_dir, "documents"), good)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 24 shards of nearly equal bytes, equal texts together."""
    out = sharding.sharded(read(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    return langid.report(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    return pii.report(read(spark, sf_dir, "documents"))


def op6_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector, within labels, at cosine 0.93."""
    return embed_dedup.linked(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    groups = simhash.duplicate_groups(read(spark, sf_dir, "documents"), shingle=4, radius=4)
    return groups.select("doc_id", simhash.simhash_hex("fp").alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.packed(read(spark, sf_dir, "documents"), room=2048)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and the items."""
    return decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extracted(read(spark, sf_dir, "pages"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, and the text rebuilt from it."""
    return fim.report(read(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most over-represented terms."""
    return divergence.audited(read(spark, sf_dir, "documents"), min_docs=10, top_terms=10)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sharding": op3_sharding,
    "op4_language_id": op4_language_id,
    "op5_pii": op5_pii,
    "op6_embedding_neardup": op6_embedding_neardup,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_html": op10_html,
    "op11_fim": op11_fim,
    "op12_divergence": op12_divergence,
    "op13_toxicity": op13_toxicity,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op6_embedding_neardup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS len FROM v),
g AS (SELECT * FROM u WHERE vec_id IS NOT NULL AND label IS NOT NULL AND isfinite(len) AND len > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.93),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       least(vec_id, coalesce(low, vec_id)) = vec_id AS kept
FROM v LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op9_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS i, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT i, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS s
      FROM (SELECT i, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
x AS (SELECT DISTINCT n FROM p),
o AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, x WHERE len(w) >= n)),
h AS (SELECT r, i, k, p.n FROM o JOIN p ON o.s = p.s AND o.n = p.n),
t AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS j FROM h) GROUP BY r),
q AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, i FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN t USING (r) LEFT JOIN q USING (r)""",
    "op11_fim": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, t, w, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS a,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
              OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
y AS (SELECT doc_id, t, n, form, array_to_string(w[1:least(a, b)], '') AS p,
    array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:], '') AS s FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM y""",
    "op12_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS l, coalesce(source, '') AS s, {_TERMS} AS w FROM documents),
o AS (SELECT r, l, s, unnest(w) AS t FROM d),
c AS (SELECT l, s, t, count(*) AS n, count(DISTINCT r) AS docs FROM o GROUP BY l, s, t),
k AS (SELECT l, t, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY l, t HAVING sum(docs) >= 10),
v AS (SELECT l, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS n FROM k GROUP BY l),
g AS (SELECT DISTINCT l, s FROM d),
u AS (SELECT g.l, g.s, k.t, CAST(coalesce(c.n, 0) AS HUGEINT) AS n, k.n AS all_n
      FROM g JOIN k ON k.l = g.l LEFT JOIN c ON c.l = g.l AND c.s = g.s AND c.t = k.t),
p AS (SELECT u.l, u.s, u.t, u.n, 1 + (1000000000 * (u.n + 2)) // (CAST(sum(u.n) OVER (PARTITION BY u.l, u.s) AS HUGEINT) + 2 * v.v) AS p,
             1 + (1000000000 * (u.all_n + 2)) // (v.n + 2 * v.v) AS q FROM u JOIN v ON v.l = u.l),
f AS (SELECT a.l, a.s, b.s AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.l = b.l AND a.t = b.t AND a.s <> b.s GROUP BY a.l, a.s, b.s),
z AS (SELECT a.l, a.s, 'pair' AS part, b.s AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.l = b.l AND a.s <> b.s LEFT JOIN f ON f.l = a.l AND f.s = a.s AND f.item = b.s
      UNION ALL
      SELECT l, s, 'term', t, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT l AS lang, s AS source, part, item, value,
                      CAST(row_number() OVER (PARTITION BY l, s, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM z)
WHERE part = 'pair' OR rank <= 10""",
}
