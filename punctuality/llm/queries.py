"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctuality.llm.ann import nearest
from punctuality.llm.bwt_dedup import remove_repeated_bytes
from punctuality.llm.common import table
from punctuality.llm.decontaminate import contamination
from punctuality.llm.divergence import source_divergence
from punctuality.llm.fm_dedup import remove_repeated_words
from punctuality.llm.lm import score_documents
from punctuality.llm.minhash import near_duplicate_groups
from punctuality.llm.mixing import mix_report
from punctuality.llm.packing import pack_documents
from punctuality.llm.tokens import round_trip as token_round_trip
from punctuality.llm.toxicity import score_toxicity
from punctuality.llm.warc import round_trip as warc_round_trip
from punctuality.llm.zones import cluster_report


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), least=50).drop("kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held_out=0)


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents"), least=13).drop("kept")


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), folds=5, held_out=1)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc_round_trip(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), query_step=100, k=10)


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op11_hilbert_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(table(spark, sf_dir, "embeddings"), dims=64, k=40, rounds=5, scale=256, seed=2)


def op12_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), end_id=1, room=2048)


def op13_term_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), least_docs=3, unit=1_000_000_000, top_terms=200)


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_toxicity, op3_superminhash, op4_fm_dedup, op5_gru_lm,
        op6_token_files, op7_warc, op8_nn_descent, op9_winnowing, op10_pivotal_mix,
        op11_hilbert_zones, op12_sum_of_squares, op13_term_tree,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"



def _lloyd_sql(k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, seed: int = 2) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS (SELECT v.row, v.vec_id, v.c, k.cluster, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.c, k.c)]) AS distance
  FROM v, c{i} k),
a{i} AS MATERIALIZED (SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(c) AS x, unnest(range({dims})) AS i FROM a{i}) GROUP BY 1, 2) GROUP BY 1),
c{i + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (cluster))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS c
  FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}),
c0 AS (SELECT row_number() OVER (ORDER BY h, c) - 1 AS cluster, c FROM (SELECT sha256('{seed}:' || vec_id) AS h, c FROM v WHERE vec_id IS NOT NULL ORDER BY h, c LIMIT {k})),
{",".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(k.c, ',')) AS centroid_sha256
FROM a{rounds} JOIN (SELECT cluster, c FROM c{rounds}) k USING (cluster)
"""


ORACLE_SQL = {
    "op3_superminhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text=_LOWER)} AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    ELSE [array_to_string(words[i:i + 2], ' ') FOR i IN range(1, greatest(len(words) - 1, 2))] END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.size + y.size - common)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
""",
    "op4_fm_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
t AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS window13
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY window13) < doc_id AS seen FROM g),
r AS (
  SELECT t.doc_id, t.i, t.word, coalesce(max(CASE WHEN f.seen THEN 1 ELSE 0 END) OVER
    (PARTITION BY t.doc_id ORDER BY t.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM t LEFT JOIN f ON f.doc_id = t.doc_id AND f.i = t.i)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM r GROUP BY 1) k USING (doc_id)
""",
    "op9_winnowing": r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(LOWER_TEXT, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(LOWER_TEXT, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
item AS (
  SELECT DISTINCT id AS item_id, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT id, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
        FROM w WHERE kind = 'b' AND len(words) > 0)),
doc AS (
  SELECT id AS doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM w, (SELECT DISTINCT size FROM item) WHERE kind = 'd' AND len(words) >= size)),
hit AS (SELECT doc_id, i, doc.size, item_id FROM doc JOIN item ON doc.size = item.size AND doc.win = item.win),
place AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM hit),
c AS (SELECT doc_id, count(*) AS n_hit FROM place GROUP BY 1),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c ON c.doc_id = id LEFT JOIN x ON x.doc_id = id WHERE kind = 'd'
""".replace("LOWER_TEXT", _LOWER),
    "op11_hilbert_zones": _lloyd_sql(),
    "op13_term_tree": r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(LOWER_TEXT, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
t AS MATERIALIZED (SELECT lang, source, doc, unnest(words) AS term FROM d),
v AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM t GROUP BY 1, 2 HAVING count(DISTINCT doc) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN v USING (lang, term) GROUP BY 1, 2, 3),
l AS (SELECT lang, count(*) AS terms, sum(total) AS total FROM v GROUP BY 1),
s AS (SELECT g.lang, g.source, coalesce(l.terms, 0) + coalesce(sum(c.n), 0) AS size
      FROM g LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source, l.terms),
p AS MATERIALIZED (SELECT s.lang, s.source, v.term, coalesce(c.n, 0) AS n,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // s.size AS BIGINT) AS p,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (v.total + 1)) // (l.total + l.terms) AS BIGINT) AS q
      FROM s JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(CAST((a.p - b.p) * (a.p - b.p) // b.p AS HUGEINT)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM term) WHERE rank <= 200
""".replace("LOWER_TEXT", _LOWER),
}
