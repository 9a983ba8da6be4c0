"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster_report
from .chat_preference import neighbour_pairs, preference_report
from .common import ship_package
from .decontam import contamination
from .exact_dedup import exact_duplicates
from .html_tree import main_text
from .jaccard_join import similarity_classes
from .mixing import mix_sources
from .repeats import cut_repeats
from .secrets import secret_report
from .spelling import spelling_variants
from .token_files import token_report
from .toxicity import toxicity
from .wordpiece import PieceAutomaton, read_vocabulary, token_counts

#: Vocabulary file of the registered token count (a parameter of the operator).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op2_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return preference_report(neighbour_pairs(turns), turns)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(_table(spark, sf_dir, "documents"), words=3, threshold=90)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), PieceAutomaton(read_vocabulary(vocabulary)))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return token_report(_table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"), min_length=6, min_count=5, ratio=5, damage_every=199)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(_table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed=1)


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_chat_preferences, op3_jaccard_join, op4_source_mixing, op5_toxicity,
    op6_token_counts, op7_exact_dedup, op8_decontamination, op9_suffix_dedup, op10_secret_scan,
    op11_token_files, op12_spelling_variants, op13_centroid_clustering)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def classes_sql(source: str, words: int, percent: int) -> str:
    """CTEs ending in ``classes(doc_id, n_shingles, component_id, n_links)`` over ``source``."""
    return f"""
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
             '[^\\x20\\x09-\\x0D]+') AS ws FROM {source}),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {words} THEN
              list_transform(range(1, len(ws) - {words} + 2), lambda i: array_to_string(ws[i:i + {words - 1}], ' '))
              WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id
       GROUP BY 1, 2),
lk AS (SELECT a, b FROM pr JOIN sz p ON p.doc_id = a JOIN sz q ON q.doc_id = b
       WHERE 100 * i >= {percent} * (p.n + q.n - i)),
reach AS (SELECT a AS node, b AS other FROM lk
          UNION SELECT r.node, l.b FROM reach r JOIN lk l ON l.a = r.other),
classes AS (SELECT d.doc_id, coalesce(max(sz.n), 0)::BIGINT AS n_shingles,
              least(d.doc_id, coalesce(min(reach.other), d.doc_id)) AS component_id,
              coalesce((SELECT count(*) FROM lk WHERE lk.a = d.doc_id), 0)::BIGINT AS n_links
            FROM {source} d LEFT JOIN sz ON sz.doc_id = d.doc_id LEFT JOIN reach ON reach.node = d.doc_id
            GROUP BY d.doc_id)"""


def contamination_sql(source: str) -> str:
    """CTEs ending in ``contamination`` over ``source`` (ids unique): phrases of 10 words, slop 2."""
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
             "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
    return f"""
dw AS (SELECT doc_id, {words} AS ws FROM {source}),
it AS (SELECT item_id::VARCHAR AS item, {words} AS ws FROM benchmark),
win AS (SELECT row_number() OVER () AS win, * FROM (SELECT terms, list(DISTINCT item) AS items FROM (
    SELECT item, unnest(CASE WHEN len(ws) <= 10 THEN [ws]
      ELSE list_transform(range(1, len(ws) - 8), lambda i: ws[i:i + 9]) END) AS terms FROM it WHERE len(ws) > 0)
  GROUP BY terms)),
pos AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM dw),
df AS (SELECT w, count(*) AS c FROM pos GROUP BY w),
runs AS (SELECT doc_id, p, n, ws[p + 1:p + n] AS terms FROM (SELECT doc_id, ws, unnest(range(0, len(ws))) AS p FROM dw),
         (SELECT DISTINCT len(terms) AS n FROM win) WHERE p + n <= len(ws)),
hits AS (SELECT doc_id, p, n, items FROM runs JOIN win USING (terms)),
hit_words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
    SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (SELECT DISTINCT doc_id, unnest(items) AS item FROM hits),
term AS (SELECT win, len(terms) AS n, unnest(terms) AS w, generate_subscripts(terms, 1) - 1 AS off FROM win),
rare AS (SELECT win, n, w, off, row_number() OVER (PARTITION BY win ORDER BY c, off) AS k, count(*) OVER (PARTITION BY win) AS m
         FROM term JOIN df USING (w)),
at1 AS (SELECT win, n, doc_id, p - off AS s FROM rare JOIN pos USING (w) WHERE k = 1 AND m = n),
at2 AS (SELECT win, doc_id, p - off AS s FROM rare JOIN pos USING (w) WHERE k = 2 AND m = n),
cand AS (SELECT DISTINCT at1.win, at1.doc_id, at1.s FROM at1 JOIN at2 ON at1.win = at2.win AND at1.doc_id = at2.doc_id
           AND abs(at1.s - at2.s) <= 2 UNION SELECT win, doc_id, s FROM at1 WHERE n = 1),
near AS (SELECT DISTINCT cand.doc_id, unnest(items) AS item FROM cand JOIN win USING (win) JOIN dw ON dw.doc_id = cand.doc_id
         WHERE len(list_filter(range(0, len(terms)), lambda k: list_contains(
           ws[greatest(s + k - 2, 0) + 1:s + k + 3], terms[k + 1]))) = len(terms)),
near_only AS (SELECT doc_id, count(*) AS k FROM (SELECT * FROM near EXCEPT SELECT * FROM hit_items) GROUP BY doc_id),
item_list AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM hit_items GROUP BY doc_id),
contamination AS (SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
    coalesce(near_only.k, 0)::BIGINT AS n_near_items
  FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN item_list USING (doc_id) LEFT JOIN near_only USING (doc_id))"""


def clusters_sql(rounds: int = 3, k: int = 16, dim: int = 64) -> str:
    """Rounds of exhaustive nearest-centroid assignment, written out one after the other."""
    def assigned(r: int) -> str:
        return f"""
a{r} AS MATERIALIZED (SELECT row, vec_id, v, min([d, num]) AS best FROM (
    SELECT row, vec_id, v, num, list_sum(list_transform(range(1, {dim + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d
    FROM kept, c{r}) GROUP BY row, vec_id, v)"""

    def moved(r: int) -> str:
        return f"""
s{r} AS (SELECT num, pos, sum(x)::BIGINT AS s, count(*) AS n FROM (
    SELECT best[2] AS num, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r})
  GROUP BY num, pos),
c{r + 1} AS MATERIALIZED (SELECT c.num, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT num, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS c FROM s{r} GROUP BY num) m USING (num))"""

    steps = ",".join(assigned(r) + "," + moved(r) for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS num, v AS c
  FROM kept QUALIFY num < {k}),{steps},{assigned(rounds)},
f AS (SELECT vec_id, best[2]::INTEGER AS cluster, best[1]::BIGINT AS distance FROM a{rounds})
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM f JOIN c{rounds} ON cluster = num"""


ORACLE_SQL = {
    "op2_chat_preferences": """
WITH t AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, conv_id, role, text, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS idx
           FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.idx, b.idx) AS idx,
        a.idx IS NULL OR b.idx IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text AS differs
      FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b
        ON a.pair_id = b.pair_id AND a.idx = b.idx),
c AS (SELECT pair_id, coalesce(min(CASE WHEN differs THEN idx END), max(idx) + 1) AS n_common FROM d GROUP BY 1),
p AS (SELECT t.*, n_common, CASE WHEN idx < n_common THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part,
        '<|start|>' || coalesce(role, 'unknown') || chr(10) AS head, coalesce(text, '') || '<|end|>' || chr(10) AS tail
      FROM t JOIN c USING (pair_id) WHERE idx >= n_common OR side = 0),
q AS (SELECT *, coalesce(sum(length(head || tail)) OVER (PARTITION BY pair_id, part ORDER BY idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM p)
SELECT pair_id, (SELECT max(conv_id) FROM t x WHERE x.pair_id = q.pair_id AND side = 0) AS chosen_id,
  (SELECT max(conv_id) FROM t x WHERE x.pair_id = q.pair_id AND side = 1) AS rejected_id, max(n_common) AS n_common,
  coalesce(string_agg(head || tail, '' ORDER BY idx) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(head || tail, '' ORDER BY idx) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(head || tail, '' ORDER BY idx) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head || tail)), ',' ORDER BY idx)
           FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_loss,
  coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head || tail)), ',' ORDER BY idx)
           FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_loss
FROM q GROUP BY pair_id""",
    "op3_jaccard_join": f"WITH RECURSIVE {classes_sql('documents', 3, 90)} SELECT * FROM classes",
    "op4_source_mixing": """
WITH z AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
       FROM z GROUP BY source),
s1 AS (SELECT *, CASE src % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
         (2 * source_size)::DOUBLE AS lim, (SELECT sum(size) FROM z)::DOUBLE * 1.5 AS goal FROM s0),
s2 AS (SELECT *, (goal - coalesce(sum(lim) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
       FROM s1 WINDOW b AS (ORDER BY lim / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT min_by(level, (lim / w, src)) AS level FROM s2 WHERE level * w <= lim),
s3 AS (SELECT src, source, source_size, goal, least(lim, (SELECT level FROM lv) * w) AS target FROM s2),
st AS (SELECT z.doc_id, z.source, z.size, source_size, target, floor(target + 0.5)::BIGINT AS quota,
         coalesce(sum(size) OVER (PARTITION BY s3.src ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':mix'), doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
       FROM z JOIN s3 ON z.source IS NOT DISTINCT FROM s3.source)
-- a stream read over and over up to the quota: whole readings, and the beginning once more
SELECT doc_id, source, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  quota // source_size * size + greatest(least(quota % source_size - off, size), 0) END::BIGINT AS taken
FROM st""",
    "op7_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_decontamination": f"""
WITH {contamination_sql('documents')} SELECT * FROM contamination""",
    "op13_centroid_clustering": clusters_sql(),
    "op9_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, substr(hx, 2 * i + 1, 200) AS s
      FROM (SELECT doc_id, hx, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
f AS (SELECT s, min((doc_id, i)) AS first FROM w GROUP BY s HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM w JOIN f USING (s) WHERE (doc_id, i) <> first),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
        SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM r)),
x AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS a, lo AS b FROM x
      UNION ALL SELECT d.doc_id, coalesce(max(hi), 0), max(n) FROM d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, any_value(n)::BIGINT AS n_bytes,
  (any_value(n) - sum(b - a))::BIGINT AS n_removed, (count(*) - 1)::BIGINT AS n_spans,
  sha256(unhex(string_agg(substr(hx, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS kept_sha256
FROM d JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id""",
}
