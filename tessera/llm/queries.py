"""Registered queries of the training-data operators (thin: each applies its operator and derives the digest)."""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_license_scan")
def op3_license_scan(spark, sf_dir):
    from .licenses import scan
    return scan(_t(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op9_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i + 1:i + m], ' ') AS p FROM bw),
dw AS (SELECT r, w, m, unnest(range(greatest(len(w) - m + 1, 0))) AS i FROM d CROSS JOIN (SELECT DISTINCT m FROM win)),
hit AS (SELECT dw.r, dw.i, dw.m, win.item_id FROM dw JOIN win ON dw.m = win.m AND array_to_string(dw.w[dw.i + 1:dw.i + dw.m], ' ') = win.p),
pos AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS x FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.r = pos.r LEFT JOIN its ON d.r = its.r""")
def op9_decontamination(spark, sf_dir):
    from .decontam import decontaminate
    d = decontaminate(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), width=10)
    return d.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op8_setsketch_near_dedup", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, least(3, len(w)) AS m, unnest(range(len(w) - least(3, len(w)) + 1)) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + m], ' ') AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 85 * (na.n + nb.n - x)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.b, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id""")
def op8_setsketch_near_dedup(spark, sf_dir):
    from .setsketch import near_duplicates
    return near_duplicates(_t(spark, sf_dir, "documents"), k=3, num=85, den=100)


@query("op5_suffix_array_dedup")
def op5_suffix_array_dedup(spark, sf_dir):
    from .repeats import remove_repeats
    d = remove_repeats(_t(spark, sf_dir, "documents"), width=400)
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op10_source_mixing")
def op10_source_mixing(spark, sf_dir):
    from .mixing import copies
    d = copies(_t(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


@query("op2_mtree_top_k", """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op2_mtree_top_k(spark, sf_dir):
    from .mtree import search
    return search(_t(spark, sf_dir, "embeddings"), every=100, k=10)


#: vocabulary of the token counts (a parameter of the operator)
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    from .wordpieces import token_counts
    return token_counts(_t(spark, sf_dir, "documents"), VOCABULARY)


@query("op4_html_extraction")
def op4_html_extraction(spark, sf_dir):
    from .html import extract
    d = extract(_t(spark, sf_dir, "pages"))
    return d.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    from .toxicity import predict
    return predict(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


#: key of the registered query; a deployment passes its own secret
PII_KEY = "registered-query-key"


@query("op1_feistel_pseudonyms")
def op1_feistel_pseudonyms(spark, sf_dir):
    from .pii import pseudonymise
    d = pseudonymise(_t(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return d.select("doc_id", "text", "n_values")


def _clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Lloyd's rounds as a chain of common table expressions, one row per (vector or centroid, dimension)."""
    kept = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (SELECT r, unnest(range({dims})) AS j, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (SELECT c, unnest(range({dims})) AS j, unnest(v) AS x FROM (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM kept) WHERE c < {k})"""
    for i in range(rounds + 1):
        kept += f""",
a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT x.r, c{i}.c, sum((x.x - c{i}.x) * (x.x - c{i}.x)) AS d
  FROM x JOIN c{i} ON x.j = c{i}.j GROUP BY x.r, c{i}.c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        if i < rounds:
            kept += f""",
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, c{i}.j, coalesce(n.x, c{i}.x) AS x FROM c{i} LEFT JOIN (
  SELECT a{i}.c, x.j, CAST(floor(sum(x.x) / count(*)) AS BIGINT) AS x FROM a{i} JOIN x ON x.r = a{i}.r GROUP BY a{i}.c, x.j) n
  ON n.c = c{i}.c AND n.j = c{i}.j)"""
    a, c = f"a{rounds}", f"c{rounds}"
    return kept + f"""
SELECT kept.vec_id, CAST({a}.c AS INTEGER) AS cluster, CAST({a}.d AS BIGINT) AS distance,
       CAST(sum({a}.d) OVER (PARTITION BY {a}.c) AS BIGINT) AS cluster_inertia, CAST(sum({a}.d) OVER () AS BIGINT) AS inertia,
       s.h AS centroid_sha256
FROM {a} JOIN kept ON kept.r = {a}.r
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS h FROM {c} GROUP BY c) s ON s.c = {a}.c"""


@query("op13_centroid_clustering", _clusters_sql())
def op13_centroid_clustering(spark, sf_dir):
    from .centroids import cluster
    return cluster(_t(spark, sf_dir, "embeddings"), k=8, rounds=10, seed=3)


def _crc_sql(s: str) -> str:
    """CRC-32 of a string's bytes: a fold over them with the byte table, built here from the polynomial."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(str(i))
    ones = "4294967295::BIGINT"
    return (f"xor(list_reduce(list_prepend({ones}, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode({s})), '..')]), "
            f"lambda a, x: xor(([{', '.join(table)}]::BIGINT[])[(xor(a, x) & 255) + 1], a >> 8)), {ones})")


@query("op12_importance_resampling", f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS r, {_WORDS} AS w FROM benchmark),
df AS MATERIALIZED (SELECT r, array_to_string(w[i + 1:i + k], ' ') AS f FROM (
  SELECT r, w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS i FROM d CROSS JOIN (VALUES (1), (2), (3)) ks(k))),
bf AS MATERIALIZED (SELECT array_to_string(w[i + 1:i + k], ' ') AS f FROM (
  SELECT w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS i FROM b CROSS JOIN (VALUES (1), (2), (3)) ks(k))),
c AS MATERIALIZED (SELECT f, {_crc_sql('f')} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf)),
s AS (SELECT bucket, count(*) AS n FROM df JOIN c USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN c USING (f) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE
        / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN c USING (f) JOIN g USING (bucket) GROUP BY r),
sc AS (SELECT d.r, doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w ON w.r = d.r),
rk AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM sc WHERE n_words >= 20)
SELECT sc.doc_id, CAST(sc.n_features AS BIGINT) AS n_features, sc.weight, sc.score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM sc LEFT JOIN rk ON rk.r = sc.r""")
def op12_importance_resampling(spark, sf_dir):
    from .resampling import resample
    d = resample(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), seed=42, share=(5, 100), min_words=20)
    return d.select("doc_id", "n_features", "weight", "score", "rank")


@query("op11_perplexity_rules")
def op11_perplexity_rules(spark, sf_dir):
    from .perplexity import judge
    return judge(_t(spark, sf_dir, "documents"))
