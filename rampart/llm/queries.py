"""Registered queries of the operators, and their DuckDB oracles where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions.session import fresh_path
from rampart.llm import counts, covertree, language, lloyd, minhash, mixing, packing, pq, repair, toxicity, urls, whitening, winnowing
from rampart.llm.common import WORD, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query()
def op1_repair(spark, sf_dir):
    """Encode, write as Re-Pair blocks, read the blocks back."""
    path = fresh_path(spark, "repair")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents")
    repair.write_repair(docs, path, tokenizer, end_id=2, vocabulary=49_408, added_tokens=True)
    return repair.read_digests(spark, path)


@query(
    """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE label IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM (FROM g WHERE isfinite(n) AND n > 0) a JOIN (FROM g WHERE isfinite(n) AND n > 0) b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.98),
r AS (WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a) SELECT a, min(b) AS b FROM reach GROUP BY a),
c AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(c.n, 0) AS n_links, coalesce(least(vec_id, r.b), vec_id) AS component_id,
  coalesce(least(vec_id, r.b), vec_id) = vec_id AS kept
FROM v LEFT JOIN c ON c.a = vec_id LEFT JOIN r ON r.a = vec_id"""
)
def op2_product_quantisation(spark, sf_dir):
    return pq.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op3_minhash(spark, sf_dir):
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.drop("group", "node", "other")


@query(
    f"""WITH p AS (SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS mark FROM pages),
q AS (SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM p),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.UPPER.lower()}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM q),
r(rhost, rpath, rverdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
m AS (SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
  row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) AS place
  FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.rverdict, 'allow') AS verdict
FROM h LEFT JOIN m ON m.place = 1 AND m.page_id = h.page_id AND m.host = h.host AND m.path = h.path"""
)
def op4_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), urls.rules_table(spark, URL_RULES))


_MIX_ORACLE = rf"""WITH d AS (SELECT doc_id, source, text,
  coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
  CASE WHEN length(text) > 0 THEN greatest(1.0::DOUBLE - length(regexp_replace(text, '[\p{{L}}\x20\x09-\x0D]', '', 'g'))::DOUBLE / length(text), 0.05) ELSE 1.0 END AS w,
  md5('7' || chr(2) || coalesce(doc_id::VARCHAR, chr(1)) || chr(2) || md5(coalesce(text, chr(1)))) AS digest FROM documents),
k AS (SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / w AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
g AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS sw,
  2.0::DOUBLE * source_size AS full_ FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY full_ / sw, source NULLS LAST) AS place FROM g),
c AS (SELECT *, coalesce(sum(full_) OVER before, 0) AS filled, sum(sw) OVER () - coalesce(sum(sw) OVER before, 0) AS open_,
  1.5::DOUBLE * sum(source_size) OVER () AS total FROM o WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((total - filled) / open_, place) AS lev FROM c WHERE (total - filled) / open_ * sw <= full_),
t AS (SELECT source, source_size, coalesce(least(full_, lev * sw), full_) AS target FROM c LEFT JOIN l ON true),
p AS (SELECT k.doc_id, k.size, t.source_size, t.target, k.source,
  coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, substr(digest, 14, 19) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
  CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - ahead)))::BIGINT AS taken, source FROM p"""


@query(_MIX_ORACLE)
def op6_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


@query(
    """WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
)
def op5_cover_tree(spark, sf_dir):
    return covertree.top_k(table(spark, sf_dir, "embeddings"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Learned from the labelled documents that are not held out."""
    return toxicity.train(docs, table(spark, sf_dir, "labels").where(~toxicity.split(F.col("doc_id"))))


@query()
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        toxicity.split(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.3, 1).otherwise(0).alias("predicted"),
        "spans",
    )


@query()
def op8_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(docs, tokenizer, end_id=1, keep_ids=False, added_tokens=True)
    return pieces.drop("continued", "continues")


@query()
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, ~toxicity.split(F.col("doc_id")))
    found = language.detect(docs, model)
    return found.select(
        "doc_id",
        toxicity.split(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        "ambiguous",
    )


@query()
def op10_trie_counts(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op11_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), scale=64, offset=1_000_000, components=16)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


_WORDS = f"regexp_extract_all(translate(text, '{urls.UPPER}', '{urls.UPPER.lower()}'), '{winnowing.ITEM_WORD}')"


@query(
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS k
  FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(s) WHERE len(w) > 0),
e AS (SELECT doc_id, s, l, array_to_string(w[s : s + l - 1], ' ') AS k FROM d, (SELECT DISTINCT l FROM v) n, unnest(range(1, len(w) - l + 2)) t(s)),
m AS (SELECT doc_id, s, e.l, item_id FROM e JOIN v ON e.k = v.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, s, l FROM m) x, unnest(range(s, s + l)) t(p) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)"""
)
def op12_winnowing(spark, sf_dir):
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _lloyd_oracle(clusters: int = 8, rounds: int = 10) -> str:
    """Assignments and centroids of all rounds, one after the other."""
    nearest = """(SELECT id, x, cluster, distance FROM (SELECT v.id, v.x, c.cluster,
  (list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x))::BIGINT AS distance,
  row_number() OVER (PARTITION BY v.id ORDER BY distance, c.cluster) AS place FROM v, {c} c) WHERE place = 1)"""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, [floor(1024 * y::DOUBLE) for y in embedding] AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INTEGER AS cluster, x
  FROM v ORDER BY sha256('3:' || vec_id) LIMIT {clusters})""",
    ]
    for k in range(rounds):
        parts.append(f"a{k} AS MATERIALIZED {nearest.format(c=f'c{k}')}")
        parts.append(
            f"""m{k} AS (SELECT cluster, i, sum(x[i]::BIGINT) AS s, count(*) AS n FROM a{k}, unnest(range(1, 65)) t(i) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(y, x) AS x FROM c{k} LEFT JOIN
  (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS y FROM m{k} GROUP BY cluster) USING (cluster))"""
        )
    return f"""WITH {", ".join(parts)}, a AS MATERIALIZED {nearest.format(c=f"c{rounds}")}
SELECT v.vec_id, a.cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(a.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string([y::BIGINT::VARCHAR for y in c.x], ',')) AS centroid_sha256
FROM a JOIN v USING (id) JOIN c{rounds} c ON c.cluster = a.cluster"""


@query(_lloyd_oracle())
def op13_sharded_lloyd(spark, sf_dir):
    return lloyd.cluster_vectors(table(spark, sf_dir, "embeddings"), width=64, scale=1024, clusters=8, rounds=10, seed=3)
