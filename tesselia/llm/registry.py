"""The thin queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, decontam, exact_dedup, near_dedup, quality, secrets, suffix_dedup, token_count, toxicity, url_filter


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules given for the query. Fixed values.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: The method's own rules, below all of those: tokens of gambling hosts.
URL_WORDS = ["bet", "bets", "casino", "gambling", "jackpot", "poker", "porn", "slots", "xxx"]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {a + b for _, a, b in URL_RULES}
    rules = [url_filter.host_rule(*r) for r in URL_RULES] + [url_filter.word_rule("block", w) for w in URL_WORDS]
    out = url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
    own = F.col("rule").isin(*given)
    return out.select("page_id", "host", "path", F.when(own, F.col("rule")).alias("rule"), "verdict")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"), size=50)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=4, percent=80)


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), where=fold != 2)
    return toxicity.score_toxicity(docs, model, 0.3).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


OP2_SQL = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), ruled AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM cut
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host || ' ' || path, '(^|[^0-9a-z])({"|".join(URL_WORDS)})($|[^0-9a-z])') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP7_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), edge AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), reach AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT edge.b, reach.c FROM reach JOIN edge ON edge.a = reach.d)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id, r.c = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(c) AS c FROM reach GROUP BY d) r ON r.d = d.doc_id
"""

QUERIES = {"op1_secret_scan": op1_secret_scan, "op7_exact_dedup": op7_exact_dedup, "op2_url_filter": op2_url_filter, "op3_decontaminate": op3_decontaminate, "op4_suffix_dedup": op4_suffix_dedup, "op5_near_dedup": op5_near_dedup, "op6_token_count": op6_token_count, "op8_bpe": op8_bpe, "op9_toxicity": op9_toxicity, "op10_quality": op10_quality, "pipeline": corpus_pipeline.run}
ORACLE_SQL = {"op2_url_filter": OP2_SQL, "op5_near_dedup": OP5_SQL, "op7_exact_dedup": OP7_SQL}
