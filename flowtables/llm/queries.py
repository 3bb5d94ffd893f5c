"""Queries that apply the operators to their whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowtables.llm import fuzzy_lines, language, leaks, merkle, mixing, near_texts, nearest, neighbours, quality, repair, shards, sql, token_files, url_rules

Query = Callable[[SparkSession, str], DataFrame]

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written with a shared dictionary and read back."""
    import public_tokenizers

    return token_files.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url, through redirects, canonical links and common url forms."""
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"), RULES)


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return shards.shard_digests(_table(spark, sf_dir, "documents"), 16)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.identify(_table(spark, sf_dir, "documents"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return neighbours.link_vectors(_table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all documents."""
    return near_texts.join_near_texts(_table(spark, sf_dir, "documents")).drop("th")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words a mix takes of every document."""
    return mixing.mix_digests(_table(spark, sf_dir, "documents"))


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all lines of all documents, and the line of each that is kept."""
    return fuzzy_lines.line_groups(_table(spark, sf_dir, "documents"))


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults, and the cheapest edits that mend them."""
    return repair.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all vectors for every vector whose id is divisible by 50."""
    return nearest.nearest_vectors(_table(spark, sf_dir, "embeddings"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Merkle manifest of all documents, and what tampering with it leads to."""
    return merkle.tampered_manifest(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_files, op2_url_rules, op3_shards, op4_language, op5_neighbours, op6_quality, op7_near_texts,
        op8_mixing, op9_fuzzy_lines, op10_leaks, op11_repair, op12_nearest, op13_manifest, pipeline,
    )
}

#: No page of the tables has a canonical link or a redirect, and two urls of one common form
#: differ in no rule, so for these tables the rules alone decide.
ORACLES: dict[str, str] = {
    "op11_repair": sql.REPAIR,
    "op13_manifest": sql.MANIFEST,
    "op2_url_rules": r"""
WITH parts AS (
  SELECT page_id,
    translate(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(url, '^.*?://([^/?#]*)', 1, 's') ELSE '' END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') ELSE '' END AS rest
  FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT DISTINCT host, path, h || p AS rule, v,
    row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM parts) AS u JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
nodes AS (
  SELECT *, host || rest AS node FROM parts),
forms AS (
  SELECT page_id, node,
    regexp_replace(regexp_replace(split_part(node, '?', 1), '^(www|m)\.([^/?]*\.[^/?]*)', '\2'), '([^/])(\.html?)?/*$', '\1') AS base,
    regexp_replace(regexp_replace(regexp_extract(node, '\?(.*)$', 1, 's'), '(?i)(^|&)(utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '', 'g'), '^&', '') AS query
  FROM nodes),
aliases AS (SELECT node, CASE WHEN query = '' THEN base ELSE base || '?' || query END AS form FROM forms),
least AS (SELECT form, least(min(node), form) AS alias_id FROM aliases GROUP BY form)
SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.v, 'allow') AS verdict,
  (SELECT any_value(l.alias_id) FROM aliases AS a JOIN least AS l USING (form) WHERE a.node = n.node) AS alias_id,
  CAST(NULL AS VARCHAR) AS blocked_by
FROM nodes AS n LEFT JOIN fits AS f ON f.host = n.host AND f.path = n.path AND f.k = 1
""",
}
