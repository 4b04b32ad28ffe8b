"""Queries of the operators over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm import (
    class_lm, decontamination, hard_negatives, licenses, line_dedup, mixing, ngram_join, quality, substring_dedup, token_links, toxicity,
    url_reputation, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]
TOXIC_FOLDS, LM_FOLDS = 3, 7
TOKENIZERS = "/opt/tokenizers"
ANCHOR_EVERY, MISLABELLED_EVERY, CLASSES = 100, 7, 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.class_lm_scores(table(spark, sf_dir, "documents"), fold(LM_FOLDS) == 2)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judged(table(spark, sf_dir, "pages"), ALLOW, BLOCK).drop("bad_bound")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), fold(TOXIC_FOLDS) != 1)
    held_out = F.coalesce(fold(TOXIC_FOLDS) == 1, F.lit(False))
    return scored.select("row.doc_id", "score", "predicted").select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", *mixing.MARGINS, "tokens", "probability", "kept")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr(f"IF(vec_id % {MISLABELLED_EVERY} = 0, (label + 1) % {CLASSES}, label)")
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % ANCHOR_EVERY == 0, label=label)


def op13_token_links(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return token_links.token_links(table(spark, sf_dir, "documents"), f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_class_lm, op3_license_scan, op4_warc, op5_url_reputation,
        op6_ngram_jaccard_join, op7_toxicity, op8_mixing, op9_quality, op10_line_dedup,
        op11_substring_dedup, op12_hard_negatives, op13_token_links,
    )
}

_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_NOT_SPACE = r"'[^\x20\x09-\x0D]+'"

OP1 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ABC}), {_LETTERS}) AS w FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), {_ABC}), {_LETTERS}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM windows
), seen AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)
), hits AS (
  SELECT r, i, seen.n, item FROM seen JOIN windows ON seen.n = windows.n AND seen.win = windows.win
), words AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(n)) AS u(k) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

OP4 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id < largest THEN largest END AS refers_to
FROM g
"""


def _op5() -> str:
    rules = sorted(sorted([*ALLOW, *BLOCK], reverse=True), key=lambda r: -len(r))  # of equally long ones the last by name first
    cases = []
    for rule in rules:
        host, slash, path = rule.partition("/")
        cases.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}') THEN '{rule}'")
    two = ", ".join(f"'{s}'" for s in url_reputation.TWO_LABEL_SUFFIXES)
    blocked = ", ".join(f"'{r}'" for r in BLOCK)

    def strength(name: str) -> str:
        return f"""{name}_fit AS (
          SELECT CASE WHEN scale > 0 AND round(excess / scale, 9) > 0
            THEN round(least(1000.0, greatest(1.0, 1 / round(excess / scale, 9) - 1)), 6) ELSE 1000.0 END AS strength
          FROM (SELECT sum((n - 1) * above * (1 - above)) AS scale, sum(n * pow(bad / n - above, 2) - above * (1 - above)) AS excess FROM {name} WHERE n > 1)
        ), {name}_mean AS (SELECT *, (bad + strength * above) / (n + strength) AS mean FROM {name}, {name}_fit)"""

    return f"""
    WITH urls AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), {_ABC}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls
    ), ruled AS (
      SELECT *, CASE {' '.join(cases)} END AS rule FROM parts
    ), named AS (
      SELECT host, count(rule) AS n, count(*) FILTER (WHERE rule IN ({blocked})) AS bad,
        string_split(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', ''), '.') AS l
      FROM ruled GROUP BY host
    ), hosts0 AS (
      SELECT host, n, bad, l, CASE WHEN len(l) > 1 AND array_to_string(l[-2:], '.') IN ({two}) THEN 2 ELSE 1 END AS depth FROM named
    ), hosts1 AS (
      SELECT host, n, bad, array_to_string(l[-least(depth, len(l)):], '.') AS suffix, array_to_string(l[-least(depth + 1, len(l)):], '.') AS domain FROM hosts0
    ), whole AS (
      SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 0.5) / (sum(n) + 1.0) ELSE 0.5 END::DOUBLE AS above FROM hosts1
    ), suffixes AS (
      SELECT suffix, n, bad, above FROM (SELECT suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM hosts1 GROUP BY 1), whole
    ), {strength('suffixes')}, domains AS (
      SELECT d.domain, d.suffix, d.n, d.bad, m.mean AS above
      FROM (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM hosts1 GROUP BY 1, 2) d JOIN suffixes_mean m USING (suffix)
    ), {strength('domains')}, hosts AS (
      SELECT h.host, h.n::DOUBLE AS n, h.bad::DOUBLE AS bad, m.mean AS above FROM hosts1 h JOIN domains_mean m USING (domain, suffix)
    ), {strength('hosts')}
    SELECT page_id, host, path, rule,
      CASE WHEN rule IN ({blocked}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
        WHEN mean - 2.0 * sqrt(mean * (1 - mean) / (n + strength + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled JOIN hosts_mean USING (host)
    """


def _op8(temperature: float = 0.5) -> str:
    margins = mixing.MARGINS
    goals = ", ".join(f"goal_{m} AS (SELECT {m}, pow(sum(tokens)::DOUBLE, {temperature}) AS share FROM cells0 GROUP BY 1)" for m in margins)
    rounds, last = [], "cells0"
    for i in range(mixing.ROUNDS):
        for m in margins:
            rounds.append(
                f"cells_{i}_{m} AS MATERIALIZED (SELECT c.* REPLACE (weight * CASE WHEN now > 0 THEN share / now ELSE 0 END AS weight) "
                f"FROM {last} c JOIN (SELECT {m}, sum(weight) AS now FROM {last} GROUP BY 1) s USING ({m}) JOIN goal_{m} USING ({m}))"
            )
            last = f"cells_{i}_{m}"
    return f"""
    WITH docs AS (
      SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN regexp_matches(coalesce(text, ''), '[#*%&$]{{2}}') THEN 'markup'
          WHEN contains(coalesce(text, ''), chr(10) || '- ') THEN 'list' ELSE 'prose' END AS topic,
        coalesce(len(regexp_extract_all(text, {_NOT_SPACE})), 0)::BIGINT AS tokens,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, {mixing.DIGITS}))::BIGINT / pow(16.0, {mixing.DIGITS}) AS draw
      FROM documents
    ), cells0 AS (
      SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS weight FROM docs GROUP BY ALL
    ), {goals}, {', '.join(rounds)}, before AS (
      SELECT sum(tokens) OVER () AS all_tokens, sum(weight) OVER () AS all_weight,
        coalesce(sum(tokens) OVER filled, 0) AS full_tokens, coalesce(sum(weight) OVER filled, 0) AS full_weight
      FROM {last} WHERE tokens > 0 AND weight > 0
      WINDOW filled AS (ORDER BY tokens / weight, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), top AS (
      SELECT coalesce(max(({mixing.KEPT} * all_tokens - full_tokens) / (all_weight - full_weight)), 0) AS scale FROM before
    ), chances AS (
      SELECT source, lang, topic, CASE WHEN tokens = 0 THEN 1.0 ELSE round(least(1.0, weight / tokens * scale), {mixing.PLACES}) END AS probability FROM {last}, top
    )
    SELECT doc_id, source, lang, topic, tokens, probability, draw < probability AS kept FROM docs JOIN chances USING (source, lang, topic)
    """


OP10 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, text FROM documents
), lines AS (
  SELECT r, coalesce(source, chr(0)) AS site, line, nr, regexp_extract_all(translate(line, {_ABC}), {_NOT_SPACE}) AS w
  FROM (SELECT r, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr FROM docs)
), needed AS (
  SELECT least(10, greatest(2, ceil({line_dedup.SHARE} * count(DISTINCT coalesce(source, chr(0)))))) AS sites FROM docs
), spread AS (
  SELECT array_to_string(w, ' ') AS key FROM lines WHERE len(w) >= 3 GROUP BY 1 HAVING count(DISTINCT site) >= (SELECT sites FROM needed)
), marked AS (
  SELECT lines.*, len(w) >= 3 AND key IS NOT NULL AS common FROM lines LEFT JOIN spread ON array_to_string(w, ' ') = key
), verdict AS (
  SELECT r, count(*) FILTER (WHERE len(w) > 0) AS n_lines, count(*) FILTER (WHERE common) AS n_common,
    count(*) FILTER (WHERE common) < count(*) FILTER (WHERE len(w) >= 3) AS hosts,
    coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE NOT common), '') AS cut
  FROM marked GROUP BY r
)
SELECT doc_id, source, n_lines, CASE WHEN hosts THEN n_common ELSE 0 END AS n_removed, md5(CASE WHEN hosts AND n_common > 0 THEN cut ELSE coalesce(text, '') END) AS text_md5
FROM docs JOIN verdict USING (r)
"""

OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {_NOT_SPACE}) AS w FROM documents
), seen AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS win FROM docs, unnest(range(1, len(w) - 33)) AS u(i)
), hits AS (
  SELECT r, i FROM seen WHERE win IN (SELECT win FROM seen GROUP BY win HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT r, i + k AS j FROM hits, unnest(range(35)) AS u(k)
), words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM docs
), kept AS (
  SELECT r, count(gone.j) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (WHERE gone.j IS NULL) AS text
  FROM words LEFT JOIN gone USING (r, j) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

OP12 = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {MISLABELLED_EVERY} = 0 THEN (label + 1) % {CLASSES} ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER best)::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER best <= 5
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op3_license_scan": licenses.scan_sql(),
    "op4_warc": OP4,
    "op5_url_reputation": _op5(),
    "op8_mixing": _op8(),
    "op10_line_dedup": OP10,
    "op11_substring_dedup": OP11,
    "op12_hard_negatives": OP12,
}
