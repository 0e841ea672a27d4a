"""The operators of this subpackage as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    filter_audit,
    fingerprints,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    mixing,
    packing,
    permutation_index,
    token_file,
    toxicity,
    whitening,
)
from .common import crc_remainder, ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc_remainder(F.col("doc_id"), 4) == 2)
    net = language_id.fit(docs.filter("NOT held_out"))
    return language_id.predict(docs, net, ("doc_id", "held_out"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", crc_remainder(F.col("doc_id"), 3) == 1)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    known = toxicity.learn(docs.filter("NOT held_out"), labels)
    return toxicity.score(docs, known, ("doc_id", "held_out"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_file.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query
def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return permutation_index.search(vectors, F.col("vec_id") % 20 == 0, k=20)


#: Domain of a source; others are "other".
DOMAINS = {"web": range(0, 5), "books": range(5, 10), "news": range(10, 15), "forum": range(15, 20)}
TARGET_WEIGHTS = {
    "domain": {"web": 0.4, "books": 0.3, "news": 0.2, "forum": 0.1},
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
}


def domain_of(source: Column) -> Column:
    pairs = [F.lit(x) for name, own in DOMAINS.items() for k in own for x in (f"src{k}", name)]
    found = F.try_element_at(F.create_map(*pairs), source)
    return F.coalesce(found, F.lit("other"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    planned = mixing.plan(docs, domain_of(F.col("source")), TARGET_WEIGHTS)
    return planned.filter("epochs > 0").select(
        "doc_id", "domain", "lang", "source", "n_tokens", "budget",
        F.col("epochs").cast("long").alias("epochs"),
    )


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_dropped", "text")


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.summary(decontamination.scan(docs, items))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", whitening.as_long(F.col("deviation")))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit_documents(docs, labels).drop("filter")


def _level(depth: int) -> str:
    """Budgets of one level of the tree out of those of the level above."""
    name = mixing.LEVELS[depth]
    path, parents = (", ".join(mixing.LEVELS[:k]) for k in (depth + 1, depth))
    own = TARGET_WEIGHTS.get(name, {})
    cases = " ".join(f"WHEN '{k}' THEN {w}::DOUBLE" for k, w in own.items())
    weight = f"CASE {name} {cases} ELSE 0.1::DOUBLE END" if own else "0.1::DOUBLE"
    above = f"JOIN budget{depth - 1} b USING ({parents})" if depth else "CROSS JOIN total b"
    group = f"PARTITION BY {parents}" if depth else ""
    return f"""
node{depth} AS (
  SELECT {path}, weight, capacity, capacity / weight AS fullness, b.budget AS whole
  FROM (SELECT {path}, 2 * sum(leaf_tokens) AS capacity, {weight} AS weight
        FROM leaf GROUP BY ALL) n {above}),
level{depth} AS (
  SELECT *, row_number() OVER o AS place, (whole - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS even
  FROM node{depth} WINDOW o AS ({group} ORDER BY fullness, {name})),
budget{depth} AS (
  SELECT {path}, CASE WHEN even >= fullness THEN capacity::DOUBLE
    ELSE weight * greatest(arg_min(even, place) FILTER (WHERE even < fullness) OVER ({group}), 0) END AS budget
  FROM level{depth})"""


def _mixing_sql() -> str:
    domains = " ".join(
        f"WHEN source IN ({', '.join(repr(f'src{k}') for k in own)}) THEN '{name}'"
        for name, own in DOMAINS.items()
    )
    leaf = ", ".join(mixing.LEVELS)
    return f"""
WITH unit AS (
  SELECT doc_id, text, {leaf}, CAST(sum(n) AS BIGINT) AS n_tokens
  FROM (SELECT doc_id, text, CASE {domains} ELSE 'other' END AS domain, coalesce(lang, '') AS lang,
          coalesce(source, '') AS source, CAST(ceil(strlen(coalesce(text, '')) / 4.0) AS BIGINT) AS n
        FROM documents) GROUP BY ALL),
leaf AS (SELECT {leaf}, CAST(sum(n_tokens) AS BIGINT) AS leaf_tokens FROM unit GROUP BY ALL),
total AS (SELECT floor(0.75::DOUBLE * sum(leaf_tokens)) AS budget FROM leaf),
{",".join(_level(k) for k in range(len(mixing.LEVELS)))},
filled AS (
  SELECT {leaf}, leaf_tokens, CAST(floor(round(budget, 6)) AS BIGINT) AS budget,
    CASE WHEN leaf_tokens > 0 THEN CAST(floor(round(budget, 6)) AS BIGINT) // leaf_tokens ELSE 0 END AS full_epochs
  FROM leaf JOIN budget2 USING ({leaf})),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY {leaf}
      ORDER BY md5(concat_ws(':', '{mixing.SEED}', full_epochs, doc_id)), doc_id
      ROWS UNBOUNDED PRECEDING) AS upto
  FROM unit JOIN filled USING ({leaf})),
counted AS (
  SELECT *, full_epochs + CAST(upto <= budget - full_epochs * leaf_tokens AS BIGINT) AS epochs
  FROM placed WHERE n_tokens > 0)
SELECT doc_id, {leaf}, n_tokens, budget, epochs FROM counted WHERE epochs > 0"""


SQL["op8_mixing"] = _mixing_sql()

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

SQL["op11_decontamination"] = f"""
WITH doc AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item, n, array_to_string(w[p + 1:p + n], ' ') AS words
  FROM (SELECT *, unnest(range(len(w) - n + 1)) AS p
        FROM (SELECT *, least(10, len(w)) AS n FROM item WHERE len(w) > 0))),
doc_window AS (
  SELECT id, p, n, array_to_string(w[p + 1:p + n], ' ') AS words
  FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS p
        FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)),
hit AS (SELECT id, p, n, item FROM doc_window JOIN item_window USING (n, words)),
covered AS (SELECT id, count(DISTINCT place) AS n_hit
            FROM (SELECT id, unnest(range(p, p + n)) AS place FROM hit) GROUP BY id),
owner AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT id, item FROM hit) GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (id) LEFT JOIN owner USING (id)"""

SQL["op13_filter_audit"] = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
label AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
          FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
      WHEN 'A' THEN len(w) < 200
      WHEN 'B' THEN 100 * len(list_distinct(w)) < 50 * len(w)
      WHEN 'C' THEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)
      WHEN 'D' THEN regexp_matches(text, '[#$%&*|]')
      ELSE coalesce(doc_id > first_id, first_id IS NOT NULL) END) AS fails
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first_id FROM doc)
  LEFT JOIN label USING (doc_id)),
mask AS (SELECT part, fails, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic
         FROM failed GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
filter_order AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
placed AS (
  SELECT part, o, step, fails, docs, good, toxic, o[step] AS f,
    list_contains(fails, o[step]) AS is_failing, list_has_any(fails, o[1:step - 1]) AS is_gone
  FROM mask, filter_order, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, o, step, f,
    sum(CASE WHEN is_failing OR is_gone THEN 0 ELSE docs END)::BIGINT AS kept,
    sum(CASE WHEN is_failing AND NOT is_gone THEN docs ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN is_failing AND is_gone THEN docs ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN is_failing AND len(fails) = 1 THEN docs ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN is_failing AND NOT is_gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN is_failing AND NOT is_gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM placed GROUP BY ALL)
SELECT part, array_to_string(o, '') AS filter_order, step, kept, removed, redundant, unique_fails,
  good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted"""
