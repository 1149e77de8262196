"""Columns of the operators' results that SQL can say, each beside its SQL; the operators make them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import licenses, mixing, pii, sharding


def pii_base(spark, sf_dir):
    """How many base spans op1 finds of each kind."""
    return pii.query(spark, sf_dir).select("doc_id", *[f"n_{kind}" for kind in pii.BASE_KINDS])


DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
DOUBLED = "2 * CAST(substr(d, k, 1) AS INTEGER)"
LUHN = f"list_sum(list_transform(range(1, length(d) + 1), lambda k: CASE WHEN (length(d) - k) % 2 = 0 THEN CAST(substr(d, k, 1) AS INTEGER) ELSE {DOUBLED} - CASE WHEN {DOUBLED} > 9 THEN 9 ELSE 0 END END)) % 10 = 0"
PII_BASE = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (
  SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS e, regexp_extract_all(t, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') AS i,
    list_transform(regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), lambda x: {DIGITS}) AS c, list_transform(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: {DIGITS}) AS p FROM t)
SELECT doc_id, CAST(len(e) AS BIGINT) AS n_email,
  CAST(len(list_filter(i, lambda x: len(list_filter(string_split(x, '.'), lambda q: coalesce(TRY_CAST(q AS HUGEINT), 999) > 255)) = 0)) AS BIGINT) AS n_ip,
  CAST(len(list_filter(c, lambda d: length(d) BETWEEN 16 AND 19 AND {LUHN})) AS BIGINT) AS n_card, CAST(len(list_filter(p, lambda d: length(d) BETWEEN 8 AND 15)) AS BIGINT) AS n_phone FROM m
"""


def shard_sizes(spark, sf_dir):
    """Sizes and law of op2, and that every row has one of the shards."""
    rows = sharding.query(spark, sf_dir)
    return rows.select("doc_id", "size", "law", F.col("shard").between(0, sharding.SHARDS - 1).alias("placed"))


SHARD_SIZES = "SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, 'bytes' AS law, true AS placed FROM documents"


def license_base(spark, sf_dir):
    """Words and base places of op4."""
    return licenses.query(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def _places(phrase: str) -> str:
    words = "[" + ", ".join(f"'{w}'" for w in phrase.split()) + "]"
    return f"list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(phrase.split()) - 1}] = {words})"


PLACES = {label: _places(phrase) for phrase, label in licenses.PHRASES.items()}
LICENSE_BASE = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n, {', '.join(f'{places} AS p{k}' for k, places in enumerate(PLACES.values()))} FROM t),
q AS (SELECT *, list_concat(list_concat(p0, p1), p2) AS every FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(every) AS BIGINT) AS n_base, CAST(list_min(every) - 1 AS BIGINT) AS first_word, CAST(list_max(every) - 1 AS BIGINT) AS last_word,
  array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(PLACES))}], lambda x: x IS NOT NULL)), ',') AS base_labels FROM q
"""


def mix_targets(spark, sf_dir):
    """Sizes and targets of op10, and whether each source takes its target to the word."""
    rows = mixing.query(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"), "doc_id")
    # The tables' ids are distinct, so the join adds no rows.
    met = rows.groupBy("source").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    return met.select("source", "size", "source_size", F.round("target", 3).alias("target"), "taken")


MIX_TARGETS = r"""
WITH d AS (SELECT source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) AS size FROM documents GROUP BY source),
s AS (SELECT source, CAST(size AS BIGINT) AS size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d),
c AS (SELECT *, 2.0 * size / w AS r, coalesce(sum(size) OVER b, 0) AS full_size, coalesce(sum(w) OVER b, 0) AS full_weight, sum(size) OVER () AS total, sum(w) OVER () AS weight FROM s
  WINDOW b AS (ORDER BY 2.0 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT 1.5 * total - 2 * full_size AS rest, weight - full_weight AS open FROM c WHERE r >= (1.5 * total - 2 * full_size) / (weight - full_weight) ORDER BY r, source NULLS LAST LIMIT 1),
t AS (SELECT source, size, CASE WHEN r < rest / open THEN CAST(2 * size AS DOUBLE) ELSE w * CAST(rest AS DOUBLE) / open END AS target FROM c, u)
SELECT source, size, size AS source_size, round(target, 3) AS target, CAST(least(2 * size, floor(target + 0.5)) AS BIGINT) AS taken FROM t
"""

QUERIES = {"pii_base": pii_base, "shard_sizes": shard_sizes, "license_base": license_base, "mix_targets": mix_targets}
ORACLES = {"pii_base": PII_BASE, "shard_sizes": SHARD_SIZES, "license_base": LICENSE_BASE, "mix_targets": MIX_TARGETS}
