"""Queries of joins, aggregations, windows, set operations and composite stages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import text as T
from ..operators import glossary, lines, quality, translate
from ..session import stored, table
from . import sql as S
from .catalog import ORACLES, query  # noqa: F401

WITH = f"WITH {S.LINES}, {S.UNITS}"
#: A memory for tests: a unit is translated in a language unless its hash ends in 0 to 3.
MEMORY = "memory AS (SELECT lang, hash, min(lang || ': ' || text) AS out FROM units WHERE right(hash, 1) NOT IN ('0', '1', '2', '3') GROUP BY lang, hash)"
DEDUP = """deduped AS (
  SELECT hash, min(text) AS text, count(*) AS count, first(kind ORDER BY doc_id, seg) AS kind, first(doc_id ORDER BY doc_id, seg) AS sample,
         CASE WHEN min(coalesce(el, '')) = max(coalesce(el, '')) THEN min(el) END AS el
  FROM (SELECT *, CASE WHEN seg = 0 THEN 'block' ELSE 'text' END AS kind, CASE WHEN seg % 3 = 0 THEN 'h1' WHEN seg % 3 = 1 THEN 'p' END AS el FROM units)
  GROUP BY hash)"""


def units(spark, sf):
    return lines.units_of(lines.segments(table(spark, sf, "documents")))


def deduped(spark, sf):
    kind = F.when(F.col("seg") == 0, "block").otherwise("text")
    el = F.when(F.col("seg") % 3 == 0, "h1").when(F.col("seg") % 3 == 1, "p")
    return lines.dedup(units(spark, sf), kind, el)


def memory(spark, sf, rows=None):
    rows = (units(spark, sf) if rows is None else rows).filter(~F.right("hash", F.lit(1)).isin("0", "1", "2", "3"))
    return rows.groupBy("lang", "hash").agg(F.min(F.concat("lang", F.lit(": "), "text")).alias("out"))


def talks(spark, sf):
    return lines.pairs(table(spark, sf, "conversations"))


def judged(spark, sf):
    return lines.judged(table(spark, sf, "documents"), table(spark, sf, "labels"))


JUDGED = f"""judged AS (SELECT d.doc_id, lang, {S.word_count('text')} AS words, CASE WHEN toxic = 1 THEN 'critical' WHEN quality = 0 THEN 'major' END AS severity,
  CASE WHEN toxic = 1 THEN 'style/tone' WHEN quality = 0 THEN 'fluency/awkward' END AS category FROM documents d JOIN labels USING (doc_id))"""
WEIGHT = "CASE severity WHEN 'critical' THEN 10 WHEN 'major' THEN 5 WHEN 'minor' THEN 1 ELSE 0 END"


# --- aggregations ---------------------------------------------------------------------------


@query("dedup_units", f"{WITH}, {DEDUP} SELECT hash, text, count, kind, sample, el FROM deduped")
def dedup_units(spark, sf):
    return deduped(spark, sf).select("hash", "text", "count", "kind", "sample", "el")


@query("units_by_kind", f"{WITH}, {DEDUP} SELECT kind, count(*) AS units FROM deduped GROUP BY kind")
def units_by_kind(spark, sf):
    return deduped(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("units"))


@query("extract_summary", f"{WITH}, {DEDUP} SELECT (SELECT count(DISTINCT doc_id) FROM units) AS pages, (SELECT count(*) FROM units) AS segments, (SELECT count(*) FROM deduped) AS units, (SELECT CAST(sum({S.word_count('text')}) AS BIGINT) FROM deduped) AS words")
def extract_summary(spark, sf):
    # A page's segments of one text travel as one row.
    seen = units(spark, sf).groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n"), F.min(T.word_count(F.col("text"))).alias("w"))
    seen = stored(seen)
    per_unit = seen.groupBy("hash").agg(F.sum("n").alias("n"), F.min("w").alias("w"))
    totals = per_unit.agg(F.sum("n").alias("segments"), F.count(F.lit(1)).alias("units"), F.sum("w").alias("words"))
    pages = seen.agg(F.count_distinct("doc_id").alias("pages"))
    return totals.join(F.broadcast(pages), F.lit(True)).select("pages", "segments", "units", "words")


@query("manifest", f"{WITH} SELECT doc_id, count(*) AS segments FROM units GROUP BY doc_id")
def manifest(spark, sf):
    return units(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("segments"))


@query("word_volume", f"{WITH}, {DEDUP}, w AS (SELECT CAST(sum({S.word_count('text')}) AS BIGINT) AS words FROM deduped) SELECT words, (SELECT count(DISTINCT lang) FROM documents) AS locales, words * (SELECT count(DISTINCT lang) FROM documents) AS volume FROM w")
def word_volume(spark, sf):
    words = deduped(spark, sf).agg(F.sum(T.word_count(F.col("text"))).alias("words"))
    locales = table(spark, sf, "documents").agg(F.count_distinct("lang").alias("locales"))
    return words.join(F.broadcast(locales), F.lit(True)).withColumn("volume", F.col("words") * F.col("locales"))


@query("coverage", f"{WITH}, {MEMORY} SELECT u.lang, count(*) AS total, count(m.hash) AS covered, round(100.0 * count(m.hash) / count(*), 6) AS percent, 100.0 * count(m.hash) / count(*) < 99 AS fails FROM units u LEFT JOIN memory m USING (lang, hash) GROUP BY u.lang")
def coverage(spark, sf):
    from ..operators import gates

    rows = stored(units(spark, sf).select("lang", "hash"))
    return gates.coverage(rows, memory(spark, sf, rows.withColumn("text", F.lit(""))))


@query("churn", f"{WITH}, {MEMORY}, u AS (SELECT DISTINCT lang, hash FROM units) SELECT u.lang, count(*) AS units, count(*) - count(m.hash) AS pending, round(100.0 * (count(*) - count(m.hash)) / count(*), 6) AS percent, 100.0 * (count(*) - count(m.hash)) / count(*) >= 15 AS hint FROM u LEFT JOIN memory m USING (lang, hash) GROUP BY u.lang")
def churn(spark, sf):
    known = stored(units(spark, sf).select("lang", "hash").distinct())
    rows = known.join(memory(spark, sf, known.withColumn("text", F.lit(""))), ["lang", "hash"], "left")
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("units"), F.count(F.when(F.col("out").isNull(), 1)).alias("pending"))
    percent = 100 * F.col("pending") / F.col("units")
    return counted.withColumn("percent", F.round(percent, 6)).withColumn("hint", percent >= K.CHURN_HINT)


@query("build_report", f"{WITH}, {MEMORY} SELECT u.lang, count(m.hash) AS replaced, count(*) - count(m.hash) AS untranslated FROM units u LEFT JOIN memory m USING (lang, hash) GROUP BY u.lang")
def build_report(spark, sf):
    rows = stored(units(spark, sf).select("lang", "hash"))
    joined = rows.join(memory(spark, sf, rows.withColumn("text", F.lit(""))), ["lang", "hash"], "left")
    return joined.groupBy("lang").agg(F.count("out").alias("replaced"), F.count(F.when(F.col("out").isNull(), 1)).alias("untranslated"))


@query("money_by_currency", "SELECT CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency, count(*) AS n, round(sum(round(o_totalprice, 2)), 2) AS total FROM orders GROUP BY 1")
def money_by_currency(spark, sf):
    code = F.when(F.col("o_custkey") % 3 == 0, "USD").when(F.col("o_custkey") % 3 == 1, "EUR").otherwise("GBP")
    rows = table(spark, sf, "orders").select(code.alias("currency"), F.round("o_totalprice", 2).cast("decimal(20,2)").alias("value"))
    return rows.groupBy("currency").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


@query("mqm_score", f"WITH {JUDGED} SELECT lang, sum({WEIGHT})::BIGINT AS penalty, sum(words)::BIGINT AS words, count(*) AS units, count(*) FILTER (severity IS NULL) AS clean, count(*) FILTER (severity = 'minor') AS minor, count(*) FILTER (severity = 'major') AS major, count(*) FILTER (severity = 'critical') AS critical, floor((100 - CAST(sum({WEIGHT}) AS DOUBLE) / sum(words) * 100) * 100 + 0.5) / 100 AS mqm FROM judged GROUP BY lang")
def mqm_score(spark, sf):
    return quality.score(judged(spark, sf), "lang")


@query("errors_by_category", f"WITH {JUDGED} SELECT lang, category, count(*) AS errors FROM judged WHERE category IS NOT NULL GROUP BY lang, category")
def errors_by_category(spark, sf):
    return judged(spark, sf).filter("category IS NOT NULL").groupBy("lang", "category").agg(F.count(F.lit(1)).alias("errors"))


@query("usage_cost", "SELECT event_type, sum(event_id % 500)::BIGINT AS tokens_in, sum(event_id % 300)::BIGINT AS tokens_out, CASE event_type WHEN 'click' THEN round((sum(event_id % 500) * 3.0 + sum(event_id % 300) * 15.0) / 1000000, 6) WHEN 'view' THEN round((sum(event_id % 500) * 0.1 + sum(event_id % 300) * 0.4) / 1000000, 6) END AS cost FROM events GROUP BY event_type")
def usage_cost(spark, sf):
    usage = table(spark, sf, "events").groupBy("event_type").agg(F.sum(F.col("event_id") % 500).alias("tokens_in"), F.sum(F.col("event_id") % 300).alias("tokens_out"))
    rate = lambda i, o: F.round((F.col("tokens_in") * i + F.col("tokens_out") * o) / 1_000_000, 6)
    return usage.withColumn("cost", F.when(F.col("event_type") == "click", rate(3.0, 15.0)).when(F.col("event_type") == "view", rate(0.1, 0.4)))


@query("tqa_estimate", f"{WITH}, {DEDUP}, w AS (SELECT CAST(sum({S.word_count('text')}) AS BIGINT) AS words, count(*) AS n FROM deduped) SELECT n, words, CAST(ceil(words * 3.2) + 40 * n AS BIGINT) AS tokens_in, 25 * n AS tokens_out FROM w")
def tqa_estimate(spark, sf):
    return quality.estimate(deduped(spark, sf))


@query("judged_share", "SELECT lang, count(*) AS sampled, count(l.doc_id) AS assessed, count(*) - count(l.doc_id) AS unreadable, round(100.0 * count(l.doc_id) / count(*), 6) AS percent, CASE WHEN count(l.doc_id) = 0 THEN 'no score' WHEN 100.0 * count(l.doc_id) / count(*) < 80 THEN 'warn' ELSE 'ok' END AS verdict FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang")
def judged_share(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", F.lit(1).alias("got")), "doc_id", "left")
    share = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("sampled"), F.count("got").alias("assessed"))
    percent = 100 * F.col("assessed") / F.col("sampled")
    verdict = F.when(F.col("assessed") == 0, "no score").when(percent < K.JUDGED_FLOOR, "warn").otherwise("ok")
    return share.withColumn("unreadable", F.col("sampled") - F.col("assessed")).withColumn("percent", F.round(percent, 6)).withColumn("verdict", verdict)


@query("repeat_variance", f"WITH {JUDGED}, a AS (SELECT lang, floor((100 - CAST(sum({WEIGHT}) AS DOUBLE) / sum(words) * 100) * 100 + 0.5) / 100 AS first, floor((100 - CAST(sum(CASE WHEN doc_id % 2 = 0 THEN {WEIGHT} ELSE 0 END) AS DOUBLE) / sum(words) * 100) * 100 + 0.5) / 100 AS second FROM judged GROUP BY lang) SELECT lang, first, second, floor((second - first) * 100 + 0.5) / 100 AS delta FROM a")
def repeat_variance(spark, sf):
    first = quality.score(judged(spark, sf), "lang").select("lang", F.col("mqm").alias("first"))
    again = judged(spark, sf).withColumn("severity", F.when(F.col("doc_id") % 2 == 0, F.col("severity")))
    second = quality.score(again, "lang").select("lang", F.col("mqm").alias("second"))
    return first.join(second, "lang").withColumn("delta", F.floor((F.col("second") - F.col("first")) * 100 + 0.5) / 100)


# --- joins ----------------------------------------------------------------------------------


@query("splice_join", f"{WITH}, {MEMORY} SELECT u.doc_id, u.seg, coalesce(m.out, u.text) AS text, m.hash IS NOT NULL AS replaced FROM units u LEFT JOIN memory m USING (lang, hash)")
def splice_join(spark, sf):
    joined = units(spark, sf).join(memory(spark, sf), ["lang", "hash"], "left")
    return joined.select("doc_id", "seg", F.coalesce("out", "text").alias("text"), F.col("out").isNotNull().alias("replaced"))


@query("missing_source", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_source(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_anti").select("doc_id")


@query("expected_pages", f"WITH {S.PAGES} SELECT DISTINCT s.slug, n_name AS locale, lower(n_name) || '/' || s.slug AS page FROM site s, nation")
def expected_pages(spark, sf):
    slugs = lines.page_rows(table(spark, sf, "pages")).select("slug").distinct()
    locales = table(spark, sf, "nation").select(F.col("n_name").alias("locale"))
    return slugs.join(F.broadcast(locales), F.lit(True)).withColumn("page", F.concat(F.lower("locale"), F.lit("/"), "slug"))


@query("pending_units", f"{WITH}, {MEMORY} SELECT DISTINCT lang, hash FROM units WHERE (lang, hash) NOT IN (SELECT (lang, hash) FROM memory)")
def pending_units(spark, sf):
    return units(spark, sf).select("lang", "hash").distinct().join(memory(spark, sf), ["lang", "hash"], "left_anti")


@query("tm_units_join", f"{WITH}, {DEDUP}, {MEMORY} SELECT m.lang, m.hash, m.out, d.count FROM memory m JOIN deduped d USING (hash)")
def tm_units_join(spark, sf):
    return memory(spark, sf).join(deduped(spark, sf).select("hash", "count"), "hash").select("lang", "hash", "out", "count")


TERMS = [("The", "keep", None, True), ("for", "keep", None, False), ("de", "translate", "von", True), ("das", "translate", None, True), ("an of", "keep", None, False)]
TERMS_SQL = "terms(source, rule, target, match_case) AS (VALUES ('The', 'keep', NULL, true), ('for', 'keep', NULL, false), ('de', 'translate', 'von', true), ('das', 'translate', NULL, true), ('an of', 'keep', NULL, false))"


def terms(spark):
    rows = [(s, r, {"xx": t} if t else None, m, None) for s, r, t, m in TERMS]
    return spark.createDataFrame(rows, glossary.SCHEMA)


HIT = f"CASE WHEN t.match_case THEN {S.term('u.text', 't.source')} ELSE {S.term('lower(u.text)', 'lower(t.source)')} END"


@query("glossary_hits", f"{WITH}, {DEDUP}, {TERMS_SQL} SELECT u.hash, t.source FROM deduped u, terms t WHERE {HIT}")
def glossary_hits(spark, sf):
    return glossary.hits_of_units(units(spark, sf), terms(spark))


@query("terms_for_batch", f"{WITH}, {DEDUP}, {TERMS_SQL} SELECT left(u.hash, 1) AS batch, t.source, count(*) AS units FROM deduped u, terms t WHERE (t.rule = 'keep' OR t.target IS NOT NULL) AND {HIT} GROUP BY 1, 2")
def terms_for_batch(spark, sf):
    usable = terms(spark).filter("rule = 'keep' OR try_element_at(targets, 'xx') IS NOT NULL")
    hit = glossary.hits_of_units(units(spark, sf), usable)
    return hit.groupBy(F.left("hash", F.lit(1)).alias("batch"), "source").agg(F.count(F.lit(1)).alias("units"))


def violations(spark, sf):
    turns = table(spark, sf, "conversations")
    return glossary.violations_between(lines.sources(turns), lines.targets(turns), ["conv_id", "turn"], terms(spark), "xx")


VIOLATED = "(CASE WHEN t.match_case THEN {0} ELSE {1} END) AND CASE WHEN t.rule = 'keep' THEN NOT contains(u.dst, t.source) ELSE t.target IS NOT NULL AND NOT contains(lower(u.dst), lower(t.target)) END".format(S.term("u.src", "t.source"), S.term("lower(u.src)", "lower(t.source)"))


@query("glossary_violations", f"WITH {S.PAIRS}, {TERMS_SQL} SELECT t.source, count(*) AS violations FROM pairs u, terms t WHERE {VIOLATED} GROUP BY t.source")
def glossary_violations(spark, sf):
    return violations(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("violations"))


@query("effective_glossary", "WITH e(source, rule) AS (VALUES ('PDF', 'translate'), ('Acme Cloud', 'keep'), ('Acme', 'keep')), i AS (SELECT unnest(" + S.array(K.TECH_TOKENS) + ") AS source) SELECT source, rule FROM e UNION ALL SELECT source, 'keep' FROM i WHERE source NOT IN (SELECT source FROM e)")
def effective_glossary(spark, sf):
    explicit = spark.createDataFrame([("PDF", "translate"), ("Acme Cloud", "keep"), ("Acme", "keep")], "source string, rule string")
    inherited = spark.createDataFrame([(t, "keep") for t in K.TECH_TOKENS], "source string, rule string")
    return glossary.effective(explicit, inherited)


@query("glossary_fingerprint", "SELECT 'The|keep|true|' || chr(10) || 'an of|keep|false|' || chr(10) || 'das|translate|true|' || chr(10) || 'de|translate|true|xx=von' || chr(10) || 'for|keep|false|' AS fingerprint")
def glossary_fingerprint(spark, sf):
    return glossary.fingerprint(terms(spark))


@query("glossary_diff", "SELECT * FROM (VALUES ('for|keep|true|', 'added', 'for'), ('for|keep|false|', 'removed', 'for'), ('an of|keep|false|', 'removed', 'an of')) AS t(line, side, source)")
def glossary_diff(spark, sf):
    new = terms(spark).filter("source != 'an of'").withColumn("match_case", F.col("match_case") | (F.col("source") == "for"))
    return glossary.changed_terms(terms(spark), new)


@query("tm_invalidate", f"{WITH}, {DEDUP}, {MEMORY} SELECT m.lang, m.hash FROM memory m WHERE m.hash NOT IN (SELECT hash FROM deduped u WHERE {S.term('lower(u.text)', S.lit('for'))} OR {S.term('lower(u.text)', S.lit('an of'))})")
def tm_invalidate(spark, sf):
    return glossary.invalidate(memory(spark, sf), units(spark, sf), glossary_diff(spark, sf)).select("lang", "hash")


@query("reply_join", "WITH r AS (SELECT conv_id, max_by(text, turn) AS reply FROM conversations GROUP BY conv_id) SELECT d.doc_id, md5(r.reply) AS reply FROM documents d LEFT JOIN r ON r.conv_id = d.doc_id")
def reply_join(spark, sf):
    last = table(spark, sf, "conversations").groupBy("conv_id").agg(F.max_by("text", "turn").alias("reply"))
    return table(spark, sf, "documents").join(last, F.col("doc_id") == F.col("conv_id"), "left").select("doc_id", F.md5("reply").alias("reply"))


@query("url_parity", f"WITH {S.PAGES}, k AS (SELECT DISTINCT lang, slug FROM site), e AS (SELECT l.lang, s.slug FROM (SELECT DISTINCT lang FROM k) l, (SELECT DISTINCT slug FROM k) s) SELECT lang, slug FROM e WHERE (lang, slug) NOT IN (SELECT (lang, slug) FROM k)")
def url_parity(spark, sf):
    from ..operators import gates

    built = lines.page_rows(table(spark, sf, "pages")).select("lang", "slug").distinct()
    return gates.missing_pages(built.select("slug").distinct(), built.select("lang").distinct(), built)


@query("page_pair", f"WITH {S.PAGES}, k AS (SELECT slug, lang, min(page_id) AS page FROM site GROUP BY slug, lang) SELECT a.slug, b.lang, a.page AS source_page, b.page AS page FROM k a JOIN k b ON a.slug = b.slug AND a.lang = 'en' AND b.lang <> 'en'")
def page_pair(spark, sf):
    k = lines.page_rows(table(spark, sf, "pages")).groupBy("slug", "lang").agg(F.min("page_id").alias("page"))
    source = k.filter("lang = 'en'").select("slug", F.col("page").alias("source_page"))
    return k.filter("lang != 'en'").join(source, "slug").select("slug", "lang", "source_page", "page")


# --- windows, ordering, sampling ---------------------------------------------------------------


@query("units_ranked", f"{WITH}, f AS (SELECT hash, count(*) AS count, min((doc_id, seg)) AS seen FROM units GROUP BY hash) SELECT hash, count, row_number() OVER (ORDER BY count DESC, seen, hash) AS place FROM f")
def units_ranked(spark, sf):
    """Places by count, then first seen."""
    rows = stored(deduped(spark, sf).select("hash", "count", F.col("first_seen.doc_id").alias("d"), F.col("first_seen.seg").alias("s")))
    ranked = quality.two_level_rank(rows.withColumn("cell", F.floor(F.col("d") / 65_536)), "count", "cell", "d", "s", "hash")
    return ranked.select("hash", "count", (F.col("rank") + 1).alias("place"))


@query("top_units", f"{WITH}, {DEDUP} SELECT hash, count FROM deduped ORDER BY count DESC, hash LIMIT 50")
def top_units(spark, sf):
    return deduped(spark, sf).select("hash", "count").orderBy(F.desc("count"), "hash").limit(50)


@query("batches", f"{WITH}, {DEDUP}, r AS (SELECT hash, row_number() OVER (PARTITION BY left(hash, 2) ORDER BY count DESC, hash) - 1 AS slot FROM deduped) SELECT hash, left(hash, 2) || '-' || CAST(slot // 40 AS VARCHAR) AS batch FROM r")
def batches(spark, sf):
    return translate.batches(deduped(spark, sf)).select("hash", "batch")


@query("stratum_quotas", f"{WITH}, {DEDUP}, r AS (SELECT row_number() OVER (ORDER BY count DESC, left(hash, 2), hash) - 1 AS p, count(*) OVER () AS n FROM deduped), s AS (SELECT CAST(least(p // CAST(ceil(n / 3.0) AS BIGINT), 2) AS INTEGER) AS stratum FROM r) SELECT stratum, count(*) AS size, CAST(least(count(*), greatest(1, floor(CASE WHEN stratum = 0 THEN 0.5 ELSE 0.25 END * 100 + 0.5))) AS BIGINT) AS quota FROM s GROUP BY stratum")
def stratum_quotas(spark, sf):
    return quality.quotas(stored(deduped(spark, sf).select("hash", "count")))


@query("stratified_sample")
def stratified_sample(spark, sf):
    return quality.stratified_sample(stored(deduped(spark, sf).select("hash", "count"))).select("hash", "count", "stratum", "rank")


@query("worst_units", f"WITH {JUDGED}, r AS (SELECT lang, doc_id, {WEIGHT} AS w, row_number() OVER (PARTITION BY lang ORDER BY {WEIGHT} DESC, doc_id) AS rank FROM judged) SELECT lang, doc_id, w, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 15 AND w > 0")
def worst_units(spark, sf):
    return quality.worst(judged(spark, sf)).select("lang", "doc_id", "w", "rank")


@query("overlap_check", "WITH s AS (SELECT l_orderkey AS page, l_linenumber AS seg, CAST(l_quantity AS BIGINT) AS start, CAST(l_quantity + l_linenumber AS BIGINT) AS stop FROM lineitem), o AS (SELECT *, lag(start) OVER (PARTITION BY page ORDER BY start DESC, stop DESC, seg) AS later FROM s) SELECT page, seg, start, stop, later FROM o WHERE stop > later")
def overlap_check(spark, sf):
    from ..operators import build

    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("seg"), F.col("l_quantity").cast("long").alias("start"), (F.col("l_quantity") + F.col("l_linenumber")).cast("long").alias("stop"))
    return build.overlaps(rows)


@query("page_sample", f"WITH {S.PAGES}, r AS (SELECT lang, slug, page_id, row_number() OVER (PARTITION BY lang ORDER BY slug, page_id) AS k FROM site) SELECT lang, slug, page_id FROM r WHERE k <= 25")
def page_sample(spark, sf):
    k = F.row_number().over(Window.partitionBy("lang").orderBy("slug", "page_id"))
    return lines.page_rows(table(spark, sf, "pages")).withColumn("k", k).filter(F.col("k") <= K.GATE_PAGES).select("lang", "slug", "page_id")


@query("first_examples", f"WITH {JUDGED}, r AS (SELECT category, doc_id, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS k FROM judged WHERE category IS NOT NULL) SELECT category, doc_id FROM r WHERE k <= 5")
def first_examples(spark, sf):
    k = F.row_number().over(Window.partitionBy("category").orderBy("doc_id"))
    return judged(spark, sf).filter("category IS NOT NULL").withColumn("k", k).filter("k <= 5").select("category", "doc_id")


# --- set operations -------------------------------------------------------------------------------


@query("dnt_union", "SELECT DISTINCT unnest(" + S.array([*K.TECH_TOKENS, "Acme", "English"]) + ") AS token UNION SELECT DISTINCT n_name FROM nation")
def dnt_union(spark, sf):
    fixed = spark.createDataFrame([(t,) for t in [*K.TECH_TOKENS, "Acme", "English"]], "token string")
    return fixed.union(table(spark, sf, "nation").select("n_name")).distinct()


@query("visible_intersection", f"{WITH} SELECT text FROM units WHERE lang = 'en' INTERSECT SELECT text FROM units WHERE lang <> 'en'")
def visible_intersection(spark, sf):
    u = units(spark, sf)
    return u.filter("lang = 'en'").select("text").intersect(u.filter("lang != 'en'").select("text"))


@query("code_difference", f"WITH {S.PAGES} SELECT n_name AS code, 'missing' AS side FROM (SELECT lower(left(n_name, 2)) AS n_name FROM nation EXCEPT SELECT lang FROM site) UNION ALL SELECT lang, 'unexpected' FROM (SELECT lang FROM site EXCEPT SELECT lower(left(n_name, 2)) FROM nation)")
def code_difference(spark, sf):
    want = table(spark, sf, "nation").select(F.lower(F.left("n_name", F.lit(2))).alias("code"))
    have = lines.page_rows(table(spark, sf, "pages")).select(F.col("lang").alias("code"))
    return want.subtract(have).withColumn("side", F.lit("missing")).unionByName(have.subtract(want).withColumn("side", F.lit("unexpected")))


@query("multiset_equality", f"WITH {S.PAIRS} SELECT conv_id, turn, {S.multiset('src')} = {S.multiset('dst')} AS tags_equal, {S.numerals('src')} = {S.numerals('dst')} AS numbers_equal FROM pairs")
def multiset_equality(spark, sf):
    a, b = F.col("src"), F.col("dst")
    return talks(spark, sf).select("conv_id", "turn", (T.placeholders(a) == T.placeholders(b)).alias("tags_equal"), (T.numerals(a) == T.numerals(b)).alias("numbers_equal"))


# --- review ------------------------------------------------------------------------------------------

LOCALE = "CASE conv_id % 3 WHEN 0 THEN 'ja' WHEN 1 THEN 'ru' ELSE 'es' END"
SRC_LEN = f"length({S.trim(S.strip('src'))})"
LEN_BAD = f"({SRC_LEN} >= 40 AND CASE WHEN locale = 'ja' THEN {S.length_ratio('src', 'dst')} NOT BETWEEN 0.12 AND 1.2 ELSE {S.length_ratio('src', 'dst')} NOT BETWEEN 0.4 AND 2.5 END)"
SAME = f"({SRC_LEN} >= 25 AND {S.trim('src')} = {S.trim('dst')} AND {S.content_words('src')} >= 3)"
LATIN = f"(locale IN ('ja', 'ru') AND {S.content_words('src')} >= 6 AND {S.latin_ratio('dst')} > 0.8)"
OVER = f"({S.content_words('src')} >= 6 AND {S.overlap('src', 'dst')} > 0.75)"
TAGS = f"({S.multiset('src')} <> {S.multiset('dst')})"
TALK = f"WITH {S.PAIRS}, t AS (SELECT *, {LOCALE} AS locale FROM pairs)"
FLAGS = f"{TALK}, f AS (SELECT conv_id, turn, locale, list_filter([CASE WHEN {TAGS} THEN 'placeholder' END, CASE WHEN {LEN_BAD} THEN 'length-anomaly' END, CASE WHEN {SAME} THEN 'untranslated' END, CASE WHEN {LATIN} THEN 'latin-heavy' END, CASE WHEN {OVER} THEN 'high-overlap' END], lambda x: x IS NOT NULL) AS reasons FROM t)"


def localised(spark, sf):
    return talks(spark, sf).withColumn("locale", F.expr(LOCALE))


def flagged(spark, sf):
    from ..operators import review

    return review.flags(localised(spark, sf))


for _name, _flag, _rule in (("length_anomaly", "length-anomaly", LEN_BAD), ("untranslated", "untranslated", SAME), ("latin_heavy", "latin-heavy", LATIN), ("high_overlap", "high-overlap", OVER), ("review_placeholder", "placeholder", TAGS)):

    @query(_name, f"{TALK} SELECT conv_id, turn FROM t WHERE {_rule}")
    def one_flag(spark, sf, flag=_flag):
        return flagged(spark, sf).filter(F.array_contains("reasons", flag)).select("conv_id", "turn")


@query("review_flags", f"{FLAGS} SELECT conv_id, turn, array_to_string(reasons, ',') AS reasons FROM f WHERE len(reasons) > 0")
def review_flags(spark, sf):
    return flagged(spark, sf).select("conv_id", "turn", F.array_join("reasons", ",").alias("reasons"))


@query("flags_by_reason", f"{FLAGS} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM f) GROUP BY reason")
def flags_by_reason(spark, sf):
    return flagged(spark, sf).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("flag_rate", f"{FLAGS} SELECT locale, count(*) AS units, count(*) FILTER (len(reasons) > 0) AS flagged, round(100.0 * count(*) FILTER (len(reasons) > 0) / count(*), 6) AS percent FROM f GROUP BY locale")
def flag_rate(spark, sf):
    from ..operators import review

    marked = review.reasons(localised(spark, sf))
    counted = marked.groupBy("locale").agg(F.count(F.lit(1)).alias("units"), F.count(F.when(F.size("reasons") > 0, 1)).alias("flagged"))
    return counted.withColumn("percent", F.round(100 * F.col("flagged") / F.col("units"), 6))


@query("tm_purge", f"{FLAGS} SELECT conv_id, turn FROM f WHERE len(reasons) = 0")
def tm_purge(spark, sf):
    return talks(spark, sf).join(flagged(spark, sf), ["conv_id", "turn"], "left_anti").select("conv_id", "turn")


@query("numeric_drift", f"WITH {S.PAIRS} SELECT conv_id % 3 AS locale, count(*) AS units, count(*) FILTER ({S.numerals('src')} <> {S.numerals('dst')}) AS drifted FROM pairs GROUP BY 1")
def numeric_drift(spark, sf):
    from ..operators import gates

    return gates.numeric_drift(talks(spark, sf).withColumn("locale", F.col("conv_id") % 3), "locale")


def drifted(spark, sf):
    """Pairs (by their numbers) whose numbers differ; texts do not travel."""
    numbers = table(spark, sf, "conversations").withColumn("text", F.array_join(T.numerals(F.col("text")), ","))
    return lines.pairs(numbers).filter("src != dst")


@query("retry_set", f"WITH {S.PAIRS} SELECT conv_id, turn FROM pairs WHERE coalesce({S.trim('dst')}, '') = '' OR {TAGS}")
def retry_set(spark, sf):
    return talks(spark, sf).filter(T.problem(F.col("src"), F.col("dst")).isNotNull()).select("conv_id", "turn")


# --- quality -----------------------------------------------------------------------------------------


@query("tqa_pool", f"{WITH}, {DEDUP}, {MEMORY} SELECT m.lang, d.hash, d.text AS source, m.out AS target, d.count FROM memory m JOIN deduped d USING (hash)")
def tqa_pool(spark, sf):
    d = deduped(spark, sf).select("hash", F.col("text").alias("source"), "count")
    return memory(spark, sf).join(d, "hash").select("lang", "hash", "source", F.col("out").alias("target"), "count")


@query("judge_join", f"WITH {JUDGED} SELECT d.doc_id, d.lang, j.severity, j.doc_id IS NULL AS unreadable FROM documents d LEFT JOIN judged j USING (doc_id)")
def judge_join(spark, sf):
    j = judged(spark, sf).select("doc_id", "severity", F.lit(True).alias("got"))
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(j, "doc_id", "left")
    return rows.select("doc_id", "lang", "severity", F.col("got").isNull().alias("unreadable"))


@query("tqa_report", f"""WITH {JUDGED}, s AS (SELECT lang, sum({WEIGHT})::BIGINT AS penalty, sum(words)::BIGINT AS words, count(*) AS units, floor((100 - CAST(sum({WEIGHT}) AS DOUBLE) / sum(words) * 100) * 100 + 0.5) / 100 AS mqm FROM judged GROUP BY lang),
    r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {WEIGHT} DESC, doc_id) AS k, {WEIGHT} AS w FROM judged), w AS (SELECT lang, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY k) AS worst FROM r WHERE k <= 15 AND w > 0 GROUP BY lang)
    SELECT lang, mqm, penalty, words, units, worst FROM s LEFT JOIN w USING (lang)""")  # fmt: skip
def tqa_report(spark, sf):
    worst = quality.worst(judged(spark, sf)).groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"].cast("string")), ",").alias("worst"))
    return quality.score(judged(spark, sf), "lang").join(worst, "lang", "left").select("lang", "mqm", "penalty", "words", "units", "worst")


@query("translate_units")
def translate_units(spark, sf):
    """All pending units through the offline translator, validated."""
    return translate.translate(stored(deduped(spark, sf).select("hash", "text", "count", "el")), "xx")


@query("judge_units", f"""WITH {S.PAIRS} SELECT sha1(conv_id || ':' || turn) AS hash, {S.word_count('src')} AS words, false AS unreadable, CASE WHEN src = dst THEN 1 ELSE 0 END AS errors FROM pairs""")
def judge_units(spark, sf):
    """Turns and their answers through the offline judge, which finds an error where the two are equal."""
    from ..operators import judge

    rows = talks(spark, sf).select(F.sha1(F.concat("conv_id", F.lit(":"), "turn")).alias("hash"), F.col("src").alias("source"), F.col("dst").alias("target"), F.lit(1).alias("count"))
    return judge.judge(rows, "xx").select("hash", "words", "unreadable", F.size("errors").alias("errors"))


# --- gates over documents' lines ------------------------------------------------------------------------

LINE_RULE = S.translatable("text", least=3, tags=False, english=False)
OFFERED = f"""WITH {S.LINES}, l AS (SELECT doc_id % 20 AS slug, lang, seg, {S.trim("text")} AS text FROM segments), en AS (SELECT DISTINCT slug, text FROM l WHERE lang = 'en' AND {LINE_RULE}),
  v AS (SELECT * FROM l WHERE lang <> 'en' AND {LINE_RULE}), b AS (SELECT slug, string_agg({S.strip("text")}, '  ') AS units FROM l WHERE lang = 'en' AND seg % 2 = 0 GROUP BY slug),
  o AS (SELECT v.slug, v.lang, v.text, en.text IS NOT NULL AS same, coalesce(contains(b.units, v.text), false) AS inside FROM v LEFT JOIN en USING (slug, text) LEFT JOIN b USING (slug))"""


def lines_offered(spark, sf):
    """Lines as visible strings, of which every second one was extracted; ids modulo 20 are pages."""
    rows = lines.segments(table(spark, sf, "documents")).select((F.col("doc_id") % 20).alias("slug"), "lang", "seg", T.trim_ws(F.col("text")).alias("text"))
    source = rows.filter("lang = 'en'")
    return source.select("slug", "text"), rows.filter("lang != 'en'").select("slug", "lang", "text"), source.filter("seg % 2 = 0").select("slug", "text")


@query("never_offered", f"{OFFERED} SELECT DISTINCT slug, lang, text FROM o WHERE same AND NOT inside")
def never_offered(spark, sf):
    from ..operators import gates

    return gates.never_offered(*lines_offered(spark, sf)).select("slug", "lang", "text")


@query("hole_rate", f"{OFFERED} SELECT lang, count(*) FILTER (same AND NOT inside) AS holes, count(*) FILTER (same AND inside) AS kept, count(*) AS total, round(100.0 * count(*) FILTER (same AND NOT inside) / count(*), 6) AS percent FROM o GROUP BY lang")
def hole_rate(spark, sf):
    from ..operators import gates

    return gates.hole_rate(*lines_offered(spark, sf)).select("lang", "holes", "kept", "total", "percent")
