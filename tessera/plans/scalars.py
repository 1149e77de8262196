"""Queries of scalar functions over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..operators import lines
from ..session import table
from . import sql as S
from .catalog import query

DOCS = "SELECT doc_id, {} FROM documents"


def docs(spark, sf):
    return table(spark, sf, "documents")


def segs(spark, sf):
    return lines.segments(docs(spark, sf))


def talks(spark, sf):
    return lines.pairs(table(spark, sf, "conversations"))


@query("unit_hash", f"WITH {S.LINES} SELECT doc_id, seg, left(sha1({S.trim('text')}), 16) AS hash FROM segments")
def unit_hash(spark, sf):
    return segs(spark, sf).select("doc_id", "seg", T.content_hash(T.trim_ws(F.col("text"))).alias("hash"))


@query("translatable_filter", f"WITH {S.LINES}, {S.UNITS} SELECT doc_id, seg, hash FROM units")
def translatable_filter(spark, sf):
    return lines.units_of(segs(spark, sf)).select("doc_id", "seg", "hash")


@query("visible_translatable", f"WITH {S.LINES}, t AS (SELECT doc_id, seg, {S.trim('text')} AS text FROM segments) SELECT doc_id, seg FROM t WHERE {S.translatable('text', 3, False, False)}")
def visible_translatable(spark, sf):
    trimmed = segs(spark, sf).withColumn("text", T.trim_ws(F.col("text")))
    return trimmed.filter(T.translatable(F.col("text"), least=3, tags=False, english=False)).select("doc_id", "seg")


TAGGED = "regexp_replace(text, '([A-Za-z]+)([0-9])', '<\\2>\\1</\\2>', 'g')"


@query("placeholder_multiset", f"WITH t AS (SELECT doc_id, {TAGGED} AS text FROM documents) SELECT doc_id, {S.multiset('text')} AS tags FROM t")
def placeholder_multiset(spark, sf):
    tagged = F.regexp_replace("text", "([A-Za-z]+)([0-9])", "<$2>$1</$2>")
    return docs(spark, sf).select("doc_id", T.placeholders(tagged).alias("tags"))


@query("strip_placeholders", f"WITH t AS (SELECT doc_id, {TAGGED} AS text FROM documents) SELECT doc_id, md5({S.strip('text')}) AS stripped FROM t")
def strip_placeholders(spark, sf):
    tagged = F.regexp_replace("text", "([A-Za-z]+)([0-9])", "<$2>$1</$2>")
    return docs(spark, sf).select("doc_id", F.md5(T.strip_placeholders(tagged)).alias("stripped"))


@query("validate_unit", f"""WITH {S.PAIRS} SELECT conv_id, turn, CASE WHEN coalesce({S.trim('dst')}, '') = '' THEN 'empty'
    WHEN {S.multiset('src')} <> {S.multiset('dst')} THEN 'placeholder-mismatch' END AS problem FROM pairs""")  # fmt: skip
def validate_unit(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", T.problem(F.col("src"), F.col("dst")).alias("problem"))


@query("word_count", DOCS.format(f"CAST({S.word_count('text')} AS INTEGER) AS words"))
def word_count(spark, sf):
    return docs(spark, sf).select("doc_id", T.word_count(F.col("text")).alias("words"))


@query("content_words", DOCS.format(f"{S.content_words('text')} AS words"))
def content_words(spark, sf):
    return docs(spark, sf).select("doc_id", T.content_words(F.col("text")).alias("words"))


@query("overlap_ratio", f"WITH {S.PAIRS} SELECT conv_id, turn, round({S.overlap('src', 'dst')}, 6) AS share FROM pairs")
def overlap_ratio(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", F.round(T.overlap(F.col("src"), F.col("dst")), 6).alias("share"))


@query("latin_ratio", DOCS.format(f"round({S.latin_ratio('text')}, 6) AS share"))
def latin_ratio(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(T.latin_ratio(F.col("text")), 6).alias("share"))


@query("tautology", f"""WITH {S.PAIRS}, r AS (SELECT conv_id, turn, {S.repeats('src')} AS a, {S.repeats('dst')} AS b FROM pairs)
    SELECT conv_id, turn, array_to_string(list_sort(list_filter(b, lambda w: NOT list_contains(a, w))), ',') AS words FROM r""")  # fmt: skip
def tautology(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", F.array_join(F.array_sort(T.tautologies(F.col("src"), F.col("dst"))), ",").alias("words"))


@query("length_ratio", f"WITH {S.PAIRS} SELECT conv_id, turn, round({S.length_ratio('src', 'dst')}, 6) AS ratio FROM pairs")
def length_ratio(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", F.round(T.length_ratio(F.col("src"), F.col("dst")), 6).alias("ratio"))


@query("contains_term", f"WITH {S.LINES} SELECT doc_id, seg, {S.term('text', chr(39) + 'The' + chr(39))} AS exact_case, {S.term('lower(text)', chr(39) + 'the' + chr(39))} AS any_case FROM segments")
def contains_term(spark, sf):
    t = F.col("text")
    return segs(spark, sf).select("doc_id", "seg", T.contains_term(t, "The").alias("exact_case"), T.contains_term(t, "The", False).alias("any_case"))


@query("numeral_multiset", DOCS.format(f"{S.numerals('text')} AS numerals"))
def numeral_multiset(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(T.numerals(F.col("text")), ",").alias("numerals"))


ESC = "replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query("escape_html", f"SELECT page_id, md5({ESC}) AS body, md5(replace({ESC}, '\"', '&quot;')) AS attribute FROM pages")
def escape_html(spark, sf):
    h = F.col("html")
    return table(spark, sf, "pages").select("page_id", F.md5(T.escape_html(h)).alias("body"), F.md5(T.escape_html(h, True)).alias("attribute"))


@query("escape_json", "SELECT page_id, md5(replace(replace(replace(html, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')) AS body FROM pages")
def escape_json(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(T.escape_json(F.col("html"))).alias("body"))


@query("entity_decode", "SELECT page_id, md5(replace(replace(replace(replace(replace(replace(html, '&quot;', '\"'), '&apos;', ''''), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS decoded FROM pages")
def entity_decode(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(T.decode_entities(F.col("html"))).alias("decoded"))


@query("tag_attr_map", f"""WITH t AS (SELECT page_id, regexp_extract_all(html, '<a[^>]*>') AS tags FROM pages), u AS (SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, tags[i] AS tag FROM t, UNNEST(range(1, len(tags) + 1)) AS x(i))
    SELECT page_id, pos, array_to_string(list_sort(list_transform(regexp_extract_all(tag, {S.lit(S.ATTR)}), lambda p: regexp_replace(p, {S.lit(S.ATTR)}, '\\1=\\2'))), ';') AS attributes FROM u""")  # fmt: skip
def tag_attr_map(spark, sf):
    tags = table(spark, sf, "pages").select("page_id", F.posexplode(T.tags(F.col("html"), "a")).alias("pos", "tag"))
    entries = F.transform(F.map_entries(T.tag_attributes(F.col("tag"))), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return tags.select("page_id", "pos", F.array_join(F.array_sort(entries), ";").alias("attributes"))


@query("first_tag", """SELECT page_id, list_filter(regexp_extract_all(html, '<meta[^>]*>'), lambda t: regexp_matches(t, 'charset="utf-8"'))[1] IS NOT NULL AS charset,
    list_filter(regexp_extract_all(html, '<link[^>]*>'), lambda t: regexp_matches(t, 'rel="canonical"'))[1] IS NOT NULL AS canonical FROM pages""")  # fmt: skip
def first_tag(spark, sf):
    h = F.col("html")
    return table(spark, sf, "pages").select("page_id", T.first_tag(h, "meta", "charset", "utf-8").isNotNull().alias("charset"), T.first_tag(h, "link", "rel", "canonical").isNotNull().alias("canonical"))


@query("page_url", f"WITH {S.PAGES} SELECT page_id, CASE WHEN lang = '' AND slug = 'index' THEN 'https://site.example/' WHEN lang = '' THEN 'https://site.example/' || slug WHEN slug = 'index' THEN 'https://site.example/' || lang ELSE 'https://site.example/' || lang || '/' || slug END AS target FROM site")
def page_url(spark, sf):
    rows = lines.page_rows(table(spark, sf, "pages"))
    slug = F.when(F.col("slug") == "index", "").otherwise(F.col("slug"))
    return rows.select("page_id", T.page_url("https://site.example", F.col("lang"), slug).alias("target"))


KINDS = "['block', 'text', 'jsonld', 'attr:alt', 'attr:title', 'attr:content']"
ELS = "['h1', 'p', 'button', 'meta:description', 'meta:og:title', 'meta:other', 'th', 'option']"


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {S.lit(k)} THEN {S.lit(v)}" for k, v in values.items()) + " END"


@query("role_of", f"""WITH u AS (SELECT event_id, {KINDS}[event_id % 6 + 1] AS kind, CASE WHEN event_id % 9 = 8 THEN NULL ELSE {ELS}[event_id % 9 + 1] END AS el FROM events)
    SELECT event_id, CASE WHEN el IS NULL THEN CASE WHEN kind = 'jsonld' THEN 'structured data' END WHEN starts_with(el, 'meta:') THEN coalesce({_case("substr(el, 6)", K.META_ROLES)}, 'page metadata')
    WHEN starts_with(kind, 'attr:') THEN {_case("kind", K.ATTR_ROLES)} WHEN kind = 'jsonld' THEN 'structured data' ELSE {_case("el", K.BLOCK_ROLES)} END AS role FROM u""")  # fmt: skip
def role_of(spark, sf):
    kinds = "array('block', 'text', 'jsonld', 'attr:alt', 'attr:title', 'attr:content')"
    els = "array('h1', 'p', 'button', 'meta:description', 'meta:og:title', 'meta:other', 'th', 'option')"
    rows = table(spark, sf, "events").selectExpr("event_id", f"{kinds}[event_id % 6] AS kind", f"get({els}, cast(event_id % 9 as int)) AS el")
    return rows.select("event_id", T.role_of(F.col("kind"), F.col("el")).alias("role"))


REPLIES = "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN 'Sure: ' || props WHEN 2 THEN '```json' || chr(10) || props || chr(10) || '```' ELSE ' [' || props || '] ' END"


@query("extract_json", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '[' || props || ']' ELSE props END AS body FROM events")
def extract_json(spark, sf):
    return table(spark, sf, "events").select("event_id", T.extract_json(F.expr(REPLIES.replace("chr(10)", "char(10)"))).alias("body"))


@query("parse_errors", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE NULL END AS errors,
    CASE event_id % 5 WHEN 2 THEN 'major' WHEN 3 THEN 'minor' END AS first_severity FROM events""")  # fmt: skip
def parse_errors(spark, sf):
    made = F.expr("""CASE event_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN props WHEN 2 THEN '[{"c": "style/tone", "s": "Major", "n": "x"}, {"s": "huge"}]'
        WHEN 3 THEN '[{"category": "style/tone", "severity": "minor"}]' ELSE '[broken' END""")
    rows = table(spark, sf, "events").select("event_id", T.parse_errors(made).alias("e"))
    return rows.select("event_id", F.when(F.col("e").isNotNull(), F.size("e")).alias("errors"), F.get("e", F.lit(0))["severity"].alias("first_severity"))


MODELS = "['gemini-2', 'models/gemini-x', 'Claude-a', 'gpt-9', 'o1-mini', 'chatgpt', 'mistral', 'geminix']"


@query("infer_provider", f"SELECT event_id, CASE WHEN event_id % 8 IN (0, 1, 7) THEN 'gemini' WHEN event_id % 8 = 2 THEN 'anthropic' WHEN event_id % 8 IN (3, 4, 5) THEN 'openai' END AS provider FROM events")
def infer_provider(spark, sf):
    named = F.expr("array" + MODELS.replace("[", "(").replace("]", ")") + "[event_id % 8]")
    return table(spark, sf, "events").select("event_id", T.infer_provider(named).alias("provider"))


@query("truncated_preview", DOCS.format("left(text, 160) AS preview"))
def truncated_preview(spark, sf):
    return docs(spark, sf).select("doc_id", F.substring("text", 1, 160).alias("preview"))


@query("switcher_label", f"WITH {S.LINES}, t AS (SELECT doc_id, seg, 'English (' || left(text, 5) || ')' AS a, left(text, 5) || ' (English)' AS b FROM segments WHERE length(text) > 5) SELECT doc_id, seg, regexp_extract(a, '^(.+?) \\(.+\\)$', 1) = 'English' AS switcher, regexp_extract(b, '^(.+?) \\(.+\\)$', 1) = 'English' AS other FROM t")
def switcher_label(spark, sf):
    rows = segs(spark, sf).filter(F.length("text") > 5)
    native = lambda c: F.regexp_extract(c, r"^(.+?) \(.+\)$", 1) == "English"
    return rows.select("doc_id", "seg", native(F.concat(F.lit("English ("), F.left("text", F.lit(5)), F.lit(")"))).alias("switcher"), native(F.concat(F.left("text", F.lit(5)), F.lit(" (English)"))).alias("other"))


@query("parse_written_number", """WITH n AS (SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS a, CAST(o_custkey AS VARCHAR) AS b, '1.2.' || o_orderkey AS c FROM orders)
    SELECT o_orderkey, round(CAST(replace(a, ',', '') AS DOUBLE), 2) AS grouped_value, CASE WHEN contains(a, ',') THEN 2 ELSE 2 END AS decimals, CAST(b AS DOUBLE) AS plain_value, contains(a, ',') AS is_grouped, CAST(NULL AS DOUBLE) AS version FROM n""")  # fmt: skip
def parse_written_number(spark, sf):
    a, b, c = (T.parse_written(x) for x in (F.format_number("o_totalprice", 2), F.col("o_custkey").cast("string"), F.concat(F.lit("1.2."), F.col("o_orderkey").cast("string"))))
    rows = table(spark, sf, "orders").select("o_orderkey", a.alias("a"), b.alias("b"), c.alias("c"))
    return rows.select("o_orderkey", F.round("a.value", 2).alias("grouped_value"), F.col("a.decimals").alias("decimals"), F.col("b.value").alias("plain_value"), F.col("a.grouped").alias("is_grouped"), F.col("c.value").alias("version"))


TWO32 = "4294967296"


@query("mulberry32", f"""WITH s AS (SELECT event_id, (42::HUGEINT + (event_id + 1)::HUGEINT * 1831565813) % {TWO32} AS a FROM events),
    t AS (SELECT event_id, CAST(((CAST(xor(CAST(a AS BIGINT), CAST(a AS BIGINT) >> 15) AS HUGEINT) * (CAST(a AS BIGINT) | 1)) % {TWO32}) AS BIGINT) AS t FROM s),
    v AS (SELECT event_id, xor(t, CAST((t + (CAST(xor(t, t >> 7) AS HUGEINT) * (t | 61)) % {TWO32}) % {TWO32} AS BIGINT)) AS t FROM t)
    SELECT event_id, xor(t, t >> 14) / 4294967296.0::DOUBLE AS draw FROM v""")  # fmt: skip
def mulberry32(spark, sf):
    return table(spark, sf, "events").select("event_id", T.mulberry32(42, F.col("event_id") + 1).alias("draw"))


@query("backoff_schedule", "SELECT CAST(i AS BIGINT) AS attempt, CAST(least(pow(2, i) * 1000, 30000) AS BIGINT) AS wait_ms FROM range(1, 6) AS r(i)")
def backoff_schedule(spark, sf):
    from ..operators.translate import backoff_ms

    return spark.range(1, K.RETRIES + 1).select(F.col("id").alias("attempt"), backoff_ms(F.col("id")).alias("wait_ms"))
