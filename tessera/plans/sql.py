"""Fragments of DuckDB SQL that the counterparts of the queries share."""

from ..functions import constants as K
from ..functions import text as T


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def names(values) -> str:
    return ", ".join(lit(v) for v in values)


def array(values) -> str:
    return "[" + names(values) + "]"


LINES = """segments AS (
  SELECT doc_id, lang, source, CAST(i - 1 AS INTEGER) AS seg, p[i] AS text
  FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS p FROM documents), UNNEST(range(1, len(p) + 1)) AS u(i))"""

PAIRS = """pairs AS (
  SELECT a.conv_id, a.turn, a.text AS src, b.text AS dst
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""

PAGES = """site AS (
  SELECT page_id, url, html, path, regexp_extract(path, '^([^/]+)', 1) AS lang,
         CASE WHEN bare = '' THEN 'index' ELSE bare END AS slug
  FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '^[^/]+/?', ''), '/?index\\.html$', ''), '\\.html$', ''), '/$', '') AS bare
        FROM (SELECT *, regexp_replace(regexp_replace(url, '^https?://[^/]+/', ''), '[?#].*$', '') AS path FROM pages)))"""


def trim(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{T.WS}+|{T.WS}+$')}, '', 'g')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(T.TAG)}, ' ', 'g')"


def translatable(x: str, least: int = 2, tags: bool = True, english: bool = True) -> str:
    out = f"(length({x}) >= {least} AND regexp_matches({x}, '\\p{{L}}') AND NOT regexp_matches({x}, {lit(T.ONLY_NUM)}) AND NOT regexp_matches({x}, {lit(T.URLISH)}) AND NOT regexp_matches({x}, {lit(T.EMAIL)}) AND NOT regexp_matches({x}, {lit(T.CODE)}) AND {x} NOT IN ({names([*K.TECH_TOKENS, *(['English'] if english else [])])}) AND regexp_extract({x}, '^(.+?) \\(.+\\)$', 1) <> 'English'"
    return out + (f" AND NOT regexp_matches({x}, {lit(T.ONLY_TAGS)}))" if tags else ")")


UNITS = f"""trimmed AS (SELECT doc_id, lang, source, seg, {trim("text")} AS text FROM segments),
units AS (SELECT *, left(sha1(text), 16) AS hash FROM trimmed WHERE {translatable("text")})"""


def multiset(x: str) -> str:
    return f"array_to_string(list_sort(regexp_extract_all({x}, {lit(T.TAG)})), '')"


def words(x: str, least: int) -> str:
    return f"list_filter(regexp_extract_all(lower({strip(x)}), '\\p{{L}}{{{least},}}'), lambda w: NOT list_contains({array(K.BRAND_TOKENS)}, w))"


def content_words(x: str) -> str:
    return f"CAST(len({words(x, 3)}) AS INTEGER)"


def word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(T.NOT_WS + '+')}))"


def overlap(a: str, b: str) -> str:
    x, y = words(a, 4), words(b, 4)
    return f"CASE WHEN len({x}) = 0 THEN 0.0 ELSE CAST(len(list_filter({x}, lambda v: list_contains({y}, v))) AS DOUBLE) / len({x}) END"


def latin_ratio(x: str) -> str:
    kept = f"array_to_string(list_filter(string_split_regex({strip(x)}, {lit(T.WS + '+')}), lambda w: NOT list_contains({array(K.BRAND_TOKENS)}, regexp_replace(lower(w), '[^\\p{{L}}]', '', 'g'))), ' ')"
    letters = f"len(regexp_extract_all({kept}, '\\p{{L}}'))"
    return f"CASE WHEN {letters} = 0 THEN 0.0 ELSE CAST(len(regexp_extract_all({kept}, '[A-Za-z]')) AS DOUBLE) / {letters} END"


def numerals(x: str) -> str:
    bare = f"list_transform(regexp_extract_all({x}, {lit(T.NUMERAL)}), lambda n: regexp_replace(regexp_replace(n, {lit(T.SEPARATORS)}, '', 'g'), '^0+([0-9])', '\\1'))"
    return f"array_to_string(list_sort(list_filter({bare}, lambda n: n <> '')), ',')"


def repeats(x: str) -> str:
    w = "regexp_extract_all(s, '\\p{L}{4,}')"
    pairs = f"list_filter(list_transform(range(1, len({w})), lambda i: CASE WHEN {w}[i] = {w}[i + 1] AND NOT list_contains({array(K.DOUBLES)}, {w}[i]) THEN {w}[i] END), lambda v: v IS NOT NULL)"
    return f"list_sort(list_distinct(flatten(list_transform(string_split_regex(lower({strip(x)}), {lit(T.SENTENCE)}), lambda s: {pairs}))))"


def length_ratio(a: str, b: str) -> str:
    size = lambda x: f"length({trim(strip(x))})"
    return f"CAST({size(b)} AS DOUBLE) / greatest({size(a)}, 1)"


def term(x: str, t: str) -> str:
    """Whole-word occurrence without look-around, for existence only."""
    return f"regexp_matches({x}, '(^|[^\\p{{L}}\\p{{N}}_])' || regexp_escape({t}) || '($|[^\\p{{L}}\\p{{N}}_])')"


ATTR = '([A-Za-z0-9_:-]+)="([^"]*)"'
