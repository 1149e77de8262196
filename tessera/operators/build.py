"""Building localized pages: splicing, rewriting identity, links."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import text as T
from ..workers import ship

ship(__name__)


def overlaps(segments: DataFrame) -> DataFrame:
    """Segments that reach into the next one of their page; there must be none before splicing."""
    later = F.lag("start").over(Window.partitionBy("page").orderBy(F.desc("start"), F.desc("stop"), "seg"))
    return segments.withColumn("later", later).filter(F.col("stop") > F.col("later"))


def splice(pages: DataFrame, replacements: DataFrame) -> DataFrame:
    """Pages with [start, stop) of each replacement exchanged for its text.

    One page's replacements, ordered by start, are folded with the kept gaps between them;
    a page is one group, so groups are bounded by a page's length.
    """
    parts = replacements.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "text"))).alias("parts"))
    fold = F.expr("""aggregate(coalesce(parts, array()), named_struct('at', 0, 'out', cast(array() as array<string>)),
        (a, p) -> named_struct('at', cast(p.stop as int), 'out', concat(a.out, array(substring(html, a.at + 1, cast(p.start as int) - a.at), p.text))),
        a -> concat(array_join(a.out, ''), substring(html, a.at + 1)))""")
    return pages.join(parts, "page", "left").withColumn("html", F.when(F.col("parts").isNull(), F.col("html")).otherwise(fold)).drop("parts")


def rewrite_root(html: Column, lang: Column, rtl: list[str]) -> Column:
    """Set lang, and dir where present, of the first <html> tag; absent attributes stay absent."""
    head = F.regexp_extract(html, r"(?s)^(.*?)<html[^>]*>", 1)
    tag = F.regexp_extract(html, r"<html[^>]*>", 0)
    direction = F.when(lang.isin(*rtl), "rtl").otherwise("ltr")
    new = F.regexp_replace(tag, F.lit(r'(\s)lang="[^"]*"'), F.concat(F.lit('$1lang="'), lang, F.lit('"')))
    new = F.regexp_replace(new, F.lit(r'(\s)dir="[^"]*"'), F.concat(F.lit('$1dir="'), direction, F.lit('"')))
    return F.when(tag == "", html).otherwise(F.concat(head, new, F.substring(html, F.length(head) + F.length(tag) + 1, F.length(html))))


# First segments and endings of paths that are no pages.
ASSETS = "_astro|assets|images|fonts|favicon|robots|sitemap"
FILES = "xml|txt|ico|png|jpe?g|webp|svg|css|js|json|pdf"
LINK = r'(<a\b[^>]*?\shref=")/(?!(?:' + ASSETS + r'))(?![^"#?]*\.(?i:' + FILES + r')["#?])([^"#?]+)(["#?])'
HOME = r'(<a\b[^>]*?\shref=")/(["#?])'


def prefix_links(html: Column, lang: Column) -> Column:
    """Put root-relative links of <a> under the language; assets and files stay; the root gets no slash."""
    # Links first, the root after them, so that neither is prefixed twice.
    linked = F.regexp_replace(html, F.lit(LINK), F.concat(F.lit("$1/"), lang, F.lit("/$2$3")))
    return F.regexp_replace(linked, F.lit(HOME), F.concat(F.lit("$1/"), lang, F.lit("$2")))


# What marks the language picker's label and its options.
PICKER_LABEL, PICKER_OPTION = "data-i18n-current-lang", "data-i18n-lang"


def picker(html: Column, hreflang: Column, label: Column) -> tuple[Column, Column]:
    """Write a language's name into every picker label and mark its option as current; also the rules that had a marker and no effect."""
    safe = F.regexp_replace(F.coalesce(label, hreflang), r"([\\$])", r"\\$1")
    named = F.regexp_replace(html, F.lit(rf"(<span[^>]*\s{PICKER_LABEL}[^>]*>)[^<]*(</span>)"), F.concat(F.lit("$1"), safe, F.lit("$2")))
    option = F.concat(F.lit(rf'(<a\b[^>]*\s{PICKER_OPTION}="\Q'), hreflang, F.lit('\\E")'))
    marked = F.regexp_replace(named, option, F.lit('$1 aria-current="true"'))
    misses = F.array(
        F.when(F.contains(html, F.lit(PICKER_LABEL)) & ~html.rlike(rf"<span[^>]*\s{PICKER_LABEL}[^>]*>[^<]*</span>"), "picker-label"),
        F.when(F.contains(html, F.lit(f"{PICKER_OPTION}=")) & (marked == named), "picker-current"),
    )
    return marked, misses


_block = re.compile(r'(<script type="application/ld\+json">)(.*?)(</script>)', re.S)
_page_types = frozenset(K.PAGE_TYPES)


def relocate(html: str | None, lang: str, own: str, root: str) -> str | None:
    """JSON-LD blocks of a page with its language and addresses: nodes' inLanguage, ids that end in #webpage, urls by type.

    A page's node gets the page's address, the site's node the locale's root, others keep theirs.
    Blocks are written without spaces; what is no JSON stays as it is.
    """

    def rewritten(m: re.Match) -> str:
        try:
            data = json.loads(m[2])
        except (ValueError, RecursionError):
            return m[0]
        todo = [data]
        while todo:
            node = todo.pop()
            if isinstance(node, dict):
                if isinstance(node.get("inLanguage"), str):
                    node["inLanguage"] = lang
                if isinstance(node.get("@id"), str) and node["@id"].endswith("#webpage"):
                    node["@id"] = f"{own}#webpage"
                kinds = node.get("@type")
                kinds = set(k for k in kinds if isinstance(k, str)) if isinstance(kinds, list) else {kinds} if isinstance(kinds, str) else set()
                if isinstance(node.get("url"), str) and ("WebSite" in kinds or kinds & _page_types):
                    node["url"] = root if "WebSite" in kinds else own
                todo += node.values()
            elif isinstance(node, list):
                todo += node
        return m[1] + json.dumps(data, ensure_ascii=False, separators=(",", ":")) + m[3]

    return html if html is None or "ld+json" not in html else _block.sub(rewritten, html)


def jsonld_identity(html: Column, lang: Column, own: Column, root: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series, langs: pd.Series, owns: pd.Series, roots: pd.Series) -> pd.Series:
        return pd.Series([relocate(*row) for row in zip(pages, langs, owns, roots, strict=True)], dtype=object)

    return run(html, lang, own, root)


def set_attribute(html: Column, tag: str, test: str, attribute: str, value: Column) -> tuple[Column, Column]:
    """Rewrite an attribute of every tag whose text matches ``test``; also whether any tag matched."""
    pattern = rf"(<{tag}(?=[^>]*{test})[^>]*?\s{attribute}=\")[^\"]*(\")"
    matched = html.rlike(rf"<{tag}(?=[^>]*{test})[^>]*>")
    safe = F.regexp_replace(value, r"([\\$])", r"\\$1")
    return F.regexp_replace(html, F.lit(pattern), F.concat(F.lit("$1"), safe, F.lit("$2"))), matched


def localize(pages: DataFrame, base: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Rewrite canonical, alternates, social tags, the language picker and JSON-LD of pages (lang, slug, html).

    ``misses`` lists rules without a match; ``labels`` are the languages' own names.
    """
    slug = F.when(F.col("slug") == "index", "").otherwise(F.col("slug"))
    own, source = T.page_url(base, F.col("lang"), slug), T.page_url(base, F.lit(None), slug)
    rules = [
        ("canonical", "link", 'rel="canonical"', "href", own),
        ("x-default", "link", 'hreflang="x-default"', "href", source),
        ("en", "link", 'hreflang="en"', "href", source),
        ("og:url", "meta", 'property="og:url"', "content", own),
        ("og:locale", "meta", 'property="og:locale"', "content", F.col("lang")),
    ]
    out, misses = pages, []
    for name, tag, test, attribute, value in rules:
        html, matched = set_attribute(F.col("html"), tag, test, attribute, value)
        out = out.withColumn(f"__hit_{name}", matched).withColumn("html", html)
        misses.append(F.when(~F.col(f"`__hit_{name}`"), name))
    names = F.create_map(*[F.lit(x) for pair in (labels or {}).items() for x in pair]) if labels else F.lit(None).cast("map<string,string>")
    html, more = picker(F.col("html"), F.col("lang"), F.try_element_at(names, F.col("lang")))
    out = out.withColumn("__more", more).withColumn("html", html)
    out = out.withColumn("html", jsonld_identity(F.col("html"), F.col("lang"), own, F.concat(F.lit(f"{base}/"), F.col("lang"))))
    out = out.withColumn("misses", F.filter(F.concat(F.array(*misses), "__more"), lambda m: m.isNotNull())).drop("__more")
    return out.drop(*[f"__hit_{r[0]}" for r in rules])


def render_block(text: Column, tags: Column) -> Column:
    """A block's inner HTML from its text with numbered tags and the table of (open, close); unknown numbers vanish."""
    marks = T.all_matches(text, "<(?:/?)[0-9]+(?:/?)>")
    gaps = F.transform(F.split(text, "</?[0-9]+/?>", -1), lambda g: T.escape_html(g))

    def of(mark: Column) -> Column:
        pair = F.get(tags, F.regexp_extract(mark, "[0-9]+", 0).cast("int"))
        return F.coalesce(F.when(mark.startswith("</") & ~mark.endswith("/>"), pair["close"]).otherwise(pair["open"]), F.lit(""))

    return F.concat(F.get(gaps, F.lit(0)), F.array_join(F.zip_with(F.transform(marks, of), F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))), lambda m, g: F.concat(m, g)), ""))
