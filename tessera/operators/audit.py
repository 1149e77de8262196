"""Search-engine audit of every page: one wide projection, then one row per finding."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..workers import ship

ship(__name__)

JSONLD = r'(?s)<script type="application/ld\+json">(.*?)</script>'


def finding(check: str, when: Column, detail: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(check).alias("check"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail")))


def page_findings(pages: DataFrame, base: str, locales: list[str], source: str = "en") -> DataFrame:
    """(page, check, detail) of pages with columns page, lang, slug and html.

    ``locales`` are the translated languages; ``source`` is the language of the originals.
    """
    html = F.col("html")
    lang, slug = F.col("lang"), F.when(F.col("slug") == "index", "").otherwise(F.col("slug"))
    local = F.when(lang == source, F.lit(None)).otherwise(lang)
    attrs = lambda name: F.transform(T.tags(html, name), T.tag_attributes)
    first = lambda name, key, value: F.get(F.filter(F.col(name), lambda a: a[key] == value), F.lit(0))
    wide = pages.select(
        "page", "lang", "html", slug.alias("slug"), T.page_url(base, local, slug).alias("own"), T.page_url(base, F.lit(None), slug).alias("original"),
        attrs("link").alias("links"), attrs("meta").alias("metas"), F.regexp_extract(html, "<html[^>]*>", 0).alias("root"),
    )
    wide = wide.withColumn("alts", F.filter("links", lambda a: (a["rel"] == "alternate") & (F.coalesce(a["hreflang"], F.lit("")) != "")))
    wide = wide.withColumn("codes", F.transform("alts", lambda a: a["hreflang"])).withColumn("canonical", first("links", "rel", "canonical"))
    wide = wide.withColumn("og_url", first("metas", "property", "og:url")["content"]).withColumn("og_locale", first("metas", "property", "og:locale")["content"])
    wide = wide.withColumn("robots", first("metas", "name", "robots")["content"]).withColumn("root_lang", F.nullif(F.regexp_extract("root", r'\slang="([^"]*)"', 1), F.lit("")))
    expected = F.array(*[F.lit(c) for c in [*locales, source, "x-default"]])
    size = len(locales) + 2
    home = F.lit(f"{base}/")
    # The last alternate of a code counts, as in a map.
    href = lambda code: F.try_element_at(F.transform(F.filter("alts", lambda a: a["hreflang"] == code), lambda a: a["href"]), F.lit(-1))
    canon, own, original = F.col("canonical")["href"], F.col("own"), F.col("original")
    has = F.col("canonical").isNotNull()
    mine = href(F.col("lang"))
    listed = F.array_contains("codes", F.col("lang"))
    duplicates = F.array_distinct(F.filter("codes", lambda c: F.size(F.filter("codes", lambda d: d == c)) > 1))
    single = [
        finding("canonical-missing", ~has, F.lit("no rel=canonical")),
        finding("canonical-wrong", has & ~canon.eqNullSafe(own), canon),
        finding("canonical-protocol", has & ~F.coalesce(canon.startswith("https://"), F.lit(False)), canon),
        finding("canonical-trailing-slash", has & (canon != home) & canon.endswith("/"), canon),
        finding("hreflang-count", F.size("codes") != size, F.concat(F.size("codes").cast("string"), F.lit(f" of {size}"))),
        finding("hreflang-duplicate", F.size(duplicates) > 0, F.array_join(duplicates, ",")),
        finding("hreflang-self-missing", ~listed, F.col("lang")),
        finding("hreflang-self-wrong", listed & ~mine.eqNullSafe(own), mine),
        finding("hreflang-canonical-mismatch", listed & mine.eqNullSafe(own) & has & ~mine.eqNullSafe(canon), canon),
        finding("hreflang-en-wrong", ~href(F.lit("en")).eqNullSafe(original), href(F.lit("en"))),
        finding("hreflang-xdefault-wrong", ~href(F.lit("x-default")).eqNullSafe(original), href(F.lit("x-default"))),
        finding("og-url-wrong", F.col("og_url").isNotNull() & (F.col("og_url") != own), F.col("og_url")),
        finding("og-locale-wrong", F.col("og_locale").isNotNull() & (F.col("og_locale") != F.col("lang")), F.col("og_locale")),
        finding("noindex", F.lower("robots").contains("noindex"), F.col("robots")),
        finding("html-lang-wrong", ~F.col("root_lang").eqNullSafe(F.col("lang")), F.col("root_lang")),
    ]
    per_code = [
        F.transform(F.array_except("codes", expected), lambda c: F.struct(F.lit("hreflang-unexpected-code").alias("check"), c.alias("detail"))),
        F.transform(F.array_except(expected, F.col("codes")), lambda c: F.struct(F.lit("hreflang-missing-code").alias("check"), c.alias("detail"))),
        F.transform(F.filter("alts", lambda a: ~F.coalesce(a["href"].startswith("https://"), F.lit(False))), lambda a: F.struct(F.lit("hreflang-protocol").alias("check"), F.concat(a["hreflang"], F.lit("="), F.coalesce(a["href"], F.lit(""))).alias("detail"))),
        F.transform(F.filter("alts", lambda a: F.coalesce((a["href"] != home) & a["href"].endswith("/"), F.lit(False))), lambda a: F.struct(F.lit("hreflang-trailing-slash").alias("check"), F.concat(a["hreflang"], F.lit("="), a["href"]).alias("detail"))),
    ]
    for code in locales:
        want = T.page_url(base, F.lit(code), F.col("slug"))
        single.append(finding("hreflang-target-wrong", href(F.lit(code)).isNotNull() & (href(F.lit(code)) != want), F.concat(F.lit(f"{code}="), href(F.lit(code)))))
    blocks = F.regexp_extract_all("html", F.lit(JSONLD), F.lit(1))
    broken = F.transform(F.filter(blocks, lambda b: F.try_parse_json(b).isNull()), lambda b: F.struct(F.lit("jsonld-invalid").alias("check"), F.left(b, F.lit(60)).alias("detail")))
    every = F.concat(F.filter(F.array(*single), lambda x: x.isNotNull()), *per_code, broken)
    return wide.select("page", F.explode(every).alias("f")).select("page", "f.check", "f.detail")


def jsonld_nodes(block: Column) -> Column:
    """Every object in a JSON-LD block at any depth, as JSON of the keys that are audited."""

    @F.pandas_udf("array<string>")
    def run(blocks: pd.Series) -> pd.Series:
        # Numbers stay as written.
        decoder = json.JSONDecoder(parse_int=str, parse_float=str)

        def walk(text: str) -> list[str]:
            found, todo = [], [decoder.raw_decode(text.lstrip(" \t\r\n"))[0]]
            while todo:
                value = todo.pop()
                if isinstance(value, dict):
                    found.append(json.dumps({k: value[k] for k in ("@type", "inLanguage", "url", "@id") if value.get(k) is not None}, separators=(",", ":")))
                    value = list(value.values())
                if isinstance(value, list):
                    todo.extend(v for v in value if isinstance(v, dict | list))
            return found

        return blocks.map(walk)

    return run(block)


def jsonld_findings(pages: DataFrame, base: str, source: str = "en") -> DataFrame:
    """Findings about language, identity and address of JSON-LD nodes, at any depth.

    Blocks that Spark's parser refuses, also for its limits (1,000 levels), are ``jsonld-invalid`` in ``page_findings``.
    """
    slug = F.when(F.col("slug") == "index", "").otherwise(F.col("slug"))
    own = T.page_url(base, F.when(F.col("lang") == source, F.lit(None)).otherwise(F.col("lang")), slug)
    blocks = pages.select("page", "lang", own.alias("own"), F.explode(F.regexp_extract_all("html", F.lit(JSONLD), F.lit(1))).alias("block")).filter(F.try_parse_json("block").isNotNull())
    nodes = blocks.select("page", "lang", "own", F.explode(jsonld_nodes(F.col("block"))).alias("node"))
    get = lambda key: F.get_json_object("node", f"$['{key}']")
    types, language, address, identity = get("@type"), get("inLanguage"), get("url"), get("@id")
    page = F.coalesce(types.rlike(r'(^|")WebPage("|$)'), F.lit(False))
    want = F.concat("own", F.lit("#webpage"))
    found = F.array(
        finding("jsonld-inlanguage", language.isNotNull() & (language != F.col("lang")), language),
        finding("jsonld-webpage-id", page & ~identity.eqNullSafe(want), identity),
        finding("jsonld-webpage-url", page & address.isNotNull() & (address != F.col("own")), address),
    )
    return nodes.select("page", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("page", "f.check", "f.detail")


def sitemap_urls(files: DataFrame) -> DataFrame:
    """(file, url): the <loc> entries of sitemap files (file, xml)."""
    return files.select("file", F.explode(F.regexp_extract_all("xml", F.lit(r"<loc>\s*([^<]*?)\s*</loc>"), F.lit(1))).alias("url"))


def sitemap_findings(files: DataFrame, built: DataFrame, base: str) -> DataFrame:
    """Findings about the sitemap index, its children and their addresses; ``built`` has url."""
    urls = sitemap_urls(files)
    index = urls.filter("file = 'sitemap.xml'").withColumn("child", F.regexp_replace("url", "^.*/", ""))
    have = files.select("file")
    row = lambda df, check, page, detail: df.select(F.col(page).alias("page"), F.lit(check).alias("check"), F.col(detail).alias("detail"))
    absent = have.agg(F.count(F.when(F.col("file") == "sitemap.xml", 1)).alias("n")).filter("n = 0").select(F.lit("sitemap.xml").alias("page"), F.lit("sitemap-index-missing").alias("check"), F.lit("").alias("detail"))
    no_child = row(index.join(have.withColumnRenamed("file", "child"), "child", "left_anti"), "sitemap-child-missing", "child", "url")
    listed = urls.join(index.select(F.col("child").alias("file")).distinct(), "file", "left_semi")
    n_built = built.agg(F.count_distinct("url").alias("n_built"))
    counts = listed.groupBy("file").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(n_built), F.lit(True)).filter("n != n_built")
    wrong_count = counts.select(F.col("file").alias("page"), F.lit("sitemap-url-count").alias("check"), F.concat(F.col("n").cast("string"), F.lit(" of "), F.col("n_built").cast("string")).alias("detail"))
    gone = row(listed.join(built.select("url").distinct(), "url", "left_anti"), "sitemap-url-404", "file", "url")
    slash = row(listed.filter(F.endswith("url", F.lit("/")) & (F.col("url") != f"{base}/")), "sitemap-trailing-slash", "file", "url")
    protocol = row(listed.filter(~F.startswith("url", F.lit("https://"))), "sitemap-protocol", "file", "url")
    out = absent
    for part in (no_child, wrong_count, gone, slash, protocol):
        out = out.unionByName(part)
    return out


def missing_pages(expected: DataFrame, pages: DataFrame) -> DataFrame:
    """Expected (lang, slug) without a page, as findings."""
    gone = expected.join(pages.select("lang", "slug").distinct(), ["lang", "slug"], "left_anti")
    return gone.select(F.concat("lang", F.lit("/"), "slug").alias("page"), F.lit("missing-page").alias("check"), F.lit("no file").alias("detail"))


def by_check(findings: DataFrame) -> DataFrame:
    """Findings per check, most first."""
    return findings.groupBy("check").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "check")
