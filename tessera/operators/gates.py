"""Integrity gates. Each gives its failures, or figures with a verdict, as a DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..session import stored


MOST_LOCALES = 2000


def missing_pages(slugs: DataFrame, locales: DataFrame, built: DataFrame) -> DataFrame:
    """Expected (lang, slug) without a page. Locales are counted, and refused beyond ``MOST_LOCALES``: each is paired with every slug."""
    names = [r[0] for r in locales.select("lang").distinct().limit(MOST_LOCALES + 1).collect()]
    if len(names) > MOST_LOCALES:
        raise ValueError(f"more than {MOST_LOCALES} locales")
    every = F.explode(F.array(*[F.lit(n) for n in names]) if names else F.expr("cast(array() as array<string>)"))
    return slugs.withColumn("lang", every).join(built, ["lang", "slug"], "left_anti").select("lang", "slug")


def coverage(segments: DataFrame, memory: DataFrame) -> DataFrame:
    """Share of segments with a translation per language; under 99 % fails, no segments passes."""
    rows = segments.join(memory.select("lang", "hash", F.lit(1).alias("got")), ["lang", "hash"], "left")
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"), F.count("got").alias("covered"))
    percent = 100 * F.col("covered") / F.col("total")
    return counted.withColumn("percent", F.round(percent, 6)).withColumn("fails", percent < K.COVERAGE_FLOOR)


def numeric_drift(pairs: DataFrame, by: str) -> DataFrame:
    """Pairs, and those whose numbers differ as multisets."""
    drifted = T.numerals(F.col("src")) != T.numerals(F.col("dst"))
    return pairs.groupBy(by).agg(F.count(F.lit(1)).alias("units"), F.count(F.when(drifted, 1)).alias("drifted"))


def placeholder_leaks(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with a numbered tag outside scripts."""
    return pages.filter(F.regexp_replace(html, r"(?s)<script[^>]*>.*?</script>", "").rlike(T.TAG))


def structure(pairs: DataFrame) -> DataFrame:
    """Localized pages whose tag sequence differs from the source's, with the first difference."""
    a, b = F.col("source_tags"), F.col("tags")
    at = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True)
    return pairs.filter(a != b).withColumn("first_difference", at)


def identity(pages: DataFrame, base: str) -> DataFrame:
    """What a localized page gets wrong about itself: language, direction, canonical and alternates."""
    html, lang, slug = F.col("html"), F.col("lang"), F.when(F.col("slug") == "index", "").otherwise(F.col("slug"))
    own, source = T.page_url(base, lang, slug), T.page_url(base, F.lit(None), slug)
    root = F.regexp_extract(html, "<html[^>]*>", 0)
    canonical = T.first_tag(html, "link", "rel", "canonical")["href"]
    alternates = F.filter(F.transform(T.tags(html, "link"), T.tag_attributes), lambda a: (a["rel"] == "alternate") & a["hreflang"].isNotNull())
    href = lambda code: F.element_at(F.transform(F.filter(alternates, lambda a: a["hreflang"] == code), lambda a: a["href"]), -1)
    safe = lambda code: F.when(F.exists(alternates, lambda a: a["hreflang"] == code), href(code))
    blocks = F.regexp_extract_all(html, F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    checks = {
        "lang": ~T.tag_attributes(root)["lang"].eqNullSafe(lang),
        "dir": lang.isin(K.RTL) & ~T.tag_attributes(root)["dir"].eqNullSafe("rtl"),
        "canonical": ~canonical.eqNullSafe(own),
        "canonical-slash": F.coalesce(canonical.endswith("/") & (canonical != f"{base}/"), F.lit(False)),
        "x-default": ~safe(F.lit("x-default")).eqNullSafe(source),
        "en": ~safe(F.lit("en")).eqNullSafe(source),
        "self": ~safe(lang).eqNullSafe(own),
        "jsonld-language": (lang != "en") & F.exists(blocks, lambda b: b.rlike(r'"inLanguage"\s*:\s*"en"')),
        "jsonld-id": (lang != "en") & F.exists(blocks, lambda b: b.rlike(rf'"@id"\s*:\s*"{re.escape(base)}/#webpage"')),
    }
    found = F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), lambda x: x.isNotNull())
    return pages.withColumn("problem", F.explode(found))


#: Lengths of the grams that stand for a string in the search, and most strings searched in one pass over the units.
GRAMS, A_PASS = (12, 3), 200_000


def _rule(df: DataFrame) -> DataFrame:
    return df.filter(T.translatable(F.col("text"), least=3, tags=False, english=False))


def _key(text) -> Column:
    return F.unhex(F.sha2(text, 256))


def offered(source_visible: DataFrame, visible: DataFrame, extracted: DataFrame) -> DataFrame:
    """Distinct translatable strings of localized pages (slug, lang) with their number n: whether the source page shows them too (same) and, if so, whether they lie in its extracted units (inside); else their text.

    A page's units are joined into one text without their numbered tags, and searched as such. Strings go by
    their SHA-256; only those that the source page shows and that are no whole unit are searched for.
    """
    strings = stored(_rule(visible).groupBy("slug", "lang", _key("text").alias("key")).agg(F.count(F.lit(1)).alias("n")))
    bare = extracted.select("slug", T.strip_placeholders(F.col("text")).alias("bare"))
    shown = _rule(source_visible).select("slug", _key("text").alias("key")).distinct()
    wholes = bare.select("slug", _key("bare").alias("key")).distinct().withColumn("whole", F.lit(True))
    same = strings.select("slug", "key").distinct().join(shown, ["slug", "key"]).join(wholes, ["slug", "key"], "left")
    same = stored(same.withColumn("whole", F.coalesce("whole", F.lit(False))))
    open_ = _rule(source_visible).select("slug", "text", _key("text").alias("key")).join(same.filter("NOT whole").drop("whole"), ["slug", "key"])
    open_ = stored(open_.select("slug", "key", "text").distinct())
    holes = open_.join(within(open_, bare), ["slug", "key"], "left_anti")
    rows = strings.join(same.select("slug", "key", F.lit(True).alias("same")), ["slug", "key"], "left").join(holes, ["slug", "key"], "left")
    return rows.select("slug", "lang", "n", F.coalesce("same", F.lit(False)).alias("same"), (F.col("same").isNotNull() & F.col("text").isNull()).alias("inside"), "text")


def within(strings: DataFrame, units: DataFrame) -> DataFrame:
    """(slug, key) of the strings (slug, key, text) that lie in the joined units (slug, bare) of their slug.

    A string lies in a unit only if each gram of it does: one gram a string (of the longest kind that fits)
    is looked up among the grams of each unit, so that work grows with the units' characters. Only a string with
    two spaces can span units; those found in none are searched for in the joined text of their pages.
    """
    grams = lambda text, n: F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    found = strings.select("slug", "key").limit(0)
    for n, longer in zip(GRAMS, (None, *GRAMS), strict=False):
        some = strings.filter(F.length("text") >= n)
        some = some.filter(F.length("text") < longer) if longer else some
        passes = -(-some.count() // A_PASS)
        least = F.array_min(F.transform(grams("text", n), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))["g"]
        for k in range(passes):
            wanted = some.filter(F.pmod(F.xxhash64("key"), F.lit(passes)) == k).withColumn("gram", least)
            near = units.withColumn("gram", F.explode(F.array_distinct(grams("bare", n)))).join(F.broadcast(wanted), ["slug", "gram"])
            found = found.unionByName(near.filter(F.contains("bare", "text")).select("slug", "key").distinct())
    spanning = strings.filter(F.contains("text", F.lit("  ")))
    if spanning.isEmpty():
        return found
    found = stored(found)
    rest = spanning.join(found, ["slug", "key"], "left_anti")
    joined = units.join(rest.select("slug").distinct(), "slug", "left_semi").groupBy("slug").agg(F.array_join(F.collect_list("bare"), "  ").alias("whole"))
    return found.unionByName(rest.join(joined, "slug").filter(F.contains("whole", "text")).select("slug", "key"))


def never_offered(source_visible: DataFrame, visible: DataFrame, extracted: DataFrame) -> DataFrame:
    """Strings that a localized page shares with its source and that were never extracted from it."""
    return offered(source_visible, visible, extracted).filter("same AND NOT inside").select("slug", "lang", "text")


def hole_rate(source_visible: DataFrame, visible: DataFrame, extracted: DataFrame) -> DataFrame:
    """Per language: strings never offered, those unchanged but offered, all of them, and the former's share in percent (0 without strings)."""
    rows = offered(source_visible, visible, extracted)
    of = lambda rule: F.sum(F.when(F.expr(rule), F.col("n")).otherwise(0))
    counted = rows.groupBy("lang").agg(of("same AND NOT inside").alias("holes"), of("same AND inside").alias("kept"), F.sum("n").alias("total"))
    return counted.withColumn("percent", F.when(F.col("total") > 0, F.round(100 * F.col("holes") / F.col("total"), 6)).otherwise(0.0))


def summary(**gates: DataFrame) -> DataFrame:
    """Failures per gate and the verdict over all of them."""
    out = None
    for name, failures in gates.items():
        row = failures.agg(F.lit(name).alias("gate"), F.count(F.lit(1)).alias("failures"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("passed", F.col("failures") == 0)
