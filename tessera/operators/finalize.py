"""The stages after extraction for one language, in one go: translate, review, purge and translate again, build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from . import build, review, translate


def finalize(pages: DataFrame, segments: DataFrame, units: DataFrame, memory: DataFrame, lang: str, base: str, translator=None, purge: bool = False, labels: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(built pages, memory, report) of a language.

    ``pages`` has page, slug and html; ``segments`` page, start, stop, kind, hash and tags; ``units`` hash,
    text, count and el; ``memory`` hash and out. With ``purge`` translations that the review flags are
    dropped and made again in small batches. The caller stores the memory.
    """
    def more(known: DataFrame, size: int) -> DataFrame:
        made = translate.translate(translate.pending(units, known), lang, translator, size).filter("problem IS NULL")
        return known.unionByName(made.select("hash", "out"))

    known = more(memory.select("hash", "out"), K.BATCH)
    if purge:
        pairs = known.join(units.select("hash", F.col("text").alias("src")), "hash").select("hash", "src", F.col("out").alias("dst"), F.lit(lang).alias("locale"))
        bad = review.flags(pairs).select("hash").distinct()
        known = more(known.join(bad, "hash", "left_anti"), 6)
    rows = segments.join(known, "hash", "left")
    body = (
        F.when(F.col("kind") == "block", build.render_block(F.col("out"), F.col("tags")))
        .when(F.col("kind") == "jsonld", T.escape_json(F.col("out")))
        .when(F.col("kind").startswith("attr:"), T.escape_html(F.col("out"), attribute=True))
        .otherwise(T.escape_html(F.col("out")))
    )
    spliced = build.splice(pages, rows.filter("out IS NOT NULL").select("page", "start", "stop", body.alias("text")))
    html = build.prefix_links(build.rewrite_root(F.col("html"), F.lit(lang), K.RTL), F.lit(lang))
    built = build.localize(spliced.withColumn("lang", F.lit(lang)).withColumn("html", html), base, labels)
    report = rows.agg(F.count("out").alias("replaced"), F.count_if(F.col("out").isNull()).alias("untranslated")).withColumn("lang", F.lit(lang))
    return built, known, report
