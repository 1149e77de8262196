"""The provided tables in the engine's roles: segments, pairs, judged units, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def segments(documents: DataFrame) -> DataFrame:
    """Lines of documents as positional segments (doc_id, lang, source, seg, text)."""
    return documents.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("seg", "text"))


def units_of(segments_: DataFrame) -> DataFrame:
    """Translatable segments, trimmed, with their content hash."""
    trimmed = segments_.withColumn("text", T.trim_ws(F.col("text")))
    return trimmed.filter(T.translatable(F.col("text"))).withColumn("hash", T.content_hash(F.col("text")))


def dedup(segments_: DataFrame, kind: Column, el: Column) -> DataFrame:
    """One row per distinct text: count, first kind, first page and the element if all agree.

    First seen is the order (doc_id, seg); every aggregate is partial, so hot texts combine map-side.
    """
    at = F.struct("doc_id", "seg")
    rows = segments_.withColumn("kind", kind).withColumn("el", el)
    return rows.groupBy("hash").agg(
        F.min("text").alias("text"),
        F.min_by("kind", at).alias("kind"),
        F.count(F.lit(1)).alias("count"),
        F.min_by("doc_id", at).alias("sample"),
        F.when((F.min(F.coalesce("el", F.lit(""))) == F.max(F.coalesce("el", F.lit("")))), F.min("el")).alias("el"),
        F.min(at).alias("first_seen"),
    )


def pairs(conversations: DataFrame) -> DataFrame:
    """Turn t and turn t + 1 of a conversation as (source, target)."""
    return sources(conversations).join(targets(conversations), ["conv_id", "turn"])


def sources(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", F.col("text").alias("src"))


def targets(conversations: DataFrame) -> DataFrame:
    """Turns by the number of the turn before them."""
    return conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("dst"))


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with an error made of their labels: toxic is critical, low quality major, else none."""
    severity = F.when(F.col("toxic") == 1, "critical").when(F.col("quality") == 0, "major")
    category = F.when(F.col("toxic") == 1, "style/tone").when(F.col("quality") == 0, "fluency/awkward")
    rows = documents.join(labels, "doc_id")
    return rows.select("doc_id", "lang", T.word_count(F.col("text")).alias("words"), severity.alias("severity"), category.alias("category"), "text")


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages with the language and the slug of their URL."""
    path = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]+/", ""), "[?#].*$", "")
    rows = pages.withColumn("path", path)
    return rows.withColumn("lang", F.regexp_extract("path", "^([^/]+)", 1)).withColumn("slug", page_key(F.regexp_replace("path", "^[^/]+/?", "")))


def page_key(path: Column) -> Column:
    """The slug of a path: without /index.html, .html or a final slash; the root is ``index``."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, "/?index\\.html$", ""), "\\.html$", ""), "/$", "")
    return F.when(bare == "", "index").otherwise(bare)
