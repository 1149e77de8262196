"""Sources of a site: HTML trees, page and locale lists, sitemaps; and the sinks."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import ship

ship(__name__)

#: Markers of client-side hydration and what they mean.
HYDRATION = {
    "astro-island": "Astro island", "__NEXT_DATA__": "Next.js hydration payload", "__NUXT__": "Nuxt hydration payload",
    "data-reactroot": "React root", "wp-json": "WordPress REST payload",
}
DOCUMENT = r'\shref="([^"]+\.(?i:pdf|docx?|xlsx?|pptx?|epub))(?:[?#][^"]*)?"'


def html_tree(spark: SparkSession, root: str) -> DataFrame:
    """(file, path, html) of every .html file below a folder; an empty tree gives no rows."""
    read = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").text(root)
    file = F.col("_metadata.file_path")
    inside = F.regexp_replace(file, "^.*?" + re.escape(root.rstrip("/").split("://")[-1]) + "/", "")
    return read.select(file.alias("file"), inside.alias("path"), F.col("value").alias("html"))


def first_component(path: Column) -> Column:
    return F.regexp_extract(path, "^([^/]+)", 1)


def without_locales(pages: DataFrame, locales: list[str], path: str = "path") -> DataFrame:
    """Pages that are not in a locale's folder: the originals."""
    return pages.filter(~first_component(F.col(path)).isin(locales))


def page_list(pages: DataFrame, locales: list[str], exclude: tuple[str, ...] = ("404",)) -> DataFrame:
    """Distinct slugs of original pages, excluded first segments left out, sorted."""
    rows = without_locales(pages, locales)
    return rows.filter(~first_component(F.col("slug")).isin(list(exclude))).select("slug").distinct().orderBy("slug")


def page_list_json(spark: SparkSession, path: str) -> DataFrame:
    """Slugs of a JSON array of strings."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "array<string>")).alias("slug"))


def page_list_source(spark: SparkSession, source: str, name: str) -> DataFrame:
    """Quoted strings of one named exported array in JS or TS source; raises where it is missing."""
    found = re.search(rf"export\s+const\s+{re.escape(name)}\b[^=]*=\s*\[(.*?)\]", source, re.S)
    if not found:
        raise ValueError(f"no exported array {name}")
    return spark.createDataFrame([(s,) for s in re.findall(r"""["']([^"']*)["']""", found[1])], "slug string")


LOCALE_SCHEMA = "hreflang string, path_code string, native_label string"


def locales(spark: SparkSession, rows: list[dict] | None = None, json_text: str | None = None, source: str | None = None, rtl: tuple[str, ...] = ()) -> DataFrame:
    """Locales given inline, as JSON, or scraped from the lines of JS or TS source; labels fall back to the path code."""
    if json_text is not None:
        rows = json.loads(json_text)
    if source is not None:
        field = lambda line, key: (m := re.search(rf"""\b{key}\s*:\s*["']([^"']+)["']""", line)) and m[1]
        rows = [{k: field(line, k) for k in ("hreflang", "pathCode", "nativeLabel")} for line in source.splitlines() if "hreflang" in line]
    made = [(r.get("hreflang") or r.get("pathCode"), r.get("pathCode"), r.get("nativeLabel") or r.get("pathCode")) for r in rows or [] if r.get("pathCode")]
    return spark.createDataFrame(made, LOCALE_SCHEMA).withColumn("rtl", F.lower(F.col("path_code")).isin(list(rtl)))


def glossary(spark: SparkSession, json_text: str) -> DataFrame:
    """Raw glossary rows of a JSON array; raises where it is not one. Rows are checked by ``operators.glossary.validate``."""
    rows = json.loads(json_text)
    if not isinstance(rows, list):
        raise ValueError("a glossary is a JSON array")
    made = []
    for r in rows:
        r = r if isinstance(r, dict) else {}
        targets = r.get("targets") if isinstance(r.get("targets"), dict) else None
        made.append((r.get("source"), r.get("rule"), targets, bool(r.get("matchCase", True)), r.get("note")))
    return spark.createDataFrame(made, "source string, rule string, targets map<string,string>, match_case boolean, note string")


def hydration(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add the labels of the hydration markers found."""
    found = F.array(*[F.when(F.contains(html, F.lit(marker)), label) for marker, label in HYDRATION.items()])
    return pages.withColumn("hydration", F.filter(found, lambda x: x.isNotNull()))


def linked_documents(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct links to office documents and the like, without query and fragment."""
    return pages.select(F.explode(F.regexp_extract_all(html, F.lit(DOCUMENT), F.lit(1))).alias("href")).distinct()


def write_memory(memory: DataFrame, path: str) -> None:
    """The translation memory, one folder per language; only the languages present are replaced."""
    memory.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lang").parquet(path)


def read_memory(spark: SparkSession, path: str, schema: str = "hash string, out string, lang string") -> DataFrame:
    """The memory, or an empty one where nothing was written yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def scorecard(report: list[dict], worst: int = 8) -> str:
    """A Markdown scorecard: a table by language and the worst units of each."""
    out = ["| language | score | words | penalty |", "| --- | --- | --- | --- |"]
    out += [f"| {r['lang']} | {r['mqm']:.2f} | {r['words']} | {r['penalty']} |" for r in report]
    for r in report:
        if r.get("worst"):
            out += ["", f"## {r['lang']}", *[f"- {w}" for w in str(r["worst"]).split(",")[:worst]]]
    return "\n".join(out) + "\n"


SEGMENT = "start: int, stop: int, kind: string, hash: string, tags: array<struct<open:string,close:string>>"


def write_segments(segments: DataFrame, path: str) -> None:
    """Segments (page, start, stop, kind, hash, tags) as JSON lines, one a page."""
    rows = segments.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "hash", "tags"))).alias("segments"))
    rows.write.mode("overwrite").json(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of files of pages, a row each; pages without any give none."""
    read = spark.read.schema(f"page string, segments array<struct<{SEGMENT}>>").json(path)
    return read.select("page", F.explode("segments").alias("s")).select("page", "s.*")


def page_file(lang: Column, slug: Column) -> Column:
    """Where a built page lies: lang/slug/index.html, the root as lang/index.html."""
    bare = F.when(F.coalesce(slug, F.lit("")).isin("", "index"), F.lit("")).otherwise(F.concat(slug, F.lit("/")))
    return F.concat(lang, F.lit("/"), bare, F.lit("index.html"))


def write_pages(pages: DataFrame, root: str) -> DataFrame:
    """Write built pages (lang, slug, html) as HTML files; gives (path, size) of each file.

    The folders of the languages present are deleted first, so that no page stays of a slug
    that is gone. Tasks write by any file system that pyarrow knows, each file under a name of
    the attempt and then moved, so a task that is run again leaves whole files.
    """
    import os

    from pyarrow import fs

    rows = pages.select("lang", page_file(F.col("lang"), F.col("slug")).alias("path"), "html")
    bad = rows.filter(F.col("lang").isNull() | F.col("lang").rlike(r"[/\\]|^\.*$") | F.col("path").rlike(r"(^|/)\.\.(/|$)"))
    if not bad.isEmpty():
        raise ValueError("a page's language or slug leaves its folder")
    root = root if "://" in root else os.path.abspath(root)
    store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    for r in rows.select("lang").distinct().collect():
        if store.get_file_info(f"{base}/{r['lang']}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{r['lang']}")

    def run(batches):
        import uuid

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        for batch in batches:
            sizes = []
            for path, html in zip(batch["path"], batch["html"], strict=True):
                body, target = (html or "").encode("utf-8", "replace"), f"{base}/{path}"
                store.create_dir(target.rsplit("/", 1)[0])
                draft = f"{target}.{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    out.write(body)
                store.move(draft, target)
                sizes.append(len(body))
            yield pd.DataFrame({"path": batch["path"], "size": sizes})

    # The list of files is a table too, beside the pages.
    listed = rows.select("path", "html").mapInPandas(run, "path string, size long")
    listed.write.mode("overwrite").json(f"{root}/.built")
    return pages.sparkSession.read.schema("path string, size long").json(f"{root}/.built")


def lookup_key(names: list[str], env: dict[str, str], env_file: str | None = None, optional: bool = False) -> str | None:
    """The first name that the environment, or else the text of an env file, has a value for; an error if a key is needed."""
    for name in names:
        if env.get(name):
            return env[name]
    for name in names:
        found = re.search(rf"^{re.escape(name)}=(.*)$", env_file or "", re.M)
        if found:
            return found[1].strip()
    if optional:
        return None
    raise LookupError(f"set one of {', '.join(names)}")
