"""Glossary terms: effective list, occurrence joins, compliance, fingerprint, invalidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "source string, rule string, targets map<string,string>, match_case boolean, note string"
BOUNDARY = r"[\p{L}\p{N}_]+"


def validate(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed terms, and a row of what is wrong with each of the others."""
    source = F.trim(F.coalesce("source", F.lit("")))
    wrong = (
        F.when(source == "", "no source")
        .when(~F.coalesce("rule", F.lit("")).isin("keep", "translate"), "unknown rule")
        .when((F.col("rule") == "translate") & (F.coalesce(F.size("targets"), F.lit(0)) <= 0), "translate without targets")
    )
    marked = raw.withColumn("problem", wrong)
    return marked.filter("problem IS NULL").drop("problem"), marked.filter("problem IS NOT NULL")


def effective(explicit: DataFrame, inherited: DataFrame) -> DataFrame:
    """Explicit terms and, for sources that they lack, inherited ones to keep; longest first."""
    rest = inherited.join(explicit.select("source"), "source", "left_anti")
    return explicit.unionByName(rest).orderBy(F.desc(F.length("source")), "source")


def hits(units: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Units joined to the terms that occur in them as whole words.

    The first word of a term, lower-cased, must be a word of the unit: that equi-join
    leaves few pairs to test, where a pattern join would compare all of them. The glossary is
    broadcast, as a shuffle by word would copy each text once for every word of it.
    """
    first = F.regexp_extract(F.lower("source"), BOUNDARY, 0)
    keyed = terms.filter(F.length("source") > 0).withColumn("__word", first)
    words = units.withColumn("__word", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(BOUNDARY), F.lit(0)))))
    near = words.join(F.broadcast(keyed), "__word").drop("__word")
    return near.filter(occurs(F.col(text), F.col("source"), F.col("match_case")))


def hits_of_units(units: DataFrame, terms: DataFrame) -> DataFrame:
    """(hash, source) once for each unit and term that occurs in it; units (hash, text) may repeat.

    Terms are found before repeated units are merged, so that texts stay where they are read. As in
    ``lines.dedup`` a hash stands for one text.
    """
    return hits(units.select("hash", "text"), terms).select("hash", "source").distinct()


def occurs(text: Column, term: Column, match_case: Column) -> Column:
    """Whole-word occurrence of a term column."""
    t, s = (F.when(match_case, c).otherwise(F.lower(c)) for c in (text, term))
    escaped = F.regexp_replace(s, r"([\\.^$|?*+()\[\]{}\-])", r"\\$1")
    return F.regexp_like(t, F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), escaped, F.lit(r"(?![\p{L}\p{N}_])")))


def _wanted(terms: DataFrame, lang: str) -> DataFrame:
    rendering = F.when(F.col("rule") == "keep", F.col("source")).otherwise(F.get(F.map_values("targets"), F.lit(0)) if not lang else F.try_element_at("targets", F.lit(lang)))
    return terms.withColumn("__want", rendering).filter("__want IS NOT NULL")


def _broken(found: DataFrame) -> DataFrame:
    kept = F.when(F.col("rule") == "keep", F.contains("dst", "__want")).otherwise(F.contains(F.lower("dst"), F.lower("__want")))
    return found.filter(~kept).drop("__want")


def violations(pairs: DataFrame, terms: DataFrame, lang: str) -> DataFrame:
    """Terms that occur in a source but are not kept, or not translated as told, in its target."""
    return _broken(hits(pairs, _wanted(terms, lang), "src"))


def violations_between(sources: DataFrame, targets: DataFrame, keys: list[str], terms: DataFrame, lang: str) -> DataFrame:
    """``violations`` of sources (keys, src) and targets (keys, dst) that have yet to be joined.

    Only terms found travel to the join, not the sources' texts; the result has no texts.
    """
    found = hits(sources.select(*keys, "src"), _wanted(terms, lang), "src").drop("src")
    return _broken(found.join(targets.select(*keys, "dst"), keys)).drop("dst")


def line(terms: DataFrame) -> DataFrame:
    """Each term's canonical line: source|rule|case|targets by language."""
    targets = F.array_join(F.array_sort(F.transform(F.map_entries(F.coalesce("targets", F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return terms.select(F.concat_ws("|", "source", "rule", F.col("match_case").cast("string"), targets).alias("line"))


def fingerprint(terms: DataFrame) -> DataFrame:
    """The sorted lines, joined; equal for equal glossaries in any order."""
    return line(terms).agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("fingerprint"))


def changed_terms(old: DataFrame, new: DataFrame) -> DataFrame:
    """Sources of lines that were added or removed, with which of the two."""
    a, b = line(old), line(new)
    added = b.exceptAll(a).withColumn("side", F.lit("added"))
    return added.unionByName(a.exceptAll(b).withColumn("side", F.lit("removed"))).withColumn("source", F.split("line", r"\|")[0])


def invalidate(memory: DataFrame, units: DataFrame, changed: DataFrame) -> DataFrame:
    """The memory without translations of units (hash, text; they may repeat) in which a changed term occurs (any case)."""
    terms = changed.select("source").distinct().withColumn("match_case", F.lit(False))
    stale = hits(units.select("hash", "text"), terms).select("hash").distinct()
    return memory.join(stale, "hash", "left_anti")
