"""License scans by diagonal voting.

All rolling word 3-grams of a document are joined, by hash, to the positions of
the same grams in license templates. A gram at word w of the document and word t
of a template votes for the diagonal w - t. The words themselves are compared
after the join on hashes, so a chance collision casts no vote.

* A base phrase stands at a place exactly when one diagonal holds all its grams.
* A longer template is found where neighbouring diagonals (gap at most
  ``NEAR``) together hold ``COVER`` of its grams within a span of at most
  ``STRETCH`` times its length; merging diagonals lets a few words be inserted
  or dropped.

The template side is a fixed list of a few hundred grams and is broadcast. The
document side is never shuffled except for votes and one row a document.

Edge cases: null text counts as empty (no words, no labels, score 0); documents
with fewer than three words have no grams and still give a row; repeated rows
each give a row, as rows are keyed by a row number, not by doc_id; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
NEAR = 3
COVER = 0.6
STRETCH = 1.5

#: The phrases of the scan and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Characteristic sentences of well-known licenses and their labels.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = "\u0000"  # no word holds it; marks the one row that every document gives


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per gram of each phrase and template, and the marker row."""
    rows = []
    for number, (words, label, exact) in enumerate([(w, x, True) for w, x in PHRASES.items()] + [(w, x, False) for w, x in TEMPLATES.items()]):
        split = words.split()
        grams = len(split) - K + 1
        rows += [(number, label, exact, at, grams, len(split), *split[at : at + K]) for at in range(grams)]
    rows.append((-1, None, None, 0, 0, 0, NO_WORD, NO_WORD, NO_WORD))
    quoted = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) and v != NO_WORD else "char(0)" if v == NO_WORD else str(v).lower() for v in row) + ")" for row in rows)
    made = spark.sql(f"SELECT * FROM VALUES {quoted} AS t(template, label, exact, at, grams, n_template, t1, t2, t3)")
    return made.withColumn("gram", F.xxhash64("t1", "t2", "t3"))


def votes(df: DataFrame, text: str = "text") -> DataFrame:
    """(row key, document columns kept, template, at, pos): one row per matching gram, and the marker rows."""
    kept = [c for c in df.columns if c != text]
    rows = df.select(*kept, F.monotonically_increasing_id().alias("__ls_row"), words_of(F.col(text)).alias("__ls_w"))
    grams = F.expr(
        f"""concat(array(named_struct('pos', size(__ls_w), 'a', char(0), 'b', char(0), 'c', char(0))),
        CASE WHEN size(__ls_w) >= {K} THEN transform(sequence(0, size(__ls_w) - {K}),
            i -> named_struct('pos', i, 'a', __ls_w[i], 'b', __ls_w[i + 1], 'c', __ls_w[i + 2])) ELSE array() END)"""
    )
    flat = rows.select(*kept, "__ls_row", F.explode(grams).alias("g")).select(*kept, "__ls_row", "g.pos", "g.a", "g.b", "g.c", F.xxhash64("g.a", "g.b", "g.c").alias("gram"))
    table = template_grams(df.sparkSession)
    same_words = (flat["a"] == table["t1"]) & (flat["b"] == table["t2"]) & (flat["c"] == table["t3"])
    return flat.join(F.broadcast(table), (flat["gram"] == table["gram"]) & same_words).drop("a", "b", "c", "t1", "t2", "t3", "gram")


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: words, base places, labels and the best cover."""
    hits = votes(df.select(id_col, text), text).withColumn("diagonal", F.col("pos") - F.col("at"))
    key = ["__ls_row", id_col]
    lines = hits.groupBy(*key, "template", "label", "exact", "grams", "n_template", "diagonal").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.bit_or(F.expr("shiftleft(1L, at)")).alias("seen")
    )
    # Neighbouring diagonals of longer templates become one run; exact phrases keep to one diagonal.
    along = Window.partitionBy("__ls_row", "template").orderBy("diagonal")
    starts = F.when(F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > NEAR), 1).otherwise(0)
    runs = lines.withColumn("starts", starts).withColumn("run", F.sum("starts").over(along))
    merged = runs.groupBy(*key, "template", "label", "exact", "grams", "n_template", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("diagonal"), F.bit_or("seen").alias("seen")
    )
    cover = F.bit_count("seen") / F.greatest(F.col("grams"), F.lit(1))
    spans = merged.withColumn("cover", cover).withColumn(
        "found",
        F.when(F.col("template") < 0, False)
        .when(F.col("exact"), F.bit_count("seen") == F.col("grams"))
        .otherwise((F.col("cover") >= COVER) & (F.col("last") - F.col("first") + K <= STRETCH * F.col("n_template"))),
    )
    base = F.col("found") & F.col("exact")

    def joined(when: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")

    return (
        spans.groupBy(*key)
        .agg(
            F.max(F.when(F.col("template") < 0, F.col("diagonal"))).cast("long").alias("n_words"),
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
            joined(base).alias("base_labels"),
            joined(F.col("found")).alias("labels"),
            F.coalesce(F.max(F.when(F.col("found"), F.col("cover"))), F.lit(0.0)).alias("score"),
        )
        .drop("__ls_row")
    )


def query(spark, sf_dir):
    """op4: license phrases of all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = None
