"""Document fingerprints: a canonical exact digest.

A text is normalised (NFKC), case-folded, and its white space folded to single
spaces; the wide fingerprint is two xxhash64 values of that canonical form. Rows
whose fingerprints are equal are then compared byte for byte: a bucket holding
more than one canonical form gives each form its own ordinal, so two documents
share a fingerprint exactly when their canonical bytes are equal.

Everything here is DataFrame functions. Normalisation and case folding call the
ICU library that Spark ships, inside the JVM.

Edge cases: a null text counts as the empty text; repeated rows keep their
number; an empty table gives an empty result; other columns are carried along
by ``exact_groups`` and never clash, as helper columns start with ``__fp_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions

SPACE = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}\x{FEFF}]+"


def canonical(text: Column) -> Column:
    """NFKC, case folding, then white space runs as one space, none at the ends."""
    icu = "com.ibm.icu"
    text = F.coalesce(text, F.lit(""))
    composed = F.reflect(F.lit(f"{icu}.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    folded = F.reflect(F.lit(f"{icu}.lang.UCharacter"), F.lit("foldCase"), composed, F.lit(True))
    again = F.reflect(F.lit(f"{icu}.text.Normalizer"), F.lit("compose"), folded, F.lit(True))
    return F.trim(F.regexp_replace(again, SPACE, " "))


def wide_hash(form: Column) -> Column:
    """128 bits of xxhash as 32 hex digits: the form alone, and the form after a salt and its length."""
    digits = [F.lower(F.lpad(F.hex(h), 16, "0")) for h in (F.xxhash64(form), F.xxhash64(F.lit("wide"), F.length(form), form))]
    return F.concat(*digits)


def collisions(forms: DataFrame) -> DataFrame:
    """(hash, form, ordinal) of buckets in which canonical bytes differ.

    ``forms`` has ``__fp_hash`` and ``__fp_form``. collect_set holds each distinct
    form of a bucket once, already on the map side, so a hot group of copies
    travels as one row per task.
    """
    return (
        forms.groupBy("__fp_hash")
        .agg(F.collect_set("__fp_form").alias("__fp_forms"))
        .filter(F.size("__fp_forms") > 1)
        .select("__fp_hash", F.posexplode(F.array_sort("__fp_forms")).alias("__fp_ordinal", "__fp_form"))
    )


def tag(hash_: Column, ordinal: Column) -> Column:
    """The fingerprint of a bucket's form; ordinals appear only where bytes differ."""
    return F.when(F.coalesce(ordinal, F.lit(0)) == 0, hash_).otherwise(F.concat(hash_, F.lit("-"), ordinal.cast("string")))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add each row's verified fingerprint.

    The table of colliding buckets is joined by hash and form; it is empty
    unless two canonical forms share 128 bits, and it is not broadcast by us.
    """
    formed = df.withColumn("__fp_form", canonical(F.col(text))).withColumn("__fp_hash", wide_hash(F.col("__fp_form")))
    clash = Scratch(df.sparkSession, "fingerprint").put(collisions(formed.select("__fp_hash", "__fp_form")))
    if clash.isEmpty():
        return formed.withColumn(out, F.col("__fp_hash")).drop("__fp_form", "__fp_hash")
    joined = formed.join(clash, ["__fp_hash", "__fp_form"], "left")
    return joined.withColumn(out, tag(F.col("__fp_hash"), F.col("__fp_ordinal"))).drop("__fp_form", "__fp_hash", "__fp_ordinal")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint, number of rows and smallest id of each group of canonically equal texts."""
    marked = fingerprint(df, text).select("fingerprint", id_col)
    return marked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_rows"), F.min(id_col).alias("first_id"))


def with_next(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``__fp_next``, the text of the next row by descending id; the first row's after the last.

    Rows are dealt to id ranges whose upper bounds are ids of the table, and the row at a
    bound is sent to the range above too, so one exchange of the texts is enough.
    """
    spark, ranges = df.sparkSession, 4 * shuffle_partitions(df.sparkSession)
    share = F.expr(f"cast(split('{','.join(f'{k / ranges:.9f}' for k in range(1, ranges + 1))}', ',') as array<double>)")
    bounds = df.agg(F.percentile_approx(id_col, share, F.lit(max(10_000, 8 * ranges))).alias("b")).first()["b"] or []
    edge = df.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).first()
    if edge["hi"] is None:
        return df.withColumn("__fp_next", F.lit(None).cast("string"))
    bounds = sorted({*bounds, edge["hi"]} - {edge["lo"]}) or [edge["hi"]]
    last = len(bounds) - 1
    steps = max(1, last.bit_length() + 1)
    listed = ",".join(map(str, bounds))
    # The first bound that is not below the id, by binary search.
    find = f"""aggregate(sequence(1, {steps}), struct(0 as lo, {last} as hi), (a, x) -> CASE WHEN a.lo >= a.hi THEN a
        WHEN {id_col} > element_at(b, shiftright(a.lo + a.hi, 1) + 1) THEN struct(shiftright(a.lo + a.hi, 1) + 1 as lo, a.hi as hi)
        ELSE struct(a.lo as lo, shiftright(a.lo + a.hi, 1) as hi) END, a -> a.lo)""".replace("element_at(b,", f"element_at(cast(split('{listed}', ',') as array<bigint>),")
    placed = df.withColumn("__fp_range", F.expr(find))
    at_bound = F.col(id_col) == F.element_at(F.expr(f"cast(split('{listed}', ',') as array<bigint>)"), F.col("__fp_range") + 1)
    above = F.when(F.col("__fp_range") == last, F.lit(0)).otherwise(F.col("__fp_range") + 1)
    copies = F.when(at_bound, F.array(F.struct(F.col("__fp_range").alias("r"), F.lit(False).alias("guest")), F.struct(above.alias("r"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(F.col("__fp_range").alias("r"), F.lit(False).alias("guest")))
    )
    dealt = placed.withColumn("__fp_copy", F.explode(copies)).drop("__fp_range")
    # A range's rows by descending id; the guest, which is the top of the range below, comes last.
    # Equal ids (repeated rows) are ordered by text; a guest that repeats is the smallest of them.
    order = Window.partitionBy("__fp_copy.r").orderBy("__fp_copy.guest", F.desc(id_col), F.col(text).asc_nulls_first())
    return dealt.withColumn("__fp_next", F.lead(F.coalesce(F.col(text), F.lit(""))).over(order)).filter(~F.col("__fp_copy.guest")).drop("__fp_copy")


def compare_edited(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    Likeness of an exact digest is 1 where canonical bytes are equal, else 0; both
    forms stand in one row, so the bytes themselves are compared. Buckets of equal hashes
    are compared byte for byte over documents; edited texts, which rarely meet another, are first
    compared by a second digest of 256 bits, and byte for byte where that differs within a bucket.
    """
    rows = df.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("__fp_text"))
    scratch = Scratch(df.sparkSession, "fingerprint")
    given = rows.select(canonical(F.col("__fp_text")).alias("__fp_form")).withColumn("__fp_hash", wide_hash(F.col("__fp_form")))
    clash = scratch.put(collisions(given))
    near = with_next(rows, id_col, "__fp_text")
    n = F.length("__fp_text")
    near = near.withColumn("n_chars", n.cast("long")).withColumn(
        "__fp_edited", F.concat(F.expr("substring(__fp_text, 1, n_chars - n_chars div 2)"), F.expr("substring(coalesce(__fp_next, ''), 1, n_chars div 2)"))
    )
    forms = near.select(
        id_col,
        "n_chars",
        F.sha2(F.col("__fp_edited"), 256).alias("edited_sha256"),
        canonical(F.col("__fp_text")).alias("__fp_a"),
        canonical(F.col("__fp_edited")).alias("__fp_b"),
        canonical(F.col("__fp_next")).alias("__fp_c"),
    )
    second = lambda form: F.unhex(F.sha2(form, 256))
    light = forms.select(
        id_col,
        "n_chars",
        "edited_sha256",
        wide_hash(F.col("__fp_a")).alias("__fp_ha"),
        wide_hash(F.col("__fp_b")).alias("__fp_hb"),
        second(F.col("__fp_a")).alias("__fp_sa"),
        second(F.col("__fp_b")).alias("__fp_sb"),
        (F.col("__fp_a") == F.col("__fp_b")).cast("double").alias("near_edited"),
        (F.col("__fp_a") == F.col("__fp_c")).cast("double").alias("near_next"),
    )
    light = scratch.put(light)
    both = light.select(F.col("__fp_ha").alias("h"), F.col("__fp_sa").alias("s")).unionByName(light.select(F.col("__fp_hb").alias("h"), F.col("__fp_sb").alias("s")))
    mixed = both.groupBy("h").agg(F.min("s").alias("a"), F.max("s").alias("b")).filter("a != b").select("h")
    mixed = scratch.put(mixed.unionByName(clash.select(F.col("__fp_hash").alias("h"))).distinct())
    if mixed.isEmpty():
        marks = {"a": F.col("__fp_ha"), "b": F.col("__fp_hb")}
    else:
        # Bytes that differ under one hash: each form of the bucket, edited ones too, gets its ordinal.
        each = [forms.select(F.col(f"__fp_{x}").alias("__fp_form")).withColumn("__fp_hash", wide_hash(F.col("__fp_form"))) for x in "ab"]
        told = collisions(each[0].unionByName(each[1]).join(mixed.withColumnRenamed("h", "__fp_hash"), "__fp_hash", "left_semi"))
        told = scratch.put(told.select("__fp_hash", second(F.col("__fp_form")).alias("__fp_second"), "__fp_ordinal"))
        for x in "ab":
            side = told.select(F.col("__fp_hash").alias(f"__fp_h{x}"), F.col("__fp_second").alias(f"__fp_s{x}"), F.col("__fp_ordinal").alias(f"__fp_o{x}"))
            light = light.join(side, [f"__fp_h{x}", f"__fp_s{x}"], "left")
        marks = {x: tag(F.col(f"__fp_h{x}"), F.col(f"__fp_o{x}")) for x in "ab"}
    return light.select(id_col, "n_chars", "edited_sha256", marks["a"].alias("fingerprint"), marks["b"].alias("edited_fingerprint"), "near_edited", "near_next")


def query(spark, sf_dir):
    """op3: fingerprints of all documents and of their edited texts."""
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
