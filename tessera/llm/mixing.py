"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a seeded hash and laid end to end; the line of
words is cut into blocks of equal numbers of words, the last one shorter. A source
needs as many slots as its target takes blocks. The unit interval is cut into the
sources' shares of slots, one after the other, and the points of a van der Corput
sequence are mapped through these cumulative weights: point n is slot n of the mix, and
the source in whose share it falls gives its next block. The first 2^k points of the
sequence are the multiples of 2^-k, each once, so every source gets the slots it needs
to the last, and any run of slots holds each source near its weight, however small it is.
The r-th slot of a source takes the r-th block of its line, starting again at the front
after the last block; a source stops at its target to the word, where its last block is
cut. The mix is the blocks in the order of their slots: each document has the slot in
which it first comes, and ``apply_mix`` writes its rows in that order.

Scale: only (id, source, size) travels. Word offsets are a two-level prefix sum
over hash buckets, so a hot source is spread over ``BUCKETS`` windows. There are at most
``SLOTS`` blocks and three slots more a source; the table of slots is broadcast while that
sum is under ``SMALL``, and joined by exchange beyond. The table of sources stays
distributed: ranks by a sort and counts of its parts, targets by repeated sums of three
groups; the driver holds three thresholds.

Edge cases: null text has size 0; a null source is a source of its own, ordered
last; repeated rows each take part; documents of size 0 are never taken; an empty
table, or one without words, takes nothing; other columns are ignored by ``mix`` and
kept by ``apply_mix``, which uses columns that start with ``__mx_``.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SLOTS = 1 << 18
SMALL = 1 << 20  # rows of a table that may be broadcast: slots or sources, a few numbers each
BUCKETS = 4096
SHARE = Fraction(3, 2)
CAP = 2
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """A table to be joined, broadcast where its counted rows are few."""
    return F.broadcast(df) if rows <= SMALL else df


def ranked_sources(light: DataFrame, scratch: Scratch, weights: tuple[int, ...]) -> tuple[DataFrame, int]:
    """(number, source, source_size, weight) of every source in the order of code points, null last; and how many."""
    sums = light.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last())
    stored = scratch.put(sums.withColumn("at", F.monotonically_increasing_id()))
    part, inside = F.expr("shiftright(at, 33)"), F.expr("at & 8589934591L")
    counts = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row a part of the sort, whatever the number of sources.
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = stored.withColumn("part", part).join(F.broadcast(before), "part").withColumn("number", inside + F.col("before"))
    of = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    out = scratch.put(numbered.select("number", "source", "source_size", of.alias("weight")))
    return out, out.count()


def targets(sources: DataFrame, share: Fraction = SHARE, cap: int = CAP) -> DataFrame:
    """Add ``target`` and ``take`` (its whole words): in proportion to the weights, none above cap times its size.

    Each round sums the sources that are at their cap and those that are not, by weight, and
    gives the latter the rest; sources below a threshold are at their cap. Exact in fractions.
    """
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    limits: dict[int, int] = {}  # weight -> the least size that is not at its cap
    while True:
        at_cap = F.lit(False)
        for w, least in limits.items():
            at_cap = F.when(F.col("weight") == w, F.col("source_size") < least).otherwise(at_cap)
        rows = sources.withColumn("full", at_cap).groupBy("weight").agg(F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).alias("s"), F.count_if(~F.col("full")).alias("free")).collect()
        open_ = sum(r["weight"] * r["free"] for r in rows)
        unit = (total - cap * sum(r["s"] for r in rows)) / open_ if open_ else Fraction(0)
        now = {r["weight"]: max(limits.get(r["weight"], 0), -(-r["weight"] * unit // cap)) for r in rows}
        if not open_ or now == limits:
            break
        limits = now
    target, take = (cap * F.col("source_size")).cast("double"), cap * F.col("source_size")
    for w, least in limits.items():
        free = (F.col("weight") == w) & (F.col("source_size") >= least)
        target = F.when(free, float(w * unit)).otherwise(target)
        take = F.when(free, F.least(F.lit(int(w * unit + Fraction(1, 2))), cap * F.col("source_size"))).otherwise(take)
    return sources.withColumn("target", target).withColumn("take", take.cast("long"))


def van_der_corput(cell: Column, bits: int) -> Column:
    """The number of the point that falls in a cell of width 2^-bits: the cell's bits, reversed."""
    return F.conv(F.reverse(F.lpad(F.bin(cell), max(bits, 1), "0")), 2, 10).cast("long")


def schedule(plan: DataFrame, block: int, scratch: Scratch, order: Callable[[Column, int], Column] = van_der_corput) -> tuple[DataFrame, int]:
    """(number, block, turn, slot, words) of each slot, and how many slots there are.

    ``plan`` has number, take and line (the source's words). ``order`` numbers the cells of
    the cumulative shares of slots.
    """
    passes = F.expr(f"take div line * ceil(line / {block}D) + ceil((take % line) / {block}D)")
    needs = scratch.put(plan.filter("line > 0 AND take > 0").select("number", "take", "line", passes.cast("long").alias("needed")))
    # Cumulative shares over cells of neighbouring sources, so that no task orders all of them.
    of = F.expr("number div 4096")
    sums = needs.groupBy(of.alias("cell")).agg(F.sum("needed").alias("n"))
    before = sums.select("cell", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("needed").over(Window.partitionBy("cell").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = needs.withColumn("cell", of).withColumn("inside", inside).join(before, "cell").withColumn("start", F.col("inside") + F.col("before"))
    slots = needs.agg(F.sum("needed")).first()[0] or 0
    bits = max(1, (slots - 1).bit_length()) if slots else 1
    cells = starts.select("number", "take", "line", F.explode(F.expr("sequence(start, start + needed - 1)")).alias("at"))
    # A source's slots are at most SLOTS and two more, so a window of them is bounded.
    rank = F.row_number().over(Window.partitionBy("number").orderBy("slot")).cast("long") - 1
    placed = cells.withColumn("slot", order(F.col("at"), bits)).withColumn("rank", rank).withColumn("blocks", F.expr(f"cast(ceil(line / {block}D) as bigint)"))
    placed = placed.withColumn("turn", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
    # The words that a slot takes end at the line's end and at the target.
    words = F.expr(f"least({block}L, line - block * {block}L, take - turn * line - block * {block}L)")
    return placed.select("number", "block", "turn", "slot", words.alias("words")), slots


def lines(light: DataFrame, id_col: str, order: int = 17) -> DataFrame:
    """Add ``start``: the words before a document on its source's shuffled line."""
    spread = light.withColumn("__mx_key", F.xxhash64(F.lit(order), F.col(id_col))).withColumn("__mx_bucket", F.expr(f"pmod(shiftright(__mx_key, 40), {BUCKETS})").cast("int"))
    sums = spread.groupBy("number", "__mx_bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("number").orderBy("__mx_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__mx_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("number", "__mx_bucket").orderBy("__mx_key", id_col, "size", "__mx_row").rowsBetween(Window.unboundedPreceding, -1)
    run = spread.withColumn("__mx_run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return run.join(offsets, ["number", "__mx_bucket"]).withColumn("start", F.col("__mx_run") + F.col("__mx_before")).drop("__mx_run", "__mx_before", "__mx_bucket", "__mx_key")


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None, order: Callable[[Column, int], Column] = van_der_corput) -> DataFrame:
    """(row, id, size, source_size, target, taken, slot, turns): what the mix takes of each row.

    ``slot`` is where the row's words first come, null if nowhere. ``turns`` lists (turn, slot,
    start, words): where a pass takes the row, and which of its words. ``row`` numbers the input's
    rows, so that repeated rows stay apart; it may be a column of the input.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "mix")
    light = df.select(id_col, F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), (F.col(row) if row else F.monotonically_increasing_id()).alias("__mx_row"))
    light = scratch.put(light)
    sources, n_sources = ranked_sources(light, scratch, WEIGHTS)
    named = scratch.put(targets(sources))
    block = max(1, -(-(named.agg(F.sum("take")).first()[0] or 0) // SLOTS))
    slots, n_slots = schedule(named.select("number", "take", F.col("source_size").alias("line")), block, scratch, order)
    facts = hinted(named.select("number", F.col("source").alias("__mx_source"), "source_size", "target"), n_sources)
    known = light.join(facts, F.col("source").eqNullSafe(F.col("__mx_source"))).drop("__mx_source")
    placed = lines(known, id_col)
    taken = slots.groupBy("number", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "slot", "words"))).alias("takes"))
    # A document's pieces, one per block that it touches; a document without words has none.
    piece = F.explode_outer(F.expr(f"CASE WHEN size > 0 THEN sequence(start div {block}, (start + size - 1) div {block}) END"))
    pieces = placed.withColumn("block", piece)
    joined = pieces.join(hinted(taken, n_slots), ["number", "block"], "left")
    # Of a block's first ``words`` words, those from the document: the overlap of [start, start + size) with the taken front.
    part = F.expr(
        f"""filter(transform(takes, t -> named_struct('turn', t.turn, 'slot', t.slot,
            'words', greatest(0L, least(start + size, block * {block}L + t.words) - greatest(start, block * {block}L)))), p -> p.words > 0)"""
    )
    mine = joined.withColumn("part", part)
    out = mine.groupBy("__mx_row", id_col, "size", "source_size", "target").agg(F.flatten(F.collect_list("part")).alias("parts"))
    turns = F.expr(
        """transform(array_sort(array_distinct(transform(parts, p -> p.turn))), t -> named_struct('turn', t,
            'slot', array_min(transform(filter(parts, p -> p.turn = t), p -> p.slot)), 'start', 0L,
            'words', aggregate(filter(parts, p -> p.turn = t), 0L, (a, p) -> a + p.words)))"""
    )
    first = F.expr("array_min(transform(parts, p -> p.slot))")
    return out.select(F.col("__mx_row").alias("row"), id_col, "size", "source_size", "target", F.expr("aggregate(parts, 0L, (a, p) -> a + p.words)").alias("taken"), first.alias("slot"), turns.alias("turns"))


def apply_mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", order: Callable[[Column, int], Column] = van_der_corput, slot: bool = False) -> DataFrame:
    """The mixed corpus: a row for each turn that takes words of a document, with the columns given, in the order of slots.

    ``df`` is written out once with its rows' numbers, as two reads may number them differently.

    A document taken whole stays as it is, in the slot of its first block; where a source's
    target cuts a document, the last row holds its first words, joined by single spaces. Rows
    are range-partitioned and sorted by slot, so files written from it follow the schedule;
    with ``slot`` the column ``mix_slot`` is added.
    """
    columns = df.columns
    numbered = Scratch(df.sparkSession, "mix-rows").put(df.withColumn("__mx_at", F.monotonically_increasing_id()))
    taken = mix(numbered, id_col, text, source, row="__mx_at", order=order).select(F.col("row").alias("__mx_at"), F.col("size").alias("__mx_size"), F.explode("turns").alias("__mx_turn"))
    joined = numbered.join(taken, "__mx_at")
    cut = F.expr(f"array_join(slice(filter(split(`{text}`, r'[\\x20\\x09-\\x0D]+'), w -> w != ''), 1, cast(__mx_turn.words as int)), ' ')")
    out = joined.withColumn(text, F.when(F.col("__mx_turn.words") >= F.col("__mx_size"), F.col(text)).otherwise(cut))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length(text).cast(df.schema["n_chars"].dataType))
    out = out.withColumn("mix_slot", F.col("__mx_turn.slot")).repartitionByRange("mix_slot", "__mx_at").sortWithinPartitions("mix_slot", "__mx_at")
    return out.select(*columns, *(["mix_slot"] if slot else []))


def query(spark, sf_dir):
    """op10: how many words of each document the mix takes, and the slot in which they first come."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "slot")
