"""Sampled quality: scores, strata, draws, estimates, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import text as T


def weight(severity: Column) -> Column:
    out = F.lit(0)
    for name, w in K.SEVERITY.items():
        out = F.when(severity == name, w).otherwise(out)
    return out


def mqm(penalty: Column, words: Column) -> Column:
    """100 less the penalty per hundred words, two decimals, halves up; 100 without words."""
    return F.when(words > 0, F.floor((100 - penalty / F.greatest(words, F.lit(1)) * 100) * 100 + 0.5) / 100).otherwise(100.0)


def score(judged: DataFrame, *by: str) -> DataFrame:
    """Score, penalty, words and counts of severities, per group."""
    rows = judged.withColumn("w", weight(F.col("severity")))
    counted = rows.groupBy(*by).agg(
        F.sum("w").alias("penalty"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("units"), F.count(F.when(F.col("severity").isNull(), 1)).alias("clean"),
        *[F.count(F.when(F.col("severity") == s, 1)).alias(s) for s in K.SEVERITY],
    )
    return counted.withColumn("mqm", mqm(F.col("penalty"), F.col("words")))


def with_strata(units: DataFrame) -> DataFrame:
    """Add the stratum (0, 1, 2): thirds of ceil(n / 3) by count, most repeated first.

    Ranks come from counts, not from one global sort: those of greater counts (a row per distinct
    count), those of earlier hash prefixes within a count, and a rank within the prefix.
    """
    n = units.count()
    ranked = two_level_rank(units.withColumn("__cell", F.left("hash", F.lit(4))), "count", "__cell", "hash").drop("__cell")
    return ranked.withColumn("stratum", F.least(F.floor(F.col("rank") / max(-(-n // 3), 1)), F.lit(2)).cast("int"))


def two_level_rank(rows: DataFrame, value: str, cell: str, *order: str) -> DataFrame:
    """Add ``rank`` (from 0) by value descending, then cell, then the order within the cell.

    No window holds more than a cell, the cells of one value, or the distinct values.
    """
    sizes = rows.groupBy(value, cell).agg(F.count(F.lit(1)).alias("__n"))
    totals = sizes.groupBy(value).agg(F.sum("__n").alias("__t"))
    above = totals.select(value, F.coalesce(F.sum("__t").over(Window.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__above"))
    earlier = F.coalesce(F.sum("__n").over(Window.partitionBy(value).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sizes.withColumn("__earlier", earlier).drop("__n").join(above, value)
    inside = F.row_number().over(Window.partitionBy(value, cell).orderBy(*order)) - 1
    joined = rows.withColumn("__r", inside).join(before, [value, cell])
    return joined.withColumn("rank", F.col("__r") + F.col("__earlier") + F.col("__above")).drop("__r", "__earlier", "__above")


def quotas(units: DataFrame, n: int = K.SAMPLE) -> DataFrame:
    """Size and quota of each stratum."""
    share = F.when(F.col("stratum") == 0, K.SHARES[0]).otherwise(K.SHARES[1])
    sized = with_strata(units).groupBy("stratum").agg(F.count(F.lit(1)).alias("size"))
    return sized.withColumn("quota", F.least(F.col("size"), F.greatest(F.lit(1), F.floor(share * n + 0.5))).cast("long"))


def stratified_sample(units: DataFrame, n: int = K.SAMPLE, seed: int = K.SEED) -> DataFrame:
    """At most n units: draws without replacement in each stratum by the seeded generator.

    The k-th draw of a stratum picks the remaining unit at floor(draw * left). Draws and
    positions depend on sizes alone, so the driver computes the picked ranks (n numbers)
    and the table is filtered by them; the units themselves never meet in one task.
    """
    ranked = with_strata(units)
    sizes = {r["stratum"]: r["n"] for r in ranked.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(sizes.values()) <= n:
        return ranked
    state, picked, third = seed & 0xFFFFFFFF, [], -(-sum(sizes.values()) // 3)
    for stratum in range(3):
        size = sizes.get(stratum, 0)
        if not size:
            continue
        want, taken = min(size, max(1, int(n * K.SHARES[stratum] + 0.5))), []
        for k in range(want):
            state, draw = next_draw(state)
            at = int(draw * (size - k))
            for t in sorted(taken):  # the at-th of those that are left
                at += t <= at
            taken.append(at)
        picked += [stratum * third + t for t in taken]
    return ranked.filter(F.col("rank").isin(picked[:n]))


def next_draw(state: int) -> tuple[int, float]:
    """One step of the 32-bit generator: the next state and a number in [0, 1)."""
    mask = 0xFFFFFFFF
    state = (state + 0x6D2B79F5) & mask
    t = ((state ^ state >> 15) * (state | 1)) & mask
    t = (t ^ (t + (t ^ t >> 7) * (t | 61))) & mask
    return state, (t ^ t >> 14) / 4294967296


def worst(judged: DataFrame, k: int = 15) -> DataFrame:
    """The k units of greatest weight per language; ties by id."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("w"), "doc_id"))
    return judged.withColumn("w", weight(F.col("severity"))).withColumn("rank", rank).filter((F.col("rank") <= k) & (F.col("w") > 0))


def estimate(units: DataFrame) -> DataFrame:
    """Tokens that judging would take: ceil(words * 3.2) + 40 n in, 25 n out."""
    counted = units.agg(F.sum(T.word_count(F.col("text"))).alias("words"), F.count(F.lit(1)).alias("n"))
    return counted.select("n", "words", (F.ceil(F.col("words") * F.lit(3.2).cast("decimal(3,1)")) + 40 * F.col("n")).cast("long").alias("tokens_in"), (25 * F.col("n")).alias("tokens_out"))
