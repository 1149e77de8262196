"""Review heuristics over (source, target) pairs of a locale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T


def reasons(pairs: DataFrame, tautology: bool = False) -> DataFrame:
    """Add ``reasons``: which heuristics a pair trips. ``pairs`` has src, dst and locale."""
    src, dst, locale = F.col("src"), F.col("dst"), F.lower("locale")
    size = F.length(T.trim_ws(T.strip_placeholders(src)))
    ratio, many = T.length_ratio(src, dst), T.content_words(src)
    bounds = F.when(locale.isin(K.COMPACT), ~ratio.between(0.12, 1.2)).otherwise(~ratio.between(0.4, 2.5))
    checks = {
        "placeholder": T.placeholders(src) != T.placeholders(dst),
        "length-anomaly": (size >= 40) & bounds,
        "untranslated": (size >= 25) & (T.trim_ws(src) == T.trim_ws(dst)) & (many >= 3),
        "latin-heavy": locale.isin(K.NON_LATIN) & (many >= 6) & (T.latin_ratio(dst) > 0.8),
        "high-overlap": (many >= 6) & (T.overlap(src, dst) > 0.75),
    }
    if tautology:
        checks["tautology"] = F.size(T.tautologies(src, dst)) > 0
    return pairs.withColumn("reasons", F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), lambda r: r.isNotNull()))


def flags(pairs: DataFrame, tautology: bool = False) -> DataFrame:
    """The pairs with at least one reason."""
    return reasons(pairs, tautology).filter(F.size("reasons") > 0)
