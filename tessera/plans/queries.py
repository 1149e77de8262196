"""Imports every module of queries, which registers them; and the flagship query."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lines
from ..session import table
from . import relational, scalars, site  # noqa: F401
from .catalog import ORACLES, QUERIES  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique translatable units of the documents' lines, their occurrences and words, by language."""
    units = lines.units_of(lines.segments(table(spark, sf_dir, "documents")))
    distinct = units.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("text"))
    return distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("units"), F.sum("n").alias("segments"), F.sum(T.word_count(F.col("text"))).alias("words")).orderBy("lang")
