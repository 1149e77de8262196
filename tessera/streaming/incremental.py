"""Incremental maintenance of units and memory from a stream of segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import text as T
from ..operators import translate
from ..sources import site


def new_units(segments: DataFrame) -> DataFrame:
    """The first occurrence of each content hash in a stream of (lang, text); state is one hash a unit."""
    trimmed = segments.withColumn("text", T.trim_ws(F.col("text")))
    rows = trimmed.filter(T.translatable(F.col("text"))).withColumn("hash", T.content_hash(F.col("text")))
    return rows.dropDuplicates(["lang", "hash"])


def maintain(segments: DataFrame, memory_path: str, checkpoint: str, lang: str, translator: translate.Translator | None = None) -> StreamingQuery:
    """Translate units as they arrive and append them to the memory at a path.

    Each micro-batch adds only hashes that the memory lacks, so a batch that is run again
    after a failure writes nothing twice.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        memory = site.read_memory(spark, memory_path)
        fresh = translate.pending(rows.dropDuplicates(["hash"]), memory.filter(F.col("lang") == lang))
        units = fresh.select("hash", "text", F.lit(1).alias("count"), F.lit(None).cast("string").alias("el"))
        done = translate.translate(units, lang, translator).filter("problem IS NULL")
        done.select("hash", "out", F.lit(lang).alias("lang")).write.mode("append").partitionBy("lang").parquet(memory_path)

    return new_units(segments).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "10 minutes", sink: Callable | None = None) -> DataFrame:
    """Events per window and type, with late rows allowed for a while."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count(F.lit(1)).alias("n"))
