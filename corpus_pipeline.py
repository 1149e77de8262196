"""A corpus pipeline of five stages, each of them one operator of ``tessera.llm``.

1. toxicity: documents scored at the threshold or above go;
2. near duplicates (five-word shingles, similarity 0.8): one document of each group stays;
3. personal data: spans are replaced by their kind;
4. mixing: documents are taken, once or twice or not at all, by the schedule's word counts, in the order of its slots;
5. BPE: every text is encoded; the result has token counts and digests.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the first four return
the columns of ``documents``. ``run`` writes each stage as Parquet to the shared
folder and reads it back as the next one's input.

Edge cases: null texts pass every stage as empty ones (mixing never takes them);
repeated rows are treated each on their own except as duplicates; copies of a row share
its id, so they stay or go together; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, mixing, neardup, pii, toxicity
from tessera.llm.common import Scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from ``labels``."""
    kept = toxicity.flag(docs, table(spark, sf_dir, "labels")).filter(F.col("toxicity") < toxicity.THRESHOLD)
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of the smallest id."""
    gone = neardup.near_duplicates(docs.select("doc_id", "text"), k=5).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), "text_hash").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (neardup.text_hash(F.col("text")) == F.col("text_hash"))
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by marks; n_chars follows the text."""
    redacted = pii.redact(docs, model=pii.fit(spark))
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row for each time."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text, with the document's other columns."""
    return bpe.encode(docs.select("doc_id", "text", "lang", "source"), ids=False).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Trained models, hashing and merging cannot be said in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir))
    return docs
