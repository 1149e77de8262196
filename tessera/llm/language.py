"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language on a bounded sample of labelled rows
(``MAX_TRAIN``, chosen by a hash of the id, whole texts); the counts are summed by
Spark, and the matrix of log probabilities (``BUCKETS`` by languages) is
broadcast. Scoring hashes a batch's n-grams at once and sums the matrix's rows of
the n-grams that occur, document by document, in slices of bounded size. The driver
holds the counts: at most ``BUCKETS`` a language, and no more than the sample's n-grams.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; without
any training row every text is; rows of null language are not learned from;
repeated rows each give a row; ties go to the first language by code point;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_below, hashed_key, ship

ship(__name__)

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MAX_TRAIN = 12_000
SMOOTH = 0.5
SLICE = 400_000  # characters scored at once
_multipliers = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(df: DataFrame, id_col: str, label: str, most: int) -> DataFrame:
    """At most ``most`` of the labelled rows open to training, those of the lowest hash of the id; whole texts."""
    labelled = df.filter(F.col(label).isNotNull() & ~held_out(id_col))
    key = hashed_key(F.lit("train"), F.col(id_col))
    cut = cut_below(labelled, key, most)
    return labelled if cut is None else labelled.filter(key < cut)


def has_letter(text: str | None) -> bool:
    """Whether a text holds a letter (Unicode category L): no digit, fraction or numeral sign counts."""
    return any(map(str.isalpha, text or ""))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def hashed(points: np.ndarray) -> tuple[np.ndarray, ...]:
    """Buckets of the n-grams that start at each point, one array per order; the last n - 1 starts are cut."""
    out = []
    for n in ORDERS:
        size = len(points) - n + 1
        if size <= 0:
            out.append(np.zeros(0, np.uint32))
            continue
        h = np.full(size, np.uint32(n * 374761393 & 0xFFFFFFFF), np.uint32)
        for k in range(n):
            h = (h ^ points[k : k + size]) * _multipliers[k]
            h ^= h >> np.uint32(15)
        out.append(h & np.uint32(BUCKETS - 1))
    return tuple(out)


def train(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MAX_TRAIN) -> dict:
    """Languages in order and the matrix of log probabilities, with priors."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for value, label in zip(batch["t"], batch["l"], strict=True):
                docs[label] = docs.get(label, 0) + 1
                mine = seen.setdefault(label, np.zeros(BUCKETS, np.int64))
                for h in hashed(code_points(value or "")):
                    mine += np.bincount(h, minlength=BUCKETS)
        for label, n in seen.items():
            at = np.nonzero(n)[0]
            yield pd.DataFrame({"l": label, "bucket": np.append(at, -1), "n": np.append(n[at], docs[label])}).astype({"bucket": "int32", "n": "int64"})

    chosen = sample(df.select(id_col, F.col(text).alias("t"), F.col(lang).alias("l")), id_col, "l", most)
    counted = chosen.select("t", "l").repartition(8).mapInPandas(count, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["l"] for r in counted})
    counts, docs = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for r in counted:
        if r["bucket"] < 0:
            docs[langs.index(r["l"])] = r["n"]
        else:
            counts[r["bucket"], langs.index(r["l"])] = r["n"]
    logs = np.log((counts + SMOOTH) / (counts.sum(0) + SMOOTH * BUCKETS)) if langs else counts
    return {"langs": langs, "logs": logs.astype(np.float32), "prior": np.log(docs / docs.sum()) if langs else docs}


def score_batch(texts: list[str], model: dict) -> tuple[list[str], np.ndarray]:
    """Predictions and posterior probabilities of texts that have letters."""
    langs, logs, prior = model["langs"], model["logs"], model["prior"]
    totals = np.zeros((len(texts), len(langs)))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE):
            size += len(texts[end])
            end += 1
        for row, value in enumerate(texts[at:end], at):
            points = code_points(value)
            for start in range(0, len(points), SLICE):
                for h in hashed(points[start : start + SLICE + max(ORDERS) - 1]):
                    # An n-gram belongs to the slice in which it starts.
                    h = h[:SLICE]
                    if len(h):
                        totals[row] += logs.take(h, axis=0).sum(0, dtype=np.float64)
        at = end
    totals += prior
    p = np.exp(totals - totals.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    pick = p.argmax(1)
    return [langs[i] for i in pick], p[np.arange(len(pick)), pick]


def identify(df: DataFrame, model: dict, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred, score for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for batch in batches:
            lang, score = np.full(len(batch), "und", object), np.zeros(len(batch))
            have = [i for i, value in enumerate(batch["t"]) if has_letter(value)] if fitted["langs"] else []
            if have:
                names, p = score_batch([batch["t"].iat[i] for i in have], fitted)
                lang[have], score[have] = names, p
            yield pd.DataFrame({"id": batch["id"], "lang_pred": lang, "score": score})

    got = df.select(F.col(id_col).alias("id"), F.col(text).alias("t")).mapInPandas(run, f"id {id_type}, lang_pred string, score double")
    return got.withColumnRenamed("id", id_col)


def query(spark, sf_dir):
    """op6: predicted language of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
