"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (hashed) and of
itself, so an unseen misspelling shares vectors with what it resembles. The words
of a window are averaged and go into a linear softmax over the two labels; a
document's score is that of its highest window, so a long text does not hide a
short insult. Windows have ``WINDOW`` words and start every ``STRIDE`` words, the last
one where it still is full, so a passage is not told by where it stands; a text of
fewer words is one window. Embeddings and softmax are trained jointly in numpy
(full-batch Adam; the gradient of a document goes through its windows' mean first, then
through its highest window), and the score is calibrated on rows left out of the fit.

Training takes a bounded sample of labelled rows (``MAX_TRAIN``, by a hash of the
id, whole texts), in one task of an executor, whose memory grows with the sample's
words. The softmax's two logits are linear in the words and only their difference
counts, so for scoring a word is one number, kept in a bounded cache.

Edge cases: null and empty texts, and those of white space, get the share of label 1
among the rows learned from, as there is nothing else to go by; without labelled
rows of both labels every score is that share (0 without any); repeated
rows each give a row; a document with several labels counts as its largest; other
columns are kept by ``flag``, save one named ``toxicity``, which is replaced, and
ignored by ``score``.
"""

from __future__ import annotations

import pickle
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .language import held_out, sample

ship(__name__)

BUCKETS, DIM = 1 << 16, 8
MASK = BUCKETS - 1
WINDOW, STRIDE = 10, 5
MAX_TRAIN = 9_000
STEPS, WARM = 90, 20
BLOCK = 50_000  # words whose n-grams are summed at once
RATE, DECAY = 0.05, 5e-4
THRESHOLD = 0.3
CACHE = 300_000
STRIP = ".,;:!?\"'()[]{}<>«»“”‘’*_-#&%$"


def words(text: str) -> list[str]:
    return text.lower().split()


def subwords(word: str) -> list[int]:
    """Buckets of a word's n-grams of 3 to 5 characters, marked at its ends, and of itself."""
    marked, crc = f"<{word}>", zlib.crc32
    size = len(marked)
    if marked.isascii():  # then bytes are characters
        coded = marked.encode()
        grams = {coded[i : i + n]: None for n in (3, 4, 5) for i in range(size - n + 1)}
    else:
        grams = {marked[i : i + n].encode("utf-8", "replace"): None for n in (3, 4, 5) for i in range(size - n + 1)}
    out = [crc(g) & MASK for g in grams]
    out.append(crc(b"=" + word.encode("utf-8", "replace")) & MASK)
    return out


def segment_mean(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) / sizes


def windows(n: int) -> np.ndarray:
    """Starts of the windows of n words: every STRIDE words, and the last full one."""
    last = max(0, n - WINDOW)
    return np.append(np.arange(0, last, STRIDE), last)


def fit(texts: list[str], labels: np.ndarray) -> dict:
    """Embeddings ``e`` of the n-grams' buckets, softmax weights ``v`` and biases ``b`` by label, and the calibration."""
    if len(labels) == 0 or labels.min() == labels.max():
        return {"e": None, "share": float(labels.mean()) if len(labels) else 0.0}
    vocabulary: dict[str, int] = {}
    tokens, start, doc, at = [], [], [], 0
    for d, text in enumerate(texts):
        mine = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
        if mine:
            starts = windows(len(mine))
            start.append(at + starts)
            doc.append(np.full(len(starts), d))
        tokens.append(np.array(mine, np.int32))
        at += len(mine)
    sizes_of = np.array([len(t) for t in tokens])
    full = sizes_of > 0  # documents with words
    if not full.any():
        return {"e": None, "share": float(labels.mean())}
    tokens, start, doc = np.concatenate(tokens), np.concatenate(start), np.concatenate(doc)
    size = np.minimum(WINDOW, sizes_of[doc])
    flat, sizes = array("i"), array("i")  # compact: the sample's vocabulary may have half a million words
    for w in vocabulary:
        before = len(flat)
        flat.extend(subwords(w.strip(STRIP)))
        sizes.append(len(flat) - before)
    del vocabulary
    gram, g_size = np.frombuffer(flat, np.int32), np.frombuffer(sizes, np.int32)
    g_start = np.concatenate([[0], np.cumsum(g_size)[:-1]])
    g_end = np.append(g_start, len(gram))
    first = np.searchsorted(doc, np.arange(len(texts)))
    count = np.bincount(doc, minlength=len(texts))
    held = np.arange(len(texts)) % 4 == 3
    used = full & ~held
    weight = np.where(labels == 1, 0.5 / max(1, (labels[used] == 1).sum()), 0.5 / max(1, (labels[used] == 0).sum())) * used
    rng = np.random.default_rng(7)
    half = rng.normal(0, 0.5, DIM)
    e, v, b = rng.normal(0, 0.1, (BUCKETS, DIM)), np.stack([-half, half], axis=1), np.zeros(2)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (e, v, b)]

    def forward():
        """The windows' log odds: the difference of the two labels' logits."""
        p, s = (e @ (v[:, 1] - v[:, 0])).astype(np.float32), np.empty(len(g_size), np.float32)
        for i in range(0, len(g_size), BLOCK):  # in blocks of words, to bound memory
            j = min(i + BLOCK, len(g_size))
            s[i:j] = segment_mean(p[gram[g_start[i] : g_end[j]]], g_start[i:j] - g_start[i], g_size[i:j])
        run = np.concatenate([[0.0], np.cumsum(s[tokens], dtype=np.float64)])
        return (run[start + size] - run[start]) / size * WINDOW + (b[1] - b[0])

    def spread(dz: np.ndarray) -> np.ndarray:
        """The gradient of the windows' log odds, carried back to the n-grams."""
        each = dz * WINDOW / size
        turn = np.bincount(start, weights=each, minlength=len(tokens) + 1) - np.bincount(start + size, weights=each, minlength=len(tokens) + 1)
        per_token = np.cumsum(turn[:-1])
        ds, dp = np.bincount(tokens, weights=per_token, minlength=len(g_size)), np.zeros(BUCKETS)
        ds /= g_size
        for i in range(0, len(g_size), BLOCK):
            j = min(i + BLOCK, len(g_size))
            dp += np.bincount(gram[g_start[i] : g_end[j]], weights=np.repeat(ds[i:j], g_size[i:j]), minlength=BUCKETS)
        return dp

    def pooled(z: np.ndarray, warm: bool) -> tuple[np.ndarray, np.ndarray]:
        """A document's log odds and each window's share in it."""
        out = np.full(len(texts), b[1] - b[0])
        if warm:
            out[full] = np.add.reduceat(z, first[full]) / count[full]
            share = 1.0 / count[doc]
        else:
            out[full] = np.maximum.reduceat(z, first[full])
            is_top = z == out[doc]
            share = is_top / np.bincount(doc, weights=is_top, minlength=len(texts))[doc]
        return out, share

    for step in range(1, STEPS + 1):
        z = forward()
        out, share = pooled(z, step <= WARM)
        error = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - labels) * weight  # softmax of label 1 less the label
        dz = error[doc] * share
        dp = spread(dz)
        pull = e.T @ dp
        sides = np.array([-1.0, 1.0])
        gradients = (np.outer(dp, v[:, 1] - v[:, 0]) + DECAY * e, np.outer(pull, sides) + DECAY * v, dz.sum() * sides)
        for x, g, moments in zip((e, v, b), gradients, state, strict=True):
            moments[0] *= 0.9
            moments[0] += 0.1 * g
            moments[1] *= 0.99
            moments[1] += 0.01 * g * g
            x -= RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
    z, _ = pooled(forward(), False)
    tune = held & full if len(set(labels[held & full])) == 2 else full
    slope, offset = 1.0, 0.0
    for _ in range(200):  # logistic calibration of the highest window's log odds
        q = 1 / (1 + np.exp(-np.clip(slope * z[tune] + offset, -40, 40)))
        slope -= 0.05 * (((q - labels[tune]) * z[tune]).mean() + 0.001 * (slope - 1))
        offset -= 0.2 * (q - labels[tune]).mean()
    return {"e": e, "v": v, "b": b, "slope": float(slope), "offset": float(offset), "share": float(labels.mean())}


def compiled(model: dict) -> dict:
    """The model for scoring: each bucket's part in the log odds, in place of its embedding."""
    if model["e"] is None:
        return {"p": None, "share": model["share"]}
    v, b = model["v"], model["b"]
    return {"p": model["e"] @ (v[:, 1] - v[:, 0]), "b": float(b[1] - b[0])} | {k: model[k] for k in ("slope", "offset", "share")}


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MAX_TRAIN) -> dict:
    """Fit on a bounded sample of the labelled rows open to training."""
    known = labels.groupBy(id_col).agg(F.max(label).alias("y"))
    chosen = sample(known, id_col, "y", most)
    # The sample's ids are few by its bound, so they are broadcast and the texts are not exchanged.
    rows = df.select(id_col, F.col(text).alias("t")).join(F.broadcast(chosen), id_col).select(F.col(id_col).alias("id"), "t", "y")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"id": [], "t": [], "y": []}), *batches]).sort_values(["id", "t"])
        yield pd.DataFrame({"model": [pickle.dumps(compiled(fit([t or "" for t in got["t"]], got["y"].to_numpy(dtype=np.float64))))]})

    # The sample is bounded, so one task of an executor fits the model; the driver gets the weights only.
    got = rows.repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(got["model"]) if got else compiled(fit([], np.zeros(0)))


class Scorer:
    """Scores whole texts with a fitted model; one per worker, with bounded caches of tokens and words."""

    def __init__(self, model: dict):
        self.model, self.cache, self.known = model, {}, {}
        self.p = None if model["p"] is None else model["p"].tolist()

    def word(self, token: str) -> float:
        """The score of a token: that of its word without punctuation at the ends."""
        word = token.strip(STRIP)
        got = self.known.get(word)
        if got is None:
            p, grams = self.p, subwords(word)
            got = sum([p[i] for i in grams]) / len(grams)
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[word] = got
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[token] = got
        return got

    def score(self, text: str) -> float:
        if self.model["p"] is None or not (mine := words(text)):
            return self.model["share"]
        get = self.cache.get
        run = np.cumsum([0.0] + [got if (got := get(w)) is not None else self.word(w) for w in mine])
        starts, size = windows(len(mine)), min(WINDOW, len(mine))
        z = self.model["b"] + float((run[starts + size] - run[starts]).max()) / size * WINDOW
        return float(1 / (1 + np.exp(-np.clip(self.model["slope"] * z + self.model["offset"], -40, 40))))


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``toxicity`` to the given columns."""
    shared = df.sparkSession.sparkContext.broadcast({"model": model})
    kept = [c for c in df.columns if c != "toxicity"]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + ["toxicity double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = shared.value  # the worker's own copy, which outlives the task: the caches stay with it
        scorer = state.get("scorer") or state.setdefault("scorer", Scorer(state["model"]))
        for batch in batches:
            yield batch.assign(toxicity=[scorer.score(t or "") for t in batch[text]])

    return df.select(*kept).mapInPandas(run, schema)


def flag(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their toxicity; a pipeline drops those at ``THRESHOLD`` or above."""
    return score(df, train(df, labels, id_col, text), id_col, text)


def query(spark, sf_dir):
    """op8: toxicity of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model).withColumnRenamed("toxicity", "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
