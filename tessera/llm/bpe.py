"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus's frequent words (counted over all documents) and the ids that exact
merging gives them are compiled on the driver into a minimal acyclic automaton
(states with equal continuations are shared). Every transition knows how many
words sort before it, so walking a word adds up to its ordinal, which finds its
ids. The automaton is a flat file image of at most ``LEXICON`` words; workers map
it into memory. Words outside it are merged exactly, pair by pair in rank order.

Encoding follows the tokenizer file: special tokens are cut out of the raw text,
the rest is NFC-normalised, lower-cased character by character and split into
words by the file's pattern; results are kept per word in a bounded cache of the
worker. For the lexicon, white-space-free chunks are counted and then split into words.

Edge cases: null text counts as empty (no ids, empty decoded text); very long
words are merged with a heap in O(n log n); repeated rows each give a row; other
columns are kept by ``encode``, unless they have the names it adds, which it replaces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut_below, hashed_key, ship

ship(__name__)

LEXICON = 1 << 16
LONGEST = 48  # characters of a chunk that is counted for the lexicon; longer ones are encoded all the same
CACHE = 400_000
FLUSH = 200_000
SHORT = 24  # symbols of a word that is merged by scanning
NONE = 1 << 40  # the rank of a pair that is never merged
BYTE = [bytes([b]) for b in range(256)]
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_white = re.compile(f"[{WHITE}]+")
_not_white = re.compile("[\x1c-\x1f]")


def default_path() -> str:
    """The tokenizer file of the public collection; pass another path to use another file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_chars() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next unused code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class Merger:
    """Exact BPE of a word by the tokenizer file's merges."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        self.bytes = byte_chars()
        self.first = [self.vocab[c] for c in self.bytes]
        self.last = [self.vocab[c + self.suffix] for c in self.bytes]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.vocab[a], self.vocab[b]] = rank
            self.made.append(self.vocab[a + b])
        import regex

        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", WHITE))
        self.cut_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def merge(self, word: str) -> list[int]:
        """Ids of a word: repeatedly join the pair of lowest rank, leftmost first."""
        coded, first, get = word.encode(), self.first, self.ranks.get
        ids = [first[b] for b in coded]
        ids[-1] = self.last[coded[-1]]
        n = len(ids)
        ranks = [get(pair, NONE) for pair in zip(ids, ids[1:], strict=False)]
        if n <= SHORT:  # a scan for the lowest rank is quicker than a heap
            while ranks and (best := min(ranks)) != NONE:
                i = ranks.index(best)
                ids[i : i + 2] = [self.made[best]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((ids[i - 1], ids[i]), NONE)
                if i < len(ranks):
                    ranks[i] = get((ids[i], ids[i + 1]), NONE)
            return ids
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(rank, i) for i, rank in enumerate(ranks) if rank != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get((ids[i], ids[j])) != rank:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (found := get((ids[i], ids[k]), NONE)) != NONE:
                    heapq.heappush(heap, (found, i))
            if (h := before[i]) >= 0 and (found := get((ids[h], ids[i]), NONE)) != NONE:
                heapq.heappush(heap, (found, h))
        return [i for i in ids if i >= 0]

    def words(self, text: str) -> list[str]:
        """Words of a raw text without special tokens; no word holds white space."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Character by character: a final sigma is no exception here.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return self.pattern.findall(text)


def chunks(text: str) -> list[str]:
    """Maximal runs without Unicode white space."""
    if _not_white.search(text):  # str.split would also cut at these
        return [x for x in _white.split(text) if x]
    return text.split()


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The image of the minimal acyclic automaton of the words, with the ids by ordinal.

    Words are added in sorted order; the states of the last word's tail that can no
    longer change are replaced by equal registered ones.
    """
    ordered = sorted(words)
    edges: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path = [0]  # states of the last word

    def settle(down_to: int, word: bytes) -> None:
        for depth in range(len(path) - 1, down_to, -1):
            state, label = path[depth], word[depth - 1]
            shape = (final[state], tuple(edges[state].items()))
            edges[path[depth - 1]][label] = register.setdefault(shape, state)
        del path[down_to + 1 :]

    last = b""
    for word in ordered:
        common = 0
        while common < min(len(last), len(word)) and last[common] == word[common]:
            common += 1
        settle(common, last)
        for label in word[common:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][label] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    settle(0, last)
    # Lay out the states that are left, counting the words below each.
    number, below, stack, order = {0: 0}, {}, [(0, False)], []
    while stack:
        state, done = stack.pop()
        if done:
            below[state] = final[state] + sum(below[t] for t in edges[state].values())
            continue
        if state in below:
            continue
        stack.append((state, True))
        stack += [(t, False) for t in edges[state].values() if t not in below]
    for state in below:
        number.setdefault(state, len(number))
    order = sorted(number, key=number.get)
    first, labels, targets, skips = [0], [], [], []
    for state in order:
        skip = int(final[state])
        for label, target in edges[state].items():
            labels.append(label)
            targets.append(number[target])
            skips.append(skip)
            skip += below[target]
        first.append(len(labels))
    ids = [words[w] for w in ordered]
    parts = [
        np.array(first, "<u4"), np.array(targets, "<u4"), np.array(skips, "<u4"), np.array([final[s] for s in order], "<u4"),
        np.cumsum([0, *map(len, ids)]).astype("<u4"), np.array([i for x in ids for i in x], "<u4"),
    ]
    return np.array([*map(len, parts), len(labels)], "<u4").tobytes() + b"".join(p.tobytes() for p in parts) + bytes(labels)


class Lexicon:
    """A compiled lexicon, mapped into memory from an unlinked file of the worker's own."""

    def __init__(self, image: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(image)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        *sizes, labels = np.frombuffer(self.map, "<u4", 7).tolist()
        at, parts = 28, []
        for size in sizes:
            parts.append(memoryview(np.frombuffer(self.map, "<u4", size, at)))
            at += 4 * size
        self.first, self.targets, self.skips, self.final, self.offsets, self.ids = parts
        self.labels = at  # one byte per transition, to the end

    def find(self, word: bytes) -> list[int] | None:
        """The word's ids, or None where the lexicon lacks it."""
        state, ordinal, seek, labels, first = 0, 0, self.map.find, self.labels, self.first
        for label in word:
            e = seek(BYTE[label], labels + first[state], labels + first[state + 1]) - labels
            if e < 0:
                return None
            ordinal += self.skips[e]
            state = self.targets[e]
        if not self.final[state]:
            return None
        return self.ids[self.offsets[ordinal] : self.offsets[ordinal + 1]].tolist()


class Codec:
    """Encodes and decodes whole texts; one per worker, with a bounded cache of words."""

    def __init__(self, spec: dict, image: bytes):
        self.merger, self.lexicon = Merger(spec), Lexicon(image)
        self.cache: dict[str, tuple[bytes, str]] = {}

    def word(self, word: str) -> tuple[bytes, str]:
        """Ids of a word as little-endian bytes, and its decoded tokens."""
        ids = self.lexicon.find(word.encode())
        if ids is None:
            ids = self.merger.merge(word)
        out = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids))
        if len(self.cache) >= CACHE:
            self.cache.clear()
        if len(word) <= LONGEST:
            self.cache[word] = out
        return out

    def encode(self, text: str) -> list[tuple[bytes, str]]:
        """Each word's ids and decoded tokens, and those of special tokens in their places."""
        get, out = self.cache.get, []
        special = self.merger.special
        pieces = self.merger.cut_special.split(text) if self.merger.cut_special and "<" in text else [text]
        for piece in pieces:
            if piece in special:
                out.append((np.array([special[piece]], "<u4").tobytes(), piece))
            elif piece:
                out += [get(w) or self.word(w) for w in self.merger.words(piece)]
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as the file names no decoder; special tokens are kept."""
        return " ".join([self.merger.tokens[i] for i in ids])


def frequent(df: DataFrame, text: str = "text", top: int = LEXICON) -> list[tuple[str, int]]:
    """The most frequent chunks of all texts with their counts, ``top`` of them or all; ties by a hash of the chunk.

    Exact counts of ranges find the least count that fits, and the hash below which its
    ties fit; only the chosen chunks reach the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch["t"]:
                if value:
                    seen.update(chunks(value))
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"chunk": list(seen), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"chunk": list(seen), "n": list(seen.values())}).astype({"chunk": object, "n": "int64"})

    counted = df.select(F.col(text).alias("t")).mapInPandas(count, "chunk string, n long").filter(F.length("chunk") <= LONGEST)
    scratch = Scratch(df.sparkSession, "lexicon")
    table = scratch.put(counted.groupBy("chunk").agg(F.sum("n").alias("n")))
    most = table.agg(F.max("n")).first()[0] or 0
    rank = F.lit(most) - F.col("n")
    cut = cut_below(table, rank, top, most + 1)
    out = table if cut is None else table.filter(rank < cut)
    out = [(r["chunk"], r["n"]) for r in out.collect()]
    if cut is not None and len(out) < top:
        ties, key = table.filter(rank == cut), hashed_key(F.col("chunk"))
        last = cut_below(ties, key, top - len(out))
        out += [(r["chunk"], r["n"]) for r in (ties if last is None else ties.filter(key < last)).collect()]
    scratch.drop(table)
    return sorted(out, key=lambda r: (-r[1], r[0]))


def build(df: DataFrame, text: str = "text", path: str | None = None, size: int = LEXICON) -> tuple[dict, bytes]:
    """The tokenizer's specification and the lexicon's image for a corpus."""
    with open(path or default_path(), encoding="utf-8") as f:
        spec = json.load(f)
    merger, words = Merger(spec), Counter()
    for chunk, n in frequent(df, text):
        pieces = merger.cut_special.split(chunk) if merger.cut_special else [chunk]
        for piece in pieces:
            if piece and piece not in merger.special:
                for word in merger.words(piece):
                    words[word] += n
    chosen = sorted(words, key=lambda w: (-words[w], w))[:size]
    return spec, compile_lexicon({w.encode(): merger.merge(w) for w in chosen})


def encode(df: DataFrame, text: str = "text", path: str | None = None, ids: bool = True) -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256; with ``ids`` also token_ids."""
    spec, image = build(df, text, path)
    shared = df.sparkSession.sparkContext.broadcast({"spec": spec, "image": image})
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | ({"token_ids": "array<long>"} if ids else {})
    kept = [c for c in df.columns if c not in added]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"{c} {t}" for c, t in added.items()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = shared.value  # the worker's own copy, which outlives the task: the codec and its cache stay with it
        codec = state.get("codec") or state.setdefault("codec", Codec(state["spec"], state["image"]))
        for batch in batches:
            rows: list[tuple] = []
            for value in batch[text]:
                parts = codec.encode(value or "")
                packed = b"".join([p[0] for p in parts])
                decoded = " ".join([p[1] for p in parts if p[1]])
                row = (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                rows.append((*row, np.frombuffer(packed, "<u4").astype("int64")) if ids else row)
            made = pd.DataFrame(rows, columns=list(added), index=batch.index)
            yield pd.concat([batch[kept], made], axis=1)

    return df.select(*kept).mapInPandas(run, schema)


def query(spark, sf_dir):
    """op9: ids and decoded text of all documents, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, ids=False).drop("text")
