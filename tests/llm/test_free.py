"""Sharding, search, language, near duplicates, toxicity, BPE and the pipeline against plain versions."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, catalog, language, neardup, search, sharding, toxicity
from tessera.llm.common import Scratch, cut_below

from .conftest import DATA


# --- sharding ---------------------------------------------------------------------------------------


def check_shards(rows, texts, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
        if r["doc_id"] in texts:
            body = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(body) + 8, zlib.crc32(body))
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    for mine in by.values():
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
    return {s: sum(r["size"] for r in mine) for s, mine in by.items()}


def test_sharding(spark, texts):
    rows = catalog.queries()["op2_sharding"](spark, DATA).collect()
    sizes = check_shards(rows, texts, 24)
    assert len(rows) == len(texts)
    largest = max(r["size"] for r in rows)
    mean = sum(sizes.values()) / 24
    assert max(sizes.values()) <= mean + largest and min(sizes.get(s, 0) for s in range(24)) >= mean - largest


def test_sharding_hot_copies(spark):
    rows = spark.createDataFrame([(i, "hot " * 20 if i % 3 == 0 else f"text {i} " * 10) for i in range(3000)], "doc_id long, text string")
    got = sharding.shard(rows).collect()
    sizes = check_shards(got, {}, 24)
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and all(abs(s - mean) <= 0.03 * mean + 100 for s in sizes.values())
    small = spark.createDataFrame([(i, f"copy {i // 2}") for i in range(600)], "doc_id long, text string")
    cut = sharding.shard(small).groupBy("text").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count()
    assert cut <= 23


def test_sharding_repeated_and_empty_rows(spark):
    """Rows equal in id and text can be cut, and a mass of empty texts is divided by rows."""
    same = spark.createDataFrame([(1, "the same row")] * 2000, "doc_id long, text string")
    sizes = check_shards(sharding.shard(same).collect(), {}, 24)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 0.02 * 2000 * 20
    light = spark.createDataFrame([(i, "" if i % 10 else "x" * 50_000) for i in range(1000)], "doc_id long, text string").select("doc_id", (F.length("text") + 8).cast("long").alias("size"), F.xxhash64("text").alias("k1"), F.xxhash64("doc_id").alias("k2"))
    starts, ranges = sharding.split(light, 4, 8)
    counts = [n for _, n, _, _ in sharding.histogram(light, starts)]
    assert sum(counts) == 1000 and max(counts) <= 100 and len(ranges) == len(counts)


def test_sharding_edges(spark, odd, empty):
    got = sharding.shard(odd)
    assert "label" in got.columns and len(check_shards(got.collect(), {}, 24)) <= 24 and got.count() == odd.count()
    assert sharding.shard(empty).count() == 0
    assert sharding.shard(odd.filter("doc_id = 3"), shards=2).count() == 2


# --- search -----------------------------------------------------------------------------------------


def brute(vectors, k=5, every=50):
    ints = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ints if i % every == 0}):
        mine = min(v for i, v in ints if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ints if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return out


def test_search(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in search.top_k(spark.read.parquet(f"{DATA}/embeddings.parquet")).select("query_id", "rank", "vec_id", "score").collect())
    assert got == sorted(brute(vectors))


def test_search_edges(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)] + [(60 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]
    vectors += [(100, [0.5, 0.5]), (101, None), (102, [None, 1.0]), (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]), (150, [1e6, -1e6, 3e5, 7.0]), (150, [1e6, -1e6, 3e5, 7.0]), (7, vectors[7][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in search.top_k(df).select("query_id", "rank", "vec_id", "score").collect())
    assert got == sorted(brute(vectors))
    assert search.top_k(df.filter("vec_id < 0")).count() == 0
    assert search.top_k(df.filter("vec_id = 0")).count() == 0
    assert search.top_k(df.filter("vec_id IN (0, 1, 2)")).count() == 2


def test_search_prunes(spark):
    """Where vectors have structure, coarse levels leave few pairs; results stay exact."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 100, (20, 64)).repeat(2, axis=0)[:20]
    x = np.floor(centres[rng.integers(0, 20, 2000)] + rng.normal(0, 3, (2000, 64)))
    found, seen = search.best(np.arange(0, 2000, 50), x[::50], np.arange(2000), x, 5)
    # Coarse to fine: each level evaluates fewer pairs than the one before.
    counts = list(seen.values())
    assert list(seen) == [1, 4, 16, "exact"] and counts == sorted(counts, reverse=True) and len(set(counts)) == 4 and seen["exact"] < 0.1 * seen[1]
    for q in (0, 50, 100):
        scores = sorted(((-int(x[q] @ x[j]), j) for j in range(2000) if j != q))[:5]
        assert [(i, -s) for s, i in scores] == [(i, s) for a, i, s in found if a == q]


# --- language ----------------------------------------------------------------------------------------


def test_language(spark, docs):
    got = catalog.queries()["op6_language_id"](spark, DATA).collect()
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(got) == len(want)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) / len(held) > 0.95


def test_language_edges(spark, odd, empty, docs):
    model = language.train(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()}
    assert got[0] == got[1] == ("und", 0.0) and got[2][0] == "en" and got[4][0] != "und"
    digits = spark.createDataFrame([(1, "12 34 !?")], "doc_id long, text string")
    assert language.identify(digits, model).first()["lang_pred"] == "und"
    assert language.identify(empty, model).count() == 0
    nothing = language.train(empty)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
    assert language.train(odd)["langs"]


def test_language_long_texts_are_read_whole():
    """Scores of a text do not depend on where slices end."""
    model = {"langs": ["a", "b"], "logs": np.random.default_rng(0).normal(-5, 1, (language.BUCKETS, 2)).astype(np.float32), "prior": np.zeros(2)}
    text = "".join(random.Random(2).choices("abcdef ghij", k=5000))
    whole = sum(model["logs"].take(h, axis=0).sum(0, dtype=np.float64) for h in language.hashed(language.code_points(text)))
    old, language.SLICE = language.SLICE, 700
    try:
        names, p = language.score_batch([text], model)
    finally:
        language.SLICE = old
    e = np.exp(whole - whole.max())
    assert names == ["ab"[int(whole.argmax())]] and abs(p[0] - (e / e.sum()).max()) < 1e-9


def test_letters(spark, docs):
    """Superscripts, fractions and numerals are no letters."""
    assert [language.has_letter(t) for t in ("²³ ½ 12", "Ⅷ ①", "", None, "12 a", "漢", "_ 9")] == [False, False, False, False, True, True, False]


def test_sample_is_exact_and_never_empty(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("y"))
    assert language.sample(rows, "doc_id", "y", 300).count() == 300 and language.sample(rows, "doc_id", "y", 1).count() == 1
    assert language.sample(rows, "doc_id", "y", 9000).count() == rows.filter(~language.held_out()).count()
    hot = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    for most in (10, 5000, 9000):
        cut = cut_below(hot, F.col("k"), most)
        kept, ties = hot.filter(F.col("k") < cut).count(), hot.filter(F.col("k") <= cut).count()
        assert kept <= most < ties


def test_language_by_plain_counting(spark):
    """Naive Bayes by dictionaries of buckets gives the same predictions and scores."""
    rng = random.Random(6)
    letters = {"aa": "abcdef gh", "bb": "abcxyz ij", "cc": "mnopq rst"}
    rows = [(i, "".join(rng.choices(letters[lang], k=rng.randint(1, 40))), lang) for i in range(200) for lang in [rng.choice(sorted(letters))]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(df, language.train(df)).collect()}

    def grams(text):
        points = list(map(ord, text.lower()))
        for n, order in enumerate(language.ORDERS):
            for i in range(len(points) - order + 1):
                h = (n + 1) * 374761393 & 0xFFFFFFFF
                for k in range(order):
                    h = ((h ^ points[i + k]) * int(language._multipliers[k])) & 0xFFFFFFFF
                    h ^= h >> 15
                yield h % language.BUCKETS

    count, docs_ = {x: {} for x in letters}, dict.fromkeys(letters, 0)
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            docs_[lang] += 1
            for g in grams(text):
                count[lang][g] = count[lang].get(g, 0) + 1
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        logs = {x: np.log(docs_[x] / sum(docs_.values())) + sum(np.log((count[x].get(g, 0) + 0.5) / (sum(count[x].values()) + 0.5 * language.BUCKETS)) for g in grams(text)) for x in sorted(letters)}
        top = max(logs, key=logs.get)
        assert got[i][0] == top and abs(got[i][1] - 1 / sum(np.exp(v - logs[top]) for v in logs.values())) < 1e-3


# --- near duplicates ----------------------------------------------------------------------------------


def sets_of(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k):
    """Sizes and smallest reachable ids by comparing all pairs."""
    sets = {i: sets_of(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if min(len(sets[i]), len(sets[j])) * 100 < 80 * max(len(sets[i]), len(sets[j])) or find(i) == find(j):
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def family(rng, size, edits, start, vocabulary):
    """Copies of one text, each with some words replaced."""
    base_ = [rng.choice(vocabulary) for _ in range(120)]
    out = []
    for i in range(size):
        w = base_[:]
        for _ in range(rng.randint(*edits)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append((start + i, " ".join(w)))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, docs, k):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows += family(rng, 120, (0, 12), 10_000, vocabulary) + family(rng, 60, (3, 9), 20_000, vocabulary) + [(30_000 + i, "just the same words") for i in range(40)]
    rows += [(40_000, None), (40_001, ""), (40_002, " \n"), (40_003, "one"), (40_004, "ONE "), (40_005, "a b c")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicate_edges(spark, odd, empty):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == odd.count() and {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, None: None}
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]
    assert neardup.near_duplicates(empty).count() == 0
    # One id with two texts: each row goes with its text; a row without an id gives way to one with an id.
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "u v w x y z"), (5, "U V W X Y Z"), (6, "a b c d e f"), (None, "a b c d e f"), (None, "p q"), (None, "P Q")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(rows, k=2).filter("component_id IS NOT NULL").collect())
    assert got == [(0, 5, 1, False), (1, 5, 1, True), (1, 5, 1, True), (5, 5, 1, False), (6, 5, 1, False)]
    assert neardup.near_duplicates(rows, k=2).filter("component_id IS NULL AND kept").count() == 2


def joined_rows(spark, texts):
    rows = spark.createDataFrame(texts, "id long, t string")
    pairs = rows.filter("id > 0").select(F.lit(0).cast("long").alias("hub"), "id")
    scratch = Scratch(spark, "test")
    tested = scratch.put(neardup.against_hubs(pairs, rows, 1))
    sure, joined = neardup.member_candidates(neardup.centred(tested, scratch))
    return tested.filter("linked").count(), sure.count(), joined.count(), neardup.between_members(tested, scratch)


def test_families_do_not_join_all_pairs(spark):
    """Members at 0.69 of their hub: with a part of the hub's own that all lack, and with words replaced anywhere."""
    base_, rng = [f"b{i}" for i in range(800)], random.Random(5)
    for m in (100, 200):
        own = [(0, " ".join([*base_, *[f"h{i}" for i in range(180)]]))] + [(i, " ".join([*base_, *[f"m{i}x{j}" for j in range(180)]])) for i in range(1, m + 1)]
        replaced = [(0, " ".join(base_))]
        for i in range(1, m + 1):
            w = base_[:]
            for p in rng.sample(range(800), 150):
                w[p] = f"q{i}x{p}"
            replaced.append((i, " ".join(w)))
        # A cluster that its hub does not connect is connected by one link a member.
        apart = [(0, own[0][1])] + [(i, " ".join([*base_[i % 7 :], *[f"c{j}" for j in range(180)]])) for i in range(1, m + 1)]
        assert joined_rows(spark, own)[:3] == (0, 0, 0) and joined_rows(spark, replaced)[:3] == (0, 0, 0)
        linked, sure, joined, links = joined_rows(spark, apart)
        assert linked == 0 and m - 1 <= sure + joined <= 3 * m
        graph = neardup.components(links, Scratch(spark, "test"))
        assert graph.select("component").distinct().count() == 1 and graph.count() == m - 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in neardup.components(links, Scratch(spark, "test")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent if find(x) != x}


# --- toxicity ------------------------------------------------------------------------------------------


def toxic_rows(n, seed):
    rng = random.Random(0)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(400)]
    rng, rows = random.Random(seed), []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["scumbag", "moronic", "idiotic"]) + rng.choice(["", "s", "ly"])
        rows.append((" ".join(w), int(bad)))
    return rows


def test_toxicity_learns_subwords():
    rows = toxic_rows(900, 1)
    scorer = toxicity.Scorer(toxicity.compiled(toxicity.fit([t for t, _ in rows], np.array([y for _, y in rows], float))))
    fresh = toxic_rows(300, 2)
    assert np.mean([(scorer.score(t) >= toxicity.THRESHOLD) == bool(y) for t, y in fresh]) > 0.97
    filler = " ".join(rows[1][0].split()[:30])
    assert scorer.score(filler + " scumbagz " + filler) >= toxicity.THRESHOLD  # a misspelling not seen in training
    assert 0 <= scorer.score("") < toxicity.THRESHOLD


def test_toxicity_by_a_plain_forward_pass():
    """Scores are the softmax of the average of a window's word vectors, each the average of its n-grams' vectors."""
    rows = toxic_rows(200, 3)
    model = toxicity.fit([t for t, _ in rows], np.array([y for _, y in rows], float))
    scorer = toxicity.Scorer(toxicity.compiled(model))
    for text in [t for t, _ in rows[:40]] + ["one", "a b c d e f g h i j", "a b c d e f g h i j k", "Scumbag, 'moronic'!"]:
        vectors = [np.mean([model["e"][g] for g in toxicity.subwords(w.strip(toxicity.STRIP))], axis=0) for w in text.lower().split()]
        odds = []
        for start in [s for s in range(0, len(vectors), toxicity.STRIDE) if s + toxicity.WINDOW < len(vectors)] + [max(0, len(vectors) - toxicity.WINDOW)]:
            logits = np.mean(vectors[start : start + toxicity.WINDOW], axis=0) @ model["v"] * toxicity.WINDOW + model["b"]
            p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
            odds.append(np.log(p[1] / p[0]))
        want = 1 / (1 + np.exp(-(model["slope"] * max(odds) + model["offset"])))
        assert abs(scorer.score(text) - want) < 1e-6


def test_toxicity_does_not_depend_on_the_place():
    """A passage is read whole wherever it starts."""
    rows = toxic_rows(600, 1)
    scorer = toxicity.Scorer(toxicity.compiled(toxicity.fit([t for t, _ in rows], np.array([y for _, y in rows], float))))
    clean = [w for t, y in rows if not y for w in t.split()][:200]
    scores = [scorer.score(" ".join([*clean[:at], "scumbag", "moronic", *clean[at:]])) for at in range(20, 60)]
    assert min(scores) >= toxicity.THRESHOLD > scorer.score(" ".join(clean))


def test_toxicity_query(spark, docs):
    rows = catalog.queries()["op8_toxicity"](spark, DATA).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_toxicity_edges(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 1), (4, 0), (5, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.flag(odd, labels)
    assert scored.count() == odd.count() and scored.columns == [*odd.columns, "toxicity"]
    assert toxicity.flag(odd, labels.filter("false")).filter("toxicity != 0").count() == 0
    assert toxicity.flag(empty, labels).count() == 0
    clash = toxicity.flag(odd.withColumn("toxicity", F.lit("old")), labels)
    assert clash.columns == [*odd.columns, "toxicity"] and dict(clash.dtypes)["toxicity"] == "double"


# --- BPE -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(bpe.default_path())
    made.no_truncation()
    made.no_padding()
    return made


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(b"".join(struct.pack("<I", i) for i in ids)).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


TRICKY = [
    "", " ", "Hello World don't  L'heure", "ΑΣ ΣΑΣ ὈΔΥΣΣΕΎΣ", "éa İstanbul ß ﬁ Ⅷ ½ 漢字 が", "a<|endoftext|>b <|startoftext|>x <|ENDOFTEXT|> <|endoftext", "x\x1cy\x1d z\x00w​q r\x85s t",
    "\U0001f600\U0001f601 \U0001f469‍\U0001f469 ok", "!!!???...''''s 's't 'S'T a'reb", "a" * 5000, "ab" * 3000 + "1" * 100, "﻿hi", "́x", "नमस्ते", "Ǆ ǅ ꙀꙂ \U00010400 \U0001f170",
]


def test_bpe_tricky(spark, reference_tokenizer, odd, empty):
    rng = random.Random(3)
    cases = TRICKY + ["".join(rng.choices("abc ABC'12é́ΣσİI\t\n .,!<|endoftext>漢\U0001f600", k=rng.randint(1, 60))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode(rows).collect()}
    assert got == {i: expected(reference_tokenizer, t) for i, t in enumerate(cases)}
    strange = {r["doc_id"]: r["n_tokens"] for r in bpe.encode(odd).collect()}
    assert strange[0] == strange[1] == 0 and bpe.encode(odd).count() == odd.count() and bpe.encode(empty).count() == 0


def test_bpe_query(spark, reference_tokenizer, texts):
    for r in catalog.queries()["op9_bpe_encoding_and_decoding"](spark, DATA).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(reference_tokenizer, texts[r["doc_id"]])


def test_lexicon():
    words = {w.encode(): [i, 7 * i] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "é", "zebra"])} | {b"x": []}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    assert {w: lexicon.find(w) for w in words} == words
    assert [lexicon.find(w) for w in (b"", b"ta", b"tapss", b"q", b"zebras")] == [None] * 5
    # Suffixes are shared: fewer states than a trie has.
    assert len(lexicon.final) < 1 + len({w[:i] for w in words for i in range(1, len(w) + 1)})
    assert bpe.Lexicon(bpe.compile_lexicon({})).find(b"a") is None


def test_frequent_chunks(spark):
    """Ties at the edge are taken up to the bound, and large counts are no exception."""
    rows = spark.createDataFrame([(1, "a b c a b c d")], "doc_id long, text string")
    assert len(bpe.frequent(rows, top=2)) == 2 and {n for _, n in bpe.frequent(rows, top=2)} == {2}
    assert bpe.frequent(rows, top=3) == [("a", 2), ("b", 2), ("c", 2)] and len(bpe.frequent(rows, top=9)) == 4
    many = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(6)) + " ") for i in range(3)], "doc_id long, text string").selectExpr("doc_id", "repeat(text, 30000) AS text")
    assert [n for _, n in bpe.frequent(many, top=4)] == [90_000] * 4
    assert bpe.frequent(rows.filter("false")) == []


def test_bpe_clashing_columns(spark):
    got = bpe.encode(spark.createDataFrame([(1, "Hi there", "old")], "doc_id long, text string, n_tokens string"), ids=False)
    assert got.columns == ["doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"] and got.first()["n_tokens"] == 2


# --- pipeline ------------------------------------------------------------------------------------------


def test_pipeline(spark, docs, reference_tokenizer):
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "bpe"]
    now, scratch, kept = docs, Scratch(spark, "test"), {}
    for name, stage in pipeline.STAGES[:4]:
        now = scratch.put(stage(spark, now, DATA))
        assert now.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in now.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept["near_duplicates"]) <= set(kept["toxicity"]) <= set(texts)
    want = brute_components(list(kept["toxicity"].items()), 5)
    assert set(kept["near_duplicates"]) == {i for i, (_, c) in want.items() if c == i}
    assert set(kept["personal_data"]) == set(kept["near_duplicates"])
    assert not any("@mail" in t for t in kept["personal_data"].values())
    final = pipeline.STAGES[4][1](spark, now, DATA).collect()
    rows = [(r["doc_id"], *expected(reference_tokenizer, r["text"])) for r in now.collect()]
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in final) == sorted(rows)


def test_pipeline_on_odd_rows(spark, odd, empty, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([(1, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for source in (odd, empty):
        now, scratch, ids = source.select(*pipeline.COLUMNS), Scratch(spark, "test"), {}
        for name, stage in pipeline.STAGES:
            now = scratch.put(stage(spark, now, str(tmp_path)))
            ids[name] = sorted(str(r["doc_id"]) for r in now.select("doc_id").collect())
        if source is empty:
            assert not any(ids.values())
            continue
        # Nothing is known to be toxic; of the copies 4, 5 and 6 one stays; texts without words are never taken.
        assert ids["toxicity"] == sorted(str(r["doc_id"]) for r in odd.collect())
        assert ids["near_duplicates"] == ids["personal_data"] == sorted(map(str, [0, 1, 2, 3, 3, 4, 7, 8, None]))
        assert set(ids["mixing"]) == {"2", "3", "4", "7", "8", "None"} and ids["bpe"] == ids["mixing"]


def test_full_sets_decide_links(spark):
    words = [f"w{i}" for i in range(20)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[1:], "x"])), (3, " ".join([*words[5:], "x"]))], "id long, t string")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "hub long, id long")
    assert {r["id"]: r["linked"] for r in neardup.against_hubs(pairs, texts, 1).collect()} == {2: True, 3: False}
