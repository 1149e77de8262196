"""PII, fingerprints, license scans and mixing against plain Python versions."""

import hashlib
import math
import random
import re
import unicodedata
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm import catalog, fingerprints, licenses, mixing, pii
from tessera.llm.common import Scratch

from .conftest import DATA

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


NASTY = [
    "a@b.c@d.e a@b.c_x@d.e a@b a@@b.c x@y.z.", "1.2.3.4.5.6.7.8 001.002.003.0255 256.1.1.1 1.2.3 00000000000255.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111 4111 1111 1111 1112 41111111111111111111111",
    "+1 (212) 555-0100 +12 +1...... ++49 30 1234567 +1+2 345 678 90", "1" * 3000 + "." + "a" * 3000 + "@" + "b." * 2000 + "c", "é4111 1111 1111 1111 \U0001f600 x@y.example", "\n\t+49 (30) 12-34.56\n", "٣.٣.٣.٣ 1.1.1.1",
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark)


def test_pii_base(spark, model, texts):
    cases = dict(enumerate(NASTY, 10_000)) | texts
    rows = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    for r in pii.detect(rows, model=model).select("doc_id", "base", "spans").collect():
        want = base(cases[r["doc_id"]])
        assert [f"{s['kind']}:{s['s']}:{s['e']}" for s in r["base"]] == want
        assert set(want) <= {f"{s['kind']}:{s['s']}:{s['e']}" for s in r["spans"]}


def test_pii_added(spark, model):
    held = model["held"]
    for k, kind in enumerate(pii.KINDS):
        mine, keep = held & (model["x"][:, 0] == k), model["p"] >= model["limits"][kind]
        assert model["y"][mine & keep].mean() >= pii.PRECISION and keep[mine & (model["y"] == 1)].mean() > 0.75
    cases = ["Please call (212) 555-0100 today", "write to jane.roe(at)mail[dot]org please", "see version 3.14.159 of the build", "the score was 10:12:33 at last", 'the token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6" here', "in IMG_20240512_101500 we see"]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: [cases[r["doc_id"]][s["s"] : s["e"]] for s in r["spans"]] for r in pii.detect(rows, model=model).collect()}
    assert got == {0: ["(212) 555-0100"], 1: ["jane.roe(at)mail[dot]org"], 2: [], 3: [], 4: ["0b96a8c8d79c4a5085c919698889f59b72ab7bb6"], 5: []}


def test_pii_planted_in_documents(spark, model, texts):
    """Held-out templates put into real texts: precision and recall of what is added."""
    rng, made, rows, want = random.Random(77), pii.templates(), [], {}
    for i, d in enumerate(sorted(texts)):
        words_, kind, label = (texts[d] or "").split(" ")[:300], pii.KINDS[i % 5], i // 5 % 2
        at, made_ = rng.randrange(len(words_) + 1), rng.choice(made[kind, label][2::3])(rng)
        start = len(" ".join(words_[:at])) + (at > 0)
        rows.append((i, " ".join([*words_[:at], made_, *words_[at:]])))
        want[i] = (label, start, start + len(made_))
    got = {r["doc_id"]: r["spans"] for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    hits = {i: any(s["s"] < stop and start < s["e"] for s in got[i]) for i, (_, start, stop) in want.items()}
    right = [want[i][0] for i, hit in hits.items() if hit]
    assert sum(right) / len(right) > 0.93 and sum(right) / sum(label for label, _, _ in want.values()) > 0.9


def test_pii_selection(spark, model, texts):
    """The added spans are those of a plain greedy choice over all scored candidates."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(t for t in texts.values() if t)], "doc_id long, text string")
    chosen = {r["doc_id"]: r for r in pii.detect(rows, model=model).collect()}
    scored = rows
    for kind in pii.KINDS:
        scored = pii.located(scored, f"w_{kind}", "text", pii.WIDE[kind], pii.NEEDS[kind]).withColumn(f"f_{kind}", F.transform(f"w_{kind}", pii.of_kind(pii.features, kind)))
    for r in scored.collect():
        base_ = [(s["s"], s["e"]) for s in chosen[r["doc_id"]]["base"]]
        found = []
        for k, kind in enumerate(pii.KINDS):
            for c, f in zip(r[f"w_{kind}"], r[f"f_{kind}"], strict=True):
                p = 1 / (1 + math.exp(-(model["a"] * (model["start"] + sum(pii.value(t, f) for t in model["trees"])) + model["b"])))
                if p >= model["limits"][kind] and not any(c["s"] < e and s < c["e"] for s, e in base_):
                    found.append((-round(p, 6), k, c["s"], c["e"]))
        kept = []
        for _, k, s, e in sorted(found):
            if not any(s < y and x < e for _, x, y in kept):
                kept.append((k, s, e))
        mine = [(pii.KINDS.index(s["kind"]), s["s"], s["e"]) for s in chosen[r["doc_id"]]["spans"] if s["p"] < 1 or (s["s"], s["e"]) not in base_]
        assert sorted(mine) == sorted(kept)


def test_pii_clashing_columns(spark, model):
    got = pii.detect(spark.createDataFrame([(1, "x@y.example", "old", 7)], "doc_id long, text string, base string, spans int"), model=model)
    assert sorted(got.columns) == ["base", "doc_id", "spans", "text"] and len(got.first()["base"]) == 1


def test_pii_redact(spark, model, odd, empty):
    got = {r["doc_id"]: r for r in pii.redact(odd, model=model).collect()}
    assert got[3]["text"] == "mail me: [EMAIL] or [PHONE]" and got[0]["text"] is None and got[1]["text"] == "" and got[8]["text"] == "é" * 10 + " \U0001f600 ok"
    assert pii.redact(odd, model=model).count() == odd.count() and pii.redact(empty, model=model).count() == 0


def test_pii_query(spark, texts):
    for r in catalog.queries()["op1_pii"](spark, DATA).collect():
        want = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]


def canonical(text):
    import regex

    norm = lambda s: unicodedata.normalize("NFKC", s)
    return regex.sub(r"[\s\x1c-\x1f\x85\p{Z}﻿]+", " ", norm(norm(text or "").casefold())).strip(" ")


def test_fingerprints(spark, texts):
    rows = {r["doc_id"]: r for r in catalog.queries()["op3_document_fingerprints"](spark, DATA).collect()}
    order = sorted(texts, reverse=True)
    prints = {}
    for i, d in enumerate(order):
        text, after, r = texts[d], texts[order[(i + 1) % len(order)]], rows[d]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == float(canonical(text) == canonical(edited)) and r["near_next"] == float(canonical(text) == canonical(after))
        assert prints.setdefault(canonical(text), r["fingerprint"]) == r["fingerprint"]
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (r["near_edited"] == 1)
    assert len(set(prints.values())) == len(prints)


def test_fingerprint_edges(spark, odd, empty):
    got = [(r["doc_id"], r["fingerprint"]) for r in fingerprints.fingerprint(odd).collect()]
    by = dict(got)
    assert len(got) == odd.count() and by[4] == by[5] == by[6] and by[0] == by[1] and by[2] != by[3]
    assert fingerprints.fingerprint(empty).count() == 0 and fingerprints.compare_edited(empty).count() == 0
    assert fingerprints.compare_edited(odd.filter("doc_id IS NOT NULL")).count() == odd.count() - 1
    groups = {r["first_id"]: r["n_rows"] for r in fingerprints.exact_groups(odd).collect()}
    assert groups[4] == 3 and groups[3] == 2


def test_colliding_bytes_are_told_apart(spark):
    forms = spark.createDataFrame([("h", "a"), ("h", "b"), ("h", "a"), ("i", "c")], "__fp_hash string, __fp_form string")
    assert {(r["__fp_form"], r["__fp_ordinal"]) for r in fingerprints.collisions(forms).collect()} == {("a", 0), ("b", 1)}


def test_collisions_end_to_end(spark, monkeypatch):
    """With a hash that says little, fingerprints are equal exactly where canonical bytes are."""
    monkeypatch.setattr(fingerprints, "wide_hash", lambda form: F.concat(F.lit("h"), (F.length(form) % 3).cast("string")))
    rows = [(i, t) for i, t in enumerate(["alpha beta", "ALPHA  beta", "gamma", "", None, "delta ab", "x", "xy", "yx", "longer text of it"])] + [(3, "another of id three"), (3, "")]
    got = fingerprints.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (-r[0], r[1]))
    forms = {}
    seen = sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in got)
    assert len(seen) == len(rows)
    by_sha = {}
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        by_sha.setdefault((d, len(t), hashlib.sha256(edited.encode()).hexdigest()), []).append((canonical(t), canonical(edited)))
    for d, n, sha, mark, edited_mark in seen:
        form, edited_form = by_sha[d, n, sha][0]
        assert forms.setdefault(form, mark) == mark and forms.setdefault(edited_form, edited_mark) == edited_mark
    assert len(set(forms.values())) == len(forms)


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def licenses_of(text):
    w = words(text)
    found = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_licenses(spark, docs, odd, empty):
    extra = spark.createDataFrame(
        [(90_001, "CC BY NC cc by nc by nc under the mit license under the MIT License!"), (90_002, "apache license version 20 apache license, version 2"), (90_003, "cc by"), (90_004, "cc by nc"), (90_005, "x " * 70_000 + "cc by nc")],
        "doc_id long, text string",
    )
    every = docs.select("doc_id", "text").unionByName(extra).unionByName(odd.select("doc_id", "text").filter("doc_id IS NULL OR doc_id != 3"))
    want = sorted(repr((r["doc_id"], *licenses_of(r["text"]))) for r in every.collect())
    got = licenses.scan(every).collect()
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in got) == want
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0


def test_license_text_with_edits(spark):
    whole = "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files"
    rows = spark.createDataFrame([(1, whole), (2, whole.replace("hereby granted", "now given")), (3, "permission is hereby granted. nothing else here at all")], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["n_base"]) for r in licenses.scan(rows).collect()}
    assert got == {1: ("mit", 0), 2: ("mit", 0), 3: ("", 0)}


def water_fill(sizes, weights):
    """Targets of sources by weight, stopped at twice their size, the excess shared out again."""
    left, targets, free = Fraction(3, 2) * sum(sizes), [Fraction(0)] * len(sizes), set(range(len(sizes)))
    while free:
        unit = left / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * unit > 2 * sizes[i]}
        for i in full or free:
            targets[i] = Fraction(2 * sizes[i]) if full else weights[i] * unit
        if not full:
            break
        left -= sum(targets[i] for i in full)
        free -= full
    return targets


@pytest.mark.parametrize("sizes", [[100, 50, 10, 200], [1, 10_000_000, 3, 0, 500, 7], [5], [0, 0], []])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(i, s, (5, 2, 1)[i % 3]) for i, s in enumerate(sizes)], "number long, source_size long, weight int")
    got = {r["number"]: (r["target"], r["take"]) for r in mixing.targets(rows).collect()}
    want = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert got == {i: (float(t), min(2 * sizes[i], int(t + Fraction(1, 2)))) for i, t in enumerate(want)}


def check_mix(rows, documents):
    sizes, total = {}, {}
    for r in documents:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, water_fill([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    of = {r["doc_id"]: r["source"] for r in documents}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert abs(r["target"] - float(target[of[r["doc_id"]]])) < 1e-6
        total[of[r["doc_id"]]] = total.get(of[r["doc_id"]], 0) + r["taken"]
    for s in order:
        assert abs(total[s] - float(target[s])) <= 1


def test_mixing(spark, docs):
    query = catalog.queries()["op10_mixing"]
    rows = query(spark, DATA).collect()
    assert len(rows) == docs.count()
    check_mix(rows, docs.collect())
    assert sorted(map(tuple, query(spark, DATA).collect())) == sorted(map(tuple, rows))


def test_mixing_edges(spark, odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    check_mix(rows, odd.collect())
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    assert mixing.mix(odd.filter("doc_id <= 1")).agg(F.sum("taken")).first()[0] == 0
    mixed = mixing.apply_mix(odd)
    assert mixed.columns == odd.columns
    words_out = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert words_out == sum(r["taken"] for r in rows)


def slots_of(spark, takes, sizes, block, **order):
    plan = spark.createDataFrame(list(zip(range(len(takes)), takes, sizes, strict=True)), "number long, take long, line long")
    rows, n = mixing.schedule(plan, block, Scratch(spark, "test"), **order)
    got = sorted(rows.collect(), key=lambda r: r["slot"])
    assert len(got) == n == len({r["slot"] for r in got}) == len({(r["number"], r["turn"], r["block"]) for r in got})
    return got


def test_schedule_takes_targets_to_the_word(spark):
    sizes = [30_000_000, 9_000_000, 4_000_000, 12_000_000, 100, 1000, 3000, 1]
    takes = [int(t + Fraction(1, 2)) for t in water_fill(sizes, [5, 2, 1, 5, 2, 1, 5, 2])]
    assert takes[4:] == [200, 2000, 6000, 2]
    got = slots_of(spark, takes, sizes, -(-sum(takes) // 5000))
    assert [sum(r["words"] for r in got if r["number"] == i) for i in range(len(sizes))] == takes
    assert len(got) <= 5000 + 3 * len(sizes) and all(r["words"] > 0 for r in got)


def test_every_prefix_is_near_its_weights(spark):
    takes, sizes, block = [50_000, 20_000, 10_000, 700], [60_000, 15_000, 9000, 500], 100
    got = slots_of(spark, takes, sizes, block)
    seen, done = [0] * 4, 0
    for r in got:
        seen[r["number"]] += r["words"]
        done += r["words"]
        assert all(abs(s - done * t / sum(takes)) <= 6 * block for s, t in zip(seen, takes, strict=True))


def test_the_sequence_decides_the_order(spark, docs):
    plain = lambda cell, bits: cell  # one source after the other
    assert [r["number"] for r in slots_of(spark, [500, 500], [500, 500], 10, order=plain)] == [0] * 50 + [1] * 50
    one = mixing.apply_mix(docs, slot=True).collect()
    other = mixing.apply_mix(docs, slot=True, order=plain).collect()
    key = lambda r: (r["doc_id"], r["text"])
    assert sorted(map(key, one)) == sorted(map(key, other)) and list(map(key, one)) != list(map(key, other))
    # Rows come in the order of slots, and sources alternate from the start.
    assert [r["mix_slot"] for r in one] == sorted(r["mix_slot"] for r in one)
    sources = docs.select("source").distinct().count()
    assert len({r["source"] for r in one[: len(one) // 4]}) == sources > len({r["source"] for r in other[: len(other) // 4]})


def test_pii_dropped_span_drops_none(spark):
    """A phone touched by a better card that an email drops stays."""
    by_kind = {"start": 0.0, "trees": [(0, 0, 3.0, (0, 2, 2.0, 1.0))], "a": 1.0, "b": 0.0, "limits": dict.fromkeys(pii.KINDS, 0.5)}
    rows = spark.createDataFrame([(1, "(21) 555-0100 1234.5678 at x dot org"), (2, "(21) 555-0100 1234.5678")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(rows, model=by_kind).collect()}
    assert got == {1: "[PHONE] [EMAIL]", 2: "(21) [CARD]"}
