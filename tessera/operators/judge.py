"""Judging translations with a model: choice of the judge, its instructions, and the calls."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..workers import ship
from . import translate
from .translate import Call, Translator

ship(__name__)


def choose(translator: str, providers: list[str], has_key: Callable[[str], bool], wanted: str | None = None) -> tuple[str, str | None]:
    """The judge's provider and a warning: the one asked for, else the first other one with a key, else the translator's own."""
    if wanted:
        return wanted, None
    other = next((p for p in providers if p != translator and has_key(p)), None)
    return (other, None) if other else (translator, "the judge is the model that translated; its score may flatter")


def prompt(language: str, terms: list[dict] = ()) -> str:
    """Instructions for a judge, with the terms that bind the translation."""
    bound = [f"- {t['source']}: " + ("stays as it is" if t["rule"] == "keep" else f"is {t['targets'][language]}") for t in terms if t["rule"] == "keep" or language in (t.get("targets") or {})]
    parts = [
        f"Review translations into {language}. For every item list its errors by category and severity; most items have none.",
        "Categories: " + ", ".join(K.CATEGORIES) + ". Severities: " + ", ".join(K.SEVERITY) + ".",
        "A numbered tag that is missing or changed is markup/placeholder and critical. A changed number is critical; another way of grouping digits is no error.",
        'Answer with a JSON list of objects with id and text; text is a JSON list of objects with c (category), s (severity) and n (note), "[]" where all is well.',
    ]
    return "\n\n".join(parts + (["Terms:\n" + "\n".join(bound)] if bound else []))


class OfflineJudge(translate.OfflineTranslator):
    """Finds the same error in every target that equals its source. Needs no network."""

    def request(self, items, lang, temperature=0.0, mode="schema", dropped=frozenset()):
        rows = []
        for i in items:
            source, _, target = i["text"].removeprefix("SOURCE: ").partition("\nTARGET: ")
            rows.append({"id": i["id"], "text": json.dumps([{"c": "accuracy/untranslated", "s": "major", "n": ""}] if source == target else [])})
        return 200, {"rows": rows, "in": sum(len(i["text"].split()) for i in items), "out": len(rows)}


def judge(pairs: DataFrame, lang: str, model: Translator | None = None, size: int = K.JUDGE_BATCH, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(hash, words, raw, errors, unreadable, tokens_in, tokens_out) of pairs (hash, source, target, count).

    Each batch is one call with the retries, reply formats and halving of translation. Items that
    the model left out or answered unreadably are no clean ones: errors is null and unreadable true.
    """
    model = model or OfflineJudge()
    rows = translate.batches(pairs, size, translate.prefix_of(pairs.count())).select("batch", "slot", "hash", "source", "target")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot").reset_index(drop=True)
        items = [{"id": i, "text": f"SOURCE: {s}\nTARGET: {t}", "el": None} for i, (s, t) in enumerate(zip(pdf["source"], pdf["target"], strict=True))]
        got: Call = translate.call_model(model, items, lang, sleep)
        raw = [got.rows.get(i) for i in range(len(items))]
        usage = [[got.tokens_in, got.tokens_out]] + [[0, 0]] * (len(items) - 1)
        return pd.DataFrame({"hash": pdf["hash"], "source": pdf["source"], "raw": raw, "tokens_in": [u[0] for u in usage], "tokens_out": [u[1] for u in usage]})

    asked = rows.groupBy("batch").applyInPandas(run, "hash string, source string, raw string, tokens_in long, tokens_out long")
    errors = T.parse_errors(F.col("raw"))
    return asked.select("hash", T.word_count(F.col("source")).alias("words"), "raw", errors.alias("errors"), errors.isNull().alias("unreadable"), "tokens_in", "tokens_out")
