"""Translation as an incremental, batched enrichment of units.

pending = units without memory (left anti join); numbered batches; a pluggable
translator called once per batch in ``mapInPandas``; validated results and failure rows.
The default translator is a deterministic offline stub.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import text as T
from ..workers import ship

ship(__name__)

# Plain values, not modules: functions that go to executors must not need the package there.
RETRIES, TAG = K.RETRIES, T.TAG


class Translator(Protocol):
    """What a model provider must offer; ``unwrap``, ``pricing``, ``unsupported_json_mode`` and ``unsupported_param`` are optional."""

    def request(self, items: list[dict], lang: str, temperature: float, mode: str, dropped: frozenset) -> tuple[int, Any]:
        """Send items (id, text, el); returns (status, body). Status 0 is a network error."""

    def parse(self, body: Any) -> dict:
        """Normalise a body to {text, usage: {in, out}, retryable, detail}."""


class OfflineTranslator:
    """Marks a text with its language; placeholders stay as they are. Needs no network."""

    def request(self, items, lang, temperature=0.2, mode="schema", dropped=frozenset()):
        rows = [{"id": i["id"], "text": f"[{lang}] {i['text']}"} for i in items]
        return 200, {"rows": rows, "in": sum(len(i["text"].split()) for i in items), "out": sum(len(r["text"].split()) for r in rows)}

    def parse(self, body):
        return {"text": json.dumps(body["rows"], ensure_ascii=False), "usage": {"in": body["in"], "out": body["out"]}, "retryable": False, "detail": None}


def load_translator(name: str) -> Translator:
    """A translator from an import string ``module:attribute``; it must have request and parse."""
    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute)()
    missing = [m for m in ("request", "parse") if not callable(getattr(found, m, None))]
    if missing:
        raise TypeError(f"{name} lacks {', '.join(missing)}")
    return found


def backoff_ms(attempt: Column) -> Column:
    """Wait before a retry: 2^attempt seconds, 30 at most."""
    return F.least(F.pow(F.lit(2), attempt) * 1000, F.lit(30_000.0)).cast("long")


def wait_s(attempt: int) -> float:
    return min(2.0**attempt, 30.0)


#: Reply formats from the strictest to the loosest.
LADDER = ("schema", "object", "none")


@dataclass
class Call:
    """The outcome of one batch: rows by id, usage, and errors by id."""

    rows: dict[int, str] = field(default_factory=dict)
    errors: dict[int, str] = field(default_factory=dict)
    tokens_in: int = 0
    tokens_out: int = 0


def call_model(translator: Translator, items: list[dict], lang: str, sleep: Callable[[float], None] = time.sleep) -> Call:
    """Send a batch; retry, step down the reply formats, drop a refused parameter once, and halve what cannot be read.

    Network errors and statuses 429 and 5xx are retried up to RETRIES times. A reply that
    was cut, refused or is not JSON splits the batch at ceil(n / 2); a single unit that still
    fails is an error. Usage of a failed parent counts, save for refusals.
    """
    out, mode, dropped, attempt = Call(), 0, frozenset(), 0
    while True:
        status, body = translator.request(items, lang, 0.2 if attempt == 0 else 0.4, LADDER[mode], dropped)
        if status == 0 or status == 429 or status >= 500:
            attempt += 1
            if attempt > RETRIES:
                out.errors.update({i["id"]: f"status {status}" for i in items})
                return out
            sleep(wait_s(attempt))
            continue
        if status >= 400:
            refused_mode = getattr(translator, "unsupported_json_mode", lambda s, b: False)
            refused_param = getattr(translator, "unsupported_param", lambda s, b: None)
            if mode + 1 < len(LADDER) and refused_mode(status, body):
                mode += 1
                continue
            if (param := refused_param(status, body)) and not dropped:
                dropped = frozenset([param])
                continue
            out.errors.update({i["id"]: f"status {status}" for i in items})
            return out
        break
    reply = translator.parse(body)
    refusal = reply.get("detail") == "safety"
    if not refusal:
        out.tokens_in += reply["usage"]["in"]
        out.tokens_out += reply["usage"]["out"]
    try:
        rows = None if reply["retryable"] or refusal else json.loads(reply["text"])
        if not isinstance(rows, list):
            rows = None
    except (TypeError, ValueError):
        rows = None
    if rows is not None:
        known = {i["id"] for i in items}
        # The last row of a repeated id counts; rows of unknown ids do not.
        out.rows.update({r["id"]: r["text"] for r in rows if isinstance(r, dict) and r.get("id") in known})
        return out
    if len(items) == 1:
        out.errors[items[0]["id"]] = reply.get("detail") or "unreadable"
        return out
    middle = -(-len(items) // 2)
    for part in (items[:middle], items[middle:]):
        got = call_model(translator, part, lang, sleep)
        out.rows |= got.rows
        out.errors |= got.errors
        out.tokens_in += got.tokens_in
        out.tokens_out += got.tokens_out
    return out


def pending(units: DataFrame, memory: DataFrame) -> DataFrame:
    """Units without a translation."""
    return units.join(memory.select("hash"), "hash", "left_anti")


CELL = 100_000  # units that one task may sort


def prefix_of(rows: int) -> int:
    """Hex digits of the hash that cut so many units into cells of at most ``CELL`` on average; two at least."""
    digits = 2
    while rows > CELL * 16**digits:
        digits += 1
    return digits


def batches(units: DataFrame, size: int = K.BATCH, prefix: int = 2) -> DataFrame:
    """Number units within hash prefixes and cut them into batches of a fixed size.

    The numbering restarts per prefix, so no task sorts all units; only the last batch
    of each prefix may be smaller.
    """
    cell = F.left("hash", F.lit(prefix))
    rank = F.row_number().over(Window.partitionBy(cell).orderBy(F.desc("count"), "hash")) - 1
    return units.withColumn("slot", rank).withColumn("batch", F.concat(cell, F.lit("-"), F.floor(F.col("slot") / size).cast("string")))


def translate(units: DataFrame, lang: str, translator: Translator | None = None, size: int = K.BATCH, in_flight: int | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(hash, text, out, problem, tokens_in, tokens_out) of each unit; rejected units are sent again alone.

    Usage stands in the first row of a batch. With ``in_flight`` batches are dealt to so many
    partitions, which is the most calls that are open at once.
    """
    translator = translator or OfflineTranslator()
    rows = batches(units, size, prefix_of(units.count())).select("batch", "slot", "hash", "text", "el")
    if in_flight:
        rows = rows.repartition(in_flight, "batch")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot").reset_index(drop=True)
        items = [{"id": i, "text": t, "el": e} for i, (t, e) in enumerate(zip(pdf["text"], pdf["el"], strict=True))]
        got = call_model(translator, items, lang, sleep)
        problems: list[str | None] = []
        for item in items:
            i = item["id"]
            bad = None if i in got.errors else check(item["text"], got.rows.get(i))
            if bad:  # once more, alone
                again = call_model(translator, [item], lang, sleep)
                got.tokens_in += again.tokens_in
                got.tokens_out += again.tokens_out
                bad = check(item["text"], again.rows.get(i))
                got.rows[i] = again.rows.get(i)
            problems.append(got.errors.get(i) or bad)
        out = [got.rows.get(i["id"]) if p is None else None for i, p in zip(items, problems, strict=True)]
        usage = [[got.tokens_in, got.tokens_out]] + [[0, 0]] * (len(pdf) - 1)
        return pd.DataFrame({"hash": pdf["hash"], "text": pdf["text"], "out": out, "problem": problems, "tokens_in": [u[0] for u in usage], "tokens_out": [u[1] for u in usage]})

    return rows.groupBy("batch").applyInPandas(run, "hash string, text string, out string, problem string, tokens_in long, tokens_out long")


def check(source: str, out: str | None) -> str | None:
    """The row-level twin of ``functions.text.problem``."""
    import re

    if not (out or "").strip():
        return "empty"
    tags = lambda t: sorted(re.findall(TAG, t))
    return None if tags(source) == tags(out) else "placeholder-mismatch"


def upsert(memory: DataFrame, fresh: DataFrame) -> DataFrame:
    """The memory with new translations; an existing hash keeps its newest text."""
    return memory.join(fresh.select("hash"), "hash", "left_anti").unionByName(fresh.select("hash", "text"))


def system_prompt(lang: str, terms: Iterator[dict] = (), roles: Iterator[str] = ()) -> str:
    """Instructions for a model: the task, then terms and roles where there are any."""
    parts = [f"Translate every item into {lang}. Answer with a JSON list of objects with id and text, one per item.", "Keep each numbered tag exactly once, and add none."]
    listed = [f"- {t['source']}: " + ("leave as it is" if t["rule"] == "keep" else f"write {t['targets'][lang]}") for t in terms if t["rule"] == "keep" or lang in (t.get("targets") or {})]
    if listed:
        parts.append("Terms:\n" + "\n".join(listed))
    if named := sorted(set(roles)):
        parts.append("An item's el says what it is: " + ", ".join(named) + ".")
    return "\n\n".join(parts)
