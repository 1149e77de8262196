"""Adapters between the engine's calls and the wire formats of model services.

An adapter makes (url, headers, body) of a request and reads a reply into text, usage and whether
the batch is to be split. The transport is a function, so calls can be recorded and replayed; the
default one is the standard library's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from ..workers import ship

ship(__name__)

Transport = Callable[[str, dict, bytes], tuple[int, str]]


def urllib_transport(url: str, headers: dict, body: bytes) -> tuple[int, str]:
    """POST; status 0 is a network error."""
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, body, headers), timeout=120) as reply:
            return reply.status, reply.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as error:
        return error.code, error.read().decode("utf-8", "replace")
    except OSError:
        return 0, ""


# Addresses, names of keys and of fields, as the services document them.
SERVICES = {
    "anthropic": {"url": "https://api.anthropic.com/v1/messages", "keys": ["ANTHROPIC_API_KEY"], "version": "2023-06-01"},
    "gemini": {"url": "https://generativelanguage.googleapis.com/v1beta/models/{model}:generateContent", "keys": ["GEMINI_API_KEY", "GOOGLE_API_KEY"]},
    "openai": {"url": "https://api.openai.com/v1/chat/completions", "keys": ["OPENAI_API_KEY"]},
}


@dataclass
class HttpTranslator:
    """A translator behind one of ``SERVICES``; ``system`` gives the instructions for a language."""

    service: str
    model: str
    key: str | None
    system: Callable[[str], str]
    transport: Transport = urllib_transport
    base_url: str | None = None
    most_tokens: int = 8192

    def request(self, items, lang, temperature=0.2, mode="schema", dropped=frozenset()):
        asked = json.dumps([{k: i[k] for k in ("id", "text", "el") if i.get(k) is not None} for i in items], ensure_ascii=False)
        url = (self.base_url or SERVICES[self.service]["url"]).replace("{model}", self.model)
        headers, body = getattr(self, f"_{self.service}")(self.system(lang), asked, mode)
        if "temperature" not in dropped:
            (body.setdefault("generationConfig", {}) if self.service == "gemini" else body)["temperature"] = temperature
        return self.transport(url, {"content-type": "application/json"} | headers, json.dumps(body, ensure_ascii=False).encode())

    def _anthropic(self, system, asked, mode):
        return {"x-api-key": self.key or "", "anthropic-version": SERVICES["anthropic"]["version"]}, {"model": self.model, "max_tokens": self.most_tokens, "system": system, "messages": [{"role": "user", "content": asked}]}

    def _gemini(self, system, asked, mode):
        config = {"maxOutputTokens": self.most_tokens} | ({"responseMimeType": "application/json"} if mode != "none" else {})
        return {"x-goog-api-key": self.key or ""}, {"systemInstruction": {"parts": [{"text": system}]}, "contents": [{"role": "user", "parts": [{"text": asked}]}], "generationConfig": config}

    def _openai(self, system, asked, mode):
        item = {"type": "object", "properties": {"id": {"type": "integer"}, "text": {"type": "string"}}, "required": ["id", "text"], "additionalProperties": False}
        schema = {"type": "object", "properties": {"items": {"type": "array", "items": item}}, "required": ["items"], "additionalProperties": False}
        forms = {"schema": {"type": "json_schema", "json_schema": {"name": "items", "strict": True, "schema": schema}}, "object": {"type": "json_object"}}
        body = {"model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": asked}]}
        return {"authorization": f"Bearer {self.key or ''}"}, body | ({"response_format": forms[mode]} if mode in forms else {})

    def parse(self, body):
        """text, usage, and whether the batch must be split: a reply that was cut, or refused (detail ``safety``)."""
        try:
            reply = json.loads(body)
        except ValueError:
            return {"text": None, "usage": {"in": 0, "out": 0}, "retryable": True, "detail": "unreadable"}
        text, why, tokens = getattr(self, f"_read_{self.service}")(reply)
        detail = "safety" if why in ("refusal", "SAFETY", "PROHIBITED_CONTENT", "BLOCKLIST", "content_filter") else "truncated" if why in ("max_tokens", "MAX_TOKENS", "length") else None
        return {"text": unwrapped(text), "usage": {"in": tokens[0] or 0, "out": tokens[1] or 0}, "retryable": detail is not None or not text, "detail": detail}

    @staticmethod
    def _read_anthropic(reply):
        usage = reply.get("usage") or {}
        return "".join(p.get("text", "") for p in reply.get("content") or [] if p.get("type") == "text"), reply.get("stop_reason"), (usage.get("input_tokens"), usage.get("output_tokens"))

    @staticmethod
    def _read_gemini(reply):
        first, usage = (reply.get("candidates") or [{}])[0], reply.get("usageMetadata") or {}
        why = first.get("finishReason") or (reply.get("promptFeedback") or {}).get("blockReason")
        return "".join(p.get("text", "") for p in (first.get("content") or {}).get("parts") or []), why, (usage.get("promptTokenCount"), usage.get("candidatesTokenCount"))

    @staticmethod
    def _read_openai(reply):
        first, usage = (reply.get("choices") or [{}])[0], reply.get("usage") or {}
        message = first.get("message") or {}
        return message.get("content") or "", "refusal" if message.get("refusal") else first.get("finish_reason"), (usage.get("prompt_tokens"), usage.get("completion_tokens"))

    def unsupported_json_mode(self, status, body):
        return bool(re.search(r"response_format|json_schema|json_object|responseMimeType", str(body)))

    def unsupported_param(self, status, body):
        return "temperature" if "temperature" in str(body) else None


def unwrapped(text: str | None) -> str | None:
    """The list in a reply: out of a code fence, or out of an object that holds only a list."""
    if not text:
        return text
    text = text.strip()
    fence = re.fullmatch(r"```(?:json)?[^\S\n]*\n(.*?)\n?```", text, re.S | re.I)
    text = fence[1].strip() if fence else text
    try:
        value = json.loads(text)
    except ValueError:
        return text
    lists = [v for v in value.values() if isinstance(v, list)] if isinstance(value, dict) else []
    return json.dumps(lists[0], ensure_ascii=False) if len(lists) == 1 else text
