"""HTML as tables: segments with positions, dropped text, tag sequences and visible text.

Every page is parsed once per operator by a position-keeping tree builder over the
standard library's tokenizer. Two modes: ``strict`` models a tree builder whose elements
without an end tag have no range (their text is lost, and reported by ``holes``);
``recover`` ends such elements where the next boundary closes them and keeps the text.
Not modelled: re-ordering of misnested formatting, text moved out of tables, foreign content.
Offsets are code points.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import constants as K
from ..functions import text as T
from ..workers import ship

ship(__name__)

_inline, _skip, _void = frozenset(K.INLINE), frozenset(K.SKIP), frozenset(K.VOID)
_formatting = frozenset("a b big code em font i s small strike strong tt u".split())
_text_attrs, _meta_keys, _json_keys = tuple(K.TEXT_ATTRS), frozenset(K.META_KEYS), tuple(K.JSONLD_KEYS)
# Plain values, not modules: functions that go to executors must not need the package there.
_tech, _tag = frozenset(K.TECH_TOKENS), T.TAG
#: Elements that end an open <p>, and elements that end an open one of their own kind.
_ends_p = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_ends_own = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_ws = "\t\n\x0b\f\r                  　﻿"


class Node:
    __slots__ = ("attrs", "children", "closed", "end", "inner", "lost", "name", "open_end", "start", "text")

    def __init__(self, name: str, start: int, open_end: int, attrs=()):
        self.name, self.start, self.open_end, self.attrs = name, start, open_end, attrs
        self.children: list[Node] = []
        self.inner = self.end = open_end  # where the content and the element end
        self.closed = False  # by an end tag of its own
        self.lost = False  # inside a reopened formatting element, which has no range
        self.text: str | None = None  # of text nodes, raw


class Builder(HTMLParser):
    """A tree with source offsets."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=False)
        self.source = source
        self.lines = [0] + [m.end() for m in re.finditer("\n", source)]
        self.root = Node("#root", 0, 0)
        self.stack = [self.root]
        self.tags: list[str] = []
        self.open: Counter[str] = Counter()  # elements on the stack by name
        self.dangling: Counter[str] = Counter()  # formatting elements that a boundary closed without an end tag
        self.pieces: dict[Node, list[str]] = {}  # of text nodes, joined at the end
        self.feed(source)
        self.close()
        while len(self.stack) > 1:
            self._drop(len(source))
        self.root.inner = self.root.end = len(source)
        for node, pieces in self.pieces.items():
            node.text = "".join(pieces)

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _drop(self, at: int, closed_end: int | None = None) -> None:
        node = self.stack.pop()
        self.open[node.name] -= 1
        node.inner, node.end, node.closed = at, closed_end if closed_end is not None else at, closed_end is not None
        if closed_end is None and node.name in _formatting:
            self.dangling[node.name] += 1

    def handle_starttag(self, tag, attrs):
        at = self._at()
        ends = ("p",) if tag in _ends_p else ()
        ends += _ends_own.get(tag, ())
        for k in range(len(self.stack) - 1, 0, -1) if any(self.open[e] for e in ends) else ():
            if self.stack[k].name in ends:
                while len(self.stack) > k:
                    self._drop(at)
                break
            if self.stack[k].name not in _formatting and self.stack[k].name not in ("p", "span"):
                break
        raw = self.get_starttag_text()
        node = Node(tag, at, at + len(raw), attrs)
        node.lost = self.dangling.total() > 0
        self.tags.append(tag)
        self.stack[-1].children.append(node)
        if tag not in _void and not raw.endswith("/>"):
            self.stack.append(node)
            self.open[tag] += 1

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        at = self._at()
        end = self.source.find(">", at) + 1 or len(self.source)
        if self.open[tag]:
            while self.stack[-1].name != tag:
                self._drop(at)
            self._drop(at, end)
        elif self.dangling[tag]:
            self.dangling[tag] -= 1

    def _text(self, raw: str, at: int) -> None:
        siblings = self.stack[-1].children
        if siblings and siblings[-1].text is not None and siblings[-1].end == at:
            self.pieces[siblings[-1]].append(raw)
            siblings[-1].end += len(raw)
            return
        node = Node("#text", at, at)
        node.text, node.end, node.lost = "", at + len(raw), self.dangling.total() > 0
        self.pieces[node] = [raw]
        siblings.append(node)

    def handle_data(self, data):
        self._text(data, self._at())

    def handle_entityref(self, name):
        at = self._at()
        raw = f"&{name};"
        self._text(raw if self.source.startswith(raw, at) else f"&{name}", at)

    def handle_charref(self, name):
        self.handle_entityref(f"#{name}")


def strip_ws(s: str) -> str:
    return s.strip(_ws)


def worth(s: str) -> bool:
    """The row-level twin of ``functions.text.translatable``."""
    if len(s) < 2 or not any(c.isalpha() for c in s) or s in _tech or s == "English":
        return False
    if re.fullmatch(r"(?:[0-9.,:%+\-–—/()]|\s)+", s) or re.fullmatch(rf"(?:\s|{_tag})*", s) or re.fullmatch(r"[A-Z0-9.+-]{2,8}", s):
        return False
    if re.fullmatch(r"(?i)(?:https?://|//|mailto:|tel:|#|/)\S*", s) or re.fullmatch(r"\S+@\S+\.\S+", s):
        return False
    return not re.fullmatch(r"English \(.+\)", s)


class Walker:
    """Segments of a page in traversal order, and the text that is lost."""

    def __init__(self, source: str, mode: str):
        self.source, self.recover = source, mode != "strict"
        self.segments: list[dict] = []
        self.lost: list[str] = []
        self.tree = Builder(source)
        self.walk(self.tree.root)

    def emit(self, start: int, stop: int, text: str, kind: str, el: str | None, tags=(), escaped: bool = False) -> None:
        text = strip_ws(text)
        if worth(text):
            self.segments.append({"start": start, "stop": stop, "raw": self.source[start:stop], "text": text, "kind": kind, "el": el, "tags": list(tags), "escaped": escaped})

    def usable(self, node: Node) -> bool:
        return node.closed or self.recover

    def tokens(self, node: Node, tags: list) -> str:
        """A block's text with numbered tags, which are added to ``tags``; nesting may be of any depth."""
        out, todo = [], [*reversed(node.children)]
        while todo:
            child = todo.pop()
            if isinstance(child, str):
                out.append(child)
            elif child.text is not None:
                out.append(entities.unescape(child.text))
            elif child.name in _void or child.name in _skip or not self.usable(child):
                whole = child.name in _skip or child.name in _void
                out.append(f"<{len(tags)}/>")
                tags.append((self.source[child.start : child.end if whole else child.open_end], None))
                if not whole:
                    self.lose(child)
            else:
                out.append(f"<{len(tags)}>")
                todo += [f"</{len(tags)}>", *reversed(child.children)]
                tags.append((self.source[child.start : child.open_end], self.source[child.inner : child.end]))
        return "".join(out)

    def lose(self, node: Node) -> None:
        todo = [*reversed(node.children)]
        while todo:
            child = todo.pop()
            if child.text is None:
                todo += reversed(child.children) if child.name not in _skip else ()
            elif strip_ws(child.text):
                self.lost.append(strip_ws(child.text))

    def attributes(self, node: Node) -> None:
        tag = self.source[node.start : node.open_end]
        given = dict(node.attrs)
        wanted = [(a, f"attr:{a}", node.name) for a in _text_attrs if given.get(a)]
        key = given.get("name") or given.get("property")
        if node.name == "meta" and key in _meta_keys and given.get("content"):
            wanted.append(("content", "attr:content", f"meta:{key}"))
        for name, kind, el in wanted:
            m = re.search(rf"\s{re.escape(name)}\s*=\s*([\"'])(.*?)\1", tag, re.S)
            if m and m[2] == given[name]:  # entities in the raw value would be lost on the way back
                self.emit(node.start + m.start(2), node.start + m.end(2), m[2], kind, el)

    def structured(self, node: Node) -> None:
        body = self.source[node.open_end : node.inner]
        try:
            found: dict[tuple[str, str], None] = {}
            stack = [json.loads(body)]
            while stack:
                value = stack.pop()
                if isinstance(value, dict):
                    found |= {(k, v): None for k, v in value.items() if k in _json_keys and isinstance(v, str)}
                    stack += value.values()
                elif isinstance(value, list):
                    stack += value
        except ValueError:
            return
        for key, value in found:
            for ascii_only in (False, True):
                coded = json.dumps(value, ensure_ascii=ascii_only)[1:-1]
                for m in re.finditer(rf'"{re.escape(key)}"\s*:\s*"({re.escape(coded)})"', body):
                    self.emit(node.open_end + m.start(1), node.open_end + m.end(1), value, "jsonld", None, escaped=coded != value)
                if coded == json.dumps(value)[1:-1]:
                    break

    def walk(self, root: Node) -> None:
        todo = [root]
        while todo:
            todo += reversed(self.visit(todo.pop()))

    def visit(self, node: Node) -> list[Node]:
        """Segments of an element itself; the elements to visit next."""
        if node.name == "script":
            if dict(node.attrs).get("type") == "application/ld+json":
                self.structured(node)
            return []
        if node.name in _skip:
            return []
        if node.name != "#root":
            self.attributes(node)
        texts = [c for c in node.children if c.text is not None and strip_ws(c.text)]
        if not self.recover and texts and any(t.lost for t in texts):
            self.lost += [strip_ws(t.text) for t in texts if t.lost]
            texts = [t for t in texts if not t.lost]
        elements = [c for c in node.children if c.text is None]
        prose = [c for c in elements if c.name not in _skip]
        if texts and node.name != "#root":
            if all(c.name in _inline for c in prose):
                if not self.usable(node) or (node.lost and not self.recover):
                    self.lose(node)
                    return []
                tags: list = []
                text = self.tokens(node, tags)
                inner = self.source[node.open_end : node.inner]
                start = node.open_end + len(inner) - len(inner.lstrip(_ws))
                self.emit(start, start + len(strip_ws(inner)), text, "block", node.name, tags)
                self.inline_attributes(elements)
                return []
            for t in texts:
                lead = len(t.text) - len(t.text.lstrip(_ws))
                start = t.start + lead
                self.emit(start, start + len(strip_ws(t.text)), entities.unescape(t.text), "text", node.name)
        return elements

    def inline_attributes(self, elements: list[Node]) -> None:
        """Attributes of the elements inside a block, at any depth; where the block is a segment they overlap it."""
        todo = [*reversed(elements)]
        while todo:
            node = todo.pop()
            if node.text is None and node.name not in _skip:
                self.attributes(node)
                todo += reversed(node.children)


def settle(found: list[dict]) -> tuple[list[dict], list[dict]]:
    """Segments that overlap none before them, by start, and those that do; each in traversal order."""
    taken, clashing = -1, set()
    for i in sorted(range(len(found)), key=lambda i: (found[i]["start"], -found[i]["stop"])):
        if found[i]["start"] < taken:
            clashing.add(i)
        else:
            taken = found[i]["stop"]
    return [s for i, s in enumerate(found) if i not in clashing], [found[i] for i in sorted(clashing)]


SEGMENT = "page long, seg int, start int, stop int, raw string, text string, kind string, el string, tags array<struct<open:string,close:string>>, escaped boolean, hash string"


#: Characters of pages that a worker parses before it hands on their rows.
A_SLICE = 1_000_000
#: Characters of a page that travel to a worker in one row.
A_PIECE = 400


def _pieces(pages: DataFrame) -> DataFrame:
    """(page, pos, html): pages cut into pieces, in order; pos is null for an empty page.

    Arrow's batches count rows (10,000) before bytes (64 MB), and a worker holds a batch whole: of pieces it is a few MB
    for pages of any length.
    """
    cut = F.regexp_extract_all("html", F.lit(f"(?s).{{1,{A_PIECE}}}"), F.lit(0))
    return pages.select("page", F.posexplode_outer(cut).alias("pos", "html"))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    """(page, html) of pieces joined again; rows without a pos are whole pages. A batch is let go before the next is read."""
    page, parts = None, []
    for batch in batches:
        ids, sources = batch.column("page"), batch.column("html")
        places = batch.column("pos") if "pos" in batch.schema.names else None
        for i in range(batch.num_rows):
            if parts and (places is None or not places[i].as_py()):
                yield page, "".join(parts)
                parts = []
            if not parts:
                page = ids[i].as_py()
            parts.append(sources[i].as_py() or "")
        del batch, ids, sources, places
    if parts:
        yield page, "".join(parts)


def _by_page(pages: DataFrame, rows_of: Callable[[int, str], Iterable[tuple]], schema: str) -> DataFrame:
    """The rows of every page, handed on after each ``A_SLICE`` characters, so that memory does not grow with Arrow's batches."""
    arrow, limit = to_arrow_schema(StructType.fromDDL(schema)), A_SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else ((),) * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        rows, size = [], 0
        for page, source in _whole(batches):
            rows += rows_of(page, source)
            size += len(source)
            if size >= limit:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)

    return _pieces(pages).mapInArrow(run, schema)


def extract(pages: DataFrame, mode: str = "recover") -> DataFrame:
    """Segments of pages (page, html): one row each, in traversal order. What overlaps them is told by ``conflicts``."""

    def rows(page, source):
        for seg, s in enumerate(settle(Walker(source, mode).segments)[0]):
            tags = [{"open": o, "close": c} for o, c in s["tags"]]
            yield page, seg, s["start"], s["stop"], s["raw"], s["text"], s["kind"], s["el"], tags, s["escaped"], hashlib.sha1(s["text"].encode("utf-8", "replace")).hexdigest()[:16]

    return _by_page(pages, rows, SEGMENT)


def conflicts(pages: DataFrame, mode: str = "recover") -> DataFrame:
    """(page, start, stop, kind, el, text) of segments that cannot be spliced, as they overlap an earlier one.

    These are attributes of elements inside a block, which the block's own translation carries unchanged.
    """

    def rows(page, source):
        return [(page, s["start"], s["stop"], s["kind"], s["el"], s["text"]) for s in settle(Walker(source, mode).segments)[1]]

    return _by_page(pages, rows, "page long, start int, stop int, kind string, el string, text string")


def holes(pages: DataFrame, mode: str = "strict") -> DataFrame:
    """(page, text) that a mode drops."""
    return _by_page(pages, lambda page, source: [(page, t) for t in Walker(source, mode).lost], "page long, text string")


def facts(pages: DataFrame) -> DataFrame:
    """(page, tags, visible): start tags in order, and text outside elements without prose, white space folded."""

    def rows(page, source):
        tree, seen = Builder(source), []
        stack = [tree.root]
        while stack:
            node = stack.pop()
            if node.text is not None:
                if folded := " ".join(entities.unescape(node.text).split()):
                    seen.append(folded)
            elif node.name not in _skip:
                stack += reversed(node.children)
        return [(page, tree.tags, seen)]

    return _by_page(pages, rows, "page long, tags array<string>, visible array<string>")
