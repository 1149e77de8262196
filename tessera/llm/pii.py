"""Personal data: candidate generation, boosted trees, calibrated thresholds.

Generators propose overlapping spans: the four base patterns (email, ip, card,
phone), whose valid matches are always kept; wider patterns of the same
kinds (spelled-out addresses, IPv6, short or oddly grouped card numbers, national
phone numbers); and, as a fifth kind, ``secret``: tokens of eight characters or more that hold a
digit. Each wider candidate is described by its format and by the words
around it; gradient-boosted trees score it, and a threshold per kind, the lowest that
reaches ``PRECISION`` on held-out templates, decides.

The trees are fitted on the driver from a fixed, seeded set of synthetic
sentences (``EXAMPLES`` of them, the documented bound) whose features are computed
by the very same columns; every third template is kept from the fit, for calibration. They
are then compiled to a column expression. Over
the documents everything is DataFrame functions in one map stage: no shuffle, no
Python.

Edge cases: null text counts as empty; spans are code points, end exclusive;
candidates of added kinds that touch a base span are dropped; repeated rows each
give their own row; other columns are kept by ``detect`` and ``redact``, save ``base``
and ``spans``, which are replaced; helper columns start with ``__pii_``.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

# The contract's patterns in a form that the JVM matches without backtracking: quantifiers
# are possessive where what follows cannot be matched by giving back, and a look-behind (or
# the end of the previous match) keeps a run of local-part characters from being retried.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}+ ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}[0-9A-Fa-f:]{1,39}",
    "card": r"(?<![0-9])[0-9]{3,6}(?:[\x20./_-]{1,2}[0-9]{2,7}){1,5}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20./-]{1,2}[0-9]{2,4}[\x20./-][0-9]{3,4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{8,}+",
}
# Texts without these cannot match.
NEEDS = {"email": r"@|(?i)[(\[ ]at[)\] ]", "ip": r"[0-9A-Fa-f]:", "card": r"[0-9]", "phone": r"[0-9]", "secret": r"[0-9]"}
BASE_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

#: Words near a span that speak for or against personal data.
FOR = ("call", "phone", "tel", "mobile", "fax", "mail", "email", "contact", "reach", "card", "visa", "amex", "credit", "host", "login", "address", "server", "client")
AGAINST = ("version", "order", "invoice", "isbn", "page", "date", "chapter", "section", "score", "build", "part", "ratio", "serial", "figure", "release", "time")

SECRET = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "auth", "bearer", "credential", "credentials", "login", "access")

CONTEXT = 32
EXAMPLES = 2400
TREES, DEPTH, RATE = 24, 3, 0.4
PRECISION = 0.97
FEATURES = ("kind", "n_chars", "n_digits", "n_groups", "first_group", "last_group", "letters", "luhn", "parens", "spaces", "dots", "dashes", "slashes", "colons", "at_sign", "for_words", "against_words", "joined_left", "joined_right", "years", "n_upper", "switches", "distinct", "hex", "assigned", "secret_words")


def located(df: DataFrame, name: str, text: str, pattern: str, needs: str) -> DataFrame:
    """Add ``name``: array of (s, e, m, left, right) for the leftmost non-overlapping matches.

    Matches and the gaps between them alternate, so offsets are running sums of
    lengths; one pass each for gaps and matches, then one fold.
    """
    has = F.col(text).rlike(needs)
    gaps, hits = f"__pii_g_{name}", f"__pii_h_{name}"
    cut = df.withColumn(hits, F.when(has, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))))
    cut = cut.withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(text), pattern, -1)))
    pairs = F.zip_with(
        F.zip_with(F.col(hits), F.slice(F.col(gaps), 1, F.size(hits)), lambda h, g: F.struct(h.alias("m"), g.alias("left"))),
        F.slice(F.col(gaps), 2, F.size(hits)),
        lambda p, right: F.struct(p["m"].alias("m"), F.length(p["left"]).alias("gap"), F.right(p["left"], F.lit(CONTEXT)).alias("left"), F.left(right, F.lit(CONTEXT)).alias("right")),
    )
    empty = F.expr("cast(array() as array<struct<s:int,e:int,m:string,left:string,right:string>>)")
    fold = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.length(x["m"])).alias("at"),
            F.array_append(a["out"], F.struct((a["at"] + x["gap"]).alias("s"), (a["at"] + x["gap"] + F.length(x["m"])).alias("e"), x["m"].alias("m"), x["left"].alias("left"), x["right"].alias("right"))).alias("out"),
        ),
        lambda a: a["out"],
    )
    return cut.withColumn(name, F.when(F.size(hits) > 0, fold).otherwise(empty)).drop(gaps, hits)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn test: every second digit from the right counts double."""
    n = F.length(d)
    doubled = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(d, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return (n > 0) & (F.pmod(F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10)) == 0)


def valid(kind: str, m: Column) -> Column:
    """The contract's test of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.coalesce(F.left(F.ltrim(p, F.lit("0")), F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    n = F.length(digits(m))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits(m))).otherwise(False)
    return n.between(8, 15)


def of_kind(f, kind: str):
    """A one-argument lambda over candidates of a kind."""
    return lambda c: f(kind, c)


def words_near(c: Column, words: tuple[str, ...]) -> Column:
    near = F.lower(F.concat(c["left"], F.lit(" "), c["right"]))
    return F.size(F.regexp_extract_all(near, F.lit(r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])"), F.lit(0)))


def features(kind: str, c: Column) -> Column:
    """The integers that the trees see, in the order of FEATURES."""
    m = c["m"]
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")

    def count(pattern: str) -> Column:
        return F.regexp_count(m, F.lit(pattern))

    values = [
        F.lit(KINDS.index(kind)), F.length(m), count("[0-9]"), F.size(groups),
        F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)), F.coalesce(F.length(F.get(groups, F.size(groups) - 1)), F.lit(0)),
        count("[A-Za-z]"), F.when(F.length(digits(m)).between(12, 19), luhn(digits(m)).cast("int")).otherwise(0),
        count(r"[()\[\]]"), count(" "), count(r"\."), count("-"), count("[/_]"), count(":"), count("@"),
        words_near(c, FOR), words_near(c, AGAINST),
        F.right(c["left"], F.lit(1)).rlike(r"[\p{L}\p{N}.]").cast("int"), F.left(c["right"], F.lit(1)).rlike(r"[\p{L}\p{N}]").cast("int"),
        count(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"),
        count("[A-Z]"), count("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"), F.size(F.array_distinct(F.split(m, ""))), m.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("int"),
        c["left"].rlike(r"""[A-Za-z]["']?\x20?[=:]\x20?["']?$""").cast("int"), words_near(c, SECRET),
    ]
    return F.array(*[v.cast("int") for v in values])


# --- the model, fitted on the driver from a fixed synthetic set -----------------------------


def templates() -> dict[tuple[str, int], list]:
    """Makers of candidates by (kind, label): each takes a random generator; 1 is personal data or a secret."""
    d = lambda r, n: "".join(r.choice("0123456789") for _ in range(n))
    w = lambda r: "".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 8)))
    x = lambda r, n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    a = lambda r, n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    m = lambda r, n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    year = lambda r: str(r.randint(1900, 2029))

    def card(r, n: int) -> str:
        body = d(r, n - 1)
        total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(body)))
        return body + str(-total % 10)

    def cut(number: str, sizes: list[int], by: str) -> str:
        out, at = [], 0
        for size in sizes:
            out.append(number[at : at + size])
            at += size
        return by.join(p for p in out if p)

    return {
        ("email", 1): [
            lambda r: f"{w(r)}{d(r, 2)} at {w(r)} dot com", lambda r: f"{w(r)}.{w(r)}(at){w(r)}[dot]org", lambda r: f"{w(r)} at {w(r)} dot net", lambda r: f"{w(r)}[at]{w(r)}.{r.choice(['de', 'fr', 'com'])}",
            lambda r: f"{w(r)}_{w(r)} (at) {w(r)} (dot) com", lambda r: f"{w(r)}.{w(r)} [at] {w(r)} [dot] {r.choice(['de', 'org', 'com'])}", lambda r: f"{w(r)} @ {w(r)}.net", lambda r: f"{w(r)}-{w(r)} @ {w(r)} . com",
        ],
        ("email", 0): [
            lambda r: f"met at noon. {w(r)}", lambda r: f"{w(r)} at {w(r)}. {w(r).capitalize()}", lambda r: f"{w(r)} at {w(r)}. {w(r).capitalize()}", lambda r: f"{w(r)} at {w(r)} .{w(r)}",
            lambda r: f"{w(r).capitalize()} at {w(r)}. {w(r).capitalize()} {w(r)}", lambda r: f"the {w(r)} at {w(r)}.{w(r).capitalize()}",
        ],
        ("ip", 1): [lambda r: ":".join(f"{r.getrandbits(16):x}" for _ in range(8)), lambda r: f"2001:db8:{r.getrandbits(16):x}::{r.getrandbits(16):x}", lambda r: f"fe80:{r.getrandbits(12):x}:{r.getrandbits(16):x}::{r.getrandbits(8):x}", lambda r: f"2a02:{r.getrandbits(16):x}:{r.getrandbits(16):x}:{r.getrandbits(16):x}::1"],
        ("ip", 0): [lambda r: f"{r.randint(10, 23)}:{d(r, 2)}:{d(r, 2)}", lambda r: f"{d(r, 1)}:{d(r, 1)}:{d(r, 2)}", lambda r: f"0{r.randint(0, 9)}:{d(r, 2)}:{d(r, 2)}", lambda r: f"{r.randint(1, 9)}:{d(r, 2)}:{d(r, 2)}", lambda r: ":".join(x(r, 2) for _ in range(6))],
        ("card", 1): [
            lambda r: cut(card(r, 15), [4, 6, 5], r.choice(" -")), lambda r: cut(card(r, 16), [4, 4, 4, 4], " - "[:2]), lambda r: cut(card(r, 14), [4, 6, 4], " "),
            lambda r: cut(card(r, 16), [4, 4, 4, 4], "."), lambda r: cut(card(r, 15), [4, 6, 5], "."), lambda r: cut(card(r, 16), [4, 4, 4, 4], "  "),
        ],
        ("card", 0): [
            lambda r: cut(d(r, 16), [4, 4, 4, 4], r.choice("-./")), lambda r: f"{year(r)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda r: f"978-{d(r, 1)}-{d(r, 4)}-{d(r, 4)}", lambda r: f"{d(r, 3)} {d(r, 3)} {d(r, 3)}",
            lambda r: f"{year(r)}/{d(r, 2)}/{d(r, 4)}", lambda r: cut(d(r, 13), [3, 5, 5], " "), lambda r: f"{d(r, 3)}.{d(r, 2)}.{d(r, 3)}", lambda r: f"{d(r, 3)}-{d(r, 4)}", lambda r: cut(d(r, 15), [4, 6, 5], " "),
        ],
        ("phone", 1): [lambda r: f"({d(r, 3)}) {d(r, 3)}-{d(r, 4)}", lambda r: f"{d(r, 3)}-{d(r, 3)}-{d(r, 4)}", lambda r: f"{d(r, 3)}.{d(r, 3)}.{d(r, 4)}", lambda r: f"0{d(r, 2)} {d(r, 4)} {d(r, 4)}", lambda r: f"({d(r, 3)})-{d(r, 3)}-{d(r, 4)}", lambda r: f"({d(r, 3)}) {d(r, 3)} {d(r, 4)}"],
        ("phone", 0): [
            lambda r: f"{d(r, 2)}.{d(r, 2)}.{year(r)}", lambda r: f"{d(r, 2)}/{d(r, 3)}/{d(r, 3)}", lambda r: f"{d(r, 3)} {d(r, 3)} {d(r, 3)}", lambda r: f"{year(r)}/{d(r, 2)}/{d(r, 4)}", lambda r: f"{d(r, 2)}-{d(r, 2)}-{year(r)}", lambda r: f"{d(r, 3)}.{d(r, 2)}.{d(r, 3)}",
            lambda r: f"{d(r, 2)} {d(r, 2)} {d(r, 3)}", lambda r: f"{d(r, 3)}/{d(r, 3)}/{d(r, 3)}",
        ],
        ("secret", 1): [
            lambda r: f'token = "{x(r, 40)}"', lambda r: f"password={x(r, r.randint(10, 20))}", lambda r: f"AKIA{a(r, 16)}", lambda r: f"secret: {m(r, r.randint(20, 44))}", lambda r: f"api_key={m(r, 32)}", lambda r: f"pwd = '{w(r)}{d(r, 4)}{m(r, 4)}'",
            lambda r: f"ghp_{m(r, 36)}", lambda r: f"Bearer {m(r, 40)}", lambda r: f"sk_live_{m(r, 24)}", lambda r: f"ASIA{a(r, 16)}", lambda r: f'"auth": "{x(r, 32)}"', lambda r: f"token={m(r, 24)}",
        ],
        ("secret", 0): [
            lambda r: f"{w(r)}{year(r)}{w(r)}", lambda r: f"IMG_{year(r)}{d(r, 4)}_{d(r, 6)}", lambda r: f"{w(r)}_{w(r)}_{year(r)}_final", lambda r: f"978{d(r, 10)}", lambda r: f"{year(r)}{d(r, 4)}T{d(r, 6)}", lambda r: f"/{year(r)}/{d(r, 2)}/{w(r)}{d(r, 3)}", lambda r: d(r, 16),
            lambda r: f"ORD-{year(r)}{d(r, 4)}-{d(r, 4)}", lambda r: f"{w(r)}-{w(r)}-{d(r, 2)}", lambda r: f"{a(r, 3)}{d(r, 7)}", lambda r: f"{w(r)}/{w(r)}{d(r, 2)}", lambda r: f"commit {x(r, 8)}", lambda r: f"{w(r)}_{d(r, 5)}", lambda r: d(r, r.randint(8, 14)), lambda r: f"{d(r, 4)}-{d(r, 2)}-{d(r, 2)}",
        ],
    }


def examples(seed: int = 5, count: int = EXAMPLES) -> list[tuple[str, str, int, bool]]:
    """(sentence, kind, label, held): synthetic sentences around one candidate; every third template is held out."""
    rng, made = random.Random(seed), templates()
    w = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8)))
    out = []
    for k in range(count):
        label, kind = k % 2, KINDS[k // 2 % len(KINDS)]
        chosen = rng.randrange(len(made[kind, label]))
        near = rng.choice(FOR if label else AGAINST) if rng.random() < 0.4 else w()
        if rng.random() < 0.04:
            near = rng.choice(AGAINST if label else FOR)
        out.append((f"{w()} {w()} {near} {made[kind, label][chosen](rng)} {w()} {w()}", kind, label, chosen % 3 == 2))
    return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> tuple[float, list]:
    """Gradient boosting with logistic loss; each tree is nested (feature, cut, left, right) or a leaf."""
    start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(len(y), start)
    cuts = [(v := np.unique(x[:, j])[:-1])[:: max(1, len(v) // 24)] for j in range(x.shape[1])]
    codes = [np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]  # how many cuts lie below a value

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        gs, hs = g[rows].sum(), h[rows].sum()
        leaf = float(RATE * gs / (hs + 1.0))
        best, found = 1e-3, None
        for j, values in enumerate(cuts if depth else []):
            if not len(values):
                continue
            sums = [np.cumsum(np.bincount(codes[j][rows], weights=v, minlength=len(values) + 1))[:-1] for v in (g[rows], h[rows], np.ones(len(rows)))]
            gl, hl, nl = sums
            gain = np.where(np.minimum(nl, len(rows) - nl) < 8, -1.0, gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1))
            if gain.max() > best:
                best, found = gain.max(), (j, int(values[gain.argmax()]))
        if found is None:
            return leaf
        left = x[rows, found[0]] <= found[1]
        return (*found, grow(rows[left], g, h, depth - 1), grow(rows[~left], g, h, depth - 1))

    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(grow(np.arange(len(y)), y - p, p * (1 - p), DEPTH))
        score += np.array([value(trees[-1], row) for row in x])
    return start, trees


def value(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and offset of the log odds on held-out examples."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * score + b)))
        g = np.array([((y - p) * score).sum() - 0.01 * (a - 1), (y - p).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * score * score).sum() + 0.01, (v * score).sum()], [(v * score).sum(), v.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)


@lru_cache(maxsize=4)
def _fitted(rows: tuple) -> dict:
    x, y, held = np.array([r[:-2] for r in rows]), np.array([r[-2] for r in rows], dtype=float), np.array([r[-1] for r in rows])
    start, trees = fit_trees(x[~held], y[~held])
    raw = np.array([start + sum(value(t, row) for t in trees) for row in x])
    a, b = calibrate(raw[held], y[held])
    p = 1 / (1 + np.exp(-(a * raw + b)))
    limits = {}
    for k, kind in enumerate(KINDS):
        mine = held & (x[:, 0] == k)
        right = [t for t in np.unique(p[mine]) if y[mine & (p >= t)].mean() >= PRECISION]
        limits[kind] = float(right[0]) if right else 1.1  # no threshold is right enough: nothing is added
    return {"start": start, "trees": trees, "a": a, "b": b, "limits": limits, "x": x, "y": y, "p": p, "held": held}


def fit(spark: SparkSession) -> dict:
    """The fitted model. Only the fixed synthetic set travels to the driver."""
    made = spark.createDataFrame(examples(), "text string, kind string, label int, held boolean")
    for kind in KINDS:
        made = located(made, f"__pii_w_{kind}", "text", WIDE[kind], NEEDS[kind])
    every = F.concat(*[F.transform(f"__pii_w_{kind}", of_kind(lambda k, c: F.struct(F.lit(k).alias("k"), features(k, c).alias("f")), kind)) for kind in KINDS])
    # A candidate of another kind than the sentence was made for is none of its own kind.
    rows = made.select("kind", "label", "held", F.explode(every).alias("c")).select("c.f", F.when(F.col("c.k") == F.col("kind"), F.col("label")).otherwise(0).alias("y"), "held").collect()
    return _fitted(tuple(sorted((*r["f"], r["y"], r["held"]) for r in rows)))


def probability(model: dict, f: str) -> str:
    """The calibrated probability as SQL over an array of features."""

    def branch(tree) -> str:
        if isinstance(tree, tuple):
            return f"IF({f}[{tree[0]}] <= {tree[1]}, {branch(tree[2])}, {branch(tree[3])})"
        return f"{tree:.9f}D"

    total = " + ".join([f"{model['start']:.9f}D", *(branch(t) for t in model["trees"])])
    return f"1D / (1D + exp(-({model['a']:.9f}D * ({total}) + {model['b']:.9f}D)))"


# --- detection and redaction -----------------------------------------------------------------


def detect(df: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """Add ``base`` and ``spans``: arrays of (kind, s, e, p), by kind as listed, then start.

    Base spans have p = 1. A wide candidate is kept where its probability reaches
    its kind's threshold, it touches no base span, and no better kept candidate
    touches it (ties: the earlier kind, then the earlier start).
    """
    model = model or fit(df.sparkSession)
    out = df.withColumn("__pii_text", F.coalesce(F.col(text), F.lit("")))
    struct = "array<struct<kind:string,s:int,e:int,p:double>>"
    for kind in KINDS:
        if kind in BASE_KINDS:
            out = located(out, f"__pii_b_{kind}", "__pii_text", BASE[kind], BASE_NEEDS[kind])
            kept = F.filter(f"__pii_b_{kind}", of_kind(lambda k, c: valid(k, c["m"]), kind))
            out = out.withColumn(f"__pii_k_{kind}", F.transform(kept, of_kind(lambda k, c: F.struct(F.lit(k).alias("kind"), c["s"].alias("s"), c["e"].alias("e"), F.lit(1.0).alias("p")), kind)).cast(struct))
        out = located(out, f"__pii_w_{kind}", "__pii_text", WIDE[kind], NEEDS[kind])
        described = F.transform(f"__pii_w_{kind}", of_kind(lambda k, c: F.struct(c["s"].alias("s"), c["e"].alias("e"), features(k, c).alias("f")), kind))
        out = out.withColumn(f"__pii_f_{kind}", described)
        out = out.withColumn(
            f"__pii_p_{kind}",
            F.expr(f"filter(transform(__pii_f_{kind}, x -> named_struct('kind', '{kind}', 's', x.s, 'e', x.e, 'p', {probability(model, 'x.f')})), x -> x.p >= {model['limits'][kind]:.9f}D)").cast(struct),
        )
    touch = "x.s < y.e AND y.s < x.e"
    listed = ", ".join(f"'{kind}'" for kind in KINDS)
    rank = f"array_position(array({listed}), {{}}.kind)"
    first = f"CASE WHEN x.p != y.p THEN IF(x.p > y.p, -1, 1) WHEN x.kind != y.kind THEN cast({rank.format('x')} - {rank.format('y')} as int) ELSE x.s - y.s END"
    best_first = f"aggregate(array_sort(__pii_new, (x, y) -> {first}), cast(array() as {struct}), (kept, x) -> IF(exists(kept, y -> {touch}), kept, array_append(kept, x)))"
    out = out.withColumn("base", F.concat(*[F.col(f"__pii_k_{kind}") for kind in BASE_KINDS]))
    out = out.withColumn("__pii_all", F.concat(*[F.col(f"__pii_p_{kind}") for kind in KINDS]))
    out = out.withColumn("__pii_new", F.expr(f"CASE WHEN size(__pii_all) > 0 THEN filter(__pii_all, x -> NOT exists(base, y -> {touch})) ELSE __pii_all END"))
    out = out.withColumn("__pii_add", F.expr(f"CASE WHEN size(__pii_new) > 1 THEN {best_first} ELSE __pii_new END"))
    by_start = F.concat(*[F.expr(f"array_sort(filter(concat(base, __pii_add), x -> x.kind = '{kind}'), (x, y) -> x.s - y.s)") for kind in KINDS])
    out = out.withColumn("spans", F.when(F.size("__pii_add") > 0, by_start).otherwise(F.col("base")))
    return out.drop(*[c for c in out.columns if c.startswith("__pii_")])


def digest(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')")


def redact(df: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """Replace each span of personal data by its kind in brackets; touching spans become one mark.

    Texts without spans stay as they are, null included; ``spans`` says what was replaced.
    """
    found = detect(df, text, model)
    fold = f"""aggregate(array_sort(spans, (x, y) -> IF(x.s != y.s, x.s - y.s, y.e - x.e)),
        named_struct('at', 0, 'out', cast(array() as array<string>)),
        (a, x) -> CASE WHEN x.s >= a.at THEN named_struct('at', x.e, 'out', array_append(a.out, concat(substring({text}, a.at + 1, x.s - a.at), '[', upper(x.kind), ']')))
                       WHEN x.e > a.at THEN named_struct('at', x.e, 'out', a.out) ELSE a END,
        a -> concat(array_join(a.out, ''), substring({text}, a.at + 1)))"""
    return found.withColumn(text, F.when(F.size("spans") > 0, F.expr(fold)).otherwise(F.col(text)))


def query(spark, sf_dir):
    """op1: personal data in all documents."""
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in BASE_KINDS]
    secrets = F.expr("cast(size(filter(spans, x -> x.kind = 'secret')) as bigint)").alias("n_secret")
    return found.select("doc_id", *counts, F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"), secrets)
