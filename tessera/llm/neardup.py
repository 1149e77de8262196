"""MinHash near-duplicate detection with banding, verification and connected components.

1. Each text's set of word shingles is hashed to 64 bits; rows with equal sets (by a
   128-bit digest) form one class, with a number of its own.
2. Every class gets ``BANDS * ROWS`` universal hash minima; classes that share all
   minima of a band fall into one bucket.
3. Each bucket has a hub, its member with the most bucket mates overall (in a family of
   edited copies that is the text they were made from). Every other member is paired
   with it: one pair a member, however large the bucket. Full shingle sets are
   compared; linked members are connected through the hub.
4. Where members are left that their hub does not connect, pairs of members are found by
   what differs from a centre v: the hub with every element changed that more than half of the
   members change. Let d(x) be the size of D(x), the symmetric difference of x and v, and
   n(x) that of x. x and y are linked where |x - y| (symmetric) <= c (n(x) + n(y)), and
   |x - y| = d(x) + d(y) - 2 |D(x) & D(y)|. So with the slack s = c n - d, a pair is surely linked
   where s(x) + s(y) >= 0, and else must share (-s(x) - s(y)) / 2 elements of D at least.
   Members whose slack makes up for that of the member with the greatest slack are
   linked to it: one link a member. Any other pair has an outer member, and shares one of the first
   elements of D (prefix filter, rare elements first, outer with outer members and outer
   with inner ones apart, as the latter need longer prefixes; positional bound). The
   pairs found are checked on whole differences. No pair of a bucket is skipped and no
   bucket is capped. In a family of texts with words of their own, elements of a prefix
   are rare, so the pairs looked at grow with the members.
5. Links become components by alternating large-star and small-star.

With 32 bands of 5 rows a pair at the threshold of 0.8 misses every bucket with
probability 3e-6.

Scale: texts are shuffled once, to fetch those of classes in shared buckets; the
other exchanges carry ids, band keys and hashed elements of texts in open buckets. Hot
groups of copies collapse into one class before banding; a hub's text is copied once for
``SALT`` members, which spreads a hot hub; hot buckets are joined, not collected, so
adaptive execution can split them.

Edge cases: null and empty texts have an empty set (size 0) and are linked with
nothing; texts with fewer words than a shingle have one shingle, the whole
sequence; repeated rows are each returned, those of one id with different texts each by its
text; ids must be integers, and rows of a null id take part: they are kept only where
no row of their component has an id, whose component is then null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ship

ship(__name__)

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
SHARE = (80, 100)  # linked where 100 * intersection >= 80 * union
CACHE = 400_000
STRIP = 1024  # shingles hashed at once
SALT = 256  # members of a hub that meet one copy of its text
_rng = np.random.default_rng(20240229)
MULTIPLIERS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """Turns texts into sorted distinct 64-bit shingles; one per task, with a bounded cache of word hashes."""

    def __init__(self, k: int):
        self.k, self.cache = k, {}

    def words(self, text: str) -> np.ndarray:
        """Hashes of the words between ASCII white space, A-Z lower-cased."""
        got, cache = text.encode("utf-8", "surrogatepass").lower().split(), self.cache
        if len(cache) > CACHE:
            cache.clear()
        out = [cache.get(w) for w in got]
        if None in out:
            for i, h in enumerate(out):
                if h is None:
                    out[i] = cache[got[i]] = xxhash.xxh3_64_intdigest(got[i])
        return np.array(out, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        w = self.words(text or "")
        if len(w) == 0:
            return w
        if len(w) < self.k:
            return np.array([xxhash.xxh3_64_intdigest(w.tobytes(), seed=1 + len(w))], np.uint64)
        n = len(w) - self.k + 1
        h = w[:n].copy()
        for j in range(1, self.k):
            h ^= h >> np.uint64(29)
            h = h * _A + w[j : j + n]
        h ^= h >> np.uint64(32)
        h *= _B
        h ^= h >> np.uint64(29)
        return np.unique(h)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash (multiplication by an odd number, modulo 2^64)."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), STRIP):
        np.minimum(out, (shingles[at : at + STRIP, None] * MULTIPLIERS).min(axis=0), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, its number included."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _B
    for j in range(ROWS):
        h = (h ^ m[j::ROWS]) * _A
        h ^= h >> np.uint64(31)
    return h.view(np.int64)


def text_hash(text) -> Column:
    """What tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signatures(df: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """id, text_hash, n (set size), d1 and d2 (digest of the set, null if empty), bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(k)
        for batch in batches:
            rows = []
            for value in batch["t"]:
                s = shingle(value)
                if len(s) == 0:
                    rows.append((0, None, None, None))
                    continue
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8")
                rows.append((len(s), int(digest[0]), int(digest[1]), band_keys(minima(s))))
            out = pd.DataFrame(rows, columns=["n", "d1", "d2", "bands"], index=batch.index).astype({"d1": "Int64", "d2": "Int64"})
            yield pd.concat([batch[["id", "text_hash"]], out], axis=1)

    rows = df.select(F.col(id_col).cast("long").alias("id"), text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("t"))
    return rows.mapInPandas(run, "id long, text_hash long, n long, d1 long, d2 long, bands array<long>")


def against_hubs(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(hub, id, n, nh, linked, diff) of pairs (hub, id): by the full sets; the hashed elements that only one has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, held = Shingler(k), (None, None)
        for batch in batches:
            rows = []
            batch = batch.sort_values("hub", kind="stable")
            for hub, other, ht, t in zip(batch["hub"], batch["id"], batch["ht"], batch["t"], strict=True):
                if held[0] != hub:
                    held = (hub, shingle(ht))
                h, z = held[1], shingle(t)
                diff = np.setxor1d(z, h, assume_unique=True)
                both = (len(z) + len(h) - len(diff)) // 2
                linked = SHARE[1] * both >= SHARE[0] * (both + len(diff))
                rows.append((hub, other, len(z), len(h), linked, diff.view(np.int64)))
            yield pd.DataFrame(rows, columns=["hub", "id", "n", "nh", "linked", "diff"])

    # Members of a hub are dealt to salts by their number; the hub's text is copied once a salt.
    copies = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("c")).select("hub", F.explode(F.expr(f"sequence(0L, c div {SALT})")).alias("salt"), F.col("c").alias("of"))
    hubs = copies.join(texts.select(F.col("id").alias("hub"), F.col("t").alias("ht")), "hub")
    counts = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("c"))
    salted = pairs.join(counts, "hub").select("hub", "id", F.expr(f"pmod(xxhash64(id), c div {SALT} + 1)").alias("salt"))
    met = salted.join(texts.select("id", "t"), "id").join(hubs.select("hub", "salt", "ht"), ["hub", "salt"])
    return met.select("hub", "id", "ht", "t").mapInPandas(run, "hub long, id long, n long, nh long, linked boolean, diff array<long>")


LESS, ALL = SHARE[1] - SHARE[0], SHARE[1] + SHARE[0]  # c = LESS / ALL


def centred(tested: DataFrame, scratch: Scratch) -> DataFrame:
    """(hub, id, n, linked, diff, d, s) of hubs with unlinked members: differences from the centre, rare elements first; slack times ALL.

    The hub stands among its members.
    """
    open_hubs = scratch.put(tested.filter("NOT linked").select("hub").distinct())
    members = tested.join(open_hubs, "hub", "left_semi")
    own = members.groupBy("hub").agg(F.max("nh").alias("n")).select("hub", F.col("hub").alias("id"), "n", F.lit(True).alias("linked"), F.expr("cast(array() as array<bigint>)").alias("diff"))
    rows = scratch.put(members.select("hub", "id", "n", "linked", "diff").unionByName(own))
    flat = rows.select("hub", "id", F.explode("diff").alias("e"))
    sizes = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("m"))
    counts = scratch.put(flat.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("c")).join(sizes, "hub").select("hub", "e", "c", (2 * F.col("c") > F.col("m")).alias("most")))
    # Elements that most members change: at most twice as many as a member changes on average.
    changed = counts.filter("most").groupBy("hub").agg(F.collect_list("e").alias("most"))
    kept = scratch.put(flat.join(counts.filter("NOT most").drop("most"), ["hub", "e"]).groupBy("hub", "id").agg(F.sort_array(F.collect_list(F.struct("c", "e"))).alias("kept")))
    out = rows.join(changed, "hub", "left").join(kept, ["hub", "id"], "left")
    none = F.expr("cast(array() as array<bigint>)")
    diff = F.concat(F.coalesce(F.expr("transform(kept, x -> x.e)"), none), F.coalesce(F.sort_array(F.array_except("most", "diff")), none))
    out = out.select("hub", "id", "n", "linked", diff.alias("diff")).withColumn("d", F.size("diff"))
    return scratch.put(out.withColumn("s", LESS * F.col("n") - ALL * F.col("d")))


def member_candidates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of centred rows: sure links (a, b) to the member of the greatest slack; and the joined rows (hub, a, b) that may be links."""
    best = rows.groupBy("hub").agg(F.max("s").alias("top"), F.max_by("id", F.struct("s", -F.col("id"))).alias("star"))
    placed = rows.join(best, "hub").withColumn("outer", F.col("s") < -F.col("top"))
    sure = placed.filter("NOT outer AND id != star").select(F.col("star").alias("a"), F.col("id").alias("b"))
    least = placed.filter("outer").groupBy("hub").agg(F.min(-F.col("s")).alias("least"))
    # Hubs without an outer member have nothing left to look for.
    placed = placed.join(least, "hub")
    prefix = lambda other: F.col("d") - F.greatest(F.lit(1), F.ceil((-F.col("s") + other) / (2.0 * ALL) - 1e-9)) + 1
    sized = placed.withColumn("to_outer", prefix(F.col("least"))).withColumn("to_inner", F.when(F.col("outer"), prefix(-F.col("top"))))
    first = F.expr("slice(diff, 1, cast(greatest(to_outer, coalesce(to_inner, 0), 0) as int))")
    flat = sized.select("hub", "id", "n", "linked", "d", "s", "outer", "to_outer", "to_inner", F.posexplode(first).alias("at", "e"))
    side = lambda df, x: df.select("hub", "e", *[F.col(c).alias(c + x) for c in ("id", "n", "linked", "d", "s", "at")])
    near = flat.filter("at < to_outer")
    outer = near.filter("outer")
    enough = F.least(F.col("dx") - F.col("atx"), F.col("dy") - F.col("aty")) * (2 * ALL) >= -F.col("sx") - F.col("sy")
    sizes = F.least("nx", "ny") * SHARE[1] >= F.greatest("nx", "ny") * SHARE[0]
    # Of two unlinked outer members one order is enough; linked ones are connected through the hub.
    one = side(outer.filter("NOT linked"), "y").join(side(outer, "x"), ["hub", "e"]).filter((F.col("idx") != F.col("idy")) & (F.col("linkedx") | (F.col("idx") < F.col("idy"))))
    two = side(flat.filter("outer AND at < to_inner"), "y").join(side(near.filter("NOT outer"), "x"), ["hub", "e"]).filter("NOT (linkedx AND linkedy)")
    return sure, one.unionByName(two).filter(enough & sizes).select("hub", F.col("idx").alias("a"), F.col("idy").alias("b"))


def between_members(tested: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect the members of a hub that the hub does not connect."""
    rows = centred(tested, scratch)
    sure, joined = member_candidates(rows)
    pairs = joined.distinct()
    one = rows.select("hub", F.col("id").alias("a"), F.col("n").alias("na"), F.col("diff").alias("fa"))
    two = rows.select("hub", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("diff").alias("fb"))
    whole = pairs.join(one, ["hub", "a"]).join(two, ["hub", "b"])
    apart = F.size("fa") + F.size("fb") - 2 * F.size(F.array_intersect("fa", "fb"))
    found = whole.filter(apart * ALL <= LESS * (F.col("na") + F.col("nb"))).select("a", "b")
    return sure.unionByName(found).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every linked id but the components' smallest, by alternating large-star and small-star."""
    edges = scratch.put(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The minima are written out: a join of two plain exchanges can be split where a node has many neighbours.
        least = scratch.put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.put(large)
        lowest = scratch.put(large.groupBy("u").agg(F.min("v").alias("m")))
        linked = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = scratch.put(linked.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        now = state(small)
        for old in (edges, large, least, lowest):
            scratch.drop(old)
        edges = small
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable), kept and text_hash for every row."""
    spark = df.sparkSession
    scratch = Scratch(spark, "neardup")
    sigs = scratch.put(signatures(df, id_col, text, k))
    # Below, a class is its number; the text that stands for it is one of its smallest id.
    first = F.coalesce("id", F.lit((1 << 63) - 1))
    classes = sigs.filter("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.min_by("text_hash", first).alias("text_hash"), F.first("bands").alias("bands"))
    classes = scratch.put(classes.withColumn("class", F.monotonically_increasing_id()))
    rows = classes.select(F.col("class").alias("id"), F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = scratch.put(rows.join(sizes, "key"))
    mates = shared.groupBy("id").agg(F.sum("c").alias("mates"))
    ranked = shared.join(mates, "id").select("key", "id", "mates")
    hubs = ranked.groupBy("key").agg(F.max_by("id", F.struct("mates", -F.col("id"))).alias("hub"))
    pairs = scratch.put(shared.join(hubs, "key").filter("id != hub").select("hub", "id").distinct())
    needed = pairs.select("id").unionByName(pairs.select(F.col("hub").alias("id"))).distinct()
    wanted = classes.select(F.col("class"), "rep", "text_hash").join(needed.withColumnRenamed("id", "class"), "class")
    given = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"), text_hash(F.col(text)).alias("th"))
    same = given["id"].eqNullSafe(wanted["rep"]) & (given["th"] == wanted["text_hash"])
    texts = scratch.put(given.join(wanted, same).select(F.col("class").alias("id"), "t").dropDuplicates(["id"]))
    tested = scratch.put(against_hubs(pairs, texts, k))
    direct = tested.filter("linked").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    found = scratch.put(components(direct.unionByName(between_members(tested, scratch)), scratch))
    for table in (shared, pairs, texts, tested):  # nothing below reads them
        scratch.drop(table)
    # A component's smallest id: roots are classes, whose numbers do not follow ids.
    rooted = classes.select("class", "rep", "d1", "d2").join(found.withColumnRenamed("id", "class"), "class", "left").withColumn("root", F.coalesce("component", "class"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("least"))
    known = scratch.put(rooted.join(least, "root").select("d1", "d2", "least"))
    out = sigs.join(known, ["d1", "d2"], "left")
    component = F.when(F.col("d1").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), "text_hash")


def query(spark, sf_dir):
    """op7: near-duplicate components of all documents, on two-word shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, k=2).drop("text_hash")


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s), f AS (SELECT doc_id, unnest(s) AS e FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM f a JOIN f b ON a.e = b.e AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, component) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.component FROM r JOIN l ON l.a = r.doc_id
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, m.component_id, n.doc_id = m.component_id AS kept
FROM n JOIN (SELECT doc_id, min(component) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
"""
