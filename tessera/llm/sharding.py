"""Sharding by histogram sort.

Rows are ordered by a 128-bit key: a hash of the text, then one of the id and the row's
number, so copies of a text stand together and a hot text, or a row that is repeated
as a whole, can still be cut between its rows.
Splitters are found without sorting: each round counts the exact bytes and rows
between candidate boundaries (probes) over all partitions, and refines the probes
inside the intervals whose boundary is not yet within tolerance. Then rows are
exchanged once.

Besides the splitters between shards, finer ones divide each shard into
sub-ranges with known row counts, so that a row's slot is a known offset plus its
rank in a small range; no task holds a shard. They are set by bytes and by rows, so a
mass of empty texts is divided too.

Law ``bytes``: sizes (UTF-8 bytes of the text plus 8) are near equal. A group of
equal texts stays in one shard unless a splitter cannot be within tolerance
without cutting it.

Rows are written out once with their numbers, as two reads may number them differently;
``keep`` names the columns to carry along where not all are wanted.

Edge cases: null text has size 8 and the checksum of the empty text; repeated rows
each get a slot (their order is arbitrary but fixed by the row number); fewer rows
than shards leave shards empty; an empty table gives an empty result; other
columns are kept, and columns of the names added are replaced.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions

SHARDS = 24
TOLERANCE = 0.004  # of a shard's bytes, for the boundaries between shards
FINE_TOLERANCE = 0.5  # of a sub-range's bytes, for the boundaries within
PROBES = 16  # per open boundary and round
LOW, SPAN = -(1 << 63), 1 << 64


def key_of(a: int, b: int) -> int:
    """One integer for a pair of signed 64-bit hashes, in the same order."""
    return ((a - LOW) << 64) | (b - LOW)


def pair_of(key: int) -> tuple[int, int]:
    return (key >> 64) + LOW, (key & (SPAN - 1)) + LOW


def place(bounds: list[int]) -> str:
    """SQL for the number of bounds at or below a row's key (k1, k2), by binary search."""
    if not bounds:
        return "0"
    pairs = [pair_of(b) for b in bounds]
    a, b = (f"cast(split('{','.join(str(p[i]) for p in pairs)}', ',') as array<bigint>)" for i in (0, 1))
    mid = "shiftright(s.lo + s.hi, 1)"
    below = f"({a}[{mid}] < k1 OR ({a}[{mid}] = k1 AND {b}[{mid}] <= k2))"
    step = f"CASE WHEN s.lo >= s.hi THEN s WHEN {below} THEN struct({mid} + 1 as lo, s.hi as hi) ELSE struct(s.lo as lo, {mid} as hi) END"
    return f"aggregate(sequence(1, {len(bounds).bit_length() + 1}), struct(0 as lo, {len(bounds)} as hi), (s, x) -> {step}, s -> s.lo)"


def histogram(light: DataFrame, bounds: list[int]) -> list[tuple[int, int, int | None, int | None]]:
    """(bytes, rows, smallest key, largest key) between each two bounds; one row a range reaches the driver."""
    low, high = F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high")
    got = light.withColumn("at", F.expr(place(bounds))).groupBy("at").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), low, high).collect()
    out: list = [(0, 0, None, None)] * (len(bounds) + 1)
    for r in got:
        out[r["at"]] = (r["b"], r["n"], key_of(*r["low"]), key_of(*r["high"]))
    return out


def split(light: DataFrame, shards: int, fine: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Bounds of all ranges in order, and for each range its (shard, rows before it in the shard).

    Each target is a share of all bytes, or of all rows. Its open interval is bounded by two known
    keys with exact bytes and rows below each; probes inside it are counted in the next round.
    """
    size = light.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high")).first()
    if not size["n"]:
        return [], [(0, 0)]
    total, low, high = (size["b"], size["n"]), key_of(*size["low"]), key_of(*size["high"])
    ranges = shards * fine
    # (measure, share of the total, slack, shard that starts there or -1); bytes are measure 0, rows 1.
    targets = [(0, i * total[0] / ranges, (TOLERANCE * total[0] / shards) if i % fine == 0 else FINE_TOLERANCE * total[0] / ranges, i // fine if i % fine == 0 else -1) for i in range(1, ranges)]
    targets += [(1, i * total[1] / ranges, FINE_TOLERANCE * total[1] / ranges, -1) for i in range(1, ranges)]
    below = {low: (0, 0), high + 1: total}  # exact bytes and rows below known keys
    keys = sorted(below)
    inside: dict[int, tuple[int, int]] = {low: (low, high)}  # smallest and largest key from a known key to the next

    def around(known: list[list[int]], measure: int, target: float) -> tuple[int, int]:
        i = bisect_right(known[measure], target)
        return keys[max(i - 1, 0)], keys[min(i, len(keys) - 1)]

    while True:
        open_: dict[int, tuple[int, int]] = {}
        known = [[below[k][m] for k in keys] for m in (0, 1)]
        for measure, target, slack, _ in targets:
            left, right = around(known, measure, target)
            near = min(target - below[left][measure], below[right][measure] - target)
            first, last = inside.get(left, (0, 0))
            # Copies of one text: cut between rows only where the tolerance asks for it.
            if near > slack and first < last:
                open_[left] = (first, last)
        if not open_:
            break
        probes = set()
        for first, last in open_.values():
            a, b = pair_of(first), pair_of(last)
            if a[0] != b[0]:  # between texts first: bounds at whole texts
                lo, hi = a[0] - LOW, b[0] - LOW
                step = max(1, (hi - lo) // (PROBES + 1))
                probes |= {x << 64 for x in range(lo + step, hi + 1, step)} | {(lo + 1) << 64, hi << 64}
            else:
                step = max(1, (last - first) // (PROBES + 1))
                probes |= set(range(first + step, last + 1, step)) | {first + 1, last}
        bounds = sorted(probes | set(keys[1:-1]))
        counted = histogram(light, bounds)
        keys, run, inside, below = [low, *bounds, high + 1], (0, 0), {}, {}
        for key, (b, n, first, last) in zip([low, *bounds], counted, strict=True):
            below[key] = run
            run = (run[0] + b, run[1] + n)
            if n:
                inside[key] = (first, last)
        below[high + 1] = total
        # Keep the bounds nearest to targets and those around open intervals only.
        kept, known = {low, high + 1}, [[below[k][m] for k in keys] for m in (0, 1)]
        for measure, target, _, _ in targets:
            kept |= {*around(known, measure, target)}
        merged, at = {}, None
        for key in keys[:-1]:
            at = key if key in kept else at
            if key in inside:
                first, last = inside[key]
                old = merged.get(at, (first, last))
                merged[at] = (min(old[0], first), max(old[1], last))
        inside, keys = merged, sorted(kept)
    chosen: list[tuple[int, int]] = []  # (key, shard that starts here or -1)
    known = [[below[k][m] for k in keys] for m in (0, 1)]
    for measure, target, _, shard_ in targets:
        best = min(around(known, measure, target), key=lambda k: (abs(below[k][measure] - target), k))
        chosen.append((best, shard_))
    starts = sorted({k for k, _ in chosen if low < k <= high})
    shard_at = [(k, s) for k, s in chosen if s > 0]
    final = histogram(light, starts)
    out, before, last_shard = [], 0, 0
    for key, (_, n, _, _) in zip([low, *starts], final, strict=True):
        shard = max([0, *(s for k, s in shard_at if k <= key)])
        before = 0 if shard != last_shard else before
        last_shard = shard
        out.append((shard, before))
        before += n
    return starts, out


def shard(df: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS, keep: list[str] | None = None) -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard to every row."""
    spark = df.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "k1", "k2", "__sh_row", "__sh_id"]
    keyed = df.select(
        *[c for c in (df.columns if keep is None else keep) if c not in added],
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("k1"),
        F.xxhash64(F.lit("order"), F.col(id_col)).alias("__sh_id"),
        F.monotonically_increasing_id().alias("__sh_row"),
    )
    scratch = Scratch(spark, "shard")
    keyed = scratch.put(keyed).withColumn("k2", F.xxhash64("__sh_id", "text_crc32", "__sh_row"))
    fine = max(2, -(-4 * shuffle_partitions(spark) // shards))
    starts, ranges = split(keyed.select("k1", "k2", "size"), shards, fine)
    listed = [f"cast(split('{','.join(str(r[i]) for r in ranges)}', ',') as array<bigint>)[__sh_range]" for i in (0, 1)]
    placed = keyed.withColumn("__sh_range", F.expr(place(starts)))
    rank = F.row_number().over(Window.partitionBy("__sh_range").orderBy("k1", "k2", "__sh_row")) - 1
    out = placed.withColumn("__sh_rank", rank)
    return (
        out.withColumn("law", F.lit("bytes"))
        .withColumn("shard", F.expr(listed[0]).cast("int"))
        .withColumn("slot", (F.expr(listed[1]) + F.col("__sh_rank")).cast("long"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
        .drop("k1", "k2", "__sh_range", "__sh_rank", "__sh_row", "__sh_id")
    )


def query(spark, sf_dir):
    """op2: shards of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs, keep=["doc_id"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
