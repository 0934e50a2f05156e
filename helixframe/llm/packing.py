"""Packing documents into sequences as a cutting-stock problem, by column generation.

A document's ids are cut into full sequences and a remainder. Lengths are
counted in classes of UNIT tokens; a linear program over patterns of classes is
solved by column generation, where a knapsack dynamic program prices new
patterns. Patterns are rounded down, what is left is packed largest first, and
the pieces of each class, ranked, fill the slots of the patterns. If whole
remainders would leave more padding than ``max_padding``, they are cut at
multiples of 2048, 1024, 512 or 256 tokens, whichever is the first to do.

Only the class counts (SEQUENCE / UNIT numbers for each way to cut) come to the
driver, so the plan's cost doesn't depend on the input. Ranks are found in hash
buckets of each class. Texts are never shuffled, and read once: the checksums of every way to cut come with
the lengths.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import slices, trim, written
from helixframe.llm.tokens import SLICE_BYTES, default_path, word_tokens

SEQUENCE = 4096
UNIT = 8
CUTS = (4096, 2048, 1024, 512, 256)
END_ID = 2
MAX_PADDING = 0.01
#: Rows of a class that are ranked in one task: with 512 classes and 64 buckets at least.
BUCKET_ROWS = 1_000_000


def piece_lengths(n: int, cut: int) -> list[int]:
    """Full sequences, then the remainder cut at multiples of cut."""
    full, rest = divmod(n, SEQUENCE)
    return [SEQUENCE] * full + [cut] * (rest // cut) + ([rest % cut] if rest % cut else [])


def checksums(ids: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """CRC-32 of the full sequences, and of the remainder's pieces for each way to cut."""
    raw = memoryview(ids.astype("<u4").view(np.uint8))
    size, full = 4 * SEQUENCE, len(ids) // SEQUENCE
    rest = raw[full * size :]
    return [zlib.crc32(raw[k * size : (k + 1) * size]) for k in range(full)], [[zlib.crc32(rest[at : at + 4 * cut]) for at in range(0, len(rest), 4 * cut)] for cut in CUTS]


def token_pieces(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, doc_tokens and the CRC-32 of each piece: of full sequences, and of the remainder's pieces for each of CUTS."""

    def pieces(batches):
        trim()  # before the tokenizer comes on top of what earlier stages left
        tokens = word_tokens(path)
        end = np.array([end_id], dtype="<u2")
        for b in batches:
            for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                flat, at = tokens.flat(some)
                n, full, rest = [], [], []
                for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
                    ids = np.concatenate((flat[low:high], end))
                    n.append(len(ids))
                    f, r = checksums(ids)
                    full.append(f)
                    rest.append(r)
                yield pa.record_batch([b.column("doc_id").slice(first, len(n)), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.list_(pa.list_(pa.int64())))], names=["doc_id", "doc_tokens", "full", "rest"])
            trim()

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pieces, "doc_id string, doc_tokens long, full array<long>, rest array<array<long>>")


def class_counts(made: DataFrame) -> tuple[dict[int, dict[int, int]], int]:
    """Pieces by way to cut and class, and the sum of ids: at most len(CUTS) x SEQUENCE / UNIT numbers."""
    rest = F.pmod("doc_tokens", F.lit(SEQUENCE))
    rows = [F.struct(F.lit(c).alias("cut"), F.lit(SEQUENCE // UNIT).alias("class"), F.floor(F.col("doc_tokens") / SEQUENCE).alias("n")) for c in CUTS]
    rows += [F.struct(F.lit(c).alias("cut"), F.lit(c // UNIT).alias("class"), F.floor(rest / c).alias("n")) for c in CUTS]
    rows += [F.struct(F.lit(c).alias("cut"), F.ceil(F.pmod(rest, F.lit(c)) / UNIT).cast("int").alias("class"), F.lit(1).cast("long").alias("n")) for c in CUTS]
    each = made.select("doc_tokens", F.explode(F.array(*rows)).alias("x")).filter("x.class > 0 and x.n > 0")
    counts: dict[int, dict[int, int]] = {}
    for cut, c, n in each.groupBy("x.cut", "x.class").agg(F.sum("x.n")).collect():
        counts.setdefault(cut, {})[c] = n
    return counts, made.agg(F.sum("doc_tokens")).first()[0] or 0


def knapsack(size: np.ndarray, value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within room, by dynamic programming; counts by size."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for k in range(1, room + 1):
        best[k] = best[k - 1]
        fit = int(np.searchsorted(size, k, side="right"))
        if fit:
            got = best[k - size[:fit]] + value[:fit]
            i = int(got.argmax())
            if got[i] > best[k] + 1e-12:
                best[k], took[k] = got[i], i
    count, k = np.zeros(len(size), dtype=np.int64), room
    while k > 0:
        if took[k] < 0:
            k -= 1
        else:
            count[took[k]] += 1
            k -= size[took[k]]
    return float(best[room]), count


def column_generation(size: np.ndarray, demand: np.ndarray, room: int, gap: float = 5e-4, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, near the least number of sequences. Any round's basis meets the demand."""
    m = len(size)
    patterns = np.diag(room // size).astype(float)
    inverse = np.diag(1.0 / np.diag(patterns))
    used = inverse @ demand
    for _ in range(rounds):
        price = inverse.sum(axis=0)
        value, column = knapsack(size, np.maximum(price, 0), room)
        if value <= 1 + 1e-7 or price @ demand / value >= used.sum() * (1 - gap):
            break
        way = inverse @ column
        ratio = np.where(way > 1e-9, used / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        used = np.maximum(used - step * way, 0)
        used[out] = step
        patterns[:, out] = column
        inverse[out] /= way[out]
        others = way.copy()
        others[out] = 0
        inverse -= np.outer(others, inverse[out])
    return patterns.astype(np.int64), used


def pack_counts(demand: dict[int, int], room: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """demand: pieces by class (1 to room). Returns (times, [(class, pieces a sequence)]) that hold every piece."""
    size = np.array(sorted(c for c, n in demand.items() if n), dtype=np.int64)
    if not len(size):
        return []
    need = np.array([demand[c] for c in size.tolist()], dtype=np.int64)
    patterns, used = column_generation(size, need.astype(float), room)
    times = np.floor(used + 1e-6).astype(np.int64)
    out, left = [], need.copy()
    for k in np.argsort(-times, kind="stable"):
        n = int(times[k])
        held = patterns[:, k]
        while n and (left < n * held).any():  # rounding errors
            n -= 1
        if n:
            left -= n * held
            out.append((n, [(int(size[i]), int(held[i])) for i in np.flatnonzero(held)]))
    while left.any():  # largest first, then the best fill of the rest
        space, own = room, []
        for i in np.flatnonzero(left)[::-1]:
            k = min(int(left[i]), space // int(size[i]))
            if k:
                own.append((int(size[i]), k))
                space -= k * int(size[i])
        times_own = min(int(left[np.searchsorted(size, c)]) // k for c, k in own)
        for c, k in own:
            left[np.searchsorted(size, c)] -= k * times_own
        out.append((times_own, own))
    return out


def choose(counts: dict[int, dict[int, int]], tokens: int, max_padding: float) -> tuple[int, list]:
    """The first way to cut whose padding is small enough, else the one with the least."""
    best = None
    for cut in CUTS:
        found = pack_counts(counts.get(cut, {}), SEQUENCE // UNIT)
        padding = sum(n for n, _ in found) * SEQUENCE - tokens
        if best is None or padding < best[0]:
            best = (padding, cut, found)
        if padding <= max_padding * tokens:
            break
    return best[1], best[2]


def pack(docs: DataFrame, path: str, end_id: int = END_ID, max_padding: float = MAX_PADDING, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]

    made = token_pieces(docs, path, end_id, id_col, text_col)
    made = written(made.withColumn("row_id", F.monotonically_increasing_id()), "token-pieces")
    counts, tokens = class_counts(made)
    cut, found = choose(counts, tokens, max_padding)
    made = made.withColumn("crcs", F.concat("full", F.col("rest")[CUTS.index(cut)]))

    full = F.floor(F.col("doc_tokens") / SEQUENCE)
    pieces = made.select("row_id", "doc_id", "doc_tokens", F.posexplode("crcs").alias("k", "ids_crc32"))
    start = F.when(F.col("k") < full, F.col("k") * SEQUENCE).otherwise(full * SEQUENCE + (F.col("k") - full) * cut)
    pieces = pieces.withColumn("start", start.cast("long"))
    size = F.least(F.when(F.col("k") < full, SEQUENCE).otherwise(cut), F.col("doc_tokens") - F.col("start"))
    pieces = pieces.withColumn("length", size.cast("long"))
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / UNIT).cast("int")).drop("k")

    slots: dict[int, list[tuple[int, int, int]]] = {}
    at, filled = 0, {}
    for times, held in found:
        for c, k in held:
            low = filled.get(c, 0)
            filled[c] = low + k * times
            slots.setdefault(c, []).append((low, k, at))
        at += times
    # the plan has at most a slot for each class of each of SEQUENCE / UNIT patterns and what they leave
    plan = spark.createDataFrame(list(slots.items()), "class int, slots array<struct<low long, each long, base long>>")

    buckets = max(64, sum(counts.get(cut, {}).values()) // BUCKET_ROWS)
    ranked = pieces.withColumn("bucket", F.pmod(F.xxhash64("row_id", "start"), F.lit(buckets)))
    ranked = ranked.withColumn("own", F.row_number().over(Window.partitionBy("class", "bucket").orderBy("row_id", "start")) - 1)
    sizes = pieces.withColumn("bucket", F.pmod(F.xxhash64("row_id", "start"), F.lit(buckets))).groupBy("class", "bucket").count()
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    ranked = ranked.join(sizes, ["class", "bucket"]).withColumn("rank", F.col("own") + F.col("before"))
    # slots are in order of rank: a piece's is the last that begins at its rank or before
    dealt = ranked.join(F.broadcast(plan), "class")
    dealt = dealt.withColumn("slot", F.element_at("slots", F.size(F.filter("slots", lambda x: x["low"] <= F.col("rank")))))
    dealt = dealt.withColumn("sequence_id", (F.col("slot.base") + F.floor((F.col("rank") - F.col("slot.low")) / F.col("slot.each"))).cast("long"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row_id", "start").rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumn("offset", F.sum("length").over(inside) - F.col("length"))
    return dealt.select(F.col("doc_id").cast(kind).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs, default_path())
