"""Read quality control: trimming, adapter removal, filtering, statistics.

reads: lane, ord, mate (1 or 2), name, seq, qual (Phred+33 text). Trimming is one
Arrow pass over both mates of a template, so overlaps are seen; filters and
statistics are Spark's own operations.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import dna, trim, trim_batches
from helixframe.functions.numeric import ratio

# The adapters that are always looked for, by mate.
ADAPTERS_1 = ["AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "CTGTCTCTTATACACATCT"]
ADAPTERS_2 = ["AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT", "CTGTCTCTTATACACATCT"]
PRESCAN = 10_000
DETECT = 5_000
#: Codes of qualities below 15.
_LOW = "".join(map(chr, range(1, 48)))


@dataclass
class Options:
    """Settings of a QC run; defaults as documented for the command line."""

    adapter_trim: bool = True
    adapters_1: list[str] = field(default_factory=list)
    adapters_2: list[str] = field(default_factory=list)
    detect_adapter: bool = False
    overlap: bool = True
    quality_trim: bool = False
    quality_cutoff: int = 20
    front_1: int = 0
    tail_1: int = 0
    front_2: int = 0
    tail_2: int = 0
    poly_g: str = "auto"  # auto, on, off
    min_length: int = 15
    max_n: int = 5
    max_low_share: float = 0.4
    keep_unpaired: bool = False


class QcError(ValueError):
    pass


def prescan(reads: DataFrame) -> str | None:
    """Checks the first reads' quality encoding and returns the two-colour instrument, if any."""
    first = reads.filter("mate = 1").orderBy("lane", "ord").limit(PRESCAN)
    codes = F.transform(F.split("qual", ""), lambda c: F.ascii(c))
    row = first.filter("qual <> ''").agg(F.min(F.array_min(codes)), F.max(F.array_max(codes)), F.first(dna.two_colour_instrument(F.col("name")), ignorenulls=True)).first()
    if first.isEmpty():
        raise QcError("no reads")
    if row[0] is not None and (row[0] < 33 or row[1] > 126 or row[0] >= 64):
        raise QcError(f"qualities aren't Phred+33: codes {row[0]} to {row[1]}")
    return row[2]


def check_pairs(reads: DataFrame) -> None:
    """Every template has both mates, and their names agree; reads the pairs once."""
    name = F.regexp_replace(dna.first_token(F.col("name")), "/[12]$", "")
    wrong = reads.groupBy("lane", "ord").agg(F.count("*").alias("n"), F.min(name).alias("a"), F.max(name).alias("b")).filter("n <> 2 or a <> b").limit(1).collect()
    if wrong:
        raise QcError(f"mates don't match at lane {wrong[0]['lane']}, record {wrong[0]['ord']}")


def choose_adapters(reads: DataFrame, options: Options) -> tuple[str, list[str]]:
    """Source (table, detected, none) and adapters for single-end reads, from the first DETECT of them."""
    table = options.adapters_1 or ADAPTERS_1
    if not options.adapter_trim:
        return "none", []
    if options.adapters_1 or not options.detect_adapter:
        return "table", table
    first = [r[0] for r in reads.filter("mate = 1").orderBy("lane", "ord").limit(DETECT).select("seq").collect()]  # a bounded sample
    hits = sum(any(trim.adapter_cut(s, a) is not None for a in table) for s in first)
    if hits * 100 >= len(first):
        return "table", table
    found = trim.detect_adapter(first)
    return ("detected", [found]) if found else ("none", [])


def _end(seq: str, qual: str, front: int, tail: int, o: Options, poly_g: bool, adapters: list[str]) -> tuple[str, str, int, int, int]:
    """seq, qual after trimming one end; bases cut by quality, poly-G, adapters (adapter bases -1: no hit)."""
    a, b = trim.fixed_bounds(len(seq), front, tail)
    seq, qual, by_q, by_g, by_a = seq[a:b], qual[a:b], 0, 0, -1
    if o.quality_trim:
        keep = trim.quality_keep(qual, o.quality_cutoff)
        by_q, seq, qual = len(seq) - keep, seq[:keep], qual[:keep]
    if poly_g:
        keep = trim.poly_g_keep(seq)
        by_g, seq, qual = len(seq) - keep, seq[:keep], qual[:keep]
    if adapters:
        seq, qual, by_a = _cut(seq, qual, adapters)
    return seq, qual, by_q, by_g, by_a


def _cut(seq: str, qual: str, adapters: list[str]) -> tuple[str, str, int]:
    n, hit = len(seq), False
    for x in adapters:
        at = trim.adapter_cut(seq[:n], x)
        if at is not None:
            hit, n = True, min(n, at)
    return seq[:n], qual[:n], len(seq) - n if hit else -1


TRIMMED = "lane int, ord long, mate int, name string, seq string, qual string, by_quality long, by_poly_g long, by_adapter long, adapter_hit boolean"


def trim_single(reads: DataFrame, o: Options, instrument: str | None, adapters: list[str]) -> DataFrame:
    """Fixed, quality, poly-G and adapter trims in turn, each over a batch of reads."""
    poly_g = o.poly_g == "on" or o.poly_g == "auto" and instrument is not None

    def run(batches):
        for b in batches:
            seq, qual = b.column("seq"), b.column("qual")
            by_q, by_g = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=np.int64)
            if o.front_1 or o.tail_1:
                size = pc.utf8_length(seq).to_numpy(zero_copy_only=False)
                start = np.minimum(o.front_1, size)
                stop = np.maximum(start, size - o.tail_1)
                seq, qual = _first(seq, stop, start), _first(qual, stop, start)
            if o.quality_trim:
                keep = trim_batches.quality_keep(qual, o.quality_cutoff).to_numpy(zero_copy_only=False)
                by_q = pc.utf8_length(seq).to_numpy(zero_copy_only=False) - keep
                seq, qual = _first(seq, keep), _first(qual, keep)
            if poly_g:
                keep = trim_batches.poly_g_keep(seq).to_numpy(zero_copy_only=False)
                by_g = pc.utf8_length(seq).to_numpy(zero_copy_only=False) - keep
                seq, qual = _first(seq, keep), _first(qual, keep)
            hit = np.zeros(b.num_rows, dtype=bool)
            by_a = np.zeros(b.num_rows, dtype=np.int64)
            if adapters:
                size = pc.utf8_length(seq).to_numpy(zero_copy_only=False)
                cut = trim_batches.adapters_keep(seq, adapters)
                hit = pc.is_valid(cut).to_numpy(zero_copy_only=False)
                keep = np.where(hit, pc.fill_null(cut, 0).to_numpy(zero_copy_only=False), size)
                by_a = size - keep
                seq, qual = _first(seq, keep), _first(qual, keep)
            yield pa.record_batch([b.column("lane"), b.column("ord"), b.column("mate"), b.column("name"), seq, qual, *[pa.array(x.astype(np.int64)) for x in (by_q, by_g, by_a)], pa.array(hit)], names=[c.split()[0] for c in TRIMMED.split(", ")])

    return reads.select("lane", "ord", "mate", "name", "seq", "qual").mapInArrow(run, TRIMMED)


def _first(texts: pa.Array, stop: np.ndarray, start: np.ndarray | None = None) -> pa.Array:
    """Letters from start (or the first) up to stop of each text."""
    start = np.zeros(len(texts), dtype=np.int64) if start is None else start
    if len(texts) == 0 or pc.any(pc.not_equal(pc.binary_length(texts), pc.utf8_length(texts))).as_py():
        return pa.array([t[i:j] for t, i, j in zip(texts.to_pylist(), start.tolist(), stop.tolist())], pa.string())
    data, at = trim_batches._bytes(texts)
    low, high = np.minimum(at[:-1] + start, at[1:]), np.minimum(at[:-1] + stop, at[1:])
    n = np.maximum(high - low, 0)
    ends = np.concatenate(([0], np.cumsum(n)))
    own = np.repeat(low - ends[:-1], n) + np.arange(ends[-1])
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[own]))


def trim_pairs(reads: DataFrame, o: Options, instrument: str | None) -> DataFrame:
    """Both mates of a template in one row, so one shuffle brings them together."""
    poly_g = o.poly_g == "on" or o.poly_g == "auto" and instrument is not None
    r = F.struct("name", "seq", "qual")
    pairs = reads.groupBy("lane", "ord").agg(F.max(F.when(F.col("mate") == 1, r)).alias("a"), F.max(F.when(F.col("mate") == 2, r)).alias("b"))

    def run(frames):
        for f in frames:
            rows = []
            for lane, ord_, a, b in zip(f["lane"], f["ord"], f["a"], f["b"]):
                ends = []
                for x, front, tail in ((a, o.front_1, o.tail_1), (b, o.front_2, o.tail_2)):
                    ends.append([x["name"], *_end(x["seq"], x["qual"], front, tail, o, poly_g, [])])
                if o.adapter_trim:
                    found = trim.overlap(ends[0][1], ends[1][1]) if o.overlap else None
                    for k, (e, own, table) in enumerate(zip(ends, (o.adapters_1, o.adapters_2), (ADAPTERS_1, ADAPTERS_2))):
                        if found:
                            if found[0] < 0:  # read through the insert: both ends are as long as it
                                e[5] = len(e[1]) - found[1] if len(e[1]) > found[1] else -1
                                e[1], e[2] = e[1][: found[1]], e[2][: found[1]]
                        else:
                            e[1], e[2], e[5] = _cut(e[1], e[2], own or ([] if o.overlap else table))
                for mate, e in enumerate(ends, 1):
                    rows.append((lane, ord_, mate, e[0], e[1], e[2], e[3], e[4], max(e[5], 0), e[5] >= 0))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TRIMMED.split(", ")])

    return pairs.mapInPandas(run, TRIMMED)


def fail_reason(seq: Column, qual: Column, adapter_hit: Column, o: Options) -> Column:
    """The first reason to drop an end: too short (or nothing but adapter), too many N, low quality; null to keep it."""
    n = F.length(seq) - F.length(F.translate(seq, "Nn", ""))
    low = F.length(qual) - F.length(F.translate(qual, _LOW, ""))
    return (
        F.when((F.length(seq) < o.min_length) & (F.length(seq) == 0) & adapter_hit, "adapter_only")
        .when(F.length(seq) < o.min_length, "too_short")
        .when(n > o.max_n, "too_many_n")
        .when(low.cast("double") > F.length(seq) * F.lit(o.max_low_share), "low_quality")
    )


def judged(trimmed: DataFrame, o: Options, paired: bool) -> DataFrame:
    """trimmed with reason, kept (written to the paired output) and unpaired (its mate alone was dropped)."""
    t = trimmed.withColumn("reason", fail_reason(F.col("seq"), F.col("qual"), F.col("adapter_hit"), o))
    if not paired:
        return t.withColumn("kept", F.col("reason").isNull()).withColumn("unpaired", F.lit(False))
    bad = t.filter("reason is not null").select("lane", "ord", (F.lit(3) - F.col("mate")).alias("mate"), F.lit(True).alias("mate_failed"))
    t = t.join(bad, ["lane", "ord", "mate"], "left").withColumn("mate_failed", F.coalesce("mate_failed", F.lit(False)))
    ok = F.col("reason").isNull()
    return t.withColumn("kept", ok & ~F.col("mate_failed")).withColumn("unpaired", ok & F.col("mate_failed") & F.lit(o.keep_unpaired)).drop("mate_failed")


# ---- statistics ----------------------------------------------------------------------


def cycles(reads: DataFrame) -> DataFrame:
    """A row for each base: side columns, cycle, base (upper case, else N), q."""
    s = reads.select("mate", F.posexplode(F.arrays_zip(F.split("seq", "").alias("s"), F.split("qual", "").alias("q"))).alias("cycle", "x")).filter("x.s <> ''")
    base = F.upper("x.s")
    return s.select("mate", "cycle", F.when(base.isin(*dna.BASES), base).otherwise("N").alias("base"), F.greatest(F.ascii("x.q") - 33, F.lit(0)).alias("q"))


def cycle_stats(reads: DataFrame) -> DataFrame:
    """mate, cycle, n, q_sum, and counts of A, C, G, T, N. Whole numbers only; partial sums before the shuffle."""
    return cycles(reads).groupBy("mate", "cycle").agg(F.count("*").alias("n"), F.sum("q").alias("q_sum"), *[F.count_if(F.col("base") == b).alias(b.lower()) for b in "ACGTN"])


def totals(reads: DataFrame) -> DataFrame:
    """mate, reads, bases, q20, q30, gc, n_bases."""
    q = F.filter(F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33), lambda v: v > -33)
    at_least = lambda k: F.size(F.filter(q, lambda v: v >= k))
    gone = lambda chars: F.length("seq") - F.length(F.translate("seq", chars, ""))
    r = reads.select("mate", F.length("seq").alias("bases"), at_least(20).alias("q20"), at_least(30).alias("q30"), gone("CGcg").alias("gc"), (F.length("seq") - gone("ACGTacgt")).alias("n_bases"))
    return r.groupBy("mate").agg(F.count("*").alias("reads"), *[F.sum(c).alias(c) for c in ("bases", "q20", "q30", "gc", "n_bases")])


def rates(t: DataFrame) -> DataFrame:
    return t.withColumn("q20_rate", ratio(F.col("q20"), F.col("bases"))).withColumn("q30_rate", ratio(F.col("q30"), F.col("bases"))).withColumn("gc_rate", ratio(F.col("gc"), F.col("bases")))


def counters(j: DataFrame) -> dict:
    """Trims, fail reasons and outputs of judged(), in one pass."""
    reasons = ["adapter_only", "too_short", "too_many_n", "low_quality"]
    row = j.agg(
        F.count("*").alias("reads_in"), F.sum("by_quality").alias("quality_bases"), F.sum("by_poly_g").alias("poly_g_bases"), F.count_if(F.col("by_poly_g") > 0).alias("poly_g_reads"),
        F.count_if("adapter_hit").alias("adapter_reads"), F.sum("by_adapter").alias("adapter_bases"), F.count_if("kept").alias("reads_out"), F.count_if("unpaired").alias("unpaired_written"),
        *[F.count_if(F.col("reason") == x).alias(x) for x in reasons],
    ).first()
    return {k: v or 0 for k, v in row.asDict().items()}


def run(reads: DataFrame, options: Options | None = None, paired: bool | None = None) -> tuple[DataFrame, dict]:
    """The judged reads and the report (qc.json's content)."""
    o = options or Options()
    paired = not reads.filter("mate = 2").isEmpty() if paired is None else paired
    instrument = prescan(reads)
    if paired:
        check_pairs(reads)
        source, trimmed = None, trim_pairs(reads, o, instrument)
    else:
        source, adapters = choose_adapters(reads, o)
        trimmed = trim_single(reads, o, instrument, adapters)
    j = judged(trimmed, o, paired).persist()
    side = lambda d: {f"r{r['mate']}": r.asDict() for r in rates(totals(d)).orderBy("mate").collect()}
    return j, {"instrument": instrument, "adapter_source": source, "before": side(reads), "after": side(j.filter("kept or unpaired")), **counters(j)}
