"""Junction discovery: support, quality and the vote against annotated neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg

# Fixed values of the filter.
LEAST_SUPPORT = 2
LEAST_MAPQ = 20
LONGEST = 500_000
SHIFT = 3


def observed(alignments: DataFrame, copies: str | None = None) -> DataFrame:
    """chrom, start, end, minus, n, mapq_sum of the introns in alignments (strand: the record's). copies: a column of how many equal records each stands for."""
    n = (F.col(copies) if copies else F.lit(1)).cast("long")
    j = alignments.select("chrom", "mapq", n.alias("n"), (F.col("flag").bitwiseAND(16) != 0).alias("minus"), F.explode(cg.introns(F.col("pos"), F.col("cigar"))).alias("j"))
    return support(j.select("chrom", "j.start", "j.end", "minus", "n", (F.col("mapq").cast("long") * F.col("n")).alias("mapq_sum")))


def support(rows: DataFrame) -> DataFrame:
    """Sums over equal junctions."""
    return rows.groupBy("chrom", "start", "end", "minus").agg(F.sum("n").alias("n"), F.sum("mapq_sum").alias("mapq_sum"))


def gated(found: DataFrame) -> DataFrame:
    return found.filter((F.col("n") >= LEAST_SUPPORT) & (F.col("mapq_sum") >= F.col("n") * LEAST_MAPQ) & (F.greatest(F.col("end") - F.col("start"), F.lit(0)) <= LONGEST))


def vote(found: DataFrame, annotated: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Kept discoveries with their fate, and annotated junctions that they outvote.

    found: support(). A discovery within SHIFT bases of an annotated junction at both ends, on either
    strand, is voted on: the side seen more than twice as often stays; otherwise both do. An
    annotated junction's votes are its own exact sightings in found.
    """
    key = ["chrom", "start", "end", "minus"]
    kept = gated(found)
    if annotated is None:
        return kept.select(*key, "n", F.lit("kept").alias("fate")), kept.select(*key).limit(0)
    seen = found.select(*key, F.col("n").alias("seen"))
    lib = annotated.select(*key).distinct().join(seen, key, "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    lib = lib.select("chrom", F.col("start").alias("as"), F.col("end").alias("ae"), F.col("minus").alias("am"), "seen")
    width = SHIFT + 1
    dealt = kept.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - SHIFT) / width), F.floor((F.col("start") + SHIFT) / width))))
    near = dealt.join(lib.withColumn("bin", F.floor(F.col("as") / width)), ["chrom", "bin"]).filter((F.abs(F.col("start") - F.col("as")) <= SHIFT) & (F.abs(F.col("end") - F.col("ae")) <= SHIFT))
    most = near.groupBy(*key).agg(F.max("seen").alias("best"))
    fate = F.when(F.col("best").isNull(), "kept").when(F.col("n") > 2 * F.col("best"), "outvotes").when(F.col("best") > 2 * F.col("n"), "outvoted").otherwise("tie")
    judged = kept.join(most, key, "left").select(*key, "n", fate.alias("fate"))
    winners = judged.filter("fate = 'outvotes'").select(*key)
    removed = near.join(winners, key, "left_semi").filter(F.col("n") > 2 * F.col("seen")).select("chrom", F.col("as").alias("start"), F.col("ae").alias("end"), F.col("am").alias("minus")).distinct()
    return judged, removed


def merged_library(annotated: DataFrame, judged: DataFrame, removed: DataFrame) -> DataFrame:
    """The second pass's library: annotated less outvoted, and discoveries that weren't outvoted, with support summed."""
    key = ["chrom", "start", "end", "minus"]
    stay = annotated.join(removed, key, "left_anti").select(*key, "support")
    new = judged.filter("fate <> 'outvoted'").select(*key, F.col("n").alias("support"))
    return stay.unionByName(new).groupBy(*key).agg(F.sum("support").alias("support"))
