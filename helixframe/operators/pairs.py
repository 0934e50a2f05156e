"""Mates: relation, span, template length, insert and mapping statistics, rescue gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.functions import dna

# Fixed values.
PROPER_SPAN = 1000
MATE_SPAN = 500_000


def mates(alignments: DataFrame) -> DataFrame:
    """A row for each template with both mates placed: template, a (first in pair), b. The last record of a mate wins."""
    slot = F.when(F.col("flag").bitwiseAND(128) != 0, 2).otherwise(1)
    rows = alignments.filter(F.col("flag").bitwiseAND(0x4) == 0).select(dna.template_name(F.col("qname")).alias("template"), slot.alias("slot"), "ord", F.struct("chrom", "pos", (F.col("flag").bitwiseAND(16) != 0).alias("minus"), "cigar", "mapq").alias("r"))
    each = rows.groupBy("template").agg(F.max_by(F.when(F.col("slot") == 1, F.col("r")), F.when(F.col("slot") == 1, F.col("ord"))).alias("a"), F.max_by(F.when(F.col("slot") == 2, F.col("r")), F.when(F.col("slot") == 2, F.col("ord"))).alias("b"))
    return each.filter("a is not null and b is not null")


def intron_overlap(r: Column, left: Column, right: Column) -> Column:
    """Bases of the record's introns within [left, right)."""
    return F.aggregate(cg.introns(r["pos"], r["cigar"]), F.lit(0).cast("long"), lambda s, j: s + F.greatest(F.least(j["end"], right) - F.greatest(j["start"], left), F.lit(0).cast("long")))


def span(a: Column, b: Column) -> Column:
    """Outer span of a pair without the introns inside; each mate's introns count."""
    left = F.least(a["pos"], b["pos"]).cast("long")
    right = F.greatest(cg.ref_end(a["pos"], a["cigar"]), cg.ref_end(b["pos"], b["cigar"])).cast("long")
    return F.when(right <= left, 0).otherwise(F.greatest(right - left - intron_overlap(a, left, right) - intron_overlap(b, left, right), F.lit(0).cast("long")))


def relate(pairs: DataFrame) -> DataFrame:
    """Adds span, proper, tlen (from the first mate's side; 0 across contigs)."""
    a, b = F.col("a"), F.col("b")
    out = pairs.withColumn("span", F.when(a["chrom"] == b["chrom"], span(a, b)))
    proper = (a["chrom"] == b["chrom"]) & (a["minus"] != b["minus"]) & (F.col("span") <= PROPER_SPAN)
    tlen = F.when(a["chrom"] != b["chrom"], 0).when(a["pos"] <= b["pos"], F.col("span")).otherwise(-F.col("span"))
    return out.withColumn("proper", proper).withColumn("tlen", tlen)


def insert_stats(related: DataFrame) -> DataFrame:
    """count, mean and population deviation of |tlen| of proper pairs."""
    x = F.abs("tlen").cast("double")
    t = related.filter("proper").agg(F.count("*").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    mean = F.coalesce(F.try_divide("s", "n"), F.lit(0.0))
    var = F.coalesce(F.try_divide("q", "n"), F.lit(0.0)) - mean * mean
    return t.select(F.col("n").alias("n_pairs"), mean.alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("stdev"))


def mapq_histogram(alignments: DataFrame) -> DataFrame:
    """mapq 0 to 60 with counts, zeros included."""
    spark = alignments.sparkSession
    counts = alignments.filter(F.col("flag").bitwiseAND(0x4) == 0).groupBy(F.least("mapq", F.lit(60)).alias("mapq")).agg(F.count("*").alias("n"))
    return spark.range(61).select(F.col("id").cast("int").alias("mapq")).join(counts, "mapq", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def mate_gate(rescued: DataFrame, placed: DataFrame) -> DataFrame:
    """rescued with concordant: no placed mate, or a mate on the contig within MATE_SPAN in the other direction.

    rescued: template, slot, chrom, pos, minus. placed: template, slot, chrom, pos, minus.
    """
    m = placed.select("template", (F.lit(3) - F.col("slot")).alias("slot"), F.col("chrom").alias("mc"), F.col("pos").alias("mp"), F.col("minus").alias("mm"))
    j = rescued.join(m, ["template", "slot"], "left")
    ok = (F.col("mc") == F.col("chrom")) & (F.abs(F.col("mp") - F.col("pos")) <= MATE_SPAN) & (F.col("mm") != F.col("minus"))
    return j.withColumn("concordant", F.col("mc").isNull() | ok).drop("mc", "mp", "mm")


def first_of(rows: DataFrame, key: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key in input order."""
    return rows.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(order))).filter("__k = 1").drop("__k")


def merge_rescued(records: DataFrame, rescued: DataFrame) -> DataFrame:
    """records without those that a rescued one (qname, slot) replaces or that an earlier merge left; then the rescued ones."""
    stale = F.col("rescue_tag").isNotNull() & (F.col("rescue_tag") != "")
    kept = records.filter(~F.coalesce(stale, F.lit(False))).join(rescued.select("qname", "slot").distinct(), ["qname", "slot"], "left_anti")
    return kept.unionByName(rescued, allowMissingColumns=True)


def coordinate_order(records: DataFrame, contigs: DataFrame) -> DataFrame:
    """records in order of the header's contigs and position; unplaced last; ties in input order. A global sort that spills."""
    c = contigs.select(F.col("name").alias("chrom"), F.col("cid").alias("ref_id"))
    return records.join(F.broadcast(c), "chrom", "left").orderBy(F.col("ref_id").asc_nulls_last(), "pos", "ord")
