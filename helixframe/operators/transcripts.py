"""Transcripts: numbering, introns, spliced sequences, projection to the genome, attribution.

transcripts: name, chrom, minus, exons array<struct<s,e>> in transcript
direction (descending for minus), and tx_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.functions import dna


def number(transcripts: DataFrame) -> DataFrame:
    """Adds tx_id, dense and in order of name, without bringing all names to one task.

    Names are range-partitioned; each partition's offset is the sum of the counts before it.
    """
    spread = transcripts.repartitionByRange("name").sortWithinPartitions("name").withColumn("__p", F.spark_partition_id())
    spread = spread.persist()
    counts, offset, before = spread.groupBy("__p").count().collect(), {}, 0  # a row a partition
    for p, n in sorted(map(tuple, counts)):
        offset[p], before = before, before + n
    local = F.row_number().over(Window.partitionBy("__p").orderBy("name")) - 1
    base = F.element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]), F.col("__p")) if offset else F.lit(0)
    return spread.withColumn("tx_id", (local + base).cast("long")).drop("__p")


def ascending(exons: Column) -> Column:
    return F.array_sort(exons)


def tx_length(exons: Column) -> Column:
    return F.aggregate(exons, F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])


def valid(exons: Column, minus: Column) -> Column:
    """Exons exist, aren't empty, don't overlap, and run in transcript direction."""
    up = ascending(exons)
    inner = F.slice(up, 2, F.greatest(F.size(up) - 1, F.lit(0)))
    apart = F.forall(F.zip_with(F.slice(up, 1, F.greatest(F.size(up) - 1, F.lit(0))), inner, lambda a, b: a["e"] <= b["s"]), lambda ok: ok)
    direction = F.when(minus, exons == F.reverse(up)).otherwise(exons == up)
    return (F.size(exons) > 0) & F.forall(exons, lambda x: x["s"] < x["e"]) & apart & direction


def introns(transcripts: DataFrame) -> DataFrame:
    """name, chrom, minus, start, end of the gaps between neighbouring exons."""
    up = ascending(F.col("exons"))
    gaps = F.zip_with(F.slice(up, 1, F.greatest(F.size(up) - 1, F.lit(0))), F.slice(up, 2, F.greatest(F.size(up) - 1, F.lit(0))), lambda a, b: F.struct(a["e"].alias("start"), b["s"].alias("end")))
    return transcripts.select("name", "chrom", "minus", F.explode(gaps).alias("j")).select("name", "chrom", "minus", "j.start", "j.end").filter("end > start")


def junction_library(transcripts: DataFrame) -> DataFrame:
    """chrom, start, end, minus, support: the number of transcripts that share the intron."""
    return introns(transcripts).groupBy("chrom", "start", "end", "minus").agg(F.count("*").alias("support"))


def project(minus: Column, exons: Column, start: Column, length: Column) -> Column:
    """Genomic start and operations (M, N) of [start, start + length) of a transcript; what hangs over its ends is cut off.

    Returns struct<pos long, cigar>; null if nothing is left.
    """
    total = tx_length(exons)
    low, high = F.greatest(start, F.lit(0)).cast("long"), F.least(start + length, total).cast("long")
    # on the minus strand the interval counts from the other end
    from_ = F.when(minus, total - high).otherwise(low)
    to = F.when(minus, total - low).otherwise(high)
    init = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("pos"), F.lit(None).cast("long").alias("last"), F.array().cast(cg.TYPE).alias("ops"))

    def step(a: Column, x: Column) -> Column:
        size = x["e"] - x["s"]
        b, e = F.greatest(from_ - a["at"], F.lit(0).cast("long")), F.least(to - a["at"], size)
        used = e > b
        gs, ge = x["s"] + b, x["s"] + e
        gap = F.when(a["last"].isNotNull(), cg.push(a["ops"], F.lit("N"), gs - a["last"])).otherwise(a["ops"])
        return F.struct((a["at"] + size).alias("at"), F.when(used & a["pos"].isNull(), gs).otherwise(a["pos"]).alias("pos"), F.when(used, ge).otherwise(a["last"]).alias("last"), F.when(used, cg.push(gap, F.lit("M"), e - b)).otherwise(a["ops"]).alias("ops"))

    found = F.aggregate(ascending(exons), init, step)
    return F.when(high > low, F.struct(found["pos"].alias("pos"), found["ops"].alias("cigar")))


def tile_sequences(intervals: DataFrame, tiles: DataFrame, width: int, key: list[str]) -> DataFrame:
    """Sequence of each interval (chrom, s, e) from non-overlapping tiles (chrom, start, seq) of one width; case is kept.

    Joins on (chrom, tile), so the reference is never whole in one place.
    """
    dealt = intervals.withColumn("tile", F.explode(F.sequence(F.floor(F.col("s") / width), F.floor((F.col("e") - 1) / width))))
    t = tiles.select("chrom", F.floor(F.col("start") / width).alias("tile"), F.col("start").alias("ts"), "seq")
    j = dealt.join(t, ["chrom", "tile"])
    low = F.greatest(F.col("s"), F.col("ts")) - F.col("ts")
    high = F.least(F.col("e"), F.col("ts") + F.length("seq")) - F.col("ts")
    part = F.struct("ts", F.substring("seq", low.cast("int") + 1, F.greatest(high - low, F.lit(0)).cast("int")).alias("x"))
    parts = j.groupBy(*key).agg(F.array_sort(F.collect_list(part)).alias("p"))
    return parts.withColumn("seq", F.array_join(F.transform("p", lambda x: x["x"]), "")).drop("p")


def sequences(transcripts: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """name, seq: exons spliced in ascending order, all reversed for minus; empty if an exon is beyond its contig."""
    ex = transcripts.select("name", "minus", "chrom", F.posexplode(ascending(F.col("exons"))).alias("i", "x")).select("name", "minus", "chrom", "i", F.col("x.s").alias("s"), F.col("x.e").alias("e"))
    got = tile_sequences(ex, tiles, width, ["name", "minus", "i", "s", "e"])
    each = ex.select("name", "minus", "i", "s", "e").join(got.select("name", "i", "seq"), ["name", "i"], "left")
    whole = each.groupBy("name", "minus").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("seq", F.lit("")).alias("seq")))).alias("p"), F.bool_and(F.coalesce(F.length("seq"), F.lit(0)) == F.col("e") - F.col("s")).alias("inside"))
    seq = F.array_join(F.transform("p", lambda x: x["seq"]), "")
    return whole.select("name", F.when(~F.col("inside"), "").when(F.col("minus"), dna.revcomp(seq)).otherwise(seq).alias("seq"))


def attribute(projections: DataFrame, library: DataFrame) -> DataFrame:
    """Groups equal placements of a read and ranks them.

    projections: read, tx_id, chrom, pos, cigar, score. library: chrom, start, end, support.
    Returns read, chrom, pos, cigar_text, score, n_tx, junctions, supported, rank.
    """
    p = projections.withColumn("cigar_text", cg.text(F.col("cigar")))
    groups = p.groupBy("read", "chrom", "pos", "cigar_text").agg(F.max("score").alias("score"), F.countDistinct("tx_id").alias("n_tx"), F.first("cigar").alias("cigar"))
    j = groups.select("read", "chrom", "pos", "cigar_text", F.explode_outer(cg.introns(F.col("pos"), F.col("cigar"))).alias("j"))
    known = library.select("chrom", F.col("start").alias("js"), F.col("end").alias("je"), F.lit(1).alias("hit")).distinct()
    j = j.withColumn("js", F.col("j.start")).withColumn("je", F.col("j.end")).join(known, ["chrom", "js", "je"], "left")
    s = j.groupBy("read", "chrom", "pos", "cigar_text").agg(F.count("js").alias("junctions"), F.count("hit").alias("supported"))
    w = Window.partitionBy("read").orderBy(F.desc("score"), F.desc("supported"), F.desc("n_tx"), "chrom", "pos", "cigar_text")
    return groups.drop("cigar").join(s, ["read", "chrom", "pos", "cigar_text"]).withColumn("rank", F.row_number().over(w))
