"""Pileup of aligned bases, candidate editing sites, and merging of a template's observations.

alignments: ord, qname, rg, flag, chrom, pos (0-based), mapq, cigar, seq, qual
array<int>. ref_bases: chrom, pos, base (case kept), or tiles through ``ref_bases``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.functions import dna
from helixframe.operators import base_kernels

# Fixed values of the evidence model.
MIN_MAPQ = 20
MIN_BQ = 13
EXCLUDED_FLAGS = 0x4 | 0x100 | 0x800
CONFLICT = "N"
#: Bases of a piece of a tile that single bases are looked up in: finding a character walks the text before it.
PIECE = 512


def ref_bases(tiles: DataFrame) -> DataFrame:
    """tiles (chrom, start, seq) as a row for each base: for small references and tests."""
    return tiles.select("chrom", F.posexplode(F.split("seq", "")).alias("i", "base"), "start").filter("base <> ''").select("chrom", (F.col("start") + F.col("i")).alias("pos"), "base")


def bases_at(places: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """chrom, pos, base of places (chrom, pos, 0-based) by a join on tiles of one width; places off the reference are left out."""
    piece = lambda c: F.floor(F.pmod(c, F.lit(width)) / PIECE)
    at = places.select("chrom", "pos", F.floor(F.col("pos") / width).alias("tile"), piece(F.col("pos")).alias("piece"))
    cut = F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    t = tiles.select("chrom", F.floor(F.col("start") / width).alias("tile"), "start", cut.alias("piece", "seq")).withColumn("start", F.col("start") + F.col("piece") * PIECE)
    return at.join(t, ["chrom", "tile", "piece"]).filter(F.col("pos") < F.col("start") + F.length("seq")).select("chrom", "pos", base_at(F.col("seq"), F.col("start"), F.col("pos")).alias("base"))


def usable(alignments: DataFrame, min_mapq: int = MIN_MAPQ) -> DataFrame:
    """Mapped primary records of enough mapping quality; a plain filter, so it reaches the scan."""
    return alignments.filter((F.col("flag").bitwiseAND(EXCLUDED_FLAGS) == 0) & (F.col("mapq") >= min_mapq) & (F.col("pos") >= 0))


def aligned_bases(alignments: DataFrame, min_bq: int = MIN_BQ) -> DataFrame:
    """A row for each aligned base of good quality: ord, chrom, pos, base, bq. What discovery needs and no more."""
    each = _exploded(usable(alignments).select("ord", "chrom", "seq", "qual", F.explode(cg.blocks(F.col("pos"), F.col("cigar"))).alias("b")), ["ord", "chrom"], min_bq)
    return each.select("ord", "chrom", "pos", "base", "bq")


def _exploded(blocks: DataFrame, carried: list[str], min_bq: int) -> DataFrame:
    """blocks: seq, qual, b and the carried columns. A row for each good base, with pos, at (its place in the read), base, bq.

    The block's own bases and qualities are zipped before they are exploded, so a row carries one base, not the read.
    """
    own = lambda c: F.slice(c, F.col("b.read") + 1, F.col("b.n"))
    zipped = F.arrays_zip(own(F.split(F.upper("seq"), "")).alias("base"), own(F.col("qual")).alias("bq"))
    each = blocks.select(*carried, F.col("b.ref").alias("ref"), F.col("b.read").alias("read"), F.posexplode(zipped).alias("i", "x"))
    each = each.filter((F.col("x.bq") >= min_bq) & (F.col("x.bq") != 255) & F.col("x.base").isin(*dna.BASES))
    return each.select(*carried, (F.col("ref") + F.col("i")).alias("pos"), (F.col("read") + F.col("i")).alias("at"), F.col("x.base").alias("base"), F.col("x.bq").alias("bq"))


def observations(alignments: DataFrame, min_bq: int = MIN_BQ) -> DataFrame:
    """aligned_bases() with what scoring needs of the read: template, mapq, end_fraction, orientation, softclip_fraction, gap_nearness."""
    size = F.length("seq")
    reverse = F.col("flag").bitwiseAND(16) != 0
    last = F.col("flag").bitwiseAND(128) != 0
    reads = usable(alignments).filter(size > 0).select(
        "ord", "chrom", "seq", "qual", size.alias("size"),
        F.concat(F.coalesce("rg", F.lit("")), F.lit("\x00"), dna.template_name(F.col("qname"))).alias("template"),
        F.when(F.col("mapq") == 255, F.lit(float("nan"))).otherwise(F.col("mapq").cast("double")).alias("mapq"),
        F.when(reverse != last, 1).otherwise(0).alias("orientation"),
        (cg.total(F.col("cigar"), "S").cast("double") / F.greatest(size, F.lit(1))).alias("softclip_fraction"),
        cg.gaps(F.col("cigar")).alias("gaps"),
        F.explode(cg.blocks(F.col("pos"), F.col("cigar"))).alias("b"),
    )
    # records of a template meet as records: what is merged by (place, template) later needs no shuffle of single bases
    reads = reads.repartition("chrom", "template")
    each = _exploded(reads, ["ord", "chrom", "size", "template", "mapq", "orientation", "softclip_fraction", "gaps"], min_bq)
    nearest = F.array_min(F.transform("gaps", lambda g: F.abs(F.col("at") - g)))
    half = F.greatest(F.col("size") - 1, F.lit(1)) / F.lit(2.0)
    return each.select(
        "ord", "chrom", "pos", "template", "base", "bq", "mapq",
        (F.least(F.col("at"), F.col("size") - 1 - F.col("at")) / half).alias("end_fraction"),
        "orientation", "softclip_fraction",
        F.when(nearest.isNull(), 0.0).otherwise(1.0 / (1.0 + nearest)).alias("gap_nearness"),
    )


def merge_templates(obs: DataFrame) -> DataFrame:
    """One observation for each (chrom, pos, template): the best base quality wins; equal quality with another base is a conflict and goes.

    The fold in input order ends on the records of the highest quality: their first one's
    values stay if all of them have its base (of equal orders, the one with the lower mapping
    quality). A conflict is dropped altogether, so the other values of conflicting records don't matter.
    """
    code = F.instr(F.lit("ACGT"), F.col("base"))
    # one aggregate: the best quality's first record in order, and its least and greatest base
    # the position comes first: it is what the sort's prefix can tell apart
    top = obs.groupBy("pos", "template", "chrom").agg(
        F.max(F.struct("bq", (-F.col("ord")).alias("back"), (-F.coalesce("mapq", F.lit(-1.0))).alias("m"), "base", "mapq", "end_fraction", "orientation", "softclip_fraction", "gap_nearness")).alias("r"),
        F.max(F.col("bq") * 8 + code).alias("high"), F.max(F.col("bq") * 8 + 7 - code).alias("low"),
    )
    agree = F.pmod("high", F.lit(8)) == 7 - F.pmod("low", F.lit(8))
    r = F.col("r")
    return top.filter(agree).select("chrom", "pos", "template", r["bq"].alias("bq"), r["base"].alias("base"), *[r[c].alias(c) for c in ("mapq", "end_fraction", "orientation", "softclip_fraction", "gap_nearness")])


#: Columns of an observation.
OBSERVED = {"chrom": "string", "pos": "long", "template": "string", "bq": "int", "base": "string", "mapq": "double", "end_fraction": "double", "orientation": "int", "softclip_fraction": "double", "gap_nearness": "double"}


def _quals() -> Column:
    return F.arrow_udf(base_kernels.qual_bytes, "binary")("qual").alias("quals")


def _template_records(alignments: DataFrame) -> DataFrame:
    """What merging needs of usable records."""
    size = F.length("seq")
    reverse, last = F.col("flag").bitwiseAND(16) != 0, F.col("flag").bitwiseAND(128) != 0
    return usable(alignments).filter((size > 0) & F.col("qual").isNotNull() & F.col("cigar").isNotNull()).select(
        "chrom", F.concat(F.coalesce("rg", F.lit("")), F.lit("\x00"), dna.template_name(F.col("qname"))).alias("template"), F.col("pos").cast("long").alias("pos"), F.col("ord").cast("long").alias("ord"), "cigar", "seq", _quals(),
        F.when(F.col("mapq") == 255, F.lit(float("nan"))).otherwise(F.col("mapq").cast("double")).alias("mapq"),
        F.when(reverse != last, 1).otherwise(0).alias("orientation"),
        (cg.total(F.col("cigar"), "S").cast("double") / F.greatest(size, F.lit(1))).alias("softclip_fraction"),
    )


def _by_template(records: DataFrame) -> DataFrame:
    return records.repartition("chrom", "template").sortWithinPartitions("chrom", "template", "pos")


def merged_observations(alignments: DataFrame, min_bq: int = MIN_BQ, columns: tuple[str, ...] = tuple(OBSERVED)) -> DataFrame:
    """Some columns of merge_templates(observations(alignments)). Records of a template meet as records, in order of place, and are merged in their task: no single base is shuffled."""
    names = list(columns)
    return _by_template(_template_records(alignments)).mapInArrow(lambda batches: base_kernels.merge(batches, min_bq, names), ", ".join(f"{c} {OBSERVED[c]}" for c in names))


def path() -> Column:
    """The pieces of base_kernels.GRAIN places that the blocks of a record (pos, cigar) touch, ascending."""
    piece = lambda p: F.floor(p / base_kernels.GRAIN)
    each = F.transform(cg.blocks(F.col("pos"), F.col("cigar")), lambda x: F.sequence(piece(x["ref"]), piece(x["ref"] + x["n"] - 1)))
    return F.array_distinct(F.flatten(each)).alias("path")


def tallies(alignments: DataFrame, marks: DataFrame, radius: int, min_bq: int = MIN_BQ) -> DataFrame:
    """base_kernels.tally() of the merged observations: they are counted in the task that merges them, and no row is a base.

    marks: chrom, pos, cigar of the records to look at, with path() and its marks; other records are left out.
    """
    met = _template_records(alignments).join(marks, ["chrom", "pos", "cigar"])
    each = _by_template(met).mapInArrow(lambda batches: base_kernels.tally(batches, min_bq, radius), base_kernels.TALLY)
    return each.groupBy("what", "chrom", "pos", "kind", "v", "orientation").agg(*[F.sum(c).alias(c) for c in "nsp"])


def counted_bases(alignments: DataFrame, min_bq: int = MIN_BQ) -> DataFrame:
    """base_counts(aligned_bases(alignments)): bases are counted within each batch of records before they are rows."""
    reads = usable(alignments).filter(F.col("seq").isNotNull() & F.col("qual").isNotNull() & F.col("cigar").isNotNull()).select("chrom", F.col("pos").cast("long").alias("pos"), "cigar", "seq", _quals())
    part = reads.mapInArrow(lambda batches: base_kernels.counts(batches, min_bq), "chrom string, pos long, a long, c long, g long, t long")
    each = part.groupBy("chrom", "pos").agg(F.sum(F.col("a") + F.col("c") + F.col("g") + F.col("t")).alias("depth"), *[F.sum(b).alias(b) for b in "acgt"])
    return each.select("chrom", "pos", "depth", *"acgt")


def base_counts(bases: DataFrame) -> DataFrame:
    """chrom, pos, depth, a, c, g, t."""
    return bases.groupBy("chrom", "pos").agg(F.count("*").alias("depth"), *[F.count_if(F.col("base") == b).alias(b.lower()) for b in dna.BASES])


def candidates(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """Sites where an upper-case reference A was read as G, or T as C: chrom, pos (1-based), ref, depth, a, c, g, t, freq.

    A lower-case (masked) reference base is no site, nor are reads counted on it.
    """
    alt = F.when(F.col("ref") == "A", F.col("g")).when(F.col("ref") == "T", F.col("c"))
    found = counts.join(refs.select("chrom", "pos", F.col("base").alias("ref")).filter(F.col("base").isin("A", "T")), ["chrom", "pos"])
    found = found.filter(alt > 0)
    return found.select("chrom", (F.col("pos") + 1).alias("pos"), "ref", "depth", "a", "c", "g", "t", (alt / F.greatest(F.col("depth"), F.lit(1))).alias("freq"))


def discover(alignments: DataFrame, refs: DataFrame) -> DataFrame:
    """The sites in order of chromosome name and position."""
    return candidates(counted_bases(alignments), refs).orderBy("chrom", "pos")


def base_at(seq: Column, start: Column, pos: Column) -> Column:
    """Base of a tile at a position, N outside of it."""
    inside = (pos >= start) & (pos < start + F.length(seq))
    return F.when(inside, F.substring(seq, (pos - start).cast("int") + 1, F.lit(1))).otherwise("N")
