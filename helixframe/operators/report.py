"""Report tables: sites with genes, gene accumulators, recodings, heat maps, run counters.

Positions are the VCF's 1-based ones, looked up as they are in 0-based
intervals, which is what published reports of this kind show.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import dna
from helixframe.functions.numeric import ratio, round_exact
from helixframe.operators import rangejoin

# Fixed values.
GENE_SITE_SCORE = 0.3
RECODE_SCORE = 0.2
GENE_SITES = 60
HYPER_PAD = 500
GENE_HORIZON = 21
HEAT_WINDOWS = (5_000_000, 1_000_000)


def report_chroms(contigs: DataFrame) -> DataFrame:
    return contigs.filter(F.col("name").startswith("chr") & ~F.col("name").contains("_") & (F.col("name") != "chrM"))


def with_genes(sites: DataFrame, genes: DataFrame, width: int = 1 << 16) -> DataFrame:
    """sites (ord, chrom, pos, ...) with gene: the first in order of start among the last GENE_HORIZON that start before the site."""
    out = rangejoin.first_containing(sites, genes.select("chrom", "start", "end", F.col("name").alias("gene"), F.col("ord").alias("gene_ord")), "pos", ["start", "gene_ord"], width=width, horizon=GENE_HORIZON)
    return out.drop("start", "end", "gene_ord")


def near_rescued(sites: DataFrame, rescued: DataFrame, pad: int = HYPER_PAD) -> DataFrame:
    """sites with has_hyper: a rescued read within pad bases."""
    hit = rangejoin.band(sites.select("ord", "chrom", "pos"), rescued.select("chrom", F.col("pos").alias("rp")), "pos", "rp", pad).select("ord").distinct().withColumn("has_hyper", F.lit(True))
    return sites.join(hit, "ord", "left").withColumn("has_hyper", F.coalesce("has_hyper", F.lit(False)))


def cds_sequences(cds: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """tx, gene, chrom, strand, start, end, frame, seq (in transcription order), blocks (in transcription order, with offsets)."""
    from helixframe.operators.transcripts import tile_sequences

    rows = cds.select("tx", "chrom", F.col("start").alias("s"), F.col("end").alias("e"))
    got = tile_sequences(rows, tiles, width, ["tx", "s", "e"])
    rows = cds.join(got.select("tx", F.col("s").alias("start"), F.col("e").alias("end"), "seq"), ["tx", "start", "end"], "left")
    each = rows.groupBy("tx").agg(F.first("gene").alias("gene"), F.first("chrom").alias("chrom"), F.first("strand").alias("strand"), F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct("start", "end", "phase", F.upper("seq").alias("seq")))).alias("b"))
    minus = F.col("strand") == "-"
    plain = F.array_join(F.transform("b", lambda x: F.coalesce(x["seq"], F.lit(""))), "")
    order = F.when(minus, F.reverse("b")).otherwise(F.col("b"))
    frame = F.when(minus, F.element_at("b", -1)["phase"]).otherwise(F.element_at("b", 1)["phase"])
    return each.select("tx", "gene", "chrom", "strand", "start", "end", frame.alias("frame"), F.when(minus, F.reverse(F.translate(plain, "ACGT", "TGCA"))).otherwise(plain).alias("seq"), F.transform(order, lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e"))).alias("blocks"))


def cds_offset(blocks: Column, minus: Column, pos: Column) -> Column:
    """Offset of a position in the coding sequence: bases of the blocks before its own, and its place there; null outside."""
    init = F.struct(F.lit(0).cast("long").alias("acc"), F.lit(None).cast("long").alias("hit"))

    def step(a: Column, x: Column) -> Column:
        inside = (x["s"] <= pos) & (pos < x["e"])
        own = a["acc"] + F.when(minus, x["e"] - 1 - pos).otherwise(pos - x["s"])
        return F.struct((a["acc"] + x["e"] - x["s"]).alias("acc"), F.when(a["hit"].isNull() & inside, own).otherwise(a["hit"]).alias("hit"))

    return F.aggregate(blocks, init, step, lambda a: a["hit"])


def recodings(sites: DataFrame, coding: DataFrame, width: int = 1 << 16) -> DataFrame:
    """ord, chrom, pos, tx, tx_gene, change: the first transcript, by (start, end, id), where A to G at the site changes the amino acid."""
    pairs = rangejoin.points_in_intervals(sites.select("ord", "chrom", "pos"), coding, "pos", width=width)
    minus = F.col("strand") == "-"
    at = cds_offset(F.col("blocks"), minus, F.col("pos")) - F.col("frame")
    pairs = pairs.withColumn("ci", at).filter("ci >= 0").withColumn("codon_i", F.floor(F.col("ci") / 3)).withColumn("ph", F.pmod("ci", F.lit(3)).cast("int"))
    codon = F.substring("seq", (F.col("frame") + F.col("codon_i") * 3).cast("int") + 1, F.lit(3))
    pairs = pairs.withColumn("codon", codon).filter((F.length("codon") == 3) & (F.substring("codon", F.col("ph") + 1, F.lit(1)) == "A"))
    changed = F.concat(F.substring("codon", F.lit(1), F.col("ph")), F.lit("G"), F.substring("codon", F.col("ph") + 2, F.lit(3)))
    pairs = pairs.withColumn("ra", dna.amino_acid(F.col("codon"))).withColumn("aa", dna.amino_acid(changed)).filter("ra <> aa")
    w = Window.partitionBy("ord").orderBy("start", "end", "tx")
    best = pairs.withColumn("__k", F.row_number().over(w)).filter("__k = 1")
    return best.select("ord", "chrom", "pos", "tx", F.col("gene").alias("tx_gene"), F.concat("ra", (F.col("codon_i") + 1).cast("string"), "aa").alias("change"))


def gene_table(sites: DataFrame, recoded: DataFrame | None = None) -> DataFrame:
    """gene, n, pass, maxscore, n_rec, sites (up to GENE_SITES by score). sites: ord, pos, score, vaf, depth, passed, gene."""
    s = sites.filter("gene is not null")
    if recoded is not None:
        s = s.join(recoded.select("ord", F.lit(1).alias("rec")), "ord", "left")
    else:
        s = s.withColumn("rec", F.lit(None).cast("int"))
    totals = s.groupBy("gene").agg(F.count("*").alias("n"), F.count_if("passed").alias("pass"), F.max(F.greatest("score", F.lit(0.0))).alias("maxscore"), F.count("rec").alias("n_rec"), F.min("ord").alias("first"))
    # a limit within the window is pushed below the shuffle, so a gene of many sites stays small
    w = Window.partitionBy("gene").orderBy(F.desc("score3"), "ord")
    scored = s.filter(F.col("score") >= GENE_SITE_SCORE).withColumn("score3", round_exact(F.col("score"), 3)).withColumn("vaf3", round_exact(F.col("vaf"), 3))
    top = scored.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= GENE_SITES)
    lists = top.groupBy("gene").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "pos", F.col("score3").alias("score"), F.col("vaf3").alias("vaf"), "depth", F.col("passed").cast("int").alias("pass")))), lambda x: x.dropFields("k")).alias("sites"))
    return totals.join(lists, "gene", "left")


def heat_map(sites: DataFrame, chroms: DataFrame, window: int, value: Column | None = None) -> DataFrame:
    """chrom, bin, heat: summed value (else counts) in each window of every contig (name, len), zeros included."""
    own = sites.groupBy("chrom", F.floor(F.col("pos") / window).alias("bin")).agg((F.sum(value) if value is not None else F.count("*")).alias("heat"))
    dense = chroms.select(F.col("name").alias("chrom"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("len") / window))).alias("bin"))
    return dense.join(own, ["chrom", "bin"], "left").withColumn("heat", F.coalesce("heat", F.lit(0)))


def run_counters(sites: DataFrame, recoded: DataFrame) -> DataFrame:
    n = recoded.agg(F.count("*").alias("recodings")).first()[0]
    return sites.agg(F.count("*").alias("events"), F.count_if("passed").alias("pass")).withColumn("recodings", F.lit(n))


def mapping_metrics(qc: dict, align: dict) -> dict:
    """Metrics of a run from its two summaries; what is absent counts as 0."""
    return {"reads_in": qc.get("reads_in", 0), "map_rate": align.get("map_rate", 0.0), "rescued": align.get("rescued", 0)}


def render(pack: dict, template: str, mark: str = "__DATA__") -> str:
    """The pack's JSON in place of the mark, which stands once; ``</`` can't end the script around it."""
    if template.count(mark) != 1:
        raise ValueError("the template holds its mark other than once")
    return template.replace(mark, json.dumps(pack, ensure_ascii=False, separators=(",", ":")).replace("</", "<\\/"))


def pass_rate(n: Column, total: Column) -> Column:
    return ratio(n, total)
