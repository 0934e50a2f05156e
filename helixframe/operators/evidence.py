"""Evidence tags, mapping statistics, the pool of reads worth a second look, and input guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.functions import dna
from helixframe.functions.numeric import ratio
from helixframe.operators import pairs

# Fixed values.
COVERED = 0.7
DENSITY = 0.05
HUMAN_CHR1 = 248_956_422
SYNTHETIC = 10_000_000
TAG = ("seeds", "chain", "sub", "dq", "splice", "mm", "ea", "mapq_src", "origin", "cand")


def evidence_tag(row: dict[str, Column]) -> Column:
    """``seeds=..;chain=..;...`` in the fixed order of TAG. dq is the margin between chain and sub, at least 0."""
    row = row | {"dq": F.greatest(row["chain"] - row["sub"], F.lit(0))}
    return F.concat_ws(";", *[F.concat(F.lit(f"{k}="), F.coalesce(row[k].cast("string"), F.lit("-"))) for k in TAG])


def tag_value(tag: Column, key: str) -> Column:
    return F.try_element_at(F.str_to_map(tag, F.lit(";"), F.lit("=")), F.lit(key))


def nm(mismatches: Column, edits: Column, cigar: Column) -> Column:
    """Edit distance of a record: all substitutions and inserted or deleted bases."""
    return mismatches + edits + cg.total(cigar, "ID")


def is_decoy(chrom: Column) -> Column:
    return F.coalesce(chrom.startswith("decoy_"), F.lit(False))


def poor(aligned: Column, read_length: Column, mapq: Column, placed: Column) -> Column:
    """Unplaced, explaining under 0.9 of the read, or below quality 20: the mate may know better."""
    return ~placed | (aligned < F.lit(0.9) * read_length) | (mapq < 20)


def deferred(records: DataFrame) -> DataFrame:
    """Placed primary records that rescue should look at: clipped to under 0.7 of the read, or with too many ordinary
    mismatches (tag mm) for the aligned columns, or left by an earlier rescue. Decoys are not."""
    primary = (F.col("flag").bitwiseAND(0x904) == 0) & ~is_decoy(F.col("chrom")) & (F.length("seq") > 0)
    aligned, covered = cg.total(F.col("cigar"), "MID=X"), cg.total(F.col("cigar"), "MI=X")
    mm = tag_value(F.col("ek"), "mm").try_cast("int")
    clipped = covered < F.lit(COVERED) * F.length("seq")
    odd = (aligned > 0) & (mm / aligned >= DENSITY)
    return records.filter(primary & (clipped | F.coalesce(odd, F.lit(False)) | F.coalesce(F.col("re") == "collapsed", F.lit(False))))


def sequenced(records: DataFrame) -> DataFrame:
    """records as the reads were sequenced: name with mate mark, seq and qual turned back on the minus strand."""
    minus = F.col("flag").bitwiseAND(16) != 0
    mark = F.when(F.col("flag").bitwiseAND(1) != 0, F.when(F.col("flag").bitwiseAND(64) != 0, "/1").otherwise("/2")).otherwise("")
    return records.select("ord", F.concat("qname", mark).alias("name"), F.when(minus, dna.revcomp_strict(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(minus, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))


def align_stats(records: DataFrame, mates: DataFrame | None = None) -> DataFrame:
    """One row: total, mapped, unmapped, mapping_rate, decoys, junctions; and of pairs, if given, proper_pairs, insert_mean, insert_stdev."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    s = records.agg(F.count("*").alias("total_reads"), F.count_if(mapped).alias("mapped_reads"), F.count_if(is_decoy(F.col("chrom"))).alias("decoy_reads"), F.sum(F.when(mapped, cg.count(F.col("cigar"), "N")).otherwise(0)).alias("junctions_total"))
    s = s.select("*", (F.col("total_reads") - F.col("mapped_reads")).alias("unmapped_reads"), ratio(F.col("mapped_reads"), F.col("total_reads")).alias("mapping_rate"))
    if mates is None:
        return s
    i = pairs.insert_stats(mates).select(F.col("n_pairs").alias("proper_pairs"), F.col("mean").alias("insert_mean"), F.col("stdev").alias("insert_stdev")).first()
    return s.select("*", *[F.lit(i[c]).alias(c) for c in ("proper_pairs", "insert_mean", "insert_stdev")])


def check_species(contigs: DataFrame) -> None:
    """A chr1 must be the human one's length, or short enough to be synthetic."""
    row = contigs.filter("name = 'chr1'").select("len").first()
    if row and row[0] != HUMAN_CHR1 and row[0] >= SYNTHETIC:
        raise ValueError(f"chr1 has {row[0]} bases: not the genome that the model was fitted for")


def missing_contigs(transcripts: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contigs of transcripts that the reference lacks, with their transcripts: an anti-join."""
    return transcripts.groupBy("chrom").agg(F.count("*").alias("n")).join(contigs.select(F.col("name").alias("chrom")), "chrom", "left_anti")


def check_contigs(transcripts: DataFrame, contigs: DataFrame) -> int:
    """Transcripts on contigs that the reference lacks; more than half of them is an error."""
    total = transcripts.count()
    if not total:
        raise ValueError("no transcripts with exons")
    row = missing_contigs(transcripts, contigs).agg(F.sum("n"), F.min("chrom")).first()
    gone = row[0] or 0
    if gone * 2 > total:
        raise ValueError(f"contigs like {row[1]} are not in the reference: the files name contigs differently")
    return gone
