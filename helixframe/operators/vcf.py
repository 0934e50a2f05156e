"""Records and text of the site table in VCF 4.2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import dna, numeric

# Fixed values of the format: header lines after the file format and before the contigs.
HEADER = [
    '##FILTER=<ID=PASS,Description="Score at or above the threshold">',
    '##FILTER=<ID=LOW_SCORE,Description="Score below the threshold">',
    '##INFO=<ID=ESP_SCORE,Number=1,Type=Float,Description="Site score">',
    '##INFO=<ID=VAF,Number=1,Type=Float,Description="Edited share of the depth">',
    '##INFO=<ID=DEPTH,Number=1,Type=Integer,Description="Read depth">',
    '##INFO=<ID=AC,Number=1,Type=Integer,Description="Edited reads">',
    '##INFO=<ID=STRAND,Number=1,Type=String,Description="Strand of the edited transcript">',
]


def records(sites: DataFrame, threshold: float) -> DataFrame:
    """sites: chrom, pos, ref, score and, if counted, depth, a, c, g, t, freq. Adds alt, filter, strand, ac."""
    counted = "depth" in sites.columns
    ac = F.when(F.col("ref") == "A", F.col("g")).otherwise(F.col("c")) if counted else F.lit(None).cast("long")
    return sites.select(
        "*", dna.edit_alt(F.col("ref")).alias("alt"), F.when(F.col("score") >= threshold, "PASS").otherwise("LOW_SCORE").alias("filter"),
        dna.edit_strand(F.col("ref")).alias("strand"), ac.alias("ac"),
    )


def lines(rows: DataFrame) -> DataFrame:
    """chrom, pos, line. Counts are left out for sites that come from a list."""
    info = [F.concat(F.lit("ESP_SCORE="), numeric.print_shortest(F.col("score")))]
    if "depth" in rows.columns:
        info += [F.concat(F.lit("VAF="), numeric.print_fixed(F.col("freq"), 8)), F.concat(F.lit("DEPTH="), F.col("depth").cast("string")), F.concat(F.lit("AC="), F.col("ac").cast("string"))]
    info.append(F.concat(F.lit("STRAND="), F.col("strand")))
    return rows.select("chrom", "pos", F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), "filter", F.concat_ws(";", *info)).alias("line"))


def header(contigs: list[tuple[str, int]]) -> list[str]:
    return ["##fileformat=VCFv4.2", *HEADER, *[f"##contig=<ID={c},length={n}>" for c, n in contigs], "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]


def parse(lines_: DataFrame) -> DataFrame:
    """Text lines as chrom, pos, ref, alt, passed, score, vaf, depth; absent keys count as 0."""
    rows = lines_.filter(~F.col("value").startswith("#") & (F.col("value") != "")).select(F.split("value", "\t").alias("f"))
    info = F.str_to_map(F.get("f", 7), F.lit(";"), F.lit("="))
    number = lambda k: F.coalesce(F.try_element_at(info, F.lit(k)).try_cast("double"), F.lit(0.0))
    return rows.select(F.get("f", 0).alias("chrom"), F.get("f", 1).cast("long").alias("pos"), F.get("f", 3).alias("ref"), F.get("f", 4).alias("alt"), (F.get("f", 6) == "PASS").alias("passed"), number("ESP_SCORE").alias("score"), number("VAF").alias("vaf"), number("DEPTH").cast("long").alias("depth"))
