"""Text tables: BED, site lists, scores, GTF, VCF; and ordered text sinks.

Readers are spark.read.text and column expressions, so files split and the work
is distributed. A malformed line raises with its text when a strict reader meets it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import numeric


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"))


def _strict(ok: Column, what: str) -> Column:
    """True, or an error that shows the line."""
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), F.col("line"))).cast("boolean"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end of lines with three fields or more; blank, ``#`` and ``track`` lines are skipped."""
    t = _lines(spark, path).filter((F.trim("line") != "") & ~F.col("line").startswith("#") & ~F.col("line").startswith("track"))
    t = t.withColumn("f", F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " "))
    start, end = F.get("f", 1).try_cast("long"), F.get("f", 2).try_cast("long")
    return t.filter(_strict(start.isNotNull() & end.isNotNull(), "invalid BED line")).select(F.get("f", 0).alias("chrom"), start.alias("start"), end.alias("end"))


def read_repeats(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    """BED intervals of known contigs (name) that aren't empty."""
    t = read_bed(spark, path).filter("end > start")
    return t.join(F.broadcast(contigs.select(F.col("name").alias("chrom"))), "chrom", "left_semi")


def read_sites(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """ord, chrom, pos of a list of two fields. strict: positions are 1 or more."""
    t = _lines(spark, path).filter("line <> ''").withColumn("ord", F.monotonically_increasing_id()).withColumn("f", F.split("line", "\t"))
    pos = F.get("f", 1).try_cast("long")
    ok = (F.size("f") == 2) & pos.isNotNull()
    return t.filter(_strict(ok & (pos >= 1) if strict else ok, "invalid site")).select("ord", F.get("f", 0).alias("chrom"), pos.alias("pos"))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a candidate BED, numbers as they are written: chrom, pos (1-based), ref, depth, a, c, g, t, freq."""
    t = _lines(spark, path).filter("line <> ''").withColumn("ord", F.monotonically_increasing_id()).withColumn("f", F.split("line", "\t"))
    t = t.filter(_strict(F.size("f") >= 10, "invalid candidate"))
    names = ["ref", "depth", "a", "c", "g", "t", "freq"]
    return t.select("ord", F.get("f", 0).alias("chrom"), F.get("f", 2).cast("long").alias("pos"), *[F.get("f", i + 3).alias(n) for i, n in enumerate(names)])


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    t = _lines(spark, path).filter("line <> ''").withColumn("ord", F.monotonically_increasing_id()).withColumn("f", F.split("line", "\t"))
    score = F.get("f", 2).try_cast("double")
    return t.filter(_strict(score.isNotNull(), "invalid score")).select("ord", F.get("f", 0).alias("chrom"), F.get("f", 1).cast("long").alias("pos"), score.alias("score"))


# ---- GTF -----------------------------------------------------------------------------


def attribute(attrs: Column, key: str) -> Column:
    """Value of a quoted attribute; semicolons inside quotes are part of it."""
    v = F.regexp_extract(attrs, f'(?:^|;)\\s*{key}\\s+"([^"]*)"', 1)
    return F.when(attrs.rlike(f'(?:^|;)\\s*{key}\\s+"'), v)


def attribute_bare(attrs: Column, key: str) -> Column:
    """Value of an attribute with or without quotes, after a space, tab or equals sign."""
    v = F.regexp_extract(attrs, f'(?:^|;)\\s*{key}[ \\t=]+(?:"([^"]*)"|([^;\\s]+))', 1)
    w = F.regexp_extract(attrs, f'(?:^|;)\\s*{key}[ \\t=]+(?:"([^"]*)"|([^;\\s]+))', 2)
    return F.nullif(F.when(v != "", v).otherwise(w), F.lit(""))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """ord, chrom, feature, start (0-based), end, strand, phase, attrs; comments and rows of under nine fields are skipped."""
    t = _lines(spark, path).withColumn("ord", F.monotonically_increasing_id()).filter(~F.col("line").startswith("#")).withColumn("f", F.split("line", "\t"))
    g = lambda i: F.get("f", i)
    return t.filter(F.size("f") >= 9).select("ord", g(0).alias("chrom"), g(2).alias("feature"), (g(3).cast("long") - 1).alias("start"), g(4).cast("long").alias("end"), g(6).alias("strand"), g(7).try_cast("int").alias("phase"), g(8).alias("attrs"))


def transcripts(gtf: DataFrame, biotypes: tuple[str, ...] | None = None) -> DataFrame:
    """name, chrom, minus, exons array<struct<s,e>> in transcript direction, tx_id by name. biotypes: keep these only."""
    exons = gtf.filter("feature = 'exon'").withColumn("name", attribute_bare(F.col("attrs"), "transcript_id")).filter("name is not null")
    if biotypes:
        kind = F.coalesce(attribute_bare(F.col("attrs"), "transcript_type"), attribute_bare(F.col("attrs"), "transcript_biotype"), attribute_bare(F.col("attrs"), "gene_type"), attribute_bare(F.col("attrs"), "gene_biotype"))
        exons = exons.filter(kind.isin(*biotypes))
    each = exons.groupBy("name").agg(F.min_by("chrom", "ord").alias("chrom"), (F.min_by("strand", "ord") == "-").alias("minus"), F.array_sort(F.collect_list(F.struct(F.col("start").alias("s"), F.col("end").alias("e")))).alias("x"))
    from helixframe.operators.transcripts import number

    return number(each.select("name", "chrom", "minus", F.when(F.col("minus"), F.reverse("x")).otherwise(F.col("x")).alias("exons")))


def genes(gtf: DataFrame) -> DataFrame:
    """chrom, start, end, name, ord."""
    name = F.coalesce(attribute(F.col("attrs"), "gene_name"), attribute(F.col("attrs"), "gene_id"), F.lit(""))
    return gtf.filter("feature = 'gene'").select("chrom", "start", "end", name.alias("name"), "ord")


def cds(gtf: DataFrame) -> DataFrame:
    name = F.coalesce(attribute(F.col("attrs"), "gene_name"), attribute(F.col("attrs"), "gene_id"), F.lit(""))
    return gtf.filter("feature = 'CDS'").select(attribute(F.col("attrs"), "transcript_id").alias("tx"), name.alias("gene"), "chrom", "strand", "start", "end", F.coalesce("phase", F.lit(0)).alias("phase"))


# ---- sinks ---------------------------------------------------------------------------


def candidate_lines(sites: DataFrame) -> DataFrame:
    """The line of each candidate, with the frequency to eight places and a tab at the end."""
    c = lambda n: F.col(n).cast("string")
    return sites.select(F.concat(F.concat_ws("\t", "chrom", (F.col("pos") - 1).cast("string"), c("pos"), "ref", *[c(n) for n in ("depth", "a", "c", "g", "t")], numeric.print_fixed(F.col("freq"), 8)), F.lit("\t")).alias("line"))


def score_lines(scores: DataFrame) -> DataFrame:
    return scores.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), numeric.print_shortest(F.col("score"))).alias("line"))


def write_lines(lines: DataFrame, path: str, order: list[str] | None = None, single: bool = False) -> None:
    """Text files whose names sort as their lines do. single: one file, for a reader that wants one."""
    out = lines.orderBy(*order) if order else lines
    out = out.select("line")
    (out.coalesce(1) if single else out).write.mode("overwrite").text(path)
