"""Queries of clipped and run-through ends over introns, on reads planted in the reference without period, with their SQL.

A row of part plants one read. In SQL the starts of reads are ends in a reversed contig.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.operators.align import kernels, splits
from helixframe.operators.transcripts import tile_sequences
from helixframe.plans import synth
from helixframe.session import shared_path, written

QUERIES: dict = {}
SQL: dict = {}
SIZE = synth.RANDOM_TILES * synth.RANDOM_TILE


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def contigs(spark: SparkSession) -> DataFrame:
    """chrom, ref: the two synthetic contigs, 20,480 bases each."""
    t = synth.random_tiles(spark).groupBy("chrom").agg(F.array_sort(F.collect_list(F.struct("start", "seq"))).alias("t"))
    return t.select("chrom", F.array_join(F.transform("t", lambda x: x["seq"]), "").alias("ref"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ord, at_end, minus, chrom, ref, s."""
    k = F.col("p_partkey").cast("long")
    t = spark.read.parquet(f"{sf_dir}/part.parquet").select(k.alias("ord"), (F.pmod(k, F.lit(4)) < 2).alias("at_end"), (F.pmod(F.floor(k / 2), F.lit(2)) == 1).alias("minus"), F.format_string("rnd%d", F.pmod(k, F.lit(2)) + 1).alias("chrom"), (F.pmod(k * 37, F.lit(17000)) + 100).alias("s"))
    return t.repartition(spark.sparkContext.defaultParallelism, "ord").join(F.broadcast(contigs(spark)), "chrom")  # two rows


def _cut(start: Column, end: Column, text: str = "ref") -> Column:
    return F.substring(text, start.cast("int") + 1, (end - start).cast("int"))


def _first(motif: Column, start: Column) -> Column:
    """The first place of the motif from start on, start - 1 if there is none."""
    return F.greatest(F.call_function("locate", motif, F.col("ref"), start.cast("int") + 1), start) - 1


def _records(rows: DataFrame, *more: str) -> DataFrame:
    """rows: ord, at_end, chrom, pos, seq, a (the outermost block's length, the other end's is whole), clip."""
    m, s = (F.struct(F.lit(op).alias("op"), F.col(n).cast("int").alias("n")) for op, n in (("M", "a"), ("S", "clip")))
    cigar = F.when(F.col("clip") == 0, F.array(m)).when(F.col("at_end"), F.array(m, s)).otherwise(F.array(s, m))
    return rows.select("ord", "at_end", "chrom", F.col("pos").cast("long").alias("pos"), cigar.alias("cigar"), "seq", *more)


_PART = f"""WITH {synth.RANDOM_SQL},
con AS (SELECT chrom, false AS rev, seq FROM rnd UNION ALL SELECT chrom, true, reverse(seq) FROM rnd),
par AS (
  SELECT p_partkey::BIGINT AS ord, p_partkey % 4 < 2 AS at_end, (p_partkey // 2) % 2 = 1 AS minus, 'rnd' || (p_partkey % 2 + 1) AS chrom, p_partkey * 37 % 17000 + 100 AS s FROM part)"""


def _wrong(x: str, y: str) -> str:
    return f"coalesce(list_sum([CASE WHEN {x}[j] = {y}[j] OR {y}[j] = 'A' AND {x}[j] = 'G' OR {y}[j] = 'T' AND {x}[j] = 'C' THEN 0 ELSE 1 END FOR j IN range(1, length({x}) + 1)]), 0)"


# ---- new introns ------------------------------------------------------------------------


def planted_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a clipped end behind an intron of a canonical signal, whose body runs up to 3 bases over or stops 2 short; t_start and t_end tell the intron."""
    t = _parts(spark, sf_dir)
    d = _first(F.when(F.col("minus"), "CT").otherwise("GT"), F.col("s"))
    t = t.withColumn("d", d).withColumn("q", _first(F.when(F.col("minus"), "AC").otherwise("AG"), F.col("d") + 60 + F.pmod(F.col("ord") * 13, F.lit(1400))) + 2)
    t = t.withColumn("n", 10 + F.pmod("ord", F.lit(13))).withColumn("over", F.pmod("ord", F.lit(6)) - 2)
    # what is cut out of a contig lies from 50 bases before the intron to 50 behind it, and is fetched from the contig once
    t = t.withColumn("text", _cut(F.col("d") - 50, F.col("q") + 50))
    cut = lambda start, end: _cut(start - F.col("d") + 50, end - F.col("d") + 50, "text")
    tail = F.when(F.col("at_end"), cut(F.col("q"), F.col("q") + F.col("n"))).otherwise(cut(F.col("d") - F.col("n"), F.col("d")))
    t = t.withColumn("tail", tail).withColumn("far", F.when(F.col("at_end"), F.right("tail", F.lit(3))).otherwise(F.left("tail", F.lit(3))))
    t = t.withColumn("near", F.when(F.col("at_end"), F.left("tail", F.col("n") - 3)).otherwise(F.right("tail", F.col("n") - 3)))
    far = F.when(F.pmod("ord", F.lit(5)) == 0, F.translate("far", "A", "G")).otherwise(F.col("far"))
    seq = F.when(F.col("at_end"), F.concat(cut(F.col("d") - 50, F.col("d")), F.col("near"), far)).otherwise(F.concat(far, F.col("near"), cut(F.col("q"), F.col("q") + 50)))
    pos = F.when(F.col("at_end"), F.col("d") - 50).otherwise(F.col("q") - F.col("over"))
    t = t.select("ord", "at_end", "chrom", pos.alias("pos"), seq.alias("seq"), (50 + F.col("over")).alias("a"), (F.col("n") - F.col("over")).alias("clip"), F.col("d").cast("long").alias("t_start"), F.col("q").cast("long").alias("t_end"))
    return _records(t, "t_start", "t_end")


@query(
    f"""{_PART},
sig(rev, x, y, sc, m) AS (VALUES (false, 'GT', 'AG', 4, false), (false, 'GC', 'AG', 2, false), (false, 'AT', 'AC', 1, false), (false, 'CT', 'AC', 4, true), (false, 'CT', 'GC', 2, true), (false, 'GT', 'AT', 1, true),
  (true, 'GA', 'TG', 4, false), (true, 'GA', 'CG', 2, false), (true, 'CA', 'TA', 1, false), (true, 'CA', 'TC', 4, true), (true, 'CG', 'TC', 2, true), (true, 'TA', 'TG', 1, true)),
pd AS (SELECT par.*, seq, s + instr(substr(seq, (s + 1)::INT), CASE WHEN minus THEN 'CT' ELSE 'GT' END) - 1 AS d FROM par JOIN rnd USING (chrom)),
pa AS (SELECT *, d + 60 + ord * 13 % 1400 AS a0, 10 + ord % 13 AS n, ord % 6 - 2 AS over FROM pd),
pl AS (SELECT *, a0 + instr(substr(seq, (a0 + 1)::INT), CASE WHEN minus THEN 'AC' ELSE 'AG' END) - 1 + 2 AS q FROM pa),
rd AS (
  SELECT *, CASE WHEN at_end THEN d + over ELSE {SIZE} - (q - over) END AS edge, 50 + over AS block, n - over AS tail,
         CASE WHEN at_end THEN substr(seq, (d - 49)::INT, 50) || substr(seq, (q + 1)::INT, n::INT) ELSE reverse(substr(seq, (d - n + 1)::INT, n::INT) || substr(seq, (q + 1)::INT, 50)) END AS told FROM pl),
rr AS (
  SELECT ord, chrom, NOT at_end AS rev, d, q, edge, block, tail, least(12, block - 1) AS inn,
         CASE WHEN ord % 5 = 0 THEN substr(told, 1, length(told) - 3) || translate(right(told, 3), 'A', 'G') ELSE told END AS told FROM rd),
ends AS (SELECT rr.*, substr(told, (block - inn + 1)::INT) AS ot, substr(con.seq, (edge - inn + 1)::INT, (inn + 14)::INT) AS near FROM rr JOIN con USING (chrom, rev)),
cut AS (SELECT *, unnest(range(0, least(inn + 12, length(ot) - 7, length(near) - 2) + 1)) AS i FROM ends),
site AS (SELECT chrom, rev, q, substr(seq, (q - 1)::INT, 2) AS y, substr(seq, (q + 1)::INT, 7) AS p FROM (SELECT con.*, unnest(range(2, length(seq) - 6)) AS q FROM con)),
cand AS (
  SELECT DISTINCT ord, site.q - (i - inn) AS g
  FROM cut JOIN sig ON sig.rev = cut.rev AND sig.x = substr(near, (i + 1)::INT, 2) JOIN site ON site.chrom = cut.chrom AND site.rev = cut.rev AND site.y = sig.y AND site.p = substr(ot, (i + 1)::INT, 7)
  WHERE site.q - (edge + i - inn) BETWEEN 20 AND 50000 AND p <> repeat(p[1], 7)),
far AS (SELECT cut.*, g, substr(con.seq, (g - inn - 1)::INT, length(ot) + 2) AS far FROM cut JOIN cand USING (ord) JOIN con ON con.chrom = cut.chrom AND con.rev = cut.rev WHERE g - inn - 2 >= 0 AND g + tail <= {SIZE}),
sides AS (SELECT far.*, sc, m, substr(ot, (i + 1)::INT) AS b1, substr(far, (i + 3)::INT) AS b2, substr(ot, 1, i::INT) AS f1, substr(near, 1, i::INT) AS f2
  FROM far JOIN sig ON sig.rev = far.rev AND sig.x = substr(near, (i + 1)::INT, 2) AND sig.y = substr(far, (i + 1)::INT, 2)),
told AS (SELECT *, {_wrong("b1", "b2")} AS behind, {_wrong("f1", "f2")} AS before FROM sides),
best AS (
  SELECT *, i - inn AS o, g - edge AS size, behind + before AS wrong, sc - 6 * (behind + before) AS score FROM told WHERE behind <= length(b1) // 5
  QUALIFY row_number() OVER (PARTITION BY ord ORDER BY sc - 6 * (behind + before) DESC, abs(i - inn), g - edge, i) = 1)
SELECT ord, CASE WHEN rev THEN {SIZE} - (g + tail) ELSE d - 50 END AS pos,
       CASE WHEN rev THEN (tail - o) || 'M' || size || 'N' || (block + o) || 'M' ELSE (block + o) || 'M' || size || 'N' || (tail - o) || 'M' END AS cigar,
       CASE WHEN rev THEN {SIZE} - (g + o) ELSE edge + o END AS "start", CASE WHEN rev THEN {SIZE} - (edge + o) ELSE g + o END AS "end", m AS on_minus, wrong::INT AS wrong, score::INT AS score, d AS t_start, q AS t_end FROM best"""
)
def split_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clipped ends laid behind introns that no library knows, of both strands, and the planted introns."""
    r = written(planted_splits(spark, sf_dir), shared_path(spark, "planted"))
    both = [splits.split_tails(r.filter(F.col("at_end") if side == "end" else ~F.col("at_end")), synth.random_tiles(spark), synth.RANDOM_TILE, side) for side in ("end", "start")]
    found = both[0].unionByName(both[1])
    return found.join(r.select("ord", "t_start", "t_end").hint("merge"), "ord").withColumn("cigar", cg.text(F.col("cigar")))


# ---- two known introns -------------------------------------------------------------------


def planted_exons(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records clipped before a short exon between two introns, and the library of all introns."""
    t = _parts(spark, sf_dir).withColumn("js", F.col("s")).withColumn("ms", F.col("s") + 80 + F.pmod(F.col("ord") * 13, F.lit(900)))
    t = t.withColumn("me", F.col("ms") + 12 + F.pmod("ord", F.lit(29))).withColumn("je", F.col("me") + 70 + F.pmod(F.col("ord") * 7, F.lit(700))).withColumn("n", 6 + F.pmod("ord", F.lit(9)))
    exon = _cut(F.col("ms"), F.col("me"))
    seq = F.when(F.col("at_end"), F.concat(_cut(F.col("js") - 50, F.col("js")), exon, _cut(F.col("je"), F.col("je") + F.col("n")))).otherwise(F.concat(_cut(F.col("js") - F.col("n"), F.col("js")), exon, _cut(F.col("je"), F.col("je") + 50)))
    pos = F.when(F.col("at_end"), F.col("js") - 50).otherwise(F.col("je"))
    r = _records(t.select("ord", "at_end", "chrom", pos.alias("pos"), seq.alias("seq"), F.lit(50).alias("a"), (F.col("n") + F.col("me") - F.col("ms")).alias("clip")))
    two = F.explode(F.array(*[F.struct(F.col(a).cast("long").alias("start"), F.col(b).cast("long").alias("end")) for a, b in (("js", "ms"), ("me", "je"))]))
    return r, t.select("chrom", "minus", two.alias("j")).select("chrom", "j.start", "j.end", "minus", F.lit(1).cast("long").alias("support"))


@query(
    f"""{_PART},
ex AS (SELECT *, s AS js, s + 80 + ord * 13 % 900 AS ms, 12 + ord % 29 AS m, 6 + ord % 9 AS n FROM par),
pl AS (SELECT *, ms + m AS me, ms + m + 70 + ord * 7 % 700 AS je FROM ex),
lib AS (SELECT DISTINCT chrom, minus, js AS a, ms AS b FROM pl UNION SELECT DISTINCT chrom, minus, me, je FROM pl),
two AS (SELECT DISTINCT x.chrom, x.a AS js, x.b AS ms, y.a AS me, y.b AS je FROM lib x JOIN lib y ON x.chrom = y.chrom AND x.minus = y.minus AND y.a > x.b AND y.a <= x.b + 60),
intr AS (SELECT chrom, false AS rev, js AS a, ms AS b, me AS c, je AS d FROM two UNION ALL SELECT chrom, true, {SIZE} - je, {SIZE} - me, {SIZE} - ms, {SIZE} - js FROM two),
rd AS (
  SELECT ord, chrom, NOT at_end AS rev, m + n AS tail, CASE WHEN at_end THEN js ELSE {SIZE} - je END AS edge,
         CASE WHEN at_end THEN substr(seq, (js - 49)::INT, 50) || substr(seq, (ms + 1)::INT, m::INT) || substr(seq, (je + 1)::INT, n::INT)
         ELSE reverse(substr(seq, (js - n + 1)::INT, n::INT) || substr(seq, (ms + 1)::INT, m::INT) || substr(seq, (je + 1)::INT, 50)) END AS told FROM pl JOIN rnd USING (chrom)),
ends AS (SELECT rd.*, substr(told, 39) AS ot, substr(con.seq, (edge - 11)::INT, 26) AS near, con.seq FROM rd JOIN con USING (chrom, rev)),
hit AS (
  SELECT ends.*, a, b, c, d, a - edge + 12 AS i, c - b AS exon, length(ot) - (a - edge + 12) - (c - b) AS rest FROM ends JOIN intr USING (chrom, rev) WHERE abs(a - edge) <= 12),
laid AS (SELECT *, substr(ot, (i + 1)::INT) AS x, substr(seq, (b + 1)::INT, exon::INT) || substr(seq, (d + 1)::INT, rest::INT) AS y, substr(ot, 1, i::INT) AS f1, substr(near, 1, i::INT) AS f2 FROM hit WHERE rest >= 4 AND length(near) >= i),
told AS (SELECT *, {_wrong("x", "y")} AS wrong, {_wrong("f1", "f2")} AS before FROM laid WHERE length(x) = length(y)),
best AS (
  SELECT * FROM told WHERE wrong <= length(x) // 10
  QUALIFY row_number() OVER (PARTITION BY ord ORDER BY wrong + before, d - a, CASE WHEN rev THEN -a ELSE a END, CASE WHEN rev THEN -b ELSE b END, CASE WHEN rev THEN -c ELSE c END) = 1)
SELECT ord, CASE WHEN rev THEN {SIZE} - (d + rest) ELSE edge - 50 END AS pos, wrong::INT AS wrong,
       CASE WHEN rev THEN rest || 'M' || (d - c) || 'N' || exon || 'M' || (b - a) || 'N' || (38 + i) || 'M' ELSE (38 + i) || 'M' || (b - a) || 'N' || exon || 'M' || (d - c) || 'N' || rest || 'M' END AS cigar FROM best"""
)
def short_exons_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clipped ends laid over a short exon between two known introns."""
    r, library = planted_exons(spark, sf_dir)
    both = [splits.short_exons(r.filter(F.col("at_end") if side == "end" else ~F.col("at_end")), library, synth.random_tiles(spark), synth.RANDOM_TILE, side) for side in ("end", "start")]
    return both[0].unionByName(both[1]).withColumn("cigar", cg.text(F.col("cigar")))


# ---- run through a known intron -------------------------------------------------------------


def planted_overhangs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records of one block that runs 1 to 12 bases into an intron, and the library."""
    t = _parts(spark, sf_dir).withColumn("a", F.col("s")).withColumn("b", F.col("s") + 60 + F.pmod(F.col("ord") * 13, F.lit(1400))).withColumn("n", 1 + F.pmod("ord", F.lit(12)))
    seq = F.when(F.col("at_end"), F.concat(_cut(F.col("a") - 50, F.col("a")), _cut(F.col("b"), F.col("b") + F.col("n")))).otherwise(F.concat(_cut(F.col("a") - F.col("n"), F.col("a")), _cut(F.col("b"), F.col("b") + 50)))
    pos = F.when(F.col("at_end"), F.col("a") - 50).otherwise(F.col("b") - F.col("n"))
    r = _records(t.select("ord", "at_end", "chrom", pos.alias("pos"), seq.alias("seq"), (50 + F.col("n")).alias("a"), F.lit(0).alias("clip")))
    return r, t.select("chrom", F.col("a").cast("long").alias("start"), F.col("b").cast("long").alias("end"), "minus", F.lit(1).cast("long").alias("support"))


@query(
    f"""{_PART},
pl AS (SELECT *, s AS a, s + 60 + ord * 13 % 1400 AS b, 1 + ord % 12 AS n FROM par),
lib AS (SELECT DISTINCT chrom, a, b FROM pl),
intr AS (SELECT chrom, false AS rev, a, b FROM lib UNION ALL SELECT chrom, true, {SIZE} - b, {SIZE} - a FROM lib),
rd AS (
  SELECT ord, chrom, NOT at_end AS rev, 50 + n AS block, CASE WHEN at_end THEN a + n ELSE {SIZE} - (b - n) END AS edge,
         CASE WHEN at_end THEN substr(seq, (a - 49)::INT, 50) || substr(seq, (b + 1)::INT, n::INT) ELSE reverse(substr(seq, (a - n + 1)::INT, n::INT) || substr(seq, (b + 1)::INT, 50)) END AS told FROM pl JOIN rnd USING (chrom)),
hit AS (SELECT rd.*, a, b, edge - a AS n, right(told, (edge - a)::INT) AS x, seq FROM rd JOIN intr USING (chrom, rev) JOIN con USING (chrom, rev) WHERE a > edge - block AND a < edge),
laid AS (SELECT *, substr(seq, (a + 1)::INT, n::INT) AS here, substr(seq, (b + 1)::INT, n::INT) AS there FROM hit),
told AS (SELECT *, {_wrong("x", "there")} AS wrong, {_wrong("x", "here")} AS as_is FROM laid WHERE length(there) = n AND length(here) = n),
best AS (
  SELECT * FROM told WHERE wrong < as_is AND wrong <= CASE WHEN n < 4 THEN 0 ELSE n // 5 END
  QUALIFY row_number() OVER (PARTITION BY ord ORDER BY wrong, b - a, CASE WHEN rev THEN -a ELSE a END) = 1)
SELECT ord, CASE WHEN rev THEN {SIZE} - (b + n) ELSE edge - block END AS pos, wrong::INT AS wrong,
       CASE WHEN rev THEN n || 'M' || (b - a) || 'N' || (block - n) || 'M' ELSE (block - n) || 'M' || (b - a) || 'N' || n || 'M' END AS cigar FROM best"""
)
def run_through_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that ran through a known intron's near side, laid behind it where they fit better."""
    r, library = planted_overhangs(spark, sf_dir)
    both = [splits.run_through(r.filter(F.col("at_end") if side == "end" else ~F.col("at_end")), library, synth.random_tiles(spark), synth.RANDOM_TILE, side) for side in ("end", "start")]
    return both[0].unionByName(both[1]).withColumn("cigar", cg.text(F.col("cigar")))


# ---- chains over several introns --------------------------------------------------------------


def planted_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ord, chrom, diagonals, seq: reads over one to three introns, a fifth of them edited, and the place of their first base on each exon's diagonal."""
    t = _parts(spark, sf_dir).withColumn("introns", (1 + F.pmod("ord", F.lit(3))).cast("int")).withColumn("size", 30 + F.pmod("ord", F.lit(17)))
    exons = F.transform(F.sequence(F.lit(0), F.col("introns")), lambda i: F.col("s") + i * (F.col("size") + 60 + F.pmod(F.col("ord") * 13, F.lit(300))))
    t = t.withColumn("exons", exons).withColumn("diagonals", F.transform("exons", lambda e, i: (e - i * F.col("size")).cast("long")))
    seq = F.array_join(F.transform("exons", lambda e: F.substring("ref", e.cast("int") + 1, F.col("size").cast("int"))), "")
    t = t.withColumn("seq", F.when(F.pmod("ord", F.lit(5)) == 0, F.translate(seq, "A", "G")).when(F.pmod("ord", F.lit(5)) == 1, F.translate(seq, "C", "A")).otherwise(seq))
    return t.select("ord", "chrom", "diagonals", "seq")


def _chain_sql() -> str:
    steps = []
    for k in (1, 2, 3):
        before = "c0.total" if k == 1 else f"f{k - 1}.best"
        source = "cum c0" if k == 1 else f"f{k - 1}"
        steps.append(f"""
g{k} AS (SELECT b.ord, b.i, b.total, CASE WHEN b.i BETWEEN 1 AND b.n - 1 THEN {before} + b.signal - b.total END AS g
  FROM cum b JOIN {source} ON {source.split()[-1]}.ord = b.ord AND {source.split()[-1]}.i = b.i {"AND c0.k = 0" if k == 1 else ""} WHERE b.k = {k}),
f{k} AS MATERIALIZED (SELECT ord, i, total + max(g) OVER (PARTITION BY ord ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM g{k})""")
    return f"""{_PART},
ch AS (SELECT ord, chrom, 1 + ord % 3 AS introns, 30 + ord % 17 AS size, s, 60 + ord * 13 % 300 AS gap FROM par),
rd AS (SELECT ch.*, seq, string_agg(substr(seq, (s + e * (size + gap) + 1)::INT, size::INT), '' ORDER BY e) AS plain FROM ch JOIN rnd USING (chrom), (SELECT unnest(range(0, 4)) AS e) WHERE e <= introns GROUP BY ALL),
told AS (SELECT *, CASE ord % 5 WHEN 0 THEN translate(plain, 'A', 'G') WHEN 1 THEN translate(plain, 'C', 'A') ELSE plain END AS told, length(plain) AS n FROM rd),
seg AS (SELECT ord, told, n, introns, k, substr(seq, (s + k * gap - 1)::INT, n::INT + 4) AS w, substr(seq, (s + k * gap - gap - 1)::INT, n::INT + 4) AS before FROM told, (SELECT unnest(range(0, 4)) AS k) WHERE k <= introns),
each AS (SELECT *, unnest(range(0, n + 1)) AS i FROM seg),
cost AS (
  SELECT ord, k, i, n, introns, substr(before, i::INT + 3, 2) || substr(w, i::INT + 1, 2) AS pair,
         CASE WHEN i = 0 THEN 0 WHEN told[i] = w[i + 2] OR w[i + 2] = 'A' AND told[i] = 'G' OR w[i + 2] = 'T' AND told[i] = 'C' THEN 0 ELSE -6 END AS gain
  FROM each),
cum AS MATERIALIZED (
  SELECT ord, k, i, n, introns, sum(gain) OVER (PARTITION BY ord, k ORDER BY i) AS total,
         CASE pair WHEN 'GTAG' THEN 4 WHEN 'CTAC' THEN 4 WHEN 'GCAG' THEN 2 WHEN 'CTGC' THEN 2 WHEN 'ATAC' THEN 1 WHEN 'GTAT' THEN 1 ELSE -8 END AS signal
  FROM cost),{",".join(steps)}
SELECT ord, introns::INT AS introns, best::INT AS score
FROM (SELECT ord, i, best, 1 AS k FROM f1 UNION ALL SELECT ord, i, best, 2 FROM f2 UNION ALL SELECT ord, i, best, 3 FROM f3) x JOIN (SELECT DISTINCT ord, n, introns FROM cum) m USING (ord)
WHERE x.k = m.introns AND x.i = m.n"""


@query(_chain_sql())
def spliced_chain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of the best cuts of each read over its introns."""
    r = planted_chains(spark, sf_dir)
    each = r.select("ord", "chrom", F.posexplode("diagonals").alias("i", "d"), F.length("seq").alias("n"))
    each = each.select("ord", "chrom", "i", "d", F.greatest(F.col("d") - 2, F.lit(0)).alias("s"), (F.col("d") + F.col("n") + 2).alias("e"))
    got = tile_sequences(each, synth.random_tiles(spark), synth.RANDOM_TILE, ["ord", "i", "d", "s", "e"])
    rows = got.groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("i", "d", "s", "seq"))).alias("parts")).join(r.select("ord", F.col("seq").alias("read")), "ord")

    def run(frames):
        for f in frames:
            out = [(o, len(parts) - 1, kernels.splice_chain(read, [(p["s"], p["seq"]) for p in parts], [p["d"] for p in parts])[3]) for o, parts, read in zip(f["ord"].tolist(), f["parts"], f["read"])]
            yield pd.DataFrame(out, columns=["ord", "introns", "score"])

    return rows.mapInPandas(run, "ord long, introns int, score int")
