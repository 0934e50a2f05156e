"""Queries of junctions, pairs, transcripts, sorting, merging and the report, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import dna
from helixframe.operators import junctions, pairs, report, transcripts
from helixframe.plans import sites, synth

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- junctions -----------------------------------------------------------------------

_FOUND = f"""
WITH {synth.READS_SQL}, {synth.JUNCTIONS_SQL},
found AS (
  SELECT chrom, pos + 20 AS "start", pos + 120 AS "end", flag & 16 <> 0 AS minus, count(*) AS n, sum(mapq) AS mapq_sum
  FROM reads WHERE kind = 2 GROUP BY ALL),
kept AS (SELECT * FROM found WHERE n >= 2 AND mapq_sum >= n * 20 AND "end" - "start" <= 500000)
"""


@query(f'{_FOUND} SELECT chrom, "start", "end", minus, n, mapq_sum::BIGINT AS mapq_sum FROM kept')
def junction_support_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junctions.gated(junctions.observed(synth.alignments(spark, sf_dir)))


_VOTE = f"""{_FOUND},
votes AS (
  SELECT DISTINCT l.chrom, l."start" AS a_s, l."end" AS a_e, l.minus AS a_m, coalesce(f.n, 0) AS seen
  FROM lib l LEFT JOIN found f ON f.chrom = l.chrom AND f."start" = l."start" AND f."end" = l."end" AND f.minus = l.minus),
near AS (
  SELECT k.*, v.a_s, v.a_e, v.a_m, v.seen FROM kept k JOIN votes v ON k.chrom = v.chrom AND abs(k."start" - a_s) <= 3 AND abs(k."end" - a_e) <= 3),
best AS (SELECT chrom, "start", "end", minus, max(seen) AS best FROM near GROUP BY ALL),
judged AS (
  SELECT k.chrom, k."start", k."end", k.minus, k.n,
         CASE WHEN best IS NULL THEN 'kept' WHEN n > 2 * best THEN 'outvotes' WHEN best > 2 * n THEN 'outvoted' ELSE 'tie' END AS fate
  FROM kept k LEFT JOIN best USING (chrom, "start", "end", minus))
"""


@query(f"{_VOTE} SELECT * FROM judged")
def junction_support_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junctions.vote(junctions.observed(synth.alignments(spark, sf_dir)), synth.junctions(spark, sf_dir))[0]


@query(
    f"""{_VOTE},
removed AS (
  SELECT DISTINCT n.chrom, a_s AS "start", a_e AS "end", a_m AS minus FROM near n JOIN judged j USING (chrom, "start", "end", minus)
  WHERE fate = 'outvotes' AND n.n > 2 * seen)
SELECT chrom, "start", "end", minus, sum(support)::BIGINT AS support FROM (
  SELECT chrom, "start", "end", minus, support FROM lib ANTI JOIN removed USING (chrom, "start", "end", minus)
  UNION ALL SELECT chrom, "start", "end", minus, n FROM judged WHERE fate <> 'outvoted') GROUP BY ALL"""
)
def merged_junction_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library of the second mapping pass."""
    lib = synth.junctions(spark, sf_dir)
    judged, removed = junctions.vote(junctions.observed(synth.alignments(spark, sf_dir)), lib)
    return junctions.merged_library(lib, judged, removed)


@query(
    """SELECT 100 + l_partkey AS len, s AS signal, CASE s WHEN 'GT-AG' THEN 4 WHEN 'GC-AG' THEN 2 WHEN 'AT-AC' THEN 1 ELSE -8 END AS score,
       trunc(8 * abs(log10((100 + l_partkey)::DOUBLE) - 3))::INT AS penalty, count(*) AS n FROM (
  SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN CASE l_suppkey % 4 WHEN 0 THEN 'GT-AG' WHEN 1 THEN 'GC-AG' WHEN 2 THEN 'AT-AC' ELSE 'none' END
     ELSE CASE l_suppkey % 4 WHEN 3 THEN 'GT-AG' ELSE 'none' END END AS s FROM lineitem) GROUP BY ALL"""
)
def intron_penalty_splice_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (F.pmod("l_suppkey", F.lit(4)) + 1).cast("int"))
    length = F.col("l_partkey") + 100
    s = dna.splice_signal(pick("GT", "GC", "AT", "CT"), pick("AG", "AG", "AC", "AC"), F.pmod("l_linenumber", F.lit(2)) == 1)
    t = t.select(length.alias("len"), s.alias("signal"))
    return t.groupBy("len", "signal", dna.splice_score(F.col("signal")).alias("score"), dna.intron_penalty(F.col("len")).alias("penalty")).agg(F.count("*").alias("n"))


# ---- transcripts ---------------------------------------------------------------------


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders play transcripts, their lines exons of 20 bases or more, apart from each other."""
    t = synth.lineitem(spark, sf_dir).select("ok", "ln", "pk").groupBy("ok", "ln").agg(F.min("pk").alias("pk"))
    s = F.col("ln") * 1000 + F.pmod("pk", F.lit(300))
    each = t.select("ok", F.struct(s.alias("s"), (s + 20 + F.pmod("pk", F.lit(97))).alias("e")).alias("x")).groupBy("ok").agg(F.array_sort(F.collect_list("x")).alias("x"))
    minus = F.pmod("ok", F.lit(2)) == 1
    return each.select(F.format_string("t%d", "ok").alias("name"), F.format_string("chr%d", F.pmod("ok", F.lit(3)) + 1).alias("chrom"), minus.alias("minus"), F.when(minus, F.reverse("x")).otherwise(F.col("x")).alias("exons"), "ok")


_EXONS = """
WITH ex AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_partkey) AS pk FROM lineitem GROUP BY ALL),
exons AS (SELECT ok, ln, ln * 1000 + pk % 300 AS s, ln * 1000 + pk % 300 + 20 + pk % 97 AS e, ok % 2 = 1 AS minus, 'chr' || (ok % 3 + 1) AS chrom FROM ex)
"""


@query(
    f"""{_EXONS}, i AS (SELECT ok, chrom, minus, e AS "start", lead(s) OVER (PARTITION BY ok ORDER BY s) AS "end" FROM exons)
SELECT chrom, "start"::BIGINT AS "start", "end"::BIGINT AS "end", minus, count(*) AS support FROM i WHERE "end" > "start" GROUP BY ALL"""
)
def exon_introns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Introns between neighbouring exons, with the transcripts that share them."""
    return transcripts.junction_library(_transcripts(spark, sf_dir))


@query(
    f"""{_EXONS},
c AS (SELECT *, sum(e - s) OVER (PARTITION BY ok) AS total, sum(e - s) OVER (PARTITION BY ok ORDER BY s) - (e - s) AS before FROM exons),
w AS (SELECT *, CASE WHEN minus THEN total - least(60, total) ELSE 10 END AS lo, CASE WHEN minus THEN total - 10 ELSE least(60, total) END AS hi FROM c),
p AS (SELECT ok, chrom, s + greatest(lo - before, 0) AS gs, s + least(hi - before, e - s) AS ge FROM w WHERE greatest(lo - before, 0) < least(hi - before, e - s)),
g AS (SELECT *, gs - lag(ge) OVER (PARTITION BY ok ORDER BY gs) AS gap FROM p)
SELECT 't' || ok AS name, min(gs)::BIGINT AS pos, string_agg(CASE WHEN gap > 0 THEN gap || 'N' ELSE '' END || (ge - gs) || 'M', '' ORDER BY gs) AS cigar_text FROM g GROUP BY ok"""
)
def tx_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bases 10 to 60 of every transcript on the genome."""
    from helixframe.functions import cigar as cg

    t = _transcripts(spark, sf_dir).withColumn("p", transcripts.project(F.col("minus"), F.col("exons"), F.lit(10), F.lit(50)))
    return t.filter("p is not null").select("name", "p.pos", cg.text(F.col("p.cigar")).alias("cigar_text"))


@query(f"{_EXONS} SELECT 't' || ok AS name, row_number() OVER (ORDER BY 't' || ok) - 1 AS tx_id FROM (SELECT DISTINCT ok FROM exons)")
def transcript_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers in order of name."""
    return transcripts.number(_transcripts(spark, sf_dir).select("name")).select("name", "tx_id")


# ---- pairs ---------------------------------------------------------------------------

_PAIRS = f"""
WITH {synth.READS_SQL},
r AS (
  SELECT *, CASE WHEN flag & 128 <> 0 THEN 2 ELSE 1 END AS slot, flag & 16 <> 0 AS minus,
         pos + CASE kind WHEN 0 THEN 50 WHEN 1 THEN 45 WHEN 2 THEN 150 WHEN 3 THEN 48 ELSE 53 END AS re FROM reads),
one AS (SELECT template, slot, max_by(row(chrom, pos, re, minus, kind), row(ord, mapq)) AS r FROM r GROUP BY ALL),
p AS (SELECT a.template, a.r AS a, b.r AS b FROM one a JOIN one b USING (template) WHERE a.slot = 1 AND b.slot = 2),
s AS (SELECT template, a[1] AS chrom, a[2] AS ap, b[2] AS bp, a[4] <> b[4] AS inward, least(a[2], b[2]) AS lo, greatest(a[3], b[3]) AS hi,
  CASE WHEN a[5] = 2 THEN 100 ELSE 0 END + CASE WHEN b[5] = 2 THEN 100 ELSE 0 END AS introns FROM p WHERE a[1] = b[1]),
q AS (SELECT *, greatest(hi - lo - introns, 0) AS span FROM s)
"""


@query(f"{_PAIRS} SELECT template, span, inward AND span <= 1000 AS proper, CASE WHEN ap <= bp THEN span ELSE -span END AS tlen FROM q")
def pair_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Span without introns, proper pairs, signed template length."""
    return pairs.relate(pairs.mates(synth.alignments(spark, sf_dir))).select("template", "span", "proper", "tlen")


@query(f"{_PAIRS} SELECT count(*) AS n_pairs, round(avg(span), 6) AS mean, round(sqrt(greatest(avg(span * span::DOUBLE) - avg(span) ** 2, 0)), 4) AS stdev FROM q WHERE inward AND span <= 1000")
def pair_insert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pairs.insert_stats(pairs.relate(pairs.mates(synth.alignments(spark, sf_dir))))
    return out.select("n_pairs", F.round("mean", 6).alias("mean"), F.round("stdev", 4).alias("stdev"))


@query(f"WITH {synth.READS_SQL}, h AS (SELECT mapq, count(*) AS n FROM reads GROUP BY mapq) SELECT m::INT AS mapq, coalesce(n, 0) AS n FROM (SELECT unnest(range(0, 61)) AS m) LEFT JOIN h ON h.mapq = m")
def mapq_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.mapq_histogram(synth.alignments(spark, sf_dir))


@query(
    f"""WITH {synth.READS_SQL},
r AS (SELECT *, CASE WHEN flag & 128 <> 0 THEN 2 ELSE 1 END AS slot, flag & 16 <> 0 AS minus FROM reads),
m AS (SELECT template, slot, chrom, pos, minus, count(*) AS k FROM r GROUP BY ALL),
one AS (SELECT template, slot, min(row(chrom, pos, minus)) AS r FROM m GROUP BY ALL)
SELECT a.template, a.slot, b.r IS NULL OR (a.r[1] = b.r[1] AND abs(a.r[2] - b.r[2]) <= 500000 AND a.r[3] <> b.r[3]) AS concordant
FROM one a LEFT JOIN one b ON a.template = b.template AND b.slot = 3 - a.slot"""
)
def rescue_mate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = synth.alignments(spark, sf_dir)
    slot = F.when(F.col("flag").bitwiseAND(128) != 0, 2).otherwise(1)
    rows = a.select(dna.template_name(F.col("qname")).alias("template"), slot.alias("slot"), F.struct("chrom", "pos", (F.col("flag").bitwiseAND(16) != 0).alias("minus")).alias("r"))
    one = rows.groupBy("template", "slot").agg(F.min("r").alias("r")).select("template", "slot", "r.*")
    return pairs.mate_gate(one, one).select("template", "slot", "concordant")


# ---- orders and merges ---------------------------------------------------------------


@query(f"""WITH {synth.READS_SQL} SELECT DISTINCT chrom, pos, ord, dense_rank() OVER (ORDER BY c, pos, ord) AS rank FROM reads""")
def coordinate_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of records in coordinate order, from the global sort's partitions and their counts."""
    a = synth.alignments(spark, sf_dir).select("chrom", "pos", "ord").distinct()
    contigs = spark.createDataFrame([(f"chr{i + 1}", i) for i in range(synth.CONTIGS)], "name string, cid int")
    out = pairs.coordinate_order(a, contigs).withColumn("part", F.spark_partition_id()).persist()
    before, offset = 0, {}
    for p, n in sorted(map(tuple, out.groupBy("part").count().collect())):
        offset[p], before = before, before + n
    base = F.element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]), F.col("part"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("ref_id", "pos", "ord"))
    return out.select("chrom", "pos", "ord", (rank + base).cast("long").alias("rank"))


@query(f"WITH {synth.READS_SQL} SELECT template, flag & 128 <> 0 AS second, min(ord) AS ord FROM reads GROUP BY ALL")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = synth.alignments(spark, sf_dir).select(dna.template_name(F.col("qname")).alias("template"), (F.col("flag").bitwiseAND(128) != 0).alias("second"), "ord")
    return pairs.first_of(a, ["template", "second"])


@query(
    f"""WITH {synth.READS_SQL}, r AS (SELECT ord, template, flag & 128 <> 0 AS second, mapq FROM reads),
resc AS (SELECT DISTINCT template, second FROM r WHERE mapq % 7 = 0)
SELECT ord, false AS rescued FROM r ANTI JOIN resc USING (template, second) UNION ALL SELECT ord, true FROM r WHERE mapq % 7 = 0"""
)
def merge_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that rescued ones of the same read and slot replace, dropped; then the rescued ones."""
    a = synth.alignments(spark, sf_dir).select("ord", dna.template_name(F.col("qname")).alias("qname"), (F.col("flag").bitwiseAND(128) != 0).alias("slot"), "mapq", F.lit(None).cast("string").alias("rescue_tag"))
    rescued = a.filter("mapq % 7 = 0").withColumn("rescue_tag", F.lit("collapsed"))
    return pairs.merge_rescued(a, rescued).select("ord", F.col("rescue_tag").isNotNull().alias("rescued"))


# ---- report --------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sites.pileup_candidates(spark, sf_dir)
    return s.select((F.substring("chrom", 4, 1).cast("long") * 10000 + F.col("pos")).alias("ord"), "chrom", "pos", "depth", F.col("freq").alias("vaf"), F.col("freq").alias("score"), (F.col("freq") >= 0.3).alias("passed"))


@query(
    f"""{sites._CANDIDATES},
h AS (SELECT chrom, pos // 500 AS bin, count(*) FILTER (freq >= 0.3) AS heat FROM sites GROUP BY ALL)
SELECT 'chr' || (c + 1) AS chrom, b AS bin, coalesce(heat, 0) AS heat FROM (SELECT unnest(range(0, {synth.CONTIGS})) AS c), (SELECT unnest(range(0, 5)) AS b)
LEFT JOIN h ON h.chrom = 'chr' || (c + 1) AND h.bin = b"""
)
def heatmap_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passing sites in dense windows."""
    contigs = spark.createDataFrame([(f"chr{i + 1}", synth.CONTIG) for i in range(synth.CONTIGS)], "name string, len long")
    return report.heat_map(_scored(spark, sf_dir), contigs, 500, F.col("passed").cast("long"))


@query(
    f"""{sites._GENE_AT},
t AS (SELECT s.chrom, s.pos, freq, depth, gene, printf('%.3f', freq)::DOUBLE AS f3 FROM sites s JOIN hit USING (chrom, pos)),
g AS (SELECT gene, count(*) AS n, count(*) FILTER (freq >= 0.3) AS pass, round(max(freq), 6) AS maxscore FROM t GROUP BY gene),
k AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY f3 DESC, chrom, pos) AS k FROM t WHERE freq >= 0.3),
l AS (SELECT gene, string_agg(pos || ':' || depth, ',' ORDER BY k) AS top FROM k WHERE k <= 60 GROUP BY gene)
SELECT gene, n, pass, maxscore, top FROM g LEFT JOIN l USING (gene)"""
)
def gene_topk_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes with counts, best score and their best sites."""
    s = report.with_genes(_scored(spark, sf_dir), synth.genes(spark, sf_dir), width=256)
    g = report.gene_table(s)
    top = F.array_join(F.transform("sites", lambda x: F.concat_ws(":", x["pos"].cast("string"), x["depth"].cast("string"))), ",")
    return g.select("gene", "n", "pass", F.round("maxscore", 6).alias("maxscore"), top.alias("top"))


def _cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers play coding transcripts of two blocks."""
    t = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"))
    s = F.pmod(F.col("k") * 89, F.lit(1500))
    blocks = F.array(F.struct(s.alias("s"), (s + 100).alias("e"), F.pmod("k", F.lit(3)).alias("phase")), F.struct((s + 250).alias("s"), (s + 371).alias("e"), F.pmod(F.col("k") + 1, F.lit(3)).alias("phase")))
    return t.select(F.format_string("t%05d", "k").alias("tx"), F.format_string("gene%d", F.pmod("k", F.lit(40))).alias("gene"), F.format_string("chr%d", F.pmod("k", F.lit(3)) + 1).alias("chrom"), F.when(F.pmod("k", F.lit(2)) == 0, "+").otherwise("-").alias("strand"), F.explode(blocks).alias("b")).select("tx", "gene", "chrom", "strand", F.col("b.s").alias("start"), F.col("b.e").alias("end"), F.col("b.phase").cast("int").alias("phase"))


@query(
    f"""{sites._CANDIDATES},
aa(codon, a) AS (
  SELECT x || y || z, substr('{dna.AMINO_ACIDS}', (i * 16 + j * 4 + k + 1)::INT, 1)
  FROM (SELECT unnest(['T', 'C', 'A', 'G']) AS x, unnest(range(0, 4)) AS i), (SELECT unnest(['T', 'C', 'A', 'G']) AS y, unnest(range(0, 4)) AS j),
       (SELECT unnest(['T', 'C', 'A', 'G']) AS z, unnest(range(0, 4)) AS k)),
t AS (SELECT 't' || lpad(s_suppkey::VARCHAR, 5, '0') AS tx, 'chr' || (s_suppkey % 3 + 1) AS chrom, s_suppkey % 2 = 1 AS minus, (s_suppkey * 89) % 1500 AS s,
  CASE WHEN s_suppkey % 2 = 1 THEN (s_suppkey + 1) % 3 ELSE s_suppkey % 3 END AS frame FROM supplier),
base AS (
  SELECT tx, chrom, minus, frame, s, p, CASE WHEN minus THEN CASE WHEN p >= s + 250 THEN s + 370 - p ELSE 121 + s + 99 - p END
         ELSE CASE WHEN p < s + 100 THEN p - s ELSE 100 + p - s - 250 END END AS off,
         CASE WHEN minus THEN translate(upper(r.base), 'ACGT', 'TGCA') ELSE upper(r.base) END AS b
  FROM t JOIN (SELECT chrom, pos AS p, base FROM refs) r USING (chrom) WHERE (p >= s AND p < s + 100) OR (p >= s + 250 AND p < s + 371)),
codons AS (
  SELECT tx, (off - frame) // 3 AS ci, string_agg(b, '' ORDER BY off) AS codon FROM base WHERE off >= frame GROUP BY ALL HAVING count(*) = 3),
h AS (
  SELECT x.chrom, x.pos, b.tx, b.s, c.ci, c.codon, ((b.off - b.frame) % 3)::INT AS ph
  FROM sites x JOIN base b ON b.chrom = x.chrom AND b.p = x.pos AND b.off >= b.frame JOIN codons c ON c.tx = b.tx AND c.ci = (b.off - b.frame) // 3),
v AS (
  SELECT h.*, r.a AS ra, n.a AS na FROM h JOIN aa r ON r.codon = h.codon
  JOIN aa n ON n.codon = substr(h.codon, 1, ph) || 'G' || substr(h.codon, ph + 2) WHERE substr(h.codon, ph + 1, 1) = 'A' AND r.a <> n.a)
SELECT chrom, pos, tx, ra || (ci + 1) || na AS change FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY s, s + 371, tx) AS k FROM v) WHERE k = 1"""
)
def codon_recoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites where A to G changes the amino acid, in the first transcript that tells."""
    coding = report.cds_sequences(_cds(spark, sf_dir), synth.tiles(spark), 500)
    return report.recodings(_scored(spark, sf_dir), coding, width=256).select("chrom", "pos", "tx", "change")
