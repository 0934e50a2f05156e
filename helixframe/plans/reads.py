"""Queries of read quality control, k-mers, minimizers and seeds, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import dna, trim
from helixframe.operators import kmer_index, qc
from helixframe.plans import synth

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different reads of the synthetic alignments: lane, ord, mate, name, seq, qual."""
    return synth.different_reads(spark, sf_dir)


_BASES = f"""
WITH {synth.READS_SQL},
one AS (SELECT DISTINCT ord, ok, ln, c, kind, pos FROM reads),
each AS (
  SELECT *, CASE kind WHEN 1 THEN CASE WHEN i < 5 THEN -1 ELSE i - 5 END WHEN 2 THEN CASE WHEN i < 20 THEN i ELSE i + 100 END
            WHEN 3 THEN CASE WHEN i < 25 THEN i WHEN i < 27 THEN -1 ELSE i - 2 END WHEN 4 THEN CASE WHEN i < 30 THEN i ELSE i + 3 END ELSE i END AS off
  FROM one, (SELECT unnest(range(0, 50)) AS i)),
b AS (
  SELECT ord, ok, ln, i, 5 + (ok + i * 7 + ln * 3) % 36 AS q, CASE WHEN ln % 2 = 0 THEN 2 ELSE 1 END AS mate,
         substr('ACGT', (CASE WHEN off < 0 THEN (i * 3 + ok) % 4 ELSE
           ((((pos + off) * (pos + off) * 7 + (pos + off) * 13 + c * 5) % 11) % 4 + CASE WHEN (ok * 17 + ln * 29 + i * i) % 23 = 0 THEN 2 ELSE 0 END
            + CASE WHEN (ok + ln * 5 + i) % 97 = 0 THEN 1 ELSE 0 END) % 4 END + 1)::INT, 1) AS base
  FROM each),
seqs AS (SELECT ord, mate, string_agg(base, '' ORDER BY i) AS seq FROM b GROUP BY ALL)
"""


@query(f"{_BASES} SELECT mate, i AS cycle, count(*) AS n, sum(q)::BIGINT AS q_sum, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'C') AS c, count(*) FILTER (base = 'G') AS g, count(*) FILTER (base = 'T') AS t, 0::BIGINT AS n_other FROM b GROUP BY ALL")
def qc_cycle_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(qc.cycle_stats(reads(spark, sf_dir)))


def _named(t: DataFrame) -> DataFrame:
    """The columns n (rows) and n (base N) apart."""
    return t.toDF("mate", "cycle", "n", "q_sum", "a", "c", "g", "t", "n_other")


@query(f"{_BASES} SELECT mate, count(DISTINCT ord) AS reads, count(*) AS bases, count(*) FILTER (q >= 20) AS q20, count(*) FILTER (q >= 30) AS q30, count(*) FILTER (base IN ('C', 'G')) AS gc, 0::BIGINT AS n_bases FROM b GROUP BY mate")
def qc_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.totals(reads(spark, sf_dir))


@query(f"{_BASES}, r AS (SELECT ord, count(*) FILTER (q < 15) AS low FROM b GROUP BY ord) SELECT CASE WHEN low > 50 * 0.3 THEN 'low_quality' END AS reason, count(*) AS n FROM r GROUP BY ALL")
def read_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = qc.Options(max_low_share=0.3)
    r = reads(spark, sf_dir).withColumn("reason", qc.fail_reason(F.col("seq"), F.col("qual"), F.lit(False), o))
    return r.groupBy("reason").agg(F.count("*").alias("n"))


@query(f"{_BASES} SELECT ord, substr(seq, 4, 42) AS seq FROM seqs")
def fixed_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, tail = 3, 5
    return reads(spark, sf_dir).select("ord", F.substring("seq", F.lit(start + 1), F.greatest(F.length("seq") - start - tail, F.lit(0))).alias("seq"))


@query(
    f"""{_BASES},
s AS (SELECT ord, i, sum(20 - q) OVER (PARTITION BY ord ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS s FROM b),
f AS (SELECT ord, max(i) FILTER (s < 0) AS stop FROM s GROUP BY ord),
m AS (SELECT s.ord, max(s) AS best, arg_max(i, row(s, i)) AS cut FROM s JOIN f USING (ord) WHERE stop IS NULL OR i > stop GROUP BY s.ord)
SELECT f.ord, CASE WHEN best > 0 THEN cut ELSE 50 END AS keep FROM f LEFT JOIN m USING (ord)"""
)
def quality_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).select("ord", trim.quality_keep_col(F.col("qual"), 20).alias("keep"))


@query(
    f"""{_BASES},
t AS (SELECT ord, i, CASE WHEN i >= 50 - (ok % 30) AND (ok + i) % 11 <> 0 THEN 'G' ELSE base END AS base FROM b),
s AS (SELECT ord, i, 50 - i AS scanned, sum((base <> 'G')::INT) OVER (PARTITION BY ord ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS other FROM t),
f AS (SELECT ord, max(i) FILTER (other > least(scanned // 8, 5)) AS stop FROM s GROUP BY ord)
SELECT ord, CASE WHEN 50 - coalesce(stop + 1, 0) >= 10 THEN coalesce(stop + 1, 0) ELSE 50 END AS keep FROM f"""
)
def poly_g_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tails of G of many lengths, with other bases between."""
    r = reads(spark, sf_dir).withColumn("ok", F.floor(F.col("ord") / 8))
    seq = F.array_join(F.transform(F.filter(F.split("seq", ""), lambda x: x != ""), lambda x, i: F.when((i >= 50 - F.pmod("ok", F.lit(30))) & (F.pmod(F.col("ok") + i, F.lit(11)) != 0), "G").otherwise(x)), "")
    return r.select("ord", trim.poly_g_keep_col(seq).alias("keep"))


def _adapter_sql(source: str, out: str, adapter: str) -> str:
    """Tables that end in ``out`` (ord, s): source (ord, s) cut before the adapter, s null where it isn't found."""
    m = len(adapter)
    first = -4 if m >= 16 else -3 if m >= 12 else -2 if m >= 8 else 0
    a = f"'{adapter}'"
    return f"""
{out}_n AS (SELECT ord, s, length(s) AS n FROM {source} WHERE length(s) >= 4),
{out}_at AS (SELECT *, unnest(range({first}, n - 4)) AS o FROM {out}_n),
{out}_plain AS (
  SELECT ord, greatest(min(o), 0) AS o FROM (SELECT *, greatest(0, -o) AS low, least(n - o, {m}) AS span FROM {out}_at)
  WHERE hamming(substr(s, o + low + 1, span - low), substr({a}, low + 1, span - low)) <= span // 8 GROUP BY ord),
{out}_left AS (SELECT * FROM {out}_at ANTI JOIN {out}_plain USING (ord) WHERE o >= 0),
{out}_ins AS (
  SELECT ord, min(o) AS o FROM (SELECT *, least(n - o - 1, {m}) AS span, greatest(least(n - o - 1, {m}) // 8 - 1, 0) AS most FROM {out}_left WHERE o < n - 5)
  WHERE hamming(substr(s, o + 1, least(8, span)), substr({a}, 1, least(8, span))) <= most
    AND list_bool_or(list_transform(range(1, span), lambda g: hamming(substr(s, o + 1, g) || substr(s, o + g + 2, span - g), substr({a}, 1, span)) <= most)) GROUP BY ord),
{out}_del AS (
  SELECT ord, min(o) AS o FROM (SELECT *, least(n - o, {m - 1}) AS span, greatest(least(n - o, {m - 1}) // 8 - 1, 0) AS most FROM {out}_left)
  WHERE hamming(substr(s, o + 1, least(8, span)), substr({a}, 1, least(8, span))) <= most
    AND list_bool_or(list_transform(range(1, span), lambda g: hamming(substr(s, o + 1, span), substr({a}, 1, g) || substr({a}, g + 2, span - g)) <= most)) GROUP BY ord),
{out} AS (
  SELECT x.ord, substr(x.s, 1, coalesce(p.o, i.o, d.o)) AS s
  FROM {source} x LEFT JOIN {out}_plain p USING (ord) LEFT JOIN {out}_ins i USING (ord) LEFT JOIN {out}_del d USING (ord))"""


_ILLUMINA, _TRANSPOSASE = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "CTGTCTCTTATACACATCT"


def _two_adapters_sql(source: str) -> str:
    """cut (ord, s): source after both adapters in turn, null without a hit."""
    return f"""{_adapter_sql(source, "c1", _ILLUMINA)},
after1 AS (SELECT x.ord, coalesce(c.s, x.s) AS s FROM {source} x JOIN c1 c USING (ord)), {_adapter_sql("after1", "c2", _TRANSPOSASE)},
cut AS (SELECT ord, coalesce(c2.s, c1.s) AS s FROM c1 JOIN c2 USING (ord))"""


@query(
    f"""{_BASES},
planted AS (SELECT ord, ord * 7 % 60 AS o, substr(seq, 1, ord * 7 % 60) || substr('{_ILLUMINA}', 1, greatest(50 - ord * 7 % 60, 0)) AS s FROM seqs),
{_two_adapters_sql("planted")}
SELECT ord, o AS planted, coalesce(length(c.s), -1)::INT AS cut FROM planted JOIN cut c USING (ord)"""
)
def adapter_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the first adapter starts, after it was written over each read's end; -1: nowhere."""
    a = qc.ADAPTERS_1[0]
    at = F.pmod(F.col("ord") * 7, F.lit(60))
    seq = F.concat(F.substring("seq", F.lit(1), at.cast("int")), F.substring(F.lit(a), F.lit(1), F.greatest(F.lit(50) - at, F.lit(0)).cast("int")))
    return reads(spark, sf_dir).select("ord", at.alias("planted"), F.coalesce(trim.adapter_cut_col(seq, qc.ADAPTERS_1), F.lit(-1)).alias("cut"))


@query(
    f"""{_BASES},
p AS (SELECT ord, seq AS x, translate(reverse(translate(reverse(substr(seq, 1, ord % 20 + 31)), 'ACGT', 'TGCA')), 'ACGT', 'TGCA') AS y FROM seqs),
a AS (SELECT *, length(x) AS n1, length(y) AS n2, unnest(range(31 - length(y), length(x) - 30)) AS o FROM p WHERE length(x) > 30 AND length(y) > 30),
z AS (SELECT *, least(n1, n2, n1 - o, n2 + o) AS size FROM a),
hit AS (
  SELECT ord, min_by(o, CASE WHEN o >= 0 THEN o ELSE 1000 - o END) AS "offset", min_by(size, CASE WHEN o >= 0 THEN o ELSE 1000 - o END) AS length FROM z
  WHERE size >= 30 AND hamming(substr(x, greatest(o, 0) + 1, size), substr(y, greatest(-o, 0) + 1, size)) <= least(5, size // 10) GROUP BY ord)
SELECT ord, "offset"::INT AS "offset", length::INT AS length FROM p LEFT JOIN hit USING (ord)"""
)
def pair_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of each read with a mate read from the other end of a shorter insert."""
    r = reads(spark, sf_dir)
    mate = dna.revcomp(F.substring("seq", F.lit(1), F.pmod("ord", F.lit(20)).cast("int") + 31))
    return r.select("ord", trim.overlap_col(F.col("seq"), mate).alias("o")).select("ord", "o.offset", "o.length")


@query(
    f"""{_BASES},
qs AS (SELECT ord, i, sum(20 - q) OVER (PARTITION BY ord ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS s FROM b),
qf AS (SELECT ord, max(i) FILTER (s < 0) AS stop FROM qs GROUP BY ord),
qm AS (SELECT qs.ord, max(s) AS best, arg_max(i, row(s, i)) AS o FROM qs JOIN qf USING (ord) WHERE stop IS NULL OR i > stop GROUP BY qs.ord),
k1 AS (SELECT ord, CASE WHEN best > 0 THEN o ELSE 50 END AS n FROM qf LEFT JOIN qm USING (ord)),
gs AS (SELECT ord, i, n, n - i AS scanned, sum((base <> 'G')::INT) OVER (PARTITION BY ord ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS other FROM b JOIN k1 USING (ord) WHERE i < n),
gf AS (SELECT ord, any_value(n) AS n, coalesce(max(i) FILTER (other > least(scanned // 8, 5)) + 1, 0) AS start FROM gs GROUP BY ord),
k2 AS (SELECT k1.ord, k1.n AS n1, CASE WHEN k1.n >= 10 AND k1.n - start >= 10 THEN start ELSE k1.n END AS n2 FROM k1 LEFT JOIN gf USING (ord)),
trimmed AS (SELECT ord, substr(seq, 1, n2) AS s FROM seqs JOIN k2 USING (ord)),
{_two_adapters_sql("trimmed")},
done AS (SELECT ord, 50 - n1 AS by_q, n1 - n2 AS by_g, coalesce(n2 - length(s), 0) AS by_a, s IS NOT NULL AS hit, coalesce(length(s), n2) AS n FROM k2 JOIN cut USING (ord)),
low AS (SELECT ord, count(*) FILTER (q < 15 AND i < n) AS low FROM b JOIN done USING (ord) GROUP BY ord),
told AS (SELECT *, CASE WHEN n = 0 AND hit THEN 'adapter_only' WHEN n < 15 THEN 'too_short' WHEN low > n * 0.3::DOUBLE THEN 'low_quality' END AS reason FROM done JOIN low USING (ord))
SELECT reason, hit AS adapter_hit, count(*) AS n, sum(by_q)::BIGINT AS by_quality, sum(by_g)::BIGINT AS by_poly_g, sum(by_a)::BIGINT AS by_adapter FROM told GROUP BY ALL"""
)
def qc_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole single-end run: trims, filters and what is left."""
    r = reads(spark, sf_dir).withColumn("mate", F.lit(1))
    o = qc.Options(quality_trim=True, poly_g="on", max_low_share=0.3)
    j = qc.judged(qc.trim_single(r, o, None, qc.ADAPTERS_1), o, False)
    return j.groupBy("reason", "adapter_hit").agg(F.count("*").alias("n"), F.sum("by_quality").alias("by_quality"), F.sum("by_poly_g").alias("by_poly_g"), F.sum("by_adapter").alias("by_adapter"))


# ---- k-mers --------------------------------------------------------------------------


@query(f"{_BASES} SELECT ord, translate(reverse(seq), 'ACGT', 'TGCA') AS rc FROM seqs")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).select("ord", dna.revcomp(F.col("seq")).alias("rc"))


_KMERS = f"""{_BASES},
k AS (SELECT ord, i, substr(seq, i + 1, 15) AS kmer FROM seqs, (SELECT unnest(range(0, 36)) AS i)),
c AS (SELECT ord, i, kmer, least(kmer, translate(reverse(kmer), 'ACGT', 'TGCA')) AS canon FROM k)
"""


@query(f"{_KMERS} SELECT canon AS kmer, count(*) AS n FROM c GROUP BY canon")
def kmer_canonical_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dna.kmer_counts(reads(spark, sf_dir), 15)


@query(f"{_BASES}, k AS (SELECT substr(seq, 10 + i + 1, 12) AS kmer, count(*) AS n FROM seqs, (SELECT unnest(range(0, 29)) AS i) GROUP BY ALL) SELECT kmer, n FROM k ORDER BY n DESC, kmer LIMIT 1")
def kmer_seed_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent 12-mer of the reads' last 40 bases; the smallest on ties."""
    k = reads(spark, sf_dir).select(F.explode(dna.kmers(F.right("seq", F.lit(40)), 12)).alias("x")).groupBy(F.col("x.kmer").alias("kmer")).agg(F.count("*").alias("n"))
    return k.orderBy(F.desc("n"), "kmer").limit(1)




def _minimizers_sql(source: str, out: str, k: int, w: int) -> str:
    """Tables that end in ``out`` (id, kmer, pos, minus): minimizers of source (id, seq). Hashes are made once for each different k-mer."""
    return f"""
{out}_k AS (SELECT id, i, substr(seq, i + 1, {k}) AS kmer FROM (SELECT id, seq, unnest(range(0, length(seq) - {k - 1})) AS i FROM {source})),
{out}_v AS (
  SELECT kmer, rc < kmer AS minus, list_sum(list_transform(range(0, {k}), lambda j: (instr('ACGT', substr(least(kmer, rc), (j + 1)::INT, 1)) - 1) * power(4, {k - 1} - j)::BIGINT))::UHUGEINT AS x
  FROM (SELECT kmer, translate(reverse(kmer), 'ACGT', 'TGCA') AS rc FROM (SELECT DISTINCT kmer FROM {out}_k))),
{out}_1 AS (SELECT *, (xor(x, x // 1073741824::UHUGEINT) * 13787848793156543929::UHUGEINT) % 18446744073709551616::UHUGEINT AS a FROM {out}_v),
{out}_2 AS (SELECT *, (xor(a, a // 134217728::UHUGEINT) * 10723151780598845931::UHUGEINT) % 18446744073709551616::UHUGEINT AS b FROM {out}_1),
{out}_r AS (SELECT kmer, minus, x::BIGINT AS code, row_number() OVER (ORDER BY xor(b, b // 2147483648::UHUGEINT)) AS rank FROM {out}_2),
{out}_s AS (SELECT kmer, minus, code, min(rank) OVER (PARTITION BY code) AS rank FROM {out}_r),
{out}_h AS (SELECT id, i, code, minus, rank * 65536 + i AS key FROM {out}_k JOIN {out}_s USING (kmer)),
{out}_w AS (SELECT id, i, min(key) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) AS best, max(i) OVER (PARTITION BY id) AS last FROM {out}_h),
{out}_m AS (SELECT DISTINCT id, best % 65536 AS i FROM {out}_w WHERE i <= greatest(last - {w - 1}, 0)),
{out} AS (SELECT h.id, h.code AS kmer, h.i AS pos, h.minus FROM {out}_m m JOIN {out}_h h USING (id, i))"""


_MIN = f"""{_BASES}, named AS (SELECT ord AS id, seq FROM seqs), {_minimizers_sql("named", "mins", 15, 10)}
"""


@query(f"{_MIN} SELECT id AS ord, kmer, pos, minus FROM mins")
def minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimizers of the reads, k 15 and w 10."""
    return dna.minimizer_rows(reads(spark, sf_dir), "ord", 15, 10).drop("size")


@query(f"{_MIN} SELECT id AS ord, count(*) AS n, sum(kmer)::BIGINT AS kmers, sum(pos)::BIGINT AS places, count(*) FILTER (minus) AS n_minus FROM mins GROUP BY id")
def minimizers_by_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, sum of codes, sum of places and number on the minus strand of each read's minimizers: a row a read."""
    m = reads(spark, sf_dir).select("ord", dna.minimizers_col(F.col("seq"), 15, 10).alias("m")).filter(F.size("m") > 0)
    total = lambda f: F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + f(x))
    return m.select("ord", F.size("m").cast("long").alias("n"), total(lambda x: x["kmer"]).alias("kmers"), total(lambda x: x["pos"]).alias("places"), total(lambda x: x["minus"].cast("long")).alias("n_minus"))


@query(f"{_MIN}, n AS (SELECT kmer, count(*) AS n FROM mins GROUP BY kmer) SELECT n AS cutoff FROM n ORDER BY n DESC LIMIT 1 OFFSET (SELECT floor(count(*) * 0.01)::BIGINT FROM n)")
def minimizer_frequency_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = dna.minimizer_rows(reads(spark, sf_dir), "ord", 15, 10).select("kmer")
    return spark.createDataFrame([(kmer_index.frequency_cutoff(m, 0.01),)], "cutoff long")


@query(
    f"""{_BASES}, {synth.REF_SQL},
named AS (SELECT ord AS id, seq FROM seqs), contigs AS (SELECT chrom AS id, string_agg(upper(base), '' ORDER BY pos) AS seq FROM refs GROUP BY chrom),
{_minimizers_sql("named", "rm", 11, 5)}, {_minimizers_sql("contigs", "gm", 11, 5)},
places AS (SELECT kmer, id AS chrom, minus, count(*) AS n, min(pos) AS first, max(pos) AS last FROM gm GROUP BY ALL)
SELECT rm.id AS read, chrom, rm.minus <> places.minus AS minus, sum(n)::BIGINT AS n, min(first) AS first, max(last) AS last FROM rm JOIN places USING (kmer) GROUP BY ALL"""
)
def seed_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads' minimizers joined to the reference's."""
    index = kmer_index.minimizer_index(synth.tiles(spark), 500, 11, 5)
    r = reads(spark, sf_dir).select(F.col("ord").alias("read"), "seq")
    return kmer_index.anchor_spans(r, index, 11, 5)


@query(
    f"""WITH {synth.REF_SQL}, s AS (SELECT chrom, string_agg(upper(base), '' ORDER BY pos) AS seq FROM refs GROUP BY chrom),
k AS (SELECT chrom, p, substr(seq, p + 1, 9) AS kmer FROM s, (SELECT unnest(range(0, {synth.CONTIG - 8})) AS p)),
c AS (SELECT chrom, p AS pos, least(kmer, translate(reverse(kmer), 'ACGT', 'TGCA')) AS kmer, translate(reverse(kmer), 'ACGT', 'TGCA') < kmer AS minus FROM k)
SELECT kmer, chrom, pos, minus FROM c"""
)
def reference_kmer_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 9-mer of the reference, across tile ends."""
    return kmer_index.kmer_index(synth.tiles(spark), 500, 9)
