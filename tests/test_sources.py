"""Text, FASTQ, FASTA and BAM: round trips, malformed input, and a whole run that resumes."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.operators import pileup, qc, report, vcf
from helixframe.plans import stages, synth
from helixframe.sources import bam, bgzf, fastq, lines, text
from helixframe.streaming import pileup as streaming


def test_fastq_lanes_members_and_errors(spark, tmp_path):
    a = tmp_path / "a.fq.gz"
    a.write_bytes(gzip.compress(b"@r1 x\nACGT\n+\nIIII\n") + gzip.compress(b"@r2\nAC\n+\nII\n"))
    b = tmp_path / "b.fq"
    b.write_text("@r3\r\nGG\r\n+\r\n##\r\n")
    got = [tuple(r) for r in fastq.read_fastq(spark, [str(a), str(b)], first_token=True).orderBy("lane", "ord").collect()]
    assert got == [(0, 0, 1, "r1", "ACGT", "IIII"), (0, 1, 1, "r2", "AC", "II"), (1, 0, 1, "r3", "GG", "##")]
    for bad, said in (("@r\nAC\n+\nI\n", "2 bases"), ("@r\nAC\n+\n", "complete"), ("r\nAC\n+\nII\n", "not a FASTQ")):
        (tmp_path / "bad.fq").write_text(bad)
        with bgzf.File(str(tmp_path / "bad.fq")) as f, pytest.raises(ValueError, match=said):
            list(fastq.records(lines.lines(f), "f"))
    out = tmp_path / "out"
    fastq.write_fastq(fastq.read_fastq(spark, [str(a)]), str(out))
    assert gzip.decompress(b"".join(p.read_bytes() for p in sorted(out.glob("part-*")))).decode() == "@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n"


def test_fasta(spark, tmp_path):
    f = tmp_path / "g.fa"
    f.write_text(">chr1 some\nAC gt\nXX\n>chr2\nTT\n")
    contigs, tiles = fastq.read_fasta(spark, str(f), width=4)
    assert [tuple(r) for r in contigs.collect()] == [(0, "chr1", 6), (1, "chr2", 2)]
    assert sorted(map(tuple, tiles.collect())) == [("chr1", 0, "ACGT"), ("chr1", 4, "NN"), ("chr2", 0, "TT")]
    f.write_text(">a\nacGTx\n")
    assert [r["seq"] for r in fastq.read_fasta(spark, str(f), keep_case=True)[1].collect()] == ["acGTn"]
    for bad, said in (("ACGT\n", "before the first"), ("", "no contigs"), (">a\nA\n>a\nC\n", "twice"), (">\nA\n", "without a name")):
        f.write_text(bad)
        with pytest.raises(Exception, match=said):
            fastq.read_fasta(spark, str(f))
    assert fastq.fai_lines([("chr1", 6)], 4) == ["chr1\t6\t6\t4\t5"]


def test_bam_round_trip(spark, sf, tmp_path):
    a = synth.alignments(spark, sf).limit(500).withColumn("nm", F.lit(2)).withColumnRenamed("nm", "NM").persist()
    parts = bam.write_bam(a.orderBy("ord"), [("chr1", 2200), ("chr2", 2200), ("chr3", 2200)], f"{tmp_path}/parts")
    bam.join_parts(parts, f"{tmp_path}/x.bam")
    assert gzip.decompress((tmp_path / "x.bam").read_bytes())[:4] == b"BAM\1"
    assert bam.bam_contigs(f"{tmp_path}/x.bam")[1] == ("chr2", 2200)
    back = bam.read_bam(spark, f"{tmp_path}/x.bam")
    keys = ["qname", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual"]
    as_text = lambda d: sorted(map(repr, d.select(*[cg.text(F.col(c)).alias(c) if c == "cigar" else c for c in keys]).collect()))
    assert as_text(back) == as_text(a)
    assert back.filter("tags['NM'] = '2'").count() == 500


def test_bed_sites_and_gtf(spark, tmp_path):
    (tmp_path / "a.bed").write_text("track x\n#c\nchr1 5 9 z\n\nchr1\t7\t12\n")
    assert [tuple(r) for r in text.read_bed(spark, f"{tmp_path}/a.bed").collect()] == [("chr1", 5, 9), ("chr1", 7, 12)]
    (tmp_path / "s").write_text("chr1\t5\nchr2\t1\n")
    assert [(r["chrom"], r["pos"]) for r in text.read_sites(spark, f"{tmp_path}/s").collect()] == [("chr1", 5), ("chr2", 1)]
    (tmp_path / "bad").write_text("chr1\t0\n")
    with pytest.raises(Exception, match="invalid site"):
        text.read_sites(spark, f"{tmp_path}/bad").collect()
    (tmp_path / "g.gtf").write_text('#!x\nchr1\ta\tgene\t1\t100\t.\t+\t.\tgene_id "g;1"; gene_name "N"\n' + "".join(f'chr1\ta\texon\t{s}\t{e}\t.\t-\t.\ttranscript_id "t1"; gene_type "lncRNA"\n' for s, e in ((11, 20), (41, 50))))
    gtf = text.read_gtf(spark, f"{tmp_path}/g.gtf")
    t = text.transcripts(gtf).first()
    assert (t["name"], t["minus"], [tuple(x) for x in t["exons"]], t["tx_id"]) == ("t1", True, [(40, 50), (10, 20)], 0)
    assert text.transcripts(gtf, ("protein_coding",)).count() == 0
    assert tuple(text.genes(gtf).first())[:4] == ("chr1", 0, 100, "N")
    assert gtf.select(text.attribute(F.col("attrs"), "gene_id")).first()[0] == "g;1"


def test_vcf_text_and_back(spark):
    s = spark.createDataFrame([("chr1", 1, "A", 10, 8, 0, 2, 0, 0.2, 0.95), ("chr1", 2, "T", 5, 0, 1, 0, 4, 0.2, 0.8)], "chrom string, pos long, ref string, depth long, a long, c long, g long, t long, freq double, score double")
    lines = vcf.lines(vcf.records(s, 0.9)).orderBy("pos")
    got = [r["line"] for r in lines.collect()]
    assert got[0] == "chr1\t1\t.\tA\tG\t.\tPASS\tESP_SCORE=0.95;VAF=0.20000000;DEPTH=10;AC=2;STRAND=+"
    assert got[1].split("\t")[6] == "LOW_SCORE"
    back = vcf.parse(lines.select(F.col("line").alias("value"))).orderBy("pos").collect()
    assert (back[0]["passed"], back[0]["score"], back[0]["depth"]) == (True, 0.95, 10) and back[1]["alt"] == "C"


def test_render_guards_the_script():
    assert report.render({"a": "</script>"}, "x __DATA__ y") == 'x {"a":"<\\/script>"} y'
    with pytest.raises(ValueError):
        report.render({}, "none")


def test_qc_run_of_pairs(spark):
    insert = "ACGTTGCAAGCTTAGGCATTCGATCGGATTACAGGCATAC"
    rc = insert[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(0, 0, 1, "r0/1", insert + "AGATCG", "5" * 46), (0, 0, 2, "r0/2", rc + "AGATCG", "I" * 46), (0, 1, 1, "r1/1", "N" * 40, "I" * 40), (0, 1, 2, "r1/2", insert, "I" * 40)]
    reads = spark.createDataFrame(rows, "lane int, ord long, mate int, name string, seq string, qual string")
    judged, told = qc.run(reads, qc.Options(keep_unpaired=True))
    got = {(r["ord"], r["mate"]): r for r in judged.collect()}
    assert got[0, 1]["seq"] == insert and got[0, 2]["seq"] == rc and got[0, 1]["kept"]
    assert got[1, 1]["reason"] == "too_many_n" and got[1, 2]["unpaired"]
    assert told["adapter_reads"] == 2 and told["reads_out"] == 2 and told["unpaired_written"] == 1
    with pytest.raises(qc.QcError, match="match"):
        qc.run(reads.filter("not (ord = 1 and mate = 2)"))
    with pytest.raises(qc.QcError, match="Phred"):
        qc.run(reads.withColumn("qual", F.lit("h" * 46)))


def test_merge_takes_the_best_and_drops_conflicts(spark):
    cols = "ord long, chrom string, pos long, template string, base string, bq int, mapq double, end_fraction double, orientation int, softclip_fraction double, gap_nearness double"
    row = lambda o, p, b, q: (o, "c", p, "t", b, q, 60.0, 0.1 * o, 0, 0.0, 0.0)
    d = spark.createDataFrame([row(1, 1, "A", 20), row(2, 1, "G", 20), row(3, 1, "G", 30), row(4, 2, "A", 20), row(5, 2, "G", 20), row(6, 3, "A", 20), row(7, 3, "A", 20)], cols)
    got = {r["pos"]: (r["base"], r["end_fraction"]) for r in pileup.merge_templates(d).collect()}
    assert got == {1: ("G", pytest.approx(0.3)), 3: ("A", pytest.approx(0.6))}


def test_streaming_counts_follow_batches(spark, sf, tmp_path):
    src = tmp_path / "in"
    a = synth.alignments(spark, sf).filter("ord % 50 = 0").persist()
    a.filter("ord % 100 = 0").write.parquet(str(src / "1"))
    schema = a.schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(src))
    q = streaming.counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    try:
        q.processAllAvailable()
        a.filter("ord % 100 <> 0").write.parquet(str(src / "2"))
        q.processAllAvailable()
        want = pileup.base_counts(pileup.aligned_bases(a))
        got = spark.table("counts")
        assert got.exceptAll(want).count() == 0 and want.count() == got.count()
    finally:
        q.stop()


@pytest.fixture
def small_run(tmp_path):
    r = random.Random(8)
    g = "".join(r.choice("ACGT") for _ in range(2000))
    (tmp_path / "g.fa").write_text(">chr1\n" + g + "\n")
    with gzip.open(tmp_path / "r.fq.gz", "wt") as f:
        for i in range(60):
            p = r.randrange(0, 1900)
            s = list(g[p : p + 80])
            s[40] = {"A": "G", "T": "C"}.get(s[40], s[40])
            f.write(f"@r{i}\n{''.join(s)}\n+\n{'5' + 'I' * 79}\n")
    return stages.RunParams(out=f"{tmp_path}/run", fasta=f"{tmp_path}/g.fa", r1=[f"{tmp_path}/r.fq.gz"], kmer=11, window=5, tile=512)


def test_run_and_resume(spark, small_run):
    run = stages.Run(spark, small_run)
    assert run.run() == ["qc", "map", "sort", "scan", "vcf"]
    vcf_rows = run.table("vcf").orderBy("pos").collect()
    assert vcf_rows and all(r["ref"] in "AT" for r in vcf_rows)
    assert stages.resume(spark, small_run.out) == []
    (open(run.seal("scan"), "w")).write("torn")
    assert stages.resume(spark, small_run.out) == ["scan", "vcf"]
    assert [r["pos"] for r in run.table("vcf").orderBy("pos").collect()] == [r["pos"] for r in vcf_rows]
    small_run.kmer = 13
    with pytest.raises(ValueError, match="other inputs"):
        stages.Run(spark, small_run).run()


def test_entries_and_lock(tmp_path):
    for bad in ({}, {"r1": ["a"], "bam": "b"}, {"sites": "s"}, {"r2": ["a"]}):
        with pytest.raises(ValueError):
            stages.RunParams(out="o", fasta="f", **bad).entry()
    assert stages.RunParams(out="o", fasta="f", bam="b", sites="s").entry() == "bam_sites"
    with stages.RunLock(str(tmp_path)), pytest.raises(RuntimeError), stages.RunLock(str(tmp_path)):
        pass
