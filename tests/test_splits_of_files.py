"""Ranges of files: whatever the split, their records are the whole file's; regions and fetches read what they need."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.plans import synth
from helixframe.sources import bam, bgzf, fastq, lines


def blocked(data: bytes, block: int) -> bytes:
    return b"".join(bgzf.packed(data[i : i + block]) for i in range(0, len(data), block)) + bam.EOF


def fastq_text(n, seed):
    r, out = random.Random(seed), []
    for i in range(n):
        size = r.randrange(0, 60)
        # qualities that look like headers and separators
        q = "".join(r.choice("@+I#") for _ in range(size))
        out.append(f"@r{i}{r.choice(['', ' x', '/1'])}\n{''.join(r.choice('ACGTN') for _ in range(size))}\n+{r.choice(['', 'r'])}\n{q}\n")
    return "".join(out)


@pytest.mark.parametrize("kind", ["plain", "bgzf", "gz"])
@pytest.mark.parametrize("split", [37, 400, 5000])
def test_lines_of_ranges_tile_the_file(tmp_path, kind, split):
    r = random.Random(split)
    data = "\n".join("x" * r.choice([0, 1, 5, 300]) for _ in range(200)).encode() + r.choice([b"", b"\n"])
    path = tmp_path / "t"
    path.write_bytes(data if kind == "plain" else gzip.compress(data) if kind == "gz" else blocked(data, 97))
    with bgzf.File(str(path)) as f:
        want = [x for _, x in lines.lines(f)]
        assert want == (data[:-1] if data.endswith(b"\n") else data).split(b"\n")
        got = []
        n = lines.ranges(str(path), split)
        assert (n == 1) == (kind == "gz" or len(path.read_bytes()) <= split)
        for i in range(n):
            got += [x for inside, x in (lines.lines(f, i * split, (i + 1) * split) if n > 1 else lines.lines(f)) if inside]
        assert got == want


@pytest.mark.parametrize("kind", ["plain", "bgzf"])
@pytest.mark.parametrize("split", [150, 3000])
def test_fastq_in_ranges(spark, tmp_path, kind, split):
    data = fastq_text(300, split).encode()
    path = tmp_path / "a.fq"
    path.write_bytes(data if kind == "plain" else blocked(data, 700))
    whole = sorted(map(tuple, fastq.read_fastq(spark, [str(path)]).collect()))
    assert [r[1] for r in whole] == list(range(300))
    assert lines.ranges(str(path), split) > 1
    assert sorted(map(tuple, fastq.read_fastq(spark, [str(path)], split=split).collect())) == whole
    broken = data[:-3]
    path.write_bytes(broken if kind == "plain" else blocked(broken, 700))
    with pytest.raises(Exception, match="bases and|complete"):
        fastq.read_fastq(spark, [str(path)], split=split).collect()


@pytest.mark.parametrize("kind", ["plain", "bgzf"])
def test_fasta_in_ranges(spark, tmp_path, kind):
    r = random.Random(4)
    contigs = [(f"c{i}", "".join(r.choice("ACGTNacgtx") for _ in range(n))) for i, n in enumerate((1000, 0, 1, 4096, 333, 60, 61))]
    data = "".join(f">{n} about\n" + "".join(s[i : i + 60] + "\n" for i in range(0, len(s), 60)) for n, s in contigs).encode()
    path = tmp_path / "g.fa"
    path.write_bytes(data if kind == "plain" else blocked(data, 301))

    def told(split):
        c, t = fastq.read_fasta(spark, str(path), 128, keep_case=True, split=split)
        return [tuple(x) for x in c.orderBy("cid").collect()], sorted(map(tuple, t.collect()))

    want = told(1 << 20)
    assert [(n, size) for _, n, size in want[0]] == [(n, len(s)) for n, s in contigs]
    for n, s in contigs:
        assert "".join(x[2] for x in want[1] if x[0] == n) == s.replace("x", "n")
    assert told(500) == want and told(90) == want
    if kind == "plain":
        (tmp_path / "g.fai").write_text("\n".join(fastq.build_fai(spark, str(path), 200)) + "\n")
        index = fastq.read_fai(spark, str(tmp_path / "g.fai"))
        assert fastq.build_fai(spark, str(path)) == (tmp_path / "g.fai").read_text().splitlines()
        regions = [(n, *sorted((r.randrange(-5, len(s) + 9), r.randrange(-5, len(s) + 9)))) for n, s in contigs for _ in range(6)]
        got = fastq.fetch(spark, str(path), spark.createDataFrame(regions, "chrom string, s long, e long"), index).collect()
        of = dict(contigs)
        assert all(x["seq"] == of[x["chrom"]][max(x["s"], 0) : max(x["e"], 0)].replace("x", "n").upper() for x in got) and len(got) == len(regions)


@pytest.fixture(scope="module")
def a_bam(spark, sf, tmp_path_factory):
    """A sorted file with small blocks, so records stand over their ends."""
    top = tmp_path_factory.mktemp("bam")
    a = synth.alignments(spark, sf).limit(3000).withColumn("cid", F.regexp_extract("chrom", "([0-9]+)", 1).cast("int"))
    before, bam.BLOCK = bam.BLOCK, 1500
    try:
        parts = bam.write_bam(a.coalesce(1).sortWithinPartitions("cid", "pos", "ord"), [("chr1", 2200), ("chr2", 2200), ("chr3", 2200)], f"{top}/parts")
    finally:
        bam.BLOCK = before
    bam.join_parts(parts, f"{top}/x.bam")
    return f"{top}/x.bam"


def told(df):
    return [repr(r) for r in df.orderBy("ord").withColumn("cigar", cg.text(F.col("cigar"))).collect()]


def test_bam_in_ranges(spark, a_bam):
    want = told(bam.read_bam(spark, a_bam))
    assert len(want) == 3000
    for split in (20_000, 3_333):
        assert told(bam.read_bam(spark, a_bam, split)) == want
    placed = [r["pos"] for r in bam.read_bam(spark, a_bam, 20_000).filter("chrom = 'chr2'").orderBy("ord").collect()]
    assert placed == sorted(placed)


def test_regions_read_through_the_index(spark, a_bam):
    with pytest.raises(ValueError, match="no index"):
        bam.check_index(a_bam)
    bam.build_bai(spark, a_bam, 20_000)
    assert bam.check_index(a_bam) == f"{a_bam}.bai"
    rows = bam.read_bam(spark, a_bam).withColumn("end", cg.ref_end(F.col("pos"), F.col("cigar")))
    for regions in ([("chr2", 300, 340)], [("chr1", 0, 10), ("chr3", 2100, 2200), ("chr1", 5, 60)], [("chr9", 0, 5)], [("chr2", 5, 5)]):
        cond = " or ".join(f"(chrom = '{c}' and pos < {b} and end > {a} and {a} < {b})" for c, a, b in regions)
        assert told(bam.read_region(spark, a_bam, regions)) == told(rows.filter(cond).drop("end"))
    # a part of the file is read: what another contig's blocks hold isn't
    index = open(f"{a_bam}.bai", "rb").read()
    chunks = bam.region_chunks(index, 1, 0, 2200)
    size = len(open(a_bam, "rb").read())
    assert sum((b >> 16) - (a >> 16) for a, b in chunks) < 0.6 * size


def test_damaged_blocks_are_told(spark, a_bam, tmp_path):
    raw = bytearray(open(a_bam, "rb").read())
    raw[len(raw) // 2] ^= 255
    (tmp_path / "x.bam").write_bytes(raw)
    with pytest.raises(Exception, match="damaged|invalid|block"):
        bam.read_bam(spark, str(tmp_path / "x.bam")).collect()
    (tmp_path / "y.bam").write_bytes(b"no bam at all")
    with pytest.raises(Exception, match="block"):
        bam.bam_contigs(str(tmp_path / "y.bam"))


def test_writer_streams_blocks(tmp_path):
    w = bgzf.Writer(f"{tmp_path}/w", 1000)
    data = random.Random(1).randbytes(5_555)
    for i in range(0, len(data), 77):
        w.write(data[i : i + 77])
        assert len(w.held) < 1000 + 77
    w.close()
    assert gzip.decompress((tmp_path / "w").read_bytes()) == data
