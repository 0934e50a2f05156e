"""Functions on columns and single reads, by example and by brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import cigar, dna, likelihood, numeric, trees, trim


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_quality_trim_keeps_good_reads_and_cuts_bad_tails():
    assert trim.quality_keep(chr(53) * 50, 20) == 50
    assert trim.quality_keep("I" * 45 + "&" * 5, 20) == 45
    assert trim.quality_front("&" * 5 + "I" * 45, 20) == 5


def test_poly_g():
    assert trim.poly_g_keep("ACGTACGTAC" + "G" * 20) == 8
    assert trim.poly_g_keep("ACGTACGTAC" + "G" * 6) == 16
    assert trim.poly_g_keep("G" * 40) == 0


def test_adapter_at_every_place_and_before_the_start():
    a = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
    insert = "TTGACCATGCAATGCTTGACCTTAGGCATT"
    for n in range(len(insert)):
        assert trim.adapter_cut(insert[:n] + a, a) == n
    assert trim.adapter_cut(a[3:], a) == 0
    assert trim.adapter_cut(insert + a[:10] + "C" + a[10:], a) == len(insert)
    assert trim.adapter_cut("ACG", a) is None


def test_overlap_of_a_short_insert():
    random.seed(4)
    x = "".join(random.choice("ACGT") for _ in range(60))
    rc = x.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert trim.overlap(x, rc) == (0, 60)
    assert trim.overlap(x + "AAAA", rc + "CCCC") == (-4, 60)
    assert trim.overlap("A" * 30, "T" * 30) is None


def test_detects_a_planted_adapter():
    random.seed(1)
    a = "CTGTCTCTTATACACATCTGG"
    reads = ["".join(random.choice("ACGT") for _ in range(30 + i % 9)) + a for i in range(200)]
    found = trim.detect_adapter(reads)
    assert found and a[1:] in found + "GG"
    assert trim.detect_adapter([]) is None


@pytest.mark.parametrize("text", ["50M", "5S45M", "20M100N30M", "25M2I23M", "30M3D20M", "*"])
def test_cigar_round_trip(spark, text):
    assert one(spark, cigar.text(cigar.parse(F.lit(text)))) == text


def test_cigar_parts(spark):
    c = cigar.parse(F.lit("5S20M100N10M2I8M3D5M"))
    assert one(spark, cigar.ref_end(F.lit(1000), c)) == 1000 + 20 + 100 + 10 + 8 + 3 + 5
    assert one(spark, cigar.read_length(c)) == 50
    assert [tuple(x) for x in one(spark, cigar.blocks(F.lit(0), c))] == [(0, 5, 20), (120, 25, 10), (130, 37, 8), (141, 45, 5)]
    assert [tuple(x) for x in one(spark, cigar.introns(F.lit(0), c))] == [(20, 120)]
    assert one(spark, cigar.gaps(c)) == [24.5, 34.5, 36.5, 44.5]
    assert one(spark, cigar.text(cigar.before_read(c, F.lit(30)))) == "5S20M100N5M"
    assert one(spark, cigar.text(cigar.from_read(c, F.lit(30)))) == "5M2I8M3D5M"
    assert one(spark, cigar.text(cigar.compact(cigar.parse(F.lit("3M4M0I2M"))))) == "9M"
    known = F.array(F.struct(F.lit(38).alias("start"), F.lit(41).alias("end")))
    assert one(spark, cigar.text(cigar.annotated_micro_deletions(F.lit(0), cigar.parse(F.lit("38M3D5M")), known))) == "38M3N5M"


def test_bases(spark):
    assert one(spark, dna.revcomp(F.lit("AcGTn"))) == "nACgT"
    assert one(spark, dna.revcomp_strict(F.lit("acxT"))) == "ANGT"
    assert one(spark, dna.amino_acid(F.lit("ATG"))) == "M"
    assert one(spark, dna.amino_acid(F.lit("ANG"))) is None
    assert one(spark, dna.splice_signal(F.lit("CT"), F.lit("AC"), F.lit(True))) == "GT-AG"
    assert one(spark, dna.intron_penalty(F.lit(100_000))) == 16
    assert one(spark, dna.template_name(F.lit("r1/2"))) == "r1"
    assert one(spark, dna.two_colour_instrument(F.lit("A00123:1 x"))) == "A00123"
    assert one(spark, dna.two_colour_instrument(F.lit("M00123:1"))) is None


def test_minimizers_by_brute_force():
    random.seed(2)
    for _ in range(50):
        s = "".join(random.choice("ACGTN" if random.random() < 0.1 else "ACGT") for _ in range(random.randint(3, 60)))
        k, w = 5, 3
        want, last = [], None
        code = {"A": 0, "C": 1, "G": 2, "T": 3}
        values = []
        for i in range(len(s) - k + 1):
            x = s[i : i + k]
            if "N" in x:
                values.append(None)
                continue
            f = sum(code[c] << 2 * (k - 1 - j) for j, c in enumerate(x))
            r = sum((3 - code[c]) << 2 * j for j, c in enumerate(x))
            m = min(f, r)
            values.append((int(dna.mix64(np.array([m], dtype=np.uint64))[0]), i, m, r < f))
        span = min(w, len(values))
        for i in range(len(values) - span + 1 if values else 0):
            own = [v for v in values[i : i + span] if v]
            if own and min(own)[1] != last:
                v = min(own)
                want.append((v[2], v[1], v[3]))
                last = v[1]
        assert dna.minimizers(s, k, w) == want


def test_exact_rounding():
    assert [numeric.fixed_text(x, 3) for x in (0.0625, 0.1875, 0.0615)] == ["0.062", "0.188", "0.061"]
    assert numeric.fixed_text(85.529999, 2) == "85.53"
    assert numeric.shortest_text(1e-7) == "0.0000001" and numeric.shortest_text(1.0) == "1" and numeric.shortest_text(1e22) == "1" + "0" * 22


def test_bayes_factors_do_not_jump_at_the_depth_limit_and_match_an_integral():
    kind, bq = np.array([0, 1]), np.array([30, 30])
    for n in ([40, 23], [41, 23], [400, 230], [1000, 0], [0, 900]):
        n = np.array(n)
        got = likelihood.bayes_factors(kind, bq, n)
        a, b = likelihood._line(kind, bq.astype(float))
        p = np.linspace(0, 1, 200_001)
        ll = np.log(np.maximum(a + b * p[:, None], 1e-300)) @ n
        want = ll.max() + np.log(np.trapezoid(np.exp(ll - ll.max()), p))
        # at the ends of [0, 1] the fixed breakpoints are coarser
        near = 1e-3 if n.min() else 0.2
        assert got[0] == pytest.approx(want - ll[0], rel=1e-4, abs=near) and got[1] == pytest.approx(want - ll[-1], rel=1e-4, abs=near)
    assert likelihood.bayes_factors(kind[:0], bq[:0], kind[:0]) == (0.0, 0.0)


MODEL = """tree
feature_names=a b
Tree=0
split_feature=0 1
threshold=0.5 2
decision_type=2 8
left_child=1 -1
right_child=-3 -2
leaf_value=1 2 4

Tree=1
split_feature=1
threshold=0
decision_type=6
left_child=-1
right_child=-2
leaf_value=-0.5 0.25

end of trees
"""


def test_trees(spark):
    m = trees.parse_model(MODEL, 2, 2)
    x = np.array([[0, 1], [0, 3], [1, 0], [np.nan, np.nan]], dtype=np.float32)
    # the last tree takes zero for missing and sends it left
    assert m.raw(x).tolist() == [1.25, 2.25, 3.5, 1.5]
    with pytest.raises(ValueError, match="expected 400"):
        trees.parse_model(MODEL, 2)
    got = spark.createDataFrame([([0.0, 1.0],)], "f array<float>").select(trees.score_col(F.col("f"), m)).first()[0]
    assert got == pytest.approx(1 / (1 + np.exp(-1.25)))


def test_trims_of_batches_equal_those_of_single_reads(monkeypatch):
    import random

    import pyarrow as pa

    from helixframe.functions import trim_batches

    monkeypatch.setattr(trim_batches, "CELLS", 1 << 10)  # many blocks
    r = random.Random(5)
    some = lambda n: "".join(r.choice("ACGTacgN") for _ in range(n))
    adapters = ["AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "CTGTCTCTTATACACATCT"]

    def read():
        s, a = some(r.randrange(70)), list(r.choice(adapters))
        for _ in range(r.randrange(4)):
            a[r.randrange(len(a))] = r.choice("ACGT")
        kind, at = r.randrange(7), r.randrange(1, len(a))
        a[at : at + (kind == 1)] = ["A"] if kind == 0 else []
        tail = "".join(r.choice("GGGGGGGA") for _ in range(r.randrange(40)))
        return [s[:40] + "".join(a)[r.randrange(4) :]] * 3 + [s + tail, s, "é" + s, None] if kind < 3 else [s[: r.randrange(6)]]

    seqs = [s for _ in range(300) for s in read()]
    quals = [s and "".join(chr(33 + r.randrange(42)) for _ in s) for s in seqs]
    each = lambda f, rows: [None if x is None else f(x) for x in rows]
    text = lambda rows: pa.array(rows, pa.string())
    assert trim_batches.quality_keep(text(quals), 20).to_pylist() == each(lambda q: trim.quality_keep(q, 20), quals)
    assert trim_batches.poly_g_keep(text(seqs)).to_pylist() == each(trim.poly_g_keep, seqs)
    for table in (adapters, ["ACGT"], ["ACGTACG", "TTAGGCATC"], ["ACG"], []):
        want = [None if x is None or x < 0 else x for x in each(lambda s, t=table: trim.adapters_cut(s, t), seqs)]
        assert trim_batches.adapters_keep(text(seqs), table).to_pylist() == want
    mates = [s and (some(r.randrange(5)) + s[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")) + some(r.randrange(5)))[: r.randrange(20, 90)] for s in seqs]
    found = [(x["offset"], x["length"]) if x else None for x in trim_batches.overlap(text(seqs), text(mates)).to_pylist()]
    assert found == [(None, None) if s is None or trim.overlap(s, m) is None else trim.overlap(s, m) for s, m in zip(seqs, mates)]


def test_single_ends_are_trimmed_as_read_by_read(spark):
    from helixframe.operators import qc

    a = qc.ADAPTERS_1[0]
    seqs = ["ACGTTGCAAC" * 3 + a[:20], "acgtacgtac" + "G" * 25, "ACGT" * 12, "AC", "", a[3:] + "ACGT", "ACéGT" * 8]
    rows = [(0, i, 1, f"r{i}", s, "".join(chr(33 + (i * 7 + j * 3) % 41) for j in range(len(s)))) for i, s in enumerate(seqs)]
    o = qc.Options(quality_trim=True, poly_g="on", front_1=2, tail_1=1)
    got = {r["ord"]: r for r in qc.trim_single(spark.createDataFrame(rows, "lane int, ord long, mate int, name string, seq string, qual string"), o, None, qc.ADAPTERS_1).collect()}
    for _, i, _, _, s, q in rows:
        want = qc._end(s, q, 2, 1, o, True, qc.ADAPTERS_1)
        g = got[i]
        assert (g["seq"], g["qual"], g["by_quality"], g["by_poly_g"], g["by_adapter"], g["adapter_hit"]) == (*want[:4], max(want[4], 0), want[4] >= 0)


def test_kmers_are_told_as_rows_of_codes(spark):
    import random

    from pyspark.sql import functions as F

    r = random.Random(3)
    rows = [(i, "".join(r.choice("ACGTacgN") for _ in range(r.randrange(60)))) for i in range(50)] + [(50, None), (51, ""), (52, "ACGT" * 10), (53, "T" * 40)]
    d = spark.createDataFrame(rows, "read long, seq string")
    x = d.select("read", F.explode(dna.kmers(F.col("seq"), 15)).alias("x"))
    canon = dna.canonical(F.col("x.kmer"))
    want = sorted(map(tuple, x.select("read", canon, "x.pos", canon != F.col("x.kmer")).collect()))
    got = dna.minimizer_rows(d, "read", 15, 1)
    assert sorted(map(tuple, got.select("read", dna.kmer_text(F.col("kmer"), 15), "pos", "minus").collect())) == want
    assert sorted(map(tuple, dna.kmer_counts(d, 15).collect())) == sorted(map(tuple, x.groupBy(canon).count().collect()))
    each = sorted((i, k, p, m) for i, s in rows for k, p, m in dna.minimizers(s or "", 5, 4))
    assert sorted(map(tuple, dna.minimizer_rows(d, "read", 5, 4).drop("size").collect())) == each
