"""Alignment kernels against brute force, and the mapper on a planted genome."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.operators import junctions, kmer_index, pairs, transcripts
from helixframe.operators.align import kernels as k
from helixframe.operators.align import mapper


def dna(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("ACGT") for _ in range(n))


def brute_local(read, ref):
    never, best = -(10**6), 0
    h = [[0] * (len(ref) + 1) for _ in range(len(read) + 1)]
    e = [[never] * (len(ref) + 1) for _ in range(len(read) + 1)]
    f = [[never] * (len(ref) + 1) for _ in range(len(read) + 1)]
    for i in range(1, len(read) + 1):
        for j in range(1, len(ref) + 1):
            e[i][j] = max(h[i - 1][j] - 6, e[i - 1][j] - 2)
            f[i][j] = max(h[i][j - 1] - 6, f[i][j - 1] - 2)
            s = 2 if read[i - 1] == ref[j - 1] != "N" else -4
            h[i][j] = max(0, h[i - 1][j - 1] + s, e[i][j], f[i][j])
            best = max(best, h[i][j])
    return best


def score_of(x, read, ref):
    q, p, s = 0, x.ref_start, 0
    for op, n in x.cigar:
        if op == "S":
            q += n
        elif op == "M":
            s += sum(2 if read[q + t] == ref[p + t] != "N" else -4 for t in range(n))
            q, p = q + n, p + n
        else:
            s -= 4 + 2 * n
            q, p = (q + n, p) if op == "I" else (q, p + n)
    assert q == len(read)
    return s


def mutated(x, r, most=4):
    x = list(x)
    for _ in range(r.randint(0, most)):
        p, o = r.randrange(len(x)), r.random()
        if o < 0.5:
            x[p] = r.choice("ACGTN")
        elif o < 0.75:
            x.insert(p, r.choice("ACGT"))
        elif len(x) > 4:
            del x[p : p + r.randint(1, 3)]
    return "".join(x)


def test_local_alignment_is_optimal():
    r = random.Random(5)
    refs = [dna(r.randint(10, 60), i) for i in range(80)]
    reads = [mutated(x[r.randint(0, 4) : len(x) - r.randint(0, 4)], r) for x in refs]
    for read, ref, got in zip(reads, refs, k.affine_local(reads, refs)):
        assert got.score == brute_local(read, ref) == score_of(got, read, ref)


def test_edit_distance():
    def infix(read, ref):
        same = lambda x, y: x == y or (y, x) in (("A", "G"), ("T", "C"))
        prev, best = list(range(len(read) + 1)), (len(read), 0)
        for j, c in enumerate(ref):
            cur = [0]
            for i, x in enumerate(read, 1):
                cur.append(min(prev[i] + 1, cur[-1] + 1, prev[i - 1] + (not same(x, c))))
            prev = cur
            if prev[-1] < best[0]:
                best = (prev[-1], j + 1)
        return best

    r = random.Random(6)
    for i in range(150):
        ref = dna(r.randint(5, 80), i)
        read = mutated(ref[2 : r.randint(4, len(ref))], r).replace("N", "A")
        assert k.edit_infix(read, ref) == infix(read, ref)
    assert k.edit_global("GGG", "AAA") == 0 and k.edit_global("AAA", "GGG") == 3


def test_chain_of_colinear_anchors():
    found = k.chains([("c", False, 100 + 10 * i, 10 * i) for i in range(20)])
    assert len(found) == 1 and found[0].score == 205 and k.second_score(found) == 0
    two = k.chains([("c", False, 100 + 10 * i, 10 * i) for i in range(20)] + [("d", False, 7 + 10 * i, 10 * i) for i in range(10)])
    assert [c.chrom for c in two] == ["c", "d"] and k.second_score(two) == 105


def test_scores_and_quality():
    p = k.rescore(k.Placement("c", False, 0, [("M", 50)]), "ACGTA" * 10, lambda s, e: ("ACGTA" * 10)[s:e])
    quality = lambda p: tuple(x[0] for x in k.qualities([k.numbers(p)]))
    assert p.score == 100 and quality(p)[0] >= 0
    p.chain_score, p.anchors = 100, 12
    assert quality(p) == (60, "unique")
    p.second = 100
    assert quality(p) == (0, "ext_margin")
    p.rescued, p.second = True, 0
    assert quality(p)[0] == 20
    q = k.rescore(k.Placement("c", False, 0, [("M", 50)]), "ACGTC" + "ACGTA" * 9, lambda s, e: ("ACGTA" * 10)[s:e])
    assert q.score == 94 and q.mismatches == 1
    assert k.hyperedited(k.Placement("c", False, 0, [("M", 50)], edits_ag=3)) and not k.hyperedited(k.Placement("c", False, 0, [("M", 50)], edits_ag=3, edits_tc=1))


def test_arbitration_refuses_and_finds_the_runner_up():
    a = k.Placement("c", False, 0, [("M", 50), ("S", 50)], score=100)
    assert k.arbitrate([a], 100) is None
    b, c = k.Placement("c", False, 0, [("M", 100)], score=200), k.Placement("c", False, 10, [("M", 100)], score=190)
    d = k.Placement("d", False, 0, [("M", 100)], score=150)
    assert k.arbitrate([d, c, b], 100) is b and b.second == 150


def test_rescue_prefilter():
    clean = dna(150, 9)
    assert k.rescue_prefilter(clean, "I" * 150)
    for bad in (clean[:125] + "A" * 25, "N" * 20 + clean[20:], "AT" * 75):
        assert not k.rescue_prefilter(bad, "I" * 150)
    assert not k.rescue_prefilter(clean, "5" * 150)


@pytest.fixture(scope="module")
def genome(spark):
    chr1 = dna(3000, 11)
    chr1 = chr1[:1057] + "GT" + chr1[1059:1215] + "AG" + chr1[1217:]  # an intron [1057, 1217)
    chr2 = dna(1500, 12)
    width = 400
    rows = [(c, i, s[i : i + width]) for c, s in (("chr1", chr1), ("chr2", chr2)) for i in range(0, len(s), width)]
    return chr1, chr2, spark.createDataFrame(rows, "chrom string, start long, seq string").persist(), width


def test_mapper_places_reads(spark, genome):
    chr1, chr2, tiles, width = genome
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    spliced = chr1[1007:1057] + chr1[1217:1267]
    reads = {
        0: chr1[200:300], 1: rc(chr2[380:480]), 2: chr2[100:150] + chr2[153:203], 3: spliced, 4: dna(100, 99),
        5: chr1[200:300], 6: chr1[500:540] + chr1[540:570].replace("A", "G", 3) + chr1[570:600],
    }
    df = spark.createDataFrame([(i, f"r{i}", s, "I" * len(s)) for i, s in reads.items()], "ord long, name string, seq string, qual string")
    got = {r["ord"]: r for r in mapper.align(df, tiles, width, kmer=11, w=5).withColumn("text", cg.text(F.coalesce("cigar", F.array().cast(cg.TYPE)))).collect()}
    place = lambda i: (got[i]["chrom"], got[i]["pos"], got[i]["minus"], got[i]["text"])
    assert place(0) == place(5) == ("chr1", 200, False, "100M")
    assert place(1) == ("chr2", 380, True, "100M")
    assert place(2)[:2] == ("chr2", 100) and "3D" in place(2)[3]
    assert place(3) == ("chr1", 1007, False, "50M160N50M")
    assert got[4]["chrom"] is None
    assert got[6]["edits_ag"] == 3 and got[6]["mismatches"] == 0
    records = mapper.to_records(mapper.align(df, tiles, width, kmer=11, w=5))
    assert {r["ord"]: r["flag"] for r in records.collect()}[4] == 4
    found = junctions.observed(records.filter("flag & 4 = 0")).collect()
    assert [(r["chrom"], r["start"], r["end"], r["n"]) for r in found] == [("chr1", 1057, 1217, 1)]


def test_rescue_of_hyperedited_reads(spark, genome):
    chr1, _, tiles, width = genome
    r = random.Random(3)
    read = "".join("G" if c == "A" and r.random() < 0.7 else c for c in chr1[1500:1600])
    df = spark.createDataFrame([(0, "h", read, "I" * 100)], "ord long, name string, seq string, qual string")
    assert mapper.align(df, tiles, width, kmer=11, w=5).first()["chrom"] is None
    got = mapper.rescue(df, tiles, width, kmer=11, w=5).collect()
    assert [(x["chrom"], x["pos"], x["direction"]) for x in got] == [("chr1", 1500, "A")] and got[0]["mapq"] <= 20


def test_vote_table(spark):
    cols = "chrom string, start long, end long, minus boolean, "
    found = spark.createDataFrame([("c", 100, 200, False, 40, 2400), ("c", 101, 200, False, 7, 420), ("c", 100, 900, False, 3, 180), ("c", 5000, 6000, False, 1, 60), ("c", 7001, 7100, True, 5, 300), ("c", 8000, 8100, False, 5, 300), ("c", 8001, 8101, False, 6, 360)], cols + "n long, mapq_sum long")
    lib = spark.createDataFrame([("c", 100, 200, False, 1), ("c", 7000, 7100, False, 1), ("c", 8001, 8101, False, 1)], cols + "support long")
    judged, removed = junctions.vote(found, lib)
    fate = {(r["start"], r["end"]): r["fate"] for r in judged.collect()}
    assert fate == {(100, 200): "tie", (101, 200): "outvoted", (100, 900): "kept", (7001, 7100): "outvotes", (8000, 8100): "tie", (8001, 8101): "tie"}
    assert [tuple(r) for r in removed.collect()] == [("c", 7000, 7100, False)]
    assert junctions.vote(found, None)[0].filter("fate = 'kept'").count() == 6


def test_pairs_and_spans(spark):
    def pair(p1, c1, m1, p2, c2, m2):
        r = "struct<chrom:string,pos:long,minus:boolean,cigar:string>"
        d = spark.createDataFrame([((("c", p1, m1, c1)), ("c", p2, m2, c2))], f"a {r}, b {r}")
        fix = lambda x: F.struct(F.col(f"{x}.chrom").alias("chrom"), F.col(f"{x}.pos").alias("pos"), F.col(f"{x}.minus").alias("minus"), cg.parse(F.col(f"{x}.cigar")).alias("cigar"))
        return pairs.relate(d.select(fix("a").alias("a"), fix("b").alias("b"))).select("span", "proper", "tlen").first()

    assert tuple(pair(1000, "150M", False, 1200, "150M", True)) == (350, True, 350)
    assert tuple(pair(1200, "150M", True, 1000, "150M", False)) == (350, True, -350)
    assert tuple(pair(1000, "150M", False, 1200, "150M", False))[1] is False
    assert tuple(pair(1000, "100M5000N50M", False, 6150, "150M", True))[0] == 300


def test_transcript_sequences_cross_tiles(spark, genome):
    chr1, _, tiles, width = genome
    tx = spark.createDataFrame([("p", "chr1", False, [(350, 450), (790, 810)]), ("m", "chr1", True, [(790, 810), (350, 450)]), ("x", "chr1", False, [(2990, 3010)])], "name string, chrom string, minus boolean, exons array<struct<s:long,e:long>>")
    got = {r["name"]: r["seq"] for r in transcripts.sequences(tx, tiles, width).collect()}
    plus = chr1[350:450] + chr1[790:810]
    assert got == {"p": plus, "m": plus[::-1].translate(str.maketrans("ACGT", "TGCA")), "x": ""}
    assert [r[0] for r in tx.select(transcripts.valid(F.col("exons"), F.col("minus"))).collect()] == [True, True, True]


def test_index_has_every_kmer_and_cutoff_is_a_rank(spark, genome):
    chr1, chr2, tiles, width = genome
    index = kmer_index.kmer_index(tiles, width, 21)
    assert index.count() == len(chr1) + len(chr2) - 40
    assert kmer_index.frequency_cutoff(index) == 1
    assert kmer_index.frequency_cutoff(index.limit(0)) == (1 << 32) - 1


def ungapped_diagonal(read, ref):
    """The diagonal of the best run, the first on ties."""
    from helixframe.operators.align.second_look import best_segment

    best = (-1, 0)
    for d in range(-len(read) + 8, len(ref) - 7):
        a, b = max(0, -d), min(len(read), len(ref) - d)
        best = max(best, (best_segment(read[a:b], ref[a + d : b + d], "")[2], -d))
    return -best[1]


def test_banded_extension_is_the_full_one(spark, sf):
    from helixframe.plans import alignment

    r = random.Random(3)
    reads, refs, diagonals = [], [], []
    for i in range(300):
        ref = dna(160, 900 + i)
        at = r.randrange(10, 60)
        read = list(ref[at : at + 90])
        for _ in range(r.randrange(0, 6)):
            j = r.randrange(len(read))
            read[j : j + 1] = r.choice([["A"], ["C"], [], [read[j], "G", "T"], []])
        if i % 9 == 0:
            read[30:30] = list(dna(r.randrange(1, 20), i))
        reads.append("".join(read))
        refs.append(ref)
        diagonals.append(at + r.randrange(-3, 4))
    reads += ["", "ACGT", "A" * 30]
    refs += ["ACGT", "", "C" * 30]
    diagonals += [0, 0, 0]
    for direction in ("", "A"):
        got, again = k.affine_banded(reads, refs, diagonals, direction)
        assert got == k.affine_local(reads, refs, direction)
        assert len(again) < 0.25 * len(reads)
    rows = alignment._windows(spark, sf).limit(1500).collect()
    reads, refs = [x["read"] for x in rows], [x["seq"] for x in rows]
    got, _ = k.affine_banded(reads, refs, [ungapped_diagonal(x, y) for x, y in zip(reads, refs)])
    assert got == k.affine_local(reads, refs)


def test_decoys_lose_ties_and_directions_decide(spark):
    p = lambda chrom, **x: k.Placement(chrom, False, 0, [("M", 100)], **x)
    assert k.arbitrate([p("decoy_a", score=200), p("z", score=200)], 100).chrom == "z"
    assert k.arbitrate([p("decoy_a", score=202), p("z", score=200)], 100).chrom == "decoy_a"
    assert k.edit_direction([p("a", score=9, edits_ag=9)]) == "A" and k.edit_direction([p("a", edits_ag=9, edits_tc=9)]) == ""
    # an edited copy wins over a diverged one once its edits are free
    seq = dna(400, 71)
    edited = seq[100:200].replace("A", "G", 12)
    other = "".join(x if i % 14 else "ACGT"[("ACGT".index(x) + 2) % 4] for i, x in enumerate(edited))
    unit = dna(300, 72)
    rows = [("chr1", i, (seq + unit)[i : i + 300]) for i in range(0, 700, 300)] + [("chr2", i, (unit + other + unit)[i : i + 300]) for i in range(0, 700, 300)]
    from helixframe.operators.align import mapper

    tiles = spark.createDataFrame(rows, "chrom string, start long, seq string")
    got = mapper.align(spark.createDataFrame([(0, "r", edited, "I" * 100)], "ord long, name string, seq string, qual string"), tiles, 300, kmer=9, w=3).first()
    assert got["edits_ag"] == 0 or got["chrom"] == "chr1"
    assert got["origin"] == "genome"


def test_exact_kmers():
    fetch = lambda s, e: ("ACGTACGTAC" * 10)[s:e]
    read = "ACGTACGTAC" * 3
    assert k.exact_kmers(read, 0, [("M", 30)], fetch, 10) == 3
    assert k.exact_kmers(read[:12] + "C" + read[13:], 0, [("M", 30)], fetch, 10) == 2
    assert k.exact_kmers(read[:8] + "G" + read[9:], 0, [("M", 30)], fetch, 10) == 2 and k.exact_kmers(read[:8] + "G" + read[9:], 0, [("M", 30)], fetch, 10, "A") == 3
    assert k.exact_kmers("NN" + read, 0, [("S", 2), ("M", 10), ("D", 10), ("M", 20)], fetch, 10) == 3


def test_ways_on_one_diagonal_are_told_together(monkeypatch):
    r, traced, real = random.Random(9), [], k._trace
    refs = [dna(60, i) for i in range(40)]
    reads = [x[5:30] + r.choice("ACGT") + x[31:50] for x in refs]
    want = [real_extension(x, y) for x, y in zip(reads, refs)]
    monkeypatch.setattr(k, "_trace", lambda *a: traced.append(1) or real(*a))
    assert [(e.ref_start, e.cigar, e.score) for e in k.affine_local(reads, refs)] == want and not traced
    assert "D" in {op for e in k.affine_local([refs[0][:20] + refs[0][22:50]], refs[:1]) for op, _ in e.cigar} and traced


def real_extension(read, ref):
    score = sum(2 if x == y else -4 for x, y in zip(read, ref[5:]))
    return 5, [("M", len(read))], score


def test_exact_kmers_of_many_reads():
    r = random.Random(4)
    shapes = [([("M", 50)], 50), ([("S", 5), ("M", 45)], 45), ([("M", 20), ("N", 100), ("M", 30)], 150), ([("M", 25), ("I", 2), ("M", 23)], 48), ([("M", 30), ("D", 3), ("M", 20)], 53)]
    rows = [(dna(50, i), r.choice(shapes)) for i in range(200)]
    rows = [(read, cigar, "".join(r.choice("ACGTN") if r.random() < 0.1 else read[i % 50] for i in range(span))) for read, (cigar, span) in rows]
    for direction in ("", "A"):
        got = k.exact_kmers_of([x for x, _, _ in rows], ["".join(f"{n}{op}" for op, n in c) for _, c, _ in rows], [y for _, _, y in rows], 5, direction)
        assert got.tolist() == [k.exact_kmers(x, 0, c, lambda s, e, y=y: y[s:e], 5, direction) for x, c, y in rows] and got.sum() > 0


def test_windows_are_fetched_once(spark, sf, monkeypatch):
    from helixframe.operators import transcripts
    from helixframe.plans import alignment

    asked, real = [], transcripts.tile_sequences
    monkeypatch.setattr(transcripts, "tile_sequences", lambda w, *a: asked.append((w.count(), w.select("chrom", "s", "e").distinct().count())) or real(w, *a))
    alignment.affine_extension(spark, sf), alignment.exact_kmer_support(spark, sf)
    assert len(asked) == 2 and all(rows == different for rows, different in asked)
