"""New introns, short exons and run-through ends: planted cases come back; chains over several introns against brute force; whole reads over two and three introns."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.operators import kmer_index
from helixframe.operators.align import kernels as k
from helixframe.operators.align import mapper, splits
from helixframe.plans import splits as planned

RECORDS = "ord long, chrom string, pos long, c string, seq string"


def dna(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("ACGT") for _ in range(n))


def tiles_of(spark, seq, width):
    return spark.createDataFrame([("chr1", i, seq[i : i + width]) for i in range(0, len(seq), width)], "chrom string, start long, seq string"), width


def records(spark, rows):
    return spark.createDataFrame(rows, RECORDS).withColumn("cigar", cg.parse(F.col("c"))).drop("c")


def told(df):
    return {r["ord"]: (r["pos"], r["cigar"]) for r in df.withColumn("cigar", cg.text(F.col("cigar"))).collect()}


def with_introns(seq, introns, motif=("GT", "AG")):
    """seq with the motif at the introns' ends."""
    s = list(seq)
    for a, b in introns:
        s[a : a + 2], s[b - 2 : b] = motif
    return "".join(s)


def test_most_planted_splits_come_back(spark, sf):
    rows = planned.split_rescued(spark, sf).collect()
    n = planned.planted_splits(spark, sf).count()
    right = sum((r["start"], r["end"]) == (r["t_start"], r["t_end"]) for r in rows)
    assert right >= 0.9 * n
    assert {r["on_minus"] for r in rows} == {True, False}


def test_split_over_a_long_intron_needs_seeds(spark):
    seq = with_introns(dna(120_000, 5), [(20_000, 100_000)], ("CT", "AC"))
    tiles, width = tiles_of(spark, seq, 4096)
    read = seq[19_950:20_000] + seq[100_000:100_040]
    r = records(spark, [(1, "chr1", 19_950, "50M40S", read), (2, "chr1", 100_000, "50S40M", seq[19_950:20_000] + seq[100_000:100_040]), (3, "chr1", 500, "50M40S", seq[500:550] + dna(40, 8))])
    index = kmer_index.minimizer_index(tiles, width, 15, 10)
    want = (19_950, "50M80000N40M")
    for side, ord_ in (("end", 1), ("start", 2)):
        assert told(splits.split_tails(r, tiles, width, side)) == {}
        assert told(splits.split_tails(r, tiles, width, side, index)) == {ord_: want}


def test_split_takes_the_best_cut_and_leaves_what_does_not_fit(spark):
    seq = with_introns(dna(4000, 6), [(1000, 1600)])
    tiles, width = tiles_of(spark, seq, 512)
    tail = seq[1600:1620]
    rows = [
        (1, "chr1", 950, "50M20S", seq[950:1000] + tail),
        (2, "chr1", 950, "53M17S", seq[950:1000] + tail),  # ran over
        (3, "chr1", 950, "46M24S", seq[950:1000] + tail),  # stopped short
        (4, "chr1", 950, "50M6S", seq[950:1000] + tail[:6]),  # too short
        (5, "chr1", 950, "50M20S", seq[950:1000] + "A" * 20),  # of one letter
        (6, "chr1", 950, "50M20S", seq[950:1000] + tail[:9] + "".join("ACGT"[("ACGT".index(x) + 1) % 4] for x in tail[9:])),  # differs by more than a fifth
        (7, "chr1", 950, "70M", seq[950:1020]), (8, None, -1, "*", "ACGT"),
    ]
    got = told(splits.split_tails(records(spark, rows), tiles, width))
    assert {k: got.get(k) for k in (1, 2, 3)} == {k: (950, "50M600N20M") for k in (1, 2, 3)}
    assert not {4, 5, 6, 7, 8} & set(got)


def test_no_side_that_grows_with_the_reads_is_broadcast(spark, sf, monkeypatch):
    plans, write = [], splits.written

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(splits, "written", lambda df, path: plans.append(plan(df)) or write(df, path))
    plans.append(plan(planned.split_rescued(spark, sf)))
    joins = re.findall(r"(\w+Join) \[([^\]]*)\]", "\n".join(plans))
    assert any("motif#" in on for _, on in joins)
    assert {how for how, on in joins if re.search(r"\b(id|ord|inner|out|motif|hi)#", on)} == {"SortMergeJoin"}


def test_short_exons_and_run_through_are_planted(spark, sf):
    r, library = planned.planted_exons(spark, sf)
    truth = {}
    for x in r.collect():
        truth[x["ord"]] = x["at_end"]
    got = planned.short_exons_rescued(spark, sf).collect()
    assert len(got) >= 0.98 * len(truth) and all(x["cigar"].count("N") == 2 for x in got)
    through = planned.run_through_rescued(spark, sf).collect()
    n, _ = planned.planted_overhangs(spark, sf)
    assert 0.6 * n.count() <= len(through)  # of one or two bases many fit as they stand


def brute_chain(read, seq, diagonals):
    s, n, best = k.substitution("both"), len(read), None
    x, y = k.codes(read), k.codes(seq)
    for cuts in itertools.combinations(range(1, n), len(diagonals) - 1):
        ends, score, wrong = [0, *cuts, n], 0, 0
        for d, a, b in zip(diagonals, ends, ends[1:]):
            bad = int((s[x[a:b], y[d + a : d + b]] != k.MATCH).sum())
            wrong, score = wrong + bad, score - 6 * bad
        for d, e, c in zip(diagonals, diagonals[1:], cuts):
            score += k.SIGNALS.get((seq[d + c : d + c + 2], seq[e + c - 2 : e + c]), (-8, False))[0]
        if best is None or score > best[3]:
            best = (list(cuts), wrong, None, score)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_chain_against_brute_force(seed):
    r = random.Random(seed)
    seq = dna(300, 40 + seed)
    for n in (2, 3):
        starts = sorted(r.sample(range(10, 250), n))
        read = "".join(seq[d + i] if r.random() < 0.9 else r.choice("ACGT") for i, d in enumerate(sorted(r.choice(starts) for _ in range(24))))
        cuts, wrong, _, score = k.splice_chain(read, [(0, seq)] * n, starts)
        want = brute_chain(read, seq, starts)
        assert score == want[3]
        ends = [0, *cuts, len(read)]
        s = k.substitution("both")
        assert wrong == sum(int((s[k.codes(read[a:b]), k.codes(seq[d + a : d + b])] != k.MATCH).sum()) for d, a, b in zip(starts, ends, ends[1:]))


def test_chain_outside_of_its_windows():
    seq = dna(200, 3)
    assert k.splice_chain(seq[10:40], [(0, seq[:20]), (150, seq[150:160])], [10, 100])[0] == []


@pytest.mark.parametrize("introns", [1, 2, 3])
def test_reads_over_several_introns_are_mapped(spark, introns):
    r = random.Random(introns)
    seq, rows, want, at, gaps = dna(60_000, 9), [], {}, 300, []
    for i in range(40):
        sizes = [r.randrange(34, 50) for _ in range(introns + 1)]
        pos, ops, exons = at, [], []
        for j, size in enumerate(sizes):
            exons.append((at, at + size))
            ops.append(f"{size}M")
            at += size
            if j < introns:
                gap = r.randrange(80, 260)
                gaps.append((at, at + gap))
                ops.append(f"{gap}N")
                at += gap
        want[i] = (pos, "".join(ops), exons)
        at += 60
    seq = with_introns(seq, gaps)
    for i, (_, _, exons) in want.items():
        read = "".join(seq[a:b] for a, b in exons)
        rows.append((i, f"r{i}", read, "I" * len(read)))
    tiles, width = tiles_of(spark, seq, 1024)
    out = mapper.align(spark.createDataFrame(rows, "ord long, name string, seq string, qual string"), tiles, width, kmer=13, w=7)
    got = told(out.filter("chrom is not null").select("ord", "pos", "cigar"))
    right = sum(got.get(i) == want[i][:2] for i in want)
    assert right >= 36


def test_run_through_fetches_texts_of_blocks_and_introns_not_of_their_pairs(spark, monkeypatch):
    seq = dna(3000, 21)
    tiles, width = tiles_of(spark, seq, 512)
    introns = [(1000 + i % 20, 1500 + 40 * (i // 20)) for i in range(400)]
    library = spark.createDataFrame([("chr1", a, b, False, 1) for a, b in introns], "chrom string, start long, end long, minus boolean, support long")
    reads = [(i, "chr1", 960, f"{50 + i % 10}M", seq[960:1004] + seq[1500 + 40 * (i % 20) : 1506 + 40 * (i % 20) + i % 10]) for i in range(60)]
    asked, fetch = [], splits.tile_sequences
    monkeypatch.setattr(splits, "tile_sequences", lambda w, *a: asked.append(w.count()) or fetch(w, *a))
    got = told(splits.run_through(records(spark, reads), library, tiles, width))
    assert sum(asked) <= 60 + 20
    differ = lambda x, y: sum(p != q and (p, q) not in {("G", "A"), ("C", "T")} for p, q in zip(x, y))
    for i, _, pos, _, read in reads:
        edge, fits = pos + len(read), []
        for a, b in introns:
            n = edge - a
            wrong = differ(read[-n:], seq[b : b + n])
            if 0 < n < len(read) and wrong < differ(read[-n:], seq[a:edge]) and wrong <= n // 5:
                fits.append((wrong, b - a, a, b))
        _, size, a, _ = min(fits)
        assert got[i] == (pos, f"{a - pos}M{size}N{edge - a}M")
