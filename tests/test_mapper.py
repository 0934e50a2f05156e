"""Second seed round, pairs, the second pass over known junctions, and rescue on the minus strand."""

import random

from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.functions import dna as bases
from helixframe.operators.align import mapper
from helixframe.operators.align import second_look as sl

READS = "ord long, name string, seq string, qual string"


def dna(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("ACGT") for _ in range(n))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def tiles_of(spark, seq, width=400):
    return spark.createDataFrame([("chr1", i, seq[i : i + width]) for i in range(0, len(seq), width)], "chrom string, start long, seq string"), width


def test_repeats_are_placed_in_the_second_round(spark):
    unit = dna(300, 1)
    tiles, width = tiles_of(spark, "".join(dna(200, 10 + i) + unit for i in range(6)))
    reads = spark.createDataFrame([(0, "r", unit[100:200], "I" * 100), (1, "u", dna(200, 13)[50:150], "I" * 100)], READS)
    got = {r["ord"]: r for r in mapper.align(reads, tiles, width, kmer=11, w=5, cutoff=2).collect()}
    assert got[0]["pos"] in {500 * i + 300 for i in range(6)} and got[0]["mapq"] < 20
    assert got[1]["pos"] == 1550 and got[1]["mapq"] >= 20


def test_hash_collisions_keep_sequences_apart(spark):
    seqs = mapper.distinct_sequences(spark.createDataFrame([("ACGT",), ("ACGT",), ("TTTT",), ("",), (None,)], "seq string")).collect()
    assert sorted(r["seq"] for r in seqs) == ["ACGT", "TTTT"] and len({r["seq_id"] for r in seqs}) == 2


def test_pair_records(spark):
    rows = [
        (0, "a", 0, "chr1", 100, "50M", 0, 1), (1, "a", 16, "chr1", 250, "50M", 0, 2),  # proper
        (2, "b", 16, "chr1", 100, "50M", 1, 1), (3, "b", 4, None, -1, "", 1, 2),  # the mate isn't placed
        (4, "c", 0, "chr1", 100, "50M", 2, 1), (5, "c", 0, "chr1", 200, "50M", 2, 2),  # same strand
        (6, "d", 16, "chr1", 7, "50M", 3, 1),  # alone
    ]
    t = spark.createDataFrame(rows, "ord long, qname string, flag int, chrom string, pos long, c string, template long, slot int").withColumn("mapq", F.lit(60)).withColumn("cigar", cg.parse(F.col("c")))
    got = {r["ord"]: (r["flag"], r["mate_pos"], r["tlen"]) for r in mapper.pair_records(t).collect()}
    assert got[0] == (1 + 2 + 32 + 64, 250, 200) and got[1] == (1 + 2 + 16 + 128, 100, -200)
    assert got[2] == (1 + 8 + 16 + 64, -1, 0) and got[3] == (1 + 4 + 32 + 128, 100, 0)
    assert got[4] == (1 + 64, 200, 0) and got[5] == (1 + 128, 100, 0)
    assert got[6] == (16, -1, 0)


def test_clipped_starts(spark):
    seq = dna(3000, 22)
    tiles, width = tiles_of(spark, seq)
    lib = spark.createDataFrame([("chr1", 1050, 1250), ("chr1", 300, 1245)], "chrom string, start long, end long")
    read = seq[1000:1050] + seq[1250:1300]
    # the aligner ran 3 bases before the intron's end by chance, or stopped 2 behind it
    rows = [(i, "chr1", 1250 - d, f"{50 - d}S{50 + d}M", read) for i, d in enumerate((0, 3, -2))] + [(9, "chr1", 1250, "50S50M", dna(50, 5) + seq[1250:1300])]
    rec = spark.createDataFrame(rows, "ord long, chrom string, pos long, c string, seq string").withColumn("cigar", cg.parse(F.col("c")))
    got = {r["ord"]: (r["pos"], r["t"]) for r in sl.clipped_tails(rec, lib, tiles, width, side="start").select("ord", "pos", cg.text(F.col("cigar")).alias("t")).collect()}
    assert got == {i: (1000, "50M200N50M") for i in range(3)}


def test_second_pass_uses_known_junctions(spark):
    seq = dna(3000, 31)
    tiles, width = tiles_of(spark, seq)
    lib = spark.createDataFrame([("chr1", 1085, 1300, False, 1), ("chr1", 2050, 2060, False, 1)], "chrom string, start long, end long, minus boolean, support long")
    short, deleted, plain = seq[1000:1085] + seq[1300:1315], seq[2000:2050] + seq[2060:2110], seq[200:300]
    reads = spark.createDataFrame([(i, f"r{i}", s, "I" * 100) for i, s in enumerate((short, deleted, plain))], READS)
    records, library = mapper.two_pass(reads, tiles, width, lib, kmer=11, w=5)
    got = {r["ord"]: (r["pos"], r["t"], r["nm"]) for r in records.select("ord", "pos", "nm", cg.text(F.col("cigar")).alias("t")).collect()}
    assert got == {0: (1000, "85M215N15M", 0), 1: (2000, "50M10N50M", 0), 2: (200, "100M", 0)}
    assert library.count() == 2


def test_rescue_on_the_minus_strand(spark):
    seq = dna(3000, 41)
    tiles, width = tiles_of(spark, seq)
    r = random.Random(3)
    edited = "".join("G" if c == "A" and r.random() < 0.7 else c for c in rc(seq[1500:1600]))
    df = spark.createDataFrame([(0, "h", edited, "I" * 100), (1, "x", dna(100, 77), "I" * 100)], READS)
    got = mapper.rescue(df, tiles, width, kmer=11, w=5).collect()
    assert [(x["ord"], x["chrom"], x["pos"], x["minus"], x["direction"]) for x in got] == [(0, "chr1", 1500, True, "A")]
    records = mapper.to_records(mapper.align(df, tiles, width, kmer=11, w=5))
    merged = {x["ord"]: x for x in mapper.rescue_records(records, tiles, width, kmer=11, w=5).collect()}
    assert merged[0]["flag"] == 16 and merged[0]["re"] == "collapsed" and merged[0]["edits_tc"] > 10 and merged[0]["seq"] == rc(edited)
    assert merged[1]["flag"] == 4 and merged[1]["re"] is None


def test_poor_reads_are_found_around_their_mates(spark):
    seq = dna(3000, 46)
    tiles, width = tiles_of(spark, seq)
    r = random.Random(8)
    # a base in seven differs: no seed of eleven is left
    broken = "".join(c if i % 7 else "ACGT"[("ACGT".index(c) + 1) % 4] for i, c in enumerate(seq[1400:1500]))
    rows = [(0, "p", seq[1200:1300], "I" * 100), (1, "p", rc(broken), "I" * 100), (2, "q", seq[500:600], "I" * 100), (3, "q", "".join(r.choice("ACGT") for _ in range(100)), "I" * 100), (4, "s", rc(seq[2000:2100]), "I" * 100), (5, "s", seq[1900:2000], "I" * 100)]
    records = mapper.to_records(mapper.align(spark.createDataFrame(rows, READS), tiles, width, kmer=11, w=5)).withColumns({"template": F.floor(F.col("ord") / 2), "slot": F.pmod("ord", F.lit(2)).cast("int") + 1})
    before = {x["ord"]: x for x in records.collect()}
    assert before[1]["flag"] == before[3]["flag"] == 4
    out = mapper.with_mates(records, tiles, width)
    assert out.columns == records.columns
    got = {x["ord"]: x for x in out.collect()}
    assert (got[1]["flag"], got[1]["chrom"], got[1]["margin"]) == (16, "chr1", "mate") and abs(got[1]["pos"] - 1400) <= 7 and 0 < got[1]["mapq"] <= 20
    assert got[1]["seq"] == broken and got[1]["mismatches"] + got[1]["edits_ag"] + got[1]["edits_tc"] >= 12
    assert all(got[i] == before[i] for i in (0, 2, 4, 5)) and len(got) == 6
    assert got[3]["mapq"] <= 20


def test_a_rescued_mate_is_known_to_the_other(spark):
    seq = dna(3000, 43)
    tiles, width = tiles_of(spark, seq)
    r = random.Random(5)
    edited = "".join("G" if c == "A" and r.random() < 0.7 else c for c in rc(seq[1400:1500]))
    rows = [(0, "p", seq[1250:1350], "I" * 100), (1, "p", edited, "I" * 100), (2, "o", seq[200:300], "I" * 100), (3, "o", rc(seq[350:450]), "I" * 100)]
    records = mapper.to_records(mapper.align(spark.createDataFrame(rows, READS), tiles, width, kmer=11, w=5))
    paired = mapper.pair_records(records.withColumns({"template": F.floor(F.col("ord") / 2), "slot": F.pmod("ord", F.lit(2)).cast("int") + 1}))
    before = {x["ord"]: x for x in paired.collect()}
    assert before[0]["flag"] & 8 and before[1]["flag"] & 4
    got = {x["ord"]: x for x in mapper.rescue_records(paired, tiles, width, paired=True, kmer=11, w=5).collect()}
    assert got[0]["flag"] == 1 + 2 + 32 + 64 and got[1]["flag"] == 1 + 2 + 16 + 128
    assert (got[0]["mate_pos"], got[1]["mate_pos"], got[0]["tlen"], got[1]["tlen"]) == (1400, 1250, 250, -250)
    assert got[1]["re"] == "collapsed" and all(got[i]["flag"] == before[i]["flag"] and got[i]["tlen"] == before[i]["tlen"] for i in (2, 3))


def test_indexes_of_rescue_are_made_once(spark, monkeypatch):
    from helixframe.operators import kmer_index

    made, real = [], kmer_index.minimizer_index
    monkeypatch.setattr(kmer_index, "minimizer_index", lambda *a, **b: made.append(1) or real(*a, **b))
    tiles, width = tiles_of(spark, dna(1500, 44))
    mapper.rescue(spark.createDataFrame([(0, "x", dna(100, 7), "I" * 100)], READS), tiles, width, kmer=11, w=5)
    assert len(made) == 2


def test_bases_of_wide_tiles(spark):
    from helixframe.operators import pileup

    seq = dna(5000, 45)
    places = spark.createDataFrame([("chr1", p) for p in (0, 1, 511, 512, 1023, 4096, 4999, 5000, 7000)], "chrom string, pos long")
    for width in (5000, 700, 512, 64):
        tiles, _ = tiles_of(spark, seq, width)
        got = {r["pos"]: r["base"] for r in pileup.bases_at(places, tiles, width).collect()}
        assert got == {p: seq[p] for p in (0, 1, 511, 512, 1023, 4096, 4999)}


def test_standard_code_where_the_surveyed_table_differs():
    at = {a + b + c: bases.AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
    assert at["CGA"] == at["CGG"] == "R"


def test_equal_reads_are_rescued_once(spark, monkeypatch):
    seq = dna(3000, 41)
    tiles, width = tiles_of(spark, seq)
    r = random.Random(3)
    edited = "".join("G" if c == "A" and r.random() < 0.7 else c for c in rc(seq[1500:1600]))
    seen, real = [], mapper.align
    monkeypatch.setattr(mapper, "align", lambda reads, *a, **b: seen.append(reads.count()) or real(reads, *a, **b))
    df = spark.createDataFrame([(i, f"h{i}", edited, "I" * 100) for i in range(5)] + [(5, "low", edited, "#" * 100)], READS)
    got = mapper.rescue(df, tiles, width, kmer=11, w=5).collect()
    assert sorted((x["ord"], x["pos"], x["minus"], x["direction"]) for x in got) == [(i, 1500, True, "A") for i in range(5)]
    assert set(seen) == {1}


def test_pairs_of_the_query_are_judged_without_bases(spark, sf, monkeypatch):
    from helixframe.plans import alignment

    seen, real = [], mapper.pair_records
    monkeypatch.setattr(mapper, "pair_records", lambda r, *a: seen.append(r.columns) or real(r, *a))
    alignment.mapped_pairs(spark, sf)
    assert not {"seq", "qual"} & set(seen[0])


def test_equal_sequences_pass_both_passes_once(spark, monkeypatch):
    seq = dna(3000, 31)
    tiles, width = tiles_of(spark, seq)
    lib = spark.createDataFrame([("chr1", 1085, 1300, False, 1)], "chrom string, start long, end long, minus boolean, support long")
    spliced, back = seq[1000:1085] + seq[1300:1315], rc(seq[200:300])
    qual = ["".join(chr(40 + (i + j) % 30) for j in range(100)) for i in range(9)]
    rows = [(i, f"r{i}", (spliced, back)[i % 2], qual[i]) for i in range(8)] + [(8, "e", "", "")]
    seen, real = [], mapper.align
    monkeypatch.setattr(mapper, "align", lambda reads, *a, **b: seen.append(reads.count()) or real(reads, *a, **b))
    records, library = mapper.two_pass(spark.createDataFrame(rows, READS), tiles, width, lib, kmer=11, w=5)
    assert seen == [2] and records.columns == mapper.RECORD == mapper.to_records(real(spark.createDataFrame(rows, READS), tiles, width, kmer=11, w=5)).columns
    got = {r["ord"]: r for r in records.withColumn("t", cg.text(F.col("cigar"))).collect()}
    phred = [[ord(c) - 33 for c in q] for q in qual]
    for i in range(8):
        want = (0, 1000, "85M215N15M", spliced, phred[i]) if i % 2 == 0 else (16, 200, "100M", rc(back), phred[i][::-1])
        assert tuple(got[i][c] for c in ("flag", "pos", "t", "seq", "qual")) == want and got[i]["qname"] == f"r{i}"
    assert (got[8]["flag"], got[8]["chrom"], got[8]["pos"], got[8]["t"], got[8]["qual"]) == (4, None, -1, "*", [])
    assert [r["support"] for r in library.collect()] == [5]  # the annotation's and four reads'
