"""Gates, mate windows, clipped tails, transcript candidates, guards and SQL functions."""

import random
import re

import pytest
from pyspark.sql import functions as F
from test_align import dna

from helixframe import api
from helixframe.functions import cigar as cg
from helixframe.operators import evidence, kmer_index
from helixframe.operators.align import kernels as k
from helixframe.operators.align import second_look as sl


def test_gates_in_order():
    r = random.Random(1)
    ref = dna(100, 3)
    edited = list(ref)
    for i, c in enumerate(ref):
        if c == "A" and 20 < i < 80 and r.random() < 0.8:
            edited[i] = "G"
    read, q = "".join(edited), [40] * 100
    why, places = sl.gate(read, q, [("M", 100)], ref, "A", "G")
    assert why is None and places == [i for i in range(100) if read[i] != ref[i]]
    assert sl.gate(read, q[:5], [("M", 100)], ref, "A", "G")[0] == "malformed_read"
    assert sl.gate(read, q, [("M", 50), ("I", 1), ("M", 49)], ref, "A", "G")[0] == "gapped"
    assert sl.gate(read, q, [("M", 100)], ref[:50], "A", "G")[0] == "off_contig"
    assert sl.gate(read, q, [("M", 120)], ref + ref, "A", "G")[0] == "cigar_overrun"
    assert sl.gate(read, q, [("M", 100)], ref, "T", "C")[0] == "non_edit_mm"
    assert sl.gate(ref, q, [("M", 100)], ref, "A", "G")[0] == "no_edits"
    assert sl.gate(read, [10] * 100, [("M", 100)], ref, "A", "G")[0] == "no_edits"
    a = "C" * 20 + "A" * 8 + "CT" * 36
    g = "C" * 20 + "G" * 8 + "CT" * 36
    assert sl.gate(g, q, [("M", 100)], a, "A", "G")[0] == "cluster_span"


def test_best_segment():
    assert sl.best_segment("ACGT", "ACGT") == (0, 4, 8)
    assert sl.best_segment("TTTACGTACGT", "GGGACGTACGT") == (3, 11, 16)
    assert sl.best_segment("GGGG", "AAAA") == (0, 4, 8)  # edits are free
    assert sl.best_segment("CCCC", "AAAA") == (0, 0, 0)


def _tiles(spark, seq, width=300):
    return spark.createDataFrame([("chr1", i, seq[i : i + width]) for i in range(0, len(seq), width)], "chrom string, start long, seq string"), width


def test_mate_window(spark):
    seq = dna(3000, 21)
    tiles, width = _tiles(spark, seq)
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(0, seq[1500:1580].replace("A", "G", 9), "chr1", 1200), (1, rc(seq[900:980]), "chr1", 1200), (2, dna(80, 77), "chr1", 1200)]
    got = {r["ord"]: r for r in sl.mate_window(spark.createDataFrame(rows, "ord long, seq string, mate_chrom string, mate_pos long"), tiles, width).collect()}
    assert (got[0]["pos"], got[0]["minus"], got[0]["distance"]) == (1500, False, 0)
    assert (got[1]["pos"], got[1]["minus"], got[1]["distance"]) == (900, True, 0)
    assert 2 not in got


def test_clipped_tails(spark):
    seq = dna(3000, 22)
    tiles, width = _tiles(spark, seq)
    lib = spark.createDataFrame([("chr1", 1050, 1250), ("chr1", 1055, 2000)], "chrom string, start long, end long")
    read = seq[1000:1050] + seq[1250:1300]
    # the aligner ran 3 bases beyond the intron's start by chance, or stopped 2 before it
    rows = [(i, "chr1", 1000, f"{50 + d}M{50 - d}S", read) for i, d in enumerate((0, 3, -2))] + [(9, "chr1", 1000, "50M50S", seq[1000:1050] + dna(50, 5))]
    rec = spark.createDataFrame(rows, "ord long, chrom string, pos long, c string, seq string").withColumn("cigar", cg.parse(F.col("c")))
    got = {r["ord"]: r["t"] for r in sl.clipped_tails(rec, lib, tiles, width).select("ord", cg.text(F.col("cigar")).alias("t")).collect()}
    assert got == {0: "50M200N50M", 1: "50M200N50M", 2: "50M200N50M"}


def test_transcript_candidates(spark):
    seq = dna(3000, 23)
    tiles, width = _tiles(spark, seq)
    tx = spark.createDataFrame([("p", "chr1", False, [(100, 200), (500, 650)]), ("m", "chr1", True, [(2000, 2100), (1500, 1600)])], "name string, chrom string, minus boolean, exons array<struct<s:long,e:long>>")
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([(0, seq[160:200] + seq[500:540]), (1, rc(seq[1560:1600] + seq[2000:2040])), (2, dna(80, 55))], "read long, seq string")
    got = {r["read"]: (r["name"], r["pos"], r["t"], r["minus"]) for r in sl.transcript_candidates(reads, tx, tiles, width).withColumn("t", cg.text(F.col("cigar"))).collect()}
    assert got == {0: ("p", 160, "40M300N40M", False), 1: ("m", 1560, "40M400N40M", True)}


def test_guards(spark):
    c = lambda n: spark.createDataFrame([("chr1", n)], "name string, len long")
    evidence.check_species(c(248_956_422))
    evidence.check_species(c(5_000))
    with pytest.raises(ValueError, match="chr1"):
        evidence.check_species(c(195_471_971))
    tx = spark.createDataFrame([("chr1",), ("1",), ("1",)], "chrom string")
    with pytest.raises(ValueError, match="contigs like 1"):
        evidence.check_contigs(tx, c(5))
    assert evidence.check_contigs(tx.filter("chrom = 'chr1'"), c(5)) == 0


def test_sql_functions(spark):
    api.register(spark)
    row = spark.sql("SELECT hx_quality_keep('IIII&&&&') AS q, hx_poly_g_keep('ACGTACGTACGGGGGGGGGGGGGGGGGGGG') AS g, hx_edit_distance('GGG', 'TAAAT') AS d, hx_fixed(0.0615D) AS f, hx_shortest(1.0E-5D) AS s, size(hx_minimizers(repeat('ACGTTGCA', 10))) AS m").first()
    assert (row["q"], row["g"], row["d"], row["f"], row["s"]) == (4, 8, 0, "0.061", "0.00001") and row["m"] > 0


def test_index_table_is_bucketed(spark):
    tiles, width = _tiles(spark, dna(900, 4))
    api.build_index(tiles, width, "mini_index", k=11, w=5, buckets=4)
    reads = spark.createDataFrame([(0, dna(900, 4)[100:200])], "read long, seq string")
    from helixframe.operators import kmer_index

    a = kmer_index.anchors(reads, spark.table("mini_index").hint("merge"), 11, 5)
    assert all(r["rpos"] - r["qpos"] == 100 for r in a.collect()) and a.count() > 3


def test_placement_scores_follow_the_rules():
    p = k.Placement("c", False, 0, [("M", 40), ("I", 2), ("M", 38)], mismatches=3, edits_ag=2, edits_tc=1)
    assert k.unexplained(p) == 6 and p.columns() == (80, 78)
    p.mismatches = 1
    assert k.unexplained(p) == 2


def test_edit_distances_of_many_equal_those_of_one():
    r = random.Random(11)
    some = lambda n: "".join(r.choice("ACGTacgN") for _ in range(n))
    for longest in (50, 64, 65, 200):
        reads = [some(r.randrange(longest + 1)) for _ in range(60)] + [some(longest)]
        refs = [some(r.randrange(90)) + x[: r.randrange(len(x) + 1)] + some(r.randrange(3)) + x[len(x) // 2 :] + some(r.randrange(90)) for x in reads]
        for direction in ("", "A", "both"):
            d, end = k.edit_infixes(reads, refs, direction)
            assert list(zip(d.tolist(), end.tolist())) == [k.edit_infix(x, y, direction) for x, y in zip(reads, refs)]
    assert [x.tolist() for x in k.edit_infixes([], [])] == [[], []]


def test_mate_windows_are_fetched_once_and_looked_at_together(spark, monkeypatch):
    r = random.Random(12)
    seq = "".join(r.choice("ACGT") for _ in range(6000))
    tiles = spark.createDataFrame([("chr1", i, seq[i : i + 500]) for i in range(0, 6000, 500)], "chrom string, start long, seq string")
    rows = [(i, seq[3000 + 7 * (i % 20) : 3060 + 7 * (i % 20)], "chr1", 2700) for i in range(200)]
    rows += [(200, "A" * 60, "chr1", 2700), (201, seq[3100:3160], "chr1", 5900), (202, "ACGT" * 70, "chr1", 2700)]
    asked, fetch = [], sl.tile_sequences
    monkeypatch.setattr(sl, "tile_sequences", lambda w, *a: asked.append(w.count()) or fetch(w, *a))
    got = {x["ord"]: (x["pos"], x["minus"], x["distance"]) for x in sl.mate_window(spark.createDataFrame(rows, "ord long, seq string, mate_chrom string, mate_pos long"), tiles, 500).collect()}
    assert asked == [2]  # not a window a read
    assert all(got[i] == (3000 + 7 * (i % 20), False, 0) for i in range(200))
    assert 202 not in got and got.get(201, (0, False, 1))[2] > 0


def test_equal_reads_are_placed_on_transcripts_once(spark, monkeypatch):
    r = random.Random(13)
    seq = "".join(r.choice("ACGT") for _ in range(3000))
    tiles = spark.createDataFrame([("chr1", i, seq[i : i + 500]) for i in range(0, 3000, 500)], "chrom string, start long, seq string")
    tx = spark.createDataFrame([("t1", "chr1", False, [(500, 700), (900, 1200)])], "name string, chrom string, minus boolean, exons array<struct<s:long,e:long>>")
    reads = spark.createDataFrame([(i, seq[660:700] + seq[900:940]) for i in range(50)] + [(50, "ACGT" * 20), (51, ""), (52, None)], "read long, seq string")
    seen, hits = [], kmer_index.transcript_hits
    monkeypatch.setattr(kmer_index, "transcript_hits", lambda r, *a: seen.append(r.count()) or hits(r, *a))
    got = sl.transcript_candidates(reads, tx, tiles, 500, kmer=13).collect()
    assert seen == [2]
    assert sorted(x["read"] for x in got) == list(range(50)) and {(x["pos"], x["distance"]) for x in got} == {(660, 0)}


def test_spans_of_anchors_need_no_row_an_anchor(spark):
    r = random.Random(14)
    unit = "".join(r.choice("ACGT") for _ in range(60))
    seq = unit * 20 + "".join(r.choice("ACGT") for _ in range(800))
    tiles = spark.createDataFrame([("chr1", i, seq[i : i + 500]) for i in range(0, 2000, 500)], "chrom string, start long, seq string")
    index = kmer_index.minimizer_index(tiles, 500, 11, 5)
    reads = spark.createDataFrame([(0, seq[100:180]), (1, seq[1500:1580]), (2, seq[100:180][::-1].translate(str.maketrans("ACGT", "TGCA"))), (3, unit * 3), (4, "")], "read long, seq string")
    a = kmer_index.anchors(reads, index, 11, 5)
    want = a.groupBy("read", "chrom", "minus").agg(F.count("*").alias("n"), F.min("rpos").alias("first"), F.max("rpos").alias("last"))
    got = kmer_index.anchor_spans(reads, index, 11, 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() < a.count() / 10


def test_frequent_kmers_of_transcripts_are_not_shuffled(spark):
    """Only k-mers that are rare in the transcripts and occur in reads reach the join; what transcripts hold else stays where it is."""
    r = random.Random(5)
    often, rare = ("".join(r.choice("ACGT") for _ in range(40)) for _ in range(2))
    tx = spark.createDataFrame([(f"t{i}", often) for i in range(30)] + [("one", often + rare)], "name string, seq string")
    hits = kmer_index.transcript_hits(spark.createDataFrame([(1, often + rare)], "read long, seq string"), tx, 13, most=20)
    # of the one transcript's k-mers those that reach beyond the frequent ones
    assert [tuple(x) for x in hits.collect()] == [(1, "one", False, 0, 40)]
    plan = hits._jdf.queryExecution().toString()
    assert re.search(r"BroadcastHashJoin \[kmer#\d+L?\], \[kmer#\d+L?\], LeftSemi", plan) and not re.search("SortMergeJoin.*LeftSemi", plan)
