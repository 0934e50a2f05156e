"""Clipped and run-through ends of reads over introns: found anew by splice signals and seeds, over two known introns, or over one that the read ran through.

All is told outward from the body's aligned end, so both ends of a read are one case: at the end of a
record outward texts run to the right, at its start they are reversed.

A new intron is found without a library. Every place of the reference that a splice signal
ends at is a row with the bases behind it; a read's possible cuts, within REACH bases of its
aligned end, meet them by an equi-join on (contig, bin, signal, bases). Longer tails are seeded by minimizers too.
Cuts are many times the clipped ends that they come from, which Spark's estimates don't know, so no side that grows with the reads is broadcast.
Both give diagonals; on each the best cut is taken by differences on both sides and by the signal,
and then the best diagonal. Texts of one place that several reads share are looked at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.operators import kmer_index
from helixframe.operators.align import exon_batches
from helixframe.operators.align import kernels as k
from helixframe.operators.rangejoin import points_in_intervals
from helixframe.operators.transcripts import tile_sequences
from helixframe.session import shared_path, written

# Fixed values of the search.
LEAST_TAIL = 7
REACH = 12
PROBE = 7
SPAN = 50_000
SHORTEST, LONGEST = 20, 500_000
SEED_PLACES = 100
#: Cost of a difference where a signal counts 1 to 4.
DIFFERENCE = 6
KEY = ["chrom", "edge", "inner", "out"]
#: Clipped ends of a task, at most, where their cuts are made.
TASK_ENDS = 250_000


def _pairs(side: str) -> dict[tuple[str, str], tuple[int, bool]]:
    """Splice signals as outward pairs: the two bases behind the body, and the two before the tail; score, and whether the intron is on the minus strand."""
    return k.SIGNALS if side == "end" else {(y[::-1], x[::-1]): v for (x, y), v in k.SIGNALS.items()}


def letters(text: Column) -> Column:
    return F.split(F.upper(text), "")


def differences(read: Column, ref: Column) -> Column:
    """Places where two texts of one length differ; edits (A read as G, T as C) are none."""
    return _differ(letters(read), letters(ref))


def _differ(read: Column, ref: Column) -> Column:
    same = F.zip_with(read, ref, lambda x, y: (x == y) | ((y == "A") & (x == "G")) | ((y == "T") & (x == "C")))
    return F.size(F.filter(same, lambda ok: ~ok))


def _from(text: Column | str, start: Column, n: Column | int | None = None) -> Column:
    """n characters (or all) of the text from start, counted from 0."""
    n = F.length(text) if n is None else F.lit(n) if isinstance(n, int) else n
    return F.substring(text, start + 1, n)


def _ends(records: DataFrame, side: str, least: int) -> DataFrame:
    """Records whose clipped end has ``least`` bases or more: ord, chrom, pos, cigar, edge, inner, tail, block, out (outward from ``inner`` bases before the edge)."""
    at_end = side == "end"
    clip, block = (F.try_element_at("cigar", F.lit(i if at_end else -i)) for i in (-1, -2))
    r = records.filter((F.size("cigar") >= 2) & (clip["op"] == "S") & (clip["n"] >= least) & (block["op"] == "M"))
    edge = cg.ref_end(F.col("pos"), F.col("cigar")) if at_end else F.col("pos")
    inner = F.least(F.lit(REACH), block["n"] - 1)
    out = F.right("seq", clip["n"] + inner) if at_end else F.reverse(F.left("seq", clip["n"] + inner))
    return r.select("ord", "chrom", "pos", "cigar", edge.cast("long").alias("edge"), inner.cast("int").alias("inner"), clip["n"].alias("tail"), block["n"].alias("block"), out.alias("out"))


def _texts(rows: DataFrame, key: list[str], name: str, start: Column, end: Column, tiles: DataFrame, width: int, side: str) -> DataFrame:
    """rows with the outward text of [start, end) of the reference, which may stand over the contig's ends."""
    w = rows.select(*key, F.greatest(start, F.lit(0)).alias("s"), end.alias("e")).distinct().filter("e > s")
    got = tile_sequences(w, tiles, width, key)
    # both sides grow with the reads
    return rows.join(got.select(*key, (F.col("seq") if side == "end" else F.reverse("seq")).alias(name)).hint("merge"), key)


def _near(probes: DataFrame, tiles: DataFrame, width: int, side: str) -> DataFrame:
    """probes with ``near``: the reference outward from ``inner`` bases before the edge to REACH and a signal behind it."""
    at_end = side == "end"
    start = F.col("edge") - (F.col("inner") if at_end else REACH + 2)
    end = F.col("edge") + (REACH + 2 if at_end else F.col("inner"))
    return _texts(probes, ["chrom", "edge", "inner"], "near", start, end, tiles, width, side)


def splice_sites(tiles: DataFrame, width: int, side: str) -> DataFrame:
    """chrom, q, motif, key: where a tail may begin outward, the signal's two bases before it and PROBE bases of it as a number; none if one of them isn't ACGT."""
    at_end = side == "end"
    motifs = sorted({y for _, y in _pairs(side)})
    code = {x: k.codes(x)[0] * 4 + k.codes(x)[1] for x in motifs}
    weights = 4 ** np.arange(PROBE - 1, -1, -1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chrom, start, own, seq in zip(*(b.column(c).to_pylist() for c in ("chrom", "start", "own", "seq"))):
                c = k.codes(seq).astype(np.int64)
                n = min(len(c) - PROBE - 1, own)
                if n <= 0:
                    continue
                window = np.lib.stride_tricks.sliding_window_view(c, PROBE + 2)[:n]
                window = window if at_end else window[:, ::-1]
                signal = np.where((window < 4).all(axis=1), window[:, 0] * 4 + window[:, 1], -1)
                keys = window[:, 2:] @ weights
                for motif, x in code.items():
                    at = np.flatnonzero(signal == x)
                    q = start + at + (2 if at_end else PROBE)
                    yield pa.record_batch([pa.array([chrom] * len(at), pa.string()), pa.array(q.astype(np.int64)), pa.array([motif] * len(at), pa.string()), pa.array(keys[at])], names=["chrom", "q", "motif", "key"])

    t = kmer_index.overlapping(tiles, width, PROBE + 1).select("chrom", F.col("start").cast("long").alias("start"), F.col("own").cast("long").alias("own"), "seq")
    return t.mapInArrow(run, "chrom string, q long, motif string, key long")


def _cuts(near: DataFrame) -> DataFrame:
    """A row for each place (i, from 0 at ``inner`` bases before the edge) where out may be cut."""
    last = F.least(F.col("inner") + REACH, F.length("out") - PROBE, F.length("near") - 2)
    return near.withColumn("i", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))))


def by_signal(near: DataFrame, tiles: DataFrame, width: int, side: str) -> DataFrame:
    """id and g: diagonals (the reference place of the tail's first clipped base, or behind it at a start) where PROBE bases of some cut stand behind a fitting signal within SPAN."""
    at_end, sign = side == "end", 1 if side == "end" else -1
    follow: dict[str, list[str]] = {}
    for x, y in _pairs(side):
        follow.setdefault(x, []).append(y)
    fits = F.create_map(*[c for x, ys in follow.items() for c in (F.lit(x), F.array(*map(F.lit, ys)))])
    probe = F.upper(_from("out", F.col("i"), PROBE))
    cuts = _cuts(near).withColumn("probe", probe).filter(F.col("probe").rlike("^[ACGT]+$") & ~F.col("probe").rlike("^(.)\\1*$"))
    off = F.col("i") - F.col("inner")
    cuts = cuts.select("id", "chrom", off.alias("off"), (F.col("edge") + sign * off).alias("d"), F.explode(F.try_element_at(fits, F.upper(_from("near", F.col("i"), 2)))).alias("motif"), F.conv(F.translate("probe", "ACGT", "0123"), 4, 10).cast("long").alias("key"))
    first = F.floor(F.col("d") / SPAN) - (0 if at_end else 1)
    cuts = cuts.withColumn("bin", F.explode(F.sequence(first, first + 1)))
    sites = splice_sites(_around(near, tiles, width), width, side).withColumn("bin", F.floor(F.col("q") / SPAN))
    size = sign * (F.col("q") - F.col("d"))
    # taken for small, as their ends are, cuts would be broadcast
    found = cuts.hint("merge").join(sites, ["chrom", "bin", "motif", "key"]).filter((size >= SHORTEST) & (size <= SPAN))
    return found.select("id", (F.col("q") - sign * F.col("off")).alias("g")).distinct()


def _around(near: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """The tiles within SPAN of some edge, and the next ones: most of a genome has no clipped end near it."""
    block = max(SPAN, width)
    some = near.select("chrom", F.floor(F.col("edge") / block).alias("b")).distinct()
    some = some.select("chrom", F.explode(F.sequence(F.col("b") - 2, F.col("b") + 2)).alias("b")).distinct()
    return tiles.withColumn("b", F.floor(F.col("start") / block)).join(some, ["chrom", "b"], "left_semi").drop("b")


def by_seeds(near: DataFrame, index: DataFrame, kmer: int, w: int, side: str) -> DataFrame:
    """id and g, as by_signal(): diagonals of minimizers that the clipped bases share with the reference, up to LONGEST away."""
    at_end = side == "end"
    tail = _from("out", F.col("inner")) if at_end else F.reverse(_from("out", F.col("inner")))
    p = near.select(F.col("id").alias("read"), "chrom", "edge", tail.alias("seq")).filter(F.length("seq") >= kmer)
    a = kmer_index.anchors(p.select("read", "seq"), index, kmer, w, SEED_PLACES).filter("not minus")
    j = p.join(a.hint("merge"), ["read", "chrom"])
    g = F.col("rpos") - F.col("qpos") + (0 if at_end else F.length("seq"))
    size = (g - F.col("edge")) if at_end else F.col("edge") - g
    return j.filter((size >= SHORTEST) & (size <= LONGEST)).select(F.col("read").alias("id"), g.cast("long").alias("g")).distinct()


def _best_cut(cands: DataFrame, near: DataFrame, tiles: DataFrame, width: int, side: str, keep: str) -> DataFrame:
    """For each KEY the best cut of its diagonals: i, g, wrong, score, on_minus. Candidates with their ends are written below keep, and a window that several need is fetched once."""
    at_end = side == "end"
    pairs = _pairs(side)
    score = F.create_map(*[c for (x, y), (v, _) in pairs.items() for c in (F.lit(x + y), F.lit(v))])
    minus = F.create_map(*[c for (x, y), (_, m) in pairs.items() for c in (F.lit(x + y), F.lit(m))])
    tail = F.length("out") - F.col("inner")
    # outward from two bases before ``inner`` bases before the diagonal's place, to the read's end
    start, end = (F.col("g") - F.col("inner") - 2, F.col("g") + tail) if at_end else (F.col("g") - tail, F.col("g") + F.col("inner") + 2)
    rows = written(cands.join(near.hint("merge"), "id").withColumns({"lo": start, "hi": end}).drop("id"), f"{keep}/cands")
    each = _cuts(_texts(rows, ["chrom", "lo", "hi"], "far", F.col("lo"), F.col("hi"), tiles, width, side).filter(F.length("far") == F.length("out") + 2))
    pair = F.upper(F.concat(_from("near", F.col("i"), 2), _from("far", F.col("i"), 2)))
    each = each.withColumn("pair", pair).withColumn("signal", F.try_element_at(score, F.col("pair"))).filter("signal is not null")
    behind = differences(_from("out", F.col("i")), _from("far", F.col("i") + 2))
    each = each.withColumn("behind", behind).filter(F.col("behind") <= F.floor((F.length("out") - F.col("i")) / 5))
    wrong = F.col("behind") + differences(F.substring("out", F.lit(1), F.col("i")), F.substring("near", F.lit(1), F.col("i")))
    each = each.withColumn("wrong", wrong).withColumn("score", F.col("signal") - DIFFERENCE * F.col("wrong"))
    order = F.struct((-F.col("score")).alias("s"), F.abs(F.col("i") - F.col("inner")).alias("o"), F.abs(F.col("g") - F.col("edge")).alias("n"), "i", "g")
    value = F.struct("i", "g", "wrong", "score", F.try_element_at(minus, F.col("pair")).alias("on_minus"))
    return each.groupBy(*KEY).agg(F.min_by(value, order).alias("b")).select(*KEY, "b.*")


def split_tails(records: DataFrame, tiles: DataFrame, width: int, side: str = "end", index: DataFrame | None = None, kmer: int = 15, w: int = 10, least: int = LEAST_TAIL, keep: str | None = None) -> DataFrame:
    """records (ord, chrom, pos, cigar, seq on the reference's strand) whose clipped end goes on behind an intron that no library knows.

    The tail's first PROBE bases must stand exactly behind a splice signal within SPAN bases, of either strand, or (with an index) share a rare minimizer with the
    reference within LONGEST. Of all cuts within REACH bases of the aligned end, the one of best score is taken: the signal's less DIFFERENCE a
    difference on either side, then the nearest to the aligned end, the shorter intron, the inner cut, the smaller place. At most a fifth of the tail may differ.
    keep: a folder for the clipped ends and their candidates, which several joins read; by default a new one in the shared folder.
    Returns ord, pos, cigar, start, end, on_minus (the signal's strand), wrong, score.
    """
    at_end, sign = side == "end", 1 if side == "end" else -1
    keep = keep or shared_path(records.sparkSession, "tails")
    ends = written(_ends(records, side, least), f"{keep}/ends")
    # the ends' table is small beside their cuts: it is dealt to as many tasks as those need
    parts = max(records.sparkSession.sparkContext.defaultParallelism, -(-ends.count() // TASK_ENDS))
    near = _near(ends.select(*KEY).distinct(), tiles, width, side).repartition(parts, *KEY)
    near = written(near.withColumn("id", F.monotonically_increasing_id()), f"{keep}/near")
    cands = by_signal(near, tiles, width, side)
    if index is not None:
        cands = cands.unionByName(by_seeds(near, index, kmer, w, side)).distinct()
    j = ends.join(_best_cut(cands, near, tiles, width, side, keep).hint("merge"), KEY)
    off, size = F.col("i") - F.col("inner"), F.abs(F.col("g") - F.col("edge"))
    d, q = F.col("edge") + sign * off, F.col("g") + sign * off
    new = _stitched(F.col("cigar"), F.col("block") + off, [(size, F.col("tail") - off)], at_end)
    pos = F.col("pos") if at_end else F.col("g") - F.col("tail")
    return j.select("ord", pos.cast("long").alias("pos"), new.alias("cigar"), F.least(d, q).alias("start"), F.greatest(d, q).alias("end"), "on_minus", "wrong", "score")


def _op(op: str, n: Column) -> Column:
    return F.struct(F.lit(op).alias("op"), n.cast("int").alias("n"))


def _stitched(cigar: Column, block: Column, behind: list[tuple[Column, Column]], at_end: bool, clip: int = 1) -> Column:
    """The operations with the outermost block (``clip`` operations within) at a new length, and introns and blocks behind it, outward."""
    joint = [_op("M", block)]
    for intron, size in behind:
        joint += [_op("N", intron), _op("M", size)]
    kept = F.size(cigar) - 1 - clip
    return F.concat(F.slice(cigar, F.lit(1), kept), F.array(*joint)) if at_end else F.concat(F.array(*joint[::-1]), F.slice(cigar, F.lit(2 + clip), kept))


# ---- over two known introns ------------------------------------------------------------

#: A short exon between two introns has up to this many bases, and so many of the read stand behind it at least.
LONGEST_EXON = 60
BEHIND = 4


#: Places of a stretch whose reads are looked at together, and reads of one of its parts.
STRETCH, READS = 128, 16_384


def _outward(library: DataFrame, at_end: bool) -> DataFrame:
    """chrom, x, y, strands: near and far side of the introns as outward places (negative at a start), once each; bits of strands: plus 1, minus 2."""
    x, y = (F.col("start"), F.col("end")) if at_end else (-F.col("end"), -F.col("start"))
    rows = library.filter("minus is not null").select("chrom", x.cast("long").alias("x"), y.cast("long").alias("y"), F.when(F.col("minus"), 2).otherwise(1).alias("m"))
    return rows.groupBy("chrom", "x", "y").agg(F.sum_distinct("m").alias("strands"))


def _exon_introns(near: DataFrame, introns: DataFrame, slack: int) -> tuple[DataFrame, DataFrame]:
    """The introns that reads of a stretch (chrom, bin) may be laid over: firsts near their edges, and seconds behind an exon of these. Each once a stretch: chrom, bin, x, y, strands."""
    bins = near.select("chrom", "bin").distinct()
    around = F.sequence(F.floor((F.col("x") - slack) / STRETCH), F.floor((F.col("x") + slack) / STRETCH))
    firsts = introns.withColumn("bin", F.explode(around)).join(bins, ["chrom", "bin"], "left_semi")
    reach = F.sequence(F.floor((F.col("y") + 1) / LONGEST_EXON), F.floor((F.col("y") + LONGEST_EXON) / LONGEST_EXON))
    places = firsts.select("chrom", "bin", F.explode(reach).alias("p")).distinct()
    seconds = introns.withColumn("p", F.floor(F.col("x") / LONGEST_EXON)).join(places, ["chrom", "p"])
    return firsts.select("chrom", "bin", "x", "y", "strands"), seconds.select("chrom", "bin", "x", "y", "strands")


def short_exons(records: DataFrame, library: DataFrame, tiles: DataFrame, width: int, side: str = "end", least: int = LEAST_TAIL, slack: int = REACH) -> DataFrame:
    """records whose clipped end holds a short exon between two known introns, and goes on behind the second: two cuts, looked for in the stretch of places of the end.

    The first intron begins within ``slack`` bases of the aligned end; BEHIND bases or more lie behind the second. At most a tenth of the bases
    behind the first cut may differ. The fewest differences win, then the shorter span, then the smaller places. Returns ord, pos, cigar, wrong.
    """
    at_end, sign = side == "end", 1 if side == "end" else -1
    keep = shared_path(records.sparkSession, "exons")
    ends = written(_ends(records, side, least), f"{keep}/ends")
    near = _near(ends.select(*KEY).distinct(), tiles, width, side).withColumn("bin", F.floor(sign * F.col("edge") / STRETCH))
    near = written(near, f"{keep}/near")
    introns = written(_outward(library, at_end), f"{keep}/introns")
    firsts, seconds = (written(x, f"{keep}/{n}") for n, x in zip(("firsts", "seconds"), _exon_introns(near, introns, slack)))
    longest = max(LONGEST_EXON, near.agg(F.coalesce(F.max(F.length("out")), F.lit(0)).alias("n")).first()["n"])
    # what stands outward from a far side is fetched once for all introns and stretches
    far = introns.select("chrom", F.col("y").alias("place")).distinct()
    place = sign * F.col("place")
    far = _texts(far, ["chrom", "place"], "text", place - (0 if at_end else longest), place + (longest if at_end else 0), tiles, width, side)
    texts = firsts.unionByName(seconds).select("chrom", "bin", F.col("y").alias("place")).distinct().join(far, ["chrom", "place"])
    rows = [d.select("chrom", "bin", F.lit(kind).alias("kind"), "x", "y", "strands", F.lit(None).cast("string").alias("text")) for kind, d in ((1, firsts), (2, seconds))]
    rows.append(texts.select("chrom", "bin", F.lit(3).alias("kind"), F.col("place").alias("x"), F.col("place").alias("y"), F.lit(0).cast("long").alias("strands"), "text"))
    known = rows[0].unionByName(rows[1]).unionByName(rows[2])
    # many reads of a stretch are dealt to parts, which all get its introns
    parts = near.groupBy("chrom", "bin").agg(F.ceil(F.count("*") / READS).alias("parts"))
    known = known.join(parts, ["chrom", "bin"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    reads = near.join(parts, ["chrom", "bin"]).withColumn("part", F.pmod(F.xxhash64("out"), F.col("parts"))).drop("parts")

    def run(reads: pa.Table, known: pa.Table) -> pa.Table:
        names = ["chrom", "edge", "inner", "out", "a", "b", "c", "d", "i", "exon", "rest", "wrong"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 4, *[pa.int32()] * 4]
        made = []
        if reads.num_rows and known.num_rows:
            kind, x, y, strands = (known.column(c).to_numpy() for c in ("kind", "x", "y", "strands"))
            text = known.filter(pa.array(kind == 3)).column("text").to_pylist()
            introns = exon_batches.Introns(*[tuple(v[kind == n] for v in (x, y, strands)) for n in (1, 2)], x[kind == 3], text, sign, LONGEST_EXON, BEHIND, slack)
            reads = reads.sort_by([("edge", "ascending"), ("inner", "ascending")])
            edge, inner, out, near, chrom = (reads.column(c).to_pylist() for c in ("edge", "inner", "out", "near", "chrom"))
            laid = introns.lay([sign * e for e in edge], inner, out, near)
            made = [(chrom[r], edge[r], inner[r], out[r], *[sign * v for v in best[:4]], *best[4:]) for r, best in enumerate(laid) if best]
        return pa.table([pa.array([m[c] for m in made], t) for c, t in enumerate(kinds)], names=names)

    key = ["chrom", "bin", "part"]
    schema = "chrom string, edge long, inner int, out string, a long, b long, c long, d long, i int, exon int, rest int, wrong int"
    best = reads.groupBy(*key).cogroup(known.groupBy(*key)).applyInArrow(run, schema)
    r = ends.join(best, KEY)
    new = _stitched(F.col("cigar"), F.col("block") + F.col("i") - F.col("inner"), [(F.abs(F.col("b") - F.col("a")), F.col("exon")), (F.abs(F.col("d") - F.col("c")), F.col("rest"))], at_end)
    pos = F.col("pos") if at_end else F.col("d") - F.col("rest")
    return r.select("ord", pos.cast("long").alias("pos"), new.alias("cigar"), "wrong")


# ---- run through an intron's near side ---------------------------------------------------


def run_through(records: DataFrame, library: DataFrame, tiles: DataFrame, width: int, side: str = "end") -> DataFrame:
    """records whose last block runs over a known intron's near side, and whose bases from there on fit its far side better.

    At most a fifth of them may differ there, so fewer than five must fit exactly, and always fewer than where they stand.
    The fewest differences win, then the shorter intron, then the smaller place. Returns ord, pos, cigar, wrong.
    """
    at_end, sign = side == "end", 1 if side == "end" else -1
    block = F.try_element_at("cigar", F.lit(-1 if at_end else 1))
    r = records.filter((F.size("cigar") >= 1) & (block["op"] == "M"))
    edge = (cg.ref_end(F.col("pos"), F.col("cigar")) if at_end else F.col("pos")).cast("long")
    r = r.select("ord", "chrom", "pos", "cigar", "seq", edge.alias("edge"), block["n"].alias("block"))
    r = r.withColumn("told", (F.right("seq", F.col("block")) if at_end else F.reverse(F.left("seq", F.col("block")))))
    # equal blocks of one place are looked at once; the reference under a block and behind an intron is fetched once each, so a pair of both is never shuffled
    place = ["chrom", "edge", "block"]
    under = _texts(r.select(*place).distinct(), place, "under", F.col("edge") - (F.col("block") if at_end else 0), F.col("edge") + (0 if at_end else F.col("block")), tiles, width, side)
    blocks = r.select(*place, "told").distinct().join(under, place)
    # an intron whose near side lies within the block
    low, high = (F.col("edge") - F.col("block") + 1, F.col("edge")) if at_end else (F.col("edge") + 1, F.col("edge") + F.col("block"))
    spans = blocks.withColumns({"lo": low, "hi": high})
    a, b = ("start", "end") if at_end else ("end", "start")
    size = sign * (F.col("b") - F.col("a"))
    known = library.select("chrom", F.col(a).alias("a"), F.col(b).alias("b")).distinct().filter((size >= SHORTEST) & (size <= LONGEST))
    longest = r.agg(F.coalesce(F.max("block"), F.lit(1)).alias("most")).first()["most"]
    ends = known.select("chrom", "b").distinct()
    behind = _texts(ends, ["chrom", "b"], "behind", F.col("b") - (0 if at_end else longest), F.col("b") + (longest if at_end else 0), tiles, width, side)
    hits = points_in_intervals(known.join(behind, ["chrom", "b"]), spans, "a", start="lo", end="hi", width=64)
    n = (sign * (F.col("edge") - F.col("a"))).cast("int")
    # bases that stand under the block's end, short at a contig's end
    j = hits.withColumn("n", n).filter((F.length("behind") >= F.col("n")) & (F.length("under") == F.col("block")))
    out = F.right("told", F.col("n"))
    j = j.withColumn("wrong", differences(out, F.left("behind", F.col("n")))).filter(F.col("wrong") <= F.floor(F.col("n") / 5))
    j = j.filter(F.col("wrong") < differences(out, F.right("under", F.col("n"))))
    best = j.groupBy(*place, "told").agg(F.min_by(F.struct("a", "b", "n", "wrong"), F.struct("wrong", size.alias("s"), "a", "b")).alias("x")).select(*place, "told", "x.*")
    out = r.join(best, [*place, "told"])
    new = _stitched(F.col("cigar"), F.col("block") - F.col("n"), [(size, F.col("n"))], at_end, clip=0)
    pos = F.col("pos") if at_end else F.col("b") - F.col("n")
    return out.select("ord", pos.cast("long").alias("pos"), new.alias("cigar"), "wrong")
