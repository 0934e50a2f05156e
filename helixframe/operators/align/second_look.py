"""Second looks: gates for rescued placements, mate windows, clipped tails over known junctions, transcript candidates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as cg
from helixframe.operators import kmer_index, transcripts
from helixframe.operators.align import kernels as k
from helixframe.operators.transcripts import tile_sequences
from helixframe.session import shared_path, written

# Fixed values of the gates.
MIN_PHRED = 30
SHORT_READ = 60
PURITY_SHORT, PURITY_LONG = 0.80, 0.60
EDGE = 0.20
CLUSTER = 0.10
ONE_BASE = 0.60
MATE_REACH = 750
#: Reads that are looked for around their mates together, and that are extended together.
TOGETHER, EXTENDED = 4096, 512


def gate(read: str, quals: list[int], cigar: k.Cigar, ref: str, source: str, target: str) -> tuple[str | None, list[int]]:
    """Why a rescued placement is refused, or None; and the reference offsets of its edits.

    read, quals: on the reference's strand. ref: reference from the placement on. source, target: the edit there.
    """
    n = len(read)
    if not n or len(quals) != n:
        return "malformed_read", []
    if any(op in "ID" for op, _ in cigar):
        return "gapped", []
    if sum(x for op, x in cigar if op in "MN") > len(ref):
        return "off_contig", []
    q = r = wrong = other = 0
    at: list[int] = []
    places: list[int] = []
    for op, size in cigar:
        if op == "M":
            if q + size > n:
                return "cigar_overrun", []
            for i in range(size):
                x, y = read[q + i].upper(), ref[r + i].upper()
                if x not in "ACGT" or y not in "ACGT":
                    wrong, other = wrong + 1, other + 1
                elif x != y:
                    wrong += 1
                    if (y, x) != (source, target):
                        other += 1
                    elif quals[q + i] >= MIN_PHRED:
                        at.append(q + i)
                        places.append(r + i)
            q, r = q + size, r + size
        elif op == "S":
            q += size
        else:
            r += size
    checks = (
        ("non_edit_mm", lambda: other > 2),
        ("no_edits", lambda: not at),
        ("edit_density", lambda: len(at) < 0.05 * n),
        ("purity", lambda: len(at) <= (PURITY_SHORT if n <= SHORT_READ else PURITY_LONG) * wrong),
        ("cluster_span", lambda: at[-1] - at[0] < CLUSTER * n),
        ("cluster_at_start", lambda: at[-1] < EDGE * n),
        ("cluster_at_end", lambda: at[0] > (1 - EDGE) * n),
        ("cluster_composition", lambda: max(read[at[0] : at[-1] + 1].upper().count(b) for b in "ACGT") > ONE_BASE * (at[-1] - at[0] + 1)),
    )
    for name, fails in checks:
        if fails():
            return name, []
    return None, places


def verify(placed: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """placed: ord, direction, chrom, pos, minus, cigar, seq, qual (as sequenced). Adds reason (null: accepted) and sites (reference places of edits).

    The true reference is fetched by tile join; the first failing gate is told.
    """
    w = placed.withColumn("s", F.col("pos")).withColumn("e", F.col("pos") + F.greatest(cg.ref_length(F.col("cigar")), F.lit(1)))
    got = tile_sequences(w.select("ord", "direction", "chrom", "s", "e"), tiles, width, ["ord", "direction", "s", "e"]).select("ord", "direction", F.col("seq").alias("ref"))
    rows = placed.join(got, ["ord", "direction"], "left").withColumn("ref", F.coalesce("ref", F.lit("")))
    names = [*placed.columns, "reason", "sites"]
    kind = ", ".join([f"{c} {t}" for c, t in placed.dtypes] + ["reason string", "sites array<long>"])

    def run(frames):
        flip = str.maketrans("ACGTacgt", "TGCAtgca")
        for f in frames:
            reasons, sites = [], []
            for x in f.itertuples(index=False):
                read, qual = (x.seq[::-1].translate(flip), x.qual[::-1]) if x.minus else (x.seq, x.qual)
                source, target = ("A", "G") if x.direction == "A" else ("T", "C")
                if x.minus:
                    source, target = source.translate(flip), target.translate(flip)
                why, places = gate(read, [ord(c) - 33 for c in qual], [(o["op"], o["n"]) for o in x.cigar], x.ref, source, target)
                reasons.append(why)
                sites.append([x.pos + p for p in places])
            f["reason"], f["sites"] = reasons, sites
            yield f[names]

    return rows.mapInPandas(run, kind)


def rejections(verified: DataFrame) -> DataFrame:
    """Counts by gate and strand; accepted placements count under null."""
    return verified.groupBy("reason", "minus").agg(F.count("*").alias("n"))


def mate_window(poor: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """poor: ord, seq, mate_chrom, mate_pos. Looks for each read (up to 256 bases) around its mate, on both strands.

    Returns ord, chrom, pos, minus, cigar, distance of the best ungapped or extended place within a third of the read's length of edits.
    """
    n = F.length("seq")
    reach = n + MATE_REACH
    w = poor.filter((n > 0) & (n <= 256)).select("ord", "seq", F.col("mate_chrom").alias("chrom"), F.greatest(F.col("mate_pos") - reach, F.lit(0)).alias("s"), (F.col("mate_pos") + reach + n).alias("e")).withColumnRenamed("seq", "read")
    # reads share windows: each is fetched once
    got = tile_sequences(w.select("chrom", "s", "e").distinct(), tiles, width, ["chrom", "s", "e"])
    kind = "ord long, chrom string, pos long, minus boolean, cigar array<struct<op:string,n:int>>, distance int"

    def batch(f: pd.DataFrame) -> list[tuple]:
        flip = str.maketrans("ACGTacgt", "TGCAtgca")
        forward, windows = f["read"].tolist(), f["seq"].tolist()
        backward = [x[::-1].translate(flip) for x in forward]
        (d, end), (d2, end2) = k.edit_infixes(forward, windows), k.edit_infixes(backward, windows)
        most = np.maximum(np.array([len(x) for x in forward]) // 3, 10)
        minus = d2 < d
        d, end = np.where(minus, d2, d), np.where(minus, end2, end)
        rows = np.flatnonzero(d <= most).tolist()
        reads = [backward[i] if minus[i] else forward[i] for i in rows]
        d, end, minus = d.tolist(), end.tolist(), minus.tolist()
        lows = [max(0, end[i] - len(x) - d[i] - 10) for i, x in zip(rows, reads)]
        refs = [windows[i][low : end[i] + d[i] + 10] for i, low in zip(rows, lows)]
        made = [e for i in range(0, len(reads), EXTENDED) for e in k.affine_local(reads[i : i + EXTENDED], refs[i : i + EXTENDED], "both")]
        chrom, s, ord_ = f["chrom"].tolist(), f["s"].tolist(), f["ord"].tolist()
        return [(ord_[i], chrom[i], s[i] + low + e.ref_start, minus[i], [{"op": o, "n": c} for o, c in e.cigar], d[i]) for i, low, e in zip(rows, lows, made) if e.score > 0]

    def run(frames):
        for f in frames:
            for i in range(0, len(f), TOGETHER):
                yield pd.DataFrame(batch(f.iloc[i : i + TOGETHER]), columns=[c.split()[0] for c in kind.split(", ")])

    return w.join(got, ["chrom", "s", "e"]).select("ord", "chrom", "s", "read", "seq").mapInPandas(run, kind)


def clipped_tails(records: DataFrame, library: DataFrame, tiles: DataFrame, width: int, least: int = 12, slack: int = 20, side: str = "end") -> DataFrame:
    """records (ord, chrom, pos, cigar, seq on the reference's strand) whose clipped end goes on behind a known intron.

    side: the end of the record, or its start. Introns within ``slack`` bases of the aligned end are tried by a band join; the
    tail, moved to the intron's near side, must match behind it with at most a tenth of mismatches. Returns ord, pos, cigar of the
    best (fewest mismatches, then shortest intron, then first).
    """
    from helixframe.operators.rangejoin import band

    at_end = side == "end"
    clip, block = (F.try_element_at("cigar", F.lit(i if at_end else -i)) for i in (-1, -2))
    r = records.filter((F.size("cigar") >= 2) & (clip["op"] == "S") & (clip["n"] >= least) & (block["op"] == "M"))
    edge = cg.ref_end(F.col("pos"), F.col("cigar")).cast("long") if at_end else F.col("pos").cast("long")
    r = r.select("ord", "chrom", "pos", "cigar", F.col("seq").alias("read"), edge.alias("edge"), clip["n"].alias("tail"), block["n"].alias("block"))
    j = band(r, library.select("chrom", F.col("start").alias("js"), F.col("end").alias("je")).distinct(), "edge", "js" if at_end else "je", slack)
    # bases of the block that belong on the other side of the intron; below 0: bases that the block still lacks
    j = j.withColumn("move", F.col("edge") - F.col("js") if at_end else F.col("je") - F.col("edge"))
    j = j.withColumn("n", F.col("tail") + F.col("move")).filter("move < block and n > 0")
    far = j.withColumn("s", F.col("je") if at_end else F.col("js") - F.col("n")).filter("s >= 0").withColumn("e", F.col("s") + F.col("n"))
    got = tile_sequences(far.select("ord", "js", "je", "chrom", "s", "e"), tiles, width, ["ord", "js", "je", "s", "e"]).drop("s", "e")
    lacking = j.filter("move < 0").withColumn("s", F.col("edge" if at_end else "je")).withColumn("e", F.col("js" if at_end else "edge"))
    lead = tile_sequences(lacking.select("ord", "js", "je", "chrom", "s", "e"), tiles, width, ["ord", "js", "je", "s", "e"]).select("ord", "js", "je", F.col("seq").alias("lead"))
    rows = far.join(got, ["ord", "js", "je"]).join(lead, ["ord", "js", "je"], "left").withColumn("lead", F.coalesce("lead", F.lit("")))

    def run(frames):
        for f in frames:
            out = []
            for x in f.itertuples(index=False):
                n, size = int(x.n), int(x.n) + len(x.lead)
                want = x.lead + x.seq if at_end else x.seq + x.lead
                tail = x.read[len(x.read) - size :] if at_end else x.read[:size]
                if len(want) < len(tail) or len(x.seq) < n:
                    continue
                wrong = int((k.substitution("both")[k.codes(tail), k.codes(want)] != k.MATCH).sum())
                if wrong > n // 10:
                    continue
                ops = [(o["op"], o["n"]) for o in x.cigar]
                joint = [("M", int(x.block - x.move)), ("N", int(x.je - x.js)), ("M", n)]
                new: k.Cigar = []
                for op, size in [*ops[:-2], *joint] if at_end else [*joint[::-1], *ops[2:]]:
                    k.push(new, op, size)
                out.append((x.ord, wrong, int(x.je - x.js), int(x.js), int(x.pos if at_end else x.s), [{"op": o, "n": c} for o, c in new]))
            yield pd.DataFrame(out, columns=["ord", "wrong", "intron", "js", "pos", "cigar"])

    found = rows.mapInPandas(run, "ord long, wrong int, intron long, js long, pos long, cigar array<struct<op:string,n:int>>")
    return found.groupBy("ord").agg(F.min_by(F.struct("pos", "cigar"), F.struct("wrong", "intron", "js")).alias("b")).select("ord", "b.pos", "b.cigar")


def transcript_candidates(reads: DataFrame, tx: DataFrame, tiles: DataFrame, width: int, kmer: int = 15, most: int = 8) -> DataFrame:
    """Places reads on transcripts and projects them: read, name, chrom, pos, cigar, distance, minus.

    Equal sequences are placed once. Seeds are shared k-mers (transcript_hits); the best diagonals are verified by editing-aware edit distance over the
    whole read (up to a thirty-third of its length, at least 1), and their intervals go to the genome.
    """
    from pyspark.sql import Window

    from helixframe.operators.align.mapper import distinct_sequences

    keep = shared_path(reads.sparkSession, "transcript-reads")
    distinct = written(distinct_sequences(reads), f"{keep}/distinct").select(F.col("seq_id").alias("read"), "seq")
    seqs = written(transcripts.sequences(tx, tiles, width).filter("seq <> ''"), f"{keep}/sequences")
    hits = kmer_index.transcript_hits(distinct, seqs, kmer)

    w = Window.partitionBy("read").orderBy(F.desc("n"), "name", "minus", "diagonal")
    hits = written(hits.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= 4 * most), f"{keep}/best")
    rows = hits.join(distinct.select("read", F.col("seq").alias("q")), "read").join(seqs, "name")
    kind = "read long, name string, minus boolean, off long, distance int, size int"

    def run(frames):
        flip = str.maketrans("ACGTacgt", "TGCAtgca")
        for f in frames:
            out = []
            for x in f.itertuples(index=False):
                q = x.q[::-1].translate(flip) if x.minus else x.q
                at = int(x.diagonal)
                if at < 0 or at + len(q) > len(x.seq):
                    continue
                same = k.substitution("both")[k.codes(q), k.codes(x.seq[at : at + len(q)])] == k.MATCH
                d = int(np.count_nonzero(~same))
                if d <= max(len(q) // 33, 1):
                    out.append((x.read, x.name, x.minus, at, d, len(q)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])

    best = rows.mapInPandas(run, kind).withColumn("k", F.row_number().over(Window.partitionBy("read").orderBy("distance", "name", "off"))).filter(F.col("k") <= most)
    p = best.join(tx.select("name", "chrom", F.col("minus").alias("tx_minus"), "exons"), "name")
    p = p.withColumn("p", transcripts.project(F.col("tx_minus"), F.col("exons"), F.col("off"), F.col("size").cast("long"))).filter("p is not null")
    p = p.select("read", "name", "chrom", "p.pos", "p.cigar", "distance", (F.col("minus") != F.col("tx_minus")).alias("minus"))
    # where few are placed, their table goes to the reads, not the reads to a shuffle
    placed = written(p.join(distinct, "read").drop("read"), f"{keep}/placed")
    return reads.select("read", "seq").join(placed, "seq").select("read", *p.columns[1:])


def best_segment(read: str, ref: str, direction: str = "both") -> tuple[int, int, int]:
    """Start, end and score of the best run of the diagonal: where to clip a read that lies without gaps. N scores nothing."""
    x, y = k.codes(read), k.codes(ref)
    s = np.where((x < 4) & (y < 4), k.substitution(direction)[x, y], 0)
    total = np.concatenate(([0], np.cumsum(s)))
    low = np.minimum.accumulate(total)
    end = int((total - low).argmax())
    start = int(np.flatnonzero(total[: end + 1] == low[end])[0])
    return start, end, int(total[end] - total[start])
