"""The distributed mapper: distinct reads, seed joins, chains, windows by tile join, extension, arbitration; pairs, a second pass, rescue.

The reference stays a table of tiles. Reads meet it in the seed join, on k-mers, and in
the join of candidate windows, on tiles; reads that few seeds cover meet the frequent
k-mers too. Equal sequences are aligned once. Kernels run in Arrow batches; a read's candidates
(at most MAX_CANDIDATES) come together by a shuffle on the read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators import kmer_index
from helixframe.operators.align import kernels as k
from helixframe.operators.align.second_look import best_segment
from helixframe.operators.transcripts import tile_sequences
from helixframe.session import shared_path, written

# Fixed values of the candidate search.
MAX_CANDIDATES = 8
PAD = 40
WIDE_CAP = 5000
WIDE_ANCHORS = 20_000
COVERED = 0.6
REFUSED = 0.66
#: Extensions that are made together.
TOGETHER = 512
ALIGNED = "seq string, chrom string, pos long, minus boolean, cigar array<struct<op:string,n:int>>, score int, second int, mismatches int, edits_ag int, edits_tc int, mapq int, n_anchors int, margin string, origin string"
#: Columns of to_records().
RECORD = ["ord", "qname", "rg", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual", "nm", "edits_ag", "edits_tc", "mismatches", "margin", "origin"]


def distinct_sequences(reads: DataFrame) -> DataFrame:
    """seq_id, seq: every sequence once. The id is its hash; of sequences with one hash all but the first get a hash of hash and rank."""
    # told apart first: sets of sequences are aggregated by sorting
    h = reads.select("seq").filter("seq <> ''").distinct().groupBy(F.xxhash64("seq").alias("h")).agg(F.array_sort(F.collect_set("seq")).alias("seqs"))
    each = h.select("h", F.posexplode("seqs").alias("i", "seq"))
    return each.select(F.when(F.col("i") == 0, F.col("h")).otherwise(F.xxhash64("seq", "i")).alias("seq_id"), "seq")


def candidate_windows(anchors: DataFrame, sizes: DataFrame, kmer: int, rules: k.ChainRules) -> DataFrame:
    """anchors: read, chrom, minus, qpos, rpos. sizes: read, size. Chains each read's anchors and gives up to MAX_CANDIDATES windows.

    Returns read, cand, chrom, minus, chain_score, second_chain, n_anchors, reach (read bases from the chain's start to its end),
    parts: array<struct<s, e, r, q>> of one window for each segment between introns, with the place of its first anchor.
    """
    kind = "read long, cand int, chrom string, minus boolean, chain_score int, second_chain int, n_anchors int, reach int, parts array<struct<s:bigint,e:bigint,r:bigint,q:int>>"

    names = [x.split()[0] for x in kind.split(", ")[:9]]

    def chain(read: int, size: int, anchors_: list) -> list[tuple]:
        found = k.chains(anchors_, rules)
        second, rows = k.second_score(found), []
        kept: list[k.Chain] = []
        for c in found:
            r, q = c.anchors[0]
            if any(o.chrom == c.chrom and o.minus == c.minus and abs(o.anchors[0][0] - o.anchors[0][1] - (r - q)) < 50 for o in kept):
                continue
            kept.append(c)
            if len(kept) > MAX_CANDIDATES:
                break
            parts = []
            for seg in k.segments(c, kmer):
                (r0, q0), (r1, q1) = seg[0], seg[-1]
                parts.append({"s": max(0, r0 - q0 - PAD), "e": r1 + (size - q1) + PAD, "r": r0, "q": q0})
            rows.append((read, len(rows), c.chrom, c.minus, c.score, second, len(c.anchors), c.anchors[-1][1] + kmer - q, parts))
        return rows

    def run(frames):
        now, own = None, []
        for f in frames:
            out = []
            for x in zip(f["read"].tolist(), f["size"].tolist(), f["chrom"].tolist(), f["minus"].tolist(), f["rpos"].tolist(), f["qpos"].tolist()):
                if now is not None and x[0] != now[0]:
                    out += chain(*now, own)
                    own = []
                now = x[:2]
                own.append(x[2:])
            yield pd.DataFrame(out, columns=names)
        if own:
            yield pd.DataFrame(chain(*now, own), columns=names)

    # a read's rows together and in order, without a call for each read
    return anchors.join(sizes, "read").repartition("read").sortWithinPartitions("read").mapInPandas(run, kind)


def _plainly(seq: str, row) -> k.Placement | None:
    """One candidate without gaps: over the windows of its exons, cut at the best splice points, or on its diagonal. None if it needs an extension."""
    parts = sorted(row.parts, key=lambda p: p["i"])
    read = _turned(seq, row.minus)
    if len(parts) > 1:
        diagonals = [p["r"] - p["q"] for p in parts]
        cuts, wrong, worst, _ = k.splice_chain(read, [(p["s"], p["seq"]) for p in parts], diagonals)
        introns = [y - x for x, y in zip(diagonals, diagonals[1:])]
        if cuts and min(introns) > 0 and wrong <= 0.1 * len(read) and worst > -8:
            cigar: k.Cigar = []
            for size, intron in zip((y - x for x, y in zip([0, *cuts], [*cuts, len(read)])), [*introns, 0]):
                k.push(cigar, "M", size)
                k.push(cigar, "N", intron)
            return k.Placement(row.chrom, row.minus, diagonals[0], cigar, extra={"read": read})
        return None
    return _ungapped(read, row, parts[0])


def _turned(seq: str, minus: bool) -> str:
    return seq[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")) if minus else seq


def _extended(rows: list) -> list[k.Placement | None]:
    """A placement of each candidate, or None. Those that need an extension are extended together, in a band around their anchors' diagonals."""
    found = [_plainly(row.seq, row) for row in rows]
    jobs = [(i, p) for i, (row, x) in enumerate(zip(rows, found)) if x is None for p in sorted(row.parts, key=lambda p: p["i"])]
    for at in range(0, len(jobs), TOGETHER):
        some = jobs[at : at + TOGETHER]
        reads = [_turned(rows[i].seq, rows[i].minus) for i, _ in some]
        made, _ = k.affine_banded(reads, [p["seq"] for _, p in some], [p["r"] - p["q"] - p["s"] for _, p in some])
        for (i, p), read, e in zip(some, reads, made):
            if e.score > 0 and (found[i] is None or e.score > found[i].score):
                found[i] = k.Placement(rows[i].chrom, rows[i].minus, p["s"] + e.ref_start, e.cigar, e.score, extra={"read": read})
    return found


def _ungapped(read: str, row, part: dict) -> k.Placement | None:
    """The read on its first anchor's diagonal, if that leaves few differences: most reads need no more."""
    first = part["r"] - part["q"]
    ref = part["seq"][first - part["s"] : first - part["s"] + len(read)] if first >= part["s"] else ""
    if len(ref) < len(read):
        return None
    start, end, _ = best_segment(read, ref)
    x, y = k.codes(read)[start:end], k.codes(ref)[start:end]
    plain = (x != y) & ~((y == 0) & (x == 2)) & ~((y == 3) & (x == 1))
    if end - start < 0.9 * len(read) or plain.sum() > 0.05 * len(read):
        return None
    cigar: k.Cigar = []
    k.push(cigar, "S", start)
    k.push(cigar, "M", end - start)
    k.push(cigar, "S", len(read) - end)
    return k.Placement(row.chrom, row.minus, first + start, cigar, extra={"read": read})


def _again(p: k.Placement, window: tuple[int, str], direction: str) -> None:
    """Extends an unspliced candidate anew with a direction's edits free; it stays if that aligns less."""
    e = k.affine_local([p.extra["read"]], [window[1]], direction)[0]
    aligned = lambda cigar: sum(n for op, n in cigar if op in "MI")
    if e.score > 0 and aligned(e.cigar) >= aligned(p.cigar):
        p.pos, p.cigar = window[0] + e.ref_start, e.cigar


def _placer(kmer: int):
    """The kernel over rows sorted by read: extends and rescores every candidate, again under an editing direction that one of them shows, and arbitrates."""
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def winner(rows: list, placed: list[k.Placement | None]) -> tuple[tuple, tuple] | None:
        found = []
        for row, p in zip(rows, placed):
            if p is None:
                continue
            windows = [(x["s"], x["seq"]) for x in row.parts]

            def fetch(s: int, e: int, windows=windows) -> str:
                for start, text in windows:
                    if start <= s and e <= start + len(text):
                        return text[s - start : e - start]
                return "N" * (e - s)

            p.extra |= {"fetch": fetch, "windows": windows}
            p.chain_score, p.second_chain = row.chain_score, row.second_chain
            found.append(p)
        for p in found:
            _score(p, "")
        direction = k.edit_direction(found)
        if direction:
            for p in found:
                if len(p.extra["windows"]) == 1 and not any(op == "N" for op, _ in p.cigar):
                    _again(p, p.extra["windows"][0], direction)
                _score(p, direction)
        p = k.arbitrate(found, len(rows[0].seq))
        if p is None:
            return None
        p.anchors = k.exact_kmers(p.extra["read"], p.pos, p.cigar, p.extra["fetch"], kmer, direction)
        told = (rows[0].seq, p.chrom, p.pos, p.minus, [{"op": o, "n": n} for o, n in p.cigar], p.score, p.second, p.mismatches, p.edits_ag, p.edits_tc)
        return told, k.numbers(p)

    def frame(rows: list) -> pd.DataFrame:
        """Whole reads' candidates."""
        placed, won, first = _extended(rows), [], 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i].read != rows[first].read:
                won.append(winner(rows[first:i], placed[first:i]))
                first = i
        won = [x for x in won if x]
        quality, source = k.qualities([n for _, n in won])
        more = ((int(q), n[k.NUMBERS.index("anchors")], str(m), "decoy" if k.is_decoy(t[1]) else "genome") for (t, n), q, m in zip(won, quality, source))
        return pd.DataFrame([(*t, *x) for (t, _), x in zip(won, more)], columns=names)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for f in frames:
            rows = held + list(f.itertuples(index=False))
            cut = next((i + 1 for i in range(len(rows) - 2, -1, -1) if rows[i].read != rows[-1].read), 0)
            held = rows[cut:]
            yield frame(rows[:cut])
        yield frame(held)

    return place


def _score(p: k.Placement, direction: str) -> None:
    if not any(op == "N" for op, _ in p.cigar) or len(p.extra["windows"]) > 1:
        k.rescore(p, p.extra["read"], p.extra["fetch"], direction)
        p.score += sum(k.OPEN + k.EXTEND * n for op, n in p.cigar if op == "N")  # an intron costs nothing here


def _candidates(distinct: DataFrame, index: DataFrame, kmer: int, w: int, cutoff: int, most: int, rules: k.ChainRules, keep: str | None) -> DataFrame:
    """Candidate windows of two seed rounds: k-mers up to the cutoff; and for reads whose best chain reaches over less than
    COVERED of them, those of up to WIDE_CAP places, if that gives at most WIDE_ANCHORS anchors. The round of the better chain counts."""
    reads, sizes = distinct.select(F.col("seq_id").alias("read"), "seq"), distinct.select(F.col("seq_id").alias("read"), F.length("seq").alias("size"))
    first = candidate_windows(kmer_index.anchors(reads, index, kmer, w, cutoff), sizes, kmer, rules)
    if most <= cutoff or cutoff >= WIDE_CAP:
        return first
    if keep:  # both what it says of reads and its windows are used: it is made once
        first = written(first, keep)
    best = first.filter("cand = 0").select("read", "chain_score", "reach")
    wanting = sizes.join(best, "read", "left").filter(F.col("reach").isNull() | (F.col("reach") < COVERED * F.col("size")))
    wide = kmer_index.anchors(reads.join(wanting.select("read"), "read", "left_semi"), index, kmer, w, WIDE_CAP)
    few = wide.groupBy("read").count().filter(F.col("count") <= WIDE_ANCHORS).select("read")
    second = candidate_windows(wide.join(few, "read", "left_semi"), sizes, kmer, rules)
    won = second.filter("cand = 0").select("read", F.col("chain_score").alias("s")).join(best, "read", "left").filter("chain_score is null or s > chain_score").select("read")
    return first.join(won, "read", "left_anti").unionByName(second.join(won, "read", "left_semi"))


def align(reads: DataFrame, tiles: DataFrame, width: int, kmer: int = 15, w: int = 10, cutoff: int | None = None, rules: k.ChainRules | None = None, index: DataFrame | None = None, keep: str | None = None) -> DataFrame:
    """reads: ord, name, seq, ... Returns reads LEFT JOIN their alignment; equal sequences are aligned once.

    index: a table of minimizer_index(), else it is made here, more than once. cutoff: of k-mer places in the first
    round, by default from the index. keep: a shared path for the first round's windows, so the second round doesn't make them again, and (with -placed) for what is placed.
    """
    rules = rules or k.ChainRules(k=kmer, min_score=min(40, 2 * kmer))
    index = kmer_index.minimizer_index(tiles, width, kmer, w) if index is None else index
    found, most = kmer_index.frequency(index)
    distinct = distinct_sequences(reads)
    cands = _candidates(distinct, index, kmer, w, found if cutoff is None else cutoff, most, rules, keep)
    each = cands.select("read", "cand", "chrom", F.posexplode("parts").alias("i", "p")).select("read", "cand", "chrom", "i", F.col("p.s").alias("s"), F.col("p.e").alias("e"), F.col("p.r").alias("r"), F.col("p.q").alias("q"))
    got = tile_sequences(each, tiles, width, ["read", "cand", "i", "s", "e", "r", "q"])
    parts = got.groupBy("read", "cand").agg(F.collect_list(F.struct("i", "s", "r", "q", "seq")).alias("parts"))
    rows = cands.drop("parts").join(parts, ["read", "cand"]).join(distinct.select(F.col("seq_id").alias("read"), "seq"), "read")
    rows = rows.select("read", "cand", "chrom", "minus", "chain_score", "second_chain", "n_anchors", "parts", "seq")
    placed = rows.repartition("read").sortWithinPartitions("read", "cand").mapInPandas(_placer(kmer), ALIGNED)
    if keep:  # where few sequences differ their table goes to the reads
        placed = written(placed, f"{keep}-placed")
    return reads.join(placed, "seq", "left")


def to_records(aligned: DataFrame) -> DataFrame:
    """Alignment records of single reads: ord, qname, rg, flag, chrom, pos, mapq, cigar, seq, qual, with NM and editing counts."""
    from helixframe.functions import cigar as cg
    from helixframe.functions import dna

    placed, qual = F.col("chrom").isNotNull(), _phred()
    indels = cg.total(F.col("cigar"), "ID")
    return aligned.select(
        "ord", F.col("name").alias("qname"), F.lit("").alias("rg"),
        F.when(~placed, 4).when(F.col("minus"), 16).otherwise(0).alias("flag"), "chrom", F.coalesce("pos", F.lit(-1)).alias("pos"),
        F.coalesce("mapq", F.lit(0)).alias("mapq"), F.coalesce("cigar", F.array().cast(cg.TYPE)).alias("cigar"),
        F.when(F.col("minus"), dna.revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("seq"),
        F.when(F.col("minus"), F.reverse(qual)).otherwise(qual).alias("qual"),
        (F.col("mismatches") + F.col("edits_ag") + F.col("edits_tc") + indels).alias("nm"), "edits_ag", "edits_tc", "mismatches", "margin", "origin",
    )


def _phred() -> Column:
    return F.transform(F.filter(F.split("qual", ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def records_of(reads: DataFrame, told: DataFrame) -> DataFrame:
    """to_records() of reads whose sequences' records are told: read (the sequence) and the columns but names, bases and qualities. Reads that aren't there are unplaced."""
    from helixframe.functions import cigar as cg
    from helixframe.functions import dna

    minus = F.coalesce(F.col("flag").bitwiseAND(16) != 0, F.lit(False))
    own = {
        "qname": F.col("name"), "rg": F.lit(""), "flag": F.coalesce("flag", F.lit(4)), "pos": F.coalesce("pos", F.lit(-1)), "mapq": F.coalesce("mapq", F.lit(0)), "cigar": F.coalesce("cigar", F.array().cast(cg.TYPE)),
        "seq": F.when(minus, dna.revcomp(F.col("seq"))).otherwise(F.col("seq")), "qual": F.when(minus, F.reverse(_phred())).otherwise(_phred()),
    }
    each = reads.select("ord", "name", "seq", "qual").join(told.withColumnRenamed("read", "seq"), "seq", "left")
    return each.select(*[own[c].alias(c) if c in own else F.col(c) for c in RECORD])


def pair_records(records: DataFrame, key: str = "template", slot: str = "slot") -> DataFrame:
    """records of to_records() with a template and a slot (1, 2), as records of pairs: flags of both mates, mate_chrom, mate_pos, tlen.

    One shuffle brings mates together. tlen is 0 unless the pair is proper. A record without its mate in the input stays single.
    """
    from helixframe.operators import pairs

    own = [c for c in records.columns if c != key]
    row = F.struct(*own, (F.col("flag").bitwiseAND(16) != 0).alias("minus"))
    each = records.groupBy(key).agg(F.max_by(F.when(F.col(slot) == 1, row), F.when(F.col(slot) == 1, F.col("ord"))).alias("a"), F.max_by(F.when(F.col(slot) == 2, row), F.when(F.col(slot) == 2, F.col("ord"))).alias("b"))
    t = pairs.relate(each)
    proper = F.coalesce(F.col("proper"), F.lit(False))

    def mate(r, m, bit: int, sign: int):
        both = m.isNotNull()
        unmapped = m["flag"].bitwiseAND(4) != 0
        flag = r["flag"].bitwiseOR(F.when(both, 1 + bit).otherwise(0)).bitwiseOR(F.when(proper, 2).otherwise(0)).bitwiseOR(F.when(both & unmapped, 8).otherwise(0)).bitwiseOR(F.when(both & m["minus"], 32).otherwise(0))
        tlen = F.when(proper, sign * F.col("tlen")).otherwise(0)
        fields = [flag.alias("flag") if c == "flag" else r[c].alias(c) for c in own]
        return F.when(r.isNotNull(), F.struct(*fields, F.when(~unmapped, m["chrom"]).alias("mate_chrom"), F.coalesce(F.when(~unmapped, m["pos"]), F.lit(-1)).cast("long").alias("mate_pos"), tlen.cast("long").alias("tlen")))

    two = F.array_compact(F.array(mate(F.col("a"), F.col("b"), 64, 1), mate(F.col("b"), F.col("a"), 128, -1)))
    return t.select(key, F.explode(two).alias("r")).select(key, "r.*")


def with_mates(records: DataFrame, tiles: DataFrame, width: int, keep: str | None = None) -> DataFrame:
    """records (of to_records(), with template and slot) whose poor ones are looked for around their placed mates, and stand there if that explains more of them.

    Poor records are unplaced, or explain under 0.7 of the read. A place is taken if it explains REFUSED of the read and its four-letter score is above 0 and above the old place's; its quality is
    at most 20, as of any placement that seeds didn't find.
    """
    from helixframe.functions import cigar as cg
    from helixframe.functions import dna
    from helixframe.operators import evidence
    from helixframe.operators.align import second_look

    keep = keep or shared_path(records.sparkSession, "mates")
    unplaced, minus = F.col("flag").bitwiseAND(4) != 0, F.col("flag").bitwiseAND(16) != 0
    covered = cg.total(F.col("cigar"), "MI")
    poor = records.filter(unplaced | (covered < evidence.COVERED * F.length("seq")))
    sequenced = F.when(minus, dna.revcomp(F.col("seq"))).otherwise(F.col("seq"))
    mates = records.filter(~unplaced & (F.col("mapq") > 0)).select("template", (3 - F.col("slot")).alias("slot"), F.col("chrom").alias("mate_chrom"), F.col("pos").alias("mate_pos"))
    wanted = poor.select("ord", "template", "slot", sequenced.alias("seq")).join(mates, ["template", "slot"]).select("ord", "seq", "mate_chrom", "mate_pos")
    found = written(second_look.mate_window(wanted, tiles, width).select("ord", F.col("chrom").alias("n_chrom"), F.col("pos").alias("n_pos"), F.col("minus").alias("n_minus"), F.col("cigar").alias("n_cigar")), f"{keep}/found")
    j = records.join(found, "ord")
    turn = minus != F.col("n_minus")
    values = {
        "flag": F.col("flag").bitwiseAND(~(4 | 16)).bitwiseOR(F.when(F.col("n_minus"), 16).otherwise(0)).cast("int"),
        "seq": F.when(turn, dna.revcomp(F.col("seq"))).otherwise(F.col("seq")), "qual": F.when(turn, F.reverse("qual")).otherwise(F.col("qual")),
        "chrom": F.col("n_chrom"), "pos": F.col("n_pos"), "cigar": F.col("n_cigar"), "margin": F.lit("mate"), "origin": F.when(F.col("n_chrom").startswith("decoy_"), "decoy").otherwise("genome"),
    }
    moved = recount(j.select(*[values[c].alias(c) if c in values else F.col(c) for c in records.columns]), tiles, width)

    def score() -> Column:
        wrong = F.coalesce(F.col("mismatches") + F.col("edits_ag") + F.col("edits_tc"), F.lit(0))
        gaps = F.aggregate("cigar", F.lit(0), lambda a, x: a + F.when(x["op"].isin("I", "D"), k.OPEN + k.EXTEND * x["n"]).otherwise(0))
        return k.MATCH * (cg.total(F.col("cigar"), "M") - wrong) + k.MISMATCH * wrong - gaps

    old = records.select("ord", F.when(unplaced, 0).otherwise(score()).alias("old"))
    odd = F.when(F.col("mismatches") > 2, F.col("mismatches") + F.col("edits_ag") + F.col("edits_tc")).otherwise(F.col("mismatches") + F.least("edits_ag", "edits_tc"))

    def quality(score_: pd.Series, columns: pd.Series, matching: pd.Series, unexplained: pd.Series) -> pd.Series:
        zero = np.zeros(len(score_), dtype=np.int64)
        told = np.column_stack([score_, zero, score_, zero, zero + 11, columns, matching, unexplained, zero + 1, zero - 1])
        return pd.Series(k.qualities(told)[0]).astype("int32")

    own = F.pandas_udf(quality, "int")(score(), cg.total(F.col("cigar"), "MID"), cg.total(F.col("cigar"), "M"), odd)
    better = moved.withColumns({"__score": score(), "__mapq": own}).join(old, "ord").filter((F.col("__score") > 0) & (F.col("__score") > F.col("old")) & (covered >= REFUSED * F.length("seq")))
    better = written(better.select(*[F.col("__mapq").alias(c) if c == "mapq" else c for c in records.columns]), f"{keep}/better")
    return records.join(better.select("ord"), "ord", "left_anti").unionByName(better)


def recount(records: DataFrame, tiles: DataFrame, width: int) -> DataFrame:
    """records with mismatches, edits_ag, edits_tc and nm counted again along their operations; blocks meet the reference by tile join."""
    from helixframe.functions import cigar as cg

    b = records.select("ord", "chrom", F.posexplode(cg.blocks(F.col("pos"), F.col("cigar"))).alias("i", "b"), "seq")
    b = b.select("ord", "chrom", "i", F.col("b.ref").alias("s"), (F.col("b.ref") + F.col("b.n")).alias("e"), F.expr("substring(seq, b.read + 1, b.n)").alias("own"))
    got = tile_sequences(b.drop("own"), tiles, width, ["ord", "i", "s", "e"]).select("ord", "i", F.col("seq").alias("ref"))

    def count(own: pd.Series, ref: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(own, ref):
            x, y = k.codes(x), k.codes(y)
            n = min(len(x), len(y))
            x, y = x[:n], y[:n]
            ag, tc = (y == 0) & (x == 2), (y == 3) & (x == 1)
            out.append((int(((x < 4) & (y < 4) & (x != y) & ~ag & ~tc).sum()), int(ag.sum()), int(tc.sum())))
        return pd.DataFrame(out, columns=["mm", "ag", "tc"])

    counted = b.join(got, ["ord", "i"]).select("ord", F.pandas_udf(count, "mm int, ag int, tc int")("own", "ref").alias("c"))
    sums = counted.groupBy("ord").agg(*[F.sum(f"c.{c}").cast("int").alias(n) for c, n in (("mm", "mismatches"), ("ag", "edits_ag"), ("tc", "edits_tc"))])
    out = records.drop("mismatches", "edits_ag", "edits_tc", "nm").join(sums, "ord").withColumn("nm", F.col("mismatches") + F.col("edits_ag") + F.col("edits_tc") + cg.total(F.col("cigar"), "ID"))
    return out.select(*records.columns)


def micro_deletions(placed: DataFrame, library: DataFrame) -> DataFrame:
    """ord, pos, cigar of records with deletions of up to 50 bases that the library knows as introns."""
    from helixframe.functions import cigar as cg

    short = library.filter(F.col("end") - F.col("start") <= 50).select("chrom", F.col("start").alias("js"), F.col("end").alias("je")).distinct()
    gaps = placed.filter(cg.count(F.col("cigar"), "D") > 0).select("ord", "chrom", "pos", "cigar", F.explode(cg.introns(F.col("pos"), F.col("cigar"), "D")).alias("d"))
    known = gaps.select("*", F.col("d.start").alias("js"), F.col("d.end").alias("je")).join(short, ["chrom", "js", "je"])
    known = known.groupBy("ord").agg(F.any_value("pos").alias("pos"), F.any_value("cigar").alias("c"), F.collect_set("d").alias("known"))
    return known.select("ord", "pos", cg.annotated_micro_deletions(F.col("pos"), F.col("c"), F.col("known")).alias("cigar"))


def looked_again(records: DataFrame, looks: list, tiles: DataFrame, width: int, keep: str | None = None) -> DataFrame:
    """records with what the looks change, one after another: each takes placed records and returns ord, pos, cigar of some of them. Differences are counted again."""
    keep = keep or shared_path(records.sparkSession, "changed")
    placed = records.filter("flag & 4 = 0")
    changed = None
    for i, look in enumerate(looks):
        base = placed if changed is None else placed.join(changed, "ord", "left").select(*[F.coalesce(f"new_{c}", c).alias(c) if c in ("pos", "cigar") else c for c in placed.columns])
        found = look(base).select("ord", F.col("pos").cast("long").alias("new_pos"), F.col("cigar").alias("new_cigar"))
        changed = written(found if changed is None else found.unionByName(changed.join(found.select("ord"), "ord", "left_anti")), f"{keep}/{i}")
    again = records.join(changed, "ord").select(*[F.col(f"new_{c}").alias(c) if c in ("pos", "cigar") else F.col(c) for c in records.columns])
    return records.join(changed.select("ord"), "ord", "left_anti").unionByName(recount(again, tiles, width))


def with_library(records: DataFrame, library: DataFrame, tiles: DataFrame, width: int, keep: str | None = None) -> DataFrame:
    """The second pass: what a library of junctions changes in records, and no more is looked at again.

    Clipped ends that go on behind a known intron are laid over it, or over a short exon between two; blocks that ran through a known
    intron's near side are laid behind it where they fit better; each at the end and at the start. Short deletions that the
    library knows become introns. Other records stay as they are.
    """
    from helixframe.operators.align import second_look, splits

    if library.isEmpty():
        return records
    looks = [lambda r, f=f, side=side: f(r, library, tiles, width, side=side) for f in (second_look.clipped_tails, splits.short_exons, splits.run_through) for side in ("end", "start")]
    return looked_again(records, [*looks, lambda r: micro_deletions(r, library)], tiles, width, keep)


def with_new_introns(records: DataFrame, tiles: DataFrame, width: int, keep: str | None = None, index: DataFrame | None = None, kmer: int = 15, w: int = 10) -> DataFrame:
    """records whose clipped ends go on behind introns that nothing knows of yet, by splice signals and (with an index) seeds."""
    from helixframe.operators.align import splits

    keep = keep or shared_path(records.sparkSession, "new-introns")
    looks = [lambda r, side=side: splits.split_tails(r, tiles, width, side, index, kmer, w, keep=f"{keep}/{side}") for side in ("end", "start")]
    return looked_again(records, looks, tiles, width, keep)


def two_pass(reads: DataFrame, tiles: DataFrame, width: int, annotated: DataFrame, keep: str | None = None, kmer: int = 15, w: int = 10, index: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Maps reads, looks at clipped ends with the annotation and then without, lets the junctions seen vote with it, and looks again at the records that the merged library can change.

    Each sequence is mapped once, however many reads have it (they count in the vote); names and qualities meet what became of it at the end.
    keep: a folder for what several plans read, by default a new one in the shared folder. The
    result reads it: it is the caller's to remove. Returns records and library.
    """
    from helixframe.operators import junctions

    keep = keep or shared_path(reads.sparkSession, "map")
    index = written(kmer_index.minimizer_index(tiles, width, kmer, w), f"{keep}/index") if index is None else index
    once = written(reads.filter("seq <> ''").groupBy("seq").agg(F.count("*").alias("copies")).withColumn("ord", F.monotonically_increasing_id()), f"{keep}/sequences")
    nameless = once.select("ord", F.lit("").alias("name"), "seq", F.lit("").alias("qual"))
    first = written(to_records(align(nameless, tiles, width, kmer, w, index=index, keep=f"{keep}/windows", **options)), f"{keep}/placed")
    first = with_library(first, annotated, tiles, width, f"{keep}/annotated")
    records = written(with_new_introns(first, tiles, width, f"{keep}/new", index, kmer, w), f"{keep}/pass1")
    seen = records.filter("flag & 4 = 0").join(once.select("ord", "copies"), "ord")
    judged, removed = junctions.vote(junctions.observed(seen, "copies"), annotated)
    library = written(junctions.merged_library(annotated, judged, removed), f"{keep}/library")
    last = with_library(records, library, tiles, width, f"{keep}/changed")
    told = last.drop("qname", "rg", "seq", "qual").join(once.select("ord", F.col("seq").alias("read")), "ord").drop("ord")
    # where few sequences differ their table goes to the reads
    return records_of(reads, written(told, f"{keep}/told")), library


#: Reads' letters and the reference's, for each of rescue's passes: a read turned A to G meets a minus strand where T was turned to C.
PASSES = (("AG", "AG"), ("AG", "TC"), ("TC", "TC"), ("TC", "AG"))


def rescue(unplaced: DataFrame, tiles: DataFrame, width: int, kmer: int = 15, w: int = 10, keep: str | None = None, **options) -> DataFrame:
    """Hyperedited reads: reads and reference in three letters, both ways of each, placed there and verified on four letters.

    unplaced: ord, name, seq, qual. Reads that more than one pass accepts are ambiguous and dropped. The two turned references' indexes, the pool and each
    pass are written below keep (by default a new shared path), so each is made once.
    Returns ord, direction, chrom, pos, minus, cigar, mapq (at most 20), sites (reference places of edits).
    """
    from helixframe.functions import dna
    from helixframe.operators.align import second_look

    keep = keep or shared_path(unplaced.sparkSession, "rescue")
    good = F.pandas_udf(lambda s, q: pd.Series([k.rescue_prefilter(a or "", b or "") for a, b in zip(s, q)]).astype(bool), "boolean").asNondeterministic()  # or it is moved before distinct()
    # equal reads (of bases and qualities) fare alike: each is looked at once, and told to all of them at the end
    different = unplaced.select("seq", "qual").distinct().filter(good("seq", "qual")).withColumns({"ord": F.monotonically_increasing_id(), "name": F.lit("")})
    pool = written(different.select("ord", "name", "seq", "qual"), f"{keep}/pool")
    turned = {x: tiles.withColumn("seq", dna.transform_bases(F.col("seq"), *x)) for x in sorted({other for _, other in PASSES})}
    indexes = {x: written(kmer_index.minimizer_index(t, width, kmer, w), f"{keep}/index-{x}") for x, t in turned.items()}
    accepted = None
    for own, other in PASSES:
        reads = pool.withColumns({"true_seq": F.col("seq"), "seq": dna.transform_bases(F.col("seq"), *own)})
        found = align(reads, turned[other], width, kmer, w, index=indexes[other], keep=f"{keep}/windows-{own}-{other}", **options).filter("chrom is not null and mapq >= 1 and mismatches <= 2")
        found = found.select("ord", F.lit(own[0]).alias("direction"), "chrom", "pos", "minus", "cigar", F.least("mapq", F.lit(20)).alias("mapq"), F.col("true_seq").alias("seq"), "qual")
        passed = written(second_look.verify(found, tiles, width).filter("reason is null").drop("reason", "seq", "qual"), f"{keep}/pass-{own}-{other}")
        accepted = passed if accepted is None else accepted.unionByName(passed)
    once = accepted.withColumn("passes", F.count("*").over(Window.partitionBy("ord"))).filter("passes = 1").drop("passes")
    told = written(once.join(pool.select("ord", "seq", "qual"), "ord").drop("ord"), f"{keep}/told")
    return unplaced.select("ord", "seq", "qual").join(told, ["seq", "qual"]).select(*once.columns)


def rescue_records(records: DataFrame, tiles: DataFrame, width: int, paired: bool = False, keep: str | None = None, **options) -> DataFrame:
    """records (of to_records(), or pair_records() with template and slot) with those that rescue could place in their stead; ``re`` tells them.

    The pool: unplaced records, records that explain under 0.7 of the read, and those with a twentieth of the aligned columns or more
    of ordinary mismatches. In pairs a rescued read must stand near its placed mate, in the other direction, and both records' flags, mate places and lengths are told anew.
    """
    from helixframe.functions import cigar as cg
    from helixframe.functions import dna
    from helixframe.operators import evidence, pairs

    aligned, covered = cg.total(F.col("cigar"), "MID"), cg.total(F.col("cigar"), "MI")
    odd = F.coalesce((aligned > 0) & (F.col("mismatches") / aligned >= evidence.DENSITY), F.lit(False))
    unplaced, minus = F.col("flag").bitwiseAND(4) != 0, F.col("flag").bitwiseAND(16) != 0
    pool = records.filter(unplaced | F.coalesce(F.col("origin") != "decoy", F.lit(True)) & ((covered < evidence.COVERED * F.length("seq")) | odd))
    as_read = pool.select("ord", F.col("qname").alias("name"), F.when(minus, dna.revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.array_join(F.transform(F.when(minus, F.reverse("qual")).otherwise(F.col("qual")), lambda q: F.char(q + 33)), "").alias("qual"))
    keep = keep or shared_path(records.sparkSession, "rescued")
    found = rescue(as_read, tiles, width, keep=f"{keep}/passes", **options)
    if paired:
        named = found.join(records.select("ord", "template", "slot"), "ord")
        placed = records.filter("flag & 4 = 0").select("template", "slot", "chrom", "pos", minus.alias("minus"))
        found = pairs.mate_gate(named, placed).filter("concordant").drop("template", "slot", "concordant")
    found = written(found, f"{keep}/found")
    new = found.select("ord", *[F.col(c).alias(f"new_{c}") for c in ("chrom", "pos", "minus", "cigar", "mapq")]).withColumn("re", F.lit("collapsed"))
    j = records.join(new, "ord")
    flag = F.col("flag").bitwiseAND(~(4 | 16)).bitwiseOR(F.when(F.col("new_minus"), 16).otherwise(0))
    turn = minus != F.col("new_minus")
    values = {"flag": flag, "seq": F.when(turn, dna.revcomp(F.col("seq"))).otherwise(F.col("seq")), "qual": F.when(turn, F.reverse("qual")).otherwise(F.col("qual")), **{c: F.col(f"new_{c}") for c in ("chrom", "pos", "cigar", "mapq")}}
    moved = j.select(*[values[c].alias(c) if c in values else F.col(c) for c in records.columns], "re")
    again = recount(moved.drop("re"), tiles, width).withColumn("re", F.lit("collapsed"))
    merged = records.join(new.select("ord"), "ord", "left_anti").withColumn("re", F.lit(None).cast("string")).unionByName(again)
    if not paired:
        return merged
    # what both mates' records say of each other is told anew where one of them was rescued
    touched = records.join(new.select("ord"), "ord", "left_semi").select("template").distinct()
    single = F.col("flag").bitwiseAND(~(1 | 2 | 8 | 32 | 64 | 128)).cast("int").alias("flag")
    pairs_ = merged.join(touched, "template", "left_semi").drop("mate_chrom", "mate_pos", "tlen")
    told = pair_records(pairs_.select(*[single if c == "flag" else c for c in pairs_.columns]))
    return merged.join(touched, "template", "left_anti").unionByName(told.select(*merged.columns))
