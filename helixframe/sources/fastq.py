"""FASTQ and FASTA: readers of ranges, fetches by index, and sinks.

Plain and BGZF files are read in ranges, a task each, which find the first record by itself; other gz files don't split and
are streamed by one task. Numbers of records (or bases) before a range come from a first pass that counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.sources import bgzf
from helixframe.sources.lines import SPLIT, lines, ranges

READS = "lane int, ord long, mate int, name string, seq string, qual string"
#: Records that are passed on at once.
BATCH = 20_000


def records(rows: Iterator[tuple[bool, bytes]], where: str, strict: bool = True, number: int = 0, synced: bool = True) -> Iterator[tuple[str, str, str]]:
    """(header without @, bases, qualities) of the records that begin within the range; errors name the file and line.

    number: records before the range. synced: the first line is a record's; else up to three lines are passed over: a
    record begins where a line with @ is followed, two lines on, by one with +, as bases have neither.
    """
    rows = iter(rows)
    ahead: list[tuple[bool, str]] = []

    def fill(n: int) -> list[tuple[bool, str]]:
        while len(ahead) < n:
            row = next(rows, None)
            if row is None:
                break
            ahead.append((row[0], row[1].rstrip(b"\r").decode("latin-1")))
        return ahead[:n]

    if not synced:
        for _ in range(3):
            three = fill(3)
            if len(three) < 3 or three[0][1].startswith("@") and three[2][1].startswith("+"):
                break
            ahead.pop(0)
    while four := fill(4):
        if not four[0][0]:
            return
        if len(four) < 4:
            raise ValueError(f"{where}:{4 * number + len(four)}: the last record isn't complete")
        del ahead[:4]
        at, plus = four[0][1], four[2][1]
        if not at.startswith("@") or not plus.startswith("+"):
            raise ValueError(f"{where}:{4 * number + 1}: not a FASTQ record")
        if len(four[1][1]) != len(four[3][1]):
            raise ValueError(f"{where}:{4 * number + 4}: {len(four[1][1])} bases and {len(four[3][1])} qualities")
        if strict and not at[1:].split():
            raise ValueError(f"{where}:{4 * number + 1}: a record without a name")
        number += 1
        yield at[1:], four[1][1], four[3][1]


def _range_counts(spark: SparkSession, path: str, n: int, split: int) -> list[int]:
    """Records that begin in each range: a number a range comes to the driver."""

    def count(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                with bgzf.File(path) as f:
                    yield pd.DataFrame({"i": [i], "n": [sum(1 for _ in records(lines(f, i * split, (i + 1) * split), path, False, synced=i == 0))]})

    found = dict(map(tuple, spark.range(0, n, 1, n).mapInPandas(count, "i long, n long").collect()))
    return [found.get(i, 0) for i in range(n)]


def read_lane(spark: SparkSession, path: str, lane: int, mate: int, first_token: bool = False, split: int = SPLIT) -> DataFrame:
    """READS of one file; ord counts its records from 0."""
    n = ranges(path, split)
    before = [0]
    for x in _range_counts(spark, path, n, split) if n > 1 else ():
        before.append(before[-1] + x)

    def decode(frames):
        columns = [x.split()[0] for x in READS.split(", ")]
        for ids in frames:
            for i in ids["id"].tolist():
                with bgzf.File(path) as f:
                    rows, at = [], before[i]
                    part = lines(f, i * split, (i + 1) * split) if n > 1 else lines(f)
                    for name, seq, qual in records(part, path, number=at, synced=i == 0):
                        rows.append((lane, at, mate, name.split()[0] if first_token else name, seq, qual))
                        at += 1
                        if len(rows) == BATCH:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    return spark.range(0, n, 1, n).mapInPandas(decode, READS)


def read_fastq(spark: SparkSession, first: list[str], second: list[str] | None = None, first_token: bool = False, split: int = SPLIT) -> DataFrame:
    """lane, ord, mate, name, seq, qual of lanes in the given order; mates pair by (lane, ord). first_token: names end at white space. split: bytes of a file a task."""
    if second and len(second) != len(first):
        raise ValueError("each lane has both mates")
    out = None
    for mate, paths in ((1, first), (2, second or [])):
        for lane, path in enumerate(paths):
            own = read_lane(spark, path, lane, mate, first_token, split)
            out = own if out is None else out.unionByName(own)
    return out


def fastq_lines(reads: DataFrame, mark: bool = False) -> DataFrame:
    """lane, ord, mate, line (four lines in one). mark: names end in /1 or /2."""
    name = F.concat("name", F.lit("/"), F.col("mate").cast("string")) if mark else F.col("name")
    return reads.select("lane", "ord", "mate", F.concat(F.lit("@"), name, F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual")).alias("line"))


def write_fastq(reads: DataFrame, path: str, mark: bool = False) -> None:
    """gz parts in order of lane and record; their concatenation is one FASTQ file, as gz members may follow each other."""
    fastq_lines(reads, mark).orderBy("lane", "ord", "mate").select("line").write.mode("overwrite").option("compression", "gzip").text(path)


# ---- FASTA ---------------------------------------------------------------------------


#: Letters that stay; other capitals are N, the rest n.
_BASES = bytes(c if chr(c) in "ACGTacgt" else ord("N") if chr(c).isupper() else ord("n") for c in range(256))


def _contig_name(line: bytes, where: str) -> str:
    name = line[1:].decode("latin-1").split()
    if not name:
        raise ValueError(f"{where}: a contig without a name")
    return name[0]


def _fasta_pieces(path: str, i: int, n: int, split: int) -> Iterator[tuple[str | None, bytes]]:
    """(name, None) where a contig begins in the range, (None, bases) of its lines; white space in sequences goes."""
    with bgzf.File(path) as f:
        for inside, line in lines(f, i * split, (i + 1) * split) if n > 1 else lines(f):
            if not inside:
                return
            if line.startswith(b">"):
                yield _contig_name(line, path), b""
            elif bases := b"".join(line.split()):
                yield None, bases


def _fasta_layout(spark: SparkSession, path: str, n: int, split: int) -> tuple[list[list[tuple[int, int]]], list[tuple[str, int]]]:
    """For each range its stretches as (contig, bases before them), and the contigs with their lengths. A row for each contig and range comes to the driver."""

    def count(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                found: list[list] = [[i, 0, None, 0]]
                for name, bases in _fasta_pieces(path, i, n, split):
                    if name is not None:
                        found.append([i, len(found), name, 0])
                    found[-1][3] += len(bases)
                yield pd.DataFrame(found, columns=["i", "k", "name", "n"])

    contigs: list[list] = []
    layout: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for r in sorted(map(tuple, spark.range(0, n, 1, n).mapInPandas(count, "i long, k long, name string, n long").collect())):
        if r[2] is not None:
            contigs.append([r[2], 0])
        if contigs:
            layout[r[0]].append((len(contigs) - 1, contigs[-1][1]))
            contigs[-1][1] += r[3]
        elif r[3]:
            raise ValueError(f"{path}: sequence before the first header")
        else:
            layout[r[0]].append((-1, 0))
    if not contigs:
        raise ValueError(f"{path}: no contigs")
    if len({c for c, _ in contigs}) < len(contigs):
        raise ValueError(f"{path}: a contig's name is there twice")
    return layout, [tuple(c) for c in contigs]


def read_fasta(spark: SparkSession, path: str, width: int = 1 << 16, keep_case: bool = False, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """contigs (cid, name, len) in order, and tiles (chrom, start, seq) of one width. Names end at white space; what isn't ACGT is N, in upper case unless keep_case.

    A task reads ``split`` bytes: a first pass tells where in its contig each range begins, and tiles that ranges share are put together by a shuffle.
    """
    n = ranges(path, split)
    layout, contigs = _fasta_layout(spark, path, n, split)

    def decode(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                rows, held, size = [], [], 0
                k, (cid, at) = 0, layout[i][0] if layout[i] else (-1, 0)

                def cut(last: bool, cid: int):
                    nonlocal held, size, at
                    bases = b"".join(held).translate(_BASES)
                    bases = bases if keep_case else bases.upper()
                    done = 0
                    while done < len(bases):
                        room = width - (at + done) % width
                        if len(bases) - done < room and not last:
                            break
                        part = bases[done : done + room]
                        rows.append((contigs[cid][0], (at + done) // width * width, at + done, part.decode()))
                        done += len(part)
                    at += done
                    held, size = [bases[done:]], len(bases) - done

                for name, bases in _fasta_pieces(path, i, n, split):
                    if name is not None:
                        cut(True, cid)
                        k += 1
                        cid, at = layout[i][k]
                        held, size = [], 0
                        if not contigs[cid][1]:
                            rows.append((name, 0, 0, ""))
                    held.append(bases)
                    size += len(bases)
                    if size >= 4 * width:
                        cut(False, cid)
                    if len(rows) >= 64:
                        yield pd.DataFrame(rows, columns=["chrom", "start", "at", "part"])
                        rows = []
                cut(True, cid)
                yield pd.DataFrame(rows, columns=["chrom", "start", "at", "part"])

    each = spark.range(0, n, 1, n).mapInPandas(decode, "chrom string, start long, at long, part string")
    if n == 1:
        tiles = each.select("chrom", "start", F.col("part").alias("seq"))
    else:
        tiles = each.groupBy("chrom", "start").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("p")).select("chrom", "start", F.array_join(F.transform("p", lambda x: x["part"]), "").alias("seq"))
    return spark.createDataFrame([(i, c, x) for i, (c, x) in enumerate(contigs)], "cid int, name string, len long"), tiles


def fetch(spark: SparkSession, path: str, regions: DataFrame, index: DataFrame, keep_case: bool = False) -> DataFrame:
    """regions (chrom, s, e, and others) with seq, read at the places that an index (read_fai) gives: only their bytes, of a plain file. Bases beyond a contig are left out."""
    kinds, names = ", ".join(f"`{c}` {t}" for c, t in regions.dtypes) + ", seq string", [*regions.columns, "seq"]

    def run(frames):
        with bgzf.File(path) as f:
            for rows in frames:
                out = []
                for s, e, size, offset, line, line_bytes in zip(*(rows[c].tolist() for c in ("s", "e", "__len", "__offset", "__line", "__bytes"))):
                    s, e = max(s, 0), min(e, size)
                    if e <= s:
                        out.append("")
                        continue
                    place = lambda x, o=offset, n=line, b=line_bytes: o + x // n * b + x % n
                    bases = b"".join(f.read(place(s), place(e - 1) + 1 - place(s)).split()).translate(_BASES)
                    out.append((bases if keep_case else bases.upper()).decode())
                rows["seq"] = out
                yield rows[names]

    own = index.select(F.col("name").alias("chrom"), F.col("len").alias("__len"), F.col("offset").alias("__offset"), F.col("line").alias("__line"), F.col("line_bytes").alias("__bytes"))
    return regions.join(F.broadcast(own), "chrom").select(*regions.columns, "__len", "__offset", "__line", "__bytes").mapInPandas(run, kinds)  # a row a contig


def build_fai(spark: SparkSession, path: str, split: int = SPLIT) -> list[str]:
    """Index lines of a plain FASTA file, whatever its line lengths are; lines of a contig must have one length, but for the last."""

    def scan(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                with bgzf.File(path) as f:
                    at = i * split
                    if at:
                        while (b := f.read(at - 1, 1)) and b != b"\n":
                            at += 1
                    rows = []
                    for inside, line in lines(f, i * split, (i + 1) * split):
                        if not inside:
                            break
                        if line.startswith(b">"):
                            rows.append((at, _contig_name(line, path), 0, 0, 0))
                        else:
                            bases = len(line.rstrip(b"\r"))
                            if rows and rows[-1][1] is None and rows[-1][3] == bases and rows[-1][4] == len(line) + 1:
                                rows[-1] = (*rows[-1][:2], rows[-1][2] + 1, *rows[-1][3:])
                            elif line:
                                rows.append((at, None, 1, bases, len(line) + 1))
                        at += len(line) + 1
                    yield pd.DataFrame(rows, columns=["at", "name", "n", "bases", "size"])

    n = ranges(path, split)
    # a row for each run of lines of one length: two a contig and range
    runs = sorted(map(tuple, spark.range(0, n, 1, n).mapInPandas(scan, "at long, name string, n long, bases long, size long").collect()))
    out: list[list] = []
    for at, name, k, bases, size in runs:
        if name is not None:
            out.append([name, 0, None, 0, 0, False])
            continue
        c = out[-1]
        if c[2] is None:
            c[2:5] = [at, bases, size]
        elif c[5] or bases > c[3]:
            raise ValueError(f"{path}: lines of {c[0]} differ in length")
        c[5] = c[5] or bases < c[3]
        if c[5] and k > 1:
            raise ValueError(f"{path}: lines of {c[0]} differ in length")
        c[1] += k * bases
    return ["\t".join(map(str, (c[0], c[1], c[2] or 0, c[3], c[4]))) for c in out]


def fai_lines(contigs: list[tuple[str, int]], line: int = 60) -> list[str]:
    """Index lines of a FASTA file written with so many bases a line."""
    out, at = [], 0
    for name, n in contigs:
        at += len(name) + 2
        out.append(f"{name}\t{n}\t{at}\t{min(line, n)}\t{min(line, n) + 1}")
        at += n + -(-n // line)
    return out


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.text(path).filter("value <> ''").select(F.split("value", "\t").alias("f"))
    return t.select(F.get("f", 0).alias("name"), F.get("f", 1).cast("long").alias("len"), F.get("f", 2).cast("long").alias("offset"), F.get("f", 3).cast("int").alias("line"), F.get("f", 4).cast("int").alias("line_bytes"))


def with_decoys(contigs: DataFrame, decoys: DataFrame) -> DataFrame:
    """Contigs and decoys, which are told by their prefix."""
    return contigs.unionByName(decoys.withColumn("name", F.concat(F.lit("decoy_"), "name")))
