"""BAM without native libraries: a reader of ranges and regions, an index, and a part-wise writer.

A file is read in ranges, each by a task of its own: it finds the first block and in it the first record that the
format allows and that whole records follow. With an index, a region is read in the ranges that its bins name. BGZF is gzip of many small
members, so a part written by one task can follow another's.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.sources import bgzf

# Fixed values of the format.
SEQ = "=ACMGRSVTWYHKDBN"
OPS = "MIDNSHP=X"
EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK = 65_000
SCHEMA = "ord long, qname string, rg string, flag int, chrom string, pos long, mapq int, cigar array<struct<op:string,n:int>>, seq string, qual array<int>, mate_chrom string, mate_pos long, tlen int, tags map<string,string>"
WIDTH = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
KIND = {"c": "b", "C": "B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
BATCH = 10_000


class _Stream:
    """Plain bytes of a file in order."""

    def __init__(self, plain: bgzf.Plain):
        self.plain, self.at = plain, 0

    def take(self, n: int) -> bytes:
        out = self.plain.get(self.at, n)
        self.at += len(out)
        return out


def header(s: _Stream, where: str) -> tuple[str, list[tuple[str, int]]]:
    if s.take(4) != b"BAM\1":
        raise ValueError(f"{where}: not a BAM file")
    text = s.take(struct.unpack("<i", s.take(4))[0]).decode("latin-1").rstrip("\0")
    contigs = []
    for _ in range(struct.unpack("<i", s.take(4))[0]):
        name = s.take(struct.unpack("<i", s.take(4))[0])[:-1].decode()
        contigs.append((name, struct.unpack("<i", s.take(4))[0]))
    return text, contigs


def tags(raw: bytes) -> dict[str, str]:
    """Character, whole number and text tags; others are passed over by their width."""
    out, i = {}, 0
    while i + 3 <= len(raw):
        name, kind = raw[i : i + 2].decode(), chr(raw[i + 2])
        i += 3
        if kind in "ZH":
            end = raw.index(0, i)
            out[name] = raw[i:end].decode("latin-1")
            i = end + 1
        elif kind == "A":
            out[name] = chr(raw[i])
            i += 1
        elif kind in "cCsSiI":
            out[name] = str(struct.unpack_from(KIND[kind], raw, i)[0])
            i += WIDTH[kind]
        elif kind == "f":
            i += 4
        elif kind == "B":
            i += 5 + WIDTH[chr(raw[i])] * struct.unpack_from("<i", raw, i + 1)[0]
        else:
            raise ValueError(f"unknown tag type {kind}")
    return out


def decode(raw: bytes, ord_: int, names: list[str]) -> tuple:
    ref, pos, l_name, mapq, _, n_ops, flag, l_seq, mref, mpos, tlen = struct.unpack_from("<iiBBHHHiiii", raw, 0)
    at = 32
    qname = raw[at : at + l_name - 1].decode("latin-1")
    at += l_name
    cigar = [{"op": OPS[x & 15], "n": x >> 4} for x in struct.unpack_from(f"<{n_ops}I", raw, at)]
    at += 4 * n_ops
    packed = raw[at : at + (l_seq + 1) // 2]
    seq = "".join(SEQ[b >> 4] + SEQ[b & 15] for b in packed)[:l_seq]
    at += (l_seq + 1) // 2
    qual = list(raw[at : at + l_seq])
    t = tags(raw[at + l_seq :])
    return (ord_, qname, t.get("RG", ""), flag, names[ref] if ref >= 0 else None, pos, mapq, cigar, seq, qual, names[mref] if mref >= 0 else None, mpos, tlen, t)


def _first(f: bgzf.File, where: str) -> tuple[list[tuple[str, int]], int]:
    """Contigs, and the virtual offset of the first record."""
    s = _Stream(bgzf.Plain(f, 0))
    contigs = header(s, where)[1]
    return contigs, s.plain.offset(s.at)


def plausible(raw: bytes, at: int, lengths: list[int]) -> int | None:
    """Where the record that may begin at a place of raw ends, or None: its fields fit each other and the contigs."""
    if at + 36 > len(raw):
        return None
    size, ref, pos, l_name, _, _, n_ops, flag, l_seq, mref, mpos = struct.unpack_from("<iiiBBHHHiii", raw, at)
    n = len(lengths)
    if not (l_name and -1 <= ref < n and -1 <= mref < n and pos >= -1 and mpos >= -1 and l_seq >= 0 and flag < 1 << 12):
        return None
    if ref >= 0 and pos >= lengths[ref] or mref >= 0 and mpos >= lengths[mref]:
        return None
    fixed = 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq
    if size < fixed or size > 1 << 28:
        return None
    name = raw[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or any(c < 33 or c > 126 for c in name[:-1])):
        return None
    if at + 36 + l_name + 4 * n_ops <= len(raw):
        ops = struct.unpack_from(f"<{n_ops}I", raw, at + 36 + l_name)
        if any(x & 15 > 8 for x in ops) or ops and l_seq and sum(x >> 4 for x in ops if x & 15 in (0, 1, 4, 7, 8)) != l_seq:
            return None
    return at + 4 + size


def _record_start(plain: bgzf.Plain, lengths: list[int], end: int, chain: int = 4) -> int | None:
    """The first place of a record that begins in a block before the file offset end; CHAIN records, or the file's end, must follow it."""
    at = 0
    while plain.need(at + 4):
        if plain.offset(at) >> 16 >= end:
            return None
        place, good = at, 0
        while good < chain:
            plain.need(place + 4)
            if place >= plain.base + len(plain.data):
                break  # the file's end
            size = struct.unpack_from("<i", plain.get(place, 4).ljust(4, b"\xff"))[0]
            if not 32 <= size <= 1 << 28 or not plain.need(place + min(4 + size, 1 << 17)):
                good = -1
                break
            after = plausible(plain.data, place - plain.base, lengths)
            if after is None:
                good = -1
                break
            place, good = after + plain.base, good + 1
        if good >= 0 and place > at:
            return at
        at += 1
    return None


def raw_records(f: bgzf.File, where: str, start: int, end: int, contigs: list[tuple[str, int]] | None = None, first: int | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(virtual offset, the next one's, record) of the records whose block begins in [start, end), from the virtual offset ``first`` on where it is given."""
    if contigs is None:
        contigs, own = _first(f, where)
        if own >> 16 >= start:
            first = own  # the range begins with, or within, the header
    if first is None:
        block = bgzf.first_block(f, start, end)
        if block is None:
            return
        plain = bgzf.Plain(f, block)
        at = _record_start(plain, [n for _, n in contigs], end)
        if at is None:
            return
    else:
        plain, at = bgzf.Plain(f, first >> 16), first & 65_535
    place = plain.offset(at) if plain.need(at + 1) else None
    while place is not None and place >> 16 < end:
        size = plain.get(at, 4)
        if len(size) < 4:
            break
        n = struct.unpack("<i", size)[0]
        raw = plain.get(at + 4, n)
        if len(raw) < n:
            raise ValueError(f"{where}: the last record isn't complete")
        at += 4 + n
        after = plain.offset(at)
        yield place, after, raw
        plain.drop(at)
        place = after if plain.need(at + 1) else None


#: Bytes of a file that one task reads.
SPLIT = 64 << 20


def _frames(rows: Iterator[tuple[int, int, bytes]], names: list[str]) -> Iterator[pd.DataFrame]:
    columns, out = [x.split()[0] for x in SCHEMA.split(", ")], []
    for place, _, raw in rows:
        out.append(decode(raw, place, names))
        if len(out) == BATCH:
            yield pd.DataFrame(out, columns=columns)
            out = []
    if out:
        yield pd.DataFrame(out, columns=columns)


def read_bam(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """Records of SCHEMA; ord is the record's virtual offset, so it tells the file's order. A task reads ``split`` bytes of the file."""
    with bgzf.File(path) as f:
        n = max(1, -(-f.size // split))

    def scan(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                with bgzf.File(path) as f:
                    names = [x for x, _ in _first(f, path)[0]]
                    yield from _frames(raw_records(f, path, i * split, (i + 1) * split), names)

    return spark.range(0, n, 1, n).mapInPandas(scan, SCHEMA)


# ---- index and regions -----------------------------------------------------------------

WINDOW = 14


def build_bai(spark: SparkSession, path: str, split: int = SPLIT) -> str:
    """Writes the index of a sorted file beside it: bins' chunks and the windows' least offsets, gathered by Spark. Returns its path."""
    with bgzf.File(path) as f:
        n, contigs = max(1, -(-f.size // split)), _first(f, path)[0]

    def scan(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                with bgzf.File(path) as f:
                    rows = []
                    for place, after, raw in raw_records(f, path, i * split, (i + 1) * split):
                        ref, pos, l_name, _, bin_, n_ops = struct.unpack_from("<iiBBHH", raw, 0)
                        if ref >= 0 and pos >= 0:
                            ops = struct.unpack_from(f"<{n_ops}I", raw, 32 + l_name)
                            span = sum(x >> 4 for x in ops if x & 15 in (0, 2, 3, 7, 8)) or 1
                            rows.append((ref, bin_, pos >> WINDOW, (pos + span - 1) >> WINDOW, place, after))
                        if len(rows) == BATCH:
                            yield pd.DataFrame(rows, columns=["ref", "bin", "w0", "w1", "a", "b"])
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=["ref", "bin", "w0", "w1", "a", "b"])

    each = spark.range(0, n, 1, n).mapInPandas(scan, "ref int, bin int, w0 long, w1 long, a long, b long")
    # a bin's records stand close together in a sorted file: one chunk for each of its stretches of blocks
    chunks = each.groupBy("ref", "bin", F.shiftright("a", 36).alias("part")).agg(F.min("a").alias("a"), F.max("b").alias("b")).persist()
    windows = each.select("ref", F.explode(F.sequence("w0", "w1")).alias("w"), "a").groupBy("ref", "w").agg(F.min("a").alias("a"))
    # the index of a file: at most a few rows for each 16,384 bases of the reference
    by_ref: dict[int, tuple[dict, dict]] = {}
    for r in chunks.orderBy("ref", "bin", "part").toLocalIterator():
        by_ref.setdefault(r["ref"], ({}, {}))[0].setdefault(r["bin"], []).append((r["a"], r["b"]))
    for r in windows.toLocalIterator():
        by_ref[r["ref"]][1][r["w"]] = r["a"]
    chunks.unpersist()
    out = [b"BAI\1", struct.pack("<i", len(contigs))]
    for ref in range(len(contigs)):
        bins, least = by_ref.get(ref, ({}, {}))
        out.append(struct.pack("<i", len(bins)))
        for bin_, own in sorted(bins.items()):
            out += [struct.pack("<Ii", bin_, len(own)), *[struct.pack("<QQ", a, b) for a, b in own]]
        size, last = max(least, default=-1) + 1, 0
        line = []
        for w in range(size):
            last = least.get(w, last)
            line.append(last)
        out += [struct.pack("<i", size), struct.pack(f"<{size}Q", *line)]
    from helixframe.sources.files import write_bytes

    write_bytes(f"{path}.bai", b"".join(out))
    return f"{path}.bai"


def bins_of(begin: int, end: int) -> set[int]:
    """Bins that may hold records of [begin, end)."""
    return {0} | {first + i for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)) for i in range(begin >> shift, ((end - 1) >> shift) + 1)}


def region_chunks(index: bytes, ref: int, begin: int, end: int) -> list[tuple[int, int]]:
    """Merged ranges of virtual offsets that hold all records of [begin, end) of a contig."""
    if index[:4] != b"BAI\1":
        raise ValueError("not a BAM index")
    at, wanted, found, least = 8, bins_of(begin, end), [], 0
    for i in range(struct.unpack_from("<i", index, 4)[0]):
        n = struct.unpack_from("<i", index, at)[0]
        at += 4
        for _ in range(n):
            bin_, k = struct.unpack_from("<Ii", index, at)
            at += 8
            if i == ref and bin_ in wanted:
                found += [struct.unpack_from("<QQ", index, at + 16 * j) for j in range(k)]
            at += 16 * k
        n = struct.unpack_from("<i", index, at)[0]
        if i == ref and begin >> WINDOW < n:
            least = struct.unpack_from("<Q", index, at + 4 + 8 * (begin >> WINDOW))[0]
        at += 4 + 8 * n
        if i == ref:
            break
    out: list[tuple[int, int]] = []
    for a, b in sorted((max(a, least), b) for a, b in found if b > least):
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def check_index(path: str) -> str:
    """The index beside a BAM file; an error tells what is missing, or older than the file."""
    from helixframe.sources import files

    if not files.exists(path):
        raise ValueError(f"{path}: there is no such file")
    name = next((x for x in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai") if files.exists(x)), None)
    if name is None:
        raise ValueError(f"{path}: it has no index beside it")
    if files.modified(name) < files.modified(path):
        raise ValueError(f"{name}: older than the file it stands for")
    return name


def read_region(spark: SparkSession, path: str, regions: list[tuple[str, int, int]]) -> DataFrame:
    """Records of SCHEMA that overlap some region (contig, begin, end), each once, read through the index: only the blocks that its bins name."""
    from helixframe.functions import cigar as cg
    from helixframe.sources import files

    index = b"".join(files.open_stream(check_index(path)))
    with bgzf.File(path) as f:
        number = {x: i for i, (x, _) in enumerate(_first(f, path)[0])}
    ranges = sorted({r for c, a, b in regions if c in number and b > a for r in region_chunks(index, number[c], a, b)})
    merged: list[tuple[int, int]] = []
    for a, b in ranges:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    n = max(1, len(merged))

    def scan(frames):
        for ids in frames:
            for i in ids["id"].tolist():
                if i < len(merged):
                    with bgzf.File(path) as f:
                        a, b = merged[i]
                        contigs = _first(f, path)[0]
                        rows = (x for x in raw_records(f, path, 0, (b >> 16) + 1, contigs, a) if x[0] < b)
                        yield from _frames(rows, [x for x, _ in contigs])

    found = spark.range(0, n, 1, n).mapInPandas(scan, SCHEMA)
    end = F.greatest(cg.ref_end(F.col("pos"), F.col("cigar")), F.col("pos") + 1)
    inside = F.lit(False)
    for c, a, b in regions:
        inside = inside | ((F.col("chrom") == c) & (F.col("pos") < b) & (end > a))
    return found.filter(inside)


def bam_contigs(path: str) -> list[tuple[str, int]]:
    with bgzf.File(path) as f:
        return _first(f, path)[0]


# ---- writing -------------------------------------------------------------------------


def header_bytes(contigs: list[tuple[str, int]], sort: str = "coordinate") -> bytes:
    text = "".join([f"@HD\tVN:1.6\tSO:{sort}\n", *[f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in contigs]]).encode()
    out = [b"BAM\1", struct.pack("<i", len(text)), text, struct.pack("<i", len(contigs))]
    for n, k in contigs:
        out += [struct.pack("<i", len(n) + 1), n.encode() + b"\0", struct.pack("<i", k)]
    whole = b"".join(out)
    return b"".join(bgzf.packed(whole[i : i + BLOCK]) for i in range(0, len(whole), BLOCK))


def bin_of(begin: int, end: int) -> int:
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if begin >> shift == end >> shift:
            return first + (begin >> shift)
    return 0


def encode(qname, flag, ref, pos, mapq, cigar, seq, qual, mref, mpos, tlen, tag_items) -> bytes:
    """A record; unplaced ones have mapping quality 255."""
    span = sum(n for op, n in cigar if op in "MDN=X") or 1
    name = qname.encode("latin-1") + b"\0"
    code = np.array([SEQ.find(c) if c in SEQ else 15 for c in seq.upper()] + [0] * (len(seq) % 2), dtype=np.uint8)
    packed = (code[0::2] << 4 | code[1::2]).tobytes()
    extra = []
    for k, v in tag_items:
        if isinstance(v, int):
            extra.append(k.encode() + b"i" + struct.pack("<i", v))
        else:
            extra.append(k.encode() + (b"A" if k == "XS" and len(v) == 1 else b"Z") + v.encode("latin-1") + (b"" if k == "XS" and len(v) == 1 else b"\0"))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), 255 if flag & 4 else mapq, bin_of(max(pos, 0), max(pos, 0) + span), len(cigar), flag, len(seq), mref, mpos, tlen)
    body += name + b"".join(struct.pack("<I", n << 4 | OPS.index(op)) for op, n in cigar) + packed + bytes(min(max(q, 0), 255) for q in qual) + b"".join(extra)
    return struct.pack("<i", len(body)) + body


TAGS = ("NM", "NH", "XS", "EA", "EK", "RE")


def write_bam(records: DataFrame, contigs: list[tuple[str, int]], folder: str) -> list[str]:
    """Writes the partitions of records, in their order, as BGZF parts in folder, a block at a time. Returns header, parts and end: joined, they are one BAM file."""
    number = {n: i for i, (n, _) in enumerate(contigs)}
    have = [c for c in TAGS if c in records.columns]

    def write(frames):
        first, out = None, None
        for f in frames:
            for r in f.to_dict("records"):
                if out is None:
                    first, name = r["__p"], f"{folder}/part-{r['__p']:08d}-{uuid.uuid4().hex}.bgzf"
                    out = bgzf.Writer(name, BLOCK)
                items = [(c, int(r[c]) if c in ("NM", "NH", "EA") else r[c]) for c in have if r[c] is not None and r[c] == r[c]]
                ref = number.get(r["chrom"], -1)
                out.write(encode(r["qname"], int(r["flag"]), ref, int(r["pos"]) if ref >= 0 else -1, int(r["mapq"]), [(x["op"], x["n"]) for x in r["cigar"]], r["seq"], r["qual"], number.get(r.get("mate_chrom"), -1), int(r.get("mate_pos") if r.get("mate_pos") is not None else -1), int(r.get("tlen") or 0), items))
        if out is not None:
            out.close()
            yield pd.DataFrame({"p": [first], "path": [name]})

    from helixframe.sources.files import write_bytes

    parts = records.withColumn("__p", F.spark_partition_id()).mapInPandas(write, "p int, path string").collect()  # a row a partition
    write_bytes(f"{folder}/header.bgzf", header_bytes(contigs))
    write_bytes(f"{folder}/end.bgzf", EOF)
    return [f"{folder}/header.bgzf", *[r["path"] for r in sorted(parts)], f"{folder}/end.bgzf"]


def join_parts(paths: list[str], target: str) -> None:
    """One file of the parts, streamed."""
    from helixframe.sources.files import copy_into

    copy_into(paths, target)
