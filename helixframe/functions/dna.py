"""Bases, k-mers, minimizers, codons and splice signals.

Column functions stay in Spark's own expressions; the generators (minimizers)
and 64-bit wrapping hashes are numpy kernels for Arrow UDFs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bases' order, and the standard genetic code in TCAG order.
BASES = "ACGT"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


# ---- complements ---------------------------------------------------------------------


def revcomp(seq: Column) -> Column:
    """Reverse complement; case is kept and other symbols pass through."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def revcomp_strict(seq: Column) -> Column:
    """Reverse complement in upper case, everything but ACGT as N (alignment records)."""
    return F.reverse(F.translate(F.regexp_replace(F.upper(seq), "[^ACGT]", "N"), "ACGT", "TGCA"))


def complement(base: Column) -> Column:
    """Complement of an upper-case base, else N."""
    return F.when(base.isin(*BASES), F.translate(base, "ACGT", "TGCA")).otherwise("N")


def transform_bases(seq: Column, source: str, target: str) -> Column:
    """Collapses one base into another in both cases, as A to G for editing-blind matching."""
    return F.translate(seq, source.upper() + source.lower(), target.upper() + target.lower())


# ---- k-mers --------------------------------------------------------------------------


def kmers(seq: Column, k: int) -> Column:
    """All k-mers of ACGT only, as array<struct<pos int, kmer string>> in upper case."""
    n = F.length(seq) - k + 1
    places = F.when(n >= 1, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    each = F.transform(places, lambda i: F.struct(i.alias("pos"), F.upper(F.substring(seq, i + 1, F.lit(k))).alias("kmer")))
    return F.filter(each, lambda x: x["kmer"].rlike("^[ACGT]+$"))


def kmer_code(kmer: Column) -> Column:
    """2-bit code of up to 31 bases, the first base highest."""
    return F.conv(F.translate(F.upper(kmer), "ACGT", "0123"), 4, 10).cast("long")


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(F.upper(kmer), revcomp(F.upper(kmer)))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on unsigned 64-bit words (fixed constants)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Rows of a batch that minimizer_rows() hands on.
ROWS = 1 << 16
#: Bases of one block of minimizers_of: some 16 MB a matrix of words.
CELLS = 1 << 21
_CODE = np.full(256, 4, dtype=np.uint64)
for _i, _b in enumerate(BASES):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _i


def minimizers_of(seqs: list[str], k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, canonical k-mer, position and strand (true: minus) of the least hash in every w windows of each sequence.

    Leftmost on ties, each place once, in order of row and place. Sequences of one length are one matrix; a block has a bounded number of cells.
    """
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(seqs):
        by_length.setdefault(len(s), []).append(i)
    found = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool))]
    for length, own in by_length.items():
        if length < k:
            continue
        step = max(1, CELLS // length)
        found += [_block(np.array(own[i : i + step]), [seqs[x] for x in own[i : i + step]], k, w) for i in range(0, len(own), step)]
    rows, kmer, at, minus = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(rows, kind="stable")
    return rows[order], kmer[order], at[order], minus[order]


def _block(own: np.ndarray, seqs: list[str], k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """minimizers_of sequences of one length; own: their rows."""
    code = _CODE[np.frombuffer("".join(seqs).encode("ascii", "replace"), dtype=np.uint8).reshape(len(seqs), -1)]
    n = code.shape[1] - k + 1
    bad = np.cumsum(np.pad(code == 4, ((0, 0), (1, 0))), axis=1)
    good = bad[:, k:] == bad[:, :n]
    base = np.minimum(code, np.uint64(3))
    forward, backward = np.zeros((len(seqs), n), dtype=np.uint64), np.zeros((len(seqs), n), dtype=np.uint64)
    for j in range(k):
        forward = (forward << np.uint64(2)) | base[:, j : j + n]
        backward |= (np.uint64(3) - base[:, j : j + n]) << np.uint64(2 * j)
    kmer = np.minimum(forward, backward)
    key = np.where(good, mix64(kmer), np.uint64(0xFFFFFFFFFFFFFFFF))
    span = min(w, n)
    least = np.lib.stride_tricks.sliding_window_view(key, span, axis=1).argmin(axis=2) + np.arange(n - span + 1)
    flat = (least + np.arange(len(seqs))[:, None] * n).ravel()
    flat = flat[good.ravel()[flat]]
    flat = flat[np.concatenate(([True], flat[1:] != flat[:-1]))] if len(flat) else flat
    return own[flat // n], kmer.ravel()[flat], flat % n, (backward < forward).ravel()[flat]


def minimizers(seq: str, k: int, w: int) -> list[tuple[int, int, bool]]:
    """minimizers_of() one sequence: (canonical k-mer, position, on the minus strand)."""
    _, kmer, at, minus = minimizers_of([seq], k, w)
    return list(zip(kmer.tolist(), at.tolist(), minus.tolist()))


def minimizers_col(seq: Column, k: int, w: int) -> Column:
    """minimizers() of a column, as array<struct<kmer long, pos int, minus boolean>>."""

    def f(s: pa.Array) -> pa.Array:
        rows, kmer, at, minus = minimizers_of([x or "" for x in s.to_pylist()], k, w)
        ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(s)))))
        each = pa.StructArray.from_arrays([pa.array(kmer.astype(np.int64)), pa.array(at.astype(np.int32)), pa.array(minus)], ["kmer", "pos", "minus"])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), each)

    return F.arrow_udf(f, "array<struct<kmer long, pos int, minus boolean>>")(seq)


def minimizer_rows(reads: DataFrame, key: str, k: int, w: int) -> DataFrame:
    """key, size (of the sequence), kmer, pos, minus: a row a minimizer of the reads' seq. With w of 1 every k-mer of ACGT, with its canonical code (k up to 31)."""
    kind = reads.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seqs = [x or "" for x in b.column("seq").to_pylist()]
            rows, kmer, at, minus = minimizers_of(seqs, k, w)
            size = np.array([len(x) for x in seqs], dtype=np.int32)
            for i in range(0, len(rows), ROWS):
                own = rows[i : i + ROWS]
                yield pa.record_batch([b.column(key).take(pa.array(own)), pa.array(size[own]), pa.array(kmer[i : i + ROWS].astype(np.int64)), pa.array(at[i : i + ROWS].astype(np.int32)), pa.array(minus[i : i + ROWS])], names=[key, "size", "kmer", "pos", "minus"])

    return reads.select(key, "seq").mapInArrow(run, f"{key} {kind}, size int, kmer long, pos int, minus boolean")


def kmer_codes(reads: DataFrame, k: int) -> DataFrame:
    """code, n: canonical 2-bit codes of k-mers of ACGT in the reads' seq, k up to 31. Counted in each batch, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, kmer, _, _ = minimizers_of([x or "" for x in b.column("seq").to_pylist()], k, 1)
            code, n = np.unique(kmer, return_counts=True)
            yield pa.record_batch([pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"])

    return reads.select("seq").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def kmer_counts(reads: DataFrame, k: int) -> DataFrame:
    """kmer (canonical text), n: k-mers of ACGT in the reads' seq, k up to 31."""
    return kmer_codes(reads, k).select(kmer_text(F.col("code"), k).alias("kmer"), "n")


def kmer_text(code: Column, k: int) -> Column:
    """The k-mer of a 2-bit code."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


# ---- codons --------------------------------------------------------------------------


def amino_acid(codon: Column) -> Column:
    """One-letter amino acid of a codon; null unless three of ACGT."""
    at = F.conv(F.translate(F.upper(codon), "TCAG", "0123"), 4, 10).cast("int")
    return F.when(F.upper(codon).rlike("^[ACGT]{3}$"), F.substring(F.lit(AMINO_ACIDS), at + 1, F.lit(1)))


# ---- editing and splicing --------------------------------------------------------------


def edit_alt(ref: Column) -> Column:
    """Base that editing yields: G at A, C at T (the minus strand), else null."""
    return F.when(ref == "A", "G").when(ref == "T", "C")


def edit_strand(ref: Column) -> Column:
    return F.when(ref == "A", "+").when(ref == "T", "-").otherwise(".")


def is_free_edit(ref: Column, read: Column) -> Column:
    """Mismatches that editing explains: A read as G, T read as C."""
    return ((ref == "A") & (read == "G")) | ((ref == "T") & (read == "C"))


def splice_signal(donor: Column, acceptor: Column, minus: Column) -> Column:
    """GT-AG, GC-AG, AT-AC or none, of the intron's first and last two bases on the plus strand."""
    d = F.when(minus, revcomp(F.upper(acceptor))).otherwise(F.upper(donor))
    a = F.when(minus, revcomp(F.upper(donor))).otherwise(F.upper(acceptor))
    pair = F.concat(d, F.lit("-"), a)
    return F.when(pair.isin("GT-AG", "GC-AG", "AT-AC"), pair).otherwise("none")


def splice_score(signal: Column) -> Column:
    """4, 2, 1, else -8."""
    return F.when(signal == "GT-AG", 4).when(signal == "GC-AG", 2).when(signal == "AT-AC", 1).otherwise(-8)


def intron_penalty(length: Column) -> Column:
    """8 times the decades that the length is from 1000, cut to an integer."""
    return (F.lit(8.0) * F.abs(F.log10(length.cast("double")) - 3.0)).cast("int")


def splice_supported(length: Column, signal: Column, support: Column) -> Column:
    """Short introns and odd signals need annotated or observed support."""
    return ((length >= 50) | (support > 0)) & ((signal != "none") | (support > 0))


# ---- names ---------------------------------------------------------------------------


def template_name(qname: Column) -> Column:
    """Read name without a mate mark."""
    return F.regexp_replace(qname, "/[12]$", "")


def first_token(name: Column) -> Column:
    return F.regexp_extract(name, r"^([^ \t]*)", 1)


def two_colour_instrument(name: Column) -> Column:
    """First field of the header if it names a two-colour instrument, else null."""
    token = F.regexp_extract(name, r"^([^ :]*)", 1)
    hit = token.rlike("^A0[0-9]") | token.startswith("NS5") | token.startswith("NB5") | name.contains("NextSeq") | name.contains("NovaSeq")
    return F.when((token != "") & hit, token)
