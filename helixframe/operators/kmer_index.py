"""K-mer and minimizer indexes as tables, and the joins that look them up.

An index is a table (kmer, chrom, pos, minus) clustered by k-mer. The mapper leaves frequent
k-mers out of its first round by a cutoff that comes from the counts, and out of its second by
a fixed one, so the rows a repeat can bring to one key of the join have a bound. The reference is read in tiles that overlap by k - 1 (or a window), never whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import dna
from helixframe.session import shared_path, written

# Fixed value: the share of distinct k-mers that counts as frequent.
FREQUENT = 0.0002
MOST_IN_TRANSCRIPTS = 100


def overlapping(tiles: DataFrame, width: int, extra: int) -> DataFrame:
    """tiles (chrom, start, seq) of one width, each with the first ``extra`` bases of the next: chrom, start, seq, own (its own length)."""
    t = tiles.select("chrom", F.floor(F.col("start") / width).alias("t"), "start", "seq")
    after = t.select("chrom", (F.col("t") - 1).alias("t"), F.substring("seq", 1, extra).alias("more"))
    return t.join(after, ["chrom", "t"], "left").select("chrom", "start", F.concat("seq", F.coalesce("more", F.lit(""))).alias("seq"), F.length("seq").alias("own"))


def kmer_index(tiles: DataFrame, width: int, k: int) -> DataFrame:
    """kmer (canonical text), chrom, pos, minus: every k-mer of ACGT."""
    t = overlapping(tiles, width, k - 1)
    each = t.select("chrom", "start", F.explode(dna.kmers(F.col("seq"), k)).alias("x"))
    canonical = dna.canonical(F.col("x.kmer"))
    return each.select(canonical.alias("kmer"), "chrom", (F.col("start") + F.col("x.pos")).alias("pos"), (canonical != F.col("x.kmer")).alias("minus"))


def minimizer_index(tiles: DataFrame, width: int, k: int, w: int) -> DataFrame:
    """kmer (2-bit code), chrom, pos, minus of the windows' minimizers. A window at a tile's end is seen whole in one tile."""
    t = overlapping(tiles, width, k + w - 2)
    each = t.select("chrom", "start", F.explode(dna.minimizers_col(F.col("seq"), k, w)).alias("m"))
    return each.select("m.kmer", "chrom", (F.col("start") + F.col("m.pos")).alias("pos"), "m.minus").distinct()


def frequency(index: DataFrame, share: float = FREQUENT) -> tuple[int, int]:
    """The count at rank floor(n x share) of the distinct k-mers, counts descending, at least 1 (a large number without any); and the greatest count.

    The ranks come from the histogram of counts, which is small whatever the index.
    """
    hist = index.groupBy("kmer").count().groupBy("count").agg(F.count("*").alias("n"))
    rows = sorted(map(tuple, hist.collect()), reverse=True)
    total = sum(n for _, n in rows)
    if not total:
        return (1 << 32) - 1, 0
    rank, seen = int(total * share), 0
    for count, n in rows:
        seen += n
        if seen > rank:
            return max(count, 1), rows[0][0]
    return 1, rows[0][0]


def frequency_cutoff(index: DataFrame, share: float = FREQUENT) -> int:
    return frequency(index, share)[0]


def anchors(reads: DataFrame, index: DataFrame, k: int, w: int, cutoff: int | None = None) -> DataFrame:
    """Seed join: read, chrom, minus, qpos, rpos of each shared minimizer. reads: read, seq, size.

    On the minus strand qpos counts from the other end. Index k-mers above the cutoff are dropped before the join.
    """
    if cutoff is not None:
        index = index.join(index.groupBy("kmer").count().filter(F.col("count") <= cutoff).select("kmer"), "kmer", "left_semi")
    m = dna.minimizer_rows(reads, "read", k, w).withColumnsRenamed({"pos": "q", "minus": "qm"})
    j = m.join(index, "kmer")
    minus = F.col("qm") != F.col("minus")
    return j.select("read", "chrom", minus.alias("minus"), F.when(minus, F.col("size") - k - F.col("q")).otherwise(F.col("q")).alias("qpos"), F.col("pos").alias("rpos"))


def anchor_spans(reads: DataFrame, index: DataFrame, k: int, w: int) -> DataFrame:
    """read, chrom, minus, n, first, last: number, least and greatest reference place of anchors().

    Places of a k-mer are summed up before the join, so a repeat brings a read one row a contig and strand, not one a place.
    """
    places = index.groupBy("kmer", "chrom", "minus").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    m = dna.minimizer_rows(reads, "read", k, w).groupBy("read", "kmer", F.col("minus").alias("qm")).agg(F.count("*").alias("times"))
    j = m.join(places, "kmer")
    return j.groupBy("read", "chrom", (F.col("qm") != F.col("minus")).alias("minus")).agg(F.sum(F.col("n") * F.col("times")).alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def transcript_hits(reads: DataFrame, sequences: DataFrame, k: int, most: int = MOST_IN_TRANSCRIPTS, keep: str | None = None) -> DataFrame:
    """read, name, minus, diagonal, n: reads' k-mers in transcripts (name, seq), one row a read, transcript, strand and diagonal.

    k-mers with more than ``most`` places in the transcripts seed nothing. The others that reads have are told first, from counts, and written below
    keep (by default a new shared path), so the transcripts' places of all the rest are never shuffled.
    """
    keep = keep or shared_path(reads.sparkSession, "hits")
    rare = dna.kmer_codes(sequences, k).filter(F.col("n") <= most)
    seeds = written(rare.join(dna.kmer_codes(reads, k), "code", "left_semi").select(F.col("code").alias("kmer")), f"{keep}/seeds")
    code = lambda d, key: dna.minimizer_rows(d, key, k, 1).withColumnsRenamed({"pos": "at", "minus": "rc"})
    t = code(sequences, "name").drop("size").withColumnsRenamed({"at": "off", "rc": "trc"})
    j = code(reads, "read").join(t.join(seeds, "kmer", "left_semi"), "kmer")
    minus = F.col("rc") != F.col("trc")
    q = F.when(minus, F.col("size") - k - F.col("at")).otherwise(F.col("at"))
    return j.groupBy("read", "name", minus.alias("minus"), (F.col("off") - q).alias("diagonal")).agg(F.count("*").alias("n"))


def index_stats(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("entries"), F.countDistinct("kmer").alias("distinct_kmers"))
