"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints are made over whole texts. Equal fingerprints are one node. The 64
bits are grouped into m partitions of correlated bits; a dynamic program gives
partition i a threshold t_i, with sum(t_i) = max_distance - m + 1, so that every
pair within max_distance is within t_i bits in some partition i (a threshold of
-1 never probes). The program minimises probes and estimated candidates, which
come from counts over all fingerprints. A node is probed by each partition's
value with every choice of t_i bits masked; nodes that meet are verified by the
number of differing bits. A bucket above BLOCK nodes is cut into blocks, and
pairs of blocks are tasks of their own. Of what is verified in a bucket only a
spanning forest is returned, so links don't grow with the square of a group.

Defined results: a null or blank text has fingerprint zero, linked like any
other; a text of fewer words than a shingle is one shingle; equal ids are one
document of several rows, each with its own fingerprint; a null id is never the
smallest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import join_by_key, keep_rows, slices, written
from helixframe.llm.graph import components

BITS = 64
#: Nodes of a bucket that are compared in one go; larger buckets are cut into blocks.
BLOCK = 4096
#: Groups up to this size are compared by shifted arrays, larger ones by search of a forest.
SMALL = 16
#: UTF-8 bytes of the texts that a worker holds as Python strings.
SLICE_BYTES = 1_000_000


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the text's shingles in order; none of a null or blank text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text: a bit is set if it is in over half the shingles' XXH64 (seed 42)."""
    return majority(shingle_hashes(text, shingle))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half the hashes; 0 of none."""
    if not len(h):
        return 0
    total = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 65536):
        total += np.unpackbits(h[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long; a row for each row of docs."""

    def fp(batches):
        for b in batches:
            for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                made = np.array([fingerprint(t, shingle) for t in some.to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.record_batch([b.column("doc_id").slice(first, len(made)), pa.array(made)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(fp, "doc_id long, fp long")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of nodes, and of those with bits i and j both set: 64 x 64 numbers, whatever the input."""

    def count(frames):
        n, c = 0, np.zeros((BITS, BITS))
        for f in frames:
            x = np.unpackbits(f["fp"].to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
            n, c = n + len(x), c + x.T @ x
        yield pd.DataFrame({"k": np.arange(-1, BITS * BITS), "c": np.concatenate(([n], c.ravel()))})

    rows = nodes.select("fp").mapInPandas(count, "k int, c double").groupBy("k").agg(F.sum("c").alias("c")).collect()
    c = np.zeros(BITS * BITS + 1)
    for k, v in rows:
        c[k + 1] = v
    return int(c[0]), c[1:].reshape(BITS, BITS)


def correlated_partitions(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits (0: the highest) in m partitions of nearly equal width; each takes the bits most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(r, 0)
    free, out = list(range(BITS)), []
    for i in range(m):
        width = (BITS - sum(map(len, out))) // (m - i)
        part = [max(free, key=lambda b: (r[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            best = max(free, key=lambda b: (r[b, part].sum(), -b))
            part.append(best)
            free.remove(best)
        out.append(sorted(part))
    return out


def _bits(part: list[int]) -> int:
    return sum(1 << (BITS - 1 - b) for b in part)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def equal_pairs(nodes: DataFrame, parts: list[list[int]]) -> list[float]:
    """Pairs of nodes with equal bits, for each partition, counted over all nodes."""
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(_bits(p)))).alias("v")) for i, p in enumerate(parts)])
    sizes = nodes.select(F.explode(keys).alias("x")).groupBy("x").count()
    rows = sizes.groupBy("x.i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect()
    return [dict(map(tuple, rows)).get(i, 0.0) for i in range(len(parts))]


def estimated(n: int, ones: np.ndarray, part: list[int], equal: float, t: int) -> float:
    """Estimated pairs within t bits in the partition: independent bits, scaled to the counted pairs without a difference."""
    d = np.zeros(t + 2)
    d[0] = 1.0
    for b in part:
        q = ones[b] / max(n, 1)
        same = q * q + (1 - q) * (1 - q)
        d[1:-1], d[0] = d[1:-1] * same + d[:-2] * (1 - same), d[0] * same
    pairs = n * (n - 1) / 2
    return d[: t + 1].sum() * pairs * max(1.0, equal / max(d[0] * pairs, 1e-9))


def allocate(cost: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds that sum to total, at least cost; cost[i][t] for t from -1. Dynamic programming over partitions and sums."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in cost:
        now: dict[int, tuple[float, list[int]]] = {}
        for s, (v, ts) in best.items():
            for t, w in c.items():
                if s + t not in now or v + w < now[s + t][0]:
                    now[s + t] = (v + w, [*ts, t])
        best = now
    return best[total]


def plan(nodes: DataFrame, max_distance: int, counts: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds: of the numbers of partitions in counts, the cheapest."""
    n, both = bit_counts(nodes)
    options = [(m, correlated_partitions(n, both, m)) for m in counts]
    equal = equal_pairs(nodes, [p for _, parts in options for p in parts])
    found = []
    for m, parts in options:
        own, equal = equal[:m], equal[m:]
        cost = []
        for p, e in zip(parts, own):
            c = {-1: 0.0}
            for t in range(min(max_distance, len(p)) + 1):
                masks = comb(len(p), t)
                # a probe is shuffled and sorted, a candidate is a few machine operations; pairs meet once for each mask that fits
                c[t] = n * masks + 0.02 * estimated(n, np.diag(both), p, e, t) * max(1, masks / 4)
            cost.append(c)
        v, ts = allocate(cost, max_distance - m + 1)
        found.append((v, [(p, t) for p, t in zip(parts, ts) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def forest(fp: np.ndarray, max_distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links between the different fingerprints of a group."""
    out, left = [], np.unique(fp)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_distance
            if near.any():
                got = left[near]
                out.append((np.full(len(got), x), got))
                queue.extend(got)
                left = left[~near]
    return out


def _groups(frames, max_distance: int):
    """Verified links of rows sorted by group (g); the last group of a batch is carried to the next."""

    def links(g, fp):
        out = []
        cut = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
        size = np.diff(cut)
        of = np.repeat(size, size)
        small = np.flatnonzero((of > 1) & (of <= SMALL))
        for d in range(1, SMALL):
            small = small[small + d < len(g)]
            small = small[g[small] == g[np.minimum(small + d, len(g) - 1)]]
            if not len(small):
                break
            a, b = fp[small], fp[small + d]
            near = (np.bitwise_count(a ^ b) <= max_distance) & (a != b)
            out.append((a[near], b[near]))
        for i in np.flatnonzero(size > SMALL):
            out += forest(fp[cut[i] : cut[i + 1]], max_distance)
        a = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.uint64)
        b = np.concatenate([x for _, x in out]) if out else np.empty(0, np.uint64)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    g, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
    for f in frames:
        g, fp = np.concatenate([g, f["g"].to_numpy()]), np.concatenate([fp, f["fp"].to_numpy().view(np.uint64)])
        if len(g) and g[0] != g[-1]:
            k = int(np.searchsorted(g, g[-1]))
            yield links(g[:k], fp[:k])
            g, fp = g[k:], fp[k:]
    if len(g):
        yield links(g, fp)


def links(nodes: DataFrame, max_distance: int = 3, counts: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints are within max_distance bits; nodes: different values of fp."""
    masks = []
    for i, (part, t) in enumerate(plan(nodes, max_distance, counts)):
        masks += [(i * 100_000 + k, _signed(_bits([b for b in part if b not in off]))) for k, off in enumerate(combinations(part, t))]
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in masks])
    probes = nodes.select("fp", F.explode(keys).alias("key"))
    # buckets with one node have no pairs; those above BLOCK are cut
    hot = written(probes.groupBy("key").count().filter(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot-buckets")
    cold = probes
    if hot.isEmpty():
        dealt = cold.select(F.col("key").alias("g"), "fp")
    else:
        tagged = probes.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        pairs = tagged.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = pairs.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "fp")
    ordered = dealt.repartition("g").sortWithinPartitions("g")
    return ordered.mapInPandas(lambda frames: _groups(frames, max_distance), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable by links); a row for each row of docs."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    roots = components(links(nodes.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    rooted = written(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id", "n")
    return join_by_key(fps, of, "fp", "n", fps.count()).select("doc_id", "fp", "component_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that with the smallest id (null ids last). Texts that SimHash links by the generalised pigeonhole, as in op4, and
    those of a band of minima, since 64 bits lose most pairs at 0.8, are linked if their five-word Jaccard similarity is 0.8 or more, counted exactly.

    Rows are judged one by one: rows that share an id but no text are different documents, null and
    blank texts are copies of each other, of equal rows one stays, an empty table gives no rows.
    """
    from helixframe.llm import jaccard

    of = jaccard.groups(docs, shingle=5).filter("members > 1")
    kept = (F.col("__k1") == F.col("first.__k1")) & (F.col("__k2") == F.col("first.__k2"))
    return keep_rows(docs, of.select("__k1", "__k2", kept.alias("kept")))
