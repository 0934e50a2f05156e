"""Near-dedup by exact shingle Jaccard similarity, for the pipeline.

Two texts are linked if at least four fifths of the different shingles that either has are in both. Candidates
are in one component of SimHash fingerprints, found by the generalised pigeonhole (``simhash.links``), or
share a band of minima: BANDS bands of ROWS minima of the shingles' hashes, which a pair at
0.8 misses once in 2 * 10^7 pairs (a closer pair less often). Buckets with the same
members are one. Only texts in a bucket with another one get their shingles fetched; there the
similarity is counted, after a bound by 64 bins of shingles that never drops a link.
A bucket above BLOCK texts or BYTES of shingles is cut into blocks, and pairs of blocks are
tasks of their own. What is returned is a spanning forest of each.

Defined results: as in simhash; null and blank texts are copies of each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm import simhash
from helixframe.llm.common import join_by_key, row_key, slices, trim, written
from helixframe.llm.graph import components
from helixframe.llm.simhash import majority, shingle_hashes

BANDS, ROWS = 32, 4
BLOCK = 4096
BYTES = 32_000_000
#: Texts that met others, up to so many, are broadcast by digest and number when texts are fetched; more are joined by shuffle.
BROADCAST_TEXTS = 300_000
#: UTF-8 bytes of the texts that a worker holds as Python strings.
SLICE_BYTES = 1_000_000
_R = np.random.Generator(np.random.PCG64(42))
_XOR = _R.integers(0, 1 << 64, size=(BANDS * ROWS, 1), dtype=np.uint64)
_ODD = _R.integers(0, 1 << 64, size=(BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, shingle: int = 5) -> np.ndarray:
    """The different shingles' hashes, sorted; none of a null or blank text."""
    return np.unique(shingle_hashes(text, shingle))


def bands(own: np.ndarray) -> list[int]:
    """A key for each band: equal if all its minima are."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for i in range(0, len(own), 4096):
        least = np.minimum(least, ((own[i : i + 4096] ^ _XOR) * _ODD).min(axis=1))
    raw, step = least.tobytes(), 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[i * step : (i + 1) * step], i) for i in range(BANDS)]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of 0.8 or more, in whole numbers; two empty sets are the same."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def forest(nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links in a bucket."""
    if len(nodes) == 2:
        return [(nodes[0], nodes[1])] if similar(*sets) else []
    size = np.array([len(x) for x in sets])
    bins = np.array([np.bincount((x & np.uint64(63)).astype(np.int64), minlength=64) for x in sets])
    out, left = [], np.arange(len(nodes))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            # similar sets differ in at most a ninth of both sizes, and bins in no more
            near = 9 * np.abs(bins[left] - bins[x]).sum(axis=1) <= size[left] + size[x]
            near[near] = [similar(sets[x], sets[j]) for j in left[near]]
            got = left[near]
            out += [(nodes[x], nodes[j]) for j in got]
            queue.extend(got)
            left = left[~near]
    return out


def _links(batches):
    """Verified links of rows sorted by bucket (g): g, node, own. Sets are views of the batches' own bytes."""
    trim()
    now, nodes, sets = None, [], []

    def found(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for b in batches:
        out, own = [], b.column("own")
        _, places, data = own.buffers()
        at = np.frombuffer(places, dtype="<i4")[own.offset : own.offset + len(own) + 1].tolist() if len(own) else [0]
        for g, node, low, high in zip(b.column("g").to_pylist(), b.column("node").to_pylist(), at, at[1:]):
            if g != now:
                if len(nodes) > 1:
                    out += forest(nodes, sets)
                now, nodes, sets = g, [], []
            nodes.append(node)
            sets.append(np.frombuffer(data, dtype=np.uint64, count=(high - low) // 8, offset=low) if high > low else np.empty(0, np.uint64))
        yield found(out)
    if len(nodes) > 1:
        yield found(forest(nodes, sets))
    nodes, sets = [], []
    trim()


def simhash_probes(nodes: DataFrame) -> DataFrame:
    """node, size, h of the nodes (node, size, fp) whose fingerprint is others' too or links to another: a key for each component of fingerprints."""
    fps = written(nodes.groupBy("fp").agg(F.count("*").alias("n")), "fingerprints")
    roots = components(simhash.links(fps.select("fp"))).withColumnRenamed("node", "fp")
    some = fps.join(roots, "fp", "left").filter("n > 1 or root is not null").select("fp", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("h"))
    return nodes.select("node", "size", "fp").join(some, "fp").select("node", "size", "h")


def links(nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """Links (a, b) that connect all similar texts. nodes: node, digest, size, keys, fp, a row for each text; texts: digest, text."""
    probes = nodes.select("node", "size", F.explode("keys").alias("h")).unionByName(written(simhash_probes(nodes), "simhash-probes"))
    met = probes.groupBy("h").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("low"), F.max("node").alias("high"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(8 * F.col("total") / BYTES)).cast("int")
    met = met.filter("n > 1").select("h", F.xxhash64("n", "total", "x", "low", "high").alias("g"), blocks.alias("blocks"))
    members = written(probes.join(met, "h").select("g", "node", F.greatest("blocks", F.lit(1)).alias("blocks")).distinct(), "buckets")
    live = written(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "digest"), "live-texts")
    few = live.count() <= BROADCAST_TEXTS
    each = texts.join(F.broadcast(live) if few else live, "digest").groupBy("node").agg(F.first("text").alias("text"))

    def hashes(batches):
        trim()
        for b in batches:
            for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                own = [shingles(t, shingle).tobytes() for t in some.to_pylist()]
                yield pa.record_batch([b.column("node").slice(first, len(own)), pa.array(own, pa.binary())], names=["node", "own"])

    sets = written(each.mapInArrow(hashes, "node long, own binary"), "shingles")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.withColumn("mine", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(F.xxhash64("g", F.least("mine", "other"), F.greatest("mine", "other")).alias("g"), "node")
    rows = dealt.join(sets, "node")
    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(_links, "a long, b long")


def groups(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, __k1, __k2 (common.row_key), n (rows with the text), first: doc_id and key of the component's first row.

    The first row has the smallest id (null ids last), then the smallest hash of the row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(docs), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))

    def sketch(batches):
        trim()
        for b in batches:
            for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                own, fps = [], []
                for t in some.to_pylist():
                    h = shingle_hashes(t, shingle)
                    own.append(np.unique(h))
                    fps.append(majority(h))
                keys = pa.array([np.array(bands(x), dtype=np.uint64).view(np.int64) for x in own], pa.list_(pa.int64()))
                rest = [b.column(c).slice(first, len(own)) for c in ("doc_id", "__k1", "__k2", "digest")]
                yield pa.record_batch([*rest, pa.array([len(x) for x in own], pa.int64()), keys, pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["doc_id", "__k1", "__k2", "digest", "size", "keys", "fp"])

    rows = written(src.mapInArrow(sketch, "doc_id long, __k1 long, __k2 long, digest binary, size long, keys array<long>, fp long"), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__k1", "__k2")
    nodes = rows.groupBy("digest").agg(F.min(first).alias("least"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("fp").alias("fp"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "texts")
    roots = components(links(nodes, src.select("digest", "text"), shingle))
    rooted = written(nodes.select("node", "digest", "least", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("first"), F.sum("n").alias("members"))
    of = rooted.join(least, "root").select("digest", "first", "n", "members")
    return join_by_key(rows.select("doc_id", "__k1", "__k2", "digest"), of, "digest", "n", rows.count()).drop("digest", "n")


def near_duplicates(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id (the smallest doc_id reachable by links); a row for each row of docs."""
    return groups(docs, shingle, id_col, text_col).select("doc_id", F.col("first.doc_id").alias("component_id"))
