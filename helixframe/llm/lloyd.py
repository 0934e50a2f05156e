"""Centroid clustering: plain Lloyd over integer vectors.

A vector with exactly ``dims`` finite components is kept, and each component x becomes
floor(SCALE * x). The first centroids are the ``k`` kept vectors with the smallest
hash of seed and id. A round broadcasts the centroids (k x dims integers) with its tasks;
mapInPandas finds squared differences to one centroid after another in NumPy, the
lowest number wins ties, and each task hands on one row of integer sums for each centroid.
These meet in a groupBy, so a round shuffles k rows a task, however the vectors are
spread, and centroids are replaced by exact floors. Equal vectors need no care: a task
adds them up as any others.

Whole numbers stay exact: a batch whose components all lie under 2^27 is computed in 64-bit integers, others
in Python's integers, and sums are handed on in limbs of 40 bits.

Defined results: a null vector, one of another length, or with a null, NaN or
infinite component is left out; rows that share an id are vectors of their own, and of these the smaller vector comes first
among the first centroids; a null id is hashed as the text ``null`` and returned as null; with fewer than k kept vectors
there are as many centroids; a distance or sum beyond a long is returned as the greatest long
(compared exactly before that); no kept vectors give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import written

SCALE = 64
DIMS = 64
K = 16
ROUNDS = 3
SEED = 1
#: Components below this are computed in 64-bit integers: DIMS squared differences of them fit.
SMALL = 1 << 27
LIMB = 40
LONG = (1 << 63) - 1


def kept_vectors(rows: DataFrame, dims: int = DIMS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (doubles): the vectors with ``dims`` components, all finite."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = (F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return rows.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & fine)


def whole(x: float) -> int:
    """floor(SCALE * x), exactly."""
    return math.floor(SCALE * x) if abs(x) < 2.0**900 else SCALE * int(x)


def whole_vectors(column: pd.Series) -> np.ndarray:
    """A row of whole numbers for each vector: 64-bit where all are small, Python's otherwise."""
    x = np.vstack(column.to_numpy())
    if np.abs(x).max() < SMALL // SCALE:
        return np.floor(SCALE * x).astype(np.int64)
    return np.array([[whole(y) for y in row] for row in x.tolist()], dtype=object)


def nearest(v: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid, the lowest number on ties, and the squared distance."""
    wide = v.dtype == object or any(abs(x) >= SMALL for c in centroids for x in c)
    v = v.astype(object) if wide else v
    best, least = np.zeros(len(v), dtype=np.int32), None
    for j, c in enumerate(centroids):
        d = v - np.array(c, dtype=object if wide else np.int64)
        d = (d * d).sum(axis=1)
        if least is None:
            least = d
        else:
            less = (d < least).astype(bool)
            best[less], least[less] = j, d[less]
    return best, least


def limbs(x: int, n: int) -> list[int]:
    """x in n limbs of LIMB bits, the last with the sign."""
    out = []
    for _ in range(n - 1):
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def n_limbs(x: int) -> int:
    return max(1, -(-(x.bit_length() + 1) // LIMB))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """At most k rows come to the driver."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return [[whole(x) for x in r["v"]] for r in vectors.orderBy(h, "v").select("v").limit(k).collect()]


def next_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: vectors are assigned, and each centroid with vectors becomes the floor of their mean."""
    k, dims = len(centroids), len(centroids[0])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for b in batches:
            if not len(b):
                continue
            v = whole_vectors(b["v"])
            at, _ = nearest(v, centroids)
            for j in np.unique(at).tolist():
                some = v[at == j]
                total[j] += some.sum(axis=0).astype(object)
                n[j] += len(some)
        rows = []
        for j in np.flatnonzero(n).tolist():
            most = max(n_limbs(int(x)) for x in total[j])
            parts = [limbs(int(x), most) for x in total[j]]
            rows += [(j, i, int(n[j]) if i == 0 else 0, [p[i] for p in parts]) for i in range(most)]
        yield pd.DataFrame(rows, columns=["cluster", "limb", "n", "sums"])

    each = vectors.select("v").mapInPandas(sums, "cluster int, limb int, n long, sums array<long>")
    # only a task's last limb has a sign, so limbs of all tasks are added place by place
    merged = each.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)])
    out = [list(c) for c in centroids]
    size: dict[int, int] = {}
    total: dict[int, list[int]] = {}
    for r in merged.collect():  # k rows for each limb
        size[r["cluster"]] = size.get(r["cluster"], 0) + r["n"]
        have = total.setdefault(r["cluster"], [0] * dims)
        for i in range(dims):
            have[i] += r[f"s{i}"] << (LIMB * r["limb"])
    for j, n in size.items():
        out[j] = [x // n for x in total[j]]
    return out


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance."""
    kind = dict(vectors.dtypes)["vec_id"]

    def to(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                at, d = nearest(whole_vectors(b["v"]), centroids)
                yield pd.DataFrame({"vec_id": b["vec_id"], "cluster": at, "distance": np.minimum(d, LONG).astype(np.int64)})

    # as text, for pandas has no whole numbers with nulls
    found = vectors.select(F.col("vec_id").cast("string").alias("vec_id"), "v").mapInPandas(to, "vec_id string, cluster int, distance long")
    return found.withColumn("vec_id", F.col("vec_id").cast(kind))


def centroid_hash(c: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()


def lloyd(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """Assignments of vec_id, v (see kept_vectors) with their clusters' sums, and the final centroids."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(vectors, centroids)
    found = written(assign(vectors, centroids), "assigned") if centroids else vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(wide.alias("d")).collect()}  # k rows
    hashes = [(j, min(int(sums.get(j, 0)), LONG), centroid_hash(c)) for j, c in enumerate(centroids)]
    total = min(sum(map(int, sums.values())), LONG)
    of = vectors.sparkSession.createDataFrame(hashes, "cluster int, cluster_inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(of), "cluster").withColumn("inertia", F.lit(total).cast("long"))  # k rows
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd(kept_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))[0]


def _round(i: int) -> str:
    """SQL of the assignment to centroids c{i}, and of the next ones."""
    return f"""
a{i} AS MATERIALIZED (
  SELECT ord, vec_id, v, arg_min(j, row(d, j)) AS j, min(d) AS d
  FROM (SELECT q.*, c.j, list_sum(list_transform(range(1, 65), lambda i: (q.v[i] - c.c[i]) * (q.v[i] - c.c[i])))::BIGINT AS d FROM q, c{i} c)
  GROUP BY ord, vec_id, v)"""


def _next(i: int) -> str:
    return f"""
s{i} AS (SELECT j, p, sum(v[p]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 65)) AS p) GROUP BY j, p),
m{i} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY p)::BIGINT[] AS c FROM s{i} GROUP BY j),
c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m{i}.c, c.c) AS c FROM c{i} c LEFT JOIN m{i} USING (j))"""


SQL = f"""
WITH q AS MATERIALIZED (
  SELECT row_number() OVER () AS ord, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j, v AS c FROM q ORDER BY sha256('1:' || vec_id) LIMIT 16),
{",".join(_round(i) + "," + _next(i) for i in range(ROUNDS))},
{_round(ROUNDS)},
t AS (SELECT j, sum(d)::BIGINT AS cluster_inertia FROM a{ROUNDS} GROUP BY j)
SELECT vec_id, j::INTEGER AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a{ROUNDS}) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN t USING (j) JOIN c{ROUNDS} USING (j)
"""
