"""Shared helpers of the corpus operators: work folder, written tables, skew-safe joins, word rules."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space of the contracts: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
#: A key is hot when it holds more than one row in HOT_SHARE, so there are fewer than HOT_SHARE hot keys whatever the input.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir, else a folder in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
        if base.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base.rstrip("/")


#: Paths that new_path() gave out since the last clear().
_MADE: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    _MADE.append(f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear(spark: SparkSession, keep: tuple[str, ...] = ()) -> None:
    """Removes what was written under new_path() since the last call, but for the paths in keep. No DataFrame over it may be used afterwards."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _MADE:
        if path not in keep:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
    _MADE[:] = [p for p in _MADE if p in keep]


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_by_key(left: DataFrame, right: DataFrame, on: str, weight: str, total: int) -> DataFrame:
    """left LEFT JOIN right, where right has one row a key and ``weight``, the key's rows in left.

    Hot keys (more than total / HOT_SHARE rows, so fewer than HOT_SHARE of them)
    are broadcast and never shuffled; the others are joined by their hash.
    left is read twice and has no null keys.
    """
    least = total // HOT_SHARE
    hot = right.filter(F.col(weight) > least)
    cold = right.filter(F.col(weight) <= least)
    rest = left.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on, "left")
    return left.join(F.broadcast(hot), on, "inner").unionByName(rest)


#: Row keys up to this many (16 bytes each) are broadcast when rows are taken out of a table; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def row_key(docs: DataFrame) -> list[Column]:
    """Two 64-bit hashes of the whole row (but columns of maps), as __k1 and __k2: equal for equal rows."""
    cols = [F.col(f"`{c}`") for c, kind in sorted(docs.dtypes) if "map<" not in kind and kind != "variant"]
    empty = [c.isNull() for c in cols]  # a hash passes over nulls
    return [F.xxhash64(F.lit(k), *empty, *cols).alias(f"__k{k}") for k in (1, 2)]


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """docs without the rows that go. verdicts: __k1, __k2, kept; a row for each row of docs that may go, the others stay.

    Of equal rows as many are verdicts, and one stays if any is kept. Texts are shuffled only if
    more than BROADCAST_ROWS different rows go, and then by the row's hash, which no group shares.
    """
    keys = ["__k1", "__k2"]
    by = written(verdicts.groupBy(keys).agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "row-verdicts")
    gone, twice = by.filter("not kept").select(keys), by.filter("kept and n > 1").select(keys)
    n_gone, n_twice = by.agg(F.count_if(F.expr("not kept")), F.count_if(F.expr("kept and n > 1"))).first()
    out = docs.select("*", *row_key(docs))
    if n_gone:
        out = out.join(F.broadcast(gone) if n_gone <= BROADCAST_ROWS else gone, keys, "left_anti")
    if n_twice:
        some = F.broadcast(twice) if n_twice <= BROADCAST_ROWS else twice
        out = out.join(some, keys, "left_anti").unionByName(out.join(some, keys, "left_semi").dropDuplicates(keys))
    return out.select([F.col(f"`{c}`") for c in docs.columns])


def trim() -> None:
    """Gives what this worker's earlier tasks and stages no longer use back to the system: workers live on, and an executor's memory counts them all."""
    pa.default_memory_pool().release_unused()
    own = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if own:
        own(0)


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """(place of the first text, some texts) over all texts, without null; a slice has about ``most`` bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        start = size[first - 1] if first else 0
        end = min(max(int(np.searchsorted(size, start + most, side="right")), first + 1), len(texts))
        yield first, pc.fill_null(texts.slice(first, end - first), "")
        first = end


def n_words(text: Column) -> Column:
    """Number of maximal runs of characters other than SPACES; null counts as none."""
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)))
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("long")
