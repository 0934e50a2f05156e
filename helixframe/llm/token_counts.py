"""Token counts by separator scan of flat token files.

A token file is ids one after another (little-endian unsigned 16 bits), each
document's followed by the end-of-document id; it has no index. Files are read
in blocks by independent tasks, each of which finds the separators of its block
with one vectorised comparison. A prefix scan over the blocks' summaries (number
of separators, place of the last) gives every block the ordinal of its first
document and where that document began, so documents across any number of
blocks are stitched.

Defined results: an empty file has no documents; ids after the last separator
of a file are a document with terminated = false; a null or empty text has 0
tokens; repeated rows are counted each; the end id isn't counted.

Files are written and read through Arrow file systems, in the shared folder.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import new_path, slices, written
from helixframe.llm.tokens import SLICE_BYTES, default_path, word_tokens

END_ID = 49407
BLOCK_BYTES = 8 << 20


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenizes docs into a flat file for each partition. Returns file, ordinal, doc_id, a row for each row of docs.

    A task that is run again writes a file of its own; only files of tasks that
    ended are in the result.
    """
    base = folder.replace("file:///", "/", 1) if folder.startswith("file:///") else folder

    def write(batches):
        tokens = word_tokens(path, literal=True)
        name, n, out = f"{base}/tokens-{uuid.uuid4().hex}.bin", 0, None
        try:
            for b in batches:
                for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                    if out is None:
                        files, at = _fs(name)
                        files.create_dir(at.rpartition("/")[0])
                        out = files.open_output_stream(at)
                    flat, ends = tokens.flat(some)
                    out.write(np.insert(flat, ends[1:], end_id).astype("<u2").tobytes())
                    k = len(some)
                    yield pa.record_batch([pa.array([name] * k, pa.string()), pa.array(np.arange(n, n + k)), b.column("doc_id").slice(first, k)], names=["file", "ordinal", "doc_id"])
                    n += k
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(write, "file string, ordinal long, doc_id string")


def scan_blocks(files: DataFrame, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """files: file. Returns file, block, n_tokens, seps: the separators' places in the file, block by block."""
    if block_bytes % 2:
        raise ValueError("a block is a whole number of 16-bit ids")

    def sizes(frames):
        for f in frames:
            found = []
            for name in f["file"]:
                fs, at = _fs(name)
                found.append(fs.get_file_info(at).size)
            yield pd.DataFrame({"file": f["file"], "size": np.array(found, dtype=np.int64)})

    def scan(frames):
        for f in frames:
            for name, block in zip(f["file"], f["block"]):
                fs, at = _fs(name)
                with fs.open_input_file(at) as source:
                    ids = np.frombuffer(source.read_at(block_bytes, int(block) * block_bytes), dtype="<u2")
                seps = np.flatnonzero(ids == end_id) + int(block) * (block_bytes // 2)
                yield pd.DataFrame({"file": [name], "block": [int(block)], "n_tokens": [len(ids)], "seps": [seps.astype(np.int64)]})

    sized = files.select("file").distinct().mapInPandas(sizes, "file string, size long").filter("size > 0")
    last = F.floor((F.col("size") - 1) / block_bytes)
    blocks = sized.select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    return blocks.repartition("file", "block").mapInPandas(scan, "file string, block long, n_tokens long, seps array<long>")


def count_tokens(files: DataFrame, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """files: file. Returns file, ordinal, n_tokens, terminated, a row for each document of the files."""
    blocks = written(scan_blocks(files, end_id, block_bytes), "blocks")
    summary = blocks.select("file", "block", "n_tokens", F.size("seps").cast("long").alias("n"), F.try_element_at("seps", F.lit(-1)).alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = summary.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"))
    # separators and documents are many times the blocks that Spark's estimates see: neither is broadcast
    each = blocks.hint("merge").join(scanned, ["file", "block"])
    began = F.transform("seps", lambda x, i: x - F.when(i == 0, F.col("carry")).otherwise(F.get("seps", i - 1)) - 1)
    whole = each.select("file", "first", F.posexplode(began).alias("k", "n_tokens"))
    whole = whole.select("file", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("terminated"))
    ends = summary.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.sum("n_tokens") - F.coalesce(F.max("last"), F.lit(-1)) - 1).alias("n_tokens"))
    return whole.unionByName(ends.filter("n_tokens > 0").withColumn("terminated", F.lit(False)))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, terminated of every document, counted in the flat files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = written(write_token_files(docs, new_path(spark, "tokens"), default_path()), "manifest")
    counts = count_tokens(manifest.select("file"))
    out = manifest.join(counts.hint("merge"), ["file", "ordinal"])
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_tokens", "terminated")
