"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import exact_dedup, mixing, packing, quality_rules, simhash
from helixframe.llm.common import clear, new_path

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("exact_dedup", exact_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]
#: SimHash and BPE ids can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        clear(spark, keep=(path,))
    return docs
