"""The public surface: the engine's commands as functions, and its kernels as SQL functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import dna, numeric, trim
from helixframe.operators import features, kmer_index, pileup, qc, vcf
from helixframe.operators.align import mapper
from helixframe.operators.align.kernels import ChainRules, edit_infix
from helixframe.plans.stages import Run, RunParams, resume

__all__ = ["ChainRules", "Run", "RunParams", "align", "build_index", "discover", "qc_reads", "register", "resume", "run", "score", "site_table"]


def qc_reads(reads: DataFrame, options: qc.Options | None = None) -> tuple[DataFrame, dict]:
    return qc.run(reads, options)


def build_index(tiles: DataFrame, width: int, table: str, k: int = 15, w: int = 10, buckets: int = 64) -> None:
    """Minimizer index as a table bucketed and sorted by k-mer, so seed joins don't shuffle it."""
    kmer_index.minimizer_index(tiles, width, k, w).write.bucketBy(buckets, "kmer").sortBy("kmer").mode("overwrite").saveAsTable(table)


def align(reads: DataFrame, tiles: DataFrame, width: int, **options) -> DataFrame:
    return mapper.to_records(mapper.align(reads, tiles, width, **options))


def discover(alignments: DataFrame, refs: DataFrame) -> DataFrame:
    return pileup.discover(alignments, refs)


def score(sites: DataFrame, alignments: DataFrame, refs: DataFrame, model, alu: DataFrame | None = None) -> DataFrame:
    return features.score(features.features(sites, pileup.merge_templates(pileup.observations(alignments)), refs, alu), model)


def site_table(sites: DataFrame, threshold: float) -> DataFrame:
    return vcf.records(sites, threshold)


def run(spark: SparkSession, params: RunParams) -> list[str]:
    return Run(spark, params).run()


def register(spark: SparkSession) -> None:
    """SQL functions: hx_minimizers(seq), hx_quality_keep(qual), hx_poly_g_keep(seq), hx_edit_distance(read, ref), hx_fixed(x), hx_shortest(x)."""

    def over(f):
        def one(s: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else f(x) for x in s]).astype("object")

        return one

    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([edit_infix(x or "", y or "")[0] for x, y in zip(a, b)], dtype="int64")

    spark.udf.register("hx_minimizers", F.pandas_udf(over(lambda x: [(a - (1 << 64) if a >> 63 else a, p, m) for a, p, m in dna.minimizers(x, 15, 10)]), "array<struct<kmer long, pos int, minus boolean>>"))
    spark.udf.register("hx_quality_keep", F.pandas_udf(over(lambda q: trim.quality_keep(q, 20)), "int"))
    spark.udf.register("hx_poly_g_keep", F.pandas_udf(over(trim.poly_g_keep), "int"))
    spark.udf.register("hx_edit_distance", F.pandas_udf(distance, "int"))
    spark.udf.register("hx_fixed", F.pandas_udf(over(lambda x: numeric.fixed_text(x, 3)), "string"))
    spark.udf.register("hx_shortest", F.pandas_udf(over(numeric.shortest_text), "string"))
