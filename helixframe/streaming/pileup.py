"""Streaming pileup: candidate sites that follow a stream of alignment records.

Counts by place and base are a stateful aggregation of sums, so state grows with
the places seen, not with the reads. A late batch adds to the same counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helixframe.operators import pileup


def counts(alignments: DataFrame) -> DataFrame:
    """chrom, pos, depth, a, c, g, t of a stream of alignments; output mode update or complete."""
    return pileup.base_counts(pileup.aligned_bases(alignments))


def event_counts(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Windowed counts and sums of a stream of events (ts, event_type, value), closed by a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sites_sink(alignments: DataFrame, refs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps a table of candidates up to date. Every batch's table is a folder of its own name, so a batch that runs again writes the same."""

    def write(found: DataFrame, epoch: int) -> None:
        pileup.candidates(found, refs).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return counts(alignments).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).start()
