"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is a shuffle of the links and is written to the shared folder; nothing
but a count and a checksum comes to the driver. A node's minimum is aggregated
before the shuffle, and hot nodes are split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v), u > v, each once. Links the neighbours of every node to the smallest of them and it."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        out = links.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of any order. Returns node, root: the smallest node reachable; nodes without links are absent."""
    links = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    sign = None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not now[0] or now == sign:
            break
        sign = now
        links = written(_star(_star(links, True), False), "links")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
