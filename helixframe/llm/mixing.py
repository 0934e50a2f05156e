"""Mixing sources to target weights.

Words are summed for each source. Sources in order of code points (null last) weigh
WEIGHTS in turn and share all words; a target stops at ``cap`` times its
source's words and the excess is shared again by weight. Every document is
emitted floor(rate) times, plus once more if a hash of its id and text is below the
fraction of the rate, where rate is target / words of the source. Long documents
make one draw of a small share uneven, so each source is drawn with DRAWS
seeds in one aggregate, and the draw whose words come nearest to the target is its own.

Ranks and targets are found without bringing the sources to one place: ranks from
a range partitioning and the partitions' counts, the water level from sums.

Defined results: a null text has no words; null is a source of its own, the
last; documents of a source without words are taken once a round of rate 0, so
never; rows that repeat an id draw each by its own text, and rows that repeat id, source and text by
their rank (in the stage, which exact dedup goes before, those share a draw); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import join_by_key, n_words, written

WEIGHTS = (1, 2, 3)
CAP = 3
#: Hash-seeded draws of a source, of which the nearest to its target is taken; two come from one MD5.
DRAWS = 16
#: Sources up to this many (about 100 bytes each) are broadcast to documents; more are joined by key.
BROADCAST_SOURCES = 100_000


#: Equal rows up to this many are made from their count by one task.
EQUAL = 10_000


def draw_key(doc_id: Column, text: Column) -> Column:
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))


def uniform(row: Column, seed: int, draw: int) -> Column:
    """A number in [0, 1) from the MD5 of seed, half the draw's number, and the row's key: its first or 17th to 29th hex digits."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{draw // 2}:"), row))
    return F.conv(F.substring(digest, 1 + 16 * (draw % 2), 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, key, size, row: a row for each of docs. row tells rows apart, and equal ones by their rank, which is made from their count."""
    text = F.col(text_col)
    each = docs.select(F.col(id_col).alias("doc_id"), key_of(F.col(source_col)).alias("key"), n_words(text).alias("size"), draw_key(F.col(id_col), text).alias("row"))
    counted = written(each.groupBy("doc_id", "key", "size", "row").agg(F.count("*").alias("m")), "counted")
    few = counted.filter(F.col("m") <= EQUAL).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    many = counted.filter(F.col("m") > EQUAL).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(EQUAL).cast("long")))).repartition("row", "first")
    many = many.withColumn("k", F.explode(F.sequence("first", F.least(F.col("first") + EQUAL, "m") - 1)))
    return few.unionByName(many.drop("first")).select("doc_id", "key", "size", F.concat("row", F.lit(":"), F.col("k").cast("string")).alias("row"))


def key_of(source: Column) -> Column:
    """Source as a key without null; sorts as the source, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sizes: DataFrame) -> DataFrame:
    """sizes: key, size. Returns key, n (rows), source_size, weight, target."""
    sums = sizes.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    dealt = written(sums.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id()), "sources")
    before, offsets = 0, []
    for part, n in sorted(map(tuple, dealt.groupBy("part").count().collect())):  # a row for each partition
        offsets.append((part, before))
        before += n
    local = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    offset = F.element_at(F.create_map(*[F.lit(x) for po in offsets for x in po]), F.col("part")) if offsets else F.lit(0)
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = dealt.withColumn("rank", local + offset).withColumn("weight", F.element_at(weights, F.pmod("rank", F.lit(len(WEIGHTS))).cast("int") + 1))
    ranked = written(ranked.select("key", "n", "source_size", F.col("weight").cast("double").alias("weight")), "ranked")
    level, seen = 0.0, None
    full = CAP * F.col("source_size")
    while level != seen:
        seen = level
        is_full = full <= F.col("weight") * level
        total, filled, open_weight = ranked.agg(F.sum("source_size"), F.sum(F.when(is_full, full).otherwise(0)), F.sum(F.when(is_full, 0.0).otherwise(F.col("weight")))).first()
        if not total or not open_weight:
            break
        level = (total - filled) / open_weight
    return ranked.withColumn("target", F.least(F.col("weight") * level, full.cast("double")))


def rates(sizes: DataFrame) -> DataFrame:
    """As targets(), with rate: how often each document of the source is taken on average."""
    of = targets(sizes)
    return of.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def copies(row: Column, rate: Column, draw: Column, seed: int) -> Column:
    """How often a document is taken in its source's draw."""
    u = F.coalesce(*[F.when(draw == j, uniform(row, seed, j)) for j in range(DRAWS)])
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def drawn(sizes: DataFrame, seed: int) -> DataFrame:
    """rates() with draw: the one whose words come nearest to the target, the first on ties. sizes: row, key, size."""
    of = written(rates(sizes), "rates")
    each = join_by_key(sizes, of.select("key", "n", "rate"), "key", "n", sizes.count())
    part = F.col("rate") - F.floor("rate")
    sums = [F.sum(F.when(uniform(F.col("row"), seed, j) < part, F.col("size")).otherwise(0)).alias(f"d{j}") for j in range(DRAWS)]
    extra = each.groupBy("key").agg(*sums)
    goal = F.col("target") - F.floor("rate") * F.col("source_size")
    tries = F.array(*[F.struct(F.abs(F.col(f"d{j}") - goal).alias("off"), F.lit(j).alias("j")) for j in range(DRAWS)])
    return written(of.join(extra, "key").select(*of.columns, F.array_min(tries)["j"].alias("draw")), "draws")


def mix(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies; a row for each row of docs."""
    sizes = written(sized(docs, id_col, text_col, source_col), "sizes")
    of = drawn(sizes, seed)
    out = join_by_key(sizes, of.select("key", "n", "source_size", "target", "rate", "draw"), "key", "n", sizes.count())
    n = copies(F.col("row"), F.col("rate"), F.col("draw"), seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"), n.alias("copies"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, seed: int = 17) -> DataFrame:
    """The mix: each document as many times as it is taken."""
    row = F.concat(draw_key(F.col("doc_id"), F.col("text")), F.lit(":0"))
    sizes = written(docs.select(row.alias("row"), key_of(F.col("source")).alias("key"), n_words(F.col("text")).alias("size")), "sizes")
    of = drawn(sizes, seed).select(F.col("key").alias("__key"), F.col("rate").alias("__rate"), F.col("draw").alias("__draw"), F.col("n").alias("__n"))
    keyed = docs.withColumns({"__key": key_of(F.col("source")), "__row": row})
    if of.count() <= BROADCAST_SOURCES:
        out = keyed.join(F.broadcast(of), "__key")
    else:
        out = join_by_key(keyed, of, "__key", "__n", sizes.count())
    out = out.withColumn("__times", copies(F.col("__row"), F.col("__rate"), F.col("__draw"), seed)).filter("__times > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')) || ':' || (row_number() OVER (PARTITION BY doc_id, source, text) - 1) AS rkey FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END)::DOUBLE AS weight FROM s),
o AS (
  SELECT *, sum(source_size) OVER () AS total,
         sum(3 * source_size) OVER (ORDER BY source_size / weight, source ROWS UNBOUNDED PRECEDING) - 3 * source_size AS filled,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY source_size / weight, source ROWS UNBOUNDED PRECEDING) + weight AS open_weight
  FROM w),
l AS (
  SELECT arg_min((total - filled)::DOUBLE / open_weight, row(source_size / weight, source))
         FILTER (3 * source_size > weight * ((total - filled)::DOUBLE / open_weight)) AS level FROM o),
t AS (SELECT source, source_size, least(weight * level, (3 * source_size)::DOUBLE) AS target FROM w, l),
r AS (
  SELECT d.doc_id, d.rkey, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (
  SELECT r.*, j, ('0x' || substr(md5('17:' || (j // 2) || ':' || rkey), (1 + 16 * (j % 2))::INT, 13))::BIGINT::DOUBLE / 4503599627370496.0 < rate - floor(rate) AS extra
  FROM r, (SELECT unnest(range(0, 16)) AS j)),
b AS (
  SELECT source, j, abs(sum(CASE WHEN extra THEN size ELSE 0 END) - (any_value(target) - floor(any_value(rate)) * any_value(source_size))) AS off
  FROM u GROUP BY source, j),
w2 AS (SELECT source, arg_min(j, row(off, j)) AS j FROM b GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u JOIN w2 ON u.source IS NOT DISTINCT FROM w2.source AND u.j = w2.j
"""
