"""Quality rules with host verdicts.

Every document is measured over its whole text. Failures are counted for each host (here
the source), the rates are shrunk towards an empirical beta prior (method of
moments over all hosts), and hosts most of whose documents fail, as far as their posterior
tells, are rejected with all their documents: those whose failure rate is above ``host_limit`` with a
probability of 0.95 (normal approximation of the beta posterior).

Defined results: a null text has no words and fails; documents without a host
(null) get no host verdict; repeated rows count each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import join_by_key, slices, written

SYMBOLS = "#*$%&|<>"
STRIP = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A host goes if its failure rate is above this with a probability of 0.95; clean documents of mixed hosts stay.
HOST_LIMIT = 0.5
#: Standard deviations of a normal distribution below which 0.05 of it lies.
TAIL = 1.645
#: Rejected hosts up to this many are broadcast when documents are filtered; more are joined by shuffle.
BROADCAST_HOSTS = 100_000
#: UTF-8 bytes of the texts that a worker holds as Python strings.
SLICE_BYTES = 1_000_000
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that are found twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        h += ids[k : k + n] * _ODD[k]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    # equal hashes are confirmed word by word
    at = np.flatnonzero(np.isin(h, twice))
    seen: dict[tuple, list[int]] = {}
    for i in at.tolist():
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for places in seen.values():
        if len(places) > 1:
            p = np.array(places)
            np.add.at(step, p, 1)
            np.add.at(step, p + WINDOW, -1)
    return int((np.cumsum(step) > 0).sum())


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(STRIP)]
    return (
        len(words),
        len(text) - sum(map(text.count, STRIP)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def fails(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def measured(rows: DataFrame) -> DataFrame:
    """rows: text and columns of strings and numbers. The latter, and FIELDS; a worker holds some texts at a time."""
    kept = [c for c in rows.columns if c != "text"]

    def f(batches):
        for b in batches:
            for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                found = np.array([measures(t) for t in some.to_pylist()], dtype=np.int64).reshape(-1, len(FIELDS))
                yield pa.record_batch([*[b.column(c).slice(first, len(found)) for c in kept], *map(pa.array, found.T)], names=[*kept, *FIELDS])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(f, ", ".join([f"`{c}` {kinds[c]}" for c in kept] + [f"{k} long" for k in FIELDS]))


def base_fails(text: Column) -> Column:
    def f(texts: pd.Series) -> pd.Series:
        found = (measures(t) for t in texts)
        return pd.Series([bool(fails(m[0], m[4])) for m in found], dtype="bool")

    return F.pandas_udf(f, "boolean")(text)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """a, b of the beta prior: matches mean and variance of the hosts' failure rates, less the variance of sampling.

    Only sums over all hosts come to the driver. With no spread between hosts beyond
    sampling, the prior is as heavy as all rows of the mean host.
    """
    rate = F.col("failed") / F.col("n")
    row = hosts.agg(F.count("*"), F.sum("failed"), F.sum("n"), F.sum(rate), F.sum(rate * rate), F.sum(1 / F.col("n"))).first()
    if not row[0]:
        return 1.0, 1.0
    k, mean = row[0], (row[1] + 0.5) / (row[2] + 1.0)
    seen = row[4] / k - (row[3] / k) ** 2
    own = mean * (1 - mean)
    between = (seen - own * row[5] / k) / max(1 - row[5] / k, 1e-9)
    weight = own / between - 1 if between > 0 else row[2] / k
    weight = min(max(weight, 1.0), max(row[2] / k, 1.0))
    return mean * weight, (1 - mean) * weight


def host_verdicts(rows: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """rows: host (not null), failed (boolean). Returns host, n, failed, rate (shrunk), rejected."""
    hosts = written(rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failed")), "hosts")
    a, b = beta_prior(hosts)
    hosts = hosts.withColumn("rate", (F.col("failed") + F.lit(a)) / (F.col("n") + F.lit(a + b)))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.lit(a + b + 1)))
    return hosts.withColumn("rejected", F.col("rate") - TAIL * spread > host_limit)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, the five measures, base_failed, kept; a row for each row of docs."""
    m = measured(docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")))
    m = written(m, "measures").withColumn("base_failed", fails(F.col("n_words"), F.col("n_repeat_words")))
    of = m.filter("host is not null")
    hosts = host_verdicts(of.select("host", F.col("base_failed").alias("failed")))
    judged = join_by_key(of, hosts.select("host", "n", "rejected"), "host", "n", of.count())
    free = m.filter("host is null").withColumn("n", F.lit(0).cast("long")).withColumn("rejected", F.lit(False))
    out = judged.unionByName(free)
    return out.select("doc_id", *FIELDS, "base_failed", (~F.col("base_failed") & ~F.col("rejected")).alias("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that neither the base rules nor their host's verdict reject."""
    rows = measured(docs.filter("source is not null").select(F.col("source").cast("string").alias("host"), "text"))
    # texts are measured again when rows are taken out: reading them twice shuffles and writes none
    bad = host_verdicts(rows.select("host", fails(F.col("n_words"), F.col("n_repeat_words")).alias("failed"))).filter("rejected").select(F.col("host").alias("source"))
    kept = docs.filter(~base_fails(F.col("text")))
    n = bad.count()
    if not n:
        return kept
    return kept.join(F.broadcast(bad) if n <= BROADCAST_HOSTS else bad, "source", "left_anti").select(docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT * FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cover AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM twice, (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, host, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN lines USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS n, sum(base_failed::BIGINT) AS failed FROM f WHERE host IS NOT NULL GROUP BY host),
s AS (
  SELECT count(*) AS k, (sum(failed) + 0.5) / (sum(n) + 1.0) AS mean, sum(n) / count(*) AS rows_a_host,
         sum((failed / n) * (failed / n)) / count(*) - (sum(failed / n) / count(*)) ** 2 AS seen,
         sum(1 / n) / count(*) AS inv FROM h),
b AS (SELECT *, (seen - mean * (1 - mean) * inv) / greatest(1 - inv, 1e-9) AS between_hosts FROM s),
p AS (
  SELECT mean, least(greatest(CASE WHEN between_hosts > 0 THEN mean * (1 - mean) / between_hosts - 1
         ELSE rows_a_host END, 1.0), greatest(rows_a_host, 1.0)) AS weight FROM b),
q AS (SELECT host, n + weight AS m, (failed + mean * weight) / (n + weight) AS rate FROM h, p),
v AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (m + 1)) > 0.5 AS rejected FROM q)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN v USING (host)
"""
