"""URL filters: host-suffix and path-prefix expressions, joined to rules on short hash prefixes.

A rule ``host/path`` fits a URL whose host is the rule's or a subdomain of it and
whose path starts with the rule's. Each URL is expanded into one expression for
each shape (labels of the host, code points of the path) that the rules have;
expressions meet rules on 32 bits of XXH64 and are confirmed by SHA-256.
The longest rule wins, then the longer host, then block before allow.
URLs without a rule get the verdict ``default``.

Defined results: a null URL, or one without ``://``, has an empty host and path,
which no rule fits; repeated rows are judged each; no rules: every URL gets
the default; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The rules of the contract: verdict, rule.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to this many are broadcast (about 100 bytes each); more are joined by shuffle.
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    return F.size(F.split(host, "\\."))


def keyed(df: DataFrame, expression: str) -> DataFrame:
    """With the short hash prefix and the full digest of an expression."""
    return df.withColumn("prefix", F.shiftright(F.xxhash64(expression), 32).cast("int")).withColumn("full", F.unhex(F.sha2(expression, 256)))


def rule_table(rules: DataFrame) -> DataFrame:
    """rules: verdict, rule. One row a rule; block wins over allow for the same rule."""
    one = rules.filter("rule is not null").groupBy("rule").agg(F.max(F.col("verdict")).alias("verdict"))
    one = one.withColumn("host", F.translate(F.regexp_extract("rule", "(?s)^([^/]*)", 1), UPPER, LOWER))
    one = one.withColumn("path", F.expr("substring(rule, length(host) + 1)"))
    return one.select("rule", "verdict", F.concat("host", "path").alias("expression"), labels(F.col("host")).alias("n_labels"), F.length("host").alias("host_len"), F.length("path").alias("path_len"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages: page_id, url. Returns page_id, host, path, rule, verdict, a row for each row of pages."""
    rules = rule_table(rules).cache()
    shapes = [(r[0], r[1]) for r in rules.select("n_labels", "path_len").distinct().collect()]  # at most labels x path lengths of the rules, a few hundred
    urls = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"))
    urls = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.monotonically_increasing_id().alias("row_id"))
    array = F.array(*[F.struct(F.lit(a).alias("n_labels"), F.lit(b).alias("path_len")) for a, b in sorted(shapes)]) if shapes else F.expr("cast(array() as array<struct<n_labels:int,path_len:int>>)")
    fitting = F.filter(array, lambda s: (s["n_labels"] <= labels(F.col("host"))) & (s["path_len"] <= F.length("path")))
    each = urls.withColumn("shape", F.explode_outer(fitting))
    suffix = F.expr("substring_index(host, '.', -shape.n_labels)")
    each = keyed(each.withColumn("expression", F.concat(suffix, F.expr("left(path, shape.path_len)"))), "expression")
    marked = keyed(rules, "expression").select("prefix", "full", "rule", "verdict", "host_len", "path_len")
    if rules.count() <= BROADCAST_RULES:
        marked = F.broadcast(marked)
    hit = each.join(marked, ["prefix", "full"], "left")
    order = F.struct((F.col("host_len") + F.col("path_len")).alias("n"), "host_len", "verdict", "rule")
    best = hit.groupBy("row_id").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(F.when(F.col("rule").isNotNull(), order)).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = ", ".join(f"('{v}', '{r}')" for v, r in RULES)
    return judge(pages, spark.sql(f"SELECT * FROM VALUES {rows} AS t(verdict, rule)"))


SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS k FROM pages),
r AS (SELECT page_id, CASE WHEN k > 0 THEN substr(url, k + 3) ELSE '' END AS rest FROM u),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
rules(verdict, rule, h, q) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
m AS (
  SELECT p.*, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS k
  FROM p LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
