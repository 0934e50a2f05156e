"""Phrase collocation mining by pivot partitioning.

1. Texts become blocks: for each language a stream of word numbers, cut at the ends of
   pieces, and the block's words with their counts. Only words and counts are shuffled
   for the corpus counts; frequent words are ranked by (count descending, lang, word), so
   a smaller rank is a more frequent word, and no two languages share one.
2. A join on the word gives each block the ranks of its own frequent words; no task has the whole dictionary.
   An n-gram's pivot is its rarest word, the leftmost one of equal words. Each place of a block sends the
   fragment around it to its word's bucket: at most MAX_WORDS - 1 words to either side, cut before
   the first word that is infrequent or rarer (on the left, as rare). Places with no word beside them send nothing. Equal fragments of a block are
   one, with a count, so copies cost little.
3. A bucket counts the n-grams of its fragments that hold the place itself, which are those that the
   pivot owns, and each is counted in one place only. Buckets are as many as the corpus needs at
   BUCKET_PLACES places each; a word with more places than that is dealt to several buckets by a hash
   of its fragment, and their counts are added before the threshold.

Phrases are then scored in joins over what is frequent: every part of a candidate is itself at least as
frequent, so its count is in the table of frequent words and phrases. The first of a language come
from a range partitioning and its counts, so no task ranks a whole language.

Defined results: a null or empty text has no words; a null lang is ``und``, and shares its counts
with rows that say ``und``; rows that repeat count as often as they stand there; only A-Z are lower-cased; other white space than
space and tab is part of words; ties are broken as the contract says and never by chance; no
candidates give no rows; other columns are not read. A language's total counts all words, frequent or not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import join_by_key, slices, written

MAX_WORDS = 4
MIN_COUNT = 30
FIRST = 2000
ABSORB = 80
SCALE = 2_000_000
#: UTF-8 bytes of text in a block, and of texts that are Python objects at a time.
BLOCK_BYTES = 8_000_000
SLICE_BYTES = 1_000_000
#: Places of frequent words that a bucket takes on average; a word with more is dealt to several.
BUCKET_PLACES = 1_000_000
#: Fragments of a bucket that are expanded at a time.
CHUNK = 1_000_000
#: A-Z in lower case, tab as space, and the ends of pieces as a full stop.
_FOLD = bytes(ord(".") if chr(i) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))
_WORDS = ["g1", "g2", "g3", "g4"]


class _Numbers(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _tokens(text: bytes) -> list[bytes]:
    """Words in order, and b"." where a piece ends; one stands at the end."""
    return (text.translate(_FOLD).replace(b".", b" . ") + b" .").split()


def _parts(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes, cut where pieces end; a piece is never cut."""
    end = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
    at = 0
    while len(text) - at > most:
        cut = end.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


BLOCKS = "block long, lang string, words array<string>, counts array<long>, stream binary"


def blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """BLOCKS: words of a block and language, their counts, and the places' word numbers plus 1 (0: a piece ends) as packed 32-bit integers."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, packer = 0, zstandard.ZstdCompressor(level=1)
        numbers: dict[str, _Numbers] = {}
        streams: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            nonlocal made, size
            for lang, stream in streams.items():
                ids = np.concatenate(stream)
                counts = np.bincount(ids, minlength=len(numbers[lang]))[1:]
                words = [w.decode("utf-8", "surrogatepass") for w in numbers[lang]][1:]
                at = (TaskContext.get().partitionId() << 32) + made
                yield pa.record_batch([pa.array([at]), pa.array([lang]), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())), pa.array([packer.compress(ids.tobytes())], pa.binary())], names=["block", "lang", "words", "counts", "stream"])
            made, size = made + 1, 0
            numbers.clear()
            streams.clear()

        for b in batches:
            for first, some in slices(b.column("text"), SLICE_BYTES):
                for text, lang in zip(some.cast(pa.binary()).to_pylist(), b.column("lang").slice(first, len(some)).to_pylist()):
                    for part in _parts(text, BLOCK_BYTES):
                        tokens = _tokens(part)
                        if len(tokens) > 1:
                            own = numbers.setdefault(lang, _Numbers({b".": 0}))
                            streams.setdefault(lang, []).append(np.fromiter(map(own.__getitem__, tokens), np.int32, len(tokens)))
                        size += len(part)
                        if size >= BLOCK_BYTES:
                            yield from flush()
        yield from flush()

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    return rows.mapInArrow(f, BLOCKS)


def ranked(rows: DataFrame, *order: Column, within: str | None = None, most: int | None = None) -> DataFrame:
    """rows with ``rank`` from 1 in the given order; with ``within`` (which the order starts with), from 1 for each of its values, up to ``most``.

    Ranks come from a range partitioning and its counts; no task gets more than a partition.
    """
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    keys = [within] if within else []
    n = dealt.groupBy("__part", *keys).count()
    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    # a row for each partition (and value of within in it)
    before = n.withColumn("__before", F.sum("count").over(over.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("__part", *keys, F.coalesce("__before", F.lit(0)).alias("__before"))
    if most:
        before = before.filter(F.col("__before") < most)
    own = F.row_number().over(Window.partitionBy("__part", *keys).orderBy(*order))
    out = dealt.join(before, ["__part", *keys]).withColumn("rank", (F.col("__before") + own).cast("long")).drop("__part", "__before")
    return out.filter(F.col("rank") <= most) if most else out


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, f."""
    each = texts.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    return each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))


def _fragments(ids: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with words beside them: the word, and ``reach`` words to the left and right, outward, -1 where cut. ids: ranks, -1 for none."""
    n = len(ids)
    padded = np.concatenate([np.full(reach, -1, np.int32), ids, np.full(reach, -1, np.int32)])
    left, right = np.full((n, reach), -1, np.int32), np.full((n, reach), -1, np.int32)
    go_left, go_right = ids >= 0, ids >= 0
    for d in range(1, reach + 1):
        x = padded[reach - d : reach - d + n]
        go_left = go_left & (x >= 0) & (x < ids)
        left[:, d - 1] = np.where(go_left, x, -1)
        x = padded[reach + d : reach + d + n]
        go_right = go_right & (x >= 0) & (x <= ids)
        right[:, d - 1] = np.where(go_right, x, -1)
    at = np.flatnonzero((left[:, 0] >= 0) | (right[:, 0] >= 0))
    return ids[at], left[at], right[at]


def _mixed(columns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row."""
    h = np.full(len(columns), 0x9E3779B97F4A7C15, np.uint64)
    for i in range(columns.shape[1]):
        h = (h ^ columns[:, i].astype(np.int64).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def _counted(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, their hashes, and summed counts, in order of hash; rows of one hash are told apart."""
    if not len(rows):
        return rows, np.empty(0, np.uint64), counts
    h = _mixed(rows)
    order = np.argsort(h, kind="stable")
    rows, h, counts = rows[order], h[order], counts[order]
    if ((h[1:] == h[:-1]) & (rows[1:] != rows[:-1]).any(axis=1)).any():
        order = np.lexsort([*rows.T, h])
        rows, h, counts = rows[order], h[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[first], h[first], np.add.reduceat(counts, first)


FRAGMENTS = "bucket int, fragments binary"


def fragments(texts: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """FRAGMENTS: for each block and bucket its fragments, packed. words: lang, word, id, f, of the frequent words."""
    reach, per = MAX_WORDS - 1, BUCKET_PLACES

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for b in batches:
            for stream, n, known in zip(b.column("stream"), b.column("n").to_pylist(), b.column("known")):
                places = np.frombuffer(unpacker.decompress(stream.as_py()), np.int32)
                of = known.values.flatten()
                at = of[0].to_numpy() + 1
                ids, times = np.full(n + 1, -1, np.int32), np.zeros(n + 1, np.int64)
                ids[at], times[at] = of[1].to_numpy(), of[2].to_numpy()
                word, left, right = _fragments(ids[places], reach)
                rows, h, counts = _counted(np.column_stack([word, left, right]), np.ones(len(word), np.int64))
                salts = np.maximum(1, -(-times // per))
                hot = np.flatnonzero((salts > 1) & (ids >= 0))
                salt = np.zeros(len(rows), np.int64)
                if len(hot):
                    hot = hot[np.argsort(ids[hot])]
                    own = ids[hot]
                    k = np.minimum(np.searchsorted(own, rows[:, 0]), len(own) - 1)
                    mine = own[k] == rows[:, 0]
                    salt = np.where(mine, (h % salts[hot][k].astype(np.uint64)).astype(np.int64) + 1, 0)
                to = (_mixed(np.column_stack([rows[:, 0], salt])) % np.uint64(buckets)).astype(np.int32)
                order = np.lexsort((rows[:, 0], to))
                rows, to, counts = np.column_stack([rows, counts, salt > 0])[order].astype(np.int32), to[order], counts[order]
                for some in np.split(np.arange(len(rows)), np.flatnonzero(to[1:] != to[:-1]) + 1):
                    if len(some):
                        # column after column packs better
                        yield pa.record_batch([pa.array([to[some[0]]], pa.int32()), pa.array([packer.compress(rows[some].T.tobytes())], pa.binary())], names=["bucket", "fragments"])

    own = texts.select("block", "lang", F.posexplode("words").alias("at", "word"))
    known = own.join(words, ["lang", "word"]).groupBy("block", "lang").agg(F.collect_list(F.struct("at", "id", "f")).alias("known"))  # as many as a block has words
    return texts.select("block", "lang", "stream", F.size("words").alias("n")).join(known, ["block", "lang"]).select("stream", "n", "known").mapInArrow(f, FRAGMENTS)


def _owned(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of fragments that hold the place: words padded by -1, and counts. rows: word, left outward, right outward."""
    reach = MAX_WORDS - 1
    line = np.concatenate([rows[:, reach:0:-1], rows[:, :1], rows[:, 1 + reach : 1 + 2 * reach]], axis=1)
    found, times = [], []
    for start in range(reach + 1):
        for end in range(reach + 1, min(start + MAX_WORDS, 2 * reach + 1) + 1):
            if end - start < 2:
                continue
            at = np.flatnonzero((line[:, start] >= 0) & (line[:, end - 1] >= 0))
            if len(at):
                gram = np.full((len(at), MAX_WORDS), -1, np.int32)
                gram[:, : end - start] = line[at, start:end]
                found.append(gram)
                times.append(counts[at])
    if not found:
        return np.empty((0, MAX_WORDS), np.int32), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(times)


GRAMS = "g1 int, g2 int, g3 int, g4 int, a long, shared boolean"


def mined(sent: DataFrame, least: int) -> DataFrame:
    """g1 to g4 (ids, -1: none), a: the frequent n-grams of two words or more."""
    wide = 1 + 2 * (MAX_WORDS - 1)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()

        def grams(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            for shared in (False, True):
                some = rows[rows[:, wide + 1] == shared]
                total, times = np.empty((0, MAX_WORDS), np.int32), np.empty(0, np.int64)
                for i in range(0, len(some), CHUNK):
                    part, n = _owned(some[i : i + CHUNK, :wide], some[i : i + CHUNK, wide].astype(np.int64))
                    total, _, times = _counted(np.concatenate([total, part]), np.concatenate([times, n]))
                if not shared:
                    total, times = total[times >= least], times[times >= least]
                if len(total):
                    yield pa.record_batch([*(pa.array(total[:, j]) for j in range(MAX_WORDS)), pa.array(times), pa.array(np.full(len(total), shared))], names=[*_WORDS, "a", "shared"])

        bucket, held = None, []
        for b in batches:
            for to, data in zip(b.column("bucket").to_pylist(), b.column("fragments").to_pylist()):
                if to != bucket and held:
                    yield from grams(held)
                    held = []
                bucket = to
                held.append(np.frombuffer(unpacker.decompress(data), np.int32).reshape(wide + 2, -1).T)
        if held:
            yield from grams(held)

    each = written(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(f, GRAMS), "grams")
    whole = each.filter("not shared").select(*_WORDS, "a")
    return whole.unionByName(each.filter("shared").groupBy(_WORDS).agg(F.sum("a").alias("a")).filter(F.col("a") >= least))


def _part(start: int, end: int = MAX_WORDS) -> Column:
    """The words from start (from 0) up to end of g1 to g4, as a key; none stay -1."""
    own = _WORDS[start:end]
    return F.array(*own, *[F.lit(-1)] * (MAX_WORDS - len(own)))


def collocations(docs: DataFrame, least: int = MIN_COUNT, first: int = FIRST, absorb: int = ABSORB, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases. least: 2 or more."""
    texts = written(blocks(docs, text_col, lang_col), "blocks")
    counts = written(word_counts(texts), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.filter(F.col("f") >= least)
    words = written(ranked(frequent, F.desc("f"), F.asc("lang"), F.asc("word")).select("lang", "word", (F.col("rank") - 1).cast("int").alias("id"), "f"), "words")
    places = words.agg(F.sum("f")).first()[0] or 0
    buckets = max(1, -(-places // BUCKET_PLACES))
    grams = written(mined(fragments(texts, words, buckets), least), "phrases").withColumn("m", 2 + (F.col("g3") >= 0).cast("int") + (F.col("g4") >= 0).cast("int"))

    # counts of what a candidate is cut into: words and phrases that are frequent, since the candidate is
    table = words.select(F.array("id", F.lit(-1), F.lit(-1), F.lit(-1)).alias("key"), "f").unionByName(grams.select(F.array(*_WORDS).alias("key"), F.col("a").alias("f")))
    sides = []
    for k in range(1, MAX_WORDS):
        cut = grams.filter(F.col("m") > k)
        sides += [cut.select(*_WORDS, "a", F.lit(k).alias("k"), F.lit(side).alias("side"), key.alias("key")) for side, key in ((0, _part(0, k)), (1, _part(k)))]
    parts = sides[0]
    for x in sides[1:]:
        parts = parts.unionByName(x)
    parts = written(parts, "cuts")
    weights = parts.groupBy("key").agg(F.count("*").alias("__n"))
    found = join_by_key(parts, table.join(weights, "key"), "key", "__n", parts.count())
    cuts = found.groupBy(*_WORDS, "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    scored = cuts.withColumn("score", F.expr(f"cast({SCALE} as decimal(38,0)) * a div cast(l + r as decimal(20,0))"))
    best = scored.groupBy(*_WORDS, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select(*_WORDS, "a", "x.score", "x.l", "x.r")

    # the most frequent longer candidate around each phrase
    inside = None
    for m in range(3, MAX_WORDS + 1):
        for size in range(2, m):
            for start in range(m - size + 1):
                one = grams.filter(F.col("m") == m).select(_part(start, start + size).alias("key"), F.col("a").alias("f"))
                inside = one if inside is None else inside.unionByName(one)
    around = inside.groupBy("key").agg(F.max("f").alias("longer"))
    left = best.withColumn("key", F.array(*_WORDS)).join(around, "key", "left")
    left = written(left.filter(F.col("longer").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("longer") < F.lit(absorb).cast("decimal(20,0)") * F.col("a"))).drop("longer"), "kept-phrases")

    spelt = left.select("key", F.posexplode("key").alias("at", "id")).filter("id >= 0")
    some = spelt.groupBy("id").agg(F.count("*").alias("__n"))
    named = join_by_key(spelt, words.select("id", "lang", "word").join(some, "id"), "id", "__n", left.count() * 3)
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    phrases = named.groupBy("key").agg(F.first("lang").alias("lang"), phrase.alias("phrase"))
    rows = left.join(phrases, "key").select("lang", "phrase", "a", "l", "r", "score")
    top = ranked(rows, F.asc("lang"), F.desc("score"), F.desc("a"), F.asc("phrase"), within="lang", most=first)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m))),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
k AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q, m
  FROM (SELECT c.*, unnest(range(1, m)) AS k FROM c) c),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * k.a) // (x.f + y.f))::BIGINT AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.p AND x.m = k.k JOIN f y ON y.lang = k.lang AND y.phrase = k.q AND y.m = k.m - k.k),
b AS (SELECT lang, phrase, a, unnest(arg_min(struct_pack(l := l, r := r, score := score), row(score, k))) FROM s GROUP BY lang, phrase, a),
i AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(w[j:j + z - 1], ' ') AS phrase
        FROM (SELECT lang, a, w, z, unnest(range(1, m - z + 2)) AS j FROM (SELECT lang, a, w, m, unnest(range(2, m)) AS z FROM c)))
  GROUP BY lang, phrase)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a) t JOIN n USING (lang)
WHERE rank <= 2000
"""
