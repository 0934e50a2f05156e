"""Quality classifier by co-training.

Two logistic classifiers look at a document from two sides: its whole text
(hashed words and statistics of characters, words and lines), and its metadata
(language, source, length). In each round each view scores all documents without a label in
the training sample and hands those of which it is surest, in the labelled
classes' proportion, to the other view as pseudo-labels. Confidence is calibrated on
held-out labelled rows; a view whose sure calls aren't right there gives none. At the
end both views are calibrated together on the held-out rows and all documents are scored.

Features are made once, over whole texts, and written. Fitting takes at most ``max_labelled`` labelled rows, those
with the smallest hash of their id, and a tenth as many pseudo-labels a round and view; only these
come to the driver, which fits the models. The pool is every other document: each
task keeps its surest, one of each content, and these meet in FAN tasks, then in the driver.

Defined results: a null text has no words; null metadata is a value of its own; a
document labelled more than once has its mean label (a half counts as good);
labels of unknown documents don't count; with labels of one class or none, every score is
the smoothed share of good labels (0.5 without labels), and 0.5 or more is kept;
of rows that share an id the one with the smallest hash of its features is the labelled one; repeated rows
are scored each and are one document of the pool; ties go to the smaller hash of the features; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import slices, written

MAX_LABELLED = 6_000
ROUNDS = 4
WORD_DIMS = 1 << 12
META_DIMS = 1 << 8
#: A pseudo-label needs this share of right calls at its confidence on held-out rows.
SURE = 0.95
KEEP = 0.5
STATS = 16
#: Tasks in which the surest documents of all tasks meet.
FAN = 32
#: UTF-8 bytes of the texts that a worker holds as Python strings.
SLICE_BYTES = 1_000_000
FEATURES = "doc_id long, fkey long, words binary, stats binary, meta binary"


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words (distinct, as buckets) and STATS numbers between 0 and about 1, over the whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    counts = Counter(words)
    buckets = np.unique(np.fromiter((zlib.crc32(w) for w in counts), np.int64, len(counts)) % WORD_DIMS)
    lines = [x for x in text.split("\n") if x.strip()]
    alpha = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    top = counts.most_common(1)[0][1] if counts else 0
    stats = np.array(
        [
            np.log1p(n) / 12,
            len(counts) / max(n, 1),
            top / max(n, 1),
            alpha / size,
            upper / max(alpha, 1),
            (size - len(raw.translate(None, b"#*$%&|<>"))) / size,
            raw.count(b"|") / max(n, 1),
            raw.count(b"!") / max(n, 1),
            raw.count(b"?") / max(n, 1),
            (size - len(raw.translate(None, b"0123456789"))) / size,
            (raw.count(b".") + raw.count(b",")) / max(n, 1),
            (len(raw) - sum(map(len, words))) / size,
            min(1.0, sum(map(len, words)) / max(n, 1) / 20),
            len(lines) / max(n, 1),
            1 - len(set(lines)) / max(len(lines), 1),
            (size - len(raw.translate(None, bytes(range(128, 256))))) / size,
        ]
    )
    return buckets, stats


def meta_features(lang, source, n_chars) -> np.ndarray:
    """Buckets of the metadata."""
    long = "none" if n_chars is None or n_chars != n_chars else str(int(np.log2(max(float(n_chars), 1)) * 2))
    names = (f"l{lang}", f"s{source}", f"n{long}", f"x{lang}/{source}")
    return np.unique([zlib.crc32(x.encode("utf-8", "surrogatepass")) % META_DIMS for x in names])


class Buckets:
    """Sets of buckets of many rows, one after another."""

    def __init__(self, column: pa.Array):
        """column: a row's buckets as unsigned 16-bit numbers."""
        _, places, data = column.buffers()
        at = np.frombuffer(places, dtype="<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64) // 2 if len(column) else np.zeros(1, np.int64)
        self.flat = np.frombuffer(data, dtype="<u2")[at[0] : at[-1]].astype(np.int64) if data is not None and len(column) else np.empty(0, np.int64)
        self.size = np.diff(at)
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        self.scale = 1 / np.sqrt(np.maximum(self.size, 1))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.flat], len(self.size)) * self.scale


class Logistic:
    """Logistic regression on buckets and numbers, by gradient descent with momentum; rows weigh the same in both classes."""

    def __init__(self, dims: int, numbers: int):
        self.w, self.v, self.b, self.mean, self.sd = np.zeros(dims), np.zeros(numbers), 0.0, np.zeros(numbers), np.ones(numbers)

    def raw(self, buckets: Buckets, numbers: np.ndarray) -> np.ndarray:
        return buckets.dot(self.w) + ((numbers - self.mean) / self.sd) @ self.v + self.b

    def fit(self, buckets: Buckets, numbers: np.ndarray, y: np.ndarray, steps: int = 200, rate: float = 1.0, l2: float = 1e-4) -> Logistic:
        self.mean, self.sd = numbers.mean(axis=0), np.maximum(numbers.std(axis=0), 1e-6)
        z = (numbers - self.mean) / self.sd
        weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        mw, mv, mb = np.zeros_like(self.w), np.zeros_like(self.v), 0.0
        for _ in range(steps):
            p = sigmoid(buckets.dot(self.w) + z @ self.v + self.b)
            g = (p - y) * weight
            mw = 0.9 * mw + np.bincount(buckets.flat, (g * buckets.scale)[buckets.row], len(self.w)) + l2 * self.w
            mv = 0.9 * mv + z.T @ g + l2 * self.v
            mb = 0.9 * mb + g.sum()
            self.w, self.v, self.b = self.w - rate * mw, self.v - 0.3 * rate * mv, self.b - 0.3 * rate * mb
        return self


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic scale of the views' raw scores (columns of x) and a constant; as likely classes as in y."""
    sd = np.maximum(x.std(axis=0), 1e-6)
    z, w = np.column_stack([x / sd, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # keeps separable classes finite
    for _ in range(steps):
        p = sigmoid(z @ w)
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z / len(z) + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (p - target) / len(z) + 1e-4 * w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    w[:-1] /= sd
    return w


def features(docs: DataFrame) -> DataFrame:
    """FEATURES of each row: buckets and numbers as bytes, and a hash of them."""

    def f(batches):
        for b in batches:
            for first, some in slices(b.column("text").cast(pa.string()), SLICE_BYTES):
                n = len(some)
                made = [text_features(t) for t in some.to_pylist()]
                own = zip(*(b.column(c).slice(first, n).to_pylist() for c in ("lang", "source", "n_chars")))
                words, stats = [w.astype("<u2").tobytes() for w, _ in made], [x.astype("<f8").tobytes() for _, x in made]
                meta = [meta_features(*m).astype("<u2").tobytes() for m in own]
                keys = np.array([xxhash.xxh64_intdigest(x + y + z, len(x)) for x, y, z in zip(words, stats, meta)], dtype=np.uint64).view(np.int64)
                kept = [pa.array(x, pa.binary()) for x in (words, stats, meta)]
                yield pa.record_batch([b.column("doc_id").slice(first, n), pa.array(keys), *kept], names=["doc_id", "fkey", "words", "stats", "meta"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    return rows.mapInArrow(f, FEATURES)


def inputs(batch: pa.RecordBatch) -> list[tuple[Buckets, np.ndarray]]:
    """What each view sees of the rows."""
    stats = np.frombuffer(b"".join(batch.column("stats").to_pylist()), dtype="<f8").reshape(-1, STATS)
    return [(Buckets(batch.column("words")), stats), (Buckets(batch.column("meta")), np.zeros((batch.num_rows, 0)))]


SURE_ROWS = "view int, call int, raw double, fkey long, words binary, stats binary, meta binary"


def surest(best: list[pa.Table], most: dict[int, int]) -> pa.Table:
    """Of rows of SURE_ROWS the surest of each view and call, one a content: the smallest raw scores for call 0, the greatest for call 1."""
    rows = pa.concat_tables(best)
    view, call, raw, key = (rows.column(c).to_numpy() for c in ("view", "call", "raw", "fkey"))
    order = np.lexsort((key, np.where(call == 1, -raw, raw), call, view))
    kept, seen, count = [], set(), Counter()
    for i, v, c, k in zip(order.tolist(), view[order].tolist(), call[order].tolist(), key[order].tolist()):
        if count[v, c] < most[c] and (v, c, k) not in seen:
            seen.add((v, c, k))
            count[v, c] += 1
            kept.append(i)
    return rows.take(pa.array(kept, pa.int64()))


def sure_calls(feats: DataFrame, views: list[Logistic], most: dict[int, int], taken: list[set[int]]) -> list[dict]:
    """The documents of which each view is surest and that the other view has no label of (taken: fkeys by view that got them), in order."""
    schema = pa.schema([("view", pa.int32()), ("call", pa.int32()), ("raw", pa.float64()), ("fkey", pa.int64()), ("words", pa.binary()), ("stats", pa.binary()), ("meta", pa.binary())])
    known = [np.array(sorted(t), dtype=np.int64) for t in taken]

    def score_all(batches):
        best = [schema.empty_table()]
        for b in batches:
            key = b.column("fkey").to_numpy()
            for v, (model, (buckets, numbers)) in enumerate(zip(views, inputs(b))):
                raw = model.raw(buckets, numbers)
                free = np.flatnonzero(~np.isin(key, known[1 - v]))
                order = free[np.lexsort((key[free], raw[free]))]
                for call, some in ((0, order), (1, order[np.lexsort((key[order], -raw[order]))])):
                    some = some[np.sort(np.unique(key[some], return_index=True)[1])[: most[call]]]
                    got = pa.table([np.full(len(some), v, np.int32), np.full(len(some), call, np.int32), raw[some], key[some], *[b.column(c).take(pa.array(some)) for c in ("words", "stats", "meta")]], schema=schema)
                    best.append(got)
            best = [surest(best, most)]
        yield from best[0].to_batches()

    def again(batches):
        best = [schema.empty_table()]
        for b in batches:
            best = [surest([*best, pa.Table.from_batches([b.cast(schema)])], most)]
        yield from best[0].to_batches()

    met = feats.select("fkey", "words", "stats", "meta").mapInArrow(score_all, SURE_ROWS).repartition(FAN, "fkey").mapInArrow(again, SURE_ROWS)
    return surest([schema.empty_table(), met.toArrow().cast(schema)], most).to_pylist()


def co_train(feats: DataFrame, known: list[dict], rounds: int = ROUNDS) -> dict:
    """known: the labelled rows, with y, in order of doc_id. Returns the models and the joint calibration, as arrays."""
    y = np.array([r["y"] for r in known])
    held = np.flatnonzero(np.arange(len(known)) % 4 == 3)
    train = np.flatnonzero(np.arange(len(known)) % 4 != 3)
    if len(set(y[train].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        held = train = np.arange(len(known))  # too few labels to hold some out
    share, size = y.mean(), max(10, len(known) // 10)
    most = {0: max(1, round(size * (1 - share))), 1: max(1, round(size * share))}
    rows = [[known[i] for i in train.tolist()] for _ in range(2)]
    calls = [y[train].tolist() for _ in range(2)]
    taken = [{r["fkey"] for r in known} for _ in range(2)]

    def seen(some: list[dict], view: int) -> tuple[Buckets, np.ndarray]:
        return inputs(pa.record_batch([pa.array([r[c] for r in some], pa.binary()) for c in ("words", "stats", "meta")], names=["words", "stats", "meta"]))[view]

    apart = [seen([known[i] for i in held.tolist()], v) for v in range(2)]
    for k in range(rounds + 1):
        views = [Logistic(dims, n).fit(*seen(rows[v], v), np.array(calls[v])) for v, (dims, n) in enumerate(((WORD_DIMS, STATS), (META_DIMS, 0)))]
        raw = [views[v].raw(*apart[v]) for v in range(2)]
        if k == rounds:
            break
        found, given = sure_calls(feats, views, most, taken), 0
        for v in range(2):
            for call in (0, 1):
                some = [r for r in found if r["view"] == v and r["call"] == call]
                if not some:
                    continue
                limit = some[-1]["raw"]
                like = y[held][raw[v] >= limit if call else raw[v] <= limit]
                if len(like) >= 5 and (like == call).mean() >= SURE:
                    some = [r for r in some if r["fkey"] not in taken[1 - v]]
                    rows[1 - v] += some
                    calls[1 - v] += [float(call)] * len(some)
                    taken[1 - v].update(r["fkey"] for r in some)
                    given += len(some)
        if not given:
            break
    joint = np.column_stack(raw)
    return {
        "w": views[0].w, "v": views[0].v, "b": np.array([views[0].b]), "mean": views[0].mean, "sd": views[0].sd,
        "mw": views[1].w, "mb": np.array([views[1].b]), "joint": calibrate(joint, y[held]),
        "text": calibrate(joint[:, :1], y[held]), "meta": calibrate(joint[:, 1:], y[held]),
    }


def sample_ids(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of doc_id; only about twice as many are compared."""
    n = ids.count()
    h = F.xxhash64(F.lit(8), "doc_id")
    if n > 2 * most:
        ids = ids.filter(h < F.lit(int(-(2**63) + 2**64 * (2 * most / n)))) if 2 * most / n < 0.999 else ids
    return ids.orderBy(h, "doc_id").limit(most)


def fit_features(feats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> tuple[float, dict | None]:
    """As fit(), of written features."""
    of = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    ids = feats.select("doc_id").filter("doc_id is not null").distinct()
    chosen = written(sample_ids(written(ids.join(of, "doc_id"), "labelled"), max_labelled), "chosen")
    # at most max_labelled rows: of rows that share an id one
    best = F.min(F.struct("fkey", "words", "stats", "meta")).alias("x")
    known = feats.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(best).select("doc_id", "y", "x.*").orderBy("doc_id")
    known = [r.asDict() for r in known.collect()]
    good = sum(r["y"] == 1 for r in known)
    share = (good + 1) / (len(known) + 2)
    if not good or good == len(known):
        return share, None
    return share, co_train(feats, known, rounds)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> tuple[float, dict | None]:
    """Share of good labels, and the model (None without both classes). docs: doc_id, text, lang, source, n_chars."""
    return fit_features(written(features(docs), "features"), labels, max_labelled, rounds)


def score_features(feats: DataFrame, share: float, model: dict | None, keep: float = KEEP) -> DataFrame:
    """As score(), of features."""

    def scores(batches):
        words, meta = Logistic(WORD_DIMS, STATS), Logistic(META_DIMS, 0)
        if model:
            words.w, words.v, words.b, words.mean, words.sd = model["w"], model["v"], model["b"][0], model["mean"], model["sd"]
            meta.w, meta.b = model["mw"], model["mb"][0]
        for b in batches:
            n = b.num_rows
            t, s = [np.full(n, share)] * 2, np.full(n, share)
            if model and n:
                raw = [m.raw(*x) for m, x in zip((words, meta), inputs(b))]
                t = [sigmoid(np.column_stack([x, np.ones(n)]) @ model[k]) for x, k in zip(raw, ("text", "meta"))]
                s = sigmoid(np.column_stack([*raw, np.ones(n)]) @ model["joint"])
            yield pa.record_batch([b.column("doc_id"), *map(pa.array, (*t, s, s >= keep))], names=["doc_id", "text_score", "meta_score", "score", "kept"])

    return feats.mapInArrow(scores, "doc_id long, text_score double, meta_score double, score double, kept boolean")


def score(docs: DataFrame, share: float, model: dict | None, keep: float = KEEP) -> DataFrame:
    """doc_id, text_score, meta_score, score, kept; a row for each row of docs."""
    return score_features(features(docs), share, model, keep)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = written(features(spark.read.parquet(f"{sf_dir}/documents.parquet")), "features")
    return score_features(feats, *fit_features(feats, spark.read.parquet(f"{sf_dir}/labels.parquet")))
