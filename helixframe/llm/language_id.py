"""Language ID: a bidirectional gated recurrent network over bytes.

A text is its runs of letters (ASCII letters, A-Z lower-cased, and all bytes of other
characters; a run of more than MAX_RUN bytes is cut). The network reads each run's bytes forwards and
backwards from a fresh state, with a mark at both ends, and gives every position a
probability of each language. A document's probability is the mean over all its
positions, so it is linear in how often each run occurs: each task labels a run once, keeps
the sums in a memo bounded by runs, and adds them up over the whole text.

Training data: of each language the documents with the smallest hash of their id, TRAIN_DOCS in
all, and of each RUNS_PER_DOC runs that are dealt evenly over its whole text. Only
those runs come to the driver, which trains by backpropagation through time in NumPy, with
Adam and a fixed seed. All other documents are scored, and none of theirs is learned.

Defined results: held-out documents (CRC-32 of the id as text, modulo 3, is 1) are never
learned from; a null id counts as an empty text; a null or empty text, or one without a letter, is ``und`` with
score 0; with one
learned language all texts with letters get it with score 1, with none ``und``; languages tie to the smaller
by code points; repeated rows are predicted each; more languages than TRAIN_DOCS are learned from the
first documents by hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import slices, written

#: At most so many documents are learned from, and so many runs of each.
TRAIN_DOCS = 1600
RUNS_PER_DOC = 48
MAX_RUN = 24
HIDDEN = 16
EMBED = 12
EPOCHS = 4
BATCH = 512
RATE = 0.01
SEED = 13
#: Runs whose labels a task keeps; the memo starts anew beyond.
MEMO = 400_000
SLICE_BYTES = 2_000_000
#: ASCII letters in lower case; all else below 128 parts runs.
_FOLD = bytes(i if i >= 128 or 97 <= i <= 122 else i + 32 if 65 <= i <= 90 else 32 for i in range(256))
#: Symbols: 0 none, 1 a run's end, then a-z and the bytes from 128 on.
_SYMBOL = np.array([0] * 97 + [i - 97 + 2 for i in range(97, 123)] + [0] * 5 + [i - 128 + 28 for i in range(128, 256)], dtype=np.int64)
SYMBOLS = 156


def runs_of(text: bytes) -> list[bytes]:
    """The text's runs of letters, in order."""
    runs = text.translate(_FOLD).split()
    if len(text) > MAX_RUN and any(len(r) > MAX_RUN for r in runs):
        runs = [r[i : i + MAX_RUN] for r in runs for i in range(0, len(r), MAX_RUN)]
    return runs


def symbols(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the runs with a mark at both ends, padded by 0 on the right; and lengths with the marks."""
    size = np.fromiter(map(len, runs), np.int64, len(runs))
    out = np.zeros((len(runs), int(size.max(initial=0)) + 2), dtype=np.int64)
    flat = _SYMBOL[np.frombuffer(b"".join(runs), np.uint8)]
    row = np.repeat(np.arange(len(runs)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at + 1] = flat
    out[:, 0] = 1
    out[np.arange(len(runs)), size + 1] = 1
    return out, size + 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """A gated recurrent unit each way, and a softmax over both states at each position."""

    def __init__(self, langs: int, hidden: int = HIDDEN, embed: int = EMBED, seed: int = SEED, kind: type = np.float32):
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(kind)

        self.hidden = hidden
        self.p = {"e": normal(SYMBOLS, embed), "wo": normal(2 * hidden, langs), "bo": np.zeros(langs, kind)}
        for way in "fb":
            # columns: update gate, reset gate, candidate
            self.p |= {f"wx{way}": normal(embed, 3 * hidden), f"wh{way}": normal(hidden, 3 * hidden), f"b{way}": np.zeros(3 * hidden, kind)}

    def _states(self, x: np.ndarray, size: np.ndarray, way: str) -> list[tuple]:
        """Steps in the order of time, each: place, who goes on, state before, update, reset, candidate, state after."""
        h, kind = self.hidden, self.p["e"].dtype
        inputs = (self.p["e"] @ self.p[f"wx{way}"] + self.p[f"b{way}"])[x]
        wh = self.p[f"wh{way}"]
        state, steps = np.zeros((len(x), h), kind), []
        for t in range(x.shape[1]) if way == "f" else range(x.shape[1] - 1, -1, -1):
            on = (t < size)[:, None].astype(kind)
            gates = _sigmoid(inputs[:, t, : 2 * h] + state @ wh[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(inputs[:, t, 2 * h :] + (r * state) @ wh[:, 2 * h :])
            after = state + on * z * (c - state)
            steps.append((t, on, state, z, r, c, after))
            state = after
        return steps

    def probabilities(self, x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, dict]:
        """A probability of each language at each place (rows, places, languages), and what training needs."""
        kept = {way: self._states(x, size, way) for way in "fb"}
        both = np.empty((*x.shape, 2 * self.hidden), self.p["e"].dtype)
        for i, way in enumerate("fb"):
            for t, *_, after in kept[way]:
                both[:, t, i * self.hidden : (i + 1) * self.hidden] = after
        logits = both @ self.p["wo"] + self.p["bo"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=2, keepdims=True), kept | {"both": both}

    def loss(self, x: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over positions, and its gradients by backpropagation through time."""
        h = self.hidden
        p, kept = self.probabilities(x, size)
        on = np.arange(x.shape[1])[None, :] < size[:, None]
        w = (on * weight[:, None] / (size * weight).sum()).astype(p.dtype)
        right = p[np.arange(len(x)), :, y]
        total = float(-(w * np.log(np.maximum(right, 1e-30))).sum())
        d = p.copy()
        d[np.arange(len(x)), :, y] -= 1
        d *= w[:, :, None]
        both = kept["both"]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["wo"] = both.reshape(-1, 2 * h).T @ d.reshape(-1, d.shape[2])
        g["bo"] = d.sum(axis=(0, 1))
        d_both = d @ self.p["wo"].T
        for i, way in enumerate("fb"):
            wh = self.p[f"wh{way}"]
            back = np.zeros((len(x), h), p.dtype)
            inputs = np.zeros((*x.shape, 3 * h), p.dtype)
            for t, live, state, z, r, c, _ in reversed(kept[way]):
                da = back + d_both[:, t, i * h : (i + 1) * h]
                dc = da * live * z * (1 - c * c)
                dz = da * live * (c - state) * z * (1 - z)
                reset = dc @ wh[:, 2 * h :].T
                dr = reset * state * r * (1 - r)
                gates = np.concatenate([dz, dr], axis=1)
                back = da * (1 - live * z) + reset * r + gates @ wh[:, : 2 * h].T
                inputs[:, t] = np.concatenate([gates, dc], axis=1)
                g[f"wh{way}"][:, : 2 * h] += state.T @ gates
                g[f"wh{way}"][:, 2 * h :] += (r * state).T @ dc
            flat = inputs.reshape(-1, 3 * h)
            by_symbol = np.zeros((SYMBOLS, 3 * h), p.dtype)
            np.add.at(by_symbol, x.ravel(), flat)
            g[f"wx{way}"] = self.p["e"].T @ by_symbol
            g[f"b{way}"] = flat.sum(axis=0)
            g["e"] += by_symbol @ self.p[f"wx{way}"].T
        return total, g

    def label(self, runs: list[bytes]) -> np.ndarray:
        """For each run the sums of its positions' probabilities over its letters' bytes."""
        out = np.zeros((len(runs), self.p["bo"].shape[0]))
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))  # like lengths together
        for i in range(0, len(order), 4 * BATCH):
            some = order[i : i + 4 * BATCH]
            x, size = symbols([runs[j] for j in some])
            p, _ = self.probabilities(x, size)
            place = np.arange(x.shape[1])[None, :]
            out[some] = (p * ((place > 0) & (place < size[:, None] - 1))[:, :, None]).sum(axis=1)
        return out


def train(runs: list[bytes], y: np.ndarray, langs: int, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam over shuffled batches of runs of like length; languages weigh the same."""
    net, rng = Network(langs, seed=seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2))
    each = np.bincount(y, minlength=langs)
    weight = (len(y) / (langs * np.maximum(each, 1)))[y]
    step, length = 0, np.fromiter(map(len, runs), np.int64, len(runs))
    for epoch in range(epochs):
        order = np.lexsort((rng.permutation(len(runs)), length))
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)).tolist():
            some = batches[k]
            x, size = symbols([runs[i] for i in some.tolist()])
            _, g = net.loss(x, size, y[some], weight[some])
            step += 1
            rate = RATE * (1 - epoch / (2 * epochs))
            for name, d in g.items():
                m[name] = 0.9 * m[name] + 0.1 * d
                v[name] = 0.99 * v[name] + 0.01 * d * d
                net.p[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)).astype(net.p[name].dtype)
    return net


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sampled_runs(docs: DataFrame, most: int = TRAIN_DOCS, per_doc: int = RUNS_PER_DOC, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[bytes, str]]:
    """At most most * per_doc runs with their languages, in an order that depends on the documents alone."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fit = own.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out(F.col("doc_id")))
    h = F.xxhash64(F.lit(SEED), F.col("doc_id").cast("string"))
    keys = fit.select("lang", h.alias("h"), F.xxhash64("text").alias("t"))
    langs = keys.select("lang").distinct().count()
    if not langs:
        return []
    share = max(1, min(most // langs, 1000))  # up to 1,000 a window keeps only the first rows of each task
    first = keys.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))).filter(F.col("i") <= share)
    chosen = written(first.orderBy("i", "h", "t", "lang").limit(most), "language-sample")

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, some in slices(b.column("text"), SLICE_BYTES):
                for i, text in enumerate(some.cast(pa.binary()).to_pylist()):
                    runs = runs_of(text)
                    at = sorted({int(x) for x in (np.arange(per_doc) + 0.5) * len(runs) / per_doc}) if runs else []
                    own = [b.column(c).slice(first + i, 1) for c in ("lang", "h", "t")]
                    yield pa.record_batch([*own, pa.array([[runs[j] for j in at]], pa.list_(pa.binary()))], names=["lang", "h", "t", "runs"])

    texts = fit.select("lang", h.alias("h"), F.xxhash64("text").alias("t"), "text").join(F.broadcast(chosen.select("lang", "h", "t")), ["lang", "h", "t"])
    rows = texts.mapInArrow(f, "lang string, h long, t long, runs array<binary>").dropDuplicates(["lang", "h", "t"]).orderBy("lang", "h", "t").collect()  # bounded by most and per_doc
    return [(bytes(r), x["lang"]) for x in rows for r in x["runs"]]


def fit(docs: DataFrame, most: int = TRAIN_DOCS, per_doc: int = RUNS_PER_DOC, **names: str) -> tuple[list[str], Network | None]:
    """The learned languages in order, and the network (None if there are fewer than two)."""
    runs = sampled_runs(docs, most, per_doc, **names)
    langs = sorted({lang for _, lang in runs})
    if len(langs) < 2:
        return langs, None
    place = {x: i for i, x in enumerate(langs)}
    return langs, train([r for r, _ in runs], np.array([place[x] for _, x in runs]), len(langs))


def predict(docs: DataFrame, langs: list[str], net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score; a row for each row of docs. Only the text is looked at."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        sums = np.zeros((1024, len(langs) + 1))  # a run's sums, and its bytes

        def places(runs: list[bytes]) -> np.ndarray:
            """Where the runs' sums stand."""
            nonlocal sums
            new = [r for r in dict.fromkeys(runs) if r not in memo]
            if new:
                if len(memo) + len(new) > MEMO:
                    memo.clear()
                    new = list(dict.fromkeys(runs))
                n = len(memo)
                if n + len(new) > len(sums):
                    sums = np.concatenate([sums, np.zeros((max(len(sums), len(new)), sums.shape[1]))])
                sums[n : n + len(new), :-1] = net.label(new)
                sums[n : n + len(new), -1] = np.fromiter(map(len, new), np.int64, len(new))
                memo.update(zip(new, range(n, n + len(new))))
            return np.fromiter(map(memo.__getitem__, runs), np.int64, len(runs))

        for b in batches:
            for first, some in slices(b.column("text"), SLICE_BYTES):
                n = len(some)
                letters = b.column("letters").slice(first, n).to_numpy(zero_copy_only=False).astype(bool)
                best, score = np.zeros(n, np.int64), np.where(letters, 1.0, 0.0)
                if net:
                    runs = [runs_of(t) if ok else [] for t, ok in zip(some.cast(pa.binary()).to_pylist(), letters.tolist())]
                    size = np.fromiter(map(len, runs), np.int64, n)
                    at = places([r for rs in runs for r in rs])
                    total = np.zeros((n, len(langs) + 1))
                    full = np.flatnonzero(size)
                    if len(full):
                        total[full] = np.add.reduceat(sums[at], (np.cumsum(size) - size)[full], axis=0)
                    p = total[:, :-1] / np.maximum(total[:, -1:], 1)
                    best, score = p.argmax(axis=1), np.where(letters, np.clip(p.max(axis=1), 0, 1), 0.0)
                names = [langs[i] if ok and langs else "und" for i, ok in zip(best.tolist(), letters.tolist())]
                score = score if langs else np.zeros(n)
                ids = [b.column(c).slice(first, n) for c in ("doc_id", "held_out")]
                yield pa.record_batch([*ids, pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(F.col(f"`{id_col}`")).alias("held_out"), text.alias("text"), F.coalesce(text.rlike("\\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(f, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, *fit(docs))
