"""Co-training against a plain version in one process; copies, nulls and ties."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_pairs_and_dedup import DOCS

from helixframe.llm import co_training as co


def plain(docs, labels, rounds):
    """Scores by rounds over lists, without Spark: every choice by sorting all documents."""
    made = {}
    for r in docs:
        w, s = co.text_features(r["text"])
        m = co.meta_features(r["lang"], r["source"], r["n_chars"])
        raw = (w.astype("<u2").tobytes(), s.astype("<f8").tobytes(), m.astype("<u2").tobytes())
        key = np.uint64(co.xxhash.xxh64_intdigest(b"".join(raw), len(raw[0]))).view(np.int64).item()
        made.setdefault(r["doc_id"], (key, *raw))
    means = {}
    for r in labels:
        means.setdefault(r["doc_id"], []).append(r["quality"])
    y = {i: float(np.mean(v) >= 0.5) for i, v in means.items() if i in made}
    known = sorted(y)
    held, train = known[3::4], [i for k, i in enumerate(known) if k % 4 != 3]

    def view(rows, v):
        batch = pa.record_batch([pa.array([r[c] for r in rows], pa.binary()) for c in (1, 2, 3)], names=["words", "stats", "meta"])
        return co.inputs(batch)[v]

    sets = [{made[i][0]: (made[i], y[i]) for i in train} for _ in range(2)]
    closed = [{made[i][0] for i in known} for _ in range(2)]
    pool = list({r[0]: r for r in made.values()}.values())
    share = np.mean([y[i] for i in known])
    size = max(10, len(known) // 10)
    exchanged = 0
    for k in range(rounds + 1):
        models = [co.Logistic(d, n).fit(*view([r for r, _ in sets[v].values()], v), np.array([c for _, c in sets[v].values()])) for v, (d, n) in enumerate(((co.WORD_DIMS, co.STATS), (co.META_DIMS, 0)))]
        if k == rounds:
            break
        before = [set(c) for c in closed]
        for v in range(2):
            free = [r for r in pool if r[0] not in before[1 - v]]
            raw = dict(zip([r[0] for r in free], models[v].raw(*view(free, v)).tolist()))
            apart = list(zip(models[v].raw(*view([made[i] for i in held], v)).tolist(), [y[i] for i in held]))
            for call, n in ((0, max(1, round(size * (1 - share)))), (1, max(1, round(size * share)))):
                some = sorted(free, key=lambda r: (-raw[r[0]] if call else raw[r[0]], r[0]))[:n]
                limit = raw[some[-1][0]]
                like = [c == call for x, c in apart if (x >= limit if call else x <= limit)]
                if len(like) >= 5 and np.mean(like) >= co.SURE:
                    for r in some:
                        if r[0] not in closed[1 - v]:
                            closed[1 - v].add(r[0])
                            sets[1 - v][r[0]] = (r, float(call))
                            exchanged += 1
    joint = np.column_stack([models[v].raw(*view([made[i] for i in held], v)) for v in range(2)])
    scale = co.calibrate(joint, np.array([y[i] for i in held]))
    both = np.column_stack([*[models[v].raw(*view(list(made.values()), v)) for v in range(2)], np.ones(len(made))])
    return dict(zip(made, co.sigmoid(both @ scale).tolist())), exchanged


def test_against_a_plain_version(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    want, exchanged = plain(docs.collect(), labels.collect(), co.ROUNDS)
    assert exchanged > 50
    got = {r["doc_id"]: r["score"] for r in co.score(docs, *co.fit(docs.repartition(5), labels)).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_copies_are_one_document_of_the_pool(spark):
    rows = [(i, ("clean words here %d" % i) * 5 if i % 2 else f"### $$$ %%% {i} " * 5, "en", "s", 10) for i in range(60)]
    d = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    many = d.unionByName(spark.createDataFrame([rows[50]] * 300 + [(None, rows[51][1], "en", "s", 10)] * 50, DOCS))
    share, model = co.fit(d, labels)
    other, again = co.fit(many.withColumn("fkey", F.lit(1)).withColumn("words", F.lit("w")).withColumn("y", F.lit(0)), labels)
    assert share == other and all(np.allclose(model[k], again[k]) for k in model)
    assert co.score(many, share, model).count() == 410


def test_surest_of_ties():
    schema = [("view", pa.int32()), ("call", pa.int32()), ("raw", pa.float64()), ("fkey", pa.int64())]
    t = pa.table([[0] * 6, [0, 0, 0, 1, 1, 1], [1.0, 1.0, 1.0, 5.0, 7.0, 7.0], [3, 2, 2, 9, 8, 7]], schema=pa.schema(schema))
    assert co.surest([t], {0: 2, 1: 2}).column("fkey").to_pylist() == [2, 3, 7, 8]


@pytest.mark.parametrize("text", [None, "", "word " * 200_000])
def test_features_of_extremes(text):
    words, stats = co.text_features(text)
    assert len(stats) == co.STATS and np.isfinite(stats).all() and len(words) <= 1
