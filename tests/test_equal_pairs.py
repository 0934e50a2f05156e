"""Equal reads in equal windows are looked at once, whatever order and batches they come in."""

import random

import pyarrow as pa

from helixframe.operators.align import equal_pairs
from helixframe.operators.align import kernels as k


def made(n):
    r = random.Random(5)
    texts = ["".join(r.choice("ACGT") for _ in range(60)) for _ in range(4)]
    rows = [(i, texts[i % 4][10 + i % 3 : 40 + i % 3], texts[i % 4]) for i in range(n)]
    r.shuffle(rows)
    return rows


def test_a_kernel_gets_each_pair_once(monkeypatch):
    rows, asked = made(300), []

    def kernel(reads, refs):
        asked.extend(zip(reads, refs))
        return k.edit_infixes(reads, refs)[0].tolist(), [x[:3] for x in reads]

    batches = [pa.record_batch([pa.array(c) for c in zip(*rows[i : i + 50])], names=["ord", "read", "seq"]) for i in range(0, 300, 50)]
    want = sorted((i, k.edit_infix(x, y)[0], x[:3]) for i, x, y in rows)
    for most in (1000, 5):  # remembered, and forgotten between batches
        asked.clear()
        monkeypatch.setattr(equal_pairs, "MOST", most)
        out = list(equal_pairs._told(iter(batches), kernel, {"distance": "int", "head": "string"}))
        assert sorted(tuple(r.values()) for b in out for r in b.to_pylist()) == want
        assert len(set(asked)) == 12 and (len(asked) == 12) == (most > 12)


def test_windows_of_one_text_count_as_one(spark):
    rows = made(40)
    at = {y: i * 100 for i, y in enumerate(sorted({y for _, _, y in rows}))}
    # each text stands at two places, once in lower case
    reads = spark.createDataFrame([(i, "c", at[y] + (1000 if i % 2 else 0), at[y] + 60, x) for i, x, y in rows], "ord long, chrom string, s long, e long, read string")
    windows = spark.createDataFrame([("c", s + d, s + 60, y.lower() if d else y) for y, s in at.items() for d in (0, 1000)], "chrom string, s long, e long, seq string")

    def kernel(some, refs):
        e = k.affine_local(list(some), list(refs))
        return [x.score for x in e], [x.ref_start for x in e]

    got = equal_pairs.each_once(reads, windows, kernel, "score int, ref_start int", 3)
    assert sorted(map(tuple, got.collect())) == sorted((i, e.score, e.ref_start) for i, x, y in rows for e in k.affine_local([x], [y]))


def test_queries_deal_reads_by_what_they_are(spark, sf):
    from helixframe.plans import alignment

    for q in (alignment.edit_distances, alignment.affine_extension):
        assert "hashpartitioning(read" in q(spark, sf)._jdf.queryExecution().executedPlan().toString()
