"""Stages of the pipeline row by row, the index after a crash, and hosts that go: nulls, repeated rows, ids of several rows, extra columns."""

import pytest
from pyspark.sql import functions as F
from test_pairs_and_dedup import DOCS, docs

import corpus_pipeline
from helixframe.llm import common, exact_dedup, quality_rules, simhash

CLEAN = "w%d " * 30


def clean(k):
    return (CLEAN % tuple(range(k, k + 30))).strip()


@pytest.fixture(params=[1_000_000, 0])
def limit(request, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", request.param)


def test_exact_stage_judges_rows(spark, sf, limit):
    rows = [(1, "a b"), (1, "a      b"), (1, "other"), (2, "ab"), (None, "ab"), (4, "x"), (4, "x"), (None, None), (None, ""), (7, "y")]
    d = docs(spark, rows).withColumn("__keep_id", F.lit(1)).withColumn("digest", F.lit("d")).withColumn("row_id", F.lit(None).cast("string"))
    got = exact_dedup.stage(spark, d, sf)
    assert got.columns == d.columns
    kept = sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=repr)
    assert kept in [sorted([(1, "a      b"), (1, "other"), (4, "x"), (7, "y"), (None, t)], key=repr) for t in (None, "")]
    assert exact_dedup.stage(spark, d.limit(0), sf).count() == 0


def test_a_batch_added_again_gets_the_same_verdicts(spark):
    index = exact_dedup.DigestIndex(spark)
    batch = docs(spark, [(1, "a"), (2, "a "), (3, "b"), (4, "b")])
    index.add(docs(spark, [(9, "b")]))
    want = sorted(map(tuple, index.add(batch, batch_name="two").drop("digest").collect()))
    assert [r[3] for r in want] == [False, True, False, False] and [r[1] for r in want] == [2, 2, 9, 9]
    assert sorted(map(tuple, index.add(batch.repartition(3), batch_name="two").drop("digest").collect())) == want  # as after a crash past the append
    assert index.table().count() == 2
    index.compact()
    assert sorted(map(tuple, index.add(batch, batch_name="two").drop("digest").collect())) == want and index.table().count() == 2
    # delivered again as another batch, or as one without a name, all rows are copies
    for again in (index.add(batch), index.add(batch, batch_name="three")):
        assert not any(r["kept"] for r in again.collect())
    assert index.table().count() == 2
    index.drop()
    assert not spark.catalog.tableExists(index.name)


def test_a_batch_cut_off_in_the_middle(spark):
    """Part of the digests were appended before the crash; the rest is appended when the batch is added again."""
    index = exact_dedup.DigestIndex(spark)
    batch = docs(spark, [(i, f"t{i // 2}") for i in range(20)])
    whole = sorted(map(tuple, index.add(batch, batch_name="one").collect()))
    half = exact_dedup.DigestIndex(spark)
    half._append(index.table().orderBy("digest").limit(4))
    assert sorted(map(tuple, half.add(batch, batch_name="one").collect())) == whole
    assert half.table().count() == 10


def test_near_dup_stage_judges_rows(spark, sf, limit):
    a, b = clean(0), clean(500)
    near = a + " more"
    rows = [(3, a), (7, near), (7, b), (None, a), (None, clean(900)), (5, None), (6, " "), (8, clean(700)), (8, clean(700))]
    d = docs(spark, rows).withColumn("node", F.lit(1)).withColumn("first", F.lit("x")).withColumn("kept", F.lit(False)).withColumn("n", F.lit(7))
    got = simhash.stage(spark, d, sf)
    assert got.columns == d.columns
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=repr) == sorted([(3, a), (7, b), (None, clean(900)), (5, None), (8, clean(700))], key=repr)
    assert simhash.stage(spark, d.limit(0), sf).count() == 0


def test_bad_hosts_go_and_mixed_ones_stay(spark, sf):
    rows = []
    for host, n, bad in (("fine", 100, 3), ("fine2", 80, 6), ("mixed", 100, 40), ("edge", 100, 55), ("spam", 60, 57), ("tiny", 2, 2)):
        rows += [(len(rows) + k, "z" if k < bad else clean(10 * (len(rows) + k)), "en", host, 0) for k in range(n)]
    d = spark.createDataFrame(rows, DOCS)
    verdicts = quality_rules.apply_rules(d).join(d.select("doc_id", "source"), "doc_id")
    lost = {r["source"] for r in verdicts.filter("not base_failed and not kept").collect()}
    assert lost == {"spam"}
    assert {r["source"] for r in quality_rules.stage(spark, d, sf).collect()} == {"fine", "fine2", "mixed", "edge"}


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, empty texts, repeated rows and an extra column whose name stages use."""
    rows = [(i, clean(40 * i), "en", f"s{i % 2}", 1) for i in range(30)]
    rows += [rows[3], rows[3], (3, None, None, None, None), (None, clean(5000), None, None, None), (None, None, None, None, None), (90, "", "en", "s0", 0), (91, clean(40) + " x", "en", None, 1)]
    d = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit(0)).withColumn("length", F.lit(1))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in got}
    assert ids <= {*range(30), None} and 91 not in ids and 90 not in ids
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d.limit(0), str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == d.columns)
