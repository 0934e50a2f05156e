"""Lloyd, phrases and language ID against brute force, gradients by differences, held-out accuracy; nulls, ties, repeats, empty tables, clashing names."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import language_id, lloyd, phrases, queries

# ---- Lloyd ---------------------------------------------------------------------------


def brute_lloyd(rows, k=16, rounds=3, dims=64):
    kept = [(i, [math.floor(Fraction(x) * 64) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]
    for step in range(rounds + 1):
        at = [min(range(len(cs)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(v, cs[j])), j)) for _, v in kept]
        if step < rounds:
            for j in range(len(cs)):
                own = [v for (_, v), a in zip(kept, at) if a == j]
                if own:
                    cs[j] = [sum(x) // len(own) for x in zip(*own)]
    d = [sum((a - b) ** 2 for a, b in zip(v, cs[j])) for (_, v), j in zip(kept, at)]
    cap = 2**63 - 1
    per = Counter()
    for x, j in zip(d, at):
        per[j] += min(x, cap)
    return sorted([(i, j, min(x, cap), min(per[j], cap), min(sum(per.values()), cap), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for (i, _), j, x in zip(kept, at, d)], key=repr)


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("v", F.lit("clash")).withColumn("cluster", F.lit(7))


def clustered(df):
    return sorted(map(tuple, lloyd.lloyd(lloyd.kept_vectors(df))[0].collect()), key=repr)


def test_lloyd_against_brute_force(spark):
    r = random.Random(5)
    rows = [(i, [r.gauss(i % 5, 1) for _ in range(64)]) for i in range(150)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (2**60 + 1, rows[6][1])] + [(900 + i, [0.5] * 64) for i in range(40)]
    rows += [(500, None), (501, []), (502, [0.0] * 63), (503, [0.0] * 63 + [None]), (504, [0.0] * 63 + [math.nan]), (505, [0.0] * 63 + [math.inf]), (506, [-0.0] * 64), (507, [0.0] * 65)]
    for n in (1, 5):
        assert clustered(vectors(spark, rows).repartition(n)) == brute_lloyd(rows)


def test_lloyd_stays_exact_with_huge_components(spark):
    r = random.Random(6)
    rows = [(i, [r.choice([1e300, -1e300, 3e9, -7e8, 0.25]) if i % 7 == 0 else r.gauss(0, 3e6) for _ in range(64)]) for i in range(60)]
    assert clustered(vectors(spark, rows).repartition(4)) == brute_lloyd(rows)


def test_lloyd_of_few_or_no_vectors(spark):
    assert clustered(vectors(spark, [])) == [] == clustered(vectors(spark, [(1, None)]))
    few = [(1, [1.0] * 64), (2, [2.0] * 64), (2, [2.0] * 64)]
    assert clustered(vectors(spark, few)) == brute_lloyd(few)


# ---- phrases -------------------------------------------------------------------------


def brute_phrases(rows, least, first, absorb=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, w[i : i + m]] += 1
    longer = Counter()
    for (lang, w), a in f.items():
        if len(w) > 2 and a >= least:
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    longer[lang, w[i : i + m]] = max(longer[lang, w[i : i + m]], a)
    out = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least or 100 * longer[lang, w] >= absorb * a:
            continue
        score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first], 1))


def texts(spark, rows):
    clash = {"block": "b", "word": "w", "f": 1, "rank": 2, "id": 3, "key": "k"}
    df = spark.createDataFrame(rows, "text string, lang string")
    for c, v in clash.items():
        df = df.withColumn(c, F.lit(v))
    return df


def some_texts():
    r = random.Random(9)
    words = ["the", "The", "of", "a", "é", "ÉE", "日本", "x\x1fy", " z", "ab#c", "to", "new", "york", "\U0001f600"]
    rows = []
    for i in range(120):
        t = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", ";:"]) for _ in range(r.randrange(0, 60)))
        rows.append((t + "new york city hall of a " * (i % 3), r.choice(["en", "fr", None, "und", ""])))
    return rows + [rows[0]] * 40 + [(None, "en"), ("", None), ("...", "en"), (" \t ", "zz"), ("ha " * 3000, "en"), ("w" * 200_000 + " end", "en")]


@pytest.mark.parametrize("sizes", [(8_000_000, 1_000_000, 1_000_000), (300, 50, 40), (2_000, 7, 3)])
def test_phrases_against_brute_force(spark, monkeypatch, sizes):
    """Also with blocks, buckets and chunks so small that texts are cut and most words are dealt to several buckets."""
    for name, x in zip(("BLOCK_BYTES", "BUCKET_PLACES", "CHUNK"), sizes):
        monkeypatch.setattr(phrases, name, x)
    rows = some_texts()
    for least, first in ((5, 2000), (2, 7)) if sizes[0] == 300 else ((3, 40),):
        got = phrases.collocations(texts(spark, rows).repartition(3), least, first)
        assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, first)


def test_phrases_of_empty_tables(spark):
    assert phrases.collocations(texts(spark, [])).count() == 0
    assert phrases.collocations(texts(spark, [(None, None), ("a b c", "en")])).count() == 0


def test_every_n_gram_has_one_owner():
    r = np.random.default_rng(3)
    ids = r.integers(-1, 6, 4000).astype(np.int32)
    word, left, right = phrases._fragments(ids, 3)
    rows, n = phrases._owned(np.column_stack([word, left, right]), np.ones(len(word), np.int64))
    got, _, times = phrases._counted(rows, n)
    want = Counter(tuple(ids[i : i + m]) for m in (2, 3, 4) for i in range(len(ids) - m + 1) if (ids[i : i + m] >= 0).all())
    assert {tuple(x for x in g if x >= 0): k for g, k in zip(got.tolist(), times.tolist())} == {tuple(map(int, k)): v for k, v in want.items()}


# ---- language ID ---------------------------------------------------------------------


def test_gradients_by_differences():
    net = language_id.Network(3, hidden=4, embed=3, seed=2, kind=np.float64)
    x, size = language_id.symbols([b"abc", b"\xc3\xa9", b"q", b"zzzzz"])
    y, weight = np.array([0, 2, 1, 1]), np.array([1.0, 2.0, 0.5, 1.0])
    _, g = net.loss(x, size, y, weight)
    r = np.random.default_rng(0)
    for name, p in net.p.items():
        for _ in range(12):
            at = tuple(r.integers(0, s) for s in p.shape) if name != "e" else (int(r.choice(x[x > 0])), int(r.integers(0, 3)))
            keep, step = p[at], 1e-6
            p[at] = keep + step
            up = net.loss(x, size, y, weight)[0]
            p[at] = keep - step
            down = net.loss(x, size, y, weight)[0]
            p[at] = keep
            assert abs((up - down) / (2 * step) - g[name][at]) < 1e-7, name


def test_runs_and_symbols():
    assert language_id.runs_of("Ab1é-c\u00a0 ".encode()) == [b"ab", "é".encode(), "c\u00a0".encode()]
    long = language_id.runs_of(b"x" * 50)
    assert [len(r) for r in long] == [24, 24, 2]
    x, size = language_id.symbols([b"a", b"bz"])
    assert x.tolist() == [[1, 2, 1, 0], [1, 3, 27, 1]] and size.tolist() == [3, 4]


def test_held_out_accuracy_and_what_is_learned(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.QUERIES["op13_language_id"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert out and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in out) / len(out) > 0.97
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    # what is held out, and lang and source of what is predicted, are not looked at
    learned = language_id.sampled_runs(docs)
    wrong = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert language_id.sampled_runs(wrong.repartition(3)) == learned


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.lit(1)).withColumn("letters", F.lit("clash")).withColumn("score", F.lit(0))


def test_language_id_of_odd_rows(spark):
    fr, en = "une élève était là où ça brûle déjà ", "the thing with which they thought "
    rows = [(i, (fr if i % 2 else en) * 3, "fr" if i % 2 else "en") for i in range(80)]
    odd = [(900, None, "fr"), (901, "", None), (902, "12 34 !", "en"), (903, "\U0001f600", "en"), (None, en, None), (904, "é" * 300_000, None), (905, (en * 20_000) + fr, None), (905, (en * 20_000) + fr, None), (906, "日本語", None)]
    df = labelled(spark, rows + odd)
    langs, net = language_id.fit(df)
    assert langs == ["en", "fr"]
    got = sorted(map(tuple, language_id.predict(df.filter("doc_id is null or doc_id >= 900"), langs, net).collect()), key=repr)
    pred = {r[0]: r for r in got}
    assert len(got) == len(odd)
    assert [pred[i][2:] for i in (900, 901, 902, 903)] == [("und", 0.0)] * 4
    assert pred[None][1:3] == (False, "en") and pred[904][2] == "fr" and pred[905][2] == "en" and pred[906][2] in langs
    # a whole text is read: its tail alone has another language
    tail = language_id.predict(labelled(spark, [(1, en * 10 + fr * 200, None)]), langs, net).first()
    assert tail["lang_pred"] == "fr"


def test_language_id_without_or_with_one_language(spark):
    for rows, want in (([], []), ([(1, "abc", None), (3, "é", None)], [("und", 0.0)] * 2), ([(0, "abc", "en"), (3, "!", "en")], [("en", 1.0), ("und", 0.0)])):
        df = labelled(spark, rows)
        assert [tuple(r)[2:] for r in language_id.predict(df, *language_id.fit(df)).orderBy("doc_id").collect()] == want


def test_memo_starts_anew(spark, monkeypatch):
    net = language_id.Network(2)
    df = labelled(spark, [(i, f"abc{chr(97 + i % 26)} de {chr(97 + i % 7)}x", None) for i in range(200)]).coalesce(1)
    want = [tuple(r)[:3] for r in language_id.predict(df, ["a", "b"], net).collect()]
    monkeypatch.setattr(language_id, "MEMO", 5)
    monkeypatch.setattr(language_id, "SLICE_BYTES", 30)
    assert [tuple(r)[:3] for r in language_id.predict(df, ["a", "b"], net).collect()] == want
