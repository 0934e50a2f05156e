"""The pipeline's near-dedup against brute-force Jaccard similarity."""

import random

import pytest
from test_pairs_and_dedup import brute_components, docs, words

from helixframe.llm import jaccard, simhash


def brute_shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def changed(r, text, k):
    w = text.split()
    for i in r.sample(range(len(w)), k):
        w[i] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("block,few", [(4096, 300_000), (3, 0)])
def test_every_pair_from_four_fifths_on(spark, sf, monkeypatch, block, few):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BROADCAST_TEXTS", few)
    r = random.Random(5)
    rows = []
    for b in range(12):
        base = words(r, 200)
        rows += [(100 * b + i, changed(r, base, i)) for i in range(9)]
    rows += [(5000, None), (5001, " "), (5002, "one two"), (5003, "ONE  two"), (None, rows[0][1])]
    sets = [brute_shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if similarity(sets[i], sets[j]) >= 0.8]
    assert sum(0.8 <= similarity(sets[i], sets[j]) < 0.9 for i, j in pairs) > 30
    comps = brute_components([*pairs, *((i, i) for i in range(len(rows)))])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[comps[i]] = min(least.get(comps[i], d), d)
    got = jaccard.near_duplicates(docs(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(d, least[comps[i]]) for i, (d, _) in enumerate(rows)], key=repr)
    kept = [x["doc_id"] for x in simhash.stage(spark, docs(spark, rows), sf).collect()]
    assert sorted(kept) == sorted(set(least.values()))
    assert jaccard.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_simhash_brings_candidates(spark, monkeypatch):
    """Without any band of minima, fingerprints alone bring near copies together, and the exact count drops what isn't similar."""
    words = [f"w{i}" for i in range(400)]
    other = [f"v{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, " ".join(other)), (4, " ".join(["y", *other])), (5, " ".join(words[:200] + other[200:]))]
    monkeypatch.setattr(jaccard, "bands", lambda own: [])
    got = dict(map(tuple, jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
