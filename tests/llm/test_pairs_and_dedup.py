"""Exact dedup, near-dedup, line dedup and components: against brute force, with nulls, ties, empty tables and clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helixframe.llm import exact_dedup, graph, line_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}" if i is not None else None, 0) for i, t in rows], DOCS)


# ---- exact ---------------------------------------------------------------------------

ROWS = [(5, "a b"), (3, "ab"), (9, " a\tb "), (2, None), (1, ""), (7, " \n"), (None, "ab"), (4, "x"), (4, "x"), (6, "X"), (8, "é"), (10, "e\u0301")]


def brute_exact(rows):
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for i, t in rows:
        group = [r for r in rows if bare(r[1]) == bare(t)]
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out.append((i, best[0], len(group), hashlib.sha256(bare(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup(spark):
    got = exact_dedup.DigestIndex(spark).add(docs(spark, ROWS)).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in got], key=repr) == brute_exact(ROWS)
    assert sum(r["kept"] for r in got) == len({r["digest"] for r in got})
    assert [r["kept"] for r in got if r["doc_id"] == 4].count(True) == 1


def test_index_keeps_what_it_had(spark):
    index = exact_dedup.DigestIndex(spark)
    index.add(docs(spark, [(1, "a"), (2, "b")]))
    again = exact_dedup.DigestIndex(spark, index.name)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.add(docs(spark, [(3, " a "), (4, "c"), (5, "c")])).collect()}
    assert got == {3: (1, False), 4: (4, True), 5: (4, False)}
    assert again.table().count() == 3
    # the index is read bucket by bucket: no exchange above its scan
    plan = docs(spark, [(1, "a")]).select(exact_dedup.digest(F.col("text")).alias("digest")).join(again.table().hint("merge"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_exact_stage_and_empty_table(spark, sf):
    kept = exact_dedup.stage(spark, docs(spark, ROWS), sf)
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(map(repr, [9, 7, 4, 6, 8, 10]))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert exact_dedup.DigestIndex(spark).add(docs(spark, ROWS).limit(0)).count() == 0
    odd = docs(spark, ROWS).withColumn("digest", F.lit(1)).withColumn("keep_id", F.lit(2)).withColumn("row_id", F.lit(3)).withColumn("n", F.lit(3))
    assert exact_dedup.DigestIndex(spark).add(odd).count() == len(ROWS)
    assert exact_dedup.stage(spark, odd, sf).columns == odd.columns


# ---- components ----------------------------------------------------------------------


def brute_components(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(-50, 150), r.randrange(-50, 150)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, x) for x in range(5001, 5060)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute_components([x for x in links if x[0] != x[1]])


def test_no_links(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


# ---- simhash -------------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def words(r, n):
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 5))) for _ in range(n))


def test_fingerprints():
    r = random.Random(1)
    for t in [None, "", " \n", "One", "one two", "A\x0bB\x1cC d", words(r, 5), words(r, 400), "É" * 10 + " x y Z"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t
        assert simhash.fingerprint(t, 5) == brute_fingerprint(t, 5)


def flipped(r, x, k):
    for b in r.sample(range(64), k):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("distance,block,small", [(3, 4096, 16), (3, 8, 4), (6, 4096, 16), (6, 16, 4)])
def test_links_find_every_pair(spark, monkeypatch, distance, block, small):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SMALL", small)
    r = random.Random(distance)
    fps = set()
    for _ in range(25):
        seed = r.getrandbits(64)
        fps.update(flipped(r, seed, r.randint(0, distance + 1)) for _ in range(r.choice([2, 3, 30])))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long").persist()
    got = {r["node"]: r["root"] for r in graph.components(simhash.links(nodes, distance)).collect()}
    sign = lambda x: int(np.uint64(x).astype(np.int64))
    want = brute_components([(sign(a), sign(b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= distance])
    assert got == want


def test_thresholds_cover_and_partitions_are_all_bits():
    cost = [{t: 10.0**t * (i + 1) for t in range(-1, 4)} for i in range(4)]
    v, ts = simhash.allocate(cost, 0)
    assert sum(ts) == 0 and v == min(sum(cost[i][t] for i, t in enumerate(x)) for x in np.ndindex(5, 5, 5, 5) for x in [tuple(y - 1 for y in x)] if sum(x) == 0)
    n, both = 50, np.random.default_rng(1).random((64, 64)) * 50
    for m in (2, 3, 4):
        parts = simhash.correlated_partitions(n, both, m)
        assert sorted(b for p in parts for b in p) == list(range(64)) and len(parts) == m


def test_near_duplicates(spark, sf):
    r = random.Random(7)
    base = [words(r, 300) for _ in range(6)]
    rows = [(i, b) for i, b in enumerate(base)]
    rows += [(100 + i, b.replace("a", "b", 1)) for i, b in enumerate(base)] + [(200, base[0].upper().replace("É", "é")), (300, None), (301, " "), (302, ""), (None, base[1]), (7, "short"), (7, "short")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fp = [(i, brute_fingerprint(t)) for i, t in rows]
    comps = brute_components([(f, g) for k, (_, f) in enumerate(fp) for _, g in fp[k:] if (f ^ g).bit_count() <= 3])
    least = {}
    for i, f in fp:
        if i is not None:
            least[comps[f]] = min(least.get(comps[f], i), i)
    want = sorted([(i, f, least[comps[f]]) for i, f in fp], key=repr)
    assert sorted([(x["doc_id"], int(np.int64(x["fp"]).astype(np.uint64)), x["component_id"]) for x in got], key=repr) == want
    kept = {x["doc_id"] for x in simhash.stage(spark, docs(spark, rows), sf).collect()}
    assert set(range(6)) <= kept and 301 not in kept and 300 in kept
    assert simhash.near_duplicates(docs(spark, rows).limit(0)).count() == 0


# ---- lines ---------------------------------------------------------------------------


def levenshtein(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[-1] + 1))
        p = q
    return p[-1]


def edited(r, x, k, alphabet="abcdefgé"):
    x = list(x)
    for _ in range(k):
        p, o = r.randrange(len(x)), r.random()
        if o < 0.4:
            x[p] = r.choice(alphabet)
        elif o < 0.7:
            x.insert(p, r.choice(alphabet))
        elif len(x) > 1:
            del x[p]
    return "".join(x)


def test_banded_distance():
    r = random.Random(3)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 14)))
        b, t = edited(r, a or "a", r.randint(0, 5), "ab"), r.randint(0, 4)
        assert line_dedup.distance_within(a, b, t) == (levenshtein(a, b) <= t)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_a_near_line_always_meets(threshold):
    r = random.Random(threshold)
    for _ in range(1500):
        a = "".join(r.choice("abc") for _ in range(r.randint(8, 30)))
        b = edited(r, a, r.randint(0, threshold), "abc")
        x, y = sorted([a, b], key=lambda z: (len(z), z))
        if levenshtein(a, b) <= threshold:
            i = line_dedup._first_meeting(x, y, threshold)
            assert i >= 0
            own = {(s, x[p:e]) for s, c, p, e in line_dedup.meeting_places(len(x), threshold) if c == 2 * i}
            other = {(s, y[p:e]) for s, _, p, e in line_dedup.meeting_places(len(y), threshold)}
            assert own & other


def edits_of(n):
    return 2 if n >= 20 else 1 if n >= 8 else 0


@pytest.mark.parametrize("block", [1024, 3])
def test_line_classes(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    r = random.Random(block)
    base = ["".join(r.choice("abcdefg é") for _ in range(r.randint(20, 50))) for _ in range(30)]
    rows = [(d, "\n".join(" " * r.randint(0, 1) + edited(r, r.choice(base), r.choice([0, 0, 1, 2, 3])) for _ in range(r.randint(0, 4)))) for d in range(120)]
    short = ["".join(r.choice("abcd ") for _ in range(n)).strip() or "a" for n in range(1, 24) for _ in range(3)]
    rows += [(200 + k, edited(r, r.choice(short), r.choice([0, 1, 1, 2]), "abcd") + "\n" + r.choice(short)) for k in range(150)]
    rows += [(900, None), (901, ""), (902, "tiny\ntiny\n \n")]
    got = sorted(tuple(x) for x in line_dedup.line_classes(docs(spark, rows)).toPandas().itertuples(index=False, name=None))
    occ = [(d, i, x.strip(" \t\x0b\x0c\r")) for d, t in rows for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\x0b\x0c\r")]
    lines = sorted({x for *_, x in occ})
    pairs = [(x, y) for i, x in enumerate(lines) for y in lines[i + 1 :] if levenshtein(x, y) <= edits_of(min(len(x), len(y)))]
    comps = brute_components(pairs + [(x, x) for x in lines])
    degree = {x: sum(x in p for p in pairs) for x in lines}
    first, size = {}, {}
    for d, i, x in occ:
        c = comps[x]
        first[c], size[c] = min(first.get(c, (10**9, 0)), (d, i)), size.get(c, 0) + 1
    assert got == sorted((d, i, *first[comps[x]], size[comps[x]], degree[x], first[comps[x]] == (d, i)) for d, i, x in occ)


def test_no_lines(spark):
    assert line_dedup.line_classes(docs(spark, [(1, None)])).count() == 0
    assert line_dedup.line_classes(docs(spark, [(1, "x")]).limit(0)).count() == 0
