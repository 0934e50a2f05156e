"""Operators with SQL against it, URL rules, quality rules, mixing, on the tables and on hand-made cases."""

import random
import re

import pytest
from compare import assert_same
from pyspark.sql import functions as F

from helixframe.llm import mixing, queries, quality_rules, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, oracle, name):
    assert_same(queries.QUERIES[name](spark, sf).toPandas(), oracle(queries.SQL[name]))


# ---- URLs ----------------------------------------------------------------------------

URLS = [None, "", "example.org/es/1", "http://example.org/es/1", "https://A.EXAMPLE.org/en/12?x", "http://badexample.org/es/", "http://x.com/fr/1#z", "http://com/de/", "http://com", "http://a.b.c.org/", "http://a.org", "ftp://example.org:80/es/", "http://u@example.org/es/é", "x://?q", "http://example.org/ES/", "a://b://c.com/fr/", "http://x.com/de/\nz"]


def brute_judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"(?s)[^/?#]*", rest)[0]
        path = re.match(r"(?s)[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    hits = []
    for v, rule in rules:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            hits.append((len(rule), len(h), v, rule))
    best = max(hits, default=None)
    return host, path, best[3] if best else None, best[2] if best else default


def judge(spark, urls, rules, **kinds):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    table = spark.createDataFrame(rules, "verdict string, rule string")
    return {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, table, **kinds).collect()}


def test_urls(spark):
    assert judge(spark, URLS, url_filter.RULES) == {i: brute_judge(u, url_filter.RULES) for i, u in enumerate(URLS)}


def test_many_rules_by_shuffle_and_ties(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    r = random.Random(1)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "com", "a.org"]
    rules = sorted({(r.choice(["allow", "block"]), r.choice(hosts) + r.choice(["/", "/x", "/x/", "/xy/z"])) for _ in range(40)})
    one = {rule: max(v for v, x in rules if x == rule) for _, rule in rules}
    urls = [f"http://{r.choice(['', 'w.'])}{r.choice(hosts)}{r.choice(['', '/', '/x', '/x/1', '/xy/zz'])}" for _ in range(80)]
    assert judge(spark, urls, rules, default="block") == {i: brute_judge(u, [(v, k) for k, v in one.items()], "block") for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    assert set(v[3] for v in judge(spark, URLS, []).values()) == {"allow"}
    assert judge(spark, [], url_filter.RULES) == {}


def test_repeated_pages_are_judged_each(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/")] * 3, "page_id long, url string")
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, rule string")
    assert [r["verdict"] for r in url_filter.judge(pages, rules).collect()] == ["block"] * 3


# ---- quality -------------------------------------------------------------------------


def brute_measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    cover = {i + j for i, x in enumerate(win) if win.count(x) > 1 for j in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), sum(x in lines[:i] for i, x in enumerate(lines)), len(cover)


@pytest.mark.parametrize("text", [None, "", " \n", "a b", "# * é|\n\n# * é|", "a " * 30, "a b c d e f g h a b c d e f g h i", "x\x1cy\x85z", "\n".join(["l1 l2", " ", "l1 l2", "l3"])])
def test_measures(text):
    assert quality_rules.measures(text) == brute_measures(text)


def test_measures_at_random():
    r = random.Random(1)
    for _ in range(200):
        t = "".join(r.choice(["a ", "b ", "c\n", "#", " "]) for _ in range(r.randint(0, 60)))
        assert quality_rules.measures(t) == brute_measures(t)


def test_host_verdicts(spark):
    good, bad = "w%d " * 30, "z"
    rows = [(i, (good % tuple(range(i, i + 30))) if i % 10 else bad, "en", "mixed", 0) for i in range(100)]
    rows += [(1000 + i, bad if i else good % tuple(range(30)), "en", "spam", 0) for i in range(200)] + [(5000, good % tuple(range(30)), "en", None, 0), (5001, None, "en", None, 0)]
    d = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1)).withColumn("host", F.lit("x")).withColumn("rate", F.lit("x"))
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.apply_rules(d).collect()}
    assert got[1] == (False, True) and got[0] == (True, False)
    assert got[1000] == (False, False)  # clean, but of a host that fails nearly always
    assert got[5000] == (False, True) and got[5001] == (True, False)
    kept = quality_rules.stage(spark, d, "")
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in got.items() if v[1]}
    assert kept.columns == d.columns
    assert quality_rules.apply_rules(d.limit(0)).count() == 0 and quality_rules.stage(spark, d.limit(0), "").count() == 0


def test_many_rejected_hosts_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", 0)
    d = spark.createDataFrame([(i, "z", "en", "spam", 0) for i in range(50)] + [(99, "w%d " * 30 % tuple(range(30)), "en", "ok", 0)], DOCS)
    assert [r["doc_id"] for r in quality_rules.stage(spark, d, "").collect()] == [99]


# ---- mixing --------------------------------------------------------------------------


def brute_targets(sizes):
    order = sorted(sizes, key=lambda k: (k is None, k or ""))
    w = {k: (1, 2, 3)[i % 3] for i, k in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [k for k in order if k not in full]
        if not open_ or not total:
            return {k: 0.0 for k in order}
        level = (total - sum(3 * sizes[k] for k in full)) / sum(w[k] for k in open_)
        more = {k for k in open_ if w[k] * level >= 3 * sizes[k]}
        if not more:
            return {k: 3.0 * sizes[k] if k in full else w[k] * level for k in order}
        full |= more


def test_mixing(spark, sf):
    r = random.Random(2)
    names = ["b", "a", "É", "Z", None, "~", "", "aa"]
    rows = [(i, "w " * r.randint(0, 12), "en", s, 0) for i, s in enumerate(r.choice(names[:5]) if i % 7 else r.choice(names) for i in range(600))] + [(10_000, None, "en", "empty", 0)]
    d = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("clash")).withColumn("rate", F.lit(0)).withColumn("size", F.lit(0))
    got = mixing.mix(d).collect()
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    source = {i: s for i, _, _, s, _ in rows}
    taken = {}
    for x in got:
        s = source[x["doc_id"]]
        assert x["source_size"] == sizes[s] and x["target"] == pytest.approx(want[s]) and x["taken"] <= 3 * x["size"]
        taken[s] = taken.get(s, 0) + x["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 20 for s in want)
    again = mixing.mix(d.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    mixed = mixing.stage(spark, d, sf)
    n = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert n == {x["doc_id"]: x["copies"] for x in got if x["copies"]} and mixed.columns == d.columns


@pytest.mark.parametrize("equal", [10_000, 7])
def test_rows_that_share_an_id_draw_each_for_itself(spark, sf, monkeypatch, equal):
    monkeypatch.setattr(mixing, "EQUAL", equal)
    rows = [(5, "w " * (1 + i % 7) + str(i), "en", "a", 0) for i in range(500)] + [(None, f"x {i}", "en", "b", 0) for i in range(500)] + [(7, "same text", "en", "c", 0)] * 400
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for s, n in (("a", 500), ("b", 500), ("c", 400)):
        own = [x for x in got if (x["doc_id"], s) in ((5, "a"), (None, "b"), (7, "c"))]
        assert len(own) == n and abs(sum(x["taken"] for x in own) - own[0]["target"]) <= 0.03 * own[0]["target"]


def test_many_sources_by_key(spark, sf, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    d = spark.createDataFrame([(i, "w " * (i % 5 + 1), "en", f"s{i % 9}", 0) for i in range(200)], DOCS)
    n = {r["doc_id"]: r["count"] for r in mixing.stage(spark, d, sf).groupBy("doc_id").count().collect()}
    assert n == {x["doc_id"]: x["copies"] for x in mixing.mix(d).collect() if x["copies"]}


def test_nothing_to_mix(spark, sf):
    d = spark.createDataFrame([(1, None, "en", None, 0), (2, "", "en", "a", 0)], DOCS)
    assert all(x["taken"] == 0 and x["target"] == 0 for x in mixing.mix(d).collect())
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.stage(spark, d.limit(0), sf).count() == 0
