"""HTML extraction, tokens, packing, token counts, the classifier, and the pipeline as a whole."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import co_training, html_text, packing, token_counts, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# ---- HTML ----------------------------------------------------------------------------

ARTICLE = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy</div><article><h1>Head &amp; tail</h1><p>One<b>two</b><br>three\n  four&nbsp;five<p>Six <a href="x">seven</a></p><aside>side</aside><form>f<input></form><div class="comments"><p>nice!</p></div></article><footer>&copy; x</footer></body></html>'


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        (ARTICLE, "Head & tail Onetwo three four five Six seven"),
        ("<p>a<p>b", "a b"),
        ("plain &lt;b&gt; &#233;&#x41;&bogus;", "plain <b> éA&bogus;"),
        ("<div class='has-sidebar'><main><p>x</p></main><div id=sidebar>y</div></div>", "x"),
        ("<header>site</header><article><header><h1>h</h1></header><p>x</p></article>", "h x"),
        ("<body><div class='post'><p>x</p></div><ul><li><a>m1</a></li><li><a>m2</a></li></ul></body>", "x"),
        ("<p>a</i>b<div>c</div>d", "ab c d"),
        ("<!-- c --><p>x<!-- y -->z</p><script>q", "xz"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<p hidden>h</p><p style='display:none'>n</p><p>v</p>", "v"),
        ("<article><p>x</p><div class='cookie notice'>c</div></article>", "x"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_wrappers_find_what_is_constant():
    page = lambda i: f"<body><div class='logo'>My site</div><div class='box'>text {i} " + "w " * i + "</div><div class='end'>All rights</div></body>"
    w = html_text.structure(html_text.parse(page(0)))
    for i in range(1, 6):
        w = html_text.merge(w, html_text.structure(html_text.parse(page(i))))
    paths = html_text.template_paths(w)
    assert len(paths) == 2 and w[1] == 6
    assert html_text.main_text(page(3), frozenset(paths)) == "text 3 w w w"
    # copies of one page have no template
    same = html_text.structure(html_text.parse(page(0)))
    for _ in range(5):
        same = html_text.merge(same, html_text.structure(html_text.parse(page(0))))
    assert html_text.template_paths(same) == []


def test_tree_matching_aligns_optional_nodes():
    a = html_text.structure(html_text.parse("<body><h1>x</h1><div class=a>1</div><p>y</p></body>"))
    b = html_text.structure(html_text.parse("<body><h1>x</h1><p>z</p><div class=b>2</div></body>"))
    assert html_text.match(a, b, {}) == 4
    kids = [k[0] for k in html_text.merge(a, b)[3][0][3]]
    assert kids == ["h1", "div.a", "p", "div.b"]


def test_extract_by_host(spark):
    page = lambda i: f"<body><div class='logo'>My site</div><div class='box'>text {i}</div></body>"
    rows = [(i, f"http://h{i % 2}.com/{i}", page(i)) for i in range(20)] + [(50, None, page(50)), (51, "http://h0.com/x", None), (52, "http://one.com/", ARTICLE), (52, "http://one.com/", ARTICLE)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit("clash")).repartition(5)
    got = html_text.extract(d).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 24 and all(by[i] == f"text {i}" for i in range(20))
    assert by[50] == "My site text 50" and by[51] == "" and by[52].startswith("Head & tail")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(d.limit(0)).count() == 0


def test_pages_of_the_tables(spark, sf):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in html_text.op2_html_extraction(spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


# ---- tokens --------------------------------------------------------------------------

HARD = ["it's don't, IT'S rock'n'roll's", "a<|endoftext|>b <|ENDOFTEXT|>, x<|endoftext|>.", "café., naïve—dash,. « word ».", "e\u0301., K\u212a İI.", ".,.!? ###", "12.5, 3rd.", "\u00a0x\u00a0. \u2003y", "😀!! ok", "x\u0301\u0301,, 中文.", "", None, "A\x1cB.", "\u0645\u0631.,", "a\x0bb\x0cc"]


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.WordTokens(tokens.default_path())


def test_word_memo_gives_the_tokenizers_ids(tokenizer, monkeypatch):
    for _ in range(2):
        for text, raw in zip(HARD, tokenizer.batch(HARD)):
            assert np.frombuffer(raw, "<u2").tolist() == tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids
    monkeypatch.setattr(tokens, "MEMO_BYTES", 1500)  # a handful of words in two generations
    monkeypatch.setattr(tokens, "SLICE_BYTES", 7)
    for text in HARD:
        assert np.frombuffer(tokenizer.batch([text])[0], "<u2").tolist() == tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids


def check_packing(rows, pieces, tokenizer, padding):
    text = dict(rows)
    by = {}
    for p in pieces:
        by.setdefault(p["doc_id"], []).append(p)
    assert set(by) == set(text)
    for i, own in by.items():
        ids = [*tokenizer.tokenizer.encode(text[i] or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], dtype="<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    total, sequences = 0, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        total += p["length"]
    for own in sequences.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 4096
    assert 4096 * len(sequences) - total <= padding * total + 4096


def test_packing(spark, tokenizer):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.choice([3, 50, 400, 2000, 9000])))) for i in range(120)] + [(900, None), (901, ""), (902, "x")]
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumn("length", F.lit(1)).withColumn("offset", F.lit(1))
    got = packing.pack(d, tokens.default_path()).collect()
    check_packing(rows, got, tokenizer, 0.02)
    assert packing.pack(d.limit(0), tokens.default_path()).count() == 0


def test_documents_of_one_length_are_cut(spark, tokenizer):
    text = " ".join(["cat"] * 2200)
    rows = [(i, text) for i in range(40)]
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    check_packing(rows, packing.pack(d, tokens.default_path()).collect(), tokenizer, 0.04)


def test_column_generation_holds_every_piece():
    r = random.Random(2)
    for _ in range(8):
        demand = Counter(r.randint(1, 60) for _ in range(r.randint(1, 400)))
        found = packing.pack_counts(demand, 64)
        assert all(sum(c * k for c, k in held) <= 64 for _, held in found)
        assert Counter({c: n for c, n in demand.items()}) == sum((Counter({c: k * n for c, k in held}) for n, held in found), Counter())
    many = {c: 1000 for c in (7, 11, 13, 17, 29)}
    sequences = sum(n for n, _ in packing.pack_counts(many, 64))
    assert sequences <= 1.01 * sum(c * n for c, n in many.items()) / 64 + 5


def test_knapsack_is_optimal():
    rng = np.random.default_rng(1)
    size, value = np.array([3, 4, 5, 9]), rng.random(4)
    best, count = packing.knapsack(size, value, 20)
    want = max(value @ np.array(c) for c in np.ndindex(7, 6, 5, 3) if np.dot(size, c) <= 20)
    assert best == pytest.approx(want) and value @ count == pytest.approx(best) and size @ count <= 20


@pytest.mark.parametrize("block", [2, 16, 64, 1 << 20])
def test_separator_scan(spark, tmp_path, block):
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 50, 300)
    flat = np.concatenate([np.r_[np.ones(n), 49407] for n in sizes] + [np.ones(7)]).astype("<u2")
    flat.tofile(tmp_path / "a.bin")
    np.empty(0, dtype="<u2").tofile(tmp_path / "e.bin")
    np.full(30, 5, dtype="<u2").tofile(tmp_path / "f.bin")
    files = spark.createDataFrame([(f"{tmp_path}/{n}.bin",) for n in "aef"], "file string")
    got = token_counts.count_tokens(files, block_bytes=block).toPandas().sort_values("ordinal")
    a = got[got.file.str.endswith("a.bin")]
    assert a.n_tokens.tolist() == [*sizes.tolist(), 7] and a.ordinal.tolist() == list(range(301)) and a.terminated.tolist() == [True] * 300 + [False]
    assert got[got.file.str.endswith("f.bin")][["n_tokens", "terminated"]].values.tolist() == [[30, False]]
    assert not got.file.str.endswith("e.bin").any()


def test_token_counts_of_documents(spark, sf):
    w = tokens.WordTokens(tokens.default_path(), literal=True)
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = token_counts.op5_token_counts(spark, sf).collect()
    assert len(got) == len(text)
    assert all(r["terminated"] and r["n_tokens"] == len(w.tokenizer.encode(text[r["doc_id"]], add_special_tokens=False).ids) for r in got)


def test_token_counts_broadcast_no_documents(spark, sf):
    plan = token_counts.op5_token_counts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


# ---- classifier ----------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    train = labels.filter("doc_id % 3 <> 0")
    got = co_training.score(docs, *co_training.fit(docs, train)).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in got]) >= 0.95
    assert np.mean([r["kept"] for r in got if r["quality"] == 1]) >= 0.97


def test_classifier_without_classes(spark):
    d = spark.createDataFrame([(1, None, None, None, None), (2, "a b", "en", "s", 3), (2, "a b", "en", "s", 3)], DOCS).withColumn("score", F.lit(1)).withColumn("y", F.lit(1))
    for rows, share in (([], 0.5), ([(1, 1, 0), (2, 1, 0), (2, 0, 0), (77, 0, 0)], 0.75), ([(None, 0, 0), (1, None, 0)], 0.5)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        got = co_training.score(d, *co_training.fit(d, labels)).collect()
        assert [r["score"] for r in got] == [share] * 3 and all(r["kept"] for r in got)
    assert co_training.score(d.limit(0), *co_training.fit(d.limit(0), labels)).count() == 0


def test_classifier_takes_few_labels(spark):
    rows = [(i, ("clean words here %d" % i) * 5 if i % 2 else "### $$$ %%% " * 10, "en", "s", 10) for i in range(12)]
    d = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in co_training.score(d, *co_training.fit(d, labels)).collect()}
    assert got == {i: bool(i % 2) for i in range(12)}


# ---- pipeline ------------------------------------------------------------------------


def brute_shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_pipeline_against_brute_force(spark, sf, tokenizer):
    import corpus_pipeline
    from test_pairs_and_dedup import brute_components, brute_exact
    from test_rules_and_mixing import brute_measures, brute_targets

    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    m = {i: brute_measures(t) for i, t, _ in docs}
    docs = [d for d in docs if not (m[d[0]][0] < 20 or 100 * m[d[0]][4] > 30 * m[d[0]][0])]
    keep = {(k, h) for _, k, _, h in brute_exact([d[:2] for d in docs])}
    docs = [d for d in docs if d[0] in {k for k, _ in keep}]
    sets = {i: brute_shingles(t) for i, t, _ in docs}
    comps = brute_components([(a, b) for a in sets for b in sets if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])])
    least = {}
    for i, c in comps.items():
        least[c] = min(least.get(c, i), i)
    docs = [d for d in docs if least[comps[d[0]]] == d[0]]
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(t.encode().split())
    targets = brute_targets(sizes)
    got = corpus_pipeline.run(spark, sf).collect()
    packed = {}
    for r in got:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["length"]
    copies = {}
    for i, t, s in docs:
        n = len(tokenizer.tokenizer.encode(t, add_special_tokens=False).ids) + 1
        k, rest = divmod(packed.pop(i, 0), n)
        assert rest == 0 and abs(k - targets[s] / sizes[s]) < 1
        copies[s] = copies.get(s, 0) + k * len(t.encode().split())
    assert packed == {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
