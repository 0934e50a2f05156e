"""Main text of web pages, by wrapper induction.

Every page is read into a tree of elements; brothers with the same tag and class are
one node of its structure, as repeated items are in a wrapper. The trees of a
host's pages are aligned by simple tree matching and merged into the host's
wrapper, where a node counts its pages and remembers its text as long as it is
the same. Nodes whose text is constant over at least MIN_PAGES pages that differ
elsewhere are template; the varying slots are content, unless their element is
a menu, header, footer, sidebar, notice, advert, form or list of comments.
Where a page has an article (or main) element, content is what stands in it and isn't template.

Wrappers are folded in each partition, then merged for each host in two steps, first
by host and hash of the partition, so a hot host is never in one task. What is
passed on is a summary whose size depends on the structure, not on the pages.

Trees are walked without recursion and tags found in one pass, so deep or broken pages cost what their
length does.

Defined results: a null or empty page has an empty text; broken markup is closed
where a browser would, and an open tag at the end of a page is text; repeated rows are extracted each; a host of few pages
is judged by elements alone; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import join_by_key, written
from helixframe.llm.url_filter import host_of

#: A constant node is template when so many pages of the host have it.
MIN_PAGES = 4
#: Partial wrappers of a host are first merged in so many groups.
FAN = 64

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are never part of an article's text.
DROP = frozenset("head script style noscript template iframe object svg math canvas audio video form button select textarea input label fieldset nav aside footer menu dialog noembed noframes title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Opening one of these closes an open p.
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table html body div article section main td th".split())
#: Words in the class, id or role of boilerplate elements.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion promoted popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer bottombar copyright legal "
    "sidebar aside rail widget widgets related recommended recommendations trending popular share sharing social follow "
    "notice notices alert cookie cookies consent gdpr newsletter subscribe subscription signup login paywall toolbar skip "
    "comment comments commentlist discussion disqus respond reply replies form search contentinfo complementary dialog".split()
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: What stands in a tag after its name, up to the first > outside quotes.
INSIDE = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
#: Class words that may as well stand on a part of an article: inside one, the wrapper alone decides on them.
WEAK = frozenset("legal copyright popular trending follow reply replies search skip rail form header masthead topbar".split())
WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "key", "noise", "kids")

    def __init__(self, tag: str, key: str, noise: bool):
        self.tag, self.key, self.noise, self.kids = tag, key, noise, []


def _element(tag: str, raw: str) -> Node:
    names, role = [], ""
    if raw.strip(" \t\r\n/"):
        for k, a, b, c in ATTRIBUTE.findall(raw):
            k, v = k.lower(), a or b or c
            if k in ("class", "id"):
                names.append(v.lower())
            elif k == "role":
                role = v.lower()
            elif k == "hidden" or k == "aria-hidden" and v.lower() == "true" or k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v, re.I):
                role = "dialog"
    # has-sidebar and the like say what stands beside the element
    own = [t for t in " ".join(names).split() if not t.startswith(("has-", "with-", "no-", "without-", "js-", "is-"))]
    words = set(WORDS.findall(" ".join([*own, role])))
    noise = tag in DROP or not NOISE.isdisjoint(words) and tag not in ("html", "body")
    return Node(tag, tag + "".join("." + x for x in sorted(words)), noise)


def _markup(page: str):
    """(start, end, tag, attributes) of the page's tags in order; tag: None for comments, with a slash for end tags. Send the place to go on from.

    Every character is looked at a bounded number of times: where no > follows, the rest is text; an
    open quote ends the tag at its first >, and can't open another.
    """
    at = 0
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end, tag, raw = (end + 3 if end >= 0 else len(page)), None, ""
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            end, tag, raw = (end + 1 if end >= 0 else len(page)), None, ""
        else:
            name = NAME.match(page, start + 1)
            if name is None:
                at = start + 1
                continue
            m = INSIDE.match(page, name.end())
            end = m.end() if m else page.find(">", name.end()) + 1
            if not end:
                return
            tag, raw = name[0], m[1] if m else page[name.end() : end - 1]
        jump = yield start, end, tag, raw
        at = end if jump is None else jump


def parse(page: str) -> Node:
    """The page as a tree; kids are nodes and decoded texts."""
    root = Node("#", "#", False)
    stack, at = [root], 0
    open_tags: Counter[str] = Counter()
    lower = None
    wraps: dict[str, list] = {}  # article and main elements: how many, and what is around the first

    def cut(i: int) -> None:
        open_tags.subtract(x.tag for x in stack[i:])
        del stack[i:]

    def text_to(end: int) -> None:
        if end > at:
            text = page[at:end]
            stack[-1].kids.append(entities.unescape(text) if "&" in text else text)

    tags = _markup(page)
    jump = None
    while True:
        try:
            start, end, tag, raw = tags.send(jump)
        except StopIteration:
            text_to(len(page))
            break
        jump = None
        text_to(start)
        at = end
        if tag is None:
            continue
        tag = tag.lower()
        if tag[0] == "/":
            tag = tag[1:]
            if open_tags[tag] <= 0:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    cut(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE and stack[i].tag != "p":
                    break  # the end of an inline element doesn't close blocks around it
            continue
        node = _element(tag, raw)
        if tag in CLOSES_P:
            if open_tags["p"] > 0:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        cut(i)
                        break
                    if stack[i].tag not in INLINE:
                        break
        elif tag in SAME and any(open_tags[t] > 0 for t in SAME[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME[tag]:
                    cut(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        stack[-1].kids.append(node)
        if tag in ("article", "main"):
            if tag in wraps:
                wraps[tag][0] += 1
            else:
                wraps[tag] = [1, stack[1:]]
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else page
            end = lower.find(f"</{tag}", at)
            if end < 0:
                end = len(page)
            if tag not in ("script", "style"):
                node.kids.append(entities.unescape(page[at:end]))
            close = page.find(">", end)
            jump = at = close + 1 if close >= 0 else len(page)
        elif tag not in VOID and not raw.endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
    # a class alone doesn't make the surroundings of the only article boilerplate
    for n, around in wraps.values():
        if n == 1:
            for x in around:
                x.noise = x.tag in DROP
    return root


def elements(root: Node) -> list[Node]:
    """The nodes below and with root, each before what is in it."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(k for k in reversed(n.kids) if not isinstance(k, str))
    return out


def _parts(node: Node) -> tuple[str, list[Node]]:
    """Text of a node and the inline elements in it, and the blocks in both."""
    text, blocks, stack = [], [], [(iter(node.kids), True)]
    while stack:
        kids, shown = stack[-1]
        k = next(kids, None)
        if k is None:
            stack.pop()
        elif isinstance(k, str):
            if shown:
                text.append(k)
        elif k.tag in INLINE:
            stack.append((iter(k.kids), shown and not k.noise))
        elif k.tag != "br":
            blocks.append(k)
    return " ".join("".join(text).split()), blocks


# A wrapper node is [key, pages, text, kids]; text is the CRC of its text, 0 without one, -1 once it varies.


def structure(root: Node) -> list:
    """The page's own wrapper: blocks only; brothers of one key are one slot, whose text is that of all."""
    out = [root.key, 1, 0, []]
    stack = [([root], out)]
    while stack:
        nodes, own = stack.pop()
        crcs, slots = [], {}
        for n in nodes:
            text, blocks = _parts(n)
            crcs.append(zlib.crc32(text.encode("utf-8", "surrogatepass")) or 1 if text else 0)
            for k in blocks:
                slots.setdefault(k.key, []).append(k)
        own[2] = crcs[0] if len(set(crcs)) == 1 else zlib.crc32(repr(crcs).encode()) or 1
        own[3] = [[key, 1, 0, []] for key in slots]
        stack.extend(zip(slots.values(), own[3]))
    return out


def dumped(wrapper: list) -> str:
    """JSON of depth, key, pages and text of the nodes in order."""
    out, stack = [], [(0, wrapper)]
    while stack:
        depth, n = stack.pop()
        out.append([depth, *n[:3]])
        stack.extend((depth + 1, k) for k in reversed(n[3]))
    return json.dumps(out, separators=(",", ":"))


def loaded(text: str) -> list:
    last: list[list] = []
    for depth, *own in json.loads(text):
        n = [*own, []]
        del last[depth:]
        if last:
            last[-1][3].append(n)
        last.append(n)
    return last[0]


def match(a: list, b: list, memo: dict) -> int:
    """Simple tree matching: most nodes that can be paired in order, roots included."""
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        if (id(x), id(y)) in memo:
            stack.pop()
        elif x[0] != y[0]:
            memo[id(x), id(y)] = 0
        elif need := [(p, q) for p in x[3] for q in y[3] if p[0] == q[0] and (id(p), id(q)) not in memo]:
            stack += need
        else:
            memo[id(x), id(y)] = 1 + _table(x[3], y[3], memo)[-1][-1]
    return memo[id(a), id(b)]


def _table(xs: list, ys: list, memo: dict) -> list[list[int]]:
    t = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + (match(x, y, memo) if x[0] == y[0] else 0))
    return t


def _aligned(xs: list, ys: list, memo: dict) -> list[tuple[list | None, list | None]]:
    """Pairs of nodes in order, by the most nodes matched; one of a pair may be missing."""
    if [x[0] for x in xs] == [y[0] for y in ys]:
        return list(zip(xs, ys))
    t, i, j, out = _table(xs, ys, memo), len(xs), len(ys), []
    while i or j:
        if i and j and xs[i - 1][0] == ys[j - 1][0] and t[i][j] == t[i - 1][j - 1] + match(xs[i - 1], ys[j - 1], memo):
            i, j = i - 1, j - 1
            out.append((xs[i], ys[j]))
        elif i and t[i][j] == t[i - 1][j]:
            i -= 1
            out.append((xs[i], None))
        else:
            j -= 1
            out.append((None, ys[j]))
    return out[::-1]


def merge(a: list, b: list) -> list:
    """The wrapper of both: aligned nodes become one, others are kept in order."""
    memo: dict = {}
    out = [a[0], 0, 0, []]
    stack = [(a, b, out)]
    while stack:
        x, y, own = stack.pop()
        own[1], own[2] = x[1] + y[1], x[2] if x[2] == y[2] else -1
        for p, q in _aligned(x[3], y[3], memo):
            if p is None or q is None:
                own[3].append(p or q)
            else:
                own[3].append([p[0], 0, 0, []])
                stack.append((p, q, own[3][-1]))
    return out


def step(path: int, key: str) -> int:
    """The path of an element with the key below one with the path: a hash of all keys."""
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), path)


def template_paths(wrapper: list, min_pages: int = MIN_PAGES) -> list[int]:
    """Paths of the nodes whose text is constant, if the pages differ anywhere."""
    constant, varying, real = set(), set(), False
    stack = [(wrapper, 0, False)]
    while stack:
        n, path, noisy = stack.pop()
        path, noisy = step(path, n[0]), noisy or _noisy(n[0])
        if n[2] == -1:
            varying.add(path)
            real |= not noisy  # if the text that varies is all boilerplate, the pages are copies of one article
        elif n[2] and n[1] >= min_pages:
            constant.add(path)
        stack.extend((k, path, noisy) for k in n[3])
    return sorted(constant - varying) if real else []


def _noisy(key: str) -> bool:
    tag, *words = key.split(".")
    return tag in DROP or not NOISE.isdisjoint(words)


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """The article's blocks in page order, joined by one space."""
    root = parse(page or "")
    region = _article(root)
    menus = frozenset() if region else _menus(root)
    blocks: list[str] = []
    open_block: list[str] = []

    def close() -> None:
        text = " ".join("".join(open_block).split())
        if text:
            blocks.append(text)
        open_block.clear()

    # frames: kids, path of the block around them, whether text counts, whether in an article, whether a block ends with them
    stack = [(iter(root.kids), step(0, root.key), not region, False, True)]
    while stack:
        kids, path, shown, heading, block = stack[-1]
        k = next(kids, None)
        if k is None:
            stack.pop()
            if block:
                close()
        elif isinstance(k, str):
            if shown and path not in template:
                open_block.append(k)
        elif k.tag == "br":
            close()
        elif _left_out(k, heading) or id(k) in menus:
            if k.tag not in INLINE:
                close()
        elif k.tag in INLINE:
            stack.append((iter(k.kids), path, shown, heading, False))
        else:
            close()
            here = heading or id(k) in region
            stack.append((iter(k.kids), step(path, k.key), shown or here, here, True))
    return " ".join(blocks)


def _left_out(k: Node, heading: bool) -> bool:
    if k.tag == "header":
        return not heading  # the header of an article holds its title
    return k.noise and not (heading and k.tag not in DROP and set(WORDS.findall(k.key)) & NOISE <= WEAK)


def _menus(root: Node) -> frozenset[int]:
    """Lists (their id()) of whose text nine tenths stand in links: menus, where no article is marked."""
    total: dict[int, int] = {}
    linked: dict[int, int] = {}
    out = []
    for n in reversed(elements(root)):
        own = sum(len("".join(k.split())) for k in n.kids if isinstance(k, str))
        kids = [id(k) for k in n.kids if not isinstance(k, str)]
        total[id(n)] = own + sum(total[k] for k in kids)
        linked[id(n)] = total[id(n)] if n.tag == "a" else sum(linked[k] for k in kids)
        if n.tag in ("ul", "ol") and 0 < total[id(n)] and 10 * linked[id(n)] >= 9 * total[id(n)]:
            out.append(id(n))
    return frozenset(out)


def _article(root: Node) -> frozenset[int]:
    """Article elements (their id()) outside boilerplate, else main elements; none if there are neither."""
    found: dict[str, list[int]] = {"article": [], "main": []}
    stack = [root]
    while stack:
        n = stack.pop()
        if n.tag in found:
            found[n.tag].append(id(n))
        stack.extend(k for k in n.kids if not isinstance(k, str) and not k.noise)
    return frozenset(found["article"] or found["main"])


def _fold(frames):
    """Wrappers of the hosts among the rows, as JSON."""
    by: dict[str, list] = {}
    for f in frames:
        for host, page in zip(f["host"], f["html"]):
            s = structure(parse(page or ""))
            by[host] = merge(by[host], s) if host in by else s
            if len(by) > 20_000:
                yield _summaries(by)
                by = {}
    if by:
        yield _summaries(by)


def _summaries(by: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame({"host": list(by), "n": [w[1] for w in by.values()], "wrapper": [dumped(w) for w in by.values()]})


def _join(frames):
    """Merges the wrappers of each host; rows of a host follow one another."""
    host, kept = None, None
    done: dict[str, list] = {}
    for f in frames:
        for h, w in zip(f["host"], f["wrapper"]):
            if h != host:
                if kept is not None:
                    done[host] = kept
                if len(done) > 5_000:
                    yield _summaries(done)
                    done = {}
                host, kept = h, loaded(w)
            else:
                kept = merge(kept, loaded(w))
    if kept is not None:
        done[host] = kept
    if done:
        yield _summaries(done)


def wrappers(pages: DataFrame) -> DataFrame:
    """pages: host, html. Returns host, n, wrapper (JSON) over all pages of the host."""
    kind = "host string, n long, wrapper string"
    parts = pages.mapInPandas(_fold, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    some = parts.repartition("host", "salt").sortWithinPartitions("host", "salt").select("host", "wrapper").mapInPandas(_join, kind)
    return some.repartition("host").sortWithinPartitions("host").select("host", "wrapper").mapInPandas(_join, kind)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages with text, n_chars added; columns kept: page_id, url. A row for each row of pages."""
    src = pages.select("page_id", F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    src = src.withColumn("host", F.coalesce(host_of(F.coalesce(F.col("url"), F.lit(""))), F.lit("")))

    def paths(frames):
        for f in frames:
            f["template"] = [json.dumps(template_paths(loaded(w), min_pages)) for w in f.pop("wrapper")]
            yield f[["host", "n", "template"]]

    made = wrappers(src.select("host", "html")).mapInPandas(paths, "host string, n long, template string")
    made = written(made.filter("template <> '[]'"), "templates")
    total = made.agg(F.sum("n")).first()[0]
    if total:  # else no host has a template
        src = join_by_key(src, made, "host", "n", pages.count())
    else:
        src = src.withColumn("template", F.lit(None).cast("string"))

    def texts(frames):
        known: dict[str, frozenset] = {}
        for f in frames:
            out = []
            for page, t in zip(f["html"], f["template"]):
                if t and t not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[t] = frozenset(json.loads(t))
                out.append(main_text(page, known[t] if t else frozenset()))
            f["text"] = out
            f["n_chars"] = [len(x) for x in out]
            yield f[["page_id", "url", "text", "n_chars"]]

    return src.select("page_id", "url", "html", "template").mapInPandas(texts, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
