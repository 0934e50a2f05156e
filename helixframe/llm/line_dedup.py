"""Line dedup by a segment-partition edit join.

Lines are stripped of white space around them; blank lines don't count. Equal
lines are one. How many edits (the threshold) link two lines grows with the shorter one's length: a
line of l code points is cut into threshold + 1 segments; if a
longer or equal line is within threshold edits of it, one of the segments stands
unchanged in that line, at one of a few places that follow from both lengths.
Index rows (length, segment number, segment) and probe rows (for each length
down to l - threshold, each segment number and place) meet on a 64-bit hash.
Only lines that meet another one get their text fetched. They are verified in
their bucket: by counts of characters, then by banded bit-parallel edit distance on
what is left between the common prefix and suffix. Buckets above BLOCK lines are cut into blocks
and pairs of blocks. A pair counts in the first segment where it meets, so links are
counted without being emitted; what is emitted is a spanning forest.

Defined results: the first line of a class in order of document and line number stays;
in lines of under 8 code points, of which one is an eighth or more, no edit is allowed; a null
text has no lines; repeated rows repeat their lines; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import SPACES, join_by_key, written
from helixframe.llm.graph import components

#: (code points of the shorter line, edits): from 20 on two, from 8 on one, else none.
EDITS = ((20, 2), (8, 1))
BLOCK = 1024
#: Lines that met others, up to so many (8 bytes each), are broadcast when texts are fetched; more are joined by shuffle.
BROADCAST_LINES = 500_000


def segments(n: int, threshold: int) -> list[tuple[int, int]]:
    """(start, length) of the threshold + 1 segments of a line of n code points; the last ones are longer."""
    k = threshold + 1
    short, extra = divmod(n, k)
    out, at = [], 0
    for i in range(k):
        size = short + (i >= k - extra)
        out.append((at, size))
        at += size
    return out


def places(n: int, short: int, i: int, start: int, size: int, threshold: int) -> tuple[int, int]:
    """First and last place in a line of n code points of segment i (from 0) of one of ``short``: multi-match-aware bounds."""
    gap = n - short
    low = max(0, start - i, start + gap - (threshold - i))
    high = min(n - size, start + i, start + gap + (threshold - i))
    return low, high


def allowed(n: int, edits: tuple[tuple[int, int], ...]) -> int:
    """The threshold of pairs whose shorter line has n code points."""
    return next((t for least, t in edits if n >= least), 0)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    each = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    return each.withColumn("line", F.trim(F.col("line"), F.lit(SPACES))).filter("line <> ''")


def digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def meeting_places(n: int, edits: int | tuple[tuple[int, int], ...]) -> list[tuple[int, int, int, int]]:
    """(seed, code, start, end) of the index and probe rows of a line of n code points; edits: as EDITS, or one threshold for all.

    code: twice the segment number, plus 1 for a probe. The seed is made of length and segment
    number, so only segments of lines of one length, or probes for it, meet. A probe at a
    segment's own place would repeat the index row and is left out.
    """
    edits = ((edits + 1, edits),) if isinstance(edits, int) else edits
    most = max((t for _, t in edits), default=0)
    out = []
    for gap in range(min(most, n - 1) + 1):
        threshold = allowed(n - gap, edits)
        if gap > threshold or not threshold:  # without edits only equal lines are linked
            continue
        for i, (start, size) in enumerate(segments(n - gap, threshold)):
            seed = (n - gap) * (most + 1) + i
            if not gap:
                out.append((seed, 2 * i, start, start + size))
            low, high = places(n, n - gap, i, start, size, threshold)
            out += [(seed, 2 * i + 1, at, at + size) for at in range(low, high + 1) if gap or at != start]
    return out


#: Different lines that a task remembers, to give the rows of repeated ones once; it starts anew beyond.
SEEN = 1_000_000


def rows_to_meet(docs: DataFrame, text_col: str, edits: tuple[tuple[int, int], ...]) -> DataFrame:
    """h, id, code of the lines of docs; a line that is in several tasks gives its rows in each."""

    shortest = min((least for least, _ in edits), default=0)

    def rows(frames):
        digest, known, seen = xxhash.xxh64_intdigest, {}, set()
        for f in frames:
            for k in range(0, len(f), 500):
                h, code, ids, times = [], [], [], []
                for text in f["text"].iloc[k : k + 500]:
                    for line in (text or "").split("\n"):
                        line = line.strip(SPACES)
                        n = len(line)
                        if n < shortest:
                            continue
                        own = digest(line.encode("utf-8"), 42)
                        if own in seen:
                            continue
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(own)
                        if n not in known:
                            if len(known) > 20_000:
                                known.clear()
                            places_ = meeting_places(n, edits)
                            known[n] = [(s, 4 * a, 4 * b) for s, _, a, b in places_], [c for _, c, _, _ in places_]
                        spans, codes = known[n]
                        wide = line.encode("utf-32-le")
                        h += [digest(wide[a:b], s) for s, a, b in spans]
                        code += codes
                        ids.append(own)
                        times.append(len(codes))
                if ids:
                    yield pd.DataFrame({"h": np.array(h, dtype=np.uint64).view(np.int64), "id": np.repeat(np.array(ids, dtype=np.uint64).view(np.int64), times), "code": np.array(code, dtype=np.int8)})

    return docs.select(F.col(text_col).alias("text")).mapInPandas(rows, "h long, id long, code byte")


#: Rows of a bucket that a task holds; of a larger bucket it holds the lines' first rows, and gives them once it is known to be live.
HELD = 100_000


def _live(frames):
    """Of rows sorted by (h, id, code), the first of each line in a group where an index row meets another line."""

    def found(f: pd.DataFrame) -> pd.DataFrame:
        h, ids = f["h"].to_numpy(), f["id"].to_numpy()
        cut = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        size = np.diff(np.concatenate((cut, [len(h)])))
        low, high = np.minimum.reduceat(ids, cut), np.maximum.reduceat(ids, cut)
        probes = np.add.reduceat((f["code"].to_numpy() & 1).astype(np.int64), cut)
        first = np.concatenate(([True], (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])))
        return f[np.repeat((low != high) & (probes < size), size) & first]

    def added(f: pd.DataFrame, held: list, state: dict) -> None:
        """Rows of the large bucket: one a line is held; state: its last line, and if an index row and other lines were seen."""
        ids = f["id"].to_numpy()
        if state["last"] is not None and (ids != state["last"]).any() or (ids != ids[0]).any():
            state["others"] = True
        state["index"] |= bool((f["code"].to_numpy() & 1 == 0).any())
        new = np.concatenate(([state["last"] is None or ids[0] != state["last"]], ids[1:] != ids[:-1]))
        held.append(f[new])
        state["last"] = ids[-1]

    rest, key, held, state = None, None, [], {}
    for f in frames:
        if key is not None and len(f):  # the large bucket goes on
            h = f["h"].to_numpy()
            k = int(np.searchsorted(h, key, side="right"))
            if k:
                added(f.iloc[:k], held, state)
            if state["others"] and state["index"]:
                yield from held
                held = []
            if k == len(f):
                continue
            key, held, f = None, [], f.iloc[k:].reset_index(drop=True)
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        h = f["h"].to_numpy()
        k = int(np.searchsorted(h, h[-1])) if len(h) else 0
        if k:  # the last group may go on in the next batch
            yield found(f.iloc[:k])
        rest = f.iloc[k:]
        if len(rest) > HELD:
            key, held, state = int(h[-1]), [], {"last": None, "index": False, "others": False}
            added(rest, held, state)
            rest = None
            if state["others"] and state["index"]:
                yield from held
                held = []
    if rest is not None and len(rest):
        yield found(rest)


def distance_within(a: str, b: str, threshold: int) -> bool:
    """Edit distance of a and b is at most threshold; bit-parallel over a band of 2 * threshold + 1 diagonals."""
    if abs(len(a) - len(b)) > threshold:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high:  # the common prefix, by halving
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low]:
            low = mid
        else:
            high = mid - 1
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not a or not b:
        return max(len(a), len(b)) <= threshold
    return _banded(a, b, threshold)


def _banded(a: str, b: str, threshold: int) -> bool:
    """Ukkonen's band with a bit for each diagonal: e edits reach, on diagonal d, the farthest place; bits are the live diagonals of a row.

    Row r of the band is a word whose bit d + threshold says that D[r, r + d] <= e; words for
    e = 0 to threshold are advanced together, one row a step.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    n, m = len(a), len(b)
    if abs(n - m) > threshold:
        return False
    # live[e]: diagonals d with D[0, d] <= e; in row 0 D = d for d >= 0
    live = [sum(1 << (d + threshold) for d in range(min(e, m) + 1)) for e in range(threshold + 1)]
    at: dict[str, int] = {}  # character of b -> bits of the places in the window of the next row
    for j in range(min(threshold, m)):
        at[b[j]] = at.get(b[j], 0) | 1 << (j + threshold)
    for r in range(n):
        j = r + threshold
        if j < m:
            at[b[j]] = at.get(b[j], 0) | 1 << (2 * threshold)
        inside = full
        if r + 1 + threshold > m:  # diagonals beyond the end of b
            inside = (1 << max(0, m - r - 1 + threshold + 1)) - 1
        if r + 1 < threshold:  # and before its start
            inside &= ~((1 << (threshold - r - 1)) - 1)
        same = at.get(a[r], 0)
        new = []
        for e in range(threshold + 1):
            x = live[e] & same  # a match keeps the diagonal
            if e:
                x |= live[e - 1] | live[e - 1] >> 1  # substitution; deletion from a moves one diagonal down
                x |= new[e - 1] << 1  # insertion into a, in the same row
            new.append(x & full & inside)
        if r + 1 <= threshold:  # column 0
            for e in range(r + 1, threshold + 1):
                new[e] |= 1 << (threshold - r - 1)
        live = new
        if not live[-1]:
            return False
        at = {c: x >> 1 for c, x in at.items() if x >> 1}
    return bool(live[-1] >> (m - n + threshold) & 1)


def _bags(lines: list[str]) -> np.ndarray:
    """Counts of characters in 32 bins; an edit changes two counts by one at most."""
    out = np.zeros((len(lines), 32), dtype=np.int32)
    for i, x in enumerate(lines):
        out[i] = np.bincount(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype="<u4") & 31, minlength=32)
    return out


def _first_meeting(a: str, b: str, threshold: int) -> int:
    """The first segment number where the pair meets: a not longer than b."""
    for i, (start, size) in enumerate(segments(len(a), threshold)):
        low, high = places(len(b), len(a), i, start, size, threshold)
        part = a[start : start + size]
        if any(b[p : p + size] == part for p in range(low, high + 1)):
            return i
    return -1


def verified(uids: list[int], lines: list[str], index: list[bool], part: list[bool], across: bool, seg: int, edits: tuple[tuple[int, int], ...]) -> tuple[list, dict]:
    """Forest links and link counts among the lines of a bucket of segment number seg.

    index: the segment is the line's own. A pair is taken in the bucket of its first meeting only, where its
    first line in order of (length, text) is an index line. part: the line's block; across: only pairs of different blocks.
    """
    if len(lines) == 2:  # most buckets
        a, b = (0, 1) if (len(lines[0]), lines[0]) < (len(lines[1]), lines[1]) else (1, 0)
        threshold = allowed(len(lines[a]), edits)
        if not index[a] or across and part[0] == part[1] or not distance_within(lines[a], lines[b], threshold) or _first_meeting(lines[a], lines[b], threshold) != seg:
            return [], {}
        return [(uids[a], uids[b])], {uids[a]: 1, uids[b]: 1}
    order = sorted(range(len(lines)), key=lambda i: (len(lines[i]), lines[i]))
    uids, lines, index, part = ([x[i] for i in order] for x in (uids, lines, index, part))
    size = np.array([len(x) for x in lines])
    bags = _bags(lines)
    links, counts, root = [], {}, list(range(len(lines)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(lines) - 1):
        if not index[i]:
            continue
        threshold = allowed(int(size[i]), edits)
        last = int(np.searchsorted(size, size[i] + threshold, side="right"))
        near = np.abs(bags[i + 1 : last] - bags[i]).sum(axis=1) <= 2 * threshold
        for j in (np.flatnonzero(near) + i + 1).tolist():
            if across and part[i] == part[j] or _first_meeting(lines[i], lines[j], threshold) != seg:
                continue
            if distance_within(lines[i], lines[j], threshold):
                counts[uids[i]] = counts.get(uids[i], 0) + 1
                counts[uids[j]] = counts.get(uids[j], 0) + 1
                a, b = find(i), find(j)
                if a != b:
                    root[a] = b
                    links.append((uids[i], uids[j]))
    return links, counts


def _verify(frames, edits: tuple[tuple[int, int], ...]):
    """Rows sorted by (h, low, high): h, low, high, own, code, uid, line. Emits links (a, b, 0) and counts (uid, uid, n)."""

    out: list[tuple[int, int, int]] = []

    def group(key: tuple, rows: list) -> None:
        code, own = [r[1] for r in rows], [r[0] for r in rows]
        links, counts = verified([r[2] for r in rows], [r[3] for r in rows], [c % 2 == 0 for c in code], [o != key[1] for o in own], key[1] != key[2], code[0] // 2, edits)
        out.extend((a, b, 0) for a, b in links)
        out.extend((u, u, n) for u, n in counts.items())

    now, rows = None, []
    for f in frames:
        keys = zip(f["h"].tolist(), f["low"].tolist(), f["high"].tolist())
        for key, r in zip(keys, zip(f["own"].tolist(), f["code"].tolist(), f["uid"].tolist(), f["line"].tolist())):
            if key != now:
                if len(rows) > 1:
                    group(now, rows)
                now, rows = key, []
            rows.append(r)
        yield pd.DataFrame(out, columns=["a", "b", "n"]).astype("int64")
        out.clear()
    if len(rows) > 1:
        group(now, rows)
        yield pd.DataFrame(out, columns=["a", "b", "n"]).astype("int64")


def line_classes(docs: DataFrame, edits: tuple[tuple[int, int], ...] = EDITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each line of docs that isn't blank: doc_id, line_no, class_doc_id, class_line_no, class_size, n_links, kept.

    n_links: different lines within as many edits of the line as their lengths allow. edits: least length and threshold, longest first.
    """
    if any(least <= t for least, t in edits) or [*edits] != sorted(edits, reverse=True):
        raise ValueError("lines must have more code points than the threshold; the longest come first")
    each = lines_of(docs, id_col, text_col)
    long_enough = F.length("line") >= min((least for least, _ in edits), default=0)
    meet = rows_to_meet(docs, text_col, edits)
    live = written(meet.repartition("h").sortWithinPartitions("h", "id", "code").mapInPandas(_live, "h long, id long, code byte"), "live")
    ids = written(live.select("id").distinct(), "live-ids")
    few = ids.count() <= BROADCAST_LINES
    texts = each.filter(long_enough).withColumn("id", F.xxhash64("line")).join(F.broadcast(ids) if few else ids, "id", "left_semi")
    texts = texts.groupBy(digest(F.col("line")).alias("digest")).agg(F.first("id").alias("id"), F.first("line").alias("line"))
    texts = written(texts.withColumn("uid", F.monotonically_increasing_id()), "live-lines")

    sized = live.groupBy("h").count().filter(F.col("count") > BLOCK).select("h", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = live.join(sized, "h", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("h", "id", "code", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = dealt.join(texts.select("id", "uid", "line"), "id")
    found = rows.repartition("h", "low", "high").sortWithinPartitions("h", "low", "high").mapInPandas(lambda frames: _verify(frames, edits), "a long, b long, n long")
    found = written(found, "line-links")
    counts = found.filter("a = b").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n_links"))
    roots = components(found.filter("a <> b").select("a", "b")).withColumnRenamed("node", "uid")
    named = texts.select("uid", "digest")
    linked = roots.join(named, "uid").join(counts, "uid", "left").join(named.select(F.col("uid").alias("root"), F.col("digest").alias("class")), "root")
    linked = written(linked.select("digest", "class", "n_links"), "classes")

    occurrences = written(each.select("doc_id", "line_no", digest(F.col("line")).alias("digest")), "occurrences")
    sizes = occurrences.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "line_no")).alias("first"))
    sizes = written(sizes.join(linked, "digest", "left").withColumn("class", F.coalesce("class", "digest")), "line-sizes")
    classes = sizes.groupBy("class").agg(F.sum("n").alias("class_size"), F.min("first").alias("first"))
    verdicts = sizes.select("digest", "class", "n", F.coalesce("n_links", F.lit(0)).alias("n_links")).join(classes, "class")
    out = join_by_key(occurrences, verdicts.select("digest", "n", "n_links", "class_size", "first"), "digest", "n", occurrences.count())
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    return out.select("doc_id", "line_no", F.col("first.doc_id").alias("class_doc_id"), F.col("first.line_no").alias("class_line_no"), "class_size", "n_links", kept.alias("kept"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
