"""The trimming kernels of trim.py over batches of reads, as arrays of a row a place and a column a read.

Reads of a batch are dealt into blocks of a bounded number of cells. Rows that aren't ASCII, where letters and bytes
differ, go through the kernels of single reads.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from helixframe.functions import trim

#: Cells of a block: some matrices of this many bytes stay in a core's cache.
CELLS = 1 << 19
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[ord("a") : ord("z") + 1] -= 32
_COMPLEMENT = _UPPER.copy()
for _x, _y in zip("ACGT", "TGCA"):
    _COMPLEMENT[ord(_x)] = _COMPLEMENT[ord(_x.lower())] = ord(_y)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings, and where each begins (one more: the end)."""
    _, places, data = texts.buffers()
    at = np.frombuffer(places, dtype="<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8), at


def _blocks(sizes: np.ndarray):
    """Runs of rows whose matrix has CELLS cells at most, or a row."""
    i, n = 0, len(sizes)
    while i < n:
        step = max(1, CELLS // (int(sizes[i]) + 1))
        step = max(1, min(step, CELLS // (int(sizes[i : i + step].max()) + 1)))
        yield i, min(n, i + step)
        i += step


def _matrix(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, backward: bool = False, table: np.ndarray = _UPPER) -> np.ndarray:
    """A column a text, in upper case (or by the table), from its first letter (or its last) on; 0 beyond its end."""
    width = int(sizes.max(initial=0))
    if width == 0 or not len(data):
        return np.zeros((width, len(sizes)), dtype=np.uint8)
    j = np.arange(width)[:, None]
    at = (starts + sizes - 1)[None, :] - j if backward else starts[None, :] + j
    out = table[data[np.clip(at, 0, len(data) - 1)]]
    if int(sizes.min()) < width:
        out[j >= sizes[None, :]] = 0
    return out


def _quality(q: np.ndarray, sizes: np.ndarray, cutoff: int) -> np.ndarray:
    """trim.quality_keep(); q: codes from the last on."""
    if not len(q):
        return sizes.copy()
    deficit = np.cumsum(cutoff - np.maximum(q.astype(np.int32) - 33, 0), axis=0, dtype=np.int32)
    alive = np.logical_and.accumulate((deficit >= 0) & (np.arange(len(q))[:, None] < sizes), axis=0)
    deficit = np.where(alive, deficit, -1)
    best = deficit.argmax(axis=0)
    return np.where(deficit.max(axis=0) > 0, sizes - 1 - best, sizes)


def _poly_g(s: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """trim.poly_g_keep(); s: letters from the last on."""
    if not len(s):
        return sizes.copy()
    most = np.minimum(np.arange(1, len(s) + 1) // trim.POLY_G_SHARE, trim.POLY_G_MOST)[:, None]
    over = (np.cumsum(s != ord("G"), axis=0, dtype=np.int32) > most) | (np.arange(len(s))[:, None] >= sizes)
    run = np.where(over.any(axis=0), over.argmax(axis=0), sizes)
    return np.where((sizes >= trim.POLY_G_RUN) & (run >= trim.POLY_G_RUN), sizes - run, sizes)


def _adapter(s: np.ndarray, sizes: np.ndarray, adapter: str) -> np.ndarray:
    """trim.adapter_cut(), -1 for None; s: letters from the first on."""
    m, n = len(adapter), s.shape[1]
    cut = np.full(n, -1, dtype=np.int64)
    if m < 4 or not len(s):
        return cut
    a = np.frombuffer(adapter.upper().encode("latin-1"), dtype=np.uint8)
    first = -4 if m >= 16 else -3 if m >= 12 else -2 if m >= 8 else 0
    places = np.arange(first, len(s) - 4)
    if not len(places):
        return cut
    # for each letter of the adapter, where the read has another one; nothing is wrong before and behind the read
    wrong = {}
    for x in np.unique(a):
        wrong[x] = np.zeros((len(s) - first + m + 1, n), dtype=np.uint8)
        wrong[x][-first : len(s) - first] = (s != x) & (s != 0)
    kind = np.uint8 if m < 250 else np.uint16
    total = np.zeros((len(places), n), dtype=kind)
    for j, x in enumerate(a):
        total += wrong[x][j : j + len(places)]
    span = np.minimum(sizes[None, :] - places[:, None], m)
    hit = (total <= np.maximum(span, 0) // trim.MISMATCH_SHARE) & (places[:, None] < sizes[None, :] - 4) & (sizes >= 4)
    found = hit.any(axis=0)
    cut[found] = np.maximum(places[hit.argmax(axis=0)[found]], 0)
    left = np.flatnonzero(~found & (sizes >= 4))
    for inserted in (True, False):
        if len(left):
            at = _gapped(s[:, left], sizes[left], a, inserted)
            cut[left] = at
            left = left[at < 0]
    return cut


def _gapped(s: np.ndarray, sizes: np.ndarray, a: np.ndarray, inserted: bool) -> np.ndarray:
    """The first offset at which the adapter matches with one base inserted or missing; -1: none. Only places whose first bases fit are looked at further."""
    m, n = len(a), s.shape[1]
    out = np.full(n, -1, dtype=np.int64)
    places = np.arange(max(len(s) - (5 if inserted else 4), 0))
    if not len(places):
        return out
    span = np.minimum(sizes[None, :] - places[:, None] - 1, m) if inserted else np.minimum(sizes[None, :] - places[:, None], m - 1)
    inside = (span >= 4) & (places[:, None] < sizes[None, :] - (5 if inserted else 4))
    allowed = np.maximum(span // trim.MISMATCH_SHARE - 1, 0)
    rows = np.zeros((len(s) + m + 1, n), dtype=np.uint8)
    rows[: len(s)] = s
    head = np.zeros((len(places), n), dtype=np.uint8)
    for j in range(min(8, m)):
        head += (rows[j : j + len(places)] != a[j]) & (j < span)
    at, own = np.nonzero(inside & (head <= allowed))
    if not len(at):
        return out
    span, allowed = span[at, own], allowed[at, own]
    j = np.arange(int(span.max()))
    some = j[None, :] < span[:, None]
    here = rows[at[:, None] + j, own[:, None]]
    straight = (here != a[j]) & some
    shifted = ((rows[at[:, None] + j + 1, own[:, None]] != a[j]) if inserted else (here != a[j + 1])) & some
    # wrong bases before a gap at k, plus those after it on the shifted diagonal; k is 1 to span - 1
    gain = np.cumsum(straight, axis=1, dtype=np.int32) - np.cumsum(shifted, axis=1, dtype=np.int32) + shifted.sum(axis=1, dtype=np.int32)[:, None]
    good = ((gain <= allowed[:, None]) & (j[None, :] < span[:, None] - 1)).any(axis=1)
    at, own = at[good], own[good]
    # in order of place: the first of each read is written last
    out[own[::-1]] = at[::-1]
    return out


def _adapters(s: np.ndarray, sizes: np.ndarray, adapters: list[str]) -> np.ndarray:
    """Bases kept after each adapter in turn; -1 without a hit."""
    n, hit = sizes.copy(), np.zeros(len(sizes), dtype=bool)
    for x in adapters:
        if len(s) and (n < sizes).any():
            s = np.where(np.arange(len(s))[:, None] < n[None, :], s, 0).astype(np.uint8)
        at = _adapter(s, n, x)
        hit |= at >= 0
        n = np.where(at >= 0, np.minimum(n, at), n)
    return np.where(hit, n, -1)


def _overlap(x: np.ndarray, n1: np.ndarray, y: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """trim.overlap(): offset and length, length 0 for None. x: letters of read 1; y: of read 2's reverse complement."""
    least = trim.OVERLAP_LEAST
    offset, length = np.zeros(len(n1), dtype=np.int64), np.zeros(len(n1), dtype=np.int64)
    left = np.flatnonzero((n1 > least) & (n2 > least))
    x, y, n1, n2 = x[:, left], y[:, left], n1[left], n2[left]
    for at in [*range(max(len(x) - least, 0)), *range(-1, least - len(y), -1)]:
        if not len(left):
            break
        a, b = (x[at:], y) if at >= 0 else (x, y[-at:])
        w = min(len(a), len(b))
        wrong = ((a[:w] != b[:w]) & (a[:w] != 0) & (b[:w] != 0)).sum(axis=0, dtype=np.int32)
        size = np.minimum(np.minimum(n1, n2), np.minimum(n1 - at, n2 + at))
        good = (size >= least) & (wrong <= np.minimum(trim.OVERLAP_MISMATCHES, size // 10))
        good &= (at < n1 - least) if at >= 0 else (at > least - n2)
        if good.any():
            offset[left[good]], length[left[good]] = at, size[good]
            x, y, n1, n2, left = x[:, ~good], y[:, ~good], n1[~good], n2[~good], left[~good]
    return offset, length


# ---- Arrow arrays --------------------------------------------------------------------


def _plain(*texts: pa.Array) -> np.ndarray:
    """Rows whose texts aren't null and have a byte a letter."""
    ok = np.ones(len(texts[0]), dtype=bool)
    for t in texts:
        ok &= pc.fill_null(pc.equal(pc.binary_length(t), pc.utf8_length(t)), False).to_numpy(zero_copy_only=False)
    return ok


def _each(texts: list[pa.Array], many: Callable, one: Callable, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Results (a column each) of all rows, by many() in blocks and by one() where a text isn't ASCII; and which rows have texts."""
    out, known = np.zeros((len(texts[0]), width), dtype=np.int64), np.ones(len(texts[0]), dtype=bool)
    plain = _plain(*texts)
    cells = [_bytes(t) for t in texts]
    rows = np.flatnonzero(plain)
    starts, sizes = [at[:-1][rows] for _, at in cells], [np.diff(at)[rows] for _, at in cells]
    for i, j in _blocks(np.maximum.reduce(sizes)):
        out[rows[i:j]] = np.stack(many(*[(data, s[i:j], n[i:j]) for (data, _), s, n in zip(cells, starts, sizes)]), axis=1)
    for i in np.flatnonzero(~plain):
        row = [t[int(i)].as_py() for t in texts]
        known[i] = all(x is not None for x in row)
        if known[i]:
            out[i] = one(*row)
    return out, known


def quality_keep(qual: pa.Array, cutoff: int) -> pa.Array:
    out, known = _each([qual], lambda q: [_quality(_matrix(*q, backward=True, table=np.arange(256, dtype=np.uint8)), q[2], cutoff)], lambda q: [trim.quality_keep(q, cutoff)])
    return pa.array(out[:, 0].astype(np.int32), mask=~known)


def poly_g_keep(seq: pa.Array) -> pa.Array:
    out, known = _each([seq], lambda s: [_poly_g(_matrix(*s, backward=True), s[2])], lambda s: [trim.poly_g_keep(s)])
    return pa.array(out[:, 0].astype(np.int32), mask=~known)


def adapters_keep(seq: pa.Array, adapters: list[str]) -> pa.Array:
    """Bases kept after each adapter in turn has cut what the one before left; null without a hit."""
    out, known = _each([seq], lambda s: [_adapters(_matrix(*s), s[2], adapters)], lambda s: [trim.adapters_cut(s, adapters)])
    return pa.array(out[:, 0].astype(np.int32), mask=~known | (out[:, 0] < 0))


def overlap(read1: pa.Array, read2: pa.Array) -> pa.Array:
    def many(a, b):
        return _overlap(_matrix(*a), a[2], _matrix(*b, backward=True, table=_COMPLEMENT), b[2])

    out, known = _each([read1, read2], many, lambda a, b: trim.overlap(a, b) or (0, 0), 2)
    none = ~known | (out[:, 1] == 0)
    return pa.StructArray.from_arrays([pa.array(out[:, k].astype(np.int32), mask=none) for k in (0, 1)], ["offset", "length"])
