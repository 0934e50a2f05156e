"""Short exons between two known introns, for the reads and introns of one stretch of places: both halves of a read are looked up, never all pairs of introns.

Places run outward, so the start of a record is an end of negative places. A read cut at i and j lies on three diagonals: before i on its own, from i to j
on the exon's, from j on behind the second intron. Where at most a tenth may differ, either the first half behind i lies on the exon's diagonal
or the second half lies behind the second intron; the one half leaves few diagonals, and the other cut's introns are looked up by place.
"""

from __future__ import annotations

import numpy as np

#: Bases that are compared at once, as bits of a word.
WORD = 64
TOGETHER = 1024


def _cells(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper-case character codes, 0 behind the end; and lengths."""
    raw = [t.upper().encode("latin-1", "replace") for t in texts]
    out = np.zeros((len(raw), width), dtype=np.uint8)
    for row, t in zip(out, raw):
        row[: len(t)] = np.frombuffer(t, dtype=np.uint8)
    return out, np.array([len(t) for t in raw], dtype=np.int64)


def _words(cells: np.ndarray) -> np.ndarray:
    """For each row three words of up to WORD cells: purines, the letters that edits lead to (G, C), and letters that are known."""
    def packed(bits: np.ndarray) -> np.ndarray:
        full = np.zeros((len(cells), WORD), dtype=bool)
        full[:, : bits.shape[1]] = bits
        return np.packbits(full, axis=1, bitorder="little").view("<u8")[:, 0]

    a, c, g, t = (cells[:, :WORD] == ord(x) for x in "ACGT")
    return np.stack([packed(a | g), packed(g | c), packed(a | c | g | t)])


_LOW = np.array([(1 << n) - 1 for n in range(WORD + 1)], dtype=np.uint64)


def _wrong(read: np.ndarray, ref: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Differences (edits are none) among the first n cells, of known letters and up to WORD of them: what is counted letter by letter is no less."""
    bits = ((read[0] ^ ref[0]) | (~read[1] & ref[1])) & read[2] & ref[2] & _LOW[np.minimum(n, WORD)]
    return np.bitwise_count(bits).astype(np.int64)


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of the ranges [low, high)."""
    size = np.maximum(high - low, 0)
    rows = np.repeat(np.arange(len(low)), size)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size) + low[rows]


def different(read: np.ndarray, ref: np.ndarray) -> np.ndarray:
    return ~((read == ref) | ((ref == ord("A")) & (read == ord("G"))) | ((ref == ord("T")) & (read == ord("C"))))


class Introns:
    """Introns as outward places: firsts (a, b, strands) and seconds (c, d, strands), and the texts outward from far sides (place, text)."""

    def __init__(self, firsts: tuple, seconds: tuple, places: np.ndarray, texts: list[str], sign: int, longest_exon: int, behind: int, slack: int):
        self.sign, self.exon, self.behind, self.slack = sign, longest_exon, behind, slack
        order = np.argsort(places, kind="stable")
        self.cells, self.size = _cells([texts[i] for i in order], max(map(len, texts), default=0))
        self.words, self.places = _words(self.cells), places[order]
        self.a, self.b, self.strands = (x[np.argsort(firsts[0], kind="stable")] for x in firsts)
        self.at_b = self._text(self.b)
        self.c, self.d, self.both = (x[np.argsort(seconds[0], kind="stable")] for x in seconds)
        self.at_d = self._text(self.d)
        self.by_d = np.argsort(self.d, kind="stable")
        self.sorted_d = self.d[self.by_d]
        self._ends()
        self.seen: tuple | None = None

    def _text(self, place: np.ndarray) -> np.ndarray:
        """The number of a place's text; -1 without one."""
        if not len(self.places):
            return np.full(len(place), -1)
        i = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
        return np.where(self.places[i] == place, i, -1)

    def _ends(self) -> None:
        """Every place where a read may end behind a second intron, with the WORD bases before it, last first, and how many of them are known to lie behind one."""
        used = np.unique(self.at_d[self.at_d >= 0])
        rows, n = _expand(np.ones(len(used), dtype=np.int64), self.size[used] + 1)
        text = used[rows]
        end = self.places[text] + n
        # the longest text before an end counts
        order = np.lexsort((-n, end))
        keep = order[np.concatenate(([True], np.diff(end[order]) > 0))] if len(order) else order
        self.end, self.known, text = end[keep], n[keep], text[keep]
        back = self.known[:, None] - 1 - np.arange(WORD)[None, :]
        self.before = _words(np.where(back >= 0, self.cells[text[:, None], np.maximum(back, 0)], 0) if len(text) else np.zeros((0, WORD), dtype=np.uint8))

    def _near(self, edge: int, inner: int) -> tuple:
        """Firsts that begin within slack of the edge: their numbers, cuts, and both in order of the exon's diagonal. Reads of one edge come together."""
        if self.seen is None or self.seen[0] != (edge, inner):
            f = np.arange(np.searchsorted(self.a, edge - self.slack), np.searchsorted(self.a, edge + self.slack, "right"))
            i = self.a[f] - edge + inner
            f, i = f[(i >= 0) & (self.at_b[f] >= 0)], i[(i >= 0) & (self.at_b[f] >= 0)]
            order = np.argsort(self.b[f] - i, kind="stable")
            f, i = f[order], i[order]
            self.seen = ((edge, inner), f, i, self.b[f] - i)
        return self.seen[1:]

    def lay(self, edge: list[int], inner: list[int], out: list[str], near: list[str]) -> list[tuple | None]:
        """For each read its best a, b, c, d (outward), i, exon, rest and wrong, or None."""
        found = []
        for at in range(0, len(out), TOGETHER):
            some = slice(at, at + TOGETHER)
            texts = out[some]
            cells, size = _cells(texts, max(map(len, texts)))
            # words of what follows each cell, and of what is before the end, last first
            wide = np.pad(cells, ((0, 0), (0, WORD)))
            after = np.stack([_words(wide[:, j : j + WORD]) for j in range(cells.shape[1] + 1)], axis=2)
            back = size[:, None] - 1 - np.arange(WORD)[None, :]
            last = _words(np.where(back >= 0, np.take_along_axis(cells, np.maximum(back, 0), axis=1), 0))
            for r, (e, n, x) in enumerate(zip(edge[some], inner[some], near[some])):
                found.append(self._one(e, n, cells[r, : size[r]], after[:, r], last[:, r], x))
        return found

    def _one(self, edge: int, inner: int, out: np.ndarray, after: np.ndarray, last: np.ndarray, near: str) -> tuple | None:
        f, i, diagonal = self._near(edge, inner)
        size, most = len(out), len(near)
        fits = (i <= most) & (size - i > self.behind)
        if not fits.any():
            return None
        if not fits.all():
            f, i, diagonal = f[fits], i[fits], diagonal[fits]
        left = size - i
        allowed, half = left // 10, (left + 1) // 2
        ref = self.words[:, self.at_b[f]]
        read = after[:, i]
        parts = []
        # the first half on the exon's diagonal
        ok = np.flatnonzero((half <= self.exon) & (half <= self.size[self.at_b[f]]) & (_wrong(read, ref, half) <= allowed))
        if len(ok):
            rows, exon = _expand(half[ok], np.minimum(np.minimum(left[ok] - self.behind, self.exon), self.size[self.at_b[f[ok]]]) + 1)
            rows = ok[rows]
            keep = _wrong(read[:, rows], ref[:, rows], exon) <= allowed[rows]
            rows, exon = rows[keep], exon[keep]
            c = self.b[f[rows]] + exon
            k, s = _expand(np.searchsorted(self.c, c), np.searchsorted(self.c, c, "right"))
            parts.append((rows[k], exon[k], s))
        # the second half behind the second intron
        far, worst = np.zeros(len(self.end), dtype=bool), int(allowed.max())
        least = size
        for w in np.unique(allowed):
            t = int((left[allowed == w] // 2 + 1).min())
            least = min(least, t)
            far |= (self.known >= min(t, WORD)) & (_wrong(last[:, None], self.before, t) <= w)
        far = np.flatnonzero(far)
        if len(far):
            rows, rest = _expand(np.full(len(far), max(least, self.behind)), np.full(len(far), size))
            rows = far[rows]
            keep = _wrong(last[:, None], self.before[:, rows], rest) <= worst
            rows, rest = rows[keep], rest[keep]
            d = self.end[rows] - rest
            k, s = _expand(np.searchsorted(self.sorted_d, d), np.searchsorted(self.sorted_d, d, "right"))
            rest, s = rest[k], self.by_d[s]
            j = size - rest
            line = self.c[s] - j
            k, rows = _expand(np.searchsorted(diagonal, line), np.searchsorted(diagonal, line, "right"))
            exon, s = j[k] - i[rows], s[k]
            keep = (exon >= 1) & (exon <= self.exon) & (exon < half[rows])
            parts.append((rows[keep], exon[keep], s[keep]))
        if not parts:
            return None
        rows, exon, s = (np.concatenate(x) for x in zip(*parts))
        rest = left[rows] - exon
        tb, td = self.at_b[f[rows]], self.at_d[s]
        keep = ((self.strands[f[rows]] & self.both[s]) != 0) & (rest >= self.behind) & (td >= 0) & (self.size[tb] >= exon) & (self.size[td] >= rest)
        rows, exon, s, rest, tb, td = (x[keep] for x in (rows, exon, s, rest, tb, td))
        j = i[rows] + exon
        wrong = _wrong(read[:, rows], ref[:, rows], exon) + _wrong(after[:, j], self.words[:, td], rest)
        keep = wrong <= allowed[rows]
        rows, exon, s, rest, tb, td, j, wrong = (x[keep] for x in (rows, exon, s, rest, tb, td, j, wrong))
        # letters that aren't known and more than a word of them are counted one by one
        mid, tail = _LOW[np.minimum(exon, WORD)], _LOW[np.minimum(rest, WORD)]
        whole = (exon <= WORD) & (rest <= WORD) & ((read[2, rows] & ref[2, rows] & mid) == mid) & ((after[2, j] & self.words[2, td] & tail) == tail)
        for x in np.flatnonzero(~whole):
            want = np.concatenate((self.cells[tb[x], : exon[x]], self.cells[td[x], : rest[x]]))
            wrong[x] = different(out[i[rows[x]] :], want).sum()
        keep = wrong <= allowed[rows]
        if not keep.any():
            return None
        rows, exon, s, rest, wrong = (x[keep] for x in (rows, exon, s, rest, wrong))
        seen = _cells([near], most)[0][0]
        n = min(most, size)
        before = np.concatenate(([0], np.cumsum(different(out[:n], seen[:n]))))[i[rows]]
        a, b, c, d = self.a[f[rows]], self.b[f[rows]], self.c[s], self.d[s]
        best = np.lexsort((self.sign * d, self.sign * c, self.sign * b, self.sign * a, np.abs(d - a), wrong + before))[0]
        return tuple(int(x[best]) for x in (a, b, c, d, i[rows], exon, rest, wrong))
