"""Arrow kernels of the pileup: aligned bases of a batch of records as flat arrays, counted or merged by template before they leave the task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from helixframe.functions import dna

OPS = pa.array(list("MIDNS=X"))
ALIGNED = np.array([1, 0, 0, 0, 0, 1, 1, 0], dtype=bool)
ON_REF = np.array([1, 0, 1, 1, 0, 1, 1, 0], dtype=np.int64)
ON_READ = np.array([1, 1, 0, 0, 1, 1, 1, 0], dtype=np.int64)
_CODE = np.full(256, 4, dtype=np.uint8)
for _i, _b in enumerate(dna.BASES):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _i
#: More than a read's bases: tells rows apart in one array of places in reads.
LONGEST = 1 << 24


def qual_bytes(qual: pa.Array) -> pa.Array:
    """Lists of qualities as a byte each: 0 to 255, null as 255 (unknown)."""
    flat = np.clip(pc.fill_null(qual.flatten(), 255).to_numpy(zero_copy_only=False), 0, 255).astype(np.uint8)
    ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(qual), 0).to_numpy(zero_copy_only=False)))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(qual), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings or binaries, and where each begins (one more: the end)."""
    _, places, data = texts.buffers()
    at = np.frombuffer(places, dtype="<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8), at


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def operations(cigar: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, kind (its place in OPS, 7 for others) and length of all operations."""
    ops = cigar.flatten()
    row = np.repeat(np.arange(len(cigar)), cigar.value_lengths().to_numpy(zero_copy_only=False))
    kind = pc.fill_null(pc.index_in(ops.field("op"), OPS), 7).to_numpy(zero_copy_only=False)
    return row, kind, ops.field("n").to_numpy(zero_copy_only=False).astype(np.int64)


def _before(row: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the sizes before each operation within its row."""
    total = _starts(size)
    first = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.empty(0, bool)
    return total - total[np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))] if len(row) else total


def spread(b: pa.RecordBatch, min_bq: int) -> tuple[np.ndarray, ...]:
    """row, at (place in the read), pos, base (0 to 3) and bq of all aligned bases of good quality. b: pos, cigar, seq, quals (qual_bytes())."""
    row, kind, n = operations(b.column("cigar"))
    read, ref = _before(row, n * ON_READ[kind]), b.column("pos").to_numpy()[row] + _before(row, n * ON_REF[kind])
    some = np.flatnonzero(ALIGNED[kind])
    n = n[some]
    own = np.repeat(some, n)
    i = np.arange(len(own)) - np.repeat(_starts(n), n)
    row, at, pos = row[own], read[own] + i, ref[own] + i
    seqs = b.column("seq")
    if pc.any(pc.not_equal(pc.binary_length(seqs), pc.utf8_length(seqs))).as_py():
        seqs = pc.replace_substring_regex(seqs, r"[^\x00-\x7f]", "N")
    (bases, s), (quals, q) = _bytes(seqs), _bytes(b.column("quals"))
    inside = (at < (s[1:] - s[:-1])[row]) & (at < (q[1:] - q[:-1])[row])
    if not inside.all():
        row, at, pos = row[inside], at[inside], pos[inside]
    base, bq = _CODE[bases[s[row] + at]], quals[q[row] + at]
    good = (base < 4) & (bq >= min_bq) & (bq != 255)
    return row[good], at[good], pos[good], base[good], bq[good]


def counts(batches: Iterator[pa.RecordBatch], min_bq: int) -> Iterator[pa.RecordBatch]:
    """chrom, pos, a, c, g, t: a batch's bases, counted by place."""
    for b in batches:
        row, _, pos, base, _ = spread(b, min_bq)
        if not len(row):
            continue
        chrom = b.column("chrom").dictionary_encode()
        low = int(pos.min())
        span = int(pos.max()) - low + 1
        place = chrom.indices.to_numpy()[row].astype(np.int64) * span + (pos - low)
        if len(chrom.dictionary) * span <= 8 * len(place):
            n = np.bincount(place * 4 + base, minlength=4 * len(chrom.dictionary) * span).reshape(-1, 4)
            at = np.flatnonzero(n.any(axis=1))
            n = n[at]
        else:
            at, own = np.unique(place, return_inverse=True)
            n = np.bincount(own * 4 + base, minlength=4 * len(at)).reshape(-1, 4)
        yield pa.record_batch([chrom.dictionary.take(pa.array(at // span)), pa.array(at % span + low), *[pa.array(n[:, k]) for k in range(4)]], names=["chrom", "pos", "a", "c", "g", "t"])


def _nearness(cigar: pa.Array, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """1 / (1 + distance to the nearest gap) of places in reads; 0 in reads without gaps."""
    own, kind, n = operations(cigar)
    read = _before(own, n * ON_READ[kind])
    inserted, skipped = kind == 1, (kind == 2) | (kind == 3)
    low, high = own * LONGEST + read - 0.5, own * LONGEST + read + n - 0.5
    gaps = np.concatenate((low[inserted | skipped], high[inserted]))
    if not len(gaps):
        return np.zeros(len(at))
    gaps = np.sort(np.concatenate(([-np.inf], gaps, [np.inf])))
    here = row * LONGEST + at
    k = np.searchsorted(gaps, here)
    near = np.minimum(here - gaps[k - 1], gaps[k] - here)
    return np.where(near < LONGEST / 2, 1.0 / (1.0 + near), 0.0)


def merge(batches: Iterator[pa.RecordBatch], min_bq: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Observations merged by template; batches: chrom, template, pos, ord, cigar, seq, quals, mapq, orientation, softclip_fraction, in order of the first three."""
    for b, _, _, (row, at, pos, base, bq) in _whole(batches, min_bq):
        if not len(row):
            continue
        of = _values(b, row, at)
        made = {"chrom": lambda: b.column("chrom").take(pa.array(row)), "pos": lambda: pa.array(pos), "template": lambda: b.column("template").take(pa.array(row)), "bq": lambda: pa.array(bq.astype(np.int32)), "base": lambda: pa.array(list(dna.BASES)).take(pa.array(base))}
        yield pa.record_batch([made[c]() if c in made else pa.array(of[c]()) for c in names], names=names)


def _values(b: pa.RecordBatch, row: np.ndarray, at: np.ndarray) -> dict:
    """What observations at places in b's rows have of their records."""
    of = lambda c: b.column(c).to_numpy(zero_copy_only=False)[row]
    return {"mapq": lambda: of("mapq"), "orientation": lambda: of("orientation"), "softclip_fraction": lambda: of("softclip_fraction"), "end_fraction": lambda: _inside(at, pc.utf8_length(b.column("seq")).to_numpy()[row]), "gap_nearness": lambda: _nearness(b.column("cigar"), row, at)}


def _whole(batches: Iterator[pa.RecordBatch], min_bq: int) -> Iterator[tuple]:
    """b, the rows' templates as numbers (ascending over all batches), row, pos and base of b's bases that no earlier batch had, and row, at, pos, base and bq of the observations merged by template, in order of template and place.

    Of a batch's last template what lies before its last record's place is whole. Records that reach on are held for the next batch, so no template is held as a whole.
    """
    held, floor, number = None, None, 0
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        group = _groups(b)
        number += int(floor is not None and (b.column("chrom")[0].as_py(), b.column("template")[0].as_py()) != floor[:2])
        every, found = _merged(b, group, min_bq, floor, False)
        first = np.searchsorted(every[0], 0 if held is None else held.num_rows)
        yield b, number + group, tuple(x[first:] for x in every), found
        number += int(group[-1])
        key = _last(b)
        same = pc.and_(pc.equal(b.column("chrom"), key[0]), pc.equal(b.column("template"), key[1]))
        row, kind, n = operations(b.column("cigar"))
        end = b.column("pos").to_numpy() + np.bincount(row, weights=n * ON_REF[kind], minlength=b.num_rows).astype(np.int64)
        held = b.filter(pc.and_(same, pa.array(end > key[2])))
        floor = key
    if held is not None and held.num_rows:
        group = _groups(held)
        every, found = _merged(held, group, min_bq, floor, True)
        yield held, number + group, tuple(x[:0] for x in every), found


def _last(b: pa.RecordBatch) -> tuple[str, str, int]:
    return tuple(b.column(c)[b.num_rows - 1].as_py() for c in ("chrom", "template", "pos"))


def _groups(b: pa.RecordBatch) -> np.ndarray:
    """Templates numbered in order of appearance: rows of one are together."""
    chrom, template, size = b.column("chrom"), b.column("template"), b.num_rows
    new = np.ones(size, dtype=bool)
    if size > 1:
        new[1:] = pc.or_(pc.not_equal(chrom.slice(1), chrom.slice(0, size - 1)), pc.not_equal(template.slice(1), template.slice(0, size - 1))).to_numpy(zero_copy_only=False)
    return np.cumsum(new) - 1


def _merged(b: pa.RecordBatch, group: np.ndarray, min_bq: int, floor: tuple[str, str, int] | None, whole: bool) -> tuple[tuple, tuple]:
    """row, pos, base of all bases of b; and row, at, pos, base, bq of the merged observations of b that no later record can change (all of them, if it is whole) and that no earlier batch gave."""
    last, size = _last(b), b.num_rows
    # of equal qualities the first record in order counts, of equal orders the one of the lowest mapping quality (unknown: lowest)
    mapq = b.column("mapq").to_numpy(zero_copy_only=False)
    up = b.column("orientation").to_numpy()
    soft = b.column("softclip_fraction").to_numpy()
    rank = np.empty(size, dtype=np.int64)
    rank[np.lexsort((-soft, -up, np.where(np.isnan(mapq), -1, mapq), b.column("ord").to_numpy()))] = np.arange(size)
    row, at, pos, base, bq = spread(b, min_bq)
    every = row, pos, base
    keep = np.ones(len(row), dtype=bool)
    if not whole:
        keep &= (group[row] < group[-1]) | (pos < last[2])
    if floor is not None and (b.column("chrom")[0].as_py(), b.column("template")[0].as_py()) == floor[:2]:
        keep &= (group[row] > 0) | (pos >= floor[2])
    if not keep.all():
        row, at, pos, base, bq = row[keep], at[keep], pos[keep], base[keep], bq[keep]
    if not len(row):
        return every, (row, at, pos, base, bq)
    low = int(pos.min())
    place = group[row] * (int(pos.max()) - low + 1) + (pos - low)
    order = np.lexsort((rank[row], place * 256 + (255 - bq)))
    row, at, pos, base, bq, place = (x[order] for x in (row, at, pos, base, bq, place))
    first = np.concatenate(([True], place[1:] != place[:-1]))
    run = np.flatnonzero(first | np.concatenate(([True], bq[1:] != bq[:-1])))  # of one place and quality
    agree = np.minimum.reduceat(base, run) == np.maximum.reduceat(base, run)
    own = run[first[run] & agree]
    return every, tuple(x[own] for x in (row, at, pos, base, bq))


def _inside(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Distance from the nearer end, as a share of half the read."""
    return np.minimum(at, size - 1 - at) / (np.maximum(size - 1, 1) / 2.0)


# ---- tallies -------------------------------------------------------------------------

#: Places of a piece of the marks that go with a record.
GRAIN = 64
#: Cells that a task counts in before it hands them on.
CELLS = 1_000_000
#: Rows of edited observations that are looked at together.
EDITED = 50_000
#: What a tally counts: a site's observations by base quality and orientation, by OF_ALT (1 to 4), all by base, and the steps and own shares of templates' edited places.
QUALITY, BASE, STEP, SELF = 0, 5, 6, 7
TALLY = "what int, chrom string, pos long, kind int, v double, orientation int, n long, s long, p long"
_FROM = 1 << 20  # places may be a radius below 0
_MARK = np.full(256, 4, dtype=np.uint8)
_SITE = np.zeros(256, dtype=bool)
for _i, _b in enumerate(dna.BASES):
    _MARK[ord(_b)] = _MARK[ord(_b.lower())] = _i
    _SITE[ord(_b.lower())] = True
_ALT = np.array([2, 9, 9, 1, 9], dtype=np.uint8)  # A is read as G, T as C


class _Cells:
    """Sums of whole numbers by key, and by a value if there is one."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, key: np.ndarray, v: np.ndarray | None, *sums: np.ndarray) -> None:
        if len(key):
            self._hold(self._summed(key, v, sums))

    def count(self, key: np.ndarray) -> None:
        """add() of one for each key."""
        if len(key):
            key = np.sort(key)
            at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            self._hold((key[at], None, np.diff(np.append(at, len(key)))))

    def _hold(self, part: tuple) -> None:
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > 2 * CELLS:
            self._join()

    def _join(self) -> None:
        key, v, *sums = (None if x[0] is None else np.concatenate(x) for x in zip(*self.parts))
        self.parts = [self._summed(key, v, sums)]
        self.size = len(self.parts[0][0])

    @staticmethod
    def _summed(key, v, sums) -> tuple:
        order = np.argsort(key) if v is None else np.lexsort((v, key))
        key, v = key[order], v if v is None else v[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        if v is not None:
            new[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(new)
        return key[at], v if v is None else v[at], *(np.add.reduceat(x[order], at) for x in sums)

    def full(self) -> bool:
        return self.size > CELLS and (self._join() or self.size > CELLS)

    def taken(self) -> tuple | None:
        if self.parts:
            self._join()
        out, self.parts, self.size = (self.parts or [None])[0], [], 0
        return out


def _key(chrom: np.ndarray, pos: np.ndarray, what: int, kind, bq=0, up=0) -> np.ndarray:
    return ((chrom << 33 | pos + _FROM) << 14) | (what << 11) | (kind << 9) | (bq << 1) | up


def _marked(b: pa.RecordBatch, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The mark of each observation's place. b: path (pieces of GRAIN places that the record touches, ascending), marks (their texts)."""
    path = b.column("path")
    own = np.repeat(np.arange(len(path)), path.value_lengths().to_numpy(zero_copy_only=False))
    k = np.searchsorted((own << 34) + path.flatten().to_numpy(), (row << 34) + pos // GRAIN)
    text, at = _bytes(b.column("marks"))
    return text[at[row] + (k - np.searchsorted(own, row)) * GRAIN + pos % GRAIN]


def _steps(group: np.ndarray, chrom: np.ndarray, minus: np.ndarray, pos: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For features.template_reuse(), of whole templates' edited places: keys and the steps t, s, p."""
    own = np.unique(group * 2 + minus, return_inverse=True)[1] << 35 | pos + 2 * _FROM
    order = np.argsort(own)
    own, chrom, minus, pos = own[order], chrom[order], minus[order], pos[order]
    within = lambda low, high: np.searchsorted(own, own + high, "right") - np.searchsorted(own, own + low, "left")
    before, behind, near, one = within(-2 * radius - 1, -1), within(0, 2 * radius + 1), within(-radius, radius), np.ones(len(own), dtype=np.int64)
    yield _key(chrom, pos - radius, STEP, minus), (before == 0).astype(np.int64), one, 2 * before
    yield _key(chrom, pos + radius + 1, STEP, minus), -(behind == 1).astype(np.int64), -one, -2 * (behind - 1)
    yield _key(chrom, pos, SELF, minus), (near == 1).astype(np.int64), one, 2 * (near - 1)


def tally(batches: Iterator[pa.RecordBatch], min_bq: int, radius: int) -> Iterator[pa.RecordBatch]:
    """Rows of TALLY: what features need of the observations that merge() would make, counted over the whole task.

    batches: as merge()'s, with path and marks: the reference base of each place, lower case at a site, N where none is known. kind: of a site's observations 0 reference,
    1 alternative, 2 other; of BASE the base (0 to 3), where orientation 1 tells the count before templates are merged; of STEP and SELF the reference base (0 A, 1 T), and n, s, p are the steps.
    """
    names: dict[str, int] = {}
    counts, values, steps = _Cells(), _Cells(), _Cells()
    edited, waiting, last = [], 0, -1

    def rows(cells: _Cells) -> Iterator[pa.RecordBatch]:
        if found := cells.taken():
            key, v, *sums = found
            low, place, size = key & (1 << 14) - 1, key >> 14, len(key)
            more = [pa.array(x) for x in sums] + [pa.nulls(size, pa.int64())] * (3 - len(sums))
            yield pa.record_batch([pa.array((low >> 11).astype(np.int32)), pa.array(list(names), pa.string()).take(pa.array(place >> 33)), pa.array((place & (1 << 33) - 1) - _FROM), pa.array((low >> 9 & 3).astype(np.int32)),
                                   pa.array((low >> 1 & 255).astype(float) if v is None else v), pa.array((low & 1).astype(np.int32)), *more], names=[x.split()[0] for x in TALLY.split(", ")])

    def told(least: int) -> None:
        """Counts the edited places of templates with numbers below least."""
        nonlocal edited, waiting
        group, *more = (np.concatenate(x) for x in zip(*edited))
        whole = group < least
        for key, *sums in _steps(group[whole], *(x[whole] for x in more), radius):
            steps.add(key, None, *sums)
        edited = [tuple(x[~whole] for x in (group, *more))]
        waiting = len(edited[0][0])

    for b, group, every, (row, at, pos, base, bq) in _whole(batches, min_bq):
        coded = b.column("chrom").dictionary_encode()
        chrom = np.array([names.setdefault(x, len(names)) for x in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
        counts.count(_key(chrom[every[0]], every[1], BASE, every[2].astype(np.int64), up=1))
        if not len(row):
            continue
        chrom, group = chrom[row], group[row]
        mark = _marked(b, row, pos)
        ref, site = _MARK[mark], _SITE[mark]
        known, alt = ref < 4, base == _ALT[ref]
        counts.count(_key(chrom[known], pos[known], BASE, base[known].astype(np.int64)))
        up = b.column("orientation").to_numpy()[row].astype(np.int64)
        kind = np.where(base == ref, 0, np.where(alt, 1, 2))
        counts.count(_key(chrom[site], pos[site], QUALITY, kind[site], bq[site].astype(np.int64), up[site]))
        some = np.flatnonzero(site & alt)
        for i, c in enumerate(("mapq", "end_fraction", "softclip_fraction", "gap_nearness"), 1):
            v = np.asarray(_values(b, row[some], at[some])[c](), dtype=float)
            own = some[~np.isnan(v)]
            values.add(_key(chrom[own], pos[own], i, 1), v[~np.isnan(v)], np.ones(len(own), dtype=np.int64))
        own = np.flatnonzero(alt)
        edited.append((group[own], chrom[own], (ref[own] == 3).astype(np.int64), pos[own]))
        waiting, last = waiting + len(own), int(group[-1])
        if waiting > EDITED:
            told(last)
        for cells in (counts, values, steps):
            if cells.full():
                yield from rows(cells)
    if edited:
        told(last + 1)
    for cells in (counts, values, steps):
        yield from rows(cells)
