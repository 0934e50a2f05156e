"""Lines of large text files by ranges: plain and BGZF files split, other gz files are streamed as one range."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from helixframe.sources import bgzf

#: Bytes of a file that one task reads.
SPLIT = 64 << 20
PLAIN, BLOCKED, WHOLE = "plain", "bgzf", "gz"


def kind_of(f: bgzf.File) -> str:
    return PLAIN if f.read(0, 2) != b"\x1f\x8b" else BLOCKED if bgzf.is_bgzf(f) else WHOLE


def ranges(path: str, split: int = SPLIT) -> int:
    """How many ranges of ``split`` bytes the file has; one where it can't be split."""
    with bgzf.File(path) as f:
        return 1 if kind_of(f) == WHOLE else max(1, -(-f.size // split))


def _pieces(f: bgzf.File, kind: str, start: int, end: int) -> Iterator[tuple[bool, bytes]]:
    """Plain bytes from the range's first place on to the file's end, and whether they begin within the range."""
    if kind == PLAIN:
        at = start
        while at < f.size:
            n = min(bgzf.FETCH, f.size - at, end - at if at < end else bgzf.FETCH)
            yield at < end, f.read(at, n)
            at += n
    elif kind == BLOCKED:
        block = bgzf.first_block(f, start, end)
        for at, data in bgzf.blocks(f, block) if block is not None else ():
            yield at < end, data
    else:
        d, at = zlib.decompressobj(31), 0
        while at < f.size:
            chunk = f.read(at, min(bgzf.FETCH, f.size - at))
            at += len(chunk)
            while chunk:
                out = d.decompress(chunk)
                if out:
                    yield True, out
                chunk = d.unused_data if d.eof else b""
                if d.eof:
                    d = zlib.decompressobj(31)


def _byte_before(f: bgzf.File, kind: str, start: int, end: int) -> bytes:
    """The plain byte before the range's first one: it tells whether a line begins there."""
    if kind == PLAIN:
        return f.read(start - 1, 1)
    block = bgzf.first_block(f, start, end)
    at = bgzf.first_block(f, max(0, block - 4 * bgzf.LONGEST), block) if block else None
    last = b"\n"
    while at is not None and at < block:
        _, data = next(bgzf.blocks(f, at))
        last = data[-1:] or last
        at += bgzf.block_size(f.read(at, 64))
    return last


def lines(f: bgzf.File, start: int = 0, end: int | None = None) -> Iterator[tuple[bool, bytes]]:
    """Lines (without their end) from the first that begins in the range on to the file's end, and whether each begins within the range.

    Ranges that tile a file tile its lines: a line is of the range, or block, that its first byte stands in.
    """
    kind, end = kind_of(f), f.size if end is None else min(end, f.size)
    if start >= end or kind == BLOCKED and bgzf.first_block(f, start, end) is None:
        return
    whole = start == 0 or _byte_before(f, kind, start, end) == b"\n"
    held: list[bytes] = []
    began = None  # whether the held line began within the range
    for inside, piece in _pieces(f, kind, start, end):
        rows = piece.split(b"\n")
        if rows[0] and began is None:
            began = inside
        if len(rows) == 1:
            held.append(rows[0])
            continue
        if whole:
            yield inside if began is None else began, b"".join([*held, rows[0]])
        whole = True
        for row in rows[1:-1]:
            yield inside, row
        held, began = [rows[-1]], inside if rows[-1] else None
    if whole and any(held):
        yield bool(began), b"".join(held)
