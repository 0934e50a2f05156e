"""Ranges of BGZF files: blocks found by their headers, and places told as virtual offsets.

A virtual offset is the file offset of a block times 65,536 plus the place within its plain bytes. A range of a
file holds the blocks whose headers stand in it, so ranges that tile a file tile its blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

#: Longest block of the format, and what is fetched at once.
LONGEST = 1 << 16
FETCH = 1 << 20


class File:
    """Bytes of a file at any place, fetched in pieces."""

    def __init__(self, uri: str):
        from helixframe.sources.files import file_system

        fs, path = file_system(uri)
        self.f = fs.open_input_file(path)
        self.size = self.f.size()
        self.at, self.held, self.fetched = 0, b"", 0

    def read(self, at: int, n: int) -> bytes:
        """Up to n bytes from at on; fewer at the end of the file."""
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not self.at <= at or at + n > self.at + len(self.held):
            self.f.seek(at)
            self.at, self.held = at, self.f.read(max(n, min(FETCH, self.size - at)))
            self.fetched += len(self.held)
        return self.held[at - self.at : at - self.at + n]

    def close(self) -> None:
        self.f.close()

    def __enter__(self) -> File:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def block_size(head: bytes) -> int | None:
    """Bytes of the block whose header this is, or None."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return None
    extra, i = struct.unpack_from("<H", head, 10)[0], 12
    while i + 4 <= min(12 + extra, len(head)):
        n = struct.unpack_from("<H", head, i + 2)[0]
        if head[i : i + 2] == b"BC" and n == 2 and i + 6 <= len(head):
            return struct.unpack_from("<H", head, i + 4)[0] + 1
        i += 4 + n
    return None


def is_bgzf(f: File) -> bool:
    return block_size(f.read(0, 64)) is not None


def first_block(f: File, start: int, end: int) -> int | None:
    """File offset of the first block that begins in [start, end): a header that another (or the file's end) follows."""
    at = start
    while at < min(end, f.size):
        piece = f.read(at, min(FETCH, f.size - at))
        i = piece.find(b"\x1f\x8b\x08\x04")
        if i < 0:
            at += max(len(piece) - 3, 1)
            continue
        at += i
        if at >= end:
            return None
        size = block_size(f.read(at, 64))
        if size and (at + size == f.size or block_size(f.read(at + size, 64))):
            return at
        at += 1
    return None


def blocks(f: File, at: int) -> Iterator[tuple[int, bytes]]:
    """(file offset, plain bytes) of the blocks from one on."""
    while at < f.size:
        size = block_size(f.read(at, 64))
        if not size:
            raise ValueError(f"no block at byte {at}")
        raw = f.read(at, size)
        if len(raw) < size:
            raise ValueError(f"the block at byte {at} isn't whole")
        head = 12 + struct.unpack_from("<H", raw, 10)[0]
        data = zlib.decompress(raw[head:-8], -15)
        if zlib.crc32(data) != struct.unpack_from("<I", raw, size - 8)[0]:
            raise ValueError(f"the block at byte {at} is damaged")
        yield at, data
        at += size


class Plain:
    """Plain bytes from a block on, with the virtual offset of each place."""

    def __init__(self, f: File, at: int):
        self.more = blocks(f, at)
        self.data, self.starts = b"", []  # (place in data, file offset)
        self.base = 0  # of data in all plain bytes from the first block on

    def need(self, end: int) -> bool:
        """Whether there are plain bytes up to end."""
        parts, size = [self.data], self.base + len(self.data)
        while size < end:
            block = next(self.more, None)
            if block is None:
                break
            self.starts.append((size, block[0]))
            parts.append(block[1])
            size += len(block[1])
        if len(parts) > 1:
            self.data = b"".join(parts)
        return size >= end

    def get(self, at: int, n: int) -> bytes:
        self.need(at + n)
        return self.data[at - self.base : at - self.base + n]

    def offset(self, at: int) -> int:
        """Virtual offset of a place; the next block's, where one ends."""
        self.need(at + 1)
        while len(self.starts) > 1 and self.starts[1][0] <= at:
            self.starts.pop(0)
        if not self.starts:
            return 0
        return self.starts[0][1] << 16 | min(at - self.starts[0][0], 65_535)

    def drop(self, at: int) -> None:
        """What stands before at isn't asked for any more."""
        if at - self.base >= FETCH:
            self.data, self.base = self.data[at - self.base :], at


class Writer:
    """Plain bytes as blocks on a stream, written as they come."""

    def __init__(self, uri: str, block: int = 65_000, level: int = 6):
        from helixframe.sources.files import file_system

        fs, path = file_system(uri)
        fs.create_dir(path.rpartition("/")[0])
        self.out, self.block, self.level, self.held = fs.open_output_stream(path), block, level, bytearray()

    def write(self, data: bytes) -> None:
        self.held += data
        while len(self.held) >= self.block:
            self._flush(self.block)

    def _flush(self, n: int) -> None:
        part = bytes(self.held[:n])
        del self.held[:n]
        self.out.write(packed(part, self.level))

    def close(self) -> None:
        if self.held:
            self._flush(len(self.held))
        self.out.close()


def packed(part: bytes, level: int = 6) -> bytes:
    """One block."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(part) + c.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
