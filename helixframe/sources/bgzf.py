"""Blocked gzip (BGZF): a file of small gzip members, each of which says how long it is.

A virtual offset is the place of a block in the file times 65,536 plus a place within its plain bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

from .parts import Window

#: The most plain bytes that a written block holds.
BLOCK = 65_280
#: The empty block that ends a file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def inflated(data: bytes, crc: int, size: int) -> bytes:
    plain = zlib.decompress(data, -15, max(size, 1))
    if len(plain) != size or zlib.crc32(plain) != crc:
        raise ValueError("damaged BGZF block")
    return plain


def blocks(window: Window, place: int) -> Iterator[tuple[int, bytes]]:
    """Place and plain bytes of the blocks from a place on."""
    while place < window.size:
        head = window.bytes_at(place, 12)
        if len(head) < 12 or head[:4] != b"\x1f\x8b\x08\x04":
            raise ValueError(f"no BGZF block at {place}")
        more = struct.unpack_from("<H", head, 10)[0]
        extra, at, length = window.bytes_at(place + 12, more), 0, None
        while at + 4 <= more:
            tag, n = extra[at : at + 2], struct.unpack_from("<H", extra, at + 2)[0]
            if tag == b"BC" and n == 2:
                length = struct.unpack_from("<H", extra, at + 4)[0] + 1
            at += 4 + n
        if length is None:
            raise ValueError(f"gzip member without a length at {place}")
        body = window.bytes_at(place + 12 + more, length - 12 - more)
        if len(body) < length - 12 - more:
            raise ValueError("BGZF file ends within a block")
        yield place, inflated(body[:-8], *struct.unpack("<II", body[-8:]))
        place += length


class Reader:
    """Plain bytes in order from a virtual offset on; tells the virtual offset it is at."""

    def __init__(self, window: Window, offset: int = 0):
        self.rest = blocks(window, offset >> 16)
        self.place, self.data, self.at, self.done = offset >> 16, b"", 0, False
        self._next()
        self.at = offset & 0xFFFF

    def _next(self) -> None:
        self.at = 0
        for place, data in self.rest:
            if data:
                self.place, self.data = place, data
                return
        self.data, self.done = b"", True

    def offset(self) -> int | None:
        """Where the next byte is, None at the end."""
        if self.at >= len(self.data) and not self.done:
            self._next()
        return None if self.done else self.place << 16 | self.at

    def read(self, n: int) -> bytes:
        parts = []
        while n and self.offset() is not None:
            part = self.data[self.at : self.at + n]
            parts.append(part)
            self.at += len(part)
            n -= len(part)
        if n:
            raise ValueError("BGZF file ends within a record")
        return parts[0] if len(parts) == 1 else b"".join(parts)


class Writer:
    def __init__(self, out):
        self.out, self.written, self.held = out, 0, bytearray()

    def offset(self) -> int:
        return self.written << 16 | len(self.held)

    def write(self, record: bytes) -> None:
        """A record begins a new block where it does not fit into the present one."""
        if self.held and len(self.held) + len(record) > BLOCK:
            self.flush()
        self.held += record
        while len(self.held) > BLOCK:
            self.flush()

    def records(self, data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Writes records that lie end to end, as many into a block as fit, and says at which virtual offsets each begins and ends."""
        ends = np.cumsum(sizes)
        starts, offsets, at = ends - sizes, np.zeros((2, len(sizes)), np.int64), 0
        while at < len(sizes):
            stop = int(np.searchsorted(ends, starts[at] + BLOCK - len(self.held), "right"))
            if stop <= at and self.held:
                self.flush()
                continue
            begin, stop = self.offset(), max(stop, at + 1)
            self.write(data[starts[at] : ends[stop - 1]])
            offsets[0, at:stop], offsets[1, at:stop] = begin + starts[at:stop] - starts[at], begin + ends[at:stop] - starts[at]
            offsets[1, stop - 1] = self.offset()
            at = stop
        return offsets[0], offsets[1]

    def flush(self) -> None:
        plain, self.held = bytes(self.held[:BLOCK]), self.held[BLOCK:]
        if not plain:
            return
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(plain) + packer.flush()
        head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25)
        self.out.write(head + body + struct.pack("<II", zlib.crc32(plain), len(plain)))
        self.written += len(body) + 26

    def close(self) -> None:
        while self.held:
            self.flush()
        self.out.write(END)
