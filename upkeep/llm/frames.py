"""Texts as sequences of independent zstandard frames with cumulative unit counts.

A frame holds whole code points of UTF-8 text and can be decompressed without
the others; ``ends[i]`` is the number of code points up to the end of frame i,
so that the frame of a position is found by binary search.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import zstandard

#: UTF-8 bytes of a frame, about.
FRAME_BYTES = 64 << 10
LEVEL = 3

_tools: dict[str, object] = {}


def compress(data: bytes) -> bytes:
    if "c" not in _tools:
        _tools["c"] = zstandard.ZstdCompressor(level=LEVEL)
    return _tools["c"].compress(data)


def decompress(frame: bytes) -> bytes:
    if "d" not in _tools:
        _tools["d"] = zstandard.ZstdDecompressor()
    return _tools["d"].decompress(frame)


def units(data: bytes) -> int:
    """Code points of whole UTF-8 text."""
    return len(data) if data.isascii() else int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def offset(data: bytes, unit: int) -> int:
    """The byte at which code point ``unit`` starts (the text's length for the one after the last)."""
    if data.isascii():
        return unit
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return len(data) if unit >= len(starts) else int(starts[unit])


class Writer:
    """Collects frames: small stretches of text share one, frames that come whole stay as they are."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.ends: list[int] = []
        self.open: list[bytes] = []
        self.size = self.total = 0

    def text(self, data: bytes) -> None:
        lo = 0
        while lo < len(data):
            hi = min(len(data), lo + FRAME_BYTES - self.size)
            while lo < hi < len(data) and data[hi] & 0xC0 == 0x80:
                hi -= 1
            if hi > lo:
                self.open.append(data[lo:hi])
                self.size += hi - lo
            lo, more = hi, hi < len(data)
            if more or self.size >= FRAME_BYTES:
                self.close()

    def frame(self, frame: bytes, count: int) -> None:
        self.close()
        self.frames.append(frame)
        self.total += count
        self.ends.append(self.total)

    def close(self) -> None:
        if self.open:
            data = b"".join(self.open)
            self.open, self.size = [], 0
            self.frame(compress(data), units(data))


def framed(data: bytes) -> tuple[list[bytes], list[int]]:
    """Frames of a text and their cumulative unit counts; an empty text has none."""
    out = Writer()
    out.text(data)
    out.close()
    return out.frames, out.ends


def copy_units(out: Writer, frames: list[bytes], ends: list[int], lo: int, hi: int) -> None:
    """Appends code points lo to hi: only the frames that are cut are decompressed, the others are taken as they are."""
    k = bisect_right(ends, lo)
    while lo < hi:
        begin = ends[k - 1] if k else 0
        if lo == begin and ends[k] <= hi:
            out.frame(frames[k], ends[k] - begin)
        else:
            data = decompress(frames[k])
            out.text(data[offset(data, lo - begin):offset(data, min(hi, ends[k]) - begin)])
        lo, k = ends[k], k + 1


def stream(frames: list[bytes]) -> Iterator[bytes]:
    """The text's bytes in order, one frame in memory at a time."""
    return map(decompress, frames)


def find(frames: list[bytes], marks: list[bytes]) -> tuple[list[int], list[int]]:
    """Byte offsets of the first of ``marks``, of the first second one after it and so on (-1: none), and each frame's cumulative bytes."""
    at, sizes, found = 0, [], []
    tail = b""  # of the frames before, so that marks across frames are seen
    for data in stream(frames):
        window = tail + data
        start, lo = at - len(tail), 0
        while len(found) < len(marks) and (hit := window.find(marks[len(found)], max(lo, (found[-1] + len(marks[len(found) - 1]) - start) if found else 0))) >= 0:
            found.append(start + hit)
            lo = hit + 1
        at += len(data)
        sizes.append(at)
        keep = max(map(len, marks)) - 1
        tail = window[-keep:] if keep else b""
    return found + [-1] * (len(marks) - len(found)), sizes


def stream_bytes(frames: list[bytes], sizes: list[int], lo: int, hi: int) -> Iterator[bytes]:
    """Bytes lo to hi; ``sizes`` as returned by ``find``."""
    k = bisect_right(sizes, lo)
    while lo < hi:
        begin = sizes[k - 1] if k else 0
        yield decompress(frames[k])[lo - begin:hi - begin]
        lo, k = sizes[k], k + 1
