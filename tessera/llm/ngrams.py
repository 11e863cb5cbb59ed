"""Hashed byte n-grams and words of a batch of texts, as numpy arrays.

A batch is one byte array with all its texts end to end, and the place where each starts. Everything counted is
additive, so texts of any length are handled whole in pieces of PIECE bytes, cut at a white space if one is near.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64))


def pieces(texts: list[bytes], size: int = PIECE):
    """(rows, bytes) groups of some size: rows[i] is the text to which the i-th byte string belongs."""
    rows, group, total = [], [], 0
    for row, raw in enumerate(texts):
        start = 0
        while start < len(raw):
            end = min(len(raw), start + size)
            if end < len(raw):
                space = max(raw.rfind(b" ", start, end), raw.rfind(b"\n", start, end))
                end = space + 1 if space > start else end
            if total and total + end - start > size:
                yield rows, group
                rows, group, total = [], [], 0
            rows.append(row)
            group.append(raw[start:end])
            total += end - start
            start = end
    if group:
        yield rows, group


class Batch:
    """Byte strings, none empty, end to end."""

    def __init__(self, group: list[bytes]):
        self.data = np.frombuffer(b"".join(group), np.uint8)
        self.sizes = np.fromiter(map(len, group), np.int64, len(group))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """64-bit keys of all n-byte windows of the data, and which of them cross two texts (indices)."""
        size = len(self.data) - n + 1
        if size <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        key = self.data[:size].astype(np.uint64)
        for k in range(1, n):
            key = (key << np.uint64(8)) | self.data[k : k + size]
        cross = (self.ends[:-1, None] - np.arange(1, n)).ravel()
        return key, np.unique(cross[(cross >= 0) & (cross < size)])

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word (a run without ASCII white space) and the index of its text."""
        space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        head = ~space
        head[1:] &= space[:-1]
        head[self.starts] = ~space[self.starts]
        first = np.flatnonzero(head)
        if not len(first):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        number = np.cumsum(head) - 1
        place = np.arange(len(self.data)) - first[np.maximum(number, 0)]
        value = (self.data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255]
        value[space] = 0
        return mix(np.add.reduceat(value, first)), np.searchsorted(self.ends, first, "right")

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of values (one for each window start) over each text."""
        full = np.zeros(len(self.data), values.dtype)
        full[: len(values)] = values
        return np.add.reduceat(full, self.starts)


class Characters(Batch):
    """The characters of a batch of UTF-8 byte strings, each as one number, with the place where each text starts."""

    def __init__(self, batch: Batch):
        raw = batch.data
        head = (raw & 0xC0) != 0x80
        head[batch.starts] = True  # a piece may be cut inside a character
        first = np.flatnonzero(head)
        self.data = raw[first].astype(np.uint64)
        if len(first) < len(raw):
            size = np.diff(np.r_[first, len(raw)])
            for k in range(1, min(4, int(size.max()))):
                some = np.flatnonzero(size > k)
                self.data[some] |= raw[first[some] + k].astype(np.uint64) << np.uint64(8 * k)
        self.sizes = np.add.reduceat(head.astype(np.int64), batch.starts)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """64-bit keys of all windows of n characters, and which of them cross two texts (indices)."""
        size = len(self.data) - n + 1
        if size <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        key = self.data[:size].copy()
        for k in range(1, n):
            key = key * np.uint64(0xD6E8FEB86659FD93) + self.data[k : k + size]
        cross = (self.ends[:-1, None] - np.arange(1, n)).ravel()
        return key, np.unique(cross[(cross >= 0) & (cross < size)])


def mix(key: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys."""
    key = key * _ODD
    key ^= key >> np.uint64(29)
    return key * _ODD


def raw_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""
