"""NumPy primitives over Arrow string columns: words, word hashes, window hashes.

Everything works on the UTF-8 bytes of many texts at once. A batch is bounded in bytes
(``common.BATCH_BYTES``, or one row if that is longer); its texts are taken in
chunks of about ``CHUNK`` bytes (a longer text is a chunk of its own), so what is computed beside the batch is
bounded by the longest text.

Nulls count as empty texts; an empty text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A longer word is hashed by itself.
_LONG_WORD = 64
_LEFT, _RIGHT = U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03)
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


class Words:
    """Words of several texts: byte starts and ends, the text of each, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets, self.n_texts = (LOWER[data] if lower else data), offsets, len(offsets) - 1
        n = len(data)
        blank = _SPACE[data]
        begins, ends = np.ones(n, bool), np.ones(n, bool)
        begins[1:], ends[:-1] = blank[:-1], blank[1:]
        first = offsets[:-1][offsets[1:] > offsets[:-1]]
        begins[first] = True
        ends[first[1:] - 1] = True
        solid = ~blank
        self.start = np.flatnonzero(solid & begins)
        self.end = np.flatnonzero(solid & ends) + 1
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        #: word range of text i: first[i]..first[i+1]
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; lanes are independent of one another.

        Blocks of eight bytes go through the finaliser one after the other, so that no arrangement of
        bytes cancels out; words over ``_LONG_WORD`` bytes get a cryptographic digest.
        """
        size = self.end - self.start
        h = mix(size.astype(np.uint64) * _RIGHT + U(lane + 1))
        if not len(h):
            return h
        padded = np.zeros(len(self.data) + 8, np.uint8)
        padded[: len(self.data)] = self.data
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        at = np.arange(len(h))
        for j in range(0, _LONG_WORD, 8):
            block = eight[self.start[at] + j] & _TAIL[np.minimum(size[at] - j, 8)]
            h[at] = mix((h[at] ^ block) * _LEFT)
            at = at[size[at] > j + 8]
            if not len(at):
                break
        for i in np.flatnonzero(size > _LONG_WORD):
            digest = blake2b(self.data[self.start[i] : self.end[i]].tobytes(), digest_size=8, salt=bytes([lane]))
            h[i] = U(int.from_bytes(digest.digest(), "little"))
        return h

    def joined(self, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray]:
        """The words (at positions ``keep``, else all), each followed by a space, and where each text's begin."""
        keep = np.arange(len(self.start)) if keep is None else keep
        size = self.end[keep] - self.start[keep] + 1
        to = np.r_[0, np.cumsum(size)]
        source = np.arange(to[-1]) + np.repeat(self.start[keep] - to[:-1], size)
        out = np.append(self.data, np.uint8(0x20))[np.minimum(source, len(self.data))]
        out[to[1:] - 1] = 0x20
        return out.tobytes(), to[np.searchsorted(keep, self.first)]

    def digests(self) -> list[bytes]:
        """128 bits for the word sequence of each text."""
        raw, cut = self.joined()
        return [blake2b(raw[a:z], digest_size=16).digest() for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def combine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    return mix(x * _LEFT + (y ^ (y >> U(29))) * _RIGHT)


def windows(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (ends of texts are the caller's), from halves of doubled width."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    part, width, out, done = mix(words + U(salt)) if salt else words, 1, None, 0
    while True:
        if k & width:
            out = part[:n] if out is None else combine(out[:n], part[done : done + n])
            done += width
        if done == k:
            return mix(out + U(k))
        part = combine(part[: len(part) - width], part[width:])
        width *= 2


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Mask over ``windows(..., k)``: those that lie within one text."""
    n = int(first[-1]) - k + 1
    keep = np.ones(max(n, 0), bool)
    for d in range(1, k):
        at = first[1:-1] - d
        at = at[(at >= 0) & (at < n)]
        keep[at] = False
    return keep


def fold(values: np.ndarray, lo: int, hi: int) -> bytes:
    """128-bit digest of a slice of 64-bit values."""
    return blake2b(values[lo:hi].tobytes(), digest_size=16).digest()


def binaries(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))
