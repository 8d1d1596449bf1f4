"""Words and rolling hashes of Arrow text columns, in numpy over the UTF-8 bytes.

Whole texts are read; a batch is cut into chunks of whole documents so that memory stays bounded by the
chunk or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 500_000

# Bytes that belong to a word: everything but white space; or digits, letters and non-ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class Roller:
    """Polynomial (Rabin-Karp) hashes modulo 2^64 of spans of a sequence, by prefix sums."""

    def __init__(self, seed: int):
        self.base = int(seeded(1, seed)[0]) | 5  # odd, so that it has an inverse
        self.inverse = pow(self.base, -1, 1 << 64)
        self.grown(1 << 12)

    def grown(self, n: int) -> None:
        with np.errstate(over="ignore"):
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n + 1, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self.up):
            self.grown(max(len(values), 2 * len(self.up)))
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.down[starts]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offset at which each begins and the last ends; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def code_points(buf: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string, as an array of code points, and the code point at which each begins and the last ends."""
    text = buf.tobytes().decode("utf-8", "surrogateescape")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) == len(buf):
        return text, points, offsets
    begun = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=begun[1:])
    return text, points, begun[offsets]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents with at most limit bytes, or of one document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of every word; no word crosses documents."""
    n = len(buf)
    if n == 0:
        none = np.empty(0, np.int64)
        return none, none, none
    inside = member[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    begins = offsets[:-1]
    before[begins[begins < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    closes = offsets[1:]
    after[closes[closes > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class WordHasher:
    """64-bit hashes of words given as byte spans."""

    def __init__(self, seed: int):
        self.table = seeded(256, seed)
        self.roller = Roller(seed + 1)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = self.roller.sums(self.table[buf])
            lengths = (ends - starts).astype(np.uint64)
            return mix(self.roller.spans(sums, starts, ends) + lengths * np.uint64(0x9E3779B97F4A7C15))


def window_hashes(roller: Roller, words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of `size` words within one document."""
    if len(words) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(doc[: len(doc) - size + 1] == doc[size - 1 :])
    with np.errstate(over="ignore"):
        sums = roller.sums(words)
        return first, mix(roller.spans(sums, first, first + size))
