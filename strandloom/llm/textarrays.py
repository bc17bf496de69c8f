"""Words, shingles and windows of whole texts as numpy arrays, straight from Arrow string buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. A word's hash sums a pseudo-random value for each letter and
place (no polynomial in the letters, so no repetitive spelling cancels out); ``seed`` gives independent hashes. Windows of
words are 64-bit polynomials in those hashes over prefix sums, so a window of any width costs two look-ups.

A text is held whole by the task that reads it, with about 15 bytes of arrays for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MUL_WORD = 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Places of a word whose letter values are kept in a table; values of later places are computed.
_PLACES = 64
_LETTERS: dict[int, np.ndarray] = {}
#: Bytes of words hashed at a time, so that the arrays stay in the cache.
_CHUNK = 1 << 16


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        size = 1 << (size - 1).bit_length()
        out = []
        for b in (base, pow(base, -1, 2**64)):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 1 << 22:
            _POWERS[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of powers become evenly spread bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _letter(code: np.ndarray, seed: int) -> np.ndarray:
    """The value of a byte at a place of its word (code: place * 256 + byte)."""
    return mix(mix(code.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)))


def _word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hash of every word: the mixed sum of its letters' values by place, so words of any length differ for sure but for chance."""
    if seed not in _LETTERS:
        _LETTERS[seed] = _letter(np.arange(_PLACES * 256), seed)
    values, size = _LETTERS[seed], end - start
    out = np.empty(len(start), np.uint64)
    total = np.cumsum(size)
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1], _CHUNK)), len(start))) if len(start) else []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        n = size[i:j]
        first = np.cumsum(n) - n
        place = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        code = place * 256 + buf[np.repeat(start[i:j], n) + place]
        out[i:j] = np.add.reduceat(values[code] if n.max() <= _PLACES else _letter(code, seed), first)
    return mix(out + size.astype(np.uint64))


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` bytes of text (a longer text stands alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a slice of texts.

    buf: the bytes; start, end: byte range of every word; first: index of each text's first word, one entry more
    than there are texts; hash: a 64-bit hash of every word under ``seed``.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, seed: int = 0):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        buf = whole[offsets[0] : offsets[-1]]
        self.buf = _LOWER[buf] if lower else buf
        self.offsets = offsets - offsets[0]
        n = len(self.buf)
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        black = ~_SPACE[self.buf]
        before, after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        if n:
            before[1:] = ~black[:-1]
            after[:-1] = ~black[1:]
        self.start = np.flatnonzero(black & (before | edge[:n]))
        self.end = np.flatnonzero(black & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.hash = _word_hashes(self.buf, self.start, self.end, seed)

    def rehash(self, seed: int) -> Words:
        """The same words under an independent hash."""
        other = object.__new__(Words)
        other.__dict__.update(self.__dict__, hash=_word_hashes(self.buf, self.start, self.end, seed))
        return other

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all windows of ``k`` words inside one text, and their hashes."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        up, down = powers(_MUL_WORD, n + 1)
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hash * up[:n], out=prefix[1:])
        left = np.repeat(self.first[1:], self.counts())[: n - k + 1]
        at = np.flatnonzero(np.arange(n - k + 1) + k <= left)
        return at, mix((prefix[at + k] - prefix[at]) * down[at])

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of all k-word shingles; a text of fewer words gives its whole sequence as one."""
        at, h = self.windows(k)
        owner = self.owner()
        text = owner[at] if len(at) else np.zeros(0, np.int64)
        counts = self.counts()
        for j in range(1, k):
            short = np.flatnonzero(counts == j)
            if len(short):
                w, hw = self.windows(j)
                pick = np.isin(w, self.first[short])
                text = np.concatenate([text, owner[w[pick]]])
                h = np.concatenate([h, mix(hw[pick] + np.uint64(j))])
        order = np.argsort(text, kind="stable")
        return text[order], h[order]
