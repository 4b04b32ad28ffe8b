"""Words of many texts at once, as numpy arrays of 64-bit hashes.

A hash is a polynomial over the bytes of a word, taken from one pass over the
joined texts. Two different words share one with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: `[^\x20\x09-\x0D]+`, on the bytes of UTF-8.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, small letters and all beyond ASCII.
LETTERS = np.array([b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" for b in range(256)])

CHUNK_BYTES = 1 << 20  # texts joined at once; a longer text is a chunk by itself
PIECE_BYTES = 1 << 18  # of a chunk that are hashed at once, so that long texts need little more than their words
_STEP = np.uint64(0x9E3779B97F4A7C17)
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread what any bit says over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP) | np.uint64(1)


_KEPT: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the polynomial's base and of its inverse; PIECE_BYTES of them stay in memory."""
    if n > PIECE_BYTES:
        return np.cumprod(np.full(n, _STEP)), np.cumprod(np.full(n, _STEP_BACK))
    if not _KEPT:
        _KEPT.extend(np.cumprod(np.full(PIECE_BYTES, step)) for step in (_STEP, _STEP_BACK))
    return _KEPT[0][:n], _KEPT[1][:n]


class Words:
    """Words of a list of texts: `hashes`, the words of text d at first[d]:first[d + 1].

    `begins` and `ends` are byte offsets in `joined`, the lower-cased texts with a
    line end between them; offsets[d] is where text d begins in it.
    """

    def __init__(self, texts: list[bytes], kind: np.ndarray = NOT_SPACE, lower: bool = True) -> None:
        joined = b"\n".join(texts)
        self.joined = joined.lower() if lower else joined  # of bytes: A-Z alone
        self.begins, self.ends, self.hashes = _hashed(np.frombuffer(self.joined, np.uint8), kind)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.begins, self.offsets)

    def count(self, d: int) -> int:
        return int(self.first[d + 1] - self.first[d])

    def of(self, d: int) -> np.ndarray:
        return self.hashes[self.first[d] : self.first[d + 1]]


def _hashed(raw: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and hashes of the words, piece by piece; a word cut by the end of a piece is put together."""
    value = np.where(kind, _BYTE, np.uint64(0))
    begins, ends, sums = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    within = False  # the piece before ends within a word, the last of the last arrays
    for start in range(0, len(raw), PIECE_BYTES):
        piece = raw[start : start + PIECE_BYTES]
        edge = np.diff(kind[piece].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(begin):
            within = False
            continue
        up, down = powers(len(piece))
        total = np.add.reduceat(value[piece] * up, begin) * down[begin]
        if within and begin[0] == 0:
            shift = np.uint64(pow(int(_STEP), int(start - begins[-1][-1]), 1 << 64))
            sums[-1][-1:] += total[:1] * shift
            ends[-1][-1] = start + end[0]
            begin, end, total = begin[1:], end[1:], total[1:]
        within = bool(kind[piece[-1]])
        if len(begin):
            begins.append(begin + start)
            ends.append(end + start)
            sums.append(total)
    return np.concatenate(begins), np.concatenate(ends), mixed(np.concatenate(sums))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """As `folded`, in a few passes for any k, by differences of one running sum."""
    if len(hashes) < k:
        return np.empty(0, np.uint64)
    up, down = powers(len(hashes))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    return mixed((total[k:] - total[:-k]) * down[: len(hashes) - k + 1])


def folded(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each window of k hashes that follow each other."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n] + np.uint64(k)
    for i in range(1, k):
        out = out * _STEP + hashes[i : n + i]
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles.

    A text of fewer words has one, all of it; a text without words none.
    """
    windows = folded(words.hashes, k)
    for d in range(len(words.first) - 1):
        n = words.count(d)
        start = words.first[d]
        yield distinct(windows[start : start + n - k + 1]) if n >= k else folded(words.of(d), n) if n else windows[:0]


def octets(text: str) -> Column:
    """A text column as bytes for Python, null as empty."""
    return F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts, null as empty, of about CHUNK_BYTES or one long text each."""
    for batch in batches:
        values = batch.column(text).cast(pa.binary()).fill_null(b"")
        sizes = pc.binary_length(values).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > CHUNK_BYTES:
                yield batch.slice(start, i - start), values.slice(start, i - start).to_pylist()
                start, total = i, 0
            total += size
        if start < len(values):
            yield batch.slice(start), values.slice(start).to_pylist()


def row_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """As `chunks`, where the text is a field of the struct `row`, so that it comes once."""
    for batch in batches:
        yield from chunks([batch.append_column("row.text", batch.column("row").field("text"))], "row.text")


class Lines:
    """Lines of the texts that have a word: the text each is in, its number there (empty lines
    count), a hash of its words, and how many words it has."""

    def __init__(self, words: Words) -> None:
        ends = np.flatnonzero(np.frombuffer(words.joined, np.uint8) == 10)
        line = np.searchsorted(ends, words.begins)
        first = np.flatnonzero(np.diff(line, prepend=-1))
        self.n_words = np.diff(first, append=len(line))
        if len(first):
            up, down = powers(len(line))
            sums = np.add.reduceat(words.hashes * up, first)
            self.hashes = mixed(sums * down[first] + self.n_words.astype(np.uint64))
        else:
            self.hashes = np.empty(0, np.uint64)
        self.text = np.searchsorted(words.first, first, "right") - 1
        self.number = line[first] - np.searchsorted(ends, words.offsets)[self.text]


class Known:
    """A bounded set of 64-bit hashes, with a quick no for most others."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.ordered = np.sort(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.ordered >> np.uint64(44)).astype(np.int64)] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = self.maybe[(hashes >> np.uint64(44)).astype(np.int64)]
        if out.any():
            some = hashes[out]
            at = np.searchsorted(self.ordered, some)
            at[at == len(self.ordered)] = 0
            out[out] = self.ordered[at] == some
        return out
