"""Substring dedup: repeated windows of words, found behind a count-min prefilter.

A window is so many consecutive words of one document. A word goes if a window that covers it has a
word sequence that also starts anywhere else, in the same document or another one. All windows are
judged on the input.

1. Tasks count in sketches of their own: `ROWS` rows of cells, a count of one or of two and more in each. Sketches
   travel piece by piece, as the gaps between cells in use, and are merged by piece. An estimate, the
   smallest of an item's cells, is never below its count. There are two:
   * of anchors: the anchor of a window is that of its runs of half its words which has the least hash, the
     first of equal ones. Equal windows at two places have equal anchors at two places, and neighbouring windows
     mostly share theirs, so a tenth of the places is counted. A window whose anchor is alone is alone.
   * of the windows whose anchor is estimated repeated.
   A repeated window is estimated repeated by both, so none is lost.
2. Windows that both estimate repeated are counted exactly (by 128 bits made of the words' hashes); those that are
   alone after all were overestimated.
3. The last pass cuts what the windows cover that are estimated repeated and not overestimated.

A sketch has `CELLS_PER_ITEM` cells a row for each item up to `MOST_CELLS` (48 MB of bits in all, which is what the driver
and each Python worker hold of each of the two). Beyond that more windows are overestimated: they cost more in the
second pass, and the result is the same. Overestimated windows go to all tasks up to `MOST_ALONE`; beyond
that each is located by its text's digest, which is unique since its text has no copy, and joined with the texts.

Null, empty and short texts (fewer words than a window) lose nothing. Very long texts are hashed in pieces. Rows
of one doc_id, or without one, are documents of their own, so equal rows lose all their windows, every copy
alike: of a passage that repeats no copy stays. An empty table gives an empty table. Other columns, whatever
their names, stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.sketch import PIECE_CELLS, bits_of, cells_for, from_gaps, gaps
from subtide.llm.store import stored
from subtide.llm.words import NOT_SPACE, Words, chunks, mixed, octets, window_hashes

ROWS = 3  # of a sketch
CELLS_PER_ITEM = 4
MOST_CELLS = 1 << 27  # of a row
HELD = 2_000_000  # windows a task holds before it passes them on
MOST_ALONE = 4_000_000  # overestimated windows sent to all tasks; 64 MB
_OTHER = np.uint64(0xD6E8FEB86659FD93)

_PIECE = T.StructType().add("piece", "integer").add("once", "binary").add("twice", "binary")
_BITS = T.StructType().add("piece", "integer").add("bits", "binary")
_COUNTED = T.StructType().add("high", "long").add("low", "long").add("n", "long")
_LOCATED = T.StructType([*_COUNTED, *T.StructType().add("digest", "string").add("start", "long")])
_REPORT = T.StructType().add("doc_id", "long").add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")


def remove_repeats(docs: DataFrame, window: int = 35, most_alone: int = MOST_ALONE) -> DataFrame:
    """`docs` without the words of repeated windows; the words that stay of a text that loses some are joined by blanks."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch, cut: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        texts = [kept.decode(errors="replace") if removed else text for text, (_, removed, kept) in zip(texts, cut)]
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    # By place: mapInArrow takes no column names with dots.
    placed = docs.toDF(*["text" if i == at else f"column_{i}" for i in range(len(docs.columns))])
    return _cut(placed, window, run, placed.schema, most_alone).toDF(*docs.columns)


def substring_report(docs: DataFrame, window: int = 35, most_alone: int = MOST_ALONE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of `docs`; the digest is of the words that stay, joined by blanks."""

    def run(batch: pa.RecordBatch, cut: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        digests = [hashlib.sha256(kept if removed else b" ".join(kept.split())).hexdigest() for _, removed, kept in cut]
        counts = [pa.array([c[i] for c in cut], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(digests, pa.string())], names=_REPORT.names)

    return _cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), octets("text").alias("text")), window, run, _REPORT, most_alone)


def _cut(docs: DataFrame, window: int, output: Callable, schema: T.StructType, most_alone: int) -> DataFrame:
    texts = docs.select(octets("text").alias("text"))
    words = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 6  # about six bytes each
    send = docs.sparkSession.sparkContext.broadcast
    anchors = send(_sketch(texts, window, cells_for(CELLS_PER_ITEM * words // 10, MOST_CELLS), None))
    sent = [anchors, send(_sketch(texts, window, cells_for(CELLS_PER_ITEM * words // 2, MOST_CELLS), anchors))]
    counted = texts.mapInArrow(_estimated_repeated(window, sent), _COUNTED).groupBy("high", "low").agg(F.sum("n").alias("n"))
    alone = stored(counted.where("n = 1").select("high", "low"))
    if alone.count() <= most_alone:
        return docs.mapInArrow(_cutting(window, sent, send(_pairs(alone)), output), schema)
    located = texts.mapInArrow(_estimated_repeated(window, sent, located=True), _LOCATED).groupBy("high", "low")
    located = located.agg(F.sum("n").alias("n"), F.min(F.struct("digest", "start")).alias("at")).where("n = 1")
    starts = located.groupBy("at.digest").agg(F.collect_list("at.start").alias("starts"))  # no more than a text has words
    joined = docs.withColumn("digest_of_text", F.md5(octets("text"))).join(stored(starts), F.col("digest_of_text") == F.col("digest"), "left")
    return joined.drop("digest_of_text", "digest").mapInArrow(_cutting(window, sent, None, output), schema)


# 1: the sketches


def _sketch(texts: DataFrame, window: int, cells: int, anchors) -> np.ndarray:
    """Bits of the cells with a count of two or more, by row: of anchors, or of the windows that `anchors` lets through."""
    partial = texts.mapInArrow(_sketched(window, cells, anchors), _PIECE)
    merged = partial.repartition("piece").sortWithinPartitions("piece").mapInArrow(_merged, _BITS)
    bits = np.zeros((ROWS * cells // PIECE_CELLS, PIECE_CELLS // 8), np.uint8)
    for row in stored(merged).toLocalIterator():  # at most ROWS * MOST_CELLS bits
        bits[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(ROWS, -1)


def _cells(high: np.ndarray, low: np.ndarray, cells: int) -> list[np.ndarray]:
    mask = np.uint64(cells - 1)
    return [(high & mask).astype(np.int64), ((high >> np.uint64(32)) & mask).astype(np.int64), (low & mask).astype(np.int64)]


def _anchors(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the windows that lie within one text begin, by word, and the place and hash of each one's anchor."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none.view(np.uint64)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    start = np.flatnonzero(text[:n] == text[k - 1 :])
    least = window_hashes(words.hashes, k // 2 + 1)
    place = np.arange(len(least))
    span, wanted = 1, k - k // 2
    while span < wanted:  # the least of so many places that follow each other, the first of equal ones
        step = min(span, wanted - span)
        later = least[step:] < least[:-step]
        least, place = np.where(later, least[step:], least[:-step]), np.where(later, place[step:], place[:-step])
        span += step
    return start, place[start], least[start]


def _windows(words: Words, k: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the windows that begin at `start`."""
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return window_hashes(words.hashes, k)[start], window_hashes(mixed(words.hashes + _OTHER), k)[start]


def _words(texts: list[bytes]) -> Words:
    return Words(texts, NOT_SPACE, lower=False)


def _sketched(window: int, cells: int, anchors):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for row, parts in enumerate(held):
                found = np.sort(np.concatenate(parts))
                parts.clear()
                first = np.concatenate([[True], found[1:] != found[:-1]])
                again = np.zeros(len(found), bool)
                again[:-1] = ~first[1:]
                used, twice = found[first].astype(np.int64), found[first & again].astype(np.int64)
                edges = np.arange(0, cells + 1, PIECE_CELLS)
                at, at_twice = np.searchsorted(used, edges), np.searchsorted(twice, edges)
                full = np.flatnonzero(np.diff(at))
                lists = [
                    pa.array([gaps(values[x[p] : x[p + 1]] - p * PIECE_CELLS) for p in full], pa.binary())
                    for values, x in ((used, at), (twice, at_twice))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(full + row * cells // PIECE_CELLS, pa.int32()), *lists], names=_PIECE.names)

        for _, texts in chunks(batches):
            words = _words(texts)
            if anchors is None:
                _, place, high = _anchors(words, window)
                high = high[np.flatnonzero(np.diff(place, prepend=-1))]  # each place once
                low = mixed(high + _OTHER)
            else:
                high, low = _windows(words, window, _likely(words, window, anchors.value))
            if len(high):
                for parts, c in zip(held, _cells(high, low, cells)):
                    parts.append(c.astype(np.uint32))
                size += len(high)
            if size > HELD:
                yield from flushed()
                size = 0
        if size:
            yield from flushed()

    return run


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces that come sorted: a cell has two if one part has, or if two parts have one."""
    piece = None
    once, twice = np.zeros(PIECE_CELLS, bool), np.zeros(PIECE_CELLS, bool)

    def done() -> pa.RecordBatch:
        bits = np.packbits(twice, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([bits], pa.binary())], names=_BITS.names)

    for batch in batches:
        for p, one, two in zip(batch.column("piece").to_pylist(), batch.column("once"), batch.column("twice")):
            if p != piece:
                if piece is not None:
                    yield done()
                piece = p
                once[:], twice[:] = False, False
            used = from_gaps(one.as_py())
            twice[used[once[used]]] = True
            twice[from_gaps(two.as_py())] = True
            once[used] = True
    if piece is not None:
        yield done()


# 2: exact counts of the windows estimated repeated


def _repeated(bits: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Where all cells have a count of two or more."""
    at = np.arange(len(high))
    for row in range(ROWS):
        at = at[bits_of(bits[row], _cells(high[at], low[at], bits.shape[1] * 8)[row])]
    return at


def _likely(words: Words, k: int, anchors: np.ndarray) -> np.ndarray:
    """Where the windows begin whose anchor is estimated repeated."""
    start, _, anchor = _anchors(words, k)
    return start[_repeated(anchors, anchor, mixed(anchor + _OTHER))]


def _estimated(words: Words, k: int, sent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the windows begin that both sketches estimate repeated, and their 128 bits."""
    start = _likely(words, k, sent[0].value)
    high, low = _windows(words, k, start)
    at = _repeated(sent[1].value, high, low)
    return start[at], high[at], low[at]


def _estimated_repeated(window: int, sent, located: bool = False):
    """Counts of a task's windows, each once; `located` adds the digest of a text that has it and where it begins there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        digests: list[str] = []
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            high, low, text, start = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
            n = np.diff(first, append=len(high))
            columns = [high[first].view(np.int64), low[first].view(np.int64), n]
            some = order[first]
            for i in range(0, len(n), 50_000):
                part = [pa.array(c[i : i + 50_000]) for c in columns]
                if located:
                    mine = some[i : i + 50_000]
                    part += [pa.array([digests[t] for t in text[mine]], pa.string()), pa.array(start[mine])]
                yield pa.RecordBatch.from_arrays(part, names=_LOCATED.names if located else _COUNTED.names)

        for _, texts in chunks(batches):
            words = _words(texts)
            start, high, low = _estimated(words, window, sent)
            if len(start):
                text = np.searchsorted(words.first, start, "right") - 1
                held.append((high, low, text + len(digests), start - words.first[text]))
                size += len(start)
            if located:
                digests.extend(hashlib.md5(t).hexdigest() for t in texts)
            if size > HELD // 2:
                yield from flushed()
                held.clear()
                digests.clear()
                size = 0
        if size:
            yield from flushed()

    return run


def _pairs(alone: DataFrame) -> np.ndarray:
    """(high, low) sorted; `most_alone` of them at most."""
    table = alone.toArrow()
    columns = [table.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("high", "low")]
    order = np.lexsort(columns[::-1])
    return np.stack([c[order] for c in columns])


def _among(pairs: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which of the windows are among the sorted pairs."""
    out = np.zeros(len(high), bool)
    if pairs.shape[1]:
        at = np.searchsorted(pairs[0], high)
        left = np.arange(len(high))
        while len(left):  # once, but for windows that share their upper half
            at, left = at[inside := at < pairs.shape[1]], left[inside]
            at, left = at[same := pairs[0][at] == high[left]], left[same]
            out[left[pairs[1][at] == low[left]]] = True
            at = at + 1
    return out


# 3: what stays


def _kept(words: Words, texts: list[bytes], start: np.ndarray, k: int) -> list[tuple[int, int, bytes]]:
    """Per text its words, those removed, and what stays: the text itself if nothing goes."""
    cover = np.zeros(len(words.hashes) + 1, np.int32)
    cover[start] += 1
    cover[start + k] -= 1
    gone = np.cumsum(cover[:-1]) > 0
    out = []
    for d, text in enumerate(texts):
        first, last = words.first[d], words.first[d + 1]
        mine = gone[first:last]
        removed = int(mine.sum())
        if removed:
            edge = np.diff(mine.view(np.int8), prepend=np.int8(1), append=np.int8(1))
            runs = zip(np.flatnonzero(edge == -1) + first, np.flatnonzero(edge == 1) + first)
            text = b" ".join(b" ".join(words.joined[words.begins[a] : words.ends[b - 1]].split()) for a, b in runs)
        out.append((int(last - first), removed, text))
    return out


def _cutting(window: int, sent, alone, output: Callable):
    """Cuts the texts; overestimated windows come as `alone`, or else with each row as its last column."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            words = _words(texts)
            start, high, low = _estimated(words, window, sent)
            if alone is not None:
                start = start[~_among(alone.value, high, low)]
            else:
                lists = batch.column(batch.num_columns - 1)
                batch = batch.select(range(batch.num_columns - 1))
                sizes = np.array([len(x) if x.is_valid else 0 for x in lists])
                single = np.repeat(words.first[:-1], sizes) + lists.flatten().to_numpy()
                start = start[~np.isin(start, single)]
            yield output(batch, _kept(words, texts, start, window))

    return run
