"""Cross-site boilerplate lines by the number of distinct sites that have them.

A line is its words, lower-cased (A-Z) and one space apart; lines of fewer than `min_words` words
are never boilerplate. A site is a value of `source`; null counts as one site. Sites are counted by
a HyperLogLog sketch per line, merged by aggregation; lines whose estimate is near `min_sites` are
counted exactly. So the verdict is exact but for lines far beyond the sketch's error. Where all
documents have fewer than 13 distinct sites, a line needs `SHARE` of them (two at least) instead of `min_sites`.

A boilerplate line goes from every text that has it, short or long, but for texts without any other line of
`min_words` words: these are copies of a much copied text, no hosts of boilerplate, and stay as they are, since near
duplicates are another operator's work. Null and empty texts stay as they are; very long ones are hashed in
pieces. Repeated rows are cut alike, each for itself; a line's sites count once however often one has it. An
empty table gives an empty one. All columns, whatever their names, stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import all_columns, quoted, stored
from subtide.llm.words import Known, Lines, Words, chunks, octets, row_chunks

BLOCK_LINES = 2_000_000  # hashes broadcast at once; 16 MB
SKETCH_BITS = 12  # 4,096 registers, a standard error of 1.6 %
SHARE = 0.75  # of the distinct sites, which makes a line boilerplate if it is less than min_sites
NEAR = 0.1  # relative distance from min_sites within which lines are counted exactly
PAIRS = 500_000  # (line, site) pairs a task holds before it passes them on


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, min_words: int = 3, block_lines: int = BLOCK_LINES) -> DataFrame:
    """`docs` with boilerplate lines cut from `text`."""
    cut = _cut_rows(docs, min_sites, min_words, block_lines)
    kept = [F.col(f"row.{quoted(c)}") if c != "text" else F.expr("IF(row.text IS NULL, NULL, CAST(cut AS string))").alias("text") for c in docs.columns]
    return cut.select(*kept)


def line_report(docs: DataFrame, min_sites: int = 10, min_words: int = 3, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Per row of `docs` its lines with a word, those removed, and the MD5 of the text that stays."""
    cut = _cut_rows(docs.select("doc_id", "source", "text"), min_sites, min_words, block_lines)
    return cut.select("row.doc_id", "row.source", "n_lines", "n_removed", F.md5("cut").alias("text_md5"))


def boilerplate_lines(docs: DataFrame, min_sites: int, min_words: int) -> DataFrame:
    """Hashes of the lines that `min_sites` distinct sites have, or SHARE of all, if that is less."""
    sites = docs.select(F.xxhash64(F.col("source").cast("string"))).distinct().limit(math.ceil(min_sites / SHARE)).count()
    min_sites = min(min_sites, max(2, math.ceil(SHARE * sites)))
    texts = docs.select(F.xxhash64(F.col("source").cast("string")).alias("site"), octets("text").alias("text"))
    pairs = texts.mapInArrow(_spread(min_words), "line long, site long")
    sketches = pairs.groupBy("line").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
    spread = stored(
        sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= max(min(1.5, min_sites - 0.5), min_sites * (1 - NEAR) - 1))
    )
    near = F.col("sites") <= min_sites * (1 + NEAR) + 1
    exact = pairs.join(spread.where(near).select("line"), "line", "left_semi").distinct().groupBy("line").count()
    return stored(spread.where(~near).select("line").union(exact.where(F.col("count") >= min_sites).select("line")))


def _spread(min_words: int):
    """The distinct pairs of line and site in a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(held), axis=0) if len(held) > 1 else held[0]
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["line", "site"])

        for batch, texts in chunks(batches):
            lines = Lines(Words(texts))
            keep = lines.n_words >= min_words
            site = batch.column("site").to_numpy()[lines.text[keep]]
            held.append(np.unique(np.stack([lines.hashes[keep].view(np.int64), site], axis=1), axis=0))
            size += len(held[-1])
            if size > PAIRS:
                yield flushed()
                held, size = [], 0
        if held:
            yield flushed()

    return run


def _cut_rows(docs: DataFrame, min_sites: int, min_words: int, block_lines: int) -> DataFrame:
    """`docs` as a struct `row`, with the text that stays (`cut`) and counts of lines."""
    lines = boilerplate_lines(docs, min_sites, min_words)
    blocks = max(1, -(-lines.count() // block_lines))
    rows = docs.select(F.struct(*all_columns(docs)).alias("row"), F.lit(None).cast("array<long>").alias("marks"))
    marked = None
    for k in range(blocks):
        if marked:
            rows = stored(rows.mapInArrow(marked, rows.schema))
        block = lines.where(F.pmod("line", F.lit(blocks)) == k).toArrow().column("line").to_numpy()
        marked = _marked(docs.sparkSession.sparkContext.broadcast(block.astype(np.int64).view(np.uint64)))
    schema = T.StructType([rows.schema["row"]]).add("cut", "binary").add("n_lines", "long").add("n_removed", "long")
    without = _without(min_words)
    # The last block in the same pass and the same Python worker.
    return rows.mapInArrow(lambda batches: without(marked(batches)), schema)


def _marked(sent):
    """Adds to `marks` the lines (counting those with a word) whose hash is in the block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(sent.value)
        for batch, texts in row_chunks(batches):
            lines = Lines(Words(texts))
            marks = batch.column("marks").to_pylist()
            first = np.searchsorted(lines.text, np.arange(len(texts)))
            for i in np.flatnonzero(known.has(lines.hashes)).tolist():
                d = int(lines.text[i])
                marks[d] = [*(marks[d] or []), i - int(first[d])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(marks, pa.list_(pa.int64()))], names=["row", "marks"])

    return run


def _without(min_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in row_chunks(batches):
            lines = Lines(Words(texts))
            bounds = np.searchsorted(lines.text, np.arange(len(texts) + 1))
            out, removed = [], []
            for d, (text, marks) in enumerate(zip(texts, batch.column("marks").to_pylist())):
                own = slice(bounds[d], bounds[d + 1])
                size = lines.n_words[own]
                gone = [m for m in marks or [] if size[m] >= min_words]
                if gone and len(gone) < int((size >= min_words).sum()):
                    numbers = set(lines.number[own][gone].tolist())
                    text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in numbers)
                else:
                    gone = []
                out.append(text)
                removed.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, pa.binary()), pa.array(np.diff(bounds).astype(np.int64)), pa.array(removed, pa.int64())],
                names=["row", "cut", "n_lines", "n_removed"],
            )

    return run
