"""Benchmark decontamination by a broadcast set of n-grams.

A window is n consecutive words of a benchmark item; an item of fewer words, but not none, is one
window. Documents are scanned for the hashes of the windows; a hit counts if its words are equal.
Null and empty texts have no words. Items of one item_id are one item; a null item_id is "null".
Repeated rows are reported one by one, very long texts are scanned whole, an empty benchmark hits nothing and an
empty table of documents gives an empty one.

The set is broadcast in blocks of a bounded number of windows. One block, the usual case, takes one
pass over the documents; each further one takes another, on what the one before has written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import all_columns, quoted, stored
from subtide.llm.words import LETTERS, Known, Words, folded, octets, row_chunks

BLOCK_WINDOWS = 500_000  # about 200 MB in a Python worker

Block = dict[int, dict[bytes, list[str]]]  # by length: windows and the items that have them


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row of `docs`: its words, the words that are hit, the items, and whether a twentieth is hit."""
    rows, marked = _marked(docs.select("doc_id", "text"), benchmark, n, block_windows)
    return rows.mapInArrow(lambda batches: _judged(marked(batches)), _verdict_of(rows)).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", _contaminated().alias("contaminated"), "items"
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = 13, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """`docs` without contaminated documents, or with the hit spans cut out of every text.

    A span goes from the first to the last character of words that are hit in a row.
    """
    rows, marked = _marked(docs, benchmark, n, block_windows)
    if remove == "documents":
        return rows.mapInArrow(lambda batches: _judged(marked(batches)), _verdict_of(rows)).where(~_contaminated()).select("row.*")
    if remove != "spans":
        raise ValueError(f"unknown remove {remove!r}")
    schema = T.StructType([rows.schema["row"], T.StructField("cut", T.BinaryType())])
    cut = rows.mapInArrow(lambda batches: _cut(marked(batches)), schema)
    kept = [F.col(f"row.{quoted(c)}") if c != "text" else F.expr("IF(row.text IS NULL, NULL, CAST(cut AS string))").alias("text") for c in docs.columns]
    return cut.select(*kept)


def _contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def _verdict_of(rows: DataFrame) -> T.StructType:
    out = T.StructType([rows.schema["row"]])
    for name in ("n_words", "n_hit", "n_items"):
        out = out.add(name, "long")
    return out.add("items_sha256", "string").add("items", T.ArrayType(T.StringType()))


def _blocks(benchmark: DataFrame, n: int, most: int) -> Iterator[Block]:
    """The windows of the benchmark, about `most` at a time. Items come to the driver one by one."""
    block: Block = {}
    size = 0
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), octets("text").alias("text"))
    for item, text in items.toLocalIterator():
        words = Words([bytes(text)], LETTERS)
        tokens = [words.joined[a:b] for a, b in zip(words.begins, words.ends)]
        length = min(n, len(tokens))
        for i in range(len(tokens) - length + 1 if tokens else 0):
            owners = block.setdefault(length, {}).setdefault(b" ".join(tokens[i : i + length]), [])
            if item not in owners:
                owners.append(item)
            size += 1
        if size >= most:
            yield block
            block, size = {}, 0
    if size:
        yield block


def _marked(docs: DataFrame, benchmark: DataFrame, n: int, most: int) -> tuple[DataFrame, Callable]:
    """`docs` as a struct `row` with the runs of hit words and items found in it by all blocks but the last, and what
    finds those of the last, for the pass that uses them."""
    rows = docs.select(
        F.struct(*all_columns(docs)).alias("row"),
        F.lit(None).cast("array<long>").alias("runs"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    scanned: Callable = iter
    for i, block in enumerate(_blocks(benchmark, n, most)):
        if i:
            rows = stored(rows.mapInArrow(scanned, rows.schema))
        scanned = _scanned(docs.sparkSession.sparkContext.broadcast(block))
    return rows, scanned


def _scanned(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: (Known(folded_windows(list(windows), n)), windows) for n, windows in sent.value.items()}
        for batch, texts in row_chunks(batches):
            words = Words(texts, LETTERS)
            covered = np.zeros(len(words.hashes) + 1, np.int32)
            items: dict[int, set[str]] = {}
            for n, (hashes, windows) in known.items():
                at = np.flatnonzero(hashes.has(folded(words.hashes, n)))
                doc = np.searchsorted(words.first, at, "right") - 1
                for i, d in zip(at[inside := at + n <= words.first[doc + 1]].tolist(), doc[inside].tolist()):
                    window = b" ".join([words.joined[a:b] for a, b in zip(words.begins[i : i + n], words.ends[i : i + n])])
                    if owners := windows.get(window):
                        items.setdefault(d, set()).update(owners)
                        covered[i] += 1
                        covered[i + n] -= 1
            hit = np.cumsum(covered[:-1]) > 0
            runs, found = batch.column("runs").to_pylist(), batch.column("items").to_pylist()
            for d, more in items.items():
                new = hit[words.first[d] : words.first[d + 1]]
                runs[d] = _runs(new | _hit(runs[d], len(new)))
                found[d] = sorted(more | set(found[d] or ()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(runs, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))],
                names=["row", "runs", "items"],
            )

    return run


def folded_windows(windows: list[bytes], n: int) -> np.ndarray:
    """The hashes that `folded` gives for these windows of n words."""
    words = Words(windows, LETTERS)
    return folded(words.hashes, n)[words.first[:-1]]


def _runs(hit: np.ndarray) -> list[int]:
    """First word and word after the last of each run, one after another."""
    return np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()


def _hit(runs: list[int] | None, n: int) -> np.ndarray:
    hit = np.zeros(n, bool)
    for a, b in zip((runs or [])[::2], (runs or [])[1::2]):
        hit[a:b] = True
    return hit


def _judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in row_chunks(batches):
        words = Words(texts, LETTERS)
        runs = [r or [] for r in batch.column("runs").to_pylist()]
        items = [sorted(x or []) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(np.diff(words.first).astype(np.int64)),
                pa.array([sum(r[1::2]) - sum(r[::2]) for r in runs], pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array(items, pa.list_(pa.string())),
            ],
            names=["row", "n_words", "n_hit", "n_items", "items_sha256", "items"],
        )


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in row_chunks(batches):
        out = []
        for text, runs in zip(texts, batch.column("runs").to_pylist()):
            if runs:
                words = Words([text], LETTERS)
                edges = [0, *[int(words.begins[r]) if i % 2 == 0 else int(words.ends[r - 1]) for i, r in enumerate(runs)], len(text)]
                text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], names=["row", "cut"])
