"""Quality rules: a hashed n-gram log-likelihood ratio of trusted and raw text.

Words and pairs of neighbouring words are hashed into `BUCKETS` buckets. Two multinomials, of the
trusted documents and of all documents, give each bucket a log ratio (both with one added); a
document's score is the mean of its features' ratios, so that length does not count. Ratios are
kept as integers, so scores and verdicts do not depend on the order of work. A document passes if
its score reaches the threshold: the highest step of 1/1000 that keeps the share `keep` of the
trusted documents that pass the base rules. For that they are scored by the ratios of the other half
of the trusted documents, as any document is by those of others. Without any of those every
document passes.

Base rules: at least 50 words, and at most half of them in 3-word windows that repeat. Null and
empty texts have no words and fail; very long ones are scored whole. A score at the threshold passes. An empty table gives
an empty one, and columns other than doc_id and text take no part, whatever their names. A document is trusted if a label row says so; repeated rows of
a doc_id are scored one by one, null ids are never trusted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import broadcast_if_small, stored
from subtide.llm.words import Words, chunks, folded, octets

BUCKETS = 1 << 14
SCALE = 1 << 20
STEP = 1000
SYMBOLS = b"#*$%&|<>"
SPACE = b"\t\n\x0b\x0c\r "
_NOT_IN_WORDS = SPACE + bytes(range(0x80, 0xC0))  # with the bytes that only continue a code point

_SCORED = T.StructType()
for _name in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "total", "features", "crossed"):
    _SCORED = _SCORED.add(_name, "long")
_SCORED = _SCORED.add("trusted", "boolean")


def quality(docs: DataFrame, labels: DataFrame, keep: float = 0.98) -> DataFrame:
    """Per row of `docs` (doc_id, text) the base counts, the score and whether it is kept.

    Rows of `labels` (doc_id, quality) with quality 1 make a document trusted.
    """
    trusted = stored(labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), octets("text").alias("text")).join(
        broadcast_if_small(trusted.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))), "doc_id", "left"
    )
    counts = rows.mapInArrow(_counted, "bucket int, raw long, good_0 long, good_1 long").groupBy("bucket").agg(F.sum("raw"), F.sum("good_0"), F.sum("good_1"))
    raw, good = np.zeros(BUCKETS), np.zeros((2, BUCKETS))
    for bucket, x, *y in counts.collect():  # BUCKETS rows
        raw[bucket], good[:, bucket] = x, y
    ratios = np.stack([_ratio(target, raw) for target in (good.sum(0), good[1], good[0])])
    sent = docs.sparkSession.sparkContext.broadcast(ratios)
    scored = stored(rows.mapInArrow(_scored(sent), _SCORED)).withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    ).withColumn("score", F.expr(f"IF(features = 0, 0D, total / features / {SCALE})")).withColumn(
        "crossed", F.expr(f"IF(features = 0, 0D, crossed / features / {SCALE})")
    )
    threshold = _threshold(scored.where("trusted AND NOT base_failed"), keep)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"), "score",
    )


def _ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return np.rint(ratio * SCALE).astype(np.int64)


def _threshold(trusted: DataFrame, keep: float) -> float:
    """From the counts of scores in steps: exact, and the same in any order."""
    steps = trusted.groupBy(F.floor(F.col("crossed") * STEP).alias("step")).count().orderBy("step").collect()  # logs of bounded counts: some ten thousand steps
    spare = (1 - keep) * sum(row["count"] for row in steps)
    for row in steps:
        spare -= row["count"]
        if spare < 0:
            return row["step"] / STEP
    return -np.inf if not steps else steps[-1]["step"] / STEP


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, and of the pair that each but the last of a text begins (-1: none)."""
    single = (words.hashes % np.uint64(BUCKETS)).astype(np.int64)
    pair = np.full(len(single), -1)
    pair[: max(0, len(single) - 1)] = (folded(words.hashes, 2) % np.uint64(BUCKETS)).astype(np.int64)
    last = words.first[1:][np.diff(words.first) > 0] - 1
    pair[last] = -1
    return single, pair


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts by bucket: all, and of the halves of the trusted documents."""
    counts = np.zeros((3, BUCKETS), np.int64)
    for batch, texts in chunks(batches):
        words = Words(texts)
        half = np.repeat(_halves(batch), np.diff(words.first))
        for feature in _features(words):
            counts[0] += np.bincount(feature[feature >= 0], minlength=BUCKETS)
            for h in (0, 1):
                counts[1 + h] += np.bincount(feature[(half == h) & (feature >= 0)], minlength=BUCKETS)
    some = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(c[some]) for c in counts]], names=["bucket", "raw", "good_0", "good_1"])


def _halves(batch: pa.RecordBatch) -> np.ndarray:
    """0 or 1 for the trusted documents, -1 for others."""
    return np.array([-1 if x is None else x for x in batch.column("half").to_pylist()], np.int64)


def _scored(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, *without = np.pad(sent.value, ((0, 0), (0, 1)))  # -1: nothing
        for batch, texts in chunks(batches):
            exact, words = Words(texts, lower=False), Words(texts)
            single, pair = _features(words)
            totals = [np.diff(np.concatenate([[0], np.cumsum(r[single] + r[pair])])[words.first]) for r in (ratio, *without)]
            half = _halves(batch)
            n = np.diff(words.first).astype(np.int64)
            columns = [
                batch.column("doc_id"),
                pa.array(n),
                pa.array([len(t.translate(None, _NOT_IN_WORDS)) for t in texts], pa.int64()),
                pa.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], pa.int64()),
                pa.array([_repeated_lines(t) for t in texts], pa.int64()),
                pa.array([_repeated_words(exact.of(d)) for d in range(len(texts))], pa.int64()),
                pa.array(totals[0]),
                pa.array(np.where(n > 0, 2 * n - 1, 0)),
                pa.array(np.choose(half + 1, totals)),
                pa.array(half >= 0),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_SCORED.names)

    return run


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def _repeated_words(words: np.ndarray) -> int:
    """Words in 3-word windows that the text has twice or more."""
    windows = folded(words, 3)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(words), bool)
    at = np.concatenate([order[1:][same], order[:-1][same]])
    for i in range(3):
        twice[at + i] = True
    return int(twice.sum())
