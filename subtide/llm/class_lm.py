"""Language-model scores by a Brown class-based bigram model.

P(text) is the product over its tokens of P(class | class before) P(word | class). Tokens are the
words of the lower-cased (A-Z) text and one end; the class before the first word is the end's.

* Words. All words are counted over all training texts, by 64-bit hashes.
* Units. What the rounds of exchange clustering move between classes: each of the `MOVED` most frequent
  words is a unit, all other words are in one of `ENDINGS` units by their last three bytes.
* Exchange clustering. Starting from classes by frequency rank, every round counts in which classes
  the neighbours of each unit are, over the whole training corpus, and moves each unit to the class
  in which they are likeliest, given the class bigrams of the round before (distributed exchange as
  in Uszkoreit and Brants, 2008). Units of one half move in one round, of the other in the next.
* The other words. After the rounds every word of the head without a unit of its own that occurs `LEAST`
  times or more leaves its ending's unit for the class in which its own neighbours are likeliest: the same
  exchange, over neighbours counted by word, side and class. Rarer and new words keep the class of words that end alike.
* Smoothing. One is added to class bigrams and to words within their class; a class has one unknown
  word more, like the base score's vocabulary.

Counts are aggregated per task before they are shuffled. The driver and the broadcasts hold what is
bounded by parameters: units, classes, and the `HEAD` most frequent words with a class each. All other
words are looked up by a join. Null and empty texts have only the end token; very long ones are scored whole. Repeated rows
are scored one by one; a null doc_id is not held out. Without training rows all words are unknown, and an empty
table gives an empty one. Columns other than doc_id and text take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import stored
from subtide.llm.words import Words, chunks, mixed, octets

CLASSES = 64
ROUNDS = 6
MOVED = 8192
ENDINGS = 2048
HEAD = 1_000_000
LEAST = 5  # occurrences of a word that leaves its ending's unit
HELD_WORDS = 1 << 18  # different words of slices, with counts, that a task holds at once
HELD_NEIGHBOURS = 1_000_000  # the same, of neighbours
SENT = 1 << 16  # rows of a batch
SPAN = 4096  # words whose neighbours are in a task at once
BLOCKS = 64
END = 0  # its unit and its class
UNITS = 1 + MOVED + ENDINGS

_SCORED = T.StructType().add("row", "long").add("doc_id", "long").add("held_out", "boolean").add("n_tokens", "long").add("n_head", "long").add("base", "double").add("model", "double")
_SCORED = _SCORED.add("words", T.ArrayType(T.LongType(), False))


def class_lm_scores(docs: DataFrame, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """Per row of `docs` (doc_id, text): token counts, the add-one unigram score and the model's.

    Scores are log10 probabilities. The model learns from the rows for which `held_out` is not true.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        octets("text").alias("text"),
    )
    training = rows.where("NOT held_out").select("text")
    counts = training.mapInArrow(_counted, "word long, ending int, n long, texts long").groupBy("word", "ending").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    counts = stored(counts)
    n_words, n_texts, n_kinds = counts.agg(F.sum("n"), F.sum("texts"), F.count_if(F.col("word").isNotNull())).first()
    total, texts = (n_words or 0) + (n_texts or 0), n_texts or 0
    kinds = n_kinds + (texts > 0)
    counts = counts.where("word IS NOT NULL").select("word", "ending", "n")

    head, floor = _most_frequent(counts, HEAD)
    words, head_n, endings = (head[c].to_numpy() for c in ("word", "n", "ending"))
    words = words.view(np.uint64)
    order = np.argsort(words)
    words, head_n, endings = words[order], head_n[order], endings[order]
    # Codes: places in `words`, then the endings, then the end.
    unit_of = np.concatenate([endings + 1 + MOVED, np.arange(ENDINGS) + 1 + MOVED, [END]]).astype(np.int32)
    moved = np.lexsort((words, -head_n))[:MOVED]
    unit_of[moved] = 1 + np.arange(len(moved))
    sent = spark.sparkContext.broadcast(words)
    codes = stored(training.mapInArrow(_coded(sent), "codes binary"))
    classes, transitions = _clustered(codes, unit_of, rounds)
    code_class = classes[unit_of].astype(np.uint8)
    loose = np.flatnonzero((unit_of[: len(words)] > MOVED) & (head_n >= LEAST))
    if rounds and len(loose):
        own = _own_classes(codes, code_class, loose, transitions)
        code_class[own["code"].to_numpy()] = own["class"].to_numpy()
        transitions = _transitions(codes, code_class)

    class_n = np.bincount(code_class[: len(words)], head_n, CLASSES)
    class_kinds = np.bincount(code_class[: len(words)], minlength=CLASSES).astype(float)
    for ending, n, kinds_of in counts.where(F.col("n") < floor).groupBy("ending").agg(F.sum("n"), F.count(F.lit(1))).collect():  # ENDINGS rows
        class_n[code_class[len(words) + ending]] += n
        class_kinds[code_class[len(words) + ending]] += kinds_of
    class_n[classes[END]] += texts
    class_kinds[classes[END]] += texts > 0
    model = {
        "words": words,
        "n": head_n,
        "classes": code_class,
        "step": np.log10((transitions + 1) / (transitions.sum(1, keepdims=True) + CLASSES)),
        "within": np.log10(class_n + class_kinds + 1),
        "texts": texts,
        "all": np.log10(total + kinds + 1),
    }
    told = rows.mapInArrow(_scored(spark.sparkContext.broadcast(model)), _SCORED)
    return _with_tail(told, counts, total)


def _with_tail(told: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """Adds what the words beyond the head give: log10(count + 1) each, in both scores."""
    told = stored(told)
    tail = told.select("row", F.explode("words").alias("word"))
    found = tail.join(counts, "word").groupBy("row").agg(F.count(F.lit(1)).alias("n_tail"), F.sum(F.log10(F.col("n") + 1)).alias("more"))
    return told.drop("words").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def _endings(words: Words) -> np.ndarray:
    """The unit (0 to ENDINGS - 1) of the last three bytes of each word."""
    raw = np.frombuffer(words.joined, np.uint8).astype(np.uint64)
    code = np.zeros(len(words.begins), np.uint64)
    for back in (1, 2, 3):
        at = words.ends - back
        code = code * np.uint64(257) + np.where(at >= words.begins, raw[np.maximum(at, 0)] + np.uint64(1), np.uint64(0))
    return (mixed(code) % np.uint64(ENDINGS)).astype(np.int32)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words; texts in a row without a word.

    Each slice of the texts is counted by itself, so that only different words and their counts are held.
    """
    held, size, texts_seen = [], 0, 0

    def flushed() -> pa.RecordBatch:
        words, endings, n = (np.concatenate(part) for part in zip(*held))
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        zero = np.zeros(len(first), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(words[first].view(np.int64)), pa.array(endings[order[first]]), pa.array(np.add.reduceat(n[order], first)), pa.array(zero)],
            names=["word", "ending", "n", "texts"],
        )

    for _, texts in chunks(batches):
        words = Words(texts)
        distinct, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
        held.append((distinct, _endings(words)[first], n.astype(np.int64)))
        size += len(distinct)
        texts_seen += len(texts)
        if size > HELD_WORDS:
            yield flushed()
            held, size = [], 0
    if size:
        yield flushed()
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([0]), pa.array([texts_seen])], names=["word", "ending", "n", "texts"])


def _most_frequent(counts: DataFrame, most: int) -> tuple[pa.Table, int]:
    """Words with counts from a power of two on, the lowest that leaves `most` of them or fewer, and that power."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect()  # 64 rows at most
    floor, kept = 1 << 62, 0
    for row in sizes:
        kept += row["count"]
        if kept > most:
            break
        floor = 1 << row["power"]
    return counts.where(F.col("n") >= floor).select("word", "n", "ending").toArrow().combine_chunks(), floor


def _codes_of(words: Words, head: np.ndarray) -> np.ndarray:
    """The place of each word in the sorted `head`, for others that of their ending after it."""
    code = _endings(words).astype(np.int64) + len(head)
    if len(head) and len(words.hashes):
        at = np.searchsorted(head, words.hashes)
        at[at == len(head)] = 0
        own = head[at] == words.hashes
        code[own] = at[own]
    return code


def _with_ends(codes: np.ndarray, words: Words, end: int) -> np.ndarray:
    """One end before all texts and one after each."""
    n = len(words.first) - 1
    out = np.full(len(codes) + n + 1, end, codes.dtype)
    text = np.repeat(np.arange(n), np.diff(words.first))
    out[np.arange(len(codes)) + text + 1] = codes
    return out


def _coded(head):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            words = Words(texts)
            codes = _with_ends(_codes_of(words, head.value), words, len(head.value) + ENDINGS).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary())], names=["codes"])

    return run


def _clustered(codes: DataFrame, unit_of: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit, and the counts of class bigrams."""
    classes = np.concatenate([[END], 1 + np.arange(UNITS - 1) % (CLASSES - 1)]).astype(np.int64)
    sent = codes.sparkSession.sparkContext.broadcast(unit_of)
    transitions = _transitions(codes, classes[unit_of].astype(np.uint8))
    for r in range(rounds):
        chosen = _neighbours(codes, sent, classes).groupBy("block").applyInArrow(_moves(classes, transitions, r), "unit int, class int")
        for unit, new in chosen.collect():  # UNITS rows
            classes[unit] = new
        transitions = _transitions(codes, classes[unit_of].astype(np.uint8))
    sent.unpersist()
    return classes, transitions


def _transitions(codes: DataFrame, code_class: np.ndarray) -> np.ndarray:
    sent = codes.sparkSession.sparkContext.broadcast(code_class)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                own = sent.value[np.frombuffer(blob.as_buffer(), np.uint32)].astype(np.int64)
                counts += np.bincount(own[:-1] * CLASSES + own[1:], minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], names=["cell", "n"])

    out = np.zeros(CLASSES * CLASSES)
    for cell, n in codes.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # CLASSES ** 2 rows
        out[cell] = n
    sent.unpersist()
    return out.reshape(CLASSES, CLASSES)


def _neighbours(codes: DataFrame, unit_of, classes: np.ndarray) -> DataFrame:
    """Per task and block of units how often each class stands before and after each unit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after = np.zeros(UNITS * CLASSES, np.int64), np.zeros(UNITS * CLASSES, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                unit = unit_of.value[np.frombuffer(blob.as_buffer(), np.uint32)].astype(np.int64)
                own = classes[unit]
                before += np.bincount(unit[1:] * CLASSES + own[:-1], minlength=len(before))
                after += np.bincount(unit[:-1] * CLASSES + own[1:], minlength=len(after))
        both = np.stack([before.reshape(UNITS, CLASSES), after.reshape(UNITS, CLASSES)], axis=1)
        parts = [np.ascontiguousarray(both[k::BLOCKS]).tobytes() for k in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names=["block", "counts"])

    return codes.mapInArrow(run, "block int, counts binary")


def _likeliest(transitions: np.ndarray):
    """From how often each class stands before and after (n x CLASSES each) to the log-likelihood of these neighbours next to each
    class, less the class's own share of the tokens. Nothing but the end is in its class."""
    joint = np.log((transitions + 0.5) / (transitions.sum() + 0.5 * transitions.size))
    left, right = np.log(transitions.sum(1) + 1), np.log(transitions.sum(0) + 1)

    def gains(before: np.ndarray, after: np.ndarray) -> np.ndarray:
        n = before.sum(1, keepdims=True)
        gain = before @ joint + after @ joint.T - n * left - n * right
        gain[:, END] = -np.inf
        return gain

    return gains


def _own_classes(codes: DataFrame, code_class: np.ndarray, loose: np.ndarray, transitions: np.ndarray) -> pa.Table:
    """(code, class) of the words `loose`, each by its own neighbours' classes; HEAD rows at most."""
    is_loose = np.zeros(len(code_class), bool)
    is_loose[loose] = True
    sent = codes.sparkSession.sparkContext.broadcast((is_loose, code_class))
    sides = 2 * CLASSES

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, own_class = sent.value
        held, size = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(keys), SENT):
                part = keys[i : i + SENT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part // sides).astype(np.int32)), pa.array((part % sides).astype(np.int32)), pa.array(n[i : i + SENT].astype(np.int64))],
                    names=["code", "cell", "n"],
                )

        for batch in batches:
            for blob in batch.column(0):
                code = np.frombuffer(blob.as_buffer(), np.uint32).astype(np.int64)
                at = np.flatnonzero(wanted[code])  # ends stand first and last, so both neighbours exist
                own = own_class[code].astype(np.int64)
                held += [code[at] * sides + own[at - 1], code[at] * sides + CLASSES + own[at + 1]]
                size += 2 * len(at)
                if size > HELD_NEIGHBOURS:
                    yield from flushed()
                    held, size = [], 0
        if size:
            yield from flushed()

    gains = _likeliest(transitions)

    def chosen(part: pa.Table) -> pa.Table:
        code = part.column("code").to_numpy()
        first = code[0] // SPAN * SPAN
        sums = np.zeros((SPAN, sides))
        sums[code - first, part.column("cell").to_numpy()] = part.column("n").to_numpy()
        own = np.unique(code)
        best = gains(sums[:, :CLASSES], sums[:, CLASSES:]).argmax(1)[own - first]
        return pa.table({"code": pa.array(own, pa.int32()), "class": pa.array(best, pa.int32())})

    sums = codes.mapInArrow(counted, "code int, cell int, n long").groupBy("code", "cell").agg(F.sum("n").alias("n"))
    # A group has SPAN * sides rows at most, whatever the corpus.
    out = sums.groupBy(F.expr(f"code div {SPAN}").alias("block")).applyInArrow(chosen, "code int, class int").toArrow()
    sent.unpersist()
    return out


def _moves(classes: np.ndarray, transitions: np.ndarray, r: int):
    """The best class of each unit of a block. Units of the other half stay, and so does the end."""
    gains = _likeliest(transitions)

    def run(block: pa.Table) -> pa.Table:
        k = block.column("block")[0].as_py()
        own = np.arange(UNITS)[k::BLOCKS]
        sums = np.zeros((len(own), 2, CLASSES))
        for blob in block.column("counts"):
            sums += np.frombuffer(blob.as_buffer(), np.int64).reshape(sums.shape)
        best = gains(sums[:, 0], sums[:, 1]).argmax(1)
        stay = (own == END) | (sums[:, 0].sum(1) == 0) | (own // BLOCKS % 2 != r % 2)
        best[stay] = classes[own[stay]]
        return pa.table({"unit": pa.array(own, pa.int32()), "class": pa.array(best, pa.int32())})

    return run


def _scored(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        end_n = np.log10(m["texts"] + 1)
        for batch, texts in chunks(batches):
            words = Words(texts)
            code, head = _codes_of(words, m["words"]), len(m["words"])
            known, count = code < head, np.zeros(len(code))
            count[known] = np.log10(m["n"][code[known]] + 1)
            own = m["classes"][_with_ends(code, words, head + ENDINGS)]
            step = m["step"][own[:-1], own[1:]] - m["within"][own[1:]]
            ends = np.cumsum(np.diff(words.first) + 1)
            sums = np.concatenate([[0.0], np.cumsum(step)])[np.concatenate([[0], ends])]
            counted = np.concatenate([[0.0], np.cumsum(count)])[words.first]
            n = np.diff(words.first)
            tail_at = np.concatenate([[0], np.cumsum(~known)])[words.first]
            tail = pa.ListArray.from_arrays(pa.array(tail_at, pa.int32()), pa.array(words.hashes[~known].view(np.int64)))
            own_count = np.diff(counted) + end_n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array((n + 1).astype(np.int64)),
                    pa.array(n - np.diff(tail_at) + (m["texts"] > 0), pa.int64()),
                    pa.array(own_count - (n + 1) * m["all"]),
                    pa.array(own_count + np.diff(sums)),
                    tail,
                ],
                names=_SCORED.names,
            )

    return run
