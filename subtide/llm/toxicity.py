"""Toxicity by a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: small letters, look-alikes of other scripts and digits or signs that stand
for letters become plain letters, white space one blank. Entries are whole words or stems (a stem
matches words that begin with it); a word counts once, by its heaviest match. A match within an
exception phrase does not count, and a match that comes n times counts 1 + log n times. The sum of
weights, divided by the root of the length in words,
goes through a logistic curve to a score from 0 to 1.

Lexicon, weights, exceptions and curve are learned from the labelled rows given as training rows.
Weights are log ratios of the shares of toxic and other documents that have an entry, less their
error; entries are picked in rounds, each among the toxic documents that those before don't match, until a
round adds none. An entry needs `LEAST_DOCS` toxic documents and evidence that all entries tested would
hardly show by chance, whatever share of the toxic documents it is in. Copies of a text
count once. Exceptions are
two-word phrases around a match that other documents have more often than toxic ones. All training
rows are used. The driver holds only what parameters bound: entries, phrases, steps of the curve.

Null and empty texts have no match and get the curve's value at 0; very long ones are matched whole. Repeated rows are
scored one by one; a doc_id with several label rows is toxic if one says so, and a text with both labels counts
once as toxic and once as not. Without training rows of both kinds every score is 0. An empty table gives an empty
one. All columns of a row, whatever their names, are kept in `row`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import all_columns, broadcast_if_small, stored
from subtide.llm.words import chunks, row_chunks

ENTRIES = 5_000  # that a round adds, and phrases
CANDIDATES = 50_000  # of a round, those with the most evidence
STEMS = (3, 4, 5, 6, 7, 8)  # letters
CHANCE = 0.05  # expected entries of a round that owe their evidence to chance alone
NEXT_TO_BEST = 0.1  # of the evidence of a round's best entry; those with less wait for the next round
LEAST_DOCS = 5
LEAST_WEIGHT = 1.5  # less the error
MORE_DOCS = 1.2  # a stem is in so many times the documents of a longer entry that begins with it
SLACK = 50  # words added to a text's length
HELD = 200_000  # counts a task holds before it passes them on

# Letters of other scripts and signs that look like Latin letters, and those letters.
_LOOKALIKES = "аеорсухіјѕԁһкмтвαβεικνορτυχ" + "0134578@$!"
_PLAIN_ONES = "aeopcyxijsdhkmtbabeiknoptyx" + "oieastbasi"
_FOLD = str.maketrans(_LOOKALIKES, _PLAIN_ONES)
_ASCII_SIGNS = re.compile("[0134578@$!]")
_WORD = re.compile("[\\w@$!]+")
_LATIN = re.compile("[a-z]")
_EDGES = ".,;:!?\"'()[]{}<>|*#%&$-_/\\…«»¿¡"

Lexicon = dict[str, tuple[float, bool]]  # weight, and whether it is a stem


def folded(text: str) -> str:
    """`text` as it is matched, between blanks."""
    return " " + " ".join(_fold_signs(text.lower()).split()) + " "


def _fold_signs(text: str) -> str:
    """Folds look-alikes in words that have a Latin letter besides, but for signs at a word's end;
    numbers and words wholly of another script stay."""
    if text.isascii() and not _ASCII_SIGNS.search(text):
        return text
    if not any(c in text for c in _LOOKALIKES):
        return text
    return _WORD.sub(_folded_word, text)


def _folded_word(found: re.Match) -> str:
    word = found[0]
    if not _LATIN.search(word):
        return word
    bare = word.rstrip("!$@")
    return bare.translate(_FOLD) + word[len(bare) :]


class Matcher:
    """Lexicon and exception phrases in one automaton."""

    def __init__(self, lexicon: Lexicon, exceptions: Iterable[str]) -> None:
        found = ahocorasick.Automaton()
        for entry, (weight, stem) in lexicon.items():
            found.add_word(entry, (len(entry), weight, stem))
        for phrase in exceptions:
            found.add_word(phrase, (len(phrase), None, False))
        self.empty = not len(found)
        if not self.empty:
            found.make_automaton()
        self.found = found

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """Begin, end and weight of each word that counts in a folded text."""
        if self.empty:
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for last, (length, weight, stem) in self.found.iter(text):
            begin, end = last + 1 - length, last + 1
            if text[begin - 1].isalnum() or not stem and text[end].isalnum():
                continue
            if weight is None:
                spared.append((begin, end))
            elif begin not in best or best[begin][1] < weight:
                best[begin] = (end, weight)
        return [(a, b, w) for a, (b, w) in sorted(best.items()) if not any(x <= a and b <= y for x, y in spared)]

    def strength(self, text: str) -> float:
        """Weight of the matches, normalised by length."""
        text = folded(text)
        times: Counter[tuple[str, float]] = Counter((text[a:b], w) for a, b, w in self.matches(text))
        total = sum(w * (1 + math.log(n)) for (_, w), n in times.items())
        return total / math.sqrt(text.count(" ") - 1 + SLACK)


class Model:
    """A matcher and the curve (intercept, slope, on log(1 + 10 strength))."""

    def __init__(self, lexicon: Lexicon, exceptions: list[str], curve: tuple[float, float] | None) -> None:
        self.lexicon, self.exceptions, self.curve = lexicon, exceptions, curve

    def scorer(self) -> Callable[[str], float]:
        matcher, curve = Matcher(self.lexicon, self.exceptions), self.curve
        if curve is None:
            return lambda text: 0.0
        a, b = curve
        return lambda text: 1 / (1 + math.exp(-(a + b * math.log1p(10 * matcher.strength(text)))))


def toxicity(docs: DataFrame, labels: DataFrame, training: Column, reject_at: float = 0.7) -> DataFrame:
    """All columns of `docs` as `row`, with `score` and `predicted`; learns where `training` holds.

    `training` is a condition on the column doc_id of `labels` (doc_id, toxic).
    """
    model = learn(docs, labels.where(training))
    return scored(docs, model, reject_at)


def scored(docs: DataFrame, model: Model, reject_at: float = 0.7) -> DataFrame:
    rows = docs.select(F.struct(*all_columns(docs)).alias("row"))
    sent = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.exceptions, model.curve))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Model(*sent.value).scorer()
        for part, texts in _texts(row_chunks(batches)):
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(map(score, texts), pa.float64())], names=["row", "score"])

    schema = T.StructType([rows.schema["row"]]).add("score", "double")
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= reject_at).cast("int"))


def learn(docs: DataFrame, labels: DataFrame, exceptions: Iterable[str] = ()) -> Model:
    """A model from the rows of `docs` that `labels` (doc_id, toxic) has. `exceptions` are further phrases."""
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") == 1).alias("toxic"))
    told = stored(told)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text()).join(broadcast_if_small(told), "doc_id")
    first = texts.groupBy(F.md5(F.col("text").cast("binary")), "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    texts = texts.join(broadcast_if_small(stored(first)), "doc_id", "left_semi")
    n = dict(map(tuple, texts.groupBy("toxic").count().collect()))
    toxic, other = n.get(True, 0), n.get(False, 0)
    if not toxic or not other:
        return Model({}, [], None)
    send = docs.sparkSession.sparkContext.broadcast

    def over(result, sent):
        """`result`, when no later job needs what was sent for it."""
        sent.destroy()
        return result

    told = texts.mapInArrow(_entry_counts, _COUNTS).groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    told = stored(told.where(F.col("bad") + F.col("good") >= LEAST_DOCS))
    bar = math.log(max(1, told.count()) / CHANCE)
    told = told.where(F.col("bad") >= LEAST_DOCS).select("entry", "good")
    lexicon: Lexicon = {}
    left = texts.where("toxic")
    while True:
        sent = send(lexicon)
        left = over(stored(left.mapInArrow(_unmatched(sent), "text string, toxic boolean")), sent)
        more = _picked(left, told, other, bar)
        if not more.keys() - lexicon.keys():
            break
        lexicon = more | lexicon

    sent = send(lexicon)
    phrases = texts.mapInArrow(_phrases(sent), "phrase string, toxic boolean, n long").groupBy("phrase").agg(
        F.sum(F.expr("IF(toxic, n, 0)")).alias("bad"), F.sum(F.expr("IF(toxic, 0, n)")).alias("good")
    )
    spared = phrases.where((F.col("good") >= 3) & (F.col("good") * toxic > F.col("bad") * other)).orderBy(F.desc("good"), "phrase").limit(ENTRIES)
    spare = [*exceptions, *[r["phrase"] for r in over(spared.collect(), sent)]]

    sent = send((lexicon, spare))
    steps = texts.mapInArrow(_strengths(sent), "step int, toxic boolean").groupBy("step", "toxic").count().collect()  # a few hundred steps
    return Model(lexicon, spare, _curve(over(steps, sent)))


def _picked(left: DataFrame, told: DataFrame, other: int, bar: float) -> Lexicon:
    """Entries that set apart the toxic texts which the lexicon so far has no match in.

    Looking at those alone keeps out words that came along with entries already found, as in copies.
    `told`: clean documents by entry. Evidence is the exponent of the Chernoff bound on an entry's toxic documents,
    had they their share by chance; `bar` is what it must reach.
    """
    n = left.count()
    if not n:
        return {}
    counts = left.mapInArrow(_entry_counts, _COUNTS).groupBy("entry").agg(F.sum("bad").alias("x")).where(F.col("x") >= LEAST_DOCS)
    weight = F.expr(f"ln((x + 0.5D) / {n + 1}) - ln((y + 0.5D) / {other + 1}) - sqrt(1 / (x + 0.5D) + 1 / (y + 0.5D))")
    evidence = F.expr(f"x * ln(x / (x + y) * {(n + other) / n!r}D) + IF(y > 0, y * ln(y / (x + y) * {(n + other) / other!r}D), 0D)")
    found = counts.join(told.withColumnRenamed("good", "y"), "entry").select("entry", "x", weight.alias("weight"), evidence.alias("evidence"))
    common = found.where((F.col("weight") >= LEAST_WEIGHT) & (F.col("evidence") >= bar)).orderBy(F.desc("evidence"), "entry").limit(CANDIDATES).collect()
    picked: dict[str, tuple[float, bool, float]] = {}
    within: Counter[str] = Counter()  # documents of picked entries, by each of their beginnings
    for e, x, w, g in sorted(common, key=lambda r: (-len(r.entry.rstrip("*")), r.entry.endswith("*"), r.entry)):
        stem, entry = e.endswith("*"), e.rstrip("*")
        if g < NEXT_TO_BEST * common[0].evidence or stem and x < MORE_DOCS * within[entry]:
            continue
        picked[entry] = (w, stem, g)
        for k in range(1, len(entry) + 1):
            within[entry[:k]] = max(within[entry[:k]], x)
    best = sorted(picked, key=lambda e: (-picked[e][2], e))[:ENTRIES]
    return {e: picked[e][:2] for e in best}


def _unmatched(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, ())
        for _, texts in _texts(chunks(batches)):
            texts = [t for t in texts if not matcher.strength(t)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([True] * len(texts), pa.bool_())], names=["text", "toxic"])

    return run


_COUNTS = "entry string, bad long, good long"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


def _texts(parts: Iterable[tuple[pa.RecordBatch, list[bytes]]]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for part, texts in parts:
        yield part, [t.decode(errors="replace") for t in texts]


def _entries(text: str) -> set[str]:
    """The whole words of a text and the stems of its words (with a star)."""
    words = {w.strip(_EDGES) for w in folded(text).split()}
    return {w for w in words if len(w) > 2} | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


def _entry_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of a task have each entry."""
    bad: Counter[str] = Counter()
    good: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        entries = list(bad.keys() | good.keys())
        columns = [pa.array([n[e] for e in entries], pa.int64()) for n in (bad, good)]
        return pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), *columns], names=["entry", "bad", "good"])

    for part, texts in _texts(chunks(batches)):
        for text, toxic in zip(texts, part.column("toxic").to_pylist()):
            (bad if toxic else good).update(_entries(text))
            if len(bad) + len(good) > HELD:
                yield flushed()
                bad.clear()
                good.clear()
    yield flushed()


def _phrases(sent):
    """Matches with the word before and with the word after, by label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, ())
        for part, texts in _texts(chunks(batches)):
            counts: Counter[tuple[str, bool]] = Counter()
            for text, toxic in zip(texts, part.column("toxic").to_pylist()):
                text = folded(text)
                found = set()
                for begin, end, _ in matcher.matches(text):
                    after = text.find(" ", end)
                    word = text[begin:after]
                    before = text.rfind(" ", 0, begin - 1)
                    if before >= 0:
                        found.add(text[before + 1 : after].strip(_EDGES + " "))
                    following = text.find(" ", after + 1)
                    if following > 0:
                        found.add(f"{word}{text[after:following]}".strip(_EDGES + " "))
                counts.update((p, toxic) for p in found if " " in p)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in counts], pa.string()), pa.array([t for _, t in counts], pa.bool_()), pa.array(counts.values(), pa.int64())],
                names=["phrase", "toxic", "n"],
            )

    return run


def _strengths(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*sent.value)
        for part, texts in _texts(chunks(batches)):
            steps = [round(100 * math.log1p(10 * matcher.strength(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int32()), part.column("toxic")], names=["step", "toxic"])

    return run


def _curve(steps: list) -> tuple[float, float]:
    """Logistic regression on the steps' counts, both labels with the same weight, by Newton's method."""
    x = np.array([s[0] / 100 for s in steps])
    y = np.array([float(s[1]) for s in steps])
    n = np.array([float(s[2]) for s in steps])
    n = np.where(y > 0, n / max(1, n[y > 0].sum()), n / max(1, n[y == 0].sum()))
    design = np.stack([np.ones_like(x), x], axis=1)
    w, penalty = np.zeros(2), np.diag([1e-4, 1e-4])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        slope = design.T @ (n * (y - p)) - penalty @ w
        curve = (design * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + penalty
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return float(w[0]), float(w[1])
