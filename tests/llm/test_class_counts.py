"""How the class model counts words: rightly, and holding different words only."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from subtide.llm import class_lm
from subtide.llm.words import Words


def batches(texts: list[str], rows: int) -> list[pa.RecordBatch]:
    whole = pa.array([t.encode() for t in texts], pa.binary())
    return [pa.RecordBatch.from_arrays([whole.slice(i, rows)], names=["text"]) for i in range(0, len(texts), rows)]


def counted(texts: list[str], rows: int) -> tuple[Counter, int]:
    n, seen = Counter(), 0
    for batch in class_lm._counted(batches(texts, rows)):
        for row in batch.to_pylist():
            n[row["word"], row["ending"]] += row["n"]
            seen += row["texts"]
    return n, seen


def test_counts_of_slices_add_up(monkeypatch):
    texts = [" ".join(f"w{i * j % 97}" for j in range(50)) for i in range(40)] + ["", "one"]
    expected = Counter(word for text in texts for word in text.split())
    for held in (0, 100, class_lm.HELD_WORDS):
        monkeypatch.setattr(class_lm, "HELD_WORDS", held)
        n, seen = counted(texts, 5)
        assert seen == n.pop((None, None), 0) + len(texts)
        one = {word: Words([word.encode()]) for word in expected}
        assert n == {(int(w.hashes.view(np.int64)[0]), int(class_lm._endings(w)[0])): expected[word] for word, w in one.items()}


def test_repeated_words_are_not_held():
    texts = [" ".join(f"w{j % 500}" for j in range(20_000))] * 100  # two million words, 500 different
    parts = batches(texts, 5)
    list(class_lm._counted(parts[:1]))
    tracemalloc.start()
    try:
        list(class_lm._counted(parts))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    print(f"peak {peak:.0f} MB")
    assert peak < 30
