"""Repeated windows against a plain version: nulls, long and short texts, runs of one word, equal rows, clashing columns."""

import hashlib
import random
from collections import Counter

import pytest

from subtide.llm import substring_dedup
from subtide.llm.sketch import from_gaps, gaps
from subtide.llm.substring_dedup import remove_repeats, substring_report
from tests.llm.brute import WORDS


def plain(texts, window=35):
    """(words, removed, kept words) per text."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def texts():
    rng = random.Random(11)
    own = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage = [rng.choice(WORDS) for _ in range(60)]
    shared = " ".join(passage)
    return [
        None, "", " \n\t ", own(34), own(35), own(400),
        f"{own(20)} {shared} {own(20)}", f"{own(3)}\n{shared}\t{own(50)}", f"{shared.upper()} {own(9)}",  # case counts
        " ".join(passage[:35]), " ".join(passage[1:35]),
        "x " * 35, "x " * 36, "é " * 40 + own(10), " ".join(passage[5:45]) + " " + own(40) + " " + " ".join(passage[5:45]),
        own(80), own(2_000),
    ]


@pytest.mark.parametrize("most_alone", [substring_dedup.MOST_ALONE, -1])
def test_report_equals_the_plain_version(spark, most_alone):
    rows = texts()
    rows = [*rows, rows[-1], rows[-1]]
    docs = spark.createDataFrame([(None if i == 15 else i % 17, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(4)
    got = substring_report(docs, most_alone=most_alone).collect()
    expected = [(None if i == 15 else i % 17, n, gone, hashlib.sha256(kept).hexdigest()) for i, (n, gone, kept) in enumerate(plain(rows))]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert any(0 < r.n_removed < r.n_words for r in got)


@pytest.mark.parametrize("most_alone", [substring_dedup.MOST_ALONE, -1])
def test_overestimated_windows_stay(spark, monkeypatch, most_alone):
    """Sketches that say "repeated" of everything change nothing."""
    full = substring_dedup._sketch
    monkeypatch.setattr(substring_dedup, "_sketch", lambda *a: full(*a) | 255)
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = substring_report(docs, most_alone=most_alone).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(i, n, gone) for i, (n, gone, _) in enumerate(plain(rows))]


@pytest.mark.parametrize("most_alone", [substring_dedup.MOST_ALONE, -1])
def test_texts_are_cut_and_columns_stay(spark, most_alone):
    rows = texts()
    data = [(i, t, "k", {"a": i}, f"d{i}") for i, t in enumerate(rows)]
    docs = spark.createDataFrame(data, "high long, text string, row_key string, row map<string,int>, ab string").withColumnRenamed("ab", "a.b")
    got = remove_repeats(docs, most_alone=most_alone)
    assert got.columns == docs.columns and got.schema["text"].dataType == docs.schema["text"].dataType
    expected = [(i, kept.decode() if gone else t, "k", {"a": i}, f"d{i}") for (i, t, *_), (_, gone, kept) in zip(data, plain(rows))]
    assert sorted(map(tuple, got.collect())) == expected
    assert remove_repeats(docs.limit(0), most_alone=most_alone).collect() == []


def test_a_long_text_within_and_across_pieces(spark):
    """20 MB; its only repeat is at both ends."""
    rng = random.Random(5)
    passage = " ".join(rng.choice(WORDS) for _ in range(50))
    middle = " ".join(f"w{i}" for i in range(2_400_000))
    docs = spark.createDataFrame([(1, f"{passage} {middle} {passage}"), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_report(docs).collect()}
    assert got[1] == (2_400_100, 100, hashlib.sha256(middle.encode()).hexdigest())
    assert got[2] == (1, 0, hashlib.sha256(b"short").hexdigest())


def test_gaps_come_back():
    import numpy as np

    rng = np.random.default_rng(1)
    for cells in ([], [0], [254], [255], [256, 257, 1023], [5, 260, 515, 516], sorted(rng.choice(1 << 18, 900, replace=False))):
        assert from_gaps(gaps(np.array(cells, np.int64))).tolist() == list(cells)
