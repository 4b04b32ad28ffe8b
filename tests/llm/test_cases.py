"""Empty tables, very long texts and clashing columns, operator by operator."""

import random

import pytest
from pyspark.sql import functions as F

from subtide.llm import class_lm, decontamination, licenses, quality, toxicity, url_reputation, warc
from subtide.llm.queries import fold
from tests.llm.brute import WORDS

CLASHES = ["row", "n", "digest", "label", "half", "score", "host", "path", "rule", "bucket", "marks", "node", "payload", "line", "word", "class", "fold"]


def texts(spark):
    rng = random.Random(2)
    own = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows = [(i, own(60)) for i in range(40)] + [(50, None), (51, ""), (3, own(5)), (3, own(5))]
    rows += [(60, " ".join(f"{rng.choice(WORDS)}{i % 9_000}" for i in range(700_000)) + " " + own(20))]  # some 6 MB
    return spark.createDataFrame(rows, "doc_id long, text string")


def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "contamination": lambda spark, docs: decontamination.contamination(docs, spark.createDataFrame([(1, " ".join(WORDS[:15]))], "item_id long, text string")),
    "class_lm": lambda spark, docs: class_lm.class_lm_scores(docs, fold(7) == 2, rounds=2),
    "licences": lambda spark, docs: licenses.license_scan(docs, licenses.known_licenses(spark)),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs.select("doc_id", "text"), labels(spark), fold(3) != 1).select("row.*", "score"),
    "quality": lambda spark, docs: quality.quality(docs, labels(spark)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_long_texts_and_clashing_columns(spark, name):
    run, docs = OPERATORS[name], texts(spark).repartition(3)
    got = run(spark, docs.withColumns({c: F.lit("clash") for c in CLASHES}))
    assert not set(got.columns) & {"row", "marks", "node"}
    rows = [tuple(r) for r in got.drop("text").collect()]
    assert len(rows) == 45
    assert sorted(rows, key=repr) == sorted((tuple(r) for r in run(spark, docs).drop("text").collect()), key=repr)
    assert run(spark, docs.limit(0)).collect() == []


def test_nothing_to_learn_from(spark):
    docs, none = texts(spark).where("doc_id < 55"), labels(spark).limit(0)
    assert {r.score for r in toxicity.toxicity(docs, none, fold(3) != 1).collect()} == {0.0}
    assert all(r.kept is not r.base_failed for r in quality.quality(docs, none).collect())
    held = class_lm.class_lm_scores(docs, F.lit(True), rounds=1).collect()
    assert {(r.n_known, r.train_tokens) for r in held} == {(0, 0)}


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "some page"), (2, "http://b.net/long", "WARC/1.0 " + "x" * 300_000)], "page_id long, url string, html string")
    clash = pages.withColumns({c: F.lit("clash") for c in CLASHES})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")  # the record is longer than a split
        assert sorted(map(tuple, warc.archived_pages(clash).collect())) == sorted(map(tuple, warc.archived_pages(pages).collect()))
        assert warc.archived_pages(pages).count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert warc.archived_pages(pages.limit(0)).collect() == []
    judged = lambda df: url_reputation.judged(df, ["org/x", "a.org/"], ["a.org/"])
    assert sorted(map(tuple, judged(clash).collect())) == sorted(map(tuple, judged(pages).collect()))
    # Rules of one length: the last by name; in both lists: it blocks.
    tied = {r.page_id: (r.rule, r.verdict) for r in url_reputation.judged(pages, ["rg/x", "org/x", "a.org/x"[2:]], ["a.org/", "b.net/"]).collect()}
    assert tied[2] == ("b.net/", "block") and tied[1] == ("a.org/", "block")
    both = {r.page_id: (r.rule, r.verdict) for r in url_reputation.judged(pages, ["org/x"], ["org/x"]).collect()}
    assert both[1] == ("org/x", "block")
