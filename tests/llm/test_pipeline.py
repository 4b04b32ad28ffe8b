"""Each stage of the corpus pipeline, and the whole of it, against plain versions."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from subtide.llm import toxicity
from subtide.llm.queries import fold
from tests.llm import brute
from tests.llm.brute import WORDS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [" ".join(WORDS[:20]), " ".join(reversed(WORDS[20:50])), "Odd short item"]
NOTICE = "Please do subscribe to our weekly letter"


def planted():
    rng = random.Random(8)
    own = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows = []
    for i in range(260):
        text = f"{own(30)}\n{own(30)}"
        if i % 5 == 0:
            text = f"{own(20)} you {rng.choice(['vilewort', 'V1lewort', 'snakespit'])} {own(20)}\n{own(20)}"
        elif i % 7 == 1:
            text += f"\n{NOTICE}"
        elif i % 11 == 2:
            text += f"\n{ITEMS[i % 2]}"
        elif i % 13 == 3:
            text = f"{own(800)} {ITEMS[0]} {own(30)}"  # covers less than a twentieth
        elif i % 17 == 4 and len(rows) > 20:
            text = f"{rows[i - 3][1]} {own(1)}"
        elif i % 19 == 6:
            text = rows[i - 2][1]
        elif i % 23 == 7:
            text += f"\n- {own(9)}\n- {own(9)} | {own(3)}"
        rows.append((i, text, rng.choice(["en", "de"]), f"s{i % 12}", len(text)))
    nothing = [(300, None, None, None, None), (301, "", "en", "s1", 0), (302, " \n\n ", "en", None, 4), (None, own(40), "de", "s2", 1)]
    return [*rows, *nothing, rows[3], (303, "one word more", "fr", "s3", 13), (304, NOTICE, "en", "s4", 40), (305, own(20_000), "en", "s5", 9)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = planted()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int(r[0] % 5 == 0)) for r in rows[:260]] + [(None, 1, 1), (4, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [*enumerate(ITEMS), (9, None), (None, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def model(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.learn(spark.read.parquet(f"{folder}/documents.parquet"), labels.where(fold(3) != 1))


def stage(spark, folder, name, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    assert out.columns[: len(docs.columns)] == docs.columns
    return sorted(map(tuple, out.collect()), key=repr)


def not_toxic(model, rows):
    a, b = model.curve
    return [r for r in rows if 1 / (1 + math.exp(-(a + b * math.log1p(10 * brute.strength(model, r[1]))))) < 0.7]


def assert_same(got, want):
    assert got == sorted(want, key=repr)


def test_toxic_documents_go(spark, folder, model):
    got = stage(spark, folder, "toxicity", planted())
    assert_same(got, not_toxic(model, planted()))
    held_out = [i for i in range(260) if zlib.crc32(str(i).encode()) % 3 == 1]
    kept = {r[0] for r in got}
    assert not any(i in kept for i in held_out if i % 5 == 0)
    assert sum(i in kept for i in held_out if i % 5) >= 0.97 * sum(i % 5 > 0 for i in held_out)


def test_boilerplate_is_cut(spark, folder):
    got = stage(spark, folder, "line_dedup", planted())
    assert_same(got, brute.without_boilerplate(planted()))
    assert [r[0] for r in got if NOTICE in (r[1] or "").split("\n")] == [304]  # it has nothing else


def test_one_document_of_each_group_stays(spark, folder):
    assert_same(stage(spark, folder, "ngram_jaccard_join", planted()), brute.one_of_each(planted()))


def test_contaminated_documents_go(spark, folder):
    got = stage(spark, folder, "decontamination", planted())
    assert_same(got, brute.clean_of(planted(), ITEMS))
    assert 2 not in {r[0] for r in got} and 3 in {r[0] for r in got}


def test_drawn_documents(spark, folder):
    assert_same(stage(spark, folder, "mixing", planted()), brute.mixed(planted()))


def test_whole_pipeline(spark, folder, model):
    rows = brute.one_of_each(brute.without_boilerplate(not_toxic(model, planted())))
    want = brute.mixed(brute.clean_of(rows, ITEMS))
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_probability"]
    assert_same(sorted(map(tuple, got.collect()), key=repr), want)


def test_empty_documents(spark, folder):
    for name, _ in corpus_pipeline.STAGES:
        assert stage(spark, folder, name, []) == []


def test_clashing_columns_stay(spark, folder):
    docs = spark.createDataFrame(planted()[:40], SCHEMA).withColumns({c: F.lit(1) for c in ("row", "cut", "marks", "node", "topic", "tokens", "score", "probability")})
    for name, run in corpus_pipeline.STAGES:
        out = run(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert out.select(docs.columns).subtract(docs).count() == 0 or name == "line_dedup"


def test_odd_names_and_maps_stay(spark, folder):
    docs = spark.createDataFrame([*planted()[:25], planted()[3]], SCHEMA).withColumn("mix_probability", F.lit("own"))
    docs = docs.withColumn("a.b", F.lit(1)).withColumn("tags", F.create_map(F.lit("k"), F.col("lang")))
    for name, run in corpus_pipeline.STAGES:
        out = run(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns and len(set(out.columns)) == len(out.columns), name
        assert all(r["a.b"] == 1 and r["mix_probability"] == "own" and r["tags"] == {"k": r["lang"]} for r in out.collect()), name
