"""Hard negatives against a plain version: ties, copies, a hot label, rows that take no part, blocks of any size."""

import math
import random

import pytest
from pyspark.sql import functions as F

from subtide.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, v string, length int"


def plain(rows, every=10, n=5, least=80):
    held = {}
    for vec_id, label, x, *_ in rows:
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        held[vec_id] = min(held.get(vec_id, (label, x)), (label, x))
    vectors = {i: (label, [math.floor(256 * c) for c in x]) for i, (label, x) in held.items()}
    score = lambda a, b: sum(p * q for p, q in zip(vectors[a][1], vectors[b][1]))
    out = []
    for a in (i for i in vectors if i % every == 0):
        ranked = sorted((-score(a, b), b) for b in vectors if b != a)
        for p, positive in [x for x in ranked if vectors[x[1]][0] == vectors[a][0]][:n]:
            hard = [x for x in ranked if vectors[x[1]][0] != vectors[a][0] and least * -p <= 100 * -x[0] <= 100 * -p][:n]
            out += [(a, positive, k + 1, negative, -p, -s) for k, (s, negative) in enumerate(hard)]
    return sorted(out)


def single(x):
    import numpy as np

    return [float(np.float32(c)) for c in x]


def some(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c, size = rng.choice(centres), math.exp(rng.gauss(0, spread))
        rows.append((i, 0 if rng.random() < 0.4 else rng.randrange(5), single([size * (y + rng.gauss(0, 0.7)) for y in c]), "x", 1))
    return rows


@pytest.mark.parametrize("block_rows", [4096, 40])
@pytest.mark.parametrize("dims, spread", [(8, 1.0), (3, 0.0)])
def test_equals_the_plain_version(spark, block_rows, dims, spread):
    rows = some(300, dims, block_rows + dims, spread)
    rows += [(1000 + 10 * i, 3, rows[7][2], None, None) for i in range(6)]  # copies, ties
    rows += [(2000, 1, [0.0] * dims, "z", 0), (2010, None, rows[0][2], "n", 0), (2020, 1, None, "n", 0), (2030, 2, [float("nan")] * dims, "n", 0)]
    rows += [(None, 2, rows[3][2], "n", 0), (2040, 1, [None] * dims, "n", 0), (20, 4, rows[5][2], "twice", 0), rows[30], (2050, 0, rows[2][2][:2], "short", 0)]
    rows += [(2060, 0, [float("inf")] * dims, "n", 0)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, block_rows=block_rows).collect()
    expected = plain(rows)
    assert sorted(map(tuple, got)) == expected
    assert len(expected) > 100


def test_few_rows_and_none(spark):
    docs = spark.createDataFrame([(0, 1, [1.0, 0.0], "", 0), (1, 1, [0.5, 0.0], "", 0), (2, 2, [0.45, 1.0], "", 0)], SCHEMA)
    anchor = F.col("vec_id") % 10 == 0
    assert [tuple(r) for r in hard_negatives(docs, anchor).collect()] == [(0, 1, 1, 2, 256 * 128, 256 * 115)]
    assert hard_negatives(docs.limit(0), anchor).collect() == []
    assert hard_negatives(docs.where("label = 1"), anchor).collect() == []
    assert hard_negatives(docs.where("vec_id > 0"), anchor).collect() == []


def test_label_of_the_caller(spark):
    rows = some(60, 4, 9)
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 5, label)")
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, label=label).collect()
    assert sorted(map(tuple, got)) == plain([(i, (y + 1) % 5 if i % 7 == 0 else y, *rest) for i, y, *rest in rows])
