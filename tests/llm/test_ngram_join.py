import random

import pytest

from subtide.llm.components import connected_components
from subtide.llm.ngram_join import near_duplicates
from tests.llm.brute import WORDS, components_of, shingles


def documents(seed, n=160):
    """Prose with copies, near copies, a shared passage, short, empty and null texts."""
    rng = random.Random(seed)
    passage = " ".join(rng.choice(WORDS) for _ in range(40))
    texts = [None, "", "  \n", "one", "One", "one two", "a b c d", "A B c d", "a b c d e", "é ü ß ñ ö"]
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.45 and len(texts) > 20:
            words = (rng.choice(texts[10:]) or "x").split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
        else:
            text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 6, 9, 30, 120])))
            texts.append(f"{text} {passage}" if kind > 0.8 else text)
    return list(enumerate(texts, 100))


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, near_duplicates(df, **options).collect()), key=repr)


@pytest.mark.parametrize("seed, frequent", [(1, 16), (2, 2)])
def test_components_equal_brute_force(spark, seed, frequent):
    rows = documents(seed)
    assert found(spark, rows, frequent=frequent) == components_of(rows)


def test_large_groups(spark):
    """Long lists of signatures, of the rare class too."""
    rng = random.Random(5)
    base = [rng.choice(WORDS) for _ in range(60)]
    rows = [(i, " ".join([*base[:20], f"x{i}", *base[20:]])) for i in range(80)]
    rows += [(200 + i, " ".join([*base[:30], *[rng.choice(WORDS) for _ in range(25)]])) for i in range(60)]
    rows += [(300 + i, " ".join(base)) for i in range(50)]
    assert found(spark, rows) == components_of(rows)
    assert found(spark, rows, frequent=10**9) == components_of(rows)


def test_repeated_ids_and_missing_ids(spark):
    a, b = " ".join(WORDS[:30]), " ".join(WORDS[30:60])
    rows = [(5, a), (5, b), (3, b), (7, a), (7, a), (None, a), (9, None), (9, "")]
    assert {x[0]: x[2] for x in found(spark, rows)} == {3: 3, 5: 3, 7: 3, 9: 9, None: None}


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "a b", "x", 2, 3)], "doc_id long, text string, node string, a int, digest int")
    assert [tuple(r) for r in near_duplicates(df).collect()] == [(1, 1, 1)]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert dict(map(tuple, got.collect())) == expected


def test_brute_force_set_of_a_short_text():
    assert shingles("a b") == {(b"a", b"b")}
