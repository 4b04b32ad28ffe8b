"""Token links against a plain version over whole texts, and the sparse products against dense ones."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from subtide.llm import token_links as links
from subtide.llm.queries import TOKENIZERS
from subtide.llm.token_links import Csr, Pair, groups, overlaps, token_links

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"

TEXTS = [
    None, "", " ", "   ", "a", " a", "a ", "Hello  world ", "don't stop\n\n  now \t x", "Zażółć gęślą jaźń, привет мир  и всё", "日本語の テキスト です。",
    "a  b　 c  d\u0085 e", "<|endoftext|> <s> </s> <unk> <0x0A> ▁", "x" * 500, "=" * 100 + " " + "-" * 77, "1234567 89 0.5e-3",
    "🙂🙂 👩‍👩‍👧 é ﬁ ①", "tab\tcr\r\nff\x0c nul\x00 esc\x1b \x1c x", "​ ﻿ ᠎ z", "line\n line\n  line",
]


def reference():
    """A by the library that its file is made for."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return lambda text: a.encode(text, add_special_tokens=False).ids


def plain(texts):
    pair, encode = Pair(A, B), reference()
    docs = []
    for text in texts:
        whole = b" " + (text or "").encode()
        a = encode(whole.decode()) if text else []
        b = pair.b.encode(text) if text else []
        a_bytes, b_bytes = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append([])
            continue
        ends = lambda parts: [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        cuts = sorted(set(a_ends) & set(b_ends))
        docs.append([([i for i, e in zip(a, a_ends) if x < e <= y], [i for i, e in zip(b, b_ends) if x < e <= y]) for x, y in zip([0, *cuts], cuts)])
    pairs = [Counter((x, y) for a, b in doc for x in a for y in b) for doc in docs]
    count = Counter(p for doc in pairs for p in doc)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    text = lambda doc: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in doc)
    return [
        (
            sum(len(a) for a, _ in doc), sum(len(b) for _, b in doc), len(doc), sum(mine.values()),
            sum(n for p, n in mine.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in mine.items()),
            hashlib.sha256(text(doc).encode()).hexdigest() if doc else "",
        )
        for doc, mine in zip(docs, pairs)
    ]


def noise(n):
    rng = random.Random(13)
    signs = "aeiou bcdfg  ABC\n\t.,'-=0123456789éßж中🙂  　́"
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 200))) for _ in range(n)]


@pytest.mark.parametrize("most_sent", [links.MOST_SENT, -1])
def test_equals_the_plain_version(spark, sf_dir, most_sent):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(25).collect()
    texts = [*TEXTS, *noise(60), *[r.text for r in given], "twice the same", "twice the same"]
    rows = [(None if i == 9 else i // 2, t, "clash", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, row_key int").repartition(3)
    got = token_links(docs, A, B, most_sent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((row[0], *p) for row, p in zip(rows, plain(texts))), key=repr)
    assert token_links(docs.limit(0), A, B, most_sent).collect() == []


def test_what_is_not_given_back_has_no_tokens(monkeypatch):
    """A stretch that tokens don't give back empties its whole text, and no other."""
    give_back = Pair.give_back
    monkeypatch.setattr(Pair, "give_back", lambda self, s, *ids: give_back(self, s, *ids) & np.array([b"bad" not in x for x in s]))
    monkeypatch.setattr(links, "_MEMORIES", {})
    run = links._linked(A, B)
    batch = pa.RecordBatch.from_pydict({"row_key": [1, 2, 3], "doc_id": [1, 2, 3], "text": [b"some bad word", None, b"some good word"]})
    rows = [r for out in run([batch]) for r in out.to_pylist()]
    assert [(r["n_a"], r["n_groups"], r["groups_sha256"], len(r["pairs"])) for r in rows[:2]] == [(0, 0, "", 0)] * 2
    assert rows[2]["n_a"] == 3 and len(rows[2]["pairs"]) == 4 * rows[2]["n_links"]


def test_every_character_alike_by_both_encoders():
    pair, encode = Pair(A, B), reference()
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{c}b 1{c}2 {c}{c} {c}" for c in signs[i : i + 400]) for i in range(0, len(signs), 400)]
    assert all(pair.a.encode_ordinary(t) == encode(t) for t in texts)


def test_remembered_stretches_come_back(monkeypatch):
    monkeypatch.setattr(links, "REMEMBERED", 5)
    pair = Pair(A, B)
    memory = links.Memory(pair)
    rng = random.Random(4)
    for _ in range(30):
        some = [b" " + bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 3))) for _ in range(8)]
        assert memory.of(some) == [links._analysed(pair, [x])[0] for x in some]


def test_products_and_groups():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, y = (rng.random((7, 5)) < 0.4).astype(int), (rng.random((5, 6)) < 0.4).astype(int)
        sparse = [Csr.of(*np.nonzero(m), *m.shape) for m in (x, y)]
        out = np.zeros((7, 6), int)
        for r, c, v in sparse[0].products(sparse[1]):
            out[r, c] = v
        assert (out == x @ y).all()
        back = sparse[0].transposed()
        assert [back.indices[back.indptr[i] : back.indptr[i + 1]].tolist() for i in range(5)] == [np.flatnonzero(x[:, i]).tolist() for i in range(5)]
    assert [o.tolist() for o in overlaps(np.array([2, 5, 6]), np.array([1, 5, 6]))] == [[0, 0, 1, 2], [0, 1, 1, 2], [1, 1, 3, 1]]
    assert [g.tolist() for g in groups(np.array([2, 5, 6]), np.array([1, 5, 6]))] == [[0, 0, 1], [0, 0, 1]]


def test_a_long_text(spark):
    """20 MB of one text, as many groups as the pieces of it have."""
    line = "the quick brown fox jumps over the lazy dog, again and again. "
    docs = spark.createDataFrame([(1, line.strip()), (2, (line * 330_000).strip())], "doc_id long, text string")
    one, many = sorted(token_links(docs, A, B).collect())
    assert (many.n_a, many.n_b, many.n_groups) == (330_000 * one.n_a, 330_000 * one.n_b, 330_000 * one.n_groups)
