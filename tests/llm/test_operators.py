"""The operators on planted cases: nulls, empty and long texts, repeated rows, hot groups, clashing columns."""

import hashlib
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtide.llm import class_lm, decontamination, licenses, line_dedup, mixing, quality, toxicity, url_reputation, warc
from subtide.llm.ngram_join import deduplicated
from subtide.llm.words import Words
from tests.llm import brute
from tests.llm.brute import WORDS

ITEM = " ".join(WORDS[:20])


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# Benchmark decontamination


@pytest.mark.parametrize("block", [500_000, 3])
def test_contamination(spark, block):
    bench = frame(spark, [(1, ITEM), (2, "Short item!"), (2, "short ITEM"), (3, None), (4, " ".join(WORDS[40:60])), (None, "odd one here")], "item_id long, text string")
    rows = [
        (1, "x " * 300 + ITEM.upper() + " y"),
        (2, ITEM + " " + " ".join(WORDS[20:25])),
        (3, " ".join(WORDS[:12])),
        (4, "a short, item and odd ONE here"),
        (5, None), (6, ""), (6, ""), (7, " ".join(WORDS[30:60])),
    ]
    got = decontamination.contamination(frame(spark, rows), bench, block_windows=block).collect()
    found = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got)
    assert found == [
        (1, 321, 20, 1, "1", True), (2, 25, 20, 1, "1", True), (3, 12, 0, 0, "", False), (4, 7, 5, 2, "2,null", True),
        (5, 0, 0, 0, "", False), (6, 0, 0, 0, "", False), (6, 0, 0, 0, "", False), (7, 30, 20, 1, "4", True),
    ]
    assert {r.items_sha256 for r in got if r.doc_id == 4} == {hashlib.sha256(b"2,null").hexdigest()}


def test_spans_are_cut_and_columns_stay(spark):
    bench = frame(spark, [(1, ITEM)], "item_id long, text string")
    docs = frame(spark, [(1, f"Keep this, {ITEM}! And that.", 7, "r"), (2, None, 8, None)], "doc_id long, text string, runs int, row string")
    cut = decontamination.decontaminate(docs, bench, remove="spans")
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.collect())) == [(1, "Keep this, ! And that.", 7, "r"), (2, None, 8, None)]
    assert [r.doc_id for r in decontamination.decontaminate(docs, bench).collect()] == [2]
    assert decontamination.contamination(docs.limit(0), bench.limit(0)).collect() == []


# Class-based language model


def test_base_score_and_gain_over_it(spark):
    rng = random.Random(3)
    tongues = [WORDS[:60], WORDS[60:120]]
    rows = [(i, " ".join(rng.choice(tongues[i % 2]) for _ in range(40))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "unseen Words"), (None, "bar"), (7, rows[7][1])]
    held = F.col("doc_id") % 5 == 2
    got = class_lm.class_lm_scores(frame(spark, rows), held, rounds=3).collect()
    words = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for d, t in rows if d is None or d % 5 != 2 for w in words(t))
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (str(d), len(words(t)), sum(counts[w] > 0 for w in words(t)), total, round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words(t)), 6))
        for d, t in rows
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    out = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(math.isfinite(r.score) for r in got)


def test_words_without_a_unit_get_the_class_of_their_neighbours(spark, monkeypatch):
    """The exchange of single words against a plain count of their neighbours."""
    monkeypatch.setattr(class_lm, "MOVED", 20)
    monkeypatch.setattr(class_lm, "UNITS", 1 + 20 + class_lm.ENDINGS)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(WORDS[:50] if k % 2 else WORDS[50:100]) for k in range(30))) for i in range(100)]
    seen = {}
    plain = class_lm._own_classes

    def spied(codes, code_class, loose, transitions):
        seen["blobs"] = [np.frombuffer(r["codes"], np.uint32) for r in codes.collect()]
        seen["before"], seen["loose"], seen["transitions"] = code_class.copy(), set(loose.tolist()), transitions
        seen["own"] = plain(codes, code_class, loose, transitions)
        return seen["own"]

    monkeypatch.setattr(class_lm, "_own_classes", spied)
    got = class_lm.class_lm_scores(frame(spark, rows), F.lit(False), rounds=2).collect()
    n = class_lm.CLASSES
    sides = {c: (Counter(), Counter()) for c in seen["loose"]}
    for blob in seen["blobs"]:
        for i, c in enumerate(blob.tolist()):
            if c in sides:
                sides[c][0][int(seen["before"][blob[i - 1]])] += 1
                sides[c][1][int(seen["before"][blob[i + 1]])] += 1
    t = seen["transitions"]
    joint = [[math.log((t[a][b] + 0.5) / (t.sum() + 0.5 * n * n)) for b in range(n)] for a in range(n)]
    left, right = [math.log(t[a].sum() + 1) for a in range(n)], [math.log(t[:, a].sum() + 1) for a in range(n)]

    def gain(c, k):
        before, after = sides[c]
        here = sum(x * joint[a][k] for a, x in before.items()) + sum(x * joint[k][b] for b, x in after.items())
        return here - sum(before.values()) * (left[k] + right[k])

    assert len(seen["loose"]) == 80
    for c, k in zip(seen["own"]["code"].to_pylist(), seen["own"]["class"].to_pylist()):
        assert gain(c, k) == pytest.approx(max(gain(c, other) for other in range(1, n)))
    assert sorted(seen["own"]["code"].to_pylist()) == sorted(seen["loose"])

    # The scores, from the final classes by the definition.
    vocabulary = sorted({w for _, text in rows for w in text.split()})
    hashes = Words([" ".join(vocabulary).encode()]).hashes
    final = seen["before"].copy()
    final[seen["own"]["code"].to_numpy()] = seen["own"]["class"].to_numpy()
    class_of = {w: int(final[np.searchsorted(np.sort(hashes), h)]) for w, h in zip(vocabulary, hashes)} | {None: class_lm.END}
    chains = {i: [None, *text.split(), None] for i, text in rows}
    counts = Counter(w for chain in chains.values() for w in chain[1:])
    steps = Counter((class_of[a], class_of[b]) for chain in chains.values() for a, b in zip(chain, chain[1:]))
    tokens, kinds, out = Counter(), Counter(), Counter()
    for w, m in counts.items():
        tokens[class_of[w]] += m
        kinds[class_of[w]] += 1
    for (a, _), m in steps.items():
        out[a] += m

    def score(chain):
        pairs = [(class_of[a], class_of[b], counts[b]) for a, b in zip(chain, chain[1:])]
        return sum(math.log10((steps[a, b] + 1) / (out[a] + n)) + math.log10((m + 1) / (tokens[b] + kinds[b] + 1)) for a, b, m in pairs)

    assert {r.doc_id: r.score for r in got} == pytest.approx({i: score(chain) for i, chain in chains.items()})


# Licences


def test_whole_texts_and_lines_match_after_normalising(spark):
    mit = licenses.KNOWN[13][1]
    texts = [
        (1, mit.replace("License", "LICENCE").replace("<year> <copyright holders>", "2020 A. Person") + "\n"),
        (2, mit + " And more."),
        (3, "Prose.\n  released under the mit licence\nMore."),
        (4, None), (5, ""), (6, "Copyright (c) 2020 X"), (3, "Licensed under CC-BY-NC 4.0!"),
    ]
    got = licenses.license_scan(frame(spark, texts), licenses.known_licenses(spark)).collect()
    assert sorted((r.doc_id, r.license or "", r.notices) for r in got) == [
        (1, "MIT", ""), (2, "", ""), (3, "", "MIT"), (3, "CC-BY-NC-4.0", "CC-BY-NC-4.0"), (4, "", ""), (5, "", ""), (6, "", ""),
    ]


def test_long_licences_match_by_digest(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    if not all((folder / f).exists() for f in files):
        pytest.skip("no copies of the licences here")
    texts = {f: (folder / f).read_text() for f in files}
    rows = [(i, " ".join(texts[f].upper().split(" "))) for i, f in enumerate(files)] + [(10, texts["MPL-2.0"] + " more")]
    got = licenses.license_scan(frame(spark, rows), licenses.known_licenses(spark)).collect()
    assert {r.doc_id: r.license for r in got} == {**dict(enumerate(files.values())), 10: None}
    short = [(i, text.replace("<year>", "1999").replace("holders", "HOLDERS")) for i, (_, text) in enumerate(licenses.KNOWN[13:])]
    got = licenses.license_scan(frame(spark, short), licenses.known_licenses(spark)).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (name, _) in enumerate(licenses.KNOWN[13:])}


# WARC


def test_archives_come_back_whole(spark, tmp_path):
    rng = random.Random(1)
    big = "é" * 700
    trap = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(i, f"http://h/{i}", "".join(rng.choice("ab<>\r\n é") for _ in range(rng.randrange(3000)))) for i in range(120)]
    rows += [(200, None, None), (201, "u v\r\n", ""), (202, "u", big), (203, "u", big), (204, "u", big), (203, "u", big), (None, "u", big)]
    rows += [(300, "u", trap * 3 + big), (301, "u", "WARC/1.0\r\n"), (302, "u", "x" * 5000 + trap + "y" * 5000)]
    pages = frame(spark, rows, "page_id long, url string, html string").repartition(3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        warc.write_warc(pages, str(tmp_path / "w"))
        got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        revisit = html == big and page_id in (202, 203)
        expected.append((f"<urn:page:{'none' if page_id is None else page_id}>", "revisit" if revisit else "response", len(body), hashlib.sha1(body).hexdigest(), None if revisit else body))
    key = lambda x: repr(x)
    assert sorted([(r.record_id, r.type, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(expected, key=key)
    assert {r.refers_to for r in got if r.type == "revisit"} == {"<urn:page:204>"}


def test_broken_archives_raise_or_are_told(spark, tmp_path):
    pages = frame(spark, [(i, "u", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    for name in ("cut", "spoilt"):
        warc.write_warc(pages, str(tmp_path / name))
    (part,) = (tmp_path / "cut").glob("part-*")
    whole = part.read_bytes()
    tenth = whole.index(b"WARC/1.0", whole.index(b"<urn:page:9>") + 1)
    part.write_bytes(whole[: tenth + 40])
    (tmp_path / "cut" / f".{part.name}.crc").unlink()
    with pytest.raises(ValueError, match=f"1 archives break off.* after {tenth} bytes"):
        warc.read_warc(spark, str(tmp_path / "cut"))
    assert warc.read_warc(spark, str(tmp_path / "cut"), broken="skip").count() == 10
    assert [(r.verified, r.length) for r in warc.broken_files(spark, str(tmp_path / "cut")).collect()] == [(tenth, tenth + 40)]
    (part,) = (tmp_path / "spoilt").glob("part-*")
    part.write_bytes(part.read_bytes().replace(b"page 7 page 7", b"page 7 PAGE 7", 1))
    (tmp_path / "spoilt" / f".{part.name}.crc").unlink()
    with pytest.raises(Exception, match="disagrees with its digest"):
        warc.read_warc(spark, str(tmp_path / "spoilt")).collect()
    assert warc.read_warc(spark, str(tmp_path / "spoilt"), broken="skip").count() == 40
    assert warc.broken_files(spark, str(tmp_path / "spoilt")).collect() == []


def test_a_record_longer_than_many_splits(spark, tmp_path):
    trap = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", "a" * 5000), (2, "u", ("x" * 3000 + trap) * 40), (3, "u", "y" * 150_000), (4, "u", None)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        warc.write_warc(frame(spark, rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
        got = {r.record_id: bytes(r.payload) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {f"<urn:page:{i}>": (html or "").encode() for i, _, html in rows}


# URL filters


def test_rules_then_reputation(spark):
    urls = ["http://a.bad.org/x"] * 30 + ["http://b.bad.org/y", "https://GOOD.net/p?q", "nourl", None, "http://org", "x://good.net:80/a#b"]
    pages = frame(spark, list(enumerate(urls)), "page_id long, url string")
    outcomes = frame(spark, [("http://a.bad.org/", 1)] * 30 + [("http://good.net/", 0)] * 30, "url string, bad int")
    got = {r.page_id: r for r in url_reputation.judged(pages, ["good.net/p"], ["org/z"], outcomes).collect()}
    assert [got[i].verdict for i in (0, 31, 32, 33)] == ["block", "allow", "allow", "allow"]
    assert (got[31].host, got[31].path, got[31].rule) == ("good.net", "/p", "good.net/p")
    assert (got[32].host, got[33].host, got[34].host, got[34].path, got[35].path) == ("", "", "org", "", "/a")
    assert url_reputation.judged(pages.limit(0), [], []).collect() == []


# Toxicity


def test_lexicon_stems_folding_and_exceptions(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice(WORDS) for _ in range(40)]
        if i % 4 == 0:
            words[3], words[9] = "idiot", rng.choice(["lowei", "loweis", "loweien"]) + rng.choice(WORDS)
        if i % 4 == 1 and i % 8 == 1:
            words[5:7] = ["village", "idiot"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs, told = frame(spark, rows), frame(spark, labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, told)
    score = model.scorer()
    plain = " ".join(WORDS[:30])
    assert score(f"{plain} 1d1оt, {plain}") == score(f"{plain} idiot, {plain}") > score(plain)
    assert score("an 1D1OT and loweismen") > 0.7 > score(f"{plain} village idiot {plain}") == score(plain)
    got = toxicity.scored(frame(spark, [(1, None, "s"), (2, "", "t"), (3, "an idiot, loweis!", "u")], "doc_id long, text string, score string"), model).collect()
    assert [r.row.score for r in got] == ["s", "t", "u"] and [r.predicted for r in got] == [0, 0, 1]
    none = toxicity.toxicity(docs, told.limit(0), F.lit(True)).agg(F.max("score"), F.count("*")).first()
    assert tuple(none) == (0.0, 240)


def test_words_of_small_shares_are_learned(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(2400):
        words = [rng.choice(WORDS) for _ in range(12)]
        if i % 4 == 0:
            words[rng.randrange(12)] = f"vile{chr(97 + i // 4 % 60 % 26)}{chr(97 + i // 4 % 60 // 26)}"[::-1]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    model = toxicity.learn(frame(spark, rows), frame(spark, labels, "doc_id long, toxic int"))
    told = {w for i, t in rows if i % 4 == 0 for w in t.split() if w not in WORDS}  # each in 10 of 600 toxic documents
    score = model.scorer()
    assert len(told) == 60 and all(score(f"{' '.join(WORDS[:11])} {w}") >= 0.7 for w in told)
    assert max(score(t) for i, t in rows if i % 4) < 0.7


# Mixing


def test_marginals_are_met(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(1, 30), rng.choice("ab"), rng.choice(["en", "de"])) for i in range(400)] + [(None, None, None, None), (1, "", "a", "en")]
    docs = frame(spark, rows, "doc_id long, text string, source string, lang string")
    cells = mixing.raked(docs, topic=F.lit("t")).collect()
    for margin in mixing.MARGINS:
        tokens, weight = Counter(), Counter()
        for c in cells:
            tokens[c[margin]] += c.tokens
            weight[c[margin]] += c.weight
        shares = {k: math.sqrt(v) for k, v in tokens.items()}
        for k, v in shares.items():
            assert weight[k] / sum(weight.values()) == pytest.approx(v / sum(shares.values()), abs=0.02)
    mixed = mixing.mixture(docs)
    assert mixed.count() == len(rows)
    assert mixing.mixture(docs.limit(0)).count() == 0


def test_no_small_cell_sets_the_rate_of_a_budget(spark):
    rows = [(i, "w " * 20, "ab"[i % 3 == 0], "en") for i in range(900)] + [(1000, "w " * 2, "c", "xx")]
    docs = frame(spark, rows, "doc_id long, text string, source string, lang string")
    for budget in (3_000, 9_000, 17_000):
        cells = mixing.raked(docs, budget=budget).collect()
        assert sum(c.probability * c.tokens for c in cells) == pytest.approx(budget, rel=1e-6)
        assert next(c.probability for c in cells if c.source == "c") == 1
        kept = mixing.mixture(docs, budget=budget).where("kept").agg(F.sum("tokens")).first()[0]
        assert kept == pytest.approx(budget, rel=0.15)
    assert {c.probability for c in mixing.raked(docs, budget=100_000).collect()} == {1.0}
    cells = mixing.raked(docs).collect()
    assert sum(c.probability * c.tokens for c in cells) == pytest.approx(mixing.KEPT * sum(c.tokens for c in cells), rel=1e-5)
    assert mixing.mixture(docs.limit(0), budget=5).count() == 0


def test_given_targets_are_met_or_refused(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(1, 30), rng.choice("abc"), rng.choice(["en", "de", None])) for i in range(500)]
    docs = frame(spark, rows, "doc_id long, text string, source string, lang string")
    shares = {"source": {"a": 0.7, "b": 0.2, "c": 0.1}, "lang": {"en": 0.5, "de": 0.4, None: 0.1}}
    targets = {m: frame(spark, list(v.items()), "value string, share double") for m, v in shares.items()}
    cells = mixing.raked(docs, topic=F.lit("t"), targets=targets).collect()
    for margin, wanted in shares.items():
        for value, share in wanted.items():
            mine = sum(c.weight for c in cells if c[margin] == (value or ""))
            assert mine / sum(c.weight for c in cells) == pytest.approx(share, abs=1e-6)
    fewer = {"source": frame(spark, [("a", 1.0), ("c", 1.0)], "value string, share double")}
    with pytest.raises(ValueError, match="source have none for 'b'"):
        mixing.raked(docs, targets=fewer)


# Quality


def test_base_counts_and_verdicts(spark):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice(WORDS[:60]) for _ in range(80))) for i in range(60)]
    bad = [(100 + i, " ".join(rng.choice(WORDS[60:]) for _ in range(80))) for i in range(20)]
    odd = [(200, None), (201, "a b c a b c"), (202, "é#\n x \nx\n x \n\n"), (203, "Q " * 100), (203, "Q " * 100)]
    labels = frame(spark, [(i, 1) for i in range(40)] + [(i + 100, 0) for i in range(10)], "doc_id long, quality int")
    got = quality.quality(frame(spark, good + bad + odd), labels).collect()
    by = {r.doc_id: r for r in got}
    assert tuple(by[200])[:7] == (200, 0, 0, 0, 0, 0, True)
    assert tuple(by[201])[:7] == (201, 6, 6, 0, 0, 6, True)
    assert tuple(by[202])[:7] == (202, 4, 5, 1, 1, 0, True)
    assert tuple(by[203])[:7] == (203, 100, 100, 0, 0, 100, True)
    assert sum(by[i].kept for i in range(60)) >= 56 and not any(by[i + 100].kept for i in range(20))
    assert len(got) == 85
    for keep in (0.98, 0.7):
        got = quality.quality(frame(spark, good + bad + odd), labels, keep).collect()
        expected = brute.quality(good + bad + odd, set(range(40)), keep)
        assert sorted((r.doc_id, round(r.score, 9), r.base_failed, r.kept) for r in got) == expected


# Line dedup


@pytest.mark.parametrize("block", [1000, 1])
def test_lines_of_many_sites_go(spark, block):
    own = lambda i: f"own words of text number {i}\nand some more that nobody else has {i}"
    rows = [(i, f"s{i % 12}", f"{own(i)}\nSubscribe to  our LETTER\n" + ("nine sites only here" if i < 9 else "")) for i in range(24)]
    rows += [(90, None, "subscribe to our letter"), (91, "s1", None), (92, "s2", ""), (93, "s3", f"{own(93)}\nread more now please\nread more now please")]
    rows += [(94 + i, f"s{i}", f"{own(94 + i)}\nread more now please") for i in range(11)]
    docs = frame(spark, rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(docs, block_lines=block).collect()}
    assert got[0] == f"{own(0)}\nnine sites only here" and got[10] == f"{own(10)}\n"
    assert (got[90], got[91], got[92], got[93]) == ("subscribe to our letter", None, "", own(93))
    assert line_dedup.remove_boilerplate(docs.limit(0)).collect() == []


def test_few_sites_have_boilerplate_too(spark):
    text = lambda i: f"own words of text number {i}\nand some more that nobody else has {i}"
    for sites, enough in ((1, 2), (2, 2), (3, 3), (9, 7), (12, 9), (13, 10), (20, 10)):
        rows = [(i, f"s{i % sites}", text(i) + "\nsubscribe to our letter" * (i % sites < enough) + "\nread more on this" * (i % sites < enough - 1)) for i in range(2 * sites)]
        cut = line_dedup.remove_boilerplate(frame(spark, rows, "doc_id long, source string, text string")).collect()
        gone = sites > 1
        assert all(("letter" in r.text) == (not gone and r.doc_id % sites < enough) for r in cut), sites
        assert all(("read more" in r.text) == (r.doc_id % sites < enough - 1) for r in cut), sites


def test_spread_lines_go_from_short_pages(spark):
    notice = " ".join(WORDS[:60])
    own = lambda i: " ".join(f"{w}{i}" for w in WORDS[60:100])
    rows = [(i, f"s{i}", f"{notice}\n{own(i)}") for i in range(12)] + [(20, "s1", f"{notice}\ntwo words"), (21, "s2", notice)]
    docs = frame(spark, rows, "doc_id long, source string, text string")
    cut = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(docs).collect()}
    assert cut == {i: own(i) for i in range(12)} | {20: f"{notice}\ntwo words", 21: notice}


def test_one_of_each_group_stays(spark):
    a, b = " ".join(WORDS[:30]), " ".join(WORDS[30:60])
    rows = [(5, a, "x"), (3, a, "y"), (3, a, "z"), (9, b, "x"), (8, None, "x"), (7, "", "x"), (None, a, "q")]
    kept = deduplicated(frame(spark, rows, "doc_id long, text string, node string")).collect()
    assert sorted((str(r.doc_id), r.node) for r in kept) == [("3", "y"), ("7", "x"), ("8", "x"), ("9", "x"), ("None", "q")]


