"""Plain versions of the operators, over lists of rows."""

import hashlib
import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash

from subtide.llm import quality as quality_rules
from subtide.llm.toxicity import folded
from subtide.llm.words import Words
from subtide.llm.words import folded as window_hash

WORDS = [f"{x}{y}{z}" for x in "bdfglmnp" for y in "aeio" for z in ("r", "st", "n", "lt")]


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components_of(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def strength(model, text):
    """Of the toxicity model, by trying every entry at every place."""
    text = folded(text or "")

    def places(entry, stem):
        for i in range(1, len(text) - len(entry)):
            end = i + len(entry)
            if text.startswith(entry, i) and not text[i - 1].isalnum() and (stem or not text[end].isalnum()):
                yield i, end

    best = {}
    for entry, (weight, stem) in model.lexicon.items():
        for begin, end in places(entry, stem):
            if begin not in best or best[begin][1] < weight:
                best[begin] = (end, weight)
    spared = [p for phrase in model.exceptions for p in places(phrase, False)]
    times = Counter((text[a:b], w) for a, (b, w) in best.items() if not any(x <= a and b <= y for x, y in spared))
    return sum(w * (1 + math.log(n)) for (_, w), n in times.items()) / math.sqrt(len(text.split()) + 50)


def without_boilerplate(rows, min_sites=10):
    """Rows are tuples (doc_id, text, lang, source, ...)."""
    words = lambda line: [w.lower() for w in line.encode().split()]
    sites = {}
    for row in rows:
        for line in (row[1] or "").split("\n"):
            sites.setdefault(tuple(words(line)), set()).add(row[3])
    enough = min(min_sites, max(2, math.ceil(0.75 * len({row[3] for row in rows}))))
    common = {k for k, s in sites.items() if len(k) >= 3 and len(s) >= enough}
    out = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        gone = [line for line in lines if tuple(words(line)) in common]
        cut = gone and len(gone) < sum(len(words(x)) >= 3 for x in lines)
        text = "\n".join(x for x in lines if tuple(words(x)) not in common) if cut else row[1]
        out.append((row[0], text, *row[2:]))
    return out


def one_of_each(rows):
    """Rows without a doc_id stay; of equal rows one stays."""
    known = [r for r in rows if r[0] is not None]
    stay = {d for d, n, c in components_of([r[:2] for r in known]) if n == 0 or d == c}
    seen, out = set(), []
    for r in rows:
        if r[0] is None or not shingles(r[1]):
            out.append(r)
        elif r[0] in stay and r not in seen:
            seen.add(r)
            out.append(r)
    return out


def clean_of(rows, items, n=13):
    """Rows that windows of the items cover by less than a twentieth."""
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = set()
    for item in items:
        w = words(item)
        windows |= {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    out = []
    for row in rows:
        w, hit = words(row[1]), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
        if not hit or 20 * len(hit) < len(w):
            out.append(row)
    return out


def mixed(rows, rounds=8):
    """Rows drawn, with their probability."""

    def cell(row):
        text = row[1] or ""
        form = "table" if " | " in text else "markup" if re.search("[#*%&$]{2}", text) else "list" if "\n- " in text else "prose"
        return (row[3] or "", row[2] or "", form)

    tokens = Counter()
    for row in rows:
        tokens[cell(row)] += len((row[1] or "").encode().split())
    weight = {c: float(n) for c, n in tokens.items()}
    for _ in range(rounds):
        for m in range(3):
            goal, now = Counter(), Counter()
            for c, n in tokens.items():
                goal[c[m]] += n
                now[c[m]] += weight[c]
            weight = {c: w * math.sqrt(goal[c[m]]) / now[c[m]] if now[c[m]] else 0.0 for c, w in weight.items()}
    # The expected tokens grow with the scale and are half of all where the last of these bounds is reached.
    filled = sorted((n / weight[c], n, weight[c]) for c, n in tokens.items() if n and weight[c])
    left, scale = sum(w for _, _, w in filled), 0.0
    wanted = 0.5 * sum(tokens.values())
    for _, n, w in filled:
        scale, wanted, left = max(scale, wanted / left), wanted - n, left - w
    out = []
    for row in rows:
        n = tokens[cell(row)]
        chance = 1.0 if n == 0 else round(min(1.0, weight[cell(row)] / n * scale), 7)
        key = str(row[0]) if row[0] is not None else row[1] or ""
        if int(hashlib.md5(key.encode()).hexdigest()[:12], 16) / 16**12 < chance:
            out.append((*row, chance))
    return out


def quality(rows, trusted, keep):
    """(doc_id, score, base_failed, kept) per row; only the hashes are the operator's own."""
    buckets, scale, step = quality_rules.BUCKETS, quality_rules.SCALE, quality_rules.STEP

    def features(text):
        words = (text or "").encode().lower().split()
        hashes = [Words([w]).hashes[0] for w in words]
        pairs = [window_hash(np.array(hashes[i : i + 2]), 2)[0] for i in range(len(words) - 1)]
        return [int(h) % buckets for h in (*hashes, *pairs)]

    def failed(text):
        words = (text or "").split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {w for w, n in Counter(windows).items() if n > 1}
        again = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
        return len(words) < 50 or 2 * len(again) > len(words)

    half = lambda d: xxhash.xxh64(d.to_bytes(8, "little", signed=True), seed=42).intdigest() % 2 if d in trusted else -1
    found = [(d, half(d), features(t), failed(t)) for d, t in rows]
    raw = Counter(f for _, _, fs, _ in found for f in fs)

    def ratios(halves):
        good = Counter(f for _, h, fs, _ in found if h in halves for f in fs)
        ratio = lambda f: math.log((good[f] + 1) / (good.total() + buckets)) - math.log((raw[f] + 1) / (raw.total() + buckets))
        return {f: round(ratio(f) * scale) for f in raw}

    by_all, by_other = ratios((0, 1)), {0: ratios((1,)), 1: ratios((0,))}
    mean = lambda by, fs: sum(by[f] for f in fs) / len(fs) / scale if fs else 0.0
    crossed = sorted(math.floor(mean(by_other[h], fs) * step) for _, h, fs, bad in found if h >= 0 and not bad)
    spare = (1 - keep) * len(crossed)
    threshold = next((x for i, x in enumerate(crossed) if spare - crossed.count(x) - crossed.index(x) < 0), -math.inf) / step
    return sorted((d, round(mean(by_all, fs), 9), bad, not bad and mean(by_all, fs) >= threshold) for d, _, fs, bad in found)
