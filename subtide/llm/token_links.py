"""Links between the tokens of two tokenizers over the same text, and what a corpus says of them.

Tokens of A and of B tile the same bytes. Per stretch of bytes the incidence of tokens and bytes is a sparse matrix,
in compressed rows; the row products A * B^T (Gustavson: a row of the product is the sum of the rows of B^T
that the row of A names) have an entry, the number of shared bytes, for each overlapping pair. Groups follow from
it: a token of A goes on with the group of the one before if the two overlap one token of B. The incidences of tokens
and groups, multiplied the same way, have an entry for each pair of tokens that share a group: the links.

Texts are cut where a blank follows anything but white space. No token of either kind reaches across such a place
(`Pair` checks this for the pieces of B; A's are split there before they are merged), so both tokenizers have an end
there and every group lies within a stretch. Stretches are encoded and multiplied once and remembered by the Python
worker, up to `REMEMBERED` in each of two generations.

A pair of ids has a count: the documents that hold it linked. Each task adds up its documents before the shuffle.
Pairs are sent to all tasks up to `MOST_SENT`; beyond that the documents' pairs are joined with them.

Texts that are null or empty, or whose tokens of either kind don't give back blank + text, have no tokens: all
numbers zero, the digest ''. Very long texts are worked on as a whole, by one task, in row blocks of the products. Equal rows
count as documents of their own, as do rows without a doc_id. An empty table gives an empty one. Columns
other than doc_id and text are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import stored
from subtide.llm.words import CHUNK_BYTES, chunks, octets

REMEMBERED = 200_000  # stretches, in each of two generations
LONG = 64  # bytes; a longer stretch is not remembered
HELD = 4_000_000  # pairs a task adds up before it passes them on
MOST_SENT = 4_000_000  # pairs of ids sent to all tasks; 64 MB
PRODUCTS = 2_000_000  # products formed at once
_B_BITS = 16

_DOCS = (
    T.StructType().add("row_key", "long").add("doc_id", "long").add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("n_links", "long")
    .add("groups_sha256", "string").add("pairs", "binary").add("times", "binary")
)
_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def token_links(docs: DataFrame, a_path: str, b_path: str, most_sent: int = MOST_SENT) -> DataFrame:
    """Per row of `docs` its tokens, groups and links, the links that are among their A id's most frequent, and
    the sum of the counts over its links.

    `a_path` is a byte-level BPE as JSON, `b_path` a SentencePiece model that puts a blank before the text; both
    must be there on every executor.
    """
    linked, counts = corpus_links(docs, a_path, b_path)
    if counts.count() <= most_sent:
        sent = docs.sparkSession.sparkContext.broadcast(_table(counts))
        schema = T.StructType([*[f for f in _DOCS if f.name in _RESULT], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
        return linked.mapInArrow(_looked_up(sent), schema).select(*_RESULT)
    each = linked.select("row_key", "pairs", "times").mapInArrow(_exploded, "row_key long, pair long, times long")
    sums = each.join(counts, "pair").groupBy("row_key").agg(F.sum(F.expr("IF(best, times, 0L)")).alias("n_best"), F.sum(F.expr("times * n")).alias("count_sum"))
    rest = linked.drop("pairs", "times").join(sums, "row_key", "left")
    return rest.na.fill(0, ["n_best", "count_sum"]).select(*_RESULT)


def corpus_links(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """The documents with their linked pairs, and per pair of ids (pair, n, best): how many documents hold it
    linked, and whether no other pair of its A id is in more. A pair is the id of A times 2**16 plus that of B."""
    texts = docs.select(F.monotonically_increasing_id().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), octets("text").alias("text"))
    linked = stored(texts.mapInArrow(_linked(a_path, b_path), _DOCS))  # written once, so that a row keeps its number
    counts = stored(linked.select("pairs").mapInArrow(_added_up, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    of_a = F.shiftright("pair", _B_BITS)
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    return linked, stored(counts.join(most, of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


# Sparse matrices


@dataclass
class Csr:
    """Compressed rows: row i has columns indices[indptr[i]:indptr[i + 1]], with the values data[...]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int) -> Csr:
        """Ones at (row, column), rows ascending."""
        indptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))])
        return cls(indptr, columns, np.ones(len(columns), np.int64), n_columns)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(indptr, self.rows()[order], self.data[order], len(self.indptr) - 1)

    def products(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, columns and values of the product with `other`, in row order, by blocks of whole rows.

        Gustavson: each stored (i, k) adds its value times row k of `other` to row i.
        """
        sizes = np.diff(other.indptr)[self.indices]
        reached = np.concatenate([[0], np.cumsum(sizes)])[self.indptr]  # products before each row
        row = 0
        while row < len(self.indptr) - 1:
            end = max(row + 1, int(np.searchsorted(reached, reached[row] + PRODUCTS, "right")) - 1)
            part = slice(self.indptr[row], self.indptr[end])
            n = sizes[part]
            from_row = np.repeat(np.arange(row, end), np.diff(self.indptr[row : end + 1]))
            at = np.repeat(other.indptr[self.indices[part]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            key = np.repeat(from_row, n) * other.columns + other.indices[at]
            value = np.repeat(self.data[part], n) * other.data[at]
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            if len(first):
                yield key[first] // other.columns, key[first] % other.columns, np.add.reduceat(value, first)
            row = end


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, shared bytes) of tokens that tile the same bytes, given where they end."""
    size = int(a_ends[-1])
    at = np.arange(size)
    a = Csr.of(np.searchsorted(a_ends, at, "right"), at, len(a_ends), size)
    b = Csr.of(np.searchsorted(b_ends, at, "right"), at, len(b_ends), size)
    return tuple(np.concatenate(x) for x in zip(*a.products(b.transposed())))


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, numbered in order."""
    a, b, _ = overlaps(a_ends, b_ends)
    # The overlaps of A's tokens one after the other: where no token of B goes on, a group ends.
    first = np.flatnonzero(np.diff(a, prepend=-1))
    fresh = np.concatenate([[True], b[first[1:]] != b[first[1:] - 1]])
    of_a = np.cumsum(fresh) - 1
    of_b = np.empty(len(b_ends), np.int64)
    of_b[b] = of_a[a]
    return of_a, of_b


def group_links(of_a: np.ndarray, of_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of A and of B that share a group, by blocks."""
    n = int(of_a[-1]) + 1
    a = Csr.of(np.arange(len(of_a)), of_a, len(of_a), n)
    b = Csr.of(np.arange(len(of_b)), of_b, len(of_b), n)
    for rows, columns, _ in a.products(b.transposed()):
        yield rows, columns


# Tokenizers


# Fixed value: how a byte-level tokenizer splits text before it merges.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, with the bytes of each id.

    A's vocabulary numbers its merges in their order, so the ids are ranks, and the encoder by ranks, which is the
    faster one, gives the same tokens (tested on every character).
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            given = json.load(file)
        split = given["pre_tokenizer"]
        if given["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError(f"{a_path} is no plain byte-level tokenizer")
        vocabulary, special = given["model"]["vocab"], {t["content"] for t in given["added_tokens"]}
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in given["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{a_path} does not number its merges in their order")
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in entry): i for entry, i in vocabulary.items() if entry not in special}
        self.a = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = {i: entry for entry, i in ranks.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces):
            raise ValueError("a piece goes on after a blank, so texts can't be cut at blanks")
        self.blank = [self.b.piece_to_id("▁")]
        self.b_bytes = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        numbers = range(max(max(ranks.values()), len(pieces)) + 1)
        self.texts = [[f"{mark}{i}" for i in numbers] for mark in ",|;"]
        self.a_sizes, self.b_sizes = (np.array([len(of.get(i, b"")) for i in range(max(of) + 1)]) for of in (self.a_bytes, self.b_bytes))

    def encoded(self, stretches: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of stretches that begin with a blank."""
        texts = [s.decode(errors="replace") for s in stretches]
        of_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return list(map(self.a.encode_ordinary, texts)), [ids or self.blank for ids in of_b]  # no blank is put before an empty text

    def give_back(self, stretches: list[bytes], of_a: list[list[int]], of_b: list[list[int]]) -> np.ndarray:
        """Whether the tokens of both kinds are the bytes of the stretch."""
        whole, sizes = b"".join(stretches), np.fromiter(map(len, stretches), np.int64, len(stretches))
        same = np.ones(len(stretches), bool)
        for ids, bytes_of, size_of in ((of_a, self.a_bytes, self.a_sizes), (of_b, self.b_bytes, self.b_sizes)):
            flat = _flat(ids)
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            covered = np.concatenate([[0], np.cumsum(size_of[flat])])
            fits = np.diff(covered[np.concatenate([[0], ends])]) == sizes
            if not fits.all() or b"".join(map(bytes_of.__getitem__, flat.tolist())) != whole:
                fits = np.array([b"".join(map(bytes_of.__getitem__, x)) == s for x, s in zip(ids, stretches)])
            same &= fits
        return same


#: Of a stretch: its tokens of A and of B, groups and links, four int32; the groups as text, a semicolon before each; the links as pairs of ids.
#: Minus one token of A where the tokens don't give back the stretch.
Stretch = tuple[bytes, str, bytes]
_LOST: Stretch = (np.array([-1, 0, 0, 0], np.int32).tobytes(), "", b"")


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.array(list(chain.from_iterable(ids)), np.int64)


def _analysed(pair: Pair, stretches: list[bytes]) -> list[Stretch]:
    """The matrices are of all stretches together."""
    of_a, of_b = pair.encoded(stretches)
    same = pair.give_back(stretches, of_a, of_b)
    if not same.all():
        kept = iter(_multiplied(pair, *([x for x, ok in zip(ids, same) if ok] for ids in (of_a, of_b))))
        return [next(kept) if ok else _LOST for ok in same]
    return _multiplied(pair, of_a, of_b)


def _multiplied(pair: Pair, of_a: list[list[int]], of_b: list[list[int]]) -> list[Stretch]:
    if not of_a:
        return []
    a_ids, b_ids = _flat(of_a), _flat(of_b)
    a_group, b_group = groups(np.cumsum(pair.a_sizes[a_ids]), np.cumsum(pair.b_sizes[b_ids]))
    n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (of_a, of_b))
    owner = np.repeat(np.arange(len(of_a)), n_a)
    links = [(owner[a], (a_ids[a] << _B_BITS | b_ids[b]).astype(np.uint32)) for a, b in group_links(a_group, b_group)]
    of_stretch, linked = (np.concatenate(x) for x in zip(*links))
    at = 4 * np.searchsorted(of_stretch, np.arange(len(of_a) + 1))
    first = np.append(a_group[np.cumsum(n_a) - n_a], a_group[-1] + 1)
    numbers = np.stack([n_a, n_b, np.diff(first), np.diff(at) // 4], axis=1).astype(np.int32).tobytes()

    # A comma between tokens of a side, a bar between the sides, a semicolon between groups: each token's text with
    # what comes before it, both sides of a group next to each other.
    place = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    side = np.concatenate([2 * a_group, 2 * b_group + 1])[place]
    change = np.diff(side, prepend=side[0] - 1)
    texts = pair.texts
    marked = [texts[c][i] for c, i in zip(np.where(change == 0, 0, 2 - side % 2).tolist(), np.concatenate([a_ids, b_ids])[place].tolist())]
    ends = np.cumsum(n_a + n_b).tolist()
    begins = [0, *ends[:-1]]
    linked, at = linked.tobytes(), at.tolist()
    return [
        (numbers[16 * k : 16 * k + 16], "".join(marked[i:j]), linked[x:y])
        for k, (i, j, x, y) in enumerate(zip(begins, ends, at, at[1:]))
    ]


class Memory:
    """Stretches looked up by their bytes: of two generations, the older one goes when the newer one is full."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.new: dict[bytes, Stretch] = {}
        self.old: dict[bytes, Stretch] = {}

    def of(self, stretches: list[bytes]) -> list[Stretch]:
        found = list(map(self.new.get, stretches))
        missing = [i for i, x in enumerate(found) if x is None]
        if not missing:
            return found
        here = dict.fromkeys(stretches[i] for i in missing)
        if len(self.new) + len(here) > REMEMBERED:
            self.old, self.new = self.new, {}
        here.update((s, self.old[s]) for s in here.keys() & self.old.keys())
        fresh = [s for s, x in here.items() if x is None]
        for part in _parts(fresh):
            here.update(zip(part, _analysed(self.pair, part)))
        self.new.update((s, x) for s, x in here.items() if len(s) <= LONG)
        for i in missing:
            found[i] = here[stretches[i]]
        return found


_MEMORIES: dict[tuple[str, str], Memory] = {}


def _memory(a_path: str, b_path: str) -> Memory:
    """Of a Python worker, which does one task after the other."""
    if (a_path, b_path) not in _MEMORIES:
        _MEMORIES[a_path, b_path] = Memory(Pair(a_path, b_path))
    return _MEMORIES[a_path, b_path]


def _parts(stretches: list[bytes]) -> Iterator[list[bytes]]:
    """Parts of about CHUNK_BYTES, or one long stretch."""
    start = size = 0
    for i, s in enumerate(stretches):
        if i > start and size + len(s) > CHUNK_BYTES:
            yield stretches[start:i]
            start, size = i, 0
        size += len(s)
    if stretches:
        yield stretches[start:]


def _cut_points(raw: np.ndarray) -> np.ndarray:
    """Where a blank follows something else than white space."""
    blank = np.flatnonzero(raw == 0x20)
    blank = blank[blank > 0]
    one, two, three = raw[blank - 1], raw[np.maximum(blank - 2, 0)], raw[np.maximum(blank - 3, 0)]
    # Beyond ASCII, all characters with the first bytes of a white space are taken for one.
    wide = (one >= 0x80) & (((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | np.isin(three, (0xE1, 0xE2, 0xE3)) & np.isin(two, (0x9A, 0xA0, 0x80, 0x81)))
    return blank[(one > 0x20) & (one != 0x7F) & ~wide]


def _linked(a_path: str, b_path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(a_path, b_path)
        for batch, texts in chunks(batches):
            spaced = [b" " + t if t else b"" for t in texts]
            joined = b"".join(spaced)
            begins = np.cumsum([0, *map(len, spaced)])
            cuts = np.union1d(_cut_points(np.frombuffer(joined, np.uint8)), begins)
            places = cuts.tolist()
            looked = memory.of([joined[x:y] for x, y in zip(places, places[1:])])
            yield _rows(batch, looked, np.searchsorted(cuts, begins))

    return run


def _rows(batch: pa.RecordBatch, looked: list[Stretch], at: np.ndarray) -> pa.RecordBatch:
    """A row per text; the stretches of text d are looked[at[d]:at[d + 1]]."""
    n = len(at) - 1
    numbers, texts, pairs = ([x[i] for x in looked] for i in range(3))
    numbers = np.frombuffer(b"".join(numbers), np.int32).reshape(-1, 4).T.astype(np.int64)
    text_of = np.repeat(np.arange(n), np.diff(at))
    lost = np.zeros(n, bool)
    lost[text_of[numbers[0] < 0]] = True
    sums = np.zeros((4, n), np.int64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        sums[:, some] = np.add.reduceat(numbers, at[some], axis=1)
    sums[:, lost] = 0
    whole = [x < y and not gone for x, y, gone in zip(at, at[1:], lost)]
    digests = [hashlib.sha256("".join(texts[x:y])[1:].encode()).hexdigest() if ok else "" for x, y, ok in zip(at, at[1:], whole)]

    of_text = np.repeat(text_of, np.fromiter(map(len, pairs), np.int64, len(pairs)) // 4).astype(np.uint64)
    linked = np.sort(of_text << np.uint64(32) | np.frombuffer(b"".join(pairs), np.uint32))
    linked = linked[~lost[(linked >> np.uint64(32)).astype(np.int64)]]
    first = np.flatnonzero(np.concatenate([[True], linked[1:] != linked[:-1]])) if len(linked) else np.empty(0, np.int64)
    times = np.diff(first, append=len(linked)).astype(np.uint32)
    linked = linked[first]
    edges = 4 * np.searchsorted(linked, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    ends = pa.py_buffer(edges.astype(np.int32))
    packed = [pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(x.astype(np.uint32))]) for x in (linked, times)]
    columns = [batch.column("row_key"), batch.column("doc_id"), *[pa.array(x) for x in sums], pa.array(digests, pa.string()), *packed]
    return pa.RecordBatch.from_arrays(columns, names=_DOCS.names)


# Counts over the corpus


def _added_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        for i in range(0, len(pair), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(pair[i : i + 50_000].astype(np.int64)), pa.array(n[i : i + 50_000])], names=["pair", "n"])

    for batch in batches:
        for packed in batch.column("pairs"):
            held.append(np.frombuffer(packed.as_py(), np.uint32))
            size += len(held[-1])
            if size > HELD:
                yield from flushed()
                size = 0
    if size:
        yield from flushed()


def _table(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = counts.toArrow()
    pair = table.column("pair").to_numpy()
    order = np.argsort(pair)
    return pair[order].astype(np.uint32), table.column("n").to_numpy()[order], table.column("best").to_numpy()[order]


def _looked_up(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in batches:
            sums = []
            for pairs, times in zip(batch.column("pairs"), batch.column("times")):
                at, often = np.searchsorted(pair, np.frombuffer(pairs.as_py(), np.uint32)), np.frombuffer(times.as_py(), np.uint32).astype(np.int64)
                sums.append((int(often[best[at]].sum()), int((often * n[at]).sum())))
            columns = [pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1)]
            kept = [f.name for f in _DOCS if f.name in _RESULT]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *columns], names=[*kept, "n_best", "count_sum"])

    return run


def _exploded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, pairs, times in zip(batch.column("row_key").to_pylist(), batch.column("pairs"), batch.column("times")):
            pair, often = np.frombuffer(pairs.as_py(), np.uint32).astype(np.int64), np.frombuffer(times.as_py(), np.uint32).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), key, np.int64)), pa.array(pair), pa.array(often)], names=["row_key", "pair", "times"])
