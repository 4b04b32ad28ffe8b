"""N-gram Jaccard join with token-combination prefixes.

A text's set holds its distinct 5-word shingles (of fewer words: all of it). Two texts link when
their sets' Jaccard similarity reaches the threshold t (0.75 or more). With n the size of a set,
a linked set shares at least ceil(t n) with it, so at most e = n - ceil(t n) of its shingles are
not shared.

Shingles have one order for all texts: rare ones first, frequent ones last, each by hash. Which
are frequent is counted over all texts, in cells of a sketch that are never below a shingle's count
(`_frequent`); any choice gives the same links, a bad one costs time.

* Rare class, single tokens. If the first shared shingle is rare, it is among the first e + 1 of
  both. Prefixes are extended to e + k, with k = 1 + n // 16; two linked sets share at least the
  smaller k shingles within them, so a pair that shares fewer is dropped before it is verified.
* Frequent class, combinations. If the first shared shingle is frequent, no rare one is shared,
  so a set of more than e rare shingles needs none of these. All that is shared is in the frequent
  part. Unshared shingles of x (u) and of y (w) come between shared neighbours at most u + w
  times; u <= e and u + w <= (n - u)(1/t - 1), so the first 2 + 2u + w <= 2 + e + (n - e)(1/t - 1)
  of x hold two shared shingles that are neighbours in both sets. So the pairs of neighbours in
  that extended prefix are indexed: a number linear in n.

Lists of up to `SMALL` sets give pairs. Longer ones give two stars (smallest and largest id);
after those are verified, only pairs from different components are left to look at. The same
holds for the pairs of short lists. Every pair that could still join two components is verified
with the whole sets, so the components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.components import connected_components
from subtide.llm.sketch import PIECE_CELLS, bits_of, cells_for, from_gaps, gaps
from subtide.llm.store import all_columns, broadcast_if_small, stored
from subtide.llm.words import Words, chunks, distinct, folded, octets, shingle_sets

SMALL = 32  # sets in a list that gives all its pairs
FREQUENT = 16  # sets that hold a frequent shingle, at least
MOST_CELLS = 1 << 27  # in which shingles are counted; 16 MB of bits
COUNTED = 2_000_000  # shingles a task counts at once

_SETS = T.StructType().add("doc_id", "long").add("n", "long").add("digest", "binary").add("piece", "integer").add("cells", "binary").add("times", "binary")
_BITS = T.StructType().add("piece", "integer").add("bits", "binary")
_PREFIX = T.StructType().add("node", "long").add("sizes", "long").add("signatures", T.ArrayType(T.LongType(), False))
_LISTED = T.StructType().add("signature", "long").add("a", "long").add("b", "long").add("sizes_a", "long").add("sizes_b", "long")
_SHINGLES = T.StructType().add("node", "long").add("shingles", "binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.75, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable by links, itself included. A null or empty text
    and one without words have no shingle and no link. Rows of one doc_id are one document, with
    the links of all of them; rows without a doc_id link with nothing and have a null component.
    Very long texts are hashed in pieces; their sets are compared whole. An empty table gives an empty
    one. Columns other than doc_id and text are not used, whatever their names.
    """
    if not 0.75 <= threshold < 1:
        raise ValueError("the combinations are complete for thresholds from 0.75 to below 1")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), octets("text").alias("text"))
    words = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 6  # about six bytes each
    cells = cells_for(4 * words, MOST_CELLS)
    measured = stored(texts.mapInArrow(_measured(shingle, cells), _SETS))
    counted = measured.where("piece IS NOT NULL").select("piece", "cells", "times").repartition("piece").sortWithinPartitions("piece")
    # Where a cell holds many shingles, a frequent one must stand out from its company.
    bits = stored(counted.mapInArrow(_summed(max(frequent, 4 * words // cells)), _BITS))
    sets = measured.where("piece IS NULL").select("doc_id", "n", "digest")
    classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"))
    members = stored(sets.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "digest").distinct().join(classes, "digest"))
    copies = stored(
        members.groupBy(F.col("doc_id").alias("copy"))
        .agg(F.max(F.col("doc_id") == F.col("node")).alias("own"))
        .where("NOT own")
        .select(F.col("copy").alias("node"))
    )

    common = docs.sparkSession.sparkContext.broadcast(_frequent(bits, cells))
    with_id = texts.where("doc_id IS NOT NULL")
    prefixes = with_id.mapInArrow(_prefixes(shingle, threshold, common), _PREFIX).join(broadcast_if_small(copies), "node", "left_anti")
    lists = prefixes.select(F.explode("signatures").alias("signature"), "node", "sizes")
    listed = stored(
        lists.repartition("signature").sortWithinPartitions("signature", "node").mapInArrow(_listed(threshold), _LISTED)
    )
    common.destroy()
    pairs = stored(_counted(listed.where("b IS NOT NULL")))
    long_lists = stored(listed.where("b IS NULL").select("signature", F.col("a").alias("node"), F.col("sizes_a").alias("sizes")).distinct())

    # A doc_id with several texts is in several classes; all of them are one component.
    several = members.groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = members.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    verifier = _Verifier(with_id, shingle, threshold, pairs, long_lists)
    stars = _stars(pairs, long_lists)
    links = stored(verifier.linked(stars))
    components = stored(connected_components(links))
    rest = _across(pairs, long_lists, components, round(threshold * 10_000)).join(stars, ["a", "b"], "left_anti")
    more = stored(verifier.linked(rest))
    components = connected_components(links.unionByName(more).unionByName(repeated))

    found = members.join(components, "node", "left").select(
        "doc_id", "digest", F.coalesce("component", "node").alias("component_id")
    )
    return sets.join(found, ["doc_id", "digest"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _measured(shingle: int, cells: int):
    """Per text the size and digest of its set; besides, for the shingles of a task's different sets,
    the cells that are in use and how often, in a row per piece of the sketch."""
    shift = np.uint64(65 - cells.bit_length())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("piece", pa.int32()), ("cells", pa.binary()), ("times", pa.binary())])
        held: list[np.ndarray] = []
        seen: set[bytes] = set()
        size = 0

        def packed() -> pa.RecordBatch:
            used = np.sort(np.concatenate(held)) >> shift
            first = np.flatnonzero(np.concatenate([[True], used[1:] != used[:-1]]))
            times = np.minimum(np.diff(first, append=len(used)), 65_535).astype(np.uint16)
            used = used[first].astype(np.int64)
            edges = np.searchsorted(used, np.arange(0, cells + 1, PIECE_CELLS))
            full = np.flatnonzero(np.diff(edges)).tolist()
            places = [gaps(used[edges[p] : edges[p + 1]] - p * PIECE_CELLS) for p in full]
            counts = [times[edges[p] : edges[p + 1]].tobytes() for p in full]
            none = pa.nulls(len(full), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.nulls(len(full), pa.binary()), pa.array(full, pa.int32()), pa.array(places, pa.binary()), pa.array(counts, pa.binary())], schema=schema)

        for batch, texts in chunks(batches):
            sizes, digests = [], []
            for found in shingle_sets(Words(texts), shingle):
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                sizes.append(len(found))
                digests.append(digest)
                if len(found) and digest not in seen:
                    seen.add(digest)
                    held.append(found)
                    size += len(found)
            none = pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.nulls(len(sizes), pa.int32()), none, none], schema=schema)
            if size > COUNTED:
                yield packed()
                held, seen, size = [], set(), 0
        if held:
            yield packed()

    return run


def _summed(least: int):
    """Bits of the cells counted `least` times or more, from pieces that come sorted; one piece is in memory."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, total = None, np.zeros(PIECE_CELLS, np.int64)

        def done() -> pa.RecordBatch:
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([bits], pa.binary())], names=_BITS.names)

        for batch in batches:
            for p, cells, times in zip(batch.column("piece").to_pylist(), batch.column("cells"), batch.column("times")):
                if p != piece:
                    if piece is not None:
                        yield done()
                    piece = p
                    total[:] = 0
                total[from_gaps(cells.as_py())] += np.frombuffer(times.as_py(), np.uint16)
        if piece is not None:
            yield done()

    return run


def _frequent(summed: DataFrame, cells: int) -> np.ndarray:
    """A bit per cell, by the upper bits of a shingle's hash: whether its shingles are in the frequent class."""
    bits = np.zeros((cells // PIECE_CELLS, PIECE_CELLS // 8), np.uint8)
    for row in summed.toLocalIterator():  # MOST_CELLS bits at most
        bits[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def _prefixes(shingle: int, threshold: float, common):
    share = round(threshold * 10_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = common.value
        shift = np.uint64(65 - (8 * len(frequent)).bit_length())
        for batch, texts in chunks(batches):
            nodes, sizes, parts = [], [], []
            for node, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(Words(texts), shingle)):
                n = len(found)
                if not n:
                    continue
                e = n + -share * n // 10_000
                often = bits_of(frequent, (found >> shift).astype(np.int64))
                rare = found[~often]
                extended = e + 1 + n // 16
                singles = rare[:extended] & ~np.uint64(1)
                reached = min(n, extended) - len(singles)  # frequent ones in the extended prefix
                if len(rare) <= e:
                    reach = 2 + e + int((n - e) * (1 / threshold - 1) + 1e-9)
                    neighbours = folded(found[often][: max(0, reach - len(rare))], 2)
                    singles = np.concatenate([singles, neighbours | np.uint64(1)])
                nodes.append(node)
                sizes.append(n << 32 | reached)
                parts.append(singles)
            if nodes:
                ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
                signatures = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), signatures], names=["node", "sizes", "signatures"])

    return run


def _inside(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _listed(threshold: float):
    """Of sorted (signature, node, sizes): the pairs of short lists, the rows of long ones (b null)."""

    def emit(sig, node, sizes, long_sig):
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        length = np.diff(first, append=len(sig))
        run_length = np.repeat(length, length)
        long = (run_length > SMALL) | (sig == long_sig if long_sig is not None else False)
        if long.any():
            none = pa.nulls(int(long.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(sig[long]), pa.array(node[long]), none, pa.array(sizes[long]), none], names=_LISTED.names)
        keep = ~long & (run_length > 1)
        sig, node, sizes = sig[keep], node[keep], sizes[keep]
        for step in range(1, SMALL):
            same = np.flatnonzero(sig[step:] == sig[:-step])
            if not len(same):
                break
            a, b, x, y = node[same], node[same + step], sizes[same], sizes[same + step]
            n, m = x >> 32, y >> 32
            ok = (a != b) & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(z[ok]) for z in (sig[same], a, b, x, y)], names=_LISTED.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        long_sig = None  # of a long list, some of whose rows went out already
        for batch in batches:
            rows = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("signature", "node", "sizes"))]
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0] == rows[0][-1], True)) if rows[0][0] != rows[0][-1] else 0
            if cut:
                yield from emit(*[r[:cut] for r in rows], long_sig)
                if rows[0][cut] != long_sig:
                    long_sig = None
            held = [r[cut:] for r in rows]
            if len(held[0]) > SMALL:
                long_sig = held[0][0]
                yield from emit(*held, long_sig)
                held = [r[:0] for r in held]
        if len(held[0]):
            yield from emit(*held, long_sig)

    return run


def _counted(pairs: DataFrame) -> DataFrame:
    """Per pair the shared single shingles, whether it shares a combination, and what `_enough` needs."""
    return pairs.groupBy("a", "b").agg(
        F.count_if(F.col("signature").bitwiseAND(F.lit(1)) == 0).alias("shared"),
        F.max(F.col("signature").bitwiseAND(F.lit(1))).alias("combined"),
        F.min("sizes_a").alias("sizes_a"),
        F.min("sizes_b").alias("sizes_b"),
    )


def _enough():
    """Whether the pair can be linked, by the number of shared shingles in the extended prefixes."""
    return F.expr(
        "combined = 1 OR shared + least(sizes_a & 4294967295, sizes_b & 4294967295)"
        " >= 1 + (least(shiftright(sizes_a, 32), shiftright(sizes_b, 32)) div 16)"
    )


def _stars(pairs: DataFrame, long_lists: DataFrame) -> DataFrame:
    """Pairs that are verified first: each set with its smallest candidate, and with the ends of long lists."""
    likely = pairs.where(_enough())
    first = likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    ends = long_lists.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    spokes = long_lists.join(ends, "signature")
    low = spokes.where("low <> node").select(F.col("low").alias("a"), F.col("node").alias("b"))
    high = spokes.where("high <> node").select(F.col("node").alias("a"), F.col("high").alias("b"))
    return stored(first.unionByName(low).unionByName(high).distinct())


def _across(pairs: DataFrame, long_lists: DataFrame, components: DataFrame, share: int) -> DataFrame:
    """Candidate pairs whose sets are in different components, which are all that are left."""
    rows = long_lists.join(components, "node", "left").selectExpr(
        "signature", "node", "sizes", "coalesce(component, node) AS component", "shiftright(sizes, 32) AS n"
    )
    singles = _mixed(rows.where("signature & 1 = 0"))
    close = F.expr(f"10000 * least(n_a, n_b) >= {share} * greatest(n_a, n_b)")
    of_long = _counted(_met(singles, close))
    known = components.select("node", "component")
    of_short = (
        pairs.join(known.toDF("a", "component_a"), "a", "left")
        .join(known.toDF("b", "component_b"), "b", "left")
        .where("NOT coalesce(component_a, a) <=> coalesce(component_b, b)")
        .select(of_long.columns)
    )
    counted = of_short.unionByName(of_long).groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), F.max("combined").alias("combined"), F.min("sizes_a").alias("sizes_a"), F.min("sizes_b").alias("sizes_b")
    )
    return stored(counted.where(_enough()).select("a", "b").union(_combined(rows.where("signature & 1 = 1"), share)).distinct())


def _combined(rows: DataFrame, share: int) -> DataFrame:
    """Pairs from long lists of combinations, each from the first list that has both.

    Sets found by combinations alone share frequent shingles alone, so a set with f of them shares f
    at most: (1 + t) min(f, f') >= t (n + n') for a link. That is asked of each set and the
    smallest of a list before pairs are made, then of the pairs.
    """
    rare = f"least(n, n - ceil({share} * n / 10000) + 1 + n div 16) - (sizes & 4294967295)"
    rows = rows.withColumn("f", F.expr(f"n - ({rare})"))
    ends = rows.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least_n"))
    enough = "(10000 + {s}) * {f} >= {s} * ({n})"
    can_any = enough.format(s=share, f="f", n=f"n + greatest(least_n, ceil({share} * n / 10000))")
    rows = rows.join(ends.where("low <> high"), "signature").where(can_any).drop("low", "high", "least_n")
    rows = _mixed(stored(rows))
    lists = rows.groupBy("node").agg(F.sort_array(F.collect_set("signature")).alias("lists"))  # no more than the set has shingles
    rows = stored(rows.join(lists, "node"))
    can = F.expr(enough.format(s=share, f="least(f_a, f_b)", n="n_a + n_b"))
    first = F.expr("signature = element_at(array_intersect(lists_a, lists_b), 1)")
    return _met(rows, can & first).select("a", "b")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of lists that hold more than one component."""
    ends = rows.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return stored(rows.join(ends.where("low <> high").select("signature"), "signature", "left_semi"))


def _met(rows: DataFrame, condition) -> DataFrame:
    """Pairs a < b of a list that are in different components and meet the condition."""
    left = rows.toDF(*[c if c == "signature" else "a" if c == "node" else f"{c}_a" for c in rows.columns])
    right = rows.toDF(*[c if c == "signature" else "b" if c == "node" else f"{c}_b" for c in rows.columns])
    return left.join(right.withColumnRenamed("signature", "other"), F.expr("signature = other AND a < b AND component_a <> component_b") & condition)


class _Verifier:
    """Compares whole sets. They are taken again from the texts, for candidates alone."""

    def __init__(self, texts: DataFrame, shingle: int, threshold: float, pairs: DataFrame, long_lists: DataFrame) -> None:
        self.threshold = threshold
        likely = pairs.where(_enough())
        wanted = stored(likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).union(long_lists.select("node")).distinct())
        self.sets = stored(texts.join(broadcast_if_small(wanted), "doc_id", "left_semi").mapInArrow(_shingles(shingle), _SHINGLES))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets reach the threshold."""
        left, right = self.sets.toDF("a", "x"), self.sets.toDF("b", "y")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return both.mapInArrow(_similar(self.threshold), "a long, b long").distinct()


def _shingles(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sets = [s.tobytes() for s in shingle_sets(Words(texts), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _similar(threshold: float):
    share = round(threshold * 10_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = int(_inside(y, x).sum()) if len(x) and len(y) else 0
                keep.append(10_000 * shared >= share * (len(x) + len(y) - shared) and shared > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one row of each component: the one with its smallest doc_id.

    Texts without a shingle and rows without a doc_id all stay. Of several rows with the doc_id that
    stays, the one with the smallest values stays, column by column, maps as JSON.
    """
    found = stored(near_duplicates(docs, **options).where("doc_id IS NOT NULL"))
    gone = stored(found.where("n_shingles > 0 AND doc_id <> component_id").select("doc_id").distinct())
    columns = all_columns(docs)
    kept = docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(columns)
    several = stored(found.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    several = broadcast_if_small(several)
    # Maps have no order of their own.
    order = F.struct(*[F.to_json(F.struct(c)) if "map<" in docs.dtypes[i][1] else c for i, c in enumerate(columns)])
    again = kept.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("key"), F.struct(*columns).alias("row"), order.alias("order"))
    one = again.groupBy("key").agg(F.min_by("row", "order").alias("row"))
    return kept.join(several, "doc_id", "left_anti").select(columns).unionByName(one.select("row.*"))
