"""Hard negatives by coordinate pruning, after LEMP.

Vectors become integers, floor(256 x) of each component, and a score is an integer inner product, so it is exact.
Rows are put into length buckets (each a tenth longer than the one before) and, within one, into blocks of about
`BLOCK_ROWS` rows of one label. A block holds its rows as a matrix and, for every coordinate of the rows at
length one, their order by its value: the sorted coordinate lists.

An anchor q with a bound t meets a block only if |q| times the largest length l there reaches t. In the block a row
scores t or more only if its cosine with q is at least c = t / (|q| l). For a focus coordinate f, one of the
`FOCUS` largest of q, that leaves values of the row at f within q_f c -+ sqrt((1 - c^2)(1 - q_f^2)), q at length
one: a range of the sorted list. Rows in the ranges of all focus coordinates are candidates, and those are
verified by their inner products.

Positives: an anchor first meets one block of its label, of the longest rows; its last positive there is the bound
for the others. Negatives: the bound is the smallest score that any positive of the anchor allows. A block gives
each anchor no more rows than it may return; those of all blocks are put together by a window over the
anchor. About `ANCHORS` anchors meet in one task with a copy of a block, so none has all anchors or all rows.

Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part; vectors shorter than
others end in zeros. Of rows that share a vec_id one takes part: of the smallest label, then vector. Ties go to
the smaller vec_id. A positive with a negative score allows no negative (80 p > 100 p). A hundred times a score must fit a long.
An anchor without positives or without negatives has no row, and an empty table gives an empty one. Other
columns are not used, whatever their names.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.store import broadcast_if_small, stored

BLOCK_ROWS = 4_096
ANCHORS = 4_096  # that share a copy of a block
FOCUS = 3
STEP = math.log(1.1)  # between length buckets
EXACT = 1 << 53  # up to here sums of products are exact in float64

_BLOCK = T.StructType().add("block", "long").add("n", "long").add("longest", "double").add("ids", "binary").add("matrix", "binary").add("lists", "binary")
_MEMBERS = ["label", "bucket", "part"]


def integer_vectors(rows: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, v, length) of the rows that take part; `label` replaces the column."""
    clean = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    ).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL"
        " AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) <> double('infinity'))"
    )
    one = clean.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
    vectors = one.select("vec_id", "row.label", F.expr("transform(row.x, c -> cast(floor(256 * c) AS long))").alias("v"))
    return vectors.withColumn("length", F.expr("sqrt(aggregate(v, 0D, (s, c) -> s + cast(c AS double) * c))"))


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    label: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchor` is a condition on vec_id. Per anchor and positive the best `negatives` rows of other labels
    whose score is from `least` percent of the positive's up to the positive's.
    """
    vectors = stored(integer_vectors(rows, label))
    blocks = stored(_blocks(vectors, block_rows))
    known = stored(blocks.select("label", "bucket", "part", "block", "longest"))
    anchors = stored(vectors.where(anchor).withColumnRenamed("vec_id", "anchor_id"))

    nearest = known.groupBy("label").agg(F.expr("max_by(block, struct(longest, -block))").alias("nearest"))
    own = broadcast_if_small(stored(known.join(nearest, "label").select("label", "block", "longest", F.expr("block = nearest").alias("seed"))))
    first = stored(anchors.join(own, "label").select("anchor_id", "v", "length", "block", "longest", "seed"))
    seeds = stored(_met(first.where("seed").withColumn("bound", F.lit(None).cast("double")), blocks, _best(positives)))
    bounds = seeds.groupBy("anchor_id").agg(F.expr(f"IF(count(*) >= {positives}, cast(min(score) AS double), NULL)").alias("bound"))
    rest = first.where("NOT seed").join(bounds, "anchor_id", "left").where("bound IS NULL OR bound <= length * longest * (1 + 1e-9D)")
    found = seeds.unionByName(_met(rest, blocks, _best(positives)))
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
    best = stored(best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "place"))

    # 80 p <= 100 n <= 100 p needs p >= 0.
    asked = best.where("positive_score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("tops"))
    asked = anchors.join(asked, "anchor_id").withColumn("bound", F.expr(f"tops[0] * {least / 100!r}D"))
    count = known.count()
    each = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>")) if count else F.lit(0).cast("long"))
    near = each.join(broadcast_if_small(known.select("block", "longest", F.col("label").alias("other"))), "block")
    near = near.where("other <> label AND bound <= length * longest * (1 + 1e-9D)")
    hard = _met(near.select("anchor_id", "v", "length", "block", "longest", "bound", "tops"), blocks, _below(negatives, least))
    by_top = Window.partitionBy("anchor_id", "top").orderBy(F.desc("score"), "vec_id")
    hard = hard.withColumn("rank", F.row_number().over(by_top)).where(F.col("rank") <= negatives)
    hard = hard.select(F.col("anchor_id").alias("of"), "top", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(hard, F.expr("anchor_id = of AND positive_score = top")).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


# Blocks


def _blocks(vectors: DataFrame, block_rows: int) -> DataFrame:
    """Rows of one label and length bucket, spread over as many parts as keep a part at about `block_rows`."""
    placed = vectors.withColumn("bucket", F.expr(f"IF(length > 0, cast(floor(ln(length) / {STEP!r}D) AS int), -1000000)"))
    sizes = placed.groupBy("label", "bucket").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    placed = placed.join(sizes, ["label", "bucket"]).withColumn("part", F.expr("pmod(xxhash64(vec_id), parts)"))
    packed = placed.select(*_MEMBERS, "vec_id", "v", "length").groupBy(*_MEMBERS).applyInArrow(_packed, T.StructType([
        T.StructField("label", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("part", T.LongType()), *_BLOCK.fields[1:],
    ]))
    names = F.row_number().over(Window.orderBy("label", "bucket", "part")) - 1
    numbered = stored(packed)
    # One row per block, so the window is small.
    order = numbered.select(*_MEMBERS).withColumn("block", names.cast("long"))
    return numbered.join(order, _MEMBERS)


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of integers, with zeros after the end of shorter ones."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))


def _unit(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return matrix / np.where(lengths > 0, lengths, 1.0)[:, None]


def _packed(rows: pa.Table) -> pa.Table:
    matrix, ids = _matrix(rows.column("v")), rows.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    matrix, ids = matrix[order], ids[order]
    lengths = _lengths(matrix)
    lists = np.argsort(_unit(matrix, lengths), axis=0, kind="stable").T.astype(np.int32)
    columns = [pa.array(rows.column(c)[:1].to_pylist(), rows.schema.field(c).type) for c in _MEMBERS]
    more = [pa.array([len(ids)], pa.int64()), pa.array([lengths.max()], pa.float64())]
    return pa.table([*columns, *more, *[pa.array([x.tobytes()], pa.binary()) for x in (ids.astype(np.int64), matrix, lists)]], names=[*_MEMBERS, *_BLOCK.names[1:]])


class _Block:
    """A block in memory, ready to be asked."""

    def __init__(self, ids: bytes, matrix: bytes, lists: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.matrix = np.frombuffer(matrix, np.int64).reshape(len(self.ids), -1)
        self.lists = np.frombuffer(lists, np.int32).reshape(-1, len(self.ids))
        lengths = _lengths(self.matrix)
        self.longest = lengths.max()
        unit = _unit(self.matrix, lengths)
        self.sorted = np.take_along_axis(unit.T, self.lists, axis=1)
        self.largest = float(np.abs(self.matrix).max(initial=0))
        self.as_float = self.matrix.astype(np.float64)

    def scored(self, q: np.ndarray, length: float, bound: float | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all rows that score `bound` or more, and perhaps of some that don't."""
        width = min(len(q), self.matrix.shape[1])
        near = self._candidates(q[:width], length, bound)
        if float(np.abs(q).max(initial=0)) * self.largest * max(1, width) < EXACT:
            part = self.as_float[:, :width] if near is None else self.as_float[near, :width]
            score = (part @ q[:width].astype(np.float64)).astype(np.int64)
        else:
            score = (self.matrix[:, :width] if near is None else self.matrix[near, :width]) @ q[:width]
        return (self.ids if near is None else self.ids[near]), score

    def _candidates(self, q: np.ndarray, length: float, bound: float | None) -> np.ndarray | None:
        """Rows within the feasible ranges of all focus coordinates; None for all rows."""
        if bound is None or bound <= 0 or not length:
            return None
        c = min(1.0, bound / (length * self.longest) * (1 - 1e-9)) if self.longest else 1.0
        hits = np.zeros(len(self.ids), np.int8)
        asked = 0
        for f in np.argsort(-np.abs(q))[:FOCUS]:
            at = q[f] / length
            slack = math.sqrt(max(0.0, 1 - c * c) * max(0.0, 1 - at * at)) + 1e-9
            low, high = _feasible(at, c, slack)
            a, b = np.searchsorted(self.sorted[f], low), np.searchsorted(self.sorted[f], high, "right")
            hits[self.lists[f, a:b]] += 1
            asked += 1
        return np.flatnonzero(hits == asked)


def _feasible(at: float, c: float, slack: float) -> tuple[float, float]:
    """Values a unit row may have at a coordinate where q has `at`, with a cosine of c or more.

    The ends are where the cosine is c, but for q's own direction (cosine 1) lying beyond them.
    """
    low, high = at * c - slack, at * c + slack
    if at >= c - 1e-9:
        high = 1.0 + 1e-9
    if -at >= c - 1e-9:
        low = -1.0 - 1e-9
    return low, high


# Anchors and blocks


def _met(pairs: DataFrame, blocks: DataFrame, select) -> DataFrame:
    """What `select` takes of each pair of an anchor and a block.

    A group is one block and a share of the anchors that it meets, `ANCHORS` or so.
    """
    choose, schema = select
    tops = F.col("tops") if "tops" in pairs.columns else F.lit(None).cast("array<long>").alias("tops")
    pairs = stored(pairs.select("anchor_id", "v", "length", "bound", tops, "block"))
    shares = stored(pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).alias("shares")))
    asked = pairs.join(shares, "block").withColumn("share", F.expr("pmod(xxhash64(anchor_id), shares)")).drop("shares")
    copies = blocks.join(shares, "block").select("block", "ids", "matrix", "lists", F.explode(F.expr("sequence(0L, shares - 1)")).alias("share"))
    both = copies.unionByName(asked, allowMissingColumns=True)

    def run(rows: pa.Table) -> pa.Table:
        held = rows.column("ids").is_valid()
        block = _Block(*[rows.column(c).filter(held)[0].as_py() for c in ("ids", "matrix", "lists")])
        rows = rows.filter(pc.invert(held))
        vectors = _matrix(rows.column("v"))
        out: list[tuple] = []
        for q, anchor, length, bound, tops in zip(vectors, *[rows.column(c).to_pylist() for c in ("anchor_id", "length", "bound", "tops")]):
            others, score = block.scored(q, length, bound)
            out.extend(choose(anchor, others, score, bound, tops))
        columns = list(zip(*out)) or [()] * len(schema.names)
        return pa.table([pa.array(x, pa.int64()) for x in columns], names=schema.names)

    return both.groupBy("block", "share").applyInArrow(run, schema)


def _top(ids: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Where the n best are: by score, ties by id."""
    if len(score) > 4 * n:
        near = np.flatnonzero(score >= -np.partition(-score, n - 1)[n - 1])
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:n]]


def _best(n: int):
    def choose(anchor: int, ids: np.ndarray, score: np.ndarray, bound: float | None, tops) -> list[tuple]:
        keep = ids != anchor
        if bound is not None:
            keep &= score >= bound
        ids, score = ids[keep], score[keep]
        at = _top(ids, score, n)
        return [(anchor, int(i), int(s)) for i, s in zip(ids[at], score[at])]

    return choose, T.StructType().add("anchor_id", "long").add("vec_id", "long").add("score", "long")


def _below(n: int, least: int):
    def choose(anchor: int, ids: np.ndarray, score: np.ndarray, bound: float | None, tops: list[int]) -> list[tuple]:
        out = []
        for top in tops:
            keep = (score <= top) & (100 * score >= least * top)
            mine, of = ids[keep], score[keep]
            at = _top(mine, of, n)
            out.extend((anchor, top, int(i), int(s)) for i, s in zip(mine[at], of[at]))
        return out

    return choose, T.StructType().add("anchor_id", "long").add("top", "long").add("vec_id", "long").add("score", "long")
