"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The cells' token weights are raked: scaled
in turn so that their sums by source, by language and by topic are the target marginals, round after
round. A document is then kept with its cell's calibrated probability: the cell's raked weight over
its tokens, times a scale, 1 at most. The scale is the one at which the probabilities keep a budget of
tokens on average, `budget` or else the share `KEPT` of all tokens, so no small cell sets the rate. Cells that give all
they have are not made up for within their margins. The draw is a hash of the document, so a rerun
keeps the same ones.

Targets default to the marginals' own token shares to the power `temperature`, which lifts rare
values; they can be given as a table per margin, which must have every value of the documents. Topic is the form of the text (`form`) unless the
caller names a column. Only DataFrame functions. Cells, not documents, go through the rounds; all
sums are aggregated before the shuffle. Null and "" are one value of a margin, "" in cells; a null or
empty text has no tokens, and a cell without tokens has probability 1. Very long texts are only
counted. Repeated rows have the same draw, as have rows without a doc_id of one text. An empty table gives an empty one.
All columns of a row, whatever their names, are kept in `row`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.store import all_columns, stored

ROUNDS = 8
KEPT = 0.5  # of all tokens, unless a budget says otherwise
MARGINS = ("source", "lang", "topic")
PLACES = 7  # of a probability
DIGITS = 12  # of the draw: hexadecimal digits of an MD5
CELLS = 200_000  # cells per task while raking


def form() -> Column:
    """A topic from the text alone: table, markup, list or prose."""
    text = F.coalesce("text", F.lit(""))
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(text.rlike("[#*%&$]{2}"), "markup")
        .when(F.contains(text, F.lit("\n- ")), "list")
        .otherwise("prose")
    )


def raked(
    docs: DataFrame, topic: Column | None = None, temperature: float = 0.5, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
    budget: int | None = None,
) -> DataFrame:
    """(source, lang, topic, tokens, weight, probability) per cell. targets: tables (value, share) by margin; raises if
    one lacks a value of the documents."""
    cells = _cells(docs.select(*_keys(topic), _tokens().alias("tokens"))).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    cells = stored(cells.withColumn("weight", F.col("tokens").cast("double")))
    # Cells are far fewer than documents: as many tasks as they need, not as a shuffle of documents has.
    tasks = 1 + cells.count() // CELLS
    cells = cells.coalesce(tasks)
    goals = {}
    for margin in MARGINS:
        if targets and margin in targets:
            goals[margin] = targets[margin].select(F.coalesce(F.col("value"), F.lit("")).alias(margin), F.col("share").cast("double").alias("share"))
            lacking = cells.where("tokens > 0").join(goals[margin].where("share IS NOT NULL"), margin, "left_anti").first()
            if lacking is not None:
                raise ValueError(f"the targets of {margin} have none for {lacking[margin]!r}")
        else:
            own = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("share"))
            goals[margin] = own
        goals[margin] = stored(goals[margin]).coalesce(tasks)
    for _ in range(rounds):
        for margin in MARGINS:
            # Both sides hold a row per value of the margin.
            sums = cells.groupBy(margin).agg(F.sum("weight").alias("now")).join(goals[margin], margin, "left")
            factor = F.coalesce(F.expr("IF(now > 0, share / now, 0D)"), F.lit(0.0))
            cells = cells.join(sums.select(margin, factor.alias("factor")), margin).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        cells = stored(cells.select(*MARGINS, "tokens", "weight")).coalesce(tasks)
    if budget is None:
        budget = KEPT * (cells.agg(F.sum("tokens")).first()[0] or 0)
    scale = _scale(cells, budget)
    chance = F.expr(f"IF(tokens = 0, 1D, round(least(1D, weight / tokens * {scale!r}D), {PLACES}))")
    return stored(cells.select(*MARGINS, "tokens", "weight", chance.alias("probability")))


def _scale(cells: DataFrame, budget: float) -> float:
    """Where the sum of min(tokens, scale * weight) over the cells is `budget`, by Newton's method from below.

    The sum is concave in pieces, so each step but the last adds cells that give all they have.
    """
    scale, full = 0.0, -1
    while True:
        all_of = f"tokens > 0 AND weight > 0 AND {scale!r}D * weight >= tokens"
        now, given, rest = cells.agg(F.count_if(F.expr(all_of)), F.sum(F.expr(f"IF({all_of}, tokens, 0)")), F.sum(F.expr(f"IF({all_of}, 0D, weight)"))).first()
        if now == full or not rest or budget <= given:
            return scale
        scale, full = (budget - given) / rest, now


def mixture(
    docs: DataFrame, topic: Column | None = None, temperature: float = 0.5, targets: dict[str, DataFrame] | None = None, budget: int | None = None
) -> DataFrame:
    """All columns of `docs` as `row`, with its cell, tokens, probability and whether it is kept."""
    cells = raked(docs, topic, temperature, targets, budget=budget).select(*MARGINS, "probability")
    rows = _cells(docs.select(F.struct(*all_columns(docs)).alias("row"), *_keys(topic), _tokens().alias("tokens"), _draw().alias("draw")))
    return rows.join(cells, list(MARGINS)).withColumn("kept", F.col("draw") < F.col("probability"))


def _keys(topic: Column | None) -> list[Column]:
    return [F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), (form() if topic is None else topic).alias("topic")]


def _cells(rows: DataFrame) -> DataFrame:
    return rows.withColumns({m: F.coalesce(m, F.lit("")) for m in MARGINS})


def _tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _draw() -> Column:
    """From 0 to below 1, by doc_id (null: by text)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("double") / 16.0**DIGITS
