"""Mixing a corpus to target shares by iterative proportional fitting, then sampling by calibrated probabilities."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.scratch import require, store

WORD = r"[^\x20\x09-\x0D]+"
UNKNOWN = ""


def word_count(text: str) -> Column:
    """Words of a text, the weight of a document unless another column is named; null has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("double")


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Shares in proportion to each value's tokens to the ``power``: 1 keeps the shares, 0 makes them equal."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("share"))
    return sums.where("share > 0")


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 50, tolerance: float = 1e-6
) -> DataFrame:
    """``cells`` (one column per dimension, ``tokens``) with ``weight``, whose sums follow the target shares.

    ``targets``: per dimension a frame of value and ``share``; shares are taken relative to those of the values that
    occur.  A cell with a value that has no target or no tokens gets weight 0.  Each round scales the weights to every
    dimension in turn; rounds end when all sums are within ``tolerance`` of their targets (relative to the whole), else
    after ``rounds``: if the targets contradict each other the last dimension is met and the others as nearly as
    the rounds got, and a warning says by how much they were missed at the start of the last round.  The table of cells is the product of the values that occur together, not of documents.
    """
    current = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dimension, target in targets.items():
        current = current.join(target.select(dimension), dimension, "left_semi")
    current = store(current.where("weight > 0"), "cells")
    wanted = {}
    for dimension, target in targets.items():
        found = target.join(current.select(dimension).distinct(), dimension, "left_semi").where("share > 0")
        total = found.agg(F.sum("share")).first()[0]
        wanted[dimension] = store(found.select(dimension, (F.col("share") / F.lit(total or 1.0)).alias("goal")), "goal")
    for _ in range(rounds):
        off = []
        for dimension, goal in wanted.items():
            sums = current.groupBy(dimension).agg(F.sum("weight").alias("sum"))
            scale = store(goal.join(sums, dimension), "scale")
            total, distance = scale.agg(
                F.sum("sum"), F.max(F.abs(F.col("sum") / F.lit(1.0) - F.col("goal")))
            ).first()
            if total is None:
                return current
            off.append(distance)
            current = current.join(scale, dimension).withColumn("weight", F.col("weight") * F.col("goal") / F.col("sum"))
            current = store(current.select(*cells.columns, "weight"), "cells")
        if max(off) <= tolerance:
            break
    else:
        warnings.warn(f"targets missed by up to {max(off):.3g} after {rounds} rounds", stacklevel=2)
    return current


def calibrate(raked: DataFrame, fraction: float, steps: int = 100) -> DataFrame:
    """``probability`` of each cell: in proportion to weight per token, at most 1, for ``fraction`` of all tokens.

    What the cells cut off at 1 cannot give is taken from the others in proportion, until nothing changes.
    """
    total = raked.agg(F.sum("tokens")).first()[0] or 0.0
    ratio = F.col("weight") / F.col("tokens")
    factor, known = 0.0, None
    for _ in range(steps):
        full = ratio * factor >= 1
        taken, rest, count = raked.agg(
            F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))
        ).first()
        if count == known or not rest:
            break
        known = count
        factor = max(fraction * total - (taken or 0.0), 0.0) / rest
    return raked.withColumn("probability", F.least(F.lit(1.0), ratio * factor))


def chance(id_col: str, text_col: str, seed: int) -> Column:
    """A number in [0, 1) that depends on id, text and seed alone, so a repeated task draws the same documents."""
    mixed = F.md5(
        F.concat_ws(
            "/", F.lit(str(seed)), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.md5(
                F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "utf-8")
            )
        ).cast("binary")
    )
    return F.conv(F.substring(mixed, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mixture(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    powers: Mapping[str, float] | Sequence[float] = (),
    targets: Mapping[str, DataFrame] | None = None,
    fraction: float = 0.7,
    tokens: Column | None = None,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The decisions on all rows of ``docs``, and the cells with their probabilities.

    ``dimensions``: name and expression of each; null is a value of its own, the empty one.  ``powers`` tempers a
    dimension's own shares; ``targets`` gives shares outright (value column named like the dimension, ``share``).
    ``tokens``: weight of a document, by default its words.  Decisions: ``row`` (all columns of the document), one
    column per dimension, ``tokens``, ``probability``, ``chance``, ``kept``.  Documents without tokens and cells
    without a target have probability 0.  Repeated rows share their fate; ties cannot occur otherwise.

    Rows are summed to cells before anything is shuffled, so a source with a third of all rows is a few cells.
    """
    require(docs, id_col, text_col)
    weight = word_count(text_col) if tokens is None else F.coalesce(tokens.cast("double"), F.lit(0.0))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        *(F.coalesce(e.cast("string"), F.lit(UNKNOWN)).alias(n) for n, e in dimensions.items()),
        weight.alias("tokens"),
        chance(id_col, text_col, seed).alias("chance"),
    )
    names = list(dimensions)
    cells = store(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "cells")
    goals = dict(targets or {})
    for name, power in dict(powers).items():
        goals.setdefault(name, tempered_targets(cells, name, power))
    cells = store(calibrate(rake(cells, goals), fraction), "probabilities")
    decided = rows.join(cells.select(*names, "probability"), names, "left")
    probability = F.when(F.col("tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(F.lit(0.0))
    decided = decided.select("row", *names, "tokens", probability.alias("probability"), "chance")
    return decided.withColumn("kept", F.col("chance") < F.col("probability")), cells
