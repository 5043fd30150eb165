"""Exact quantiles of several columns in a few light passes.

The first pass brackets every quantile with mergeable sketches.  The second counts
what lies below the bracket.  Then the bracket is cut by sketches of its own values
until it holds a bounded number of distinct ones, which are read off.  A bracket that
turns out not to contain the wanted ranks is widened and tried again, up to the range of
the column, so the result is exact in every case.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.expressions import present_double

_ACCURACY = 10_000
_MARGIN = 4.0 / _ACCURACY
# Distinct values of a bracket that are read off at once, and the parts of a bracket that has more.
FEW = 20_000
PARTS = 64


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """Zero-based neighbours of the interpolated position and the weight of the upper one."""
    position = (n - 1) * p
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.5,)
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, ignoring nulls and NaN; None for a column without values."""
    columns, probabilities = list(columns), list(probabilities)
    if not columns:
        return {}
    values = df.select(*[present_double(df, c).alias(f"_{i}") for i, c in enumerate(columns)])

    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    pending = [(i, j) for i in range(len(columns)) for j in range(len(probabilities))]
    margin = _MARGIN
    while pending:
        used = sorted({i for i, _ in pending})
        # A lower and an upper sketch quantile per probability; the sketch size is fixed.
        asked = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)]
        sketch = values.agg(
            *[F.count(f"_{i}").alias(f"n{i}") for i in used],
            *[F.percentile_approx(f"_{i}", asked, _ACCURACY).alias(f"q{i}") for i in used],
        ).first()
        brackets = [
            (i, j, sketch[f"q{i}"][2 * j], sketch[f"q{i}"][2 * j + 1]) for i, j in pending if sketch[f"n{i}"]
        ]
        if not brackets:
            break
        found = _values_at_ranks(values, sketch, probabilities, brackets)
        pending = []
        for i, j, _, _ in brackets:
            below, above = found.get((i, j), (None, None))
            if below is None or above is None:
                pending.append((i, j))
                continue
            weight = _ranks(sketch[f"n{i}"], probabilities[j])[2]
            # From an infinite lower neighbour there is no share of the way to the upper one.
            stays = not weight or math.isinf(below)
            result[columns[i]][j] = below if stays else below + (above - below) * weight
        margin *= 8
    return result


def _values_at_ranks(values, sketch, probabilities, brackets) -> dict:
    """For each bracket the two neighbouring values, where the bracket holds both ranks."""
    counted = values.agg(
        *[F.count_if(F.col(f"_{i}") < F.lit(low)).alias(f"b{k}") for k, (i, _, low, _) in enumerate(brackets)],
        *[F.count_if(F.col(f"_{i}") <= F.lit(high)).alias(f"u{k}") for k, (i, _, _, high) in enumerate(brackets)],
    ).first()
    found, open_brackets = {}, []
    for k, (i, j, low, high) in enumerate(brackets):
        low_rank, high_rank, _ = _ranks(sketch[f"n{i}"], probabilities[j])
        if counted[f"b{k}"] <= low_rank and high_rank < counted[f"u{k}"]:
            if low == high:
                found[i, j] = (low, high)
            else:
                open_brackets.append((i, j, low, high, low_rank - counted[f"b{k}"], high_rank - counted[f"b{k}"]))
    if not open_brackets:
        return found

    found.update(_narrow(values, open_brackets))
    return found


def _narrow(values: DataFrame, brackets: list[tuple]) -> dict:
    """The values at the wanted ranks inside each bracket, read off when few enough distinct values are left.

    ``brackets``: column, probability, bounds, and the two ranks among the values inside.  A bracket with more than
    ``FEW`` distinct values is split at sketch quantiles of its own values and the part that holds a rank goes on, so no
    task and no driver ever gets more than ``FEW`` of them however large the data is.
    """
    wanted = {}
    # A piece of work is one rank in one interval: (column, low, high, rank from the interval's beginning).
    for i, j, low, high, first, second in brackets:
        wanted[i, j, 0], wanted[i, j, 1] = (i, low, high, first), (i, low, high, second)
    answers: dict = {}
    while wanted:
        places = sorted(set((i, low, high) for i, low, high, _ in wanted.values()))
        held = [
            F.when((F.col(f"_{i}") >= F.lit(low)) & (F.col(f"_{i}") <= F.lit(high)), F.col(f"_{i}"))
            for i, low, high in places
        ]
        shares = [k / PARTS for k in range(PARTS + 1)]
        row = values.agg(
            *[F.approx_count_distinct(x, 0.05).alias(f"d{k}") for k, x in enumerate(held)],
            *[F.percentile_approx(x, shares, _ACCURACY).alias(f"q{k}") for k, x in enumerate(held)],
        ).first()
        few = {p for k, p in enumerate(places) if row[f"d{k}"] <= FEW // 2 or row[f"q{k}"][0] == row[f"q{k}"][-1]}
        # Exact counts below each cut tell which part a rank lies in.
        cuts = {p: sorted(set(row[f"q{k}"]))[1:-1] for k, p in enumerate(places) if p not in few}
        # All parts are one value wide or the sketch has no cut inside: read them off.
        few |= {p for p, c in cuts.items() if not c}
        if few:
            chosen = sorted(few)
            cells = F.explode(F.array_compact(F.array(*[
                F.when(held[places.index(p)].isNotNull(), F.struct(F.lit(n).alias("k"), held[places.index(p)].alias("v")))
                for n, p in enumerate(chosen)
            ])))
            counts = values.select(cells.alias("h")).groupBy("h.k", "h.v").agg(F.count(F.lit(1)).alias("n"))
            spans: dict = {}
            for r in sorted(counts.collect(), key=lambda r: (r["k"], r["v"])):
                spans.setdefault(chosen[r["k"]], []).append((r["v"], r["n"]))
            for name, (i, low, high, rank) in list(wanted.items()):
                if (i, low, high) in few:
                    for value, n in spans[i, low, high]:
                        if rank < n:
                            answers[name] = value
                            break
                        rank -= n
                    del wanted[name]
        rest = [(p, cut) for p, c in cuts.items() if p not in few for cut in c]
        if rest:
            row = values.agg(
                *[F.count_if((F.col(f"_{p[0]}") >= F.lit(p[1])) & (F.col(f"_{p[0]}") < F.lit(cut))).alias(f"b{k}")
                  for k, (p, cut) in enumerate(rest)],
                *[F.count_if((F.col(f"_{p[0]}") >= F.lit(p[1])) & (F.col(f"_{p[0]}") <= F.lit(cut))).alias(f"u{k}")
                  for k, (p, cut) in enumerate(rest)],
            ).first()
            counted = {key: (row[f"b{k}"], row[f"u{k}"]) for k, key in enumerate(rest)}
            for name, (i, low, high, rank) in list(wanted.items()):
                p = (i, low, high)
                begin, before = low, 0
                for cut in cuts[p]:
                    below, upto = counted[p, cut]
                    if below <= rank < upto:
                        answers[name] = cut
                        del wanted[name]
                        break
                    if rank < below:
                        wanted[name] = (i, begin, cut, rank - before)
                        break
                    begin, before = cut, below
                else:
                    wanted[name] = (i, begin, high, rank - before)
    return {(i, j): (answers[i, j, 0], answers[i, j, 1]) for i, j, *_ in brackets}


def exact_median(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, (0.5,)).items()}
