"""Exact quantiles without gathering a column in one task.

Spark's ``percentile`` keeps every distinct value of the column in a single
aggregation buffer. Here sketches of bounded size bracket each wanted order statistic
first; a second pass counts what lies outside the brackets and the distinct values
inside them, combined map-side. Only the few wanted values reach the driver. Brackets
that would still hold too many distinct values are narrowed by sketching their inside
again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapstats.functions import columns as C

POINTS = 400                  # equally spaced quantiles kept of each group of tasks
GROUPS = 128                  # groups of tasks whose sketches are merged together
SLACK = 2.0 / POINTS          # half the width of a bracket, as a share of the rows
GROUP_LIMIT = 1_000_000       # values inside the brackets of a column that are ordered in one group
MANY = 10                     # probabilities answered together; two ranks each

Spans = dict[int, list[tuple[float, float]]]


def quantiles(df: DataFrame, columns, probabilities, exact: bool = True) -> dict[str, list[float | None]]:
    """Quantiles per column with linear interpolation; missing values are ignored.

    ``exact=False`` answers from the sketches alone (one pass, about 0.5 % rank error).
    """
    columns, probabilities = list(columns), list(probabilities)
    if not columns:
        return {}
    values = df.select(*[_present(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    asked = _around(probabilities, SLACK) if exact else probabilities
    if exact and len(probabilities) > MANY:      # narrowing must shrink what is left each time
        first = quantiles(df, columns, probabilities[:MANY])
        rest = quantiles(df, columns, probabilities[MANY:])
        return {c: first[c] + rest[c] for c in columns}
    counts, near = sketch(values, {f"c{i}": asked for i in range(len(columns))})
    if not exact:
        return {c: near[f"c{i}"] or [None] * len(probabilities) for i, c in enumerate(columns)}

    counts = {i: counts[f"c{i}"] for i in range(len(columns)) if counts[f"c{i}"]}
    ranks = {i: {k for p in probabilities for k in _neighbours(n, p)} for i, n in counts.items()}
    spans = {i: _pairs(near[f"c{i}"]) for i in counts}
    found = _at_ranks(values, ranks, counts, spans, SLACK)
    return {
        c: [_interpolate(found[i], counts[i], p) if i in counts else None for p in probabilities]
        for i, c in enumerate(columns)
    }


def sketch(values: DataFrame, wanted: dict[str, list[float]], points: int | None = None,
           groups: int = GROUPS) -> tuple[dict[str, int], dict[str, list[float]]]:
    """Approximate quantiles per column in one pass: (value counts, quantiles).

    Every group of tasks is reduced to ``points`` quantiles on its own; these, weighted by
    the group's size, give the answer. So no task merges the sketches of all others, and
    the last one sees ``points * groups`` numbers per column whatever the table's size.
    """
    points = points or POINTS
    even = C.numbers(i / points for i in range(points + 1))
    parts = values.groupBy(C.task_group(groups).alias("g")).agg(
        *[F.count(c).alias(f"n_{c}") for c in wanted],
        *[F.percentile_approx(F.col(f"`{c}`"), even, F.lit(10 * points)).alias(f"q_{c}") for c in wanted])
    exploded = parts.select(*[f"n_{c}" for c in wanted], F.explode(F.arrays_zip(*[
        F.coalesce(f"q_{c}", F.array().cast("array<double>")).alias(c) for c in wanted])).alias("q"))
    row = exploded.agg(
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in wanted],
        *[F.percentile(F.col(f"q.{c}"), C.numbers(probs), F.col(f"n_{c}")).alias(f"q_{c}") for c, probs in wanted.items()],
    ).first()
    # Every group of tasks with any value has points + 1 rows, each carrying its counts.
    return ({c: (row[f"n_{c}"] or 0) // (points + 1) for c in wanted}, {c: row[f"q_{c}"] or [] for c in wanted})


def _present(df: DataFrame, name: str) -> Column:
    return F.when(~C.is_missing(f"`{name}`", df.schema[name].dataType), F.col(f"`{name}`").cast("double"))


def _around(probabilities, slack: float) -> list[float]:
    return [edge for p in probabilities for edge in (max(0.0, p - slack), min(1.0, p + slack))]


def _neighbours(n: int, p: float) -> tuple[int, int]:
    position = (n - 1) * p
    return math.floor(position), math.ceil(position)


def _interpolate(at_rank: dict[int, float], n: int, p: float) -> float:
    low, high = _neighbours(n, p)
    a, b = at_rank[low], at_rank[high]
    return a if a == b else a + (b - a) * ((n - 1) * p - low)


def _pairs(edges: list[float]) -> list[tuple[float, float]]:
    return _merge(zip(edges[0::2], edges[1::2]))


def _merge(pairs) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for low, high in sorted(pairs):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _placed(values: DataFrame, spans: Spans) -> DataFrame:
    """One row (column, cell, value) per present value.

    Cells are numbered in value order: gap 0, span 1, gap 2, span 3, ... Values in
    gaps are dropped so that a gap collapses to one group when counted.
    """
    parts = []
    for i, intervals in spans.items():
        c = F.col(f"c{i}")
        cell = F.lit(2 * len(intervals))
        for j in reversed(range(len(intervals))):
            low, high = intervals[j]
            cell = F.when(c < low, F.lit(2 * j)).when(c <= high, F.lit(2 * j + 1)).otherwise(cell)
        parts.append(F.struct(F.lit(i).alias("i"), F.when(c.isNotNull(), cell).alias("cell"), c.alias("v")))
    return (
        values.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
        .filter(F.col("cell").isNotNull())
        .withColumn("v", F.when(F.col("cell") % 2 == 1, F.col("v")))
    )


def _at_ranks(values: DataFrame, ranks, counts, spans: Spans, slack: float) -> dict[int, dict[int, float]]:
    """Values at the wanted 0-based ranks of every column."""
    if not ranks:
        return {}
    inside = {i: n * min(1.0, 2 * slack) * len(spans[i]) for i, n in counts.items()}
    closer = min(slack, 1 / (8 * max(map(len, ranks.values()))))      # each round leaves at most a quarter
    while max(inside.values()) > GROUP_LIMIT:
        spans, inside = _narrow(values, ranks, spans, closer)

    running = Window.partitionBy("i").orderBy("cell", "v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = (
        _placed(values, spans).groupBy("i", "cell", "v").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
    )
    wanted = F.lit(False)
    for i, ks in ranks.items():
        for k in ks:
            wanted = wanted | ((F.col("i") == i) & (F.col("upto") > k) & (F.col("upto") - F.col("n") <= k))
    found: dict[int, dict[int, float]] = {i: {} for i in ranks}
    for row in ordered.filter(wanted).collect():      # at most two rows per quantile
        if row["v"] is not None:
            start = row["upto"] - row["n"]
            found[row["i"]].update({k: row["v"] for k in ranks[row["i"]] if start <= k < row["upto"]})
    missed = {i: ks - found[i].keys() for i, ks in ranks.items() if ks - found[i].keys()}
    if missed:      # a sketch strayed further than promised: look again, wider
        if slack >= 1.0:
            raise RuntimeError("column changed while its quantiles were computed")
        wider = min(1.0, slack * 30)
        _, near = sketch(values, {f"c{i}": _around([k / counts[i] for k in ks], wider) for i, ks in missed.items()})
        spans = {i: _pairs(near[f"c{i}"]) for i in missed}
        again = _at_ranks(values, missed, {i: counts[i] for i in missed}, spans, wider)
        for i, answers in again.items():
            found[i].update(answers)
    return found


def _narrow(values: DataFrame, ranks, spans: Spans, slack: float) -> tuple[Spans, dict[int, float]]:
    """Sketch the inside of every span again and shrink it around the wanted ranks."""
    counted = {
        (r["i"], r["cell"]): r["n"]
        for r in _placed(values, spans).groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    requests = []
    for i, intervals in spans.items():
        below = 0
        for j, (low, high) in enumerate(intervals):
            below += counted.get((i, 2 * j), 0)
            size = counted.get((i, 2 * j + 1), 0)
            shares = [(k - below) / size for k in sorted(ranks[i]) if below <= k < below + size]
            if shares:
                requests.append((i, low, high, size, shares))
            below += size
    near: dict[str, list[float]] = {}
    if requests:
        within = values.select(*[
            F.when(F.col(f"c{i}").between(low, high), F.col(f"c{i}")).alias(f"r{k}")
            for k, (i, low, high, _, _) in enumerate(requests)])
        _, near = sketch(within, {f"r{k}": _around(shares, slack) for k, (*_, shares) in enumerate(requests)})
    asked = {i for i, *_ in requests}
    narrowed: Spans = {i: list(pairs) for i, pairs in spans.items() if i not in asked}
    inside: dict[int, float] = dict.fromkeys(narrowed, 0.0)
    for k, (i, _, _, size, shares) in enumerate(requests):
        edges = list(zip(near[f"r{k}"][0::2], near[f"r{k}"][1::2]))
        narrowed.setdefault(i, []).extend(edges)
        wide = sum(1 for low, high in edges if low < high)      # a single value is one group row
        inside[i] = inside.get(i, 0.0) + size * min(1.0, 2 * slack) * wide
    return {i: _merge(pairs) for i, pairs in narrowed.items()}, inside
