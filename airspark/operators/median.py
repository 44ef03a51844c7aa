"""Exact quantiles over a whole frame without gathering a column anywhere.

``percentile``/``median`` over one global group keep every distinct value in
one aggregation buffer, which does not scale.  Here mergeable KLL sketches
(Spark's ``kll_sketch_agg_double``, combined map-side) bracket each target
rank with their guaranteed rank error.  The next scan proves the bracket by
counting the values below it and at its ends, and fetches what lies strictly
between if that is little, or sketches it again if it is not.  Each scan is one
aggregate without grouping: no row is exploded, whatever the number of columns
and ranks, and only a bounded number of values ever reaches the driver.  A
bracket that the counts refute (sketches are right with high probability,
not always) is widened and tried again, so the result is exact always.

Quantiles use numpy's default linear interpolation bit for bit (what
pandas ``quantile`` returns); the median is the mean of the two middle
values, as pandas ``median``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import nan_to_null

#: Items of a sketch, and a rank error that it keeps nearly always (the sketch's own bound at this size, with room).
SKETCH_K = 4096
RANK_ERROR = 0.003
#: Conditional sums of one aggregate; more brackets take another scan.
BRACKETS_A_SCAN = 200


@dataclass
class _Bracket:
    """A column's ranks (first, last) and the values that should enclose them."""

    column: int
    first: int
    last: int
    low: float
    high: float
    expected: float            # values between the ends, by the sketch
    outer: tuple = ()          # the proven bracket around it: (low, high, below, inside, sketch bytes)
    error: float = RANK_ERROR
    found: dict = field(default_factory=dict)


def exact_quantiles(df: DataFrame, cols, probs=(0.5,), max_collect: int = 50_000, max_fetch_total: int = 1_000_000,
                    k: int = SKETCH_K, error: float = RANK_ERROR) -> dict:
    """{col: {p: value or None}} for every column and probability."""
    cols = list(cols)
    vals = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    # Infinities are counted at the ends and kept out of the sketches.
    finite = [F.when(F.abs(f"c{i}") < float("inf"), F.col(f"c{i}")) for i in range(len(cols))]
    stats = vals.agg(*[F.count(f"c{i}").alias(f"n{i}") for i in range(len(cols))],
                     *[F.count(F.when(F.col(f"c{i}") == float("-inf"), 1)).alias(f"neg{i}") for i in range(len(cols))],
                     *[F.count(x).alias(f"fin{i}") for i, x in enumerate(finite)],
                     *[F.min(x).alias(f"lo{i}") for i, x in enumerate(finite)],
                     *[F.max(x).alias(f"hi{i}") for i, x in enumerate(finite)],
                     *[F.kll_sketch_agg_double(x, F.lit(k)).alias(f"s{i}") for i, x in enumerate(finite)]).first()

    ranks, found, todo = {}, {}, []  # found: (column, rank) -> value
    for i, c in enumerate(cols):
        n, neg, fin = stats[f"n{i}"], stats[f"neg{i}"], stats[f"fin{i}"]
        for p in probs if n else ():
            first, last = ranks[i, p] = _ranks(n, p)
            found.update({(i, r): float("-inf") for r in (first, last) if r < neg})
            found.update({(i, r): float("inf") for r in (first, last) if r >= neg + fin})
            inside = [r for r in (first, last) if neg <= r < neg + fin]
            if inside:
                whole = (stats[f"lo{i}"], stats[f"hi{i}"], neg, fin, stats[f"s{i}"])
                todo.append(_Bracket(i, inside[0], inside[-1], 0.0, 0.0, 0.0, whole, error))
    todo = _narrow(df.sparkSession, todo)
    while todo:
        todo, later = todo[:BRACKETS_A_SCAN], todo[BRACKETS_A_SCAN:]
        todo = _scan(vals, todo, found, max_collect, max_fetch_total, k) + later

    return {c: {p: _value(found, i, ranks[i, p], stats[f"n{i}"], p) if (i, p) in ranks else None for p in probs}
            for i, c in enumerate(cols)}


def _narrow(spark, brackets: list[_Bracket]) -> list[_Bracket]:
    """Set each bracket's ends from the sketch of the proven bracket around it."""
    if not brackets:
        return []
    asked: dict[bytes, list] = {}  # each sketch is asked once, for all ranks wanted of it
    places = []
    for b in brackets:
        _, _, below, inside, sketch = b.outer
        share = [min(max((r - below) / inside, 0.0), 1.0) for r in
                 (b.first - b.error * inside - 1, b.last + b.error * inside + 2)]
        of = asked.setdefault(bytes(sketch), [])
        places.append((bytes(sketch), len(of), share))
        of += share
    row = spark.range(1).select(*[F.kll_sketch_get_quantile_double(F.lit(s), F.array(*map(F.lit, shares))) for s, shares in asked.items()]).first()
    answers = dict(zip(asked, row))
    for b, (sketch, at, (a, z)) in zip(brackets, places):
        low, high, _, inside, _ = b.outer
        b.low, b.high = (answers[sketch][at] if a > 0 else low), (answers[sketch][at + 1] if z < 1 else high)
        b.expected = (z - a) * inside
    return brackets


def _scan(vals: DataFrame, brackets: list[_Bracket], found: dict, max_collect: int, budget: int, k: int) -> list[_Bracket]:
    """One aggregate over all brackets: prove each, then read its ranks off or sketch its inside.  Returns the open ones."""
    fetch, aggs = set(), []
    for j, b in sorted(enumerate(brackets), key=lambda x: x[1].expected):
        if b.expected <= min(max_collect, budget):
            fetch.add(j)
            budget -= int(b.expected) + 1
    for j, b in enumerate(brackets):
        c, low, high = F.col(f"c{b.column}"), F.lit(b.low), F.lit(b.high)
        between = F.when((c > low) & (c < high), c)
        aggs += [F.count(F.when(c < low, 1)).alias(f"b{j}"), F.count(F.when(c == low, 1)).alias(f"l{j}"),
                 F.count(F.when(c == high, 1)).alias(f"h{j}"), F.count(between).alias(f"m{j}")]
        aggs.append((F.collect_list(between) if j in fetch else F.kll_sketch_agg_double(between, F.lit(k))).alias(f"v{j}"))
    got = vals.agg(*aggs).first()
    again = []
    for j, b in enumerate(brackets):
        below, at_low, between = got[f"b{j}"], got[f"l{j}"], got[f"m{j}"]
        at_high = got[f"h{j}"] if b.high > b.low else 0
        if not (below <= b.first and b.last < below + at_low + between + at_high):
            b.error *= 4  # the sketch missed: look wider inside the proven bracket
            again.append(b)
            continue
        missing = []
        inner = sorted(got[f"v{j}"]) if j in fetch else None
        for r in {b.first, b.last}:
            place = r - below
            if place < at_low:
                found[b.column, r] = b.low
            elif place >= at_low + between:
                found[b.column, r] = b.high
            elif inner is not None:
                found[b.column, r] = inner[place - at_low]
            else:
                missing.append(r)
        if missing:
            # Only what lies strictly between the ends was sketched.
            again.append(_Bracket(b.column, min(missing), max(missing), 0.0, 0.0, 0.0,
                                  (b.low, b.high, below + at_low, between, got[f"v{j}"]), max(RANK_ERROR, b.error / 2)))
    return _narrow(vals.sparkSession, again)


def _value(found: dict, column: int, ranks: tuple, n: int, p) -> float:
    a, b = (found[column, r] for r in ranks)
    return (a + b) / 2 if p == MEDIAN else lerp(a, b, _gamma(n, p))


MEDIAN = "median"


def _ranks(n: int, p) -> tuple:
    """0-based ranks holding quantile ``p`` of ``n`` values."""
    if p == MEDIAN:
        return (n - 1) // 2, n // 2
    lo = int(math.floor((n - 1) * p))
    return lo, min(lo + 1, n - 1)


def _gamma(n: int, p: float) -> float:
    v = (n - 1) * p
    return v - math.floor(v)


def lerp(a: float, b: float, g: float) -> float:
    """numpy's linear interpolation (the g >= 0.5 branch counts from b)."""
    if g == 0 or a == b:  # also where infinities have no difference
        return a
    d = b - a
    return b - d * (1 - g) if g >= 0.5 else a + d * g


def exact_medians(df: DataFrame, cols, **kw) -> dict:
    """Mean of the two middle values (pandas ``median``)."""
    q = exact_quantiles(df, cols, (MEDIAN,), **kw)
    return {c: q[c][MEDIAN] for c in cols}


def median_impute(df: DataFrame, cols, by=None, null_counts: dict | None = None, **kw) -> DataFrame:
    """NULL -> column median; all-NULL column -> 0.0.

    ``by=None``: one median over the whole frame (reference behaviour); it
    is computed eagerly and exactly, only for columns that have NULLs.
    ``by=[...]``: per-group median as a window aggregate; use it only where
    groups are bounded (e.g. a forecast horizon of at most 168 rows).
    ``null_counts``: NULL counts already observed (e.g. during a write), which
    saves the counting pass.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if by:
        from pyspark.sql import Window as W
        w = W.partitionBy(*by)
        return df.withColumns({
            c: F.coalesce(nan_to_null(c), F.median(nan_to_null(c)).over(w), F.lit(0.0)).cast(df.schema[c].dataType)
            for c in cols})
    nulls = null_counts
    if nulls is None or any(c not in nulls for c in cols):
        nulls = df.agg(*[F.count(F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), 1)).alias(c)
                         for c in cols]).first().asDict()
    need = [c for c in cols if nulls[c]]
    if not need:
        return df
    med = exact_medians(df, need, **kw)
    return df.withColumns({
        c: F.coalesce(nan_to_null(F.col(c)), F.lit(med[c] if med[c] is not None else 0.0))
        .cast(df.schema[c].dataType) for c in need})
