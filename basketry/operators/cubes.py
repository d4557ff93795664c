"""Totals over several sets of dimensions at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

#: What a measure may be, as (partial at the finest grain, how partials combine).
_PARTS = {
    "sum": ((F.sum, F.sum),),
    "count": ((F.count, F.sum),),
    "min": ((F.min, F.min),),
    "max": ((F.max, F.max),),
    "avg": ((F.sum, F.sum), (F.count, F.sum)),
}


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets, the whole first."""
    n = len(dimensions)
    return [s for k in range(n, -1, -1) for s in combinations(dimensions, k)]


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """The whole and each shorter beginning."""
    return [tuple(dimensions[:k]) for k in range(len(dimensions), -1, -1)]


def at_finest(
    df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """The measures' partials per distinct row of ``dimensions``."""
    parts = [
        partial(F.col(column)).alias(f"_{name}_{i}")
        for name, (kind, column) in measures.items()
        for i, (partial, _) in enumerate(_PARTS[kind])
    ]
    return df.groupBy(*dimensions).agg(*parts)


def combined(
    partials: DataFrame, dimensions: Sequence[str], measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Partials of a finer grain, reduced to a row per distinct row of ``dimensions``."""
    parts = [
        combine(F.col(f"_{name}_{i}")).alias(f"_{name}_{i}")
        for name, (kind, _) in measures.items()
        for i, (_, combine) in enumerate(_PARTS[kind])
    ]
    return partials.groupBy(*dimensions).agg(*parts)


def over_sets(
    partials: DataFrame,
    dimensions: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
    sets: Sequence[Sequence[str]],
) -> DataFrame:
    """The totals of partials over each of ``sets``, with ``grouping_id``."""
    if unknown := {d for s in sets for d in s} - set(dimensions):
        raise ValueError(f"no dimensions: {sorted(unknown)}")
    whole: list[Column] = []
    for name, (kind, _) in measures.items():
        pieces = [combine(F.col(f"_{name}_{i}")) for i, (_, combine) in enumerate(_PARTS[kind])]
        total = F.try_divide(*pieces) if kind == "avg" else pieces[0]
        whole.append(total.alias(name))
    grouped = partials.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(d) for d in dimensions))
    return grouped.agg(F.grouping_id(*dimensions).alias("grouping_id"), *whole)


def totals(
    df: DataFrame,
    dimensions: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Measures over each of ``sets`` of the dimensions (all subsets if not given).

    ``measures`` maps a name to (kind, column): sum, count, min, max or avg.
    Returns the dimensions (null where a row's set lacks them), ``grouping_id``,
    whose bits tell which those are, as a dimension may be null itself, and the
    measures. The empty set is the grand total; an empty table has no rows.

    The input is read once and reduced to a row per distinct combination before
    it is multiplied by the sets, so the rows that are expanded and shuffled
    depend on the combinations, not on the input. Where a join brings dimensions in,
    use ``at_finest`` before it, ``combined`` after it, then ``over_sets``.
    """
    sets = cube_sets(dimensions) if sets is None else sets
    return over_sets(at_finest(df, dimensions, measures), dimensions, measures, sets)
