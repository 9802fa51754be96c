"""Wide and long forms of measure tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.labels import starts_with
from wardgrid.functions.numbers import sum_or_zero


def unpivot_measures(
    wide: DataFrame, keys: Sequence[str], measures: Sequence[str], metric: str = "metric", value: str = "value"
) -> DataFrame:
    """One row per (keys, measure); missing values stay as rows."""
    return wide.unpivot(list(keys), list(measures), metric, value)


def pivot_series(
    long: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    metric: str = "metric",
    value: str = "value",
) -> DataFrame:
    """One column per metric. The metrics are given, so no job looks for them.

    A metric that occurs twice for one key is an error, not a choice between values.
    """
    def only(name: str) -> Column:
        here = F.when(F.col(metric) == name, F.col(value))
        return (
            F.when(F.count(here) <= 1, F.max(here))
            .otherwise(F.raise_error(F.lit(f"more than one value of {name} for one key")))
            .alias(name)
        )

    return long.groupBy(*keys).agg(*[only(name) for name in metrics])


def merge_series(tables: Sequence[DataFrame], keys: Sequence[str], value: str = "value") -> DataFrame:
    """Add several tables up by key; NULLs are skipped and count as 0 if alone."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return union.groupBy(*keys).agg(sum_or_zero(F.col(value)).alias(value))


def select_prefixed(table: DataFrame, keys: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    """Key columns and the columns starting with a prefix, ignoring case."""
    lowered = tuple(prefix.lower() for prefix in prefixes)
    named = [c for c in table.columns if c.lower().startswith(lowered) and c not in keys]
    return table.select(*keys, *[F.col(f"`{c}`") for c in named])


def headings_prefixed(cells: DataFrame, prefixes: Sequence[str], heading: str = "heading") -> DataFrame:
    """Long form of `select_prefixed`: rows whose heading starts with a prefix."""
    tests = [starts_with(F.col(heading), prefix) for prefix in prefixes]
    return cells.where(reduce(lambda a, b: a | b, tests))


def map_measures(table: DataFrame, measures: Sequence[str], expression) -> DataFrame:
    """One expression applied to every measure column."""
    return table.select(
        *[expression(F.col(c)).alias(c) if c in measures else F.col(c) for c in table.columns]
    )
