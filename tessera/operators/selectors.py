"""Selector cubes over overlapping groups, and their 2x2 tables.

``CUBE`` cannot express groups that overlap: a row in two groups must count in both and once in ``all``.
Rows are exploded into their selectors, then grouped once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "all"


def with_all(values: Column, allowed: Sequence[str] | None = None) -> Column:
    """``all`` and the distinct values (an array), limited to the allowed ones."""
    v = F.array_distinct(F.filter(values, lambda x: x.isNotNull()))
    if allowed is not None:
        v = F.array_intersect(v, F.array(*map(F.lit, allowed)))
    return F.concat(F.array(F.lit(ALL)), v)


def expand(df: DataFrame, axes: Mapping[str, Column]) -> DataFrame:
    """One row per combination of the axes' array items; a row with an empty axis is in no selector."""
    out = df
    for name, values in axes.items():
        out = out.withColumn(f"_{name}", F.explode(values))
    keep = [c for c in df.columns if c not in axes]
    return out.select(*keep, *(F.col(f"_{name}").alias(name) for name in axes))


def cube_counts(df: DataFrame, axes: Mapping[str, Column], aggs: Sequence[Column]) -> DataFrame:
    return expand(df, axes).groupBy(*axes).agg(*aggs)


def two_by_two(df: DataFrame, group: Sequence[str], row: Column, column: Column) -> DataFrame:
    """(group, a, b, c, d): row and column, row only, column only, neither. Null flags are left out."""
    r, k = row.cast("boolean"), column.cast("boolean")
    cells = {"a": r & k, "b": r & ~k, "c": ~r & k, "d": ~r & ~k}
    return df.groupBy(*group).agg(*(F.count_if(x).alias(n) for n, x in cells.items()))


def eligible(genes: Column, allowed: Column) -> Column:
    """Any of an item's groups is eligible."""
    return F.arrays_overlap(genes, allowed)


def estimability(df: DataFrame, group: Sequence[str], row: Column, column: Column, empty: str, one_column: str, one_row: str) -> DataFrame:
    """(group, reason): the first rule that a group fails, empty text if it can be estimated."""
    n = df.groupBy(*group).agg(F.count("*").alias("_n"), F.countDistinct(row).alias("_r"), F.countDistinct(column).alias("_k"))
    reason = F.when(F.col("_n") == 0, empty).when(F.col("_k") < 2, one_column).when(F.col("_r") < 2, one_row).otherwise("")
    return n.select(*group, reason.alias("reason"))


def range_overlap(df: DataFrame, group: Sequence[str], flag: str, score: str, least: float = 0.1) -> DataFrame:
    """(group, overlap_low, overlap_high, overlap_fraction, overlap_warning) of the score ranges of flag = 1 and 0."""
    by = lambda f, v: f(F.when(F.col(flag) == v, F.col(score)))
    s = df.groupBy(*group).agg(
        by(F.min, 1).alias("l1"), by(F.max, 1).alias("h1"), by(F.min, 0).alias("l0"), by(F.max, 0).alias("h0"), F.min(score).alias("lo"), F.max(score).alias("hi")
    )
    both = F.col("l1").isNotNull() & F.col("l0").isNotNull()
    low, high = F.when(both, F.greatest("l1", "l0")), F.when(both, F.least("h1", "h0"))
    span = F.col("hi") - F.col("lo")
    s = s.withColumns({"overlap_low": low, "overlap_high": high})  # greatest and least pass over nulls
    share = F.when(both & (span > 0), F.greatest(F.col("overlap_high") - F.col("overlap_low"), F.lit(0.0)) / span)
    return s.select(*group, "overlap_low", "overlap_high", share.alias("overlap_fraction"), F.coalesce(share < least, F.lit(False)).alias("overlap_warning"))
