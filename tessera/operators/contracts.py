"""Integrity rules that fail a query, reconciliation of evidence, and joins of a declared cardinality."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class DataContractError(ValueError):
    """A table breaks one of its rules; the message holds a few offending rows."""


@dataclass(frozen=True)
class Check:
    """A rule by the rows that break it. ``run`` reads ``sample`` of them at most."""

    name: str
    violations: DataFrame
    sample: int = 10

    def run(self) -> None:
        rows = self.violations.limit(self.sample).collect()
        if rows:
            raise DataContractError(f"{self.name}: {len(rows)}{'+' if len(rows) == self.sample else ''} rows, such as {rows[0].asDict()}")


def run_all(*checks: Check) -> None:
    for c in checks:
        c.run()


def assert_schema(df: DataFrame, expected: StructType, mode: str = "exact") -> DataFrame:
    """exact: same names, order and types; superset: the expected columns are there with their types."""
    have, want = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in expected]
    bad = have != want if mode == "exact" else bool(set(want) - set(have))
    if bad:
        raise DataContractError(f"schema ({mode}): expected {want}, found {have}")
    return df


def row_count(name: str, df: DataFrame, expected: int) -> Check:
    return Check(f"{name} has {expected} rows", df.agg(F.count("*").alias("rows")).where(F.col("rows") != expected))


def unique(name: str, df: DataFrame, keys: Sequence[str]) -> Check:
    return Check(f"{name} is unique by {list(keys)}", df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1"))


def holds(name: str, df: DataFrame, rule: Column) -> Check:
    """Every row satisfies ``rule``; null counts as broken."""
    return Check(name, df.where(~F.coalesce(rule, F.lit(False))))


def references(name: str, child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> Check:
    """Every child has a parent (orphan detection)."""
    return Check(name, child.join(parent.select(*keys), list(keys), "left_anti"))


def same_keys(name: str, left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Check:
    """Both sides have the same key set; violations tell the side that has the extra key."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    extra = a.join(b, list(keys), "left_anti").withColumn("only_in", F.lit("left"))
    missing = b.join(a, list(keys), "left_anti").withColumn("only_in", F.lit("right"))
    return Check(name, extra.unionByName(missing))


def disjoint(name: str, left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Check:
    return Check(name, left.select(*keys).join(right.select(*keys), list(keys), "left_semi"))


def subset(name: str, inner: DataFrame, outer: DataFrame, keys: Sequence[str]) -> Check:
    return Check(name, inner.select(*keys).distinct().join(outer.select(*keys), list(keys), "left_anti"))


def one_outcome(name: str, accepted: DataFrame, outcomes: DataFrame, keys: Sequence[str]) -> Check:
    """Every accepted key has exactly one terminal outcome."""
    n = accepted.select(*keys).distinct().join(outcomes.groupBy(*keys).agg(F.count("*").alias("n")), list(keys), "left")
    return Check(name, n.where(F.coalesce("n", F.lit(0)) != 1))


def consecutive(name: str, df: DataFrame, group: Sequence[str], number: str, first: int = 1) -> Check:
    """Numbers run from ``first`` without gaps in each group; needs no order, so no window."""
    n = df.groupBy(*group).agg(F.min(number).alias("low"), F.max(number).alias("high"), F.countDistinct(number).alias("n"))
    return Check(name, n.where((F.col("low") != first) | (F.col("high") - F.col("low") + 1 != F.col("n"))))


def reconcile(df: DataFrame, key: Sequence[str], fields: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Per key, each field's only non-empty value with ``<field>_conflict``; numeric fields are cast to
    double with ``<field>_invalid``, the number of texts that are no number.

    Empty text means absent.
    """
    aggs: list[Column] = []
    for f in fields:
        v = F.nullif(F.col(f).cast("string"), F.lit(""))
        if f in numeric:
            n = v.try_cast("double")
            aggs += [
                F.max(n).alias(f),
                F.coalesce(F.min(n) != F.max(n), F.lit(False)).alias(f"{f}_conflict"),
                F.count_if(v.isNotNull() & n.isNull()).alias(f"{f}_invalid"),
            ]
        else:
            aggs += [F.max(v).alias(f), F.coalesce(F.min(v) != F.max(v), F.lit(False)).alias(f"{f}_conflict")]
    return df.groupBy(*key).agg(*aggs)


def reconciled(df: DataFrame, key: Sequence[str], fields: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """``reconcile`` that fails on conflicts and on texts that are no number, and returns the plain fields."""
    out = reconcile(df, key, fields, numeric)
    broken = F.lit(False)
    for f in fields:
        broken = broken | F.col(f"{f}_conflict")
        if f in numeric:
            broken = broken | (F.col(f"{f}_invalid") > 0)
    Check("evidence agrees", out.where(broken)).run()
    return out.select(*key, *fields)


def join_checked(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", cardinality: str = "m:1") -> DataFrame:
    """A join whose sides are first checked to be unique by ``on`` where the cardinality (1:1, m:1, 1:m, m:m) says so."""
    a, b = cardinality.split(":")
    run_all(*([unique("left side", left, on)] if a == "1" else []), *([unique("right side", right, on)] if b == "1" else []))
    return left.join(right, list(on), how)


def split_lookup(requests: DataFrame, records: DataFrame, on: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of a cache probe; different values for one key are an error."""
    distinct = records.select(*on, value).distinct()
    unique("cached records", distinct, on).run()
    return requests.join(distinct, list(on)), requests.join(distinct, list(on), "left_anti")
