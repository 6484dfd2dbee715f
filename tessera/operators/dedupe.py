"""Deduplication, compaction and deterministic choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.labels import set_items
from tessera.operators.contracts import Check, holds
from tessera.storage import scratch


def first_by(df: DataFrame, key: Sequence[str], *priority: Column | str) -> DataFrame:
    """One whole row per key: the least by ``priority``, then by all columns, so the choice is total.

    Aggregates on the map side, unlike a window.
    """
    order = [F.col(p) if isinstance(p, str) else p for p in priority]
    rest = [F.col(c) for c in df.columns]
    best = F.min_by(F.struct(*rest), F.struct(*(o.alias(f"_{i}") for i, o in enumerate([*order, *rest]))))
    return df.groupBy(*key).agg(best.alias("_row")).select("_row.*")


def top_k(df: DataFrame, group: Sequence[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each group; Spark prunes groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def hash_sample(df: DataFrame, group: str, key: str, k: int, seed: str = "0") -> DataFrame:
    """Deterministic top k of each group by md5(seed|group|key), with ``sample_rank``."""
    h = F.md5(F.concat_ws("|", F.lit(seed), F.col(group).cast("string"), F.col(key).cast("string")).cast("binary"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(h, key))
    return df.withColumn("sample_rank", rank).where(F.col("sample_rank") <= k)


def occurrence(df: DataFrame, key: Sequence[str], *order: str, out: str = "occurrence") -> DataFrame:
    """Numbers equal keys from 1 in the given order."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def dense_index(df: DataFrame, *order: str, out: str) -> DataFrame:
    """Numbers rows from 1 in the given order, which must be total, without one task for all of them.

    A range sort gives each row its partition and place in it; the partitions' sizes, one row
    per partition, give the offsets. The sorted table is written once, so both see the same rows.
    """
    placed = scratch(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, F.col("_before") + place + 1).drop("_part", "_before", "_at")


def accept_first(df: DataFrame, value: str, position: str) -> DataFrame:
    """Keeps all rows: accepted (first of its value), accepted_index, duplicate_of_index (the first's).

    Indexes number accepted rows by position.
    """
    numbered = dense_index(df.groupBy(value).agg(F.min(position).alias("_first")), "_first", out="_index")
    both = df.join(numbered, value)
    accepted = F.col(position) == F.col("_first")
    return both.select(
        *df.columns, accepted.alias("accepted"),
        F.when(accepted, F.col("_index")).alias("accepted_index"), F.when(~accepted, F.col("_index")).alias("duplicate_of_index"),
    )


def conflict_free(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct rows; a key with two different rows is an error."""
    distinct = df.distinct()
    Check("rows of a key agree", distinct.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")).run()
    return distinct


def compact_events(
    raw: DataFrame, event: Sequence[str], observer: str, attributes: Sequence[str], flags: str | None, order: Sequence[str], partition: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(events with consecutive ``event_id``, support with one row per event and observer).

    Support holds the first non-empty attributes in ``order``, the union of flags and the row count.
    """
    place = F.struct(*order)
    filled = lambda c: F.min_by(F.nullif(F.col(c), F.lit("")), F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), place))
    aggs = [F.count("*").alias("rows"), *(filled(a).alias(a) for a in attributes)]
    if flags:
        items = F.flatten(F.collect_set(F.split(F.coalesce(F.col(flags), F.lit("")), "[,|]")))
        clean = F.array_sort(F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")))
        aggs.append(F.array_join(clean, "|").alias(flags))
    support = raw.groupBy(*event, observer).agg(*aggs)
    events = support.groupBy(*event).agg(F.countDistinct(observer).alias("observers"), F.sum("rows").alias("rows"))
    if partition:
        number = F.row_number().over(Window.partitionBy(*partition).orderBy(*event))
        events = events.withColumn("event_id", number.cast("long"))
    else:
        events = dense_index(events, *event, out="event_id")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in event]
    keyed = support.alias("s").join(events.select(*event, "event_id").alias("e"), same).select("e.event_id", *(f"s.{c}" for c in support.columns if c not in event))
    return events, keyed


def latest(df: DataFrame, key: Sequence[str], *order: str) -> DataFrame:
    """Last writer wins by an explicit order."""
    best = F.max_by(F.struct(*df.columns), F.struct(*order, *(c for c in df.columns if c not in order)))
    return df.groupBy(*key).agg(best.alias("_row")).select("_row.*")


def append_new(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """The incoming rows whose key is not there yet, one per key."""
    return first_by(incoming, key).join(existing.select(*key), list(key), "left_anti")


def refresh_plan(needed: DataFrame, present: DataFrame, forced: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys to fetch: needed ones that are not present, counting forced ones as not present."""
    usable = present.select(*key).join(forced.select(*key), list(key), "left_anti")
    return needed.select(*key).distinct().join(usable, list(key), "left_anti")


def distinct_requests(rows: DataFrame, key: str, listed: str, valid: Column, out: str, separator: str = "|") -> DataFrame:
    """Distinct (key, ``out``) of the items in separated text; a row whose key is not ``valid`` is an error."""
    holds("requests have a valid key", rows, valid).run()
    return rows.select(key, F.explode(set_items(listed, separator)).alias(out)).distinct()


def alias_lookup(requests: DataFrame, records: DataFrame, on: str, aliases: str, value: str, *order: str) -> DataFrame:
    """``requests`` (with column ``on``) and the value of the record that has it among its ``aliases``; of several the
    last by ``order`` counts, of equal ones the largest value."""
    each = records.select(F.explode(aliases).alias(on), value, *order).where(F.col(on).isNotNull())
    best = each.groupBy(on).agg(F.max(F.struct(*order, value)).getField(value).alias(value))
    return requests.join(best, on, "left")
