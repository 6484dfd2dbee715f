"""Set membership as bit masks: one row per item instead of one per (item, member)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_MEMBERS = 63  # the sign bit stays clear


def _bits(members: Sequence[str]) -> list[tuple[str, int]]:
    if not 0 < len(members) <= MOST_MEMBERS or len(set(members)) != len(members):
        raise ValueError(f"members must be 1 to {MOST_MEMBERS} distinct names")
    return [(m, 1 << k) for k, m in enumerate(members)]


def mask_of_array(values: Column, members: Sequence[str]) -> Column:
    """Mask of the members in an array column; others are ignored."""
    parts = [F.when(F.array_contains(values, m), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")) for m, bit in _bits(members)]
    return reduce(lambda a, b: a + b, parts)


def mask_of_text(text: Column | str, members: Sequence[str], separator: str = ",") -> Column:
    """Mask of the members in separated text, items trimmed."""
    t = F.col(text) if isinstance(text, str) else text
    return mask_of_array(F.transform(F.split(t, f"[{separator}]"), lambda x: F.trim(x)), members)


def member_bit(member: Column | str, members: Sequence[str]) -> Column:
    m = F.col(member) if isinstance(member, str) else member
    out = F.lit(None).cast("long")
    for name, bit in reversed(_bits(members)):
        out = F.when(m == name, F.lit(bit).cast("long")).otherwise(out)
    return out


def membership_mask(df: DataFrame, key: str | Sequence[str], member: str, members: Sequence[str]) -> DataFrame:
    """(key, mask): the members that an item occurs with."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.coalesce(F.bit_or(member_bit(member, members)), F.lit(0)).cast("long").alias("mask"))


def mask_histogram(masks: DataFrame, *dims: str) -> DataFrame:
    """(dims, mask, items): number of items of each combination."""
    return masks.groupBy(*dims, "mask").agg(F.count("*").alias("items"))


def decoded(masks: DataFrame, members: Sequence[str], mask: str = "mask") -> DataFrame:
    """One row per mask row and member that it holds, as ``member``."""
    table = F.array(*(F.struct(F.lit(m).alias("member"), F.lit(bit).cast("long").alias("bit")) for m, bit in _bits(members)))
    held = F.filter(table, lambda x: F.col(mask).bitwiseAND(x["bit"]) != 0)
    return masks.withColumn("_m", F.explode(held)).select("*", F.col("_m.member").alias("member")).drop("_m")


def member_counts(histogram: DataFrame, members: Sequence[str]) -> DataFrame:
    """(member, items, unique_items): items of each member, and those that no other member has."""
    alone = F.sum(F.when(F.bit_count("mask") == 1, F.col("items")).otherwise(0))
    return decoded(histogram, members).groupBy("member").agg(F.sum("items").alias("items"), alone.alias("unique_items"))


def mask_totals(histogram: DataFrame, members: Sequence[str]) -> DataFrame:
    """One row: items, items in all members, and the sum of memberships."""
    full = (1 << len(members)) - 1
    return histogram.agg(
        F.sum("items").alias("items"),
        F.coalesce(F.sum(F.when(F.col("mask") == full, F.col("items"))), F.lit(0)).alias("items_in_all"),
        F.sum(F.bit_count("mask") * F.col("items")).cast("long").alias("memberships"),
    )


def pairwise_overlap(histogram: DataFrame, members: Sequence[str]) -> DataFrame:
    """(member_a, member_b, intersection, union_items, jaccard) for a <= b; jaccard 0 for an empty union.

    Works on the histogram, whose rows are at most the combinations that occur.
    """
    pairs = [(a, x, b, y) for i, (a, x) in enumerate(_bits(members)) for b, y in _bits(members)[i:]]
    table = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(x).cast("long").alias("x"), F.lit(b).alias("b"), F.lit(y).cast("long").alias("y")) for a, x, b, y in pairs))
    rows = histogram.withColumn("p", F.explode(table))
    has_a, has_b = F.col("mask").bitwiseAND(F.col("p.x")) != 0, F.col("mask").bitwiseAND(F.col("p.y")) != 0
    out = rows.groupBy(F.col("p.a").alias("member_a"), F.col("p.b").alias("member_b")).agg(
        F.sum(F.when(has_a & has_b, F.col("items")).otherwise(0)).alias("intersection"),
        F.sum(F.when(has_a | has_b, F.col("items")).otherwise(0)).alias("union_items"),
    )
    share = F.when(F.col("union_items") > 0, F.col("intersection") / F.col("union_items")).otherwise(F.lit(0.0))
    return out.withColumn("jaccard", F.round(share, 9))


def status_masks(df: DataFrame, key: Sequence[str], member: str, members: Sequence[str], status: str, first: str, second: str) -> DataFrame:
    """(key, first mask, second mask without first, conflicts): members by status, ``first`` taking precedence."""
    bit = member_bit(member, members)
    m = df.groupBy(*key).agg(
        F.coalesce(F.bit_or(F.when(F.col(status) == first, bit)), F.lit(0)).cast("long").alias(f"{first}_mask"),
        F.coalesce(F.bit_or(F.when(F.col(status) == second, bit)), F.lit(0)).cast("long").alias("_second"),
    )
    a, b = F.col(f"{first}_mask"), F.col("_second")
    return m.withColumns({
        f"{second}_mask": b.bitwiseAND(F.bitwise_not(a)),
        "conflicts": F.bit_count(a.bitwiseAND(b)).cast("long"),
    }).drop("_second")


def mask_excludes(mask: Column | str, banned: int | Column) -> Column:
    """No banned bit is set."""
    m = F.col(mask) if isinstance(mask, str) else mask
    return m.bitwiseAND(banned if isinstance(banned, Column) else F.lit(banned).cast("long")) == 0


def not_covered(left: DataFrame, right: DataFrame, on: Sequence[str], left_mask: str, right_mask: str) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks or whose mask it does not cover."""
    other = right.select(*on, F.col(right_mask).alias("_covering"))
    covered = F.col("_covering").bitwiseAND(F.col(left_mask)) == F.col(left_mask)
    return left.join(other, list(on), "left").where(F.col("_covering").isNull() | ~covered).drop("_covering")
