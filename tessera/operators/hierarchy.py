"""Distinct counts over a hierarchy: which ancestors filter (scopes) by what is counted (units)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def member_units(members: DataFrame, profiles: DataFrame, item: str, taxon: str, lineage: str, scopes: Mapping[str, str], ranks: Sequence[str], item_unit: str = "item") -> DataFrame:
    """One row per member, scope that holds it, and unit, with ``unit_id``.

    A scope is an ancestor id (empty: everything). A rank that a taxon lacks falls back to the taxon
    itself, tagged so that it cannot collide with a rank id. A member's own taxon is an ancestor.
    Members without a taxon are left out.
    """
    known = members.where(F.coalesce(F.col(taxon).cast("string"), F.lit("")) != "").join(profiles, taxon)
    ancestors = F.array_union(F.col(lineage), F.array(F.col(taxon).cast("string")))
    held = [F.when(F.lit(a == "") | F.array_contains(ancestors, a), F.lit(s)) for s, a in scopes.items()]
    own = F.concat(F.lit("taxon:"), F.col(taxon).cast("string"))
    rank_id = lambda r: F.coalesce(F.nullif(F.col(r).cast("string"), F.lit("")), own)
    units = F.array(
        F.struct(F.lit(item_unit).alias("unit"), F.col(item).cast("string").alias("unit_id")),
        *(F.struct(F.lit(r).alias("unit"), rank_id(r).alias("unit_id")) for r in ranks),
    )
    rows = known.withColumn("scope", F.explode(F.array_compact(F.array(*held)))).withColumn("_u", F.explode(units))
    return rows.select(*members.columns, "scope", F.col("_u.unit").alias("unit"), F.col("_u.unit_id").alias("unit_id"))


def distinct_counts(units: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, scope, unit, n)."""
    return units.groupBy(*group, "scope", "unit").agg(F.countDistinct("unit_id").alias("n"))


def wide_counts(counts: DataFrame, group: Sequence[str], scopes: Sequence[str], units: Sequence[str]) -> DataFrame:
    """One row per group with a column ``scope__unit`` for each pair, 0 where nothing was counted."""
    cells = [
        F.coalesce(F.max(F.when((F.col("scope") == s) & (F.col("unit") == u), F.col("n"))), F.lit(0)).alias(f"{s}__{u}") for s in scopes for u in units
    ]
    return counts.groupBy(*group).agg(*cells)


def summary(counts: DataFrame, groups: DataFrame, group: str, scopes: Sequence[str], units: Sequence[str]) -> DataFrame:
    """(scope, unit, groups, least, median, mean, most) of per-group counts, groups without any as 0."""
    table = F.array(*(F.struct(F.lit(s).alias("scope"), F.lit(u).alias("unit")) for s in scopes for u in units))
    grid = groups.select(group).distinct().withColumn("_c", F.explode(table)).select(group, "_c.scope", "_c.unit")
    full = grid.join(counts, [group, "scope", "unit"], "left").fillna(0, ["n"])
    return full.groupBy("scope", "unit").agg(
        F.count("*").alias("groups"), F.min("n").alias("least"), F.percentile("n", 0.5).alias("median"), F.avg("n").alias("mean"), F.max("n").alias("most")
    )


def evidence_histogram(sites: DataFrame, dims: Sequence[str], pairs: Sequence[tuple[str, str, str]], status: str, statuses: Sequence[str]) -> DataFrame:
    """(dims, counter, n_site, n_alt, one count per status) from wide (counter, site column, alt column) pairs; n_site = 0 is dropped."""
    cells = F.array(*(F.struct(F.lit(c).alias("counter"), F.col(s).alias("n_site"), F.col(a).alias("n_alt")) for c, s, a in pairs))
    long = sites.select(*dims, status, F.explode(cells).alias("_c")).select(*dims, status, "_c.*").where("n_site > 0")
    return long.groupBy(*dims, "counter", "n_site", "n_alt").agg(*(F.count_if(F.col(status) == s).alias(s) for s in statuses))


def is_under(lineage: Column | str, ancestor: str) -> Column:
    """Ancestor test on a lineage array."""
    return F.array_contains(F.col(lineage) if isinstance(lineage, str) else lineage, ancestor)
