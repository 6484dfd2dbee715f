"""Aggregations beyond ``groupBy``: exact quantiles, threshold curves, histograms, grids, compactions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sorted_distinct(value: Column | str, separator: str = "|", where: Column | None = None) -> Column:
    """Aggregate: distinct non-empty texts, sorted and joined. (``listagg`` with FILTER is not usable.)"""
    v = F.col(value) if isinstance(value, str) else value
    v = F.nullif(v, F.lit(""))
    return F.array_join(F.array_sort(F.collect_set(v if where is None else F.when(where, v))), separator)


def quantiles(value: Column | str, points: Sequence[float], where: Column | None = None, frequency: Column | None = None) -> Column:
    """Aggregate: exact linear-interpolation quantiles as an array, optionally filtered or weighted."""
    v = F.col(value) if isinstance(value, str) else value
    v = v if where is None else F.when(where, v)
    at = F.array(*(F.lit(float(p)) for p in points))
    return F.percentile(v, at) if frequency is None else F.percentile(v, at, frequency)


def lower_quantiles(df: DataFrame, group: Sequence[str], value: str, weight: str, points: Sequence[float]) -> DataFrame:
    """(group, point, value): the least value whose cumulated weight reaches point * total; no interpolation."""
    w = df.groupBy(*group, value).agg(F.sum(weight).alias("_w")).where("_w > 0")
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    run = w.withColumns({"_cum": F.sum("_w").over(part.orderBy(value)), "_total": F.sum("_w").over(part)})
    at = run.withColumn("point", F.explode(F.array(*(F.lit(float(p)) for p in points))))
    return at.where(F.col("_cum") >= F.col("point") * F.col("_total") - 1e-9).groupBy(*group, "point").agg(F.min(value).alias(value))


def boundary_bin(value: Column | str, boundaries: Column) -> Column:
    """How many boundaries are below the value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.size(F.filter(boundaries, lambda b: b < v))


def heatmap(df: DataFrame, group: Sequence[str], x: str, y: str, weight: str, hit: str, bins: int) -> DataFrame:
    """(group, x_bin, y_bin, eligible, found): both axes cut at weighted lower quantiles."""
    points = [k / bins for k in range(1, bins)]

    def cuts(c: str) -> DataFrame:
        q = lower_quantiles(df.select(*group, c, weight), group, c, weight, points)
        return q.groupBy(*group).agg(F.array_sort(F.collect_set(c)).alias(f"_{c}"))

    rows = df
    for c in (x, y):
        rows = rows.join(cuts(c), list(group)) if group else rows.crossJoin(F.broadcast(cuts(c)))  # one row
    cells = rows.withColumns({"x_bin": boundary_bin(x, F.col(f"_{x}")), "y_bin": boundary_bin(y, F.col(f"_{y}"))})
    return cells.groupBy(*group, "x_bin", "y_bin").agg(F.sum(weight).alias("eligible"), F.sum(F.when(F.col(hit), F.col(weight)).otherwise(0)).alias("found"))


def threshold_curve(
    df: DataFrame, group: Sequence[str], score: str, direction: str = "min", start: int = 1, weight: str | None = None, also: dict[str, Column] | None = None
) -> DataFrame:
    """(group, threshold, retained, total) over the dense integer grid start .. max + 1.

    ``min`` keeps score >= threshold, ``max`` keeps score <= threshold. Null scores never pass, but
    count in the total. ``also`` adds columns that sum further weights over what is retained.
    """
    w = F.col(weight) if weight else F.lit(1)
    sums = {"retained": w, **(also or {})}
    total = df.groupBy(*group).agg(F.sum(w).alias("total"), F.max(score).alias("_top"))
    known = df.where(F.col(score).isNotNull())
    counts = known.groupBy(*group, F.col(score).cast("long").alias("threshold")).agg(*(F.sum(v).alias(n) for n, v in sums.items()))
    low = F.lit(start).cast("long")
    grid = total.where("_top is not null").select(*group, F.explode(F.sequence(low, F.greatest(F.col("_top") + 1, low).cast("long"))).alias("threshold"))
    # scores outside the grid still add to the running sums
    cells = counts.unionByName(grid.withColumns({n: F.lit(0) for n in sums})).groupBy(*group, "threshold").agg(*(F.sum(n).alias(n) for n in sums))
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    along = part.orderBy(F.desc("threshold") if direction == "min" else F.asc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    run = cells.withColumns({n: F.sum(n).over(along) for n in sums}).where(F.col("threshold") >= start)
    totals = total.drop("_top")
    run = run.join(totals, list(group)) if group else run.crossJoin(F.broadcast(totals))  # one row
    return run.select(*group, "threshold", *sums, "total")


def change_points(df: DataFrame, group: Sequence[str], score: str, direction: str = "min") -> DataFrame:
    """(group, threshold): where a curve changes: score + 1 for minimum filters, score for maximum ones."""
    step = F.col(score) + 1 if direction == "min" else F.col(score)
    return df.where(F.col(score).isNotNull()).select(*group, step.cast("long").alias("threshold")).distinct()


def contingency_curve(df: DataFrame, group: Sequence[str], score: str, label: Column, direction: str = "min") -> DataFrame:
    """2x2 counts at each change point: a, b pass with and without the label, c, d do not.

    Two running sums per group; each row is read once.
    """
    marked = df.withColumn("_label", F.coalesce(label.cast("int"), F.lit(0)))
    total = marked.groupBy(*group).agg(F.sum("_label").alias("_p"), F.sum(1 - F.col("_label")).alias("_q"))
    shift = 1 if direction == "min" else 0
    known = marked.where(F.col(score).isNotNull())
    at = known.select(*group, (F.col(score) + shift).cast("long").alias("threshold")).distinct().withColumns({"_a": F.lit(0), "_b": F.lit(0)})
    own = known.groupBy(*group, F.col(score).cast("long").alias("threshold")).agg(F.sum("_label").alias("_a"), F.sum(1 - F.col("_label")).alias("_b"))
    cells = own.unionByName(at).groupBy(*group, "threshold").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    along = Window.partitionBy(*group).orderBy(F.desc("threshold") if direction == "min" else F.asc("threshold"))
    run = along.rowsBetween(Window.unboundedPreceding, 0)
    swept = cells.withColumns({"a": F.sum("_a").over(run), "b": F.sum("_b").over(run)})
    kept = swept.join(at.select(*group, "threshold"), [*group, "threshold"], "left_semi").join(total, list(group))
    return kept.select(*group, "threshold", "a", "b", (F.col("_p") - F.col("a")).alias("c"), (F.col("_q") - F.col("b")).alias("d"))


def with_union_row(df: DataFrame, key: Sequence[str], member: str, maxima: Sequence[str], minima: Sequence[str] = (), name: str = "union") -> DataFrame:
    """The rows and, per key, one more whose scores are the maxima (minima) over its members."""
    union = df.groupBy(*key).agg(*(F.max(c).alias(c) for c in maxima), *(F.min(c).alias(c) for c in minima)).withColumn(member, F.lit(name))
    columns = [*key, member, *maxima, *minima]
    return df.select(*columns).unionByName(union.select(*columns))


def melt_counts(df: DataFrame, dims: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(dims, metric, score, rows): long form of the metrics, nulls left out."""
    long = df.select(*dims, *(F.col(m).cast("long") for m in metrics)).unpivot(list(dims), list(metrics), "metric", "score")
    return long.where("score is not null").groupBy(*dims, "metric", "score").agg(F.count("*").alias("rows"))


def fd_edges(df: DataFrame, group: Sequence[str], value: str, most: int = 80) -> DataFrame:
    """(group, low, high, bins) by Freedman and Diaconis, at most ``most`` bins; a single value is padded."""
    part = F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)))
    s = df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*group).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("_n"), part.alias("_q")
    )
    width = 2 * (F.col("_q")[1] - F.col("_q")[0]) / F.pow(F.col("_n").cast("double"), F.lit(1 / 3))
    span = F.col("_hi") - F.col("_lo")
    same = span == 0
    pad = F.greatest(F.abs("_lo") * 0.05, F.lit(0.5))
    bins = F.when(same, 1).when(width > 0, F.least(F.ceil(span / F.when(width > 0, width)), F.lit(most))).otherwise(1)
    return s.select(
        *group, F.when(same, F.col("_lo") - pad).otherwise(F.col("_lo")).alias("low"),
        F.when(same, F.col("_hi") + pad).otherwise(F.col("_hi")).alias("high"), F.greatest(bins, F.lit(1)).cast("long").alias("bins"),
    )


def histogram(df: DataFrame, group: Sequence[str], value: str, edges: DataFrame) -> DataFrame:
    """(group, bin, left, right, rows); the last bin is closed on the right."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).join(edges, list(group)) if group else df.crossJoin(F.broadcast(edges))
    width = (F.col("high") - F.col("low")) / F.col("bins")
    at = F.least(F.floor((F.col(value) - F.col("low")) / width), F.col("bins") - 1)
    counted = rows.groupBy(*group, "low", "high", "bins", at.alias("bin")).agg(F.count("*").alias("rows"))
    return counted.select(*group, "bin", (F.col("low") + F.col("bin") * width).alias("left"), (F.col("low") + (F.col("bin") + 1) * width).alias("right"), "rows")


def box_summary(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, rows, q1, median, q3, lower_whisker, upper_whisker): whiskers are the outermost values within 1.5 IQR."""
    q = df.where(F.col(value).isNotNull()).groupBy(*group).agg(F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("_q"), F.count("*").alias("rows"))
    q = q.select(*group, "rows", *(F.col("_q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))))
    iqr = F.col("q3") - F.col("q1")
    rows = df.where(F.col(value).isNotNull()).join(q, list(group))
    return rows.groupBy(*group, "rows", "q1", "median", "q3").agg(
        F.min(F.when(F.col(value) >= F.col("q1") - 1.5 * iqr, F.col(value))).alias("lower_whisker"),
        F.max(F.when(F.col(value) <= F.col("q3") + 1.5 * iqr, F.col(value))).alias("upper_whisker"),
    )


def share_of(df: DataFrame, whole: Sequence[str], value: str, out: str = "share") -> DataFrame:
    """Each row's part of its group's sum (of the table's without groups); null for an empty sum.

    Sums are aggregated on the map side and joined back, so a large group needs no task of its own.
    """
    totals = df.groupBy(*whole).agg(F.sum(value).alias("_total"))
    if not whole:
        joined = df.crossJoin(F.broadcast(totals))  # one row
    else:
        same = totals.select(*(F.col(c).alias(f"_w_{c}") for c in whole), "_total")
        on = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in whole]
        joined = df.join(same, on).drop(*(f"_w_{c}" for c in whole))
    return joined.withColumn(out, F.when(F.col("_total") != 0, F.col(value) / F.col("_total"))).drop("_total")


def on_grid(df: DataFrame, axes: dict[str, DataFrame], values: Sequence[str]) -> DataFrame:
    """All combinations of the axes' values, missing ones as 0. Axes are small dimensions."""
    grid = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), (d.select(c).distinct() for c, d in axes.items()))
    return grid.join(df, list(axes), "left").fillna(0, list(values))


def status_counts(df: DataFrame, status: str, first: str = "ok") -> DataFrame:
    """(status, rows, share, place): the ``first`` status leads, then by falling count and name."""
    n = df.groupBy(status).agg(F.count("*").alias("rows"))
    shared = share_of(n, [], "rows")
    order = Window.orderBy((F.col(status) != first).cast("int"), F.desc("rows"), status)
    return shared.withColumn("place", F.row_number().over(order))


def mean_if_complete(df: DataFrame, key: Sequence[str], positions: str, scores: DataFrame, on: Sequence[str], pos: str, score: str) -> DataFrame:
    """Mean score over an array of positions; null as soon as one of them has none."""
    each = df.select(*dict.fromkeys([*key, *on]), F.explode_outer(positions).alias(pos))
    joined = each.join(scores.select(*on, pos, score), [*on, pos], "left")
    return joined.groupBy(*key).agg(F.when(F.count(score) == F.count("*"), F.avg(score)).alias(score))


def span_summary(df: DataFrame, group: Sequence[str], first: str, last: str) -> DataFrame:
    """The least start and the greatest end per group."""
    return df.groupBy(*group).agg(F.min(first).alias(first), F.max(last).alias(last))


def precedence(df: DataFrame, key: Sequence[str], status: str, order: Sequence[str]) -> DataFrame:
    """Per key the status that comes first in ``order``."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(status))
    rank = F.min(F.when(place > 0, place))
    return df.groupBy(*key).agg(F.get(F.array(*map(F.lit, order)), (rank - 1).cast("int")).alias(status))


def status_by_member(df: DataFrame, mask: str, members: Sequence[tuple[str, int]], statuses: Sequence[str], status: str) -> DataFrame:
    """(member, status, rows): counts of rows per set bit and status, zero-filled."""
    table = F.array(*(F.struct(F.lit(m).alias("member"), F.lit(b).cast("long").alias("bit")) for m, b in members))
    held = df.select(status, F.explode(F.filter(table, lambda x: F.col(mask).bitwiseAND(x["bit"]) != 0)).alias("m"))
    counted = held.groupBy(F.col("m.member").alias("member"), status).agg(F.count("*").alias("rows"))
    spark = df.sparkSession
    axes = {"member": spark.createDataFrame([(m,) for m, _ in members], "member string"), status: spark.createDataFrame([(s,) for s in statuses], f"{status} string")}
    return on_grid(counted, axes, ["rows"])


def ratio_with_limits(numerator: Column, denominator: Column) -> Column:
    """x/0 is infinity, 0/0 is NaN, as for transition/transversion ratios."""
    return F.when(denominator != 0, numerator / denominator).when(numerator == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))


def expected_summary(df: DataFrame, expected: DataFrame, key: str, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per expected key; keys without rows get zeros."""
    out = expected.select(key).distinct().join(df.groupBy(key).agg(*aggs), key, "left")
    return out.fillna(0)
