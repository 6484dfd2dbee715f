"""Interval algebra on (group, start, end) rows, half-open unless said otherwise.

All of it is windows and equi-joins. Joins by place go through tiles: both sides meet on group and tile, so the work of a
group, however large, spreads over its tiles and grows with what overlaps. Tiles are about as wide as the spans are on average
(``tile_width``, one small aggregation), unless the caller names a width. These joins sort and merge: rows that an explosion
makes are not in Spark's estimate of a side, so a side that looks small enough for a broadcast can be far too large for the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Mean lengths in a stretch that merges in a task of its own.
CHUNK = 64


def tile_width(*sides: tuple[DataFrame, str, str]) -> int:
    """The mean length of the sides' spans, at least 1."""
    total = n = 0
    for df, start, end in sides:
        row = df.agg(F.sum(F.greatest(F.col(end) - F.col(start), F.lit(0))).alias("t"), F.count(start).alias("n")).first()
        total, n = total + (row["t"] or 0), n + row["n"]
    return max(1, int(total / max(1, n)))


def _before(group: Sequence[str], *order: str):
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _upto(group: Sequence[str], *order: str):
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def merge(
    df: DataFrame, group: Sequence[str], start: str = "start", end: str = "end", gap: int = 0, closed: bool = False, chunk: int | None = None,
    unplaced: bool = False,
) -> DataFrame:
    """Gaps and islands: (group, start, end, members) of merged intervals.

    Half-open intervals that touch merge; ``gap`` bridges that much more. ``closed`` intervals
    merge when adjacent (start <= end + 1). Intervals that start in the same stretch of width
    ``chunk`` (by default ``CHUNK`` mean lengths; 0: no stretches) merge first, each stretch in a task of its own; a group that holds a large part of all
    rows then reaches the last window as few islands. Rows without a start or an end are left out; ``unplaced`` keeps each as an
    island of its own.
    """
    slack = gap + (1 if closed else 0)
    every = df.select(*group, start, end).withColumn("members", F.lit(1).cast("long"))
    placed = F.col(start).isNotNull() & F.col(end).isNotNull()
    rows = every.where(placed)
    if chunk is None:
        chunk = CHUNK * tile_width((rows, start, end))
    if chunk:
        stretched = rows.withColumn("_chunk", F.floor(F.col(start) / chunk))
        rows = _islands(stretched, [*group, "_chunk"], start, end, slack).drop("_chunk")
    merged = _islands(rows, group, start, end, slack)
    return merged.unionByName(every.where(~placed)) if unplaced else merged


def _islands(rows: DataFrame, group: Sequence[str], start: str, end: str, slack: int) -> DataFrame:
    reach = F.max(end).over(_before(group, start, end)) + slack
    marked = rows.withColumn("_first", F.coalesce((F.col(start) > reach).cast("int"), F.lit(1)))
    island = marked.withColumn("_island", F.sum("_first").over(_upto(group, start, end)))
    return (
        island.groupBy(*group, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("members").alias("members")).drop("_island")
    )


def union_length(df: DataFrame, group: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(group, covered, intervals, total): merged length, number of rows, summed length.

    As in SQL, the merged length is null for a null group and where no row has both a start and an end.
    """
    total = df.groupBy(*group).agg(F.count("*").alias("intervals"), F.sum(F.col(end) - F.col(start)).alias("total"))
    covered = merge(df, group, start, end).groupBy(*group).agg(F.sum(F.col(end) - F.col(start)).alias("covered"))
    return total.join(covered, list(group), "left").select(*group, "covered", "intervals", "total")


def depth(df: DataFrame, group: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Sweep line: (group, start, end, depth) of elementary intervals with depth above 0."""
    edges = df.select(*group, F.explode(F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
    )).alias("e")).groupBy(*group, F.col("e.at").alias("at")).agg(F.sum("e.step").alias("step"))
    along = Window.partitionBy(*group).orderBy("at")
    swept = edges.withColumns({
        "depth": F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)),
        "next": F.lead("at").over(along),
    })
    return swept.where((F.col("depth") > 0) & F.col("next").isNotNull()).select(*group, F.col("at").alias(start), F.col("next").alias(end), "depth")


def distinct_depth(df: DataFrame, group: Sequence[str], item: str, start: str = "start", end: str = "end") -> DataFrame:
    """Depth where each item counts once, however many of its intervals overlap."""
    return depth(merge(df, [*group, item], start, end), group, start, end)


def gaps(df: DataFrame, group: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(group, start, end) between merged intervals."""
    merged = merge(df, group, start, end)
    after = F.lead(start).over(Window.partitionBy(*group).orderBy(start))
    return merged.select(*group, F.col(end).alias(start), after.alias(end)).where(F.col(end).isNotNull())


def subtract(base: DataFrame, cut: DataFrame, group: Sequence[str], start: str = "start", end: str = "end", width: int | None = None) -> DataFrame:
    """What is left of each base interval without the cut ones; base columns stay, and so do repeated rows."""
    own = list(base.columns)
    rows = base.groupBy(*own).agg(F.count("*").alias("_copies"))
    holes = merge(cut, group, start, end).select(*group, F.col(start).alias("_s"), F.col(end).alias("_e"))
    width = width or tile_width((base, start, end), (cut, start, end))
    met = range_join(rows, holes, (start, end), ("_s", "_e"), width, group).where((F.col("_s") < F.col(end)) & (F.col("_e") > F.col(start)))
    met = met.select(*own, "_copies", "_s", "_e")
    # an edge of nothing ends each interval, so that the last piece needs no second look
    tail = rows.select(*own, "_copies", F.col(end).alias("_s"), F.col(end).alias("_e"))
    by_row = Window.partitionBy(*own).orderBy("_s", "_e")
    left = met.unionByName(tail).withColumns({
        "_from": F.greatest(F.col(start), F.coalesce(F.lag("_e").over(by_row), F.col(start))), "_to": F.least(F.col(end), F.col("_s")),
    }).where("_from < _to").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
    return left.withColumns({start: F.col("_from"), end: F.col("_to")}).select(*own)


def contained(
    points: DataFrame, intervals: DataFrame, group: Sequence[str], pos: str, start: str = "start", end: str = "end", how: str = "left", closed: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Joins points with the intervals of their group that hold them; with disjoint intervals at most one."""
    width = width or tile_width((intervals, start, end))
    other = intervals.select(*(F.col(c).alias(f"_g_{c}") if c in group else F.col(c) for c in intervals.columns))
    other = other.where(F.col(start) <= F.col(end)).withColumn("_g_tile", F.explode(tiles(F.col(start), F.col(end), width)))
    on = (F.col(pos) >= F.col(start)) & (F.col(pos) <= F.col(end) if closed else F.col(pos) < F.col(end)) & (F.col("_tile") == F.col("_g_tile"))
    for g in group:
        on = on & (F.col(g) == F.col(f"_g_{g}"))
    found = points.withColumn("_tile", F.floor(F.col(pos) / width)).join(other.hint("merge"), on, how)
    return found.drop("_tile", "_g_tile", *(f"_g_{g}" for g in group))


def asof(left: DataFrame, right: DataFrame, group: Sequence[str], at: str, values: Sequence[str], until: str | None = None, default: str | None = None) -> DataFrame:
    """Adds the values of the last right row at or before ``at`` in the group, by one union and one window.

    With ``until`` the match counts only before that right column's value; ``default`` fills misses.
    Of right rows at the same place the largest values win.
    """
    columns = [*values, *([until] if until else [])]
    payload = F.struct(F.col(at).alias("_at"), *(F.col(c).alias(f"_{c}") for c in columns))
    r = right.where(F.col(at).isNotNull()).groupBy(*group, at).agg(F.max(payload).alias("_p"))
    both = left.withColumn("_left", F.lit(1)).unionByName(r.withColumn("_left", F.lit(0)), allowMissingColumns=True)
    along = Window.partitionBy(*group).orderBy(at, "_left").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_p", F.last("_p", ignorenulls=True).over(along)).where("_left = 1")
    ok = F.col("_p").isNotNull()
    if until:
        ok = ok & (F.col(at) < F.col(f"_p._{until}"))
    out = {v: F.when(ok, F.col(f"_p._{v}")) for v in values}
    if default is not None:
        out = {v: F.coalesce(c, F.lit(default)) for v, c in out.items()}
    return found.withColumns(out).drop("_p", "_left")


def tiles(start: Column, end: Column, width: int) -> Column:
    """The tiles that a closed span touches."""
    return F.sequence(F.floor(start / width), F.floor(end / width))


def range_join(
    left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], width: int, on: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Overlap join of closed spans without a nested loop.

    Both sides go into tiles of ``width``, meet by equi-join on tile (and ``on``), and a pair
    comes out only in the tile that holds the later start. ``how`` is inner, left_semi or left_anti, by the distinct spans of the left side;
    spans that end before they start meet nothing. Column names other than ``on`` must differ.
    """
    (ls, le), (rs, re) = left_span, right_span
    if how != "inner":
        spans = left.select(*on, ls, le).distinct()
        hit = range_join(spans, right.select(*on, rs, re), left_span, right_span, width, on).select(*on, ls, le).distinct()
        return left.join(hit, [*on, ls, le], how).select(*left.columns)
    a = left.where(F.col(ls) <= F.col(le)).withColumn("_tile", F.explode(tiles(F.col(ls), F.col(le), width)))
    b = right.where(F.col(rs) <= F.col(re)).withColumn("_tile", F.explode(tiles(F.col(rs), F.col(re), width)))
    met = a.join(b.hint("merge"), ["_tile", *on]).where(
        (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) & (F.floor(F.greatest(ls, rs) / width) == F.col("_tile"))
    )
    return met.drop("_tile")


def exists_in(points: DataFrame, spans: DataFrame, group: str, pos: str, start: str = "start", end: str = "end", flag: str = "hit") -> DataFrame:
    """Adds whether any closed span of the group holds the point.

    Spans are merged first, so a point matches one at most and no row multiplies.
    """
    merged = merge(spans, [group], start, end, closed=True).select(group, F.col(start).alias("_s"), F.col(end).alias("_e"))
    joined = contained(points, merged, [group], pos, "_s", "_e", "left", closed=True)
    return joined.withColumn(flag, F.col("_s").isNotNull()).drop("_s", "_e")


def coverage(features: DataFrame, segments: DataFrame, group: Sequence[str], item: str, feature_id: str, start: str = "start", end: str = "end") -> DataFrame:
    """Per feature: covered length, depth length, breadth, mean depth, distinct items covering it."""
    own = merge(segments, [*group, item], start, end).select(*group, item, F.col(start).alias("_s"), F.col(end).alias("_e"))
    spans = features.select(*group, feature_id, start, end)
    width = tile_width((spans, start, end), (own, "_s", "_e"))
    # lengths add up over tiles, so each tile clips, sorts and sums its own part; the tile of the later start keeps what has no length
    a, b = ((df.where(F.col(s) <= F.col(e)).withColumn("_tile", F.explode(tiles(F.col(s), F.col(e), width)))) for df, s, e in ((spans, start, end), (own, "_s", "_e")))
    hit = a.join(b.hint("merge"), ["_tile", *group]).where((F.col("_s") < F.col(end)) & (F.col("_e") > F.col(start)))
    later = F.floor(F.greatest(start, "_s") / width) == F.col("_tile")
    clipped = hit.withColumns({
        "_from": F.greatest("_s", start, F.col("_tile") * width), "_to": F.least("_e", end, (F.col("_tile") + 1) * width),
    }).where((F.col("_from") < F.col("_to")) | later)
    key = [*group, feature_id]
    reach = F.max("_to").over(_before([*key, "_tile"], "_from", "_to"))
    pieces = clipped.select(
        *key, item, F.greatest(F.col("_to") - F.col("_from"), F.lit(0)).alias("_length"),
        F.greatest(F.col("_to") - F.greatest(F.col("_from"), reach), F.lit(0)).alias("_new"),
    )
    lengths = pieces.groupBy(*key).agg(F.sum("_length").alias("depth_length"), F.countDistinct(item).alias("items_covering"), F.sum("_new").alias("covered"))
    out = features.join(lengths.hint("merge"), key, "left").fillna(0, ["depth_length", "items_covering", "covered"])
    length = F.col(end) - F.col(start)
    return out.withColumns({
        "breadth": F.when(length > 0, F.col("covered") / length).otherwise(0.0),
        "mean_depth": F.when(length > 0, F.col("depth_length") / length).otherwise(0.0),
    })


def depth_at(sites: DataFrame, segments: DataFrame, group: Sequence[str], item: str, pos: str, start: str = "start", end: str = "end") -> DataFrame:
    """Adds the number of distinct items whose segments hold the site."""
    by_depth = distinct_depth(segments, group, item, start, end).select(*group, F.col(start).alias("_s"), F.col(end).alias("_e"), "depth")
    return contained(sites, by_depth, group, pos, "_s", "_e").withColumn("depth", F.coalesce("depth", F.lit(0))).drop("_s", "_e")


def members_at(sites: DataFrame, segments: DataFrame, group: Sequence[str], item: str, pos: str, start: str = "start", end: str = "end") -> DataFrame:
    """One row per site and distinct item that holds it."""
    merged = merge(segments, [*group, item], start, end).select(*group, item, F.col(start).alias("_s"), F.col(end).alias("_e"))
    return contained(sites, merged, group, pos, "_s", "_e", "inner").drop("_s", "_e")


def priority_partition(df: DataFrame, group: Sequence[str], label: str, priority: str, start: str = "start", end: str = "end") -> DataFrame:
    """(group, start, end, label): the line cut at every boundary, each piece with its label of least priority
    value, equal neighbours joined again."""
    at = df.select(*group, F.explode(F.array(start, end)).alias("_s")).distinct()
    pieces = at.withColumn("_e", F.lead("_s").over(Window.partitionBy(*group).orderBy("_s"))).where(F.col("_e").isNotNull())
    # of one label overlapping intervals merge first, so a piece meets each label once at most
    own = merge(df, [*group, label, priority], start, end).drop("members")
    width = tile_width((own, start, end))
    met = range_join(pieces, own, ("_s", "_e"), (start, end), width, group).where((F.col(start) <= F.col("_s")) & (F.col(end) >= F.col("_e")))
    best = met.groupBy(*group, "_s", "_e").agg(F.min(F.struct(priority, label)).alias("_b")).select(*group, "_s", "_e", F.col(f"_b.{label}").alias(label))
    along = Window.partitionBy(*group).orderBy("_s")
    new = (F.lag(label).over(along) != F.col(label)) | (F.lag("_e").over(along) != F.col("_s"))
    marked = best.withColumn("_new", F.coalesce(new.cast("int"), F.lit(1)))
    island = marked.withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*group, label, "_island").agg(F.min("_s").alias(start), F.max("_e").alias(end)).drop("_island")


def gap_clusters(df: DataFrame, group: Sequence[str], at: Column | str, max_gap: float, out: str = "cluster", tie: Sequence[str] = ()) -> DataFrame:
    """Numbers runs (from 1) whose neighbours are at most ``max_gap`` apart."""
    place = F.col(at) if isinstance(at, str) else at
    rows = df.withColumn("_at", place)
    along = Window.partitionBy(*group).orderBy("_at", *tie)
    new = F.coalesce((F.col("_at") - F.lag("_at").over(along) > max_gap).cast("int"), F.lit(1))
    marked = rows.withColumn("_new", new)
    return marked.withColumn(out, F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))).drop("_new", "_at")


def tile_islands(tiles_df: DataFrame, group: Sequence[str], tile: str, width: int) -> DataFrame:
    """(group, first, last, tiles): runs of consecutive tiles."""
    distinct = tiles_df.select(*group, tile).distinct()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(tile))
    runs = distinct.withColumn("_island", F.floor(F.col(tile) / width) - rank)
    return runs.groupBy(*group, "_island").agg(F.min(tile).alias("first"), F.max(tile).alias("last"), F.count("*").alias("tiles")).drop("_island")
