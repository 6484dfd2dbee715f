"""Intervals, coverage, clusters and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import keys
from tessera.operators import intervals
from tessera.plans.registry import query, table

SPAN = 90
_SPANS = f"""spans AS (SELECT o_custkey AS g, o_orderkey AS item, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS s,
  date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + {SPAN} AS e FROM orders)"""
_MERGED = f"""{_SPANS},
flagged AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY g ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS first FROM spans),
islands AS (SELECT *, sum(first) OVER (PARTITION BY g ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM flagged),
merged AS (SELECT g, min(s) AS s, max(e) AS e, count(*) AS members FROM islands GROUP BY g, island)"""


def day(column):
    return F.datediff(column, F.lit("1970-01-01").cast("date")).cast("long")


def _spans(spark, sf_dir, *more):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("item"), day("o_orderdate").alias("s"), *more)
    return rows.withColumn("e", F.col("s") + SPAN)


def _points(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("g"))
    return rows.withColumn("pos", F.explode(F.sequence(F.lit(9200), F.lit(11400), F.lit(200)).cast("array<long>")))


_POINTS = "points AS (SELECT c_custkey AS g, unnest(range(9200, 11401, 200)) AS pos FROM customer)"


@query("interval_merge", f"WITH {_MERGED} SELECT g, s, e, members::BIGINT AS members FROM merged")
def interval_merge(spark, sf_dir):
    return intervals.merge(_spans(spark, sf_dir), ["g"], "s", "e", unplaced=True)


@query("interval_union_length", f"""WITH {_MERGED}
SELECT g, (SELECT sum(m.e - m.s) FROM merged m WHERE m.g = spans.g)::BIGINT AS covered, count(*)::BIGINT AS intervals, sum(e - s)::BIGINT AS total FROM spans GROUP BY g""")
def interval_union_length(spark, sf_dir):
    return intervals.union_length(_spans(spark, sf_dir), ["g"], "s", "e")


@query("interval_gaps", f"""WITH {_MERGED}, n AS (SELECT g, e AS s, lead(s) OVER (PARTITION BY g ORDER BY s) AS e FROM merged)
SELECT g, s, e FROM n WHERE e IS NOT NULL""")
def interval_gaps(spark, sf_dir):
    return intervals.gaps(_spans(spark, sf_dir), ["g"], "s", "e")


@query("interval_closed_merge", f"""WITH {_SPANS},
c AS (SELECT g, s, e - 1 AS e FROM spans),
flagged AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY g ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS first FROM c),
islands AS (SELECT *, sum(first) OVER (PARTITION BY g ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM flagged)
SELECT g, min(s) AS s, max(e) AS e, count(*)::BIGINT AS members FROM islands GROUP BY g, island""")
def interval_closed_merge(spark, sf_dir):
    return intervals.merge(_spans(spark, sf_dir).withColumn("e", F.col("e") - 1), ["g"], "s", "e", closed=True, unplaced=True)


_SWEEP = """edges AS (SELECT g, t, sum(step) AS step FROM (SELECT g, s AS t, 1 AS step FROM spans UNION ALL SELECT g, e, -1 FROM spans) GROUP BY g, t),
swept AS (SELECT g, t AS s, lead(t) OVER (PARTITION BY g ORDER BY t) AS e, sum(step) OVER (PARTITION BY g ORDER BY t) AS depth FROM edges)"""


@query("sweep_depth", f"WITH {_SPANS}, {_SWEEP} SELECT g, s, e, depth::BIGINT AS depth FROM swept WHERE depth > 0")
def sweep_depth(spark, sf_dir):
    return intervals.depth(_spans(spark, sf_dir), ["g"], "s", "e")


@query("depth_at_sites", f"""WITH {_SPANS}, {_POINTS}
SELECT p.g, p.pos, count(DISTINCT spans.item)::BIGINT AS depth FROM points p LEFT JOIN spans ON spans.g = p.g AND p.pos >= s AND p.pos < e GROUP BY 1, 2""")
def depth_at_sites(spark, sf_dir):
    return intervals.depth_at(_points(spark, sf_dir), _spans(spark, sf_dir), ["g"], "item", "pos", "s", "e")


@query("members_at_sites", f"""WITH {_SPANS}, {_POINTS}
SELECT DISTINCT p.g, p.pos, spans.item FROM points p JOIN spans ON spans.g = p.g AND p.pos >= s AND p.pos < e""")
def members_at_sites(spark, sf_dir):
    return intervals.members_at(_points(spark, sf_dir), _spans(spark, sf_dir), ["g"], "item", "pos", "s", "e")


@query("feature_coverage", f"""WITH {_SPANS}, f AS (SELECT g, pos // 200 AS feature, pos AS fs, pos + 150 AS fe FROM (SELECT c_custkey AS g, unnest(range(9200, 11401, 200)) AS pos FROM customer)),
days AS (SELECT f.g, feature, d.day, count(DISTINCT item) AS n FROM f JOIN spans ON spans.g = f.g AND s < fe AND e > fs, LATERAL (SELECT unnest(range(greatest(s, fs), least(e, fe))) AS day) d GROUP BY 1, 2, 3),
items AS (SELECT f.g, feature, count(DISTINCT item) AS items_covering FROM f JOIN spans ON spans.g = f.g AND s < fe AND e > fs GROUP BY 1, 2),
t AS (SELECT g, feature, count(*) AS covered, sum(n) AS depth_length FROM days GROUP BY 1, 2)
SELECT f.g, f.feature, f.fs, f.fe, coalesce(depth_length, 0)::BIGINT AS depth_length, coalesce(items_covering, 0)::BIGINT AS items_covering, coalesce(covered, 0)::BIGINT AS covered,
  round(coalesce(covered, 0) / 150.0::DOUBLE, 6) AS breadth, round(coalesce(depth_length, 0) / 150.0::DOUBLE, 6) AS mean_depth
FROM f LEFT JOIN t USING (g, feature) LEFT JOIN items USING (g, feature)""")
def feature_coverage(spark, sf_dir):
    features = _points(spark, sf_dir).select("g", F.expr("pos div 200").alias("feature"), F.col("pos").alias("fs"), (F.col("pos") + 150).alias("fe"))
    segments = _spans(spark, sf_dir).withColumnsRenamed({"s": "fs", "e": "fe"})
    out = intervals.coverage(features, segments, ["g"], "item", "feature", "fs", "fe")
    return out.withColumns({c: F.round(c, 6) for c in ("breadth", "mean_depth")})


@query("interval_subtract", f"""WITH {_SPANS}, ranked AS (SELECT spans.*, o_orderstatus AS status FROM spans JOIN orders ON o_orderkey = item),
cut AS (SELECT g, s + 30 AS s, s + 40 AS e FROM ranked WHERE status = 'F'),
days AS (SELECT DISTINCT b.g, b.item, b.s, b.e, unnest(range(b.s, b.e)) AS day FROM ranked b WHERE b.status <> 'F'),
kept AS (SELECT * FROM days d WHERE NOT EXISTS (SELECT 1 FROM cut c WHERE c.g = d.g AND d.day >= c.s AND d.day < c.e)),
r AS (SELECT g, item, day, day - row_number() OVER (PARTITION BY g, item ORDER BY day) AS island FROM kept)
SELECT g, item, min(day) AS s, max(day) + 1 AS e FROM r GROUP BY g, item, island""")
def interval_subtract(spark, sf_dir):
    spans = _spans(spark, sf_dir, "o_orderstatus")
    cut = spans.where("o_orderstatus = 'F'").select("g", (F.col("s") + 30).alias("s"), (F.col("s") + 40).alias("e"))
    return intervals.subtract(spans.where("o_orderstatus <> 'F'"), cut, ["g"], "s", "e").select("g", "item", "s", "e")


@query("priority_partition", f"""WITH {_SPANS}, l AS (SELECT spans.g, s, e, o_orderpriority AS label, substr(o_orderpriority, 1, 1)::INT AS rank FROM spans JOIN orders ON o_orderkey = item),
days AS (SELECT g, unnest(range(s, e)) AS day, rank, label FROM l), best AS (SELECT g, day, arg_min(label, (rank, label)) AS label FROM days GROUP BY 1, 2),
r AS (SELECT *, day - row_number() OVER (PARTITION BY g, label ORDER BY day) AS island FROM best)
SELECT g, label, min(day) AS s, max(day) + 1 AS e FROM r GROUP BY g, label, island""")
def priority_partition(spark, sf_dir):
    labels = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_orderpriority").alias("label"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("rank"))
    return intervals.priority_partition(_spans(spark, sf_dir).join(labels, "item"), ["g"], "label", "rank", "s", "e")


@query("containment_join", f"""WITH {_MERGED}, {_POINTS}
SELECT p.g, p.pos, m.s, m.e, m.members::BIGINT AS members FROM points p LEFT JOIN merged m ON m.g = p.g AND p.pos >= m.s AND p.pos < m.e""")
def containment_join(spark, sf_dir):
    return intervals.contained(_points(spark, sf_dir), interval_merge(spark, sf_dir), ["g"], "pos", "s", "e")


@query("existence_range", f"""WITH {_SPANS}, {_POINTS}
SELECT p.g, p.pos, EXISTS (SELECT 1 FROM spans WHERE spans.g = p.g AND p.pos BETWEEN s AND e) AS hit FROM points p""")
def existence_range(spark, sf_dir):
    return intervals.exists_in(_points(spark, sf_dir), _spans(spark, sf_dir), "g", "pos", "s", "e")




@query("asof_context", """
SELECT e.event_id, p.event_id AS last_buy FROM events e LEFT JOIN LATERAL (
  SELECT event_id FROM events b WHERE b.event_type = 'purchase' AND b.user_id = e.user_id AND b.ts <= e.ts ORDER BY b.ts DESC, b.event_id DESC LIMIT 1) p ON true""")
def asof_context(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    buys = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("last_buy"))
    out = intervals.asof(events, buys, ["user_id"], "ts", ["last_buy"])
    return out.select("event_id", "last_buy")


@query("range_overlap_join", f"""WITH {_SPANS}
SELECT a.g, a.item AS item_a, b.item AS item_b FROM spans a JOIN spans b ON a.g = b.g AND a.s <= b.e AND b.s <= a.e AND a.item < b.item""")
def range_overlap_join(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    a = spans.select("g", F.col("item").alias("item_a"), F.col("s").alias("sa"), F.col("e").alias("ea"))
    b = spans.select("g", F.col("item").alias("item_b"), F.col("s").alias("sb"), F.col("e").alias("eb"))
    return intervals.range_join(a, b, ("sa", "ea"), ("sb", "eb"), SPAN, on=["g"]).where("item_a < item_b").select("g", "item_a", "item_b")


@query("range_semi_join", f"""WITH {_SPANS}, r AS (SELECT spans.*, o_orderstatus AS status FROM spans JOIN orders ON o_orderkey = item)
SELECT a.item AS item_a FROM r a WHERE status <> 'O' AND EXISTS (SELECT 1 FROM r b WHERE b.status = 'O' AND a.g = b.g AND a.s <= b.e AND b.s <= a.e)""")
def range_semi_join(spark, sf_dir):
    spans = _spans(spark, sf_dir, "o_orderstatus")
    a = spans.where("o_orderstatus <> 'O'").select("g", F.col("item").alias("item_a"), F.col("s").alias("sa"), F.col("e").alias("ea"))
    b = spans.where("o_orderstatus = 'O'").select("g", F.col("s").alias("sb"), F.col("e").alias("eb"))
    return intervals.range_join(a, b, ("sa", "ea"), ("sb", "eb"), SPAN, on=["g"], how="left_semi").select("item_a")


@query("gap_clusters", """
WITH m AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w > 6 * 3600000000 THEN 1 WHEN lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS first
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, sum(first) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS cluster FROM m""")
def gap_clusters(spark, sf_dir):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return intervals.gap_clusters(table(spark, sf_dir, "events"), ["user_id"], at, 6 * 3600 * 1_000_000, tie=["event_id"]).select("event_id", "user_id", "cluster")


@query("tile_assignment", """
SELECT o_orderkey, ((o_orderkey) // 100) * 100 + 1 AS tile, CASE WHEN o_orderkey >= 0 THEN 'k_' || (o_orderkey // 1000)::VARCHAR ELSE 'invalid' END AS block FROM orders""")
def tile_assignment(spark, sf_dir):
    pos = F.col("o_orderkey") + 1
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.tile_start(pos, 100).cast("long").alias("tile"), keys.block_id(F.lit("k"), pos, 1000).alias("block"))


@query("tile_islands", """
WITH t AS (SELECT DISTINCT o_custkey % 10 AS g, (o_orderkey // 20) * 20 AS tile FROM orders),
r AS (SELECT *, tile // 20 - row_number() OVER (PARTITION BY g ORDER BY tile) AS island FROM t)
SELECT g, min(tile) AS first, max(tile) AS last, count(*)::BIGINT AS tiles FROM r GROUP BY g, island""")
def tile_islands(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 10).alias("g"), F.expr("o_orderkey div 20 * 20").alias("tile"))
    return intervals.tile_islands(rows, ["g"], "tile", 20)
