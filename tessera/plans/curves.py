"""Quantiles, thresholds, histograms, shares and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import keys, labels
from tessera.operators import aggregate
from tessera.plans.registry import query, table


@query("filtered_quantiles", """
SELECT l_returnflag, count(*)::BIGINT AS rows, median(l_extendedprice) FILTER (l_discount > 0.05) AS median_over,
  round(quantile_cont(l_extendedprice, 0.05), 6) AS p05, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
  round(avg(log10(nullif(l_discount, 0))), 6) AS mean_log FROM lineitem GROUP BY 1""")
def filtered_quantiles(spark, sf_dir):
    q = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("rows"),
        aggregate.quantiles("l_extendedprice", [0.5], where=F.col("l_discount") > 0.05)[0].alias("median_over"),
        aggregate.quantiles("l_extendedprice", [0.05, 0.95]).alias("q"),
        F.round(F.avg(labels.log10_positive("l_discount")), 6).alias("mean_log"),
    )
    return q.select("l_returnflag", "rows", "median_over", F.round(F.col("q")[0], 6).alias("p05"), F.round(F.col("q")[1], 6).alias("p95"), "mean_log")


@query("weighted_quantiles", """
SELECT p_brand, round(quantile_cont(p_retailprice, 0.25), 6) AS q1, round(quantile_cont(p_retailprice, 0.5), 6) AS q2, round(quantile_cont(p_retailprice, 0.75), 6) AS q3
FROM (SELECT p_brand, p_retailprice, unnest(range(p_size)) FROM part) GROUP BY 1""")
def weighted_quantiles(spark, sf_dir):
    q = table(spark, sf_dir, "part").groupBy("p_brand").agg(aggregate.quantiles("p_retailprice", [0.25, 0.5, 0.75], frequency=F.col("p_size")).alias("q"))
    return q.select("p_brand", *(F.round(F.col("q")[i], 6).alias(f"q{i + 1}") for i in range(3)))


_LOWER = """w AS (SELECT {g} AS g, {v} AS v, sum({w}) AS w FROM part GROUP BY 1, 2),
c AS (SELECT *, sum(w) OVER (PARTITION BY g ORDER BY v) AS cum, sum(w) OVER (PARTITION BY g) AS total FROM w)"""


@query("lower_weighted_quantiles", f"""WITH {_LOWER.format(g="p_brand", v="p_retailprice", w="p_size")}
SELECT g AS p_brand, point, min(v) AS p_retailprice FROM c, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) p(point) WHERE cum >= point * total - 1e-9 GROUP BY 1, 2""")
def lower_weighted_quantiles(spark, sf_dir):
    return aggregate.lower_quantiles(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", "p_size", [0.1, 0.5, 0.9])


def _cuts(v: str) -> str:
    return f"""SELECT g, list_sort(list(DISTINCT b)) AS cuts FROM (SELECT g, point, min(v) AS b FROM (
      SELECT *, sum(w) OVER (PARTITION BY g ORDER BY v) AS cum, sum(w) OVER (PARTITION BY g) AS total FROM (SELECT p_type AS g, {v} AS v, sum(p_size) AS w FROM part GROUP BY 1, 2)),
      (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) p(point) WHERE cum >= point * total - 1e-9 GROUP BY 1, 2) GROUP BY 1"""


@query("quantile_heatmap", f"""WITH x AS ({_cuts("p_retailprice")}), y AS ({_cuts("p_size")})
SELECT p_type, len(list_filter(x.cuts, lambda b: b < p_retailprice))::INTEGER AS x_bin, len(list_filter(y.cuts, lambda b: b < p_size))::INTEGER AS y_bin,
  sum(p_size)::BIGINT AS eligible, sum(CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE 0 END)::BIGINT AS found
FROM part JOIN x ON x.g = p_type JOIN y ON y.g = p_type GROUP BY 1, 2, 3""")
def quantile_heatmap(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_type", "p_retailprice", "p_size", F.col("p_size").cast("long").alias("w"), (F.col("p_partkey") % 3 == 0).alias("hit"))
    return aggregate.heatmap(rows, ["p_type"], "p_retailprice", "p_size", "w", "hit", 4)


_SCORES = "scores AS (SELECT l_suppkey % 20 AS g, l_returnflag AS member, nullif(count(*) % 9, 4) AS score, l_suppkey AS key FROM lineitem GROUP BY l_suppkey, l_returnflag)"


def _scores(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("member")).agg(F.count("*").alias("n"))
    return n.select((F.col("key") % 20).alias("g"), "member", F.nullif(F.col("n") % 9, F.lit(4)).alias("score"), "key")


def _curve_sql(sign: str, start: int) -> str:
    return f"""WITH {_SCORES}, t AS (SELECT g, count(*) AS total, max(score) AS top FROM scores GROUP BY 1),
grid AS (SELECT g, total, unnest(range({start}, greatest(top + 1, {start}) + 1)) AS threshold FROM t)
SELECT grid.g, threshold, count(score)::BIGINT AS retained, total::BIGINT AS total FROM grid LEFT JOIN scores ON scores.g = grid.g AND score {sign} threshold GROUP BY grid.g, threshold, total"""


@query("threshold_curve_min", _curve_sql(">=", 1))
def threshold_curve_min(spark, sf_dir):
    return aggregate.threshold_curve(_scores(spark, sf_dir), ["g"], "score", "min", 1)


@query("threshold_curve_max", _curve_sql("<=", 0))
def threshold_curve_max(spark, sf_dir):
    return aggregate.threshold_curve(_scores(spark, sf_dir), ["g"], "score", "max", 0)


@query("union_scores", f"""WITH {_SCORES}
SELECT key, member, score AS best, score AS least FROM scores UNION ALL SELECT key, 'union', max(score), min(score) FROM scores GROUP BY 1""")
def union_scores(spark, sf_dir):
    rows = _scores(spark, sf_dir).select("key", "member", F.col("score").alias("best"), F.col("score").alias("least"))
    return aggregate.with_union_row(rows, ["key"], "member", ["best"], ["least"])


@query("melted_counts", f"""WITH {_SCORES}
SELECT member, metric, score, count(*)::BIGINT AS rows FROM (SELECT member, 'score' AS metric, score FROM scores UNION ALL SELECT member, 'key', key // 10 FROM scores)
WHERE score IS NOT NULL GROUP BY 1, 2, 3""")
def melted_counts(spark, sf_dir):
    rows = _scores(spark, sf_dir).select("member", "score", F.expr("key div 10").alias("key"))
    return aggregate.melt_counts(rows, ["member"], ["score", "key"])


@query("contingency_curve", f"""WITH {_SCORES}, c AS (SELECT DISTINCT member, score + 1 AS threshold FROM scores WHERE score IS NOT NULL)
SELECT c.member, threshold, count(*) FILTER (score >= threshold AND key % 2 = 0)::BIGINT AS a, count(*) FILTER (score >= threshold AND key % 2 <> 0)::BIGINT AS b,
  count(*) FILTER ((score IS NULL OR score < threshold) AND key % 2 = 0)::BIGINT AS c, count(*) FILTER ((score IS NULL OR score < threshold) AND key % 2 <> 0)::BIGINT AS d
FROM c JOIN scores ON scores.member = c.member GROUP BY 1, 2""")
def contingency_curve(spark, sf_dir):
    return aggregate.contingency_curve(_scores(spark, sf_dir), ["member"], "score", F.col("key") % 2 == 0, "min")


_FD = """s AS (SELECT l_returnflag AS g, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n,
  2 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) / pow(count(*), 1 / 3::DOUBLE) AS width FROM lineitem GROUP BY 1),
e AS (SELECT g, lo, hi, least(ceil((hi - lo) / width), 40)::BIGINT AS bins FROM s)"""


@query("fd_histogram", f"""WITH {_FD}, b AS (SELECT g, lo, hi, bins, least(floor((l_extendedprice - lo) / ((hi - lo) / bins)), bins - 1)::BIGINT AS bin FROM lineitem JOIN e ON g = l_returnflag)
SELECT g AS l_returnflag, bin, round(lo + bin * ((hi - lo) / bins), 6) AS "left", round(lo + (bin + 1) * ((hi - lo) / bins), 6) AS "right", count(*)::BIGINT AS rows FROM b GROUP BY g, bin, lo, hi, bins""")
def fd_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    out = aggregate.histogram(rows, ["l_returnflag"], "l_extendedprice", aggregate.fd_edges(rows, ["l_returnflag"], "l_extendedprice", 40))
    return out.withColumns({"left": F.round("left", 6), "right": F.round("right", 6)})


@query("box_summary", """
WITH q AS (SELECT l_returnflag, count(*) AS rows, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT q.l_returnflag, rows::BIGINT AS rows, q1, median, q3, min(l_extendedprice) FILTER (l_extendedprice >= q1 - 1.5 * (q3 - q1)) AS lower_whisker,
  max(l_extendedprice) FILTER (l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS upper_whisker FROM q JOIN lineitem l ON l.l_returnflag = q.l_returnflag GROUP BY 1, 2, 3, 4, 5""")
def box_summary(spark, sf_dir):
    return aggregate.box_summary(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query("share_of_total", """
WITH n AS (SELECT o_orderstatus, o_orderpriority, count(*)::BIGINT AS rows FROM orders GROUP BY 1, 2)
SELECT *, round(rows / sum(rows) OVER (PARTITION BY o_orderstatus), 9) AS share FROM n""")
def share_of_total(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("rows"))
    return aggregate.share_of(n, ["o_orderstatus"], "rows").withColumn("share", F.round("share", 9))


@query("status_counts", """
WITH n AS (SELECT event_type, count(*)::BIGINT AS rows FROM events GROUP BY 1)
SELECT event_type, rows, round(rows / sum(rows) OVER (), 9) AS share, row_number() OVER (ORDER BY (event_type <> 'view')::INT, rows DESC, event_type)::INTEGER AS place FROM n""")
def status_counts(spark, sf_dir):
    return aggregate.status_counts(table(spark, sf_dir, "events"), "event_type", "view").withColumn("share", F.round("share", 9))


@query("power_bins", """
WITH n AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT CASE WHEN n = 0 THEN 0 ELSE length(bin(n)) END::INTEGER AS bin, CASE WHEN n <= 1 THEN n::VARCHAR ELSE (1 << (length(bin(n)) - 1))::VARCHAR || '-' || ((1 << length(bin(n))) - 1)::VARCHAR END AS label,
  count(*)::BIGINT AS groups FROM n GROUP BY 1, 2""")
def power_bins(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    n = table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left").fillna(0, ["n"])
    return n.groupBy(keys.power_bin("n").alias("bin"), keys.power_bin_label("n").alias("label")).agg(F.count("*").alias("groups"))


@query("zero_filled_grid", """
SELECT m.s AS c_mktsegment, r.r_name, count(c.c_custkey)::BIGINT AS rows FROM (SELECT DISTINCT c_mktsegment AS s FROM customer) m CROSS JOIN region r
LEFT JOIN (SELECT c_custkey, c_mktsegment, n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal < 0) c ON c.c_mktsegment = m.s AND c.n_regionkey = r.r_regionkey GROUP BY 1, 2""")
def zero_filled_grid(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf_dir, "customer")
    n = customers.where("c_acctbal < 0").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("c_mktsegment", "r_name").agg(F.count("*").alias("rows"))
    return aggregate.on_grid(n, {"c_mktsegment": customers, "r_name": table(spark, sf_dir, "region")}, ["rows"])


@query("group_histogram", """
SELECT o_orderstatus, o_orderpriority, year(o_orderdate)::INTEGER AS y, count(*)::BIGINT AS rows, count(DISTINCT o_custkey)::BIGINT AS customers, count(*) FILTER (o_totalprice > 200000)::BIGINT AS large
FROM orders GROUP BY ALL""")
def group_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.groupBy("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("rows"), F.countDistinct("o_custkey").alias("customers"), F.count_if(F.col("o_totalprice") > 200000).alias("large")
    )


@query("complete_means", """
WITH p AS (SELECT o_orderkey, unnest(range(o_orderkey, o_orderkey + 3)) AS pos FROM orders),
s AS (SELECT o_orderkey AS pos, o_totalprice AS score FROM orders WHERE o_totalprice > 50000)
SELECT o_orderkey, CASE WHEN count(score) = count(*) THEN round(avg(score), 6) END AS score FROM p LEFT JOIN s USING (pos) GROUP BY 1""")
def complete_means(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", F.sequence("o_orderkey", F.col("o_orderkey") + 2).alias("positions"))
    scores = orders.where("o_totalprice > 50000").select(F.col("o_orderkey").alias("pos"), F.col("o_totalprice").alias("score"))
    return aggregate.mean_if_complete(rows, ["o_orderkey"], "positions", scores, [], "pos", "score").withColumn("score", F.round("score", 6))


@query("transition_ratio", """
WITH n AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'purchase') AS b FROM events GROUP BY 1)
SELECT user_id, a::BIGINT AS a, b::BIGINT AS b, CASE WHEN b <> 0 THEN round(a::DOUBLE / b, 6) WHEN a = 0 THEN 'nan'::DOUBLE ELSE 'inf'::DOUBLE END AS ratio FROM n""")
def transition_ratio(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("a"), F.count_if(F.col("event_type") == "purchase").alias("b"))
    return n.withColumn("ratio", F.round(aggregate.ratio_with_limits(F.col("a"), F.col("b")), 6))


@query("expected_summary", """
SELECT t.k AS event_type, count(e.event_id)::BIGINT AS rows, count(DISTINCT e.user_id)::BIGINT AS users FROM (VALUES ('view'), ('click'), ('refund')) t(k) LEFT JOIN events e ON e.event_type = t.k GROUP BY 1""")
def expected_summary(spark, sf_dir):
    expected = spark.createDataFrame([("view",), ("click",), ("refund",)], "event_type string")
    aggs = [F.count("*").alias("rows"), F.countDistinct("user_id").alias("users")]
    return aggregate.expected_summary(table(spark, sf_dir, "events"), expected, "event_type", aggs)
