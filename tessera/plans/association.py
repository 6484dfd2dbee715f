"""Contingency tables and the statistics on them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import selectors, stats
from tessera.plans.registry import query, table

_ROWS = "rows AS (SELECT lang, source, quality, toxic, n_chars FROM documents JOIN labels USING (doc_id))"
_CELLS = """count(*) FILTER (quality = 1 AND toxic = 1)::BIGINT AS a, count(*) FILTER (quality = 1 AND toxic = 0)::BIGINT AS b,
  count(*) FILTER (quality = 0 AND toxic = 1)::BIGINT AS c, count(*) FILTER (quality = 0 AND toxic = 0)::BIGINT AS d"""


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")


def _tables(spark, sf_dir, *group):
    return selectors.two_by_two(_rows(spark, sf_dir), list(group), F.col("quality") == 1, F.col("toxic") == 1)


@query("two_by_two", f"WITH {_ROWS} SELECT lang, source, {_CELLS} FROM rows GROUP BY 1, 2")
def two_by_two(spark, sf_dir):
    return _tables(spark, sf_dir, "lang", "source")


@query("odds_ratio", f"""WITH {_ROWS}, t AS (SELECT lang, {_CELLS} FROM rows GROUP BY 1),
k AS (SELECT *, CASE WHEN least(a, b, c, d) = 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS h FROM t),
o AS (SELECT *, ln((a + h) * (d + h) / ((b + h) * (c + h))) AS l, sqrt(1 / (a + h) + 1 / (b + h) + 1 / (c + h) + 1 / (d + h)) AS e FROM k)
SELECT lang, CASE WHEN b * c <> 0 THEN round((a * d)::DOUBLE / (b * c), 6) WHEN a * d > 0 THEN 'inf'::DOUBLE END AS odds_ratio,
  round(exp(l - 1.96 * e), 6) AS ci_low, round(exp(l + 1.96 * e), 6) AS ci_high FROM o""")
def odds_ratio(spark, sf_dir):
    t = _tables(spark, sf_dir, "lang").withColumn("o", stats.odds_ratio("a", "b", "c", "d"))
    return t.select("lang", *(F.round(f"o.{c}", 6).alias(c) for c in ("odds_ratio", "ci_low", "ci_high")))


@query("mantel_haenszel", f"""WITH {_ROWS}, t AS (SELECT source, {_CELLS} FROM rows GROUP BY 1),
n AS (SELECT a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c, d::DOUBLE AS d, (a + b + c + d)::DOUBLE AS n FROM t WHERE a + b + c + d > 1),
s AS (SELECT count(*) AS strata, sum(a * d / n) AS r, sum(b * c / n) AS s, sum((a + b) * (c + d) * (a + c) * (b + d) / (n * n * (n - 1))) AS v, sum(a - (a + b) * (a + c) / n) AS dev FROM n)
SELECT strata::BIGINT AS strata, round(r / s, 6) AS odds_ratio_mh, round(dev * dev / v, 6) AS cmh_chi2 FROM s""")
def mantel_haenszel(spark, sf_dir):
    out = stats.mantel_haenszel(_tables(spark, sf_dir, "source"), [])
    return out.select("strata", F.round("odds_ratio_mh", 6).alias("odds_ratio_mh"), F.round("cmh_chi2", 6).alias("cmh_chi2"))


@query("fisher_exact", f"""WITH {_ROWS}, t AS (SELECT lang, {_CELLS} FROM rows GROUP BY 1),
x AS (SELECT *, unnest(range(greatest(0, a + b + a + c - (a + b + c + d)), least(a + b, a + c) + 1)) AS x FROM t),
p AS (SELECT lang, a, x, lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1)
  - lgamma(x + 1) - lgamma(a + b - x + 1) - lgamma(a + c - x + 1) - lgamma(d - a + x + 1) AS lp FROM x),
o AS (SELECT lang, lp, max(lp) FILTER (x = a) OVER (PARTITION BY lang) AS own FROM p)
SELECT lang, round(least(1.0, sum(exp(lp)) FILTER (lp <= own + 1e-7)), 6)::DOUBLE AS p FROM o GROUP BY 1""")
def fisher_exact(spark, sf_dir):
    return _tables(spark, sf_dir, "lang").select("lang", F.round(stats.fisher_p("a", "b", "c", "d"), 6).alias("p"))


@query("benjamini_hochberg", """
WITH p AS (SELECT l_returnflag AS g, l_suppkey AS k, count(*)::DOUBLE / 10000 AS p FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, p * count(*) OVER (PARTITION BY g) / row_number() OVER (PARTITION BY g ORDER BY p) AS raw FROM p)
SELECT g, k, round(p, 9) AS p, round(least(1.0, min(raw) OVER (PARTITION BY g ORDER BY p DESC)), 9)::DOUBLE AS q FROM r""")
def benjamini_hochberg(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("g"), F.col("l_suppkey").alias("k")).agg((F.count("*") / 10000).alias("p"))
    out = stats.benjamini_hochberg(n, ["g"], "p")
    return out.select("g", "k", F.round("p", 9).alias("p"), F.round("q", 9).alias("q"))


@query("estimability", f"""WITH {_ROWS}
SELECT lang, source, CASE WHEN count(DISTINCT toxic) < 2 THEN 'one label' WHEN count(DISTINCT quality) < 2 THEN 'one state' ELSE '' END AS reason FROM rows GROUP BY 1, 2""")
def estimability(spark, sf_dir):
    return selectors.estimability(_rows(spark, sf_dir), ["lang", "source"], F.col("quality"), F.col("toxic"), "no rows", "one label", "one state")


@query("range_overlap", f"""WITH {_ROWS}, s AS (SELECT lang, min(n_chars) FILTER (quality = 1) l1, max(n_chars) FILTER (quality = 1) h1, min(n_chars) FILTER (quality = 0) l0,
  max(n_chars) FILTER (quality = 0) h0, min(n_chars) lo, max(n_chars) hi FROM rows GROUP BY 1)
SELECT lang, greatest(l1, l0) AS overlap_low, least(h1, h0) AS overlap_high, round(greatest(least(h1, h0) - greatest(l1, l0), 0)::DOUBLE / (hi - lo), 6) AS overlap_fraction,
  coalesce(greatest(least(h1, h0) - greatest(l1, l0), 0)::DOUBLE / (hi - lo) < 0.1, false) AS overlap_warning FROM s WHERE l1 IS NOT NULL AND l0 IS NOT NULL AND hi > lo""")
def range_overlap(spark, sf_dir):
    out = selectors.range_overlap(_rows(spark, sf_dir), ["lang"], "quality", "n_chars")
    return out.where("overlap_fraction is not null").withColumn("overlap_fraction", F.round("overlap_fraction", 6))


def _matched(spark, sf_dir):
    """Suppliers as focals: their first line is observed, all others are controls."""
    rank = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice").withColumn("n", rank)
    role = F.when(F.col("n") == 1, "observed").otherwise("control")
    return rows.select((F.col("l_suppkey") % 3).alias("g"), F.col("l_suppkey").alias("focal"), role.alias("role"), F.col("l_extendedprice").alias("score"))


_MATCHED = """ranked AS (SELECT l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS n FROM lineitem),
m AS (SELECT l_suppkey % 3 AS g, l_suppkey AS focal, CASE WHEN n = 1 THEN 'observed' ELSE 'control' END AS role, l_extendedprice AS score FROM ranked)"""


@query("matching_rate", f"""WITH {_MATCHED}
SELECT g, count(DISTINCT focal)::BIGINT AS eligible, count(DISTINCT focal) FILTER (role = 'control' AND score > 90000)::BIGINT AS matched,
  round(count(DISTINCT focal) FILTER (role = 'control' AND score > 90000)::DOUBLE / count(DISTINCT focal), 9) AS rate FROM m GROUP BY 1""")
def matching_rate(spark, sf_dir):
    out = stats.matching_rate(_matched(spark, sf_dir), ["g"], "focal", (F.col("role") == "control") & (F.col("score") > 90000))
    return out.withColumn("rate", F.round("rate", 9))


@query("weighted_ecdf", f"""WITH {_MATCHED}, w AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY g, focal, role) AS w FROM m),
q AS (SELECT g, quantile_cont(score, 0.005) AS lo, (quantile_cont(score, 0.995) - quantile_cont(score, 0.005)) / 120 AS step FROM m GROUP BY 1),
grid AS (SELECT g, lo, step, unnest(range(0, 121)) AS k FROM q)
SELECT grid.g, role, k::INTEGER AS k, round(lo + k * step, 3) AS x, round(sum(CASE WHEN k >= ceil((score - lo) / step - 1e-9) THEN w ELSE 0 END) / sum(w), 6) AS fraction FROM grid JOIN w ON w.g = grid.g GROUP BY grid.g, role, k, lo, step""")
def weighted_ecdf(spark, sf_dir):
    out = stats.weighted_ecdf(_matched(spark, sf_dir), ["g"], "focal", "role", "score")
    return out.withColumns({"x": F.round("x", 3), "fraction": F.round("fraction", 6)})


@query("paired_bootstrap")
def paired_bootstrap(spark, sf_dir):
    return stats.paired_bootstrap(_matched(spark, sf_dir), ["g"], "focal", "role", "score")


@query("firth_logistic")
def firth_logistic(spark, sf_dir):
    rows = _rows(spark, sf_dir).withColumn("score", F.log("n_chars"))
    return stats.firth_by_group(rows, ["lang"], "quality", "toxic", "score")


@query("firth_saturated", """
WITH r AS (SELECT lang, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL),
c AS (SELECT lang, count(*)::BIGINT AS rows, count(*) FILTER (quality = 1 AND toxic = 1) + 0.5::DOUBLE AS a, count(*) FILTER (quality = 0 AND toxic = 1) + 0.5::DOUBLE AS b,
  count(*) FILTER (quality = 1 AND toxic = 0) + 0.5::DOUBLE AS c, count(*) FILTER (quality = 0 AND toxic = 0) + 0.5::DOUBLE AS d FROM r GROUP BY 1 HAVING count(DISTINCT quality) = 2 AND count(DISTINCT toxic) = 2)
SELECT lang, rows, round(a * d / (b * c), 4) AS odds_ratio FROM c""")
def firth_saturated(spark, sf_dir):
    """With one binary term the penalised estimate is that of the table with half a row added to each cell."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id").where("lang is not null").withColumn("score", F.lit(0.0))
    out = stats.firth_by_group(rows, ["lang"], "quality", "toxic", "score", spline_df=0)
    return out.where("odds_ratio is not null").select("lang", "rows", F.round("odds_ratio", 4).alias("odds_ratio"))


@query("bootstrap_observed", f"""WITH {_MATCHED}, p AS (SELECT g, focal, max(score) FILTER (role = 'observed') AS own, count(*) FILTER (role = 'control') AS controls FROM m GROUP BY 1, 2)
SELECT g, count(*)::BIGINT AS matched_focals, round(median(own), 6) AS observed_median, 1000::BIGINT AS valid_resamples FROM p WHERE own IS NOT NULL AND controls > 0 GROUP BY 1""")
def bootstrap_observed(spark, sf_dir):
    """What does not depend on draws."""
    out = stats.paired_bootstrap(_matched(spark, sf_dir), ["g"], "focal", "role", "score")
    return out.select("g", "matched_focals", F.round("observed_median", 6).alias("observed_median"), "valid_resamples")
