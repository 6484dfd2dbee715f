"""Whole reports: item summary, support and filtering, labelled universe, cohorts, taxonomy, coverage.

Each function takes tables and returns lazily composed DataFrames; Spark's own partial aggregation takes
the place of block-by-block merging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import keys, labels
from tessera.operators import aggregate, contracts, intervals, masks, selectors, stats
from tessera.plans.registry import query, table

STATUS_ORDER = ("found", "lookup_failed", "not_found")


# ---------------------------------------------------------------- item summary


def normalised_rows(
    rows: DataFrame, strategies: Sequence[str], begins: DataFrame, contexts: DataFrame, failures: DataFrame, evidence: Sequence[str], numeric: Sequence[str],
    frequency: str, significance: str,
) -> DataFrame:
    """One row per source row with its mask, id, place, context, reconciled evidence, classes and status.

    rows: variant_key, gene_id, event_type, ref, alt, strategies, vep_status, vep_primary_consequence and the
    evidence fields. begins: gene_id, begin. contexts: gene_id, start, end, context (disjoint, half-open).
    failures: axis, start, end (closed).
    """
    k = keys.key_struct("variant_key")
    keyed = rows.withColumns({
        "mask": masks.mask_of_text("strategies", strategies),
        "item": keys.item_id("variant_key", "gene_id", "event_type", "ref", "alt"),
    }).withColumn("_k", k)
    contracts.holds("rows have a strategy", keyed, F.col("mask") > 0).run()
    agreed = contracts.reconciled(keyed, ["item"], evidence, numeric)
    placed = keyed.drop(*evidence).join(agreed, "item").join(begins, "gene_id", "left")
    placed = placed.withColumns({
        "axis": F.col("_k.axis"), "pos": F.col("_k.pos"),
        "offset": keys.changed_offset("_k.pos", "begin", "_k.ref", "_k.alt"),
        "kind": keys.change_type("_k.ref", "_k.alt"), "substitution": keys.substitution_class("_k.ref", "_k.alt"),
    })
    located = intervals.contained(placed, contexts, ["gene_id"], "offset").drop("start", "end")
    failed = intervals.exists_in(located, failures, "axis", "pos", flag="failed")
    found = F.col(frequency).isNotNull() | (F.coalesce(F.col(significance), F.lit("")) != "")
    return failed.withColumns({
        "context": F.coalesce("context", F.lit("other")),
        "significance_class": labels.significance_class(significance),
        "consequence": labels.consequence_or_default("vep_primary_consequence", "vep_status"),
        "status": labels.lookup_status(found, F.col("failed")),
    }).drop("_k")


def item_relations(rows: DataFrame, frequency: str) -> tuple[DataFrame, DataFrame]:
    """(per item and gene, per item): masks, counts and the best status; constants by ``min``, never by order."""
    place = F.array(*map(F.lit, STATUS_ORDER))
    best = F.get(place, (F.min(F.array_position(place, F.col("status"))) - 1).cast("int")).alias("status")
    common = [F.bit_or("mask").alias("mask"), F.max(frequency).alias(frequency), best, F.min("significance_class").alias("significance_class"), F.min("kind").alias("kind"), F.min("substitution").alias("substitution")]
    by_gene = rows.groupBy("item", "gene_id").agg(*common, F.min("context").alias("context"), F.min("consequence").alias("consequence"), F.count("*").alias("rows"))
    by_item = rows.groupBy("item").agg(*common, F.countDistinct("gene_id").alias("genes"), F.count("*").alias("rows"))
    return by_gene, by_item


def strategy_table(items: DataFrame, strategies: Sequence[str], frequency: str) -> DataFrame:
    """Per strategy: items, unique items, found, substitution counts and their ratio, exact frequency quantiles
    (over positive values) and the median over all known ones."""
    held = masks.decoded(items, strategies)
    positive = F.col(frequency) > 0
    out = held.groupBy("member").agg(
        F.count("*").alias("items"),
        F.count_if(F.bit_count("mask") == 1).alias("unique_items"),
        F.count_if(F.col("status") == "found").alias("found"),
        F.count_if(F.col("substitution") == "transition").alias("transitions"),
        F.count_if(F.col("substitution") == "transversion").alias("transversions"),
        F.count_if(positive).alias("with_frequency"),
        F.percentile(frequency, 0.5).alias("median_frequency"),
        aggregate.quantiles(frequency, [0.05, 0.25, 0.75, 0.95], where=positive).alias("frequency_quantiles"),
        F.avg(F.when(positive, F.log10(F.when(positive, F.col(frequency))))).alias("mean_log_frequency"),
    )
    return out.withColumn("ti_tv", aggregate.ratio_with_limits(F.col("transitions"), F.col("transversions")))


def detail_rows(rows: DataFrame, wanted: Column, stars: str, submissions: str) -> DataFrame:
    """One row per wanted item, best reviewed first: joined contexts, genes, strategies and the merged evidence."""
    d = rows.where(wanted).groupBy("item").agg(
        aggregate.sorted_distinct("gene_id").alias("genes"), aggregate.sorted_distinct("context").alias("contexts"),
        F.bit_or("mask").alias("mask"), F.max(stars).alias(stars), F.max(submissions).alias(submissions),
    )
    return d.orderBy(F.desc_nulls_last(stars), F.desc_nulls_last(submissions), "item")


# ---------------------------------------------------------------- support and filtering


def support_edges(edges: DataFrame, context: Sequence[str], strategy: str, observer: str, weight: str) -> DataFrame:
    """(context, strategy, observers, multiplicity): distinct observers and the summed weight, by two partial aggregations."""
    per_edge = edges.groupBy(*context, strategy, observer).agg(F.sum(weight).alias("_w"))
    return per_edge.groupBy(*context, strategy).agg(F.count("*").alias("observers"), F.sum("_w").alias("multiplicity"))


def checked_support(support: DataFrame) -> DataFrame:
    """Support rows (strategy, ortholog, family, aligned, kind) whose numbers fit together; others are an error."""
    ok = (
        (F.coalesce("strategy", F.lit("")) != "") & (F.col("strategy") != "union") & (F.col("ortholog") >= 1)
        & (F.coalesce("family", F.lit(0)).between(0, F.col("ortholog")))
        & ((F.col("kind") != "snv") | (F.col("family").isNotNull() & F.col("aligned").isNotNull()))
        & (F.coalesce("aligned", F.col("ortholog")) >= F.col("ortholog"))
    )
    contracts.holds("support is consistent", support, ok).run()
    return support


def filter_scores(support: DataFrame) -> DataFrame:
    """(item, strategy, ortholog, family, strategies, aligned_min, aligned_max) and a ``union`` row per item."""
    per = checked_support(support).groupBy("item", "strategy").agg(
        F.max("ortholog").alias("ortholog"), F.max("family").alias("family"), F.min("aligned").alias("aligned_min"), F.max("aligned").alias("aligned_max")
    )
    n = per.groupBy("item").agg(F.count("*").alias("strategies"))
    rows = per.join(n, "item")
    return aggregate.with_union_row(rows, ["item"], "strategy", ["ortholog", "family", "strategies", "aligned_max"], ["aligned_min"])


#: Filters: score column, direction, first threshold. A family or maximum filter starts at 0.
FILTERS = {
    "ortholog": ("ortholog", "min", 1),
    "family": ("family", "min", 0),
    "strategy": ("strategies", "min", 1),
    "aligned_min": ("aligned_min", "min", 1),
    "aligned_max": ("aligned_max", "max", 0),
}


def filter_curves(scores: DataFrame, items: DataFrame, dims: Sequence[str] = ("kind",)) -> DataFrame:
    """(strategy, dims, filter, threshold, retained, total, found_fraction) for every filter.

    items: item, dims, status. found_fraction is the found share of retained items with a decided lookup.
    """
    rows = scores.join(items, "item")
    group = ["strategy", *dims]
    out = None
    for name, (score, direction, start) in FILTERS.items():
        usable = rows if name != "strategy" else rows.where(F.col("strategy") == "union")
        also = {"_f": (F.col("status") == "found").cast("int"), "_m": (F.col("status") == "not_found").cast("int")}
        one = aggregate.threshold_curve(usable, group, score, direction, start, also=also)
        decided = F.col("_f") + F.col("_m")
        one = one.select(*group, F.lit(name).alias("filter"), "threshold", "retained", "total", F.when(decided > 0, F.col("_f") / decided).alias("found_fraction"))
        out = one if out is None else out.unionByName(one)
    return out


def filter_associations(scores: DataFrame, cohort: DataFrame, filter_name: str, dims: Sequence[str] = ()) -> DataFrame:
    """2x2 counts (label by passing) at every change point of one filter, with odds ratio, interval and exact p.

    cohort: item, label_class (benign, pathogenic), dims. Items without scores never pass.
    """
    score, direction, _ = FILTERS[filter_name]
    strategies = scores.select("strategy").distinct()
    rows = cohort.where(F.col("label_class").isin("benign", "pathogenic")).crossJoin(F.broadcast(strategies))
    rows = rows.join(scores.select("item", "strategy", score), ["item", "strategy"], "left")
    curve = aggregate.contingency_curve(rows, ["strategy", *dims], score, F.col("label_class") == "benign", direction)
    out = curve.withColumn("o", stats.odds_ratio("a", "b", "c", "d"))
    out = out.select(*curve.columns, "o.*", stats.fisher_p("a", "b", "c", "d").alias("fisher_p"))
    reason = F.when(F.col("a") + F.col("b") == 0, "no item passes").when(F.col("c") + F.col("d") == 0, "every item passes")
    reason = reason.when(F.col("a") + F.col("c") == 0, "no benign item").when(F.col("b") + F.col("d") == 0, "no pathogenic item").otherwise("estimated")
    return out.withColumn("status", reason)


# ---------------------------------------------------------------- labelled universe and cohorts


def labelled_universe(records: DataFrame, key: Sequence[str], significance: str, texts: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(items with one label, diagnostics): benign or pathogenic by all their records, texts as sorted sets.

    Items whose records disagree are left out and counted.
    """
    cls = labels.significance_class(significance)
    named = records.withColumn("_label", F.when(cls == "B/LB", "benign").when(cls == "P/LP", "pathogenic"))
    sets = named.where("_label is not null").groupBy(*key).agg(
        F.array_sort(F.collect_set("_label")).alias("_labels"), *(aggregate.sorted_distinct(t).alias(t) for t in texts), F.count("*").alias("records")
    )
    one = sets.where(F.size("_labels") == 1).withColumn("label_class", F.col("_labels")[0]).drop("_labels")
    diagnostics = sets.agg(
        F.count("*").alias("items"), F.count_if(F.size("_labels") > 1).alias("mixed_labels"), F.count_if(F.col("records") > 1).alias("merged_items")
    )
    return one, diagnostics


def annotations_by_item(rows: DataFrame, key: Sequence[str], terms: str, status: str) -> DataFrame:
    """Union of the consequence terms of ``ok`` rows, most severe first, with a status that falls back to the others'."""
    ok = F.col(status) == "ok"
    found = F.array_distinct(F.flatten(F.collect_list(F.when(ok, labels.set_items(terms)))))
    return rows.groupBy(*key).agg(labels.by_severity(found).alias("terms"), F.when(F.max(ok), "ok").otherwise(F.min(status)).alias("status"))


def condition_distribution(items: DataFrame, key: Sequence[str], names: str, ids: str) -> DataFrame:
    """(condition, name, items, named_items, total_items): distinct items per condition."""
    each = items.select(*key, F.explode_outer(labels.conditions(names, ids)).alias("c"))
    k = F.struct(*key)
    total = each.agg(F.countDistinct(k).alias("total_items"), F.countDistinct(F.when(F.col("c").isNotNull(), k)).alias("named_items"))
    by = each.where("c is not null").groupBy(F.col("c.key").alias("condition")).agg(F.min("c.name").alias("name"), F.countDistinct(k).alias("items"))
    return by.crossJoin(F.broadcast(total))  # one row


def condition_background(records: DataFrame, key: Sequence[str], ref: str, alt: str, significance: str, names: str, ids: str) -> DataFrame:
    """(kind, condition, name, items, total_items, named_items) of purely pathogenic single-base changes and indels.

    An item is a ``key`` with its upper-cased alleles; one that is also reported benign counts for nothing. A kind
    without conditions has one row of empty texts.
    """
    cls = labels.significance_class(significance)
    label = F.when(cls == "B/LB", "benign").when(cls == "P/LP", "pathogenic")
    rows = records.withColumns({ref: F.upper(ref), alt: F.upper(alt)}).withColumn("kind", keys.change_type(ref, alt)).where(label.isNotNull() & F.col("kind").isin("snv", "indel"))
    item = [*key, ref, alt]
    each = rows.select(*item, "kind", label.alias("_label"), F.explode_outer(labels.conditions(names, ids)).alias("c"))
    each = each.groupBy(*item, "kind", F.col("c.key").alias("condition")).agg(F.min("c.name").alias("name"), F.min("_label").alias("_label"))
    own = Window.partitionBy(*item)  # an item has few conditions
    each = each.withColumns({
        "_label": F.min("_label").over(own), "_named": F.max(F.col("condition").isNotNull()).over(own), "_nth": F.row_number().over(own.orderBy("condition")),
    }).where("_label = 'pathogenic'")
    totals = each.where("_nth = 1").groupBy("kind").agg(F.count("*").alias("total_items"), F.count_if("_named").alias("named_items"))
    by = each.where("condition is not null").groupBy("kind", "condition").agg(F.min("name").alias("name"), F.count("*").alias("items"))
    by = by.withColumn("name", F.min("name").over(Window.partitionBy("condition")))
    out = F.broadcast(totals).join(by, "kind", "left")  # two rows
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("condition", "name")]
    return out.select("kind", *texts, F.coalesce("items", F.lit(0)).cast("long").alias("items"), "total_items", "named_items")


def cohort_comparison(cohorts: dict[str, DataFrame], key: str, kind: str, condition: str) -> DataFrame:
    """(condition, kind, <cohort> counts): items per condition for all kinds and each; the first cohort must lie in the others."""
    names = list(cohorts)
    for other in names[1:]:
        contracts.subset(f"{names[0]} lies in {other}", cohorts[names[0]], cohorts[other], [key]).run()
    out = None
    for name, df in cohorts.items():
        rows = df.select(key, condition, F.explode(selectors.with_all(F.array(kind))).alias("kind")).withColumn("cohort", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    counted = out.groupBy(condition, "kind", "cohort").agg(F.countDistinct(key).alias("n"))
    cells = [F.coalesce(F.max(F.when(F.col("cohort") == n, F.col("n"))), F.lit(0)).alias(n) for n in names]
    return counted.groupBy(condition, "kind").agg(*cells)


# ---------------------------------------------------------------- queries


@query("support_edges", """
WITH e AS (SELECT l_partkey, l_returnflag, l_suppkey, sum(l_linenumber) AS w FROM lineitem GROUP BY 1, 2, 3)
SELECT l_partkey, l_returnflag, count(*)::BIGINT AS observers, sum(w)::BIGINT AS multiplicity FROM e GROUP BY 1, 2""")
def support_edges_query(spark, sf_dir):
    return support_edges(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_returnflag", "l_suppkey", "l_linenumber")


@query("labelled_universe", """
WITH r AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'benign' WHEN 'R' THEN 'pathogenic' END AS label, l_linestatus FROM lineitem),
s AS (SELECT l_orderkey, list_sort(list(DISTINCT label)) AS labels, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) AS l_linestatus, count(*) AS records FROM r WHERE label IS NOT NULL GROUP BY 1)
SELECT l_orderkey, l_linestatus, records::BIGINT AS records, labels[1] AS label_class FROM s WHERE len(labels) = 1""")
def labelled_universe_query(spark, sf_dir):
    text = F.when(F.col("l_returnflag") == "A", "Likely benign").when(F.col("l_returnflag") == "R", "Pathogenic").otherwise("Uncertain significance")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", text.alias("significance"), "l_linestatus")
    return labelled_universe(rows, ["l_orderkey"], "significance", ["l_linestatus"])[0]


@query("cohort_comparison", """
WITH k AS (SELECT o_orderkey, o_orderpriority AS condition, unnest(['all', o_orderstatus]) AS kind, o_totalprice > 100000 AS t, o_totalprice > 200000 AS o FROM orders)
SELECT condition, kind, count(*) FILTER (o)::BIGINT AS observed, count(*) FILTER (t)::BIGINT AS target, count(*)::BIGINT AS everything FROM k GROUP BY 1, 2""")
def cohort_comparison_query(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("condition"), F.col("o_orderstatus").alias("kind"))
    cohorts = {"observed": rows.where("o_totalprice > 200000"), "target": rows.where("o_totalprice > 100000"), "everything": rows}
    return cohort_comparison(cohorts, "o_orderkey", "kind", "condition")


@query("strategy_summary", """
WITH m AS (SELECT l_orderkey AS item, bit_or(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 4 END) AS mask, min(l_discount) AS f, min(l_linestatus) AS s, min(l_suppkey) % 3 AS k FROM lineitem GROUP BY 1)
SELECT member, count(*)::BIGINT AS items, count(*) FILTER (bit_count(mask) = 1)::BIGINT AS unique_items, count(*) FILTER (s = 'F')::BIGINT AS found,
  count(*) FILTER (k = 0)::BIGINT AS transitions, count(*) FILTER (k = 1)::BIGINT AS transversions, count(*) FILTER (f > 0)::BIGINT AS with_frequency, round(median(f), 6) AS median_frequency,
  round(quantile_cont(f, 0.05) FILTER (f > 0), 6) AS q05, round(quantile_cont(f, 0.95) FILTER (f > 0), 6) AS q95,
  CASE WHEN count(*) FILTER (k = 1) <> 0 THEN round((count(*) FILTER (k = 0))::DOUBLE / count(*) FILTER (k = 1), 6) WHEN count(*) FILTER (k = 0) = 0 THEN 'nan'::DOUBLE ELSE 'inf'::DOUBLE END AS ti_tv
FROM m, (VALUES ('A', 1), ('N', 2), ('R', 4)) v(member, bit) WHERE mask & bit <> 0 GROUP BY 1""")
def strategy_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("item")).agg(
        F.bit_or(masks.member_bit("l_returnflag", ("A", "N", "R"))).alias("mask"), F.min("l_discount").alias("f"),
        F.when(F.min("l_linestatus") == "F", "found").otherwise("not_found").alias("status"), (F.min("l_suppkey") % 3).alias("k"),
    )
    rows = rows.withColumn("substitution", F.when(F.col("k") == 0, "transition").when(F.col("k") == 1, "transversion"))
    out = strategy_table(rows, ("A", "N", "R"), "f")
    return out.select(
        "member", "items", "unique_items", "found", "transitions", "transversions", "with_frequency", F.round("median_frequency", 6).alias("median_frequency"),
        F.round(F.col("frequency_quantiles")[0], 6).alias("q05"), F.round(F.col("frequency_quantiles")[3], 6).alias("q95"), F.round("ti_tv", 6).alias("ti_tv"),
    )


def _filter_input(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    support = lines.groupBy(F.col("l_partkey").alias("item"), F.col("l_returnflag").alias("strategy")).agg(
        F.countDistinct("l_suppkey").alias("ortholog"), F.countDistinct(F.col("l_suppkey") % 4).alias("family"), F.count("*").alias("aligned")
    )
    support = support.withColumn("kind", F.lit("snv"))
    status = F.when(F.col("p_size") % 3 == 0, "found").when(F.col("p_size") % 3 == 1, "not_found").otherwise("lookup_failed")
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.lit("snv").alias("kind"), status.alias("status"))
    return support, items


_SUPPORT = """s AS (SELECT l_partkey AS item, l_returnflag AS strategy, count(DISTINCT l_suppkey) AS ortholog, count(DISTINCT l_suppkey % 4) AS family, count(*) AS aligned_min, count(*) AS aligned_max FROM lineitem GROUP BY 1, 2),
n AS (SELECT item, count(*) AS strategies FROM s GROUP BY 1), b AS (SELECT * FROM s JOIN n USING (item)),
scores AS (SELECT item, strategy, ortholog, family, strategies, aligned_max, aligned_min FROM b UNION ALL SELECT item, 'union', max(ortholog), max(family), max(strategies), max(aligned_max), min(aligned_min) FROM b GROUP BY 1)"""


@query("filter_scores", f"WITH {_SUPPORT} SELECT * FROM scores")
def filter_scores_query(spark, sf_dir):
    return filter_scores(_filter_input(spark, sf_dir)[0])


def _curves_sql() -> str:
    parts = []
    for name, (score, direction, start) in FILTERS.items():
        rows = f"(SELECT * FROM j WHERE strategy = 'union')" if name == "strategy" else "j"  # noqa: F541
        sign = ">=" if direction == "min" else "<="
        parts.append(f"""SELECT g.strategy, g.kind, '{name}' AS filter, g.threshold, count(*) FILTER ({score} {sign} threshold)::BIGINT AS retained, count(*)::BIGINT AS total,
          count(*) FILTER ({score} {sign} threshold AND status = 'found') AS f, count(*) FILTER ({score} {sign} threshold AND status = 'not_found') AS m
          FROM (SELECT strategy, kind, unnest(range({start}, greatest(max({score}) + 1, {start}) + 1)) AS threshold FROM {rows} GROUP BY 1, 2) g JOIN {rows} r ON r.strategy = g.strategy AND r.kind = g.kind GROUP BY 1, 2, 3, 4""")
    return f"""WITH {_SUPPORT}, j AS (SELECT scores.*, 'snv' AS kind, CASE p_size % 3 WHEN 0 THEN 'found' WHEN 1 THEN 'not_found' ELSE 'lookup_failed' END AS status FROM scores JOIN part ON p_partkey = item)
    SELECT strategy, kind, filter, threshold, retained, total, CASE WHEN f + m > 0 THEN round(f::DOUBLE / (f + m), 9) END AS found_fraction FROM ({" UNION ALL ".join(parts)})"""


@query("filter_curves", _curves_sql())
def filter_curves_query(spark, sf_dir):
    support, items = _filter_input(spark, sf_dir)
    return filter_curves(filter_scores(support), items).withColumn("found_fraction", F.round("found_fraction", 9))


@query("filter_associations", f"""WITH {_SUPPORT},
cohort AS (SELECT p_partkey AS item, CASE WHEN p_size > 25 THEN 'benign' ELSE 'pathogenic' END AS label FROM part),
r AS (SELECT c.item, c.label, t.strategy, s.ortholog FROM cohort c CROSS JOIN (SELECT DISTINCT strategy FROM scores) t LEFT JOIN scores s ON s.item = c.item AND s.strategy = t.strategy),
p AS (SELECT DISTINCT strategy, ortholog + 1 AS threshold FROM r WHERE ortholog IS NOT NULL),
t AS (SELECT p.strategy, threshold, count(*) FILTER (ortholog >= threshold AND label = 'benign')::BIGINT AS a, count(*) FILTER (ortholog >= threshold AND label <> 'benign')::BIGINT AS b,
  count(*) FILTER (coalesce(ortholog, 0) < threshold AND label = 'benign')::BIGINT AS c, count(*) FILTER (coalesce(ortholog, 0) < threshold AND label <> 'benign')::BIGINT AS d FROM p JOIN r USING (strategy) GROUP BY 1, 2)
SELECT *, CASE WHEN b * c <> 0 THEN round((a * d)::DOUBLE / (b * c), 6) WHEN a * d > 0 THEN 'inf'::DOUBLE END AS odds_ratio,
  CASE WHEN a + b = 0 THEN 'no item passes' WHEN c + d = 0 THEN 'every item passes' WHEN a + c = 0 THEN 'no benign item' WHEN b + d = 0 THEN 'no pathogenic item' ELSE 'estimated' END AS status FROM t""")
def filter_associations_query(spark, sf_dir):
    scores = filter_scores(_filter_input(spark, sf_dir)[0])
    cohort = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.when(F.col("p_size") > 25, "benign").otherwise("pathogenic").alias("label_class"))
    out = filter_associations(scores, cohort, "ortholog")
    return out.select("strategy", "threshold", "a", "b", "c", "d", F.round("odds_ratio", 6).alias("odds_ratio"), "status")
