"""Who reports what: masks, evidence, statuses, text aggregation, hierarchies, selectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import labels
from tessera.operators import aggregate, contracts, hierarchy, masks, selectors
from tessera.plans.registry import query, table

STATES = ("AF", "AO", "NF", "NO", "RF", "RO")
STATE = "l_returnflag || l_linestatus"
_BITS = f"CASE {STATE} " + " ".join(f"WHEN '{m}' THEN {1 << k}" for k, m in enumerate(STATES)) + " END"
_MASKS = f"masks AS (SELECT l_partkey, bit_or({_BITS})::BIGINT AS mask FROM lineitem GROUP BY 1)"
_HIST = f"{_MASKS}, hist AS (SELECT mask, count(*) AS items FROM masks GROUP BY 1)"
_MEMBERS = "(VALUES " + ", ".join(f"('{m}', {1 << k}::BIGINT)" for k, m in enumerate(STATES)) + ") m(member, bit)"


def _histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", F.expr(STATE).alias("state"))
    return masks.mask_histogram(masks.membership_mask(rows, "l_partkey", "state", STATES))


@query("mask_histogram", f"WITH {_HIST} SELECT mask, items::BIGINT AS items FROM hist")
def mask_histogram(spark, sf_dir):
    return _histogram(spark, sf_dir)


@query("mask_members", f"""WITH {_HIST}
SELECT member, sum(items)::BIGINT AS items, coalesce(sum(items) FILTER (bit_count(mask) = 1), 0)::BIGINT AS unique_items
FROM hist, {_MEMBERS} WHERE mask & bit <> 0 GROUP BY member""")
def mask_members(spark, sf_dir):
    return masks.member_counts(_histogram(spark, sf_dir), STATES)


@query("mask_totals", f"""WITH {_HIST}
SELECT sum(items)::BIGINT AS items, coalesce(sum(items) FILTER (mask = 63), 0)::BIGINT AS items_in_all,
       sum(bit_count(mask) * items)::BIGINT AS memberships FROM hist""")
def mask_totals(spark, sf_dir):
    return masks.mask_totals(_histogram(spark, sf_dir), STATES)


@query("pairwise_jaccard", f"""WITH {_HIST}, m AS (SELECT * FROM {_MEMBERS})
SELECT a.member AS member_a, b.member AS member_b,
       sum(CASE WHEN mask & a.bit <> 0 AND mask & b.bit <> 0 THEN items ELSE 0 END)::BIGINT AS intersection,
       sum(CASE WHEN mask & a.bit <> 0 OR mask & b.bit <> 0 THEN items ELSE 0 END)::BIGINT AS union_items,
       round(sum(CASE WHEN mask & a.bit <> 0 AND mask & b.bit <> 0 THEN items ELSE 0 END)::DOUBLE /
             sum(CASE WHEN mask & a.bit <> 0 OR mask & b.bit <> 0 THEN items ELSE 0 END), 9) AS jaccard
FROM hist, m a, m b WHERE a.bit <= b.bit GROUP BY 1, 2""")
def pairwise_jaccard(spark, sf_dir):
    return masks.pairwise_overlap(_histogram(spark, sf_dir), STATES)


@query("status_masks", """
WITH m AS (SELECT o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4
  WHEN '4-NOT SPECIFIED' THEN 8 WHEN '5-LOW' THEN 16 END::BIGINT AS bit, o_orderstatus AS s FROM orders),
g AS (SELECT o_custkey, coalesce(bit_or(bit) FILTER (s = 'F'), 0)::BIGINT AS f, coalesce(bit_or(bit) FILTER (s = 'O'), 0)::BIGINT AS o FROM m GROUP BY 1)
SELECT o_custkey, f AS "F_mask", (o & ~f)::BIGINT AS "O_mask", bit_count(f & o)::BIGINT AS conflicts FROM g""")
def status_masks(spark, sf_dir):
    members = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    return masks.status_masks(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", members, "o_orderstatus", "F", "O")


@query("mask_status_grid", """
WITH m AS (SELECT l_orderkey, bit_or(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 4 END)::BIGINT AS mask,
  CASE WHEN max(l_linestatus) = min(l_linestatus) THEN 'one' ELSE 'mixed' END AS state FROM lineitem GROUP BY 1),
grid AS (SELECT member, bit, state FROM (VALUES ('A', 1), ('N', 2), ('R', 4)) t(member, bit), (VALUES ('one'), ('mixed'), ('none')) s(state))
SELECT g.member, g.state, count(m.mask)::BIGINT AS rows FROM grid g LEFT JOIN m ON m.state = g.state AND m.mask & g.bit <> 0 GROUP BY 1, 2""")
def mask_status_grid(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.bit_or(masks.member_bit("l_returnflag", ("A", "N", "R"))).alias("mask"),
        F.when(F.max("l_linestatus") == F.min("l_linestatus"), "one").otherwise("mixed").alias("state"),
    )
    return aggregate.status_by_member(rows, "mask", [("A", 1), ("N", 2), ("R", 4)], ("one", "mixed", "none"), "state")


@query("mask_aware_anti", """
WITH f AS (SELECT o_custkey, bit_or(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 4 END)::BIGINT AS mask
           FROM orders WHERE o_orderpriority < '3' GROUP BY 1),
o AS (SELECT o_custkey, bit_or(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 4 END)::BIGINT AS mask
           FROM orders WHERE o_orderpriority >= '3' GROUP BY 1)
SELECT f.o_custkey, f.mask FROM f LEFT JOIN o USING (o_custkey) WHERE o.mask IS NULL OR (o.mask & f.mask) <> f.mask""")
def mask_aware_anti(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    part = lambda urgent: masks.membership_mask(orders.where((F.col("o_orderpriority") < "3") == F.lit(urgent)), "o_custkey", "o_orderstatus", ("F", "O", "P"))
    return masks.not_covered(part(True), part(False), ["o_custkey"], "mask", "mask")


@query("evidence_reconcile", """
SELECT o_custkey, max(nullif(o_orderpriority, '')) AS priority, coalesce(min(nullif(o_orderpriority, '')) <> max(nullif(o_orderpriority, '')), false) AS priority_conflict,
  max(try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE)) AS level,
  coalesce(min(try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE)) <> max(try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE)), false) AS level_conflict,
  count(*) FILTER (substr(o_orderpriority, 1, 1) <> '' AND try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE) IS NULL)::BIGINT AS level_invalid
FROM orders GROUP BY 1""")
def evidence_reconcile(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("priority"), F.left("o_orderpriority", F.lit(1)).alias("level"))
    return contracts.reconcile(rows, ["o_custkey"], ["priority", "level"], numeric=["level"])


@query("status_precedence", """
SELECT user_id, ['purchase', 'signup', 'click', 'view', 'error'][min(list_position(['purchase', 'signup', 'click', 'view', 'error'], event_type))] AS event_type
FROM events GROUP BY 1""")
def status_precedence(spark, sf_dir):
    return aggregate.precedence(table(spark, sf_dir, "events"), ["user_id"], "event_type", ("purchase", "signup", "click", "view", "error"))


@query("sorted_distinct_text", """
SELECT user_id, coalesce(string_agg(DISTINCT event_type, '|' ORDER BY event_type), '') AS types,
  coalesce(string_agg(DISTINCT event_type, '|' ORDER BY event_type) FILTER (value > 50), '') AS types_over FROM events GROUP BY 1""")
def sorted_distinct_text(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        aggregate.sorted_distinct("event_type").alias("types"), aggregate.sorted_distinct("event_type", where=F.col("value") > 50).alias("types_over")
    )


_TREE = """t AS (SELECT o_orderkey AS item, c_custkey, n_name AS nation, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT *, unnest(CASE WHEN region = 'ASIA' THEN ['all', 'asia'] ELSE ['all'] END) AS scope FROM t),
u AS (SELECT item % 50 AS part, scope, unit, id FROM s, LATERAL (VALUES ('item', item::VARCHAR), ('customer', c_custkey::VARCHAR), ('nation', nation), ('region', region)) v(unit, id)),
c AS (SELECT part, scope, unit, count(DISTINCT id)::BIGINT AS n FROM u GROUP BY 1, 2, 3)"""


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    customers = customers.join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    profiles = customers.select(
        F.col("c_custkey").alias("taxon"), F.array("n_name", "r_name").alias("lineage"), F.col("c_custkey").cast("string").alias("customer"),
        F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
    )
    members = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("part"), F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("taxon"))
    return hierarchy.member_units(members, profiles, "item", "taxon", "lineage", {"all": "", "asia": "ASIA"}, ("customer", "nation", "region"))


@query("hierarchical_distinct", f"WITH {_TREE} SELECT * FROM c")
def hierarchical_distinct(spark, sf_dir):
    return hierarchy.distinct_counts(_units(spark, sf_dir), ["part"])


@query("hierarchical_wide", f"""WITH {_TREE}
SELECT part, coalesce(max(n) FILTER (scope = 'all' AND unit = 'nation'), 0)::BIGINT AS all__nation, coalesce(max(n) FILTER (scope = 'all' AND unit = 'customer'), 0)::BIGINT AS all__customer,
  coalesce(max(n) FILTER (scope = 'asia' AND unit = 'nation'), 0)::BIGINT AS asia__nation, coalesce(max(n) FILTER (scope = 'asia' AND unit = 'customer'), 0)::BIGINT AS asia__customer
FROM c GROUP BY 1""")
def hierarchical_wide(spark, sf_dir):
    return hierarchy.wide_counts(hierarchy.distinct_counts(_units(spark, sf_dir), ["part"]), ["part"], ("all", "asia"), ("nation", "customer"))


@query("hierarchy_summary", f"""WITH {_TREE}, p AS (SELECT range AS part FROM range(60)),
g AS (SELECT p.part, scope, unit, coalesce(c.n, 0) AS n FROM (SELECT * FROM p, (VALUES ('all'), ('asia')) a(scope), (VALUES ('customer'), ('nation')) b(unit)) p LEFT JOIN c USING (part, scope, unit))
SELECT scope, unit, count(*)::BIGINT AS groups, min(n)::BIGINT AS least, median(n)::DOUBLE AS median, round(avg(n), 6) AS mean, max(n)::BIGINT AS most FROM g GROUP BY 1, 2""")
def hierarchy_summary(spark, sf_dir):
    counts = hierarchy.distinct_counts(_units(spark, sf_dir), ["part"])
    groups = spark.range(60).withColumnRenamed("id", "part")
    out = hierarchy.summary(counts, groups, "part", ("all", "asia"), ("customer", "nation"))
    return out.withColumn("mean", F.round("mean", 6))


@query("selector_cube", """
WITH e AS (SELECT doc_id, unnest(list_distinct(['all', lang])) AS lang, quality, toxic, unnest_kind FROM (
  SELECT d.doc_id, lang, quality, toxic, unnest(list_concat(['all'], CASE WHEN n_chars > 2000 THEN ['long'] ELSE [] END, CASE WHEN n_chars < 6000 THEN ['short'] ELSE [] END)) AS unnest_kind
  FROM documents d JOIN labels USING (doc_id)))
SELECT lang, unnest_kind AS kind, count(*)::BIGINT AS rows, count(*) FILTER (quality = 1)::BIGINT AS good FROM e GROUP BY 1, 2""")
def selector_cube(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    kinds = F.array_compact(F.array(F.when(F.col("n_chars") > 2000, "long"), F.when(F.col("n_chars") < 6000, "short")))
    axes = {"lang": selectors.with_all(F.array("lang")), "kind": selectors.with_all(kinds)}
    return selectors.cube_counts(rows, axes, [F.count("*").alias("rows"), F.count_if(F.col("quality") == 1).alias("good")])


_INFO = "p AS (SELECT event_id, 'KIND=' || event_type || ';K=' || json_extract_string(props, '$.k') || ';KIND=x' AS info FROM events)"


@query("attribute_parse", f"""WITH {_INFO}
SELECT event_id, regexp_extract(info, '(^|;)KIND=([^;]*)', 2) AS kind, regexp_extract(info, '(^|;)K=([^;]*)', 2) AS k FROM p""")
def attribute_parse(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("KIND="), "event_type", F.lit(";K="), k, F.lit(";KIND=x")).alias("info"))
    return rows.select("event_id", labels.info_value("info", "KIND").alias("kind"), labels.info_value("info", "K").alias("k"))


@query("url_attributes", """
SELECT page_id, regexp_extract(url, '^(https?)', 1) AS scheme, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
  coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '') AS page FROM pages""")
def url_attributes(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.parse_url("url", F.lit("PROTOCOL")).alias("scheme"), F.parse_url("url", F.lit("HOST")).alias("host"),
        F.coalesce(F.parse_url("url", F.lit("QUERY"), F.lit("page")), F.lit("")).alias("page"),
    )


@query("flag_cleanup", """
SELECT event_id, list_aggregate(list_sort(list_distinct(list_filter(list_transform(string_split_regex(event_type || ',x|' || event_type || '||', '[,|]'), lambda s: trim(s)), lambda s: s <> ''))), 'string_agg', '|') AS flags FROM events""")
def flag_cleanup(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", labels.flags_text(F.concat("event_type", F.lit(",x|"), "event_type", F.lit("||"))).alias("flags"))
