"""Joins, set operations, deduplication and key expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import keys
from tessera.operators import contracts, dedupe
from tessera.operators.sequence import windows
from tessera.plans.registry import query, table


@query("first_by_priority", """
SELECT l_orderkey, arg_min(l_linenumber, (-l_extendedprice, l_linenumber)) AS l_linenumber, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1""")
def first_by_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return dedupe.first_by(rows, ["l_orderkey"], -F.col("l_extendedprice"), "l_linenumber")


@query("topk_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def topk_per_group(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return dedupe.top_k(rows, ["o_custkey"], 3, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("hash_sample", """
SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7|' || o_orderpriority || '|' || o_orderkey), o_orderkey)::INTEGER AS sample_rank FROM orders
QUALIFY sample_rank <= 25""")
def hash_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    return dedupe.hash_sample(rows, "o_orderpriority", "o_orderkey", 25, "7")


@query("first_index_dedupe", """
WITH r AS (SELECT doc_id, md5(text) AS h, min(doc_id) OVER (PARTITION BY md5(text)) AS f FROM documents),
n AS (SELECT f, row_number() OVER (ORDER BY f)::BIGINT AS i FROM (SELECT DISTINCT f FROM r))
SELECT doc_id, h, doc_id = r.f AS accepted, CASE WHEN doc_id = r.f THEN i END AS accepted_index, CASE WHEN doc_id <> r.f THEN i END AS duplicate_of_index FROM r JOIN n ON n.f = r.f""")
def first_index_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    return dedupe.accept_first(rows, "h", "doc_id")


@query("occurrence_counter", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)::INTEGER AS occurrence FROM conversations")
def occurrence_counter(spark, sf_dir):
    return dedupe.occurrence(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn").select("conv_id", "turn", "occurrence")


@query("event_compaction", """
WITH s AS (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2, 3)
SELECT o_custkey, o_orderstatus, count(*)::BIGINT AS observers, sum(n)::BIGINT AS rows, row_number() OVER (PARTITION BY o_custkey ORDER BY o_custkey, o_orderstatus)::BIGINT AS event_id FROM s GROUP BY 1, 2""")
def event_compaction(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return dedupe.compact_events(rows, ["o_custkey", "o_orderstatus"], "o_orderpriority", [], None, ["o_orderkey"], ["o_custkey"])[0]


@query("event_support", """
SELECT o_custkey, o_orderpriority, count(*)::BIGINT AS rows, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS flags FROM orders GROUP BY 1, 2""")
def event_support(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("flags", F.col("o_orderstatus"))
    events, support = dedupe.compact_events(rows, ["o_custkey"], "o_orderpriority", ["o_orderstatus"], "flags", ["o_orderkey"])
    named = support.join(events.select("event_id", "o_custkey"), "event_id")
    return named.select("o_custkey", "o_orderpriority", "rows", "o_orderstatus", "flags")


@query("latest_wins", "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def latest_wins(spark, sf_dir):
    return dedupe.latest(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("refresh_plan", """
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_custkey % 7 <> 0)""")
def refresh_plan(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return dedupe.refresh_plan(table(spark, sf_dir, "orders"), customers.where("c_acctbal > 0"), customers.where("o_custkey % 7 = 0"), ["o_custkey"])


@query("append_new", """
SELECT user_id, min(event_id) AS event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-02') GROUP BY 1""")
def append_new(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = dedupe.append_new(events.where("event_type = 'error' and ts < timestamp'2024-01-02'"), events.select("event_id", "user_id"), ["user_id"])
    return rows.select("user_id", "event_id")


@query("conflict_free", "SELECT DISTINCT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def conflict_free(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return dedupe.conflict_free(nations.unionByName(nations), ["n_nationkey"])


@query("checked_join", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def checked_join(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return contracts.join_checked(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), customers, ["o_custkey"]).select("o_orderkey", "c_mktsegment")


@query("multi_key_join", """
SELECT a.l_orderkey, a.l_linenumber, o_orderpriority, coalesce(p_brand, '') AS p_brand FROM lineitem a JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey AND p_size > l_linenumber * 8""")
def multi_key_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    out = lines.join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    out = out.join(table(spark, sf_dir, "part"), (F.col("p_partkey") == F.col("l_partkey")) & (F.col("p_size") > F.col("l_linenumber") * 8), "left")
    return out.select("l_orderkey", "l_linenumber", "o_orderpriority", F.coalesce("p_brand", F.lit("")).alias("p_brand"))


@query("anti_orphans", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_orphans(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return contracts.references("customers have orders", customers, table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]).violations


@query("semi_scope", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def semi_scope(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(wanted, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@query("full_outer_top", """
WITH a AS (SELECT p_brand, count(*) AS x FROM part WHERE p_size < 25 AND p_brand LIKE '%1%' GROUP BY 1), b AS (SELECT p_brand, count(*) AS y FROM part WHERE p_size > 40 AND p_brand LIKE '%2%' GROUP BY 1)
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(x, 0)::BIGINT AS x, coalesce(y, 0)::BIGINT AS y FROM a FULL JOIN b ON a.p_brand = b.p_brand ORDER BY y DESC NULLS LAST, 1 LIMIT 15""")
def full_outer_top(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    a = part.where("p_size < 25 and p_brand like '%1%'").groupBy("p_brand").agg(F.count("*").alias("x"))
    b = part.where("p_size > 40 and p_brand like '%2%'").groupBy("p_brand").agg(F.count("*").alias("y"))
    out = a.join(b, "p_brand", "full").orderBy(F.desc_nulls_last("y"), "p_brand").limit(15)
    return out.select("p_brand", F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y"))


@query("outer_split", """
SELECT t.k AS user_id, CASE WHEN e.user_id IS NULL THEN 'not_returned' ELSE 'resolved' END AS status, coalesce(n, 0)::BIGINT AS n FROM range(0, 200) t(k) LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON e.user_id = t.k""")
def outer_split(spark, sf_dir):
    requests = spark.range(200).withColumnRenamed("id", "user_id")
    records = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    hits, misses = contracts.split_lookup(requests, records, ["user_id"], "n")
    both = hits.withColumn("status", F.lit("resolved")).unionByName(misses.withColumns({"n": F.lit(0).cast("long"), "status": F.lit("not_returned")}))
    return both.select("user_id", "status", "n")


@query("many_to_many", "SELECT a.s_suppkey AS focal, b.s_suppkey AS control FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey WHERE a.s_acctbal > 0")
def many_to_many(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    a = s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("focal"), "s_nationkey")
    return a.join(s.select(F.col("s_suppkey").alias("control"), "s_nationkey"), "s_nationkey").where("focal <> control").select("focal", "control")


@query("small_dimension_cross", "SELECT r_name, t.k AS state, (r_regionkey * 10 + t.k)::BIGINT AS cell FROM region, range(0, 4) t(k)")
def small_dimension_cross(spark, sf_dir):
    states = spark.range(4).withColumnRenamed("id", "state")
    rows = table(spark, sf_dir, "region").crossJoin(F.broadcast(states))
    return rows.select("r_name", "state", (F.col("r_regionkey") * 10 + F.col("state")).cast("long").alias("cell"))


@query("set_difference", """
SELECT only_in, count(*)::BIGINT AS keys FROM (SELECT 'left' AS only_in, o_custkey FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'right', o_custkey FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) GROUP BY 1""")
def set_difference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    check = contracts.same_keys("states", orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'P'"), ["o_custkey"])
    return check.violations.groupBy("only_in").agg(F.count("*").alias("keys"))


@query("set_algebra", """
SELECT 'union' AS op, count(*)::BIGINT AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'not_subset', count(*) FROM (SELECT c_custkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders)""")
def set_algebra(spark, sf_dir):
    f = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    everyone = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    ops = {
        "union": f.union(rich).distinct(),
        "intersect": contracts.disjoint("x", f, rich, ["k"]).violations.distinct(),
        "not_subset": contracts.subset("x", rich, everyone, ["k"]).violations,
    }
    out = None
    for op, df in ops.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


_KEYS = "k AS (SELECT o_orderkey, 'chr' || (o_custkey % 30) || ':' || (o_orderkey % 97) || ':' || ['A', 'C', 'AT', 'ACG'][(o_orderkey % 4 + 1)::INT] || '>' || ['G', 'T', 'A', 'ACT', 'N'][(o_orderkey % 5 + 1)::INT] AS key FROM orders)"


@query("key_expressions", f"""WITH {_KEYS},
p AS (SELECT o_orderkey, key, regexp_replace(split_part(key, ':', 1), '^chr', '') AS axis, try_cast(split_part(key, ':', 2) AS BIGINT) AS pos,
  split_part(split_part(key, ':', 3), '>', 1) AS ref, split_part(split_part(key, ':', 3), '>', 2) AS alt FROM k)
SELECT o_orderkey, axis, pos, ref, alt, regexp_full_match(key, '(chr)?[^:>]+:[0-9]+:[ACGT]+>[ACGT]+') AND pos > 0 AS valid,
  CASE WHEN alt = 'N' THEN 'unsupported' WHEN len(ref) = 1 AND len(alt) = 1 THEN 'snv' WHEN len(ref) <> len(alt) THEN 'indel' ELSE 'complex' END AS kind,
  CASE WHEN len(ref) = 1 AND len(alt) = 1 AND ref <> alt THEN CASE WHEN ref || alt IN ('AG', 'GA', 'CT', 'TC') THEN 'transition' ELSE 'transversion' END END AS class,
  (SELECT count(*) FROM range(1, 4) t(i) WHERE i <= least(len(ref), len(alt)) AND ref[1:i] = alt[1:i])::INTEGER AS shared,
  translate(reverse(ref), 'ACGT', 'TGCA') AS rc FROM p""")
def key_expressions(spark, sf_dir):
    refs, alts = F.array(*map(F.lit, ("A", "C", "AT", "ACG"))), F.array(*map(F.lit, ("G", "T", "A", "ACT", "N")))
    n = F.col("o_orderkey")
    key = F.concat(F.lit("chr"), (F.col("o_custkey") % 30).cast("string"), F.lit(":"), (n % 97).cast("string"), F.lit(":"), refs[(n % 4).cast("int")], F.lit(">"), alts[(n % 5).cast("int")])
    rows = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("key")).withColumn("k", keys.key_struct("key"))
    return rows.select(
        "o_orderkey", "k.*", keys.key_is_valid("key").alias("valid"), keys.change_type("k.ref", "k.alt").alias("kind"),
        keys.substitution_class("k.ref", "k.alt").alias("class"), keys.common_prefix("k.ref", "k.alt").alias("shared"), keys.reverse_complement("k.ref").alias("rc"),
    )


@query("sequence_windows", """
WITH s AS (SELECT doc_id, n_chars AS n FROM documents), w AS (
  SELECT doc_id, n, unnest(CASE WHEN n >= 500 THEN list_distinct(list_concat(range(0, n - 499, 300), [n - 500])) ELSE [0] END) AS window_start FROM s)
SELECT doc_id, window_start, least(n - window_start, 500)::BIGINT AS window_length FROM w""")
def sequence_windows(spark, sf_dir):
    out = windows(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 500, 300)
    return out.select("doc_id", "window_start", F.col("window_length").cast("long").alias("window_length"))


@query("contract_violations", """
SELECT 'unique' AS rule, count(*)::BIGINT AS rows FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'holds', count(*) FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, false)
UNION ALL SELECT 'consecutive', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(DISTINCT l_linenumber))
UNION ALL SELECT 'one_outcome', count(*) FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1 HAVING count(o_orderkey) <> 1)""")
def contract_violations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    customers, orders = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    checks = {
        "unique": contracts.unique("lines", lines, ["l_orderkey", "l_linenumber"]),
        "holds": contracts.holds("discount", lines, F.col("l_discount") <= 0.05),
        "consecutive": contracts.consecutive("numbers", lines, ["l_orderkey"], "l_linenumber"),
        "one_outcome": contracts.one_outcome("orders", customers, orders, ["c_custkey"]),
    }
    out = None
    for rule, check in checks.items():
        one = check.violations.agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
