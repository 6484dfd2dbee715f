"""Line formats, stores and sequence operators over texts and files made of the driver tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import labels
from tessera.operators import aggregate, contracts, hierarchy, intervals, sequence
from tessera.plans.ladders import _TERMS, pick, sql_pick
from tessera.plans.lines import _SPANS, _spans
from tessera.plans.registry import query, table
from tessera.sources import formats, tables
from tessera.storage import shared_dir


def _path(spark, tag: str) -> str:
    """A new folder in shared storage."""
    return f"{shared_dir(spark)}/tessera-{tag}-{uuid.uuid4().hex}"


def _text(*columns):
    """The columns as one tab-separated line."""
    return F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit(".")) if isinstance(c, str) else c for c in columns))


# ---------------------------------------------------------------- line formats


@query("vcf_records", "SELECT o_orderstatus AS chrom, o_orderkey AS pos, o_orderpriority AS ref, o_custkey::VARCHAR AS alt, o_orderpriority AS class FROM orders")
def vcf_records(spark, sf_dir):
    info = F.concat(F.lit("AF=1;CLASS="), "o_orderpriority", F.lit(";CLASS=no;X="), F.col("o_custkey").cast("string"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"), _text("o_orderstatus", "o_orderkey", F.lit("."), "o_orderpriority", "o_custkey", F.lit("."), F.lit("."), info).alias("value"))
    comments = lines.limit(3).select("n", F.lit("##comment").alias("value"))
    return formats.vcf(lines.unionByName(comments)).select("chrom", "pos", "ref", "alt", labels.info_value("info", "CLASS").alias("class"))


@query("gff3_records", """
SELECT o_orderstatus AS seqid, o_orderkey AS start, o_orderkey + 9 AS "end", CASE o_orderstatus WHEN 'P' THEN NULL ELSE '+' END AS strand, o_orderpriority AS note, o_custkey::VARCHAR AS gene FROM orders""")
def gff3_records(spark, sf_dir):
    attrs = F.concat(F.lit("ID=i;Note="), F.url_encode("o_orderpriority"), F.lit(";Note=second;Dbxref=X:1,GeneID:"), F.col("o_custkey").cast("string"))
    attrs = F.regexp_replace(attrs, r"\+", "%20")
    strand = F.when(F.col("o_orderstatus") == "P", ".").otherwise("+")
    value = _text("o_orderstatus", F.lit("src"), F.lit("gene"), "o_orderkey", (F.col("o_orderkey") + 9).cast("string"), F.lit("."), strand, F.lit("."), attrs)
    out = formats.gff3(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"), value.alias("value")))
    return out.select("seqid", "start", "end", "strand", F.col("attributes")["Note"].alias("note"), formats.gene_ids(F.col("attributes"))[0].alias("gene"))


@query("paf_events", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey % 50 + 1 AS m, l_suppkey % 7 + 1 AS d FROM lineitem)
SELECT l_orderkey || '-' || l_linenumber AS query, event_type, start0, end0, ref, alt FROM (
  SELECT *, unnest([{'event_type': 'snv', 'start0': 100 + m, 'end0': 101 + m, 'ref': 'A', 'alt': 'G'}, {'event_type': 'del', 'start0': 103 + m, 'end0': 103 + m + d, 'ref': repeat('C', d), 'alt': ''},
    {'event_type': 'ins', 'start0': 103 + m + d, 'end0': 103 + m + d, 'ref': '', 'alt': 'TTA'}], recursive := true) FROM l)""")
def paf_events(spark, sf_dir):
    m, d = F.col("l_partkey") % 50 + 1, F.col("l_suppkey") % 7 + 1
    tag = F.concat(F.lit("cs:Z::"), m.cast("string"), F.lit("*ag:2-"), F.repeat(F.lit("c"), d.cast("int")), F.lit("+tta:4"))
    name = F.concat_ws("-", "l_orderkey", "l_linenumber")
    numbers = [F.lit(str(k)) for k in (900, 0, 90)], [F.lit(str(k)) for k in (5000, 100, 300)], [F.lit(str(k)) for k in (80, 90, 60)]
    value = F.concat_ws("\t", name, *numbers[0], F.lit("+"), F.lit("t"), *numbers[1], *numbers[2], tag)
    rows = formats.paf(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("n"), value.alias("value")))
    events = sequence.difference_events(rows.select("query", F.col("tags")["cs"].alias("cs"), "target_start"), "cs", "target_start")
    return events.select("query", "event_type", "start0", "end0", "ref", "alt")


@query("sam_segments", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey % 30 + 1 AS a, l_suppkey % 5 + 1 AS b, l_orderkey % 90 AS p FROM lineitem WHERE l_returnflag <> 'A')
SELECT l_orderkey || '-' || l_linenumber AS query, b AS mismatches, unnest([p, p + a + 2 + b])::BIGINT AS segment_start0, unnest([p + a + 2, p + a + 2 + b + 6])::BIGINT AS segment_end0 FROM l""")
def sam_segments(spark, sf_dir):
    a, b, p = F.col("l_partkey") % 30 + 1, F.col("l_suppkey") % 5 + 1, F.col("l_orderkey") % 90
    cigar = F.concat(F.lit("3S"), a.cast("string"), F.lit("M2I2="), b.cast("string"), F.lit("N6X4H"))
    flag = F.when(F.col("l_returnflag") == "A", "4").otherwise("16")  # unmapped ones go
    name = F.concat_ws("-", "l_orderkey", "l_linenumber")
    value = F.concat_ws("\t", name, flag, F.lit("t"), (p + 1).cast("string"), F.lit("60"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("A"), F.lit("I"), F.concat(F.lit("NM:i:"), b.cast("string")))
    rows = formats.sam(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("n"), value.alias("value"))).where("mapped")
    return sequence.cigar_segments(rows.select("query", "mismatches", "cigar", "start0"), "cigar", "start0").select("query", "mismatches", "segment_start0", "segment_end0")


@query("id_list_chunks", """
WITH t AS (SELECT o_orderkey AS line, unnest([o_custkey + 1, o_orderkey % 40 + 1]) AS id, unnest([0, 1]) AS slot FROM orders),
f AS (SELECT id, min((line, slot)) AS first FROM t GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY first) AS accepted_index FROM f)
SELECT line, slot, t.id, (line, slot) = first AS accepted, CASE WHEN (line, slot) = first THEN accepted_index END AS accepted_index, CASE WHEN (line, slot) <> first THEN accepted_index END AS duplicate_of_index,
  ((accepted_index - 1) // 25 + 1)::INT AS chunk FROM t JOIN n USING (id)""")
def id_list_chunks(spark, sf_dir):
    value = F.concat((F.col("o_custkey") + 1).cast("string"), F.lit(", "), (F.col("o_orderkey") % 40 + 1).cast("string"), F.lit("  # 7 no"))
    out = formats.id_list(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"), value.alias("value")), chunk=25)
    at = F.col("position.at").cast("int")
    whole = F.coalesce("accepted_index", "duplicate_of_index")
    return out.select("line", at.alias("slot"), "id", "accepted", "accepted_index", "duplicate_of_index", (F.floor((whole - 1) / 25) + 1).cast("int").alias("chunk"))


@query("fasta_records", """
SELECT 'NC_' || c_custkey || '.1' AS accession, c_custkey % 2 = 0 AS complement, c_custkey + 10 AS start1, c_custkey + 20 AS end1, c_nationkey::VARCHAR AS gene_id, c_mktsegment AS organism,
  upper(c_name || c_mktsegment) AS sequence, len(c_name || c_mktsegment)::INT AS length FROM customer""")
def fasta_records(spark, sf_dir):
    key = F.col("c_custkey")
    ends = F.when(key % 2 == 0, F.concat(F.lit("c"), (key + 20).cast("string"), F.lit("-"), (key + 10).cast("string"))).otherwise(F.concat_ws("-", (key + 10).cast("string"), (key + 20).cast("string")))
    header = F.concat(F.lit(">NC_"), key.cast("string"), F.lit(".1:"), ends, F.lit(" name [organism="), "c_mktsegment", F.lit("] [GeneID="), F.col("c_nationkey").cast("string"), F.lit("]"))
    path = _path(spark, "fasta")
    table(spark, sf_dir, "customer").select(F.concat_ws("\n", header, F.lower("c_name"), "c_mktsegment")).write.text(path)
    out = formats.fasta(spark, path).withColumn("h", formats.header_fields("header"))
    return out.select("h.accession", "h.complement", "h.start1", "h.end1", "h.gene_id", "h.organism", "sequence", "length")


@query("json_report", """
SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'c' || o_custkey WHEN o_orderstatus = 'F' THEN 'F' END AS query_id FROM orders""")
def json_report(spark, sf_dir):
    """Each report's first group item that was requested: 'c<customer>' of a third of the customers, else 'F'."""
    orders = table(spark, sf_dir, "orders")
    items = F.array(*(F.struct(c.alias("id"), F.lit(1).alias("w")) for c in (F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.col("o_orderstatus"), F.lit("z"))))
    path = _path(spark, "report")
    orders.select("o_orderkey", items.alias("groups")).write.json(path)
    wanted = orders.where("o_custkey % 3 = 0").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id")).union(spark.createDataFrame([("F",)], "id string")).distinct()
    return formats.json_groups(spark, path, "o_orderkey long, groups array<struct<id:string,w:int>>", "groups", wanted, "id").select("o_orderkey", "query_id")


# ---------------------------------------------------------------- stores


@query("text_roundtrip", "SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS label FROM orders UNION ALL SELECT n_nationkey::VARCHAR, n_name FROM nation")
def text_roundtrip(spark, sf_dir):
    label = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("label")
    first = table(spark, sf_dir, "orders").select("o_orderkey", label)
    other = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("o_orderkey"), F.col("n_name").alias("label"))
    path = _path(spark, "text")
    tables.write_text(tables.union_exact(first, other), path, ["o_orderkey"])
    return tables.text_table(spark, f"{path}/*.csv.gz", ["o_orderkey", "label"], empty_as_null=True)


@query("store_roundtrips", """
SELECT store, o_orderstatus, rows::BIGINT AS rows, total::BIGINT AS total FROM (SELECT 'checked' AS store, o_orderstatus, count(*)::BIGINT AS rows, sum(o_custkey)::BIGINT AS total FROM orders GROUP BY ALL
UNION ALL SELECT 'partitioned', o_orderstatus, count(*), sum(o_custkey) FROM orders GROUP BY ALL UNION ALL SELECT 'shards', o_orderstatus, count(*), sum(o_custkey) FROM orders GROUP BY ALL
UNION ALL SELECT 'manifest', o_orderstatus, count(*), sum(o_custkey) FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL
UNION ALL SELECT 'fragments', o_orderstatus, count(*), sum(o_custkey) FROM orders GROUP BY ALL UNION ALL SELECT 'repaired', CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE o_orderstatus END, count(*), sum(o_custkey) FROM orders GROUP BY ALL
UNION ALL SELECT 'memory', 'x', 2, 3)""")
def store_roundtrips(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = _path(spark, "stores")
    found = {
        "checked": tables.write_checked(rows, f"{path}/checked", rows.count()),
        "partitioned": tables.write_partitioned(rows, f"{path}/partitioned", ["o_orderstatus"]),
    }
    tables.write_shards(rows, f"{path}/shards", ["o_orderkey"], 1000)
    found["shards"] = spark.read.parquet(f"{path}/shards")
    parts = []
    for status in ("F", "O"):
        part = rows.where(F.col("o_orderstatus") == status)
        part.write.parquet(f"{path}/set/{status}")
        parts.append({"partition_id": status, "path": status, "rows": part.count()})
    spec = json.dumps({"format": "parquet", "columns": rows.columns, "partitions": [*parts, {"partition_id": "x", "path": "none", "rows": 0}]})
    spark.createDataFrame([(spec,)], "value string").coalesce(1).write.text(f"{path}/set/manifest")
    found["manifest"] = tables.dataset(spark, f"{path}/set/manifest", ["F", "O"])
    for chosen in ("o_orderstatus <> 'F'", "true", "true"):  # repeats add nothing
        tables.append_fragments(rows.where(chosen), f"{path}/fragments", ["o_orderkey"], "o_orderstatus")
    found["fragments"] = spark.read.parquet(f"{path}/fragments")
    supplement = rows.select("o_orderkey", F.lit("new").alias("o_orderstatus"))
    found["repaired"] = tables.repaired(rows, supplement, ["o_orderkey"], ["o_orderstatus"], F.col("o_orderstatus") == "P")
    found["memory"] = tables.register(spark, "in_memory", [(1, 1, "x"), (2, 2, "x")], "o_orderkey long, o_custkey long, o_orderstatus string")
    out = None
    for name, df in found.items():
        one = df.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_custkey").alias("total")).select(F.lit(name).alias("store"), "o_orderstatus", "rows", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query("track_lookup", """
SELECT c_custkey AS pos, o_totalprice AS score FROM customer LEFT JOIN (SELECT o_custkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) ON o_custkey = c_custkey""")
def track_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first = orders.groupBy("o_custkey").agg(F.min_by("o_totalprice", "o_orderkey").alias("score"))
    track = first.select(F.lit("x").alias("axis"), F.col("o_custkey").alias("pos"), (F.floor((F.col("o_custkey") - 1) / 100) * 100 + 1).alias("tile"), "score")
    path = _path(spark, "track")
    tables.write_partitioned(track, path, ["tile"])
    requests = table(spark, sf_dir, "customer").select(F.lit("x").alias("axis"), F.col("c_custkey").alias("pos"))
    return formats.track_scores(requests, spark.read.parquet(path).withColumn("tile", F.col("tile").cast("long")), "axis", "pos", "score", 100).select("pos", "score")


@query("read_blocks", """
WITH p AS (SELECT DISTINCT o_orderstatus AS axis, o_orderkey AS pos FROM orders), f AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 4 THEN 0 ELSE 1 END AS new FROM p WINDOW w AS (PARTITION BY axis ORDER BY pos)),
c AS (SELECT *, sum(new) OVER (PARTITION BY axis ORDER BY pos) AS cluster FROM f), b AS (SELECT *, (pos - min(pos) OVER (PARTITION BY axis, cluster)) // 50 AS part FROM c)
SELECT axis, min(pos) AS start, max(pos) AS "end", count(*)::BIGINT AS positions FROM b GROUP BY axis, cluster, part""")
def read_blocks(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("axis"), F.col("o_orderkey").alias("pos"))
    return formats.read_blocks(rows, "axis", "pos", 50, 4)


# ---------------------------------------------------------------- hierarchies, reports, rules


@query("parent_roots", """
WITH RECURSIVE f AS (SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey >= 8 THEN (p_partkey // 2)::VARCHAR END AS parent FROM part),
r AS (SELECT id, id AS root FROM f WHERE parent IS NULL UNION ALL SELECT f.id, r.root FROM f JOIN r ON f.parent = r.id) SELECT id, root FROM r""")
def parent_roots(spark, sf_dir):
    key = F.col("p_partkey")
    parent = F.when(key >= 8, F.floor(key / 2).cast("string"))
    return formats.resolve_parents(table(spark, sf_dir, "part").select(key.cast("string").alias("id"), parent.alias("parent")))


@query("evidence_histogram", """
WITH s AS (SELECT o_orderpriority AS context, o_orderstatus AS status, o_custkey % 6 AS a, o_custkey % 3 AS b, o_orderkey % 4 AS c, o_orderkey % 2 AS d FROM orders),
l AS (SELECT context, status, 'taxon' AS counter, a AS n_site, b AS n_alt FROM s UNION ALL SELECT context, status, 'family', c, d FROM s)
SELECT context, counter, n_site, n_alt, count(*) FILTER (status = 'F')::BIGINT AS "F", count(*) FILTER (status = 'O')::BIGINT AS "O" FROM l WHERE n_site > 0 GROUP BY 1, 2, 3, 4""")
def evidence_histogram(spark, sf_dir):
    sites = table(spark, sf_dir, "orders").selectExpr("o_orderpriority AS context", "o_orderstatus", "o_custkey % 6 AS a", "o_custkey % 3 AS b", "o_orderkey % 4 AS c", "o_orderkey % 2 AS d")
    return hierarchy.evidence_histogram(sites, ["context"], [("taxon", "a", "b"), ("family", "c", "d")], "o_orderstatus", ["F", "O"])


_RANKS = f"list_position([{', '.join(repr(t) for t in labels.SEVERITY)}], x)"


@query("item_annotations", f"""
WITH l AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN 'failed' WHEN l_returnflag = 'N' THEN 'ok' ELSE 'missing' END AS status, concat_ws('|', {sql_pick(_TERMS, "l_partkey")}, {sql_pick(_TERMS, "l_suppkey")}) AS t FROM lineitem),
e AS (SELECT DISTINCT l_orderkey, trim(x) AS x FROM (SELECT l_orderkey, unnest(string_split(t, '|')) AS x FROM l WHERE status = 'ok') WHERE trim(x) <> ''),
o AS (SELECT l_orderkey, string_agg(x, '|' ORDER BY coalesce(nullif({_RANKS}, 0), 1000), x) AS terms FROM e GROUP BY 1)
SELECT l_orderkey, coalesce(any_value(terms), '') AS terms, CASE WHEN bool_or(status = 'ok') THEN 'ok' ELSE min(status) END AS status FROM l LEFT JOIN o USING (l_orderkey) GROUP BY 1""")
def item_annotations(spark, sf_dir):
    from tessera.plans.pipelines import annotations_by_item

    status = F.when(F.col("l_returnflag") == "A", "failed").when(F.col("l_returnflag") == "N", "ok").otherwise("missing")
    listed = F.concat_ws("|", pick(_TERMS, F.col("l_partkey")), pick(_TERMS, F.col("l_suppkey")))
    out = annotations_by_item(table(spark, sf_dir, "lineitem").select("l_orderkey", listed.alias("t"), status.alias("status")), ["l_orderkey"], "t", "status")
    return out.withColumn("terms", F.array_join("terms", "|"))


@query("detail_report", """
SELECT l_partkey AS item, string_agg(DISTINCT l_suppkey::VARCHAR, '|' ORDER BY l_suppkey::VARCHAR) AS genes, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) AS contexts,
  bit_or(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 4 END)::BIGINT AS mask, max(l_linenumber) AS stars, max(l_quantity) AS submissions FROM lineitem WHERE l_discount > 0.05 GROUP BY 1""")
def detail_report(spark, sf_dir):
    from tessera.operators import masks
    from tessera.plans.pipelines import detail_rows

    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item"), F.col("l_suppkey").cast("string").alias("gene_id"), F.col("l_linestatus").alias("context"),
        masks.member_bit("l_returnflag", ("A", "N", "R")).alias("mask"), F.col("l_linenumber").alias("stars"), F.col("l_quantity").alias("submissions"), "l_discount",
    )
    return detail_rows(rows, F.col("l_discount") > 0.05, "stars", "submissions")


@query("span_windows", f"WITH {_SPANS} SELECT g, min(s) AS s, max(e) AS e FROM spans GROUP BY 1")
def span_windows(spark, sf_dir):
    return aggregate.span_summary(_spans(spark, sf_dir), ["g"], "s", "e")


@query("support_summary", """
SELECT l_partkey, l_returnflag, round(avg(l_quantity), 6) AS mean, min(l_quantity) AS least, max(l_quantity) AS most, count(DISTINCT l_suppkey)::BIGINT AS observers, median(l_extendedprice) AS median_price,
  round(sum(l_discount * l_extendedprice) / sum(l_extendedprice), 9) AS weighted FROM lineitem GROUP BY 1, 2""")
def support_summary(spark, sf_dir):
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.round(F.avg(q), 6).alias("mean"), F.min(q).alias("least"), F.max(q).alias("most"), F.countDistinct("l_suppkey").alias("observers"),
        F.percentile("l_extendedprice", 0.5).alias("median_price"), F.round(F.sum(F.col("l_discount") * F.col("l_extendedprice")) / F.sum("l_extendedprice"), 9).alias("weighted"),
    )


@query("taxon_depth", f"""WITH {_SPANS}, p AS (SELECT o_custkey AS g, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS pos, o_orderkey AS site FROM orders WHERE o_orderstatus = 'F')
SELECT p.g, site, count(DISTINCT spans.item)::BIGINT AS species, count(DISTINCT spans.item % 7)::BIGINT AS genera, count(DISTINCT spans.item % 3)::BIGINT AS families FROM p JOIN spans ON spans.g = p.g AND pos >= s AND pos < e GROUP BY 1, 2""")
def taxon_depth(spark, sf_dir):
    """Distinct taxa of three ranks at each site, from the members that hold it."""
    spans = _spans(spark, sf_dir, "o_orderstatus")
    sites = spans.where("o_orderstatus = 'F'").select("g", F.col("s").alias("pos"), F.col("item").alias("site"))
    held = intervals.members_at(sites, spans, ["g"], "item", "pos", "s", "e")
    return held.groupBy("g", "site").agg(F.countDistinct("item").alias("species"), F.countDistinct(F.col("item") % 7).alias("genera"), F.countDistinct(F.col("item") % 3).alias("families"))


@query("longest_backbones", """
WITH RECURSIVE o AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, o_orderkey AS v FROM orders),
r AS (SELECT o_custkey, k, [v] AS vs, [1] AS ls FROM o WHERE k = 1 UNION ALL
  SELECT r.o_custkey, o.k, list_append(vs, v), list_append(ls, 1 + coalesce(list_max(list_transform(range(1, len(vs) + 1), lambda i: CASE WHEN vs[i] < v THEN ls[i] ELSE 0 END)), 0)) FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.k = r.k + 1)
SELECT o_custkey, max(list_max(ls))::BIGINT AS length FROM r GROUP BY 1""")
def longest_backbones(spark, sf_dir):
    """Rows of each customer's longest run of orders whose numbers rise with the date."""
    rows = table(spark, sf_dir, "orders")
    rank = F.struct("o_orderdate", "o_orderkey")
    placed = rows.select("o_custkey", F.to_json(rank).alias("unused"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("day"), F.col("o_orderkey").alias("target"), F.lit("+").alias("strand")).drop("unused")
    return sequence.backbone(placed, ["o_custkey"], "day", "target", "strand").groupBy("o_custkey").agg(F.count("*").alias("length"))


@query("support_violations", """
SELECT 'orphans' AS rule, count(*)::BIGINT AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'alt_above_site', count(*) FROM lineitem WHERE NOT l_linenumber <= l_quantity UNION ALL SELECT 'zero_depth', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'keys_differ', (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) + (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'status_and_key', count(*) FROM orders WHERE (o_orderstatus = 'F') <> (o_totalprice > 100000) UNION ALL SELECT 'rows', CASE WHEN (SELECT count(*) FROM orders) <> 7 THEN 1 ELSE 0 END""")
def support_violations(spark, sf_dir):
    orders, customers, lines = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    named = customers.withColumnRenamed("c_custkey", "o_custkey")
    checks = {
        "orphans": contracts.references("orders", orders.select("o_custkey"), named.where("c_acctbal > 0"), ["o_custkey"]),
        "alt_above_site": contracts.holds("alt", lines, F.col("l_linenumber") <= F.col("l_quantity")),
        "zero_depth": contracts.references("depth", named.select("o_custkey"), orders.select("o_custkey"), ["o_custkey"]),
        "keys_differ": contracts.same_keys("keys", named, orders, ["o_custkey"]),
        "status_and_key": contracts.holds("status", orders, (F.col("o_orderstatus") == "F") == (F.col("o_totalprice") > 100000)),
        "rows": contracts.row_count("orders", orders, 7),
    }
    out = None
    for rule, check in checks.items():
        one = check.violations.agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("cache_probe", """
SELECT c_custkey, n.total IS NOT NULL AS hit, n.total FROM customer LEFT JOIN (SELECT o_custkey, sum(o_orderkey)::BIGINT AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) n ON o_custkey = c_custkey""")
def cache_probe(spark, sf_dir):
    one = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_orderkey").alias("total"))
    hits, misses = contracts.split_lookup(table(spark, sf_dir, "customer").select("c_custkey"), one.unionByName(one), ["c_custkey"], "total")
    return hits.select("c_custkey", F.lit(True).alias("hit"), "total").unionByName(misses.select("c_custkey", F.lit(False).alias("hit"), F.lit(None).cast("long").alias("total")))


@query("reference_checks", """
SELECT o_orderkey, coalesce(c_name[o_orderkey % 20 + 1:o_orderkey % 20 + 1] = upper(o_orderstatus), false) AS matches FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def reference_checks(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c"), (F.col("o_orderkey") % 20).alias("at"), F.lower("o_orderstatus").alias("ref"))
    sequences = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"), F.col("c_name").alias("sequence"))
    return sequence.reference_matches(rows, sequences, "c", "at", "ref").select("o_orderkey", "matches")


@query("fasta_offsets", """
WITH c AS (SELECT c_custkey, c_name, '>' || c_custkey || ' é' AS head, c_mktsegment AS one, c_name AS two FROM customer)
SELECT c_custkey::VARCHAR || ' é' AS header, (len(one) + len(two) - CASE WHEN contains(one, ' ') THEN 1 ELSE 0 END)::BIGINT AS length, (strlen(head) + strlen(one) + strlen(two) + 3)::BIGINT AS bytes FROM c""")
def fasta_offsets(spark, sf_dir):
    """Lengths of records in bytes, from places in files that tile each file without a gap."""
    path = _path(spark, "fasta")
    head = F.concat(F.lit(">"), F.col("c_custkey").cast("string"), F.lit(" é"))
    table(spark, sf_dir, "customer").select(F.concat_ws("\n", head, "c_mktsegment", "c_name")).write.text(path)
    out = formats.fasta_slices(spark, path)
    before = F.coalesce(F.lag("end_offset").over(Window.partitionBy("file").orderBy("record_index")), F.lit(0))
    return out.withColumn("gap", F.col("start_offset") - before).where("gap = 0").select("header", "length", (F.col("end_offset") - F.col("start_offset")).alias("bytes"))


# Letters that a hexadecimal digest is turned into: long runs of one letter let indels move.
_HEX, _LETTERS = "0123456789abcdef", "AAAAAAAAAACCCGGT"
_KINDS, _PLACES, _STARTS, _INSERTED = ("snv", "del", "ins", "del", "ins", "mnv"), ("NC_000001.11", "23", "chrM", "NC_012920.1", "odd"), ("5", None, "12", "7", "x"), ("A", "AA", "c", "CA")


def _bases(number):
    return F.translate(F.md5(number.cast("string").cast("binary")), _HEX, _LETTERS)


@query("event_keys", f"""
WITH RECURSIVE e AS (SELECT o_orderkey, o_custkey, o_orderstatus, left(o_orderpriority, 1) AS priority, translate(md5(o_custkey::VARCHAR), '{_HEX}', '{_LETTERS}') AS s, o_orderkey % 36 AS t,
  {sql_pick(_KINDS, 'o_orderkey + o_custkey')} AS kind, {sql_pick(_PLACES, 'o_custkey')} AS place, {sql_pick(_STARTS, 'o_orderkey')} AS start1 FROM orders),
f AS (SELECT *, CASE kind WHEN 'snv' THEN substr(s, t + 1, 1) WHEN 'del' THEN CASE o_orderstatus WHEN 'P' THEN 'TT' ELSE substr(s, t + 1, 2) END WHEN 'ins' THEN '' ELSE 'AC' END AS ref,
  CASE kind WHEN 'snv' THEN CASE priority WHEN '5' THEN 'N' ELSE 'G' END WHEN 'del' THEN '' WHEN 'ins' THEN upper({sql_pick(_INSERTED, 'o_orderkey')}) ELSE 'GT' END AS alt FROM e),
g AS (SELECT f.*, CASE place WHEN 'NC_000001.11' THEN '1' WHEN '23' THEN 'X' WHEN 'odd' THEN NULL ELSE 'MT' END AS axis, CASE WHEN c_custkey IS NULL THEN 'raw_no_context' END AS lost,
  CASE priority WHEN '4' THEN NULL ELSE t END AS start0 FROM f LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey),
h AS (SELECT *, CASE WHEN contains(ref || alt, 'N') THEN 'non_concrete_allele' WHEN axis IS NULL THEN 'unknown_chrom' WHEN start1 = 'x' THEN 'bad_position' WHEN lost IS NOT NULL THEN lost
  WHEN start0 IS NULL THEN 'bad_target_position' WHEN kind = 'mnv' THEN 'unsupported_event_type' WHEN kind = 'snv' AND (len(ref) <> 1 OR len(alt) <> 1) THEN 'bad_snv_allele'
  WHEN kind = 'del' AND ref = '' THEN 'bad_del_allele' WHEN kind <> 'snv' AND start0 <= 0 THEN 'missing_left_anchor' ELSE 'ok' END AS first_status FROM g),
k AS (SELECT *, CASE WHEN kind = 'snv' THEN t ELSE t - 1 END AS p0, CASE WHEN kind = 'snv' THEN '' ELSE substr(s, t, 1) END AS anchor FROM h WHERE first_status = 'ok'),
n AS (SELECT o_orderkey, s, axis, o_custkey, p0, anchor || ref AS ref, anchor || alt AS alt FROM k),
c AS (SELECT *, CASE WHEN ref = '' OR alt = '' THEN 'unsupported_allele' WHEN p0 < 0 OR p0 + len(ref) > len(s) THEN 'out_of_target' WHEN substr(s, p0 + 1, len(ref)) <> ref THEN 'ref_mismatch' ELSE 'ok' END AS status FROM n),
m AS (SELECT o_orderkey, s, p0, ref, alt FROM c WHERE status = 'ok' UNION ALL
  SELECT o_orderkey, s, p0 - 1, substr(s, p0, 1) || left(ref, len(ref) - 1), substr(s, p0, 1) || left(alt, len(alt) - 1) FROM m WHERE p0 > 0 AND len(ref) <> len(alt) AND right(ref, 1) = right(alt, 1)),
l AS (SELECT o_orderkey, min(p0) AS p0, arg_min(ref, p0) AS ref, arg_min(alt, p0) AS alt FROM m GROUP BY 1)
SELECT h.o_orderkey, coalesce(c.status, first_status) AS key_status, h.axis, h.o_custkey * 1000 + l.p0 AS pos, l.ref AS key_ref, l.alt AS key_alt FROM h LEFT JOIN c USING (o_orderkey) LEFT JOIN l USING (o_orderkey)""")
def event_keys(spark, sf_dir):
    n, c, t = F.col("o_orderkey"), F.col("o_custkey"), (F.col("o_orderkey") % 36).cast("int")
    kind, s, priority = pick(_KINDS, n + c), _bases(c), F.left("o_orderpriority", F.lit(1))
    deleted = F.when(F.col("o_orderstatus") == "P", "TT").otherwise(F.substr(s, t + 1, F.lit(2)))
    events = table(spark, sf_dir, "orders").select(
        "o_orderkey", c.alias("gene_id"), kind.alias("event_type"), pick(_PLACES, c).alias("genomic_accession"), pick(_STARTS, n).alias("genomic_start1"),
        F.when(kind == "snv", F.substr(s, t + 1, F.lit(1))).when(kind == "del", deleted).when(kind == "ins", "").otherwise("AC").alias("ref"),
        F.when(kind == "snv", F.when(priority == "5", "N").otherwise("G")).when(kind == "del", "").when(kind == "ins", pick(_INSERTED, n)).otherwise("GT").alias("alt"),
        F.when(priority == "4", "q").otherwise(t.cast("string")).alias("target_start0"),
    )
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("gene_id"), (F.col("c_custkey") * 1000).alias("begin"), _bases(F.col("c_custkey")).alias("sequence"))
    out = sequence.left_normalised(sequence.anchored_events(events, known))
    ok = F.col("key_status") == "ok"
    return out.select("o_orderkey", "key_status", "axis", "pos", *(F.when(ok, F.col(x)).alias(x) for x in ("key_ref", "key_alt")))


@query("control_draws", f"""
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'C' ELSE 'A' END AS base, translate(md5(o_custkey::VARCHAR), '{_HEX}', '{_LETTERS}') AS s FROM orders JOIN customer ON c_custkey = o_custkey),
n AS (SELECT o_orderkey, base, least(5, len(s) - len(replace(s, base, '')))::BIGINT AS controls FROM o)
SELECT o_orderkey, base, controls, controls AS places, controls::INT AS last_rank, true AS same_base FROM n WHERE controls > 0""")
def control_draws(spark, sf_dir):
    """What the seeded draws must have in common: as many distinct places as there are, five at most, each with the focal's base."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    focals = orders.select(F.col("o_custkey").alias("gene"), "o_orderkey", F.when(F.col("o_orderstatus") == "F", "C").otherwise("A").alias("base"))
    start = F.col("c_custkey") * 100
    spans = customers.select(F.col("c_custkey").alias("gene"), start.alias("start"), (start + 32).alias("end"), _bases(F.col("c_custkey")).alias("sequence"))
    drawn = sequence.control_positions(focals, spans, "gene", "o_orderkey", "base", 5)
    checked = drawn.join(focals, ["gene", "o_orderkey"]).join(spans, "gene")
    same = F.substr("sequence", (F.col("position") - F.col("start") + 1).cast("int"), F.lit(1)) == F.col("base")
    return checked.groupBy("o_orderkey", "base").agg(
        F.count("*").alias("controls"), F.countDistinct("position").alias("places"), F.max("control_rank").alias("last_rank"), F.min(same).alias("same_base")
    )
