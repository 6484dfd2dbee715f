"""Classification ladders and coordinate expressions over texts and numbers that order columns select."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import keys, labels
from tessera.operators import dedupe, masks, selectors
from tessera.plans.registry import query, table


def pick(values, number):
    """The value at ``number`` modulo their count."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def sql_pick(values, number: str) -> str:
    return f"{sql_list(values)}[(({number}) % {len(values)} + 1)::INT]"


_SIGNIFICANCE = (
    "Pathogenic", "Likely_pathogenic", "Pathogenic/Likely pathogenic", "Benign", "Likely benign", "Uncertain significance", "Conflicting classifications of pathogenicity",
    "risk factor", "", None, "Pathogenic|Likely pathogenic", " Pathogenic, low penetrance", "VUS-high", "Benign/Pathogenic", "likely_pathogenic/_low_penetrance|drug response",
)


@query("significance_ladder", f"""
WITH o AS (SELECT o_orderkey, {sql_pick(_SIGNIFICANCE, "o_orderkey")} AS s, o_orderstatus = 'F' AS found, o_orderstatus = 'P' AS failed FROM orders),
c AS (SELECT *, CASE WHEN coalesce(s, '') = '' THEN NULL WHEN contains(lower(s), 'conflicting') THEN 'Other' WHEN regexp_matches(lower(s), 'uncertain|vus') THEN 'VUS'
  WHEN contains(lower(s), 'benign') AND NOT contains(lower(s), 'pathogenic') THEN 'B/LB' WHEN contains(lower(s), 'pathogenic') AND NOT contains(lower(s), 'benign') THEN 'P/LP' ELSE 'Other' END AS class,
  replace(lower(trim(s)), ' ', '_') AS t FROM o),
i AS (SELECT *, list_transform(string_split(t, '|'), lambda x: regexp_replace(x, '[,/]_?low_penetrance', '', 'g')) AS items FROM c),
f AS (SELECT *, len(list_filter(items, lambda x: contains(x, 'likely_pathogenic'))) > 0 AS likely, len(list_filter(items, lambda x: contains(x, 'pathogenic') AND NOT contains(x, 'likely_pathogenic'))) > 0 AS plain,
  len(list_filter(items, lambda x: contains(x, 'pathogenic/likely_pathogenic'))) > 0 AS both_of FROM i)
SELECT o_orderkey, class, CASE WHEN NOT found THEN 'Not in ClinVar' ELSE coalesce(class, 'Unclassified') END AS category,
  CASE WHEN class = 'P/LP' THEN CASE WHEN both_of OR (likely AND plain) THEN 'Pathogenic / likely pathogenic' WHEN likely THEN 'Likely pathogenic' WHEN plain THEN 'Pathogenic' ELSE 'Pathogenic / likely pathogenic' END END AS subtype,
  coalesce(class = 'P/LP' AND contains(t, 'low_penetrance'), false) AS low_penetrance,
  CASE WHEN found THEN 'found' WHEN failed THEN 'lookup_failed' ELSE 'not_found' END AS status, CASE WHEN failed THEN 'lookup_failed' WHEN found THEN 'found' ELSE 'not_found' END AS strict FROM f""")
def significance_ladder(spark, sf_dir):
    found, failed = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P"
    rows = table(spark, sf_dir, "orders").withColumn("s", pick(_SIGNIFICANCE, F.col("o_orderkey"))).withColumn("p", labels.pathogenic_subtype("s"))
    return rows.select(
        "o_orderkey", labels.significance_class("s").alias("class"), labels.record_category("s", found).alias("category"), "p.subtype", "p.low_penetrance",
        labels.lookup_status(found, failed).alias("status"), labels.lookup_status(found, failed, found_first=False).alias("strict"),
    )


_REVIEWS = (
    "criteria_provided,_single_submitter", "reviewed by expert panel", "practice_guideline|practice_guideline", "no_assertion_provided|practice_guideline", "of no known kind",
    "", None, "criteria_provided,_conflicting_classifications|criteria_provided,_single_submitter", " Practice_Guideline ", "practice_guideline|new_status",
)
_STARS = "map {" + ", ".join(f"{quoted(k)}: {v}" for k, v in labels.REVIEW_STARS.items()) + "}"


@query("review_ladder", f"""
WITH o AS (SELECT o_orderkey, {sql_pick(_REVIEWS, "o_orderkey + o_custkey")} AS s FROM orders),
i AS (SELECT o_orderkey, list_transform(list_filter(string_split(coalesce(s, ''), '|'), lambda x: x <> ''), lambda x: replace(lower(trim(x)), ' ', '_')) AS items FROM o),
m AS (SELECT *, list_transform(items, lambda x: {_STARS}[x]) AS stars, list_filter(items, lambda x: {_STARS}[x] IS NULL) AS unknown FROM i),
s AS (SELECT *, CASE WHEN len(items) = 0 THEN 'missing' WHEN len(unknown) > 0 THEN 'unmapped:' || unknown[1] WHEN len(list_distinct(stars)) > 1 THEN 'ambiguous_multiple_review_statuses' ELSE 'mapped' END AS status FROM m)
SELECT o_orderkey, CASE WHEN status = 'mapped' THEN stars[1] END AS stars, status FROM s""")
def review_ladder(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("s", pick(_REVIEWS, F.col("o_orderkey") + F.col("o_custkey")))
    return rows.select("o_orderkey", labels.review_stars("s").alias("r")).select("o_orderkey", "r.stars", "r.status")


_TERMS = (
    "missense_variant", "stop_gained", "synonymous_variant", "intron_variant", "made_up_term", "splice_donor_variant", "splice_region_variant", "stop_lost", "3_prime_UTR_variant",
    "", "frameshift_variant", "intergenic_variant", None,
)
_SEVERITY = sql_list(labels.SEVERITY)
_RANK = f"CASE WHEN list_position({_SEVERITY}, {{0}}) > 0 THEN list_position({_SEVERITY}, {{0}}) - 1 ELSE {len(labels.SEVERITY)} END"
_ALL_TERMS = sql_list(t for ts in labels.GROUPS.values() for t in ts)


@query("consequence_ladder", f"""
WITH o AS (SELECT l_orderkey, l_linenumber, {sql_pick(_TERMS, "l_partkey")} AS a, {sql_pick(_TERMS, "l_suppkey + l_linenumber")} AS b, l_linestatus = 'O' AS good FROM lineitem),
t AS (SELECT *, CASE WHEN good AND coalesce(a, '') <> '' THEN a ELSE '__not_annotated__' END AS term, concat_ws('|', a, b, ' ' || b) AS listed FROM o),
i AS (SELECT *, list_filter(list_transform(string_split(listed, '|'), lambda x: trim(x)), lambda x: x <> '') AS items FROM t),
g AS (SELECT *, list_filter([{", ".join(f"CASE WHEN list_has_any(items, {sql_list(ts)}) THEN {quoted(g)} END" for g, ts in labels.GROUPS.items())},
  CASE WHEN len(items) = 0 OR len(list_filter(items, lambda x: NOT list_contains({_ALL_TERMS}, x))) > 0 THEN 'other' END], lambda x: x IS NOT NULL) AS groups FROM i)
SELECT l_orderkey, l_linenumber, term, array_to_string(groups, ',') AS groups, ({" + ".join(f"CASE WHEN list_contains(groups, {quoted(g)}) THEN {1 << k} ELSE 0 END" for k, g in enumerate((*labels.GROUPS, "other")))})::BIGINT AS mask,
  CASE WHEN term = '__not_annotated__' THEN 'Not annotated' {" ".join(f"WHEN list_contains({sql_list(ts)}, term) THEN {quoted(g)}" for g, ts in labels.DISPLAY_GROUPS.items())} ELSE 'Other' END AS display,
  ({_RANK.format("term")})::INT AS rank, (SELECT coalesce(string_agg(x, '|' ORDER BY {_RANK.format("x")}, x), '') FROM (SELECT DISTINCT unnest(items) AS x)) AS by_severity FROM g""")
def consequence_ladder(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", pick(_TERMS, F.col("l_partkey")).alias("a"), pick(_TERMS, F.col("l_suppkey") + F.col("l_linenumber")).alias("b"))
    status = F.when(F.col("l_linestatus") == "O", "ok").otherwise("failed")
    rows = rows.withColumns({"term": labels.consequence_or_default("a", status), "listed": F.concat_ws("|", "a", "b", F.concat(F.lit(" "), "b"))})
    return rows.select(
        "l_orderkey", "l_linenumber", "term", F.array_join(labels.consequence_groups("listed"), ",").alias("groups"), labels.consequence_mask("listed").alias("mask"),
        labels.display_group("term").alias("display"), labels.severity_rank("term").alias("rank"), F.array_join(labels.by_severity(labels.set_items("listed")), "|").alias("by_severity"),
    )


@query("frequency_ladder", """
WITH o AS (SELECT o_orderkey, o_orderkey % 7 - 1 AS ac, o_custkey % 5 * 1000 AS an, CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1e6 END AS exome, CASE WHEN o_orderpriority < '4' THEN o_totalprice / 2e6 END AS genome,
  CASE WHEN o_orderstatus = 'P' THEN 'nan'::DOUBLE WHEN o_orderstatus = 'O' THEN NULL ELSE (o_totalprice - 250000) / 100000 END AS score FROM orders),
j AS (SELECT *, CASE WHEN an > 0 AND ac >= 0 THEN ac::DOUBLE / an END AS joint FROM o)
SELECT o_orderkey, round(coalesce(joint, exome, genome), 9) AS af, CASE WHEN joint IS NOT NULL THEN 'joint' WHEN exome IS NOT NULL THEN 'exome' WHEN genome IS NOT NULL THEN 'genome' END AS source,
  CASE WHEN score IS NULL OR isnan(score) THEN NULL WHEN score <= -1.30103 THEN 'acceleration' WHEN score >= 1.30103 THEN 'conservation' ELSE 'central' END AS band,
  CASE WHEN coalesce(joint, exome, genome) > 0 THEN round(log10(coalesce(joint, exome, genome)), 9) END AS log_af FROM j""")
def frequency_ladder(spark, sf_dir):
    n, price = F.col("o_orderkey"), F.col("o_totalprice")
    af = labels.selected_frequency(n % 7 - 1, F.col("o_custkey") % 5 * 1000, F.when(F.col("o_orderstatus") == "F", price / 1e6), F.when(F.col("o_orderpriority") < "4", price / 2e6))
    score = F.when(F.col("o_orderstatus") == "P", float("nan")).when(F.col("o_orderstatus") == "F", (price - 250000) / 100000)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", af.alias("f"), labels.score_band(score).alias("band"))
    return rows.select("o_orderkey", F.round("f.af", 9).alias("af"), "f.source", "band", F.round(labels.log10_positive("f.af"), 9).alias("log_af"))


@query("consequence_pair_lists", """
WITH o AS (SELECT o_orderkey, concat_ws(',', 'SO:' || (o_custkey % 3) || '|missense', 'SO:' || (o_orderkey % 3) || '|missense', 'bad', 'SO:0|' || o_orderstatus) AS t FROM orders),
e AS (SELECT o_orderkey, k, x FROM (SELECT o_orderkey, unnest(string_split(t, ',')) AS x, generate_subscripts(string_split(t, ','), 1) AS k FROM o) WHERE contains(x, '|')),
d AS (SELECT o_orderkey, x, min(k) AS k FROM e GROUP BY 1, 2)
SELECT o_orderkey, string_agg(split_part(x, '|', 1) || '=' || split_part(x, '|', 2), ';' ORDER BY k) AS pairs FROM d GROUP BY 1""")
def consequence_pair_lists(spark, sf_dir):
    part = lambda c, k: F.concat(F.lit("SO:"), (F.col(c) % 3).cast("string"), F.lit(f"|{k}"))
    text = F.concat_ws(",", part("o_custkey", "missense"), part("o_orderkey", "missense"), F.lit("bad"), F.concat(F.lit("SO:0|"), "o_orderstatus"))
    pairs = F.transform(labels.consequence_pairs(text), lambda p: F.concat_ws("=", p["id"], p["term"]))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(pairs, ";").alias("pairs"))


_NAMES = ("not_provided", "Long QT syndrome", "Breast%20cancer", "a+b", ".", "Marfan syndrome", "Long_QT_syndrome")
_IDS = ("MedGen:C1,OMIM:7", "OMIM:8,MONDO:5", "", ".", "Orphanet:3,HP:2", "MONDO:5")
_CONDITIONS = f"""o AS (SELECT o_orderkey, o_orderstatus, concat_ws('|', {sql_pick(_NAMES, "o_orderkey")}, {sql_pick(_NAMES, "o_custkey")}) AS names, concat_ws('|', {sql_pick(_IDS, "o_custkey")}, {sql_pick(_IDS, "o_orderkey")}) AS ids FROM orders),
e AS (SELECT o_orderkey, unnest([1, 2]) AS k, string_split(names, '|') AS n, string_split(ids, '|') AS i FROM o),
p AS (SELECT o_orderkey, k, replace(trim(url_decode(n[k])), ' ', '_') AS name, list_filter(string_split(i[k], ','), lambda x: x <> '' AND x <> '.') AS own FROM e),
named AS (SELECT o_orderkey, k, name, coalesce(list_filter(own, lambda x: starts_with(x, 'MedGen:'))[1], list_filter(own, lambda x: starts_with(x, 'MONDO:'))[1], list_filter(own, lambda x: starts_with(x, 'OMIM:'))[1], nullif(array_to_string(own, ','), ''), name) AS key
  FROM p WHERE lower(name) NOT IN ('', '.', 'not_provided', 'not_specified')),
conditions AS (SELECT o_orderkey, key, arg_min(name, k) AS name, min(k) AS k FROM named GROUP BY 1, 2)"""


def _condition_rows(spark, sf_dir):
    n, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.concat_ws("|", pick(_NAMES, n), pick(_NAMES, c)).alias("names"), F.concat_ws("|", pick(_IDS, c), pick(_IDS, n)).alias("ids")
    )


@query("condition_lists", f"WITH {_CONDITIONS} SELECT o_orderkey, string_agg(key || '=' || name, ';' ORDER BY k) AS conditions FROM conditions GROUP BY 1")
def condition_lists(spark, sf_dir):
    found = F.transform(labels.conditions("names", "ids"), lambda x: F.concat_ws("=", x["key"], x["name"]))
    return _condition_rows(spark, sf_dir).select("o_orderkey", F.array_join(found, ";").alias("conditions")).where("conditions <> ''")


@query("condition_report", f"""WITH {_CONDITIONS}
SELECT key AS condition, min(name) AS name, count(DISTINCT o_orderkey)::BIGINT AS items, (SELECT count(DISTINCT o_orderkey) FROM conditions)::BIGINT AS named_items, (SELECT count(*) FROM orders)::BIGINT AS total_items FROM conditions GROUP BY 1""")
def condition_report(spark, sf_dir):
    from tessera.plans.pipelines import condition_distribution

    return condition_distribution(_condition_rows(spark, sf_dir), ["o_orderkey"], "names", "ids")


_REFS, _ALTS = ("A", "C", "AT", "ACG", "ACCT"), ("G", "T", "A", "ACT", "ACCGT", "ATT", "N")
_ALLELES = f"a AS (SELECT o_orderkey, o_custkey, o_orderkey % 97 + 1 AS pos, {sql_pick(_REFS, 'o_orderkey')} AS ref, {sql_pick(_ALTS, 'o_custkey + o_orderkey')} AS alt FROM orders)"


def _alleles(spark, sf_dir):
    n = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (n % 97 + 1).alias("pos"), pick(_REFS, n).alias("ref"), pick(_ALTS, F.col("o_custkey") + n).alias("alt"))


@query("condition_background", f"""WITH {_CONDITIONS}, {_ALLELES},
r AS (SELECT o_orderkey, orders.o_orderstatus AS axis, pos, ref, alt, CASE left(o_orderpriority, 1) WHEN '4' THEN 'benign' ELSE 'pathogenic' END AS label, CASE WHEN len(ref) = 1 AND len(alt) = 1 THEN 'snv' ELSE 'indel' END AS kind
  FROM orders JOIN a USING (o_orderkey) WHERE alt <> 'N' AND (len(ref) <> len(alt) OR len(ref) = 1) AND o_orderpriority < '5'),
pure AS (SELECT axis, pos, ref, alt, any_value(kind) AS kind FROM r GROUP BY 1, 2, 3, 4 HAVING min(label) = 'pathogenic'),
c AS (SELECT axis, pos, ref, alt, r.kind, key, min(name) AS name FROM pure JOIN r USING (axis, pos, ref, alt) JOIN conditions USING (o_orderkey) GROUP BY 1, 2, 3, 4, 5, 6),
n AS (SELECT key, min(name) AS name FROM c GROUP BY 1), i AS (SELECT kind, key, count(*)::BIGINT AS items FROM c GROUP BY 1, 2),
t AS (SELECT kind, count(*)::BIGINT AS total_items FROM pure GROUP BY 1), d AS (SELECT kind, count(DISTINCT (axis, pos, ref, alt))::BIGINT AS named_items FROM c GROUP BY 1)
SELECT t.kind, coalesce(key, '') AS condition, coalesce(n.name, '') AS name, coalesce(items, 0)::BIGINT AS items, total_items, coalesce(named_items, 0)::BIGINT AS named_items
FROM t LEFT JOIN d USING (kind) LEFT JOIN i USING (kind) LEFT JOIN n USING (key)""")
def condition_background_query(spark, sf_dir):
    from tessera.plans.pipelines import condition_background

    first = F.left("o_orderpriority", F.lit(1))
    text = F.when(first == "4", "Likely benign").when(first == "5", "Uncertain significance").otherwise("Pathogenic")
    alleles = _alleles(spark, sf_dir).drop("o_custkey").join(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("significance")), "o_orderkey")
    records = alleles.join(_condition_rows(spark, sf_dir).withColumnRenamed("o_orderstatus", "axis"), "o_orderkey")
    return condition_background(records, ["axis", "pos"], "ref", "alt", "significance", "names", "ids")


@query("allele_positions", f"""WITH {_ALLELES},
l AS (SELECT *, (SELECT count(*) FROM range(1, 9) t(i) WHERE i <= least(len(ref), len(alt)) AND ref[1:i] = alt[1:i])::INT AS lead FROM a),
r AS (SELECT *, ref[lead + 1:] AS r1, alt[lead + 1:] AS a1 FROM l),
t AS (SELECT *, (SELECT count(*) FROM range(1, 9) t(i) WHERE i <= least(len(r1), len(a1)) AND reverse(r1)[1:i] = reverse(a1)[1:i])::INT AS tail FROM r),
n AS (SELECT *, len(r1) - tail AS nr, len(a1) - tail AS na, pos + lead AS place FROM t)
SELECT o_orderkey, CASE WHEN len(ref) = 1 AND len(alt) = 1 THEN 'snv' WHEN len(alt) > len(ref) THEN 'insertion' WHEN len(alt) < len(ref) THEN 'deletion' ELSE 'other' END AS subtype,
  CASE WHEN nr = 1 AND na = 1 THEN place::VARCHAR WHEN nr > 0 AND na = 0 THEN array_to_string(range(place, place + nr), ',') WHEN nr = 0 AND na > 0 THEN (place - 1) || ',' || place ELSE '' END AS offsets,
  pos - o_custkey + lead AS changed, CASE WHEN o_orderkey % 4 = 0 THEN 'g' || o_custkey || ':' || '' || ':' || ref || '>' || alt ELSE 'k' || o_orderkey END AS item FROM n""")
def allele_positions(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))).otherwise(pick((None, ""), F.col("o_custkey")))
    group = F.concat(F.lit("g"), F.col("o_custkey").cast("string"))
    return _alleles(spark, sf_dir).select(
        "o_orderkey", keys.change_subtype("ref", "alt").alias("subtype"), F.array_join(keys.score_offsets("pos", "ref", "alt"), ",").alias("offsets"),
        keys.changed_offset("pos", "o_custkey", "ref", "alt").alias("changed"), keys.item_id(key, group, F.lit(None).cast("string"), "ref", "alt").alias("item"),
    )


_AXES = ("NC_000001.11", "NC_000023.11", "NC_012920.1", "chrM", "chr7", " 22 ", "X", "junk", "", "NC_000024.10", None, "chrY")


@query("axis_names", f"""
WITH o AS (SELECT o_orderkey, {sql_pick(_AXES, "o_orderkey")} AS v FROM orders),
b AS (SELECT *, CASE WHEN regexp_replace(trim(v), '^chr', '') = 'M' THEN 'MT' ELSE nullif(regexp_replace(trim(v), '^chr', ''), '') END AS name FROM o),
n AS (SELECT *, nullif(regexp_extract(name, 'NC_0+([0-9]+)\\.', 1), '') AS acc FROM b),
x AS (SELECT o_orderkey, CASE WHEN name IN ('X', 'Y', 'MT') THEN name WHEN acc IN ('12920', '1807') THEN 'MT' WHEN coalesce(acc, name) = '23' THEN 'X' WHEN coalesce(acc, name) = '24' THEN 'Y' ELSE try_cast(coalesce(acc, name) AS BIGINT)::VARCHAR END AS axis FROM n)
SELECT o_orderkey, axis, coalesce(try_cast(axis AS INT), CASE axis WHEN 'X' THEN 1001 WHEN 'Y' THEN 1002 WHEN 'MT' THEN 1003 ELSE 2000 END) AS place FROM x""")
def axis_names(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", keys.axis_of_accession(pick(_AXES, F.col("o_orderkey"))).alias("axis"))
    return rows.withColumn("place", keys.axis_order("axis"))


@query("alignment_measures", """
WITH l AS (SELECT l_orderkey, l_linenumber, (l_quantity::INT) || 'M' || l_linenumber || 'I' || (l_partkey % 9 + 1) || 'D' || (l_suppkey % 5) || 'S' AS cigar, (l_partkey * 256) % 4096 AS flag, l_partkey % 70 AS nm, l_returnflag = 'R' AS reverse FROM lineitem),
n AS (SELECT *, list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MID=X]', 1), lambda x: x::BIGINT)) AS block FROM l)
SELECT l_orderkey, l_linenumber, CASE WHEN flag & 256 <> 0 AND flag & 2048 <> 0 THEN 'secondary_supplementary' WHEN flag & 256 <> 0 THEN 'secondary' WHEN flag & 2048 <> 0 THEN 'supplementary' ELSE 'primary' END AS role,
  block::BIGINT AS block, CASE WHEN block > 0 THEN round(greatest(0, block - nm)::DOUBLE / block, 9) END AS identity,
  1000 + CASE WHEN reverse THEN 500 - (40 + l_linenumber) ELSE 10 + l_linenumber END AS lifted_start, 1000 + CASE WHEN reverse THEN 500 - (10 + l_linenumber) ELSE 40 + l_linenumber END AS lifted_end,
  l_orderkey + 3 AS span_start, CASE WHEN nm > 3 THEN l_orderkey + nm - 1 ELSE l_orderkey + 3 END AS span_end FROM n""")
def alignment_measures(spark, sf_dir):
    text = lambda c: c.cast("string")
    cigar = F.concat(text(F.col("l_quantity").cast("int")), F.lit("M"), text(F.col("l_linenumber")), F.lit("I"), text(F.col("l_partkey") % 9 + 1), F.lit("D"), text(F.col("l_suppkey") % 5), F.lit("S"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", cigar.alias("cigar"), (F.col("l_partkey") * 256 % 4096).alias("flag"), (F.col("l_partkey") % 70).alias("nm"))
    strand = F.when(F.col("l_returnflag") == "R", "-").otherwise("+")
    rows = rows.withColumns({
        "lifted": keys.lifted_span(F.lit(1000), F.lit(500), F.lit(10), F.lit(40), strand, "l_linenumber"), "span": keys.source_span("l_orderkey", F.lit(3), "nm"),
    })
    return rows.select(
        "l_orderkey", "l_linenumber", keys.alignment_role("flag").alias("role"), keys.cigar_length("cigar").alias("block"), F.round(keys.alignment_identity("cigar", "nm"), 9).alias("identity"),
        F.col("lifted.start0").alias("lifted_start"), F.col("lifted.end0").alias("lifted_end"), F.col("span.start1").alias("span_start"), F.col("span.end1").alias("span_end"),
    )


_ALLOWED = ("P", "O")


@query("eligibility", """
WITH o AS (SELECT o_orderkey, o_orderstatus || ' , ' || o_orderpriority[1:1] AS listed, o_orderpriority FROM orders)
SELECT o_orderkey, ((CASE WHEN o_orderpriority[1:1] = '1' THEN 1 ELSE 0 END) + (CASE WHEN listed[1:1] = 'F' THEN 2 ELSE 0 END) + (CASE WHEN listed[1:1] = 'O' THEN 4 ELSE 0 END))::BIGINT AS mask,
  listed[1:1] <> 'F' AND o_orderpriority[1:1] <> '1' AS free, listed[1:1] IN ('P', 'O') AS eligible FROM o""")
def eligibility(spark, sf_dir):
    listed = F.concat_ws(" , ", "o_orderstatus", F.left("o_orderpriority", F.lit(1)))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", masks.mask_of_text(listed, ("1", "F", "O")).alias("mask"), labels.set_items(listed, ",").alias("groups"))
    return rows.select("o_orderkey", "mask", masks.mask_excludes("mask", 3).alias("free"), selectors.eligible(F.col("groups"), F.array(*map(F.lit, _ALLOWED))).alias("eligible"))


@query("distinct_requests", """
WITH r AS (SELECT o_custkey, unnest(string_split(o_orderstatus || '| ' || o_orderpriority || '|' || o_orderstatus, '|')) AS gene FROM orders)
SELECT DISTINCT o_custkey::VARCHAR AS key, trim(gene) AS gene FROM r""")
def distinct_requests(spark, sf_dir):
    listed = F.concat_ws("|", "o_orderstatus", F.concat(F.lit(" "), "o_orderpriority"), "o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("key"), listed.alias("listed"))
    return dedupe.distinct_requests(rows, "key", "listed", F.col("key").rlike("^[0-9]+$"), "gene")


@query("alias_lookup", """
WITH a AS (SELECT unnest([o_custkey::VARCHAR, 'c' || (o_custkey % 50)]) AS alias, o_orderkey, o_orderdate FROM orders),
b AS (SELECT alias, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM a GROUP BY 1),
q AS (SELECT c_custkey, CASE WHEN c_mktsegment < 'C' THEN 'c' || (c_custkey % 60) ELSE c_custkey::VARCHAR END AS alias FROM customer)
SELECT c_custkey, alias, o_orderkey FROM q LEFT JOIN b USING (alias)""")
def alias_lookup(spark, sf_dir):
    short = lambda c, n: F.concat(F.lit("c"), (F.col(c) % n).cast("string"))
    orders = table(spark, sf_dir, "orders").withColumn("aliases", F.array(F.col("o_custkey").cast("string"), short("o_custkey", 50)))
    wanted = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_mktsegment") < "C", short("c_custkey", 60)).otherwise(F.col("c_custkey").cast("string")).alias("alias"))
    return dedupe.alias_lookup(wanted, orders, "alias", "aliases", "o_orderkey", "o_orderdate").select("c_custkey", "alias", "o_orderkey")


@query("number_texts", """
SELECT o_orderkey, printf('%.6f', o_totalprice * sqrt(2)) AS fixed, printf('%.6g', v) AS general FROM (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN o_totalprice * sqrt(2) * (o_custkey + 1) WHEN 'O' THEN o_totalprice * sqrt(2) / 1e9 / (o_custkey + 1) ELSE -round(o_totalprice / 1000) END AS v FROM orders)""")
def number_texts(spark, sf_dir):
    price, n = F.col("o_totalprice"), F.col("o_custkey") + 1
    v = F.when(F.col("o_orderstatus") == "F", price * F.sqrt(F.lit(2.0)) * n).when(F.col("o_orderstatus") == "O", price * F.sqrt(F.lit(2.0)) / 1e9 / n).otherwise(-F.round(price / 1000))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.fixed_text(price * F.sqrt(F.lit(2.0))).alias("fixed"), labels.general_text(v).alias("general"))


@query("utc_times", """
WITH t AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS plain, user_id % 5 AS form FROM events)
SELECT event_id, CASE WHEN form IN (0, 1) THEN epoch_us(date_trunc('second', ts)) WHEN form = 2 THEN epoch_us(ts) END AS micros FROM t""")
def utc_times(spark, sf_dir):
    ts, form = F.col("ts").cast("timestamp"), F.col("user_id") % 5
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(form == 0, F.concat(plain, F.lit("Z"))).when(form == 1, F.concat(plain, F.lit("+00:00")))
        .when(form == 2, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))).when(form == 3, F.concat(plain, F.lit("+02:00"))).otherwise(F.concat(F.lit("2024-13-01"), F.lit("T00:00:00Z")))
    )
    return table(spark, sf_dir, "events").select("event_id", labels.utc_micros(text).alias("micros"))
