import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators.contracts import DataContractError
from tessera.plans import pipelines as P
from tessera.streaming import sessions


def test_filter_curves_and_associations(spark):
    support = spark.createDataFrame(
        [("1:10:A>G", "s1", 3, 2, 10, "snv"), ("1:10:A>G", "s2", 2, 1, 10, "snv"), ("1:10:A>G", "s1", 2, 1, 20, "snv"), ("1:10000020:C>T", "s1", 1, 1, 10, "snv")],
        "item string, strategy string, ortholog long, family long, aligned long, kind string",
    )
    scores = P.filter_scores(support)
    items = spark.createDataFrame([("1:10:A>G", "snv", "found"), ("1:10000020:C>T", "snv", "not_found")], "item string, kind string, status string")
    c = {(r["strategy"], r["filter"], r["threshold"]): r for r in P.filter_curves(scores, items).collect()}
    one = c["union", "strategy", 2]
    assert (one["retained"], one["found_fraction"], c["union", "strategy", 1]["retained"]) == (1, 1.0, 2)
    assert (c["union", "ortholog", 3]["retained"], c["union", "ortholog", 3]["total"], c["union", "ortholog", 4]["retained"]) == (1, 2, 0)
    assert c["union", "aligned_max", 10]["retained"] == 1 and c["union", "aligned_min", 11]["retained"] == 0
    with pytest.raises(DataContractError):
        P.filter_scores(support.union(spark.createDataFrame([("x", "union", 1, 0, 1, "snv")], support.schema)))
    cohort = spark.createDataFrame([("1:10:A>G", "benign"), ("1:10000020:C>T", "pathogenic"), ("none", "benign")], "item string, label_class string")
    r = P.filter_associations(scores, cohort, "ortholog").where("strategy = 'union' and threshold = 2").first()
    assert (r["a"], r["b"], r["c"], r["d"], r["odds_ratio"], r["status"]) == (1, 0, 1, 1, float("inf"), "estimated")


def test_item_summary(spark, rows):
    src = spark.createDataFrame(
        [
            ("chr1:105:A>G", "g1", "snv", "A", "G", "s1, s2", "ok", "missense_variant", "0.2", "Benign"),
            ("1:105:A>G", "g2", "snv", "A", "G", "s2", "ok", "intron_variant", "", "Benign"),
            ("", "g1", "ins", "", "T", "s1", "failed", "", "", ""),
        ],
        "variant_key string, gene_id string, event_type string, ref string, alt string, strategies string, vep_status string, vep_primary_consequence string, af string, cls string",
    )
    src = src.withColumn("variant_key", F.regexp_replace("variant_key", "^chr", ""))
    begins = spark.createDataFrame([("g1", 100), ("g2", 50)], "gene_id string, begin long")
    contexts = spark.createDataFrame([("g1", 0, 6, "cds"), ("g2", 50, 60, "intron")], "gene_id string, start long, end long, context string")
    failures = spark.createDataFrame([("1", 100, 101)], "axis string, start long, end long")
    n = P.normalised_rows(src, ("s1", "s2"), begins, contexts, failures, ["af", "cls"], ["af"], "af", "cls")
    assert rows(n, "item", "gene_id", "context", "status", "af", "mask") == [
        ("1:105:A>G", "g1", "cds", "found", 0.2, 3), ("1:105:A>G", "g2", "intron", "found", 0.2, 2), ("g1:ins:>T", "g1", "other", "not_found", None, 1),
    ]
    by_gene, by_item = P.item_relations(n, "af")
    assert rows(by_item, "item", "mask", "genes", "rows") == [("1:105:A>G", 3, 2, 2), ("g1:ins:>T", 1, 1, 1)]
    assert by_gene.count() == 3
    t = {r["member"]: r for r in P.strategy_table(by_item, ("s1", "s2"), "af").collect()}
    assert (t["s1"]["items"], t["s1"]["unique_items"], t["s1"]["transitions"], t["s2"]["found"]) == (2, 1, 1, 1)
    with pytest.raises(DataContractError):
        P.normalised_rows(src.withColumn("strategies", F.lit("zz")), ("s1",), begins, contexts, failures, ["af"], ["af"], "af", "cls").count()


def test_universe_conditions_and_cohorts(spark, rows):
    rec = spark.createDataFrame([("a", "Benign", "x"), ("a", "Likely_benign", "y"), ("b", "Benign", "x"), ("b", "Pathogenic", "x"), ("c", "VUS", "x")], "k string, sig string, t string")
    one, diag = P.labelled_universe(rec, ["k"], "sig", ["t"])
    assert rows(one, "k", "label_class", "t", "records") == [("a", "benign", "x|y", 2)] and diag.first()["mixed_labels"] == 1
    items = spark.createDataFrame([("a", "D1|D2", "MedGen:1|MedGen:2"), ("b", "D1", "MedGen:1"), ("c", "not_provided", ".")], "k string, names string, ids string")
    assert rows(P.condition_distribution(items, ["k"], "names", "ids")) == [("MedGen:1", "D1", 2, 3, 2), ("MedGen:2", "D2", 1, 3, 2)]
    ann = spark.createDataFrame([("a", "intron_variant", "ok"), ("a", "stop_gained|intron_variant", "ok"), ("b", "x", "failed")], "k string, terms string, status string")
    assert rows(P.annotations_by_item(ann, ["k"], "terms", "status")) == [("a", ["stop_gained", "intron_variant"], "ok"), ("b", [], "failed")]
    small = spark.createDataFrame([("z", "snv", "c")], "k string, kind string, condition string")
    with pytest.raises(DataContractError):
        P.cohort_comparison({"observed": small, "everything": small.limit(0)}, "k", "kind", "condition")


def test_streams_agree_with_batches(spark, tmp_path):
    data = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:04:00"), ("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 00:00:30"), ("a", "2024-01-01 09:00:00")]
    df = spark.createDataFrame(data, "g string, t string").select("g", F.col("t").cast("timestamp").alias("at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = sessions.session_clusters(stream, ["g"], "at", "10 minutes", "1 hour").writeStream.format("memory").queryName("clusters").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["g"], r["rows"]) for r in spark.table("clusters").collect()) == [("a", 1), ("a", 2), ("b", 1)]
    w = sessions.windowed_counts(df, ["g"], "at", "5 minutes", None, "1 hour")
    assert sorted((r["g"], r["rows"]) for r in w.collect()) == [("a", 1), ("a", 1), ("a", 2), ("b", 1)]


def test_entry_and_names():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 60


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
