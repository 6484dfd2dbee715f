import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.operators import contracts as C
from tessera.operators import dedupe as D


def test_conflicting_evidence_is_rejected(spark, rows):
    good = spark.createDataFrame([("k", "0.2", "x"), ("k", "", "x"), ("j", "0.1", "")], "key string, af string, cls string")
    assert rows(C.reconciled(good, ["key"], ["af", "cls"], ["af"])) == [("j", 0.1, None), ("k", 0.2, "x")]
    for bad in (("k", "0.3", "x"), ("k", "broken", "x"), ("k", "0.2", "y")):
        with pytest.raises(C.DataContractError):
            C.reconciled(good.union(spark.createDataFrame([bad], good.schema)), ["key"], ["af", "cls"], ["af"])


def test_schema_modes(spark):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    want = StructType([StructField("k", LongType()), StructField("v", StringType())])
    C.assert_schema(df, want)
    C.assert_schema(df.withColumn("x", F.lit(1)), want, "superset")
    for bad in (df.select("v", "k"), df.drop("v"), df.withColumn("x", F.lit(1))):
        with pytest.raises(C.DataContractError):
            C.assert_schema(bad, want)


def test_key_rules(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    b = spark.createDataFrame([(1,), (3,)], "k long")
    for check in (C.unique("u", a, ["k"]), C.references("r", a, b, ["k"]), C.same_keys("s", a, b, ["k"]), C.disjoint("d", a, b, ["k"]), C.subset("x", a, b, ["k"]), C.row_count("n", a, 2), C.holds("h", a, F.col("k") < 2), C.one_outcome("o", b, a, ["k"])):
        with pytest.raises(C.DataContractError):
            check.run()
    C.run_all(C.unique("u", b, ["k"]), C.row_count("n", a, 3), C.subset("x", b.where("k = 1"), a, ["k"]))


def test_consecutive_numbers(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3)], "g string, n long")
    assert [r["g"] for r in C.consecutive("c", df, ["g"], "n").violations.collect()] == ["b"]


def test_join_cardinality(spark, rows):
    left = spark.createDataFrame([(1, "x"), (1, "y")], "k long, a string")
    right = spark.createDataFrame([(1, "p"), (1, "q")], "k long, b string")
    with pytest.raises(C.DataContractError):
        C.join_checked(left, right, ["k"])
    assert len(rows(C.join_checked(left, right, ["k"], cardinality="m:m"))) == 4


def test_cache_probe(spark, rows):
    req = spark.createDataFrame([(1,), (2,)], "k long")
    rec = spark.createDataFrame([(1, "a"), (1, "a")], "k long, v string")
    hits, misses = C.split_lookup(req, rec, ["k"], "v")
    assert rows(hits) == [(1, "a")] and rows(misses) == [(2,)]
    with pytest.raises(C.DataContractError):
        C.split_lookup(req, rec.union(spark.createDataFrame([(1, "b")], rec.schema)), ["k"], "v")


def test_choice_does_not_depend_on_order(spark, rows):
    data = [("a", 2, "z"), ("a", 1, "y"), ("a", 1, "x"), ("b", 5, None)]
    for d in (data, data[::-1]):
        df = spark.createDataFrame(d, "k string, p long, v string").repartition(3)
        assert rows(D.first_by(df, ["k"], "p")) == [("a", 1, "x"), ("b", 5, None)]
        assert rows(D.hash_sample(df.where("v is not null"), "k", "v", 2, "s"), "v") == rows(D.hash_sample(df.where("v is not null").coalesce(1), "k", "v", 2, "s"), "v")
        assert rows(D.top_k(df, ["k"], 1, F.desc("p"))) == [("a", 2, "z"), ("b", 5, None)]
        assert rows(D.latest(df, ["k"], "p")) == [("a", 2, "z"), ("b", 5, None)]


def test_events_are_compacted_once_per_observer(spark, rows):
    raw = spark.createDataFrame(
        [("e", "o1", "", "b,a", 1), ("e", "o1", "t1", "a|c", 2), ("e", "o2", "t2", "", 3), (None, "o1", "t3", "", 4)], "event string, o string, tax string, flags string, n long"
    )
    events, support = D.compact_events(raw, ["event"], "o", ["tax"], "flags", ["n"])
    assert rows(events, "event", "observers", "rows", "event_id") == [("e", 2, 3, 2), (None, 1, 1, 1)]
    assert rows(support, "event_id", "o", "rows", "tax", "flags") == [(1, "o1", 1, "t3", ""), (2, "o1", 2, "t1", "a|b|c"), (2, "o2", 1, "t2", "")]


def test_refresh_and_append(spark, rows):
    k = lambda *v: spark.createDataFrame([(x,) for x in v], "k long")
    assert rows(D.refresh_plan(k(1, 2, 3, 3), k(1, 2), k(2), ["k"])) == [(2,), (3,)]
    assert rows(D.append_new(k(1), k(1, 2, 2), ["k"])) == [(2,)]
    with pytest.raises(C.DataContractError):
        D.conflict_free(spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), ["k"])
