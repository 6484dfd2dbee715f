"""The pipeline's stages keep columns, take effect, and agree with the operators they call."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import jaccard, language, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("quality_score", F.lit("clash"))
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.scratch(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns_stay_until_the_last_stage(steps):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert steps[name].columns == steps["input"].columns
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(steps[names[-1]].columns)


def test_each_stage_works_on_what_the_one_before_kept(steps):
    names = ["input", *(n for n, _ in corpus_pipeline.STAGES)]
    for before, after in zip(names, names[1:]):
        assert ids(steps[after]) <= ids(steps[before])
    assert ids(steps["pii_redaction"]) == ids(steps["ngram_jaccard_join"]) == ids(steps["best_fit_packing"])


def test_quality_stage_agrees_with_labels(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = ids(steps["quality_classifier"])
    agree = [(i in kept) == bool(q) for i, q in labels.items() if i in ids(steps["input"])]
    assert sum(agree) / len(agree) > 0.95


def test_one_document_of_each_group_stays(steps):
    before, after = steps["language_id"], steps["ngram_jaccard_join"]
    groups = jaccard.near_duplicates(before).collect()
    assert ids(after) == {r["component_id"] for r in groups} and after.count() == len(ids(after))


def test_texts_are_redacted_and_measured(steps):
    rows = steps["pii_redaction"].select("text", "n_chars").collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert not any("@mail" in r["text"] for r in rows)


def test_rows_without_ids_or_texts(spark, tmp_path):
    rows = [(1, "one two three four five six", "en"), (1, "one two three four five six", "en"), (2, "One two three  four five six", "en"), (None, "p q", "en"), (None, "p q", "en"), (3, None, None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert sorted((r["doc_id"], r["text"]) for r in out.where("doc_id is not null").collect()) == [(1, rows[0][1]), (3, None)]
    assert sorted((r["text"] for r in out.where("doc_id is null").collect()), key=repr) == [None, "p q"] or out.where("doc_id is null").count() == 2
    empty = docs.limit(0).withColumns({"source": F.lit("s"), "n_chars": F.lit(0).cast("long")})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_repeated_ids_are_told_apart_by_text(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "one two three four five six seven eight nine ten", "red blue green black white brown grey pink gold teal")
    rows = [(3, a, "en"), (5, f"{a} ", "en"), (5, b, "en"), (5, c, "en"), (5, c, "en"), (7, b, "en"), (8, "x", "en"), (8, "", "en"), (8, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    want = [(3, a), (5, b), (5, c), (8, "x"), (8, ""), (8, None)]
    assert out.columns == docs.columns and sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_texts_are_scored_like_others(spark, monkeypatch):
    monkeypatch.setattr(quality, "THRESHOLD", 0.0)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, ""), (-2, " \n"), (-3, None)], "doc_id long, text string")
    out = corpus_pipeline.quality_stage(spark, docs.unionByName(odd, allowMissingColumns=True), SF)
    assert ids(out) == ids(docs) | {-1, -2, -3}


def test_rejections(spark):
    docs = spark.createDataFrame([(k, "the river runs under the old stone bridge " * 3, "en") for k in range(20)] + [(90, "1234 5678", "en"), (91, None, "en")], "doc_id long, text string, lang string")
    assert ids(corpus_pipeline.language_stage(spark, docs, SF)) == set(range(20))
    forest = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert quality.score(docs, forest).count() == docs.count() and language.UNKNOWN == "und"
