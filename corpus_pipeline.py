"""From raw documents to packed sequences: quality, language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last keep the columns of ``documents`` (and whatever
other columns came along).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, language, packing, pii, quality
from tessera.llm.common import scratch, table

#: The least probability of the predicted language that a document stays with.
LEAST_LANGUAGE = 0.5


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not use yet."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at its threshold or more."""
    forest = quality.train(docs, table(spark, sf_dir, "labels"))
    (column,) = _fresh(docs, "quality_score")
    scored = quality.score(docs, forest, score_col=column)
    return scored.where(F.col(column) >= quality.THRESHOLD).drop(column)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and a language that is likelier than not."""
    model = language.train(docs)
    lang, score = _fresh(docs, "lang_pred", "lang_score")
    found = language.predict(docs, model, lang_col=lang, score_col=score)
    return found.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE)).drop(lang, score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id.

    Rows that share an id are documents of their own unless their texts are equal; of equal ones one
    stays. Documents without an id are in no group; of equal texts among them one stays.
    """
    named = docs.where("doc_id is not null")
    if named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        groups = scratch(jaccard.near_duplicates(docs).select("doc_id", "component_id"), "groups")
        copies = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
        kept = jaccard.without(named, copies, "doc_id").select(*docs.columns)
    else:
        digest, row = _fresh(docs, "text_digest", "row")
        marked = named.withColumn(digest, F.coalesce(F.sha2("text", 256), F.lit("")))
        # each distinct (id, text) gets an id of its own, in the order of the ids
        rows = marked.select("doc_id", digest, "text").dropDuplicates(["doc_id", digest]).orderBy("doc_id", digest)
        rows = scratch(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
        groups = jaccard.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
        first = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(row))
        chosen = scratch(rows.join(first, row, "left_semi").select("doc_id", digest), "chosen")
        kept = marked.join(chosen, ["doc_id", digest], "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)
    without = docs.where("doc_id is null")
    if not without.isEmpty():
        kept = kept.unionByName(without.dropDuplicates(["text"]))
    return kept


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows."""
    found = pii.scan(docs, pii.train(docs))
    text = pii.redact(F.coalesce(F.col("text"), F.lit("")), F.concat("base", "added"))
    out = found.withColumn("text", F.when(F.col("text").isNotNull(), text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of at most 4096 tokens."""
    return packing.pack(packing.pieces_of(docs, packing.tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", quality_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("pii_redaction", pii_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained models and tokenisers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch(docs, name)
    return docs
