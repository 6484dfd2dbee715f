"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is read as code points: lower-cased, everything but letters folded to single
spaces. Its n-grams of one to three code points are hashed into a fixed number of
cells; the model is a matrix of log-probabilities, cells by languages, which is
broadcast (a fixed size times the number of languages). Texts are scored as sparse
rows: only the matrix rows of cells that occur are gathered.

Training reads at most ``MAX_TRAIN`` labelled documents (the ones of least hash of
doc_id and text), whole texts of each; their counts are summed on the executors.

Defined results for odd input: null text or text without letters gives ``und`` with
score 0; rows with equal or null ids are scored one by one; an empty table gives no
rows; with no labelled document everything is ``und``; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, crc_mod, least_hashed, schema_with, table, with_room

BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Labelled documents that the model may learn from.
MAX_TRAIN = 6000
UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@cache
def _fold() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else 0 (read as a space)."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def code_points(text: str) -> np.ndarray:
    """Folded code points with single zeros between words and at both ends; empty if no letter."""
    points = _fold()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]
    keep = points != 0
    if not keep.any():
        return points[:0]
    # a zero stays only before a letter; one more closes the text
    keep[:-1] |= keep[1:]
    points = points[keep]
    return np.concatenate(([np.uint32(0)] if points[0] else [], points, [0])).astype(np.uint64)


def cells(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The cells that a text's n-grams hash to, and how often."""
    p = code_points(text)
    if not len(p):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float64)
    found = []
    h = np.zeros(len(p), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(p) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + p[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append(mixed >> np.uint64(64 - BITS))
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(np.float64)


class Model:
    """Log-probabilities, cells x languages, and log-priors."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray) -> None:
        self.langs = langs
        probability = (counts + SMOOTHING) / (counts.sum(axis=0, keepdims=True) + SMOOTHING * counts.shape[0])
        self.weights = np.log(probability)
        self.prior = np.log(docs / docs.sum())

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and posterior probabilities of a batch, by one sparse product.

        The language is that of the greatest posterior, from all n-grams of a text. Its score is tempered: it takes the
        mean log-likelihood of ``EVIDENCE`` n-grams where there are more, as n-grams of a
        text depend on each other, and the plain sum would call every long text certain.
        """
        rows = [cells(t or "") for t in texts]
        sizes = np.array([len(at) for at, _ in rows])
        score = np.zeros(len(texts))
        best = np.full(len(texts), -1)
        full = np.flatnonzero(sizes)
        if len(full) and self.langs:
            at = np.concatenate([rows[i][0] for i in full])
            n = np.concatenate([rows[i][1] for i in full])
            starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            like = np.add.reduceat(self.weights[at] * n[:, None], starts)
            total = np.add.reduceat(n, starts)
            best[full] = (like + self.prior).argmax(axis=1)
            like = like * (np.minimum(total, EVIDENCE) / total)[:, None] + self.prior
            like -= like.max(axis=1, keepdims=True)
            p = np.exp(like)
            p /= p.sum(axis=1, keepdims=True)
            score[full] = p[np.arange(len(full)), best[full]]
        return [self.langs[k] if k >= 0 else UNKNOWN for k in best], score


#: n-grams that count as independent evidence for the score (not for the language) at most.
EVIDENCE = 300.0


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learns from ``text`` and non-null ``lang`` of the given rows."""
    spark = docs.sparkSession
    labelled = docs.where("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64(F.col("doc_id"), F.crc32(F.col("text").cast("binary"))).alias("h")
    )
    # rows of one id and text are one example, however many they are
    bound = least_hashed(labelled.select("h").distinct(), max_train, "h").agg(F.max(F.xxhash64("h"))).first()[0]
    if bound is None:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, n = cells(text.as_py())
                if lang not in sums:
                    sums[lang], docs_of[lang] = np.zeros(1 << BITS), 0
                sums[lang][at] += n
                docs_of[lang] += 1
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            cell = np.concatenate((at, [-1]))
            n = np.concatenate((s[at], [docs_of[lang]])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell)), pa.array(cell), pa.array(n)], ["lang", "cell", "n"])

    chosen = labelled.where(F.xxhash64("h") <= bound).dropDuplicates(["h", "lang", "text"]).select("lang", "text")
    counted = arrow_map(chosen, count, "lang string, cell long, n long")
    pdf = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()  # languages x cells at most
    langs = sorted(pdf["lang"].unique())
    index = {x: k for k, x in enumerate(langs)}
    counts, priors = np.zeros((1 << BITS, len(langs))), np.zeros(len(langs))
    lang, cell, n = pdf["lang"].map(index).to_numpy(), pdf["cell"].to_numpy(), pdf["n"].to_numpy()
    real = cell >= 0
    counts[cell[real], lang[real]] = n[real]
    priors[lang[~real]] = n[~real]
    return Model(langs, counts, priors)


def predict(docs: DataFrame, model: Model, text: str = "text", lang_col: str = "lang_pred", score_col: str = "lang_score") -> DataFrame:
    """``docs`` with a predicted language and its probability; all other columns pass through."""
    docs = with_room(docs, lang_col, score_col)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    schema = schema_with(docs, **{lang_col: "string", score_col: "double"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            column, langs, scores = batch.column(at), [], []
            for k in range(0, batch.num_rows, 256):
                a, b = m.predict(column.slice(k, 256).to_pylist())
                langs += a
                scores.append(b)
            extra = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, lang_col, score_col])

    return arrow_map(docs, run, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(crc_mod("doc_id", 4) != 2))
    held = docs.select("doc_id", "text", (crc_mod("doc_id", 4) == 2).alias("held_out"))
    return predict(held, model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


QUERIES = {"op5_language_id": op5_language_id}
