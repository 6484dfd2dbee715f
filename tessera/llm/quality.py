"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each text becomes a fixed vector of statistics. Trees are grown in numpy from
histograms of binned statistics, then flattened into arrays (feature, threshold,
children, value), which are broadcast; a batch of documents walks all trees with
vectorised numpy steps.

Training reads at most ``MAX_TRAIN`` labelled documents (those of least hash). Labels,
language, source and id are never inputs of a score.

Defined results for odd input: null text is the empty text and is scored like any
other; a label whose document is missing, and null labels, are not learned; a document
that is labelled several times counts several times; with no labels, or labels of one kind,
every score is that share (0.5 with none); an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, crc_mod, least_hashed, schema_with, table, with_room

#: Labelled documents that the trees may learn from.
MAX_TRAIN = 12_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, LEAST = 120, 4, 64, 0.12, 12.0

# ---------------------------------------------------------------- statistics

_CLASSES = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",", ";:", "!", "?",
    "|", "#$%&*", "()[]{}<>", "-_", "@/\\", "\"'`", "+=~^",
)
_CLASS = np.full(256, len(_CLASSES), dtype=np.int64)  # the last class holds bytes beyond ASCII and controls
for _k, _s in enumerate(_CLASSES):
    _CLASS[list(_s.encode())] = _k
NAMES = (
    "log_bytes", "log_words", "log_lines", "word_mean", "word_std", "word_max", "line_mean", "unique_words", "top_word", "top_two",
    "top_five", "repeat_next", "repeat_lines", "top_line", "short_words", "long_words", "ended_lines", "marked_words", "upper_words",
    "pair_unique", "entropy", "blank_lines", "repeat_bytes", "one_class_words",
    *(f"class_{k}" for k in range(len(_CLASSES) + 1)),
)


def statistics(text: str | None) -> np.ndarray:
    """The statistics of a text, in the order of ``NAMES``."""
    out = np.zeros(len(NAMES))
    if not text:
        return out
    raw = text.encode("utf-8", "replace")
    words, lines = raw.split(), raw.split(b"\n")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    by_class = np.bincount(_CLASS, weights=counts, minlength=len(_CLASSES) + 1) / len(raw)
    share = counts[counts > 0] / len(raw)
    n = len(words)
    full = [x for x in lines if x.strip()]
    line_counts = Counter(full)
    head = [math.log1p(len(raw)), math.log1p(n), math.log1p(len(lines))]
    if n:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        by_word = Counter(words)
        top = [c for _, c in by_word.most_common(5)]
        same = sum(map(bytes.__eq__, words, words[1:]))
        pairs = len(set(zip(words, words[1:])))
        marked = sum(c for w, c in by_word.items() if w[-1] in b"#$%&*|!~^" or w[0] in b"#$%&*|~^")
        upper = sum(c for w, c in by_word.items() if w.isupper() and len(w) > 1)
        single = sum(c for w, c in by_word.items() if not w[:1].isalnum() and w[0] < 128)
        head += [
            sizes.mean(), sizes.std(), math.log1p(sizes.max()), math.log1p(len(raw) / len(lines)), len(by_word) / n, top[0] / n,
            sum(top[:2]) / n, sum(top) / n, same / n, 1 - len(line_counts) / max(1, len(full)),
            max(line_counts.values()) / len(full), (sizes <= 3).mean(), (sizes >= 12).mean(),
            sum(1 for x in full if x.rstrip()[-1:] in (b".", b"!", b"?", b":", b";")) / len(full), marked / n, upper / n,
            pairs / max(1, n - 1), float(-(share * np.log2(share)).sum()), 1 - len(full) / len(lines),
            float((np.frombuffer(raw, np.uint8)[1:] == np.frombuffer(raw, np.uint8)[:-1]).mean()) if len(raw) > 1 else 0.0, single / n,
        ]
        out[: len(head)] = head
    else:
        out[:3] = head
        out[20] = float(-(share * np.log2(share)).sum())
    out[-len(by_class) :] = by_class
    return out


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(len(texts), len(NAMES))


# ---------------------------------------------------------------- trees


class Forest:
    """Trees in arrays of trees x nodes; node k has children 2k+1 and 2k+2. A leaf's threshold is
    infinite, so a walk of ``DEPTH`` steps ends in a leaf or below one with its value."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> None:
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Boosts logistic loss with second-order histogram trees of a fixed depth."""
    n, m = x.shape
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.zeros((trees, nodes), dtype=np.int64)
    threshold, value = np.full((trees, nodes), np.inf), np.zeros((trees, nodes))
    share = float(y.mean()) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Forest(math.log(share / (1 - share)), feature[:0], threshold[:0], value[:0])
    base = math.log(share / (1 - share))
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(m) * BINS
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(DEPTH + 1):
            first, wide = 2**level - 1, 2**level
            here = at - first
            gs, hs = np.bincount(here, g, wide), np.bincount(here, h, wide)
            value[t, first : first + wide] = -RATE * gs / (hs + 1.0)
            if level == DEPTH:
                break
            key = (flat + (here * m * BINS)[:, None]).ravel()
            gh = np.bincount(key, np.repeat(g, m), wide * m * BINS).reshape(wide, m, BINS).cumsum(axis=2)
            hh = np.bincount(key, np.repeat(h, m), wide * m * BINS).reshape(wide, m, BINS).cumsum(axis=2)
            gt, ht = gs[:, None, None], hs[:, None, None]
            gain = gh**2 / (hh + 1) + (gt - gh) ** 2 / (ht - hh + 1) - gt**2 / (ht + 1)
            few = np.minimum(hh, ht - hh) < LEAST * 0.02
            gain[few] = -1
            best = gain.reshape(wide, -1).argmax(axis=1)
            f, cut = best // BINS, best % BINS
            real = (gain.reshape(wide, -1).max(axis=1) > 1e-6) & (cut < np.array([len(edges[k]) for k in f]))
            feature[t, first : first + wide] = f
            for k in np.flatnonzero(real):
                threshold[t, first + k] = edges[f[k]][cut[k]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > threshold[t, at])
        for k in range(nodes // 2):  # a walk through a leaf stays left; its value goes down with it
            if np.isinf(threshold[t, k]):
                value[t, 2 * k + 1] = value[t, k]
        raw += value[t, at]
    return Forest(base, feature, threshold, value)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Forest:
    """Learns ``labels.quality`` from the texts of ``docs``; both are joined on doc_id.

    The sample's ids are chosen on the labels alone, so only its own texts are read on.
    """
    spark = docs.sparkSession
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    chosen = least_hashed(known, max_train, "doc_id", "quality").collect()
    if not chosen:
        return grow(np.zeros((0, len(NAMES))), np.zeros(0))
    sample = F.broadcast(spark.createDataFrame(chosen, known.schema))  # max_train rows at most
    schema = "doc_id long, quality double, x array<double>"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(2)]
            ids, q = batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.float64())
            yield pa.RecordBatch.from_arrays([ids, q, pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = arrow_map(docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "quality", "text"), measure, schema)
    pdf = rows.toPandas()
    if not len(pdf):
        return grow(np.zeros((0, len(NAMES))), np.zeros(0))
    pdf = pdf.iloc[np.lexsort((pdf["quality"], pdf["doc_id"]))]
    return grow(np.stack(pdf["x"].to_numpy()), (pdf["quality"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, forest: Forest, text: str = "text", score_col: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of good quality; all other columns pass through."""
    docs = with_room(docs, score_col)
    held = docs.sparkSession.sparkContext.broadcast(forest)
    at = docs.columns.index(text)
    schema = schema_with(docs, **{score_col: "double"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = held.value
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(f.predict(x))], [*batch.schema.names, score_col])

    return arrow_map(docs, run, schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    forest = train(docs, labels.where(crc_mod("doc_id", 5) != 0))
    held = docs.select("doc_id", "text", (crc_mod("doc_id", 5) == 0).alias("held_out"))
    scored = score(held, forest, score_col="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op4_quality": op4_quality}
