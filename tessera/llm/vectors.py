"""Near-duplicate vectors by random-hyperplane sign hashing, exact cosines and components.

Equal vectors of a label collapse to one row with a count. Each distinct vector gets one
signature per table, the signs of its products with ``bits`` random directions; vectors of a
label that share a signature in any table meet. A bucket's vectors are compared in blocks by one
matrix product in double precision; a pair counts in the first table that both share only. Out of
a bucket come, per vector, the number of links and one edge towards its component inside
the bucket, never the pairs, so a bucket of m vectors gives m rows. Components are then joined by
rounds of minimum labels with pointer jumping.

The number of bits follows the number of vectors of the largest label, so that a bucket of
unrelated vectors keeps its size; the number of tables follows from the bits, so that a pair at
the threshold is found with probability ``RECALL`` at least. Buckets of more than ``BLOCK``
vectors are cut into blocks, and each pair of blocks is a task of its own.

Defined results for odd input: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with null labels, link with nothing; vectors of different lengths do
not link; vectors of very large or small components are scaled before they are squared; rows with equal vec_id are separate vectors that share an id (a component is known by
its smallest id); null vec_ids take part but cannot name a component; an empty table gives
no rows; extra columns are ignored, whatever their names; very long vectors are compared whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, rows_by_key, scratch, shuffle_partitions, table
from tessera.llm.components import components, local_roots

COSINE = 0.93
RECALL = 0.995
#: Unrelated vectors that share a bucket on average, and vectors that are compared at once.
OCCUPANCY, BLOCK = 48, 2048
SEED = 20240


def plan(n_largest: int, cosine: float = COSINE) -> tuple[int, int]:
    """(bits of a signature, tables) for a label of ``n_largest`` distinct vectors."""
    same = 1 - math.acos(cosine) / math.pi
    bits = min(24, max(4, math.ceil(math.log2(max(1, n_largest) / OCCUPANCY + 1))))
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same**bits))


def directions(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors of largest component 1 in absolute value (about, for the smallest numbers), whose squares neither overflow nor vanish."""
    _, power = np.frexp(np.abs(x).max(axis=1, initial=0))
    half = power // 2  # in two steps, as one power of two may be out of range
    return np.ldexp(np.ldexp(x, -half[:, None]), (half - power)[:, None])


def _signed(vectors: DataFrame, bits: int, tables: int, kind: str) -> DataFrame:
    """One row per vector and table: bucket, key, copies, vector (components of numpy type ``kind``), signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, labels, copies = (part.column(i).to_pylist() for i in range(3))
                vecs = part.column(3).to_pylist()
                out: list[tuple] = []
                for dim in sorted({len(v) for v in vecs}):
                    here = [i for i, v in enumerate(vecs) if len(v) == dim]
                    x = scaled(np.array([vecs[i] for i in here], dtype=np.float64))
                    signs = (x @ directions(dim, bits, tables) > 0).reshape(len(here), tables, bits)
                    sig = signs @ (1 << np.arange(bits))
                    for row, i in enumerate(here):
                        own = sig[row].astype("<i4").tobytes()
                        payload = np.asarray(vecs[i], dtype=kind).tobytes()
                        out += [(f"{labels[i]}/{dim}/{t}/{sig[row, t]}", keys[i], copies[i], payload, own) for t in range(tables)]
                cols = list(zip(*out))
                types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                names = ["bucket", "key", "copies", "vec", "sigs"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    columns = vectors.select("key", "label", "copies", "embedding")
    return arrow_map(columns, run, "bucket string, key long, copies long, vec binary, sigs binary")


def _blocked(signed: DataFrame) -> DataFrame:
    """Adds ``task`` (bucket and pair of blocks) and ``side`` (its bits: first block, second block).

    Rows of buckets of up to ``BLOCK`` vectors go to one task; others to one for each block that
    their own is paired with.
    """
    sizes = signed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    rows = signed.join(sizes, "bucket", "left")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    each = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.concat_ws("/", "bucket", F.least(own, other).cast("string"), F.greatest(own, other).cast("string")).alias("task"),
            F.when(own == other, 3).when(own < other, 1).otherwise(2).alias("side"),
        ),
    )
    one = F.array(F.struct(F.col("bucket").alias("task"), F.lit(3).alias("side")))
    return rows.withColumn("x", F.explode(F.when(F.col("n").isNull(), one).otherwise(each))).select("x.task", "x.side", "bucket", "key", "copies", "vec", "sigs")


def _compare(tasks: DataFrame, cosine: float, kind: str) -> DataFrame:
    """Per task and vector: key, other (an edge towards its component), links (rows that it links with, copies
    counted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in rows_by_key(batches, "task"):
            t = int(group["bucket"][0].as_py().split("/")[-2])
            side, key = group["side"].to_numpy(), group["key"].to_numpy()
            weight = group["copies"].to_numpy().astype(np.float64)
            x = np.frombuffer(b"".join(group["vec"].to_pylist()), dtype=kind).reshape(len(key), -1).astype(np.float64)
            sigs = np.frombuffer(b"".join(group["sigs"].to_pylist()), dtype="<i4").reshape(len(key), -1)
            x = scaled(x)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            a, b = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
            links, root = np.zeros(len(key)), np.arange(len(key))
            inner = bool((side == 3).all())
            for at in range(0, len(a), 512):
                rows = a[at : at + 512]
                i, j = np.nonzero(x[rows] @ x[b].T >= cosine)
                i, j = rows[i], b[j]
                keep = key[i] < key[j] if inner else key[i] != key[j]
                i, j = i[keep], j[keep]
                if t and len(i):
                    fresh = ~(sigs[i, :t] == sigs[j, :t]).any(axis=1)
                    ei, ej = i[fresh], j[fresh]
                else:
                    ei, ej = i, j
                np.add.at(links, ei, weight[ej])
                np.add.at(links, ej, weight[ei])
                root = local_roots(len(key), i, j, root)  # all links of the bucket take part
            some = np.flatnonzero((links > 0) | (root != np.arange(len(key))))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[some]), pa.array(key[root[some]]), pa.array(links[some].astype(np.int64))], ["key", "other", "links"]
                )

    n = shuffle_partitions(tasks.sparkSession)
    placed = tasks.repartition(n, "task").sortWithinPartitions("task")
    return arrow_map(placed, run, "key long, other long, links long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    good = (
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
        & F.exists("embedding", lambda v: v != 0)
    )
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    # a distinct vector is known by a wide hash of its label and components
    value = F.concat_ws(",", F.col("label").cast("string"), F.transform("embedding", lambda v: F.hex((v + 0.0).cast("string").cast("binary"))))
    rows = rows.withColumn("hash", F.when(F.col("good"), F.sha2(value, 256)))
    distinct = (
        rows.where("good").groupBy("hash")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    )
    # the key is a short hash of the wide one; a label's vectors would have to number billions to share one
    distinct = scratch(distinct.withColumn("key", F.xxhash64("hash")), "vectors")
    largest = distinct.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if largest is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    bits, tables = plan(largest, cosine)
    # components travel as they are stored; sums are in double precision
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    tasks = _blocked(_signed(distinct, bits, tables, kind))
    compared = scratch(_compare(tasks, cosine, kind), "compared")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    edges = compared.where("key <> other").select(F.col("key").alias("a"), F.col("other").alias("b")).distinct()
    member = components(edges)
    named = distinct.join(member, distinct["key"] == member["node"], "left").join(links, "key", "left")
    named = named.withColumn("component", F.coalesce("component", "key"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    per_vector = named.join(least, "component").select(
        "hash", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "hash").join(per_vector, "hash", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_vector_dedup": op7_vector_dedup}
