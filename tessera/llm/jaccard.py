"""N-gram Jaccard join by adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles is at least the
threshold t. Documents with equal sets form one class; the join works on classes.

*Order.* Shingles are ordered by hash, but frequent ones come last, by estimated frequency. How many
classes share a shingle is estimated from one class in ``SAMPLE``; the ``FREQUENT`` most
frequent shingles of the sample, at most, are broadcast with their estimates. Any order gives the same
result; this one keeps passages that many documents share out of the index.

*Adaptive multi-match prefixes.* Of a set of n, let p = n - ceil(t n) + 1. If two sets are similar, then
for any l their first p + l - 1 shingles share at least l. A class starts with l = 1 and lengthens its
prefix with the number of candidates that its shingles are estimated to bring, and then requires l
shared shingles before verification; of a pair the smaller requirement holds.

*Rare shingles.* Lists of rare shingles are short. In the first rounds each list pairs its members only with
one centre, chosen anew in each round. Verified pairs join classes to components, and a list only
pairs members of different components. The last round pairs what is still apart.

*Frequent shingles.* Their lists are long: a group of near copies shares all of them, and its members need not
be similar to each other. Classes that meet in such lists form families; a pair that shares a frequent shingle of both
prefixes is of one family, any other pair must share l rare ones. Families come first. Their members also meet centres,
so that most near copies join one component at a linear cost. Only the classes outside the family's largest component are then
compared with all others: a family is cut into size classes (similar sets are in the same or
neighbouring ones) and blocks; each pair of blocks is one task, which counts all common
shingles by matrix products and returns for each class an edge to its component in the task. So a family of m classes gives
about m rows, never its pairs.

Defined results for odd input: null text and texts without words have an empty set (n_shingles 0)
and link with nothing; rows with equal doc_id are separate texts that share an id; rows
without an id link with nothing (component null); an empty table gives no rows; extra columns
are ignored. Whole texts are read, however long: a set is as large as its text, and one set's arrays are held at a time
(in a block at most ``BLOCK_SETS``). Equal frequencies, sizes and centres are settled by hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, discard, release, rows_by_key, scratch, shuffle_partitions, table
from tessera.llm.components import components, local_roots
from tessera.llm.shingles import mix, shingle_set

#: The threshold as a fraction, so that borderline pairs are decided in integers.
NUMERATOR, DENOMINATOR = 80, 100
#: Estimated classes from which on a shingle counts as frequent.
HEAVY = 100
#: One class in so many tells shingle frequencies; the most frequent shingles that are broadcast (16 bytes each).
SAMPLE, FREQUENT = 16, 500_000
#: Shingles of the sets in a block of a family, and sets in it at most.
BLOCK_SHINGLES, BLOCK_SETS = 400_000, 256
#: Rounds that compare with centres only, before what is left is compared.
STAR_ROUNDS = 2
#: Matches that a prefix may require at most.
MOST_MATCHES = 8
#: Hash buckets of a broadcast that thins out rows before they are shuffled (an exact join follows).
BUCKETS = 1 << 18


def least_common(n: int) -> int:
    """ceil(t n): what a set of n shares at least with a similar one."""
    return -(-n * NUMERATOR // DENOMINATOR)


def digests(s: np.ndarray) -> tuple[int, int]:
    first = mix(s + np.uint64(11)).sum(dtype=np.uint64)
    second = mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)
    return int(first.astype(np.int64)), int(second.astype(np.int64))


def signature(s: np.ndarray) -> bytes:
    """How many shingles fall into each of about n / 4 ranges of hashes; empty if a count exceeds a byte."""
    bits = max(4, min(20, int(len(s)).bit_length() - 2))
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def may_link(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    """False only if the ranges' counts show that two sets share too little."""
    if not a or not b:
        return True
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    width = min(len(x), len(y))
    common = int(np.minimum(x.reshape(width, -1).sum(axis=1), y.reshape(width, -1).sum(axis=1)).sum())
    return common * DENOMINATOR >= (n_a + n_b - common) * NUMERATOR


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def summaries(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, two digests of the set, its signature; sampled classes also all their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            sizes, first, second, some, signs = [], [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py())
                n = len(s)
                d1, d2 = digests(s)
                sizes.append(n)
                first.append(d1)
                second.append(d2)
                signs.append(signature(s))
                some.append(s.view(np.int64) if d1 % SAMPLE == 0 else none)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()), _lists(some), pa.array(signs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "some", "sign"],
            )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, some array<long>, sign binary"
    return arrow_map(docs.select("doc_id", "text"), run, schema)


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sample's most frequent shingles, ascending, with estimated numbers of classes."""
    sampled = rows.where("size(some) > 0 and doc_id is not null").groupBy("n_shingles", "d1", "d2").agg(F.first("some").alias("some"))
    seen = sampled.select(F.explode("some").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    seen = scratch(seen, "seen")
    # the least frequency that lets at most FREQUENT shingles through
    least, total = 2, 0
    for n, k in sorted(((r["n"], r["k"]) for r in seen.groupBy("n").agg(F.count("*").alias("k")).collect()), reverse=True):
        total += k
        if total > FREQUENT:
            least = n + 1
            break
    pdf = seen.where(F.col("n") >= least).toPandas()
    discard(seen)
    keys, n = pdf["shingle"].to_numpy(np.int64).view(np.uint64), pdf["n"].to_numpy(np.int64) * SAMPLE
    order = np.argsort(keys)
    return keys[order], n[order]


def prefix(s: np.ndarray, keys: np.ndarray, estimate: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(rare shingles, frequent ones, matches required) that a set puts into the index."""
    n = len(s)
    p = n - least_common(n) + 1
    at = np.minimum(np.searchsorted(keys, s), max(0, len(keys) - 1))
    classes = np.where(keys[at] == s, estimate[at], 1) if len(keys) else np.ones(n, np.int64)
    heavy = classes > HEAVY
    order = np.lexsort((s, np.where(heavy, classes, 0)))
    cost = float((classes[order[:p]] - 1).sum()) / p
    matches = 1 + min(MOST_MATCHES - 1, int(np.log2(1 + cost)), n - p)
    own = order[: p + matches - 1]
    rare, often = own[~heavy[own]], own[heavy[own]]
    return s[rare], s[often], matches


def _index(docs: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The index: shingle, cls, n, k, often; rare shingles of one class only are left out.

    A task passes each class on once, and classes that several tasks hold meet in the lists.
    """
    held = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, estimate = held.value
        passed: set[tuple[int, int, int]] = set()
        for batch in batches:
            sizes, first, second, required, rare, often = [], [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(text.as_py())
                if not len(s) or doc_id is None:
                    continue
                name = (len(s), *digests(s))
                if name in passed:
                    continue
                passed.add(name)
                a, b, k = prefix(s, keys, estimate)
                for column, x in zip((sizes, first, second, required), (*name, k)):
                    column.append(x)
                rare.append(a.view(np.int64))
                often.append(b.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (sizes, first, second, required)), _lists(rare), _lists(often)],
                ["n_shingles", "d1", "d2", "k", "rare", "often"],
            )

    schema = "n_shingles long, d1 long, d2 long, k long, rare array<long>, often array<long>"
    rows = arrow_map(docs.select("doc_id", "text"), run, schema)
    # size and requirement travel as one number, which is negative for frequent shingles
    size = F.col("n_shingles") * (MOST_MATCHES + 1) + F.col("k")
    def marked(column: str, nk):
        return F.transform(column, lambda x: F.struct(x.alias("shingle"), nk.alias("nk")))

    each = rows.select(F.xxhash64("n_shingles", "d1", "d2").alias("cls"), F.explode(F.concat(marked("rare", size), marked("often", -size))).alias("x")).select("x.shingle", "cls", "x.nk")
    # lists of rare shingles are short, so one exchange serves to count and to keep; frequent ones are only passed on
    spread = F.when(F.col("nk") < 0, F.pmod(F.xxhash64("cls"), F.lit(1024))).otherwise(0)
    low, high = (f("cls").over(Window.partitionBy("shingle", "spread")) for f in (F.min, F.max))
    kept = each.withColumn("spread", spread).withColumns({"low": low, "high": high}).where("nk < 0 or low < high")
    kept = kept.dropDuplicates(["shingle", "spread", "cls"])  # where the window has put them
    whole = F.abs("nk")
    n = F.floor(whole / (MOST_MATCHES + 1)).alias("n")
    return kept.select("shingle", "cls", n, F.pmod(whole, F.lit(MOST_MATCHES + 1)).alias("k"), (F.col("nk") < 0).alias("often"))


def _counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of common shingles of the sets at ``a`` with those at ``b``."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, times = np.unique(tokens, return_inverse=True, return_counts=True)
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    row, col = np.full(len(sets), -1), np.full(len(sets), -1)
    row[a], col[b] = np.arange(len(a)), np.arange(len(b))
    # shingles of many sets by dense products over slices of the shingles
    rank = np.full(len(times), -1)
    many = np.flatnonzero(times >= 24)
    for at in range(0, len(many), 2048):
        part = many[at : at + 2048]
        rank[:] = -1
        rank[part] = np.arange(len(part))
        here = np.flatnonzero(rank[token] >= 0)
        x, y = np.zeros((len(a), len(part)), np.float32), np.zeros((len(b), len(part)), np.float32)
        for side, place in ((x, row), (y, col)):
            own = here[place[owner[here]] >= 0]
            side[place[owner[own]], rank[token[own]]] = 1
        out += x @ y.T
    # the others pair by pair: below 24 sets each
    few = np.flatnonzero((times[token] > 1) & (times[token] < 24))
    few = few[np.argsort(token[few], kind="stable")]
    for gap in range(1, 24):
        left, right = few[:-gap], few[gap:]
        same = token[left] == token[right]
        if not same.any():
            break
        for u, v in ((owner[left[same]], owner[right[same]]), (owner[right[same]], owner[left[same]])):
            ok = (row[u] >= 0) & (col[v] >= 0)
            np.add.at(out, (row[u[ok]], col[v[ok]]), 1)
    return out


def _families(index: DataFrame) -> DataFrame:
    """cls, n, family of the classes that meet others in lists of frequent shingles."""
    often = index.where("often").select("shingle", "cls", "n")
    centre = often.groupBy("shingle").agg(F.min("cls").alias("b"), F.count("*").alias("m")).where("m > 1").select("shingle", "b")
    met = scratch(often.join(centre, "shingle").where("cls <> b").select(F.col("cls").alias("a"), "b").distinct(), "met")
    family = components(met)
    out = scratch(often.select("cls", "n").distinct().join(family.withColumnsRenamed({"node": "cls", "component": "family"}), "cls"), "family")
    discard(met, family)
    return out


def _apart(lists: DataFrame, key: str) -> DataFrame:
    """``lists`` (key, component, ...) of more than one component, with ``rest``: not of the list's largest component.

    Pairs inside the largest component tell nothing more, so what is compared grows with the rest only.
    """
    sizes = lists.groupBy(key, "component").agg(F.count("*").alias("m"))
    largest = sizes.groupBy(key).agg(F.max(F.struct("m", "component"))["component"].alias("largest"), F.count("*").alias("several"))
    return lists.join(largest.where("several > 1").drop("several"), key).withColumn("rest", F.col("component") != F.col("largest")).drop("largest")


def _cells(families: DataFrame, member: DataFrame | None, texts) -> DataFrame:
    """(a, b): edges that join the linked classes of each family. Blocks are either of the rest or of the largest component."""
    # similar sets differ by one size class at most
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DENOMINATOR / NUMERATOR)) + 1e-9).cast("long")
    held = scratch(_apart(_named(families, member), "family").withColumn("size", step), "apart")
    per_block = F.greatest(F.lit(4), F.least(F.lit(BLOCK_SETS), F.lit(BLOCK_SHINGLES) / F.max("n")))
    count = lambda rest: F.ceil(F.count_if(F.col("rest") == rest) / per_block).cast("int")
    blocks = held.groupBy("family", "size").agg(count(True).alias("rest_here"), count(False).alias("main_here"))
    along = Window.partitionBy("family").orderBy("size")  # size classes of a family are few
    near = lambda f, c, d: F.coalesce(F.when(f("size").over(along) == F.col("size") + d, f(c).over(along)), F.lit(0))
    blocks = blocks.withColumns({
        f"{c}_{name}": near(f, f"{c}_here", d) for c in ("rest", "main") for f, name, d in ((F.lag, "below", -1), (F.lead, "above", 1))
    })
    place = F.pmod(F.xxhash64("cls"), F.when(F.col("rest"), F.col("rest_here")).otherwise(F.col("main_here")))
    placed = held.join(blocks, ["family", "size"]).withColumn("block", place.cast("int"))
    own, size = F.col("block"), F.col("size")

    def cells(column: str, kind: str, size, cell, side):
        """Structs of the tasks that pair a set's block with the others that ``column`` counts."""
        numbers = F.when(F.col(column) > 0, F.sequence(F.lit(0), F.greatest(F.col(column) - 1, F.lit(0)))).otherwise(F.expr("cast(array() as array<int>)"))
        name = lambda i: F.concat_ws("/", F.lit(kind), "family", size.cast("string"), *(c.cast("string") for c in cell(i)))
        return F.transform(numbers, lambda i: F.struct(name(i).alias("cell"), F.lit(side(i)).alias("side")))

    inside = lambda i: F.when(own == i, 3).when(own < i, 1).otherwise(2)
    of_rest = F.concat(
        cells("rest_here", "in", size, lambda i: (F.least(own, i), F.greatest(own, i)), inside),
        cells("rest_above", "up", size, lambda i: (own, i), lambda i: 1),
        cells("rest_below", "up", size - 1, lambda i: (i, own), lambda i: 2),
        *(cells(f"main_{c}", c, size, lambda i: (own, i), lambda i: 1) for c in ("below", "here", "above")),
    )
    of_main = F.concat(
        cells("rest_here", "here", size, lambda i: (i, own), lambda i: 2),
        cells("rest_above", "below", size + 1, lambda i: (i, own), lambda i: 2),
        cells("rest_below", "above", size - 1, lambda i: (i, own), lambda i: 2),
    )
    dealt = placed.select("cls", F.explode(F.when(F.col("rest"), of_rest).otherwise(of_main)).alias("x")).select("cls", "x.cell", "x.side")
    dealt = scratch(dealt, "cells")
    rows = dealt.join(texts(dealt.select("cls")), "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in rows_by_key(batches, "cell"):
            if group.num_rows < 2:
                continue
            cls, side = group["cls"].to_numpy(), group["side"].to_numpy()
            sets = [shingle_set(t) for t in group["text"].to_pylist()]
            size = np.array([len(x) for x in sets])
            a, b = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
            common = _counts(sets, a, b).astype(np.int64)
            either = size[a][:, None] + size[b][None, :] - common
            i, j = np.nonzero(common * DENOMINATOR >= either * NUMERATOR)
            root = local_roots(len(cls), a[i], b[j])
            some = np.flatnonzero(root != np.arange(len(cls)))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(cls[root[some]])], ["a", "b"])

    n = shuffle_partitions(families.sparkSession)
    out = scratch(arrow_map(rows.repartition(n, "cell").sortWithinPartitions("cell"), run, "a long, b long"), "linked")
    discard(held, dealt)
    return out


def _thinned(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys``: by a broadcast of at most ``BUCKETS`` hash buckets."""
    bucket = F.pmod(F.xxhash64(F.col(column)), F.lit(BUCKETS))
    some = keys.select(bucket.alias("_bucket")).distinct()
    return df.withColumn("_bucket", bucket).join(F.broadcast(some), "_bucket", "left_semi").drop("_bucket")


def without(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among ``keys``. Only rows whose bucket some key has go through the join."""
    bucket = F.pmod(F.xxhash64(F.col(column)), F.lit(BUCKETS))
    some = F.broadcast(keys.select(bucket.alias("_bucket")).distinct())
    marked = df.withColumn("_bucket", bucket)
    may = marked.join(some, "_bucket", "left_semi").join(keys, column, "left_anti")
    return marked.join(some, "_bucket", "left_anti").unionByName(may).drop("_bucket")


def _sized(a: str, b: str):
    """The sizes allow similarity."""
    return (F.col(a) * DENOMINATOR >= F.col(b) * NUMERATOR) & (F.col(b) * DENOMINATOR >= F.col(a) * NUMERATOR)


def _named(rows: DataFrame, member: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their class; a class that is no member is a component of its own.

    Only rows whose class may be a member, by its hash bucket, go through the join.
    """
    if member is None:
        return rows.withColumn("component", F.col("cls"))
    bucket = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(BUCKETS))
    some = member.select(bucket("node").alias("_bucket")).distinct().withColumn("_hit", F.lit(True))
    marked = rows.withColumn("_bucket", bucket("cls")).join(F.broadcast(some), "_bucket", "left")
    may = marked.where("_hit").drop("_bucket", "_hit")
    may = may.join(member, may["cls"] == member["node"], "left").drop("node").withColumn("component", F.coalesce("component", "cls"))
    return may.unionByName(marked.where("_hit is null").drop("_bucket", "_hit").withColumn("component", F.col("cls")))


def _plausible(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs that their signatures, a small part of the texts, do not rule out."""

    def side(x: str) -> DataFrame:
        some = _thinned(signs, pairs.select(F.col(x).alias("cls")), "cls")
        return some.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sign").alias(f"sign_{x}"))

    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "sign_a", "sign_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            keep = [may_link(x, y, n, m) for n, m, x, y in zip(*columns[2:])]
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"])

    return arrow_map(rows, run, "a long, b long")


def _verified(pairs: DataFrame, texts) -> DataFrame:
    """(a, b, common, either) of the pairs, from their whole texts; ``texts`` gives those of some classes."""
    of_b = texts(pairs.select(F.col("b").alias("cls"))).select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    of_a = texts(pairs.select(F.col("a").alias("cls"))).select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    # b's text travels with the pair, a's is joined last: pairs of one centre come together
    rows = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for i in range(batch.num_rows):
                if a[i] != last:
                    last, own = a[i], shingle_set(batch.column(2)[i].as_py())
                other = shingle_set(batch.column(3)[i].as_py())
                common = len(np.intersect1d(own, other, assume_unique=True))
                out.append((a[i], b[i], common, len(own) + len(other) - common))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "common", "either"])

    return arrow_map(rows, run, "a long, b long, common long, either long")


def _links(verified: DataFrame) -> DataFrame:
    return verified.where(F.col("common") * DENOMINATOR >= F.col("either") * NUMERATOR).select("a", "b")


def _agreed(meetings: DataFrame) -> DataFrame:
    """Pairs (a, b) that meet as often as their smaller requirement, from rows (a, k_a, b, k_b)."""
    met = meetings.groupBy("a", "b").agg(F.count("*").alias("m"), F.min(F.least("k_a", "k_b")).alias("k"))
    return met.where("m >= k").select("a", "b")


def linked_classes(index: DataFrame, signs: DataFrame, texts) -> DataFrame | None:
    """(node, component) of the classes that link with another, None if no two met. signs: cls, n, sign."""
    spark = index.sparkSession
    columns = ("cls", "n", "k", "component")
    families = _families(index)
    member: DataFrame | None = None
    done: list[DataFrame] = []

    def linked(pairs: DataFrame, member: DataFrame | None) -> DataFrame | None:
        """``member`` with the links among new pairs."""
        for known in done:
            pairs = pairs.join(known.union(known.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti")
        pairs = scratch(pairs, "pairs")
        done.append(pairs)
        if pairs.isEmpty():
            return member
        plausible = scratch(_plausible(pairs, signs), "plausible")
        links = scratch(_links(_verified(plausible, texts)), "links")
        release(spark)
        return joined(links, member, plausible, links)

    def joined(links: DataFrame, member: DataFrame | None, *spent: DataFrame) -> DataFrame:
        known = links if member is None else links.union(member.select(F.col("node").alias("a"), F.col("component").alias("b")))
        out = components(known)
        discard(member, *spent)
        return out

    def centred(turn: int):
        return F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("order"), *columns))

    def met(kept: DataFrame) -> DataFrame:
        """Pairs of a list's centre and its members in other components."""
        meet = kept.select("*", *(F.col(f"c.{x}").alias(f"{x}_a") for x in columns))
        meet = meet.where((F.col("component") != F.col("component_a")) & _sized("n", "n_a"))
        return _agreed(meet.select(F.col("cls_a").alias("a"), "k_a", F.col("cls").alias("b"), F.col("k").alias("k_b")))

    # families may be large, so their centres are aggregated before they meet the members; one match is enough
    one = families.withColumn("k", F.lit(1).cast("long"))
    for turn in range(STAR_ROUNDS):
        named = _named(one, member)
        ends = named.groupBy("family").agg(F.min("component").alias("low"), F.max("component").alias("high"), centred(turn).alias("c"))
        # a list whose members are in one component has nothing more to tell
        member = linked(met(named.join(ends.where("low < high").select("family", "c"), "family")), member)
    links = _cells(families, member, texts)
    if not links.isEmpty():
        member = joined(links, member)
    discard(links, families, *done)
    done.clear()
    release(spark)

    rare = index.where("not often").select("shingle", "cls", "n", "k")
    of_list = Window.partitionBy("shingle")
    ends = {"low": F.min("component").over(of_list), "high": F.max("component").over(of_list)}
    for turn in range(STAR_ROUNDS):
        kept = _named(rare, member).withColumns(ends | {"c": centred(turn).over(of_list)}).where("low < high")
        kept = scratch(kept.drop("low", "high"), "lists")
        member = linked(met(kept), member)
        discard(rare)
        rare = kept.select("shingle", "cls", "n", "k")
        rare._scratch = kept._scratch
        release(spark)
    left = scratch(_named(rare, member).withColumns(ends).where("low < high").drop("low", "high"), "left")
    rows = scratch(_apart(left, "shingle"), "rest")
    other = rows.select("shingle", F.col("rest").alias("rest_a"), *(F.col(x).alias(f"{x}_a") for x in columns))
    meet = rows.where("rest").join(other, "shingle").where((F.col("component") != F.col("component_a")) & _sized("n", "n_a"))
    # two of the rest meet from both sides; once is enough
    meet = meet.where("not rest_a or cls > cls_a")
    pair = [F.least("cls", "cls_a").alias("a"), F.when(F.col("cls") < F.col("cls_a"), F.col("k")).otherwise(F.col("k_a")).alias("k_a")]
    pair += [F.greatest("cls", "cls_a").alias("b"), F.when(F.col("cls") < F.col("cls_a"), F.col("k_a")).otherwise(F.col("k")).alias("k_b")]
    member = linked(_agreed(meet.select(*pair)), member)
    discard(rare, left, rows, *done)
    release(spark)
    return member


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    whole = scratch(summaries(docs), "summaries")
    keys = ["n_shingles", "d1", "d2"]
    # copies meet here; partial aggregation leaves one row per task of a large group
    classes = whole.where("n_shingles > 0 and doc_id is not null").groupBy(*keys).agg(
        F.min("doc_id").alias("least"), F.first("sign").alias("sign")
    )
    classes = scratch(classes.select(*keys, "least", "sign", F.xxhash64(*keys).alias("cls")), "classes")
    common = frequent(whole)
    rows = scratch(whole.select("doc_id", *keys), "rows")
    discard(whole)
    release(spark)
    chosen = classes.select(F.col("least").alias("doc_id"), "n_shingles", "d1", "cls")
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("m"))
    repeated = not ids.where("m > 1").isEmpty()
    index = scratch(_index(docs, common), "index")
    release(spark)
    signs = classes.select("cls", F.col("n_shingles").alias("n"), "sign")
    member = linked_classes(index, signs, _texts(docs, chosen, repeated))
    discard(index)
    named = _named(classes.select(*keys, "cls", "least"), member)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # classes that stand alone need no join: they are known by their own smallest id
    moved = named.join(smallest, "component").where("component_id <> least").select(*keys, "component_id")
    copied = rows.where("doc_id is not null").groupBy(*keys).agg(F.min("doc_id").alias("least"), F.count("*").alias("m")).where("m > 1")
    known = copied.select(*keys, "least").join(moved, keys, "full").select(*keys, F.coalesce("component_id", "least").alias("component_id"))
    known = scratch(known, "known")
    discard(classes, member)
    release(spark)
    out = rows.select("doc_id", *keys).join(known, keys, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def _texts(docs: DataFrame, chosen: DataFrame, repeated: bool):
    """A function from some classes (cls) to (cls, text): the text of each class's smallest document.

    Rows that share an id (``repeated``) may hold other texts; digests tell the right one, and one of equals stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                s = shingle_set(batch.column(3)[i].as_py())
                keep.append(len(s) == batch.column(1)[i].as_py() and digests(s)[0] == batch.column(2)[i].as_py())
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(3)], ["cls", "text"])

    def of(classes: DataFrame) -> DataFrame:
        wanted = scratch(chosen.join(classes.distinct(), "cls", "left_semi"), "wanted")
        own = _thinned(docs.select("doc_id", "text"), wanted, "doc_id").join(wanted, "doc_id").select("cls", "n_shingles", "d1", "text")
        return arrow_map(own, run, "cls long, text string").dropDuplicates(["cls"]) if repeated else own.select("cls", "text")

    return of


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op2_ngram_jaccard": op2_ngram_jaccard}
