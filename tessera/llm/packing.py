"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents are tokenised, cut into pieces of at most ``capacity`` tokens, and packed
into as few sequences as possible by dominance reduction followed by best fit.

The instance is described by its length histogram, which has at most ``capacity``
cells however many documents there are. Reduction and best fit work on that
histogram on the driver and give *patterns*: (lengths in a sequence, number of
sequences filled like that). Pieces then find their place by their rank within their
length, so no step gathers pieces.

Defined results for odd input: null text is the empty text (one piece holding only the
end id); rows with equal ids are packed separately; null ids are packed like any other;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, scratch, shuffle_partitions, table

CAPACITY = 4096
END_ID = 1
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

# ---------------------------------------------------------------- tokenising

#: Cached chunks and words of a worker, those that it meets first, which are the frequent ones; others are learned anew each time. Texts that
#: are encoded together.
CACHE_WORDS, GROUP = 400_000, 16
#: Code points below this are composed, so NFC leaves a text of them as it is.
SIMPLE_BELOW = 0x250
_TOKENISERS: dict[str, WordTokeniser] = {}  # one per worker and file


def _ranges(keep) -> str:
    """A regular expression's class body for the simple code points that ``keep`` accepts."""
    return "".join(re.escape(chr(c)) for c in range(SIMPLE_BELOW) if keep(unicodedata.category(chr(c)), chr(c)))


class WordTokeniser:
    """Ids of a text by a ``tokenizers`` file, through a bounded cache of what stands between spaces.

    The file's pre-tokeniser splits a text into words that are encoded separately, so a
    word's ids may be kept. Texts with code points outside the simple range or with an added token of the file
    go to the tokeniser whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = _ranges(lambda cat, _: cat[0] == "L")
        numbers = _ranges(lambda cat, _: cat[0] == "N")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}]+")
        # without the controls that only Python counts as white space
        self.simple = re.compile(f"[\x00-\x1b\x20-\x84\x86-{chr(SIMPLE_BELOW - 1)}]*").fullmatch
        self.chunks: dict[str, bytes] = {}

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of single words."""
        out = {}
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            enc = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, owner = np.asarray(enc.ids, dtype="<u4"), np.asarray(enc.word_ids)
            cuts = np.searchsorted(owner, np.arange(len(part) + 1))
            if len(owner) and owner[-1] != len(part) - 1:
                raise ValueError("the tokeniser split a word differently on its own")
            for w, a, b in zip(part, cuts[:-1].tolist(), cuts[1:].tolist()):
                out[w] = ids[a:b].tobytes()
        return out

    def _learned(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks and of their words that the cache lacks. Words never cross white space, so what stands between two spaces has
        ids of its own; a word has the same ids as a chunk and in it."""
        parts, known = [self.words.findall(x) for x in chunks], self.chunks
        own = self._words(sorted({w for p in parts for w in p if w not in known}))
        for x, p in zip(chunks, parts):
            if len(p) > 1:
                own[x] = b"".join([own[w] if w in own else known[w] for w in p])
        return own

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers. What the texts lack in the cache is
        learned together."""
        found: list[list[bytes] | None] = []
        missing: dict[str, list[tuple[list, int]]] = {}  # where a chunk's ids are to be filled in
        get = self.chunks.get
        for t in texts:
            low = t.lower()
            if not self.simple(t) or any(x in low for x in self.added):
                found.append(None)
                continue
            chunks = low.split()
            ids = list(map(get, chunks))
            found.append(ids)
            for at in [i for i, x in enumerate(ids) if x is None]:
                missing.setdefault(chunks[at], []).append((ids, at))
        own = self._learned(list(missing))
        for chunk, places in missing.items():
            for ids, at in places:
                ids[at] = own[chunk]
        if len(self.chunks) + len(own) <= CACHE_WORDS:  # else these were learned for this time only
            self.chunks.update(own)
        plain = self.tokenizer.encode
        return [
            b"".join(ids) if ids is not None else np.asarray(plain(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
            for t, ids in zip(texts, found)
        ]


def word_tokeniser(path: str) -> WordTokeniser:
    if path not in _TOKENISERS:
        _TOKENISERS[path] = WordTokeniser(path)
    return _TOKENISERS[path]


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokeniser(tokenizer_path)
        for batch in batches:
            out: list[tuple] = []
            for first in range(0, batch.num_rows, GROUP):
                part = batch.slice(first, GROUP)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), tok.encode(texts)):
                    ids = ids + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        out.append((doc_id, k, at // 4, len(own) // 4, zlib.crc32(own)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return arrow_map(docs.select("doc_id", "text"), cut, PIECE_SCHEMA)


# ---------------------------------------------------------------- the packing of a histogram


class _Lengths:
    """Counts by length with the queries that the reduction needs."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.counts = {w: n for w, n in counts.items() if n > 0}
        self.order = sorted(self.counts)

    def take(self, w: int, n: int) -> None:
        self.counts[w] -= n
        if not self.counts[w]:
            del self.counts[w]
            self.order.pop(bisect_left(self.order, w))

    def at_most(self, limit: int, used: Counter) -> int | None:
        """The largest length <= limit of which some are left besides ``used``."""
        i = bisect_left(self.order, limit + 1) - 1
        while i >= 0 and self.counts[self.order[i]] <= used[self.order[i]]:
            i -= 1
        return self.order[i] if i >= 0 else None

    def smallest(self, k: int, used: Counter) -> list[int]:
        out: list[int] = []
        for w in self.order:
            out += [w] * min(k - len(out), self.counts[w] - used[w])
            if len(out) == k:
                break
        return out


def _dominant(lengths: _Lengths, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``w`` that dominates every feasible set with ``w``, if the rules show one."""
    room, used = capacity - w, Counter([w])
    best = lengths.at_most(room, used)
    if best is None:
        return (w,)
    if best == room:
        return (w, best)
    least = lengths.smallest(3, used)
    if len(least) < 2 or least[0] + least[1] > room:
        return (w, best)  # one partner at most: the largest dominates the others
    if len(least) < 3 or sum(least) > room:  # two partners at most
        top, pair = 0, None
        for a in reversed(lengths.order[: bisect_left(lengths.order, room + 1)]):
            if 2 * a <= top:
                break
            if lengths.counts[a] <= used[a]:
                continue
            b = lengths.at_most(min(a, room - a), used + Counter([a]))
            if b is not None and a + b > top:
                top, pair = a + b, (a, b)
        if pair is None or best >= top:
            return (w, best)
        if top == room and pair[0] == best:
            # The pair fills the room with the largest partner there is, so each part of another
            # set with w can be exchanged for one of the pair that is at least as large.
            smaller = lengths.at_most(pair[1], used + Counter([pair[0]]))
            rest = lengths.at_most(room - least[0], used)
            if smaller == pair[1] and rest is not None and rest <= pair[0]:
                return (w, *pair)
    return None


def _repeat(lengths: _Lengths, chosen: tuple[int, ...]) -> int:
    """How often a pattern may be laid while its rule stays the same: until one of its lengths runs out."""
    return min(lengths.counts[w] // n for w, n in Counter(chosen).items())


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that use up ``counts``, by dominance reduction, then best fit decreasing.

    Reduction goes through the lengths from the largest and lays down each set that
    dominates all others with that length. Removing such a set can only make further
    rules apply, so it starts over until nothing changes. What is left goes by best fit.
    """
    lengths, patterns = _Lengths(counts), []
    changed = True
    while changed and lengths.order:
        changed = False
        for w in reversed(list(lengths.order)):
            while w in lengths.counts and (chosen := _dominant(lengths, w, capacity)):
                times = _repeat(lengths, chosen)
                if not times:  # a pattern with more of a length than there are
                    break
                for v, n in Counter(chosen).items():
                    lengths.take(v, n * times)
                patterns.append((chosen, times))
                changed = True
    return patterns + _best_fit(lengths, capacity)


def _best_fit(lengths: _Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over classes of equal bins: residual -> [(lengths in the bin, number of bins)]."""
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    residuals: list[int] = []

    def put(residual: int, content: tuple[int, ...], n: int) -> None:
        if residual not in bins or not bins[residual]:
            if residual not in bins:
                bins[residual] = []
            insort(residuals, residual)
        bins[residual].append((content, n))

    for w in reversed(list(lengths.order)):
        left = lengths.counts[w]
        while left:
            i = bisect_left(residuals, w)
            if i == len(residuals):  # open new ones, each filled before the next, as best fit would
                each = capacity // w
                if full := left // each:
                    put(capacity - each * w, (w,) * each, full)
                if rest := left % each:
                    put(capacity - rest * w, (w,) * rest, 1)
                break
            r = residuals[i]
            content, n = bins[r].pop()
            if not bins[r]:
                del bins[r]
                residuals.pop(i)
            each = min(r // w, left)
            times = min(n, left // each)
            if n > times:
                put(r, content, n - times)
            put(r - each * w, content + (w,) * each, times)
            left -= each * times
    return [x for r in sorted(bins) for x in bins[r]]


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Martello and Toth's L2 bound on the number of sequences."""
    best = -(-sum(w * n for w, n in counts.items()) // capacity)
    items = sorted(counts.items())
    for a in [0, *(w for w, _ in items if w <= capacity // 2)]:
        n1 = sum(n for w, n in items if w > capacity - a)
        mid = [(w, n) for w, n in items if capacity // 2 < w <= capacity - a]
        n2, small = sum(n for _, n in mid), sum(w * n for w, n in items if a <= w <= capacity // 2)
        best = max(best, n1 + n2 + max(0, -(-(small - (capacity * n2 - sum(w * n for w, n in mid))) // capacity)))
    return best


# ---------------------------------------------------------------- places


def _places(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """Runs of ranks by length: rank r of a run that begins at ``rank`` goes to sequence
    ``sequence + (r - rank) // slots`` and offset ``offset + (r - rank) % slots * length``."""
    rank: Counter = Counter()
    rows, sequence = [], 0
    for content, times in patterns:
        offset = 0
        for w, slots in sorted(Counter(content).items(), reverse=True):
            rows.append((w, rank[w], sequence, offset, slots))
            rank[w] += slots * times
            offset += w * slots
        sequence += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "offset", "slots"), cols))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length``.

    Equal lengths are interchangeable. A row's rank within its length is made from a
    salted window and the salts' running counts, so a length that a third of all rows
    share is spread over many tasks.
    """
    spark = pieces.sparkSession
    pieces = scratch(pieces, "pieces")
    salts = max(8, 2 * shuffle_partitions(spark))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    cells = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(pack_histogram(histogram, capacity), capacity))

    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_own", F.row_number().over(own) - 1)
        .join(cells.select("length", "_salt", "_before"), ["length", "_salt"])
        .withColumn("_rank", F.col("_own") + F.col("_before"))
        .drop("_salt", "_own", "_before")
    )
    names = [c for c in ranked.columns if c != "_rank"]
    schema = ", ".join(f"{c} {t}" for c, t in ranked.select(*names).dtypes) + ", sequence_id bigint, offset bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        # one sorted key of (length, rank); ranks stay below 2**48
        starts = (p["length"] << 48) + p["rank"]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(starts, (length << 48) + rank, side="right") - 1
            n = rank - p["rank"][run]
            sequence = p["sequence"][run] + n // p["slots"][run]
            offset = p["offset"][run] + n % p["slots"][run] * length
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return arrow_map(ranked, place, schema)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(pieces_of(docs, tokenizer_path("word_bpe_49k.json")))


QUERIES = {"op6_best_fit_packing": op6_best_fit_packing}
