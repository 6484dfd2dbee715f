"""Byte-level BPE by DuckDB recursive queries, one embedded connection per worker.

A text is split by the tokeniser's pattern; pieces recur, so each distinct piece is
encoded once per worker through a bounded cache. Encoding is a recursive query over
token-position rows: each step joins neighbouring tokens with the merge table and
contracts every piece's leftmost pair of least rank, until no piece has a pair left.
Decoding joins the ids with the vocabulary and aggregates the bytes in order.

Long pieces would need about as many steps as they have bytes. They are first cut where no entry of the vocabulary can
reach across, and what stays long takes several contractions of one rank in a step: all that the rule would make one after the other, up
to the first that gives rise to a pair of lower rank. So ids are the same, and memory is linear in the piece.

The merge table holds each way to write a vocabulary entry as two entries, with the
entry's rank; that is the rank order that rank files define.

Defined results for odd input: null text is the empty text (0 tokens, digests of the
empty string); repeated rows and null ids give a row each; an empty table gives no
rows; extra columns are ignored; very long texts and very long pieces without a break are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import arrow_map, table

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Pieces that a worker keeps; the cache starts anew beyond this.
CACHE_PIECES = 700_000
#: Bytes of pieces in one recursive query, so that its intermediate rows stay small.
QUERY_BYTES = 800_000
#: Rows of all steps of one recursive query.
STEP_ROWS = 12_000_000
#: DuckDB's memory; beyond ``QUERY_BYTES`` of one piece it grows by so many bytes with each byte of the piece.
MEMORY_MB, PIECE_ROW = 400, 400
#: Ids that are decoded together.
GROUP_IDS = 200_000
#: Bytes from which on a piece counts as long.
LONG = 512

ENCODE = """
WITH RECURSIVE step(i, word, pos, tok) AS (
    SELECT 0, word, pos, tok FROM start
  UNION ALL -- at most {most} steps; what is not done then starts anew, so that the rows of steps stay few
    (
    WITH pairs AS (
      SELECT s.i, s.word, s.pos, s.tok, s.before, m.merged, m.merged::BIGINT * 4294967296 + s.pos AS key
      FROM (
        SELECT *, lead(tok) OVER w AS next, lag(pos) OVER w AS before
        FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)
      ) s
      LEFT JOIN merges m ON m.l = s.tok AND m.r = s.next
    ), least AS (
      SELECT word, min(key) AS key, (min(key) % 4294967296)::INTEGER AS pos FROM pairs WHERE key IS NOT NULL GROUP BY word
    )
    SELECT p.i + 1, p.word, p.pos, CASE WHEN p.pos = x.pos THEN p.merged ELSE p.tok END
    FROM pairs p JOIN least x ON p.word = x.word
    WHERE p.before IS DISTINCT FROM x.pos AND p.i < {most}
    )
)
SELECT s.word, s.pos, s.tok, s.i
FROM step s JOIN (SELECT word, max(i) AS i FROM step GROUP BY word) l ON s.word = l.word AND s.i = l.i
ORDER BY s.word, s.pos
"""

#: The same contractions, but in a step all those of a word's least rank that follow each other.
ENCODE_LONG = """
WITH RECURSIVE step(i, word, pos, tok) AS (
    SELECT 0, word, pos, tok FROM start
  UNION ALL
    (
    WITH placed AS (
      SELECT *, row_number() OVER w AS idx, lead(tok) OVER w AS next, lead(tok, 2) OVER w AS after, lag(tok) OVER w AS before
      FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)
    ), pairs AS (
      SELECT s.*, m.merged FROM placed s LEFT JOIN merges m ON m.l = s.tok AND m.r = s.next
    ), least AS (
      SELECT word, min(merged) AS merged FROM pairs WHERE merged IS NOT NULL GROUP BY word
    ), found AS (
      SELECT p.*, p.idx - row_number() OVER (PARTITION BY p.word ORDER BY p.idx) AS run
      FROM pairs p JOIN least x ON p.word = x.word AND p.merged = x.merged
    ), apart AS ( -- of pairs that overlap every second one
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY idx) AS nth FROM found) WHERE nth % 2 = 1
    ), beside AS (
      SELECT word, idx, merged, after,
             CASE WHEN lag(idx) OVER (PARTITION BY word ORDER BY idx) = idx - 2 THEN merged ELSE before END AS before
      FROM apart
    ), stops AS ( -- the first whose token makes a pair of lower rank with a neighbour
      SELECT b.word, min(b.idx) AS idx
      FROM beside b LEFT JOIN merges x ON x.l = b.before AND x.r = b.merged LEFT JOIN merges y ON y.l = b.merged AND y.r = b.after
      WHERE x.merged < b.merged OR y.merged < b.merged GROUP BY b.word
    ), chosen AS (
      SELECT b.word, b.idx, b.merged FROM beside b LEFT JOIN stops s ON b.word = s.word WHERE s.idx IS NULL OR b.idx <= s.idx
    )
    SELECT p.i + 1, p.word, p.pos, coalesce(c.merged, p.tok)
    FROM pairs p JOIN least x ON p.word = x.word
    LEFT JOIN chosen c ON c.word = p.word AND c.idx = p.idx LEFT JOIN chosen d ON d.word = p.word AND d.idx = p.idx - 1
    WHERE d.idx IS NULL AND p.i < {most}
    )
)
SELECT s.word, s.pos, s.tok, s.i
FROM step s JOIN (SELECT word, max(i) AS i FROM step GROUP BY word) l ON s.word = l.word AND s.i = l.i
ORDER BY s.word, s.pos
"""

DECODE = """
SELECT t.word, string_agg(hex(v.bytes), '' ORDER BY t.pos) AS text
FROM tokens t JOIN vocabulary v ON v.id = t.tok
GROUP BY t.word ORDER BY t.word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankCodec:
    """Encodes and decodes pieces by the ranks in a file, with recursive SQL."""

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        self.ranks = ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.single = np.zeros(256, dtype=np.int32)
        for b in range(256):
            self.single[b] = ranks[bytes([b])]
        merges = [
            (left, right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None
        ]
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{MEMORY_MB}MB", "temp_directory": ""})
        cols = np.array(merges, dtype=np.int32).T
        merge_rows = pa.table({"l": cols[0], "r": cols[1], "merged": cols[2]})
        words = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())})
        self.con.register("merge_rows", merge_rows)
        self.con.register("words", words)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM words")
        self.inner: tuple[np.ndarray, np.ndarray] | None = None
        self.ids: dict[str, bytes] = {}  # decimals, comma-joined
        self.back: dict[str, bytes] = {}  # what the ids decode to

    def cuts(self, raw: bytes) -> list[bytes]:
        """A piece's parts, between which no entry reaches: an entry of two bytes is a pair, any longer one holds a triple."""
        if self.inner is None:
            pairs, triples = np.zeros(1 << 16, dtype=bool), np.zeros(1 << 24, dtype=bool)
            for token in self.ranks:
                if len(token) == 2:
                    pairs[token[0] << 8 | token[1]] = True
                for k in range(len(token) - 2):
                    triples[token[k] << 16 | token[k + 1] << 8 | token[k + 2]] = True
            self.inner = pairs, triples
        pairs, triples = self.inner
        b = np.frombuffer(raw, dtype=np.uint8).astype(np.int32)
        crossed = pairs[b[:-1] << 8 | b[1:]]
        if len(b) > 2:
            held = triples[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
            crossed[:-1] |= held
            crossed[1:] |= held
        at = [0, *(np.flatnonzero(~crossed) + 1).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def encode_long(self, raw: bytes) -> np.ndarray:
        """The ids of a long piece."""
        parts = self.cuts(raw)
        out: list[np.ndarray] = []
        at = 0
        while at < len(parts):  # neighbours that are alike in size, up to the bytes of a query
            upto, total, long = at, 0, len(parts[at]) > LONG
            while upto < len(parts) and (upto == at or (total + len(parts[upto]) <= QUERY_BYTES and (len(parts[upto]) > LONG) == long)):
                total += len(parts[upto])
                upto += 1
            more = max(0, total - QUERY_BYTES) * PIECE_ROW // 1_000_000
            if more:
                self.con.execute(f"SET memory_limit = '{MEMORY_MB + more}MB'")
            out.append(self.encode_pieces(parts[at:upto], ENCODE_LONG if long else ENCODE)[1])
            if more:
                self.con.execute(f"SET memory_limit = '{MEMORY_MB}MB'")
            at = upto
        return np.concatenate(out)

    def encode_pieces(self, pieces: list[bytes], query: str = ENCODE) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers and ids, in order; pieces must not be empty."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        pos = (np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        word, tok = word, self.single[raw]
        done: list[tuple[np.ndarray, ...]] = []
        while len(word):
            most = max(1, STEP_ROWS // len(word))
            self.con.register("start", pa.table({"word": word, "pos": pos, "tok": tok}))
            out = self.con.sql(query.format(most=most)).to_arrow_table()
            self.con.unregister("start")
            word, pos, tok, step = (out[c].to_numpy() for c in ("word", "pos", "tok", "i"))
            over = step < most
            done.append((word[over], tok[over]))
            word, pos, tok = word[~over], pos[~over], tok[~over]
        word, tok = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int32),) * 2
        order = np.argsort(word, kind="stable")
        return word[order], tok[order]

    def decode_pieces(self, word: np.ndarray, tok: np.ndarray) -> list[bytes]:
        if not len(tok):
            return []
        self.con.register("tokens", pa.table({"word": word, "tok": tok, "pos": np.arange(len(tok))}))
        out = self.con.sql(DECODE).to_arrow_table()["text"].to_pylist()
        self.con.unregister("tokens")
        return list(map(bytes.fromhex, out))

    def learn(self, pieces: list[str]) -> None:
        """Keeps for each piece the decimals of its ids and the bytes that they decode to."""
        raw = [p.encode() for p in pieces]
        whole = [(p, r) for p, r in zip(pieces, raw) if r in self.ranks]  # a piece that is an entry has that id
        ids = np.array([self.ranks[r] for _, r in whole], dtype=np.int32)
        for (p, _), one, back in zip(whole, ids.tolist(), self.decode_pieces(np.arange(len(ids)), ids)):
            self.ids[p], self.back[p] = str(one).encode(), back
        for p, r in zip(pieces, raw):
            if len(r) > LONG and r not in self.ranks:
                tok = self.encode_long(r)
                self.ids[p] = ",".join(map(str, tok.tolist())).encode()
                self.back[p] = b"".join(self.decode_pieces(np.zeros(len(tok[k : k + GROUP_IDS]), np.int32), tok[k : k + GROUP_IDS])[0] for k in range(0, len(tok), GROUP_IDS))
        rest = [(p, r) for p, r in zip(pieces, raw) if r not in self.ranks and len(r) <= LONG]
        pieces, raw = [p for p, _ in rest], [r for _, r in rest]
        at = 0
        while at < len(pieces):
            upto, total = at, 0
            while upto < len(pieces) and (upto == at or total + len(raw[upto]) <= QUERY_BYTES):
                total += len(raw[upto])
                upto += 1
            word, tok = self.encode_pieces(raw[at:upto])
            back = self.decode_pieces(word, tok)
            cuts = np.searchsorted(word, np.arange(upto - at + 1)).tolist()
            text = list(map(str, tok.tolist()))
            for k in range(upto - at):
                self.ids[pieces[at + k]] = ",".join(text[cuts[k] : cuts[k + 1]]).encode()
                self.back[pieces[at + k]] = back[k]
            at = upto

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, sha256 of the ids, sha256 of the decoded bytes) of each text."""
        split = [self.split(t) for t in texts]
        unseen = {p for s in split for p in s}.difference(self.ids)
        if len(self.ids) + len(unseen) > CACHE_PIECES and self.ids:
            self.ids.clear()
            self.back.clear()
            unseen = {p for s in split for p in s}
        self.learn(sorted(unseen))
        out = []
        for pieces in split:
            ids = b",".join(map(self.ids.__getitem__, pieces))
            back = b"".join(map(self.back.__getitem__, pieces))
            n = ids.count(b",") + 1 if ids else 0
            out.append((n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
        return out


_CODECS: dict[tuple[str, str], RankCodec] = {}  # one per worker, file and pattern


def codec(path: str, pattern: str) -> RankCodec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = RankCodec(path, pattern)
    return _CODECS[path, pattern]


#: Characters of texts that are split and encoded together.
GROUP_CHARS = 4_000_000


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(path, pattern)
        ids: list[int | None] = []
        texts: list[str] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = (ids, *zip(*enc.digests(texts))) if texts else ((),) * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            out = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= GROUP_CHARS:
                    yield flush()
                    ids, texts, size = [], [], 0
        yield flush()

    return arrow_map(docs.select("doc_id", "text"), run, SCHEMA)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
