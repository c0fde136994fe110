"""Byte-level BPE by DuckDB recursive queries inside each partition, and decoding by ordered aggregation.

A partition's texts are split into pieces; each distinct piece is a set of (piece, position, token) rows. A recursive
query joins neighbouring rows with the merge table, contracts each piece's leftmost pair of least rank, and lets a
piece go when no pair is left. Ids are decoded by joining (text, position, id) rows with the vocabulary and
aggregating them in order. Spark partitions the documents and nothing is shuffled.

A round of the recursive query reads every row of a piece, so a piece of n bytes costs n * n. Pieces over
``MAX_RECURSIVE`` bytes (no natural word is) are contracted by the same rule with a heap.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows are encoded one by one, so repeated
rows and any doc_id are fine; special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from battlelake.llm import bpe_split, bytesets
from battlelake.llm.piece_cache import PieceCache

MAX_RECURSIVE = 256

#: Distinct pieces in one recursive query.
PIECES_PER_QUERY = 20_000

CONTRACT = """
WITH RECURSIVE step(piece, pos, token, live) AS (
    SELECT piece, pos, token, true FROM bytes_in
    UNION ALL (
        WITH pairs AS (
            SELECT piece, pos, token, lead(token) OVER w AS next_token, lead(pos) OVER w AS next_pos
            FROM step WHERE live WINDOW w AS (PARTITION BY piece ORDER BY pos)
        ),
        ranked AS (
            SELECT p.piece, p.next_pos, (m.merged::BIGINT << 16) | p.pos AS rank_pos
            FROM pairs p JOIN merges m ON m.pair = p.token::BIGINT * 4294967296 + p.next_token
        ),
        best AS (
            SELECT piece, min(rank_pos) AS rank_pos, arg_min(next_pos, rank_pos) AS gone FROM ranked GROUP BY piece
        )
        SELECT p.piece, p.pos, CASE WHEN p.pos = (b.rank_pos & 65535) THEN (b.rank_pos >> 16)::INTEGER ELSE p.token END,
               b.piece IS NOT NULL
        FROM pairs p LEFT JOIN best b ON p.piece = b.piece
        WHERE b.gone IS NULL OR p.pos <> b.gone
    )
)
SELECT piece, token FROM step WHERE NOT live ORDER BY piece, pos
"""

DECODE = """
SELECT i.text_no, string_agg(v.bytes, '' ORDER BY i.pos) AS bytes FROM ids_in i JOIN vocabulary v ON v.id = i.id GROUP BY i.text_no
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """The tables of one rank file in a DuckDB database of this process's memory."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [
            (self.ranks[token[:k]] * 2**32 + self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items() for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        # Spark runs a task for each core; a task's queries take one thread.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        self._table("merges_in", pair=pa.array([m[0] for m in merges], pa.int64()), merged=pa.array([m[1] for m in merges], pa.int32()))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self._table("vocabulary_in", id=pa.array(self.ranks.values(), pa.int32()), bytes=pa.array([t.hex() for t in self.ranks]))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
        self.cache = PieceCache(bpe_split.by_regex, self.encode_pieces)

    def _table(self, name: str, **columns) -> None:
        self.db.register(name, pa.table(columns))

    def encode_pieces(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(raw)
        short = [i for i, b in enumerate(raw) if len(b) <= MAX_RECURSIVE]
        for at in range(0, len(short), PIECES_PER_QUERY):
            chosen = short[at:at + PIECES_PER_QUERY]
            lengths = np.array([len(raw[i]) for i in chosen])
            starts = np.cumsum(lengths) - lengths
            self._table(
                "bytes_in",
                piece=np.repeat(np.arange(len(chosen), dtype=np.int32), lengths),
                pos=(np.arange(lengths.sum()) - np.repeat(starts, lengths)).astype(np.int32),
                token=self.single[np.frombuffer(b"".join(raw[i] for i in chosen), np.uint8)],
            )
            rows = self.db.execute(CONTRACT).fetchnumpy()
            tokens = np.asarray(rows["token"], np.int32)
            ends = np.cumsum(np.bincount(np.asarray(rows["piece"]), minlength=len(chosen)))
            for i, ids in zip(chosen, np.split(tokens, ends[:-1]), strict=True):
                out[i] = ids
        for i, b in enumerate(raw):
            if out[i] is None:
                out[i] = self.contracted(b)
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def contracted(self, word: bytes) -> np.ndarray:
        """The same rule for a long piece: the pair of least rank, the leftmost of equals, until none is left."""
        n, ranks = len(word), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def pair(i: int) -> tuple[int, int, int] | None:
            j = end[i]
            rank = ranks.get(word[i:end[j]]) if j < n else None
            return None if rank is None else (rank, i, end[j])

        heap = [p for p in map(pair, range(n)) if p]
        heapq.heapify(heap)
        while heap:
            rank, i, to = heapq.heappop(heap)
            if not alive[i] or (p := pair(i)) is None or p != (rank, i, to):
                continue
            alive[end[i]] = False
            end[i] = to
            if to < n:
                before[to] = i
            for k in (i, before[i]):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([ranks[word[i:end[i]]] for i in range(n) if alive[i]], np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        return self.cache.encode(texts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        self._table("ids_in", text_no=np.repeat(np.arange(len(counts), dtype=np.int32), counts),
                    pos=np.arange(len(ids), dtype=np.int32), id=ids.astype(np.int32))
        out = [b""] * len(counts)
        for number, text in self.db.execute(DECODE).fetchall():
            out[number] = bytes.fromhex(text)
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker process and file."""
    return Codec(path)


def _added(df: DataFrame, name: str, kind) -> StructType:
    return StructType([*df.schema.fields]).add(bytesets.free_name(df, name), kind)


def _positioned(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Columns named by position, since names may repeat."""
    return pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns, and the array ``ids`` (or a free name) of each whole text."""
    schema, at = _added(docs, "ids", ArrayType(IntegerType())), docs.columns.index(text)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in bytesets.slices(_positioned(batch), str(at)):
                ids, counts = own.encode(part.column(at).fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids, counts)], names=schema.names)

    return bytesets.map_arrow(docs, encoded, schema)


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns, ``ids`` and ``decoded`` (or free names), in one pass.

    ``decode(encode(...))`` is the same, but Spark would run both functions at once, each in a process of its own with a
    codec of its own.
    """
    schema, at = _added(docs, "ids", ArrayType(IntegerType())), docs.columns.index(text)
    schema = schema.add(bytesets.free_name(docs, "decoded"), BinaryType())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in bytesets.slices(_positioned(batch), str(at)):
                ids, counts = own.encode(part.column(at).fill_null("").to_pylist())
                texts = pa.array(own.decode(ids, counts), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids, counts), texts], names=schema.names)

    return bytesets.map_arrow(docs, coded, schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns, and ``decoded`` (or a free name): the bytes that the ids stand for."""
    schema, at = _added(df, "decoded", BinaryType()), df.columns.index(ids)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(at).fill_null([])
                counts = np.asarray(column.value_lengths(), np.int64)
                texts = own.decode(np.asarray(column.flatten(), np.int32), counts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=schema.names)

    return bytesets.map_arrow(df, decoded, schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of what they decode to."""
    rows = bytesets.only(docs, doc_id="bigint", text="string")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        decimal = [str(i) for i in range(max(own.ranks.values()) + 1)]
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                ids, counts = own.encode(part.column("text").fill_null("").to_pylist())
                texts = own.decode(ids, counts)
                ends = np.cumsum(counts)
                lines = [" ".join(map(decimal.__getitem__, ids[a:b].tolist())) for a, b in zip(ends - counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                ], schema=schema)

    return bytesets.map_arrow(rows, digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
