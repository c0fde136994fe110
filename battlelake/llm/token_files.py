"""Token ids in blocks of frequency-ranked, byte-aligned variable-length numbers with control bytes apart.

Documents are dealt by ranges of (doc_id, hash of the text), encoded, and written in that order as self-contained blocks. A block
ranks its own ids by frequency, so frequent ids take one byte; ranks are written in one to four bytes, four lengths
to a control byte, control bytes before data bytes. Reading looks the lengths up in a table of 256 control bytes.

Blocks are rows of a parquet table, since Spark's writers reach every store; ``Block`` is the byte format itself.
Documents are read once; no count of the whole corpus is needed before the first byte is written.

Defined cases: a null or empty text is only the end id; null doc_ids come first; rows of equal doc_id follow each
other in order of a hash of their texts; an empty table gives no block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from battlelake import session
from battlelake.llm import bpe_split, bytesets
from battlelake.llm.piece_cache import PieceCache

MAGIC = b"FRVB1\0\0\0"
HEADER = struct.Struct("<8sQQQQ")

#: Ids in one block, unless a single document has more.
BLOCK_IDS = 1_000_000

END_ID = 0

#: Pieces that one call of the library encodes.
LINES = 20_000

#: Length of each of the four numbers that a control byte describes, and their sum.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
TOTALS = LENGTHS.sum(axis=1)


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit numbers; the last control byte counts absent ones as 0."""
    n = len(numbers)
    values = np.zeros(-(-n // 4) * 4, np.uint32)
    values[:n] = numbers
    size = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = (size - 1).reshape(-1, 4).astype(np.uint8)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    places = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8), places[np.arange(4) < size[:, None]]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers behind the control bytes."""
    size = LENGTHS[control].ravel()
    starts = np.cumsum(size) - size
    padded = np.concatenate((data, np.zeros(4, np.uint8)))
    out = np.zeros(len(size), np.uint32)
    for k in range(4):
        there = size > k
        out[there] |= padded[starts[there] + k].astype(np.uint32) << np.uint32(8 * k)
    return out[:n]


class Block:
    """The byte format: header, doc ids with a byte that says whether each is null, lengths, ids by rank, numbers."""

    @staticmethod
    def write(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
        present, frequency = np.unique(ids, return_counts=True)
        order = np.argsort(-frequency, kind="stable")
        ranked = present[order].astype("<u4")
        rank_of = np.zeros(int(present.max()) + 1 if len(present) else 1, np.uint32)
        rank_of[ranked] = np.arange(len(ranked))
        control, data = pack(rank_of[ids])
        known = np.array([d is not None for d in doc_ids], np.uint8)
        numbers = np.array([d or 0 for d in doc_ids], "<i8")
        return b"".join((
            HEADER.pack(MAGIC, len(doc_ids), len(ids), len(ranked), len(data)), known.tobytes(), numbers.tobytes(),
            np.asarray(counts, "<u8").tobytes(), ranked.tobytes(), control.tobytes(), data.tobytes(),
        ))

    @staticmethod
    def read(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Doc ids, the number of ids of each document, and all ids."""
        magic, docs, n, ranked_n, data_n = HEADER.unpack_from(block)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(block, kind, count, at)
            at += out.nbytes
            return out

        known, numbers, counts = take("u1", docs), take("<i8", docs), take("<u8", docs).astype(np.int64)
        ranked, control, data = take("<u4", ranked_n), take("u1", -(-n // 4)), take("u1", data_n)
        ids = ranked[unpack(control, data, n)] if n else np.zeros(0, np.uint32)
        return [int(d) if k else None for k, d in zip(known, numbers, strict=True)], counts, ids


class LibraryEncoder:
    """The tokenizers library over distinct pieces, many to a call."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        # The byte-level alphabet stands for one byte with each character, whatever it takes in UTF-8.
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        self.cache = PieceCache(self.classify, self.encode_pieces)

    def classify(self, char: str) -> int:
        """The character's class as the library splits it: what it stays together with."""
        for kind, mate in ((bpe_split.LETTER, "a"), (bpe_split.DIGIT, "1"), (bpe_split.OTHER, "!")):
            if len(self.splitter.pre_tokenize_str(mate + char)) == 1:
                return kind
        return bpe_split.SPACE

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces with anything but white space are set on lines of one text: a line feed never joins a piece."""
        plain = np.array([not p.isspace() and b"\n" not in p for p in pieces], bool)
        # White space of more than ASCII is no line either: the library has its own rules for runs of it.
        plain[plain] = [not (p[0] > 0x7F or p[-1] > 0x7F) or not p.decode().isspace() for p in map(pieces.__getitem__, np.flatnonzero(plain))]
        sizes = np.zeros(len(pieces), np.int64)
        chunks: list[np.ndarray] = []
        lines = np.flatnonzero(plain)
        for at in range(0, len(lines), LINES):
            some = lines[at:at + LINES]
            own = [pieces[i] for i in some.tolist()]
            text = b"\n".join(own).decode()
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum(self.bytes_of[ids])
            piece_ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
            stop = np.searchsorted(ends, piece_ends)
            if not np.array_equal(ends[stop], piece_ends):
                raise RuntimeError("the library split a piece differently")
            sizes[some] = np.diff(stop, prepend=-2) - 1
            chunks.append(np.delete(ids, stop[:-1] + 1))
        ids = np.concatenate(chunks) if chunks else np.zeros(0, np.int32)
        if plain.all():
            return ids, sizes
        flat = {i: np.array(self.library.encode(pieces[i].decode(), add_special_tokens=False).ids, np.int32) for i in np.flatnonzero(~plain).tolist()}
        for i, found in flat.items():
            sizes[i] = len(found)
        starts = np.cumsum(sizes) - sizes
        out, other = np.zeros(int(sizes.sum()), np.int32), np.repeat(~plain, sizes)
        out[~other] = ids
        for i, found in flat.items():
            out[starts[i]:starts[i] + len(found)] = found
        return out, sizes


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write(docs: DataFrame, path: str, out: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents, each with ``end_id`` appended, in ascending doc_id order to the table ``out``.

    A row has its task's number, its place among the task's blocks, the ids in those before it, its own, the block.
    """
    rows = bytesets.only(docs, doc_id="bigint", text="string")
    # Ranges are drawn from sampled keys, so the key has a hash in the text's place.
    keyed = rows.withColumn("text_hash", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "text").drop("text_hash")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part_no, number = encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = before = 0

        def block() -> pa.RecordBatch:
            nonlocal doc_ids, counts, ids, held, before, number
            blob = Block.write(doc_ids, np.concatenate(counts), np.concatenate(ids))
            row = [part_no, number, before, held, blob]
            doc_ids, counts, ids, held, before, number = [], [], [], 0, before + held, number + 1
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, FIELDS, strict=True)], schema=FIELDS)

        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                flat, sizes = own.cache.encode(part.column("text").fill_null("").to_pylist())
                ends = np.cumsum(sizes)
                flat = np.insert(flat, ends, end_id)
                doc_ids += part.column("doc_id").to_pylist()
                counts.append(sizes + 1)
                ids.append(flat)
                held += len(flat)
                if held >= block_ids:
                    yield block()
        if doc_ids:
            yield block()

    bytesets.map_arrow(ordered, blocks, "part int, block int, before long, ids long, data binary").write.parquet(out)


FIELDS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("ids", pa.int64()), ("data", pa.binary())])


def read(spark: SparkSession, out: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), ids."""
    stored = spark.read.parquet(out)
    # One sum for each part: as many rows as the writer had tasks, whatever the number of documents.
    sums = {r["part"]: r["ids"] for r in stored.groupBy("part").agg(F.sum("ids").alias("ids")).collect()}
    earlier, total = {}, 0
    for part in sorted(sums):
        earlier[part], total = total, total + sums[part]
    blocks = stored.select("part", "before", "data")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at, data in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "data")), strict=True):
                doc_ids, counts, ids = Block.read(data)
                ends = np.cumsum(counts)
                for a in range(0, len(doc_ids), 256):
                    b = min(a + 256, len(doc_ids))
                    lo, hi = int(ends[a] - counts[a]), int(ends[b - 1])
                    offsets = np.concatenate(([0], np.cumsum(counts[a:b]))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[a:b], pa.int64()), pa.array(earlier[part] + at + ends[a:b] - counts[a:b], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[lo:hi].astype(np.int32))),
                    ], names=["doc_id", "start", "ids"])

    return bytesets.map_arrow(blocks, documents, "doc_id long, start long, ids array<int>")


def report(docs: DataFrame, path: str) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, crc32 of the little-endian ids."""
    spark = docs.sparkSession
    out = session.work_path(spark, "token-ids")
    write(docs, path, out)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = np.asarray(ids.offsets)
            flat = np.asarray(ids.values, np.int32).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets), pa.int64()),
                pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return bytesets.map_arrow(read(spark, out), sums, "doc_id long, start long, n_tokens long, ids_crc32 long")

