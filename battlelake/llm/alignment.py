"""Alignment of two tokenizers over a corpus: groups, links, and how many documents hold each linked pair of ids.

Both tokenizers cover the bytes of one text (A byte-level BPE, B SentencePiece). Ends that both have cut a document into groups;
tokens whose byte ranges overlap are linked. A task numbers its documents in blocks and keeps, for each pair of ids, a compressed
bitmap of the block's documents that hold it: sorted 16-bit numbers while they are few, bits when they are many. Bitmaps of
a block's slices are OR-merged. Further bitmaps, the multiplicity planes, hold the binary digits of the links beyond
the first. Popcounts added up over blocks give a pair's documents in the corpus; the postings then carry
that count back: each bitmap adds its pair's score to the documents it names, once for every link.

Counts are one row per pair, blocks are bounded by documents and by links, and a frequent pair is one bitmap in each
block. No group of all documents of a pair exists anywhere.

Defined cases: a null or empty text, or one whose bytes either tokenizer doesn't give back behind a blank, has zeros and an
empty digest column; repeated rows are documents of their own; null and repeated doc_ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from battlelake import session
from battlelake.llm import bytesets, pieces, token_files

#: Documents of a block (at most 65,536), and links after which a block is closed early.
BLOCK_DOCS, BLOCK_LINKS = 4096, 4_000_000

#: Bytes of a bitmap in bits; a list of numbers is always shorter.
BITMAP = BLOCK_DOCS // 8

FIELDS = pa.schema([
    ("doc_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32()),
    ("n_docs", pa.int32()), ("docs", pa.binary())])
DDL = ("doc_id long, block long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "a int, b int, plane int, n_docs int, docs binary")


def bitmaps(run: np.ndarray, places: np.ndarray, runs: int) -> pa.Array:
    """One compressed bitmap for each of ``runs`` runs: the places with that run's number, ascending within it."""
    counts = np.bincount(run, minlength=runs)
    sizes = np.where(2 * counts < BITMAP, 2 * counts, BITMAP)
    offsets = np.append(0, np.cumsum(sizes))
    data = np.zeros(int(offsets[-1]), np.uint8)
    few = sizes[run] < BITMAP
    rank = np.arange(len(run)) - (np.cumsum(counts) - counts)[run]
    data.view("<u2")[(offsets[run] // 2 + rank)[few]] = places[few]
    many = ~few
    np.bitwise_or.at(data, offsets[run[many]] + (places[many] >> 3), (1 << (places[many] & 7)).astype(np.uint8))
    return pa.BinaryArray.from_buffers(pa.binary(), runs, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def members(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a column of bitmaps and the places in each; the inverse of ``bitmaps``."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    few = np.flatnonzero((sizes < BITMAP) & (sizes > 0))
    counts = sizes[few] // 2
    before = np.cumsum(counts) - counts
    at = np.repeat(offsets[few] - 2 * before, counts) + 2 * np.arange(int(counts.sum()))
    rows, places = [np.repeat(few, counts)], [data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8]
    for row in np.flatnonzero(sizes == BITMAP).tolist():
        found = np.flatnonzero(np.unpackbits(data[offsets[row]:offsets[row + 1]], bitorder="little"))
        rows.append(np.full(len(found), row))
        places.append(found)
    return np.concatenate(rows), np.concatenate(places)


class Aligner:
    """Both tokenizers in one worker process."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = token_files.encoder(path_a), pieces.encoder(path_b)
        self.raw_b = self.b.raw
        self.bytes_b = np.array([len(x) for x in self.raw_b], np.int64)
        self.signs_a = [f"{i}{s}".encode() for i in range(len(self.a.bytes_of)) for s in ",|"]
        self.signs_b = [f"{i}{s}".encode() for i in range(len(self.raw_b)) for s in ",;"]

    def _given_back(self, text: str, ids: np.ndarray) -> bool:
        """Whether the bytes of B's tokens are the text behind a blank."""
        if self.b.gives_back:
            return pieces.MARK not in text
        return b"".join(map(self.raw_b.__getitem__, ids.tolist())) == (" " + text).encode()

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of texts: a table (n_a, n_b, n_groups, n_links), digests, and text, A id and B id of all links."""
        table, digests = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        found = self.b.encode(texts)
        spaced = [" " + t for t in texts]
        used = [i for i, t in enumerate(texts) if t and self._given_back(t, found[i][0])]
        none = np.zeros(0, np.int64)
        if not used:
            return table, digests, none, none, none
        a, a_counts = self.a.cache.encode([spaced[i] for i in used])
        b, b_counts = np.concatenate([found[i][0] for i in used]).astype(np.int64), np.array([len(found[i][0]) for i in used])
        a_ends, b_ends = np.cumsum(self.a.bytes_of[a]), np.cumsum(self.bytes_b[b])
        a_text, b_text = (np.repeat(np.arange(len(used)), counts) for counts in (a_counts, b_counts))
        doc_ends = a_ends[np.cumsum(a_counts) - 1]
        if not np.array_equal(doc_ends, b_ends[np.cumsum(b_counts) - 1]):
            raise RuntimeError("the tokenizers cover different bytes")
        both_a, both_b = (mine == other[np.searchsorted(other, mine)] for mine, other in ((a_ends, b_ends), (b_ends, a_ends)))
        group = np.concatenate((np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b))
        # A link is a stretch between two ends of either kind: the pair of tokens that cover it.
        stretch = np.sort(np.concatenate((a_ends, b_ends[~both_b])), kind="stable")
        at_a, at_b = np.searchsorted(a_ends, stretch), np.searchsorted(b_ends, stretch)
        link_text = a_text[at_a]
        every = np.array(used)
        for column, values in enumerate((a_text, b_text, a_text[both_a], link_text)):
            table[every, column] = np.bincount(values, minlength=len(used))
        signs = np.concatenate((2 * a.astype(np.int64) + both_a, len(self.signs_a) + 2 * b + both_b))[np.argsort(group, kind="stable")].tolist()
        names = self.signs_a + self.signs_b
        ends = np.cumsum(a_counts + b_counts).tolist()
        for i, start, end in zip(used, [0, *ends], ends, strict=False):
            digests[i] = hashlib.sha256(b"".join(map(names.__getitem__, signs[start:end]))[:-1]).hexdigest()
        return table, digests, every[link_text], a[at_a].astype(np.int64), b[at_b]


class Block:
    """Links of up to ``BLOCK_DOCS`` documents, merged into bitmaps and planes."""

    def __init__(self, number: int, width_b: int):
        self.number, self.width_b, self.docs, self.links = number, width_b, 0, 0
        self.codes: list[np.ndarray] = []
        self.extra: list[np.ndarray] = []

    def add(self, place: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        codes, times = np.unique((a * self.width_b + b) * BLOCK_DOCS + place, return_counts=True)
        self.codes.append(codes)
        self.extra.append(times - 1)
        self.links += len(codes)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.codes:
            return
        codes, extra = np.concatenate(self.codes), np.concatenate(self.extra)
        order = np.argsort(codes, kind="stable")
        codes, extra = codes[order], extra[order]
        for plane in range(int(extra.max()).bit_length() + 1):
            kept = slice(None) if plane == 0 else (extra >> (plane - 1) & 1).astype(bool)
            pair, place = np.divmod(codes[kept], BLOCK_DOCS)
            present, run = np.unique(pair, return_inverse=True)
            n = len(present)
            columns = {
                "block": pa.array(np.full(n, self.number)), "a": pa.array((present // self.width_b).astype(np.int32)),
                "b": pa.array((present % self.width_b).astype(np.int32)), "plane": pa.array(np.full(n, plane, np.int32)),
                "n_docs": pa.array(np.bincount(run, minlength=n).astype(np.int32)), "docs": bitmaps(run, place, n),
            }
            yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in FIELDS], schema=FIELDS)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def indexed(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Two kinds of rows: documents with their place in a block, and the bitmaps of pairs (``a`` is set)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        block = Block(part << 32, len(own.raw_b))
        for batch in batches:
            for piece in bytesets.slices(batch, "text"):
                for at in range(0, piece.num_rows, BLOCK_DOCS):
                    some = piece.slice(at, BLOCK_DOCS)
                    if block.docs + some.num_rows > BLOCK_DOCS or block.links >= BLOCK_LINKS:
                        yield from block.rows()
                        number += 1
                        block = Block((part << 32) + number, len(own.raw_b))
                    table, digests, text, a, b = own.align(some.column("text").fill_null("").to_pylist())
                    places = block.docs + np.arange(some.num_rows)
                    block.docs += some.num_rows
                    if len(text):
                        block.add(places[text], a, b)
                    columns = {
                        "doc_id": some.column("doc_id"), "block": pa.array(np.full(len(places), block.number)),
                        "place": pa.array(places.astype(np.int32)), "groups_sha256": pa.array(digests),
                    } | {name: pa.array(table[:, i]) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
                    yield pa.RecordBatch.from_arrays(
                        [columns.get(f.name, pa.nulls(len(places), f.type)) for f in FIELDS], schema=FIELDS)
        yield from block.rows()

    return bytesets.map_arrow(bytesets.only(docs, doc_id="bigint", text="string"), index, DDL)


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, is_best): documents of each pair in the corpus, and whether none of its ``a`` has more."""
    counts = index.where("plane = 0").groupBy("a", "b").agg(F.sum(F.col("n_docs").cast("bigint")).alias("n_docs"))
    best = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(best, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def returned(index: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, place, n_best, count_sum): what the postings of each block add to its documents."""
    postings = index.where(F.col("a").isNotNull()).select("a", "b", "block", "plane", "docs")
    scored = postings.join(counts, ["a", "b"]).select("block", "plane", "docs", "n_docs", "is_best")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, total = None, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)

        def done() -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(total)
            if len(at):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), current)), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at]),
                ], names=["block", "place", "n_best", "count_sum"])
            best[:], total[:] = 0, 0

        for batch in batches:
            blocks = np.asarray(batch.column("block"))
            edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if blocks[a] != current:
                    yield from done()
                    current = blocks[a]
                part = batch.slice(a, b - a)
                rows, places = members(part.column("docs"))
                plane = np.asarray(part.column("plane"), np.int64)
                times = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
                np.add.at(best, places, (times * np.asarray(part.column("is_best").cast(pa.int64())))[rows])
                np.add.at(total, places, (times * np.asarray(part.column("n_docs")))[rows])
        yield from done()

    by_block = scored.repartition("block").sortWithinPartitions("block")
    return bytesets.map_arrow(by_block, add_up, "block long, place int, n_best long, count_sum long")


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: token, group and link numbers, links of highest count, the sum of counts, the digest of groups."""
    index = session.cut_lineage(indexed(docs, path_a, path_b))
    found = returned(index, pair_counts(index))
    zero = F.lit(0).cast("bigint")
    return index.where(F.col("a").isNull()).join(found, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
