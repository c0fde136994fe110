"""Vector codes: integer product quantisation whose nearest entries are found in a GNAT over each codebook.

A vector becomes whole numbers floor(256 * x), cut into 16 consecutive parts. Every part position has a codebook of at most 64
entries. Its tree keeps some entries of a node as split points and deals the others to the nearest split; for each
pair of a split and a child it stores the least and greatest distance between them. A query's distances to the splits
rule out a child when no entry in its ranges could be as near as the best so far; the test is strict and every
root is rounded outwards, so an equally near entry is always looked at. Distances are compared as whole numbers, the
lower index winning ties.

Each round is one pass over the vectors: tasks find entries and add up their parts, one row per (length, part, entry) is shuffled,
and the driver divides. It holds 64 vectors of each length and as many sums, whatever the number of vectors.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors of different lengths have
codebooks of their own; a length that 16 doesn't divide is cut as evenly as it can be, a part without components
has code 0; a row without a vec_id is coded but doesn't start an entry; equal vec_ids start entries in the order of
their vectors; repeated rows count each; an empty table gives no rows. Components that fit no long, and errors beyond it, are
an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from battlelake import session
from battlelake.llm import bytesets

#: Parts of a vector, entries of a codebook, rounds of refinement, and what components are multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0

#: Split points of a node, and entries that a leaf compares one by one.
SPLITS, LEAF = 8, 8

#: Rows whose parts are looked up together.
ROWS = 8192

#: Numbers below this can be squared and added up in 64 bits, in parts of up to as many components.
NARROW, WIDEST = 2**24, 2**13

Codebook = np.ndarray


def bounds(dims: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and end."""
    return [p * dims // parts for p in range(parts + 1)]


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    gap = points - entry
    return (gap * gap).sum(axis=1)


def roots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of square roots of whole numbers of any size."""
    near = np.sqrt(values.astype(np.float64))
    slack = near * 2.0**-50
    return np.maximum(near - slack, 0.0), near + slack


class Child(NamedTuple):
    low: np.ndarray
    high: np.ndarray
    node: Node


class Node(NamedTuple):
    """Entries compared directly (a leaf, or split points), and the children with their ranges of distance to each."""

    own: list[int]
    children: list[Child]


def build(book: Codebook, members: list[int] | None = None) -> Node:
    """The tree of a codebook: splits far from each other, every other entry with the nearest of them."""
    members = list(range(len(book))) if members is None else members
    if len(members) <= LEAF:
        return Node(members, [])
    points = book[members]
    splits, nearest = [0], squared(points, points[0])
    while len(splits) < SPLITS and nearest.max() > 0:
        splits.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[splits[-1]]))
    distances = np.stack([squared(points, points[s]) for s in splits])
    home = distances.argmin(axis=0)
    children = []
    for place in range(len(splits)):
        inside = [i for i in np.flatnonzero(home == place).tolist() if i not in splits]
        if inside:
            low, high = roots(distances[:, inside])
            children.append(Child(low.min(axis=1), high.max(axis=1), build(book, [members[i] for i in inside])))
    return Node([members[s] for s in splits], children)


class Search:
    """Nearest entries of many points; counts the distances it computes."""

    def __init__(self, book: Codebook):
        self.book, self.tree, self.distances = book, build(book), 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry, the lower index of equals."""
        n = len(points)
        best = np.full(n, -1, np.int64)
        reach = np.zeros(n, points.dtype)
        self._visit(self.tree, points, np.arange(n), best, reach)
        return best, reach

    def _visit(self, node: Node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, reach: np.ndarray) -> None:
        if not len(rows):
            return
        apart = np.empty((len(node.own), len(rows)), points.dtype)
        for k, entry in enumerate(node.own):
            apart[k] = squared(points[rows], self.book[entry])
            nearer = (best[rows] < 0) | (apart[k] < reach[rows]) | ((apart[k] == reach[rows]) & (entry < best[rows]))
            better = rows[nearer]
            best[better], reach[better] = entry, apart[k][nearer]
        self.distances += apart.size
        if not node.children:
            return
        low, high = roots(apart)
        for child in node.children:
            limit = roots(reach[rows])[1]
            # Nothing in the child is nearer than this to the point.
            least = np.maximum(child.low[:, None] - high, low - child.high[:, None]).max(axis=0)
            self._visit(child.node, points, rows[least * (1 - 2.0**-50) <= limit], best, reach)


def whole(flat: np.ndarray) -> np.ndarray:
    """floor(256 * x) of doubles, in 64 bits where squares fit, else as unbounded numbers."""
    scaled = np.floor(flat * SCALE)
    size = float(np.abs(scaled).max(initial=0))
    if size >= 2.0**62:
        raise ValueError("a component fits no long")
    return scaled.astype(np.int64) if size < NARROW else np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def taking_part(vectors: DataFrame, vector: str) -> DataFrame:
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))


def _groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of one length at a time, some at once: length, their places in the batch, their whole numbers."""
    vectors = batch.column(column)
    lengths = np.asarray(vectors.value_lengths(), np.int64)
    flat, starts = np.asarray(vectors.flatten(), np.float64), np.cumsum(lengths) - lengths
    for dims in np.unique(lengths).tolist():
        every = np.flatnonzero(lengths == dims)
        for at in range(0, len(every), ROWS):
            rows = every[at:at + ROWS]
            yield dims, rows, whole(flat[starts[rows][:, None] + np.arange(dims)])


def _matching(points: np.ndarray, book: Codebook) -> tuple[np.ndarray, Codebook]:
    """Both in 64 bits if both are narrow, else both as unbounded numbers."""
    if points.dtype != object and points.shape[1] <= WIDEST and max((abs(int(x)) for x in book.ravel()), default=0) < NARROW:
        return points, book.astype(np.int64)
    return points.astype(object), book


class Coder:
    """Searches over given codebooks, by length, part and kind of numbers."""

    def __init__(self, books: dict[int, list[Codebook]]):
        self.books, self.searches = books, {}

    def assigned(self, dims: int, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: its number, the parts of all points, index and squared distance of their entries."""
        edges = bounds(dims)
        for part, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            own, book = _matching(points[:, a:b], self.books[dims][part])
            key = dims, part, own.dtype == object
            if key not in self.searches:
                self.searches[key] = Search(book)
            yield part, own, *self.searches[key].nearest(own)


def first_books(rows: DataFrame) -> dict[int, list[Codebook]]:
    """Codebooks of the least vec_ids of each length."""
    place = F.row_number().over(Window.partitionBy("dims").orderBy("vec_id", "vector"))
    first = (rows.where(F.col("vec_id").isNotNull()).withColumn("dims", F.size("vector"))
             .withColumn("place", place).where(F.col("place") <= ENTRIES).orderBy("dims", "place"))
    found: dict[int, list[np.ndarray]] = {}
    for row in first.select("dims", "vector").collect():
        found.setdefault(row["dims"], []).append(whole(np.array(row["vector"], np.float64)).astype(object))
    books = {}
    for dims, vectors in found.items():
        table, edges = np.array(vectors, object).reshape(len(vectors), dims), bounds(dims)
        books[dims] = [table[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return books


def refined(rows: DataFrame, books: dict[int, list[Codebook]]) -> dict[int, list[Codebook]]:
    """Each entry that some part is nearest to becomes the floor of those parts' mean."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, totals = Coder(books), {}
        for batch in batches:
            for dims, _, points in _groups(batch, "vector"):
                if dims not in books:
                    continue
                for part, own, entry, _ in coder.assigned(dims, points):
                    order = np.argsort(entry, kind="stable")
                    present, first, counts = np.unique(entry[order], return_index=True, return_counts=True)
                    added = np.add.reduceat(own[order], first, axis=0)
                    for e, n, total in zip(present.tolist(), counts.tolist(), added, strict=True):
                        known = totals.setdefault((dims, part, e), [0, [0] * own.shape[1]])
                        known[0] += n
                        known[1] = [x + int(y) for x, y in zip(known[1], total, strict=True)]
        keys = list(totals)
        # Sums of any size are sent in two halves that add up on their own.
        yield pa.RecordBatch.from_arrays([
            *(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)),
            pa.array([totals[k][0] for k in keys], pa.int64()),
            pa.array([[x >> 32 for x in totals[k][1]] for k in keys], pa.list_(pa.int64())),
            pa.array([[x & 0xFFFFFFFF for x in totals[k][1]] for k in keys], pa.list_(pa.int64())),
        ], names=["dims", "part", "entry", "n", "upper", "lower"])

    found = bytesets.map_arrow(
        rows.select("vector"), sums, "dims int, part int, entry int, n long, upper array<long>, lower array<long>")
    wide = found.select("dims", "part", "entry", "n", F.posexplode_outer(F.arrays_zip("upper", "lower")).alias("place", "half"))
    sums_by_place = wide.groupBy("dims", "part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum("half.upper").alias("upper"), F.sum("half.lower").alias("lower"))
    new = {dims: [book.copy() for book in parts] for dims, parts in books.items()}
    for r in sums_by_place.collect():
        if r["place"] is not None:
            new[r["dims"]][r["part"]][r["entry"], r["place"]] = ((r["upper"] << 32) + r["lower"]) // r["n"]
    return new


def digest(parts: list[Codebook]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in parts for x in book.ravel()).encode()).hexdigest()


def trained(rows: DataFrame, rounds: int = ROUNDS) -> dict[int, list[Codebook]]:
    books = first_books(rows)
    for _ in range(rounds if books else 0):
        books = refined(rows, books)
    return books


def coded(rows: DataFrame, books: dict[int, list[Codebook]]) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of the rows (vec_id, vector, label)."""
    digests = {dims: digest(parts) for dims, parts in books.items()}
    none = digest([])
    label = rows.schema["label"].dataType.simpleString()

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for batch in batches:
            for dims, places, points in _groups(batch, "vector"):
                code = np.zeros((len(places), PARTS), np.uint8)
                error = np.zeros(len(places), object)
                if dims in books:
                    for part, _, entry, distance in coder.assigned(dims, points):
                        code[:, part] = entry
                        error += distance.astype(object)
                if max(error, default=0) >= 2**63:
                    raise ValueError("an error fits no long")
                text = [row.tobytes().hex() for row in code]
                taken = pa.array(places)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(taken), batch.column("label").take(taken), pa.array(text), pa.array(error.tolist(), pa.int64()),
                    pa.array([digests.get(dims, none)] * len(places)),
                ], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return bytesets.map_arrow(rows, codes, f"vec_id long, label {label}, code string, error long, codebooks_sha256 string")


def decoded(codes: DataFrame, books: dict[int, list[Codebook]], dims: int, code: str = "code") -> DataFrame:
    """All columns, and ``approximation`` (or a free name): the entries that a code stands for, as components."""
    parts = [[[int(x) / SCALE for x in entry] for entry in book] for book in books[dims]]
    entries = F.array(*[F.array(*[F.array(*map(F.lit, entry)).cast("array<double>") for entry in book]) for book in parts])
    place = F.sequence(F.lit(0), F.lit(PARTS - 1))
    number = lambda p: F.conv(F.substring(F.col(code), p * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return codes.withColumn(bytesets.free_name(codes, "approximation"),
                            F.flatten(F.transform(place, lambda p: F.get(F.get(entries, p), number(p)))))


def report(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part."""
    rows = taking_part(vectors, f"`{vector}`").select(
        F.col(f"`{key}`").try_cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.col(f"`{label}`").alias("label"))
    # Stored, since the sums by label and the rows both read it; labels may be few and hot, so they are summed before they meet.
    found = session.cut_lineage(coded(rows, trained(rows)))
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    return found.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
