"""Exact top-k inner products over vector-approximation files.

Vectors are packed into blocks: exact components beside a file of one-byte cells per dimension. A block's cells have
the same width in a dimension, so a query's score over a cell lies within a fixed distance of the score of the cell's
middle: one product of the query with the middles bounds all scores of the block. The exact vectors are then read in
order of their upper bounds, a chunk at a time, until the k-th exact score is above every bound left. A block gives at
most k rows for each query, and a window keeps the k best of all blocks.

Queries are packed into blocks too. Each pair of a query block and a vector block is one row, dealt out by both
numbers, so no task holds more than one block of each.

Defined cases: a vector that is null, or holds a null or a non-finite component, takes no part; a component
too large to be scaled, and a score among the best that fits no long, are errors; vectors of
different lengths are not comparable, and each query meets those of its own length; equal scores go to the smaller
vec_id; rows of one vec_id as the query's are not its candidates, and other repeated rows count each; equal
query rows are asked once; a row with a null vec_id takes no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from battlelake import session
from battlelake.llm import bytesets

#: Vectors of one block, and queries of one block.
BLOCK_ROWS, QUERY_ROWS = 4096, 1024

#: Cells of a dimension, numbered in a byte.
CELLS = 256

#: Exact vectors read at a time for one group of queries.
READ_ROWS = 64

#: Larger numbers are whole as doubles. Larger scores are beyond doubles.
WHOLE, LARGEST = 2.0**52, 2**1023


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(key, vector of floor(scale * x)) of the rows that take part."""
    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return (F.when(F.abs(scaled) < WHOLE, F.floor(scaled).cast("double")).when(F.abs(scaled) < float("inf"), scaled)
                .otherwise(F.raise_error(F.lit("a component is too large to be scaled")).cast("double")))

    valid = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    # Vectors that take no part are not scaled, in whatever order the plan has the filter.
    numbers = F.when(valid, F.transform(F.col(f"`{vector}`"), whole))
    return rows.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & valid).select(
        F.col(f"`{key}`").cast("bigint").alias("key"), numbers.alias("vector"))


def _packed(rows: DataFrame, size: int, cells: bool) -> DataFrame:
    """Blocks (block, dims, n, keys, exact[, cells, low, width]) of at most ``size`` vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dims: int, keys: np.ndarray, exact: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            row = [(part << 32) + number, dims, len(keys), keys.astype("<i8").tobytes(), exact.astype("<f8").tobytes()]
            number += 1
            low = exact.min(axis=0) if dims else np.zeros(0)
            width = np.maximum((exact.max(axis=0) - low) / CELLS, 1e-9) if dims else low
            row += [
                np.minimum((exact - low) / width, CELLS - 1).astype(np.uint8).tobytes() if cells else b"",
                low.tobytes(), width.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, FIELDS, strict=True)], schema=FIELDS)

        for batch in batches:
            lengths = np.asarray(batch.column("vector").value_lengths())
            flat, keys = np.asarray(batch.column("vector").flatten()), np.asarray(batch.column("key"))
            starts = np.cumsum(lengths) - lengths
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                held.setdefault(int(dims), []).append((keys[at], flat[starts[at][:, None] + np.arange(dims)]))
                while sum(len(k) for k, _ in held[int(dims)]) >= size:
                    keys_all, exact_all = (np.concatenate(x) for x in zip(*held[int(dims)], strict=True))
                    held[int(dims)] = [(keys_all[size:], exact_all[size:])]
                    yield block(int(dims), keys_all[:size], exact_all[:size])
        for dims, parts in held.items():
            keys_all, exact_all = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(keys_all):
                yield block(dims, keys_all, exact_all)

    return bytesets.map_arrow(rows, pack, "block long, dims int, n int, keys binary, exact binary, cells binary, low binary, width binary")


FIELDS = pa.schema([
    ("block", pa.int64()), ("dims", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("exact", pa.binary()),
    ("cells", pa.binary()), ("low", pa.binary()), ("width", pa.binary())])


def block_top(queries: np.ndarray, query_keys: np.ndarray, keys: np.ndarray, exact: np.ndarray, cells: np.ndarray,
              low: np.ndarray, width: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its position, and keys and scores of the block's k best candidates."""
    middles = low + (cells + 0.5) * width
    with np.errstate(over="ignore", invalid="ignore"):
        approximate = queries @ middles.T
        # Half a cell in each dimension, and what the sums may have been rounded by, also where large terms cancel.
        reach = np.abs(queries) @ (width / 2 + (np.abs(low) + CELLS * width) * ((exact.shape[1] + 8) * 2.0**-50))
        upper = approximate + reach[:, None]
        upper += np.abs(upper) * 1e-9 + 1e-6
    # A bound beyond doubles says nothing; only what was read is -inf.
    upper = np.nan_to_num(upper, copy=False, nan=np.inf, posinf=np.inf, neginf=-np.finfo(float).max)
    upper[query_keys[:, None] == keys[None, :]] = -np.inf
    small = float(np.abs(queries).max(initial=0)) * float(np.abs(exact).max(initial=0)) * max(1, exact.shape[1]) < 2.0**53
    for q in range(len(queries)):
        bounds = upper[q]
        best_keys, best_scores = np.zeros(0, np.int64), np.zeros(0, np.float64 if small else object)
        at, n = 0, len(bounds)
        size = min(n, READ_ROWS)
        order = np.argpartition(-bounds, size - 1)[:size] if size < n else np.arange(n)
        read = order[bounds[order] > -np.inf]
        while True:
            scores = exact[read] @ queries[q] if small else np.array([sum(int(a) * int(b) for a, b in zip(x, queries[q], strict=True)) for x in exact[read]], object)
            best_keys, best_scores = np.concatenate((best_keys, keys[read])), np.concatenate((best_scores, scores))
            chosen = np.lexsort((best_keys, -best_scores))[:k]
            best_keys, best_scores = best_keys[chosen], best_scores[chosen]
            bounds[read] = -np.inf
            # The next in order of their bounds, as long as one could still be among the k best or equal the last.
            least = _as_double(best_scores[-1]) if len(best_scores) == k else -np.inf
            open_ = np.flatnonzero((bounds > -np.inf) & (bounds >= least))
            if not len(open_):
                break
            at += 1
            size = min(len(open_), READ_ROWS << min(at, 6))
            read = open_[np.argpartition(-bounds[open_], size - 1)[:size]]
        yield q, best_keys, best_scores


def _as_double(score) -> float:
    """The score, or an infinity where it is beyond doubles."""
    return float(score) if -LARGEST < score < LARGEST else math.copysign(math.inf, score > 0 or -1)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` selects, its k best rows of another key."""
    files = session.cut_lineage(_packed(whole_vectors(vectors, key, vector, scale), BLOCK_ROWS, cells=True))
    asked = session.cut_lineage(_packed(whole_vectors(vectors.where(queries), key, vector, scale).distinct(), QUERY_ROWS, cells=False))
    # Pairs of block numbers of one vector length; the blocks follow by their numbers.
    pairs = files.select("block", "dims").join(asked.select(F.col("block").alias("asked"), "dims"), "dims")
    pairs = pairs.repartition("block", "asked")
    wide = pairs.join(files.drop("dims", "n"), "block").join(
        asked.select(F.col("block").alias("asked"), F.col("keys").alias("asked_keys"), F.col("exact").alias("asked_exact")), "asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dims = r["dims"]
                keys, own = np.frombuffer(r["keys"], "<i8"), np.frombuffer(r["asked_keys"], "<i8")
                exact = np.frombuffer(r["exact"], "<f8").reshape(len(keys), dims)
                found = list(block_top(
                    np.frombuffer(r["asked_exact"], "<f8").reshape(len(own), dims), own, keys, exact,
                    np.frombuffer(r["cells"], np.uint8).reshape(len(keys), dims),
                    np.frombuffer(r["low"], "<f8"), np.frombuffer(r["width"], "<f8"), k))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.full(len(x), own[q]) for q, x, _ in found]), pa.int64()),
                    pa.array(np.concatenate([x for _, x, _ in found]), pa.int64()),
                    pa.array([min(max(int(s), -2**63), 2**63 - 1) for _, _, x in found for s in x], pa.int64()),
                    pa.array([(int(s) >= 2**63) - (int(s) < -2**63) for _, _, x in found for s in x], pa.int32()),
                ], names=["query_id", "vec_id", "score", "beyond"])

    best = bytesets.map_arrow(wide, search, "query_id long, vec_id long, score long, beyond int")
    order = Window.partitionBy("query_id").orderBy(F.col("beyond").desc(), F.col("score").desc(), "vec_id")
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score fits no long")).cast("long"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
