"""Benchmark decontamination: a broadcast hash set of normalised benchmark windows against every document.

Words are the maximal runs of digits, letters and non-ASCII characters after A-Z is lower-cased. A benchmark item
gives its windows of ``width`` consecutive words, or all its words as one window if it has fewer. Documents hash
their windows in whole arrays, look them up in the set, and compare the words of each hit.

The set is sent out in parts of about ``MAX_WINDOWS`` (window, item) rows and ``MAX_BYTES`` of words at most, held as Arrow
columns, so what is broadcast has a bound however large the benchmark is. Where there are several parts, each is one
narrow pass over the numbered texts that stores only what it hit; that is joined to the documents once, at the end.

Defined cases: a null or wordless text has no windows and is never hit; an item without words matches nothing; a
null item id counts as the empty string; repeated items count once; repeated documents are judged one by one;
clashing names of other columns are kept and the result's columns renamed (see ``scan``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from battlelake import session
from battlelake.llm import bytesets

WIDTH = 10

#: Rows of one broadcast part and bytes of their window texts: some 30 bytes a row beside the texts, 80 MB in all at most.
MAX_WINDOWS, MAX_BYTES = 500_000, 64 << 20

INSIDE = np.zeros(256, bool)
INSIDE[0x30:0x3A] = INSIDE[0x61:0x7B] = INSIDE[0x80:] = True


def _words(data: np.ndarray, offsets: np.ndarray):
    lower = bytesets.LOWER[data]
    starts, ends, rows = bytesets.words(lower, offsets, INSIDE)
    return lower, starts, ends, rows, bytesets.span_hashes(lower, starts, ends)


def _joined(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(lower[a:b].tobytes() for a, b in zip(starts, ends, strict=True))


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (hash, words, window, item_id) of all benchmark items; ``words`` is the window's width."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                lower, starts, ends, rows, hashes = _words(*bytesets.texts_of(part.column("text")))
                items = part.column("item_id").to_pylist()
                out: dict[str, list] = {"hash": [], "words": [], "window": [], "item_id": []}
                bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
                for item, a, b in zip(items, bounds[:-1], bounds[1:], strict=True):
                    size = min(width, b - a)
                    for k, code in enumerate(bytesets.window_hashes(hashes[a:b], size) if size else ()):
                        out["hash"].append(int(code.view(np.int64)))
                        out["words"].append(size)
                        out["window"].append(_joined(lower, starts[a + k:a + k + size], ends[a + k:a + k + size]))
                        out["item_id"].append(item or "")
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [("hash", pa.int64()), ("words", pa.int32()), ("window", pa.binary()), ("item_id", pa.string())]))

    items = bytesets.only(benchmark, item_id="string", text="string")
    return bytesets.map_arrow(items, windows, "hash long, words int, window binary, item_id string").distinct()


@dataclass
class Windows:
    """The windows of one width, by their hashes in ascending order, and a filter on the hashes' first bits."""

    codes: np.ndarray
    window: pa.Array
    item_id: pa.Array
    filter: np.ndarray

    BITS = 20

    @classmethod
    def of(cls, rows: pa.Table) -> Windows:
        codes = rows["hash"].to_numpy().view(np.uint64)
        order = np.argsort(codes, kind="stable")
        rows = rows.take(order).combine_chunks()
        known = np.zeros(1 << cls.BITS, bool)
        known[(codes >> np.uint64(64 - cls.BITS)).astype(np.int64)] = True
        return cls(codes[order], rows["window"].combine_chunks(), rows["item_id"].combine_chunks(), known)

    def found(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the codes that are in the set, and the first row of each."""
        maybe = np.flatnonzero(self.filter[(codes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.codes, codes[maybe]), len(self.codes) - 1)
        hit = self.codes[at] == codes[maybe]
        return maybe[hit], at[hit]

    def items(self, first: int, window: bytes) -> list[str]:
        """The items that have this window; ``first`` is the first row of its hash."""
        out, code = [], self.codes[first]
        for row in range(first, len(self.codes)):
            if self.codes[row] != code:
                break
            if self.window[row].as_py() == window:
                out.append(self.item_id[row].as_py())
        return out


def window_set(rows: pa.Table) -> dict[int, Windows]:
    """One broadcast part: the windows by their width."""
    words = rows["words"].to_numpy()
    return {int(width): Windows.of(rows.filter(pa.array(words == width))) for width in np.unique(words)}


def _hits(lower, starts, ends, rows, hashes, windows: dict[int, Windows]):
    """Whether each word is inside a window of the set, and the items found in each row."""
    depth = np.zeros(len(starts) + 1, np.int32)
    items: dict[int, set[str]] = {}
    for width, known in windows.items():
        for k, first in zip(*known.found(bytesets.window_hashes(hashes, width)), strict=True):
            if rows[k] != rows[k + width - 1]:
                continue
            if names := known.items(first, _joined(lower, starts[k:k + width], ends[k:k + width])):
                depth[k] += 1
                depth[k + width] -= 1
                items.setdefault(int(rows[k]), set()).update(names)
    return np.cumsum(depth[:-1]) > 0, items


def _merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


RESULT = {
    "n_words": pa.int64(), "n_hit": pa.int64(), "hit_items": pa.list_(pa.string()),
    "hit_words": pa.list_(pa.list_(pa.int64())), "clean_text": pa.string(),
}
RESULT_DDL = {
    "n_words": "long", "n_hit": "long", "hit_items": "array<string>", "hit_words": "array<array<bigint>>", "clean_text": "string",
}


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WIDTH,
         max_windows: int = MAX_WINDOWS) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` and, per document: its number of words, of words inside occurring windows, the sorted
    items these belong to, the word ranges hit (start, end), and the text without them. Also returns the names that
    these columns have in the result, since ``docs`` may have columns of the same names."""
    spark = docs.sparkSession
    names = {}
    for stem in RESULT:
        names[stem] = bytesets.free_name(docs, stem)
    windows = session.cut_lineage(benchmark_windows(benchmark, width))
    size = windows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length("window")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-size["rows"] // max_windows), -(-size["bytes"] // MAX_BYTES))

    def part_of(part: int):
        rows = windows.where(F.pmod(F.xxhash64("hash", "item_id"), F.lit(parts)) == part)
        return spark.sparkContext.broadcast(window_set(rows.toArrow()))

    if parts == 1:
        return _pass(docs, part_of(0), text, names, first=True), names
    number = bytesets.free_name(docs, "row_number")
    numbered = session.cut_lineage(docs.withColumn(number, F.monotonically_increasing_id()))
    hits = []
    for part in range(parts):
        known = part_of(part)
        found = _pass(numbered.select(F.col(f"`{number}`").alias("row"), F.col(f"`{text}`").alias("text")), known, "text", {k: k for k in RESULT}, first=True)
        hits.append(session.cut_lineage(found.where(F.size("hit_items") > 0).select("row", "hit_items", "hit_words")))
        known.unpersist()
    every = hits[0]
    for other in hits[1:]:
        every = every.unionByName(other)
    every = every.groupBy(F.col("row").alias(number)).agg(
        F.flatten(F.collect_list("hit_items")).alias(names["hit_items"]), F.flatten(F.collect_list("hit_words")).alias(names["hit_words"]))
    added = [F.col(names[k]) if k in ("hit_items", "hit_words") else F.lit(None).cast(v).alias(names[k]) for k, v in RESULT_DDL.items()]
    joined = numbered.join(every, number, "left").select(*[F.col(f"`{c}`") for c in docs.columns], *added)
    return _pass(joined, spark.sparkContext.broadcast({}), text, names, first=False), names


def _pass(docs: DataFrame, known, text: str, names: dict[str, str], first: bool) -> DataFrame:
    """Adds the result columns; or fills them in around the hits that they hold already."""
    added = StructType.fromDDL(", ".join(f"`{names[k]}` {v}" for k, v in RESULT_DDL.items()))
    kept = [f for f in docs.schema.fields if f.name not in names.values()]
    schema = StructType([*kept, *added.fields])
    position = next(i for i, f in enumerate(docs.schema.fields) if f.name == text)
    width_before = len(kept)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = known.value
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])
            for part in bytesets.slices(batch, str(position)):
                data, offsets = bytesets.texts_of(part.column(position))
                lower, starts, ends, rows, hashes = _words(data, offsets)
                hit, items = _hits(lower, starts, ends, rows, hashes, windows)
                n_words = np.bincount(rows, minlength=part.num_rows)
                first_word = np.concatenate(([0], np.cumsum(n_words)))
                spans: list[list[tuple[int, int]]] = [[] for _ in range(part.num_rows)]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    # A run of hit words may go on into the next text.
                    while a < b:
                        row = int(rows[a])
                        to = min(b, first_word[row + 1])
                        spans[row].append((int(a - first_word[row]), int(to - first_word[row])))
                        a = to
                names_found = [items.get(r, set()) for r in range(part.num_rows)]
                if not first:
                    earlier = {k: part.column(width_before + i).to_pylist() for i, k in enumerate(RESULT)}
                    names_found = [a | set(b or ()) for a, b in zip(names_found, earlier["hit_items"], strict=True)]
                    spans = [_merge_spans(a + [tuple(x) for x in b or ()]) for a, b in zip(spans, earlier["hit_words"], strict=True)]
                column = part.column(position)
                clean = column
                touched = [r for r, s in enumerate(spans) if s]
                if touched:
                    texts = column.to_pylist()
                    for r in touched:
                        own, pieces, at = data[offsets[r]:offsets[r + 1]], [], 0
                        for a, b in spans[r]:
                            begin, end = (int(starts[first_word[r] + a] - offsets[r]), int(ends[first_word[r] + b - 1] - offsets[r]))
                            pieces.append(own[at:begin].tobytes())
                            at = end
                        texts[r] = b"".join([*pieces, own[at:].tobytes()]).decode("utf-8", "replace")
                    clean = pa.array(texts, column.type)
                new = [
                    pa.array(n_words, pa.int64()),
                    pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                    pa.array([sorted(s) for s in names_found], pa.list_(pa.string())),
                    pa.array([[list(x) for x in s] for s in spans], RESULT["hit_words"]),
                    clean,
                ]
                columns = [*part.columns[:width_before], *new]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return bytesets.map_arrow(docs, scanned, schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, min_share: float = 0.0, **options) -> DataFrame:
    """The documents of which at most ``min_share`` of the words are inside benchmark windows."""
    found, names = scan(docs, benchmark, **options)
    bad = (F.col(names["n_hit"]) > 0) & (F.col(names["n_hit"]) > F.lit(min_share) * F.col(names["n_words"]))
    return found.where(~bad).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents; the words inside benchmark windows are cut out of ``text``, with what stands between them."""
    found, names = scan(docs, benchmark, text, **options)
    return found.select(*[F.col(f"`{names['clean_text']}`").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, words, hit words, items found and a digest of their sorted ids."""
    found, names = scan(bytesets.only(docs, doc_id="bigint", text="string"), benchmark)
    items = F.col(names["hit_items"])
    return found.select(
        "doc_id", F.col(names["n_words"]).alias("n_words"), F.col(names["n_hit"]).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(names["n_hit"]) > 0).alias("contaminated"),
    )

