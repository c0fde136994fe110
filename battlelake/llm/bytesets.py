"""Helpers that the operators share inside tasks: texts as byte arrays, words and windows as 64-bit hashes.

Everything here works on one Arrow batch; Spark partitions the rows and moves them between tasks. Texts are
looked at whole. A null text is an empty text.
"""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a task turns into arrays at a time; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The first 0 to 8 bytes of eight.
_HEADS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: Longer spans, in bytes, are rare: no natural word is.
LONG_SPAN = 128


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have, also not in another case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns cast to the given types (null where that fails); other columns go, so their names cannot clash."""
    return df.select(*[F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in columns.items()])


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the result."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each span ``data[start:end]``; equal spans have equal hashes wherever they stand.

    Eight bytes of all spans are taken in at a time, and every step mixes what was before with the next eight, so no algebra of
    the whole word can make two of them meet. Spans over ``LONG_SPAN`` bytes are digested one by one.
    """
    sizes = ends - starts
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mixed(sizes.astype(np.uint64) * _ODD + np.uint64(seed))
    live = np.flatnonzero((sizes > 0) & (sizes <= LONG_SPAN))
    done = 0
    while len(live):
        chunk = eights[starts[live] + done] & _HEADS[np.minimum(sizes[live] - done, 8)]
        out[live] = mixed((out[live] ^ chunk) + _ODD)
        done += 8
        live = live[sizes[live] > done]
    for i in np.flatnonzero(sizes > LONG_SPAN).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]] if len(offsets) else whole, offsets - (offsets[0] if len(offsets) else 0)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``SLICE_BYTES`` of text, or one longer row."""
    if not batch.num_rows:
        return
    _, offsets = texts_of(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that ``inside`` (256 booleans) allows, and the row of each."""
    is_word = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    before = np.concatenate(([False], is_word[:-1])) & ~first[:-1] if len(data) else is_word
    after = np.concatenate((is_word[1:], [False])) & ~first[1:] if len(data) else is_word
    starts, ends = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def window_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each ``width`` consecutive words; empty if there are fewer."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = out * _ODD + word_hashes[k:k + n]
    return mixed(out)


#: Bytes that Spark hands to a task in one Arrow batch, unless the session says otherwise: both processes hold a batch of texts
#: at once, and the operators cut it into slices anyway. Short rows still come 10,000 at a time.
BATCH_BYTES, DEFAULT_BATCH_BYTES = 2 << 20, "67108864b"

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; a cluster that has it installed loses nothing.

    A session whose Arrow batches have Spark's own size gets smaller ones.
    """
    context = spark.sparkContext
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) == DEFAULT_BATCH_BYTES:
        spark.conf.set(size, BATCH_BYTES)
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as target:
            for source in sorted(package.rglob("*.py")):
                target.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped[context.applicationId] = str(archive)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks, which give back the memory that they no longer use."""
    ship(df.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return freed memory to the system: workers live on, and the next stage's share a machine with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
