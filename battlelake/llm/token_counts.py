"""Unigram token counts without building the tokens.

A text becomes units that start with the word mark (a blank is a word mark, and one is set before a text that has
none). In each unit an Aho-Corasick automaton enumerates the vocabulary's matches by their ends, longest first;
the best score up to each position is carried together with the number of pieces on that path. A later start must be
strictly better, so equal scores go to the longer last piece, as in the tokenizer. A character that no
single-character piece covers costs the lowest score less ten and counts one piece for each of its bytes.

Units are counted once per worker and remembered up to ``MAX_UNITS``. Rows are independent: nothing is shuffled.

Defined cases: a null or empty text has no pieces; other columns are left out of ``report`` and kept by ``counted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructType

from battlelake.llm import bytesets

#: The sign that stands for a blank, and what an unknown character costs below the lowest score. Fixed values.
MARK, UNKNOWN_PENALTY = "▁", 10.0

MAX_UNITS = 500_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The pieces of a model file with their scores; control and byte pieces match no text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class Counter:
    """Counts for one vocabulary, in one process."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def unit(self, unit: str) -> int:
        n = len(unit)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(unit):
            matches[end].append(match)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for end, ending in enumerate(matches):
            top, pieces, single = None, 0, False
            for length, score in ending:
                start = end + 1 - length
                total = best[start] + score
                if top is None or total > top:
                    top, pieces = total, count[start] + 1
                single = single or length == 1
            if not single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, pieces = total, count[end] + len(unit[end].encode("utf-8", "surrogatepass"))
            best[end + 1], count[end + 1] = top, pieces
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        units = marked.split(MARK)
        if marked.startswith(MARK):
            units = units[1:]
        total, known = 0, self.known
        for unit in units:
            size = known.get(unit)
            if size is None:
                size = self.unit(MARK + unit)
                if len(known) >= MAX_UNITS:
                    known.clear()
                if len(unit) <= 64:
                    known[unit] = size
            total += size
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(read_pieces(path))


def counted(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns and ``n_tokens`` (or a free name)."""
    schema = StructType([*docs.schema.fields]).add(bytesets.free_name(docs, "n_tokens"), LongType())
    at = docs.columns.index(text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            sizes = np.array([own.text(t or "") for t in batch.column(at).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=schema.names)

    return bytesets.map_arrow(docs, count, schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id and n_tokens."""
    return counted(bytesets.only(docs, doc_id="bigint", text="string"), path).select("doc_id", "n_tokens")
