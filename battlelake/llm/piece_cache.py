"""Ids of pieces already met, kept by a worker process as arrays sorted by the pieces' hashes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from battlelake.llm import bpe_split, bytesets

#: Pieces that a worker remembers; beyond it those met once are forgotten, which changes no result.
MAX_PIECES = 400_000

#: Seeds of the hash that a piece is looked up by and of the one that it must have as well.
KEY_SEED, CHECK_SEED = 0x51, 0x7C3


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``flat[start:start + count]`` of each entry, one after the other."""
    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


class PieceCache:
    """Turns texts into ids; ``encode_pieces`` gives flat ids and their number for pieces (bytes) not met before.

    A piece is known by two independent hashes and its length. Where only one of them agrees, it is encoded anew.
    """

    def __init__(self, classify: Callable[[str], int], encode_pieces: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.classes, self.encode_pieces = bpe_split.Classes(classify), encode_pieces
        self.flat, self.filled = np.zeros(1 << 16, np.int32), 0
        # Sorted runs of (keys, checks, starts, counts, met again); a run is merged into one before it of at most twice its size.
        self.runs: list[tuple[np.ndarray, ...]] = []

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for run_keys, run_checks, run_starts, run_counts, again in self.runs:
            at = np.minimum(np.searchsorted(run_keys, keys), len(run_keys) - 1)
            same = (run_keys[at] == keys) & (run_checks[at] == checks)
            starts[same], counts[same] = run_starts[at[same]], run_counts[at[same]]
            again[at[same]] = True
        return starts, counts

    def _add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Remember new pieces, and say where their ids are."""
        if len(self.flat) < self.filled + len(ids):
            self.flat = np.concatenate((self.flat[:self.filled], np.zeros(self.filled + 2 * len(ids), np.int32)))
        self.flat[self.filled:self.filled + len(ids)] = ids
        starts = self.filled + np.cumsum(counts) - counts
        run = (keys, checks, starts, counts, np.zeros(len(keys), bool))
        self.filled += len(ids)
        while self.runs and len(self.runs[-1][0]) <= 2 * len(run[0]):
            parts = [np.concatenate(pair) for pair in zip(self.runs.pop(), run, strict=True)]
            order = np.argsort(parts[0], kind="stable")
            run = tuple(p[order] for p in parts)
        self.runs.append(run)
        return starts

    def _forget(self) -> None:
        """Keep the pieces met again since they came, unless these are more than half of all."""
        parts = [np.concatenate(column) for column in zip(*self.runs, strict=True)]
        kept = parts[4] if parts[4].sum() <= MAX_PIECES // 2 else np.zeros(len(parts[4]), bool)
        keys, checks, starts, counts = (p[kept] for p in parts[:4])
        order = np.argsort(keys, kind="stable")
        keys, checks, starts, counts = keys[order], checks[order], starts[order], counts[order]
        ids = gathered(self.flat, starts, counts)
        self.flat, self.filled, self.runs = np.zeros(1 << 16, np.int32), 0, []
        if len(keys):
            self._add(keys, checks, ids, counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        pieces = bpe_split.split(texts, self.classes)
        data, starts_at, ends_at = np.frombuffer(pieces.data, np.uint8), pieces.bounds[:-1], pieces.bounds[1:]
        keys, checks = (bytesets.span_hashes(data, starts_at, ends_at, seed) for seed in (KEY_SEED, CHECK_SEED))
        distinct, where, which = np.unique(keys, return_index=True, return_inverse=True)
        if sum(len(r[0]) for r in self.runs) + len(distinct) > MAX_PIECES and self.runs:
            self._forget()
        starts, counts = self._find(distinct, checks[where])
        new = np.flatnonzero(starts < 0)
        if len(new):
            ids, sizes = self.encode_pieces(pieces.taken(where[new]))
            starts[new], counts[new] = self._add(distinct[new], checks[where[new]], ids, sizes), sizes
        flat, starts, counts = self.flat, starts[which], counts[which]
        other = np.flatnonzero(checks != checks[where][which])
        if len(other):
            ids, sizes = self.encode_pieces(pieces.taken(other))
            flat = np.concatenate((flat[:self.filled], ids))
            starts[other], counts[other] = self.filled + np.cumsum(sizes) - sizes, sizes
        ends = np.append(0, np.cumsum(counts))
        return gathered(flat, starts, counts), np.diff(ends[pieces.first])
