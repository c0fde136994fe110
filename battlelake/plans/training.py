"""Pattern mapping and effectiveness matrix from battles, in one go or batch after batch."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from battlelake.operators.mapping import extend_mapping, new_mapping, with_pattern_ids
from battlelake.operators.matrix import accumulate_legacy, merge_moments, pattern_moments, scored
from battlelake.operators.performance import player_results
from battlelake.session import cut_lineage


class State(NamedTuple):
    """What is kept between batches, and the matrix of the last batch alone.

    ``parts`` are stored moments by level; ``moments`` merges them when it is read.
    """

    mapping: DataFrame
    moments: DataFrame
    last_moments: DataFrame
    parts: tuple[tuple[int, DataFrame], ...] = ()

    def matrix(self) -> DataFrame:
        return scored(with_pattern_ids(self.moments, self.mapping), "deck_pattern_id")

    def last_matrix(self) -> DataFrame:
        return scored(with_pattern_ids(self.last_moments, self.mapping), "deck_pattern_id")


#: Parts of one level that are merged into one of the next.
FANOUT = 4


def batch_moments(battles: DataFrame, legacy: bool = False) -> DataFrame:
    return pattern_moments(player_results(battles, legacy))


def start(battles: DataFrame) -> State:
    moments = cut_lineage(batch_moments(battles))
    return State(new_mapping(moments), moments, moments, ((0, moments),))


def _added(parts: tuple[tuple[int, DataFrame], ...], fresh: DataFrame) -> tuple[tuple[int, DataFrame], ...]:
    """The parts with one more; a full level becomes one part of the next."""
    parts, level = (*parts, (0, fresh)), 0
    while len(full := [df for own, df in parts if own == level]) >= FANOUT:
        parts = (*(p for p in parts if p[0] != level), (level + 1, cut_lineage(merge_moments(*full))))
        level += 1
    return parts


def advance(state: State | None, battles: DataFrame) -> State:
    """Apply one batch. Ids of known patterns never change; only what the batch adds is stored."""
    if state is None:
        return start(battles)
    fresh = cut_lineage(batch_moments(battles))
    parts = _added(state.parts or ((0, state.moments),), fresh)
    mapping = extend_mapping(state.mapping, fresh)
    return State(mapping, merge_moments(*(df for _, df in parts)), fresh, parts)


def run_batches(batches: list[DataFrame]) -> State:
    state = None
    for battles in batches:
        state = advance(state, battles)
    return state


def accumulate_batches_legacy(batches: list[DataFrame]) -> DataFrame:
    """The earlier accumulation, where each new batch weighs as much as all history."""
    total = None
    for battles in batches:
        matrix = scored(batch_moments(battles))
        total = matrix if total is None else accumulate_legacy(total, matrix)
        total = cut_lineage(total)
    return total
