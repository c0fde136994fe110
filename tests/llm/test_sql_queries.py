"""The operators that SQL can express, against that SQL."""

import compare
import pytest

from battlelake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
