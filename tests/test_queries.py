"""Every registered query against its SQL counterpart."""

import re

import __spark_entry__ as entry_points
import pytest

import compare

QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


def test_all_but_model_queries_have_sql():
    assert set(ORACLE) <= set(QUERIES)
    own = {name for name in QUERIES if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own - set(ORACLE) == {"als_recommendations"}


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not re.match(r"op\d+_|pipeline$", n)))
def test_equals_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


def test_model_query_gives_three_ordered_unseen_or_seen_cards(spark, sf_dir):
    rows = QUERIES["als_recommendations"](spark, sf_dir).collect()
    by_pattern = {}
    for row in rows:
        by_pattern.setdefault(row["deck_pattern_id"], []).append(row)
    assert by_pattern
    for found in by_pattern.values():
        scores = [r["score"] for r in sorted(found, key=lambda r: r["place"])]
        assert len(scores) == 3 and scores == sorted(scores, reverse=True)


def test_pair_file_keeps_battles_with_unknown_cards(spark, sf_dir):
    rows = QUERIES["deck_pair_file_rows"](spark, sf_dir)
    battles = QUERIES["deck_pair_stats"](spark, sf_dir).selectExpr("sum(wins + losses)").first()[0]
    assert rows.selectExpr("sum(wins + losses)").first()[0] == battles
    assert rows.where("unknown_cards > 0").count() > 0
