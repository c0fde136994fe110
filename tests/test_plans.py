"""Plans: what is read, what is shuffled, and what never appears."""

import __spark_entry__ as entry_points
import pytest

from battlelake.plans import queries as Q
from battlelake.operators import canonical
from battlelake.sources import fixtures


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [n for n in Q.QUERIES if not n.startswith(("stream_", "als_", "log_", "model_", "csv_"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(entry_points.queries()[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_flagship_reads_two_columns(spark, sf_dir):
    text = plan(Q.effectiveness_matrix(spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_small_dimensions_never_shuffle_battles(spark, sf_dir):
    assert "Exchange hashpartitioning" not in plan(Q.search_documents(spark, sf_dir))
    assert "BroadcastHashJoin" in plan(Q.season_dedup(spark, sf_dir))


def test_similarity_limits_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(Q.jaccard_matches(spark, sf_dir))


def test_recent_days_prune_partitions(spark, sf_dir, tmp_path):
    flat = Q._dated(spark, sf_dir)
    flat.write.partitionBy("battle_date").parquet(str(tmp_path / "battles"))
    stored = spark.read.parquet(str(tmp_path / "battles"))
    recent = canonical.last_days(stored, 3)
    assert recent.select("battle_date").distinct().count() == 3
    assert "PartitionFilters: [isnotnull(battle_date" in plan(recent)


def test_log_fixture_has_copies(spark, sf_dir):
    battles = fixtures.battles(spark, sf_dir)
    log = fixtures.battle_log(battles)
    assert log.count() > battles.count() == canonical.canonical_battles(log).count()
