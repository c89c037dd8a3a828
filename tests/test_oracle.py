"""Every registered query equals its DuckDB oracle (the driver's correctness gate)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duckdb_con

from __spark_entry__ import oracle_sql, queries
from keytally.plans.queries import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, SF_SMALL, con)
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["match"], result


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["word", "cnt"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con_oracle_scale():
    from tests.conftest import SF_ORACLE
    return duckdb_con(SF_ORACLE)


@pytest.mark.parametrize("name", ["word_count", "accumulate_counts", "resume_filter", "event_time_walk", "group_totals",
                                  "latest_offsets", "running_total",
                                  "gen_user_visit_action", "starting_offsets"])
def test_key_queries_match_oracle_at_driver_scale(spark, con_oracle_scale, name):
    """The driver's correctness gate runs at sf0.01: check the headline queries there too."""
    from tests.conftest import SF_ORACLE
    result = compare(spark, name, SF_ORACLE, con_oracle_scale)
    assert result["match"], result


@pytest.mark.parametrize("name", ["latest_offsets", "progress_lookup", "starting_offsets", "group_totals"])
def test_progress_follows_the_whole_log(spark, name):
    """Positions depend on all epochs: they differ between table sizes."""
    from tests.conftest import SF_ORACLE
    rows = [sorted(map(str, QUERIES[name](spark, sf).collect())) for sf in (SF_SMALL, SF_ORACLE)]
    assert rows[0] != rows[1]
