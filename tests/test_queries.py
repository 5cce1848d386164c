"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import os

import pytest

from tests.conftest import plan_of
from tidings.plans import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    from tools.compare import connect

    return connect(SF_DIR)


#: Too slow in SQL at their size; tested against brute force or single searches.
WITHOUT_SQL = {"gap_table_full", "digest_full", "frame_searches", "capture_stream", "learned_sentences"}


def test_every_other_query_has_sql():
    assert set(queries.registered()) - WITHOUT_SQL == set(oracles.all_sql())


@pytest.mark.parametrize("name", sorted(set(queries.registered()) - WITHOUT_SQL))
def test_query_matches_sql(spark, con, name):
    from tools.compare import rows_of

    df = queries.registered()[name](spark, SF_DIR)
    result = con.execute(oracles.all_sql()[name])
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == expected
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
