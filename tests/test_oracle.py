"""Every registered query with SQL agrees with it, row by row."""

import pytest

from oracle import connect, difference
from pricelift.checks.registry import all_checks

CHECKS = all_checks()

# rows leaving the JVM, and joins that pair everything with everything
UNWANTED = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck(small):
    con = connect(small)
    yield con
    con.close()


@pytest.mark.parametrize("key", [k for k, c in CHECKS.items() if c.sql is not None])
def test_query_matches_sql(spark, small, duck, key):
    check = CHECKS[key]
    df = check.run(spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    assert difference(df, duck, check.oracle()) is None


@pytest.mark.parametrize("key", [k for k, c in CHECKS.items() if c.sql is None])
def test_query_without_sql_has_rows(spark, small, key):
    assert CHECKS[key].run(spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"department", "profit_uplift"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
