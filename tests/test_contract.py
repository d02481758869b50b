import pytest

import __spark_entry__ as E
from tablelearn.plans.catalog import QUERIES
from conftest import SF001
from oracle_compare import compare, duck


OWN = set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) == {"n_train", "n_test", "accuracy_pct", "precision_pct"}


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(OWN & set(E.oracle_sql())))
def test_query_matches_duckdb(spark, con, name):
    problems = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(OWN - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF001).count() > 0


FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(OWN))
def test_plan_has_no_cross_join_or_python_udf(spark, name):
    from conftest import SF0001
    df = E.queries()[name](spark, SF0001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan]


@pytest.mark.parametrize("what", [
    "SELECT count(*) FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 3",                  # incomplete rows
    "SELECT count(*) FROM orders WHERE o_orderkey % 17 <= 2",                                   # damaged hand lines
    "SELECT count(*) FROM lineitem WHERE l_orderkey % 13 <= 2",                                 # damaged records
    "{is_pure} HAVING is_pure = 1", "{is_pure} HAVING is_pure = 0",
    "{hand_flush_bonus} HAVING flush_bonus = 25", "{hand_flush_bonus} HAVING flush_bonus = 0",
    "{id3_build_deep} HAVING is_pure = 1 AND depth < 7", "{id3_build} HAVING depth = 6",
    "{best_attribute} HAVING gain > 0",
])
def test_the_data_reach_the_branch(con, what):
    sql = E.oracle_sql()
    if what.startswith("{"):
        name, condition = what[1:].split("} HAVING ")
        what = f"SELECT count(*) FROM ({sql[name]}) WHERE {condition}"
    assert con.execute(what).fetchone()[0] > 0


def test_without_the_text_operators(monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(E.importlib.util, "find_spec", lambda name: None)
        assert set(E.queries()) == OWN and set(E.oracle_sql()) <= OWN


def test_nothing_else_imports_the_text_operators():
    import pathlib
    root = pathlib.Path(E.__file__).parent / "tablelearn"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text()
