"""Property checks: gain report and metrics against brute force on random
small tables (hypothesis), plus invariants from the survey."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablelearn.operators import metrics, stats

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.sampled_from([0, 1, 2])),
    min_size=1, max_size=40)


def _h(counts, base=2.0):
    t = sum(counts)
    return -sum(c / t * math.log(c / t, base) for c in counts if c)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_gain_report_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "f string, g int, y int")
    rep = {r["feature"]: r for r in stats.gain_report(df, ["f", "g"], "y").collect()}
    n = len(rows)
    hy = _h(list(Counter(r[2] for r in rows).values()))
    for i, name in enumerate(["f", "g"]):
        by_value = Counter(r[i] for r in rows)
        cond = sum(c / n * _h(list(Counter(r[2] for r in rows if r[i] == v).values())) for v, c in by_value.items())
        hx_nats = _h(list(by_value.values()), math.e)
        assert rep[name]["label_entropy"] == pytest.approx(hy, abs=1e-9)
        assert rep[name]["gain"] == pytest.approx(hy - cond, abs=1e-9)
        assert rep[name]["gain_compat"] == pytest.approx(hy - hx_nats, abs=1e-9)
        assert rep[name]["gain"] >= -1e-12


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=2, max_size=40))
def test_auc_matches_pairwise_definition(spark, pairs):
    df = spark.createDataFrame([(float(y), float(s)) for y, s in pairs], "label double, score double")
    got = metrics.area_under_roc(df, buckets=3).collect()[0]["area_under_roc"]
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        assert got is None
        return
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want, abs=1e-12)
