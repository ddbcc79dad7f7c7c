"""The small cases of FIXTURES.md §C, by name, for the three history folds."""

import datetime as dt

import pytest

from tidemark.functions.hashing import row_hash
from tidemark.operators.common import empty_like, history_schema
from tidemark.operators.scd1 import scd1_fold
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.version_set import version_set_fold

T1, T2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
SCHEMA = "k bigint, v string, seq bigint"


def batch(spark, values, key=1):
    df = spark.createDataFrame([(key, v, i) for i, v in enumerate(values)], SCHEMA)
    return df.withColumn("data_hash", row_hash(df.schema, ["v"]))


def run(spark, fold, batches, family="scd", **kw):
    state = empty_like(spark, history_schema(spark.createDataFrame([], SCHEMA).schema, family))
    out = None
    for i, b in enumerate(batches):
        out = fold(state, b, ["k"], T1 if i == 0 else T2, seq="seq", **kw)
        state = out.state.checkpoint(eager=True)
    m = out.metrics.first().asDict()
    return state, m


def versions(state, active="is_active"):
    return sorted((r["v"], r["occurrence_number"], r[active] if active else None)
                  for r in state.collect())


def counters(m):
    return (m["new_records"], m["updated_records"], m["unchanged_records"], m["new_occurrences"])


# (batch values, scd2 versions, scd2 counters, version-set versions, version-set
# counters, scd1 versions, scd1 counters); versions are (v, occurrence, active)
CASES = {
    "A": (["A"], [("A", 1, True)], (1, 0, 0, 0),
          [("A", 1)], (1, 0, 0, 0), [("A", 1, True)], (1, 0, 0, 0)),
    "A,A": (["A", "A"], [("A", 1, True)], (1, 0, 1, 0),
            [("A", 1)], (1, 0, 1, 0), [("A", 1, True)], (1, 0, 1, 0)),
    "A,B": (["A", "B"], [("A", 1, False), ("B", 2, True)], (1, 1, 0, 1),
            [("A", 1), ("B", 2)], (1, 0, 0, 1), [("B", 1, True)], (1, 1, 0, 0)),
    "A,B,A": (["A", "B", "A"], [("A", 1, False), ("A", 3, True), ("B", 2, False)],
              (1, 2, 0, 2), [("A", 1), ("B", 2)], (1, 0, 1, 1),
              [("A", 1, True)], (1, 2, 0, 0)),
}


@pytest.mark.parametrize("case", list(CASES))
def test_case(spark, case):
    vals, s2, c2, vs, cvs, s1, c1 = CASES[case]
    st, m = run(spark, scd2_fold, [batch(spark, vals)])
    assert versions(st) == s2 and counters(m) == c2
    st, m = run(spark, version_set_fold, [batch(spark, vals)], family="versions")
    assert [(v, o) for v, o, _ in versions(st, None)] == vs and counters(m) == cvs
    st, m = run(spark, scd1_fold, [batch(spark, vals)])
    assert versions(st) == s1 and counters(m) == c1


def test_null_key_run_twice(spark):
    for fold, fam in ((scd2_fold, "scd"), (version_set_fold, "versions"), (scd1_fold, "scd")):
        b = batch(spark, ["A"], key=None)
        st, m = run(spark, fold, [b, b], family=fam)
        assert st.count() == 2 and m["new_records"] == 1
        assert {r["occurrence_number"] for r in st.collect()} == {1}


def test_state_a_then_empty_batch(spark):
    empty = spark.createDataFrame([], SCHEMA)
    empty = empty.withColumn("data_hash", row_hash(empty.schema, ["v"]))
    st, m = run(spark, scd2_fold, [batch(spark, ["A"]), empty])
    assert versions(st) == [("A", 1, True)] and counters(m) == (0, 0, 0, 0)
    st, m = run(spark, version_set_fold, [batch(spark, ["A"]), empty], family="roster",
                active_col="active")
    assert versions(st, "active") == [("A", 1, False)] and m["deactivated_records"] == 1
