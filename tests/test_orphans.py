from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarazu.operators.orphans import Orphans, court_orphan_counts, court_orphans

T0, T1, T2 = datetime(2020, 1, 5), datetime(2020, 2, 5), datetime(2020, 3, 5)
CHILD = "id long, k string, at timestamp_ntz, source string"
PARENT = "k string, at timestamp_ntz, id long"


def brute(children, parents):
    first = {}
    for k, at, _ in parents:
        if k is not None:
            first[k] = min(at, first.get(k, at))
    out = []
    for i, k, at, _ in children:
        if k not in first:
            out.append((str(i), at.strftime("%Y-%m") if at else None, "missing"))
        elif at and first[k] > at:
            out.append((str(i), at.strftime("%Y-%m"), "late"))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    parents = [("a", T1, 1), ("a", T0, 2), ("b", T1, 3), (None, T0, 4), ("hot", T2, 5)]
    children = [(1, "a", T0, "x"), (2, "b", T0, "x"), (3, "b", T1, "x"), (4, "c", T1, "x"), (5, None, T1, "x"), (6, "c", None, "x"), (4, "c", T1, "x"), (7, "b", None, "x"), (8, "A", T0, "x")]
    children += [(i, "hot", T1, "x") for i in range(100, 150)] + [(i, f"gone{i % 7}", T2, "x") for i in range(200, 230)]
    c, p = spark.createDataFrame(children, CHILD), spark.createDataFrame(parents, PARENT)
    both = Orphans(c, ["k"], "at", F.col("id").cast("string"), p, ["k"], "at")
    want = brute(children, parents)
    assert sorted(((r.record_key, r.created_month, r.orphan_kind) for r in both.found().collect()), key=str) == want
    assert {(r.created_month, r.orphan_kind): r.n_records for r in both.counts().collect()} == Counter((m, k) for _, m, k in want)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 70) | st.none()), max_size=25), st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 70)), max_size=4))
def test_periods_within_which_the_parent_came(spark, child, parent):
    day = lambda d: None if d is None else T0 + timedelta(days=d)
    children, parents = [(i, k, day(d), "x") for i, (k, d) in enumerate(child)], [(k, day(d), 1) for k, d in parent]
    both = Orphans(spark.createDataFrame(children, CHILD), ["k"], "at", F.col("id").cast("string"), spark.createDataFrame(parents, PARENT), ["k"], "at")
    assert {(r.created_month, r.orphan_kind): r.n_records for r in both.counts().collect()} == Counter((m, k) for _, m, k in brute(children, parents))


def test_empty_tables(spark):
    c, p = spark.createDataFrame([(1, "a", T0, "x")], CHILD), spark.createDataFrame([("a", T0, 1)], PARENT)
    none = Orphans(c.limit(0), ["k"], "at", F.col("id").cast("string"), p, ["k"], "at")
    assert none.found().count() == 0 and none.counts().count() == 0
    assert [r.orphan_kind for r in Orphans(c, ["k"], "at", F.col("id").cast("string"), p.limit(0), ["k"], "at").found().collect()] == ["missing"]


def test_court_tables(spark):
    ent = spark.createDataFrame([(1, "1", "x", T0), (2, "2", "x", T0), (3, "1", "y", T1)], "id long, case_number string, court_identifier string, created_at timestamp_ntz")
    cases = spark.createDataFrame([("1", "x", T1, "p"), ("1", "x", T2, "p"), ("1", "y", T0, "p")], "case_number string, court_identifier string, created_at timestamp_ntz, id string")
    courts = spark.createDataFrame([("x", T2)], "identifier string, created_at timestamp_ntz")
    found = court_orphans(ent, cases, courts)
    got = {(r.table_name, r.record_key, r.created_month, r.orphan_kind) for r in found.collect()}
    assert got == {("court_case_entities", "1", "2020-01", "late"), ("court_case_entities", "2", "2020-01", "missing"), ("court_cases", "1@x", "2020-02", "late"), ("court_cases", "1@y", "2020-01", "missing")}
    assert court_orphan_counts(ent, cases, courts).agg(F.sum("n_records")).first()[0] == 4
