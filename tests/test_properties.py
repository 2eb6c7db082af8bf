"""Property tests: invariants that must hold for any input."""

import random

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanmart.operators import agg as A
from loanmart.operators import windows as W
from loanmart.plans import blocks as B

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["A", "B", "C", None])), min_size=1, max_size=40))
def test_shares_sum_to_one(spark, data):
    df = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(data)], "id int, k int, s string")
    out = A.category_shares(df, "k", "s", {"A": "a", "B": "b", "C": "c"}).collect()
    for r in out:
        assert abs(sum(v or 0.0 for v in (r["ratio_a"], r["ratio_b"], r["ratio_c"])) - 1.0) < 1e-12
    assert {r["k"] for r in out} == {k for k, s in data if s is not None}


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(-30, 0), st.one_of(st.none(), st.floats(-5, 50))),
                min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1])), st.integers(2, 9))
def test_bucketed_lag_equals_plain_lag(spark, data, width):
    df = spark.createDataFrame(data, "k int, m int, v double")
    plain = {(r["k"], r["m"]): r["v_prev"] for r in W.lag_prev(df, "k", ["m"], ["v"]).collect()}
    bucketed = {(r["k"], r["m"]): r["v_prev"]
                for r in W.lag_prev(df, "k", ["m"], ["v"], bucket=F.floor(F.col("m") / width)).collect()}
    assert plain == bucketed


@SETTINGS
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(1, 6))
def test_salted_quota_sample_equals_plain(spark, groups, quota):
    df = spark.createDataFrame([(i, g, quota) for i, g in enumerate(groups)], "id int, g int, q int")
    plain = {r["id"] for r in W.sample_per_group(df, "g", "id", 9, quota=quota).collect()}
    salted = {r["id"] for r in W.sample_per_group(df, "g", "id", 9, quota="q").collect()}
    assert plain == salted
    counts = {}
    for i, g in enumerate(groups):
        counts[g] = counts.get(g, 0) + 1
    assert len(plain) == sum(min(c, quota) for c in counts.values())


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 20), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=30, unique_by=lambda t: (t[0], t[1])))
def test_latest_slot0_is_latest(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    wide = {r["k"]: r for r in W.latest_n_wide(df, "k", ["t"], ["v", "t"], n=3).collect()}
    for k in {d[0] for d in data}:
        ts = sorted((t, v) for kk, t, v in data if kk == k)[::-1]
        assert wide[k]["t0"] == ts[0][0] and wide[k]["v0"] == ts[0][1]
        assert wide[k]["t2"] == (ts[2][0] if len(ts) > 2 else None)
    first = {r["k"]: r for r in W.latest_n_wide(df, "k", ["t"], ["v"], n=2, first_skips_null=True).collect()}
    for k in {d[0] for d in data}:
        present = sorted((t, v) for kk, t, v in data if kk == k and v is not None)
        assert first[k]["v0"] == (present[-1][1] if present else None)


def test_result_independent_of_partitioning(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(1, 30), rnd.randint(-400, 0), rnd.choice(["Approved", "Refused", None]),
             rnd.choice(["Cash loans", "Consumer loans"]), rnd.random() * 100, rnd.choice([None, 5.0]), None,
             None, None, None, None) for i in range(300)]
    schema = ("SK_ID_PREV bigint, SK_ID_CURR bigint, DAYS_DECISION int, NAME_CONTRACT_STATUS string, "
              "NAME_CONTRACT_TYPE string, AMT_APPLICATION double, AMT_CREDIT double, AMT_DOWN_PAYMENT double, "
              "NAME_YIELD_GROUP string, NFLAG_INSURED_ON_APPROVAL double, RATE_INTEREST_PRIMARY double, "
              "RATE_INTEREST_PRIVILEGED double")
    df = spark.createDataFrame(rows, schema)
    a = sorted(map(tuple, B.previous_block(df.repartition(1)).collect()))
    b = sorted(map(tuple, B.previous_block(df.repartition(7, "SK_ID_PREV")).collect()))
    assert a == b


def test_mart_plan_has_no_full_outer_join(spark):
    from loanmart.plans.queries import build_mart
    from tests.conftest import SF001
    plan = build_mart(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "BatchEvalPython" not in plan


def test_hot_key_is_reduced_before_shuffle(spark):
    """A key holding a third of the rows: every aggregate of the blocks has
    a partial (map-side) phase and every window a partial group limit."""
    from loanmart.plans import blocks as B
    rows = [(i, 1 if i % 3 == 0 else i, -(i % 50), "Approved" if i % 2 else "Refused", "Cash loans",
             float(i), float(i), None, None, None, None, None) for i in range(600)]
    schema = ("SK_ID_PREV bigint, SK_ID_CURR bigint, DAYS_DECISION int, NAME_CONTRACT_STATUS string, "
              "NAME_CONTRACT_TYPE string, AMT_APPLICATION double, AMT_CREDIT double, AMT_DOWN_PAYMENT double, "
              "NAME_YIELD_GROUP string, NFLAG_INSURED_ON_APPROVAL double, RATE_INTEREST_PRIMARY double, "
              "RATE_INTEREST_PRIVILEGED double")
    prev = spark.createDataFrame(rows, schema)
    plan = B.previous_block(prev)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and plan.count("Exchange hashpartitioning") == 1
    pos = prev.select("SK_ID_PREV", "SK_ID_CURR", F.col("DAYS_DECISION").alias("MONTHS_BALANCE"),
                      F.lit(1).alias("SK_DPD"), F.lit(0).alias("SK_DPD_DEF"))
    wplan = B.pos_parts(pos)[1]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in wplan and "Partial" in wplan
    hot = B.previous_block(prev).filter("SK_ID_CURR = 1").first()
    assert hot["ratio_approved"] == pytest.approx(101 / 201) and hot["ratio_refused"] == pytest.approx(100 / 201)


def test_pushdown_and_pruning(spark):
    """Filters reach the parquet scan and only needed columns are read."""
    import __spark_entry__ as E
    from tests.conftest import SF001
    q = E.queries()
    import contextlib
    import io as _io
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        q["semi_join_cascade"](spark, SF001).explain("formatted")
    text = buf.getvalue()
    assert "PushedFilters: [Not(EqualNullSafe(c_mktsegment,HOUSEHOLD))" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    pos = q["block_pos"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in pos.split("FileScan parquet")[1:]]
    assert scans and all("props" not in s.split("ReadSchema")[-1][:300] for s in scans)
    sent = q["filter_sentinel"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in sent
