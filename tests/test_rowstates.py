"""Grandchild features from merged states against aggregates of the rows themselves."""

import decimal
import random

import pytest
from pyspark.sql import functions as F

from loanmart.operators import synth as D
from tests.conftest import rows


def rows_of(spark, count=600, seed=1):
    """Rows by a child key 0..59 (child key // 20 is its root, half of all in root 0), with awkward columns."""
    rng = random.Random(seed)
    data = []
    for i in range(count):
        fk = None if i % 97 == 0 else rng.randint(0, 29) if i % 2 else rng.randint(0, 59)
        data.append((i, fk, rng.choice([None, rng.random()]), 1e9 + rng.random(), 0.07, rng.randint(-5, 5),
                     decimal.Decimal(rng.randint(-999, 999)) / 100, rng.choice([True, False, None]),
                     rng.choice(["a", "b", "c", None]), None, rng.random() ** 6))
    return spark.createDataFrame(data, "id int, fk int, x double, far double, same double, n int, d decimal(9,2), yes boolean, "
                                       "cat string, empty string, steep double")


def close(a, b):
    """Equal keys and values; doubles within 1e-9 of their size.  ``far`` lies 1e9 from zero with a spread of 0.3: its
    means are known to about 1e-7, so its moments are compared to 1e-5."""
    assert len(a) == len(b)
    for r, s in zip(a, b):
        assert set(r) == set(s)
        for c in r:
            if isinstance(r[c], float) and s[c] is not None:
                tol = 1e-5 if "far" in c and ("STD" in c or "SKEW" in c) else 1e-9
                assert r[c] == pytest.approx(s[c], rel=tol, abs=tol), c
            else:
                assert r[c] == s[c], (c, r[c], s[c])


@pytest.mark.parametrize("split", [False, True])
def test_states_equal_the_rows(spark, split, monkeypatch):
    if split:                                               # every root counts as hot
        monkeypatch.setattr(D, "HOT_LEAST", 0)
        monkeypatch.setattr(D, "SALTS", 3)
    df = rows_of(spark)
    keys = spark.range(60).select(F.col("id").cast("int").alias("_fk"),
                                  F.when(F.col("id") != 59, F.floor(F.col("id") / 20).cast("int")).alias("_root"))
    st = D.RowStates.of(df, "t", "fk", {"id", "fk"})
    low = D.aggregate_child(df, "t", "fk", ["id", "fk"])
    got = st.features(D.NUMERIC_PRIMS, D.CATEGORICAL_PRIMS)
    assert got.columns == low.columns and got.schema == low.schema or [f.dataType for f in got.schema] == [f.dataType for f in low.schema]
    close(rows(got, ["_fk"]), rows(low, ["_fk"]))
    lifted = df.join(keys, df["fk"] == keys["_fk"]).drop("_fk")
    want = D.aggregate_child(lifted, "t", "_root", ["id", "fk"])
    close(rows(st.lift(keys).features(D.NUMERIC_PRIMS, D.CATEGORICAL_PRIMS), ["_fk"]), rows(want, ["_fk"]))
    root = rows(st.lift(keys).features(("std", "skew"), ()), ["_fk"])[0]
    assert root["STD(t.same)"] == 0 and root["SKEW(t.same)"] == 0   # a constant stays one


def test_states_of_few_and_no_rows(spark):
    df = rows_of(spark, 3)
    keys = spark.createDataFrame([(i, 7) for i in range(60)], "_fk int, _root int")
    for part in (df, df.limit(0)):
        st = D.RowStates.of(part, "t", "fk", {"id", "fk"})
        want = D.aggregate_child(part.join(keys, part["fk"] == keys["_fk"]).drop("_fk"), "t", "_root", ["id", "fk"])
        close(rows(st.lift(keys).features(D.NUMERIC_PRIMS, D.CATEGORICAL_PRIMS), ["_fk"]), rows(want, ["_fk"]))
    only = df.select("id", "fk", "cat")                     # no numbers at all
    st = D.RowStates.of(only, "t", "fk", {"id", "fk"})
    assert st.lift(keys).features(D.NUMERIC_PRIMS, D.CATEGORICAL_PRIMS).columns == ["_fk", "COUNT(t)", "NUM_UNIQUE(t.cat)", "MODE(t.cat)"]


def test_a_grandchild_is_read_once_for_numbers_and_once_for_categories(spark, monkeypatch):
    from loanmart.plans.synth_queries import entity_set
    from tests.conftest import SF001
    import loanmart.session as session
    plans, cut = [], session.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(session, "cut_lineage", seen)
    out = D.synthesize(entity_set(spark, SF001), "customer", depth=2)
    assert [p.count("/lineitem.parquet") for p in plans][:2] == [1, 1] and sum(p.count("/lineitem.parquet") for p in plans) == 2
    last = out._jdf.queryExecution().executedPlan().toString()
    assert "/lineitem.parquet" not in last and "/customer.parquet" in last
