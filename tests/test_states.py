"""Mergeable states: the same results from parts as from all rows."""

import random

import pytest
from pyspark.sql import functions as F

from loanmart.operators import states as ST
from loanmart.operators.agg import agg_expr
from loanmart.plans import blocks as B
from loanmart.plans import standins as V
from loanmart.plans.increment import MartStates, read_states, write_states
from tests.conftest import SF001, rows


def events(spark, count=400, seed=3):
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), i, rng.choice([None, -1, -2, -3, -4, -5]), rng.choice(["a", "b", None]),
             rng.choice([None, float(rng.randint(-9, 9))]), rng.randint(0, 5)) for i in range(count)]
    return spark.createDataFrame(data, "k int, id int, month int, cat string, x double, n int")


FNS = ("size", "count", "sum", "mean", "min", "max", "first", "last")


def spec_of(order):
    is_a = F.col("cat") == "a"
    out = [ST.measure(fn, f"{c}_{fn}", c, order) for fn in FNS for c in ("x", "n")]
    out += [ST.measure(fn, f"x_{fn}_a", "x", order, is_a, "a") for fn in FNS]
    return ST.Totals("k", out), is_a


def test_totals_of_parts_are_those_of_all_rows(spark):
    df, order = events(spark), ["month", "id"]
    part, is_a = spec_of(order)
    plain = rows(df.filter("k is not null").groupBy("k").agg(
        *[agg_expr(c, fn, order).alias(f"{c}_{fn}") for fn in FNS for c in ("x", "n")],
        *[agg_expr("x", fn, order, where=is_a).alias(f"x_{fn}_a") for fn in FNS]), ["k"])
    cuts = ([F.lit(True)], [F.col("id") % 2 == 0, F.col("id") % 2 == 1], [F.col("k") == 1, F.col("k") != 1],
            [F.col("id") < 0, F.col("id") % 3 == 0, F.col("id") % 3 == 1, F.col("id") % 3 == 2])
    for cut in cuts:                                        # one part, rows apart, keys apart, an empty part
        merged = part.merge([part.build(df.filter(c)) for c in cut])
        got = rows(part.finish(merged), ["k"])
        assert [{c: pytest.approx(v) if isinstance(v, float) else v for c, v in r.items()} for r in plain] == got
    twice = part.merge([part.merge([part.build(df.filter("id < 100")), part.build(df.filter("id between 100 and 250"))]),
                        part.build(df.filter("id > 250"))])
    assert rows(part.finish(twice), ["k"]) == rows(part.finish(part.build(df)), ["k"])
    assert part.finish(part.build(df.limit(0))).count() == 0


def test_statistics_without_a_small_state_are_refused():
    for fn in ("std", "nunique", "median"):
        with pytest.raises(ValueError):
            ST.measure(fn, "y", "x")
    with pytest.raises(ValueError):
        ST.measure("first", "y", "x")


def test_newest_rows_and_pairs_of_parts(spark):
    df = events(spark)
    newest = ST.NewestRows("k", ["month", "id"], ["x"], 4)
    merged = newest.merge([newest.build(df.filter("id % 3 = 0")), newest.build(df.filter("id % 3 > 0"))])
    want = []
    for k in (1, 2, 3):
        mine = [r for r in rows(df) if r["k"] == k]
        mine.sort(key=lambda r: (r["month"] is not None, r["month"] or 0, r["id"]), reverse=True)
        want += [{"k": k, "month": r["month"], "id": r["id"], "x": r["x"]} for r in mine[:4]]
    assert sorted(map(str, rows(merged))) == sorted(map(str, want))
    pairs = ST.Pairs(["k", "cat"])
    merged = pairs.merge([pairs.build(df.filter("id < 50")), pairs.build(df.filter("id >= 50"))])
    assert {tuple(r) for r in merged.collect()} == {(r["k"], r["cat"]) for r in rows(df) if r["k"] and r["cat"]}
    assert merged.count() == len({tuple(r) for r in merged.collect()})


def test_card_changes_come_from_the_kept_rows(spark):
    """Lags on n + 1 rows a card equal those on all, months without a value included."""
    rng = random.Random(5)
    data = []
    for i in range(300):
        who = rng.choice([1, 1, 1, 2, 3])
        data.append((who, who * 10 + rng.randint(0, 2), i, rng.choice([None, *range(-12, 0)]) if i % 7 == 0 else -rng.randint(1, 40),
                     rng.choice([None, -1.0, 0.0, 5.0, 70.0, 200.0]), 100.0, 5.0, 10.0))
    data += [(4, 40, 900, None, 3.0, 1.0, 1.0, 1.0), (4, 40, 901, None, 4.0, 1.0, 1.0, 1.0), (4, 40, 902, -3, 9.0, 1.0, 1.0, 1.0)]
    card = spark.createDataFrame(data, "SK_ID_CURR int, SK_ID_PREV int, row int, MONTHS_BALANCE int, AMT_BALANCE double, "
                                       "AMT_CREDIT_LIMIT_ACTUAL double, AMT_PAYMENT_CURRENT double, AMT_INST_MIN_REGULARITY double")
    spec = MartStates(card_tie=("row",))
    part = {s: p for s, (t, p) in spec.parts().items() if t == "card"}
    halves = [spec.build({"card": card.filter(c)}) for c in ("row % 2 = 0", "row % 2 = 1")]
    states = spec.merge(*halves)
    assert set(states) == set(part) == {"card_sums", "card_rows"}
    per_card = states["card_rows"].groupBy("SK_ID_PREV").count().agg(F.max("count")).first()[0]
    assert per_card <= spec.n + 1
    from loanmart.operators.windows import latest_n_wide, pct_change
    lagged = pct_change(states["card_rows"], "SK_ID_PREV", ["MONTHS_BALANCE", "row"], "AMT_BALANCE")
    got = latest_n_wide(lagged, "SK_ID_CURR", ["MONTHS_BALANCE", "row"], ["MONTHS_BALANCE", "balance_pct_change"])
    want = B.card_block(card, tie=("row",), bucket=None).select(got.columns)
    assert rows(got, ["SK_ID_CURR"]) == rows(want, ["SK_ID_CURR"])


def test_stored_states_of_three_months_give_the_mart(spark, tmp_path):
    from loanmart.plans.queries import _application, build_mart, finish
    spec = MartStates(V.PREV_SPEC, V.BUREAU_SPEC, V.EVENT_TIE, V.LINEITEM_TIE, V.EVENT_TIE)
    tables = {"previous": V.previous(spark, SF001), "installments": V.installments(spark, SF001),
              "card": V.card_balance(spark, SF001), "pos": V.pos_balance(spark, SF001), "bureau": V.bureau(spark, SF001),
              "bureau_balance": V.bureau_balance(spark, SF001)}
    third = {t: F.pmod(F.hash(*df.columns), F.lit(3)) for t, df in tables.items()}
    names = list(spec.parts())
    write_states(spec.build({t: df.filter(third[t] == 0) for t, df in tables.items()}), f"{tmp_path}/v0")
    for i in (1, 2):                                        # then the other thirds; the last lacks some tables' rows
        new = spec.build({t: df.filter(third[t] == i) for t, df in tables.items() if i == 1 or t != "pos"})
        write_states(spec.merge(read_states(spark, f"{tmp_path}/v{i - 1}", names), new), f"{tmp_path}/v{i}")
    last = spec.build({"pos": tables["pos"].filter(third["pos"] == 2)})
    states = spec.merge(read_states(spark, f"{tmp_path}/v2", names), last)
    got = finish(spec.mart(_application(spark, SF001), states))
    want = finish(build_mart(spark, SF001))
    assert set(got.columns) == set(want.columns)
    key = B.KEY
    assert rows(got.select(want.columns), [key]) == rows(want, [key])
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    stored = plan(spec.mart(_application(spark, SF001), read_states(spark, f"{tmp_path}/v2", names)))
    for table in ("lineitem", "orders", "events"):
        assert f"/{table}.parquet" not in stored and f"/{table}.parquet" in plan(build_mart(spark, SF001))
