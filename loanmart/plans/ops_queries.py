"""Operator-level keys (§2.1-2.7): each runs one library operator over a
whole stand-in table and carries its DuckDB oracle next to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.functions.scalars import cap, drop_sentinel, map_values, null_if, replace_value
from loanmart.operators import agg as A
from loanmart.operators import joins as J
from loanmart.operators import sample as L
from loanmart.operators import windows as W
from loanmart.plans import blocks as B
from loanmart.plans import oracle_blocks as OB
from loanmart.plans import sqlkit as S
from loanmart.plans import standins as V
from loanmart.plans.oracle_views import with_views
from loanmart.plans.queries import (
    _application,
    _card,
    _installment,
    _previous,
    finish,
    register,
)
from loanmart.sources.io import materialize, read_table, write_bucketed, write_features

KEY = "SK_ID_CURR"
PREV_ORDER = ["DAYS_DECISION", "SK_ID_PREV"]
BUR_ORDER = ["DAYS_CREDIT", "SK_ID_BUREAU"]
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def R(sql: str, doubles, *views: str) -> str:
    """Oracle text: optional views, then rounding of the double columns."""
    body = with_views(f"SELECT * FROM ({sql}) AS _b", *views) if views else sql
    return S.rounded(body, list(doubles))


# ------------------------------------------------------------------ 2.1 sources

@register("scan_normalize", R(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate FROM lineitem",
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def scan_normalize(spark, sf):
    li = read_table(spark, f"{sf}/lineitem.parquet")
    return finish(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"))


def _app_sql_unclean():
    sql, _c, d = OB.application_sql()
    sql = sql.replace(f"WHERE CODE_GENDER IS DISTINCT FROM '{V.GENDER_SENTINEL}'", "")
    sql = sql.replace(f"REPLACE (NULLIF(DAYS_EMPLOYED, {V.EMPLOYED_SENTINEL}) AS DAYS_EMPLOYED)", "")
    return sql.replace("SELECT *  FROM", "SELECT * FROM"), d


@register("scoring_table_features", R(_app_sql_unclean()[0], _app_sql_unclean()[1], "application"))
def scoring_table_features(spark, sf):
    return finish(B.application_features(V.application(spark, sf), clean=False))


@register("feature_sink_roundtrip", R(OB.installment_sql()[0], OB.installment_sql()[2], "installments"))
def feature_sink_roundtrip(spark, sf):
    from loanmart.session import scratch_path
    path = scratch_path(spark, "features")
    write_features(_installment(spark, sf), path)
    return finish(read_table(spark, path))


@register("materialize_mart", R(OB.mart_sql()[0], OB.mart_sql()[2], "application", "prev", "ccb", "installments",
                                "pos", "bureau", "bureau_balance"))
def materialize_mart(spark, sf):
    from loanmart.plans.queries import build_mart
    return finish(materialize(build_mart(spark, sf)))


# ------------------------------------------------------- 2.2 row expressions

@register("filter_sentinel", R(
    f"SELECT c_custkey, seg FROM (SELECT c_custkey, CASE WHEN c_nationkey = 1 THEN NULL ELSE c_mktsegment END AS seg "
    f"FROM customer) AS c WHERE seg IS DISTINCT FROM '{V.GENDER_SENTINEL}'", []))
def filter_sentinel(spark, sf):
    c = V.table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") == 1, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    return drop_sentinel(c, "seg", V.GENDER_SENTINEL)


@register("sentinel_to_null", R("SELECT c_custkey, NULLIF(c_nationkey, 0) AS nationkey_clean FROM customer", []))
def sentinel_to_null(spark, sf):
    return V.table(spark, sf, "customer").select("c_custkey", null_if("c_nationkey", 0).alias("nationkey_clean"))


_RATIO_COLS = ["Days_employed_age", "Credit_income_ratio", "Anuity_income_ratio", "Income_per_person", "Credit_term"]


@register("ratio_features", R(
    f"SELECT SK_ID_CURR, {', '.join(_RATIO_COLS)} FROM ({_app_sql_unclean()[0]}) AS a", _RATIO_COLS, "application"))
def ratio_features(spark, sf):
    return finish(B.application_features(V.application(spark, sf), clean=False).select(KEY, *_RATIO_COLS))


def _bureau_rows_sql(select: str, doubles) -> str:
    return R(f"WITH rows AS ({OB.BUREAU_ROWS}) {select}", doubles, "bureau")


@register("difference_features", _bureau_rows_sql("SELECT SK_ID_BUREAU, Days_early_paidoff, Duration_real FROM rows",
                                                  ["Days_early_paidoff", "Duration_real"]))
def difference_features(spark, sf):
    return finish(B.bureau_rows(V.bureau(spark, sf)).select("SK_ID_BUREAU", "Days_early_paidoff", "Duration_real"))


_DUR = ["Duration_planned", "AMT_weightdebt_duration", "AMT_Overdue_duration", "AMT_Maxoverdue_duration"]


@register("replace_zero_divisor", _bureau_rows_sql(f"SELECT SK_ID_BUREAU, {', '.join(_DUR)} FROM rows", _DUR))
def replace_zero_divisor(spark, sf):
    return finish(B.bureau_rows(V.bureau(spark, sf)).select("SK_ID_BUREAU", *_DUR))


@register("flag_times_amount", _bureau_rows_sql("SELECT SK_ID_BUREAU, Defaulted, AMT_defaulted FROM rows",
                                                ["AMT_defaulted"]))
def flag_times_amount(spark, sf):
    return finish(B.bureau_rows(V.bureau(spark, sf)).select("SK_ID_BUREAU", "Defaulted", "AMT_defaulted"))


@register("map_values", R(
    "SELECT SK_ID_BUREAU, CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 WHEN CREDIT_ACTIVE = 'Active' THEN 1 END "
    "AS CREDIT_ACTIVE FROM bureau", [], "bureau"))
def map_values_q(spark, sf):
    return V.bureau(spark, sf).select("SK_ID_BUREAU", map_values("CREDIT_ACTIVE", B.CREDIT_ACTIVE_MAP)
                                      .alias("CREDIT_ACTIVE"))


_CARD_ROW_SQL = f"WITH rows AS ({OB.CARD_ROWS}) "


@register("compare_flags", R(_CARD_ROW_SQL + "SELECT CCB_ROW, Beyond_limit, Delinquent FROM rows", [], "ccb"))
def compare_flags(spark, sf):
    return B.card_rows(V.card_balance(spark, sf), tie=V.EVENT_TIE).select("CCB_ROW", "Beyond_limit", "Delinquent")


@register("threshold_flags", R(_CARD_ROW_SQL + "SELECT CCB_ROW, times_bal80, has_cc_now, balance_now FROM rows",
                               ["balance_now"], "ccb"))
def threshold_flags(spark, sf):
    rows = B.card_rows(V.card_balance(spark, sf), tie=V.EVENT_TIE)
    return finish(rows.select("CCB_ROW", "times_bal80", "has_cc_now", "balance_now"))


_TYPES4 = list(V.BUREAU_SPEC.credit_types)


@register("membership_filter", R(
    "SELECT SK_ID_BUREAU, CREDIT_TYPE FROM bureau WHERE CREDIT_TYPE IN ("
    + ", ".join(f"'{t}'" for t in _TYPES4) + ")", [], "bureau"))
def membership_filter(spark, sf):
    return V.bureau(spark, sf).filter(F.col("CREDIT_TYPE").isin(_TYPES4)).select("SK_ID_BUREAU", "CREDIT_TYPE")


@register("cap_values", R(
    "SELECT o_orderkey, CASE WHEN x > 30 THEN 30 ELSE x END AS capped FROM "
    "(SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 60 END AS x FROM orders) AS o",
    []))
def cap_values(spark, sf):
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderkey") % 60).alias("x"))
    return o.select("o_orderkey", cap("x", 30).alias("capped"))


@register("replace_value", R(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE o_orderkey % 7 END AS divisor FROM orders", []))
def replace_value_q(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", replace_value(F.col("o_orderkey") % 7, 0, 1)
                                               .alias("divisor"))


# ------------------------------------------------------------- 2.3 aggregates

def _tot_sql():
    exprs, cols, doubles = [], [], []
    for c, fns in B.BUREAU_TOTALS.items():
        for fn in fns:
            exprs.append(f"{S.agg(c, fn, integral=c in OB.INTEGRAL)} AS {c}_{fn}")
            if fn == "mean" or (fn == "sum" and c not in OB.INTEGRAL):
                doubles.append(f"{c}_{fn}")
    return _bureau_rows_sql(f"SELECT SK_ID_CURR, {', '.join(exprs)} FROM rows GROUP BY SK_ID_CURR", doubles)


@register("group_multi_agg", _tot_sql())
def group_multi_agg(spark, sf):
    return finish(A.named_aggs(B.bureau_rows(V.bureau(spark, sf)), KEY, B.BUREAU_TOTALS))


_TWO = {"DAYS_CREDIT": ["first", "last"], "AMT_CREDIT_SUM_DEBT": ["count", "sum", "mean"]}


@register("group_two_keys", _bureau_rows_sql(
    "SELECT SK_ID_CURR, CREDIT_TYPE, "
    + ", ".join(f"{S.agg(c, fn, BUR_ORDER)} AS {c}_{fn}" for c, fns in _TWO.items() for fn in fns)
    + " FROM rows GROUP BY SK_ID_CURR, CREDIT_TYPE",
    ["DAYS_CREDIT_first", "DAYS_CREDIT_last", "AMT_CREDIT_SUM_DEBT_sum", "AMT_CREDIT_SUM_DEBT_mean"]))
def group_two_keys(spark, sf):
    return finish(A.named_aggs(B.bureau_rows(V.bureau(spark, sf)), [KEY, "CREDIT_TYPE"], _TWO, order=BUR_ORDER))


@register("conditional_sums", R(
    _CARD_ROW_SQL + "SELECT SK_ID_CURR, CAST(coalesce(sum(has_cc_now), 0) AS BIGINT) AS has_cc_now, "
    "coalesce(sum(balance_now), 0) AS balance_now, CAST(coalesce(sum(times_bal80), 0) AS BIGINT) AS times_bal80 "
    "FROM rows GROUP BY SK_ID_CURR", ["balance_now"], "ccb"))
def conditional_sums(spark, sf):
    rows = B.card_rows(V.card_balance(spark, sf), tie=V.EVENT_TIE)
    return finish(A.conditional_sums(rows, KEY, {"has_cc_now": F.col("has_cc_now"),
                                                 "balance_now": F.col("balance_now"),
                                                 "times_bal80": F.col("times_bal80")}))


_LATEST_COLS = ["DAYS_DECISION", "NAME_CONTRACT_STATUS", "AMT_CREDIT"]


@register("latest_value", R(
    "SELECT SK_ID_CURR, " + ", ".join(f"{S.latest(c, PREV_ORDER)} AS {c}" for c in _LATEST_COLS)
    + " FROM prev GROUP BY SK_ID_CURR", ["AMT_CREDIT"], "prev"))
def latest_value(spark, sf):
    return finish(A.latest(V.previous(spark, sf), KEY, PREV_ORDER, _LATEST_COLS))


@register("earliest_value", R(
    "SELECT SK_ID_CURR, CREDIT_TYPE, " + ", ".join(f"{S.earliest(c, BUR_ORDER)} AS {c}"
                                                   for c in ["DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT"])
    + " FROM bureau GROUP BY SK_ID_CURR, CREDIT_TYPE", ["DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT"], "bureau"))
def earliest_value(spark, sf):
    return finish(A.earliest(V.bureau(spark, sf), [KEY, "CREDIT_TYPE"], BUR_ORDER,
                             ["DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT"]))


_APPR = list(V.PREV_SPEC.approved_cols)


@register("latest_filtered_row", R(
    "SELECT SK_ID_CURR, " + ", ".join(f"{S.latest(c, PREV_ORDER)} AS {c}" for c in _APPR)
    + f" FROM prev WHERE NAME_CONTRACT_STATUS = '{V.PREV_SPEC.approved}' GROUP BY SK_ID_CURR",
    ["AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT"], "prev"))
def latest_filtered_row(spark, sf):
    return finish(A.latest_row(V.previous(spark, sf), KEY, PREV_ORDER, _APPR,
                               where=F.col("NAME_CONTRACT_STATUS") == V.PREV_SPEC.approved))


_ST = V.PREV_SPEC.statuses


@register("category_shares", R(
    "SELECT SK_ID_CURR, " + ", ".join(
        f"CAST(NULLIF(count(*) FILTER (WHERE NAME_CONTRACT_STATUS = '{v}'), 0) AS DOUBLE) / count(*) AS ratio_{n}"
        for v, n in _ST.items())
    + " FROM prev WHERE NAME_CONTRACT_STATUS IS NOT NULL GROUP BY SK_ID_CURR",
    [f"ratio_{n}" for n in _ST.values()], "prev"))
def category_shares(spark, sf):
    return finish(A.category_shares(V.previous(spark, sf), KEY, "NAME_CONTRACT_STATUS", _ST, id_col="SK_ID_PREV"))


_TY = V.PREV_SPEC.types


def _pivot_sql(table, key, cat, values, spec, order, where=None):
    exprs, doubles = [], []
    for v, label in values.items():
        cond = f"{cat} = '{v}'"
        for c, fns in spec.items():
            for fn in fns:
                name = f"{c}_{fn}_{label}"
                exprs.append(f"CASE WHEN count(*) FILTER (WHERE {cond}) > 0 THEN "
                             f"{S.agg(c, fn, order, cond, integral=c in OB.INTEGRAL)} END AS {name}")
                doubles.append(name)
    vals = ", ".join(f"'{v}'" for v in values)
    w = f" AND {where}" if where else ""
    return f"SELECT {key}, {', '.join(exprs)} FROM {table} WHERE {cat} IN ({vals}){w} GROUP BY {key}", doubles


_PIV_SPEC = {"DAYS_DECISION": ["first"], "AMT_CREDIT": ["first"]}
_piv_sql, _piv_d = _pivot_sql("prev", KEY, "NAME_CONTRACT_TYPE", _TY, _PIV_SPEC, PREV_ORDER,
                              f"NAME_CONTRACT_STATUS = '{V.PREV_SPEC.approved}'")


@register("pivot_latest_by_category", R(_piv_sql, [d for d in _piv_d if d.startswith("AMT")], "prev"))
def pivot_latest_by_category(spark, sf):
    prev = V.previous(spark, sf).filter(F.col("NAME_CONTRACT_STATUS") == V.PREV_SPEC.approved)
    return finish(A.pivot_stats(prev, KEY, "NAME_CONTRACT_TYPE", _TY, _PIV_SPEC, order=PREV_ORDER))


_bt_sql, _bt_d = _pivot_sql("rows", KEY, "CREDIT_TYPE", V.BUREAU_SPEC.credit_types, B.BUREAU_BY_TYPE, BUR_ORDER)


@register("pivot_stats_by_category", _bureau_rows_sql(
    _bt_sql, [d for d in _bt_d if d.split("_")[0] in ("DAYS", "AMT") and "_count_" not in d]))
def pivot_stats_by_category(spark, sf):
    rows = B.bureau_rows(V.bureau(spark, sf))
    return finish(A.pivot_stats(rows, KEY, "CREDIT_TYPE", V.BUREAU_SPEC.credit_types, B.BUREAU_BY_TYPE,
                                order=BUR_ORDER))


_SUB = {"AMT_CREDIT_SUM_DEBT": ["count", "sum", "mean", "first"]}


@register("subset_stats", R(
    "SELECT SK_ID_CURR, " + ", ".join(f"{S.agg('AMT_CREDIT_SUM_DEBT', fn, BUR_ORDER)} AS AMT_CREDIT_SUM_DEBT_{fn}"
                                      for fn in _SUB["AMT_CREDIT_SUM_DEBT"])
    + f" FROM bureau WHERE CREDIT_TYPE = '{V.BUREAU_SPEC.credit_card}' GROUP BY SK_ID_CURR",
    ["AMT_CREDIT_SUM_DEBT_sum", "AMT_CREDIT_SUM_DEBT_mean", "AMT_CREDIT_SUM_DEBT_first"], "bureau"))
def subset_stats(spark, sf):
    cards = V.bureau(spark, sf).filter(F.col("CREDIT_TYPE") == V.BUREAU_SPEC.credit_card)
    return finish(A.named_aggs(cards, KEY, _SUB, order=BUR_ORDER))


_LV = B.STATUS_LEVELS


@register("category_ratios", R(
    "SELECT SK_ID_BUREAU, " + ", ".join(f"avg(CASE WHEN STATUS = '{s}' THEN 1.0 ELSE 0.0 END) AS STATUS_{s}"
                                        for s in _LV)
    + " FROM bureau_balance WHERE STATUS IS DISTINCT FROM 'X' AND STATUS IS DISTINCT FROM 'C' GROUP BY SK_ID_BUREAU",
    [f"STATUS_{s}" for s in _LV], "bureau_balance"))
def category_ratios(spark, sf):
    return finish(A.category_ratios(V.bureau_balance(spark, sf), "SK_ID_BUREAU", "STATUS", _LV,
                                    exclude=B.STATUS_EXCLUDED))


@register("latest_month_by_status", R(
    "SELECT SK_ID_BUREAU, max(CASE WHEN STATUS = '0' THEN MONTHS_BALANCE END) AS Months_latest_open, "
    "max(CASE WHEN STATUS = '1' THEN MONTHS_BALANCE END) AS Months_latest_delin FROM bureau_balance "
    "WHERE STATUS IN ('0', '1') GROUP BY SK_ID_BUREAU HAVING count(*) FILTER (WHERE STATUS = '0') > 0", [],
    "bureau_balance"))
def latest_month_by_status(spark, sf):
    return A.latest_month_by_status(V.bureau_balance(spark, sf), "SK_ID_BUREAU", "STATUS", "MONTHS_BALANCE")


def _rollup_sql():
    cte, cols, doubles = OB.balance_rollup_cte()
    return R(f"WITH {cte.strip()} SELECT * FROM rollup", doubles, "bureau", "bureau_balance")


@register("latest_child_rollup", _rollup_sql())
def latest_child_rollup(spark, sf):
    return finish(B.bureau_balance_rollup(V.bureau(spark, sf), V.bureau_balance(spark, sf)))


@register("distinct_keys", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def distinct_keys(spark, sf):
    return A.distinct_keys(V.table(spark, sf, "orders"), "o_custkey")


# ------------------------------------------------------------------ 2.4 joins

def _ins_cols():
    return OB.installment_sql()


@register("left_join_features", R(
    f"SELECT * FROM ({OB.application_sql()[0]}) AS a LEFT JOIN ({_ins_cols()[0]}) AS i USING (SK_ID_CURR)",
    OB.application_sql()[2] + _ins_cols()[2], "application", "installments"))
def left_join_features(spark, sf):
    return finish(J.left_join_all(_application(spark, sf), [_installment(spark, sf)], KEY))


@register("full_outer_blocks", R(
    f"SELECT * FROM ({OB.previous_sql()[0]}) AS p FULL JOIN ({OB.card_sql()[0]}) AS c USING (SK_ID_CURR)",
    OB.previous_sql()[2] + OB.card_sql()[2], "prev", "ccb"))
def full_outer_blocks(spark, sf):
    return finish(J.outer_join_all([_previous(spark, sf), _card(spark, sf)], KEY))


@register("inner_join_key_lift", R(
    "SELECT SK_ID_PREV, SK_ID_CURR, l_linenumber, l_partkey, l_suppkey, DAYS_INSTALMENT, AMT_INSTALMENT "
    "FROM installments", ["DAYS_INSTALMENT", "AMT_INSTALMENT"], "installments"))
def inner_join_key_lift(spark, sf):
    return finish(V.installments(spark, sf).select("SK_ID_PREV", KEY, "l_linenumber", "l_partkey", "l_suppkey",
                                                   "DAYS_INSTALMENT", "AMT_INSTALMENT"))


@register("semi_join_cascade", R(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_orderkey IN "
    "(SELECT o_orderkey FROM orders WHERE o_custkey IN "
    f"(SELECT c_custkey FROM customer WHERE c_mktsegment IS DISTINCT FROM '{V.GENDER_SENTINEL}'))",
    ["l_extendedprice"]))
def semi_join_cascade(spark, sf):
    apps = drop_sentinel(V.table(spark, sf, "customer"), "c_mktsegment", V.GENDER_SENTINEL)
    orders = J.restrict_to(V.table(spark, sf, "orders"), apps, "o_custkey", "c_custkey")
    li = J.restrict_to(V.table(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey")
    return finish(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


def _jwp_sql():
    app, _ac, ad = OB.application_sql()
    prev, pc, pdbl = OB.previous_sql()
    clash = {"AMT_CREDIT"}
    sel = ", ".join(f"{c} AS prev_{c}" if c in clash else c for c in pc)
    return R(f"SELECT * FROM ({app}) AS a LEFT JOIN (SELECT {sel} FROM ({prev}) AS p0) AS p USING (SK_ID_CURR)",
             ad + [f"prev_{c}" if c in clash else c for c in pdbl], "application", "prev")


@register("join_with_prefix", _jwp_sql())
def join_with_prefix(spark, sf):
    return finish(J.join_with_prefix(_application(spark, sf), _previous(spark, sf), KEY, "prev_", how="left"))


_SEQ_COLS = ["DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE", "DAYS_ENDDATE_FACT"]


@register("padded_sequences", R(
    f"""WITH b AS (SELECT SK_ID_CURR, SK_ID_BUREAU, DAYS_CREDIT,
                    {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS v{i}' for i, c in enumerate(_SEQ_COLS))},
                    row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT DESC NULLS LAST,
                                       SK_ID_BUREAU DESC) AS rn FROM bureau),
        slots AS (SELECT a.SK_ID_CURR, s.rn, t.j FROM application a CROSS JOIN range(1, 6) AS s(rn)
                  CROSS JOIN range(0, 4) AS t(j))
    SELECT sl.SK_ID_CURR, CAST((sl.rn - 1) * {len(_SEQ_COLS)} + sl.j AS INTEGER) AS pos,
           coalesce(CASE sl.j {' '.join(f'WHEN {i} THEN b.v{i}' for i in range(len(_SEQ_COLS)))} END,
                    CAST(-99 AS DOUBLE)) AS value
    FROM slots sl LEFT JOIN b ON b.SK_ID_CURR = sl.SK_ID_CURR AND b.rn = sl.rn""",
    ["value"], "application", "bureau"))
def padded_sequences(spark, sf):
    bureau = V.bureau(spark, sf).fillna(0, subset=_SEQ_COLS)
    seq = W.padded_sequences(V.application(spark, sf), KEY, bureau, KEY, BUR_ORDER, _SEQ_COLS, n=5, pad=-99.0)
    return finish(seq.select(KEY, F.posexplode("seq").alias("pos", "value")))


# ---------------------------------------------------------------- 2.5 windows

@register("lag_pct_change", R(_CARD_ROW_SQL + "SELECT CCB_ROW, balance_pct_change FROM rows",
                              ["balance_pct_change"], "ccb"))
def lag_pct_change(spark, sf):
    rows = B.card_rows(V.card_balance(spark, sf), tie=V.EVENT_TIE, bucket=V.card_bucket())
    return finish(rows.select("CCB_ROW", "balance_pct_change"))


def _lags_sql():
    slots = OB._slots(B.BUREAU_LAG_COLS, 4)
    sql = (f"WITH rows AS ({OB.BUREAU_ROWS}), ranked AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR "
           "ORDER BY DAYS_CREDIT DESC NULLS LAST, SK_ID_BUREAU DESC) AS rn FROM rows) "
           f"SELECT SK_ID_CURR, {', '.join(f'{e} AS {a}' for e, a in slots)} FROM ranked WHERE rn <= 4 "
           "GROUP BY SK_ID_CURR")
    return R(sql, [a for _, a in slots if not a.startswith("Defaulted")], "bureau")


@register("latest_n_wide", _lags_sql())
def latest_n_wide(spark, sf):
    rows = B.bureau_rows(V.bureau(spark, sf))
    return finish(W.latest_n_wide(rows, KEY, BUR_ORDER, B.BUREAU_LAG_COLS, n=4))


@register("latest_n_wide_skipnull", R(OB.pos_sql()[0], [], "pos"))
def latest_n_wide_skipnull(spark, sf):
    return W.latest_n_wide(V.pos_balance(spark, sf), KEY, ["MONTHS_BALANCE", "CCB_ROW"],
                           ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"], n=4, first_skips_null=True)


@register("surrogate_index", R(
    "SELECT CAST(row_number() OVER (ORDER BY " + ", ".join(LI_KEYS) + ") AS BIGINT) AS row_index, "
    + ", ".join(LI_KEYS) + " FROM lineitem", ["l_extendedprice"]))
def surrogate_index(spark, sf):
    li = V.table(spark, sf, "lineitem").select(*LI_KEYS)
    return finish(W.add_index(li, order=LI_KEYS, name="row_index"))


@register("sample_per_group", R(
    "SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey "
    f"ORDER BY {S.hash_int('o_orderkey', 1)}, o_orderkey) AS rn FROM orders) AS o WHERE rn <= 1", []))
def sample_per_group(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return W.sample_per_group(o, "o_custkey", "o_orderkey", seed=1, quota=1)


# ------------------------------------------------------- 2.6 sort, limit, split

@register("sort_report", R("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, "
                           "o_orderkey", ["o_totalprice"]))
def sort_report(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return finish(L.sort_report(o, ["o_totalprice", "o_orderkey"], ascending=[False, True]))


@register("top_n_rows", R("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 100",
                          ["c_acctbal"]))
def top_n_rows(spark, sf):
    return finish(L.head_rows(V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), 100,
                              ["c_custkey"]))


@register("hash_shuffle_sample", f"SELECT c_custkey, {S.hash_int('c_custkey', 7)} AS shuffle_key FROM customer")
def hash_shuffle_sample(spark, sf):
    return L.hash_order(V.table(spark, sf, "customer").select("c_custkey"), "c_custkey", 7)


@register("train_test_split", f"SELECT c_custkey, CAST({S.hash_int('c_custkey', 1234)} < "
                              f"{int(round(0.05 * 4294967296))} AS INTEGER) AS is_test FROM customer")
def train_test_split(spark, sf):
    return L.split_flag(V.table(spark, sf, "customer").select("c_custkey"), "c_custkey", 0.05, 1234)


@register("kfold_assign", R(
    f"SELECT SK_ID_CURR, TARGET, CAST((row_number() OVER (PARTITION BY TARGET ORDER BY "
    f"{S.hash_int('SK_ID_CURR', 1234)}, SK_ID_CURR) - 1) % 5 AS INTEGER) AS fold FROM application", [],
    "application"))
def kfold_assign(spark, sf):
    app = V.application(spark, sf).select(KEY, "TARGET")
    return L.kfold_assign(app, KEY, "TARGET", k=5, seed=1234)


# ------------------------------------------------------------- 2.7 set ops

@register("balanced_union", R(
    f"""SELECT SK_ID_CURR, TARGET FROM application WHERE TARGET = 1
        UNION ALL
        SELECT SK_ID_CURR, TARGET FROM (
          SELECT SK_ID_CURR, TARGET, row_number() OVER (ORDER BY {S.hash_int('SK_ID_CURR', 3)}, SK_ID_CURR) AS rn
          FROM application WHERE TARGET = 0) AS n
        WHERE rn <= (SELECT count(*) FROM application WHERE TARGET = 1)""", [], "application"))
def balanced_union(spark, sf):
    from loanmart.operators.resample import random_undersample
    app = V.application(spark, sf).select(KEY, "TARGET")
    return random_undersample(app, KEY, "TARGET", seed=3)


@register("class_partition", R(
    "SELECT SK_ID_CURR, TARGET, 'negative' AS part FROM application WHERE TARGET = 0 UNION ALL "
    "SELECT SK_ID_CURR, TARGET, 'positive' AS part FROM application WHERE TARGET = 1", [], "application"))
def class_partition(spark, sf):
    neg, pos = L.class_partition(V.application(spark, sf).select(KEY, "TARGET"), "TARGET")
    return L.balanced_union(neg.withColumn("part", F.lit("negative")), pos.withColumn("part", F.lit("positive")))


@register("bucketed_previous_block", R(OB.previous_sql()[0], OB.previous_sql()[2], "prev"))
def bucketed_previous_block(spark, sf):
    """E1 over a copy of the previous-application view bucketed by the
    applicant key: the block aggregate needs no exchange."""
    prev = write_bucketed(V.previous(spark, sf), KEY, name="prev_by_applicant")
    return finish(B.previous_block(prev, V.PREV_SPEC))
