"""DuckDB oracle SQL for the feature blocks on the stand-in views.

Each builder returns ``(sql, columns, double_columns)`` so the mart can
prefix and round without guessing types.  The SQL is written directly (window
+ GROUP BY), independent of the DataFrame code it checks.
"""

from __future__ import annotations

from loanmart.plans import sqlkit as S
from loanmart.plans.blocks import (
    BUREAU_BY_TYPE,
    BUREAU_LAG_COLS,
    BUREAU_TOTALS,
    STATUS_LEVELS,
)
from loanmart.plans.standins import BUREAU_SPEC, EMPLOYED_SENTINEL, GENDER_SENTINEL, LINEITEM_TIE, PREV_SPEC

KEY = "SK_ID_CURR"
INTEGRAL = {"Defaulted", "CREDIT_ACTIVE", "insta_delinquency", "has_cc_now", "times_bal80"}


def application_sql() -> tuple[str, list[str], list[str]]:
    base = ["SK_ID_CURR", "TARGET", "CODE_GENDER", "DAYS_EMPLOYED", "DAYS_BIRTH", "AMT_CREDIT",
            "AMT_INCOME_TOTAL", "AMT_ANNUITY", "CNT_FAM_MEMBERS"]
    ratios = {
        "Days_employed_age": S.safe_div("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "Credit_income_ratio": S.safe_div("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "Anuity_income_ratio": S.safe_div("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "Income_per_person": S.safe_div("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "Credit_term": S.safe_div("AMT_ANNUITY", "AMT_CREDIT"),
    }
    cleaned = (f"SELECT * REPLACE (NULLIF(DAYS_EMPLOYED, {EMPLOYED_SENTINEL}) AS DAYS_EMPLOYED) FROM application "
               f"WHERE CODE_GENDER IS DISTINCT FROM '{GENDER_SENTINEL}'")
    sql = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in ratios.items())} FROM ({cleaned}) AS a"
    doubles = ["DAYS_EMPLOYED", "DAYS_BIRTH", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "CNT_FAM_MEMBERS",
               *ratios]
    return sql, base + list(ratios), doubles


def previous_sql() -> tuple[str, list[str], list[str]]:
    spec = PREV_SPEC
    order = ["DAYS_DECISION", "SK_ID_PREV"]
    appr = f"NAME_CONTRACT_STATUS = '{spec.approved}'"
    cols, exprs = [], []
    for c in ("DAYS_DECISION", "NAME_CONTRACT_STATUS", "AMT_CREDIT"):
        exprs.append(f"{S.latest(c, order)} AS {c}")
        cols.append(c)
    for c in spec.approved_cols:
        exprs.append(f"{S.latest(c, order, appr)} AS approved_{c}")
        cols.append(f"approved_{c}")
    for v, name in spec.statuses.items():
        exprs.append(f"CAST(NULLIF(count(*) FILTER (WHERE NAME_CONTRACT_STATUS = '{v}'), 0) AS DOUBLE)"
                     f" / NULLIF(count(NAME_CONTRACT_STATUS), 0) AS ratio_{name}")
        cols.append(f"ratio_{name}")
    for v, name in spec.types.items():
        cond = f"{appr} AND NAME_CONTRACT_TYPE = '{v}'"
        exprs.append(f"{S.latest('DAYS_DECISION', order, cond)} AS Days_{name}")
        exprs.append(f"{S.latest('AMT_CREDIT', order, cond)} AS AMT_credit_{name}")
        cols += [f"Days_{name}", f"AMT_credit_{name}"]
    inner = f"SELECT {KEY}, {', '.join(exprs)} FROM prev WHERE {KEY} IS NOT NULL GROUP BY {KEY}"
    sql = f"SELECT *, approved_AMT_APPLICATION - approved_AMT_CREDIT AS Diff_applied_apprved FROM ({inner}) AS p"
    cols.append("Diff_applied_apprved")
    doubles = ["AMT_CREDIT", "approved_AMT_APPLICATION", "approved_AMT_CREDIT", "approved_AMT_DOWN_PAYMENT",
               *[f"ratio_{n}" for n in spec.statuses.values()],
               *[f"AMT_credit_{n}" for n in spec.types.values()], "Diff_applied_apprved"]
    return sql, [KEY, *cols], doubles


def _slots(cols, n, rn="rn"):
    return [(f"max(CASE WHEN {rn} = {i + 1} THEN {c} END)", f"{c}{i}") for i in range(n) for c in cols]


CARD_ROWS = """
    SELECT *, has_cc_now * AMT_BALANCE AS balance_now,
           CASE WHEN prev_bal + 1 = 0 AND AMT_BALANCE - prev_bal > 0 THEN 30.0
                WHEN (AMT_BALANCE - prev_bal) / NULLIF(prev_bal + 1, 0) > 30 THEN 30.0
                ELSE (AMT_BALANCE - prev_bal) / NULLIF(prev_bal + 1, 0) END AS balance_pct_change
    FROM (
      SELECT *,
             CASE WHEN AMT_BALANCE > AMT_CREDIT_LIMIT_ACTUAL THEN 1 ELSE 0 END AS Beyond_limit,
             CASE WHEN AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY THEN 1 ELSE 0 END AS Delinquent,
             CASE WHEN (CASE WHEN AMT_CREDIT_LIMIT_ACTUAL = 0 THEN AMT_BALANCE > 0
                             ELSE AMT_BALANCE / NULLIF(AMT_CREDIT_LIMIT_ACTUAL, 0) >= 0.8 END)
                  THEN 1 ELSE 0 END AS times_bal80,
             CASE WHEN MONTHS_BALANCE = -1 THEN 1 ELSE 0 END AS has_cc_now,
             LAG(AMT_BALANCE) OVER (PARTITION BY SK_ID_PREV ORDER BY MONTHS_BALANCE, CCB_ROW) AS prev_bal
      FROM ccb) AS c0"""


def card_sql(n: int = 4) -> tuple[str, list[str], list[str]]:
    lag_cols = ["MONTHS_BALANCE", "Beyond_limit", "Delinquent", "balance_pct_change"]
    slots = _slots(lag_cols, n)
    sql = f"""
    WITH rows AS ({CARD_ROWS}),
    sums AS (SELECT {KEY}, CAST(coalesce(sum(has_cc_now), 0) AS BIGINT) AS has_cc_now,
                    coalesce(sum(balance_now), 0) AS balance_now,
                    CAST(coalesce(sum(times_bal80), 0) AS BIGINT) AS times_bal80
             FROM rows GROUP BY {KEY}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEY}
                                             ORDER BY MONTHS_BALANCE DESC NULLS LAST, CCB_ROW DESC) AS rn
               FROM rows),
    lags AS (SELECT {KEY}, {', '.join(f'{e} AS {a}' for e, a in slots)} FROM ranked WHERE rn <= {n} GROUP BY {KEY})
    SELECT * FROM sums FULL JOIN lags USING ({KEY})"""
    cols = [KEY, "has_cc_now", "balance_now", "times_bal80", *[a for _, a in slots]]
    doubles = ["balance_now", *[f"balance_pct_change{i}" for i in range(n)]]
    return sql, cols, doubles


def installment_sql() -> tuple[str, list[str], list[str]]:
    order = ["DAYS_INSTALMENT", *LINEITEM_TIE]
    spec = [("DAYS_INSTALMENT", "first"), ("insta_debt", "sum"), ("insta_debt", "mean"), ("insta_debt", "first"),
            ("insta_delinquency", "sum"), ("insta_delinquency", "first")]
    exprs = [f"{S.agg(c, fn, order, integral=c in INTEGRAL)} AS {c}_{fn}" for c, fn in spec]
    sql = f"""
    SELECT {KEY}, {', '.join(exprs)}
    FROM (SELECT *, CASE WHEN DAYS_INSTALMENT >= DAYS_ENTRY_PAYMENT THEN 0 ELSE 1 END AS insta_delinquency,
                 AMT_INSTALMENT - AMT_PAYMENT AS insta_debt
          FROM installments) AS i
    GROUP BY {KEY}"""
    cols = [KEY, *[f"{c}_{fn}" for c, fn in spec]]
    doubles = ["DAYS_INSTALMENT_first", "insta_debt_sum", "insta_debt_mean", "insta_debt_first"]
    return sql, cols, doubles


def pos_sql(n: int = 4) -> tuple[str, list[str], list[str]]:
    cols = ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"]
    order = ["MONTHS_BALANCE", "CCB_ROW"]
    first = [(S.latest(c, order), f"{c}0") for c in cols]
    slots = [(e, a) for e, a in _slots(cols, n) if not a.endswith("0")]
    sql = f"""
    WITH f AS (SELECT {KEY}, {', '.join(f'{e} AS {a}' for e, a in first)} FROM pos GROUP BY {KEY}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEY}
                                             ORDER BY MONTHS_BALANCE DESC NULLS LAST, CCB_ROW DESC) AS rn
               FROM pos),
    s AS (SELECT {KEY}, {', '.join(f'{e} AS {a}' for e, a in slots)} FROM ranked WHERE rn <= {n} GROUP BY {KEY})
    SELECT * FROM f FULL JOIN s USING ({KEY})"""
    out = [KEY, *[f"{c}{i}" for i in range(n) for c in cols]]
    return sql, out, []


BUREAU_ROWS = """
    SELECT *, Defaulted * AMT_CREDIT_SUM_DEBT AS AMT_defaulted
    FROM (
      SELECT * REPLACE (CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 WHEN CREDIT_ACTIVE = 'Active' THEN 1 END
                        AS CREDIT_ACTIVE),
             DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT AS Days_early_paidoff,
             DAYS_ENDDATE_FACT - DAYS_CREDIT AS Duration_real,
             CASE WHEN DAYS_CREDIT_ENDDATE - DAYS_CREDIT = 0 THEN 1 ELSE DAYS_CREDIT_ENDDATE - DAYS_CREDIT END
                 AS Duration_planned,
             AMT_CREDIT_SUM_DEBT / NULLIF(CASE WHEN DAYS_CREDIT_ENDDATE - DAYS_CREDIT = 0 THEN 1
                                               ELSE DAYS_CREDIT_ENDDATE - DAYS_CREDIT END, 0)
                 AS AMT_weightdebt_duration,
             AMT_CREDIT_SUM_OVERDUE / NULLIF(CASE WHEN DAYS_CREDIT_ENDDATE - DAYS_CREDIT = 0 THEN 1
                                                  ELSE DAYS_CREDIT_ENDDATE - DAYS_CREDIT END, 0)
                 AS AMT_Overdue_duration,
             AMT_CREDIT_MAX_OVERDUE / NULLIF(CASE WHEN DAYS_CREDIT_ENDDATE - DAYS_CREDIT = 0 THEN 1
                                                  ELSE DAYS_CREDIT_ENDDATE - DAYS_CREDIT END, 0)
                 AS AMT_Maxoverdue_duration,
             CASE WHEN CREDIT_DAY_OVERDUE > 270 THEN 1 ELSE 0 END AS Defaulted
      FROM bureau) AS b0"""


def bureau_stats_parts() -> tuple[list[str], list[str], list[str]]:
    order = ["DAYS_CREDIT", "SK_ID_BUREAU"]
    exprs, cols, doubles = [], [], []
    for c, fns in BUREAU_TOTALS.items():
        for fn in fns:
            exprs.append(f"{S.agg(c, fn, order, integral=c in INTEGRAL)} AS {c}_{fn}")
            cols.append(f"{c}_{fn}")
            if fn == "mean" or (fn == "sum" and c not in INTEGRAL):
                doubles.append(f"{c}_{fn}")
    for v, label in BUREAU_SPEC.credit_types.items():
        cond = f"CREDIT_TYPE = '{v}'"
        present = f"count(*) FILTER (WHERE {cond}) > 0"
        for c, fns in BUREAU_BY_TYPE.items():
            for fn in fns:
                name = f"{c}_{fn}_{label}"
                exprs.append(f"CASE WHEN {present} THEN {S.agg(c, fn, order, cond, integral=c in INTEGRAL)} END "
                             f"AS {name}")
                cols.append(name)
                if c in ("DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT", "AMT_defaulted") and fn != "count":
                    doubles.append(name)
    card = f"CREDIT_TYPE = '{BUREAU_SPEC.credit_card}'"
    for fn in ("count", "sum", "mean", "first"):
        name = f"card_AMT_CREDIT_SUM_DEBT_{fn}"
        exprs.append(f"CASE WHEN count(*) FILTER (WHERE {card}) > 0 THEN "
                     f"{S.agg('AMT_CREDIT_SUM_DEBT', fn, order, card)} END AS {name}")
        cols.append(name)
        if fn != "count":
            doubles.append(name)
    return exprs, cols, doubles


BALANCE_ROLLUP = """
    per_credit AS (
      SELECT m.SK_ID_BUREAU, m.Months_latest_open, m.Months_latest_delin, {ratio_cols}
      FROM (SELECT SK_ID_BUREAU,
                   max(CASE WHEN STATUS = '0' THEN MONTHS_BALANCE END) AS Months_latest_open,
                   max(CASE WHEN STATUS = '1' THEN MONTHS_BALANCE END) AS Months_latest_delin
            FROM bureau_balance WHERE STATUS IN ('0', '1') GROUP BY SK_ID_BUREAU
            HAVING count(*) FILTER (WHERE STATUS = '0') > 0) AS m
      JOIN (SELECT SK_ID_BUREAU, {ratio_exprs}
            FROM bureau_balance WHERE STATUS IS DISTINCT FROM 'X' AND STATUS IS DISTINCT FROM 'C'
            GROUP BY SK_ID_BUREAU) AS r ON m.SK_ID_BUREAU = r.SK_ID_BUREAU),
    rollup AS (
      SELECT b.SK_ID_CURR, {latest_cols}
      FROM bureau b JOIN per_credit p ON b.SK_ID_BUREAU = p.SK_ID_BUREAU
      GROUP BY b.SK_ID_CURR)"""


def balance_rollup_cte() -> tuple[str, list[str], list[str]]:
    ratio_names = [f"STATUS_{s}" for s in STATUS_LEVELS]
    ratio_exprs = ", ".join(f"avg(CASE WHEN STATUS = '{s}' THEN 1.0 ELSE 0.0 END) AS STATUS_{s}"
                            for s in STATUS_LEVELS)
    cols = ["Months_latest_open", "Months_latest_delin", *ratio_names]
    order = ["p.Months_latest_open", "p.SK_ID_BUREAU"]
    latest_cols = ", ".join(f"{S.latest('p.' + c, order)} AS {c}" for c in cols)
    cte = BALANCE_ROLLUP.format(ratio_cols=", ".join(f"r.{c}" for c in ratio_names), ratio_exprs=ratio_exprs,
                                latest_cols=latest_cols)
    return cte, cols, ratio_names


def bureau_sql(n: int = 4, with_balance: bool = True) -> tuple[str, list[str], list[str]]:
    exprs, stat_cols, doubles = bureau_stats_parts()
    slots = _slots(BUREAU_LAG_COLS, n)
    lag_doubles = [a for _, a in slots if not a.startswith("Defaulted")]
    ctes = [f"rows AS ({BUREAU_ROWS})",
            f"stats AS (SELECT {KEY}, {', '.join(exprs)} FROM rows GROUP BY {KEY})",
            f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEY}
                                    ORDER BY DAYS_CREDIT DESC NULLS LAST, SK_ID_BUREAU DESC) AS rn FROM rows)""",
            f"lags AS (SELECT {KEY}, {', '.join(f'{e} AS {a}' for e, a in slots)} FROM ranked WHERE rn <= {n} "
            f"GROUP BY {KEY})"]
    cols = [KEY, *stat_cols, *[a for _, a in slots]]
    body = f"SELECT * FROM stats FULL JOIN lags USING ({KEY})"
    if with_balance:
        cte, bcols, bdoubles = balance_rollup_cte()
        ctes.append(cte.strip())
        body = f"SELECT * FROM stats FULL JOIN lags USING ({KEY}) FULL JOIN rollup USING ({KEY})"
        cols += bcols
        doubles += bdoubles
    sql = "WITH " + ",\n".join(ctes) + "\n" + body
    return sql, cols, doubles + lag_doubles


def prefixed(sql: str, cols: list[str], prefix: str) -> str:
    sel = ", ".join(c if c == KEY else f"{S.q(c)} AS {S.q(prefix + c)}" for c in cols)
    return f"SELECT {sel} FROM ({sql}) AS _p"


def mart_sql() -> tuple[str, list[str], list[str]]:
    app, app_cols, app_d = application_sql()
    bur, bur_cols, bur_d = bureau_sql()
    parts = [("prev_", previous_sql()), ("cc_", card_sql()), ("ins_", installment_sql()), ("pos_", pos_sql())]
    hist = None
    cols = list(app_cols) + [f"bur_{c}" for c in bur_cols if c != KEY]
    doubles = list(app_d) + [f"bur_{c}" for c in bur_d]
    for prefix, (sql, c, d) in parts:
        p = f"({prefixed(sql, c, prefix)})"
        hist = p if hist is None else f"{hist} FULL JOIN {p} USING ({KEY})"
        cols += [f"{prefix}{x}" for x in c if x != KEY]
        doubles += [f"{prefix}{x}" for x in d]
    body = (f"SELECT * FROM ({app}) AS a LEFT JOIN ({prefixed(bur, bur_cols, 'bur_')}) AS b USING ({KEY}) "
            f"LEFT JOIN (SELECT * FROM {hist}) AS h USING ({KEY})")
    return body, cols, doubles
