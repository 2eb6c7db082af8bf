"""DuckDB SQL for the credit-table stand-in views (mirror of standins.py)."""

from __future__ import annotations

from loanmart.plans.standins import EVENTS_REF_DAY, ORDERS_REF_DAY

_ODAYS = "CAST(date_diff('day', DATE '{ref}', CAST({col} AS DATE)) AS INTEGER)"


def _odays(col: str) -> str:
    return _ODAYS.format(ref=ORDERS_REF_DAY, col=col)


_EMONTHS = f"CAST(-date_diff('day', CAST(ts AS DATE), DATE '{EVENTS_REF_DAY}') AS INTEGER)"

VIEWS = {
    "application": """
        SELECT c_custkey AS SK_ID_CURR, CAST(c_acctbal < 0 AS INTEGER) AS TARGET, c_mktsegment AS CODE_GENDER,
               CAST(c_nationkey AS DOUBLE) AS DAYS_EMPLOYED, CAST(-c_custkey AS DOUBLE) AS DAYS_BIRTH,
               c_acctbal AS AMT_CREDIT, CAST(c_nationkey * 1000 AS DOUBLE) AS AMT_INCOME_TOTAL,
               abs(c_acctbal) / 12 AS AMT_ANNUITY, CAST(c_custkey % 4 AS DOUBLE) AS CNT_FAM_MEMBERS
        FROM customer""",
    "prev": f"""
        SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, {_odays('o_orderdate')} AS DAYS_DECISION,
               o_orderstatus AS NAME_CONTRACT_STATUS, o_orderpriority AS NAME_CONTRACT_TYPE,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS AMT_CREDIT,
               o_totalprice AS AMT_APPLICATION, o_totalprice * 0.1 AS AMT_DOWN_PAYMENT
        FROM orders""",
    "bureau": f"""
        SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
               CAST({_odays('o_orderdate')} AS DOUBLE) AS DAYS_CREDIT,
               CAST({_odays('o_orderdate')} + (o_orderkey % 50) - 10 AS DOUBLE) AS DAYS_CREDIT_ENDDATE,
               CAST(CASE WHEN o_orderstatus <> 'O' THEN {_odays('o_orderdate')} + (o_orderkey % 30) END AS DOUBLE)
                   AS DAYS_ENDDATE_FACT,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS AMT_CREDIT_SUM_DEBT,
               o_totalprice * 0.01 AS AMT_CREDIT_SUM_OVERDUE, o_totalprice * 0.02 AS AMT_CREDIT_MAX_OVERDUE,
               CAST(o_orderkey % 400 AS INTEGER) AS CREDIT_DAY_OVERDUE,
               CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Sold' END
                   AS CREDIT_ACTIVE,
               o_orderpriority AS CREDIT_TYPE
        FROM orders""",
    "bureau_balance": """
        SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS INTEGER) AS MONTHS_BALANCE,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'C' WHEN l_returnflag = 'R' THEN 'X'
                    ELSE CAST((l_linenumber - 1) % 6 AS VARCHAR) END AS STATUS
        FROM lineitem""",
    "installments": f"""
        SELECT l.l_orderkey AS SK_ID_PREV, o.o_custkey AS SK_ID_CURR,
               CAST({_odays('l.l_shipdate')} AS DOUBLE) AS DAYS_INSTALMENT,
               CAST(CASE WHEN l.l_tax <> 0 THEN {_odays('l.l_shipdate')} + l.l_linenumber - 4 END AS DOUBLE)
                   AS DAYS_ENTRY_PAYMENT,
               l.l_extendedprice AS AMT_INSTALMENT,
               CASE WHEN l.l_discount <> 0 THEN l.l_extendedprice * (1 - l.l_discount) END AS AMT_PAYMENT,
               l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "ccb": f"""
        SELECT user_id AS SK_ID_CURR, user_id * 10 + event_id % 3 AS SK_ID_PREV, event_id AS CCB_ROW,
               {_EMONTHS} AS MONTHS_BALANCE, value AS AMT_BALANCE,
               CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(100.0 AS DOUBLE) END
                   AS AMT_CREDIT_LIMIT_ACTUAL,
               CASE WHEN event_type <> 'signup' THEN value * 0.5 END AS AMT_PAYMENT_CURRENT,
               CAST(20.0 AS DOUBLE) AS AMT_INST_MIN_REGULARITY
        FROM events""",
    "pos": f"""
        SELECT user_id AS SK_ID_CURR, user_id * 10 + event_id % 3 AS SK_ID_PREV, event_id AS CCB_ROW,
               {_EMONTHS} AS MONTHS_BALANCE,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INTEGER) END AS SK_DPD,
               CAST(floor(value / 10) AS INTEGER) AS SK_DPD_DEF
        FROM events""",
}


def with_views(body: str, *names: str) -> str:
    """``WITH`` clause declaring the named stand-in views before ``body``."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    return f"WITH {ctes}\n{body}"
