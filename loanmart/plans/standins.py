"""Credit-table views over the driver's tables.

The eight credit tables are not part of the test data, so each is derived
from a driver table with a fixed, documented mapping; the oracle SQL in
``oracles.py`` builds the identical views.  Null paths (missing amounts,
payment days, limits) are made from data values, never from row positions.

| credit table          | driver table(s)              |
| application           | customer                     |
| previous_application  | orders                       |
| bureau                | orders                       |
| bureau_balance        | lineitem                     |
| installments_payments | lineitem ⋈ orders (key lift) |
| credit_card_balance   | events                       |
| POS_CASH_balance      | events                       |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators.joins import lift_key
from loanmart.plans.blocks import BureauSpec, PreviousSpec
from loanmart.sources.io import read_table

# Fixed values of the stand-in mapping (shared with the oracle SQL).
ORDERS_REF_DAY = "2001-08-02"
EVENTS_REF_DAY = "2024-01-31"
GENDER_SENTINEL = "HOUSEHOLD"
EMPLOYED_SENTINEL = 0.0
PREV_SPEC = PreviousSpec(
    approved="F",
    statuses={"F": "f", "O": "o", "P": "p"},
    types={"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"},
    approved_cols=("NAME_CONTRACT_TYPE", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT"),
)
BUREAU_SPEC = BureauSpec(
    credit_types={"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "notspecified"},
    credit_card="5-LOW",
)
LINEITEM_TIE = ("SK_ID_PREV", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
EVENT_TIE = ("CCB_ROW",)


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per (session, table): the file listing and footer read
    happen once however many blocks use the table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = read_table(spark, path)
    return _TABLES[key]


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        F.col("c_mktsegment").alias("CODE_GENDER"),
        F.col("c_nationkey").cast("double").alias("DAYS_EMPLOYED"),
        (-F.col("c_custkey")).cast("double").alias("DAYS_BIRTH"),
        F.col("c_acctbal").alias("AMT_CREDIT"),
        (F.col("c_nationkey") * 1000).cast("double").alias("AMT_INCOME_TOTAL"),
        (F.abs(F.col("c_acctbal")) / 12).alias("AMT_ANNUITY"),
        (F.col("c_custkey") % 4).cast("double").alias("CNT_FAM_MEMBERS"),
    )


def _order_days(col: str, ref: str):
    return F.datediff(F.col(col), F.lit(ref).cast("date")).cast("int")


def previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        _order_days("o_orderdate", ORDERS_REF_DAY).alias("DAYS_DECISION"),
        F.col("o_orderstatus").alias("NAME_CONTRACT_STATUS"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("AMT_CREDIT"),
        F.col("o_totalprice").alias("AMT_APPLICATION"),
        (F.col("o_totalprice") * 0.1).alias("AMT_DOWN_PAYMENT"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    days = _order_days("o_orderdate", ORDERS_REF_DAY).cast("double")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("SK_ID_BUREAU"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        days.alias("DAYS_CREDIT"),
        (days + (key % 50) - 10).cast("double").alias("DAYS_CREDIT_ENDDATE"),
        F.when(F.col("o_orderstatus") != "O", days + (key % 30)).cast("double").alias("DAYS_ENDDATE_FACT"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("AMT_CREDIT_SUM_DEBT"),
        (F.col("o_totalprice") * 0.01).alias("AMT_CREDIT_SUM_OVERDUE"),
        (F.col("o_totalprice") * 0.02).alias("AMT_CREDIT_MAX_OVERDUE"),
        (key % 400).cast("int").alias("CREDIT_DAY_OVERDUE"),
        F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Active")
         .otherwise("Sold").alias("CREDIT_ACTIVE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    status = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "C")
               .when(F.col("l_returnflag") == "R", "X")
               .otherwise(((F.col("l_linenumber") - 1) % 6).cast("string")))
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).cast("int").alias("MONTHS_BALANCE"),
        status.alias("STATUS"),
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    days = _order_days("l_shipdate", ORDERS_REF_DAY).cast("double")
    rows = li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        days.alias("DAYS_INSTALMENT"),
        F.when(F.col("l_tax") != 0, days + F.col("l_linenumber") - 4).cast("double").alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice") * (1 - F.col("l_discount")))
         .alias("AMT_PAYMENT"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
    )
    prev = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("SK_ID_PREV"),
                                                 F.col("o_custkey").alias("SK_ID_CURR"))
    return lift_key(rows, prev, "SK_ID_PREV", ["SK_ID_CURR"])


def _event_months():
    return (-F.datediff(F.lit(EVENTS_REF_DAY).cast("date"), F.col("ts"))).cast("int")


def card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("SK_ID_CURR"),
        (F.col("user_id") * 10 + F.col("event_id") % 3).alias("SK_ID_PREV"),
        F.col("event_id").alias("CCB_ROW"),
        _event_months().alias("MONTHS_BALANCE"),
        F.col("value").alias("AMT_BALANCE"),
        F.when(et == "error", F.lit(None).cast("double")).when(et == "view", F.lit(0.0)).otherwise(F.lit(100.0))
         .alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.when(et != "signup", F.col("value") * 0.5).alias("AMT_PAYMENT_CURRENT"),
        F.lit(20.0).alias("AMT_INST_MIN_REGULARITY"),
    )


def pos_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("SK_ID_CURR"),
        (F.col("user_id") * 10 + F.col("event_id") % 3).alias("SK_ID_PREV"),
        F.col("event_id").alias("CCB_ROW"),
        _event_months().alias("MONTHS_BALANCE"),
        F.when(F.col("event_type") != "error", F.floor(F.col("value")).cast("int")).alias("SK_DPD"),
        F.floor(F.col("value") / 10).cast("int").alias("SK_DPD_DEF"),
    )


def card_bucket():
    """Order bucket for the skew-safe lag: weeks of the month index."""
    return F.floor(F.col("MONTHS_BALANCE") / 7)
