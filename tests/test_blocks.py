"""Hand fixtures on the credit schemas, one per null/tie/division rule."""

import math

import pytest

from loanmart.plans import blocks as B
from tests.conftest import rows

APP = ("SK_ID_CURR bigint, TARGET int, CODE_GENDER string, DAYS_EMPLOYED double, DAYS_BIRTH double, "
       "AMT_CREDIT double, AMT_INCOME_TOTAL double, AMT_ANNUITY double, CNT_FAM_MEMBERS double")


def test_application_small(spark):
    app = spark.createDataFrame([
        (1, 0, "F", -1000.0, -10000.0, 200.0, 100.0, 20.0, 2.0),
        (2, 0, "XNA", -1000.0, -10000.0, 200.0, 100.0, 20.0, 2.0),
        (3, 1, None, -500.0, -10000.0, 300.0, 100.0, 30.0, 1.0),
        (4, 0, "M", 365243.0, -20000.0, 400.0, 0.0, 40.0, 0.0),
    ], APP)
    out = {r["SK_ID_CURR"]: r for r in rows(B.application_features(app))}
    assert sorted(out) == [1, 3, 4]                       # XNA dropped, missing gender kept
    assert out[1]["Days_employed_age"] == pytest.approx(0.1)
    assert out[1]["Credit_term"] == pytest.approx(0.1)
    assert out[4]["DAYS_EMPLOYED"] is None                # sentinel -> missing
    assert out[4]["Days_employed_age"] is None
    assert out[4]["Credit_income_ratio"] is None          # division by zero -> missing
    assert out[4]["Income_per_person"] is None
    scoring = rows(B.application_features(app, clean=False), ["SK_ID_CURR"])
    assert len(scoring) == 4 and scoring[3]["DAYS_EMPLOYED"] == 365243.0


PREV = ("SK_ID_PREV bigint, SK_ID_CURR bigint, DAYS_DECISION int, NAME_CONTRACT_STATUS string, "
        "NAME_CONTRACT_TYPE string, AMT_APPLICATION double, AMT_CREDIT double, AMT_DOWN_PAYMENT double, "
        "NAME_YIELD_GROUP string, NFLAG_INSURED_ON_APPROVAL double, RATE_INTEREST_PRIMARY double, "
        "RATE_INTEREST_PRIVILEGED double")


def test_previous_small(spark):
    prev = spark.createDataFrame([
        # applicant 1: newest row has no credit amount -> older 100 is "first"
        (10, 1, -5, "Approved", "Cash loans", 120.0, None, None, "high", 1.0, None, None),
        (11, 1, -9, "Approved", "Consumer loans", 90.0, 100.0, 5.0, None, None, 0.1, None),
        (12, 1, -20, "Refused", "Cash loans", 50.0, 50.0, None, None, None, None, None),
        # applicant 2: only refused
        (20, 2, -3, "Refused", "Cash loans", 10.0, 10.0, None, None, None, None, None),
    ], PREV)
    out = {r["SK_ID_CURR"]: r for r in rows(B.previous_block(prev))}
    a = out[1]
    assert a["DAYS_DECISION"] == -5 and a["NAME_CONTRACT_STATUS"] == "Approved"
    assert a["AMT_CREDIT"] == 100.0                       # skip-null first
    # composite approved row: type/application from -5, credit/down payment from -9
    assert a["approved_NAME_CONTRACT_TYPE"] == "Cash loans"
    assert a["approved_AMT_APPLICATION"] == 120.0 and a["approved_AMT_CREDIT"] == 100.0
    assert a["approved_AMT_DOWN_PAYMENT"] == 5.0 and a["approved_RATE_INTEREST_PRIMARY"] == 0.1
    assert a["Diff_applied_apprved"] == 20.0
    assert a["ratio_approved"] == pytest.approx(2 / 3) and a["ratio_refused"] == pytest.approx(1 / 3)
    assert a["ratio_canceled"] is None                    # absent status -> missing, not 0
    assert a["Days_consumerloans"] == -9 and a["AMT_credit_consumerloans"] == 100.0
    assert a["Days_cashloans"] == -5 and a["AMT_credit_cashloans"] is None
    b = out[2]
    assert b["ratio_refused"] == 1.0 and b["ratio_approved"] is None
    assert b["approved_AMT_CREDIT"] is None and b["Days_cashloans"] is None


CCB = ("SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE int, AMT_BALANCE double, "
       "AMT_CREDIT_LIMIT_ACTUAL double, AMT_PAYMENT_CURRENT double, AMT_INST_MIN_REGULARITY double")


def test_card_small(spark):
    ccb = spark.createDataFrame([
        (100, 1, -3, 0.0, 10.0, 5.0, 1.0),
        (100, 1, -2, 50.0, 0.0, 5.0, 10.0),   # limit 0 with balance 50: high usage
        (100, 1, -1, 40.0, None, None, 1.0),  # missing limit: not high usage; missing payment: not late
        (200, 2, -2, -1.0, 10.0, 1.0, 1.0),
        (200, 2, -1, 5.0, 0.0, 1.0, 1.0),     # previous balance -1: +inf capped to 30
        (300, 3, -1, 0.0, 0.0, 1.0, 1.0),     # 0/0 usage -> 0
    ], CCB)
    pct = {(r["SK_ID_PREV"], r["MONTHS_BALANCE"]): r["balance_pct_change"]
           for r in rows(B.card_rows(ccb, bucket=None))}
    assert pct[(100, -3)] is None
    assert pct[(100, -2)] == 30.0                         # 50 / 1 capped
    assert pct[(100, -1)] == pytest.approx(-10 / 51)
    assert pct[(200, -1)] == 30.0
    from pyspark.sql import functions as F
    bucketed = {(r["SK_ID_PREV"], r["MONTHS_BALANCE"]): r["balance_pct_change"]
                for r in rows(B.card_rows(ccb, bucket=F.floor(F.col("MONTHS_BALANCE") / 2)))}
    assert bucketed == pct                                # skew-safe lag gives the same values
    out = {r["SK_ID_CURR"]: r for r in rows(B.card_block(ccb))}
    assert out[1]["times_bal80"] == 1 and out[2]["times_bal80"] == 1 and out[3]["times_bal80"] == 0
    assert out[1]["has_cc_now"] == 1 and out[1]["balance_now"] == 40.0
    assert out[1]["MONTHS_BALANCE0"] == -1 and out[1]["MONTHS_BALANCE2"] == -3 and out[1]["MONTHS_BALANCE3"] is None
    assert out[1]["Beyond_limit1"] == 1 and out[1]["Delinquent0"] == 0


INST = ("SK_ID_PREV bigint, SK_ID_CURR bigint, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, "
        "AMT_INSTALMENT double, AMT_PAYMENT double")


def test_installment_small(spark):
    inst = spark.createDataFrame([
        (1, 1, -10.0, -12.0, 100.0, 100.0),   # early -> 0
        (1, 1, -20.0, -15.0, 100.0, 60.0),    # late -> 1
        (1, 1, -30.0, None, 100.0, None),     # never paid -> late, debt missing
        (2, 2, -5.0, None, 10.0, None),
    ], INST)
    out = {r["SK_ID_CURR"]: r for r in rows(B.installment_block(inst))}
    assert out[1]["DAYS_INSTALMENT_first"] == -10.0
    assert out[1]["insta_delinquency_sum"] == 2 and out[1]["insta_delinquency_first"] == 0
    assert out[1]["insta_debt_sum"] == 40.0 and out[1]["insta_debt_mean"] == 20.0
    assert out[1]["insta_debt_first"] == 0.0
    assert out[2]["insta_debt_sum"] == 0.0 and out[2]["insta_debt_mean"] is None   # sum of none = 0


def test_pos_small(spark):
    pos = spark.createDataFrame([(1, 1, -1, None, 0), (1, 1, -2, 7, 1)],
                                "SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE int, SK_DPD int, SK_DPD_DEF int")
    r = rows(B.pos_block(pos))[0]
    assert r["MONTHS_BALANCE0"] == -1 and r["SK_DPD0"] == 7    # slot 0 skips missing
    assert r["SK_DPD1"] == 7 and r["MONTHS_BALANCE1"] == -2    # later slots do not
    assert r["SK_DPD2"] is None and r["MONTHS_BALANCE3"] is None


BUR = ("SK_ID_BUREAU bigint, SK_ID_CURR bigint, DAYS_CREDIT double, DAYS_CREDIT_ENDDATE double, "
       "DAYS_ENDDATE_FACT double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, "
       "AMT_CREDIT_MAX_OVERDUE double, CREDIT_DAY_OVERDUE int, CREDIT_ACTIVE string, CREDIT_TYPE string")
BAL = "SK_ID_BUREAU bigint, MONTHS_BALANCE int, STATUS string"


def test_bureau_small(spark):
    bureau = spark.createDataFrame([
        (1, 1, -100.0, -100.0, -90.0, 50.0, 5.0, 7.0, 271, "Active", "Car loan"),     # planned 0 -> 1
        (2, 1, -200.0, -100.0, None, 30.0, None, None, 270, "Sold", "Credit card"),
        (3, 2, -50.0, 10.0, None, None, None, None, 0, "Closed", "Mortgage"),
    ], BUR)
    balance = spark.createDataFrame([
        (1, -3, "0"), (1, 0, "1"), (1, -1, "C"), (1, -2, "X"), (1, -5, "0"),
        (2, 0, "C"), (2, -1, "C"),
        (3, -4, "0"), (3, -2, "2"),
    ], BAL)
    r = {x["SK_ID_BUREAU"]: x for x in rows(B.bureau_rows(bureau))}
    assert r[1]["Duration_planned"] == 1.0 and r[1]["AMT_weightdebt_duration"] == 50.0
    assert r[1]["Defaulted"] == 1 and r[2]["Defaulted"] == 0 and r[1]["AMT_defaulted"] == 50.0
    assert r[1]["CREDIT_ACTIVE"] == 1 and r[2]["CREDIT_ACTIVE"] is None and r[3]["CREDIT_ACTIVE"] == 0
    out = {x["SK_ID_CURR"]: x for x in rows(B.bureau_block(bureau, balance))}
    a, b = out[1], out[2]
    assert a["AMT_CREDIT_SUM_DEBT_count"] == 2 and a["AMT_CREDIT_SUM_DEBT_sum"] == 80.0
    assert b["AMT_CREDIT_SUM_DEBT_count"] == 0 and b["AMT_CREDIT_SUM_DEBT_sum"] == 0.0
    assert b["AMT_CREDIT_SUM_DEBT_mean"] is None
    assert a["CREDIT_ACTIVE_sum"] == 1 and a["Defaulted_mean"] == 0.5
    assert a["DAYS_CREDIT0"] == -100.0 and a["DAYS_CREDIT1"] == -200.0 and a["DAYS_CREDIT2"] is None
    assert a["DAYS_CREDIT_first_carloan"] == -100.0 and a["AMT_CREDIT_SUM_DEBT_count_mortgage"] is None
    assert b["AMT_CREDIT_SUM_DEBT_count_mortgage"] == 0
    assert a["card_AMT_CREDIT_SUM_DEBT_count"] == 1 and a["card_AMT_CREDIT_SUM_DEBT_first"] == 30.0
    assert b["card_AMT_CREDIT_SUM_DEBT_count"] is None
    # balance rollup: credit 1 (open -3, late 0) beats credit 2 (only C: dropped)
    assert a["Months_latest_open"] == -3 and a["Months_latest_delin"] == 0
    assert a["STATUS_0"] == pytest.approx(2 / 3) and a["STATUS_1"] == pytest.approx(1 / 3)
    assert b["Months_latest_open"] == -4 and b["Months_latest_delin"] is None and b["STATUS_2"] == 0.5
    assert 4 not in out


def test_feature_mart_keys(spark):
    app = spark.createDataFrame([(1, 0, "F", -1.0, -2.0, 1.0, 1.0, 1.0, 1.0),
                                 (9, 1, "M", -1.0, -2.0, 1.0, 1.0, 1.0, 1.0)], APP)
    prev = spark.createDataFrame([(10, 1, -5, "Approved", "Cash loans", 1.0, 1.0, None, None, None, None, None),
                                  (11, 7, -5, "Approved", "Cash loans", 1.0, 1.0, None, None, None, None, None)],
                                 PREV)
    ccb = spark.createDataFrame([(100, 1, -1, 1.0, 2.0, 1.0, 1.0)], CCB)
    inst = spark.createDataFrame([(1, 1, -1.0, -1.0, 1.0, 1.0)], INST)
    pos = spark.createDataFrame([(1, 1, -1, 0, 0)],
                                "SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE int, SK_DPD int, SK_DPD_DEF int")
    bureau = spark.createDataFrame([(1, 1, -1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0, "Active", "Car loan")], BUR)
    mart = B.feature_mart(app, B.bureau_parts(bureau), B.previous_block(prev), B.card_parts(ccb),
                          B.installment_block(inst), B.pos_parts(pos))
    out = {r["SK_ID_CURR"]: r for r in rows(mart)}
    assert sorted(out) == [1, 9]                          # one row per application, none for unknown ids
    assert out[1]["prev_AMT_CREDIT"] == 1.0 and out[9]["prev_AMT_CREDIT"] is None
    assert out[1]["bur_CREDIT_ACTIVE_sum"] == 1 and out[9]["cc_has_cc_now"] is None
    assert len(set(mart.columns)) == len(mart.columns)
    assert not math.isnan(out[1]["ins_insta_debt_sum"])
