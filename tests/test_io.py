"""Sources and sinks: CSV with NaN and empty fields, parquet round trip,
materialisation into the checkpoint folder, model save/load."""

import os
import tempfile

from pyspark.sql import functions as F

from loanmart.sources import io
from tests.conftest import rows


def test_read_csv_nan_and_empty(spark):
    d = tempfile.mkdtemp()
    path = os.path.join(d, "t.csv")
    with open(path, "w") as fh:
        fh.write("SK_ID_CURR,AMT,NAME\n1,NaN,a\n2,,\n3,2.5,c\n")
    df = io.read_table(spark, path, schema="SK_ID_CURR bigint, AMT double, NAME string")
    got = {r["SK_ID_CURR"]: r for r in rows(df)}
    assert got[1]["AMT"] is None and got[2]["AMT"] is None and got[2]["NAME"] is None
    assert df.filter(F.col("AMT") > 1).count() == 1        # NaN no longer compares greater


def test_write_and_materialize(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    d = tempfile.mkdtemp()
    io.write_features(df, os.path.join(d, "f"))
    assert io.read_table(spark, os.path.join(d, "f")).count() == 10
    m = io.materialize(df.filter("id > 4"))
    assert m.count() == 5 and "materialized-" in m.inputFiles()[0]


def test_model_save_load(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(maxIter=5)]).fit(df)
    path = os.path.join(tempfile.mkdtemp(), "m")
    io.save_model(model, path)
    again = io.load_model(path)
    assert again.transform(df).count() == 20
    scored = io.score_frame(again, df.withColumn("id", F.monotonically_increasing_id()), "id")
    assert all(0.0 <= r["TARGET"] <= 1.0 for r in scored.collect())


def test_bucketed_child_needs_no_shuffle(spark):
    from loanmart.plans import blocks as B
    rows_ = [(i, i % 7, -(i % 30), "Approved" if i % 3 else "Refused", "Cash loans", float(i), float(i), None, None,
              None, None, None) for i in range(200)]
    schema = ("SK_ID_PREV bigint, SK_ID_CURR bigint, DAYS_DECISION int, NAME_CONTRACT_STATUS string, "
              "NAME_CONTRACT_TYPE string, AMT_APPLICATION double, AMT_CREDIT double, AMT_DOWN_PAYMENT double, "
              "NAME_YIELD_GROUP string, NFLAG_INSURED_ON_APPROVAL double, RATE_INTEREST_PRIMARY double, "
              "RATE_INTEREST_PRIVILEGED double")
    prev = spark.createDataFrame(rows_, schema)
    bucketed = io.write_bucketed(prev, "SK_ID_CURR", 4, name="prev_test")
    out = B.previous_block(bucketed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, B.previous_block(prev).collect()))


def test_read_credit_table_casts_known_columns(spark):
    from loanmart.sources.credit import read_credit_table
    d = tempfile.mkdtemp()
    path = os.path.join(d, "bureau.csv")
    with open(path, "w") as fh:
        fh.write("SK_ID_CURR,SK_ID_BUREAU,CREDIT_ACTIVE,DAYS_CREDIT,CREDIT_DAY_OVERDUE,EXTRA\n"
                 "1,10,Active,-5,0,x\n2,11,,NaN,271,\n")
    df = read_credit_table(spark, path, "bureau")
    types = dict(df.dtypes)
    assert types["SK_ID_CURR"] == "bigint" and types["DAYS_CREDIT"] == "double" and types["EXTRA"] == "string"
    got = {r["SK_ID_BUREAU"]: r for r in df.collect()}
    assert got[11]["CREDIT_ACTIVE"] is None and got[11]["DAYS_CREDIT"] is None and got[11]["CREDIT_DAY_OVERDUE"] == 271


def test_build_credit_mart_from_csv(spark):
    from loanmart.plans.mart import CREDIT_FILES, build_credit_mart
    d = tempfile.mkdtemp()
    files = {
        "application": "SK_ID_CURR,TARGET,CODE_GENDER,DAYS_EMPLOYED,DAYS_BIRTH,AMT_CREDIT,AMT_INCOME_TOTAL,"
                       "AMT_ANNUITY,CNT_FAM_MEMBERS,NAME_CONTRACT_TYPE\n"
                       "1,0,F,-100,-10000,200,100,20,2,Cash loans\n2,1,XNA,-100,-10000,200,100,20,2,Cash loans\n"
                       "3,0,M,365243,-9000,300,50,30,,Revolving loans\n",
        "previous_application": "SK_ID_PREV,SK_ID_CURR,DAYS_DECISION,NAME_CONTRACT_STATUS,NAME_CONTRACT_TYPE,"
                                "AMT_APPLICATION,AMT_CREDIT,AMT_DOWN_PAYMENT,NAME_YIELD_GROUP,"
                                "NFLAG_INSURED_ON_APPROVAL,RATE_INTEREST_PRIMARY,RATE_INTEREST_PRIVILEGED\n"
                                "10,1,-5,Approved,Cash loans,120,100,,high,1,,\n",
        "credit_card_balance": "SK_ID_PREV,SK_ID_CURR,MONTHS_BALANCE,AMT_BALANCE,AMT_CREDIT_LIMIT_ACTUAL,"
                               "AMT_PAYMENT_CURRENT,AMT_INST_MIN_REGULARITY\n20,1,-2,10,100,5,1\n20,1,-1,90,100,5,1\n",
        "installments_payments": "SK_ID_PREV,SK_ID_CURR,DAYS_INSTALMENT,DAYS_ENTRY_PAYMENT,AMT_INSTALMENT,AMT_PAYMENT\n"
                                 "10,1,-10,-12,100,100\n",
        "POS_CASH_balance": "SK_ID_PREV,SK_ID_CURR,MONTHS_BALANCE,SK_DPD,SK_DPD_DEF\n10,1,-1,0,0\n",
        "bureau": "SK_ID_BUREAU,SK_ID_CURR,DAYS_CREDIT,DAYS_CREDIT_ENDDATE,DAYS_ENDDATE_FACT,AMT_CREDIT_SUM_DEBT,"
                  "AMT_CREDIT_SUM_OVERDUE,AMT_CREDIT_MAX_OVERDUE,CREDIT_DAY_OVERDUE,CREDIT_ACTIVE,CREDIT_TYPE\n"
                  "5,3,-100,-50,,40,0,0,300,Active,Car loan\n",
        "bureau_balance": "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n5,0,0\n5,-1,1\n",
    }
    for name, text in files.items():
        with open(os.path.join(d, CREDIT_FILES[name]), "w") as fh:
            fh.write(text)
    mart = build_credit_mart(spark, d)
    out = {r["SK_ID_CURR"]: r for r in mart.collect()}
    assert sorted(out) == [1, 3]                                  # XNA row dropped
    assert out[1]["prev_AMT_CREDIT"] == 100.0 and out[1]["cc_MONTHS_BALANCE0"] == -1
    assert abs(out[1]["cc_balance_pct_change0"] - 80 / 11) < 1e-12   # (90 - 10) / (10 + 1)
    assert out[3]["DAYS_EMPLOYED"] is None and out[3]["bur_Defaulted_sum"] == 1
    assert out[3]["bur_Months_latest_open"] == 0 and out[3]["bur_DAYS_CREDIT_first_carloan"] == -100.0
    assert "NAME_CONTRACT_TYPE" in mart.columns and "prev_approved_NAME_CONTRACT_TYPE" in mart.columns
    from loanmart.operators.synth import synthesize
    from loanmart.plans.mart import credit_entityset
    auto = {r["SK_ID_CURR"]: r for r in synthesize(credit_entityset(spark, d), "train", depth=2).collect()}
    assert len(auto) == 3 and auto[1]["COUNT(prev)"] == 1 and auto[2]["COUNT(prev)"] == 0
    assert auto[1]["SUM(prev.COUNT(insta))"] == 1 and auto[1]["SUM(prev.COUNT(ccb))"] == 0  # card 20 is not a prev
    assert auto[3]["MAX(bureau.COUNT(bureaubal))"] == 2
    from loanmart.plans.mart import credit_training_table
    seq = {r["SK_ID_CURR"]: r for r in credit_training_table(spark, d, "sequence", seq_features=3).collect()}
    assert len(seq) == 3 and {"bfeat_1", "bfeat_2", "bfeat_3"} <= set(seq[1].asDict())


def test_session_helpers(spark):
    from loanmart.session import checkpoint_dir, cut_lineage, get_spark
    s = get_spark(shuffle_partitions=4, max_partition_bytes="64m")
    assert s.sparkContext is spark.sparkContext
    assert checkpoint_dir(s)
    df = cut_lineage(s.range(5))
    assert df.count() == 5 and "LogicalRDD" in df._jdf.queryExecution().logical().toString()
