"""Loading the eight credit tables from their CSV files.

The columns the blocks rely on have fixed types; the types of the others can
be given, so that a file is read in one pass with a full schema.  Columns of
unknown type make one more pass over the whole file, which finds their types.
Malformed fields are errors.  NaN becomes NULL on floating columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.functions.scalars import nan_to_null

# The column types the blocks rely on, per credit table.
CREDIT_COLUMN_TYPES = {
    "application": {"SK_ID_CURR": "bigint", "TARGET": "int", "CODE_GENDER": "string", "DAYS_EMPLOYED": "double",
                    "DAYS_BIRTH": "double", "AMT_CREDIT": "double", "AMT_INCOME_TOTAL": "double",
                    "AMT_ANNUITY": "double", "CNT_FAM_MEMBERS": "double"},
    "previous_application": {"SK_ID_PREV": "bigint", "SK_ID_CURR": "bigint", "DAYS_DECISION": "int",
                             "NAME_CONTRACT_STATUS": "string", "NAME_CONTRACT_TYPE": "string",
                             "AMT_APPLICATION": "double", "AMT_CREDIT": "double", "AMT_DOWN_PAYMENT": "double",
                             "NAME_YIELD_GROUP": "string", "NFLAG_INSURED_ON_APPROVAL": "double",
                             "RATE_INTEREST_PRIMARY": "double", "RATE_INTEREST_PRIVILEGED": "double"},
    "credit_card_balance": {"SK_ID_PREV": "bigint", "SK_ID_CURR": "bigint", "MONTHS_BALANCE": "int",
                            "AMT_BALANCE": "double", "AMT_CREDIT_LIMIT_ACTUAL": "double",
                            "AMT_PAYMENT_CURRENT": "double", "AMT_INST_MIN_REGULARITY": "double"},
    "installments_payments": {"SK_ID_PREV": "bigint", "SK_ID_CURR": "bigint", "DAYS_INSTALMENT": "double",
                              "DAYS_ENTRY_PAYMENT": "double", "AMT_INSTALMENT": "double", "AMT_PAYMENT": "double"},
    "POS_CASH_balance": {"SK_ID_PREV": "bigint", "SK_ID_CURR": "bigint", "MONTHS_BALANCE": "int",
                         "SK_DPD": "int", "SK_DPD_DEF": "int"},
    "bureau": {"SK_ID_BUREAU": "bigint", "SK_ID_CURR": "bigint", "DAYS_CREDIT": "double",
               "DAYS_CREDIT_ENDDATE": "double", "DAYS_ENDDATE_FACT": "double", "AMT_CREDIT_SUM_DEBT": "double",
               "AMT_CREDIT_SUM_OVERDUE": "double", "AMT_CREDIT_MAX_OVERDUE": "double",
               "CREDIT_DAY_OVERDUE": "int", "CREDIT_ACTIVE": "string", "CREDIT_TYPE": "string"},
    "bureau_balance": {"SK_ID_BUREAU": "bigint", "MONTHS_BALANCE": "int", "STATUS": "string"},
}


def read_credit_table(spark: SparkSession, path: str, table: str, types: dict[str, str] | None = None) -> DataFrame:
    """Headered CSV with known column types, NaN -> NULL.

    ``table`` is one of CREDIT_COLUMN_TYPES (``application`` also serves
    the unlabelled scoring table, which has no TARGET).  ``types`` gives the
    types of further columns; only if some are left, types are inferred.
    """
    known = {**CREDIT_COLUMN_TYPES[table], **(types or {})}
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("nanValue", "NaN")
    names = spark.read.option("header", True).csv(path).columns          # the header line alone
    if all(c in known for c in names):
        schema = ", ".join(f"`{c}` {known[c]}" for c in names)
    else:
        found = reader.option("inferSchema", True).csv(path).schema
        schema = ", ".join(f"`{f.name}` {known.get(f.name, f.dataType.simpleString())}" for f in found.fields)
    # ids and flags may be written as 1.0: integers are read as numbers, then cast
    wide = schema
    whole = [c for c in names if known.get(c) in ("bigint", "int")]
    for c in whole:
        wide = wide.replace(f"`{c}` {known[c]}", f"`{c}` decimal(38,6)")
    df = reader.schema(wide).csv(path)
    return nan_to_null(df.withColumns({c: F.col(c).cast(known[c]) for c in whole}))
