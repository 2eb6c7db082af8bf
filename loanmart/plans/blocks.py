"""Per-applicant feature blocks of the eight credit tables.

Each block reads one child table and returns one row per applicant key.
Statistics of one table that share a key are computed in a single hash
aggregate (conditional aggregation replaces the source's many
filter/group/merge rounds); the only windows are the bounded latest-n ones.
Column names follow the source's feature names; ``feature_mart`` prefixes
each block (``prev_``, ``cc_``, ``ins_``, ``pos_``, ``bur_``) so names stay
unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.constants import (
    XNA,
    DAYS_EMPLOYED_SENTINEL,
    PREV_STATUSES,
    PREV_TYPES,
    PREV_APPROVED_COLS,
    CREDIT_TYPES,
    CREDIT_CARD,
    CREDIT_ACTIVE_MAP,
    DEFAULT_DAYS,
    BALANCE_USAGE,
    PCT_CHANGE_CAP,
    STATUS_OPEN,
    STATUS_LATE,
    STATUS_LEVELS,
    STATUS_EXCLUDED,
    N_LATEST,
)
from loanmart.functions.scalars import (
    drop_sentinel,
    flag,
    latest_expr,
    map_values,
    null_if,
    replace_value,
    safe_div,
)
from loanmart.operators.agg import agg_expr, latest_row
from loanmart.operators.joins import left_join_all, outer_join_all, with_prefix
from loanmart.operators.windows import latest_n_parts, latest_n_wide, pct_change

KEY = "SK_ID_CURR"


@dataclass
class PreviousSpec:
    approved: str = "Approved"
    statuses: Mapping[str, str] = field(default_factory=lambda: dict(PREV_STATUSES))
    types: Mapping[str, str] = field(default_factory=lambda: dict(PREV_TYPES))
    approved_cols: Sequence[str] = PREV_APPROVED_COLS
    tie: Sequence[str] = ("SK_ID_PREV",)


@dataclass
class BureauSpec:
    credit_types: Mapping[str, str] = field(default_factory=lambda: dict(CREDIT_TYPES))
    credit_card: str = CREDIT_CARD
    include_credit_types: bool = True
    tie: Sequence[str] = ("SK_ID_BUREAU",)


def application_features(app: DataFrame, clean: bool = True, gender_sentinel: str = XNA,
                         employed_sentinel=DAYS_EMPLOYED_SENTINEL) -> DataFrame:
    """E5: sentinel cleaning (training table only) and five ratios."""
    if clean:
        app = drop_sentinel(app, "CODE_GENDER", gender_sentinel)
        app = app.withColumn("DAYS_EMPLOYED", null_if("DAYS_EMPLOYED", employed_sentinel).cast("double"))
    return app.withColumns({
        "Days_employed_age": safe_div("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "Credit_income_ratio": safe_div("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "Anuity_income_ratio": safe_div("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "Income_per_person": safe_div("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "Credit_term": safe_div("AMT_ANNUITY", "AMT_CREDIT"),
    })


def previous_block(prev: DataFrame, spec: PreviousSpec | None = None) -> DataFrame:
    """Latest application, latest approved row, status shares and the
    latest approved credit per contract type, all in one aggregate."""
    spec = spec or PreviousSpec()
    order = ["DAYS_DECISION", *spec.tie]
    status = F.col("NAME_CONTRACT_STATUS")
    approved = status == F.lit(spec.approved)
    exprs: list[Column] = [latest_expr(c, order).alias(c) for c in ("DAYS_DECISION", "NAME_CONTRACT_STATUS",
                                                                    "AMT_CREDIT")]
    exprs += [latest_expr(c, order, where=approved).alias(f"approved_{c}") for c in spec.approved_cols]
    n_status = F.count(status)
    exprs += [F.try_divide(F.nullif(F.count_if(status == F.lit(v)), F.lit(0)).cast("double"), n_status)
              .alias(f"ratio_{name}") for v, name in spec.statuses.items()]
    for v, name in spec.types.items():
        is_type = approved & (F.col("NAME_CONTRACT_TYPE") == F.lit(v))
        exprs += [latest_expr("DAYS_DECISION", order, where=is_type).alias(f"Days_{name}"),
                  latest_expr("AMT_CREDIT", order, where=is_type).alias(f"AMT_credit_{name}")]
    out = prev.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(*exprs)
    if "AMT_APPLICATION" in spec.approved_cols and "AMT_CREDIT" in spec.approved_cols:
        out = out.withColumn("Diff_applied_apprved", F.col("approved_AMT_APPLICATION") - F.col("approved_AMT_CREDIT"))
    return out


YEAR_OF_MONTHS = "year"


def card_flags(ccb: DataFrame) -> DataFrame:
    """E2 row features that need no other row: limit and payment flags."""
    bal, limit = F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL")
    rows = ccb.withColumns({
        "Beyond_limit": flag(bal > limit),
        "Delinquent": flag(F.col("AMT_PAYMENT_CURRENT") < F.col("AMT_INST_MIN_REGULARITY")),
        "times_bal80": flag(F.when(limit == 0, bal > 0).otherwise(safe_div(bal, limit) >= F.lit(BALANCE_USAGE))),
        "has_cc_now": flag(F.col("MONTHS_BALANCE") == -1),
    })
    return rows.withColumn("balance_now", F.col("has_cc_now") * bal)


def card_rows(ccb: DataFrame, tie: Sequence[str] = ("SK_ID_PREV",),
              bucket: Column | str | None = YEAR_OF_MONTHS) -> DataFrame:
    """E2 row features: flags and the month-on-month balance change.

    The lag runs per (card, year of months) by default, so one card holding
    a large share of all rows is still spread over tasks; ``bucket=None``
    gives the plain per-card window."""
    if isinstance(bucket, str):
        bucket = F.floor(F.col("MONTHS_BALANCE") / 12)
    rows = card_flags(ccb)
    order = ["MONTHS_BALANCE", *[t for t in tie if t != "SK_ID_PREV"]]
    return pct_change(rows, "SK_ID_PREV", order, "AMT_BALANCE", out="balance_pct_change",
                      upper=PCT_CHANGE_CAP, bucket=bucket)


def card_parts(ccb: DataFrame, tie: Sequence[str] = ("SK_ID_PREV",),
               bucket: Column | str | None = YEAR_OF_MONTHS, n: int = N_LATEST) -> list[DataFrame]:
    rows = card_rows(ccb, tie, bucket)
    sums = card_flags(ccb).groupBy(KEY).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                   for c in ("has_cc_now", "balance_now", "times_bal80")])
    lags = latest_n_wide(rows, KEY, ["MONTHS_BALANCE", *tie],
                         ["MONTHS_BALANCE", "Beyond_limit", "Delinquent", "balance_pct_change"], n=n)
    return [sums, lags]


def card_block(ccb: DataFrame, tie: Sequence[str] = ("SK_ID_PREV",),
               bucket: Column | str | None = YEAR_OF_MONTHS, n: int = N_LATEST) -> DataFrame:
    """Counts of cards now / balance now / high usage, and the n newest
    months per applicant flattened."""
    return outer_join_all(card_parts(ccb, tie, bucket, n), KEY)


INSTALLMENT_STATS = {"DAYS_INSTALMENT": ["first"], "insta_debt": ["sum", "mean", "first"],
                     "insta_delinquency": ["sum", "first"]}


def installment_rows(inst: DataFrame) -> DataFrame:
    """E3 row features: late flag (a missing payment day counts as late) and unpaid amount."""
    return inst.withColumns({
        "insta_delinquency": F.when(F.col("DAYS_INSTALMENT") >= F.col("DAYS_ENTRY_PAYMENT"), 0).otherwise(1),
        "insta_debt": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
    })


def installment_block(inst: DataFrame, tie: Sequence[str] = ("SK_ID_PREV",)) -> DataFrame:
    """first/sum/mean of the row features in descending instalment-day order."""
    order = ["DAYS_INSTALMENT", *tie]
    return installment_rows(inst).groupBy(KEY).agg(*[agg_expr(c, fn, order).alias(f"{c}_{fn}")
                                                     for c, fns in INSTALLMENT_STATS.items() for fn in fns])


def pos_parts(pos: DataFrame, tie: Sequence[str] = ("SK_ID_PREV",), n: int = N_LATEST) -> list[DataFrame]:
    return latest_n_parts(pos, KEY, ["MONTHS_BALANCE", *tie], ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
                          n=n, first_skips_null=True)


def pos_block(pos: DataFrame, tie: Sequence[str] = ("SK_ID_PREV",), n: int = N_LATEST) -> DataFrame:
    """Newest n POS months; slot 0 skips missing values (``first``)."""
    return outer_join_all(pos_parts(pos, tie, n), KEY)


def bureau_rows(bureau: DataFrame) -> DataFrame:
    """E6 row features (durations, per-day amounts, default flag)."""
    planned = replace_value(F.col("DAYS_CREDIT_ENDDATE") - F.col("DAYS_CREDIT"), 0, 1)
    rows = bureau.withColumns({
        "Days_early_paidoff": F.col("DAYS_CREDIT_ENDDATE") - F.col("DAYS_ENDDATE_FACT"),
        "Duration_real": F.col("DAYS_ENDDATE_FACT") - F.col("DAYS_CREDIT"),
        "Duration_planned": planned,
    })
    rows = rows.withColumns({
        "AMT_weightdebt_duration": safe_div("AMT_CREDIT_SUM_DEBT", "Duration_planned"),
        "AMT_Overdue_duration": safe_div("AMT_CREDIT_SUM_OVERDUE", "Duration_planned"),
        "AMT_Maxoverdue_duration": safe_div("AMT_CREDIT_MAX_OVERDUE", "Duration_planned"),
        "Defaulted": flag(F.col("CREDIT_DAY_OVERDUE") > DEFAULT_DAYS),
        "CREDIT_ACTIVE": map_values("CREDIT_ACTIVE", CREDIT_ACTIVE_MAP),
    })
    return rows.withColumn("AMT_defaulted", F.col("Defaulted") * F.col("AMT_CREDIT_SUM_DEBT"))


BUREAU_TOTALS = {"AMT_CREDIT_SUM_DEBT": ["count", "sum", "mean"], "AMT_weightdebt_duration": ["sum", "mean"],
                 "AMT_Overdue_duration": ["sum", "mean"], "AMT_Maxoverdue_duration": ["mean"],
                 "Days_early_paidoff": ["sum", "mean"], "Defaulted": ["sum", "mean"],
                 "AMT_defaulted": ["sum", "mean"], "CREDIT_ACTIVE": ["sum"]}
BUREAU_BY_TYPE = {"DAYS_CREDIT": ["first", "last"], "AMT_CREDIT_SUM_DEBT": ["count", "sum", "mean"],
                  "CREDIT_ACTIVE": ["sum"], "Defaulted": ["sum"], "AMT_defaulted": ["sum"]}
BUREAU_LAG_COLS = ("DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT", "AMT_weightdebt_duration", "AMT_Overdue_duration",
                   "Days_early_paidoff", "Defaulted", "AMT_defaulted")


def bureau_stats(rows: DataFrame, spec: BureauSpec) -> DataFrame:
    """Totals, per-credit-type pivots and the credit-card subset in one
    aggregate.  A type (or the card subset) absent for a key gives NULLs."""
    order = ["DAYS_CREDIT", *spec.tie]
    exprs = [agg_expr(c, fn, order).alias(f"{c}_{fn}") for c, fns in BUREAU_TOTALS.items() for fn in fns]
    ctype = F.col("CREDIT_TYPE")
    if spec.include_credit_types:
        for v, label in spec.credit_types.items():
            is_v = ctype == F.lit(v)
            present = F.count_if(is_v) > 0
            exprs += [F.when(present, agg_expr(c, fn, order, where=is_v)).alias(f"{c}_{fn}_{label}")
                      for c, fns in BUREAU_BY_TYPE.items() for fn in fns]
    is_card = ctype == F.lit(spec.credit_card)
    has_card = F.count_if(is_card) > 0
    exprs += [F.when(has_card, agg_expr("AMT_CREDIT_SUM_DEBT", fn, order, where=is_card))
              .alias(f"card_AMT_CREDIT_SUM_DEBT_{fn}") for fn in ("count", "sum", "mean", "first")]
    return rows.groupBy(KEY).agg(*exprs)


def bureau_balance_features(balance: DataFrame) -> DataFrame:
    """A12-A13 per bureau credit, in one aggregate over the balance table:
    newest open / late month, and the shares of statuses 0..5 among the
    months that are neither X nor C (missing statuses count, as all-zero
    indicators).  Credits without an open month are dropped."""
    st, month = F.col("STATUS"), F.col("MONTHS_BALANCE")
    counted = ~(st.eqNullSafe(STATUS_EXCLUDED[0]) | st.eqNullSafe(STATUS_EXCLUDED[1]))
    n_counted = F.count_if(counted)
    exprs = [F.count_if(st == STATUS_OPEN).alias("_n_open"),
             F.max(F.when(st == STATUS_OPEN, month)).alias("Months_latest_open"),
             F.max(F.when(st == STATUS_LATE, month)).alias("Months_latest_delin")]
    exprs += [safe_div(F.count_if(counted & (st == s)), n_counted).alias(f"STATUS_{s}") for s in STATUS_LEVELS]
    return balance.groupBy("SK_ID_BUREAU").agg(*exprs).filter(F.col("_n_open") > 0).drop("_n_open")


def bureau_balance_rollup(bureau: DataFrame, balance: DataFrame, tie: Sequence[str] = ("SK_ID_BUREAU",)) -> DataFrame:
    """Per applicant, the credit with the newest open month (per-column
    first present value in that order)."""
    return newest_credit(bureau, bureau_balance_features(balance), tie)


def newest_credit(bureau: DataFrame, per_credit: DataFrame, tie: Sequence[str] = ("SK_ID_BUREAU",)) -> DataFrame:
    """Features per credit brought to the applicant, newest open month first."""
    lifted = bureau.select(KEY, "SK_ID_BUREAU").join(per_credit, on="SK_ID_BUREAU", how="inner")
    cols = ["Months_latest_open", "Months_latest_delin", *[f"STATUS_{s}" for s in STATUS_LEVELS]]
    return latest_row(lifted, KEY, ["Months_latest_open", *tie], cols)


def bureau_parts(bureau: DataFrame, balance: DataFrame | None = None, spec: BureauSpec | None = None,
                 n: int = N_LATEST) -> list[DataFrame]:
    spec = spec or BureauSpec()
    rows = bureau_rows(bureau)
    parts = [bureau_stats(rows, spec), latest_n_wide(rows, KEY, ["DAYS_CREDIT", *spec.tie], BUREAU_LAG_COLS, n=n)]
    if balance is not None:
        parts.append(bureau_balance_rollup(bureau, balance, spec.tie))
    return parts


def bureau_block(bureau: DataFrame, balance: DataFrame | None = None, spec: BureauSpec | None = None,
                 n: int = N_LATEST) -> DataFrame:
    """Bureau totals, n newest credits, type pivots, card subset and the
    balance rollup, joined on the applicant key."""
    return outer_join_all(bureau_parts(bureau, balance, spec, n), KEY)


def _as_parts(x: DataFrame | Sequence[DataFrame]) -> list[DataFrame]:
    return [x] if isinstance(x, DataFrame) else list(x)


def feature_mart(app: DataFrame, bureau_feats, prev_feats, card_feats, inst_feats, pos_feats) -> DataFrame:
    """Application ⟕ bureau ⟕ (previous ⟗ card ⟗ installment ⟗ POS).

    Every block argument is a keyed frame or a list of keyed parts.  Only
    application keys survive the final left join, so the source's
    full-outer merges of the in-house history blocks reduce to left joins of
    every part onto the application table: the application side keeps its
    hash partitioning through the whole chain, and each part (an
    aggregate, already partitioned on the key) is joined without a second
    shuffle of the growing wide rows.
    """
    parts = []
    for prefix, blk in (("bur_", bureau_feats), ("prev_", prev_feats), ("cc_", card_feats),
                        ("ins_", inst_feats), ("pos_", pos_feats)):
        parts += [with_prefix(p, prefix, [KEY]) for p in _as_parts(blk)]
    return left_join_all(app, parts, KEY)
