"""The feature mart from stored states (S5, E7): child tables that grow are read once.

``MartStates`` describes one state per feature block.  ``build`` makes them from child tables, ``merge`` adds the
states of appended rows, ``write`` / ``read`` keep them as Parquet, ``mart`` gives the rows of
``blocks.feature_mart``.  Rows already built are not read again: a new month costs a pass over that month and
one over the states.

The month-on-month change of a card needs the row before each shown one.  A card belongs to one applicant, so a
row among the applicant's n newest is among the card's n newest; the state keeps n + 1 rows a card and the lag is
taken on those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.constants import (
    N_LATEST,
    PCT_CHANGE_CAP,
    STATUS_EXCLUDED,
    STATUS_LATE,
    STATUS_LEVELS,
    STATUS_OPEN,
)
from loanmart.functions.scalars import safe_div
from loanmart.operators.states import Measure, NewestRows, Pairs, Part, Totals, combine, measure
from loanmart.operators.windows import latest_n_wide, pct_change
from loanmart.plans import blocks as B

KEY = B.KEY
CARD_COLS = ("MONTHS_BALANCE", "Beyond_limit", "Delinquent", "balance_pct_change")
POS_COLS = ("MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF")


def _if_any(rows: Measure, m: Measure) -> Measure:
    """m where the key has rows of the kind counted by ``rows``, else NULL."""
    return combine(m.name, lambda n, v: F.when(n > 0, v), rows, m)


def previous_measures(spec: B.PreviousSpec) -> list[Measure]:
    order = ["DAYS_DECISION", *spec.tie]
    status = F.col("NAME_CONTRACT_STATUS")
    approved = status == F.lit(spec.approved)
    out = [measure("first", c, c, order) for c in ("DAYS_DECISION", "NAME_CONTRACT_STATUS", "AMT_CREDIT")]
    out += [measure("first", f"approved_{c}", c, order, approved, "approved") for c in spec.approved_cols]
    all_rows = measure("count", "", "NAME_CONTRACT_STATUS")
    out += [combine(f"ratio_{name}", lambda a, n: F.try_divide(F.nullif(a, F.lit(0)).cast("double"), n),
                    measure("size", "", where=status == F.lit(v), tag=f"status {v}"), all_rows)
            for v, name in spec.statuses.items()]
    for v, name in spec.types.items():
        is_type = approved & (F.col("NAME_CONTRACT_TYPE") == F.lit(v))
        out += [measure("first", f"Days_{name}", "DAYS_DECISION", order, is_type, f"type {v}"),
                measure("first", f"AMT_credit_{name}", "AMT_CREDIT", order, is_type, f"type {v}")]
    if "AMT_APPLICATION" in spec.approved_cols and "AMT_CREDIT" in spec.approved_cols:
        asked, given = (next(m for m in out if m.name == f"approved_{c}") for c in ("AMT_APPLICATION", "AMT_CREDIT"))
        out.append(combine("Diff_applied_apprved", lambda a, g: a - g, asked, given))
    return out


def installment_measures(tie: Sequence[str]) -> list[Measure]:
    order = ["DAYS_INSTALMENT", *tie]
    return [measure(fn, f"{c}_{fn}", c, order) for c, fns in B.INSTALLMENT_STATS.items() for fn in fns]


def bureau_measures(spec: B.BureauSpec) -> list[Measure]:
    order = ["DAYS_CREDIT", *spec.tie]
    out = [measure(fn, f"{c}_{fn}", c, order) for c, fns in B.BUREAU_TOTALS.items() for fn in fns]
    groups: list[tuple[str, str, Mapping[str, Sequence[str]]]] = []
    if spec.include_credit_types:
        groups += [(v, f"{{c}}_{{fn}}_{label}", B.BUREAU_BY_TYPE) for v, label in spec.credit_types.items()]
    groups.append((spec.credit_card, "card_{c}_{fn}", {"AMT_CREDIT_SUM_DEBT": ["count", "sum", "mean", "first"]}))
    for v, fmt, stats in groups:
        is_v: Column = F.col("CREDIT_TYPE") == F.lit(v)
        rows = measure("size", "", where=is_v, tag=f"type {v}")
        out += [_if_any(rows, measure(fn, fmt.format(c=c, fn=fn), c, order, is_v, f"type {v}"))
                for c, fns in stats.items() for fn in fns]
    return out


def balance_measures() -> list[Measure]:
    st = F.col("STATUS")
    counted = ~(st.eqNullSafe(STATUS_EXCLUDED[0]) | st.eqNullSafe(STATUS_EXCLUDED[1]))
    n = measure("size", "", where=counted, tag="counted")
    return [measure("size", "_n_open", where=st == STATUS_OPEN, tag="open"),
            measure("max", "Months_latest_open", "MONTHS_BALANCE", where=st == STATUS_OPEN, tag="open"),
            measure("max", "Months_latest_delin", "MONTHS_BALANCE", where=st == STATUS_LATE, tag="late"),
            *[combine(f"STATUS_{s}", safe_div, measure("size", "", where=counted & (st == s), tag=f"status {s}"), n)
              for s in STATUS_LEVELS]]


@dataclass
class MartStates:
    """States of all blocks.  ``tie`` arguments end each order with unique columns, as in ``blocks``."""
    previous: B.PreviousSpec = field(default_factory=B.PreviousSpec)
    bureau: B.BureauSpec = field(default_factory=B.BureauSpec)
    card_tie: Sequence[str] = ("SK_ID_PREV",)
    installment_tie: Sequence[str] = ("SK_ID_PREV",)
    pos_tie: Sequence[str] = ("SK_ID_PREV",)
    n: int = N_LATEST

    def parts(self) -> dict[str, tuple[str, Part]]:
        """State name -> (child table, part)."""
        n = self.n
        card = ["MONTHS_BALANCE", *self.card_tie]
        pos = ["MONTHS_BALANCE", *self.pos_tie]
        return {
            "previous": ("previous", Totals(KEY, previous_measures(self.previous))),
            "installments": ("installments", Totals(KEY, installment_measures(self.installment_tie))),
            "card_sums": ("card", Totals(KEY, [measure("sum", c, c) for c in ("has_cc_now", "balance_now", "times_bal80")])),
            "card_rows": ("card", NewestRows([KEY, "SK_ID_PREV"], card, ["AMT_BALANCE", "Beyond_limit", "Delinquent"], n + 1)),
            "pos_first": ("pos", Totals(KEY, [measure("first", f"{c}0", c, pos) for c in POS_COLS])),
            "pos_rows": ("pos", NewestRows(KEY, pos, POS_COLS, n)),
            "bureau": ("bureau", Totals(KEY, bureau_measures(self.bureau))),
            "bureau_rows": ("bureau", NewestRows(KEY, ["DAYS_CREDIT", *self.bureau.tie], B.BUREAU_LAG_COLS, n)),
            "bureau_keys": ("bureau", Pairs([KEY, "SK_ID_BUREAU"])),
            "balance": ("bureau_balance", Totals("SK_ID_BUREAU", balance_measures())),
        }

    def build(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """States of child tables ``previous installments card pos bureau bureau_balance`` (those given)."""
        shape = {"card": B.card_flags, "installments": B.installment_rows, "bureau": B.bureau_rows}
        rows = {name: shape.get(name, lambda df: df)(df) for name, df in tables.items()}
        return {s: part.build(rows[t]) for s, (t, part) in self.parts().items() if t in rows}

    def merge(self, *states: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """One set of states from several; a set may lack the tables that had no new rows."""
        out = {}
        for s, (_, part) in self.parts().items():
            have = [x[s] for x in states if s in x]
            if have:
                out[s] = part.merge(have) if len(have) > 1 else have[0]
        return out

    def mart(self, app: DataFrame, states: Mapping[str, DataFrame]) -> DataFrame:
        """``blocks.feature_mart`` for the applications of ``app``; all states must be there."""
        done = {s: part.finish(states[s]) for s, (_, part) in self.parts().items()}
        n = self.n
        order = ["MONTHS_BALANCE", *self.card_tie]
        within = [c for c in order if c != "SK_ID_PREV"]
        card = pct_change(done["card_rows"], "SK_ID_PREV", within, "AMT_BALANCE", out="balance_pct_change", upper=PCT_CHANGE_CAP)
        pos = latest_n_wide(done["pos_rows"], KEY, ["MONTHS_BALANCE", *self.pos_tie], POS_COLS, n=n)
        bureau = latest_n_wide(done["bureau_rows"], KEY, ["DAYS_CREDIT", *self.bureau.tie], B.BUREAU_LAG_COLS, n=n)
        credits = done["balance"].filter(F.col("_n_open") > 0).drop("_n_open")
        return B.feature_mart(
            app,
            [done["bureau"], bureau, B.newest_credit(done["bureau_keys"], credits, self.bureau.tie)],
            done["previous"],
            [done["card_sums"], latest_n_wide(card, KEY, order, CARD_COLS, n=n)],
            done["installments"],
            [done["pos_first"], pos.drop(*[f"{c}0" for c in POS_COLS])])


def write_states(states: Mapping[str, DataFrame], path: str) -> None:
    """One Parquet folder per state below ``path`` (a new one: a version is not written over the one it reads)."""
    for name, df in states.items():
        df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{name}")


def read_states(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in names}
