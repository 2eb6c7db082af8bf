"""Registered queries on the driver's tables: one per operator key.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Floating outputs are rounded to 6 decimals (``finish``) so the
DuckDB oracle comparison is not sensitive to summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.plans import blocks as B
from loanmart.plans import standins as V

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None: rows-only)."""
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def snap(c, digits: int = 6):
    """Round a double through decimals: to 9 places (drops summation noise),
    then half-up to ``digits`` places, back to double.  Same bits as the
    oracle's CAST chain."""
    snapped = c.try_cast("decimal(38,9)").cast(f"decimal(38,{digits})").cast("double")
    return F.coalesce(snapped, c)   # NaN, infinities and huge values pass through unchanged


def sig7(c):
    """Seven significant digits via the shortest %e text (same as DuckDB's
    printf) for statistics that are not decimal numbers (std, skew)."""
    return F.when(c.isNotNull(), F.format_string("%.6e", c).cast("double"))


def finish(df: DataFrame, digits: int = 6, sig=lambda name: False) -> DataFrame:
    """Round every floating column (names unchanged); ``sig(name)`` picks
    columns rounded to significant digits instead of decimals."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = sig7(c) if sig(f.name) else snap(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- blocks E1-E7

def _application(spark, sf):
    return B.application_features(V.application(spark, sf), gender_sentinel=V.GENDER_SENTINEL,
                                  employed_sentinel=V.EMPLOYED_SENTINEL)


def _previous(spark, sf):
    return B.previous_block(V.previous(spark, sf), V.PREV_SPEC)


def _card(spark, sf):
    return B.card_block(V.card_balance(spark, sf), tie=V.EVENT_TIE, bucket=V.card_bucket())


def _installment(spark, sf):
    return B.installment_block(V.installments(spark, sf), tie=V.LINEITEM_TIE)


def _pos(spark, sf):
    return B.pos_block(V.pos_balance(spark, sf), tie=V.EVENT_TIE)


def _bureau(spark, sf):
    return B.bureau_block(V.bureau(spark, sf), V.bureau_balance(spark, sf), V.BUREAU_SPEC)


def build_mart(spark: SparkSession, sf: str, application: DataFrame | None = None) -> DataFrame:
    """The feature mart of the training table, or of the given application rows."""
    return B.feature_mart(
        _application(spark, sf) if application is None else application,
        B.bureau_parts(V.bureau(spark, sf), V.bureau_balance(spark, sf), V.BUREAU_SPEC),
        _previous(spark, sf),
        B.card_parts(V.card_balance(spark, sf), tie=V.EVENT_TIE, bucket=V.card_bucket()),
        _installment(spark, sf),
        B.pos_parts(V.pos_balance(spark, sf), tie=V.EVENT_TIE))


@register("block_application")
def block_application(spark, sf):
    return finish(_application(spark, sf))


@register("block_previous")
def block_previous(spark, sf):
    return finish(_previous(spark, sf))


@register("block_card")
def block_card(spark, sf):
    return finish(_card(spark, sf))


@register("block_installment")
def block_installment(spark, sf):
    return finish(_installment(spark, sf))


@register("block_pos")
def block_pos(spark, sf):
    return finish(_pos(spark, sf))


@register("block_bureau")
def block_bureau(spark, sf):
    return finish(_bureau(spark, sf))


@register("feature_mart")
def feature_mart(spark, sf):
    return finish(build_mart(spark, sf))


@register("mart_increment")
def mart_increment(spark, sf):
    """The mart from stored states of three quarters of all child rows, merged with those of the rest."""
    from loanmart.plans.increment import MartStates
    from loanmart.session import cut_lineage
    spec = MartStates(V.PREV_SPEC, V.BUREAU_SPEC, V.EVENT_TIE, V.LINEITEM_TIE, V.EVENT_TIE)
    tables = {"previous": V.previous(spark, sf), "installments": V.installments(spark, sf), "card": V.card_balance(spark, sf),
              "pos": V.pos_balance(spark, sf), "bureau": V.bureau(spark, sf), "bureau_balance": V.bureau_balance(spark, sf)}
    later = {t: F.pmod(F.hash(*df.columns), F.lit(4)) == 0 for t, df in tables.items()}
    stored = {s: cut_lineage(df) for s, df in spec.build({t: df.filter(~later[t]) for t, df in tables.items()}).items()}
    new = spec.build({t: df.filter(later[t]) for t, df in tables.items()})
    return finish(spec.mart(_application(spark, sf), spec.merge(stored, new)))


def _load_all() -> None:
    """Import the modules that register the remaining keys."""
    from loanmart.plans import (  # noqa: F401
        metric_queries,
        model_queries,
        ops_queries,
        prep_queries,
        resample_queries,
        synth_queries,
    )


_load_all()
