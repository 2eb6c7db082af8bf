"""DuckDB oracle SQL per registered query (the correctness gate).

Tables ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are views in
the checking database; stand-in credit views are declared in a WITH clause.
"""

from __future__ import annotations

from loanmart.plans import oracle_blocks as OB
from loanmart.plans.oracle_views import with_views
from loanmart.plans.sqlkit import rounded

ORACLES: dict[str, str] = {}


def _register_block(name: str, built: tuple[str, list[str], list[str]], *views: str) -> None:
    sql, _cols, doubles = built
    ORACLES[name] = rounded(with_views(f"SELECT * FROM ({sql}) AS _b", *views), doubles)


_register_block("block_application", OB.application_sql(), "application")
_register_block("block_previous", OB.previous_sql(), "prev")
_register_block("block_card", OB.card_sql(), "ccb")
_register_block("block_installment", OB.installment_sql(), "installments")
_register_block("block_pos", OB.pos_sql(), "pos")
_register_block("block_bureau", OB.bureau_sql(), "bureau", "bureau_balance")
_register_block("feature_mart", OB.mart_sql(), "application", "prev", "ccb", "installments", "pos", "bureau",
                "bureau_balance")
ORACLES["mart_increment"] = ORACLES["feature_mart"]   # the mart of all rows, however they arrive


def _merge_registered() -> None:
    from loanmart.plans.queries import SQL
    for k, v in SQL.items():
        ORACLES.setdefault(k, v)


_merge_registered()
