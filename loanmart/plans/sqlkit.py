"""Small helpers that write the DuckDB oracle SQL (used only by oracles.py)."""

from __future__ import annotations

from collections.abc import Sequence


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def order_struct(order: Sequence[str]) -> str:
    parts = [f"'p': ({order[0]}) IS NOT NULL"] + [f"'o{i}': {o}" for i, o in enumerate(order)]
    return "{" + ", ".join(parts) + "}"


def latest(x: str, order: Sequence[str], where: str | None = None) -> str:
    """First present value of x in (order desc, missing last)."""
    cond = f"({x}) IS NOT NULL" + (f" AND ({where})" if where else "")
    return f"arg_max({x}, {order_struct(order)}) FILTER (WHERE {cond})"


def earliest(x: str, order: Sequence[str], where: str | None = None) -> str:
    cond = f"({x}) IS NOT NULL" + (f" AND ({where})" if where else "")
    return f"arg_min({x}, {order_struct(order)}) FILTER (WHERE {cond})"


def agg(col: str, fn: str, order: Sequence[str] | None = None, where: str | None = None,
        integral: bool = False) -> str:
    """One aggregate with the same meaning as loanmart.operators.agg.agg_expr.

    ``integral`` marks integer inputs whose sum is BIGINT in Spark."""
    x = col if where is None else f"CASE WHEN {where} THEN {col} END"
    if fn == "count":
        return f"count({x})"
    if fn == "sum":
        return f"CAST(coalesce(sum({x}), 0) AS BIGINT)" if integral else f"coalesce(sum({x}), 0)"
    if fn == "mean":
        return f"avg({x})"
    if fn == "min":
        return f"min({x})"
    if fn == "max":
        return f"max({x})"
    if fn == "std":
        return f"stddev_samp({x})"
    if fn == "nunique":
        return f"count(DISTINCT {x})"
    if fn == "first":
        return latest(col, order, where)
    if fn == "last":
        return earliest(col, order, where)
    raise ValueError(fn)


def rounded(sql: str, cols: Sequence[str], digits: int = 6, sig: Sequence[str] = ()) -> str:
    """Round the listed columns of a query's result (``sig``: to seven
    significant digits instead)."""
    if not cols:
        return sql
    sig = set(sig)
    rep = ", ".join(f"CAST(printf('%.6e', {q(c)}) AS DOUBLE) AS {q(c)}" if c in sig else
                    f"CAST(CAST(CAST({q(c)} AS DECIMAL(38,9)) AS DECIMAL(38,{digits})) AS DOUBLE) AS {q(c)}"
                    for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _r"


def safe_div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def hash_int(key: str, seed) -> str:
    """Same integer as loanmart.functions.hash_int (md5 of 'key:seed')."""
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::UBIGINT AS BIGINT)"
