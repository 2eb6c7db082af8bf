"""Synthesis keys (§2.8): customer <- orders <- lineitem, customer <- events."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.operators import synth as D
from loanmart.plans import sqlkit as S
from loanmart.plans import standins as V
from loanmart.plans.queries import finish, register

# Column roles of the stand-in entity set (types drive the primitives).
ORDERS_NUM = {"o_totalprice": "DOUBLE"}
ORDERS_CAT = ["o_orderstatus", "o_orderpriority"]
LINE_NUM = {"l_linenumber": "INTEGER", "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE",
            "l_tax": "DOUBLE"}
LINE_CAT = ["l_returnflag", "l_linestatus"]
EVENT_NUM = {"value": "DOUBLE"}
EVENT_CAT = ["event_type", "props"]


def entity_set(spark, sf) -> D.EntitySet:
    es = D.EntitySet()
    es.add("customer", V.table(spark, sf, "customer"), "c_custkey")
    es.add("orders", V.table(spark, sf, "orders"), "o_orderkey")
    es.add("lineitem", V.table(spark, sf, "lineitem"), "_none", ignore=("l_partkey", "l_suppkey"))
    es.add("events", V.table(spark, sf, "events"), "event_id")
    es.relate("customer", "c_custkey", "orders", "o_custkey")
    es.relate("orders", "o_orderkey", "lineitem", "l_orderkey")
    es.relate("customer", "c_custkey", "events", "user_id")
    return es


# ------------------------------------------------------------- oracle SQL

def _num_sql(prim: str, x: str, typ: str) -> tuple[str, str]:
    """SQL and result type of one numeric primitive."""
    if prim == "sum":
        return (f"CAST(sum({x}) AS BIGINT)", "BIGINT") if typ in ("INTEGER", "BIGINT") else (f"sum({x})", "DOUBLE")
    if prim == "std":
        return f"stddev_samp({x})", "DOUBLE"
    if prim in ("max", "min"):
        return f"{prim}({x})", typ
    if prim == "mean":
        return f"avg({x})", "DOUBLE"
    if prim == "skew":
        return (f"CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0.0 ELSE skewness({x}) END",
                "DOUBLE")
    raise ValueError(prim)


def child_agg_sql(child: str, table: str, fk: str, num: dict[str, str], cat: list[str]):
    """(sql, {column: type}) of one child's aggregates keyed by _fk."""
    q = S.q
    exprs, types = [f"count(*) AS {q(f'COUNT({child})')}"], {f"COUNT({child})": "BIGINT"}
    for c, t in num.items():
        for p in D.NUMERIC_PRIMS:
            e, rt = _num_sql(p, q(c), t)
            name = f"{p.upper()}({child}.{c})"
            exprs.append(f"{e} AS {q(name)}")
            types[name] = rt
    for c in cat:
        name = f"NUM_UNIQUE({child}.{c})"
        exprs.append(f"count(DISTINCT {q(c)}) AS {q(name)}")
        types[name] = "BIGINT"
    base = f"SELECT {q(fk)} AS _fk, {', '.join(exprs)} FROM {table} WHERE {q(fk)} IS NOT NULL GROUP BY {q(fk)}"
    joins = []
    for i, c in enumerate(cat):
        name = f"MODE({child}.{c})"
        types[name] = "VARCHAR"
        m = (f"(SELECT _fk, v AS {q(name)} FROM (SELECT {q(fk)} AS _fk, {q(c)} AS v, row_number() OVER "
             f"(PARTITION BY {q(fk)} ORDER BY count(*) DESC, {q(c)}) AS rn FROM {table} WHERE {q(c)} IS NOT NULL "
             f"AND {q(fk)} IS NOT NULL GROUP BY {q(fk)}, {q(c)}) AS r WHERE rn = 1) AS m{i}")
        joins.append(f"LEFT JOIN {m} USING (_fk)")
    order = ["_fk", *[n for n in types]]
    sql = f"SELECT {', '.join(S.q(c) for c in order)} FROM ({base}) AS b {' '.join(joins)}"
    return sql, types


def attach_sql(parent_sql: str, parent_key: str, child_sql: str, types: dict[str, str]) -> str:
    cols = []
    for c in types:
        zero = c.startswith("COUNT(") or c.startswith("SUM(")
        cols.append(f"coalesce(c.{S.q(c)}, 0) AS {S.q(c)}" if zero else f"c.{S.q(c)}")
    return (f"SELECT p.*, {', '.join(cols)} FROM ({parent_sql}) AS p LEFT JOIN ({child_sql}) AS c "
            f"ON p.{S.q(parent_key)} = c._fk")


def dfs_sql(depth: int) -> tuple[str, list[str]]:
    doubles: list[str] = []
    if depth >= 2:
        li_sql, li_types = child_agg_sql("lineitem", "lineitem", "l_orderkey", LINE_NUM, LINE_CAT)
        orders_sql = attach_sql("SELECT * FROM orders", "o_orderkey", li_sql, li_types)
        o_num = dict(ORDERS_NUM)
        o_cat = list(ORDERS_CAT)
        for c, t in li_types.items():
            if t == "VARCHAR":
                o_cat.append(c)
            else:
                o_num[c] = t
        orders_table = f"({orders_sql})"
    else:
        o_num, o_cat, orders_table = dict(ORDERS_NUM), list(ORDERS_CAT), "orders"
    o_sql, o_types = child_agg_sql("orders", orders_table, "o_custkey", o_num, o_cat)
    e_sql, e_types = child_agg_sql("events", "events", "user_id", EVENT_NUM, EVENT_CAT)
    sql = attach_sql(attach_sql("SELECT * FROM customer", "c_custkey", o_sql, o_types), "c_custkey", e_sql, e_types)
    lifted: dict[str, str] = {}
    if depth >= 2:                                          # lineitem rows by customer, through the order's key
        rows = "(SELECT l.*, o.o_custkey AS _root FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
        l_sql, lifted = child_agg_sql("lineitem", rows, "_root", LINE_NUM, LINE_CAT)
        sql = attach_sql(sql, "c_custkey", l_sql, lifted)
    doubles = ["c_acctbal"] + [c for c, t in {**o_types, **e_types, **lifted}.items() if t == "DOUBLE"]
    return S.rounded(sql, doubles, sig=[c for c in doubles if is_moment(c)]), doubles


def is_moment(name: str) -> bool:
    """Standard deviations: irrational in general and computed by different
    moment algorithms per engine, so they are compared to 7 significant
    digits; everything else is rounded to 6 decimals."""
    return name.startswith("STD(")


@register("dfs_depth1", dfs_sql(1)[0])
def dfs_depth1(spark, sf):
    return finish(D.synthesize(entity_set(spark, sf), "customer", depth=1), sig=is_moment)


@register("dfs_depth2", dfs_sql(2)[0])
def dfs_depth2(spark, sf):
    return finish(D.synthesize(entity_set(spark, sf), "customer", depth=2), sig=is_moment)


@register("dfs_transforms", """
    SELECT o_orderkey, CAST(dayofmonth(o_orderdate) AS INTEGER) AS "DAY(o_orderdate)",
           CAST(month(o_orderdate) AS INTEGER) AS "MONTH(o_orderdate)",
           CAST(year(o_orderdate) AS INTEGER) AS "YEAR(o_orderdate)",
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS "WEEKDAY(o_orderdate)",
           CAST(length(o_orderpriority) - length(replace(o_orderpriority, ' ', '')) + 1 AS INTEGER)
               AS "NUM_WORDS(o_orderpriority)",
           CAST(length(o_orderpriority) AS INTEGER) AS "NUM_CHARACTERS(o_orderpriority)"
    FROM orders""")
def dfs_transforms(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return D.dfs_transforms(o, dates=["o_orderdate"], texts=["o_orderpriority"]).drop("o_orderdate",
                                                                                      "o_orderpriority")


@register("feature_count", f"SELECT (SELECT count(*) FROM (DESCRIBE {dfs_sql(2)[0]})) AS n_features, "
                           "(SELECT count(*) FROM customer) AS n_rows")
def feature_count(spark, sf):
    """Shape of the depth-2 synthesis result (rows counted by Spark)."""
    out = D.synthesize(entity_set(spark, sf), "customer", depth=2)
    return out.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(len(out.columns)).cast("long").alias("n_features"), "n_rows")
