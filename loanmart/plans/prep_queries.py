"""Preparation keys (§2.9) on stand-in tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from loanmart.operators import prep as P
from loanmart.operators.sample import split_flag
from loanmart.plans import sqlkit as S
from loanmart.plans import standins as V
from loanmart.plans.oracle_views import with_views
from loanmart.plans.queries import finish, register

# ------------------------------------------------------------- correlation

# (Spark expression builder, SQL text) per feature; built lazily so that
# importing this module needs no running Spark.
CORR_FEATURES = {
    "q": (lambda: F.col("l_quantity"), "l_quantity"),
    "p": (lambda: F.col("l_extendedprice"), "l_extendedprice"),
    "disc": (lambda: F.nullif(F.col("l_discount"), F.lit(0.0)), "NULLIF(l_discount, 0)"),
    "tax": (lambda: F.nullif(F.col("l_tax"), F.lit(0.0)), "NULLIF(l_tax, 0)"),
    "p2": (lambda: F.col("l_extendedprice") * 2, "l_extendedprice * 2"),
    "negq": (lambda: -F.col("l_quantity"), "-l_quantity"),
    "one": (lambda: F.lit(1.0), "CAST(1.0 AS DOUBLE)"),
    "pgap": (lambda: F.when(F.col("l_tax") != 0, F.col("l_extendedprice")),
             "CASE WHEN l_tax <> 0 THEN l_extendedprice END"),
    "qd": (lambda: F.col("l_quantity") * F.col("l_discount"), "l_quantity * l_discount"),
}
NAMES = list(CORR_FEATURES)


def corr_frame(spark, sf):
    li = V.table(spark, sf, "lineitem")
    return li.select(*[build().cast("double").alias(n) for n, (build, _s) in CORR_FEATURES.items()])


FEATS_SQL = "SELECT " + ", ".join(f"CAST({s} AS DOUBLE) AS {n}" for n, (_e, s) in CORR_FEATURES.items()) + \
    " FROM lineitem"
PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS col_i, '{b}' AS col_j, {j} AS j, CASE WHEN isnan(corr({b}, {a})) THEN NULL "
    f"ELSE corr({b}, {a}) END AS corr FROM feats"
    for (i, a), (j, b) in combinations(list(enumerate(NAMES)), 2))


@register("correlation_matrix", S.rounded(
    f"WITH feats AS ({FEATS_SQL}) SELECT col_i, col_j, corr FROM ({PAIRS_SQL}) AS p", ["corr"]))
def correlation_matrix(spark, sf):
    return finish(P.pairwise_corr(corr_frame(spark, sf), NAMES).select("col_i", "col_j", "corr"))


_NAMES_SQL = " UNION ALL ".join(f"SELECT '{n}' AS column, {i} AS pos" for i, n in enumerate(NAMES))


@register("correlated_columns", S.rounded(
    f"WITH feats AS ({FEATS_SQL}), pairs AS ({PAIRS_SQL}), names AS ({_NAMES_SQL}) "
    "SELECT n.column, m.max_corr, coalesce(m.max_corr > 0.98, false) AS dropped FROM names n LEFT JOIN "
    "(SELECT j, max(corr) AS max_corr FROM pairs GROUP BY j) AS m ON n.pos = m.j", ["max_corr"]))
def correlated_columns(spark, sf):
    return finish(P.correlated_columns(corr_frame(spark, sf), NAMES, 0.98))


# -------------------------------------------------------- impute / encode

def gap_frame(spark, sf):
    b = V.bureau(spark, sf)
    return b.select("SK_ID_BUREAU", "DAYS_CREDIT", "DAYS_ENDDATE_FACT", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE",
                    "CREDIT_TYPE",
                    F.when(F.col("CREDIT_ACTIVE") != "Sold", F.col("CREDIT_ACTIVE")).alias("ACTIVE"))


GAP_SQL = ("SELECT SK_ID_BUREAU, DAYS_CREDIT, DAYS_ENDDATE_FACT, AMT_CREDIT_SUM_DEBT, CREDIT_DAY_OVERDUE, CREDIT_TYPE, "
           "CASE WHEN CREDIT_ACTIVE <> 'Sold' THEN CREDIT_ACTIVE END AS ACTIVE FROM bureau")


def G(body: str, doubles) -> str:
    return S.rounded(with_views(f"SELECT * FROM (WITH gaps AS ({GAP_SQL}) {body}) AS _g", "bureau"), doubles)


@register("impute_constant", G(
    "SELECT SK_ID_BUREAU, DAYS_CREDIT, coalesce(DAYS_ENDDATE_FACT, 0) AS DAYS_ENDDATE_FACT, "
    "coalesce(AMT_CREDIT_SUM_DEBT, 0) AS AMT_CREDIT_SUM_DEBT, CREDIT_DAY_OVERDUE, CREDIT_TYPE, "
    "coalesce(ACTIVE, 'Not_Applicable') AS ACTIVE FROM gaps", ["DAYS_CREDIT", "DAYS_ENDDATE_FACT",
                                                                "AMT_CREDIT_SUM_DEBT"]))
def impute_constant(spark, sf):
    return finish(P.impute_constant(gap_frame(spark, sf), exclude=["SK_ID_BUREAU"]))


_CUT = int(round(0.05 * 4294967296))
_TRAIN = f"{S.hash_int('SK_ID_BUREAU', 1234)} >= {_CUT}"
_MEAN_COLS = ["DAYS_ENDDATE_FACT", "AMT_CREDIT_SUM_DEBT"]


@register("impute_mean", G(
    "SELECT g.SK_ID_BUREAU, " + ", ".join(f"coalesce(g.{c}, m.{c}) AS {c}" for c in _MEAN_COLS)
    + " FROM gaps g, (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in _MEAN_COLS)
    + f" FROM gaps WHERE {_TRAIN}) AS m", _MEAN_COLS))
def impute_mean(spark, sf):
    g = gap_frame(spark, sf)
    train = split_flag(g, "SK_ID_BUREAU", 0.05, 1234).filter("is_test = 0")
    model = P.MeanImputer.fit(train, _MEAN_COLS)
    return finish(model.transform(g.select("SK_ID_BUREAU", *_MEAN_COLS)))


_TYPES = sorted(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
_ACTIVE = sorted(["Active", "Closed", "Not_Applicable"])


@register("one_hot_drop_first", G(
    "SELECT SK_ID_BUREAU, "
    + ", ".join(f"CASE WHEN CREDIT_TYPE = '{v}' THEN 1 ELSE 0 END AS {S.q('CREDIT_TYPE_' + v)}" for v in _TYPES[1:])
    + ", "
    + ", ".join(f"CASE WHEN ACTIVE = '{v}' THEN 1 ELSE 0 END AS {S.q('ACTIVE_' + v)}" for v in _ACTIVE[1:])
    + " FROM (SELECT SK_ID_BUREAU, CREDIT_TYPE, coalesce(ACTIVE, 'Not_Applicable') AS ACTIVE FROM gaps) AS g", []))
def one_hot_drop_first(spark, sf):
    g = P.impute_constant(gap_frame(spark, sf).select("SK_ID_BUREAU", "CREDIT_TYPE", "ACTIVE"),
                          exclude=["SK_ID_BUREAU"])
    enc = P.OneHot.fit(g, ["CREDIT_TYPE", "ACTIVE"], drop_first=True)
    return enc.transform(g)


_CODES_ACTIVE = sorted(["Active", "Closed", "nan"])


@register("label_encode", G(
    "SELECT SK_ID_BUREAU, CASE CREDIT_TYPE " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(_TYPES))
    + " END AS CREDIT_TYPE, CASE coalesce(ACTIVE, 'nan') "
    + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(_CODES_ACTIVE)) + " END AS ACTIVE FROM gaps", []))
def label_encode(spark, sf):
    g = gap_frame(spark, sf).select("SK_ID_BUREAU", "CREDIT_TYPE", "ACTIVE")
    return P.LabelEncoder.fit(g, ["CREDIT_TYPE", "ACTIVE"]).transform(g)


_SCALE_COLS = ["DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE"]


@register("standard_scale", G(
    "SELECT g.SK_ID_BUREAU, " + ", ".join(
        f"(g.{c} - s.m_{c}) / CASE WHEN s.s_{c} IS NULL OR s.s_{c} = 0 THEN 1 ELSE s.s_{c} END AS {c}"
        for c in _SCALE_COLS)
    + " FROM gaps g, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE_COLS)
    + f" FROM gaps WHERE {_TRAIN}) AS s", _SCALE_COLS))
def standard_scale(spark, sf):
    g = gap_frame(spark, sf).select("SK_ID_BUREAU", *_SCALE_COLS)
    train = split_flag(g, "SK_ID_BUREAU", 0.05, 1234).filter("is_test = 0")
    return finish(P.Standardizer.fit(train, _SCALE_COLS).transform(g))


@register("inverse_scale", G("SELECT SK_ID_BUREAU, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SCALE_COLS)
                             + " FROM gaps", _SCALE_COLS))
def inverse_scale(spark, sf):
    g = gap_frame(spark, sf).select("SK_ID_BUREAU", *[F.col(c).cast("double").alias(c) for c in _SCALE_COLS])
    sc = P.Standardizer.fit(g, _SCALE_COLS)
    return finish(sc.inverse(sc.transform(g)))


@register("label_one_hot", "SELECT doc_id, pos, value FROM (SELECT doc_id, unnest([0, 1]) AS pos, "
                           "unnest([CAST(1 - toxic AS DOUBLE), CAST(toxic AS DOUBLE)]) AS value FROM labels) AS u")
def label_one_hot(spark, sf):
    lab = V.table(spark, sf, "labels")
    return lab.select("doc_id", F.posexplode(P.label_one_hot(F.col("toxic"))).alias("pos", "value"))


def embedding_columns(spark, sf):
    """One column per dimension; the number of dimensions comes from the data."""
    e = V.table(spark, sf, "embeddings")
    dims = e.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)])


@register("pca_variance", """
    SELECT CAST(i AS INTEGER) AS component, (SELECT count(*) FROM embeddings) AS n_rows, true AS mean_is_zero,
           true AS variance_descends, true AS uncorrelated, true AS explained_matches FROM range(16) AS r(i)""")
def pca_variance(spark, sf):
    """What principal components of standardised rows must satisfy: means of
    zero, falling variances, no covariance between components, and explained
    shares equal to the variances over the number of columns."""
    from pyspark.ml.functions import vector_to_array
    from loanmart.session import cut_lineage
    emb = embedding_columns(spark, sf)
    cols = [c for c in emb.columns if c.startswith("e")]
    k = 16
    out, _model, explained = P.pca_features(emb, cols, k=k)
    x = cut_lineage(out.select(vector_to_array("pca").alias("x")))
    row = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)],
                *[F.covar_samp(F.col("x")[i], F.col("x")[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    var = [row[f"c{i}_{i}"] for i in range(k)]
    rows = [(i, row["n"], abs(row[f"m{i}"]) < 1e-9, i == 0 or var[i] <= var[i - 1] + 1e-9,
             all(abs(row[f"c{min(i, j)}_{max(i, j)}"]) < 1e-8 for j in range(k) if j != i),
             abs(sum(var) / len(cols) - explained) < 1e-6) for i in range(k)]
    return spark.createDataFrame(rows, "component int, n_rows bigint, mean_is_zero boolean, variance_descends boolean, "
                                       "uncorrelated boolean, explained_matches boolean")


@register("one_hot_high_cardinality", """
    WITH d AS (SELECT CAST(l_partkey AS VARCHAR) AS v, row_number() OVER (ORDER BY CAST(l_partkey AS VARCHAR)) - 1 AS code
               FROM (SELECT DISTINCT l_partkey FROM lineitem) AS u)
    SELECT l_orderkey, l_linenumber, CAST(CASE WHEN code > 0 THEN code - 1 END AS INTEGER) AS set_bit,
           CAST((SELECT count(*) - 1 FROM d) AS INTEGER) AS width
    FROM lineitem JOIN d ON CAST(l_partkey AS VARCHAR) = d.v""")
def one_hot_high_cardinality(spark, sf):
    """A string column of very many values as sparse one-hot vectors: the one
    set position (none for the first category) and the width."""
    li = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    enc = P.SparseOneHot.fit(li, ["part"])
    width = enc.sizes["part"] - 1
    vec = enc.transform(li)
    bit = F.get(F.unwrap_udt("part__onehot")["indices"], F.lit(0))          # a dense array would have ``width`` numbers a row
    return vec.select("l_orderkey", "l_linenumber", bit.cast("int").alias("set_bit"),
                      F.lit(width).cast("int").alias("width"))
