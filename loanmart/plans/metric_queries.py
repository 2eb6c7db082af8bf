"""Metric keys (§2.12) on a scored stand-in: ``labels`` (toxic = label) joined
to ``documents`` with a score made from the document length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.operators import metrics as M
from loanmart.plans import sqlkit as S
from loanmart.plans import standins as V
from loanmart.plans.queries import finish, register

SCORED_SQL = ("SELECT l.doc_id, l.toxic AS label, (CAST(d.n_chars % 70 AS DOUBLE) + 30 * l.toxic) / 100.0 AS score "
              "FROM labels l JOIN documents d ON l.doc_id = d.doc_id")


def scored(spark, sf) -> DataFrame:
    lab = V.table(spark, sf, "labels")
    docs = V.table(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    return j.select("doc_id", F.col("toxic").alias("label"),
                    ((F.col("n_chars") % 70).cast("double") + 30 * F.col("toxic")) / 100.0).toDF(
        "doc_id", "label", "score")


def W(body: str, doubles) -> str:
    return S.rounded(f"WITH scored AS ({SCORED_SQL}) {body}", doubles)


CONF = ("count(*) FILTER (WHERE NOT (score > {t}) AND label <> 1) AS tn, "
        "count(*) FILTER (WHERE score > {t} AND label <> 1) AS fp, "
        "count(*) FILTER (WHERE NOT (score > {t}) AND label = 1) AS fn, "
        "count(*) FILTER (WHERE score > {t} AND label = 1) AS tp")
T01 = "CAST(0.1 AS DOUBLE)"


@register("metric_auc", W(
    "SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM ("
    "SELECT CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg, CAST(coalesce(sum(neg) OVER (ORDER BY score "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS below FROM ("
    "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg "
    "FROM scored GROUP BY score) AS g) AS c", ["auc"]))
def metric_auc(spark, sf):
    return finish(M.auc(scored(spark, sf)))


@register("metric_confusion", W(f"SELECT {CONF.format(t=T01)} FROM scored", []))
def metric_confusion(spark, sf):
    return M.confusion(scored(spark, sf), threshold=0.1)


_PRF = ("SELECT precision, recall, 2.0 * precision * recall / NULLIF(precision + recall, 0) AS f1 FROM ("
        "SELECT CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) AS recall "
        "FROM (SELECT {conf} FROM scored) AS c) AS p")


@register("metric_prf", W(_PRF.format(conf=CONF.format(t=T01)), ["precision", "recall", "f1"]))
def metric_prf(spark, sf):
    return finish(M.precision_recall_f1(scored(spark, sf), threshold=0.1))


@register("metric_kappa", W(
    "SELECT (po - pe) / NULLIF(1.0 - pe, 0) AS kappa FROM ("
    "SELECT (tp + tn) / n AS po, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS pe FROM ("
    "SELECT CAST(tp AS DOUBLE) AS tp, CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, "
    "CAST(tp + tn + fp + fn AS DOUBLE) AS n FROM (SELECT " + CONF.format(t=T01) + " FROM scored) AS c0) AS c1) AS c2",
    ["kappa"]))
def metric_kappa(spark, sf):
    return finish(M.kappa(scored(spark, sf), threshold=0.1))


_CURVE = ("SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps, "
          "sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps FROM ("
          "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg "
          "FROM scored GROUP BY score) AS g")
_TOT = "(SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label <> 1) AS N, max(score) AS top " \
       "FROM scored)"


@register("roc_points", W(
    f"SELECT c.score AS threshold, CAST(c.fps AS DOUBLE) / t.N AS fpr, CAST(c.tps AS DOUBLE) / t.P AS tpr "
    f"FROM ({_CURVE}) AS c, {_TOT} AS t UNION ALL SELECT top + 1, 0.0, 0.0 FROM {_TOT} AS t2",
    ["threshold", "fpr", "tpr"]))
def roc_points(spark, sf):
    return finish(M.roc_points(scored(spark, sf)))


@register("pr_points", W(
    f"SELECT c.score AS threshold, coalesce(CAST(c.tps AS DOUBLE) / NULLIF(c.tps + c.fps, 0), 0.0) AS precision, "
    f"CAST(c.tps AS DOUBLE) / t.P AS recall FROM ({_CURVE}) AS c, {_TOT} AS t "
    f"WHERE c.score >= (SELECT max(score) FROM ({_CURVE}) AS c2 WHERE c2.tps = (SELECT P FROM {_TOT} AS t3)) "
    "UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0",
    ["threshold", "precision", "recall"]))
def pr_points(spark, sf):
    return finish(M.pr_points(scored(spark, sf)))


def _threshold_sql():
    parts = []
    for t in M.DEFAULT_THRESHOLDS:
        lit = f"CAST({t!r} AS DOUBLE)"
        parts.append(f"SELECT {lit} AS threshold, {CONF.format(t=lit)} FROM scored")
    union = " UNION ALL ".join(parts)
    return W("SELECT threshold, tn, fp, fn, tp, precision, recall, "
             "2.0 * precision * recall / NULLIF(precision + recall, 0) AS f1 FROM ("
             "SELECT *, CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision, "
             f"CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) AS recall FROM ({union}) AS u) AS v",
             ["threshold", "precision", "recall", "f1"])


@register("threshold_table", _threshold_sql())
def threshold_table(spark, sf):
    return finish(M.threshold_table(scored(spark, sf)))
