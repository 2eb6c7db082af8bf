"""Rebalancing keys (§2.10) on ``embeddings``: label 0 is the minority
class (``minority`` = 1), the other nine labels are the majority."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart.operators import resample as R
from loanmart.operators import ward as W
from loanmart.plans import sqlkit as S
from loanmart.plans import standins as V
from loanmart.plans.queries import finish, register

def emb(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"),
                    (F.col("label") == 0).cast("int").alias("minority"))


E_SQL = ("e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, CAST(label = 0 AS INTEGER) AS minority "
         "FROM embeddings), "
         "u AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e)")


def _assign_sql(where: str) -> str:
    """Nearest label-mean centroid (centroids from the rows in ``where``)."""
    return (f"c AS (SELECT label AS cl, i, avg(v) AS m FROM u WHERE {where} GROUP BY label, i), "
            f"d AS (SELECT u.vec_id, c.cl, sum((u.v - c.m) * (u.v - c.m)) AS d2 FROM u JOIN c ON u.i = c.i "
            f"WHERE {where.replace('label', 'u.label')} GROUP BY u.vec_id, c.cl), "
            "a AS (SELECT vec_id, CAST(arg_min(cl, d2) AS INTEGER) AS cluster FROM d GROUP BY vec_id)")


@register("class_balance", S.rounded(
    f"WITH {E_SQL} SELECT minority, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM e "
    "GROUP BY minority", ["share"]))
def class_balance(spark, sf):
    return finish(R.class_balance(emb(spark, sf), "minority"))


@register("nearest_centroid", f"WITH {E_SQL}, {_assign_sql('label >= 0')} SELECT vec_id, cluster FROM a")
def nearest_centroid(spark, sf):
    e = emb(spark, sf)
    cents = R.group_means(e, "label", "x")
    return R.nearest_centroid(e, "x", cents).select("vec_id", F.col("cluster").cast("int"))


@register("cluster_quota_sample", f"""
    WITH {E_SQL}, {_assign_sql('label <> 0')},
    t AS (SELECT count(*) AS T FROM e WHERE minority = 1),
    sizes AS (SELECT cluster, count(*) AS size FROM a GROUP BY cluster),
    q0 AS (SELECT cluster, (t.T * size) // tot.N AS base, (t.T * size) % tot.N AS rem
           FROM sizes, t, (SELECT sum(size) AS N FROM sizes) AS tot),
    q AS (SELECT cluster, CAST(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, cluster)
                      <= (SELECT T FROM t) - (SELECT sum(base) FROM q0) THEN 1 ELSE 0 END AS INTEGER) AS quota
          FROM q0),
    ranked AS (SELECT vec_id, cluster, row_number() OVER (PARTITION BY cluster
                      ORDER BY {S.hash_int('vec_id', 11)}, vec_id) AS rn FROM a)
    SELECT r.vec_id, r.cluster FROM ranked r JOIN q ON r.cluster = q.cluster WHERE r.rn <= q.quota""")
def cluster_quota_sample(spark, sf):
    e = emb(spark, sf)
    maj = e.filter(F.col("minority") == 0)
    cents = R.group_means(maj, "label", "x")
    target = e.filter(F.col("minority") == 1).count()
    assigned = R.nearest_centroid(maj, "x", cents).withColumn("cluster", F.col("cluster").cast("int"))
    return R.quota_sample(assigned, "vec_id", "cluster", target, seed=11).select("vec_id", "cluster")


@register("random_undersample", f"""
    WITH {E_SQL}
    SELECT vec_id, minority FROM e WHERE minority = 1
    UNION ALL
    SELECT vec_id, minority FROM (SELECT vec_id, minority, row_number() OVER (
        ORDER BY {S.hash_int('vec_id', 5)}, vec_id) AS rn FROM e WHERE minority = 0) AS n
    WHERE rn <= (SELECT count(*) FROM e WHERE minority = 1)""")
def random_undersample(spark, sf):
    e = emb(spark, sf).select("vec_id", "minority")
    return R.random_undersample(e, "vec_id", "minority", seed=5)


KNN_SQL = ("m AS (SELECT vec_id, x FROM e WHERE minority = 1), "
           "nn AS (SELECT vec_id, nbr_id, CAST(nbr_rank AS INTEGER) AS nbr_rank, dist FROM ("
           "SELECT a.vec_id, b.vec_id AS nbr_id, list_distance(a.x, b.x) AS dist, row_number() OVER ("
           "PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS nbr_rank "
           "FROM m a JOIN m b ON a.vec_id <> b.vec_id) AS p WHERE nbr_rank <= 5)")


@register("knn_minority", S.rounded(f"WITH {E_SQL}, {KNN_SQL} SELECT * FROM nn", ["dist"]))
def knn_minority(spark, sf):
    m = emb(spark, sf).filter(F.col("minority") == 1)
    return finish(R.knn(m, "vec_id", "x", k=5, cell_rows=16))


_KEY = "CAST(j.vec_id AS VARCHAR) || ':' || CAST(j.syn_id AS VARCHAR)"


@register("smote", S.rounded(f"""
    WITH {E_SQL}, {KNN_SQL},
    idx AS (SELECT vec_id, x, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM m),
    cnt AS (SELECT (SELECT count(*) FROM m) AS n,
                   (SELECT count(*) FROM e WHERE minority = 0) - (SELECT count(*) FROM m) AS need),
    jobs AS (SELECT idx.vec_id, idx.x, r.syn_id FROM idx, cnt, range(0, cnt.need) AS r(syn_id)
             WHERE r.syn_id % cnt.n = idx.i),
    picked AS (SELECT j.vec_id, j.x, j.syn_id,
                      CAST(({S.hash_int(_KEY, '1:n').replace("CAST(" + _KEY + " AS VARCHAR)", "(" + _KEY + ")")}
                            % 5) + 1 AS INTEGER) AS pick,
                      CAST({S.hash_int(_KEY, '1:u').replace("CAST(" + _KEY + " AS VARCHAR)", "(" + _KEY + ")")}
                           AS DOUBLE) / 4294967296.0 AS u
               FROM jobs j),
    gen AS (SELECT p.syn_id, p.x, p.u, y.x AS y FROM picked p
            JOIN nn ON nn.vec_id = p.vec_id AND nn.nbr_rank = p.pick
            JOIN m y ON y.vec_id = nn.nbr_id)
    SELECT syn_id, CAST(i - 1 AS INTEGER) AS pos, x[i] + u * (y[i] - x[i]) AS value
    FROM gen, unnest(generate_series(1, len(x))) AS s(i)""", ["value"]))
def smote(spark, sf):
    e = emb(spark, sf)
    m = e.filter(F.col("minority") == 1)
    n_new = e.filter(F.col("minority") == 0).count() - m.count()
    syn = R.smote(m, "vec_id", "x", n_new, k=5, seed=1)
    return finish(syn.select("syn_id", F.posexplode("vector").alias("pos", "value")))


@register("cluster_undersample", """
    SELECT CAST(label = 0 AS INTEGER) AS minority, (SELECT count(*) FROM embeddings WHERE label = 0) AS n_rows,
           (SELECT count(*) FROM embeddings WHERE label = 0) AS n_ids, true AS from_the_table
    FROM embeddings GROUP BY 1""")
def cluster_undersample(spark, sf):
    """Both classes have the minority's size; all rows are rows of the table."""
    e = emb(spark, sf)
    kept = R.cluster_undersample(e, "vec_id", "minority", "x", seed=3, negative=0, positive=1).select("vec_id", "minority")
    real = e.select(F.col("vec_id").alias("_v"), F.col("minority").alias("_m"))
    joined = kept.join(real, F.col("vec_id") == F.col("_v"), "left")
    return joined.groupBy("minority").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("vec_id").alias("n_ids"),
                                          F.bool_and(F.coalesce(F.col("_m") == F.col("minority"), F.lit(False))).alias("from_the_table"))


@register("ward_undersample")
def ward_undersample(spark, sf):
    """The kept majority rows, one for each of as many Ward clusters as there are minority rows, and their cluster's size."""
    e = emb(spark, sf)
    maj = W.standardised(e.filter("minority = 0"), "x")
    clusters = W.ward_clusters(maj, "vec_id", "x", e.filter("minority = 1").count())
    return W.one_per_cluster(clusters, "vec_id", seed=3)


@register("under_over_sample", """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (label = 0) AS pos, count(*) FILTER (label <> 0) AS neg FROM embeddings),
    k AS (SELECT least((n + 1) // 2, neg) AS keep, pos FROM c),
    r AS (SELECT 0 AS label, false AS synthetic, keep AS n_rows FROM k UNION ALL SELECT 1, false, pos FROM k
          UNION ALL SELECT 1, true, keep - pos FROM k)
    SELECT CAST(label AS INTEGER) AS label, synthetic, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_rows AS BIGINT) AS n_ids,
           (SELECT CAST(max(len(embedding)) AS INTEGER) FROM embeddings) AS dims, NOT synthetic AS known_ids
    FROM r WHERE n_rows > 0""")
def under_over_sample(spark, sf):
    """Rows, distinct ids and vector length per class and origin; real rows
    keep their ids and class, synthetic ones have ids of their own."""
    e = emb(spark, sf).select("vec_id", "minority", "x")
    out = R.under_over_sample(e, "vec_id", "minority", "x", seed=3)
    real = e.select(F.col("vec_id").alias("_v"), F.col("minority").alias("_m"))
    joined = out.join(real, F.col("row_id") == F.col("_v"), "left")
    return joined.groupBy(F.col("label").cast("int").alias("label"), "synthetic").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"), F.max(F.size("vector")).alias("dims"),
        F.bool_and(F.coalesce(F.col("_m") == F.col("label"), F.lit(False))).alias("known_ids"))
