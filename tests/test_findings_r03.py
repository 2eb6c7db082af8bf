"""Findings of round 3: work that grew faster than its input."""


def test_one_hot_of_many_values_makes_no_dense_rows(spark, tmp_path):
    from loanmart.plans.prep_queries import one_hot_high_cardinality
    parts = [None if i % 7 == 3 else i % 50 for i in range(400)]
    rows = [(i // 4, i % 4, p) for i, p in enumerate(parts)]
    spark.createDataFrame(rows + rows[:9], "l_orderkey bigint, l_linenumber int, l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = one_hot_high_cardinality(spark, str(tmp_path))
    plan = got._jdf.queryExecution().toString()
    assert "array_position" not in plan and "indices" in plan              # an array of all categories a row is quadratic
    order = {p: k for k, p in enumerate(sorted({str(p) for p in parts if p is not None}))}
    bit = lambda p: None if p is None or not order[str(p)] else order[str(p)] - 1
    want = [(o, n, bit(p), len(order) - 1) for o, n, p in rows + rows[:9]]
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_chained_steps_are_single_steps(spark, monkeypatch):
    import numpy as np
    from loanmart.operators import network as N
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 5))
    df = spark.createDataFrame([(i, int(v[0] + v[1] > 0), v.tolist()) for i, v in enumerate(x)], "id bigint, y int, x array<double>").repartition(3)
    p = N.NetParams(epochs=3, batch_rows=40, micro_rows=20, rate=0.02, valid_share=0.1)
    tracker, jobs = spark.sparkContext, {}

    def fit(name):
        tracker.setJobGroup(name, name)
        m = N.fit_network(df, "id", "y", "x", (5,), N.connected((8, 4), 0.2), p)
        jobs[name] = len(tracker.statusTracker().getJobIdsForGroup(name))
        tracker.setLocalProperty("spark.jobGroup.id", None)
        return m

    chained = fit("chained")
    monkeypatch.setattr(N, "CHAIN_BYTES", 40 * 5 * 8 * 7)                   # seven steps a chain
    short = fit("short")
    monkeypatch.setattr(N, "CHAIN_MICROS", 0)
    single = fit("single")
    for m in (chained, short):
        assert np.array_equal(m.weights, single.weights) and np.array_equal(m.stats, single.stats) and m.history == single.history
    assert jobs["chained"] < jobs["short"] < jobs["single"] and jobs["single"] - jobs["chained"] > 40           # 16 steps an epoch


def test_joins_of_large_tables_keep_all_partitions(spark, tmp_path, monkeypatch):
    from loanmart.operators import joins as J
    base = spark.range(60).withColumnRenamed("id", "k")
    parts = []
    for name in "abc":
        spark.createDataFrame([(i % 50 if i % 9 else None, i) for i in range(300)], f"k bigint, {name} int").write.parquet(f"{tmp_path}/{name}")
        parts.append(spark.read.parquet(f"{tmp_path}/{name}").groupBy("k").agg({name: "max"}))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = J.left_join_all(base, parts, "k")
        monkeypatch.setattr(J, "SPREAD_BYTES", 100)
        large = J.left_join_all(base, parts, "k")
        rows = sorted(map(str, large.collect()))
        assert rows == sorted(map(str, small.collect())) and len(rows) == 60
        assert large.rdd.getNumPartitions() == 4 and small.rdd.getNumPartitions() == 1        # four shuffle partitions, merged by AQE
        count = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange")
        assert count(large) == count(small)                 # no shuffle is added
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_knn_batches_and_slices_follow_the_width(spark, monkeypatch):
    """Copies of rows leave in batches of bounded size, and a block meets rows by their numbers: all neighbours stay."""
    import numpy as np
    from loanmart.operators import resample as R
    x = np.random.default_rng(2).normal(size=(400, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>")
    monkeypatch.setattr(R, "PROBE_VALUES", 16 * 50)                          # 50 rows
    monkeypatch.setattr(R, "BATCH_VALUES", 16 * 30)
    points, probes = R._pivot_cells(df, "id", "x", 3, 2048, 7)
    seen = probes.groupBy("_c", "_s", "_q").count().agg({"count": "max"}).first()[0]
    assert seen <= 100 and points.agg({"_q": "max"}).first()[0] >= 5         # 400 rows ask a block: by hash about 50 a slice
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    got = {(r["id"], r["nbr_rank"]): r["nbr_id"] for r in R.knn(df, "id", "x", 3).collect()}
    assert got == {(i, k + 1): int(j) for i in range(400) for k, j in enumerate(np.argsort(d[i], kind="stable")[:3])}


def test_children_of_a_synthesis_are_stored_by_columns(spark):
    from pyspark.sql import functions as F

    from loanmart.operators import synth as D
    from loanmart.session import store_rows

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    rows = [(i if i % 13 else None, float(i % 2), float(i * 7 % 11) if i % 5 else None, "ab"[i % 2] if i % 3 else None) for i in range(200)]
    mart = spark.createDataFrame(rows + rows[:20], "k bigint, y double, `MAX(a.b)` double, s string")
    kept = store_rows(mart, "rows")
    assert kept.schema == mart.schema and sorted(map(str, kept.collect())) == sorted(map(str, mart.collect()))
    es = D.EntitySet().add("a", spark.createDataFrame([(1,), (2,), (None,)], "a bigint"), "a")
    es.add("b", spark.createDataFrame([(1, 1, "x"), (2, 1, None), (3, None, "y"), (None, 2, "x")], "b bigint, a bigint, s string"), "b")
    es.add("c", spark.createDataFrame([(1, 2.0, "u"), (1, 4.0, "v"), (3, 1.0, "u"), (None, 9.0, "u")], "b bigint, v double, t string"), "none")
    es.relate("a", "a", "b", "a").relate("b", "b", "c", "b")
    out = D.synthesize(es, "a", depth=2)
    got = {r["a"]: (r["COUNT(b)"], r["SUM(b.SUM(c.v))"], r["NUM_UNIQUE(c.t)"], r["MODE(c.t)"]) for r in out.collect()}
    assert got == {1: (2, 6.0, 2, "u"), 2: (1, 0.0, None, None), None: (0, 0.0, None, None)}
    assert "FileScan parquet" in plan(out)
    odd = store_rows(mart.select("k", F.lit(None).alias("nothing")), "odd")
    assert odd.count() == 220 and odd.columns == ["k", "nothing"]
