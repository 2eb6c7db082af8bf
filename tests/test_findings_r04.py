"""Findings of round 4: disk and time that grew faster than they need to."""

from pyspark.sql import functions as F


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_stored_rows_leave_no_shuffle_files(spark):
    from loanmart.session import CLEANUP, store_rows
    rows = spark.range(400).select((F.col("id") % 37).alias("k"), "id").union(spark.createDataFrame([(None, 1), (3, None)], "k bigint, id bigint"))
    sums = rows.groupBy("k").agg(F.sum("id").alias("s"))
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    kept = store_rows(sums, "sums")
    assert not shuffle_files(spark) - before and spark.conf.get(CLEANUP, None) == setting
    assert sorted(map(str, kept.collect())) == sorted(map(str, sums.collect())) and kept.count() == 38


def test_children_of_a_parent_are_stored_side_by_side(spark, monkeypatch):
    """The aggregate of a child then makes one row of partial sums a parent, not one in every task."""
    import loanmart.session as session
    from loanmart.operators import synth as D
    stored, store = {}, session.store_rows

    def seen(df, name):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(session, "store_rows", seen)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        es = D.EntitySet().add("a", spark.createDataFrame([(i,) for i in range(9)] + [(None,)], "a bigint"), "a")
        es.add("b", spark.createDataFrame([(i if i % 19 else None, i * 7 % 10 if i % 5 else None, float(i)) for i in range(300)],
                                          "b bigint, a bigint, x double").repartition(3), "b")
        es.add("c", spark.createDataFrame([(i % 290, float(i % 7)) for i in range(900)], "b bigint, v double").repartition(3), "none")
        es.relate("a", "a", "b", "a").relate("b", "b", "c", "b")
        got = {r["a"]: (r["COUNT(b)"], r["SUM(b.x)"]) for r in D.synthesize(es, "a", depth=2).collect()}
        places = stored["child"].select("a", F.input_file_name().alias("f")).distinct().groupBy("a").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {"states", "sums", "child"} <= set(stored) and stored["child"].inputFiles()[1:]
    assert places.agg(F.max("count")).first()[0] == 1
    mine = {a: [float(i) for i in range(300) if i % 5 and i * 7 % 10 == a] for a in range(9)}
    assert got == {**{a: (len(x), sum(x)) for a, x in mine.items()}, None: (0, 0.0)}


def test_the_mart_is_stored_by_columns(spark, monkeypatch):
    """Its many columns compressed, and without the shuffles of its blocks; only the rows of learners that bin values stay checkpoints."""
    from loanmart.plans import mart as MT
    stored, store = [], MT.store_rows

    def seen(df, name):
        stored.append(name)
        return store(df, name)

    monkeypatch.setattr(MT, "store_rows", seen)
    rows = [(i, float(i % 3 == 0), float(i % 7) if i % 5 else None, "ab"[i % 2] if i % 11 else None) for i in range(120)]
    mart = spark.createDataFrame(rows, "k bigint, y double, amount double, s string")
    p = MT.prepare(mart, "k", "y", test_size=0.3)
    assert stored == ["mart", "train", "test"] and p.features == ["amount", "s__onehot"]
    both = p.train.union(p.test).collect()
    assert sorted(r["k"] for r in both) == list(range(120)) and all((r["y"], r["amount"]) == (rows[r["k"]][1], rows[r["k"]][2] or 0.0) for r in both)
    assert MT.feature_width(p.train, p.features) == 3       # two values and the filled one, the first left out
    MT.prepare(mart, "k", "y", test_size=0.3, encoding="label")
    assert len(stored) == 3


def test_blocks_of_knn_compare_few_pairs(monkeypatch):
    """Near pairs by a matrix product, exact distances of those alone; the same neighbours as all differences give."""
    import numpy as np
    from loanmart.operators import resample as R
    rng = np.random.default_rng(4)
    plain = rng.normal(size=(400, 24))
    cases = {"plain": plain, "copies": np.repeat(plain[:80], 5, 0), "far": 1e9 + plain, "grid": rng.integers(0, 2, (400, 6)).astype(float),
             "huge": plain * 1e160, "missing": np.where(np.arange(400)[:, None] == 7, np.nan, plain)}
    pairs, exact = [], R._pair_sq_dist

    def counted(a, b, i, j):
        pairs.append(len(i))
        return exact(a, b, i, j)

    monkeypatch.setattr(R, "_pair_sq_dist", counted)
    for name, x in cases.items():
        number = rng.permutation(len(x))
        most = np.where(rng.random(len(x)) < 0.3, np.inf, np.sqrt(x.shape[1]) * (1e160 if name == "huge" else 1.0))
        with np.errstate(all="ignore"):
            d = np.sqrt(R._sq_dist(x, x))
        d[np.arange(len(x)), np.arange(len(x))] = np.inf
        want = []
        for i in range(len(x)):
            order = [j for j in np.lexsort((number, d[i])) if np.isfinite(d[i, j]) and d[i, j] <= most[i]][:5]
            want += [(i, int(j), d[i, j]) for j in order]
        pairs.clear()
        row, other, dist = R._closest(x, x, 5, (number, number), most)
        assert [(int(i), int(j)) for i, j in zip(row, other)] == [w[:2] for w in want], name
        assert np.allclose(dist, [w[2] for w in want], rtol=1e-14, atol=0)
        if name == "plain":
            assert sum(pairs) <= 5 * len(x) + 50             # of 160,000
    assert all(len(c) == 0 for c in R._closest(plain[:0], plain, 5)) and all(len(c) == 0 for c in R._closest(plain, plain[:0], 5))
