"""Merkle manifest against a plain tree over whole lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.cases import by_id


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(row):
    levels = [row]
    while len(levels[-1]) > 1:
        r = levels[-1]
        levels.append([h(*r[i:i + 2]) for i in range(0, len(r), 2)])
    return levels


def plain_manifest(rows):
    """rows: (id, group, leaf, tampered); (id, leaf, subroot, root, proof, folded root) of each."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_levels([r[2] for r in sorted(groups[g], key=lambda r: (r[0] is None, r[0] or 0, r[2]))]) for g in order}
    top = plain_levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(sorted(groups[g], key=lambda r: (r[0] is None, r[0] or 0, r[2]))):
            node, proof = r[3] or r[2], []
            for levels, at in ((trees[g], i), (top, k)):
                for row in levels[:-1]:
                    other = at ^ 1
                    if other < len(row):
                        proof.append(row[other])
                        node = h(row[other], node) if other < at else h(node, row[other])
                    else:
                        node = h(node)
                    at >>= 1
            out.append((r[0], r[2], trees[g][-1][0], top[-1][0], h(*proof), node))
    return out


def digests(df):
    return df.select("id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", "").cast("binary"), 256), "folded_root").collect()


@pytest.mark.parametrize("block_levels", [1, 2, 12])
def test_manifest_of_odd_groups(spark, block_levels):
    """Groups of 1, 2, 5, 8, 9 and 70 rows, a NULL group, NULL and equal ids, equal rows."""
    from loanmart.llm.merkle import manifest
    rows, i = [], 0
    for g, n in (("a", 1), ("é", 2), (None, 5), ("", 8), ("b", 9), ("zz", 70)):
        for _ in range(n):
            i += 1
            rows.append((i * 37 % 1009, g, h(str(i)), h("x", str(i)) if i % 3 == 0 else None))
    rows += [(None, "b", h("q"), None), (None, "b", h("p"), h("pp")), (5, "b", h("5"), None), (5, "b", h("5"), None), (5, "b", h("4"), None)]
    df = spark.createDataFrame(rows, "id bigint, grp string, d string, c string").withColumn("tree", F.lit(7)).repartition(5)
    got = manifest(df, "id", "grp", F.col("d"), F.col("c"), block_levels)
    assert by_id(digests(got)) == by_id(plain_manifest(rows))
    for r in got.collect():
        assert (r["copied"] is None) == (r["folded_root"] == r["root"])
        assert r["copied"] is None or (r["copied"][-1] == r["folded_root"] and r["leaf"] not in r["copied"])
    assert manifest(df.limit(0), "id", "grp", F.col("d"), F.col("c"), block_levels).count() == 0


def test_versions_share_nodes():
    from loanmart.llm.merkle import Block, digest, fold, pack, unpack
    leaves = [digest(bytes([i])) for i in range(13)]
    b = Block(leaves, 4)
    before, size = list(b.digests), len(b.digests)
    tops = [b.digests[b.change(i, digest(b"new%d" % i))[-1]] for i in range(13)]
    assert b.digests[:size] == before and len(b.digests) == size + 13 * 5      # copies of one path each
    for i, t in enumerate(tops):
        changed = leaves[:i] + [digest(b"new%d" % i)] + leaves[i + 1:]
        assert t.decode() == plain_levels([x.decode() for x in changed])[-1][0]
        s = b.siblings(i)
        assert unpack(pack(s)) == s and fold(leaves[i], s)[-1] == before[b.top]


def test_op13_against_plain(spark):
    from loanmart.llm.merkle import op13_merkle
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    rows = []
    for d, s, g, n, t in docs:
        other = h(*map(enc, (d, s, g, n + 1, t))) if zlib.crc32(str(d).encode()) % 7 == 0 else None
        rows.append((d, g, h(*map(enc, (d, s, g, n, t))), other))
    want = [(*r, r[-1] == r[3]) for r in plain_manifest(rows)]
    assert by_id(op13_merkle(spark, SF001).collect()) == by_id(want) and 0 < sum(not w[-1] for w in want) < len(want)


def test_nulls_in_hashed_columns(spark, tmp_path):
    from loanmart.llm.merkle import op13_merkle
    rows = [(None, None, None, None, None), (1, "s", "en", None, "t"), (7, "", "", 0, ""), (14, "s", "en", 2 ** 63 - 1, "é" * 9000), (14, "s", "en", 3, "x")]
    ddl = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["leaf"]): r["verified"] for r in op13_merkle(spark, str(tmp_path)).collect()}
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
        assert got[r[0], h(*map(enc, r))] == (not hit)
    spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_merkle(spark, f"{tmp_path}/none").count() == 0
