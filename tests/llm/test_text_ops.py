"""Operators on single texts against plain Python versions."""

import collections
import hashlib

import numpy as np
import pytest
import regex
import xxhash

from tests.conftest import SF001
from tests.llm.cases import ODD, by_id, odd_docs, texts

WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---------------------------------------------------------------- byte-level BPE

@pytest.fixture(scope="module")
def tik():
    import base64
    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_tiktoken(spark, tik):
    from loanmart.llm.bpe import decode, encode, op1_byte_bpe, public_ranks
    want = []
    for i, t in texts(SF001):
        ids = np.array(tik.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_id(op1_byte_bpe(spark, SF001).collect()) == by_id(want)
    odd = decode(encode(odd_docs(spark), *public_ranks()), *public_ranks()).collect()
    assert len(odd) == len(ODD)
    for r in odd:
        assert np.frombuffer(r["ids"], "<u4").tolist() == tik.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and r["n_words"] is not None
    assert encode(odd_docs(spark).limit(0), *public_ranks()).count() == 0


def test_bpe_ranks_out_of_merge_order(tmp_path):
    """A pair may get a lower rank than one that waits: the lower goes first."""
    import base64
    import tiktoken
    from loanmart.llm.bpe import Bpe
    words = [bytes([b]) for b in range(256)]
    more = [b"abab", b"cd", b"ab", b"abc", b"ababcd", b"bab", b"aba"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % i for i, w in enumerate(words + more)))
    bpe = Bpe(str(path), r"\S+|\s+")
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=bpe.rank, special_tokens={})
    rng = np.random.default_rng(0)
    for _ in range(300):
        t = "".join(rng.choice(list("abcd"), rng.integers(0, 40)))
        assert np.frombuffer(bpe.encode(t), "<u4").tolist() == enc.encode_ordinary(t)


# ---------------------------------------------------------------- quality rules

def plain_counts(t):
    t = t or ""
    w = WORD.findall(t)
    grams = list(zip(w, w[1:], w[2:]))
    often = collections.Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(regex.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def test_quality_counts(spark):
    from loanmart.llm.quality import judge, op5_quality
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = op5_quality(spark, SF001).collect()
    assert by_id(tuple(r[c] for c in cols) for r in got) == by_id((i, *plain_counts(t)) for i, t in texts(SF001))
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    odd = judge(odd_docs(spark)).collect()
    assert by_id(tuple(r[c] for c in cols) for r in odd) == by_id((i, *plain_counts(t)) for i, t in ODD)
    assert judge(odd_docs(spark).limit(0)).count() == 0


def test_quality_agrees_with_labels(spark):
    from loanmart.llm.quality import op5_quality
    path = SF001.replace("0.001", "0.01")
    got = op5_quality(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    bad = [r["kept"] for r in got if r["quality"] == 0]
    good = [r["kept"] for r in got if r["quality"] == 1 and not r["base_failed"]]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.97 * len(good)


def test_em_finds_the_rare_class():
    from loanmart.llm.quality import fit
    p = fit({13: 900, 4: 30, 10: 30, 12: 40}, 3)   # 13: no votes; others one bad vote
    assert p[13] > 0.9 and max(p[4], p[10], p[12]) < 0.5 and fit({}, 3) == {}


# ---------------------------------------------------------------- decontamination

def plain_hits(docs, items, k=10):
    pat = regex.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pat.findall((t or "").encode().lower())
    wins = [(str("" if i is None else i), tuple(w[j:j + k])) for i, t in items if (w := words(t))
            for j in range(max(1, len(w) - k + 1))]
    sizes = {len(w) for _, w in wins}
    by = collections.defaultdict(set)
    for i, w in wins:
        by[w].add(i)
    out = []
    for i, t in docs:
        w, hit, its = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (x := by.get(tuple(w[s:s + n]))):
                    hit.update(range(s, s + n))
                    its |= x
        out.append((i, len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("chunk", [16 << 20, 700])
def test_decontamination_against_plain(spark, chunk):
    from pyspark.sql import functions as F
    from loanmart.llm.decontaminate import decontaminate
    items = [(1, "sat on the mat. The cat"), (2, "mat"), (2, "mat"), (None, "only a few"), (4, None), (5, " ?! "),
             (6, "one TWO three four five six seven eight nine ten eleven twelve"), (7, "x y " * 30), (8, "éTé")]
    df = decontaminate(odd_docs(spark), spark.createDataFrame(items, "item_id bigint, text string"), chunk_bytes=chunk)
    got = df.select("doc_id", "n_words", "n_hit", F.size("item_ids"), F.sha2(F.concat_ws(",", "item_ids"), 256),
                    F.col("n_hit") > 0).collect()
    assert by_id(got) == by_id(plain_hits(ODD, items))


def test_decontamination_of_the_tables(spark):
    import duckdb
    from loanmart.llm.decontaminate import op9_decontaminate
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    want = plain_hits(texts(SF001), items)
    assert by_id(op9_decontaminate(spark, SF001).collect()) == by_id(want) and any(w[-1] for w in want)


def test_decontamination_of_empty_tables(spark):
    from loanmart.llm.decontaminate import decontaminate
    items = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    assert decontaminate(odd_docs(spark).limit(0), items).count() == 0
    got = decontaminate(odd_docs(spark), items.limit(0)).select("n_hit", "item_ids", "ids").collect()
    assert len(got) == len(ODD) and all(r["n_hit"] == 0 and r["item_ids"] == [] for r in got) and {r["ids"] for r in got} == {"s"}


# ---------------------------------------------------------------- SimHash

def plain_simhash(t, k=4):
    w = lower(t).encode().split()
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(rows, most=4):
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [(i, f"{f:016x}", least.get(find(f))) for i, f in rows]


def test_simhash_against_plain(spark):
    from loanmart.llm.simhash import op6_simhash
    want = plain_components([(i, plain_simhash(t)) for i, t in texts(SF001)])
    assert by_id(op6_simhash(spark, SF001).collect()) == by_id(want)


def test_simhash_odd_rows_and_keep_one(spark):
    from pyspark.sql import functions as F
    from loanmart.llm.simhash import keep_one, near_duplicates
    found = near_duplicates(odd_docs(spark))
    want = plain_components([(i, plain_simhash(t)) for i, t in ODD])
    got = found.select("id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert by_id(got) == by_id(want)
    kept = keep_one(odd_docs(spark)).collect()
    assert len(kept) == len({r["root"] for r in found.collect()}) and set(kept[0].asDict()) == set(odd_docs(spark).columns)
    assert near_duplicates(odd_docs(spark).limit(0)).count() == 0 and keep_one(odd_docs(spark).limit(0)).count() == 0


def test_vantage_tree_shards_find_every_pair(spark):
    from loanmart.llm import simhash
    from loanmart.llm.common import components
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    near = base.copy()
    for i in range(len(near)):
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    ball = np.array([base[0] ^ np.uint64((1 << i) | (1 << j)) for i in range(64) for j in range(i)], np.uint64)
    fps = np.unique(np.concatenate([base, near, ball]))
    old = simhash.SHARD_POINTS
    simhash.SHARD_POINTS = 300
    try:
        df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
        got = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    finally:
        simhash.SHARD_POINTS = old
    far = np.bitwise_count(fps[:, None] ^ fps[None, :])
    a, b = np.nonzero(np.triu(far <= 4, 1))
    from loanmart.llm.common import local_forest
    s = fps.view(np.int64)
    node, root = local_forest(s[a], s[b])
    want = dict(zip(node.tolist(), root.tolist())) | {r: r for r in root.tolist()}
    assert got == want


def test_quality_from_written_counts_is_the_same(spark):
    from loanmart.llm import quality as Q
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate([None, "", "a b", "word " * 60, "one two three four. " * 30, "x#y " * 80,
                                                                   " ".join(f"w{k}" for k in range(90)) + "."] * 3)],
                                 "doc_id int, text string, n_words int")
    want = sorted(map(str, Q.judge(docs).drop("text").collect()))
    assert sorted(map(str, Q.judge_counts(docs).collect())) == want and len(want) == 21
    assert Q.judge_counts(docs.limit(0)).count() == 0
