"""Ranked search against scores of all documents."""

import collections
import math

import numpy as np
import pytest
import regex

from tests.conftest import SF001
from tests.llm.cases import ODD, by_id, odd_docs, texts

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain_ranks(rows, items, k=10):
    docs = [(i, c) for i, c in ((i, collections.Counter(plain_terms(t))) for i, t in rows) if c]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for q, text in set(items):
        scored = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(plain_terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(q, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def bench():
    import duckdb
    return duckdb.connect().execute(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()


def test_op11_against_all_documents(spark):
    from loanmart.llm.lexical_search import op11_lexical_search
    want = plain_ranks(texts(SF001), bench())
    assert by_id(op11_lexical_search(spark, SF001).collect(), "item_id") == by_id(want, "item_id") and len(want) > 50


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, monkeypatch, small):
    """NULLs, empty and long texts, repeated rows and ids, items without terms; also in small groups, chunks and lists."""
    from loanmart.llm import lexical_search as S
    kw = {}
    if small:
        monkeypatch.setattr(S, "GROUP_BYTES", 500)
        monkeypatch.setattr(S, "SEEDS", 2)
        monkeypatch.setattr(S, "ITEMS", 2)
        kw = {"chunk_bytes": 25_000, "list_bytes": 0}
    rng = np.random.default_rng(2)
    word = [("".join(rng.choice(list("abcdeé1"), rng.integers(1, 4)))) for _ in range(300)]
    rows = list(ODD) + [(100 + i, ", ".join(rng.choice(word, rng.integers(1, 90)))) for i in range(120)]
    items = [(1, "The CAT sat"), (2, None), (3, "... !"), (4, "été 日本語 x"), (5, "one two three nine"), (5, "one two three nine"),
             (None, "no id here"), (6, "a" * 30000)] + [(10 + i, " ".join(rng.choice(word, 12))) for i in range(12)]
    df = odd_docs(spark, rows)
    asks = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, rank int")
    got = S.search(df, asks, **kw)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_ranks(rows, items)))
    assert S.search(df.limit(0), asks, **kw).count() == 0 and S.search(df, asks.limit(0), **kw).count() == 0
    empty = df.filter("text = ''")
    assert S.search(empty, asks, **kw).count() == 0


def test_bounds_hold_and_exclude():
    """No score is above its bound, and most documents are excluded by the bounds alone."""
    import pyarrow as pa
    from loanmart.llm import lexical_search as S
    rng = np.random.default_rng(4)
    word = [f"w{int(x)}" for x in rng.zipf(1.3, 60000) % 5000]
    docs = [" ".join(rng.choice(word, rng.integers(20, 400))) for _ in range(1500)]
    asks = [S.terms_of(" ".join(rng.choice(word, 25))) for _ in range(20)]
    terms = list(dict.fromkeys(t for a in asks for t in a))
    place = {t: i for i, t in enumerate(terms)}
    batch = pa.RecordBatch.from_arrays([pa.array(map(str, range(1500))), pa.array(range(1500), pa.int64()), pa.array(docs)], names=["i", "h", "t"])
    blocks = [r for b in S._index_batch(batch, pa.array(terms, pa.binary())) for r in b.to_pylist()]
    df = np.zeros(len(terms), int)
    for b in blocks:
        np.add.at(df, b["terms"], b["dfs"])
    assert df.tolist() == [sum(t.decode() in set(d.split()) for d in docs) for t in terms]
    weight = np.array([math.floor(1000 * math.log(3002 / (2 * x + 1))) for x in df])
    items = S.Items(terms, [[place[t] for t in a] for a in asks], weight, 1500, sum(len(d.split()) for d in docs))
    exact = collections.defaultdict(dict)
    for i, q, s in items.scores(pa.RecordBatch.from_arrays([pa.array(docs), pa.array([list(range(20))] * 1500)], names=["t", "q"])):
        exact[q][i] = s
    reach = 0
    for b in blocks:
        for q, upper, guess in items.bounds(np.array(b["n"]), b["rows"], b["bits"]):
            kth = sorted(exact[q].values())[-10]
            reach += int((upper >= kth).sum())
            for i, u, g in zip(b["hashes"], upper, guess):
                assert exact[q].get(i, 0) <= u and g <= u
    assert reach < 0.25 * 20 * 1500
