"""The pipeline stage by stage, each on what the one before kept, against plain versions."""

import base64

import numpy as np

import corpus_pipeline as P
from tests.conftest import SF001
from tests.llm.cases import odd_docs
from tests.llm.test_suffix_dedup import plain_removed
from tests.llm.test_text_ops import plain_components, plain_hits, plain_simhash


def cut_repeats(rows, length=200, most_bytes=400, most_words=50):
    """Texts without characters whose bytes all lie in repeated strings, in runs of many bytes or words."""
    import collections
    import re
    data = [t.encode() for _, t in rows]
    seen = collections.Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (i, t), b in zip(rows, data):
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        gone, at, kept = np.cumsum(gone) > 0, 0, []
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        for s, e in edge.reshape(-1, 2).tolist():
            if e - s < most_bytes and len(re.findall(rb"[^\x20\x09-\x0D]+", b[s:e])) <= most_words:
                gone[s:e] = False
        for c in t:
            n = len(c.encode())
            if not gone[at:at + n].all():
                kept.append(c)
            at += n
        out.append((i, "".join(kept)))
    return out


def test_stages_against_plain(spark):
    import duckdb
    import public_tokenizers
    import tiktoken
    from loanmart.llm.common import store, table
    from loanmart.llm.quality import op5_quality
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    now = pairs(docs)
    ok = {r["doc_id"] for r in op5_quality(spark, SF001).filter("kept").collect()}
    want = [(i, t) for i, t in now if i in ok]
    got = [docs]
    for name, stage in P.STAGES:
        got.append(store(stage(spark, got[-1], SF001), name))
    assert pairs(got[1]) == want and got[1].columns == docs.columns and len(want) < len(now)
    comp = plain_components([(i, plain_simhash(t)) for i, t in want])
    want = [(i, t) for (i, t), c in zip(want, comp) if c[2] == i]
    assert pairs(got[2]) == want and got[2].columns == docs.columns and got[2].count() < got[1].count()
    want = cut_repeats(want)
    assert pairs(got[3]) == want and got[3].columns == docs.columns
    assert got[3].filter("n_chars <> length(text)").count() == 0
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    hit = {h[0] for h in plain_hits(want, items) if h[-1]}
    want = [(i, t) for i, t in want if i not in hit]
    assert pairs(got[4]) == want and got[4].columns == docs.columns and hit
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = got[5].collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in last} == {i: enc.encode_ordinary(t) for i, t in want}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) // 4 for r in last)
    assert sorted(map(str, P.run(spark, SF001).collect())) == sorted(map(str, last))


def test_passages_of_over_fifty_words_go(spark):
    """Passages of 51 to 60 words below 400 bytes go from all texts, those of 40 words stay, other text stays."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghiéß"), rng.integers(2, 8)))
    passage = lambda n: " ".join(word() for _ in range(n))
    long, short = [passage(n) for n in (51, 53, 60)], [passage(40) for _ in range(3)]
    assert all(len(p.encode()) < 400 for p in long[:2])
    rows = [(i, f"{passage(80)}\n{long[i % 3]}\n{passage(60)} {short[i % 3]} {passage(30)}") for i in range(24)]
    rows += [(100 + i, passage(150)) for i in range(20)]
    df = spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
    got = {r["doc_id"]: r["text"] for r in P.repeats(spark, df, SF001).collect()}
    assert got == dict(cut_repeats(rows))
    for i, t in rows:
        if i < 100:
            assert long[i % 3][1:-1] not in got[i] and short[i % 3] in got[i] and len(got[i]) >= len(t) - len(long[i % 3]) - 12
        else:
            assert got[i] == t


def test_stages_take_odd_and_empty_tables(spark):
    from loanmart.llm.common import store
    for docs, empty in ((odd_docs(spark), False), (odd_docs(spark).limit(0), True)):
        for name, stage in P.STAGES:
            docs = store(stage(spark, docs, SF001), name)
        left = docs.collect()
        assert all(r["round_trip"] and r["doc_id"] not in (3, 4, 5) for r in left) and not (empty and left)
    for _, stage in P.STAGES:                                # each stage on the raw odd rows
        out = stage(spark, odd_docs(spark), SF001)
        assert out.count() > 0 or stage is P.quality
        same = "__in0" in out.columns and out.schema["n_words"].dataType.simpleString() == "int"
        assert same and (stage is P.token_ids or out.columns == odd_docs(spark).columns)
