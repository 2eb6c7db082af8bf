"""Suffix arrays and the removal of repeated strings against plain versions."""

import collections
import hashlib

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.cases import ODD, by_id, odd_docs, texts


def plain_removed(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digests(df):
    from pyspark.sql import functions as F
    return df.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)),
                     F.coalesce(F.octet_length("text"), F.lit(0)) - F.octet_length("kept"),
                     (F.size("removed") / 2).cast("int"), F.sha2("kept", 256)).collect()


def test_suffix_array_against_sorting():
    from loanmart.llm.suffixes import common_prefixes, suffix_array
    rng = np.random.default_rng(1)
    for it in range(200):
        t = rng.integers(0, rng.choice([1, 2, 3, 5, 256]), rng.integers(0, 60)).astype(np.uint8)
        t = np.tile(t, rng.integers(1, 5)) if it % 3 == 0 else t
        b = t.tolist()
        want = sorted(range(len(b)), key=lambda i: b[i:])
        sa = suffix_array(t)
        assert sa.tolist() == want
        got = common_prefixes(t, sa).tolist()
        for r in range(1, len(b)):
            x, y = b[want[r - 1]:], b[want[r]:]
            k = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert got[r] == k


def test_repeats_of_the_tables(spark):
    from loanmart.llm.suffix_dedup import op4_suffix_dedup
    want = plain_removed(texts(SF001), 400)
    assert by_id(op4_suffix_dedup(spark, SF001).collect()) == by_id(want) and any(w[2] for w in want)


def test_repeats_in_odd_rows(spark):
    from loanmart.llm.suffix_dedup import remove_repeats
    assert by_id(digests(remove_repeats(odd_docs(spark), length=50))) == by_id(plain_removed(ODD, 50))
    assert remove_repeats(odd_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("hot", [8 << 20, 2000])
def test_shared_passages_with_other_contexts(spark, monkeypatch, hot):
    """Passages just below, at and above the length, in many texts, also with anchors split."""
    from loanmart.llm import suffix_dedup as S
    monkeypatch.setattr(S, "HOT_BYTES", hot)
    monkeypatch.setattr(S, "SHARD_BYTES", 20000)
    monkeypatch.setattr(S, "PIECE", 3000)
    rng = np.random.default_rng(7)
    word = lambda n: "".join(rng.choice(list("abcdefgh éß\n"), n))
    shared = [word(n) for n in (90, 99, 100, 101, 150, 400)]
    rows = [(i, word(rng.integers(0, 300)) + (shared[i % 6] if i % 7 else "") + word(rng.integers(0, 200)) + shared[(i + 1) % 6][:95])
            for i in range(80)] + [(100, "ab" * 4000), (101, "b" + "ab" * 100), (102, word(9000) * 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert by_id(digests(S.remove_repeats(df, length=100))) == by_id(plain_removed(rows, 100))
