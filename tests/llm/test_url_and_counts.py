"""URL filter and edit-aware counts against plain versions."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tests.conftest import SF001
from tests.llm.cases import by_id, odd_docs, texts, tiktoken_encoding

URLS = [(1, "https://A.Example.ORG/es/1?x#y"), (2, "http://example.org/en/12"), (3, "http://notexample.org/es/"),
        (4, "ftp://x.com/fr/a"), (5, "x.com/fr/a"), (6, None), (7, ""), (8, "http://com/de/"), (9, "http://org"),
        (10, "http://org?/"), (11, "http://é.org/ü/" + "p" * 9000), (11, "http://é.org/ü/" + "p" * 9000), (None, "a://b://c.org/x"),
        (12, "http://x.com/FR/"), (13, "://org/"), (14, "http://x.net/de/\n"), (15, "http://..org/es/")]


def plain_verdict(url, entries, default="allow"):
    url = url if url and "://" in url else ""
    rest = url.split("://", 1)[1] if url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(e.encode()), len(e.split("/")[0].encode()), e, v) for e, v in entries
            if (h := e.split("/", 1)[0]) and (host == h or host.endswith("." + h)) and path.startswith("/" + e.split("/", 1)[1])]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


@pytest.mark.parametrize("chunk", [64 << 20, 300])
def test_filter_against_plain(spark, chunk):
    from loanmart.llm.url_filter import RULES, filter_urls
    rng = random.Random(2)
    entries = RULES + [(f"{rng.choice(['x', 'a.example', 'q'])}.{rng.choice(['com', 'org'])}/{'ab'[:rng.randint(0, 2)]}{i % 40}", "block")
                       for i in range(200)] + [("é.org/ü", "block")]
    entries = sorted(set(entries))
    urls = URLS + [(100 + i, f"http://{rng.choice(['w.x', 'a.example', 'q', 'z'])}.{rng.choice(['com', 'org'])}/{rng.choice('ab')}{rng.randint(0, 50)}")
                   for i in range(300)]
    pages = spark.createDataFrame([(*u, "other") for u in urls], "page_id bigint, url string, host string").repartition(4)
    got = filter_urls(pages, spark.createDataFrame(entries + [(None, "block")], "entry string, verdict string"), chunk_bytes=chunk)
    want = [(i, *plain_verdict(u, entries)) for i, u in urls]
    assert by_id(got.select("page_id", "host", "path", "rule", "verdict").collect()) == by_id(want)
    assert filter_urls(pages.limit(0), spark.createDataFrame(entries, "entry string, verdict string")).count() == 0
    none = filter_urls(pages, spark.createDataFrame([], "entry string, verdict string"))
    assert none.filter("rule is not null or verdict <> 'allow'").count() == 0


def test_filter_of_the_tables_matches_sql(spark):
    from loanmart.llm.url_filter import OP3_SQL, RULES, op3_url_filter
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF001}/pages.parquet'")
    got = by_id(op3_url_filter(spark, SF001).collect())
    assert got == by_id(con.execute(OP3_SQL).fetchall())
    assert got == by_id((i, *plain_verdict(u, RULES)) for i, u in con.execute("SELECT page_id, url FROM pages").fetchall())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [u for u in URLS if u[0] is not None and u[0] != 11])
    assert by_id(con.execute(OP3_SQL).fetchall()) == by_id((i, *plain_verdict(u, RULES)) for i, u in URLS if i is not None and i != 11)


def test_digest_collisions_are_told_apart(monkeypatch):
    from loanmart.llm import url_filter as U
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda b: len(b))
    array = U.DigestArray(U.pack_entries([("ab/", "block"), ("cd/", "allow"), ("e/", "block")]))
    found = array.find([b"ab/", b"cd/", b"xx/", b"e/", b""])
    assert [array.entry(i) if i >= 0 else None for i in found.tolist()] == [b"ab/", b"cd/", None, b"e/", None]


# ---------------------------------------------------------------- counts under edits

def test_random_edits_count_like_a_full_encoding():
    from loanmart.llm.bpe import codec, public_ranks
    from loanmart.llm.token_counts import CountTree, Counter
    counter, enc, rng = Counter(codec(*public_ranks())), tiktoken_encoding(), random.Random(4)
    bits = ["'", "'re", "re", " ", "  ", "\n", "a", "don't", "é", "12", "!!", "日本", "\t", " the", "x" * 40, "'l", "l"]
    for _ in range(150):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        tree = CountTree(counter, text)
        for _ in range(rng.randint(1, 12)):
            a = rng.randint(-2, len(text) + 3)
            b = a + rng.choice([0, 0, 1, 2, 5, 30])
            new = "".join(rng.choice(bits) for _ in range(rng.choice([0, 0, 1, 2, 3, 400 if rng.random() < 0.05 else 4])))
            s = min(max(a, 0), len(text))
            text = text[:s] + new + text[min(max(b, s), len(text)):]
            tree.edit(a, b, new)
            assert tree.text == text and tree.tokens == len(enc.encode_ordinary(text))
            assert int(tree.tree[0, 1]) == len(text)


def test_edits_touch_little_of_a_long_text():
    from loanmart.llm.bpe import codec, public_ranks
    from loanmart.llm.token_counts import CountTree, Counter
    tree = CountTree(Counter(codec(*public_ranks())), "some words and more " * 20000)
    before = tree.tokens
    tree.edit(200000, 200005, "other")
    assert tree.encoded < 10 and abs(tree.tokens - before) < 10


def plain_edits(i, t):
    t, e = t or "", tiktoken_encoding()
    n = len(t)
    cut = t[40:]
    ins, place = t[100:130], zlib.crc32(str("" if i is None else i).encode()) % (max(n - 40, 0) + 1)
    two = cut[:place] + ins + cut[place:]
    three = two[:max(len(two) - 25, 0)] + t[-25:].upper()
    return t, three


def test_counts_of_the_tables(spark):
    from loanmart.llm.token_counts import op10_token_counts
    enc, want = tiktoken_encoding(), []
    for i, t in texts(SF001):
        a, b = plain_edits(i, t)
        want.append((i, len(enc.encode_ordinary(a)), len(enc.encode_ordinary(b)), hashlib.sha256(b.encode()).hexdigest()))
    got = op10_token_counts(spark, SF001).select("doc_id", "n_tokens", "n_tokens_edited", "edited_sha256").collect()
    assert by_id(got) == by_id(want)


def test_counts_of_odd_rows(spark):
    from pyspark.sql import functions as F
    from loanmart.llm.bpe import public_ranks
    from loanmart.llm.token_counts import count_edits
    enc = tiktoken_encoding()
    edits = F.expr("CASE WHEN n_words % 3 = 0 THEN NULL WHEN n_words % 3 = 1 THEN array() ELSE array(NULL, "
                   "named_struct('start', 1, 'end', 4, 'text', NULL), named_struct('start', 99999, 'end', 0, 'text', ' end')) END")
    df = odd_docs(spark).withColumn("edits", edits)
    for r in count_edits(df, *public_ranks()).collect():
        t = r["text"] or ""
        after = t[:1] + t[4:] + " end" if r["n_words"] % 3 == 2 else t
        assert r["edited"] == after and r["n_tokens"] == len(enc.encode_ordinary(t))
        assert r["n_tokens_edited"] == len(enc.encode_ordinary(after))
    assert count_edits(df.limit(0), *public_ranks()).count() == 0
