"""Ranked lexical search over bit-sliced Bloom signatures, with exact scores for what they cannot exclude.

Index: documents of a batch are parted by their number of distinct terms, and each part is a block: a bitmap whose rows are
hash positions and whose columns are documents.  A term sets its ``HASHES`` rows in the document's column, once for
each level of ``LEVELS`` that its count reaches; the rows follow the terms of the part, so all blocks are about as full.

Query: the rows of a term, ANDed, name the documents that may hold it (no holder is missed).  For each level the
weights of the terms found are summed over the slices; the sums, times what a count below the next level can add, bound
a document's score from above.  The documents that look best give a first k-th best exact score; all documents
whose bound reaches it are scored exactly from their whole text, so what is left out is provably lower.

Score (integers, ``div`` rounds down): the sum over an item's distinct terms of
w * ((10**9 * tf) div (1000 * tf + 8 * m)), with w = floor(1000 ln((2N + 2) / (2df + 1))) and m = 100 - B + ((B * n * N) div L).

Items are taken in chunks of ``CHUNK_BYTES`` of text, which with their ``SEEDS`` first documents each bound all that is
broadcast; the exact pass broadcasts its list of documents below ``LIST_BYTES`` and joins by shuffle beyond.

Defined cases: NULL and empty texts have no terms and are no documents of N; repeated rows are documents each; NULL
ids come last among equal scores; equal rows of items count once, items without terms give no rows; empty
tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.common import (ROW_HASH, ROW_ID, Words, buffer_of, doc_groups, fold_table, key_join, map_arrow,
                                 partitions_for, row_key, span_codes, store, table)

K, B = 10, 90
LEVELS = (1, 2, 4, 8)                                       # counts from which a term has another entry
HASHES, BITS = 3, 8                                         # rows of an entry, rows of a block per entry
SEEDS = 40
GROUP_BYTES = 4 << 20
CHUNK_BYTES, LIST_BYTES = 4 << 20, 16 << 20
ITEMS = 256                                                 # items scored side by side
_BREAKS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = fold_table(_BREAKS)
_TERM = regex.compile(rb"[0-9a-z\x80-\xff]+")
_SALT = np.array([xxhash.xxh3_64_intdigest(b"level %d" % x) for x in LEVELS], np.uint64)
_INDEX = ("ids array<string>, hashes array<bigint>, n array<bigint>, rows bigint, bits binary, "
          "terms array<int>, dfs array<bigint>")


def terms_of(text: str | None) -> list[bytes]:
    """Distinct terms of a short text, in order."""
    raw = bytes(x + 32 if 0x41 <= x <= 0x5A else x for x in (text or "").encode())
    return list(dict.fromkeys(_TERM.findall(raw)))


def _hashes(terms: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in terms], np.uint64)


def _rows(h: np.ndarray, level: int, rows: int) -> np.ndarray:
    """The rows of entries with term hashes ``h``, as [entry, hash function]."""
    x = h ^ _SALT[level]
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return ((x & np.uint64(0xFFFFFFFF))[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(rows)


def counted(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(terms of each document with repeats, then by document and distinct term: document, term number, count; the terms)."""
    norm = Words(data, off, _FOLD)
    start = norm.word_start
    space = np.flatnonzero(norm.text[:norm.size + 1] == 32)
    end = space[np.searchsorted(space, start)]
    code, terms = span_codes(start, end, norm.text)
    n = np.diff(norm.first_word)
    pair = np.repeat(np.arange(len(n)), n) * max(1, len(terms)) + code
    pair, tf = np.unique(pair, return_counts=True)
    return n, pair // max(1, len(terms)), pair % max(1, len(terms)), tf, terms


def _index_batch(batch: pa.RecordBatch, vocabulary: pa.Array) -> Iterator[pa.RecordBatch]:
    """Blocks of signatures of a batch (row id, row hash, text); the first of a group has the group's document counts."""
    data, off = buffer_of(batch.column(2))
    for lo, hi in doc_groups(off, GROUP_BYTES):
        n, doc, code, tf, terms = counted(data, off[lo:hi + 1])
        number = pc.index_in(terms, value_set=vocabulary).fill_null(-1).to_numpy()
        asked = number[code]
        term, df = np.unique(asked[asked >= 0], return_counts=True)
        h = _hashes(terms.to_pylist())
        entries = sum(np.bincount(doc[tf >= x], minlength=hi - lo) for x in LEVELS)
        size = np.ceil(np.log2(np.maximum(entries, 1))).astype(int)
        out: dict[str, list] = {c.split()[0]: [] for c in _INDEX.split(", ")}
        for s in np.unique(size[n > 0]).tolist():
            pick = np.flatnonzero((size == s) & (n > 0))
            column = np.full(hi - lo, -1)
            column[pick] = np.arange(len(pick))
            rows = BITS << s
            on = np.zeros((rows, len(pick)), bool)
            for level, least in enumerate(LEVELS):
                here = np.flatnonzero((tf >= least) & (column[doc] >= 0))
                on[_rows(h[code[here]], level, rows), column[doc[here]][:, None]] = True
            at = pa.array(pick + lo)
            for name, x in zip(out, (batch.column(0).take(at).to_pylist(), batch.column(1).take(at).to_pylist(), n[pick].tolist(), rows,
                                     np.packbits(on, 1, bitorder="little").tobytes(), term.tolist(), df.tolist())):
                out[name].append(x)
            term = df = term[:0]
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("ids", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("rows", pa.int64()),
            ("bits", pa.binary()), ("terms", pa.list_(pa.int32())), ("dfs", pa.list_(pa.int64()))]))


class Items:
    """Items of a chunk: term numbers and weights of each (terms of weight 0 add nothing and are left out)."""

    def __init__(self, terms: list[bytes], of_item: list[list[int]], weight: np.ndarray, docs: int, length: int):
        self.docs, self.length, self.weight, self.terms = docs, length, weight, pa.array(terms, pa.binary())
        self.of_item = [np.array([t for t in x if weight[t] > 0], np.int64) for x in of_item]
        self.hash = _hashes(terms)

    def m(self, n: np.ndarray) -> np.ndarray:
        return 100 - B + (B * n * self.docs) // self.length

    def add(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def bounds(self, n: np.ndarray, rows: int, bits: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, upper bounds, guesses) of a block, a batch of items at a time; bounds are at least the scores."""
        packed = np.frombuffer(bits, np.uint8).reshape(rows, -1)
        m, d = self.m(n), len(n)
        top = [self.add(np.full(d, x - 1), m) for x in LEVELS[1:]] + [self.add(np.maximum(n, LEVELS[-1]), m)]
        low = [self.add(np.full(d, x), m) for x in LEVELS]
        for lo in range(0, len(self.of_item), ITEMS):
            part = self.of_item[lo:lo + ITEMS]
            used = np.unique(np.concatenate([*part, np.zeros(0, np.int64)]))
            if not len(used):
                continue
            place = [np.searchsorted(used, x) for x in part]
            upper, guess = np.zeros((len(part), d)), np.zeros((len(part), d))
            may = None
            for level in range(len(LEVELS)):
                found = np.bitwise_and.reduce(packed[_rows(self.hash[used], level, rows).astype(np.int64)], 1)
                may = found if may is None else may & found
                if not may.any():
                    break
                held = np.unpackbits(may, axis=1, count=d, bitorder="little") * self.weight[used][:, None].astype(np.float64)
                more = top[level] - (top[level - 1] if level else 0)
                least = low[level] - (low[level - 1] if level else 0)
                for j, p in enumerate(place):
                    slices = held[p].sum(0)
                    upper[j] += more * slices
                    guess[j] += least * slices
            for j in range(len(part)):
                yield lo + j, upper[j], guess[j]

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, int]]:
        """(row, item, score) of the exact scores above 0 of a batch (text, items asked for)."""
        data, off = buffer_of(batch.column(0))
        asked = batch.column(1)
        dense = np.zeros(len(self.terms), np.int64)
        for lo, hi in doc_groups(off, GROUP_BYTES):
            n, doc, code, tf, terms = counted(data, off[lo:hi + 1])
            number = pc.index_in(terms, value_set=self.terms).fill_null(-1).to_numpy()[code]
            known = number >= 0
            doc, number, tf, m = doc[known], number[known], tf[known], self.m(n)
            edge = np.searchsorted(doc, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                mine = number[edge[i]:edge[i + 1]]
                dense[mine] = self.weight[mine] * self.add(tf[edge[i]:edge[i + 1]], m[i])
                for q in asked[lo + i].as_py():
                    s = int(dense[self.of_item[q]].sum())
                    if s > 0:
                        yield lo + i, q, s
                dense[mine] = 0


def _seeds(index: DataFrame, shared) -> DataFrame:
    """(item, ROW_ID, ROW_HASH) of the ``SEEDS`` documents that look best for each item."""

    def fn(batches):
        items = shared.value
        best: dict[int, list] = {}
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                for q, _, guess in items.bounds(np.array(r["n"]), r["rows"], r["bits"]):
                    near = np.argsort(-guess, kind="stable")[:SEEDS]
                    got = best.get(q, []) + [(-guess[i], r["ids"][i], r["hashes"][i]) for i in near.tolist() if guess[i] > 0]
                    best[q] = sorted(got, key=lambda x: (x[0], x[2]))[:SEEDS]
        rows = [(q, -s, i, h) for q, x in best.items() for s, i, h in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(
            (pa.int32(), pa.float64(), pa.string(), pa.int64()))], names=["item", "guess", ROW_ID, ROW_HASH])

    found = map_arrow(index.select("ids", "hashes", "n", "rows", "bits"), fn, f"item int, guess double, {ROW_ID} string, {ROW_HASH} bigint")
    best = Window.partitionBy("item").orderBy(F.desc("guess"), ROW_HASH, ROW_ID)
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= SEEDS).select("item", ROW_ID, ROW_HASH)


def _reach(index: DataFrame, shared, least) -> DataFrame:
    """(ROW_ID, ROW_HASH, items) of the documents whose bound reaches the item's least score."""

    def fn(batches):
        items, need = shared.value, least.value
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                asked: list[list[int]] = [[] for _ in r["n"]]
                for q, upper, _ in items.bounds(np.array(r["n"]), r["rows"], r["bits"]):
                    for i in np.flatnonzero((upper >= need[q]) & (upper > 0)).tolist():
                        asked[i].append(q)
                hit = [i for i, x in enumerate(asked) if x]
                if hit:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["ids"][i] for i in hit], pa.string()), pa.array([r["hashes"][i] for i in hit], pa.int64()),
                         pa.array([asked[i] for i in hit], pa.list_(pa.int32()))], names=[ROW_ID, ROW_HASH, "items"])

    found = map_arrow(index.select("ids", "hashes", "n", "rows", "bits"), fn, f"{ROW_ID} string, {ROW_HASH} bigint, items array<int>")
    return found.dropDuplicates([ROW_ID, ROW_HASH])          # equal rows have equal signatures and bounds


def _score(keyed: DataFrame, asked: DataFrame, shared, kind: str) -> DataFrame:
    """(item, doc_id, score) of the rows named by ``asked`` for their items."""
    rows = key_join(keyed, asked, "inner").select("doc_id", "text", "items")

    def fn(batches):
        for b in batches:
            got = list(shared.value.scores(b.select(["text", "items"])))
            ids = b.column(0).take(pa.array([g[0] for g in got], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([g[1] for g in got], pa.int32()), ids, pa.array([g[2] for g in got], pa.int64())],
                                             names=["item", "doc_id", "score"])

    return map_arrow(rows, fn, f"item int, doc_id {kind}, score bigint")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", chunk_bytes: int = CHUNK_BYTES, list_bytes: int = LIST_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of every item with scores above 0."""
    spark = docs.sparkSession
    key_id, key_hash = row_key(id_col, text_col)
    keyed = docs.select(key_id, key_hash, F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    sel = items.select(F.col(f"`{item_id}`").alias("i"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("t")).distinct()
    size = sel.agg(F.sum(F.octet_length("t") + 16).alias("b")).first()["b"] or 0
    chunks = partitions_for(int(size) * (2 if size > chunk_bytes else 1), chunk_bytes)
    results = None
    for c in range(chunks):
        part = sel if chunks == 1 else sel.filter(F.pmod(F.xxhash64("i", "t"), F.lit(chunks)) == c)
        mine = [(r["i"], terms_of(r["t"])) for r in part.toLocalIterator()]     # a chunk: bounded by chunk_bytes
        done = _search_chunk(spark, keyed, mine, sel.schema["i"].dataType.simpleString(), kind, k, list_bytes)
        results = done if results is None else results.unionByName(done)
    return results


def _search_chunk(spark, keyed: DataFrame, mine: list[tuple], item_kind: str, kind: str, k: int, list_bytes: int) -> DataFrame:
    terms = list(dict.fromkeys(t for _, x in mine for t in x))
    place = {t: i for i, t in enumerate(terms)}
    vocabulary = spark.sparkContext.broadcast(pa.array(terms, pa.binary()))

    def fn(batches):
        for b in batches:
            yield from _index_batch(b, vocabulary.value)

    index = store(map_arrow(keyed.select(ROW_ID, ROW_HASH, "text"), fn, _INDEX), "signatures")
    total = index.agg(F.sum(F.size("n")).alias("N"), F.sum(F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("L")).first()
    names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(mine)], f"item int, item_id {item_kind}")
    out = ["item_id", "rank", "doc_id", "score"]
    if not total["N"] or not terms:
        return names.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    counts = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df"))
    df = np.zeros(len(terms), np.int64)
    for r in counts.toLocalIterator():                      # one row for a term of the items
        df[r["terms"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total["N"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    shared = spark.sparkContext.broadcast(Items(terms, [[place[t] for t in x] for _, x in mine], weight, total["N"], total["L"]))
    seeds = _seeds(index, shared).groupBy(ROW_ID, ROW_HASH).agg(F.collect_list("item").alias("items"))
    seeds = store(seeds, "seeds")                           # SEEDS rows an item at most
    reached = _best(_score(keyed, F.broadcast(seeds), shared, kind), k).filter(F.col("rank") == k).select("item", "score")
    need = np.zeros(len(mine))
    for r in reached.toLocalIterator():                     # one row an item
        need[r["item"]] = r["score"]
    asked = store(_reach(index, shared, spark.sparkContext.broadcast(need)), "reached")
    held = asked.agg(F.sum(F.octet_length(F.coalesce(ROW_ID, F.lit(""))) + 64 + 4 * F.size("items")).alias("b")).first()["b"] or 0
    best = _best(_score(keyed, F.broadcast(asked) if held <= list_bytes else asked, shared, kind), k)
    return best.join(F.broadcast(names), "item").select(*out)


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) AS x WHERE t IN (SELECT t FROM q) GROUP BY r, t),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * CAST(len(w) AS BIGINT) * docs) // total) AS m FROM d, s WHERE len(w) > 0),
scored AS (
  SELECT q.item_id, q.text, m.r, m.doc_id, CAST(sum(weights.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf ON tf.t = q.t JOIN weights ON weights.t = q.t JOIN m ON m.r = tf.r GROUP BY q.item_id, q.text, m.r, m.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) AS x
WHERE rank <= 10
"""
