"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are normalised to `` w1 w2 ... wn `` (A-Z lower-cased, words of letters, digits and non-ASCII
bytes, one space on both sides of each word), so a window of an item is a plain byte string.  Patterns
fall into length classes; within one, the first ``m`` bytes (the shortest length) are indexed: a shift
table keyed by a hash of the last ``B`` bytes of the search window says how far the window may skip, a
zero shift leads to the bucket of patterns with that suffix block, and a direct comparison of all bytes
decides.  Many cursors advance at once over a few megabytes of text (NumPy), each by its own shifts.

Patterns are sent to the executors in chunks of at most ``CHUNK_BYTES`` of item text; a larger benchmark
takes several passes over the documents in the same stage, each adding to the hits so far.  Nothing is
shuffled, so hot items, sources or copies make no hot task.

Defined cases: NULL or empty documents have no words; NULL or empty items never occur; an item shorter than
a window is one window; repeated items count once by id, items with a NULL id count as the id ``""``;
repeated documents get equal results; documents without hits hash the empty string; an empty table
gives an empty result, an empty benchmark hits nothing; other columns pass through, one with the name of a result column is replaced.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import Words, add_columns, buffer_of, doc_groups, fold_table, table, text_input

WINDOW = 10
CHUNK_BYTES = 16 << 20
GROUP_BYTES = 2 << 20
LANE = 2048                     # window starts that one cursor goes over
_MIX = np.uint64(0x9E3779B97F4A7C15)

_FOLD = fold_table(bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))


def _blocks(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one little-endian integer; text has eight spare bytes."""
    return np.ndarray(len(text) - 7, "<u8", text.tobytes(), 0, (1,)).copy()


class Patterns:
    """Windows of a chunk of items, with shift and bucket tables per length class."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(ids)}
        found: dict[bytes, set[int]] = {}
        self.words: list[int] = []
        for item, text in items:
            raw = text.encode()
            norm = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _FOLD)
            words = norm.text[:norm.end[0]].tobytes().split()
            for k in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(b" " + b" ".join(words[k:k + window]) + b" ", set()).add(number[item])
        self.ids = ids
        pats = sorted(found, key=lambda p: (len(p), p))
        self.items = [sorted(found[p]) for p in pats]
        self.n_words = np.array([p.count(b" ") - 1 for p in pats], np.int64)
        self.length = np.array([len(p) for p in pats], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.length)])[:-1].astype(np.int64)
        self.blocks = _blocks(np.frombuffer(b"".join(pats) + bytes(16), np.uint8))
        self.classes = []
        lo = 0
        for limit in (8, 12, 16, 24, 32, 48, 1 << 62):      # shortest first, so m stays near the lengths
            hi = int(np.searchsorted(self.length, limit))
            if hi > lo:
                self.classes.append(self._tables(lo, hi))
            lo = hi

    def _tables(self, lo: int, hi: int):
        m = int(self.length[lo])
        b = min(8, m)
        bits = max(12, int(np.ceil(np.log2((hi - lo) * (m - b + 1) * 8))))
        bits = min(bits, 24)
        shift = np.full(1 << bits, m - b + 1, np.int32)
        mask = np.uint64((1 << (8 * b)) - 1) if b < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
        key = lambda x: ((x & mask) * _MIX) >> np.uint64(64 - bits)
        for j in range(m - b + 1):                          # block at offset j: the window end may move m-b-j
            np.minimum.at(shift, key(self.blocks[self.at[lo:hi] + j]), m - b - j)
        suffix = key(self.blocks[self.at[lo:hi] + m - b])
        order = np.argsort(suffix, kind="stable")
        return m, b, key, shift, suffix[order], (np.arange(lo, hi))[order]

    def search(self, norm: Words) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, position) of every occurrence."""
        blocks = _blocks(norm.text)
        out = []
        for m, b, key, shift, suffix, pats in self.classes:
            last = norm.size - m                            # last window start
            if last < 0:
                continue
            cur = np.arange(0, last + 1, LANE, dtype=np.int64)
            stop = np.minimum(cur + LANE, last + 1)
            hits = []
            while len(cur):
                by = shift[key(blocks[cur + (m - b)])]
                zero = by == 0
                if zero.any():
                    hits.append(cur[zero])
                cur = cur + np.maximum(by, 1)
                live = cur < stop
                if not live.all():
                    cur, stop = cur[live], stop[live]
            if not hits:
                continue
            cand = np.concatenate(hits)
            k = key(blocks[cand + (m - b)])
            a, z = np.searchsorted(suffix, k), np.searchsorted(suffix, k, "right")
            pos = np.repeat(cand, z - a)
            which = np.arange(len(pos)) - np.repeat(np.cumsum(z - a) - (z - a), z - a) + np.repeat(a, z - a)
            out.append(self._confirm(blocks, norm, pats[which], pos))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p for p, _ in out]), np.concatenate([x for _, x in out])

    def _confirm(self, blocks: np.ndarray, norm: Words, pat: np.ndarray, pos: np.ndarray):
        """Keep the pairs whose bytes are all equal."""
        fits = pos + self.length[pat] <= norm.size
        pat, pos = pat[fits], pos[fits]
        sure = []
        done = 0
        while len(pat):
            left = self.length[pat] - done
            x = blocks[pos + done] ^ self.blocks[self.at[pat] + done]
            short = np.minimum(left, 8).astype(np.uint64)
            x = x << (np.uint64(64) - short * np.uint64(8))  # only the first min(left, 8) bytes count
            same = x == 0
            over = same & (left <= 8)
            sure.append((pat[over], pos[over]))
            go = same & (left > 8)
            pat, pos = pat[go], pos[go]
            done += 8
        return (np.concatenate([p for p, _ in sure]) if sure else pat), (np.concatenate([x for _, x in sure]) if sure else pos)


_TABLES: dict[str, Patterns] = {}


def _patterns(key: str, shared, window: int) -> Patterns:
    """Tables of a broadcast chunk, built once a worker process."""
    if key not in _TABLES:
        if len(_TABLES) >= 4:
            _TABLES.clear()
        _TABLES[key] = Patterns(shared.value, window)
    return _TABLES[key]


def _match(key: str, shared, window: int, batch: pa.RecordBatch) -> list[pa.Array]:
    """Words, hit runs (pairs of word numbers) and item ids of each text, merged with those so far."""
    data, off = buffer_of(batch.column(0))
    before = batch.column(1).to_pylist() if batch.num_columns > 1 else None
    items_before = batch.column(2).to_pylist() if batch.num_columns > 1 else None
    pats = _patterns(key, shared, window)
    words, runs, items = [], [], []
    for lo, hi in doc_groups(off, GROUP_BYTES):
        norm = Words(data, off[lo:hi + 1], _FOLD)
        words.append(np.diff(norm.first_word))
        pat, pos = pats.search(norm)
        doc = norm.doc_at(pos)
        first = norm.word_at(pos) - norm.first_word[doc]
        order = np.lexsort((first, doc))
        doc, first, pat = doc[order], first[order], pat[order]
        bounds = np.searchsorted(doc, np.arange(hi - lo + 1))
        for d in range(hi - lo):
            a, z = bounds[d], bounds[d + 1]
            if a == z and before is None:
                runs.append([])
                items.append([])
                continue
            spans = np.stack([first[a:z], first[a:z] + pats.n_words[pat[a:z]]], 1).tolist()
            got = {pats.ids[i] for p in set(pat[a:z].tolist()) for i in pats.items[p]}
            if before is not None:
                flat = before[lo + d]
                spans = sorted([list(x) for x in zip(flat[::2], flat[1::2])] + spans)
                got |= set(items_before[lo + d])
            merged: list[list[int]] = []
            for s, e in spans:
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            runs.append([x for span in merged for x in span])
            items.append(sorted(got))
    return [pa.array(np.concatenate(words) if words else [], pa.int64()),
            pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Append ``n_words``, ``hit_runs`` (flat pairs of word numbers, end exclusive), ``item_ids`` (sorted) and
    ``n_hit`` to ``docs``."""
    spark = docs.sparkSession
    sel = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("i"),
                       F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("t")).distinct()
    size = sel.agg(F.sum(F.octet_length("t") + 16).alias("b")).first()["b"] or 0
    chunks = max(1, -(-int(size) // chunk_bytes) * (2 if size > chunk_bytes else 1))
    out = docs
    for c in range(chunks):
        part = sel if chunks == 1 else sel.filter(F.pmod(F.xxhash64("i", "t"), F.lit(chunks)) == c)
        shared = spark.sparkContext.broadcast([(r["i"], r["t"]) for r in part.toLocalIterator()])
        key = uuid.uuid4().hex
        inputs = [text_input(out, text_col)] + ([F.col("hit_runs"), F.col("item_ids")] if c else [])
        out = add_columns(out, inputs, lambda b, k=key, s=shared: _match(k, s, window, b),
                          "n_words bigint, hit_runs array<bigint>, item_ids array<string>")
    ends = F.aggregate(F.sequence(F.lit(0), F.size("hit_runs") - 1), F.lit(0).cast("bigint"),
                       lambda a, i: a + F.get("hit_runs", i) * F.when(i % 2 == 0, -1).otherwise(1))
    return out.withColumn("n_hit", F.when(F.size("hit_runs") > 0, ends).otherwise(F.lit(0).cast("bigint")))


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows of ten words cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


#: Words and windows by regular expression; a window occurs where its ten words follow one another.
OP9_SQL = r"""
WITH dw AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, len(w[i:i + 9]) AS k, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM dw, sizes WHERE len(w) >= k)),
hit AS (SELECT p.doc_id, p.i, p.k, win.item FROM pos p JOIN win ON p.k = win.k AND p.s = win.s),
cover AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN cover c USING (doc_id) LEFT JOIN its n USING (doc_id)
"""
