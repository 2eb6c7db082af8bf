"""URL filter on a sorted digest array.

An entry is a host and a path prefix with a verdict (``example.org/es/``, block); it holds for its host and all
subdomains.  A chunk of entries is laid out as one file: the sorted 64-bit xxhash digests of the entry
strings, their places, and the strings.  An executor maps that file into memory.  The strings that a URL could
match - each of its host's suffixes with its path cut at each prefix length in use - are hashed and looked
up by one vectorised binary search a batch; a digest that is found counts only if the stored string is
equal too.  The longest entry wins (then the one with the longer host); without any, ``default`` holds.

A list larger than ``CHUNK_BYTES`` is probed chunk by chunk, in one stage, each pass keeping the better
match; nothing is shuffled, so a hot host makes no hot task.

Defined cases: a NULL URL, or one without ``://``, has the empty host and path and fits no entry; NULL or
repeated entries: NULL ones fit nothing, of equal strings the smallest verdict holds; an empty list gives the default; an empty table gives an empty result;
other columns pass through, one with the name of a result column is replaced.
"""

from __future__ import annotations

import mmap
import os
import string
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import add_columns, table

CHUNK_BYTES = 64 << 20
ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def pack_entries(entries: list[tuple[str, str]]) -> bytes:
    """One chunk of the list: number of entries, digests, string offsets, host lengths, verdicts, strings."""
    by = {}
    for text, verdict in sorted(entries, reverse=True):
        by[text] = verdict
    raw = [(xxhash.xxh64_intdigest(t.encode()), t, v) for t, v in by.items()]
    raw.sort()
    blobs = [t.encode() for _, t, _ in raw]
    host = [len(t.split("/", 1)[0].encode()) for _, t, _ in raw]
    return b"".join([
        np.array([len(raw)], "<u8").tobytes(), np.array([d for d, _, _ in raw], "<u8").tobytes(),
        np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype("<u8").tobytes(),
        np.array(host, "<u8").tobytes(), np.array([v == BLOCK for _, _, v in raw], "<u8").tobytes(), *blobs])


class DigestArray:
    """A chunk mapped into memory; its file has no name any more and goes with the process."""

    def __init__(self, packed: bytes):
        fd, path = tempfile.mkstemp()
        try:
            with os.fdopen(os.dup(fd), "wb") as f:
                f.write(packed)
            self.map = mmap.mmap(fd, len(packed), prot=mmap.PROT_READ)
        finally:
            os.close(fd)
            os.unlink(path)
        n = int(np.frombuffer(self.map, "<u8", 1)[0])
        self.n = n
        self.digest = np.frombuffer(self.map, "<u8", n, 8)
        self.at = np.frombuffer(self.map, "<u8", n + 1, 8 + 8 * n)
        self.host = np.frombuffer(self.map, "<u8", n, 16 + 16 * n)
        self.block = np.frombuffer(self.map, "<u8", n, 16 + 24 * n)
        self.text = 16 + 32 * n
        length = np.diff(self.at).astype(np.int64) - self.host.astype(np.int64)
        self.lengths = np.unique(length).tolist()           # path lengths in use, in bytes

    def entry(self, i: int) -> bytes:
        return self.map[self.text + int(self.at[i]):self.text + int(self.at[i + 1])]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Place of each string in the list, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not keys:
            return out
        d = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        at = np.searchsorted(self.digest, d)
        for i in np.flatnonzero(self.digest[np.minimum(at, self.n - 1)] == d).tolist():
            j = int(at[i])
            while j < self.n and self.digest[j] == d[i]:    # equal digests: the strings decide
                if self.entry(j) == keys[i]:
                    out[i] = j
                    break
                j += 1
        return out


_ARRAYS: dict[str, DigestArray] = {}


def _array(key: str, shared) -> DigestArray:
    if key not in _ARRAYS:
        if len(_ARRAYS) >= 8:
            _ARRAYS.clear()
        _ARRAYS[key] = DigestArray(shared.value)
    return _ARRAYS[key]


def _suffixes(host: bytes) -> list[bytes]:
    parts = host.split(b".")
    return [b".".join(parts[i:]) for i in range(len(parts))]


def _probe(key: str, shared, b: pa.RecordBatch) -> list[pa.Array]:
    """(entry, verdict) of the better of the match so far and this chunk's."""
    array = _array(key, shared)
    rule, block = b.column(2).to_pylist(), b.column(3).to_pylist()
    seen: dict[bytes, list[bytes]] = {}
    number: dict[bytes, int] = {}
    rows: list[list[int]] = []
    for host, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
        if host not in seen:
            seen[host] = _suffixes(host) if host else []
        rows.append([number.setdefault(s + path[:n], len(number)) for s in seen[host]
                     for n in array.lengths if n <= len(path)])
    found = array.find(list(number))
    for i, own in enumerate(rows):
        hits = [int(found[k]) for k in own if found[k] >= 0]
        if hits:
            best = max(hits, key=lambda j: (int(array.at[j + 1] - array.at[j]), int(array.host[j])))
            text = array.entry(best).decode()
            old = rule[i]
            if old is None or (len(text.encode()), len(text.split("/")[0])) > (len(old.encode()), len(old.split("/")[0])):
                rule[i], block[i] = text, bool(array.block[best])
    return [pa.array(rule, pa.string()), pa.array(block, pa.bool_())]


def filter_urls(pages: DataFrame, entries: DataFrame, url_col: str = "url", default: str = ALLOW,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Append ``host``, ``path``, ``rule`` (the entry, or NULL) and ``verdict``.

    ``entries``: ``entry`` (host, then a path from its ``/`` on) and ``verdict`` (allow or block).
    """
    spark = pages.sparkSession
    rows = entries.select("entry", "verdict").filter("entry is not null and verdict is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("entry") + 32).alias("b")).first()["b"] or 0
    chunks = 1 if size <= chunk_bytes else 2 * -(-int(size) // chunk_bytes)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    out = pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    out = out.withColumns({"rule": F.lit(None).cast("string"), "block": F.lit(None).cast("boolean")})
    for c in range(chunks):
        part = rows if chunks == 1 else rows.filter(F.pmod(F.xxhash64("entry"), F.lit(chunks)) == c)
        shared = spark.sparkContext.broadcast(pack_entries([(r["entry"], r["verdict"]) for r in part.toLocalIterator()]))
        key = uuid.uuid4().hex
        out = add_columns(out, [F.col("host").cast("binary"), F.col("path").cast("binary"), "rule", "block"],
                          lambda b, k=key, s=shared: _probe(k, s, b), "rule string, block boolean")
    verdict = F.when(F.col("block"), BLOCK).when(~F.col("block"), ALLOW).otherwise(default)
    return out.withColumn("verdict", verdict).drop("block")


RULES = [("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK)]


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    entries = spark.createDataFrame(RULES, "entry string, verdict string")
    return filter_urls(pages, entries).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM r),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(coalesce(rest, ''), length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (
  SELECT p.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""
