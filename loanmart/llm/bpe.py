"""Byte-level BPE with a hierarchical-bitmap rank queue.

``merge_ids`` merges one pre-token.  Its parts are a doubly linked list over byte positions.  Every
adjacent pair with a rank is queued in the bucket of that rank; a two-level bitmap of the non-empty
buckets gives the lowest rank by find-first-set.  A bucket is emptied from the leftmost position on;
entries whose pair has changed since are stale and are skipped.  A merge queues the two new pairs, so
a pre-token of n bytes takes O(n) queue operations, however long it is.

Pre-tokens repeat, so each worker keeps the ids of the ones it has met, in two generations of a fixed
number of bytes (a cache: dropping one changes no result).

Defined cases: NULL and empty text encode to no ids; text that is one very long pre-token is merged
whole; repeated rows get equal results; other columns pass through, a column with the name of a
result column is replaced; an empty table gives an empty result.  Texts are valid UTF-8 (Spark strings); ``decode`` of ids that name no
token raises ``KeyError``.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import add_columns, buffer_of, doc_groups, register_cache, table, text_input

CACHE_BYTES = 64 << 20
_BIT = [1 << k for k in range(256)]


class RankQueue:
    """Storage of the queue, reused from pre-token to pre-token (it is empty between them).

    ``buckets`` holds positions by rank, ``words[w]`` the bitmap of the ranks 256 w to 256 w + 255 in use;
    the top bitmap, of the words in use, is a local of the merge loop.
    """

    __slots__ = ("buckets", "words")

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * (ranks // 256 + 1)


class Bpe:
    """Encoder and decoder for one rank file (token bytes in base64, rank) and one split pattern."""

    def __init__(self, path: str, pattern: str):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.rank[base64.b64decode(token)] = int(rank)
        token = {r: t for t, r in self.rank.items()}
        self.split = regex.compile(pattern)
        self.queue = RankQueue(max(self.rank.values(), default=0) + 1)
        self.two = [-1] * 65536               # ranks of the two-byte tokens
        for t, r in self.rank.items():
            if len(t) == 2:
                self.two[t[0] << 8 | t[1]] = r
        self.known = Known(self, {})
        self.tokens = pa.array([token.get(i) for i in range(max(token, default=-1) + 1)], pa.large_binary())

    def forget(self) -> None:
        self.known = Known(self, {})

    def merge_ids(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n, get, two, queue = len(piece), self.rank.get, self.two, self.queue
        buckets, words, bit = queue.buckets, queue.words, _BIT
        top = i = 0
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]    # rank of the pair at a position, -1: none
        pair.append(-1)
        for r in pair:
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> 8
                    words[w] |= bit[r & 255]
                    top |= bit[w]
            i += 1
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            low = word & -word
            words[w] = word ^ low
            if word == low:
                top ^= bit[w]
            r = (w << 8) + low.bit_length() - 1
            at = buckets.pop(r)
            if len(at) > 1:
                at.sort()
            done = 0
            for i in at:
                done += 1
                if pair[i] != r:              # stale: the pair here has changed
                    continue
                j = nxt[i]                    # parts i and j become one
                nxt[i] = k = nxt[j]
                pair[j] = -1
                lowest = r
                if k < n:
                    prev[k] = i
                    pair[i] = new = get(piece[i:nxt[k]], -1)
                    if new >= 0:
                        if new < lowest:
                            lowest = new
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            w = new >> 8
                            words[w] |= bit[new & 255]
                            top |= bit[w]
                else:
                    pair[i] = -1
                p = prev[i]
                if p >= 0:
                    new = get(piece[p:k], -1)
                    if new != pair[p]:
                        pair[p] = new
                        if new >= 0:
                            if new < lowest:
                                lowest = new
                            if new in buckets:
                                buckets[new].append(p)
                            else:
                                buckets[new] = [p]
                                w = new >> 8
                                words[w] |= bit[new & 255]
                                top |= bit[w]
                if lowest < r and done < len(at):    # a lower rank goes first; the rest of this bucket waits
                    buckets[r] = at[done:]
                    words[r >> 8] |= bit[r & 255]
                    top |= bit[r >> 8]
                    break
        out, i, rank = [], 0, self.rank
        while i < n:
            j = nxt[i]
            out.append(rank[piece[i:j]])
            i = j
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.known.size > CACHE_BYTES:
            self.known = Known(self, self.known)
        return b"".join(map(self.known.__getitem__, self.split.findall(text)))

    def decode(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """Bytes of each run ids[off[i]:off[i + 1]]: the tokens of all ids side by side, cut at the runs' ends."""
        if len(ids) and int(ids.max()) >= len(self.tokens):
            raise KeyError("an id names no token")
        data = self.tokens.take(pa.array(ids, pa.uint32()))
        if data.null_count:
            raise KeyError("an id names no token")
        _, ends = buffer_of(data)
        cut = pa.py_buffer(ends[off].tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, cut, data.buffers()[2]]).cast(pa.binary())


class Known(dict):
    """Packed ids of the pre-tokens met so far, with the generation before them."""

    def __init__(self, bpe: Bpe, older: dict):
        self.bpe, self.older, self.size = bpe, dict(older), 0

    def __missing__(self, piece: str) -> bytes:
        got = self.older.get(piece)
        if got is None:
            ids = self.bpe.merge_ids(piece.encode())
            got = struct.pack(f"<{len(ids)}I", *ids)
        self.size += 170 + 2 * len(piece) + len(got)
        self[piece] = got
        return got


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Bpe:
    """The worker's codec; rank file and pattern are read once a process."""
    bpe = Bpe(path, pattern)
    register_cache(__name__, bpe.forget)
    return bpe


def _encoded(bpe: Bpe, texts: pa.Array) -> pa.Array:
    """Packed ids of each text, one Python string at a time."""
    return pa.array((bpe.encode(x.as_py() or "") for x in texts), pa.binary())


def _decoded(bpe: Bpe, ids: pa.Array) -> pa.Array:
    data, off = buffer_of(ids)
    out = []
    for i, j in doc_groups(off, 4 << 20):
        some = np.frombuffer(data[off[i]:off[j]].tobytes(), "<u4")
        out.append(bpe.decode(some, (off[i:j + 1] - off[i]) // 4))
    got = pa.chunked_array(out, pa.binary()).combine_chunks()
    return pc.if_else(ids.is_valid(), got, pa.scalar(None, pa.binary())) if ids.null_count else got


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", out: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """Append ``out`` (binary): the ids of the text, four bytes each, little-endian; and, if a name is given,
    ``decoded``: what those ids decode to, in the same pass."""
    def fn(b: pa.RecordBatch) -> list[pa.Array]:
        bpe = codec(rank_file, pattern)
        ids = _encoded(bpe, b.column(0))
        return [ids, _decoded(bpe, ids)] if decoded else [ids]

    return add_columns(df, [text_input(df, text_col)], fn, f"`{out}` binary" + (f", `{decoded}` binary" if decoded else ""))


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Append ``out`` (binary): the bytes that the ids stand for; NULL ids give NULL."""
    return add_columns(df, [ids_col], lambda b: [_decoded(codec(rank_file, pattern), b.column(0))], f"`{out}` binary")


def public_ranks() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every text of ``documents``; digests of ids and bytes."""
    path, pattern = public_ranks()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode(docs, path, pattern, decoded="decoded")
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
