"""Token counts under edits.

A document keeps a segment tree over its pre-tokens: leaves hold characters and tokens of a pre-token, inner
nodes the sums.  An edit replaces a range of characters.  The pre-tokens whose match may have looked at the
edited place - it reads ``REACH`` characters beyond its end at most - are split again from the first of them
on, until a boundary behind the edit falls on an old one; only these are encoded, and the sums above them
are renewed.  A leaf takes the new pre-tokens of its range (several, if need be), the others of the range
become empty; a tree whose leaf has grown too long is laid out anew from the kept counts.

Defined cases: NULL text is the empty text and counts 0; offsets beyond the text are cut to it; a NULL edit
list, or an empty one, changes nothing; equal rows get equal counts; an empty table gives an empty result;
other columns pass through, one with the name of a result column is replaced.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.bpe import CACHE_BYTES, Bpe, codec, public_ranks
from loanmart.llm.common import add_columns, table, text_input

REACH = 2
COUNT_BYTES = 2 * CACHE_BYTES    # counts are smaller than ids


class Counts(dict):
    """Number of tokens of the pre-tokens met so far, in two generations."""

    def __init__(self, bpe: Bpe, older: dict):
        self.bpe, self.older, self.size = bpe, dict(older), 0

    def __missing__(self, piece: str) -> int:
        got = self.older.get(piece)
        if got is None:
            got = len(self.bpe.merge_ids(piece.encode()))
        self.size += 150 + 2 * len(piece)
        self[piece] = got
        return got


class Counter:
    """Counts pre-tokens for one codec."""

    def __init__(self, bpe: Bpe):
        self.split, self.bpe, self.known = bpe.split, bpe, Counts(bpe, {})

    def count(self, pieces: list[str]) -> list[int]:
        if self.known.size > COUNT_BYTES:
            self.known = Counts(self.bpe, self.known)
        return list(map(self.known.__getitem__, pieces))


class CountTree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text, self.encoded = counter, text, 0
        pieces = counter.split.findall(text)
        self._lay(np.fromiter(map(len, pieces), np.int64, len(pieces)), np.array(counter.count(pieces), np.int64))

    def _lay(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        n = max(1, len(chars))
        self.size = 1 << (n - 1).bit_length()
        self.tree = np.zeros((2, 2 * self.size), np.int64)
        self.tree[0, self.size:self.size + len(chars)] = chars
        self.tree[1, self.size:self.size + len(chars)] = tokens
        self.leaves = n
        self.inside: dict[int, list[tuple[int, int]]] = {}  # leaves of several pre-tokens
        self._renew(0, self.size - 1)

    def _renew(self, lo: int, hi: int) -> None:
        """Sums above the leaves lo to hi."""
        lo, hi = lo + self.size >> 1, hi + self.size >> 1
        while lo:
            self.tree[:, lo:hi + 1] = self.tree[:, 2 * lo:2 * hi + 2:2] + self.tree[:, 2 * lo + 1:2 * hi + 2:2]
            lo, hi = lo >> 1, hi >> 1

    @property
    def tokens(self) -> int:
        return int(self.tree[1, 1])

    def _parts(self, leaf: int) -> list[tuple[int, int]]:
        """(characters, tokens) of the pre-tokens of a leaf."""
        got = self.inside.get(leaf)
        if got is None:
            c, t = self.tree[:, self.size + leaf].tolist()
            got = [(c, t)] if c else []
        return got

    def locate(self, pos: int) -> tuple[int, int, int]:
        """(leaf, part, start) of the pre-token that holds the character at pos; behind the last one: the end."""
        if pos >= self.tree[0, 1]:
            last = self.size - 1
            return last, len(self._parts(last)), int(self.tree[0, 1])
        node, start = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.tree[0, node])
            if pos >= start + left:
                start += left
                node += 1
        leaf = node - self.size
        for k, (c, _) in enumerate(self._parts(leaf)):
            if pos < start + c:
                return leaf, k, start
            start += c
        raise AssertionError("sums and parts differ")

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end] by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        leaf, part, at = self.locate(max(start - REACH, 0)) if len(self.text) else (0, 0, 0)
        self.text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        pieces, stop = [], None
        for m in self.counter.split.finditer(self.text, at):
            old = m.start() - shift
            if m.start() >= start + len(new) and old >= end:
                to = self.locate(old)
                if to[2] == old:                            # an old boundary: all after it is as before
                    stop = to
                    break
            pieces.append(m.group())
        if stop is None:
            stop = (self.size - 1, len(self._parts(self.size - 1)), 0)
        fresh = list(zip(map(len, pieces), self.counter.count(pieces)))
        self.encoded += len(fresh)
        to, skip = stop[:2]
        head = self._parts(leaf)[:part]
        if to == leaf:
            self._put(leaf, head + fresh + self._parts(leaf)[skip:])
        else:
            rest = self._parts(to)[skip:]
            for k in [k for k in self.inside if leaf < k < to]:
                del self.inside[k]
            self.tree[:, self.size + leaf + 1:self.size + to] = 0
            self._put(to, rest)
            self._put(leaf, head + fresh)
        self._renew(leaf, to)
        if len(self.inside.get(leaf, ())) > max(256, self.leaves):
            parts = [p for k in range(self.size) for p in self._parts(k)]
            self._lay(*np.array(parts, np.int64).T)

    def _put(self, leaf: int, parts: list[tuple[int, int]]) -> None:
        self.inside.pop(leaf, None)
        if len(parts) > 1:
            self.inside[leaf] = parts
        self.tree[:, self.size + leaf] = [sum(c for c, _ in parts), sum(t for _, t in parts)]


_COUNTERS: dict[tuple[str, str], Counter] = {}


def _counter(rank_file: str, pattern: str) -> Counter:
    key = rank_file, pattern
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(codec(rank_file, pattern))
    return _COUNTERS[key]


def count_edits(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """Append counts before and after the edits of each row, made one after another.

    ``edits_col``: array of structs (start, end, text), in characters of the text as it is at that time.  Adds
    ``n_tokens``, ``n_pretokens`` (before), ``n_tokens_edited``, ``n_encoded`` (pre-tokens encoded again) and
    ``edited`` (the text after all edits).
    """
    def fn(b: pa.RecordBatch) -> list[pa.Array]:
        counter, out = _counter(rank_file, pattern), []
        for text, edits in zip(b.column(0), b.column(1)):
            tree = CountTree(counter, text.as_py() or "")
            before, pieces = tree.tokens, int(np.count_nonzero(tree.tree[0, tree.size:]))
            for e in edits.as_py() or ():
                if e is not None and e["start"] is not None:
                    tree.edit(e["start"], e["end"] if e["end"] is not None else e["start"], e["text"] or "")
            out.append((before, pieces, tree.tokens, tree.encoded, tree.text))
        cols = list(zip(*out))
        return [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.string())]

    edits = F.transform(F.col(f"`{edits_col}`"), lambda e: F.struct(
        e["start"].cast("bigint").alias("start"), e["end"].cast("bigint").alias("end"), e["text"].cast("string").alias("text")))
    return add_columns(docs, [text_input(docs, text_col), edits], fn,
                       "n_tokens bigint, n_pretokens bigint, n_tokens_edited bigint, n_encoded bigint, edited string")


def sample_edits(text, seed):
    """Three edits that follow from a text: its first 40 characters go, 30 of its characters are put in again at a
    place given by ``seed``, and its last 25 characters turn to capitals."""
    n = F.length(text)
    left = F.greatest(n - 40, F.lit(0))
    place = F.pmod(seed, left + 1)
    total = left + F.length(F.substring(text, 101, 30))
    return F.array(
        F.struct(F.lit(0).alias("start"), F.lit(40).alias("end"), F.lit("").alias("text")),
        F.struct(place.cast("int").alias("start"), place.cast("int").alias("end"), F.substring(text, 101, 30).alias("text")),
        F.struct(F.greatest(total - 25, F.lit(0)).alias("start"), total.alias("end"),
                 F.upper(F.substring(text, -25, 25)).alias("text")))


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("edits", sample_edits(F.col("text"), F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))))
    done = count_edits(docs, *public_ranks())
    return done.select("doc_id", "n_tokens", "n_pretokens", "n_tokens_edited", "n_encoded",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
