"""SimHash near-duplicates by vantage-point trees.

Fingerprints are compared exactly, but only where triangle bounds cannot rule a pair out.  Two fingerprints
that differ in at most ``k`` bits differ in at most ``k // b`` bits in one of ``b`` blocks of the bits at least,
so each block has its own tree over the Hamming distance of that block, with the small radius ``k // b`` (on
whole 64-bit fingerprints most points lie within the radius of every median, and nothing is pruned).

The upper levels are the shards: vantage points and median distances come from a bounded sample of
``SAMPLE`` fingerprints (which only decides how even the shards are), and every fingerprint is filed in its home
shard and visits the shards that its ball reaches.  Inside a shard the tree goes on over the shard's own
points; at a leaf, visitors and points meet in blocks of XOR and bit counts over all 64 bits.  A shard returns
a spanning forest of its links, not all pairs, and the forests are joined to components by star contraction.

Equal fingerprints are one point, so groups of copies cost nothing here.

Defined cases: NULL text is the empty text; a text without words has fingerprint zero, linked like any
other; fewer words than a shingle make one shingle; repeated rows and ties share a fingerprint; an empty table
gives an empty result; NULL ids are linked too, and a component of NULL ids alone has the id NULL;
other columns are not read by ``near_duplicates`` and pass through ``keep_one``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import (ROW_HASH, ROW_ID, Words, add_columns, buffer_of, components, doc_groups, fold_table, forget_others,
                                 key_join, local_forest, map_arrow, partitions_for, row_key, store, table, text_input)

SHINGLE, MAX_BITS, BLOCKS = 4, 4, 3
SAMPLE = 65_536                 # fingerprints that place the shards
SHARD_POINTS = 20_000
LEAF_POINTS = 64
SLICE = 100_000                 # shingles hashed at a time
_SPACE = fold_table(b" \t\n\x0b\x0c\r")


def fingerprints(data: np.ndarray, off: np.ndarray, shingle: int) -> np.ndarray:
    """SimHash of each document of a run (bytes and offsets)."""
    words = Words(data, off, _SPACE)
    buf, hash64 = words.text.tobytes(), xxhash.xxh64_intdigest
    starts = words.word_start
    out = np.zeros(len(off) - 1, np.uint64)
    for d in range(len(out)):
        a, b = int(words.first_word[d]), int(words.first_word[d + 1])
        if a == b:
            continue
        begin = starts[a:b]
        stop = np.append(begin[1:], words.end[d]) - 1
        width = min(shingle, b - a)
        begin, stop = begin[:b - a - width + 1], stop[width - 1:]
        ones = np.zeros(64, np.int64)
        for i in range(0, len(begin), SLICE):
            h = np.array([hash64(buf[s:e], 42) for s, e in zip(begin[i:i + SLICE].tolist(), stop[i:i + SLICE].tolist())],
                         "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[d] = np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0]
    return out


def add_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """Append the fingerprint as a long (its 64 bits)."""
    def fn(b: pa.RecordBatch) -> list[pa.Array]:
        data, off = buffer_of(b.column(0))
        got = [fingerprints(data, off[i:j + 1], shingle) for i, j in doc_groups(off, 1 << 20)]
        return [pa.array(np.concatenate(got).view(np.int64), pa.int64())]

    return add_columns(docs, [text_input(docs, text_col)], fn, f"`{out}` bigint")


def block_bits(blocks: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each block."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(fp: np.ndarray, bits: tuple[int, int]) -> np.ndarray:
    return (fp >> np.uint64(bits[0])) & np.uint64((1 << bits[1]) - 1 if bits[1] < 64 else 0xFFFFFFFFFFFFFFFF)


def _far(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def _median(dist: np.ndarray) -> int | None:
    """A distance that splits the points best, None if they are all equally far."""
    lo, hi = int(dist.min()), int(dist.max())
    if lo == hi:
        return None
    below = np.cumsum(np.bincount(dist, minlength=hi + 1))
    return lo + int(np.abs(below[lo:hi] - len(dist) / 2).argmin())


def plant(points: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Upper levels over sample points as a heap: (vantage point, median distance) of node i, whose children
    are 2 i + 1 (at most the median) and 2 i + 2; median 64 sends all one way."""
    nodes, sets = [], [points]
    for i in range(2 ** depth - 1):
        mine = sets[i]
        split = None
        if len(mine) > 1:
            vantage = mine[len(mine) // 2]
            dist = _far(mine, vantage)
            split = _median(dist)
        if split is None:
            nodes.append((0, 64))
            sets += [mine, mine[:0]]
        else:
            nodes.append((int(vantage), split))
            sets += [mine[dist <= split], mine[dist > split]]
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, int]], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point number, shard, home) for the home shard of each point and the shards that its ball reaches."""
    at = np.arange(len(points))
    node, home = np.zeros(len(points), np.int64), np.ones(len(points), bool)
    vantage = np.array([v for v, _ in nodes], np.uint64)
    split = np.array([s for _, s in nodes], np.int64)
    for _ in range((len(nodes) + 1).bit_length() - 1):
        dist = _far(points[at], vantage[node]).astype(np.int64)
        near = dist <= split[node]
        left, right = dist - radius <= split[node], dist + radius > split[node]
        right &= split[node] < 64
        at = np.concatenate([at[left], at[right]])
        home = np.concatenate([(home & near)[left], (home & ~near)[right]])
        node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return at, node - len(nodes), home


class Search:
    """All pairs of one shard: its points against themselves and its visitors, by a vantage-point tree."""

    def __init__(self, bits: tuple[int, int], radius: int, most: int):
        self.bits, self.radius, self.most = bits, radius, most
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held = 0

    def keep(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > 1 << 20:                             # many links: only a forest is kept
            self.links()

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            none = np.zeros(0, np.uint64)
            return none, none
        a, b = local_forest(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.held = [a], [b], 0
        return a, b

    def compare(self, points: np.ndarray, askers: np.ndarray) -> None:
        for i in range(0, len(askers), 4096):
            some = askers[i:i + 4096]
            for j in range(0, len(points), 512):
                q, p = np.nonzero(_far(some[:, None], points[None, j:j + 512]) <= self.most)
                x, y = some[q], points[j + p]
                other = x != y
                if other.any():
                    self.keep(x[other], y[other])

    def run(self, points: np.ndarray, askers: np.ndarray) -> None:
        """askers include the points themselves."""
        stack = [(points, _part(points, self.bits), askers, _part(askers, self.bits))]
        while stack:
            points, sub, askers, ask = stack.pop()
            if not len(points) or not len(askers):
                continue
            split = None
            if len(points) > LEAF_POINTS:
                vantage = sub[len(sub) // 2]
                dist = _far(sub, vantage)
                split = _median(dist)
            if split is None:
                self.compare(points, askers)
                continue
            near, to = dist <= split, _far(ask, vantage).astype(np.int64)
            for mine, who in ((near, to - self.radius <= split), (~near, to + self.radius > split)):
                stack.append((points[mine], sub[mine], askers[who], ask[who]))


def links(points: DataFrame, fp: str = "fp", most: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct fingerprints within ``most`` bits."""
    spark = points.sparkSession
    n = points.count()
    shards = partitions_for(n, SHARD_POINTS)
    depth = max(0, (shards - 1).bit_length())
    step = max(1, n // SAMPLE)
    rows = points.filter(F.pmod(F.xxhash64(fp), F.lit(step)) == 0).limit(2 * SAMPLE).collect() if depth else []
    sample = np.sort(np.array([r[fp] for r in rows], np.int64)).view(np.uint64)
    mixed = sample[np.argsort(sample * np.uint64(0x9E3779B97F4A7C15), kind="stable")]
    radius, parts = most // blocks, block_bits(blocks)
    trees = [plant(_part(mixed, bits), depth) for bits in parts]

    def send(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, bits in enumerate(parts):
                at, shard, home = route(_part(fps, bits), trees[k], radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard + (k << 32), pa.int64()), pa.array(fps[at].view(np.int64)), pa.array(home)],
                    names=["shard", "fp", "home"])

    def pairs(t: pa.Table) -> pa.Table:
        forget_others(__name__)
        shard = t.column("shard")[0].as_py()
        fps, home = t.column("fp").to_numpy().view(np.uint64), t.column("home").to_numpy()
        order = np.argsort(fps * np.uint64(0x9E3779B97F4A7C15))     # same tree whatever the order of arrival
        fps, home = fps[order], home[order]
        search = Search(parts[shard >> 32], radius, most)
        search.run(fps[home], fps)
        a, b = search.links()
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = map_arrow(points.select(F.col(fp).alias("fp")), send, "shard bigint, fp bigint, home boolean")
    width = max(shards * blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return sent.repartition(width, "shard").groupBy("shard").applyInArrow(pairs, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    most: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Row key, id, fingerprint ``fp`` and ``component_id`` (smallest id reachable) of every row.

    ``root`` is the smallest fingerprint of the component (signed), which names it whatever the ids.
    """
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), *row_key(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    rows = store(add_fingerprint(keyed, "text", shingle).drop("text"), "fingerprints")
    points = store(rows.groupBy("fp").agg(F.min("id").alias("least")), "points")
    found = components(links(points, "fp", most, blocks))
    named = store(points.join(found, points["fp"] == found["node"], "left").select(
        F.col("fp").alias("__fp"), "least", F.coalesce("root", "fp").alias("root")), "rooted")
    # written before the join, which then has no aggregate in its stage: a component with very many points can be split
    least = store(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = store(named.join(least, "root").select("__fp", "root", "component_id"), "named")
    return rows.join(named, rows["fp"] == named["__fp"]).drop("__fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest text hash; repeated
    rows count as one."""
    found = near_duplicates(docs, id_col, text_col, **how)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", ROW_HASH, ROW_ID)).alias("b"))
    best = best.select(F.col(f"b.{ROW_ID}").alias(ROW_ID), F.col(f"b.{ROW_HASH}").alias(ROW_HASH))
    keyed = docs.withColumns({ROW_ID: row_key(id_col, text_col)[0], ROW_HASH: row_key(id_col, text_col)[1]})
    return key_join(keyed, best, "left_semi").dropDuplicates([ROW_ID, ROW_HASH]).drop(ROW_ID, ROW_HASH)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
