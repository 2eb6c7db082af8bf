"""Helpers shared by the operators of this subpackage.

Rows are addressed by ``row_key``: the id column plus a 64-bit hash of the text.  Equal rows share a
key and, being equal, share every result, so repeated rows and NULL ids need no surrogate number that
could change when a task is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.session import scratch_path

ROW_HASH = "__row_hash"
ROW_ID = "__row_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text column (or a binary one as it is); NULL counts as the empty text."""
    return F.coalesce(text.cast("binary"), F.lit("").cast("binary"))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """The two key columns (``ROW_ID`` and ``ROW_HASH``); join them null-safely with ``key_join``."""
    return [F.col(f"`{id_col}`").cast("string").alias(ROW_ID),
            F.xxhash64(F.col(f"`{text_col}`")).alias(ROW_HASH)]


def key_join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the row key; both sides carry it, the result keeps the left one."""
    r = right.withColumnsRenamed({ROW_ID: "__r_id", ROW_HASH: "__r_hash"})
    on = left[ROW_ID].eqNullSafe(r["__r_id"]) & (left[ROW_HASH] == r["__r_hash"])
    return left.join(r, on, how).drop("__r_id", "__r_hash")


_CACHES: list[tuple[str, Callable[[], None]]] = []


def register_cache(owner: str, forget: Callable[[], None]) -> None:
    """Name the module that keeps a cache in this worker, and how to empty it."""
    _CACHES.append((owner, forget))


def forget_others(owner: str) -> None:
    """Empty the caches of other modules: workers are used again, and one that turns to another operator
    has no use for what the last one kept."""
    for name, forget in _CACHES:
        if name != owner:
            forget()


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | T.StructType) -> DataFrame:
    def run(batches):
        forget_others(fn.__module__)
        yield from fn(batches)

    return df.mapInArrow(run, schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema))


def text_input(df: DataFrame, name: str) -> Column | str:
    """A text column as input of ``add_columns``: sent once if it is a string already."""
    return name if isinstance(df.schema[name].dataType, T.StringType) else F.col(f"`{name}`").cast("string")


def add_columns(df: DataFrame, inputs: list[Column | str], fn: Callable[[pa.RecordBatch], list[pa.Array]], new: str) -> DataFrame:
    """Append the columns ``new`` (DDL) computed by ``fn`` from the Arrow batch of ``inputs``.

    Every column of ``df`` passes through untouched; ``fn`` sees only the inputs.  Those given by name are columns
    that pass through anyway, others are sent under private names, so a clashing column name cannot reach ``fn``.
    An existing column with the name of a new one is replaced.
    """
    added = T.StructType.fromDDL(new)
    keep = [f for f in df.schema.fields if f.name not in set(added.names)]
    place = {f.name: i for i, f in enumerate(keep)}
    names, mark = {f.name for f in df.schema.fields}, "__in"
    while any(f"{mark}{i}" in names for i in range(len(inputs))):
        mark += "_"
    use, sent = [], []
    for c in inputs:
        if isinstance(c, str) and c in place:
            use.append(place[c])
        else:
            use.append(len(keep) + len(sent))
            sent.append((F.col(f"`{c}`") if isinstance(c, str) else c).alias(f"{mark}{len(sent)}"))
    out = T.StructType([*keep, *added.fields])

    def run(batches):
        forget_others(fn.__module__)
        for b in batches:
            if not b.num_rows:
                continue
            got = fn(pa.RecordBatch.from_arrays([b.column(i) for i in use], names=[str(i) for i in range(len(use))]))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], *got], names=out.names)

    return df.select(*[F.col(f"`{f.name}`") for f in keep], *sent).mapInArrow(run, out)


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string array, NULL as empty; row i is bytes[offsets[i]:offsets[i+1]]."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    if pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type):
        off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    else:
        off = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4).astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, off


def doc_groups(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def fold_table(breaks: bytes) -> np.ndarray:
    """Byte table that lower-cases A-Z and turns the bytes between words into spaces."""
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 0x20
    fold[list(breaks)] = 32
    return fold


class Words:
    """Texts of a run of documents, folded by a table and with one space between words.

    ``text``: for each document its words, each after one space, then a space and a zero byte.
    ``first_word[d]``: number of words before document d; ``word_at(p)``: words that start before p.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, fold: np.ndarray):
        base = int(off[0])
        raw = fold[data[base:int(off[-1])]]
        off = off - base
        n = len(off) - 1
        word = raw != 32
        start = word.copy()
        start[1:] &= ~word[:-1]
        cut = off[:-1][off[:-1] < len(raw)]
        start[cut] = word[cut]                              # a document's first byte starts a word
        sizes = np.diff(off)
        place = np.cumsum(word.astype(np.int64) + start)
        total = np.concatenate([[0], place])[off]           # bytes written before each document
        doc = np.repeat(np.arange(n), sizes)
        self.text = np.full(int(total[-1]) + 2 * n + 16, 32, np.uint8)
        where = place[word] - 1 + 2 * doc[word]
        self.text[where] = raw[word]
        self.end = total[1:] + 2 * np.arange(n) + 1         # place of each document's zero byte
        self.text[self.end] = 0
        self.size = int(total[-1]) + 2 * n
        self.text[self.size:] = 0
        starts = np.concatenate([[0], np.cumsum(start)])
        self.first_word = starts[off]
        self.word_start = (place[start] - 1 + 2 * doc[start])

    def word_at(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.word_start, pos)

    def doc_at(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, pos)


def span_codes(starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The byte strings data[starts[i]:ends[i]] (in order, not overlapping) as numbers, and the strings by number."""
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.binary())
    offsets = np.empty(2 * len(starts) + 1, np.int32)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = starts, ends, ends[-1]
    cells = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = cells.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(total: int, each: int, least: int = 1) -> int:
    """Number of partitions so that each holds about ``each`` units."""
    return max(least, -(-int(total or 0) // each))


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the given edges connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of each node that has an edge; root is the smallest node of its component.

    Large-star and small-star rounds in turn, each a join of the edges with the smallest neighbour of
    each node, written below the checkpoint folder.  The number of edges never grows; a node with very many
    neighbours is only ever joined with its one smallest neighbour, so its rows can be split.
    """
    cols = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")            # an edge points from u to the smaller v
    cur = store(edges.select(*cols).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = cur.select(F.col("u").alias("n"), F.col("v").alias("o")).union(cur.select(F.col("v"), F.col("u")))
        least = both.groupBy("n").agg(F.least(F.min("o"), F.col("n")).alias("m"))
        large = both.join(least, "n").filter("o > n").select(F.col("o").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v"))
        cur = store(small.filter("u <> v").distinct(), "edges")
        now = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
