"""Token ids in range-coded files.

``write_ids`` sorts the texts by id, encodes them with the tokenizers library, ends each with one id more,
and writes segments: rows of Parquet files, in id order, that hold the ids of some million tokens.  A segment
is a header (``TID2``, the number of blocks, the length of the table, the CRC-32 of what follows up to the payloads; then
the number of ids, the payload length and the CRC-32 of each block; the shares of the segment's ids, compressed) and the
payloads of its blocks (``range_coder``), each coded from a fresh state.  Beside it stand the documents' ids
and lengths and the segment's place.  ``read_ids`` decodes the segments, verifies every block, and adds the
number of ids before each document.

The texts are dealt to tasks by ranges of their ids (ties by a hash of the text, so one id on very many
rows is dealt too); numbers of ids before a segment are sums over one number a segment.  Spark's writer commits the
files, so lost executors cost the tasks they ran only.

The literal text of a special token (``<|endoftext|>``) is that token, as the library has it by default.

Defined cases: NULL or empty text gives the end id alone; rows of NULL id come last; equal rows give equal documents
side by side; an empty table gives no segments and an empty result; other columns are not stored.  Tokenizers
with ids beyond ``MAX_ID`` (two bytes an id) raise ``ValueError``.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanmart.llm.common import buffer_of, doc_groups, map_arrow, partitions_for, table
from loanmart.session import scratch_path
from loanmart.llm.range_coder import BLOCK_IDS, LANES, MAX_ID, checksum, decode_blocks, encode_blocks, frequencies

MAGIC = b"TID2"
END_ID = 1
TASK_BYTES = 24 << 20           # of text
CACHE_BYTES = 24 << 20
SEGMENT_IDS = BLOCK_IDS * LANES
LEAST_IDS = 256                 # of a block
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
#: Kinds of bytes (white space, ASCII letters, punctuation, others): neighbours are parted if theirs make 3 or more by xor.
_SPACE, _LETTER, _POINT = 4, 1, 2
_KIND = bytes(_SPACE if c in b" \t\n\r\v\f" else _LETTER if c < 0x80 and chr(c).isalpha() else
              _POINT if 0x21 <= c < 0x7F and not chr(c).isalnum() and c != 0x27 else 0 for c in range(256))
_LATIN = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")      # letters that are whole in NFC


class WordIds:
    """Ids of texts, by way of the ids of their words.

    The tokenizer drops white space, never joins across it and takes no account of case, so the ids of a text are
    those of its lower-cased words between ASCII white space, one after another.  It also ends a piece between an ASCII letter
    and punctuation, so words are cut there (apostrophes aside, which may begin a piece of their own kind).  Words met
    before are not encoded again (a table of a fixed number of bytes, the words met longest ago leave it); new ones are
    encoded many to a call: those of Latin letters side by side, as the last token of each is marked as such, others with
    a control character between them.
    """

    MARK = "\x01"
    JOINED = 16
    TEXT_BYTES = 12 << 20           # of text looked at together

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > MAX_ID + 1:
            raise ValueError(f"{path} has {self.tokenizer.get_vocab_size()} ids; files hold {MAX_ID + 1} at most")
        # special tokens are found before case goes (``encode_texts``): what is left only looks like one in lower case
        self.tokenizer.encode_special_tokens = True
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized}
        self.special = {x: struct.pack("<H", i) for x, i in special.items()}
        longest = sorted(special, key=len, reverse=True)
        self.literal = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        # words of Latin letters need no normalizing but lower case and are one piece each
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.last = np.zeros(MAX_ID + 1, bool)
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if end:
            self.last[[i for x, i in self.tokenizer.get_vocab().items() if x.endswith(end)]] = True
        self.words = pa.array([], pa.large_binary())
        self.ids = pa.array([], pa.large_binary())
        self.met = np.zeros(0, np.int64)
        self.calls = 0

    def _letters(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of Latin letters; None if their ends cannot be told."""
        lines = [" ".join(words[i:i + 64]).lower() for i in range(0, len(words), 64)]
        done = self.plain.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in done), np.uint16)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or len(ids) and ends[-1] != len(ids):
            return None
        raw, at = ids.astype("<u2").tobytes(), (2 * ends).tolist()
        return [raw[i:j] for i, j in zip([0, *at], at)]

    def _others(self, words: list[bytes]) -> list[bytes]:
        known: dict[bytes, bytes] = {}
        plain = [w for w in words if b"\x01" not in w] if len(self.mark) == 1 else []
        alone = [w for w in words if b"\x01" in w] if len(self.mark) == 1 else words
        groups = [plain[i:i + self.JOINED] for i in range(0, len(plain), self.JOINED)]
        between = f" {self.MARK} "
        for at in range(0, len(groups), 512):
            some = groups[at:at + 512]
            done = self.tokenizer.encode_batch_fast([between.join(w.decode() for w in g) for g in some], add_special_tokens=False)
            for group, e in zip(some, done):
                ids, start = e.ids, 0
                for w in group[:-1]:
                    end = ids.index(self.mark[0], start)
                    known[w] = struct.pack(f"<{end - start}H", *ids[start:end])
                    start = end + 1
                known[group[-1]] = struct.pack(f"<{len(ids) - start}H", *ids[start:])
        for w, e in zip(alone, self.tokenizer.encode_batch_fast([w.decode() for w in alone], add_special_tokens=False) if alone else ()):
            known[w] = struct.pack(f"<{len(e.ids)}H", *e.ids)
        return [known[w] for w in words]

    def _encode_new(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        latin = [_LATIN.fullmatch(t) is not None for t in texts]
        got = self._letters([t for t, x in zip(texts, latin) if x]) if any(latin) and self.last.any() else None
        if got is None:
            return self._others(words)
        letters, others = iter(got), iter(self._others([w for w, x in zip(words, latin) if not x]))
        return [next(letters) if x else next(others) for x in latin]

    def _rows(self, words: pa.Array) -> np.ndarray:
        """Rows of the table of known words that hold these (distinct) words."""
        self.calls += 1
        if self.words.nbytes + self.ids.nbytes > CACHE_BYTES:
            order = np.argsort(-self.met, kind="stable")
            size = pc.add(pc.binary_length(self.words), pc.binary_length(self.ids)).to_numpy()[order] + 16
            stay = np.sort(order[:int(np.searchsorted(np.cumsum(size), CACHE_BYTES // 2))])
            self.words, self.ids, self.met = self.words.take(stay), self.ids.take(stay), self.met[stay]
        rows = pc.index_in(words, value_set=self.words)
        new = rows.is_null()
        some = words.filter(new).to_pylist()
        rows = rows.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if some:
            rows[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(some))
            self.words = pa.concat_arrays([self.words, pa.array(some, pa.large_binary())])
            self.ids = pa.concat_arrays([self.ids, pa.array(self._encode_new(some), pa.large_binary())])
            self.met = np.concatenate([self.met, np.zeros(len(some), np.int64)])
        self.met[rows] = self.calls
        return rows

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as the library's defaults give them: the literal text of a special token is that token."""
        cut = {k: self.literal.split(t) for k, t in enumerate(texts) if any(x in t for x in self.special)}     # text and literals in turn
        ids = iter(self.encode([x for k, t in enumerate(texts) for x in (cut[k][::2] if k in cut else (t,))]))
        return [b"".join(self.special[x] if j % 2 else next(ids) for j, x in enumerate(cut[k])) if k in cut else next(ids)
                for k in range(len(texts))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, special tokens' literals as plain text, as little-endian unsigned 16-bit integers."""
        cells = [t.encode() for t in texts]
        off = np.cumsum([0, *map(len, cells)])
        return [x for i, j in doc_groups(off, self.TEXT_BYTES) for x in self._encode(cells[i:j])]

    def _encode(self, cells: list[bytes]) -> list[bytes]:
        joined = b" ".join([b"", *cells, b""])
        kind = np.frombuffer(joined.translate(_KIND), np.uint8)
        edge = np.flatnonzero((kind[1:] ^ kind[:-1]) >= 3) + 1
        word = np.flatnonzero(kind[edge] != _SPACE)
        start = edge[word]
        ends = np.concatenate([[0], np.cumsum(edge[1:][word] - start)]) if len(word) else np.zeros(1, np.int64)   # white space is last
        low = np.frombuffer(joined.translate(_LOWER), np.uint8)[kind != _SPACE]
        coded = pa.Array.from_buffers(pa.large_binary(), len(word), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(low)]).dictionary_encode()
        # the ids of all words side by side, cut at the texts' ends
        flat, off = buffer_of(self.ids_of(coded.dictionary).take(coded.indices))
        first = np.cumsum([1, *(len(c) + 1 for c in cells)])
        at = off[np.searchsorted(start, first)].tolist()
        raw = memoryview(flat)
        return [bytes(raw[i:j]) for i, j in zip(at, at[1:])]

    def ids_of(self, words: pa.Array) -> pa.Array:
        rows = self._rows(words)                            # may replace the table
        return self.ids.take(pa.array(rows))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pack_segment(ids: np.ndarray) -> bytes:
    """Range-coded blocks of one run of ids; a short run has shorter blocks, as blocks are coded side by side."""
    each = min(BLOCK_IDS, max(LEAST_IDS, len(ids) // 1024))
    blocks = [ids[i:i + each] for i in range(0, len(ids), each)]
    share = frequencies(np.bincount(ids, minlength=MAX_ID + 1))
    payloads = encode_blocks(blocks, share)
    head = np.array([(len(b), len(p), checksum(b)) for b, p in zip(blocks, payloads)], "<u4").reshape(-1, 3).tobytes()
    there = np.flatnonzero(share)
    shares = zlib.compress(there.astype("<u2").tobytes() + share[there].astype("<u4").tobytes())
    return b"".join([MAGIC, struct.pack("<III", len(blocks), len(shares), zlib.crc32(head + shares)), head, shares, *payloads])


def unpack_segment(data: bytes) -> np.ndarray:
    """Ids of a segment; a damaged block raises ``ValueError``."""
    if data[:4] != MAGIC or len(data) < 16:
        raise ValueError("not a segment of token ids")
    n, size, crc = struct.unpack_from("<III", data, 4)
    at = 16 + 12 * n
    if zlib.crc32(data[16:at + size]) != crc:
        raise ValueError("the head is damaged")
    head = np.frombuffer(data, "<u4", 3 * n, 16).reshape(n, 3)
    shares = zlib.decompress(data[at:at + size])
    known = len(shares) // 6
    share = np.zeros(MAX_ID + 1, np.int64)
    share[np.frombuffer(shares, "<u2", known)] = np.frombuffer(shares, "<u4", known, 2 * known)
    at = at + size + np.concatenate([[0], np.cumsum(head[:, 1].astype(np.int64))])
    if at[-1] != len(data):
        raise ValueError("a segment of another length")
    blocks = decode_blocks([data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], head[:, 0].tolist(), share)
    for i, b in enumerate(blocks):
        if checksum(b) != head[i, 2]:
            raise ValueError(f"block {i} is damaged")
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint16)


def write_ids(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> None:
    """Write the ids of ``docs`` to ``path`` in ascending order of ``id_col`` (an integer column)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    by = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc()]
    sorted_rows = rows.repartitionByRange(partitions_for(size, TASK_BYTES), *by).sortWithinPartitions(*by)
    part = F.spark_partition_id().cast("bigint")

    def fn(batches):
        number = 0
        held: list[bytes] = []
        doc: list[int | None] = []
        total = 0

        def flush():
            nonlocal number, held, doc, total
            ids = np.frombuffer(b"".join(held), "<u2")
            row = pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([number], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([doc], pa.list_(pa.int64())), pa.array([[len(h) // 2 for h in held]], pa.list_(pa.int64())),
                 pa.array([pack_segment(ids)], pa.binary())],
                names=["part", "segment", "n_ids", "doc_ids", "doc_lengths", "data"])
            number, held, doc, total = number + 1, [], [], 0
            return row

        end = struct.pack("<H", end_id)
        at = None
        for b in batches:
            if b.num_rows:
                at = b.column(2)[0].as_py()
            for i in range(0, b.num_rows, 4096):
                texts = b.column(1).slice(i, 4096).to_pylist()
                for k, ids in zip(b.column(0).slice(i, 4096).to_pylist(), word_ids(tokenizer_file).encode_texts(texts)):
                    held.append(ids + end)
                    doc.append(k)
                    total += len(ids) // 2 + 1
                    if total >= SEGMENT_IDS:
                        yield flush()
        if held:
            yield flush()

    out = map_arrow(sorted_rows.select("id", "text", part.alias("part")), fn,
                    "part bigint, segment bigint, n_ids bigint, doc_ids array<bigint>, doc_lengths array<bigint>, data binary")
    out.write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (packed, four bytes each) of
    the documents in the files, decoded and verified."""
    files = spark.read.schema("part bigint, segment bigint, n_ids bigint, doc_ids array<bigint>, doc_lengths array<bigint>, "
                              "data binary").parquet(path)
    before = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("part", "segment", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))

    def fn(batches):
        for b in batches:
            for i in range(b.num_rows):
                first, docs, sizes = b.column(0)[i].as_py(), b.column(1)[i].values, b.column(2)[i].values.to_numpy()
                ids = unpack_segment(b.column(3)[i].as_py()).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(sizes)])
                for j in range(0, len(sizes), 2000):
                    z = min(j + 2000, len(sizes))
                    offsets = ((ends[j:z + 1] - ends[j]) * 4).astype(np.int64)
                    packed = pa.Array.from_buffers(pa.large_binary(), z - j, [
                        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids[ends[j]:ends[z]].tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [docs.slice(j, z - j), pa.array(first + ends[j:z], pa.int64()), pa.array(sizes[j:z], pa.int64()), packed],
                        names=["doc_id", "start", "n_tokens", "ids"])

    joined = files.join(places, ["part", "segment"]).select("first", "doc_ids", "doc_lengths", "data")
    return map_arrow(joined, fn, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """Token files of ``documents``, written and read back."""
    import public_tokenizers
    path = scratch_path(spark, "token-files")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
