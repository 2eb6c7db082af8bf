"""Removal of long byte strings that occur more than once, by suffix arrays in shards.

Every window of ``length`` bytes has an anchor: of the ``gram``-byte strings inside it the one with the
smallest hash, the leftmost if equal.  Equal windows have equal anchors at the same place, so windows are
filed under the hash of their anchor, and consecutive windows with one anchor form a region.  Regions are counted by
anchor and content (summed before the shuffle).  Regions of equal content repeat one another whole.  Those
whose anchor has other contents too go, one of each content, to shards: a shard sorts the suffixes of
its regions (``suffixes.suffix_array``), and a window is repeated if it shares its first ``length`` bytes with
the window next to it in the array.  No pairs are formed, and an anchor seen once sends no text.

An anchor with more than ``HOT_BYTES`` of different contents (a short passage that very many documents share)
is split: its windows are halved by their place against the anchor, and each half is filed under the hash of
all bytes its windows have in common, again and again; a half of one place holds equal windows only.

Defined cases: NULL text is the empty text; texts shorter than ``length`` keep all; equal rows repeat each
other, so texts of ``length`` bytes or more that occur in two rows go whole; repeated ids and NULL ids are
told apart by a hash of the text; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import (ROW_HASH, ROW_ID, add_columns, buffer_of, forget_others, key_join, map_arrow, partitions_for, row_key,
                                 store, table, text_bytes, text_input)
from loanmart.llm.suffixes import common_prefixes, suffix_array

LENGTH, GRAM = 400, 64
PIECE = 1 << 20                 # bytes of text looked at together
SHARD_BYTES, HOT_BYTES = 2 << 20, 8 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_WORD_BYTE = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up = np.full(size, _ODD, np.uint64)
        down = np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed hash of the ``gram`` bytes from each position on."""
    n = len(data)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[:n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of x[i:i + width] for each i."""
    n = len(x)
    full = -(-n // width) * width
    y = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    y[:n] = x
    y = y.reshape(-1, width)
    left = np.minimum.accumulate(y, 1).ravel()
    right = np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def regions(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(anchor hash, anchor, first window, last window) of the regions of the pieces data[starts:ends]."""
    h = gram_hashes(data, gram)
    keyed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    anchor = (_window_min(keyed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int8)
    fits = ends - starts >= length
    np.add.at(inside, starts[fits], 1)
    np.add.at(inside, ends[fits] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:len(anchor)]))
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    a = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)]))
    last = np.append(first[1:], len(at)) - 1
    return h[a[first]], a[first], at[first], at[last]


def _pieces(off: np.ndarray, length: int):
    """Groups of (row, start, end): whole rows, long rows cut into pieces that overlap by length - 1."""
    group, held = [], 0
    for row in range(len(off) - 1):
        a, z = int(off[row]), int(off[row + 1])
        if z - a < length:
            continue
        while a + length <= z:
            e = min(z, a + PIECE + length - 1)
            group.append((row, a, e))
            held += e - a
            a = e - length + 1
            if held >= PIECE:
                yield group
                group, held = [], 0
    if group:
        yield group


def _anchor_rows(batch: pa.RecordBatch, length: int, gram: int):
    """Rows (row number, anchor hash, content hash, count, offset in the text, bytes, anchor's place, spans) of a batch."""
    data, off = buffer_of(batch)
    for group in _pieces(off, length):
        row = np.array([g[0] for g in group])
        at, end = np.array([g[1] for g in group]), np.array([g[2] for g in group])
        starts = np.concatenate([[0], np.cumsum(end - at)])
        buf = np.concatenate([data[a:e] for a, e in zip(at, end)])
        key, anchor, first, last = regions(buf, starts[:-1], starts[1:], length, gram)
        if not len(key):
            continue
        piece = np.searchsorted(starts, first, "right") - 1
        raw, digest = memoryview(buf.tobytes()), xxhash.xxh3_64_intdigest
        content = np.array([digest(raw[a:e]) for a, e in zip(first.tolist(), (last + length).tolist())], np.uint64)
        doc, place = row[piece], first - starts[piece] + at[piece] - off[row[piece]]
        order = np.lexsort((place, content, key, doc))
        same = np.concatenate([[False], (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
                               & (content[order][1:] == content[order][:-1])])
        head = np.flatnonzero(~same)
        count = np.diff(np.append(head, len(order)))
        pick = order[head]
        spans: list[bytes | None] = [None] * len(pick)
        for k in np.flatnonzero(count > 1).tolist():        # copies in one text: the union of their bytes
            p = place[order[head[k]:head[k] + count[k]]]
            spans[k] = merge_spans(p, p + int(last[pick[k]] - first[pick[k]]) + length).tobytes()
        yield (doc[pick], key[pick].view(np.int64), content[pick].view(np.int64), count, place[pick],
               (last - first + length)[pick], (anchor - first)[pick], spans)


def merge_spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Union of spans, as sorted rows (start, end) that neither overlap nor touch."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    return np.stack([s[first], np.append(e[:-1][first[1:]], e[-1])], 1).astype(np.int64)


def anchors(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Regions of every text of ``keyed`` (row key and ``text``), equal ones of a row in one row."""
    names = [ROW_ID, ROW_HASH, "gh", "ch", "cnt", "at", "len", "lead", "spans"]

    def fn(batches):
        for b in batches:
            for doc, *cols, spans in _anchor_rows(b.column(2), length, gram):
                i = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(i), b.column(1).take(i), *[pa.array(c, pa.int64()) for c in cols],
                     pa.array(spans, pa.binary())], names=names)

    ddl = ", ".join(f"{n} {t}" for n, t in zip(names, ["string"] + ["bigint"] * 7 + ["binary"]))
    return map_arrow(keyed.select(ROW_ID, ROW_HASH, text_bytes(F.col("text")).alias("b")), fn, ddl)


def repeated_windows(texts: list[bytes], first: np.ndarray, last: np.ndarray, length: int,
                     owner: np.ndarray | None = None) -> list[np.ndarray]:
    """For each text, which of its windows first[i]..last[i] occur among the windows of all texts again - if
    ``owner`` names the texts' rows, in a text of another row.
    """
    size = np.array([len(t) for t in texts])
    at = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    joined = np.full(int(size.sum()) + len(texts), 256, np.uint16)
    for a, t in zip(at.tolist(), texts):
        joined[a:a + len(t)] = np.frombuffer(t, np.uint8)
    sa = suffix_array(joined)
    prefix = common_prefixes(joined, sa)
    asked = np.zeros(len(joined) + 1, np.int8)
    np.add.at(asked, at + first, 1)
    np.add.at(asked, at + last + 1, -1)
    asked = np.cumsum(asked[:-1]) > 0
    place = np.flatnonzero(asked[sa])                       # places of the windows in the array
    again = np.zeros(len(joined), bool)
    if len(place) > 1:
        shared = np.minimum.reduceat(prefix, place[:-1] + 1)
        shared[-1] = prefix[place[-2] + 1:place[-1] + 1].min()
        first_of = np.flatnonzero(np.concatenate([[True], shared < length]))     # runs of equal windows
        size_of = np.diff(np.append(first_of, len(place)))
        if owner is None:
            several = size_of > 1
        else:
            who = owner[np.searchsorted(at, sa[place], "right") - 1]
            several = np.minimum.reduceat(who, first_of) != np.maximum.reduceat(who, first_of)
        again[sa[place[np.repeat(several, size_of)]]] = True
    return [again[a + f:a + z + 1] for a, f, z in zip(at.tolist(), first.tolist(), last.tolist())]


def _shard(t: pa.Table, length: int, across: bool) -> pa.Table:
    """Repeated spans of each region of a shard, relative to the region; ``across``: in other rows only."""
    forget_others(__name__)
    order = np.lexsort((t.column("w0").to_numpy(), t.column("ch").to_numpy(), t.column("gh").to_numpy()))
    t = t.take(pa.array(order))
    gh, ch, w0, w1 = (t.column(c).to_numpy() for c in ("gh", "ch", "w0", "w1"))
    once = np.concatenate([[True], (gh[1:] != gh[:-1]) | (ch[1:] != ch[:-1]) | (w0[1:] != w0[:-1])])   # repeated rows
    pick = np.flatnonzero(once)
    raw = [t.column("region")[int(i)].as_py() for i in pick]
    texts = [r[a:z + length] for r, a, z in zip(raw, w0[pick].tolist(), w1[pick].tolist())]
    owner = t.column("owner").to_numpy()[pick] if across else None
    found = repeated_windows(texts, np.zeros(len(pick), np.int64), w1[pick] - w0[pick], length, owner)
    keep, spans = [], []
    for i, again in zip(pick.tolist(), found):
        p = np.flatnonzero(again) + w0[i]
        if len(p):
            keep.append(i)
            spans.append(merge_spans(p, p + length).tobytes())
    return pa.table({"gh": gh[keep], "ch": ch[keep], "part": pa.array(spans, pa.binary())})


def _split_hot(found: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows for the shards, spans known from equal windows).  ``found``: gh, ch, owner, lead, region, w0, w1
    (windows asked for), key, lo, hi (places of the key's windows against the anchor)."""
    ready, known, hot = None, None, found
    while True:
        sizes = hot.groupBy("key").agg(F.sum(F.octet_length("region")).alias("b"), F.count(F.lit(1)).alias("n"))
        large = store(sizes.filter((F.col("b") > HOT_BYTES) & (F.col("n") > 1)).select("key"), "hot")
        if large.isEmpty():
            return (hot if ready is None else ready.unionByName(hot)), known
        cold = hot.join(large, "key", "left_anti")
        hot = hot.join(large, "key", "left_semi")
        same = hot.filter("lo = hi").select("gh", "ch", F.col("w0").alias("s"))
        known = same if known is None else known.unionByName(same)
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        halves = hot.filter("lo < hi").withColumn("half", F.explode(F.array(
            F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi").alias("hi")))))
        halves = halves.select("gh", "ch", "owner", "lead", "region", "key", F.col("half.lo").alias("lo"), F.col("half.hi").alias("hi"),
                               F.greatest("w0", F.col("half.lo") + F.col("lead")).alias("w0"),
                               F.least("w1", F.col("half.hi") + F.col("lead")).alias("w1")).filter("w0 <= w1")
        core = F.expr(f"substring(region, int(hi + lead + 1), int(lo + {length} - hi))")
        halves = halves.withColumn("key", F.xxhash64("key", "lo", core))
        alone = halves.groupBy("key").agg(F.min("owner").alias("a"), F.max("owner").alias("z")).filter("a <> z").select("key")
        hot = store(halves.join(alone, "key", "left_semi"), "halves")
        ready = cold if ready is None else ready.unionByName(cold)


def repeated_spans(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, across: bool = False) -> DataFrame:
    """Row key and ``hits`` (see ``row_spans``) of the rows with strings that occur again.

    ``keyed``: the row key and ``text`` (string or binary).  With ``across`` only strings count that occur in
    another row too, not those that one row alone repeats.
    """
    gram = min(gram, length)
    spark = keyed.sparkSession
    all_rows = anchors(keyed, length, gram)
    by_content = all_rows.groupBy("gh", "ch").agg(
        F.sum(F.lit(1) if across else F.col("cnt")).alias("n"), *[F.first(c).alias(c) for c in (ROW_HASH, "at", "len", "lead")])
    by_content = store(by_content, "regions")
    several = by_content.groupBy("gh").agg(F.count(F.lit(1)).alias("d")).filter("d > 1").select("gh")
    asked = store(by_content.join(several, "gh", "left_semi"), "asked")
    size = asked.agg(F.sum("len").alias("b")).first()["b"]
    shards = partitions_for(size or 0, SHARD_BYTES)
    # the text of one region of each content
    part = F.expr("substring(b, int(at + 1), int(len))")
    # rows with equal keys have equal texts; the content hash below tells a clash of row hashes
    text = keyed.select(ROW_HASH, text_bytes(F.col("text")).alias("b"))
    owner = F.when(F.col("n") > 1, F.xxhash64("gh", "ch")).otherwise(F.col(ROW_HASH) if across else F.xxhash64("gh", "ch"))
    found = asked.join(text, ROW_HASH).select(
        "gh", "ch", owner.alias("owner"), "lead", part.alias("region"), F.lit(0).cast("bigint").alias("w0"),
        (F.col("len") - length).alias("w1"), F.col("gh").alias("key"),
        F.lit(gram - length).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("hi"))
    found = store(found, "region_texts")
    rows, same = _split_hot(found, length, gram)
    rows = rows.select("gh", "ch", "owner", "region", "w0", "w1", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    width = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    partial = (rows.repartition(width, "shard").groupBy("shard")
               .applyInArrow(lambda t: _shard(t, length, across), "gh bigint, ch bigint, part binary"))
    if same is not None:
        pair = F.concat(_packed("s"), _packed(f"s + {length}"))
        partial = partial.unionByName(same.select("gh", "ch", pair.alias("part")))
    whole = by_content.filter("n > 1").select("gh", "ch", F.lit(None).cast("binary").alias("part"))
    told = store(partial.unionByName(whole), "told")
    hits = all_rows.join(told, ["gh", "ch"]).select(
        ROW_ID, ROW_HASH, F.struct("at", "len", F.when(F.col("part").isNull(), F.col("spans")).alias("spans"), "part").alias("h"))
    return hits.groupBy(ROW_ID, ROW_HASH).agg(F.collect_list("h").alias("hits"))


def _packed(expr: str):
    """Eight little-endian bytes of a long expression."""
    return F.unhex(F.concat(*[F.lpad(F.hex(F.expr(f"({expr}) >> {8 * i} & 255")), 2, "0") for i in range(8)]))


def row_spans(hits: list[dict]) -> np.ndarray:
    """Union of the hits of one row."""
    start, end = [], []
    for h in hits:
        if h["part"] is not None:
            p = np.frombuffer(h["part"], "<i8").reshape(-1, 2) + h["at"]
        elif h["spans"] is not None:
            p = np.frombuffer(h["spans"], "<i8").reshape(-1, 2)
        else:
            p = np.array([[h["at"], h["at"] + h["len"]]])
        start.append(p[:, 0])
        end.append(p[:, 1])
    return merge_spans(np.concatenate(start), np.concatenate(end))


def _whole_characters(text: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Spans without the characters that they cover in part only."""
    out = []
    for s, e in spans.tolist():
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return np.array(out, np.int64).reshape(-1, 2)


def _long_enough(text: np.ndarray, spans: np.ndarray, least_bytes: int, least_words: int) -> np.ndarray:
    """Spans of at least so many bytes or at least so many words (runs of bytes that are not white space)."""
    keep = spans[:, 1] - spans[:, 0] >= least_bytes
    for i in np.flatnonzero(~keep).tolist():
        word = _WORD_BYTE[text[spans[i, 0]:spans[i, 1]]]
        keep[i] = int(word[0]) + np.count_nonzero(word[1:] & ~word[:-1]) >= least_words
    return spans[keep]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   whole_characters: bool = False, gram: int = GRAM, least_bytes: int = 0, least_words: int = 0) -> DataFrame:
    """Append ``kept`` (binary: the bytes that stay) and ``removed`` (flat pairs of byte offsets) to ``docs``.

    With ``whole_characters`` a character that is covered in part only stays, so that ``kept`` is valid UTF-8.
    With ``least_words`` a maximal repeated run goes only if it has that many words or ``least_bytes`` bytes: with a
    small ``length`` this finds passages by their words, whatever the length of a word.
    """
    key_id, key_hash = row_key(id_col, text_col)
    keyed = docs.select(key_id, key_hash, F.col(f"`{text_col}`").alias("text"))
    spans = repeated_spans(keyed, length, gram)
    joined = key_join(docs.withColumns({ROW_ID: key_id, ROW_HASH: key_hash}), spans, "left").drop(ROW_ID, ROW_HASH)

    def fn(b: pa.RecordBatch) -> list[pa.Array]:
        data, off = buffer_of(b.column(0))
        kept, removed = [], []
        for i in range(len(off) - 1):
            text = data[off[i]:off[i + 1]]
            hits = b.column(1)[i]
            if hits.is_valid:
                cut = row_spans(hits.as_py())
                if least_words:
                    cut = _long_enough(text, cut, least_bytes, least_words)
                if whole_characters:
                    cut = _whole_characters(text, cut)
                stay = np.ones(len(text), bool)
                for s, e in cut.tolist():
                    stay[s:e] = False
                kept.append(text[stay].tobytes())
                removed.append(cut.ravel().tolist())
            else:
                kept.append(text.tobytes())
                removed.append([])
        return [pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.int64()))]

    return add_columns(joined, [text_input(joined, text_col), "hits"], fn,
                       "kept binary, removed array<bigint>").drop("hits")


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes of every document that 400-byte strings cover which start anywhere else."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeats(docs)
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return done.select("doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).cast("long").alias("n_removed"),
                       (F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Every window of 400 bytes by its digest; windows that occur again, as spans, cut from the text.
OP4_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT r, doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT r, p, md5(b[p + 1:p + 400]) AS k FROM (SELECT r, b, unnest(generate_series(0, n - 400)) AS p FROM n WHERE n >= 400) AS s),
again AS (SELECT r, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT r, p, CASE WHEN p > 400 + lag(p) OVER (PARTITION BY r ORDER BY p) THEN 1 ELSE 0 END AS fresh FROM again),
spans AS (SELECT r, g, min(p) AS s, max(p) + 400 AS e
          FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS g FROM marked) AS x GROUP BY r, g),
cuts AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before FROM spans),
per AS (SELECT n.r, count(*) AS k, sum(e - s) AS gone, max(e) AS last, string_agg(hex(n.b[before + 1:s]), '' ORDER BY s) AS head
        FROM cuts JOIN n ON n.r = cuts.r GROUP BY n.r)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_bytes, CAST(coalesce(per.gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(per.k, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN per.r IS NULL THEN n.b ELSE unhex(per.head || hex(n.b[per.last + 1:n.n])) END) AS kept_sha256
FROM n LEFT JOIN per ON per.r = n.r
"""
