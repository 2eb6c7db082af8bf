"""Word-pair language model: a hierarchical Pitman-Yor process, sampled in shards.

A restaurant for each context (the word before) seats the words that follow it; the tables of all contexts are
customers of one parent restaurant over single words, whose base is uniform over the known words and one unknown.
A context with c customers, c_w of them at t_w tables of word w, predicts

    P(w) = (c_w - d t_w + (s + d t) P0(w)) / (s + c)

with P0 the parent's prediction, and text is scored by the mean of P over several seatings.

1. Texts become units of ``UNIT_TOKENS`` tokens.  A unit sends each shard its pairs (word hashes, counts, and the
   documents they stand in).  A shard holds whole restaurants; those of very common contexts are parted by word.
   A pair that is frequent in a unit sends its count only: the places stay with the unit.
2. The start is one table for each pair.  The tables of each word go to the word's home, where they are the
   customers of the parent restaurant; its state, summed over all shards, goes back to all shards that asked.  Which
   words a shard asks for is sent once; later messages are numbers in that order.
3. In a sweep each shard lets a word's customers in a context leave and sit down again one by one, given the tables of
   the context's other words and the parent as the last sweep left them everywhere; then the parent's customers are
   seated anew, in the words' homes.  Seatings after ``BURN`` sweeps are kept.  The words of one context, and those
   of the parent, are seated side by side on the totals of the last sweep.
4. Each shard predicts its pairs by the kept seatings, and sends each unit the sums of its documents.

Randomness is a hash of pair, sweep and step, and all totals are exact sums over all shards, so seatings do not
depend on the machine or on the number of shards.  Words are told apart by 64-bit hashes.

Defined cases: NULL text is the empty text, which is one end token; repeated rows count as often as they
occur and get equal scores; NULL ids count as the text ``""`` when training rows are chosen; an empty table gives
an empty result, and with no training text every word is unknown; other columns are not read, whatever their names.
"""

from __future__ import annotations

import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import buffer_of, doc_groups, map_arrow, partitions_for, store, table, text_bytes

DISCOUNT, STRENGTH = 0.75, 1.0              # of a context
ROOT_DISCOUNT, ROOT_STRENGTH = 0.5, 1.0     # of the parent
SAMPLES, BURN = 3, 2
UNIT_TOKENS = 2_000_000
SHARD_BYTES = 16 << 20                      # of text
HOME_SHARDS = 8                             # shards for each home of words: a home hears of some 2 million words
RETAIN = 64                                 # occurrences in a unit from which on a pair's places stay with it
COMMON = 8192                               # contexts below 1 / COMMON of a text group (or 1 / 8 of a shard's share) are not counted
BASE_UNIT, SCORE_UNIT = 1e-10, 1e-8         # sums of a document's tokens in one shard travel as multiples of these
START, END = 0x5354415254, 0x454E44         # stand for hashes of the text's start and end
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers or floats as one compressed string; bytes of equal weight stand together."""
    parts = [struct.pack("<H", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind = a.dtype.str[1:].encode()
        parts.append(struct.pack("<2sQ", kind, len(a)))
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = struct.unpack_from("<H", raw)[0], 2, []
    for _ in range(n):
        kind, size = struct.unpack_from("<2sQ", raw, at)
        at += 10
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel() if size else np.zeros(0, dtype))
        at += size * dtype.itemsize
    return out


def small(a: np.ndarray) -> np.ndarray:
    """Non-negative integers in the fewest bytes that hold them."""
    most = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def fixed(a: np.ndarray, unit: float) -> np.ndarray:
    """Sums of logarithms (none above zero) as multiples of ``unit``."""
    return small(np.rint(a / -unit).clip(0).astype(np.uint64))


def steps_of(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


# ---------------------------------------------------------------- texts to units

def token_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the tokens of a run of documents, with each document's end."""
    raw, at = memoryview(data), off.tolist()
    split = [bytes(raw[a:b]).lower().split() for a, b in zip(at, at[1:])]     # bytes: ASCII letters and white space only
    size = np.fromiter(map(len, split), np.int64, len(split))
    words = list(chain.from_iterable(split))
    ends = np.cumsum(np.fromiter(map(len, words), np.int32, len(words)), dtype=np.int32)
    cells = pa.Array.from_buffers(pa.binary(), len(words), [
        None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends]).tobytes()), pa.py_buffer(b"".join(words))])
    coded = cells.dictionary_encode()
    del split, words
    names = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)
    out = np.full(len(doc), END, np.uint64)
    inner = np.ones(len(doc), bool)
    inner[np.cumsum(size + 1) - 1] = False
    if len(names):
        out[inner] = names[coded.indices.to_numpy()]
    return out, doc


def contexts(tokens: np.ndarray, doc: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.concatenate([[True], doc[1:] != doc[:-1]])[:len(doc)]] = START
    return before


def _group_contexts(least: int):
    """(context, count) of the contexts of each group of texts that hold 1 / least of it, and its number of tokens (context NULL)."""
    def fn(batches):
        for b in batches:
            data, off = buffer_of(b.column(0))
            for i, j in doc_groups(off, 8 << 20):
                tokens, doc = token_hashes(data, off[i:j + 1])
                h, n = np.unique(contexts(tokens, doc), return_counts=True)
                some = n * least >= len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None, *h[some].view(np.int64).tolist()], pa.int64()), pa.array([len(tokens), *n[some].tolist()], pa.int64())],
                    names=["u", "n"])
    return fn


class Router:
    """Shard of a pair: by its context, and for common contexts by the word's part too."""

    def __init__(self, shards: int, common: dict[int, int]):
        self.shards, self.homes = shards, partitions_for(shards, HOME_SHARDS)
        self.common = np.array(sorted(common), np.uint64)
        self.parts = np.array([common[int(u)] for u in self.common], np.uint64)

    def is_common(self, u: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.common, u), max(len(self.common) - 1, 0))
        return self.common[at] == u if len(self.common) else np.zeros(len(u), bool)

    def shard(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        key = u.copy()
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, u), len(self.common) - 1)
            hot = self.common[at] == u
            key[hot] += (mix(w[hot]) % self.parts[at[hot]] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return (mix(key) % np.uint64(self.shards)).astype(np.int32)

    def home(self, w: np.ndarray) -> np.ndarray:
        """Home of a word: its share of the parent restaurant."""
        return (mix(w ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(self.homes)).astype(np.int64)


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, place of each value among them)."""
    coded = pa.array(values).dictionary_encode()
    names = coded.dictionary.to_numpy()
    order = np.argsort(names)
    rank = np.empty(len(names), np.int32)
    rank[order] = np.arange(len(names))
    return names[order], rank[coded.indices.to_numpy()]


def _unit_rows(router: Router, unit: int, tokens: list[np.ndarray], docs: list[np.ndarray], ids: list[pa.Array], train: np.ndarray):
    """Messages (shard, unit, kind, payload) of one unit: pairs to shards, and what stays with the unit (kind 1)."""
    w, doc = np.concatenate(tokens), np.concatenate(docs)
    u = contexts(w, doc)
    shard = router.shard(u, w)
    names, cw = _codes(w)
    start = int(np.searchsorted(names, np.uint64(START)))
    names = np.insert(names, start, np.uint64(START))
    cw += cw >= start
    cu = np.empty_like(cw)
    cu[1:] = cw[:-1]
    cu[np.concatenate([[True], doc[1:] != doc[:-1]])] = start
    del w, u
    bits = max(1, int(len(names)).bit_length())
    key = (shard.astype(np.int64) << (2 * bits)) | (cu.astype(np.int64) << bits) | cw
    order = np.argsort(key, kind="stable")
    del key
    shard, cu, cw, doc = shard[order], cu[order], cw[order], doc[order]
    del order
    edge = np.searchsorted(shard, np.arange(router.shards + 1))
    stay: list[np.ndarray] = []
    for s in range(router.shards):
        a, z = int(edge[s]), int(edge[s + 1])
        if a == z:
            continue
        su, sw, sd = cu[a:z], cw[a:z], doc[a:z]
        first = np.flatnonzero(np.concatenate([[True], (su[1:] != su[:-1]) | (sw[1:] != sw[:-1])]))
        n = np.diff(np.append(first, z - a))
        learnt = np.add.reduceat(train[sd].astype(np.int64), first)
        used, local = np.unique(np.concatenate([su[first], sw[first]]), return_inverse=True)
        lu, lw = local[:len(first)], local[len(first):]
        many = n > RETAIN
        sent = np.repeat(~many, n)
        yield s, unit, 0, pack(steps_of(names[used]), small(steps_of(lu)), small(lw), small(n), small(learnt), small(sd[sent]))
        if many.any():
            stay += [np.array([s, int(many.sum())]), n[many], sd[~sent]]
    head = np.array([len(train)], np.int64)
    kept = pack(head, np.concatenate(stay).astype(np.int64) if stay else np.zeros(0, np.int64))
    names_ = pa.chunked_array(ids, pa.string()).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("id", pa.string()), ("held", pa.bool_())])) as out:
        out.write_table(pa.table({"id": names_, "held": ~train}))
    yield int(mix(np.array([unit], np.int64).view(np.uint64))[0] % np.uint64(router.shards)), unit, 1, \
        struct.pack("<Q", len(kept)) + kept + sink.getvalue().to_pybytes()


def _units(router: Router, unit_tokens: int):
    def fn(batches):
        tokens, docs, ids, train = [], [], [], []
        held = at = number = 0
        part = 0

        def flush():
            nonlocal tokens, docs, ids, train, held, at, number
            rows = list(_unit_rows(router, (part << 32) + number, tokens, docs, ids, np.concatenate(train)))
            tokens, docs, ids, train, held, at, number = [], [], [], [], 0, 0, number + 1
            for i in range(0, len(rows), 64):
                s, u, k, p = zip(*rows[i:i + 64])
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(u, pa.int64()), pa.array(k, pa.int64()),
                                                  pa.array(p, pa.binary())], names=["shard", "unit", "kind", "payload"])

        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(3)[0].as_py()
            data, off = buffer_of(b.column(0))
            learn = b.column(2).to_numpy(zero_copy_only=False)
            for i, j in doc_groups(off, 4 << 20):
                w, d = token_hashes(data, off[i:j + 1])
                tokens.append(w)
                docs.append(d + np.int32(at))
                ids.append(b.column(1).slice(i, j - i))
                train.append(learn[i:j])
                held, at = held + len(w), at + j - i
                if held >= unit_tokens:
                    yield from flush()
        if held:
            yield from flush()
    return fn


# ---------------------------------------------------------------- seating

def seat(c: np.ndarray, pull: np.ndarray, key: np.ndarray, sweep: int, d: float) -> np.ndarray:
    """Tables after c customers of one word sat down one by one; a new table is opened with probability
    pull / (pull + customers - d tables).  Stretches without a new table are skipped at once: the probability
    only falls while none is opened, so gaps are drawn for its value at their start and thinned."""
    t = np.minimum(c, 1)
    at = np.flatnonzero(c > 1)
    n, left, a, k = np.ones(len(at)), c[at].astype(float), pull[at], key[at]
    tables = np.ones(len(at))
    step = 0
    while len(at):
        # one hash a step gives the gap and the thinning draw
        h = mix(k + np.uint64(((sweep << 40) + step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        p = np.minimum(a / (a + n - d * tables), 1 - 1e-12)
        r1, r2 = (h >> np.uint64(32)).astype(float) / (1 << 32), (h & np.uint64(0xFFFFFFFF)).astype(float) / (1 << 32)
        gap = np.floor(np.log1p(-r1) / np.minimum(np.log1p(-p), -1e-300))
        n = n + np.minimum(gap, left)                       # customers at old tables
        tables = tables + ((n < left) & (r2 * p < a / (a + n - d * tables)))
        n = n + 1
        over = n >= left
        if over.any():
            t[at[over]] = tables[over].astype(t.dtype)
            go = ~over
            at, n, left, a, k, tables = at[go], n[go], left[go], a[go], k[go], tables[go]
        step += 1
    return t


class Shard:
    """Pairs of one shard."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        units = [(u, unpack(p)) for u, p in rows]
        words = [np.cumsum(x[0], dtype=np.uint64) for _, x in units]
        self.names = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        keys, learnt, self.units = [], [], []
        for (unit, x), own in zip(units, words):
            place = np.searchsorted(self.names, own)
            u, w = place[np.cumsum(x[1].astype(np.int64))], place[x[2].astype(np.int64)]
            keys.append((u << 32) | w)
            learnt.append(x[4].astype(np.int64))
            self.units.append((unit, x[3].astype(np.int64), x[5].astype(np.int64)))
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        pairs, self.where = np.unique(key, return_inverse=True)
        self.sizes = [len(k) for k in keys]
        self.u, self.w = pairs >> 32, pairs & 0xFFFFFFFF
        self.c = np.bincount(self.where, np.concatenate(learnt) if learnt else None, len(pairs)).astype(np.int64)


def _compact(t: pa.Table) -> pa.Table:
    """What the sweeps need of a shard: its names, which of them are words and contexts, and the pairs met in training."""
    shard = Shard(_rows(t, 0))
    if not len(shard.names):
        return pa.table({"shard": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
    role = np.zeros(len(shard.names), np.uint8)
    role[shard.w] |= 1
    role[shard.u] |= 2
    known = shard.c > 0
    return pa.table({"shard": pa.array([t.column("shard")[0].as_py()], pa.int64()), "payload": pa.array([pack(
        steps_of(shard.names), role, small(steps_of(shard.u[known])), small(shard.w[known]), small(shard.c[known]))], pa.binary())})


class Seats:
    """The pairs of a shard that have customers; words are asked for in the order of their homes."""

    def __init__(self, names: np.ndarray, role: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray, router: Router):
        self.names, self.u, self.w, self.c = names, u, w, c
        asked = np.flatnonzero(role & 1)
        home = router.home(names[asked])
        self.asked = asked[np.argsort(home, kind="stable")]
        self.home = np.sort(home, kind="stable")
        self.place = np.zeros(len(names), np.int64)
        self.place[self.asked] = np.arange(len(self.asked))
        self.cu = np.bincount(u, c, len(names)).astype(np.int64)        # customers of each context (this part's)
        self.common = np.flatnonzero(((role & 2) > 0) & router.is_common(names))

    @classmethod
    def read(cls, payload: bytes, router: Router) -> Seats:
        names, role, u, w, c = unpack(payload)
        return cls(np.cumsum(names, dtype=np.uint64), role, np.cumsum(u.astype(np.int64)), w.astype(np.int64), c.astype(np.int64), router)

    def per_context(self, tables: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Tables of each context, those of common ones as all their parts have them."""
        out = np.bincount(self.u, tables, len(self.names))
        out[self.common] = hot
        return out


class Told:
    """The parent's state for the words a shard asked for, with the sums over all shards."""

    def __init__(self, rows: list[tuple[int, bytes]], seats: Seats, model: dict):
        answers = [unpack(p) for _, p in sorted(rows)]
        join = lambda i, kind: np.concatenate([x[i] for x in answers]).astype(kind)
        self.customers, self.tables = join(0, np.int64), join(1, np.int64)
        hot = join(2, np.uint64)
        at = np.argsort(hot)
        at = at[np.searchsorted(hot[at], seats.names[seats.common])]
        self.hot_customers, self.hot_tables = join(3, np.int64)[at], join(4, np.int64)[at]
        self.sums = np.sum([x[5] for x in answers], 0)      # known words, customers, tables, training tokens
        self.count = join(6, np.int64) if answers and len(answers[0]) > 6 else None
        self.model = model

    def parent(self, place: np.ndarray, leave: np.ndarray | int = 0) -> np.ndarray:
        """Probability of words in the parent, without ``leave`` customers of each."""
        known, customers, tables = self.sums[:3].astype(float)
        d, s = self.model["root_discount"], self.model["root_strength"]
        own = self.customers[place] - leave
        return (own - d * np.minimum(self.tables[place], own) + (s + d * tables) / (known + 1)) / (s + customers - leave)


def _rows(t: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    rows = [(u, p) for u, k, p in zip(t.column("unit").to_pylist(), t.column("kind").to_pylist(), t.column("payload").to_pylist())
            if k == kind]
    rows.sort()
    return rows


def _told(t: pa.Table) -> tuple[list[tuple[int, bytes]], bytes, bytes]:
    """Answers, what the shard kept for itself, and what the home of the same number kept."""
    rows, own = [], {1: b"", 2: b""}
    for h, k, p in zip(t.column("home").to_pylist(), t.column("kind").to_pylist(), t.column("payload").to_pylist()):
        if k:
            own[k] = p
        else:
            rows.append((h, p))
    return rows, own[1], own[2]


def _by_home(seats: Seats, router: Router):
    """(home, first and last word asked of it, its common contexts) of the homes that a shard asks."""
    to = router.home(seats.names[seats.common])
    edge = np.searchsorted(seats.home, np.arange(router.homes + 1))
    for j in range(router.homes):
        mine = to == j
        yield j, int(edge[j]), int(edge[j + 1]), mine


def _names(t: pa.Table, router: Router) -> pa.Table:
    """What a shard asks of each home in every sweep: its words, how often they occur, and common contexts with its customers."""
    me, seats = t.column("shard")[0].as_py(), Seats.read(t.column("payload")[0].as_py(), router)
    count = np.bincount(seats.w, seats.c, len(seats.names))[seats.asked].astype(np.int64)
    rows = []
    for j, a, z, mine in _by_home(seats, router):
        hot = seats.common[mine]
        rows.append((j, me, 0, pack(steps_of(seats.names[seats.asked[a:z]]), small(count[a:z]), seats.names[hot], seats.cu[hot])))
    return _asks(rows)


def _questions(me: int, seats: Seats, tables: np.ndarray, sums: np.ndarray, kept: list[np.ndarray], router: Router) -> list:
    """Messages of a shard to all homes: tables of its words and of its parts of contexts; and its own state."""
    m = len(seats.names)
    per_word = np.bincount(seats.w, tables, m)[seats.asked].astype(np.int64)
    per_context = np.bincount(seats.u, tables, m)[seats.common].astype(np.int64)
    out = [(me, me, 1, pack(small(tables), *kept))]
    for j, a, z, mine in _by_home(seats, router):
        out.append((j, me, 0, pack(small(per_word[a:z]), per_context[mine], sums)))
    return out


def _asks(rows: list) -> pa.Table:
    home, asker, kind, payload = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"home": pa.array(home, pa.int64()), "asker": pa.array(asker, pa.int64()), "kind": pa.array(kind, pa.int64()),
                     "payload": pa.array(payload, pa.binary())})


def _open(t: pa.Table, router: Router, model: dict) -> pa.Table:
    """The start: one table for each pair."""
    seats = Seats.read(t.column("payload")[0].as_py(), router)
    return _asks(_questions(t.column("shard")[0].as_py(), seats, (seats.c > 0).astype(np.int64), np.zeros(4, np.int64), [], router))


def _sweep(left: pa.Table, right: pa.Table, sweep: int, router: Router, model: dict) -> pa.Table:
    """One sweep over a shard's pairs, given the parent and the contexts as all shards left them."""
    if not right.num_rows:
        return _asks([])
    me = right.column("shard")[0].as_py()
    answers, state, home = _told(right)
    out = [(me, me, 2, home)] if home else []
    if left.num_rows:
        seats = Seats.read(left.column("payload")[0].as_py(), router)
        told = Told(answers, seats, model)
        tables, *kept = unpack(state)
        tables = tables.astype(np.int64)
        if sweep > model["burn"]:
            kept += _keep(tables, told)
        others = seats.per_context(tables, told.hot_tables)[seats.u] - tables
        pull = (model["strength"] + model["discount"] * others) * told.parent(seats.place[seats.w], tables)
        seed = mix(seats.names[seats.u] * np.uint64(3) ^ mix(seats.names[seats.w]))
        tables = seat(seats.c, pull, seed, sweep, model["discount"])
        out += _questions(me, seats, tables, told.sums, kept, router)
    return _asks(out)


def _keep(tables: np.ndarray, told: Told) -> list[np.ndarray]:
    return [small(tables), small(told.customers), small(told.tables), told.hot_tables, told.sums]


def _answer(left: pa.Table, right: pa.Table, sweep: int, model: dict) -> pa.Table:
    """The parent restaurant's share of one home: seated anew, its state to each asker in the order asked.

    ``left``: what is asked of the home in every sweep; ``right``: this sweep's numbers, and states on their way back.
    """
    tells = {"shard": pa.int64(), "home": pa.int64(), "kind": pa.int64(), "payload": pa.binary()}
    if not right.num_rows:
        return pa.table({k: pa.array([], v) for k, v in tells.items()})
    me = right.column("home")[0].as_py()
    now, out, state = {}, [], b""
    for k, kind, p in zip(right.column("asker").to_pylist(), right.column("kind").to_pylist(), right.column("payload").to_pylist()):
        if kind == 0:
            now[k] = unpack(p)
        elif kind == 1:
            out.append((k, me, 1, p))
        else:
            state = p
    asked = sorted(zip(left.column("asker").to_pylist(), map(unpack, left.column("payload").to_pylist())), key=lambda x: x[0])
    if asked:
        names = [np.cumsum(x[0], dtype=np.uint64) for _, x in asked]
        words = np.unique(np.concatenate(names))
        places = [np.searchsorted(words, n) for n in names]
        every = np.concatenate(places)
        total = lambda parts: np.bincount(every, np.concatenate([x.astype(float) for x in parts]), len(words)).astype(np.int64)
        customers = total([now[k][0] for k, _ in asked])
        tables = np.minimum(customers, 1)
        if sweep:
            known, _, around, _ = now[asked[0][0]][2].astype(float)  # of the whole parent, before this sweep
            (before,) = unpack(state)
            pull = (model["root_strength"] + model["root_discount"] * (around - before.astype(float))) / (known + 1)
            tables = seat(customers, pull, mix(words + np.uint64(7)), 1000 + sweep, model["root_discount"])
        last = sweep == model["burn"] + model["samples"]
        count = total([x[1] for _, x in asked]) if last else np.zeros(0, np.int64)
        hot, hot_at = np.unique(np.concatenate([x[2] for _, x in asked]), return_inverse=True)
        hot_sum = [np.bincount(hot_at, np.concatenate([p.astype(float) for p in parts]), len(hot)).astype(np.int64)
                   for parts in ([x[3] for _, x in asked], [now[k][1] for k, _ in asked])]
        sums = np.array([(customers > 0).sum(), customers.sum(), tables.sum(), count.sum()], np.int64)
        for (asker, x), place in zip(asked, places):
            h = np.searchsorted(hot, x[2])
            out.append((asker, me, 0, pack(small(customers[place]), small(tables[place]), x[2], *[v[h] for v in hot_sum], sums,
                                           *([small(count[place])] if last else []))))
        if not last:
            out.append((me, me, 2, pack(small(tables))))
    cols = list(zip(*out)) if out else [()] * 4
    return pa.table({k: pa.array(c, v) for (k, v), c in zip(tells.items(), cols)})


def _score(left: pa.Table, right: pa.Table, router: Router, model: dict) -> pa.Table:
    """Messages (unit, kind, from, payload): sums of each unit's documents, what stayed with a unit (kind 1)."""
    none = pa.table({"unit": pa.array([], pa.int64()), "kind": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()),
                     "payload": pa.array([], pa.binary())})
    if not left.num_rows:
        return none
    me = left.column("shard")[0].as_py()
    out = [(u, 1, me, p) for u, p in _rows(left, 1)]
    shard = Shard(_rows(left, 0))
    if len(shard.names):
        role = np.zeros(len(shard.names), np.uint8)
        role[shard.w] |= 1
        role[shard.u] |= 2
        learnt = np.flatnonzero(shard.c > 0)
        seats = Seats(shard.names, role, shard.u[learnt], shard.w[learnt], shard.c[learnt], router)
        answers, state, _ = _told(right)
        told = Told(answers, seats, model)
        tables, *kept = unpack(state)
        kept += _keep(tables, told)
        n_known, _, _, n_train = told.sums.astype(float)
        cu = seats.cu.astype(float)
        cu[seats.common] = told.hot_customers
        count, place = told.count, seats.place[shard.w]
        chance = np.zeros(len(shard.u))
        for k in range(0, len(kept), 5):
            t, told.customers, told.tables, hot, told.sums = [x.astype(np.int64) for x in kept[k:k + 5]]
            parent = told.parent(place)
            tu = seats.per_context(t, hot)
            own = shard.c.astype(float)
            own[learnt] -= model["discount"] * t
            chance += (own + (model["strength"] + model["discount"] * tu[shard.u]) * parent) / (model["strength"] + cu[shard.u])
        score = np.log10(chance / (len(kept) // 5))
        word = count[place].astype(float)
        base = np.log10(word + 1) - np.log10(n_train + n_known + 1)
        known = word > 0
        at = 0
        for (unit, n, docs), size in zip(shard.units, shard.sizes):
            pair = shard.where[at:at + size]
            at += size
            many = n > RETAIN
            each = np.repeat(pair[~many], n[~many])
            used, local = np.unique(docs, return_inverse=True)
            add = lambda x: np.bincount(local, x[each], len(used))  # noqa: E731, B023
            out.append((unit, 0, me, pack(small(steps_of(used)), small(np.bincount(local, minlength=len(used))),
                                          small(add(known).astype(np.int64)), fixed(add(base), BASE_UNIT), fixed(add(score), SCORE_UNIT),
                                          known[pair[many]].astype(np.uint8), base[pair[many]], score[pair[many]],
                                          np.array([n_train], np.int64))))
    unit, kind, src, payload = zip(*out)
    return pa.table({"unit": pa.array(unit, pa.int64()), "kind": pa.array(kind, pa.int64()), "shard": pa.array(src, pa.int64()),
                     "payload": pa.array(payload, pa.binary())})


def _gather(t: pa.Table) -> pa.Table:
    """Documents of one unit from its shards' sums."""
    rows = sorted(zip(t.column("kind").to_pylist(), t.column("shard").to_pylist(), t.column("payload").to_pylist()))
    (own,) = [p for k, _, p in rows if k == 1]
    size = struct.unpack_from("<Q", own)[0]
    (n_docs,), stay = unpack(own[8:8 + size])
    with pa.ipc.open_stream(own[8 + size:]) as stream:
        ids = stream.read_all()
    total = np.zeros((4, int(n_docs)))                      # tokens, known, base, score
    values, trained = {}, 0
    for k, src, p in rows:
        if k == 0:
            docs, n, known, base, score, *many, n_train = unpack(p)
            at = np.cumsum(docs.astype(np.int64))
            for line, x in zip(total, (n, known, base * -BASE_UNIT, score * -SCORE_UNIT)):
                line[at] += x
            values[src], trained = many, int(n_train[0])
    at = 0
    while at < len(stay):                                   # shard, number of pairs, their sizes, their documents
        src, pairs = int(stay[at]), int(stay[at + 1])
        n = stay[at + 2:at + 2 + pairs]
        docs = stay[at + 2 + pairs:at + 2 + pairs + int(n.sum())]
        at += 2 + pairs + int(n.sum())
        known, base, score = (np.repeat(x, n) for x in values[src])
        for line, x in zip(total, (np.ones(len(docs)), known, base, score)):
            line += np.bincount(docs, x, int(n_docs))
    return pa.table({"id": ids.column("id"), "held_out": ids.column("held"), "n_tokens": total[0].astype(np.int64),
                     "n_known": total[1].astype(np.int64), "train_tokens": np.full(int(n_docs), trained, np.int64),
                     "base_score": total[2], "score": total[3]})


# ---------------------------------------------------------------- operator

def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", discount: float = DISCOUNT,
                strength: float = STRENGTH, root_discount: float = ROOT_DISCOUNT, root_strength: float = ROOT_STRENGTH,
                samples: int = SAMPLES, burn: int = BURN, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """Score all rows of ``docs`` by a model of those where ``train`` holds.

    Returns the id, ``held_out``, ``n_tokens``, ``n_known`` (tokens that occur in training), ``train_tokens``,
    ``base_score`` (add-one single words) and ``score`` (log10 probability under the model).
    """
    spark = docs.sparkSession
    rows = docs.select(text_bytes(F.col(f"`{text_col}`")).alias("b"), F.col(f"`{id_col}`").cast("string").alias("id"),
                       F.coalesce(train, F.lit(False)).alias("train"), F.spark_partition_id().cast("bigint").alias("part"))
    size = rows.agg(F.sum(F.octet_length("b")).alias("b")).first()["b"] or 0
    shards = max(partitions_for(size, SHARD_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # what a group leaves out adds up to an eighth of a shard's share at most
    counts = map_arrow(rows.select("b"), _group_contexts(max(COMMON, 8 * shards)), "u bigint, n bigint")
    seen = store(counts.groupBy("u").agg(F.sum("n").alias("n")), "contexts")
    n = seen.filter("u is null").agg(F.sum("n").alias("n")).first()["n"] or 1
    # at most 2 * shards contexts reach half a shard's share each
    heavy = seen.filter(F.col("u").isNotNull() & (F.col("n") * (2 * shards) > n)).collect()
    router = Router(shards, {r["u"] & 0xFFFFFFFFFFFFFFFF: -(-2 * shards * r["n"] // n) for r in heavy})
    model = {"discount": discount, "strength": strength, "root_discount": root_discount, "root_strength": root_strength,
             "samples": samples, "burn": burn}
    sent = map_arrow(rows, _units(router, unit_tokens), "shard bigint, unit bigint, kind bigint, payload binary")
    sent = sent.repartition(shards, "shard")
    asks, tells = "home bigint, asker bigint, kind bigint, payload binary", "shard bigint, home bigint, kind bigint, payload binary"
    pairs = sent.groupBy("shard").applyInArrow(_compact, "shard bigint, payload binary").repartition(shards, "shard")
    names = pairs.groupBy("shard").applyInArrow(lambda t: _names(t, router), asks).repartition(shards, "home")
    asked = pairs.groupBy("shard").applyInArrow(lambda t: _open(t, router, model), asks)
    tell = lambda k: lambda a, b: _answer(a, b, k, model)
    ask = lambda k: lambda a, b: _sweep(a, b, k, router, model)
    for sweep in range(burn + samples + 1):
        told = names.groupBy("home").cogroup(asked.repartition(shards, "home").groupBy("home")).applyInArrow(tell(sweep), tells)
        if sweep < burn + samples:
            asked = pairs.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(ask(sweep), asks)
    scored = sent.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(
        lambda a, b: _score(a, b, router, model), "unit bigint, kind bigint, shard bigint, payload binary")
    done = scored.groupBy("unit").applyInArrow(
        _gather, "id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return done.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *done.columns[1:])


def op2_pitman_yor(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, trained on those whose crc32(doc_id) modulo 7 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return score_texts(docs, rest != 2)
