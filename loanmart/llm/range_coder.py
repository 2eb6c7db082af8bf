"""Adaptive context-mixing range coder for token ids, in blocks that are coded side by side.

A table of the ids that followed the last two ids (order 2) and one of those that followed the last id (order 1) each
predict one id, with a confidence.  The first step tells whether the order-2 id, else the order-1 id, else neither is
right; its probabilities mix two adaptive estimates, one by the confidences and one by the latest outcomes, with a weight
that follows the better of them.  If neither is right, the order-0 model codes the id itself by its share: a table
of the ids' frequencies (``frequencies``), which the caller keeps beside the blocks, or else a fixed one.

Every block starts from the same fresh model and coder, so blocks are decoded independently; NumPy takes one id
of each block at a time.  The coder is a range coder on 64-bit integers with 32-bit output words (a carry runs back into
the words that are out); an id gives one word at most.  All probabilities are integers, so encoder and decoder agree on
any machine.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK_IDS = 1024
LANES = 16384                   # blocks coded side by side
MAX_ID = 65534
_S1, _S2 = 9, 10                # bits of the order-1 and order-2 tables
_U = np.uint64
_32, _LOW = _U(32), _U(0xFFFFFFFF)
_MIX = _U(16)                   # bits of the first step's probabilities
_SHARE = 18                     # bits of the order-0 shares
_NO = MAX_ID + 1                # no id
_NONE = _NO << 2                # empty table entry: no id, no confidence


def _mask(x: np.ndarray) -> np.ndarray:
    """All bits set where true."""
    return np.negative(x.view(np.int8)).astype(np.int32)


def _wide(mask: np.ndarray) -> np.ndarray:
    return mask.astype(np.int64).view(np.uint64)


def _pick(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a where the mask is set, else b: ``np.where`` without branches, which outcomes by chance mislead."""
    return (a ^ b) & mask ^ b


class _Model:
    """Predictions and probabilities of all lanes.  A table entry is an id and a confidence of 0 to 3.
    Entries of one place lie side by side for all lanes, as many lanes ask the same at a time.  Both orders, and both kinds
    of estimates, are looked up in one call: the first half of such an array is order 2 (by confidences), the second order 1
    (by the latest outcomes)."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.next = np.full(lanes * ((1 << _S2) + (1 << _S1)), _NONE, np.int32)
        # of 65536: order 2 is right (upper half), order 1 is right; 32 places by confidences, 64 by the latest outcomes
        self.odds = np.full(lanes * 96, 20000 << 16 | 8000, np.uint32)
        self.past = np.full(lanes, 0b101010, np.int32)      # three outcomes of two bits
        self.weight = np.full(lanes, 8, np.int32)
        self.last, self.before = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.shrink(lanes)

    def shrink(self, live: int) -> None:
        """Only the first lanes go on."""
        for name in ("past", "weight", "last", "before"):
            setattr(self, name, getattr(self, name)[:live])
        self.live = live
        lane = np.arange(live, dtype=np.int32)
        self.lane = np.concatenate([lane, lane])
        self.rate = np.repeat(np.array([4, 5], np.int32), live)
        self.place = np.empty(2 * live, np.int32)

    def _at(self) -> np.ndarray:
        return (self.place * self.lanes + self.lane).astype(np.int64)

    def look(self) -> None:
        """What the tables predict."""
        n = self.live
        np.bitwise_and(self.before * 40503 + self.last * 30011 >> 3, (1 << _S2) - 1, out=self.place[:n])     # bits 3 to 12 only
        np.bitwise_or(self.last & ((1 << _S1) - 1), 1 << _S2, out=self.place[n:])
        self.i = self._at()
        self.e = self.next.take(self.i, mode="clip")
        p = self.e >> 2
        self.k = self.e & 3
        self.p2, self.p1 = p[:n], p[n:]

    def weigh(self) -> None:
        """How likely the predictions are: ``f2``, and ``f12`` of both."""
        n = self.live
        same = _mask(self.p1 == self.p2)
        np.bitwise_or(self.k[:n] << 2 | self.k[n:], same & 16, out=self.place[:n])
        np.add(self.past, 32, out=self.place[n:])
        self.o = self._at()
        odds = self.odds.take(self.o, mode="clip")
        self.v2, self.v1 = (odds >> 16).view(np.int32), (odds & 0xFFFF).view(np.int32)
        self.d2, self.d1 = self.v2[:n] - self.v2[n:], self.v1[:n] - self.v1[n:]
        f2 = np.maximum(self.v2[n:] + (self.d2 * self.weight >> 4), 32)
        f1 = np.maximum(self.v1[n:] + (self.d1 * self.weight >> 4), 32) & ~same
        self.f2, self.f12 = f2.astype(np.uint64), (f2 + f1).astype(np.uint64)

    def learn(self, two: np.ndarray, right1: np.ndarray, ids: np.ndarray) -> None:
        """The ids that followed (masks: whether each order was right)."""
        right, fresh = np.concatenate([two, right1]), np.concatenate([ids, ids]) << 2
        k = self.k                                          # a wrong entry loses confidence, or else its place
        self.next[self.i] = _pick(right, self.e - (k - 3 >> 2), _pick(-k >> 2, self.e - 1, fresh))
        self.before, self.last = self.last, ids

    def update(self, two: np.ndarray, one: np.ndarray) -> None:
        """Masks: whether order 2 was right, whether order 1 was; else neither."""
        better = _pick(two, self.d2, _pick(one, self.d1, -self.d2 - self.d1))
        self.weight = np.minimum(np.maximum(self.weight + np.sign(better), 1), 15)
        right2, right1 = np.concatenate([two, two]), np.concatenate([one, one])
        v2 = self.v2 + ((right2 & 65000) - self.v2 >> self.rate)
        v1 = self.v1 + ((right1 & 65000) - self.v1 >> self.rate)
        self.odds[self.o] = (v2 << 16 | v1).view(np.uint32)
        self.past = (self.past << 2 | 2 + 2 * two + one) & 63


def frequencies(count: np.ndarray) -> np.ndarray:
    """Shares in 2**18 of the ids 0 to ``MAX_ID``, by their counts: one at least for each id that occurs."""
    there = count > 0
    if not there.any():
        return np.zeros(_NO, np.int64)
    free = (1 << _SHARE) - int(np.count_nonzero(there))
    share = np.where(there, 1 + count * free // int(count.sum()), 0)
    share[int(np.argmax(count))] += (1 << _SHARE) - int(share.sum())
    return share


#: Shares if no table is given: the smaller an id, the more frequent.
_GIVEN = frequencies((1 << 30) // (np.arange(_NO, dtype=np.int64) + 32))


def _shares(share: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Start (upper half) and share of each id, the whole for no id; and the id of each place."""
    share = _GIVEN if share is None else share
    table = np.empty(_NO + 1, np.uint64)
    table[:_NO] = (np.cumsum(share) - share).astype(np.uint64) << _32 | share.astype(np.uint64)
    table[_NO] = 1 << _SHARE
    return table, np.repeat(np.arange(_NO, dtype=np.uint16), share)


def _still(size: np.ndarray) -> list[int]:
    """Number of blocks that have an id at each step (``size`` falls)."""
    return np.searchsorted(-size, -np.arange(int(size[0])), "left").tolist()


def encode_blocks(blocks: list[np.ndarray], share: np.ndarray | None = None) -> list[bytes]:
    """Range-coded payload of each block of ids."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    out: list[bytes] = [b""] * len(blocks)
    for g in range(0, len(order), LANES):
        some = order[g:g + LANES]
        for i, payload in zip(some, _encode_lanes([blocks[i] for i in some], _shares(share)[0])):
            out[i] = payload
    return out


def _encode_lanes(blocks: list[np.ndarray], table: np.ndarray) -> list[bytes]:
    """``blocks`` from the longest to the shortest."""
    size = np.array([len(b) for b in blocks])
    lanes, steps = len(blocks), int(size[0])
    lines = np.zeros((lanes, steps), np.uint16)
    for line, b in zip(lines, blocks):
        line[:len(b)] = b
    ids = np.ascontiguousarray(lines.T)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    room = steps + 2                                        # a word an id at most, and the rest of the state
    words = np.zeros(lanes * room, np.uint32)
    first = np.arange(lanes) * room
    at = first.copy()
    model = _Model(lanes)
    live = lanes
    for t, now in enumerate(_still(size)):
        if now < live:
            live = now
            model.shrink(live)
        x = ids[t, :live].astype(np.int32)
        model.look()
        two, right1 = _mask(x == model.p2), _mask(x == model.p1)
        model.learn(two, right1, x)                         # while the entries are near
        model.weigh()
        known, one = two | right1, right1 & ~two
        m2, m1 = _wide(two), _wide(one)
        m0 = ~(m2 | m1)
        start = model.f2 & m1 | model.f12 & m0
        stop = model.f2 & m2 | model.f12 & m1 | m0 & _U(1 << 16)
        r = span[:live] >> _MIX
        add = start * r
        r = (stop - start) * r >> _SHARE
        g = table.take(x | known & _NO, mode="clip")
        add += (g >> _32) * r
        sp = (g & _LOW) * r
        lo = low[:live] + add
        over = np.flatnonzero(lo < add)
        if len(over):                                       # a carry goes to the words that are out
            back = at[over] - 1
            while len(back):
                words[back] += np.uint32(1)
                back = back[words[back] == 0] - 1
        go = np.flatnonzero(sp <= _LOW)
        some, to = lo[go], at[go]
        words[to] = some >> _32
        at[go] = to + 1
        lo[go] = some << _32
        sp[go] <<= _32
        low[:live], span[:live] = lo, sp
        model.update(two, one)
    words[at], words[at + 1] = low >> _32, low & _LOW       # the rest of the state
    raw = memoryview(words.astype("<u4", copy=False)).cast("B")
    return [bytes(raw[4 * i:4 * j + 8]) for i, j in zip(first.tolist(), at.tolist())]


def decode_blocks(payloads: list[bytes], sizes: list[int], share: np.ndarray | None = None) -> list[np.ndarray]:
    """Ids of each block, from payloads and numbers of ids."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(sizes)
    for g in range(0, len(order), LANES):
        some = order[g:g + LANES]
        for i, ids in zip(some, _decode_lanes([payloads[i] for i in some], np.array([sizes[i] for i in some]), *_shares(share))):
            out[i] = ids
    return out


def _decode_lanes(payloads: list[bytes], size: np.ndarray, table: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    lanes, steps = len(payloads), int(size[0])
    at = np.cumsum([0] + [len(p) // 4 for p in payloads])[:-1]
    words = np.frombuffer(b"".join(p[:len(p) // 4 * 4] for p in payloads) + bytes(8), "<u4").astype(np.uint64)
    code = words.take(at, mode="clip") << _32 | words.take(at + 1, mode="clip")
    at += 2
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    ids = np.zeros((steps, lanes), np.uint16)
    model = _Model(lanes)
    live = lanes
    for t, now in enumerate(_still(size)):
        if now < live:
            live = now
            model.shrink(live)
            code, span, at = code[:live], span[:live], at[:live]
        model.look()
        model.weigh()
        r = span >> _MIX
        end2, end1 = model.f2 * r, model.f12 * r
        two, known = _mask(code < end2), _mask(code < end1)
        one = known & ~two
        m2, m1 = _wide(two), _wide(one)
        m0 = ~(m2 | m1)
        start = end2 & m1 | end1 & m0
        co = code - start
        r = (end2 & m2 | end1 & m1 | r << _MIX & m0) - start >> _SHARE
        # the place co // r by floats, then to the exact one: off by one at most
        place = (co.astype(np.float64) / r.astype(np.float64)).astype(np.int64)
        rest = (co - place.view(np.uint64) * r).view(np.int64)
        place += (rest >= r.view(np.int64)).view(np.int8) - (rest < 0).view(np.int8)
        z = places.take(place, mode="clip").astype(np.int32)
        x = _pick(two, model.p2, _pick(one, model.p1, z))
        model.learn(two, _mask(model.p1 == x), x)
        g = table.take(z | known & _NO, mode="clip")
        code, span = co - (g >> _32) * r, (g & _LOW) * r
        go = np.flatnonzero(span <= _LOW)
        to = at[go]
        code[go] = code[go] << _32 | words.take(to, mode="clip")
        at[go] = to + 1
        span[go] <<= _32
        ids[t, :live] = x
        model.update(two, one)
    lines = np.ascontiguousarray(ids.T)
    return [lines[k, :n] for k, n in enumerate(size.tolist())]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
