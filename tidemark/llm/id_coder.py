"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks of BLOCK ids. Every block starts from an empty model, so any block decodes
by itself. Blocks are coded side by side, one array lane each: an array operation serves one step
of all of them. Models use whole numbers only (divisions in floating point are far enough from
rounding), so encoder and decoder agree on every machine.

The model of a block learns from the ids coded so far, and is brought up to date at the positions
CUTS, which lie closer together at the start, where there is most to learn:

* orders 2 and 1: for each hashed context the id that last followed, how often it did (match) and
  how often the context occurred (total);
* order 0: the share of every id seen, and an escape share, in which unseen ids are equal.

Mixing: the candidate is that of the highest order that has one. Its mass weighs the evidence of
both contexts against a constant weight of order 0, WEIGHTS; what is left is dealt out by order 0.
So every id takes one arithmetic coding step.
"""

from __future__ import annotations

import numpy as np

BLOCK = 2048  # ids in a block
SLOTS = 1024  # hashed contexts of each order
CUTS = (0, 64, 256, 768)
WEIGHTS = (3, 2, 5)  # evidence of order 0 (constant), 1 and 2 (per occurrence)
WIDTH = 65536  # ids are below
CHUNK = 64  # lanes modelled together, for the sake of the caches

BITS = 28  # of a coding step's total
TOTAL = 1 << BITS
KEY = (1 << 17) - 1  # low bits of an entry: id + 1; the mass stands above

U = np.uint64
FULL, LOW, KEEP, UPPER, SIXTEEN = U((1 << 48) - 1), U(1 << 32), U((1 << 32) - 1), U(32), U(16)


def _contexts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the contexts of order 1 and 2 in which the ids of each row stand."""
    one = np.zeros(rows.shape, np.int32)
    np.multiply(rows[:, :-1], 20507, out=one[:, 1:])
    two = one.copy()
    two[:, 2:] += rows[:, :-2] * 11003
    return one >> 4 & (SLOTS - 1), two >> 4 & (SLOTS - 1)


def _tables(rows: np.ndarray, slots: tuple[np.ndarray, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries lane x slot of order 1, and of order 2 mixed with the order 1 it implies.

    ``rows``: the ids; those before position ``size`` count.
    """
    lanes = rows.shape[0]
    none = lanes * SLOTS  # the place of no context
    if not size:
        empty = np.zeros(none, np.int64)
        return empty, empty
    offset = (np.arange(lanes) * SLOTS)[:, None]
    key = (rows[:, :size] + 1).ravel()
    found = []
    for own in slots:
        at = (offset + own[:, :size]).ravel()
        last = np.zeros(none + 1, np.int32)
        last[at] = key  # of equal places the last one stays
        total = np.bincount(at, minlength=none + 1)
        match = np.bincount(at, last.take(at) == key, none + 1)
        found.append((at, last, match, total))
    (at1, last1, match1, total1), (at2, last2, match2, total2) = found
    below = np.full(none + 1, none)
    below[at2] = at1  # the order 1 context of each order 2 context

    def entries(last: np.ndarray, match: np.ndarray, total: np.ndarray) -> np.ndarray:
        mass = match * float(TOTAL * 63 // 64)
        mass /= total + WEIGHTS[0]
        table = mass.astype(np.int64)
        table <<= 17
        table |= last
        return table[:none]

    match1 *= WEIGHTS[1]
    total1 *= WEIGHTS[1]
    match2 *= WEIGHTS[2]
    match2 += match1.take(below) * (last1.take(below) == last2)
    total2 *= WEIGHTS[2]
    total2 += total1.take(below)
    return entries(last1, match1, total1), entries(last2, match2, total2)


class _Order0:
    """Shares out of 65536 of the ids in each row of ``rows``, side by side in id order.

    Every row has n + 1 places: its n ids, sorted, and one for unseen ids. ``entries`` holds for each
    place the id (16 bits), where its share begins (17) and the share (17).
    """

    def __init__(self, rows: np.ndarray):
        self.lanes, self.n = rows.shape
        n = self.n
        self.each = (65536 - 65536 // (2 + n.bit_length() // 2)) // n if n else 1
        self.top = n * self.each  # where the share of unseen ids begins
        places = np.empty((self.lanes, n + 1), np.uint16)
        places[:, :n] = rows
        places[:, :n].sort(axis=1, kind="stable")
        new = np.ones((self.lanes, n + 1), bool)
        new[:, 1:n] = places[:, 1:n] != places[:, : max(0, n - 1)]
        starts = np.flatnonzero(new)
        runs = np.cumsum(new.ravel(), dtype=np.int32) - 1
        column = (starts % (n + 1)).astype(np.int32)
        size = np.diff(starts, append=new.size).astype(np.int32) * self.each
        last = column == n
        size[last] = 65536 - self.top
        self.ids = places.ravel()
        shares = size.astype(np.int64) << 33 | (column * self.each).astype(np.int64) << 16
        self.entries = shares[runs] | self.ids
        self.runs = starts[~last], column[~last]

    def places(self, rows: np.ndarray, scratch: np.ndarray) -> np.ndarray:
        """The places of ids, row by row; ``scratch``: zeros, lanes x WIDTH, left as they were."""
        flat = scratch.ravel()
        starts, column = self.runs
        spots = starts // (self.n + 1) * WIDTH + self.ids.take(starts)
        flat[spots] = column - self.n
        lane = np.arange(self.lanes)[:, None]
        found = flat.take(lane * WIDTH + rows)
        flat[spots] = 0
        return found + (lane * (self.n + 1) + self.n)


def _spans(steps: int) -> list[tuple[int, int]]:
    cuts = [c for c in CUTS if c < steps]
    return list(zip(cuts, [*cuts[1:], steps]))


def _intervals(rows: np.ndarray, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size, out of TOTAL, of the interval of each id."""
    lanes, steps = rows.shape
    start, size = np.empty((lanes, steps), np.int64), np.empty((lanes, steps), np.int64)
    slots = _contexts(rows)
    offset = (np.arange(lanes, dtype=np.int32) * SLOTS)[:, None]
    for a, b in _spans(steps):
        ids = rows[:, a:b]
        one, two = (table.take(offset + s[:, a:b]) for table, s in zip(_tables(rows, slots, a), slots))
        entry = np.where(two > 0, two, one)
        mass = entry >> 17
        order0 = _Order0(rows[:, :a])
        at = order0.places(ids, scratch[:lanes])
        place = order0.entries.take(at)
        low, share = place >> 16 & 0x1FFFF, place >> 33
        rest = TOTAL - mass
        begin = rest * low >> 16
        width = (rest * (low + share) >> 16) - begin
        begin += mass
        unseen = np.flatnonzero(low == order0.top)
        fresh, wide = ids.ravel()[unseen].astype(np.int64), width.ravel()[unseen]
        inner = wide * fresh >> 16
        begin.ravel()[unseen] += inner
        width.ravel()[unseen] = (wide * (fresh + 1) >> 16) - inner
        hit = np.flatnonzero(((entry & KEY) == ids + 1) & (mass > 0))
        begin.ravel()[hit] = 0
        width.ravel()[hit] = mass.ravel()[hit]
        start[:, a:b], size[:, a:b] = begin, width
    return start, size


def encode(rows: np.ndarray) -> list[bytes]:
    """The code of each row of ids; the rows are equally long."""
    lanes, steps = rows.shape
    start, size = np.empty((steps, lanes), np.uint32), np.empty((steps, lanes), np.uint32)
    scratch = np.zeros((min(lanes, CHUNK), WIDTH), np.int16)
    for i in range(0, lanes, CHUNK):
        one, two = _intervals(rows[i : i + CHUNK].astype(np.int32), scratch)
        start[:, i : i + CHUNK], size[:, i : i + CHUNK] = one.T, two.T
    low, range_ = np.zeros(lanes, U), np.full(lanes, FULL, U)
    out = np.zeros((lanes, steps * 2 + 8), np.uint32)
    flat, base = out.ravel(), np.arange(lanes) * out.shape[1]
    at = base.copy()
    bits, unit = U(BITS), np.empty(lanes, U)
    for s, z in zip(start, size):
        np.right_shift(range_, bits, out=unit)
        low += unit * s
        np.multiply(unit, z, out=range_)
        # a word may exceed 16 bits by a carry, which goes to the word before at the end
        short = range_ < LOW
        flat[at] = low >> UPPER
        at += short
        shift = short * SIXTEEN
        low &= KEEP | (short - U(1))
        low <<= shift
        range_ <<= shift
        more = np.flatnonzero(range_ < LOW)
        while more.size:
            own = low[more]
            flat[at[more]] = own >> UPPER
            at[more] += 1
            low[more] = (own & KEEP) << SIXTEEN
            range_[more] <<= SIXTEEN
            more = more[range_[more] < LOW]
    for _ in range(3):
        flat[at] = low >> UPPER
        at += 1
        low = (low & KEEP) << SIXTEEN
    counts = at - base
    out *= np.arange(out.shape[1]) < counts[:, None]
    while (carry := out >> 16).any():
        out &= 0xFFFF
        out[:, :-1] += carry[:, 1:]
    words = out.astype("<u2")
    return [words[i, :n].tobytes() for i, n in enumerate(counts)]


def decode(codes: list[bytes], steps: int) -> np.ndarray:
    """The rows that encode() was given. Damaged codes give wrong rows; checksums are the caller's."""
    lanes = len(codes)
    width = max(len(code) for code in codes) // 2 + 4
    words = np.zeros((lanes, width), U)
    for i, code in enumerate(codes):
        words[i, : len(code) // 2] = np.frombuffer(code, "<u2")
    flat, at = words.ravel(), np.arange(lanes) * width
    value = np.zeros(lanes, U)
    for _ in range(3):
        value = value << SIXTEEN | flat.take(at)
        at += 1
    bits, range_ = U(BITS), np.full(lanes, FULL, U)
    rows = np.zeros((lanes, steps), np.int32)
    offset = np.arange(lanes) * SLOTS
    one = before = last = np.zeros(lanes, np.int64)  # the last id's hash, that of the one before, the last id
    for a, b in _spans(steps):
        parts = []
        for i in range(0, lanes, CHUNK):
            history = np.ascontiguousarray(rows[i : i + CHUNK, :a])
            order0 = _Order0(history)
            parts.append((*_tables(history, _contexts(history), a), order0.entries))
        table1, table2, entries0 = (np.concatenate(columns) for columns in zip(*parts))
        base, each, top = np.arange(lanes) * (a + 1), order0.each, order0.top
        done = np.empty((b - a, lanes), np.int32)
        for t in range(b - a):
            entry = table2.take(offset + ((one + before) >> 4 & (SLOTS - 1)), mode="clip")
            bare = np.flatnonzero(entry == 0)
            entry[bare] = table1.take(offset[bare] + (one[bare] >> 4 & (SLOTS - 1)), mode="clip")
            mass = entry >> 17
            unit = range_ >> bits
            slot = np.minimum((value / unit).astype(np.int64), TOTAL - 1)
            rest = TOTAL - mass
            beyond = slot - mass
            hit = beyond < 0
            share = ((beyond << 16) + 65535) / rest
            place = base + np.minimum(np.maximum(share, 0).astype(np.int64) // each, a)
            place = entries0.take(place, mode="clip")
            low, own = place >> 16 & 0x1FFFF, place >> 33
            begin = rest * low >> 16
            wide = (rest * (low + own) >> 16) - begin
            begin += mass
            ids = np.where(hit, (entry & KEY) - 1, place & 0xFFFF)
            odd = np.flatnonzero((low == top) > hit)
            if odd.size:
                w, first = wide[odd], begin[odd]
                fresh = (((slot[odd] - first << 16) + 65535) / w).astype(np.int64)
                ids[odd] = fresh
                inner = w * fresh >> 16
                begin[odd] = first + inner
                wide[odd] = (w * (fresh + 1) >> 16) - inner
            begin *= ~hit
            wide = np.where(hit, mass, wide)
            value -= unit * begin.view(U)
            range_ = unit * wide.view(U)
            short = range_ < LOW
            shift = short * SIXTEEN
            value <<= shift
            value += flat.take(at, mode="clip") * short
            at += short
            range_ <<= shift
            more = np.flatnonzero(range_ < LOW)
            while more.size:
                value[more] = (value[more] << SIXTEEN) + flat.take(at[more], mode="clip")
                at[more] += 1
                range_[more] <<= SIXTEEN
                more = more[range_[more] < LOW]
            done[t] = ids
            before, last, one = last * 11003, ids, ids * 20507
        rows[:, a:b] = done.T
    return rows
