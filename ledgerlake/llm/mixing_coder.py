"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block is coded on its own: its models and its coder start afresh. Each id is coded in up to three
steps of an arithmetic coder:

* Order 2 (the two ids before) and order 1 (the id before) each predict the id that followed their
  context last; order 0 predicts every id that the block has had. For each pair of confidences the block learns how
  often each prediction is right and what weight order 2 has against order 1; the two mixed by that weight are what
  they claim of the range (where they agree: how often both are right), and order 0 has the rest.
* An id that neither predicts is coded by order 0: ids are numbered as they first come, adaptive counts give
  the probability of a number's magnitude (0: the id is new), and the number's lower bits are even.
* A new id follows in even bits.

The blocks of a call are lanes of numpy arrays: step t codes the t-th id of every block. Encoder and
decoder share the models, and all arithmetic is on integers, so that every machine decodes what another wrote.
"""

from __future__ import annotations

import numpy as np

#: Most ids of a block; a call's memory is bounded by the blocks it is given.
BLOCK = 1024
#: Bits of the probabilities of the first step and of the magnitudes.
BITS, MAGNITUDE_BITS = 15, 12
#: Contexts of order 2 per block (hashed), and steps between new probabilities (and a few at the start).
CONTEXTS, REFRESH, SOONER = 1024, 256, (16, 64)
#: Confidences 0..3: one up when right; halved when wrong, and replaced at 0.
STATES, MAGNITUDES = 4, BLOCK.bit_length() + 1
#: The range has 62 bits at most and over 46 before each id; an id takes 15 or 5 + 12 + 22 bits of it at most.
RANGE, LEAST = 1 << 62, 1 << 46
WIDEST = 32 - (BLOCK - 1).bit_length()
_MOST = (1 << BITS) - 1024
#: Blocks whose ids are numbered at once.
_ROWS = 128


class _Models:
    """The models of ``lanes`` blocks of at most ``length`` ids. Tables hold the lanes side by side: entry n of lane i is at
    n * lanes + i, so that what many blocks use often shares cache lines. Arrays are small and steps work in place, since tasks share caches.

    after: (number << 3 | confidence) of the id that followed a context; the contexts of order 1 come first, then those of order 2.
    hits: how often neither, order 1 only, order 2 only or both were right, for each pair of confidences, and for each where the two
    agree; outcomes and sizes hold the places in hits and counts of the last steps, which refresh() counts.
    claims: from hits, by refresh(): the end of order 2's claim << 16 | the end of order 1's; one claim if the two agree.
    counts, cum, shares: of the magnitudes: how often, by refresh() the end of each one's share, and its start << 16 | its size.
    """

    def __init__(self, lanes: int, length: int):
        self.lanes, self.cap, self.lane, self.pairs = lanes, length + 2, np.arange(lanes), 2 * STATES * STATES
        self.after = np.zeros(lanes * (self.cap + CONTEXTS), np.int16)
        self.contexts = self.lane + lanes * self.cap
        sure = np.arange(STATES) * 4 + 1
        most = 4 * STATES
        first = [[most - max(a, b), a, b, min(a, b)] for a in sure for b in sure] + [[most - max(a, b), 0, 0, a + b] for a in sure for b in sure]
        self.hits = np.repeat(np.array(first, np.int32).T.ravel(), lanes)
        self.counts = np.repeat(np.r_[4, np.ones(MAGNITUDES - 1, np.int32)], lanes)
        self.outcomes, self.logged, self.sizes = np.empty((REFRESH, lanes), np.int64), 0, []
        self.before, self.at = np.zeros(lanes, np.int64), np.stack([self.lane, self.contexts])
        self.entry, self.sure, self.number = np.zeros((3, 2, lanes), np.int16)
        self.claim, self.end1, self.end2 = np.zeros((3, lanes), np.int32)

    def refresh(self, t: int) -> None:
        """At step ``t``, the mixed claims and the probabilities of the magnitudes by the counts so far; none is zero."""
        if t % REFRESH and t not in SOONER:
            return
        self.hits += np.bincount(self.outcomes[:self.logged].ravel(), minlength=len(self.hits))
        if self.sizes:
            self.counts += np.bincount(np.concatenate(self.sizes), minlength=len(self.counts))
        self.logged, self.sizes = 0, []
        half = self.lanes * STATES * STATES
        neither, only1, only2, both = self.hits.reshape(4, -1)
        total = neither + only1 + only2 + both
        weight = ((only2 + 1) << 16) // (only1 + only2 + 2)
        right1, right2 = (_MOST * (only1 + both)) // total, (_MOST * (only2 + both)) // total
        claim2 = ((weight * right2) >> 16) + 1
        claim1 = (((65536 - weight) * right1) >> 16) + 1
        claim2[half:], claim1[half:] = right2[half:] + 1, 0
        self.claims = (claim2 << 16) + claim2 + claim1
        counts = self.counts.reshape(MAGNITUDES, -1)
        size = counts * ((1 << MAGNITUDE_BITS) - MAGNITUDES) // counts.sum(0) + 1
        self.cum = np.cumsum(size, axis=0, dtype=np.int32)
        self.cum[-1] = 1 << MAGNITUDE_BITS
        start = np.concatenate([np.zeros((1, self.lanes), np.int32), self.cum[:-1]])
        self.shares = ((start << 16) + self.cum - start).ravel()
        self.cum = self.cum[:-1].astype(np.int16)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the claims of order 2 and of order 1 end in the range; the second is empty if the two agree."""
        entry, sure, number, pair = self.entry, self.sure, self.number, self.outcomes[self.logged]
        self.after.take(self.at, out=entry, mode="wrap")
        np.bitwise_and(entry, STATES - 1, out=sure)
        np.right_shift(entry, 3, out=number)
        which = (number[0] == number[1]) * np.int16(STATES)
        which += sure[1]
        which *= np.int16(STATES)
        which += sure[0]
        np.multiply(which, self.lanes, out=pair, dtype=np.int64)
        pair += self.lane
        self.claims.take(pair, out=self.claim, mode="wrap")
        np.right_shift(self.claim, 16, out=self.end2)
        np.bitwise_and(self.claim, 65535, out=self.end1)
        return self.end2, self.end1

    def update(self, number: np.ndarray, at: np.ndarray) -> None:
        """Learns the numbers that came; ``at``: number * lanes + lane."""
        entry, sure, pair = self.entry, self.sure, self.outcomes[self.logged]
        hit = self.number == number
        right = hit.view(np.int8)
        pair += np.multiply(right[1] * np.int8(2) + right[0], self.pairs * self.lanes, dtype=np.int64)
        self.logged += 1
        # One up (not above the most) or halved, or replaced.
        down = (sure + np.int16(1)) >> 1
        moved = sure < STATES - 1
        moved = (moved + down) * hit
        moved -= down
        moved += entry
        lost = sure + hit == 0
        moved += ((number << 3) - moved) * lost
        self.after[self.at] = moved
        context = self.at[1]
        np.multiply(number, 30011, out=context, dtype=np.int64)
        context += self.before
        context &= CONTEXTS - 1
        context *= self.lanes
        context += self.contexts
        np.multiply(number, 40503, out=self.before, dtype=np.int64)
        self.at[0] = at


def _shapes(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Even bits below each magnitude and its first number; magnitude 0 has the bits of a new id."""
    return np.array([width, *range(MAGNITUDES - 1)]), np.array([0, *(1 << n for n in range(MAGNITUDES - 1))])


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the ids of each row as they first come, from 1; whether an id is new), both by step."""
    lanes, length = ids.shape
    shift = (length - 1).bit_length()
    kind = np.uint32 if shift + WIDEST <= 32 else np.uint64
    numbers, new = np.empty((length, lanes), np.int16), np.empty((length, lanes), bool)
    for i in range(0, lanes, _ROWS):
        rows = ids[i:i + _ROWS].astype(kind)
        rows <<= shift
        rows |= np.arange(length, dtype=kind)
        rows.sort(axis=1)
        order = (rows & kind((1 << shift) - 1)).astype(np.int64)
        rows >>= shift
        heads = np.ones(rows.shape, bool)  # of the runs of an id, whose first place is its first occurrence
        np.not_equal(rows[:, 1:], rows[:, :-1], out=heads[:, 1:])
        fresh = np.zeros(rows.shape, bool)
        at = order + np.arange(len(rows))[:, None] * length
        first = at[heads]
        fresh.ravel()[first] = True
        number = np.cumsum(fresh, axis=1, dtype=np.int16).ravel()
        out = np.empty(rows.size, np.int16)
        out[at.ravel()] = number[first][np.cumsum(heads.ravel()) - 1]
        numbers[:, i:i + _ROWS], new[:, i:i + _ROWS] = out.reshape(rows.shape).T, fresh.T
    return numbers, new


def encode(ids: np.ndarray, width: int) -> list[bytes]:
    """The payload of each row of ``ids`` (blocks, length), ids below 2 ** ``width``, which is at most WIDEST."""
    lanes, length = ids.shape
    if not lanes or not length:
        return [b""] * lanes
    models, lane = _Models(lanes, length), np.arange(lanes)
    by_step = ids.T.astype(np.uint32, order="C")
    numbers, new = _numbered(ids)
    bits_of, first_of = _shapes(width)
    magnitude = np.array([n.bit_length() for n in range(length + 2)], np.int16)
    low, rng, put = np.zeros(lanes, np.int64), np.full(lanes, RANGE, np.int64), lane.copy()
    digits = np.zeros((3 * length + 8) * lanes, np.uint32)
    at, size, lower, more = np.empty((4, lanes), np.int64)
    for t in range(length):
        models.refresh(t)
        number, fresh = numbers[t], new[t]
        end2, end1 = models.predict()
        is2, is1 = models.number[1] == number, models.number[0] == number
        rest = ~(is1 | is2)
        end = np.where(is2, end2, end1)
        start = np.where(rest, end, end2 * ~is2)
        end = np.where(rest, 1 << BITS, end)
        rng >>= BITS
        low += np.multiply(rng, start, out=more)
        end -= start
        rng *= end
        # By order 0, for the lanes of ``rest``.
        np.multiply(magnitude.take(number), ~fresh, out=size, dtype=np.int64)
        np.subtract(number, first_of.take(size), out=lower)
        some = np.flatnonzero(fresh)
        lower[some] = by_step[t].take(some)
        bits = bits_of.take(size)
        size *= lanes
        size += lane
        share = models.shares.take(size)
        r = rng >> MAGNITUDE_BITS
        np.multiply(r, share >> 16, out=more)
        share &= 65535
        r *= share
        r >>= bits
        lower *= r
        more += lower
        more *= rest
        low += more
        rng = np.where(rest, r, rng)
        models.sizes.append(size[rest])
        np.multiply(number, lanes, out=at, dtype=np.int64)
        at += lane
        models.update(number, at)
        some = np.flatnonzero(rng < LEAST)
        while len(some):
            value, place, r = low.take(some), put.take(some), rng.take(some)
            r <<= 16
            digits[place] = value >> 46
            place += lanes
            put[some] = place
            value &= LEAST - 1
            value <<= 16
            low[some], rng[some] = value, r
            some = some[r < LEAST]
    for _ in range(4):
        digits[put] = low >> 46
        low = (low & (LEAST - 1)) << 16
        put += lanes
    digits = digits[:put.max() + lanes - put.max() % lanes]
    over = np.flatnonzero(digits >> 16)
    while len(over):  # carries go to the digit before, never out of a block
        digits[over] &= 65535
        over -= lanes
        digits[over] += 1
        over = over[digits[over] >> 16 > 0]
    by_lane, put = digits.reshape(-1, lanes).astype("<u2").T.copy(), (put // lanes).tolist()
    return [row[:n].tobytes() for row, n in zip(by_lane, put)]


def decode(payloads: list[bytes], length: int, width: int) -> np.ndarray:
    """The ids (blocks, length) of encode(). Damaged payloads give some ids; a checksum must tell."""
    lanes = len(payloads)
    if not lanes or not length:
        return np.zeros((lanes, length), np.int64)
    models, lane = _Models(lanes, length), np.arange(lanes)
    sizes = [len(p) // 2 for p in payloads]
    digits = np.zeros((lanes, max(max(sizes), 4) + 2), np.uint16)
    for i, p in enumerate(payloads):
        digits[i, :sizes[i]] = np.frombuffer(p, "<u2")
    # 62 bits of the first four digits are in the code; what follows is shifted by the two that are left.
    code, rng = digits[:, :4].astype(np.int64) @ np.array([1 << 46, 1 << 30, 1 << 14, 0]) | digits[:, 3] >> 2, np.full(lanes, RANGE, np.int64)
    digits[:, :-1] = digits[:, :-1] << 14 | digits[:, 1:] >> 2
    get, last = lane * digits.shape[1] + 3, (lane + 1) * digits.shape[1] - 2
    digits = digits.ravel()
    numbers, ids, known = np.empty((length, lanes), np.int16), np.zeros((lanes, models.cap), np.uint32), np.ones(lanes, np.int64)
    ids_at = ids.ravel()
    bits_of, first_of = _shapes(width)
    at, part = np.empty(lanes, np.int64), np.zeros(lanes, np.int16)
    for t in range(length):
        models.refresh(t)
        end2, end1 = models.predict()
        rng >>= BITS
        end2, end1 = end2 * rng, end1 * rng
        after2, free = code >= end2, code >= end1
        number = np.where(after2, models.number[0], models.number[1])
        rest = np.flatnonzero(free)
        left, r = code.take(rest), rng.take(rest)
        start = end1.take(rest)
        left -= start
        r <<= BITS
        r -= start
        rng = np.where(after2, end1, end2)
        end2 *= after2
        rng -= end2
        code -= end2
        if len(rest):
            r >>= MAGNITUDE_BITS
            part[rest] = left.view(np.uint64) // r.view(np.uint64)
            size = np.add.reduce((models.cum <= part).view(np.int8), axis=0, dtype=np.int8).take(rest).astype(np.int64)
            fresh = np.flatnonzero(size == 0)
            where = size * lanes
            where += rest
            share = models.shares.take(where)
            left -= r * (share >> 16)
            r *= share & 65535
            r >>= bits_of.take(size)
            lower = (left.view(np.uint64) // r.view(np.uint64)).view(np.int64)
            left -= lower * r
            code[rest], rng[rest] = left, r
            models.sizes.append(where)
            new = rest.take(fresh)
            number_of = known.take(new)
            ids_at[new * models.cap + number_of] = lower.take(fresh)
            known[new] = number_of + 1
            lower += first_of.take(size)
            lower[fresh] = number_of
            number[rest] = np.minimum(lower, models.cap - 1, out=lower)
        numbers[t] = number
        np.multiply(number, lanes, out=at, dtype=np.int64)
        at += lane
        models.update(number, at)
        some = np.flatnonzero(rng < LEAST)
        while len(some):
            place, r, value = get.take(some), rng.take(some), code.take(some)
            r <<= 16
            value <<= 16
            value |= digits.take(place)
            place += 1
            get[some] = np.minimum(place, last.take(some), out=place)
            code[some], rng[some] = value, r
            some = some[r < LEAST]
    out = np.empty((lanes, length), np.int64)
    for i in range(0, lanes, _ROWS):
        at = numbers[:, i:i + _ROWS].T.astype(np.int64)
        at += lane[i:i + _ROWS, None] * models.cap
        out[i:i + _ROWS] = ids_at.take(at)
    return out
