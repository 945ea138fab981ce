"""Adaptive context-mixing range coder for token ids, in blocks that stand alone.

A block holds up to ``BLOCK`` ids of an alphabet it lists. Its ids lie in lanes of ``STEPS``; all lanes move together, one id a
step, each with a range coder of its own, and share one model that starts empty in every block and learns after each step:

* order 0: counts of all ids seen, each one more than zero from the start;
* order 1: the id that the last one predicts, and how often in a row it has been right;
* order 2: the same for the last two ids, in hashed slots.

The three are mixed into one distribution over ids: a predicted id is raised to the share of right predictions among those of its
order, confidence and rarity in this block so far, if the orders below give it less. All numbers are whole, or come from them by single
products and quotients of doubles, so a reader repeats them exactly. Blocks carry
checksums of header and ids; a damaged block raises an error and its neighbours remain readable.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

BLOCK = 1 << 21
STEPS = 256
LEARN = 4  # what an id seen adds to its count
FULL_STEPS, EVERY = 8, 4  # counts are brought up to date at each of the first steps, then at every few
SURE_BITS = 4
CONFIDENCE, RARITY = 1 << SURE_BITS, 12  # levels: times in a row that a prediction was right; how rare the predicted id is, as a power of 2
# confidence after a wrong and after a right prediction, by confidence before and rarity
NEXT = np.array([[max(1, k // 2), min(k + 1, CONFIDENCE - 1)] for k in range(CONFIDENCE) for _ in range(RARITY)], np.int32).ravel()
GUIDE_BITS = 13  # the points of the counts are cut into about this many stretches, as a power of 2, to look ids up
ODDS = 15  # most that a prediction adds, as a multiple of all below it: the total stays under 2^32
SLOTS_BITS = 17
SLOT_FACTOR = np.uint64(0x9E3779B97F4A7C15)
TOP, BOTTOM, WORD = np.uint64(1 << 48), np.uint64(1 << 32), np.uint64(16)
FLAGS = 1 << 20  # ids below it are told apart by a flag each, not by sorting
HEAD = "<4sIIIIIIII"  # magic, ids, alphabet, lanes, words, extra bytes, crc of ids, crc of the rest, crc of the head
HEAD_BYTES = struct.calcsize(HEAD)
MAGIC = b"CMB2"


class BlockError(ValueError):
    pass


def taken(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values[at]``, all of which exist: "clip" spares numpy a copy."""
    return values.take(at, mode="clip")


class Prediction:
    """What one order says about the next id of each lane."""

    def __init__(self, slots: int) -> None:
        self.held = np.zeros(slots, np.int32)  # id times CONFIDENCE, plus confidence
        self.tries, self.right = np.full(CONFIDENCE * RARITY, 8, np.int64), np.ones(CONFIDENCE * RARITY, np.int64)

    def look(self, at: np.ndarray) -> None:
        self.at = at
        found = taken(self.held, at)
        self.id32 = found >> SURE_BITS
        self.id, self.sure = self.id32.astype(np.int64), found & (CONFIDENCE - 1)

    def weigh(self, total: np.ndarray, share: np.ndarray, rarity: np.ndarray) -> None:
        """``more``: what is added to the ``share`` of the predicted ids in ``total``."""
        # quotients of whole numbers below 2^53 are rounded in one way everywhere
        self.level = self.sure * RARITY + rarity
        wrong = self.tries - self.right
        odds, off = np.minimum(self.right / wrong, float(ODDS)), self.tries / wrong
        odds[:RARITY] = 0.0  # no confidence, nothing added
        more = taken(odds, self.level)
        more *= total
        more -= taken(off, self.level) * share
        added = more.astype(np.int64)
        self.more = np.maximum(added, 0, out=added)

    def learn(self, ids: np.ndarray) -> None:
        hit = self.id == ids
        case = self.level * 2 + hit
        seen = np.bincount(case, minlength=2 * CONFIDENCE * RARITY).reshape(-1, 2)
        self.tries += seen.sum(1)
        self.right += seen[:, 1]
        # a prediction that fails loses half its confidence, and its place once none is left; lanes in the same context write in
        # lane order, the last one stays
        held = np.where(hit | (self.sure > 1), self.id32, ids.astype(np.int32))
        held <<= SURE_BITS
        held += taken(NEXT, case)
        self.held[self.at] = held


class Mixer:
    """The model that the lanes of a block share."""

    def __init__(self, size: int, lanes: int) -> None:
        self.size = size
        self.count = np.ones(size, np.int64)
        self.below = np.zeros(size + 1, np.int64)  # sum of the counts of smaller ids
        self.one, self.two = Prediction(size + 1), Prediction(1 << SLOTS_BITS)
        self.last = np.full((2, lanes), size, np.int64)  # ``size`` stands for no id yet
        self.waiting: list[np.ndarray] = []
        self.step = 0
        self.counted()

    def counted(self) -> None:
        """Bring up to date what follows from the counts."""
        np.cumsum(self.count, out=self.below[1:])
        total = int(self.below[-1])
        self.rarity = np.minimum(((total / self.count).view(np.int64) >> 52) - 1022, RARITY - 1)  # the exponent
        self.guide = None

    def predict(self, lanes: int) -> None:
        """Predictions for the next id of the first ``lanes`` lanes, and what they add."""
        one, two = self.one, self.two
        last = self.last[0, :lanes].copy()
        hashed = self.last[1, :lanes] * (self.size + 1)
        hashed += last
        hashed = hashed.view(np.uint64)
        hashed *= SLOT_FACTOR
        hashed >>= np.uint64(64 - SLOTS_BITS)
        one.look(last)
        two.look(hashed.view(np.int64))
        self.share1, self.share2 = taken(self.count, one.id), taken(self.count, two.id)
        total = self.below[-1]
        one.weigh(total, self.share1, taken(self.rarity, one.id))
        self.same = one.id == two.id
        total = total + one.more
        two.weigh(total, self.share2 + one.more * self.same, taken(self.rarity, two.id))
        self.total = total + two.more

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each id in the mixed distribution."""
        one, two = self.one, self.two
        start, width = taken(self.below, ids), taken(self.count, ids)
        for order in (one, two):
            start += order.more * (order.id < ids)
            width += order.more * (order.id == ids)
        return start, width

    def smaller(self, point: np.ndarray) -> np.ndarray:
        """The last id that starts at or before each point, among the counts alone."""
        if self.guide is None:
            self.shift = max(0, int(self.below[-1]).bit_length() - GUIDE_BITS)
            # ids that end before each stretch of 2^shift points
            ended = np.bincount((self.below[1:] >> self.shift) + 1, minlength=(1 << GUIDE_BITS) + 2)
            self.guide = np.cumsum(ended)
        ends = self.below[1:]
        found = taken(self.guide, point >> self.shift)
        found += taken(ends, found) <= point
        left = np.flatnonzero(taken(ends, found) <= point)
        if len(left):
            found[left] = np.searchsorted(self.below, point[left], "right") - 1
        return found

    def find(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold these points, with start and width."""
        one, two = self.one, self.two
        start1 = taken(self.below, one.id) + two.more * (two.id < one.id)
        start2 = taken(self.below, two.id) + one.more * (one.id < two.id)
        both = (one.more + two.more) * self.same
        width1 = self.share1 + np.where(self.same, both, one.more)
        width2 = self.share2 + np.where(self.same, both, two.more)
        past1, past2 = point >= start1, point >= start2
        in1, in2 = past1 & (point < start1 + width1), past2 & (point < start2 + width2)
        ids, start, width = (np.where(in1, x, y) for x, y in ((one.id, two.id), (start1, start2), (width1, width2)))
        # what the predictions add lies behind the point if they start before it and do not hold it
        rest = np.flatnonzero(~(in1 | in2))
        added = taken(one.more * past1 + two.more * past2, rest)
        found = self.smaller(taken(point, rest) - added)
        ids[rest] = found
        start[rest] = taken(self.below, found) + added
        width[rest] = taken(self.count, found)
        return ids, start, width

    def learn(self, ids: np.ndarray) -> None:
        lanes = len(ids)
        self.one.learn(ids)
        self.two.learn(ids)
        self.last[1, :lanes] = self.last[0, :lanes]
        self.last[0, :lanes] = ids
        self.waiting.append(ids)
        self.step += 1
        if self.step <= FULL_STEPS or self.step % EVERY == 0:
            self.count += LEARN * np.bincount(np.concatenate(self.waiting), minlength=self.size)
            self.waiting.clear()
            self.counted()


def lanes_of(n: int) -> tuple[int, np.ndarray]:
    """Lanes of a block of ``n`` ids, and how many of them have an id at each step."""
    lanes = -(-n // STEPS)
    tail = n - (lanes - 1) * STEPS
    steps = STEPS if lanes > 1 else tail
    return lanes, np.where(np.arange(steps) < tail, lanes, lanes - 1)


def encode_ids(ranks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each lane and how many, for ids that are ranks in an alphabet of ``size``."""
    n = len(ranks)
    lanes, active = lanes_of(n)
    padded = np.zeros(lanes * STEPS, np.int64)
    padded[:n] = ranks
    steps = np.ascontiguousarray(padded.reshape(lanes, STEPS).T)
    mixer = Mixer(size, lanes)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out = np.zeros((lanes, STEPS + 16), np.uint16)
    used = np.zeros(lanes, np.int64)
    for t, here in enumerate(active.tolist()):
        ids = steps[t, :here]
        mixer.predict(here)
        start, share = mixer.interval(ids)
        lo, w = low[:here], width[:here]
        unit = w // mixer.total.astype(np.uint64)
        lo += unit * start.astype(np.uint64)
        np.multiply(unit, share.astype(np.uint64), out=w)
        for at, words in settled(lo, w):
            put = taken(used, at)
            if int(put.max()) >= out.shape[1]:
                out = np.concatenate([out, np.zeros_like(out)], axis=1)
            out.ravel()[at * out.shape[1] + put] = words
            used[at] = put + 1
        mixer.learn(ids)
    if out.shape[1] < int(used.max()) + 4:
        out = np.concatenate([out, np.zeros((lanes, 4), np.uint16)], axis=1)
    for _ in range(4):
        out[np.arange(lanes), used] = (low >> TOP_SHIFT).astype(np.uint16)
        used += 1
        low <<= WORD
    return out[np.arange(out.shape[1])[None, :] < used[:, None]], used


TOP_SHIFT = np.uint64(48)


def ready(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Lanes whose leading word is settled. Where a range too narrow straddles a border it is cut there first."""
    same = (low ^ (low + width)) < TOP
    narrow = ~same & (width < BOTTOM)
    if narrow.any():
        width[narrow] = (np.uint64(0) - low[narrow]) & (BOTTOM - np.uint64(1))
        same |= narrow
    return np.flatnonzero(same)


def settled(low: np.ndarray, width: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lanes and their leading words, as long as any is settled; both leave the ranges."""
    at = ready(low, width)
    while len(at):
        lo, w = taken(low, at), taken(width, at)
        yield at, (lo >> TOP_SHIFT).astype(np.uint16)
        lo <<= WORD
        w <<= WORD
        # only these lanes can be settled again
        again = ready(lo, w)
        low[at], width[at] = lo, w
        at = taken(at, again)


def decode_ids(words: np.ndarray, used: np.ndarray, n: int, size: int) -> np.ndarray:
    lanes, active = lanes_of(n)
    mixer = Mixer(size, lanes)
    held = np.concatenate([words.astype(np.uint64), np.zeros(4, np.uint64)])
    at_word = np.cumsum(used) - used
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << WORD) | held[at_word]
        at_word += 1
    steps = np.zeros((STEPS, lanes), np.int64)
    for t, here in enumerate(active.tolist()):
        mixer.predict(here)
        lo, w, c = low[:here], width[:here], code[:here]
        unit = w // mixer.total.astype(np.uint64)
        point = np.minimum(((c - lo) // unit).astype(np.int64), mixer.total - 1)
        ids, start, share = mixer.find(point)
        lo += unit * start.astype(np.uint64)
        np.multiply(unit, share.astype(np.uint64), out=w)
        for at, _ in settled(lo, w):
            read = taken(at_word, at)
            c[at] = (taken(c, at) << WORD) | taken(held, read)
            at_word[at] = read + 1
        mixer.learn(ids)
        steps[t, :here] = ids
    return np.ascontiguousarray(steps.T).reshape(-1)[:n]


class Block(NamedTuple):
    ids: np.ndarray  # uint32
    extra: bytes  # what the file format keeps beside the ids


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and the place of each id among them."""
    if not len(ids) or int(ids.max()) >= FLAGS:
        return np.unique(ids, return_inverse=True)
    seen = np.zeros(int(ids.max()) + 1, bool)
    seen[ids] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[ids]


def pack(ids: np.ndarray, extra: bytes = b"") -> bytes:
    """One block of at most ``BLOCK`` ids (none is allowed)."""
    if len(ids) > BLOCK:
        raise BlockError(f"a block holds {BLOCK} ids at most")
    ids = np.ascontiguousarray(ids, np.uint32)
    alphabet, ranks = ranked(ids)
    words, used = encode_ids(ranks, len(alphabet)) if len(ids) else (np.empty(0, np.uint16), np.empty(0, np.int64))
    steps = np.diff(alphabet.astype(np.int64), prepend=0).astype("<u4")
    rest = b"".join([steps.tobytes(), used.astype("<u2").tobytes(), words.astype("<u2").tobytes(), extra])
    head = struct.pack(HEAD, MAGIC, len(ids), len(alphabet), len(used), len(words), len(extra), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(rest), 0)[:-4]
    return head + struct.pack("<I", zlib.crc32(head)) + rest


def unpack(data: memoryview, at: int = 0) -> tuple[Block, int]:
    """The block that starts at ``at``, and where it ends."""
    head = bytes(data[at : at + HEAD_BYTES])
    if len(head) < HEAD_BYTES or head[:4] != MAGIC or zlib.crc32(head[:-4]) != int.from_bytes(head[-4:], "little"):
        raise BlockError(f"no block at byte {at}")
    _, n, size, lanes, words, extra, of_ids, of_rest, _ = struct.unpack(HEAD, head)
    at += HEAD_BYTES
    rest = data[at : at + 4 * size + 2 * (lanes + words) + extra]
    if zlib.crc32(rest) != of_rest:
        raise BlockError(f"the block before byte {at} is damaged")
    alphabet = np.cumsum(np.frombuffer(rest, "<u4", size), dtype=np.int64)
    used = np.frombuffer(rest, "<u2", lanes, 4 * size).astype(np.int64)
    held = np.frombuffer(rest, "<u2", words, 4 * size + 2 * lanes)
    ids = alphabet[decode_ids(held, used, n, size)].astype(np.uint32) if n else np.empty(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != of_ids:
        raise BlockError(f"the ids before byte {at} differ from those written")
    return Block(ids, bytes(rest[len(rest) - extra :])), at + len(rest)
