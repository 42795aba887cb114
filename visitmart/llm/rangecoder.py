"""Adaptive context-mixing range coder for token ids, numpy only.

A block of ids is cut into lanes of consecutive ids. All lanes of a block (and
of many blocks at once) take one step together: the model predicts, each lane
codes its next id with a range coder of its own, and the model learns from all
of them. Integer arithmetic throughout, so any machine decodes the same.

Prediction of an id: order 2 and order 1 each name a candidate (the id last
confirmed after the two, one previous ids) with a confidence. Adaptive hit
rates, by confidence and by whether the two agree, are stretched and mixed with
weights that a gradient step adjusts after each step of the lanes. The mixed
probabilities cut the coder's range into "order 2 is right", "order 1 is right"
and the rest, in which order 0 codes the id by adaptive frequencies.

Blocks start from the same state, so each can be decoded alone, and carry CRC-32
checksums of payload and ids.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

LANES, STEPS = 8192, 256                  # so many lanes that a step is worth its calls; one block fits the cache
GROUP = 1                                 # full blocks coded together
HEAD = struct.Struct("<IIIIII")           # ids, lanes, steps, payload bytes, crc of payload, crc of ids
CONF = 16                                 # confidences of a candidate
STATES = CONF * CONF * 2                  # both confidences, and whether the candidates are the same
TABLE = 1 << 16
TOTAL_MAX = 1 << 22
REST_MIN = 1 << 12                        # order 0 keeps at least this part of 2**16
GAIN = 48

# stretch(p) = 256 ln(p / (1 - p)) for 12-bit p, squash its inverse to 16 bits
STRETCH = np.array([round(256 * math.log((i + 0.5) / (4095.5 - i))) for i in range(4096)], np.int64)
SQUASH = np.array([min(65000, max(64, round(65536 / (1 + math.exp(-(i - 2047) / 256))))) for i in range(4095)], np.int64)
_K2, _K1, _SAME = (x.ravel() for x in np.indices((CONF, CONF, 2)))
_APART = 1 - _SAME
# A lane's kind is its state and the part of the range it takes: order 2, order 1, rest (a fourth is unused).
KINDS = STATES * 4


def _changes(k: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By kind: whether the candidate gives way to the new id, else what is added to its confidence."""
    return (k == 0) & ~hit, np.where(hit, k < CONF - 1, (k >> 1) - k).astype(np.int32)


_FIRST, _SECOND = np.arange(KINDS) & 3 == 0, np.arange(KINDS) & 3 == 1
_NEW2, _CHANGE2 = _changes(np.repeat(_K2, 4), _FIRST)
_NEW1, _CHANGE1 = _changes(np.repeat(_K1, 4), _SECOND | _FIRST & (np.repeat(_SAME, 4) == 1))
GUIDE = 1 << 12                           # spans of a block's order-0 sums whose first places are looked up together
_MUL1, _MUL2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


class Model:
    """Shared state of the lanes of ``blocks`` blocks. Arrays of both orders have order 2 first."""

    def __init__(self, blocks: int, lanes: int, vocab: int):
        self.blocks, self.lanes, self.vocab = blocks, lanes, vocab
        # a candidate and its confidence in one number: id * CONF + confidence
        self.two = np.zeros(blocks * TABLE, np.int32)
        self.one = np.zeros(blocks * (vocab + 1), np.int32)
        self.rate = np.tile(np.arange(CONF * 2) * 65536 // (CONF * 2 + 2), (2, blocks, 1))
        self.of_state = np.arange(2 * blocks).reshape(2, blocks, 1) * CONF * 2 + np.stack([_K2, _K1])[:, None] * 2 + _SAME
        self.weight = np.tile(np.array([50000, 10000, 0], np.int64), (2, blocks, 1))
        # id i of a block is at i + 1; the first place keeps the blocks' sums apart by one
        self.freq = np.ones((blocks, vocab + 1), np.int32)
        self.freq[0, 0] = 0
        self.flat = np.empty(self.freq.size, np.int32)
        n = blocks * lanes
        block = np.repeat(np.arange(blocks), lanes)
        self.base2, self.base0, self.base_kind = block * TABLE, block * (vocab + 1), block * KINDS
        self.prev1, self.prev2 = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.at1 = self.base0
        # where the range of each kind begins and how wide it is; the fourth begins at its end
        self.cuts, self.widths = np.zeros((blocks, STATES, 4), np.int64), np.zeros((blocks, STATES, 4), np.int64)
        self.cuts[:, :, 3] = 65536
        self.cut, self.width = self.cuts.ravel(), self.widths.ravel()           # views
        self.step, self.pending = 0, []
        self._mix()

    def _mix(self):
        """The cuts of the range for every state: rates, stretched and mixed."""
        self.x = STRETCH.take(self.rate >> 4).take(self.of_state)
        z = self.weight[:, :, :1] * self.x
        z += self.weight[:, :, 1:2] * self.x[::-1]
        z += self.weight[:, :, 2:] << 8
        z >>= 16
        z += 2047
        self.p = SQUASH.take(z, mode="clip")
        a2 = np.minimum(self.p[0], 65536 - REST_MIN - 64)
        left = 65536 - a2
        a1 = np.minimum(left * self.p[1] >> 16, left - REST_MIN) * _APART
        self.cuts[:, :, 1] = self.widths[:, :, 0] = a2
        self.widths[:, :, 1] = a1
        self.widths[:, :, 2] = left - a1
        self.cuts[:, :, 2] = a2 + a1

    def renew(self):
        """Sum the order-0 frequencies anew, all blocks in one rising array."""
        if self.step < 8 or self.step & 15 == 0:
            if self.pending:
                places = np.concatenate(self.pending)
                places += 1
                np.add.at(self.freq.ravel(), places, np.int32(GAIN))
                self.pending = []
            rising = self._sum()
            big = rising[:, -1] - rising[:, 0] > TOTAL_MAX
            if big.any():
                self.freq[big, 1:] = (self.freq[big, 1:] + 1) >> 1
                rising = self._sum()
            self.guide = None
            self.offset = np.repeat(rising[:, 0].astype(np.int64), self.lanes)
            self.total = np.repeat((rising[:, -1] - rising[:, 0]).astype(np.float64), self.lanes)

    def _sum(self) -> np.ndarray:
        return np.cumsum(self.freq, dtype=np.int32, out=self.flat).reshape(self.freq.shape)

    def find(self, q: np.ndarray) -> np.ndarray:
        """The last place whose sum is at most q: mostly the one where q's span of the sums begins."""
        if self.guide is None:
            self.shift = max(0, (int(self.flat[-1]) // (self.blocks * GUIDE)).bit_length())
            self.guide = np.searchsorted(self.flat, np.arange(0, int(self.flat[-1]), 1 << self.shift).astype(np.int32), "right") - 1
        at = self.guide.take(q >> self.shift)
        later = np.flatnonzero(self.flat.take(at + 1) <= q)
        at[later] = np.searchsorted(self.flat, q.take(later), "right") - 1
        return at

    def predict(self):
        """Both candidates, and the first kind of each lane's state: its range holds first
        "order 2 is right", then "order 1 is right", then the rest."""
        self.renew()
        at2 = self.prev1 * _MUL1
        at2 += self.prev2 * _MUL2
        at2 >>= 8
        at2 &= TABLE - 1
        self.at2 = self.base2 + at2
        self.e2, self.e1 = self.two.take(self.at2), self.one.take(self.at1)
        self.c2, self.c1 = self.e2 >> 4, self.e1 >> 4
        kind = self.e2 & 15
        kind <<= 4
        kind += self.e1 & 15
        kind <<= 1
        kind += self.c2 == self.c1
        kind <<= 2
        return kind

    def update(self, ids: np.ndarray, at: np.ndarray, rest: np.ndarray, kind: np.ndarray, in_block: np.ndarray):
        """Learn the lanes' ids, whose places are ``at``; rest: the places of those coded by
        order 0; kind: the part of its range each lane took, in_block: with its block's base."""
        new = ids << 4
        self.two[self.at2] = np.where(_NEW2.take(kind), new, self.e2 + _CHANGE2.take(kind))
        self.one[self.at1] = np.where(_NEW1.take(kind), new, self.e1 + _CHANGE1.take(kind))
        self.pending.append(rest)
        self.prev2, self.prev1, self.at1 = self.prev1, ids.view(np.uint32), at
        if self.step < 16 or self.step & 3 == 0:
            self._learn(in_block)
        self.step += 1

    def _learn(self, kind):
        """Rates and weights from how often each state was seen, and order 2 or else 1 was right."""
        n = np.bincount(kind, minlength=self.blocks * KINDS).reshape(self.blocks, STATES, 4)
        hits = np.ascontiguousarray(n[:, :, :2].transpose(2, 0, 1))
        tries = np.empty_like(hits)
        np.add(hits[1], n[:, :, 2], out=tries[1])
        np.add(hits[0], tries[1], out=tries[0])
        seen, right = np.empty_like(self.rate), np.empty_like(self.rate)
        shape = (self.blocks, CONF, CONF, 2)
        for i, axis, y in ((0, 2, hits[0]), (1, 1, hits[1] + hits[0] * _SAME)):
            for out, x in ((seen, tries[0]), (right, y)):
                np.add.reduce(x.reshape(shape), axis, out=out[i].reshape(self.blocks, CONF, 2))
        right *= 65535
        right //= np.maximum(seen, 1)
        right -= self.rate
        right >>= 3
        right *= seen > 0
        self.rate += right
        tries[1] *= _APART                                       # order 1 is asked where order 2 fails
        tries *= self.p
        err = (hits << 16) - tries
        step = np.empty_like(self.weight)
        np.einsum("obs,obs->ob", err, self.x, out=step[:, :, 0])
        np.einsum("obs,obs->ob", err, self.x[::-1], out=step[:, :, 1])
        np.add.reduce(err, 2, out=step[:, :, 2])
        step[:, :, 2] <<= 8
        self.weight += step // (self.lanes << 10)
        self._mix()


def encode_group(ids: np.ndarray, vocab: int) -> list[bytes]:
    """ids: (blocks, lanes, steps) -> the payload of each block."""
    blocks, lanes, steps = ids.shape
    model = Model(blocks, lanes, vocab)
    n = blocks * lanes
    columns = np.ascontiguousarray(ids.reshape(n, steps).T, np.int32)
    low, rng = np.zeros(n, np.int64), np.full(n, 1 << 48, np.int64)
    width = 2 * steps + 4
    out, pos = np.zeros(n * width, np.uint32), np.arange(n) * width

    def carry(lane):
        """Add one to the words already out (a run of 65535 passes it on)."""
        at = pos[lane] - 1
        while len(at):
            out[at] += 1
            at = at[out[at] == 65536]
            out[at] = 0
            at = at - 1

    for x in columns:
        kind = model.predict()
        at = model.base0 + x
        not2 = model.c2 != x
        miss = not2 & (model.c1 != x)
        kind += not2.view(np.int8) + miss.view(np.int8)
        in_block = model.base_kind + kind
        r = rng >> 16
        low += r * model.cut.take(in_block)
        rng = r * model.width.take(in_block)
        rest = np.flatnonzero(miss)
        places = at.take(rest)
        first = model.flat.take(places)
        r = (rng.take(rest) / model.total.take(rest)).astype(np.int64)      # exact: below 2**53
        low[rest] += r * (first - model.offset.take(rest))
        rng[rest] = r * (model.flat.take(places + 1) - first)
        over = np.flatnonzero(low >= 1 << 48)
        if len(over):
            carry(over)
            low[over] &= (1 << 48) - 1
        lane = np.flatnonzero(rng < 1 << 32)
        while len(lane):
            v, q, to = low.take(lane), rng.take(lane) << 16, pos.take(lane)
            out[to] = v >> 32
            pos[lane] = to + 1
            low[lane] = (v & 0xFFFFFFFF) << 16
            rng[lane] = q
            lane = lane[q < 1 << 32]
        model.update(x, at, places, kind, in_block)
    last = (low + ((1 << 32) - 1)) >> 32                      # one word picks a number inside the range
    over = np.flatnonzero(last >> 16)
    if len(over):
        carry(over)
    out[pos] = last & 0xFFFF
    size = (pos + 1 - np.arange(n) * width).reshape(blocks, lanes)
    words = out.astype("<u2").reshape(blocks, lanes, width)
    return [s.astype("<u2").tobytes() + w[np.arange(width) < s[:, None]].tobytes() for s, w in zip(size, words)]


def decode_group(payloads: list[bytes], lanes: int, steps: int, vocab: int) -> np.ndarray:
    """The payloads of blocks of one shape -> ids (blocks, lanes, steps)."""
    blocks = len(payloads)
    n, width = blocks * lanes, 2 * steps + 8
    grid = np.zeros((n, width), np.uint16)                    # zeros follow a lane's last word
    for b, data in enumerate(payloads):
        size = np.frombuffer(data, "<u2", lanes).astype(np.int64)
        flat = np.frombuffer(data, "<u2", offset=2 * lanes)
        if size.sum() != len(flat) or size.max(initial=0) > width - 4:
            raise ValueError("block payload does not have the lengths it states")
        grid[b * lanes:(b + 1) * lanes][np.arange(width) < size[:, None]] = flat
    model = Model(blocks, lanes, vocab)
    words, pos = grid.ravel(), np.arange(n) * width + 3
    end = np.arange(1, n + 1) * width - 1
    rng = np.full(n, 1 << 48, np.int64)
    code = (grid[:, 0].astype(np.int64) << 32) | (grid[:, 1].astype(np.int64) << 16) | grid[:, 2]
    out = np.empty((steps, n), np.int32)
    for t in range(steps):
        kind = model.predict()
        in_block = model.base_kind + kind
        r = rng >> 16
        not2 = code >= r * model.cut[1:].take(in_block)
        miss = code >= r * model.cut[2:].take(in_block)
        part = not2.view(np.int8) + miss.view(np.int8)
        kind += part
        in_block += part
        code -= r * model.cut.take(in_block)
        rng = r * model.width.take(in_block)
        x = np.where(not2, model.c1, model.c2)
        rest = np.flatnonzero(miss)
        total, left, offset = model.total.take(rest), code.take(rest), model.offset.take(rest)
        r = (rng.take(rest) / total).astype(np.int64)         # exact: below 2**53
        places = model.find(np.minimum(left / r, total - 1).astype(np.int32) + offset.astype(np.int32))
        first = model.flat.take(places)
        x[rest] = places - model.base0.take(rest)
        code[rest] = left - r * (first - offset)
        rng[rest] = r * (model.flat.take(places + 1) - first)
        lane = np.flatnonzero(rng < 1 << 32)
        while len(lane):
            q, at = rng.take(lane) << 16, pos.take(lane)
            code[lane] = (code.take(lane) << 16) | words.take(np.minimum(at, end.take(lane)))
            pos[lane] = at + 1
            rng[lane] = q
            lane = lane[q < 1 << 32]
        out[t] = x
        model.update(x, model.base0 + x, places, kind, in_block)
    return out.T.reshape(blocks, lanes, steps).view(np.uint32)


def encode_blocks(ids: np.ndarray, vocab: int) -> list[bytes]:
    """Any number of ids -> whole blocks (header and payload), the last perhaps shorter."""
    if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= vocab):
        raise ValueError("id outside the vocabulary")
    full, out = LANES * STEPS, []
    whole = len(ids) // full
    jobs = [(ids[a * full:min(whole, a + GROUP) * full].reshape(-1, LANES, STEPS), full) for a in range(0, whole, GROUP)]
    rest = ids[whole * full:]
    if len(rest):
        steps = max(-(-len(rest) // LANES), STEPS // 4)        # a lane needs some ids to pay for its own words
        lanes = -(-len(rest) // steps)
        jobs.append((np.concatenate([rest, np.zeros(lanes * steps - len(rest), rest.dtype)]).reshape(1, lanes, steps), len(rest)))
    for grid, n in jobs:
        for block, payload in zip(grid, encode_group(grid, vocab)):
            crc = zlib.crc32(np.ascontiguousarray(block.ravel()[:n], "<u4"))
            out.append(HEAD.pack(n, grid.shape[1], grid.shape[2], len(payload), zlib.crc32(payload), crc) + payload)
    return out


def decode_blocks(blocks: list[tuple], vocab: int) -> list[np.ndarray]:
    """(header fields, payload) pairs -> the ids of each block; checks both checksums."""
    out: list = [None] * len(blocks)
    shapes: dict = {}
    for i, ((_, lanes, steps, size, crc, _), payload) in enumerate(blocks):
        if len(payload) != size or zlib.crc32(payload) != crc:
            raise ValueError(f"block {i}: payload does not match its checksum")
        shapes.setdefault((lanes, steps), []).append(i)
    for (lanes, steps), where in shapes.items():
        for a in range(0, len(where), GROUP):
            part = where[a:a + GROUP]
            for i, grid in zip(part, decode_group([blocks[i][1] for i in part], lanes, steps, vocab)):
                ids = grid.ravel()[:blocks[i][0][0]].astype(np.uint32)
                if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != blocks[i][0][5]:
                    raise ValueError(f"block {i}: ids do not match their checksum")
                out[i] = ids
    return out
