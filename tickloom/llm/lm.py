"""Language model scores from Elias-Fano n-gram tries.

A trigram model learns from the documents outside the held-out fold and scores all of them.  With ``c`` for counts in the
training tokens, the probability of a token ``w`` after ``u v`` is interpolated with Dirichlet weights::

    p(w | u v) = (c(u v w) + M3 p(w | v)) / (c(u v) + M3)
    p(w | v)   = (c(v w) + M2 p(w)) / (c(v) + M2)
    p(w)       = (c(w) + 0.5) / (N + 0.5 (V + 1))

A word ``v`` with over ``LIMIT`` tokens or 1 / ``SHARE`` of all (but no fewer than 1 in 2 ** 20, so that such words stay under
that number) is *heavy*: the level of ``u v`` is split by a hash of ``u`` into parts of about so many tokens.  Its ``p(w | v)`` comes from counts over the whole
data: the blocks' pairs ``v w`` are summed by a hash of both words, and the blocks get the sums back.  A pair ``u v`` that is
heavy itself is split by ``w``; its total is among those sums.

1. Documents are packed into blocks of token numbers with the block's own words; the words' counts meet by hash in
   shards, which give each word a number that is small where the word is frequent, and answer to the blocks.
2. The pairs after heavy words are counted in the same way.  The blocks deal their trigrams, by middle context, to shards,
   each with its ``p(w)``, or ``p(w | v)`` where ``v`` is heavy.  A shard builds a trie: contexts ``v``; under each its
   successors ``w`` and the words ``u`` before it; under each ``u v`` the successors, as ranks among the successors of
   ``v``.  Every level, and the pointers from each node to its children, is a monotone sequence in Elias-Fano code, with
   probabilities and weights as two-byte logarithms.  The levels are written to one file and memory-mapped; beside them a
   query only holds a count for each 64 bits.  A successor is searched in the pointer range of its context.
3. The shard sends back one sum for each document of a block.  Nothing of the model or the corpus passes the driver but
   two totals and the heavy words and pairs with their counts.

The pieces that blocks send to shards grow with the product of both, which is what bounds a single run of this size.

Defined cases: null and empty texts are one token, the end; a null id is in the training part; rows with one id are
scored row by row; without training documents all probabilities are the base's.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import common

BLOCK = 8_000_000
M2, M3 = 50.0, 20.0
SHARD_TOKENS, LEAST_SHARDS = 1_200_000, 48
#: Tokens of a word, or of a pair of words, that one shard holds at the most.
LIMIT, SHARE, MOST_HEAVY = SHARD_TOKENS // 2, 256, 1 << 20
#: Trigrams that a shard scores at once.
AT_ONCE = 200_000
#: A context is its word's number and its part; a pair is a heavy word's place and the other word's number.
PARTS, WORDS = 1 << 20, 1 << 43
END, START = np.uint64(1), np.uint64(2)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Step of the logarithms: for shares of counts, and for the probabilities that come with a trigram.
STEP, BASE_STEP = 0.001, 0.05


def _pack(x: np.ndarray) -> bytes:
    """Integers from zero as planes of bytes, compressed; four bytes each, or eight where one needs them."""
    x = np.ascontiguousarray(x, np.int64)
    wide = 8 if len(x) and int(x.max()) >= 1 << 32 else 4
    x = x if wide == 8 else x.astype(np.uint32)
    return bytes([wide]) + zstandard.compress(x.view(np.uint8).reshape(-1, wide).T.tobytes(), 3)


def _unpack(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(x[1:]), np.uint8).reshape(x[0], -1)
    return np.ascontiguousarray(planes.T).view(np.uint32 if x[0] == 4 else np.int64).reshape(-1).astype(np.int64)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(axis=1).astype(np.uint8)
#: Place of the k-th one in a byte.
_SELECT = np.array([[*np.flatnonzero(row), *[8] * (8 - int(row.sum()))] for row in _BITS], np.uint8)


class EliasFano:
    """A strictly increasing sequence: low bits packed, high bits in unary, with a count of ones for each 64 bits."""

    BYTES, AT_ONCE = 8, 1 << 17

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low = n, low_bits, low
        self.high = high.reshape(-1, self.BYTES)
        ones = np.concatenate([np.empty(0, np.int64), *(_ONES[self.high[k : k + self.AT_ONCE]].sum(axis=1, dtype=np.int64) for k in range(0, len(self.high), self.AT_ONCE))])
        self.ones = np.concatenate(([0], np.cumsum(ones)))
        self.zeros = np.arange(len(self.ones)) * self.BYTES * 8 - self.ones

    @classmethod
    def encode(cls, values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, int(np.floor(np.log2(max(1, top // max(1, n))))))
        high = (values >> bits).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        unary = np.zeros(-(-size // (8 * cls.BYTES)) * 8 * cls.BYTES, np.uint8)
        unary[high + np.arange(n)] = 1
        if bits:
            low = np.empty((n, bits), np.uint8)
            for k in range(bits):
                low[:, k] = values >> k & 1
            low = np.packbits(low.reshape(-1), bitorder="little")
        else:
            low = np.empty(0, np.uint8)
        return n, bits, low, np.packbits(unary, bitorder="little")

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one, or zero, from 0."""
        if len(k) > self.AT_ONCE:
            return np.concatenate([self._select(k[i : i + self.AT_ONCE], one) for i in range(0, len(k), self.AT_ONCE)])
        before = self.ones if one else self.zeros
        block = np.searchsorted(before, k, "right") - 1
        rest = (k - before[block]).astype(np.int16)
        raw = self.high[block] if one else ~self.high[block]
        run = np.cumsum(_ONES[raw], axis=1, dtype=np.int16)
        byte = (run <= rest[:, None]).sum(axis=1)
        each = np.arange(len(k))
        rest -= np.where(byte > 0, run[each, np.maximum(byte - 1, 0)], 0)
        return block * (8 * self.BYTES) + byte * 8 + _SELECT[raw[each, byte], rest]

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        out, byte, shift = np.zeros(len(i), np.int64), at >> 3, at & 7
        for k in range((self.low_bits + 7) // 8 + 1):
            inside = np.minimum(byte + k, len(self.low) - 1)
            part = self.low[inside].astype(np.int64)
            out |= np.where(byte + k < len(self.low), part << (8 * k), 0) if 8 * k < 56 else 0
        return (out >> shift) & ((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, True) - i) << self.low_bits) | self.lows(i)

    def find(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """The place of each value, or -1; searched in [lo, hi) where they are given."""
        bucket, out = x >> self.low_bits, np.full(len(x), -1, np.int64)
        ok = np.flatnonzero((x >= 0) & (bucket < self.zeros[-1]))
        # a bucket's elements stand between the zeros before and after it
        after = self._select(bucket[ok], False)
        last = np.minimum(after - bucket[ok], self.n)
        inner = bucket[ok] > 0
        first = np.zeros(len(ok), np.int64)
        first[inner] = self._select(bucket[ok][inner] - 1, False) - (bucket[ok][inner] - 1)
        if lo is not None:
            first, last = np.maximum(first, lo[ok]), np.minimum(last, hi[ok])
        want = x[ok] & ((1 << self.low_bits) - 1)
        while len(ok):
            alive = first < last
            ok, first, last, want = ok[alive], first[alive], last[alive], want[alive]
            if not len(ok):
                break
            middle = (first + last) // 2
            got = self.lows(middle)
            hit = got == want
            out[ok[hit]] = middle[hit]
            less = got < want
            first, last = np.where(less, middle + 1, first)[~hit], np.where(less, last, middle)[~hit]
            ok, want = ok[~hit], want[~hit]
        return out


def _code_of(p: np.ndarray) -> np.ndarray:
    """Logarithms of base probabilities in two bytes, which hold down to exp(-3276)."""
    return np.round(-np.log(p) / BASE_STEP).astype(np.int64)


def _value_of(code: np.ndarray) -> np.ndarray:
    return np.exp(-BASE_STEP * code.astype(np.float64))


def quantise(p: np.ndarray) -> np.ndarray:
    """Logarithms in two bytes, which hold down to exp(-65.5) = 3.5e-29, under the share of one in any count of 64 bits."""
    return np.minimum(np.round(-np.log(np.maximum(p, 1e-300)) / STEP), 65535).astype(np.uint16)


def dequantise(q: np.ndarray) -> np.ndarray:
    return np.exp(-STEP * q.astype(np.float64))


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal rows begin, and the run of each row."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new), np.cumsum(new) - 1


class Trie:
    """Levels of one shard, in one memory-mapped file: build with ``write``, then query."""

    #: Contexts, their successors, the words before them, successors of both; and the pointers to the last three.
    LEVELS, POINTERS = ("mid", "succ", "pair", "tri"), ("to_succ", "to_pair", "to_tri")

    @staticmethod
    def write(path: str, u, v, w, n, pair_total=None) -> dict:
        """Distinct trigrams with their counts, sorted by (v, u, w) of non-negative numbers.  ``pair_total`` holds the count of
        ``u v`` where it isn't the sum of what is here, and 0 elsewhere."""
        layout, at = {}, 0
        mid, v_at = np.unique(v, return_inverse=True)
        width_w, width_u = int(w.max(initial=0)) + 1, int(u.max(initial=0)) + 1
        total = np.bincount(v_at, n, len(mid))
        succ, s_at = np.unique(v_at * width_w + w, return_inverse=True)
        s_n = np.bincount(s_at, n, len(succ))
        s_mid = succ // width_w
        starts, p_at = _runs(v, u)  # they are sorted
        pair = v_at[starts] * width_u + u[starts]
        p_n = np.bincount(p_at, n, len(pair))
        if pair_total is not None:
            p_n = np.where(pair_total[starts] > 0, pair_total[starts], p_n)
        begin = lambda of, parents: np.searchsorted(of, np.arange(parents + 1))
        to_succ, to_pair, to_tri = begin(s_mid, len(mid)), begin(v_at[starts], len(mid)), begin(p_at, len(pair))
        rank = s_at - to_succ[v_at]  # among the successors of v
        width_r = int(np.diff(to_succ).max(initial=0)) + 1
        arrays = {"mid": mid, "succ": succ, "pair": pair, "tri": p_at * width_r + rank}
        # pointers may stand still; with their numbers added they increase strictly
        arrays |= {k: x + np.arange(len(x)) for k, x in (("to_succ", to_succ), ("to_pair", to_pair), ("to_tri", to_tri))}
        values = {"mid_weight": quantise(M2 / (total + M2)), "succ_share": quantise(s_n / (total + M2)[s_mid]), "pair_weight": quantise(M3 / (p_n + M3)), "tri_share": quantise(n / (p_n + M3)[p_at])}
        with open(path, "wb") as f:
            for name, x in arrays.items():
                count, bits, low, high = EliasFano.encode(x)
                layout[name] = (count, bits, at, len(low), at + len(low), len(high))
                at += f.write(low.tobytes()) + f.write(high.tobytes())
            for name, x in values.items():
                layout[name] = (len(x), 0, at, x.nbytes, at + x.nbytes, 0)
                at += f.write(x.tobytes())
        return layout | {"widths": (width_w, width_u, width_r), "bytes": at}

    def __init__(self, path: str, layout: dict):
        self.map = np.asarray(np.memmap(path, np.uint8, "r"))
        part = lambda x: (self.map[x[2] : x[2] + x[3]], self.map[x[4] : x[4] + x[5]])
        self.ef = {k: EliasFano(layout[k][0], layout[k][1], *part(layout[k])) for k in (*self.LEVELS, *self.POINTERS)}
        # bytes, as a level may begin at an odd place
        self.val = {k: part(x)[0].reshape(-1, 2) for k, x in layout.items() if k.endswith(("_weight", "_share"))}
        self.widths = layout["widths"]

    def _range(self, pointers: str, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the children of each node begin and end; an empty range for no node (-1)."""
        ef, at = self.ef[pointers], np.maximum(parent, 0)
        if ef.n < 2:
            return np.zeros(len(parent), np.int64), np.zeros(len(parent), np.int64)
        lo, hi = ef.get(at) - at, ef.get(at + 1) - at - 1
        return lo, np.where(parent >= 0, hi, lo)

    def _value(self, name: str, at: np.ndarray, default: float) -> np.ndarray:
        own = self.val[name]
        return np.where(at >= 0, dequantise(np.ascontiguousarray(own[np.maximum(at, 0)]).view(np.uint16)[:, 0]), default) if len(own) else np.full(len(at), default)

    def score(self, u, v, w, p1, given=False, pair_total=None) -> np.ndarray:
        """p(w | u v); ``p1`` is p(w), or p(w | v) already where ``given``.  Neighbours with one context look it up once."""
        width_w, width_u, width_r = self.widths
        at, of = _runs(v)
        mid = self.ef["mid"].find(v[at])
        s_lo, s_hi = self._range("to_succ", mid)
        p_lo, p_hi = self._range("to_pair", mid)
        key = np.where((mid[of] >= 0) & (w < width_w), mid[of] * width_w + w, -1)
        succ = self.ef["succ"].find(key, s_lo[of], s_hi[of])
        rank = np.where(succ >= 0, succ - s_lo[of], -1)
        p2 = np.where(given, p1, self._value("succ_share", succ, 0.0) + self._value("mid_weight", mid, 1.0)[of] * p1)
        both, of_both = _runs(v, u)
        over, before = of[both], u[both]
        pair = self.ef["pair"].find(np.where((mid[over] >= 0) & (before < width_u), mid[over] * width_u + before, -1), p_lo[over], p_hi[over])
        t_lo, t_hi = self._range("to_tri", pair)
        weight = self._value("pair_weight", pair, 1.0)
        if pair_total is not None:
            weight = np.where(pair_total[both] > 0, M3 / (pair_total[both] + M3), weight)
        tri = self.ef["tri"].find(np.where((pair[of_both] >= 0) & (rank >= 0), pair[of_both] * width_r + rank, -1), t_lo[of_both], t_hi[of_both])
        return np.minimum(self._value("tri_share", tri, 0.0) + weight[of_both] * p2, 1.0)


def _blocks(size: int, kind: pa.DataType):
    def run(batches):
        ids, keys, train, parts, total = common.Ids(), [], [], [], 0

        def flush():
            flat = np.concatenate([np.array(p, np.int64) for p in parts])
            return pa.RecordBatch.from_arrays([pa.array([keys], pa.list_(kind)), pa.array([train], pa.list_(pa.bool_())), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())), pa.array([common.hash_words(list(ids)).tobytes()], pa.binary()), pa.array([_pack(flat)], pa.binary())], ["keys", "train", "sizes", "vocab", "tokens"])

        for batch in batches:
            key, learn = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for start, texts in common.chunks(batch):
                for i, t in enumerate(texts, start):
                    n = len(t or b"")
                    if total and total + n > size:
                        yield flush()
                        ids, keys, train, parts, total = common.Ids(), [], [], [], 0
                    found = (t or b"").translate(_LOWER).split()
                    parts.append(np.fromiter(map(ids.__getitem__, found), np.uint32, len(found)))
                    keys.append(key[i])
                    train.append(learn[i])
                    total += n + 64
        if keys:
            yield flush()

    return run


def _with_ends(tokens: np.ndarray, sizes: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with an end after each document, and the document of each."""
    out = np.empty(len(tokens) + len(sizes), tokens.dtype)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out[np.arange(len(tokens)) + doc] = tokens
    out[np.cumsum(sizes + 1) - 1] = end
    return out, np.repeat(np.arange(len(sizes)), sizes + 1)


def _vocab(vocab: bytes) -> np.ndarray:
    h = np.frombuffer(vocab, np.uint64)
    return np.concatenate((np.where(h <= START, h + np.uint64(16), h), [END]))


def _emit_words(shards: int):
    def run(batches):
        for batch in batches:
            for block, train, sizes, vocab, tokens in zip(*(batch.column(i).to_pylist() for i in range(5))):
                h, sizes = _vocab(vocab), np.array(sizes, np.int64)
                t, doc = _with_ends(_unpack(tokens), sizes, len(h) - 1)
                n = np.bincount(t, np.array(train, float)[doc], len(h)).astype(np.int64)
                shard = (h % np.uint64(shards)).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)
                yield pa.RecordBatch.from_arrays([pa.array([int(shard[p[0]]) for p in parts], pa.int32()), pa.array([block] * len(parts), pa.int64()), pa.array([h[p].tobytes() for p in parts], pa.binary()), pa.array([_pack(n[p]) for p in parts], pa.binary())], ["shard", "block", "words", "counts"])

    return run


def _count_words(shards: int, limit: int):
    """Numbers and counts of a shard's words for each block; in a row without block, the shard's totals and top words."""

    def run(data: pa.Table) -> pa.Table:
        shard = data["shard"][0].as_py()
        words = [np.frombuffer(x, np.uint64) for x in data["words"].to_pylist()]
        flat = np.concatenate(words)
        distinct, at = np.unique(flat, return_inverse=True)
        n = np.bincount(at, np.concatenate([_unpack(x) for x in data["counts"].to_pylist()]), len(distinct)).astype(np.int64)
        order = np.lexsort((distinct, -n))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order)) * shards + shard
        out, start = [], 0
        for block, w in zip(data["block"].to_pylist(), words):
            mine = at[start : start + len(w)]
            start += len(w)
            out.append((block, shard, _pack(number[mine]), _pack(n[mine]), None, None, None, None))
        top = np.union1d(order[:SHARE], np.flatnonzero(n > limit))  # of no shard more can have that share
        out.append((None, shard, None, None, int(n.sum()), int((n > 0).sum()), number[top].tolist(), n[top].tolist()))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["block", "shard", "numbers", "counts", "total", "distinct", "top", "top_counts"])

    return run


_WORDS = "block bigint, shard int, numbers binary, counts binary, total bigint, distinct bigint, top array<bigint>, top_counts array<bigint>"


def _code(shards: int, total: int, distinct: int, kind: pa.DataType):
    """Blocks with the words' numbers in place of their hashes, and the documents' base scores."""

    def run(batches):
        for batch in batches:
            for block, keys, train, sizes, vocab, tokens, parts in zip(*(batch.column(i).to_pylist() for i in range(7))):
                h, sizes = _vocab(vocab), np.array(sizes, np.int64)
                number, count, shard = np.empty(len(h), np.int64), np.empty(len(h), np.int64), (h % np.uint64(shards)).astype(np.int32)
                for p in parts:
                    mine = shard == p["shard"]
                    number[mine], count[mine] = _unpack(p["numbers"]), _unpack(p["counts"])
                local = _unpack(tokens)
                t, doc = _with_ends(local, sizes, len(h) - 1)
                p1 = (count + 0.5) / (total + 0.5 * (distinct + 1))
                base = np.bincount(doc, np.log10(p1)[t], len(sizes))
                known = np.bincount(doc, (count > 0)[t], len(sizes)).astype(np.int64)
                quant = _code_of(p1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([keys], pa.list_(kind)), pa.array([train], pa.list_(pa.bool_())), pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([known.tolist()], pa.list_(pa.int64())),
                     pa.array([base.tolist()], pa.list_(pa.float64())), pa.array([_pack(number)], pa.binary()), pa.array([_pack(quant)], pa.binary()), pa.array([tokens], pa.binary())],
                    ["block", "keys", "train", "sizes", "known", "base", "numbers", "quant", "tokens"],
                )

    return run


def _grams(numbers: bytes, sizes, tokens: bytes):
    """Local and global number of each token, the two global numbers before it, and its document; 0 and 1 stand before the
    first words."""
    sizes, number = np.array(sizes, np.int64), _unpack(numbers) + 2
    t, doc = _with_ends(_unpack(tokens), sizes, len(number) - 1)
    w = number[t]
    start = np.cumsum(sizes + 1) - sizes - 1
    v, u = np.roll(w, 1), np.roll(w, 2)
    v[start], u[start] = 1, 0
    u[start[sizes > 0] + 1] = 1
    return t, u, v, w, doc


def _slots(v: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The place of each word among the sorted heavy ones, or -1."""
    if not len(heavy):
        return np.full(len(v), -1, np.int64)
    slot = np.minimum(np.searchsorted(heavy, v), len(heavy) - 1)
    return np.where(heavy[slot] == v, slot, -1)


def _heavy_pairs(v, w, heavy: np.ndarray, shards: int):
    """Positions after a heavy word, their place among the block's distinct pairs, these pairs, and the shard of each."""
    slot = _slots(v, heavy)
    at = np.flatnonzero(slot >= 0)
    pairs, which = np.unique(slot[at] * WORDS + w[at], return_inverse=True)
    return at, which, pairs, (common.mix(pairs.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _totals(u, v, heavy: np.ndarray, keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The count of ``u v`` where that pair is heavy, and 0 elsewhere."""
    out = np.zeros(len(u), np.int64)
    if len(keys):
        slot = _slots(u, heavy)
        at = np.flatnonzero(slot >= 0)
        key = slot[at] * WORDS + v[at]
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        out[at] = np.where(keys[place] == key, totals[place], 0)
    return out


def _emit_pairs(shards: int, heavy: np.ndarray):
    def run(batches):
        for batch in batches:
            for block, train, sizes, numbers, tokens in zip(*(batch.column(i).to_pylist() for i in range(5))):
                _, _, v, w, doc = _grams(numbers, sizes, tokens)
                at, which, pairs, shard = _heavy_pairs(v, w, heavy, shards)
                n = np.bincount(which, np.array(train, float)[doc[at]], len(pairs)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                for p in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else ():
                    yield pa.RecordBatch.from_arrays([pa.array([int(shard[p[0]])], pa.int32()), pa.array([block], pa.int64()), *(pa.array([_pack(x)], pa.binary()) for x in (pairs[p] // WORDS, pairs[p] % WORDS, n[p]))], ["shard", "block", "slots", "words", "counts"])

    return run


_PAIRS = "block bigint, shard int, counts binary, hot array<bigint>, hot_counts array<bigint>"


def _count_pairs(limit: int):
    """The counts over all blocks of each block's pairs; in a row without block, the heavy pairs."""

    def run(data: pa.Table) -> pa.Table:
        pairs = [_unpack(a) * WORDS + _unpack(b) for a, b in zip(data["slots"].to_pylist(), data["words"].to_pylist())]
        distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
        n = np.bincount(at, np.concatenate([_unpack(x) for x in data["counts"].to_pylist()]), len(distinct)).astype(np.int64)
        ends = np.cumsum([len(x) for x in pairs])
        hot = np.flatnonzero(n > limit)
        shard, blocks = data["shard"][0].as_py(), data["block"].to_pylist()
        counts = [_pack(n[x]) for x in np.split(at, ends[:-1])]
        rows = [(b, shard, c, None, None) for b, c in zip(blocks, counts)] + [(None, shard, None, distinct[hot].tolist(), n[hot].tolist())]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [c.split()[0] for c in _PAIRS.split(", ")])

    return run


def _emit_trigrams(shards: int, heavy: dict[int, tuple[int, int]], keys: np.ndarray, totals: np.ndarray):
    """heavy: parts and count in training of each heavy word; keys and totals: the heavy pairs and their counts."""

    def run(batches):
        words = np.array(sorted(heavy), np.int64)
        split_by, total = (np.array([heavy[k][i] for k in sorted(heavy)], np.int64) for i in range(2))
        for batch in batches:
            for block, train, sizes, numbers, quant, tokens, sums in zip(*(batch.column(i).to_pylist() for i in range(7))):
                t, u, v, w, doc = _grams(numbers, sizes, tokens)
                p1 = _unpack(quant)[t]
                part = np.zeros(len(w), np.int64)
                hot, which, pairs, home = _heavy_pairs(v, w, words, shards)
                if len(hot):
                    slot = pairs // WORDS
                    n = np.empty(len(pairs), np.int64)
                    for x in sums:
                        n[home == x["shard"]] = _unpack(x["counts"])
                    by = np.where(_totals(u[hot], v[hot], words, keys, totals) > 0, common.mix(w[hot].astype(np.uint64)), np.uint64(0))
                    part[hot] = (common.mix(u[hot].astype(np.uint64) + by) % split_by[slot[which]].astype(np.uint64)).astype(np.int64)
                    p1[hot] = _code_of(((n[which] + M2 * _value_of(p1[hot])) / (total[slot] + M2)[which]))
                shard = (common.mix((v * PARTS + part).astype(np.uint64)) % np.uint64(shards)).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                flags = np.array(train, bool)
                for p in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    docs, n = np.unique(doc[p], return_counts=True)
                    head = _pack(np.concatenate((np.diff(docs, prepend=0), n * 2 + flags[docs])))
                    body = (_pack(x[p]) for x in (u, v, w, part, p1))
                    yield pa.RecordBatch.from_arrays([pa.array([int(shard[p[0]])], pa.int32()), pa.array([block], pa.int64()), pa.array([head], pa.binary()), *(pa.array([x], pa.binary()) for x in body)], ["shard", "block", "docs", "u", "v", "w", "part", "p1"])

    return run


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int32) if not len(x) or int(x.max()) < 1 << 31 else x


def _score_shard(heavy: np.ndarray, keys: np.ndarray, totals: np.ndarray):
    """log10 probability of each block's documents, as far as their trigrams are in this shard."""

    def run(data: pa.Table) -> pa.Table:
        blocks, column = data["block"].to_pylist(), lambda c: [_narrow(_unpack(x.as_py())) for x in data[c]]
        cols = {c: np.concatenate(column(c)) for c in ("u", "v", "w", "part")}
        p1 = np.concatenate([x.astype(np.uint16) for x in column("p1")])
        heads = [h.reshape(2, -1) for h in column("docs")]
        train = np.concatenate([np.repeat(h[1] & 1, h[1] >> 1) for h in heads]).astype(np.int8)
        order = np.lexsort((cols["w"], cols["u"], cols["part"], cols["v"]))
        u, v, w, part = (cols.pop(c)[order] for c in ("u", "v", "w", "part"))
        starts, run_of = _runs(v, part, u, w)
        which = np.empty(len(order), np.int32)
        which[order] = run_of
        u, v, w, part, p = u[starts].astype(np.int64), v[starts].astype(np.int64), w[starts].astype(np.int64), part[starts], p1[order][starts]
        n = np.bincount(which, train, len(u)).astype(np.int64)
        del order, p1, run_of, starts
        pair_total, given, context = _totals(u, v, heavy, keys, totals), _slots(v, heavy) >= 0, v * PARTS + part
        seen = n > 0
        file, path = tempfile.mkstemp(prefix="trie-")
        os.close(file)
        try:
            trie = Trie(path, Trie.write(path, u[seen], context[seen], w[seen], n[seen], pair_total[seen]))
            logs = np.empty(len(u))
            for k in range(0, len(u), AT_ONCE):
                x = slice(k, k + AT_ONCE)
                logs[x] = np.log10(trie.score(u[x], context[x], w[x], _value_of(p[x]), given[x], pair_total[x]))
            del trie
        finally:
            os.unlink(path)
        out, start = {"block": [], "docs": [], "logs": []}, 0
        for block, head in zip(blocks, heads):
            count = head[1] >> 1
            mine = logs[which[start : start + int(count.sum())]]
            start += int(count.sum())
            out["block"].append(block)
            out["docs"].append(_pack(np.cumsum(head[0])))
            out["logs"].append(np.add.reduceat(mine, np.cumsum(count) - count).tobytes())
        return pa.table([pa.array(out["block"], pa.int64()), pa.array(out["docs"], pa.binary()), pa.array(out["logs"], pa.binary())], ["block", "docs", "logs"])

    return run


def _finish(kind: pa.DataType):
    def run(batches):
        for batch in batches:
            for keys, train, sizes, known, base, parts in zip(*(batch.column(i).to_pylist() for i in range(6))):
                score = np.zeros(len(keys))
                # in one order always, so that reruns sum alike
                for p in sorted(parts or (), key=lambda p: (p["docs"], p["logs"])):
                    score[_unpack(p["docs"])] += np.frombuffer(p["logs"], np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array([not x for x in train], pa.bool_()), pa.array([x + 1 for x in sizes], pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())], ["key", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, held_out: Column, *, key: str = "doc_id", text: str = "text", block: int = BLOCK, limit: int = LIMIT) -> DataFrame:
    """One row for each of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    common.small_batches(spark, 8 << 20)
    field = docs.schema[key].dataType
    kind = pa.int64() if isinstance(field, T.LongType) else pa.int32() if isinstance(field, T.IntegerType) else pa.string()
    name = field.simpleString()
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (~F.coalesce(held_out, F.lit(False))).alias("train"))
    blocks = common.materialize(chosen.mapInArrow(_blocks(block, kind), f"keys array<{name}>, train array<boolean>, sizes array<bigint>, vocab binary, tokens binary").withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    tokens = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x + 1))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-tokens // SHARD_TOKENS))
    words = blocks.select("block", "train", "sizes", "vocab", "tokens").mapInArrow(_emit_words(shards), "shard int, block bigint, words binary, counts binary")
    words = common.materialize(words.groupBy("shard").applyInArrow(_count_words(shards, limit), _WORDS), "lm-words")
    total, distinct = words.where("block IS NULL").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    least = max(min(limit, total // SHARE), total // MOST_HEAVY, 1)
    tops = words.where("block IS NULL").select(F.explode(F.arrays_zip("top", "top_counts")).alias("x")).select("x.*").where(F.col("top_counts") > least)
    heavy = {r["top"] + 2: (-(-r["top_counts"] // least), r["top_counts"]) for r in tops.collect()}
    # START stands before each text's first word, and is no token itself
    starts = blocks.select(F.sum(F.size(F.filter("train", lambda x: x)))).first()[0] or 0
    if starts > least:
        heavy |= {0: (1, starts), 1: (-(-starts // least), starts)}
    heavy_words = np.array(sorted(heavy), np.int64)
    answers = words.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("shard", "numbers", "counts")).alias("parts"))
    coded = blocks.join(answers, "block").select("block", "keys", "train", "sizes", "vocab", "tokens", "parts")
    coded = common.materialize(coded.mapInArrow(_code(shards, total, distinct, kind), f"block bigint, keys array<{name}>, train array<boolean>, sizes array<bigint>, known array<bigint>, base array<double>, numbers binary, quant binary, tokens binary"), "lm-coded")
    common.discard(blocks)
    common.discard(words)
    common.tidy(spark)
    pairs = coded.select("block", "train", "sizes", "numbers", "tokens").mapInArrow(_emit_pairs(shards, heavy_words), "shard int, block bigint, slots binary, words binary, counts binary")
    pairs = common.materialize(pairs.groupBy("shard").applyInArrow(_count_pairs(least), _PAIRS), "lm-pairs")
    hot = pairs.where("block IS NULL").select(F.explode(F.arrays_zip("hot", "hot_counts")).alias("x")).select("x.*").collect()
    hot = sorted([*map(tuple, hot), *([(heavy_words.tolist().index(0) * WORDS + 1, starts)] if 0 in heavy else [])])
    keys, totals = (np.array([r[i] for r in hot], np.int64) for i in range(2))
    common.tidy(spark)
    with_sums = coded.join(pairs.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("shard", "counts")).alias("sums")), "block", "left")
    trigrams = with_sums.select("block", "train", "sizes", "numbers", "quant", "tokens", "sums").mapInArrow(_emit_trigrams(shards, heavy, keys, totals), "shard int, block bigint, docs binary, u binary, v binary, w binary, part binary, p1 binary")
    sums = common.materialize(trigrams.groupBy("shard").applyInArrow(_score_shard(heavy_words, keys, totals), "block bigint, docs binary, logs binary"), "lm-sums")
    common.discard(pairs)
    common.tidy(spark)
    sums = sums.groupBy("block").agg(F.collect_list(F.struct("docs", "logs")).alias("parts"))
    out = coded.select("block", "keys", "train", "sizes", "known", "base").join(sums, "block", "left").select("keys", "train", "sizes", "known", "base", "parts")
    out = out.mapInArrow(_finish(kind), f"key {name}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(total).cast("bigint"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = score(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 1)
    return found.select(F.col("key").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
