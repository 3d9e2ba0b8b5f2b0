"""Exact removal of repeated byte strings with suffix arrays.

Each byte covered by a ``LENGTH``-byte string that starts earlier too (in an earlier document, or further left) goes.

1. Documents are packed into blocks.  Winnowing picks anchors: of any ``LENGTH`` bytes at least one anchor's ``GRAM``
   bytes, so that equal strings share an anchor's hash.  An anchor's *region* is all that such strings around it can
   cover; a strong 128-bit digest stands for its bytes.  Of a block's equal regions only the first is dealt, by the anchor's
   hash, to shards; the others are repeats as a whole already.
2. A shard keeps the anchors that occur more than once.  Regions equal to an earlier one are repeats as a whole.  Where
   the regions of an anchor differ, the first of each kind goes on, with its bytes; an anchor of more than ``HOT`` bytes of
   them is cut into parts, which go to different shards.
3. These regions form the shards of the suffix arrays: Larsson and Sadakane's refinement, doubling the sorted depth
   and sorting again only groups that are not single yet; common prefixes of neighbours by Kasai's lemma (an entry is
   its left neighbour's less one unless the bytes before differ, so that only the others are compared).  Runs of
   common prefixes of at least ``LENGTH`` are equal strings; all but the earliest are repeats.  A shard over
   ``CHUNK`` bytes is cut between anchors.
4. Each part of a cut anchor sends on its distinct strings with their earliest places, sorted, dealt by digest into as many
   slots as there are parts; a slot merges the parts' lists by binary search, and what an earlier place has too is a repeat.
5. The repeats go back to their blocks.

Anchors, regions and strings travel as rows, so a shard costs a group and not a piece from each block.

Defined cases: null and empty texts have no bytes; ids may be of any type, in the order that Spark gives them, and a null id
comes before all others; rows with the same id are separate documents in the order of their blocks; nothing matches across
documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

LENGTH, GRAM = 100, 24
BLOCK = 2_000_000
#: Text for one shard of anchors; regions for one shard and for one suffix array; one part of a hot anchor.
SHARD_TEXT, SHARD_REGIONS, CHUNK, HOT = 8_000_000, 6_000_000, 1_200_000, 1_200_000
LEAST_SHARDS = 48
_NULL = -(1 << 63)
_TABLE = common.mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15


def _blocks(size: int):
    """(key, order, text) rows to blocks."""

    def run(batches):
        keys, order, texts, total = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([keys], pa.list_(kind)), pa.array([order], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([zstandard.compress(b"".join(texts), 3)], pa.binary())], ["keys", "order", "sizes", "data"])

        for batch in batches:
            kind = batch.schema.field(0).type
            ids, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, found in common.chunks(batch):
                for i, t in enumerate(found, start):
                    if total and total + len(t or b"") > size:
                        yield flush()
                        keys, order, texts, total = [], [], [], 0
                    keys.append(ids[i])
                    order.append(numbers[i])
                    texts.append(t or b"")
                    total += len(t or b"")
        if keys:
            yield flush()

    return run


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8)


def gram_hashes(b: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each position, by doubling."""
    out, have, base, parts = np.zeros(max(0, len(b) - n + 1), np.uint64), 1, _BASE, []
    level, done = _TABLE[b], 0
    while True:
        if n & have:
            out *= np.uint64(base)
            out += level[done : done + len(out)]
            done += have
        if have * 2 > n:
            return common.mix(out)
        level = level[:-have] * np.uint64(base) + level[have:]
        base, have = base * base % 2**64, have * 2


def _sliding(x: np.ndarray, w: int, best) -> np.ndarray:
    """``best`` of each ``w`` neighbours."""
    have = 1
    while have * 2 <= w:
        x, have = best(x[:-have], x[have:]), have * 2
    return best(x[: len(x) - (w - have)], x[w - have :]) if w > have else x


def anchors(b: np.ndarray, sizes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors: the smallest hash in each ``length`` bytes of a document."""
    w = length - gram + 1
    if len(b) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(b, gram)
    low = _sliding(h, w, np.minimum)
    ends = np.repeat(np.cumsum(sizes), sizes)
    low[np.arange(len(low)) + length > ends[: len(low)]] = 0
    pad = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate((pad, low, pad)), w, np.maximum)[: len(h)] == h)
    return _thin(at, h[at], w)


def _thin(at: np.ndarray, h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Of near anchors with one hash, as in runs of one byte, the first and last in each half window stay."""
    if len(at) < 3:
        return at, h
    new = np.ones(len(at), bool)
    new[1:] = (h[1:] != h[:-1]) | (at[1:] - at[:-1] >= w)
    start = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
    part = (at - start) // (w // 2)
    first = new.copy()
    first[1:] |= part[1:] != part[:-1]
    last = np.append(first[1:], True)
    return at[first | last], h[first | last]


def region_bounds(at: np.ndarray, sizes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    doc = np.searchsorted(ends, at, "right")
    return np.maximum(at - (length - gram), ends[doc] - sizes[doc]), np.minimum(at + length, ends[doc])


def _digests(b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Strong digests of the byte ranges, as two columns of numbers."""
    raw, strong = memoryview(np.ascontiguousarray(b)), hashlib.blake2b
    return np.frombuffer(b"".join([strong(raw[s:e], digest_size=16).digest() for s, e in zip(lo.tolist(), hi.tolist())]), np.int64).reshape(-1, 2)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Whether a row, in sorted order, begins another group."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


_ANCHORS = "shard int, h bigint, r1 bigint, r2 bigint, key bigint, block bigint, at int, repeat boolean"


def _emit_anchors(shards: int):
    names = [c.split()[0] for c in _ANCHORS.split(", ")]

    def run(batches):
        for batch in batches:
            for block, order, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                b, sizes, order = _unpack(data), np.array(sizes, np.int64), np.array(order, np.int64)
                at, h = anchors(b, sizes)
                if not len(at):
                    continue
                r = _digests(b, *region_bounds(at, sizes))
                key, h = order[np.searchsorted(np.cumsum(sizes), at, "right")], h.view(np.int64)
                by = np.lexsort((at, key, r[:, 1], r[:, 0], h))
                repeat = np.empty(len(at), bool)
                repeat[by] = ~_groups(h[by], r[by, 0], r[by, 1])
                # a repeat only needs to come back to its block: it goes wherever there is room
                shard = np.where(repeat, common.mix(np.full(len(at), block, np.uint64)), h.view(np.uint64)) % np.uint64(shards)
                columns = (shard.astype(np.int32), h, r[:, 0], r[:, 1], key, np.full(len(at), block), at.astype(np.int32), repeat)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


_MET = "block bigint, at int, part int, parts int"


def _meet(hot: int):
    """Of one shard's anchors: whole repeats (part -1) and regions to be compared, by block."""

    def run(data: pa.Table) -> pa.Table:
        h, r1, r2, key, block, at, repeat = (data[c].to_numpy(zero_copy_only=False) if c == "repeat" else data[c].to_numpy() for c in ("h", "r1", "r2", "key", "block", "at", "repeat"))
        gone = np.flatnonzero(repeat)
        left = np.flatnonzero(~repeat)
        left = left[np.argsort(h[left], kind="stable")]
        edge = _groups(h[left])
        size = np.bincount(np.cumsum(edge) - 1, minlength=1)
        left = left[size[np.cumsum(edge) - 1] > 1] if len(left) else left
        left = left[np.lexsort((at[left], block[left], key[left], r2[left], r1[left], h[left]))]
        new_h, first = _groups(h[left]), _groups(h[left], r1[left], r2[left])
        group = np.cumsum(new_h) - 1
        kinds = np.bincount(group, first, minlength=1).astype(np.int64)[group] if len(left) else np.empty(0, np.int64)
        # the regions of a hot anchor are dealt into parts, in their order
        each = max(1, hot // (2 * LENGTH))
        number = np.cumsum(first) - 1
        number = number - np.maximum.accumulate(np.where(new_h, number, 0)) if len(left) else number
        parts = -(-kinds // each)
        open_ = first & (kinds > 1)
        keep = ~first | open_
        out_block = np.concatenate((block[gone], block[left][keep]))
        out_at = np.concatenate((at[gone], at[left][keep]))
        part = np.concatenate((np.full(len(gone), -1), np.where(open_, number // each, -1)[keep]))
        return pa.table([pa.array(out_block, pa.int64()), pa.array(out_at, pa.int32()), pa.array(part, pa.int32()), pa.array(np.concatenate((np.ones(len(gone), np.int64), parts[keep])), pa.int32())], [c.split()[0] for c in _MET.split(", ")])

    return run


_REGIONS = "shard int, h bigint, part int, parts int, key bigint, block bigint, place bigint, data binary"


def _emit_regions(shards: int):
    names = [c.split()[0] for c in _REGIONS.split(", ")]

    def run(batches):
        for batch in batches:
            for block, order, sizes, data, marks in zip(*(batch.column(i).to_pylist() for i in range(5))):
                at = np.array([m["at"] for m in marks], np.int64)
                part, parts = (np.array([m[c] for m in marks], np.int64) for c in ("part", "parts"))
                b, sizes, order = _unpack(data), np.array(sizes, np.int64), np.array(order, np.int64)
                lo, hi = region_bounds(at, sizes)
                h = gram_hashes(b, GRAM)[at]
                key = order[np.searchsorted(np.cumsum(sizes), at, "right")]
                shard = (common.mix(h + part.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(shards)).astype(np.int32)
                raw = b.tobytes()
                columns = (shard, h.view(np.int64), part.astype(np.int32), parts.astype(np.int32), key, np.full(len(at), block), lo)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array([raw[s:e] for s, e in zip(lo.tolist(), hi.tolist())], pa.binary())], names)

    return run


PACKED = 7


def packed(text: np.ndarray, low: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``PACKED`` letters from each place as one number, and whether an end mark (a letter under ``low``) is among
    them; the number stops at that mark."""
    n = len(text)
    mark = text < low
    letter = np.where(mark, 0, text - low + 1)
    out, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(PACKED):
        a, m = np.zeros(n, np.int64), np.ones(n, bool)
        if k < n:
            a[: n - k], m[: n - k] = letter[k:], mark[k:]
        ended |= m
        out = out << 9
        out[~ended] |= a[~ended]
    return out, ended


def suffix_array(text: np.ndarray, most: int, low: int | None = None, pack: tuple | None = None) -> np.ndarray:
    """Suffix order of ``text`` (no negative letters) by Larsson and Sadakane's refinement, to a depth of ``most``.

    Letters under ``low`` are end marks that occur once each, and the others are under ``low`` + 256: then the first
    ``PACKED`` letters are sorted as one number.
    """
    n = len(text)
    if low is None:
        rank, depth = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
    else:
        key, ended = pack or packed(text, low)
        # up to the end mark the letters agree, and the mark decides
        nearest = np.minimum.accumulate(np.where(text < low, np.arange(n), n)[::-1])[::-1]
        tie = np.where(ended & (nearest < n), text[np.minimum(nearest, n - 1)] + 1, 0)
        order = np.argsort(key)
        some = np.flatnonzero(ended[order])
        if len(some):
            order = np.lexsort((tie, key))
        new = np.ones(n, np.int64)
        new[1:] = (key[order[1:]] != key[order[:-1]]) | (tie[order[1:]] != tie[order[:-1]])
        rank, depth = np.empty(n, np.int64), PACKED
        rank[order] = np.cumsum(new) - 1
    # a group's number is the place of its last member
    rank = _number(rank, order)
    size = np.bincount(rank, minlength=n)
    todo = order[size[rank[order]] > 1]
    while len(todo) and depth < most:
        after = np.where(todo + depth < n, rank[np.minimum(todo + depth, n - 1)], -1)
        by = np.argsort(rank[todo] * (n + 1) + after + 1)
        todo, after = todo[by], after[by]
        group = rank[todo]
        # the members of a group fill its places again, in their new order
        start = np.ones(len(todo), bool)
        start[1:] = group[1:] != group[:-1]
        which = np.cumsum(start) - 1
        length = np.bincount(which)
        place = group - length[which] + 1 + np.arange(len(todo)) - np.flatnonzero(start)[which]
        order[place] = todo
        new = start.copy()
        new[1:] |= after[1:] != after[:-1]
        last = np.append(np.flatnonzero(new)[1:] - 1, len(todo) - 1)
        part = np.cumsum(new) - 1
        rank[todo] = place[last[part]]
        todo = todo[np.bincount(part)[part] > 1]
        depth *= 2
    return order


def _number(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    r = rank[order]
    last = np.append(np.flatnonzero(r[1:] != r[:-1]), len(r) - 1)
    out = np.empty(len(r), np.int64)
    out[order] = np.repeat(last, np.diff(last, prepend=-1))
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, low: int | None = None, pack: tuple | None = None) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it.

    In text order an entry is its left neighbour's less one where the bytes before both suffixes agree (Kasai), so only
    the others are compared.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    fresh = (i == 0) | (before <= 0)
    fresh[~fresh] = text[i[~fresh] - 1] != text[before[~fresh] - 1]
    fresh[1:] |= before[:-1] < 0
    left = np.flatnonzero(fresh & (before >= 0))
    right, size = before[left], np.zeros(n, np.int64)
    alive = np.arange(len(left))
    k = np.zeros(len(left), np.int64)
    if low is not None:  # as long as the next letters agree without an end mark, they count together
        key, ended = pack or packed(text, low)
        run = alive
        while len(run):
            a, b = left[run] + k[run], right[run] + k[run]
            inside = (a < n) & (b < n)
            run, a, b = run[inside], a[inside], b[inside]
            run = run[(key[a] == key[b]) & ~ended[a] & ~ended[b]]
            k[run] += PACKED
        size[left] = k
    while len(alive):
        a, b = left[alive] + k[alive], right[alive] + k[alive]
        inside = (a < n) & (b < n)
        alive, a, b = alive[inside], a[inside], b[inside]
        alive = alive[text[a] == text[b]]
        k[alive] += 1
        size[left[alive]] = k[alive]
    base = np.maximum.accumulate(np.where(fresh, i, 0))
    return np.maximum(size[base] - (i - base), 0)[order]


def repeats(regions: list[bytes], rank: np.ndarray, base: np.ndarray, length: int = LENGTH, single: bool = True) -> tuple[np.ndarray, ...]:
    """All strings of ``length`` in the regions: (region, place, group of equal strings, the groups' first members).

    A string's place is its region's ``base`` plus its offset; the first of a group has the smallest (rank, place).
    Regions may overlap: what has the same rank and place is one string.  Groups are in lexical order; without
    ``single`` those of one member are left out.
    """
    size = np.array([len(r) for r in regions], np.int64)
    flat = np.frombuffer(b"".join(regions), np.uint8)
    start = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    text = np.zeros(int(size.sum() + len(size)), np.int64)
    of = np.repeat(np.arange(len(size)), size)
    where = np.arange(len(flat)) + of
    # the end of each region is a letter of its own, so that no common prefix goes on beyond it
    text[where] = flat.astype(np.int64) + len(size)
    text[start + size] = np.arange(len(size))
    pack = packed(text, len(size))
    order = suffix_array(text, int(size.max()) + 1, len(size), pack)
    lcp = common_prefixes(text, order, len(size), pack)
    region = np.repeat(np.arange(len(size)), size + 1)[order]
    offset = order - start[region]
    valid = offset + length <= size[region]
    # a chain of long common prefixes only holds suffixes with so many bytes left
    group = np.cumsum(lcp < length)
    if not single:
        valid &= np.bincount(group)[group] > 1
    group, region = group[valid], region[valid]
    place = base[region] + offset[valid]
    new = np.ones(len(group), bool)  # a group stands together in the order of suffixes
    new[1:] = group[1:] != group[:-1]
    group, age = np.cumsum(new) - 1, (rank[region] << 32) | place
    oldest = np.minimum.reduceat(age, np.flatnonzero(new)) if len(age) else age
    first = np.flatnonzero(age == oldest[group])
    return region, place, group, first[np.append(True, np.diff(group[first]) > 0)] if len(first) else first


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """``parts``: (sorted distinct strings, ages) each.  For each part, which of its strings has a smaller age elsewhere.

    One part after the other is looked up in the merged list by binary search; ages are rows of numbers, compared in order.
    """
    merged, best = parts[0][0][:0], parts[0][1][:0].copy()
    for own, age in parts:
        at = np.searchsorted(merged, own)
        known = np.zeros(len(own), bool)
        inside = at < len(merged)
        known[inside] = merged[at[inside]] == own[inside]
        best[at[known]] = np.where(_older(age[known], best[at[known]])[:, None], age[known], best[at[known]])
        merged, best = np.insert(merged, at[~known], own[~known]), np.insert(best, at[~known], age[~known], axis=0)
    return [(best[np.searchsorted(merged, own)] != age).any(axis=1) for own, age in parts]


def _older(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a row of ``a`` comes before that of ``b``, by the first column that differs."""
    out, same = np.zeros(len(a), bool), np.ones(len(a), bool)
    for k in range(a.shape[1]):
        out |= same & (a[:, k] < b[:, k])
        same &= a[:, k] == b[:, k]
    return out


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of [lo, hi)."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    at = np.flatnonzero(new)
    return lo[at], hi[np.append(at[1:] - 1, len(hi) - 1)] if len(at) else hi[:0]


_FOUND = "block bigint, spans binary, anchor bigint, slot int, strings binary, ages binary"
_KINDS = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary())


def _table(rows: list[tuple]) -> pa.Table:
    """Rows of ``_FOUND``: a block's spans, or the sorted strings that a part of an anchor has in one slot, with their ages."""
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_KINDS)], [c.split()[0] for c in _FOUND.split(", ")])


def _united(block: np.ndarray, lo: np.ndarray) -> list[tuple]:
    """The union of [lo, lo + LENGTH) in each block."""
    by = np.argsort(block, kind="stable")
    block, lo = block[by], lo[by]
    cuts = np.flatnonzero(np.diff(block)) + 1
    return [(int(block[p[0]]), np.column_stack(_spans(lo[p], lo[p] + LENGTH)).tobytes(), None, None, None, None) for p in np.split(np.arange(len(by)), cuts) if len(p)]


def _compare(data: pa.Table) -> pa.Table:
    """The repeats in one shard's regions, as spans; of a part of a cut anchor also its distinct strings."""
    h, part, parts, key, block, pos = (data[c].to_numpy() for c in ("h", "part", "parts", "key", "block", "place"))
    texts = data["data"].cast(pa.large_binary()).combine_chunks()
    size = pa.compute.binary_length(texts).to_numpy()
    order = np.lexsort((pos, block, key, part, h))
    by = np.lexsort((block, key))
    rank = np.empty(len(h), np.int64)
    rank[by] = np.cumsum(_groups(key[by], block[by])) - 1
    # anchors and parts stay whole; a chunk ends with the anchor that fills it
    starts = np.append(np.flatnonzero(_groups(h[order], part[order])), len(order))
    run = np.concatenate(([0], np.cumsum(size[order])))
    lo, of, sent = [], [], []
    i = 0
    while i < len(starts) - 1:
        cut = parts[order[starts[i]]] > 1
        j = i + 1 if cut else max(i + 1, int(np.searchsorted(run[starts], run[starts[i]] + CHUNK, "right")) - 1)
        if not cut:  # up to the next part of a cut anchor
            ahead = np.flatnonzero(parts[order[starts[i:j]]] > 1)
            j = i + int(ahead[0]) if len(ahead) else j
        own = order[starts[i] : starts[j]]
        if len(own) > 1 or cut:
            regions = texts.take(pa.array(own)).to_pylist()
            region, place, group, first = repeats(regions, rank[own], pos[own], LENGTH, cut)
            top = first[group] if len(group) else first
            later = (rank[own][region] != rank[own][region[top]]) | (place != place[top])
            lo.append(place[later])
            of.append(block[own[region[later]]])
            if cut and len(first):
                where = (place - pos[own][region])[first].tolist()
                raw = b"".join(hashlib.blake2b(regions[r][o : o + LENGTH], digest_size=16).digest() for r, o in zip(region[first].tolist(), where))
                strings = np.frombuffer(raw, "S16")
                src, one = own[region[first]], own[0]
                ages = np.column_stack((key[src], block[src], place[first])).astype(np.int64)
                slot = np.frombuffer(raw, ">u4")[::4].astype(np.int64) * int(parts[one]) >> 32
                in_order = np.argsort(strings, kind="stable")
                in_order = in_order[np.argsort(slot[in_order], kind="stable")]
                for p in np.split(in_order, np.flatnonzero(np.diff(slot[in_order])) + 1):
                    sent.append((None, None, int(h[one]), int(slot[p[0]]), strings[p].tobytes(), ages[p].tobytes()))
        i = j
    flat = lambda x: np.concatenate([np.empty(0, np.int64), *x])
    return _table(_united(flat(of), flat(lo)) + sent)


def _merge_slot(data: pa.Table) -> pa.Table:
    """The repeats among the distinct strings that the parts of one anchor have in one slot."""
    parts = [(np.frombuffer(x, "S16"), np.frombuffer(y, np.int64).reshape(-1, 3)) for x, y in zip(data["strings"].to_pylist(), data["ages"].to_pylist())]
    gone = np.concatenate([age[later] for (_, age), later in zip(parts, merge(parts))])
    return _table(_united(gone[:, 1], gone[:, 2]))


def _finish(kind: pa.DataType):
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("key", "n_bytes", "spans", "kept")}
            for keys, sizes, data, ats, spans in zip(*(batch.column(i).to_pylist() for i in range(5))):
                b, sizes = _unpack(data), np.array(sizes, np.int64)
                gone = np.zeros(len(b) + 1, np.int32)
                if ats:
                    lo, hi = region_bounds(np.array(ats, np.int64), sizes)
                    np.add.at(gone, lo, 1)
                    np.add.at(gone, hi, -1)
                for x in spans or ():
                    pair = np.frombuffer(x, np.int64).reshape(-1, 2)
                    np.add.at(gone, pair[:, 0], 1)
                    np.add.at(gone, pair[:, 1], -1)
                removed = np.cumsum(gone[:-1]) > 0
                ends = np.cumsum(sizes)
                for key, a, e in zip(keys, (ends - sizes).tolist(), ends.tolist()):
                    r = removed[a:e]
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], r.view(np.int8), [0]))))
                    out["key"].append(key)
                    out["n_bytes"].append(e - a)
                    out["spans"].append([{"start": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
                    out["kept"].append((b[a:e][~r] if len(edges) else b[a:e]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["key"], kind), pa.array(out["n_bytes"], pa.int64()), pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(out["kept"], pa.binary())], list(out))

    return run


def _ordered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, order, text): whole numbers are their own order; other ids are numbered over ranges of them."""
    kind = docs.schema[key].dataType
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if isinstance(kind, T.IntegralType):
        return chosen.select("key", F.coalesce(F.col("key").cast("bigint"), F.lit(_NULL)).alias("order"), "text")
    ids = common.numbered(chosen.select("key").where("key IS NOT NULL").distinct(), "key", "order")
    return chosen.join(ids, "key", "left").select("key", F.coalesce("order", F.lit(_NULL)).alias("order"), "text")


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """One row for each of ``docs``: key, n_bytes, spans (removed byte runs), kept (the bytes that stay)."""
    spark = docs.sparkSession
    common.small_batches(spark, 8 << 20)
    kind = docs.schema[key].dataType
    name, arrow = kind.simpleString(), common.arrow_type(kind)
    blocks = _ordered(docs, key, text).mapInArrow(_blocks(block), f"keys array<{name}>, order array<bigint>, sizes array<bigint>, data binary").withColumn("block", F.monotonically_increasing_id())
    blocks = common.materialize(blocks, "suffix-blocks")
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-total // SHARD_TEXT))
    found = blocks.select("block", "order", "sizes", "data").mapInArrow(_emit_anchors(shards), _ANCHORS)
    met = common.materialize(found.groupBy("shard").applyInArrow(_meet(hot), _MET), "suffix-met")
    common.tidy(spark)
    open_ = met.where("part >= 0")
    shards = max(LEAST_SHARDS, -(-open_.count() * 2 * LENGTH // SHARD_REGIONS))
    marked = open_.groupBy("block").agg(F.collect_list(F.struct("at", "part", "parts")).alias("marks"))
    sent = blocks.join(marked, "block").select("block", "order", "sizes", "data", "marks").mapInArrow(_emit_regions(shards), _REGIONS)
    compared = common.materialize(sent.groupBy("shard").applyInArrow(_compare, _FOUND), "suffix-compared")
    common.tidy(spark)
    merged = common.materialize(compared.where("anchor IS NOT NULL").groupBy("anchor", "slot").applyInArrow(_merge_slot, _FOUND), "suffix-merged")
    ats = met.where("part < 0").groupBy("block").agg(F.collect_list("at").alias("ats"))
    spans = compared.where("anchor IS NULL").unionByName(merged).groupBy("block").agg(F.collect_list("spans").alias("spans"))
    full = blocks.join(ats, "block", "left").join(spans, "block", "left").select("keys", "sizes", "data", "ats", "spans")
    return full.mapInArrow(_finish(arrow), f"key {name}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(common.table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(F.col("key").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
