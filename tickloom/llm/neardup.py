"""Near-duplicate documents by BagMinHash.

A document is the multiset of its shingles (five consecutive words; a shorter document is one shingle).  BagMinHash
draws, for each shingle, Poisson processes over its discretised weight: one of rate 1 for the weight's first unit and
one of rate 2**k for each doubling after that, whose points are spread over the units by bits of their own and count
where the weight reaches their unit.  Each of ``m`` registers keeps its smallest point, so that two registers agree with
the probability of the weighted Jaccard similarity.  Points are only drawn as far as some register could need them.

1. Documents with the same words are one class from the start (by a 128-bit digest); classes go on as one member.
2. Registers are banded.  In each bucket the member that shares most buckets, its centre, is compared with the others,
   word by word: pairs of a multiset overlap of at least ``threshold`` are links.  A centre's members are dealt into parts
   of bounded size, and its text goes to each part once.
3. Components of the links are found; buckets that still hold more than one component go through ``ROUNDS`` more such
   rounds with other members as centre.  What is left is compared all with all: clusters of open buckets in tiles of at
   most ``TILE`` by ``TILE`` members, or, where a cluster has more than ``BANDS`` blocks of members, bucket by bucket, a
   pair in the first bucket that both are in.  A tile is one task's work, holds registers and words, and emits links only.
   So no candidate pair is left out unless both ends are in one component already, and no pairs are ever emitted to be
   compared.

Buckets, digests and centres with very many rows are joined by broadcast (``common.join_hot``), so that none of them meets
in one task.  Candidates come from banding: 20 bands of 4 registers miss a pair at 0.8 with a chance of 3 in 100,000.
Inside a tile, 512 registers that agree less than five standard deviations below the threshold let pairs go (1 in
3,000,000).

Defined cases: a text without words is a copy of texts with the same bytes only (null and empty are zero bytes); rows
with the same id and words are copies; the class id is the smallest id of the class (null the largest); other columns
are carried untouched, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
ROUNDS = 1
TILE, TILE_BYTES, TILE_REGISTERS = 1500, 12_000_000, 512
#: Members and words of one part of a centre's comparisons.
PART, PART_WORDS = 256, 1_000_000


def bags(texts: list[bytes | None], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets of the texts' shingles: (text number, shingle hash, count), by text number."""
    ids, parts, sizes = common.Ids(), [], []
    for t in texts:
        w = common.words(t)
        parts.append(np.fromiter(map(ids.__getitem__, w), np.int64, len(w)))
        sizes.append(len(w))
    return bags_of_words(parts, np.array(sizes, np.int64), ids, n)


def bags_of_words(parts, sizes, ids, n):
    flat = np.concatenate([np.empty(0, np.int64), *parts])
    values = hash_ids(flat, ids)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    h = common.rolling(values, n)
    inside = doc[: len(h)] == doc[n - 1 :] if len(h) else np.empty(0, bool)
    docs, hashes = [doc[: len(h)][inside]], [h[inside]]
    for i in np.flatnonzero((sizes > 0) & (sizes < n)):
        docs.append(np.array([i]))
        hashes.append(common.rolling(values[starts[i] : starts[i] + sizes[i]], int(sizes[i])) ^ np.uint64(sizes[i]))
    docs, hashes = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return docs[at], hashes[at], np.diff(np.concatenate((at, [len(docs)])))


def hash_ids(flat: np.ndarray, ids) -> np.ndarray:
    return common.hash_words(list(ids))[flat] if len(flat) else np.empty(0, np.uint64)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def registers(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """BagMinHash registers, as float32 (infinite for empty multisets), one row for each document."""
    out = np.full((n_docs, m), np.inf, np.float32)
    total = np.bincount(doc, weight, n_docs)
    todo, slack = total > 0, 5.0
    while todo.any():
        limit = np.where(todo, m / np.maximum(total, 1) * (np.log(m) + slack), -1.0)
        mine = todo[doc]
        _draw(out, doc[mine], element[mine], weight[mine], limit, m)
        # a register that saw nothing within the limit may have its smallest point beyond it
        todo = todo & ~np.isfinite(out).all(axis=1)
        slack *= 2
    return out


def _draw(out, doc, element, weight, limit, m):
    most = int(weight.max()).bit_length() if len(weight) else 0
    for k in range(most + 1):
        low = 0 if k == 0 else 1 << (k - 1)  # units low + 1 ... low + width
        width = max(1, low)
        has = weight > low
        if not has.any():
            break
        d, w, state = doc[has], weight[has] - low, common.mix(element[has] + np.uint64(k * 0xD1B54A32D192ED03 % 2**64))
        cap = limit[d]
        x = np.zeros(len(d))
        while len(d):
            state = state + _STEP
            bits = common.mix(state)
            x = x - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
            alive = x <= cap
            if not alive.all():
                d, w, state, bits, x, cap = d[alive], w[alive], state[alive], bits[alive], x[alive], cap[alive]
            where = common.mix(bits ^ np.uint64(0xA0761D6478BD642F))
            reaches = slice(None)
            if width > 1:  # the bits below the unit's own walk down the halves of the interval
                reaches = ((where >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64) < w
            slot = d[reaches] * m + ((where & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64)[reaches]
            np.minimum.at(out.reshape(-1), slot, x[reaches].astype(np.float32))


def digest(text: bytes | None, found: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(found) if found else b"\0" + (text or b""), digest_size=16).digest()


def _sign(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            digests, bucket, sizes = [], [], []
            for _, texts in common.chunks(batch):
                ids, parts, own = common.Ids(), [], []
                for t in texts:
                    w = common.words(t)
                    digests.append(digest(t, w))
                    parts.append(np.fromiter(map(ids.__getitem__, w), np.int64, len(w)))
                    own.append(len(w))
                sizes += own
                doc, element, weight = bags_of_words(parts, np.array(own, np.int64), ids, SHINGLE)
                sig = registers(doc, element, weight, len(texts), bands * rows)
                key = sig.view(np.uint32).astype(np.uint64).reshape(len(texts), bands, rows)
                h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), key.shape[:2]).copy()
                for r in range(rows):
                    h = common.mix(h * _STEP + key[:, :, r])
                bucket += [b if n else None for b, n in zip(h.view(np.int64), own)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bucket, pa.list_(pa.int64()))], ["key", "digest", "n_words", "buckets"])

    return run


def similarity(a: bytes | None, b: bytes | None) -> float:
    """Weighted Jaccard similarity of the two texts' multisets of shingles."""
    return float(similarities([a, b], 0)[1])


def shingle_numbers(words: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` words, at its start: the same for the same words and for no others."""

    def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.unique(x * (int(y.max()) + 1) + y, return_inverse=True)[1] if len(x) else x

    out, done, level, have = None, 0, words.astype(np.int64), 1
    while True:
        if n & have:
            rest = len(level) - done
            out = level if out is None else pair(out[:rest], level[done : done + len(out[:rest])])
            done += have
        if have * 2 > n:
            return out
        level, have = pair(level[:-have], level[have:]) if len(level) > have else level[:0], have * 2


def similarities(texts: list[bytes | None], centre: int, n: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of each text's multiset of shingles with the centre's, word by word."""
    ids, parts = common.Ids(), []
    for t in texts:
        w = common.words(t)
        parts.append(np.fromiter(map(ids.__getitem__, w), np.int64, len(w)))
    size = np.array([len(p) for p in parts], np.int64)
    flat, doc = np.concatenate(parts), np.repeat(np.arange(len(parts)), size)
    number = shingle_numbers(flat, n)
    inside = doc[: len(number)] == doc[n - 1 :] if len(number) else np.empty(0, bool)
    doc, number = doc[: len(number)][inside], number[inside]
    # a text of fewer words is one shingle, equal to that of the same words only
    short, fresh = {}, int(number.max(initial=-1)) + 1
    few = [i for i in range(len(parts)) if 0 < size[i] < n]
    doc = np.concatenate((doc, np.array(few, np.int64)))
    number = np.concatenate((number, np.array([fresh + short.setdefault(tuple(parts[i].tolist()), len(short)) for i in few], np.int64)))
    width = int(number.max(initial=0)) + 1
    keys, count = np.unique(doc * width + number, return_counts=True)
    doc, number = keys // width, keys % width
    own = np.zeros(width, np.int64)
    own[number[doc == centre]] = count[doc == centre]
    total = np.bincount(doc, count, len(parts))
    both = np.bincount(doc, np.minimum(count, own[number]), len(parts))
    return np.where(both > 0, both / np.maximum(total + total[centre] - both, 1), 0.0)


def overlap(ha: np.ndarray, na: np.ndarray, hb: np.ndarray, nb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets, hashes sorted, with their counts."""
    if not len(ha) or not len(hb):
        return 0.0
    slot = np.minimum(np.searchsorted(ha, hb), len(ha) - 1)
    both = np.where(ha[slot] == hb, np.minimum(na[slot], nb), 0).sum()
    return float(both) / float(na.sum() + nb.sum() - both)


def part_links(data: pa.Table, threshold: float) -> pa.Table:
    """The links (u, v) of one centre (``member`` false) with the members of one part."""
    node, member = data["node"].to_numpy(), data["member"].to_numpy(zero_copy_only=False).astype(bool)
    centre = int(np.flatnonzero(~member)[0])
    alike = similarities(data["text"].cast(pa.binary()).to_pylist(), centre) >= threshold
    found = node[alike & member]
    return pa.table({"u": pa.array(np.maximum(found, node[centre]), pa.int64()), "v": pa.array(np.minimum(found, node[centre]), pa.int64())})


def _links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (x, y) that hold, by their words, as links (u, v); x is the centre."""
    pairs = common.materialize(pairs, "neardup-pairs")
    each = pairs.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    each = common.materialize(each.withColumn("parts", F.ceil(F.greatest(F.col("n") / PART, F.col("words") / PART_WORDS)).cast("int")), "neardup-centres")
    dealt = common.join_hot(pairs, each, "x", "n", pairs.count()).select("x", F.pmod(F.xxhash64("y"), F.col("parts")).cast("int").alias("part"), F.col("y").alias("node"))
    members = dealt.join(texts, "node").select("x", "part", "node", "text", F.lit(True).alias("member"))
    centres = each.select("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("x").alias("node"))
    centres = centres.join(dealt.select("x", "part").distinct(), ["x", "part"], "left_semi").join(texts, "node").select("x", "part", "node", "text", F.lit(False).alias("member"))
    found = members.unionByName(centres).groupBy("x", "part").applyInArrow(lambda t: part_links(t, threshold), "u bigint, v bigint")
    found = common.materialize(found, "neardup-links")
    common.discard(pairs, each)
    return found


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each of ``docs``: key, digest, n_words, first_key and first_digest (of the class's kept document),
    kept (whether this row is that)."""
    common.small_batches(docs.sparkSession)
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T._parse_datatype_string("digest binary, n_words bigint, buckets array<bigint>").fields])
    signed = common.materialize(chosen.mapInArrow(_sign(bands, rows), schema).withColumn("row", F.monotonically_increasing_id()), "neardup-signed")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    copies = common.materialize(signed.groupBy("digest").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("n")).select("digest", F.col("o.key").alias("first"), F.col("o.row").alias("node"), "n"), "neardup-copies")
    own = signed.join(copies.select(F.col("node").alias("row")), "row", "left_semi")
    buckets = common.materialize(own.select(F.col("row").alias("node"), "n_words", F.explode("buckets").alias("bucket")), "neardup-banded")
    sizes = common.materialize(buckets.groupBy("bucket").count().where("count > 1"), "neardup-sizes")
    members = common.materialize(common.join_hot(buckets, sizes, "bucket", "count", buckets.count()), "neardup-buckets")
    common.discard(buckets, sizes)
    links = None if members.isEmpty() else _find_links(members, _texts(chosen, signed, members), threshold, bands)
    common.discard(members)
    return _assign(signed, copies, links)


def _texts(chosen: DataFrame, signed: DataFrame, members: DataFrame) -> DataFrame:
    """node, text of the members of shared buckets: a second scan, joined on id and digest; of equal rows one stays."""

    def run(batches):
        for batch in batches:
            found = []
            for _, texts in common.chunks(batch):
                found += [digest(t, common.words(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], ["key", "text", "digest"])

    schema = T.StructType([*chosen.schema.fields, T.StructField("digest", T.BinaryType())])
    wanted = signed.join(members.select(F.col("node").alias("row")).distinct(), "row", "left_semi").select(F.col("key").alias("k"), F.col("digest").alias("d"), F.col("row").alias("node"))
    again = chosen.mapInArrow(run, schema)
    found = again.join(wanted, (F.col("digest") == F.col("d")) & F.col("key").eqNullSafe(F.col("k"))).select("node", "text")
    return common.materialize(found.dropDuplicates(["node"]), "neardup-texts")


def _find_links(members: DataFrame, texts: DataFrame, threshold: float, bands: int) -> DataFrame:
    """All links found, as (u, v) towards the smallest node of each component."""
    centrality = members.groupBy("node").agg(F.sum("count").alias("shared"))
    members = common.materialize(members.join(centrality, "node"), "neardup-members")
    total, roots = members.count(), None
    open_ = members.withColumn("root", F.col("node"))
    for k in range(ROUNDS + 1):
        rank = F.struct("shared", "node") if k == 0 else F.struct(F.xxhash64("node", F.lit(k)).alias("shared"), "node")
        hubs = open_.groupBy("bucket").agg(F.max_by(F.struct("node", "root"), rank).alias("hub"), F.max("count").alias("count"))
        hubs = common.materialize(hubs, "neardup-hubs")
        pairs = common.join_hot(open_.select("bucket", "node", "root", "n_words"), hubs, "bucket", "count", total).where("root != hub.root")
        pairs = pairs.select(F.col("hub.node").alias("x"), F.col("node").alias("y"), "n_words").distinct()
        found = _links(pairs, texts, threshold)
        common.discard(hubs, open_ if k else None)
        before, roots = roots, components(found if roots is None else roots.unionByName(found))
        common.discard(found, before)
        open_ = _still_open(members, roots, total)
    if open_.isEmpty():
        common.discard(texts, members, open_)
        return roots
    tiles = _tiles(open_, texts, threshold, bands)
    after = components(roots.unionByName(tiles))
    common.discard(texts, members, open_, roots, tiles)
    return after


def _still_open(members: DataFrame, roots: DataFrame, total: int) -> DataFrame:
    """The rows of ``members`` with their root, of the buckets that are not all in one component."""
    named = members.join(roots.select(F.col("u").alias("node"), F.col("v").alias("r")), "node", "left").withColumn("root", F.coalesce("r", "node")).drop("r")
    named = common.materialize(named, "neardup-named")
    mixed = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("count").alias("n")).where("lo < hi").select("bucket", "n")
    mixed = common.materialize(mixed, "neardup-mixed")
    found = common.materialize(common.join_hot(named, mixed, "bucket", "n", total).drop("n"), "neardup-open")
    common.discard(named, mixed)
    return found


def _tiles(open_: DataFrame, texts: DataFrame, threshold: float, bands: int) -> DataFrame:
    """Links between members of different components that are joined by open buckets.

    Each cluster of such buckets is dealt into blocks of about ``TILE`` members, and each pair of blocks is one tile.  In a
    cluster of more than ``bands`` blocks the buckets are dealt so instead: then a text is copied for each of its buckets,
    of which there are ``bands`` at the most, and not for each block of a long chain of buckets.
    """
    spark = open_.sparkSession
    hubs = common.materialize(open_.groupBy("bucket").agg(F.min("node").alias("v"), F.max("count").alias("n")), "neardup-lows")
    spokes = common.join_hot(open_.select("bucket", "node"), hubs, "bucket", "n", open_.count())
    clusters = components(spokes.select(F.col("node").alias("u"), "v").where("u != v"))
    nodes = open_.groupBy("node").agg(F.first("root").alias("root"), F.array_sort(F.collect_set("bucket")).alias("buckets")).join(clusters.select(F.col("u").alias("node"), F.col("v").alias("c")), "node", "left").withColumn("cluster", F.coalesce("c", "node")).drop("c")
    nodes = nodes.join(texts.select("node", F.octet_length("text").alias("bytes")), "node")
    nodes = common.materialize(nodes, "neardup-nodes")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("bytes") / TILE_BYTES)).cast("int").alias("blocks")
    small = nodes.groupBy("cluster").agg(blocks, F.count(F.lit(1)).alias("n"))
    small = common.materialize(small, "neardup-clusters")
    named = common.join_hot(nodes, small, "cluster", "n", nodes.count())
    whole = named.where(F.col("blocks") <= bands).select("node", "root", F.lit(None).cast("array<bigint>").alias("buckets"), F.col("cluster").alias("of"), "blocks")
    # bucket by bucket: a bucket's blocks as a cluster's, in a group of its own
    apart = named.where(F.col("blocks") > bands).select("node", "root", "buckets", "bytes", F.explode("buckets").alias("of"))
    apart = common.materialize(apart, "neardup-apart")
    per = common.materialize(apart.groupBy("of").agg(blocks, F.count(F.lit(1)).alias("n")), "neardup-per")
    apart_ = common.join_hot(apart, per, "of", "n", apart.count()).select("node", "root", "buckets", "of", "blocks")
    dealt = whole.unionByName(apart_).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = common.materialize(dealt, "neardup-dealt")
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("node", "root", "buckets", "of", F.col("buckets").isNull().alias("whole"), "block", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"))
    # so many tasks, however few bytes the tiles have: their work grows with the square of those
    wide = tiles.join(texts, "node").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "whole", "of", "ti", "tj")
    found = wide.groupBy("whole", "of", "ti", "tj").applyInArrow(lambda t: tile_links(t, threshold), "u bigint, v bigint")
    found = common.materialize(found, "neardup-tiles")
    common.discard(hubs, clusters, nodes, small, apart, per, dealt)
    return found


def tile_links(data: pa.Table, threshold: float) -> pa.Table:
    """The links (u, v) of one tile between different components, as far as they join what is not joined yet.

    With ``buckets``, a tile of one bucket (``of``): a pair that shares an earlier bucket is compared there.
    """
    node, root, block = (data[c].to_numpy() for c in ("node", "root", "block"))
    lists = data["buckets"].to_pylist() if "buckets" in data.column_names else [None] * len(node)
    earlier = [{b for b in own if b < data["of"][0].as_py()} for own in lists] if lists and lists[0] is not None else None
    texts, n = data["text"].cast(pa.binary()), len(node)
    doc, element, weight = bags([x.as_py() for x in texts])
    sig = registers(doc, element, weight, n, TILE_REGISTERS)
    at = np.searchsorted(doc, np.arange(n + 1))
    total = np.bincount(doc, weight, n)
    least = threshold - 5 * np.sqrt(threshold * (1 - threshold) / TILE_REGISTERS)
    joined = {r: r for r in root.tolist()}

    def find(x):
        while joined[x] != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    one, two = (np.flatnonzero(block == b) for b in (block.min(), block.max()))
    same, us, vs = block.min() == block.max(), [], []
    label = root.copy()
    for k, a in enumerate(one):
        others = two[k + 1 :] if same else two
        others = others[label[others] != label[a]]
        if earlier is not None and earlier[a]:
            others = np.array([b for b in others.tolist() if not earlier[a] & earlier[b]], np.int64)
        size = np.minimum(total[others], total[a]) >= threshold * np.maximum(total[others], total[a]) - 1e-9
        others = others[size]
        others = others[(sig[others] == sig[a]).mean(axis=1) >= least] if len(others) else others
        for b in others:
            ra, rb = find(int(root[a])), find(int(root[b]))
            # hashes nominate, words decide
            if ra != rb and overlap(element[at[a] : at[a + 1]], weight[at[a] : at[a + 1]], element[at[b] : at[b + 1]], weight[at[b] : at[b + 1]]) >= threshold and similarity(texts[int(a)].as_py(), texts[int(b)].as_py()) >= threshold:
                us.append(max(node[a], node[b]))
                vs.append(min(node[a], node[b]))
                joined[max(ra, rb)] = min(ra, rb)
                label[(label == ra) | (label == rb)] = min(ra, rb)
    return pa.table({"u": pa.array([int(x) for x in us], pa.int64()), "v": pa.array([int(x) for x in vs], pa.int64())})


def _assign(signed: DataFrame, copies: DataFrame, roots: DataFrame | None) -> DataFrame:
    order = F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("key"), F.col("node").alias("row"), "digest")
    if roots is None:
        classed = copies.select("digest", "n", order.alias("o"))
    else:
        named = copies.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
        best = named.groupBy("root").agg(F.min(order).alias("o"))
        classed = named.join(best, "root").select("digest", "n", "o")
    classed = common.materialize(classed.select("digest", "n", F.col("o.key").alias("first_key"), F.col("o.row").alias("first_row"), F.col("o.digest").alias("first_digest")), "neardup-classes")
    out = common.join_hot(signed.select("key", "digest", "n_words", "row"), classed, "digest", "n", signed.count())
    common.discard(copies, roots)
    return out.select("key", "digest", "n_words", "first_key", "first_digest", (F.col("row") == F.col("first_row")).alias("kept"))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class."""
    own, none, ident = (common.free_name(docs, n) for n in ("_nd_digest", "_nd_none", "_nd_id"))
    kind = docs.schema[key].dataType
    zero = F.lit("").cast(kind) if isinstance(kind, T.StringType) else F.lit(0).cast(kind)
    kept = classes(docs, key=key, text=text).where("kept").select(F.col("key").isNull().alias(none), F.coalesce(F.col("key"), zero).alias(ident), F.col("digest").alias(own))

    def run(batches):
        for batch in batches:
            found = []
            for _, texts in common.chunks(batch, text):
                found += [digest(t, common.words(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, own])

    known = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(own, T.BinaryType())]))
    known = known.withColumns({none: F.col(key).isNull(), ident: F.coalesce(F.col(key), zero)})
    on = [ident, none, own]
    return known.join(kept, on, "left_semi").dropDuplicates(on).select(docs.columns)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.col("first_key").alias("component_id"), "kept", "n_words")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return keep_one(docs)
