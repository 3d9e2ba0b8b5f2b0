"""Personal data by patterns, widened by bootstrapped contextual extraction.

Four shapes (email, ip, card, phone) are found in every text: these spans are the seeds.  Every other token with a digit or
an ``@`` is a *mention*.  Lexical *patterns* are the words beside a token, at four grains: the two words before it, the one
before, the one after, and the one before with the one after; lower case, with classes in place of words that hold digits or
an ``@``.  Spark then scores the graph of patterns and instances (tokens) in turns, until a turn finds no further pattern and
no further instance: a pattern's confidence for a kind is the mean score of the distinct instances that it stands by, of
which those without any kind so far count for a half; an instance's score is the chance that not all its patterns are wrong, where of the grains of one side the surest counts.  A
pattern needs ``support`` distinct instances that back it and a confidence of ``confident``.  Mentions of instances that
end up scored at least ``accept`` are added as spans of kind ``ctx_<kind>``.

Patterns and instances once found stay found, so the turns end.  The graph holds a row for each distinct pair of pattern
and instance; hot patterns are summed before the shuffle.

Defined cases: null and empty texts hold nothing; rows are judged one by one (a row number keeps repeated ids apart); no
seeds, no patterns, no additions; tokens under ``LEAST_TOKEN`` characters are no mentions; a text has an end on both sides,
which counts as a word.  Spans are in code points, the end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *(f"ctx_{k}" for k in BASE))
SUPPORT, CONFIDENT, ACCEPT = 5, 0.8, 0.9
#: What an instance without any kind counts for against a pattern: it may be one that nobody has found yet.
UNKNOWN = 0.5
#: Shorter tokens are no identifiers.
LEAST_TOKEN = 5
#: Sides of the four grains: before, before, after, both.
SIDES = (0, 0, 1, 2)
#: Patterns and instances under so many rows are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits fails or matches as a whole, so that no try inside it is needed
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK, _TOKEN, _DIGIT = re.compile(r"[0-9@]"), re.compile(r"\S+"), re.compile(r"[0-9]")
_EDGE = ".,;:!?\"'()[]{}<>"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, t.find("@")
    while at >= 0:
        start = at
        while start > last and t[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(t, at + 1)):
            out.append((start, m.end()))
            last = m.end()
        else:
            last = at  # what stands before a failing @ can't begin a later match, which would have to cross it
        at = t.find("@", max(at + 1, last))
    return out


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four shapes, by kind and start."""
    out = [(0, a, b) for a, b in emails(t)]
    if not _MARK.search(t):
        return out
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(t):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def _word(w: str) -> str:
    return "<mail>" if "@" in w else "<num>" if _DIGIT.search(w) else w.strip(_EDGE).lower() or w


def _signed(x: str) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(x.encode()), "big", signed=True)


class Contexts:
    """The words of a text and the patterns beside a token of it."""

    def __init__(self, t: str):
        self.at = [m.span() for m in _TOKEN.finditer(t)]
        self.starts, self.t, self.known = [a for a, _ in self.at], t, {}

    def word(self, i: int) -> str:
        return _word(self.t[slice(*self.at[i])]) if 0 <= i < len(self.at) else "<end>"

    def patterns(self, start: int, end: int) -> list[int]:
        """Numbers of the four patterns beside [start, end), which begins and ends in words of the text."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        if (first, last) not in self.known:
            two, one, after = self.word(first - 2), self.word(first - 1), self.word(last + 1)
            self.known[first, last] = [_signed(x) for x in (f"bb {two} {one}", f"b {one}", f"a {after}", f"ba {one} {after}")]
        return self.known[first, last]


def mentions(t: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, list[int]]]:
    """(start, end, kind or -1, patterns): the seeds, and the other tokens with a digit or an @."""
    if not base and not _MARK.search(t):
        return []
    contexts = Contexts(t)
    out = [(a, b, k, contexts.patterns(a, b)) for k, a, b in base]
    taken, i = sorted((a, b) for _, a, b in base), 0
    for start, end in contexts.at:
        if not _MARK.search(t, start, end):
            continue
        while start < end and t[start] in _EDGE:
            start += 1
        while end > start and t[end - 1] in _EDGE:
            end -= 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if end - start >= LEAST_TOKEN and not (i < len(taken) and taken[i][0] < end):
            out.append((start, end, -1, contexts.patterns(start, end)))
    return out


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("patterns", pa.list_(pa.int64())), ("instance", pa.int64())])


def _spot(batches):
    for batch in batches:
        spans, found = [], []
        for _, texts in common.chunks(batch):
            for raw in texts:
                t = raw.decode() if raw else ""
                base = base_spans(t)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                found.append([{"start": a, "end": b, "kind": k, "patterns": p, "instance": _signed(t[a:b])} for a, b, k, p in mentions(t, base)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN)), pa.array(found, pa.list_(_MENTION))], ["key", "base", "mentions"])


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _turn(edges: DataFrame, unknown: DataFrame, total: DataFrame, scored: DataFrame | None, support: int, confident: float) -> tuple[DataFrame, DataFrame]:
    """(patterns, instances) that hold, given the scores of the turn before."""
    known = edges.where("kind >= 0").select("pattern", "side", "instance", F.col("kind").alias("found_kind"), F.lit(1.0).alias("score"))
    if scored is not None:
        known = known.unionByName(unknown.join(_maybe_broadcast(scored), "instance").select("pattern", "side", "instance", "found_kind", "score"))
    patterns = known.groupBy("pattern", "side", "found_kind").agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("backed"))
    all_ = patterns.groupBy("pattern").agg(F.sum("backed").alias("of_a_kind"))
    patterns = patterns.where(F.col("backed") >= support).join(all_, "pattern").join(total, "pattern")
    weighed = F.col("of_a_kind") + UNKNOWN * F.greatest(F.col("instances") - F.col("of_a_kind"), F.lit(0))
    patterns = patterns.select("pattern", "side", "found_kind", F.least(F.col("mass") / weighed, F.lit(0.99)).alias("confidence"))
    patterns = common.materialize(patterns.where(F.col("confidence") >= confident), "pii-patterns")
    surest = unknown.join(_maybe_broadcast(patterns.drop("side")), "pattern").groupBy("instance", "found_kind", "side").agg(F.max("confidence").alias("c"))
    found = surest.groupBy("instance", "found_kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("score"))
    best = found.groupBy("instance").agg(F.max(F.struct("score", (-F.col("found_kind")).alias("k"))).alias("x"))
    return patterns, common.materialize(best.select("instance", (-F.col("x.k")).alias("found_kind"), F.col("x.score").alias("score")), "pii-scores")


def score_graph(edges: DataFrame, *, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """``edges`` (pattern, side, instance, kind; -1 unknown) to (instance, found_kind, score) of instances without a kind."""
    unknown = edges.where("kind < 0").select("pattern", "side", "instance")
    total = common.materialize(edges.groupBy("pattern").agg(F.count_distinct("instance").alias("instances")).where(F.col("instances") >= support), "pii-totals")
    scored, size = None, (-1, -1)
    while True:
        patterns, after = _turn(edges, unknown, total, scored, support, confident)
        now = (patterns.count(), after.count())
        common.discard(patterns, scored)
        scored = after
        # scores only go up from turn to turn, so what held goes on to hold
        if now == size or not now[0]:
            break
        size = now
    common.discard(total)
    return scored


def find(docs: DataFrame, *, key: str = "doc_id", text: str = "text", accept: float = ACCEPT, **options) -> DataFrame:
    """One row for each of ``docs``: ``key`` and ``spans`` (kind 0 to 7 as in KINDS, start, end), by kind and start."""
    common.small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("base", T._parse_datatype_string("array<struct<kind:int,start:bigint,end:bigint>>")), T.StructField("mentions", T._parse_datatype_string("array<struct<start:bigint,end:bigint,kind:int,patterns:array<bigint>,instance:bigint>>"))])
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spotted = common.materialize(chosen.mapInArrow(_spot, schema).withColumn("row", F.monotonically_increasing_id()), "pii-spotted")
    each = spotted.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    side = F.element_at(F.array(*map(F.lit, SIDES)), F.col("pos") + 1)
    pairs = each.select("instance", "kind", F.posexplode("patterns").alias("pos", "pattern")).select("pattern", side.alias("side"), "instance", "kind")
    edges = common.materialize(pairs.distinct(), "pii-edges")
    scored = score_graph(edges, **options)
    best = common.materialize(scored.where(F.col("score") >= accept).select("instance", "found_kind"), "pii-instances")
    common.discard(edges, scored)
    more = each.where("kind < 0").join(_maybe_broadcast(best), "instance").groupBy("row").agg(F.collect_list(F.struct((F.col("found_kind") + len(BASE)).cast("int").alias("kind"), "start", "end")).alias("more"))
    out = spotted.select("row", "key", "base").join(more, "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))))
    return out.select(F.col("key").alias(key), spans.alias("spans"))


def _listed(spans) -> F.Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(common.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE)), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def base_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 without what the contexts add, which SQL can't express."""
    return op6(spark, sf_dir).drop("spans")


def _sql_spans(name: str, kind: int, pattern: str, keep: str) -> str:
    """Matches of a pattern with their places, from the lengths of gaps and matches before them."""
    p = pattern.replace("'", "''")
    return f"""{name}1 AS (SELECT r, i, m[i] AS m, length(g[i]) + length(m[i]) AS step FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT r, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{p}')))),
{name}2 AS (SELECT r, m, regexp_replace(m, '[^0-9]', '', 'g') AS n, CAST(sum(step) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS e FROM {name}1),
{name} AS (SELECT r, {kind} AS kind, e - length(m) AS s, e FROM {name}2 WHERE {keep})"""


_LUHN = "list_sum(list_transform(range(0, len(n)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(n[len(n) - i] AS INT) ELSE (2 * CAST(n[len(n) - i] AS INT)) // 10 + (2 * CAST(n[len(n) - i] AS INT)) % 10 END)) % 10 = 0"
SQL = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
{_sql_spans("m", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")},
{_sql_spans("p", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 OR CAST('0' || right(ltrim(x, '0'), 3) AS INT) > 255)) = 0")},
{_sql_spans("c", 2, r"[0-9](?:[\x20-]?[0-9])+", f"len(n) BETWEEN 13 AND 19 AND {_LUHN}")},
{_sql_spans("f", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "len(n) BETWEEN 9 AND 15")},
x AS (SELECT * FROM m UNION ALL SELECT * FROM p UNION ALL SELECT * FROM c UNION ALL SELECT * FROM f),
y AS (SELECT r, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(BASE))}, string_agg(['email', 'ip', 'card', 'phone'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY kind, s) AS listed FROM x GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(listed, '')) AS base_sha256 FROM d LEFT JOIN y USING (r)"""
