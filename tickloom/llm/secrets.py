"""Secret scan with a randomness test battery, in DataFrame functions only.

Known shapes (assignments, access keys, long hex) are found by patterns.  Beyond those, every other run of
``[A-Za-z0-9+/_=-]`` of at least ``least`` characters is put to three tests under the hypothesis that it is ordinary
text in its inferred encoding (hex, base32 or base64):

* chi-squared of its characters against a uniform alphabet: ordinary text, whose characters repeat with an index of
  coincidence of ``COINCIDENCE``, lies far above what a random token shows;
* runs of character classes: ordinary text changes its class seldom;
* correlation of neighbouring codes: ordinary and sequential text is correlated, random text is not.

The three scores are summed by Stouffer's method to a ``z``.  The null's place and spread are then read off the corpus: in
each stratum of one encoding and about the same length (powers of two), from the lower quantiles of ``z``, where ordinary runs stand even if
up to three quarters are secrets; few runs leave them near the theoretical 0 and 1 (as many as ``PRIOR`` runs speak for
that).  Benjamini and Hochberg's procedure over each stratum's p-values settles what counts as a discovery.

The texts are read once: what was found is written, without the texts where the caller doesn't need them, and judged when
the thresholds are known.  Places come from the lengths of gaps and matches by running sums in blocks, so that a
text's cost grows with the number of its matches, not with its square.  Spans are in code points, the end exclusive.

Defined cases: null and empty texts hold no secrets; rows are judged one by one, so repeated ids do not matter; other
columns are carried untouched, and a new column whose name is taken gets an underscore; without any candidates no threshold
exists and nothing is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common
from .decontaminate import remove_spans

#: The known shapes; a value of an assignment has 12 characters, an access key 18.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: The runs of ``[0-9a-f]+`` are maximal, so the length can stand in the pattern.
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
#: Chance that two characters of ordinary text agree (English, case folded).
COINCIDENCE = 0.065
#: Ordinary text's share of steps between character classes, and its correlation of neighbouring codes.
CLASS_STEPS, CORRELATION = 0.1, 0.4
#: ``z`` is counted in steps of 1 / ``STEPS``, between these bounds.
STEPS, LOWEST, HIGHEST = 20, -40, 80
PRIOR = 100
#: Values in a block of a running sum.
BLOCK = 512
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
_PLACED = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, which is computed once however often ``f`` names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _scanned(x: Column, best: Callable[[Column, Column], Column]) -> Column:
    """Running ``best`` (a sum, a maximum, ...) of an array of longs, in blocks of blocks of ``BLOCK``: a step copies no more
    than a block, so ``n`` values cost ``n * BLOCK / 2`` copies, not ``n * n / 2``."""

    def short(values: Column) -> Column:
        last = lambda acc, v: F.when(F.size(acc) > 0, best(F.get(acc, F.size(acc) - 1), v)).otherwise(v)
        return F.aggregate(values, F.array().cast("array<bigint>"), lambda acc, v: F.concat(acc, F.array(last(acc, v))).cast("array<bigint>"))

    def blocks(values: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda i: short(F.slice(values, i * BLOCK + 1, F.lit(BLOCK))))

    def joined(parts: Column, before: Column) -> Column:
        """The parts in a row, each on top of what its forerunners come to."""
        return F.flatten(F.transform(parts, lambda p, i: F.when(i > 0, F.transform(p, lambda v: best(F.get(before, i - 1), v))).otherwise(p)))

    ends = lambda parts: F.transform(parts, lambda p: F.element_at(p, -1))
    upper = lambda parts: _let(blocks(ends(parts)), lambda over: _let(short(ends(over)), lambda o: joined(over, o)))
    return F.when(F.size(x) > 0, _let(x, lambda v: _let(blocks(v), lambda parts: F.when(F.size(parts) > 1, _let(upper(parts), lambda before: joined(parts, before))).otherwise(F.flatten(parts))))).otherwise(F.array().cast("array<bigint>"))


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _placed(text: Column, matches: Column, values: Column, pattern: str, kind: int) -> Column:
    """The matches as spans, each with its value of ``values``.  Lambdas name no column but what is zipped into them: Spark
    may put a column's whole expression in its place, to be computed for each element."""

    def place(gaps: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
        found = F.arrays_zip(_scanned(steps, lambda a, b: a + b).alias("end"), matches.alias("m"), values.alias("v"))
        return F.transform(found, lambda x: F.struct((x["end"] - F.length(x["m"])).alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["v"].alias("value")))

    return F.when(F.size(matches) > 0, _let(F.split(text, pattern, -1), place)).otherwise(F.array().cast(_PLACED)).cast(_PLACED)


def _found(text: Column, matches: Column, values: Column, pattern: str, kind: int, least: int) -> Column:
    """The spans of the matches whose value has ``least`` characters."""
    spans = F.filter(_placed(text, matches, values, pattern, kind), lambda s: F.length(s["value"]) >= least)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(_SPAN)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the spans of the known shapes, by start and kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    m = {k: common.free_name(df, f"_m_{k}") for k in KINDS[:3]}
    df = df.withColumns({m[k]: _matches(t, p) for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX))})
    values = common.free_name(df, "_m_values")
    df = df.withColumn(values, F.when(F.size(m["assign"]) > 0, _matches(t, ASSIGN, 2)))
    own = {k: F.col(m[k]) for k in m}
    spans = [_found(t, own["assign"], F.col(values), ASSIGN, 0, 12), _found(t, own["access"], own["access"], ACCESS, 1, 18), _found(t, own["hex"], own["hex"], HEX, 2, 16)]
    return df.withColumn(out, F.array_sort(F.concat(*spans))).drop(*m.values(), values)


def _alphabet(run: Column) -> Column:
    """The inferred encoding: 0 hex, 1 base32, 2 base64."""
    return F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)=*$"), 0).when(run.rlike("^[A-Z2-7]+=*$"), 1).otherwise(2)


def randomness(run: Column) -> Column:
    """The battery's ``z`` of a run, in steps: large where it is too random for ordinary text.  Null, which counts for
    nothing, under 16 characters and where a run encodes plain text in base64 or hex."""

    def judge(token: Column) -> Column:
        n = F.length(token).cast("double")
        is_hex, k = _alphabet(token) == 0, F.element_at(F.array(*map(F.lit, (16.0, 32.0, 64.0))), _alphabet(token) + 1)
        chars = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.when(c == "-", "+").when(c == "_", "/").otherwise(c))
        return F.when((n >= 16) & ~_plain(token, is_hex), _let(chars, lambda c: tests(c, n, k)))

    def tests(chars: Column, n: Column, k: Column) -> Column:
        # at most 64 characters are distinct
        same = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow(F.size(F.filter(chars, lambda x: x == c)).cast("double"), F.lit(2.0)))
        chi = k / n * same - n
        excess = F.greatest(k * COINCIDENCE - 1, F.lit(0.6))
        z_chi = (k - 1 + n * excess - chi) / F.sqrt(2 * (k - 1) + 4 * n * excess)
        kinds = F.transform(chars, lambda c: F.when(c.between("a", "z"), 0).when(c.between("A", "Z"), 1).when(c.between("0", "9"), 2).otherwise(3))
        steps = F.aggregate(kinds, F.struct(F.lit(-1).alias("last"), F.lit(-1.0).alias("n")), lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.when(x != acc["last"], 1.0).otherwise(0.0)).alias("n")), lambda acc: acc["n"])
        z_runs = (steps - CLASS_STEPS * (n - 1)) / F.sqrt(CLASS_STEPS * (1 - CLASS_STEPS) * (n - 1))
        # sums of codes, of their squares and of products of neighbours give the serial correlation
        zero = F.struct(*(F.lit(0.0).alias(x) for x in ("a", "b", "c", "last", "first")), F.lit(0).alias("i"))
        add = lambda acc, x: F.struct((acc["a"] + x).alias("a"), (acc["b"] + x * x).alias("b"), (acc["c"] + acc["last"] * x).alias("c"), x.alias("last"), F.when(acc["i"] == 0, x).otherwise(acc["first"]).alias("first"), (acc["i"] + 1).alias("i"))

        def serial(acc: Column) -> Column:
            mean = acc["a"] / n
            cov = acc["c"] - mean * (2 * acc["a"] - acc["first"] - acc["last"]) + (n - 1) * mean * mean
            var = acc["b"] - n * mean * mean
            return F.when(var > 1e-9, cov / var).otherwise(1.0)

        z_serial = (CORRELATION - F.abs(F.aggregate(F.transform(chars, lambda c: F.ascii(c).cast("double")), zero, add, serial))) * F.sqrt(n)
        z = (z_chi + z_runs + z_serial) / math.sqrt(3)
        return F.floor(F.greatest(F.lit(float(LOWEST)), F.least(F.lit(float(HIGHEST)), z)) * STEPS).cast("int")

    return _let(F.regexp_replace(run, "=+$", ""), judge)


def _plain(token: Column, is_hex: Column) -> Column:
    """Whether the token encodes printable text.  (Of random bytes one in 2.6 is printable.)"""
    standard = F.translate(token, "-_", "+/")
    whole = F.concat(standard, F.repeat(F.lit("="), F.pmod(-F.length(token), F.lit(4))))
    text = F.when(is_hex & (F.length(token) % 2 == 0), F.unhex(token)).otherwise(F.try_to_binary(whole, F.lit("base64")))
    return F.coalesce(text.cast("string").rlike(r"^[\x20-\x7E\t\r\n]+$"), F.lit(False))


def candidate_spans(df: DataFrame, text: str, base: str, out: str, least: int) -> DataFrame:
    """Adds the runs that touch no known shape, with the stratum of their length and the step of their ``z``."""
    pattern = f"[A-Za-z0-9+/_=-]{{{least},}}"
    t = F.coalesce(F.col(text), F.lit(""))
    m = common.free_name(df, "_m_runs")
    df = df.withColumn(m, _matches(t, pattern))
    runs = _placed(t, F.col(m), F.col(m), pattern, 3)
    known = F.transform(F.col(base), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("string").alias("value")))

    def free(all_: Column) -> Column:
        """Of all spans by start, the runs that no span of a known shape reaches into."""
        ends = _scanned(F.transform(all_, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(-1).cast("bigint")), _larger)
        nexts = F.reverse(_scanned(F.reverse(F.transform(all_, lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(2**62).cast("bigint"))), _smaller))
        near = F.arrays_zip(all_.alias("s"), ends.alias("before"), nexts.alias("after"))
        return F.transform(F.filter(near, lambda x: (x["s"]["kind"] == 3) & (x["before"] <= x["s"]["start"]) & (x["after"] >= x["s"]["end"])), lambda x: x["s"])

    open_ = F.when(F.size(F.col(base)) > 0, _let(F.array_sort(F.concat(runs, known)), free)).otherwise(runs)
    judged = F.transform(open_, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), (F.floor(F.log2((s["end"] - s["start"]).cast("double"))) * 3 + _alphabet(s["value"])).cast("int").alias("stratum"), randomness(s["value"]).alias("step")))
    kind = "array<struct<start:bigint,kind:int,end:bigint,stratum:int,step:int>>"
    return df.withColumn(out, F.when(F.size(m) > 0, judged).otherwise(F.array().cast(kind)).cast(kind)).drop(m)


def _tail(z: float) -> float:
    """Chance that a standard normal number is larger."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def calibrated(counts: list[tuple[int, int]]) -> tuple[float, float]:
    """Place and spread of the null from a histogram of ``z`` (step, count): the quantiles at 5 % and 25 %, shrunk towards
    0 and 1 by ``PRIOR`` runs.  The spread is 1 at least."""
    total, seen, at = sum(c for _, c in counts), 0, {}
    for step, count in sorted(counts):
        seen += count
        for q in (0.05, 0.25):
            if q not in at and seen >= q * total:
                at[q] = (step + 0.5) / STEPS
    spread = max(1.0, (at[0.25] - at[0.05]) / (1.6449 - 0.6745))
    place = at[0.25] + 0.6745 * spread
    weight = total / (total + PRIOR)
    return weight * place, math.sqrt(weight * spread**2 + 1 - weight)


def discoveries(candidates: DataFrame, rate: float) -> dict[int, int]:
    """The least step that counts in each stratum: Benjamini and Hochberg over the histogram of steps.

    At most 96 strata of ``(HIGHEST - LOWEST) * STEPS`` steps come to the driver, whatever the corpus.
    """
    rows = candidates.where("step IS NOT NULL").groupBy("stratum", "step").count().collect()
    out = {}
    for stratum in {r["stratum"] for r in rows}:
        own = sorted(((r["step"], r["count"]) for r in rows if r["stratum"] == stratum), reverse=True)
        place, spread = calibrated(own)
        total, above = sum(c for _, c in own), 0
        for step, count in own:
            above += count
            if _tail((step / STEPS - place) / spread) <= rate * above / total:
                out[stratum] = step
    return out


def scan(docs: DataFrame, *, text: str = "text", least: int = 20, rate: float = 0.001, out: str = "secrets", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) with ``out``: the spans (start, kind 0 to 3 as in KINDS, end) of all
    secrets, by start and kind."""
    out = common.free_name(docs, out)
    base, runs = common.free_name(docs, "_base"), common.free_name(docs, "_runs")
    found = candidate_spans(base_spans(docs, text, base), text, base, runs, least)
    found = common.materialize(found if keep_text else found.drop(text), "secrets-found")
    limits = discoveries(found.select(F.explode(runs).alias("c")).select("c.stratum", "c.step"), rate)
    if not limits:
        return found.withColumn(out, F.col(base)).drop(base, runs)
    limit = F.create_map(*(F.lit(x) for kv in sorted(limits.items()) for x in kv))
    random = F.filter(F.col(runs), lambda s: F.coalesce(s["step"] >= F.try_element_at(limit, s["stratum"]), F.lit(False)))
    random = F.transform(random, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.withColumn(out, F.array_sort(F.concat(F.col(base), random))).drop(base, runs)


def merged(spans: Column) -> Column:
    """Spans by start as disjoint spans."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def join(ends: Column) -> Column:
        """``ends``: the largest end so far.  A span that starts beyond all before it opens a new one."""
        near = F.transform(F.arrays_zip(spans.alias("s"), ends.alias("end")), lambda x, i: F.struct(x["s"]["start"].alias("start"), F.when(i > 0, F.get(ends, i - 1)).alias("before")))
        opens = F.filter(near, lambda x: x["before"].isNull() | (x["start"] > x["before"]))
        closes = F.concat(F.transform(F.slice(opens, 2, F.size(opens)), lambda x: x["before"]), F.array(F.element_at(ends, -1)))
        return F.transform(F.arrays_zip(opens.alias("o"), closes.alias("end")), lambda x: F.struct(x["o"]["start"].alias("start"), x["end"].alias("end"))).cast(kind)

    ends = _scanned(F.transform(spans, lambda s: s["end"]), _larger)
    return F.when(F.size(spans) > 0, _let(ends, join)).otherwise(F.array().cast(kind))


def redact(docs: DataFrame, *, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; other columns as they were."""
    found = common.free_name(docs, "_secrets")
    df = scan(docs, text=text, out=found)
    cut = common.free_name(df, "_cut")
    return remove_spans(df.withColumn(cut, merged(F.col(found))), cut, text, mark).select(docs.columns)


def _listed(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))


def base_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8 without what the battery adds, which SQL can't express."""
    return op8(spark, sf_dir).drop("spans")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced, and n_chars follows the text."""
    out = redact(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(docs.columns) if "n_chars" in docs.columns else out


def _sql_spans(name: str, kind: int, pattern: str, least: str) -> str:
    """Matches of a pattern with their places, from the lengths of gaps and matches before them."""
    p = pattern.replace("'", "''")
    return f"""{name}0 AS (SELECT r, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}', {2 if kind == 0 else 0}) AS v FROM d WHERE regexp_matches(t, '{p}')),
{name}1 AS (SELECT r, i, m[i] AS m, v[i] AS v, length(g[i]) + length(m[i]) AS step FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {name}0)),
{name} AS (SELECT r, {kind} AS kind, e - length(m) AS s, e FROM (SELECT *, CAST(sum(step) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS e FROM {name}1) WHERE {least})"""


SQL = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
{_sql_spans("a", 0, ASSIGN, "length(v) >= 12")},
{_sql_spans("k", 1, ACCESS, "length(m) >= 18")},
{_sql_spans("h", 2, HEX, "true")},
x AS (SELECT * FROM a UNION ALL SELECT * FROM k UNION ALL SELECT * FROM h),
y AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS listed FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(listed, '')) AS base_sha256 FROM d LEFT JOIN y USING (r)"""
