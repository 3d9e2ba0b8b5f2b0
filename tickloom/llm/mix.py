"""Mixing sources to target weights by Pareto order sampling.

A source's target in words is split into whole copies that every document gets for certain and a remainder.  The
remainder is filled by order sampling: each document draws a number ``u`` from its key and text, is ranked by its random
odds ``u / (1 - u)`` over its inclusion odds ``p / (1 - p)``, and the head of that order is taken until its words reach the
remainder (the document at the border is taken when that comes nearer).  ``p`` is the document's ``weight`` (by default
the fourth root of its words, so that of a source the fuller documents come in first) times the source's rate, which
makes the expected words those of the remainder.

Texts are read once: sizes and draws are written beside the documents.  Only numbers are shuffled.  The border of each
source is found by two histograms of 4,096 bins and, inside one bin of the second, by a sum over distinct ranks: a source
with a third of all rows costs the same as any other, and no source is sorted.  Sources are numbered by ranges, and the
level up to which they share is found by resharing until none is above its limit, in sums over all sources.  The result
depends on keys and texts alone, so reruns agree.

Defined cases: null and empty texts have no words, and take none; a null source is a source of its own, last; rows with
the same key and the same text draw the same number and are taken or left together; a weight that is null or not above
zero is 0, and such a document comes last; other columns are carried untouched, and a new column whose name is taken gets
an underscore (``names``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from . import common

BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"
#: A plan of at most so many sources is broadcast (under 10 MB); a larger one is joined by a shuffle.
BROADCAST_SOURCES = 50_000
OUT = ("size", "source_size", "target", "copies", "taken")


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(WORD), F.lit(0))).cast("bigint"), F.lit(0).cast("bigint"))


def draw(key: Column, text: Column) -> Column:
    """A number in (0, 1) from the digest of key and text."""
    value = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    head = F.conv(F.substring(F.md5(value), 1, 13), 16, 10).cast("bigint")
    return (head.cast("double") + 0.5) / F.lit(2.0**52)


def bounded(plan: DataFrame) -> DataFrame:
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size) with target: ``share`` of all words by weight, at most ``most`` times the source.

    What sources at their limit leave is shared anew by weight among the others, until none is above; each turn sets at
    least one more source to its limit, and is one sum over the sources.
    """
    own = common.numbered(sizes, "source", "position").withColumn("weight", F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("position") % len(weights) + 1).cast("int")))
    own = common.materialize(own.withColumn("cap", F.col("source_size") * F.lit(float(most))).drop("position"), "mix-weights")
    total = (own.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    full, seen = F.lit(False), -1
    while True:
        n, capped, rest = own.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        level = (total - capped) / rest if rest else 0.0
        if n == seen:
            break
        seen, full = n, full | (F.col("cap") / F.col("weight") <= F.lit(level))
    return own.withColumn("target", F.when(full, F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.lit(level)))).select("source", "source_size", "target")


def plan_sources(rows: DataFrame, weights, share, most) -> DataFrame:
    """One row for each source: target, whole copies, remainder, and the rate that makes weights inclusion odds."""
    sizes = common.materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") * F.col("weight")).cast("decimal(28,6)")).cast("double").alias("mass")), "mix-totals")
    t = targets(sizes.drop("mass"), weights, share, most)
    t = t.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint"))
    t = t.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    t = t.join(sizes.select(F.col("source").alias("_s"), "mass"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    t = t.withColumn("rate", F.when(F.col("mass") > 0, F.col("rest") / F.col("mass")).otherwise(0.0)).drop("mass")
    out = common.materialize(t, "mix-plan")
    common.discard(sizes)
    return out


def rank(weight: Column, rate: Column, u: Column) -> Column:
    """The Pareto rank as a number in [0, 1]: random odds over inclusion odds, q, as q / (1 + q)."""
    p = F.least(rate * weight, F.lit(1.0))
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p <= 0, F.lit(1.0)).when(p >= 1, F.lit(0.0)).otherwise(q / (1 + q))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``border``: documents ranked under it are taken once more."""
    ranked = rows.join(bounded(plan), rows["source"].eqNullSafe(plan["source"])).select(plan["source"], "size", "rest", rank(F.col("weight"), F.col("rate"), F.col("u")).alias("v")).where((F.col("rest") > 0) & (F.col("size") > 0))
    width, state = 1.0, plan.select("source", "rest", F.lit(0.0).alias("low"), F.lit(0.0).alias("done"))
    made = []
    for k in range(2):
        width /= BINS
        s = state.select(F.col("source").alias("_s"), "low", "done")
        inside = ranked.join(bounded(s), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        slot = F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(BINS - 1))
        inside = inside.where((F.col("v") >= F.col("low")) & (F.col("v") - F.col("low") < width * BINS * (2 if k == 0 else 1)))
        bins = inside.groupBy("source", "rest", "low", "done", slot.alias("slot")).agg(F.sum("size").alias("words"))
        run = F.col("done") + F.sum("words").over(W.partitionBy("source").orderBy("slot"))
        # the first bin that reaches the remainder; where none does, the last
        state = bins.withColumn("run", run).withColumn("over", F.col("run") >= F.col("rest"))
        state = state.groupBy("source", "rest").agg(F.min(F.struct(~F.col("over"), F.when(F.col("over"), F.col("slot")).otherwise(-F.col("slot")).alias("k"), F.col("low"), (F.col("run") - F.col("words")).alias("done"))).alias("x"))
        state = state.select("source", "rest", (F.col("x.low") + F.abs(F.col("x.k")) * width).alias("low"), F.col("x.done").alias("done"))
        state = common.materialize(state, "mix-bins")
        made.append(state)
    s = state.select(F.col("source").alias("_s"), "low", "done")
    close = ranked.join(bounded(s), F.col("source").eqNullSafe(F.col("_s"))).drop("_s").where((F.col("v") >= F.col("low")) & (F.col("v") < F.col("low") + width * 2))
    close = close.groupBy("source", "rest", "done", "v").agg(F.sum("size").alias("size"))
    before = F.col("done") + F.sum("size").over(W.partitionBy("source").orderBy("v")) - F.col("size")
    border = close.withColumn("stop", before + F.col("size") / 2 > F.col("rest")).groupBy("source", "rest").agg(F.min(F.when(F.col("stop"), F.col("v"))).alias("border"), F.max("v").alias("last"))
    # none stops: all inside the bin are taken, and the next after it are not
    border = border.select(F.col("source").alias("_s"), F.coalesce(F.col("border"), F.col("last") + 1e-15).alias("border"))
    out = plan.join(border, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    out = common.materialize(out.withColumn("border", F.coalesce("border", F.lit(0.0))), "mix-borders")
    common.discard(*made)
    return out


def names(docs: DataFrame, prefix: str = "") -> dict[str, str]:
    """What the new columns are called beside those of ``docs``."""
    return common.out_names(docs, OUT, prefix)


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, prefix: str = "", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) with size, source_size, target, copies (0 to ``most``) and taken =
    copies * size, under ``names``; a text stays whole.  ``weight`` names a column of weights."""
    new = names(docs, prefix)
    size, w, u = new["size"], common.free_name(docs, "_mix_weight"), common.free_name(docs, "_mix_u")
    own = F.col(weight).cast("double") if weight else F.sqrt(F.sqrt(F.col(size).cast("double")))
    rows = docs.withColumns({size: n_words(text), u: draw(F.col(key), F.col(text))}).withColumn(w, F.when(own > 0, own).otherwise(0.0))
    rows = common.materialize(rows if keep_text else rows.drop(text), "mix-rows")
    numbers = rows.select(F.col(source).alias("source"), F.col(size).alias("size"), F.col(w).alias("weight"), F.col(u).alias("u"))
    plan = plan_sources(numbers, weights, share, most)
    borders = thresholds(numbers, plan)
    common.discard(plan)
    m = {k: common.free_name(rows, f"_mix_{k}") for k in ("source", "copies", "rate", "border")}
    p = borders.select(F.col("source").alias(m["source"]), F.col("source_size").alias(new["source_size"]), F.col("target").alias(new["target"]), *(F.col(k).alias(m[k]) for k in ("copies", "rate", "border")))
    out = rows.join(bounded(p), F.col(source).eqNullSafe(F.col(m["source"])), "left")
    more = F.coalesce(rank(F.col(w), F.col(m["rate"]), F.col(u)) < F.col(m["border"]), F.lit(False)).cast("bigint")
    out = out.withColumn(new["copies"], F.col(m["copies"]) + more).withColumn(new["taken"], F.col(new["copies"]) * F.col(size))
    kept = docs.columns if keep_text else [c for c in docs.columns if c != text]
    return out.select(*kept, *(new[k] for k in OUT))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often."""
    new = names(docs, "mix_")
    return mix(docs, prefix="mix_").where(F.col(new["copies"]) > 0)


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(CAST(size * sqrt(sqrt(CAST(size AS DOUBLE))) AS DECIMAL(28,6))) AS DOUBLE) AS mass, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w FROM d GROUP BY source),
l AS (SELECT *, source_size * 2::DOUBLE AS cap, source_size * 2::DOUBLE / w AS r, (sum(source_size) OVER ()) * 1.5::DOUBLE AS total FROM s),
m AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM l),
t AS (SELECT *, CASE WHEN r <= lev THEN cap ELSE least(cap, w * (SELECT arg_min(lev, r) FROM m AS x WHERE x.r > x.lev)) END AS target FROM m),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM t),
q AS (SELECT *, target - copies * source_size AS rest, CASE WHEN mass > 0 THEN (target - copies * source_size) / mass ELSE 0 END AS rate FROM p),
k AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.copies, q.rest, q.source, u, least(rate * sqrt(sqrt(CAST(size AS DOUBLE))), 1) AS p FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
v AS (SELECT *, CASE WHEN p <= 0 THEN 1 WHEN p >= 1 THEN 0 ELSE (((u / (1 - u)) / (p / (1 - p))) / (1 + ((u / (1 - u)) / (p / (1 - p))))) END AS v FROM k),
g AS (SELECT source, v, rest, sum(size) AS size FROM v WHERE size > 0 AND rest > 0 GROUP BY source, v, rest),
c AS (SELECT source, v, (sum(size) OVER (PARTITION BY source ORDER BY v)) - size + size / 2::DOUBLE > rest AS stop FROM g),
b AS (SELECT source, coalesce(min(CASE WHEN stop THEN v END), max(v) + 1e-15) AS border FROM c GROUP BY source)
SELECT doc_id, size, source_size, target, CAST(size * (copies + CASE WHEN v < coalesce(border, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM v LEFT JOIN b ON v.source IS NOT DISTINCT FROM b.source
"""
