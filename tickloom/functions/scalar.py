"""Column functions with the reference semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Values this close under a tie round up, so that engines with other decimal conversions agree.
NUDGE = 1e-9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column, digits: int) -> Column:
    """Rounded; what is below zero and rounds to it is -0.0, as in DuckDB."""
    near = c + F.lit(NUDGE)
    out = F.round(near, digits)
    return F.when((out == 0) & (near < 0), F.lit(-0.0)).otherwise(out)


def move(first: Column | str, last: Column | str) -> Column:
    """The relative change; null where the first value is zero."""
    return F.try_divide(_col(last) - _col(first), _col(first))


def bucket(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned window that holds ``ts``."""
    return F.timestamp_seconds(F.floor(F.unix_micros(_col(ts)) / 1_000_000 / seconds) * seconds)


def month(ts: Column | str) -> Column:
    """The month as ``yyyyMM``."""
    return F.date_format(_col(ts), "yyyyMM")


def ntz(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def epoch_ms(c: Column | str) -> Column:
    return F.unix_millis(_col(c))


def iso_utc(c: Column | str) -> Column:
    """ISO text with a UTC offset, to the millisecond."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def side_code(side: Column) -> Column:
    return F.when(side == "BUY", 1).when(side == "SELL", 2).otherwise(0)


def readable_size(n: Column) -> Column:
    """Bytes as text with a binary unit."""
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    step = F.least(F.floor(F.log2(F.greatest(n.cast("double"), F.lit(1.0))) / 10), F.lit(len(units) - 1)).cast("int")
    return F.concat(F.format_number(n / F.pow(F.lit(1024.0), step), 2), F.lit(" "), F.element_at(F.array(*map(F.lit, units)), step + 1))


def annotation(method: Column, score: Column) -> Column:
    return F.concat(method, F.lit(" "), F.round(score, 1).cast("string"), F.lit("σ"))


def uniform(seed: int, *on: Column | str) -> Column:
    """A number in (0, 1) that depends on the values alone: the same on every run, machine and partitioning."""
    h = F.xxhash64(F.lit(seed), *map(_col, on))
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(2.0**53)


def normal(seed: int, *on: Column | str) -> Column:
    """A standard normal number by the polar form of two uniform ones."""
    radius = F.sqrt(-2 * F.log(uniform(seed, F.lit("r"), *on)))
    return radius * F.cos(2 * F.pi() * uniform(seed, F.lit("a"), *on))


def poisson(rate: Column, seed: int, *on: Column | str, exact_below: float = 24.0) -> Column:
    """A Poisson number.  Small rates by inversion, summing probabilities up to 96; others by a normal number with the
    first correction for skewness."""
    u, z = uniform(seed, F.lit("p"), *on), normal(seed, F.lit("n"), *on)
    small = F.least(rate, F.lit(exact_below))
    zero = F.struct(F.exp(-small).alias("p"), F.exp(-small).alias("sum"), F.lit(0).alias("n"))

    def step(acc, k):
        p = acc["p"] * small / k
        return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), F.when(u > acc["sum"], k).otherwise(acc["n"]).alias("n"))

    inverse = F.aggregate(F.sequence(F.lit(1), F.lit(96)), zero, step, lambda acc: acc["n"])
    large = F.greatest(F.floor(rate + F.sqrt(rate) * z + (z * z - 1) / 6 + 0.5), F.lit(0))
    return F.when(rate < exact_below, inverse).otherwise(large).cast("bigint")
