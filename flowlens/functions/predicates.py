"""Row predicates, flags and bands. All are plain expressions that stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens import conventions as K

INF = float("inf")


def is_finite(col: Column) -> Column:
    """True for ordinary numbers. NaN sorts above +Inf in Spark, so two comparisons are enough."""
    return (col > F.lit(-INF)) & (col < F.lit(INF))


def all_finite(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [is_finite(F.col(c)) for c in cols], F.lit(True))


def all_values(cols: Iterable[str]) -> Column:
    """Neither NULL nor NaN in any of the columns; infinities are values."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in cols], F.lit(True))


def infinity_as_nan(col: Column) -> Column:
    return F.when(col.isin(INF, -INF), F.lit(float("nan"))).otherwise(col)


def binary_label(col: Column, benign) -> Column:
    """0 for the benign class, 1 for everything else, a missing class included."""
    return F.when(col == F.lit(benign), 0).otherwise(1)


def flag_anomaly(score: Column, threshold: float) -> Column:
    """1 above the threshold, else 0. A NULL score gives NULL; a NaN score is an anomaly."""
    return (score > F.lit(float(threshold))).cast("int")


def matches_any(col: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive substring test against several patterns."""
    low = F.lower(col)
    return reduce(lambda a, b: a | b, [low.contains(p.lower()) for p in patterns], F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0.0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def rate_band(rate: Column, warn: float = 10.0, high: float = 30.0) -> Column:
    return F.when(rate < F.lit(warn), "ok").when(rate < F.lit(high), "warn").otherwise("high")


def value_band(value: Column, low: float, high: float) -> Column:
    return F.when(value <= F.lit(low), "ok").when(value >= F.lit(high), "bad").otherwise("warn")


def ratio_band(value: Column, good: float = 1.2, fair: float = 1.0) -> Column:
    return F.when(value >= F.lit(good), "ok").when(value >= F.lit(fair), "warn").otherwise("bad")


def throughput_ratio(in_rate: Column, out_rate: Column) -> Column:
    return ratio(out_rate, in_rate)


def sla_status(latency_ms: Column, ratio_: Column, states=K.SLA_STATES) -> Column:
    """The first state, from the worst down, whose latency or throughput limit is broken."""
    checks = [((latency_ms > F.lit(late)) | (ratio_ < F.lit(slow)), name) for name, late, slow in states]
    return reduce(
        lambda worse, check: F.when(check[0], check[1]).otherwise(worse), reversed(checks), F.lit("OK")
    )


def weekday_token(text: Column, days: Iterable[str] = tuple(K.SPLIT_BY_DAY)) -> Column:
    """The first weekday, in the given order of days, that occurs in the text; NULL if none does."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.contains(day), F.lit(day)) for day in days])


def mapped(col: Column, mapping: Mapping[str, str]) -> Column:
    """Value lookup in a small literal map; NULL for other values."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def levels_below(col: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending ``cuts`` are strictly below the value, by binary decisions."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col > F.lit(float(cuts[mid])), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(cuts))
