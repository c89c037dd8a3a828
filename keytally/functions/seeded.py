"""Seeded, reproducible random draws as column expressions.

Every draw is a pure function of ``(seed, salt, key...)``: the first 13 hex digits of
``md5("seed|salt|key|...")`` read as a 52-bit unsigned integer. The same bits come out
of any engine with ``md5`` (DuckDB included), so generated tables can be checked
against SQL, regenerated after an executor loss, and split across any number of
tasks without coordination. Different ``salt`` strings give independent streams.

The reference draws with unseeded ``java.util.Random``; only its distributions
(ranges, weights, bound conventions) are reproduced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

U_BITS = 52
U_RANGE = 1 << U_BITS  # draws lie in [0, U_RANGE)
DEFAULT_SEED = 42


def _key_strings(keys: Sequence[Column | str | int]) -> list[Column]:
    out = []
    for k in keys:
        if isinstance(k, Column):
            out.append(k.cast("string"))
        elif isinstance(k, str):
            out.append(F.col(k).cast("string"))
        else:
            out.append(F.lit(str(k)))
    return out


def draw(seed: int, salt: str, *keys: Column | str | int) -> Column:
    """52-bit unsigned draw (bigint) for ``keys`` under ``(seed, salt)``."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *_key_strings(keys)))
    return F.conv(F.substring(digest, 1, U_BITS // 4), 16, 10).cast("bigint")


def unit_interval(seed: int, salt: str, *keys: Column | str | int) -> Column:
    """Uniform double in [0, 1) with 52 bits of resolution."""
    return draw(seed, salt, *keys).cast("double") / F.lit(float(U_RANGE))


def uniform_int(low: int, high: int, seed: int, salt: str, *keys: Column | str | int) -> Column:
    """Uniform integer in ``[low, high]`` — both ends inclusive (bigint)."""
    if high < low:
        raise ValueError(f"empty range [{low}, {high}]")
    return F.lit(low).cast("bigint") + draw(seed, salt, *keys) % F.lit(high - low + 1)


def weighted_choice(options: Sequence[tuple[object, int]], seed: int, salt: str,
                    *keys: Column | str | int) -> Column:
    """One of ``options`` (value, weight) with probability weight / total weight."""
    total = sum(w for _, w in options)
    if total <= 0 or any(w < 0 for _, w in options):
        raise ValueError("weights must be non-negative with a positive total")
    r = draw(seed, salt, *keys) % F.lit(total)
    expr = None
    bound = 0
    for value, weight in options:
        if weight == 0:
            continue
        bound += weight
        expr = (F.when(r < F.lit(bound), F.lit(value)) if expr is None
                else expr.when(r < F.lit(bound), F.lit(value)))
    return expr


def distinct_sample(low: int, high_exclusive: int, amount: Column | int, seed: int, salt: str,
                    *keys: Column | str | int) -> Column:
    """``amount`` distinct integers from ``[low, high_exclusive)``, ascending (array<bigint>).

    Each candidate gets its own draw; the ``amount`` smallest draws win (ties by value).
    This is a uniform sample without replacement, computed per row with no shuffle.
    Note the exclusive upper bound, unlike :func:`uniform_int`. Per-row cost is one
    draw per candidate, O(high_exclusive - low): meant for small id ranges such as
    the category range (19 candidates).
    """
    width = high_exclusive - low
    if width <= 0:
        raise ValueError(f"empty range [{low}, {high_exclusive})")
    if isinstance(amount, int):
        if amount > width:
            raise ValueError(f"cannot draw {amount} distinct values from {width}")
        amount = F.lit(amount)
    candidates = F.sequence(F.lit(low).cast("bigint"), F.lit(high_exclusive - 1).cast("bigint"))
    scored = F.transform(candidates, lambda x: F.struct(draw(seed, salt, *keys, x).alias("h"),
                                                        x.alias("x")))
    # More distinct values than the range holds cannot be drawn: fail the row loudly.
    take = F.when(amount.cast("int") <= F.lit(width), amount.cast("int")).otherwise(
        F.raise_error(F.lit(f"distinct_sample: amount exceeds the {width} values of the range")))
    chosen = F.slice(F.array_sort(scored), 1, take)
    return F.array_sort(F.transform(chosen, lambda s: s["x"]))


def sample_of_range(low: int, high_exclusive: int, amount: Column | int, seed: int, salt: str,
                    *keys: Column | str | int) -> Column:
    """``amount`` distinct integers from ``[low, high_exclusive)``, ascending (array<bigint>), for ranges of any size.

    Floyd's sampling: for ``j`` from ``width - amount`` on, a draw from ``[0, j]``, or ``j`` itself if
    the draw was taken before. Every subset is equally likely; the cost goes by the amount, not by
    the range. Null amounts give null; an amount beyond the range fails the row.
    """
    width = high_exclusive - low
    if not 0 < width <= U_RANGE:
        raise ValueError(f"range [{low}, {high_exclusive}) must hold 1 to 2**{U_BITS} values")
    if isinstance(amount, int):
        if amount > width:
            raise ValueError(f"cannot draw {amount} distinct values from {width}")
        amount = F.lit(amount)
    amount = amount.cast("bigint")
    steps = (F.when(amount > width, F.raise_error(F.lit(f"sample_of_range: amount exceeds the {width} values of the range")).cast("array<bigint>"))
             .when(amount > 0, F.sequence(F.lit(width) - amount, F.lit(width - 1).cast("bigint")))
             .when(amount.isNotNull(), F.array().cast("array<bigint>")))

    def take(chosen: Column, j: Column) -> Column:
        t = draw(seed, salt, *keys, j) % (j + F.lit(1))
        return F.concat(chosen, F.array(F.when(F.array_contains(chosen, t), j).otherwise(t)))

    chosen = F.aggregate(steps, F.array().cast("array<bigint>"), take)
    return F.array_sort(F.transform(chosen, lambda x: x + F.lit(low)))


def repeat_sample(low: int, high_exclusive: int, amount: Column | int, seed: int, salt: str,
                  *keys: Column | str | int) -> Column:
    """``amount`` integers from ``[low, high_exclusive)`` with repeats, in draw order."""
    width = high_exclusive - low
    if width <= 0:
        raise ValueError(f"empty range [{low}, {high_exclusive})")
    if isinstance(amount, int):
        amount = F.lit(amount)
    return F.transform(F.sequence(F.lit(1).cast("bigint"), amount.cast("bigint")),
                       lambda i: F.lit(low).cast("bigint") + draw(seed, salt, *keys, i) % F.lit(width))


def join_ids(ids: Column, delimiter: str = ",") -> Column:
    """Delimited string of an id array (``mkString``)."""
    return F.array_join(ids.cast("array<string>"), delimiter)


def uuid_like(seed: int, salt: str, *keys: Column | str | int) -> Column:
    """Deterministic 8-4-4-4-12 hex identifier."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *_key_strings(keys)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
                       F.substring(digest, 13, 4), F.substring(digest, 17, 4),
                       F.substring(digest, 21, 12))


def geometric_length(continue_probability: float, seed: int, salt: str,
                     *keys: Column | str | int) -> Column:
    """Number of successes before the first failure, P(L >= l) = p**l (int).

    ``floor(ln(1 - U) / ln(p))`` with U uniform in [0, 1). With 52-bit draws the
    largest possible value is ``floor(-52 ln 2 / ln p)`` (342 for p = 0.9), so the
    expansion of one key is bounded.
    """
    if not 0.0 < continue_probability < 1.0:
        raise ValueError("continue probability must lie in (0, 1)")
    log_p = math.log(continue_probability)
    return F.floor(F.log(F.lit(1.0) - unit_interval(seed, salt, *keys)) / F.lit(log_p)).cast("int")


def max_geometric_length(continue_probability: float) -> int:
    return math.floor(-U_BITS * math.log(2.0) / math.log(continue_probability))
