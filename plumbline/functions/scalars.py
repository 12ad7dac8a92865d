"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 15 hex digits of an md5 fit a signed 64-bit integer: values lie in [0, 2**60).
DIGEST_HEX, DIGEST_BITS = 15, 60
SPLIT_HEX, SPLIT_BUCKETS = 8, 10_000

# Prime moduli just below 2**31 and a multiplier for each: products stay below 2**62.
TIE_FIELDS = ((2147483647, 742938285), (2147483629, 950706376))
TIE_BITS = 62


def _md5_number(keys: Sequence[str], salt: Sequence[str], digits: int) -> Column:
    """First digits of an md5 over length-marked values, so that no two key tuples share a text."""
    values = [F.col(k).cast("string") for k in keys]
    marked = [F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in values]
    text = F.concat(*marked, *[F.lit(f"|{s}") for s in salt])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """Random-like 60-bit number of a row's keys, from md5. Costs a few microseconds per row."""
    return _md5_number(keys, [str(seed)], DIGEST_HEX)


def tie_number(df: DataFrame, keys: Sequence[str], seed: int = 0, content: Sequence[str] = ()) -> Column:
    """Evenly spread 62-bit number of a row's keys; the tie-break of every ranking.

    It spreads one very frequent score over the whole number range, which a raw key
    would not do. Plain 64-bit arithmetic, so it costs little per row and any SQL
    engine can repeat it: per prime p, fold h = (h * a + key) mod p over the keys and
    multiply by a once more. Keys that are not integers enter through md5. A missing key
    is replaced by a hash of the ``content`` columns, so that rows without keys spread too.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = [
        F.col(k).cast("bigint") if isinstance(kinds[k], T.IntegralType) else _md5_number([k], [], DIGEST_HEX)
        for k in keys
    ]
    missing = F.xxhash64(*content) if content else F.lit(-1)
    halves = []
    for prime, factor in TIE_FIELDS:
        h = F.lit((seed + 1) % prime).cast("bigint")
        for number in numbers:
            h = (h * factor + F.pmod(F.coalesce(number, missing), F.lit(prime))) % prime
        halves.append((h * factor) % prime)
    return F.shiftleft(halves[0], 31) + halves[1]


def split_bucket(keys: Sequence[str], seed: int) -> Column:
    """Bucket in [0, 10000) that depends on nothing but the keys and the seed."""
    return _md5_number(keys, [str(seed)], SPLIT_HEX) % SPLIT_BUCKETS


def sortable_score(score: str) -> Column:
    """Score with a place in the order for every row: null lowest, NaN highest."""
    value = F.nanvl(F.col(score).cast("double"), F.lit(float("inf")))
    return F.coalesce(value, F.lit(float("-inf")))


def positive_probability(probability: str = "probability") -> Column:
    """Second entry of a class-probability vector, without a Python worker."""
    return vector_to_array(F.col(probability))[1]


def percent_of_total(part: Column, total: Column) -> Column:
    """``part / total * 100``; null when the total is zero."""
    return F.try_divide(part.cast("double"), total.cast("double")) * 100


def sign_colour(corr: Column) -> Column:
    """'red' for a positive correlation, 'blue' otherwise."""
    return F.when(corr > 0, "red").otherwise("blue")


def null_default(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(default))
