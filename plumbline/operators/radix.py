"""Selection of ranks by radix over one sortable composite key, for all groups at once.

The key of a row is the order-preserving code of its score (highest first), then its tie
number. A pass counts rows by (group, next digits of the key): a hash aggregation that
combines on the map side. Cells that hold a wanted rank are kept, by an equijoin with a
broadcast row per cell, and cut by their next digits; a cell of a single score goes on with
the tie number at once. Once few rows are left, their keys are counted one by one. The
driver sees at most about ``CELL_BUDGET`` cells per pass, or ``FINISH_ROWS`` keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import TIE_BITS

#: Leading bits of the code (sign, exponent, 8 of the fraction) that the first pass counts.
CODE_BITS, FIRST_BITS = 64, 20
DIGIT_BITS = 12
CELL_BUDGET, FINISH_ROWS = 131_072, 100_000
LARGEST, SMALLEST = 1.7976931348623157e308, 4.9e-324
NORMAL = 2.2250738585072014e-308


@dataclass(frozen=True)
class Found:
    """The row that ends a wanted stretch: its score, and inside a run of equal scores its tie number.

    ``tie`` is None where the stretch takes all rows of the score. ``taken`` counts the rows of
    this score and tie number that are inside; it is None where all of them are.
    """

    group: tuple
    score: float
    tie: int | None = None
    taken: int | None = None


@dataclass
class _Cell:
    """Rows that share the leading ``width`` bits of the score's code, or of the tie number of one score."""

    group: tuple
    first: int
    tied: bool
    width: int
    value: int
    score: float
    before: int
    count: int
    ends: list[int] = field(default_factory=list)


def order_code(score: Column) -> Column:
    """Long that never decreases along descending doubles; neighbours may share one."""
    size = F.least(F.abs(score), F.lit(LARGEST))
    power = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size)).cast("int")))
    part = F.floor((size / F.pow(F.lit(2.0), power) - 1) * 2.0**52)
    part = F.greatest(F.lit(0), F.least(F.lit(2**52 - 1), part))
    code = F.when(size < NORMAL, F.floor(size / SMALLEST)).otherwise(F.shiftleft((power + 1023).cast("bigint"), 52) + part)
    return F.when(score < 0, code).otherwise(-code)


def select_ends(
    rows: DataFrame, wanted: Callable[[tuple, int], Sequence[int]], by: Sequence[str], tie: Callable[[int], Column], keys: Sequence[str]
) -> dict[tuple, list[Found]]:
    """Where the first ``n`` rows of a group end, for every n (0 < n < rows) in ``wanted(group, rows)``.

    ``rows`` has the sortable score as ``_s``; ``tie(nulls)`` gives the tie number of its rows
    once it is known how many rows lack one of ``keys``. Groups must be few.
    """
    by = list(by)
    coded = rows.withColumn("_o", order_code(F.col("_s")))
    first = F.shiftright("_o", CODE_BITS - FIRST_BITS)
    lacking = F.count_if(F.greatest(F.lit(False), F.lit(False), *[F.col(k).isNull() for k in keys]))
    counted = coded.groupBy(*by, first.alias("_d")).agg(
        F.count("*").alias("n"), F.min("_s").alias("low"), F.max("_s").alias("high"), lacking.alias("lacking")
    )
    table = counted.toArrow()
    nulls = sum(table.column("lacking").to_pylist())
    names = list(zip(*[table.column(b).to_pylist() for b in by])) if by else [()] * table.num_rows
    found: dict[tuple, list[Found]] = {}
    ends: dict[tuple, list[int]] = {}
    open_: list[_Cell] = []
    places: dict[tuple, list[int]] = {}
    for at, group in enumerate(names):
        places.setdefault(group, []).append(at)
    digit, n, low, high = (table.column(c).to_numpy() for c in ("_d", "n", "low", "high"))
    resolved: dict[tuple, dict[int, Found]] = {}
    for group, own in places.items():
        own = np.array(own)[np.argsort(digit[own], kind="stable")]
        ends[group] = sorted(set(wanted(group, int(n[own].sum()))))
        whole = _Cell(group, 0, False, 0, 0, 0.0, 0, int(n[own].sum()), ends[group])
        ties = np.zeros(len(own), np.int64)
        open_ += _descend(whole, FIRST_BITS, digit[own], n[own], low[own], high[own], ties, ties - 1, resolved.setdefault(group, {}))
    rows = coded.withColumn("_t", tie(nulls))
    while open_:
        finish = sum(c.count for c in open_) <= FINISH_ROWS
        open_ = _pass(rows, open_, by, finish, resolved)
    for group, at in ends.items():
        found[group] = [resolved[group][end] for end in at]
    return found


def _descend(cell: _Cell, width: int, digits, counts, low, high, tie_low, tie_high, resolved: dict[int, Found]) -> list[_Cell]:
    """Hands each end of ``cell`` on to the part that holds it; ascending arrays, one entry per part."""
    stops = cell.before + np.cumsum(counts)
    if int(counts.sum()) != cell.count:
        raise RuntimeError("the input changed between two counting passes; cache or checkpoint it")
    parts: dict[int, _Cell] = {}
    for end in cell.ends:
        at = int(np.searchsorted(stops, end, side="left"))
        score, stop, count = float(low[at]), int(stops[at]), int(counts[at])
        one_score, one_tie = low[at] == high[at], tie_low[at] == tie_high[at]
        if one_score and one_tie and end < stop:
            resolved[end] = Found(cell.group, score, int(tie_low[at]), end - (stop - count))
        elif end == stop:
            resolved[end] = Found(cell.group, score, int(tie_high[at]) if cell.tied else None)
        else:
            if at not in parts:
                first = int(digits[at]) if not cell.width and not cell.tied else cell.first
                into = one_score and not cell.tied
                value, bits = (0, 0) if into else (int(digits[at]), width)
                parts[at] = _Cell(cell.group, first, bool(one_score), bits, value, score, stop - count, count)
            parts[at].ends.append(end)
    return list(parts.values())


def _pass(rows: DataFrame, open_: list[_Cell], by: list[str], finish: bool, resolved: dict) -> list[_Cell]:
    """Counts the parts of all open cells; returns the parts that stay open."""
    bits = max(4, min(DIGIT_BITS, (CELL_BUDGET // len(open_)).bit_length() - 1))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField(f"_by{k}", kinds[b]) for k, b in enumerate(by)])
    for name, kind in {"_first": "long", "_cell": "integer", "_tied": "boolean", "_rest": "integer", "_value": "long", "_score": "double", "_next": "integer"}.items():
        schema = schema.add(name, kind)
    listed, widths = [], []
    for number, c in enumerate(open_):
        whole = TIE_BITS if c.tied else CODE_BITS
        widths.append(min(whole, c.width + bits))
        listed.append((*c.group, c.first, number, c.tied, whole - c.width, c.value, c.score, whole - widths[-1]))
    table = rows.sparkSession.createDataFrame(listed, schema).coalesce(1)
    match = F.shiftright("_o", CODE_BITS - FIRST_BITS) == F.col("_first")
    for k, b in enumerate(by):
        match = match & F.col(b).eqNullSafe(F.col(f"_by{k}"))
    # Shifts by 64 wrap around in the JVM; only tie cells can be whole, and those by 62.
    inside = F.when(F.col("_tied"), (F.col("_s") == F.col("_score")) & (F.expr("shiftright(_t, _rest)") == F.col("_value")))
    inside = inside.otherwise(F.expr("shiftright(_o, _rest)") == F.col("_value"))
    held = rows.join(F.broadcast(table), match).filter(inside)
    if finish:
        grouped = held.groupBy("_cell", F.col("_s").alias("low"), F.col("_t").alias("tie_low")).agg(F.count("*").alias("n"))
        counted = grouped.select("_cell", F.lit(0).cast("bigint").alias("_d"), "n", "low", F.col("low").alias("high"), "tie_low", F.col("tie_low").alias("tie_high"))
    else:
        digit = F.when(F.col("_tied"), F.expr("shiftright(_t, _next)")).otherwise(F.expr("shiftright(_o, _next)"))
        # Neighbouring scores may share a whole code: those are told apart as they are.
        exact = F.when(~F.col("_tied") & (F.col("_rest") == 0), F.col("_s"))
        counted = held.groupBy("_cell", digit.alias("_d"), exact.alias("_exact")).agg(
            F.count("*").alias("n"),
            F.min("_s").alias("low"),
            F.max("_s").alias("high"),
            F.min(F.when(F.col("_tied"), F.col("_t"))).alias("tie_low"),
            F.max(F.when(F.col("_tied"), F.col("_t"))).alias("tie_high"),
        )
        counted = counted.withColumns({"tie_low": F.coalesce("tie_low", F.lit(0)), "tie_high": F.coalesce("tie_high", F.lit(-1))})
    return _parts(counted.select("_cell", "_d", "n", "low", "high", "tie_low", "tie_high").toArrow(), open_, widths, finish, resolved)


def _parts(table: pa.Table, open_: list[_Cell], widths: list[int], finish: bool, resolved: dict) -> list[_Cell]:
    cell, digit, n, low, high, tie_low, tie_high = (c.to_numpy() for c in table.columns)
    order = np.lexsort((tie_low, -low, digit, cell))
    starts = np.searchsorted(cell[order], np.arange(len(open_) + 1))
    left: list[_Cell] = []
    for number, c in enumerate(open_):
        at = order[starts[number] : starts[number + 1]]
        c.tied = c.tied or finish
        left += _descend(c, widths[number], digit[at], n[at], low[at], high[at], tie_low[at], tie_high[at], resolved[c.group])
    return left
