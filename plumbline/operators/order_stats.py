"""Exact order statistics and quantiles without moving rows between executors.

A rank is found by counting: every pass lays cells over the value intervals that
still hold a wanted rank, counts the rows of each cell (a hash aggregation that
combines on the map side) and keeps the cells the ranks fall into. The first pass
uses cells of equal ratio, later ones equal widths. An interval shrinks by the
number of cells per pass; a value that fills a third of the table is one cell like
any other. The driver sees cell counts only, at most about ``CELL_BUDGET`` of them
per pass, or ``FINISH_ROWS`` values once no more rows than that are left.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_BUDGET = 131_072
MAX_CELLS = 4_096
FINISH_ROWS = 500_000
CELLS_PER_E = 128
#: Intervals compared one by one; more are searched in a sorted array.
FEW_INTERVALS = 32
LARGEST = 1.7976931348623157e308

# Ascending arrays: smallest value, largest value and row count per cell.
Cells = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class OrderStat:
    """The value at an ascending zero-based ``rank`` of a group."""

    group: tuple
    rank: int
    value: float | int
    below: int  # rows with a smaller value
    equal: int  # rows with this value
    size: int  # rows in the group


@dataclass
class _Interval:
    """Values of one group between two bounds that still hold wanted ranks."""

    group: tuple
    low: float | int
    high: float | int
    below: int
    count: int
    size: int
    ranks: list[int]


def order_statistics(
    df: DataFrame,
    value: str,
    wanted: Callable[[tuple, int], Iterable[int]],
    by: Sequence[str] = (),
    known: dict[tuple, tuple[int, int, int]] | None = None,
) -> list[OrderStat]:
    """Values at the ranks ``wanted(group, size)`` of every group of ``by``.

    Null and NaN values are left out. ``by`` must have few groups (features,
    buckets, models); the values may be doubles or integers of any width.
    ``known`` may give (low, high, count) of every group and saves the first pass.
    """
    by = list(by)
    rows = _narrow(df, value, by)
    found: list[OrderStat] = []
    active: list[_Interval] = []

    def ranks_of(group: tuple, size: int) -> list[int]:
        ranks = sorted(set(wanted(group, size)))
        if ranks and not 0 <= ranks[0] <= ranks[-1] < size:
            raise ValueError(f"ranks outside 0..{size - 1} wanted for group {group}")
        return ranks

    if known is None:
        for group, cells in _first_cells(rows, by).items():
            size = int(cells[2].sum())
            ranks = ranks_of(group, size)
            _descend(_Interval(group, cells[0][0], cells[1][-1], 0, size, size, ranks), cells, found, active)
    else:
        for group, (low, high, size) in known.items():
            ranks = ranks_of(group, size)
            if ranks:
                active.append(_Interval(group, low, high, 0, size, size, ranks))

    stalled = False
    while active:
        # Values too close for cell arithmetic (at most a few hundred) are counted one by one.
        finish = stalled or sum(i.count for i in active) <= FINISH_ROWS
        counts = _count_values(rows, active, by) if finish else _count_cells(rows, active, by)
        following: list[_Interval] = []
        for number, interval in enumerate(active):
            _descend(interval, counts[number], found, following)
        stalled = [(i.low, i.high) for i in following] == [(i.low, i.high) for i in active]
        active = following
    return found


def quantile_ranks(size: int, probability: float) -> tuple[int, int, float]:
    """Ranks around a linear-interpolation quantile and the weight of the upper one."""
    position = probability * (size - 1)
    lower = math.floor(position)
    return lower, min(lower + 1, size - 1), position - lower


def quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> dict[tuple, list[float]]:
    """Exact quantiles (linear interpolation) per group, as ``{group: [q, ...]}``."""

    def wanted(_group: tuple, size: int) -> list[int]:
        return [r for p in probabilities for r in quantile_ranks(size, p)[:2]]

    values: dict[tuple, dict[int, float]] = {}
    sizes: dict[tuple, int] = {}
    for stat in order_statistics(df, value, wanted, by):
        values.setdefault(stat.group, {})[stat.rank] = float(stat.value)
        sizes[stat.group] = stat.size
    result = {}
    for group, at in values.items():
        result[group] = []
        for p in probabilities:
            lower, upper, weight = quantile_ranks(sizes[group], p)
            low, high = at[lower], at[upper]
            result[group].append(low if low == high else low + (high - low) * weight)
    return result


def _narrow(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    column = F.col(value)
    kind = df.select(column).schema.fields[0].dataType
    integral = isinstance(kind, T.IntegralType)
    rows = df.select(*by, column.cast("bigint" if integral else "double").alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull())
    return rows if integral else rows.filter(~F.isnan("_v"))


def _descend(
    interval: _Interval,
    cells: Cells,
    found: list[OrderStat],
    following: list[_Interval],
) -> None:
    """Hand each rank of ``interval`` on to the cell that holds it."""
    lows, highs, counts = cells
    ends = interval.below + np.cumsum(counts)
    if int(counts.sum()) != interval.count:
        raise RuntimeError("the input changed between two counting passes; cache or checkpoint it")
    held: dict[int, list[int]] = {}
    for rank in interval.ranks:
        held.setdefault(int(np.searchsorted(ends, rank, side="right")), []).append(rank)
    for cell, ranks in held.items():
        low, high, count = lows[cell].item(), highs[cell].item(), int(counts[cell])
        below = int(ends[cell]) - count
        if low == high:
            found.extend(OrderStat(interval.group, r, low, below, count, interval.size) for r in ranks)
        else:
            following.append(_Interval(interval.group, low, high, below, count, interval.size, ranks))


def _first_cells(rows: DataFrame, by: list[str]) -> dict[tuple, Cells]:
    """Counts in cells of equal ratio, which need no bounds: sign and logarithm of the value."""
    size = F.least(F.abs(F.col("_v").cast("double")), F.lit(LARGEST))
    step = F.floor(F.ln(size) * CELLS_PER_E).cast("int") + F.lit(CELLS_PER_E * 800)
    cell = F.when(F.col("_v") == 0, 0).when(F.col("_v") > 0, step).otherwise(-step)
    counted = (
        rows.groupBy(*by, cell.alias("_cell"))
        .agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count("*").alias("n"))
        .toArrow()
    )
    names = list(zip(*[counted.column(b).to_pylist() for b in by])) if by else [()] * counted.num_rows
    places = {group: k for k, group in enumerate(dict.fromkeys(names))}
    return _split_cells(counted, np.array([places[g] for g in names], dtype=np.int64), places)


def _scaled(value: Column) -> Column:
    # Halves keep the width of the largest double range finite.
    clamped = F.least(F.greatest(value.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
    return clamped / 2


def _assigned(rows: DataFrame, active: list[_Interval], by: list[str]) -> DataFrame:
    """Rows inside an active interval, with its number and bounds.

    The intervals are few (groups x wanted ranks), so they travel as a broadcast
    table when grouped and as literals otherwise.
    """
    if not by and len(active) > FEW_INTERVALS:
        lows, highs = (F.array(*[F.lit(getattr(i, side)) for i in active]) for side in ("low", "high"))
        order = sorted(range(len(active)), key=lambda n: active[n].low)
        if order != list(range(len(active))):
            raise RuntimeError("intervals must ascend")
        place = sorted_place(lows, len(active), lambda low: low <= F.col("_v")) - 1
        rows = rows.withColumn("_i", place).withColumns({"_low": F.get(lows, F.col("_i")), "_high": F.get(highs, F.col("_i"))})
        return rows.filter((F.col("_i") >= 0) & (F.col("_v") <= F.col("_high"))).select("_v", "_i", "_low", "_high")
    if not by:
        number = F.lit(None).cast("int")
        low = high = F.lit(None)
        for n, i in enumerate(active):
            inside = (F.col("_v") >= F.lit(i.low)) & (F.col("_v") <= F.lit(i.high))
            number = F.when(inside, n).otherwise(number)
            low = F.when(F.col("_i") == n, F.lit(i.low)).otherwise(low)
            high = F.when(F.col("_i") == n, F.lit(i.high)).otherwise(high)
        rows = rows.withColumn("_i", number).filter(F.col("_i").isNotNull())
        return rows.select("_v", "_i", low.alias("_low"), high.alias("_high"))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType(
        [T.StructField(f"_by{k}", kinds[b]) for k, b in enumerate(by)]
        + [
            T.StructField("_i", T.IntegerType()),
            T.StructField("_low", kinds["_v"]),
            T.StructField("_high", kinds["_v"]),
        ]
    )
    table = rows.sparkSession.createDataFrame(
        [(*i.group, n, i.low, i.high) for n, i in enumerate(active)], schema
    )
    match = (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
    for k, b in enumerate(by):
        match = match & F.col(b).eqNullSafe(F.col(f"_by{k}"))
    return rows.join(F.broadcast(table), match).select("_v", "_i", "_low", "_high")


def sorted_place(items: Column, size: int | Column, passed: Callable[[Column], Column], steps: int | None = None) -> Column:
    """How many leading items of a sorted array are passed, by binary search."""
    steps = steps or int(size).bit_length()

    def step(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        past = F.coalesce(passed(F.get(items, middle)), F.lit(False))
        open_ = span["low"] < span["high"]
        return F.struct(
            F.when(open_ & past, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(open_ & ~past, middle).otherwise(span["high"]).alias("high"),
        )

    limit = size if isinstance(size, Column) else F.lit(size)
    start = F.struct(F.lit(0).alias("low"), limit.alias("high"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(steps)]), start, step)["low"]


def _count_cells(rows: DataFrame, active: list[_Interval], by: list[str]) -> dict[int, Cells]:
    cells = max(16, min(MAX_CELLS, CELL_BUDGET // len(active)))
    low, high = _scaled(F.col("_low")), _scaled(F.col("_high"))
    share = F.try_divide(_scaled(F.col("_v")) - low, high - low)
    cell = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * cells), F.lit(cells - 1)).cast("int")
    counted = (
        _assigned(rows, active, by)
        .groupBy("_i", cell.alias("_cell"))
        .agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count("*").alias("n"))
        .select("_i", "low", "high", "n")
    )
    table = counted.toArrow()
    numbers = table.column("_i").to_numpy()
    return _split_cells(table, numbers, range(len(active)))


def _count_values(rows: DataFrame, active: list[_Interval], by: list[str]) -> dict[int, Cells]:
    counted = _assigned(rows, active, by).groupBy("_i", "_v").agg(F.count("*").alias("n"))
    table = counted.select("_i", F.col("_v").alias("low"), F.col("_v").alias("high"), "n").toArrow()
    numbers = table.column("_i").to_numpy()
    return _split_cells(table, numbers, range(len(active)))


def _split_cells(table: pa.Table, numbers: np.ndarray, owners: Iterable) -> dict:
    """Arrow rows (low, high, n) as ascending arrays per owner; ``numbers`` places each row."""
    low, high, n = (table.column(c).to_numpy() for c in ("low", "high", "n"))
    order = np.lexsort((low, numbers))
    owners = list(owners)
    starts = np.searchsorted(numbers[order], np.arange(len(owners) + 1))
    parts = {owner: order[starts[k] : starts[k + 1]] for k, owner in enumerate(owners)}
    return {owner: (low[p], high[p], n[p]) for owner, p in parts.items()}
