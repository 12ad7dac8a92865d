"""Ranks and n-tiles of a score over a whole table, without a single-partition window.

The order is: score descending, then the tie number of the row's keys. Null
scores come last, NaN first.

* ``score_ntile`` needs only the rows at the tile edges. They are found by counting
  (``radix``); after that a row's tile is a comparison with a few literals, so no row
  is shuffled.
* ``score_rank`` must order every row. Rows are put into cells that follow the
  order and have about equal size, a window ranks each cell, and the rows in the
  cells before it are added.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import TIE_BITS, sortable_score, tie_number
from plumbline.operators.order_stats import sorted_place
from plumbline.operators.radix import Found, select_ends

CHUNK = 100_000
SUBCELL_BITS = 20
HOT_CELL_ROWS = 1_000_000
#: Rows that a window over one cell should hold, and edges that are compared one by one.
CELL_ROWS = 2_000_000
FEW_EDGES = 32


#: Last row of a tile, as the selection finds it.
TileEdge = Found


def tile_sizes(rows: int, tiles: int) -> list[int]:
    """Rows per tile as ``ntile`` deals them: the first ``rows % tiles`` get one more."""
    small, extra = divmod(rows, tiles)
    return [small + (t < extra) for t in range(tiles)]


def content_columns(df: DataFrame) -> list[str]:
    """Columns that can be hashed: what tells rows without keys apart."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def tile_edges(
    df: DataFrame,
    score: str,
    keys: Sequence[str],
    tiles: int = 10,
    by: Sequence[str] = (),
    seed: int = 0,
    content: Sequence[str] = (),
) -> list[TileEdge]:
    """Edges between the tiles of every group, in order. Groups must be few.

    ``content`` columns tell rows apart that lack a key; they are read only if there are any.
    """

    def wanted(_group: tuple, size: int) -> list[int]:
        ends = itertools.accumulate(tile_sizes(size, tiles)[:-1])
        return sorted({end for end in ends if 0 < end < size})

    def tie(nulls: int) -> Column:
        return tie_number(df, keys, seed, content if nulls else ())

    rows = df.withColumn("_s", sortable_score(score))
    found = select_ends(rows, wanted, by, tie, keys)
    return [edge for edges in found.values() for edge in edges]


def with_tile(
    df: DataFrame,
    edges: Sequence[TileEdge],
    score: str,
    keys: Sequence[str],
    by: Sequence[str] = (),
    output: str = "deciles",
    seed: int = 0,
    content: Sequence[str] = (),
) -> DataFrame:
    """Adds the tile of every row, and the helper columns ``_s``, ``_t`` and ``_split``.

    Edges are literals, or one broadcast row per group. The tie number is computed
    for rows on an edge score only. ``_split`` marks copies of one row that belong to
    different tiles.
    """
    groups: dict[tuple, list[TileEdge]] = {}
    for edge in edges:
        groups.setdefault(edge.group, []).append(edge)
    width = max((len(g) for g in groups.values()), default=0)
    rows = df.withColumn("_s", sortable_score(score))
    if width > FEW_EDGES:
        return _with_many_tiles(df, rows, groups, keys, by, output, seed, content)
    if by:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        schema = T.StructType([T.StructField(f"_by{k}", kinds[b]) for k, b in enumerate(by)])
        for i in range(width):
            schema = schema.add(f"_e{i}", "double").add(f"_e{i}t", "long").add(f"_e{i}p", "boolean")
        empty = (None, None, None)
        table = [
            (*group, *itertools.chain(*[_edge_cells(e) for e in own], *[empty] * (width - len(own))))
            for group, own in groups.items()
        ]
        match = F.lit(True)
        for k, b in enumerate(by):
            match = match & F.col(b).eqNullSafe(F.col(f"_by{k}"))
        rows = rows.join(F.broadcast(df.sparkSession.createDataFrame(table, schema)), match, "left")
        cells = [(F.col(f"_e{i}"), F.col(f"_e{i}t"), F.col(f"_e{i}p")) for i in range(width)]
    else:
        cells = [tuple(F.lit(v) for v in _edge_cells(e)) for e in edges]
    value, tie = F.col("_s"), F.col("_t")
    tied, number, split = F.lit(False), F.lit(1), F.lit(False)
    for edge_score, edge_tie, partial in cells:
        on_edge = (value == edge_score) & edge_tie.isNotNull()
        past = (value < edge_score) | (on_edge & (tie > edge_tie))
        tied = tied | on_edge
        number = number + F.coalesce(past.cast("int"), F.lit(0))
        split = split | (partial & on_edge & (tie == edge_tie))
    rows = rows.withColumn("_t", F.when(tied, tie_number(df, keys, seed, content)))
    numbered = rows.withColumns({output: number.cast("int"), "_split": F.coalesce(split, F.lit(False))})
    return numbered.select(*df.columns, "_s", "_t", output, "_split")


def _with_many_tiles(
    df: DataFrame,
    rows: DataFrame,
    groups: dict[tuple, list[TileEdge]],
    keys: Sequence[str],
    by: Sequence[str],
    output: str,
    seed: int,
    content: Sequence[str],
) -> DataFrame:
    """As :func:`with_tile`, by binary search in one sorted array of edges per group."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(f"_by{k}", kinds[b]) for k, b in enumerate(by)])
    edge = T.StructType().add("s", "double").add("t", "long").add("p", "boolean")
    schema = schema.add("_edges", T.ArrayType(edge))
    table = df.sparkSession.createDataFrame(
        [(*group, [_edge_cells(e) for e in own]) for group, own in groups.items()], schema
    )
    match = F.lit(True)
    for k, b in enumerate(by):
        match = match & F.col(b).eqNullSafe(F.col(f"_by{k}"))
    rows = rows.join(F.broadcast(table), match, "left").withColumn("_t", tie_number(df, keys, seed, content))
    value, tie, none = F.col("_s"), F.col("_t"), F.array().cast(T.ArrayType(edge))
    rows = rows.withColumn("_edges", F.coalesce("_edges", none))

    def past(edge: Column) -> Column:
        return (value < edge["s"]) | ((value == edge["s"]) & F.coalesce(tie > edge["t"], F.lit(False)))

    steps = max(len(own) for own in groups.values()).bit_length()
    found = sorted_place(F.col("_edges"), F.size("_edges"), past, steps)
    rows = rows.withColumn("_place", found)
    here = F.get("_edges", F.col("_place"))
    split = here["p"] & (value == here["s"]) & (tie == here["t"])
    numbered = rows.withColumns({output: (F.col("_place") + 1).cast("int"), "_split": F.coalesce(split, F.lit(False))})
    return numbered.select(*df.columns, "_s", "_t", output, "_split")


def _edge_cells(edge: TileEdge) -> tuple:
    return float(edge.score), edge.tie, edge.taken is not None


def has_split(edges: Sequence[TileEdge]) -> bool:
    return any(e.taken is not None for e in edges)


def deal_copies(
    copies: DataFrame, edges: Sequence[TileEdge], order: Sequence[Column], by: Sequence[str], output: str
) -> DataFrame:
    """Deals counted copies (``_n`` rows of score ``_s`` and tie number ``_t``) out to tiles.

    Adds the tile and ``_take``, the copies that go there. The pieces are a table of
    at most two rows per edge.
    """
    by = list(by)
    kinds = {f.name: f.dataType for f in copies.schema.fields}
    schema = T.StructType([T.StructField(f"_by{k}", kinds[b]) for k, b in enumerate(by)]).add("_ps", "double")
    schema = schema.add("_pt", "long").add("_start", "long").add("_stop", "long").add(output, "integer")
    pieces = copies.sparkSession.createDataFrame(_pieces(edges), schema)
    window = W.partitionBy(*by, "_s", "_t").orderBy(*order)
    placed = copies.withColumn("_end", F.sum("_n").over(window)).withColumn("_from", F.col("_end") - F.col("_n"))
    match = (F.col("_s") == F.col("_ps")) & (F.col("_t") == F.col("_pt"))
    for k, b in enumerate(by):
        match = match & F.col(b).eqNullSafe(F.col(f"_by{k}"))
    match = match & (F.col("_from") < F.col("_stop")) & (F.col("_end") > F.col("_start"))
    take = F.least("_end", "_stop") - F.greatest("_from", "_start")
    return placed.join(F.broadcast(pieces), match).withColumn("_take", take)


def score_ntile(
    df: DataFrame,
    score: str,
    keys: Sequence[str],
    tiles: int = 10,
    by: Sequence[str] = (),
    output: str = "deciles",
    seed: int = 0,
) -> DataFrame:
    """Adds the tile (1 = highest scores) of every row; equal to ``ntile`` over the order.

    Copies of one row that straddle an edge are counted, dealt out to the tiles and
    expanded again, since nothing in the row tells them apart.
    """
    content = content_columns(df)
    edges = tile_edges(df, score, keys, tiles, by, seed, content)
    numbered = with_tile(df, edges, score, keys, by, output, seed, content)
    columns = [*df.columns, output]
    if not has_split(edges):
        return numbered.select(*columns)
    counted = numbered.filter("_split").groupBy(*df.columns, "_s", "_t").agg(F.count("*").alias("_n"))
    dealt = deal_copies(counted, edges, [F.col(c) for c in df.columns], by, output)
    whole = numbered.filter("NOT _split").select(*columns)
    return whole.unionByName(_expand(dealt, F.col("_take")).select(*columns))


def score_rank(
    df: DataFrame,
    score: str,
    keys: Sequence[str],
    by: Sequence[str] = (),
    output: str = "rownum",
    seed: int = 0,
    cells: int | None = None,
) -> DataFrame:
    """Adds the row number (1 = highest score) of every row of its group."""
    by = list(by)
    spark = df.sparkSession
    cells = cells or max(default_cells(spark), math.ceil(df.count() / CELL_ROWS))
    scored = df.withColumns({"_s": sortable_score(score), "_t": tie_number(df, keys, seed, content_columns(df))})
    scored = _with_cell(scored, cells)

    sizes = scored.groupBy(*by, "_cell").agg(F.count("*").alias("_size")).toArrow().to_pylist()
    sizes.sort(key=lambda r: r["_cell"])
    total: dict[tuple, int] = {}
    offsets, hot = [], []
    limit = max(HOT_CELL_ROWS, 8 * sum(r["_size"] for r in sizes) // max(1, len(sizes)))
    for row in sizes:
        group = tuple(row[b] for b in by)
        offsets.append((*group, row["_cell"], total.get(group, 0)))
        total[group] = total.get(group, 0) + row["_size"]
        if row["_size"] > limit:
            hot.append(row["_cell"])

    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(f"_by{k}", kinds[b]) for k, b in enumerate(by)])
    schema = schema.add("_ocell", "long").add("_offset", "long")
    match = F.col("_cell") == F.col("_ocell")
    for k, b in enumerate(by):
        match = match & F.col(b).eqNullSafe(F.col(f"_by{k}"))
    # One row per cell: bounded by the number of cells, not by the data.
    placed = scored.join(F.broadcast(spark.createDataFrame(offsets, schema)), match, "left")

    # Rows of equal score and keys are ordered by their other columns, in every cell alike.
    others = [F.asc(c) for c in content_columns(df) if c not in (*by, *keys)]
    order = [F.desc("_s"), F.asc("_t"), *[F.asc(k) for k in keys], *others]
    in_cell = W.partitionBy(*by, "_cell").orderBy(*order)
    regular = placed.filter(~F.col("_cell").isin(hot)) if hot else placed
    ranked = regular.withColumn(output, (F.col("_offset") + F.row_number().over(in_cell)).cast("bigint"))
    ranked = ranked.select(*df.columns, output)
    if not hot:
        return ranked
    # A cell far above its share holds copies of few rows: rank the distinct rows, then expand.
    counted = placed.filter(F.col("_cell").isin(hot))
    counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(W.partitionBy(*by, "_cell").orderBy(*order))
    dealt = counted.withColumn("_before", F.col("_offset") + running - F.col("_n"))
    expanded = _expand(dealt, F.col("_n")).withColumn(output, F.col("_before") + F.col("_copy"))
    return ranked.unionByName(expanded.select(*df.columns, output))


def default_cells(spark: SparkSession) -> int:
    """Cells for windows over ordered values: follows the shuffle width, at least 2, at most 10,000."""
    return min(10_000, max(2, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def cell_points(df: DataFrame, column: str, cells: int) -> list[float]:
    """Ascending values that part the rows about equally; a frequent value comes repeatedly.

    They balance the work only: results are exact wherever the points lie.
    """
    cells = max(2, cells)
    steps = [k / cells for k in range(1, cells)]
    points = df.stat.approxQuantile(column, steps, 0.5 / cells)
    return points if any(math.isfinite(p) for p in points) else [0.0]


def _with_cell(scored: DataFrame, cells: int) -> DataFrame:
    """Adds ``_cell``: ascending along the order, about equally filled.

    A score that spans several quantiles gets a score cell of its own, cut into
    sub-cells along the tie number.
    """
    points = cell_points(scored, "_s", cells)
    repeats = {p: points.count(p) for p in set(points)}
    splits = set(points)
    splits.update(math.nextafter(p, math.inf) for p, n in repeats.items() if n > 1)
    splits = [-math.inf, *sorted(s for s in splits if math.isfinite(s)), math.inf]
    parts = [repeats.get(low, 1) + 1 if repeats.get(low, 1) > 1 else 1 for low in splits[:-1]]
    bucketed = Bucketizer(splits=splits, inputCol="_s", outputCol="_bucket").transform(scored)
    # Missing scores and NaN are the ends of the order; they are cut like any frequent score.
    bucket = F.when(F.col("_s") == math.inf, len(parts)).when(F.col("_s") == -math.inf, -1)
    bucket = bucket.otherwise(F.col("_bucket").cast("int"))
    ends = {end: repeats.get(end, 0) + 1 for end in (math.inf, -math.inf)}
    inner = F.get(F.array(*[F.lit(p) for p in parts]), F.col("_bucket").cast("int"))
    part_count = F.when(F.col("_s") == math.inf, ends[math.inf]).when(F.col("_s") == -math.inf, ends[-math.inf])
    part_count = part_count.otherwise(inner)
    sub = F.shiftright(F.shiftright("_t", TIE_BITS - SUBCELL_BITS) * part_count, SUBCELL_BITS)
    descending = F.lit(len(splits)) - bucket
    cell = F.shiftleft(descending.cast("bigint"), SUBCELL_BITS) + sub
    return bucketed.withColumn("_cell", cell.cast("bigint")).drop("_bucket")


def _pieces(edges: Sequence[TileEdge]) -> list[tuple]:
    """(group, score, tie, first copy, end copy, tile) for every straddling row."""
    number: dict[tuple, int] = {}
    runs: dict[tuple, list[tuple[int, int]]] = {}
    for edge in edges:
        number[edge.group] = number.get(edge.group, 0) + 1
        if edge.taken is not None:
            runs.setdefault((*edge.group, edge.score, edge.tie), []).append((number[edge.group], edge.taken))
    rows = []
    for row, run in runs.items():
        start = 0
        for tile, taken in run:
            rows.append((*row, start, taken, tile))
            start = taken
        rows.append((*row, start, 2**62, run[-1][0] + 1))
    return rows


def _expand(df: DataFrame, copies: Column) -> DataFrame:
    """Repeats every row ``copies`` times; ``_copy`` counts from 1. Large counts go out in chunks."""
    chunks = df.withColumn("_copies", copies).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / CHUNK)))
    )
    first = F.col("_chunk") * CHUNK + 1
    last = F.least(F.col("_copies"), first + CHUNK - 1)
    return chunks.repartition(F.xxhash64(*df.columns), F.col("_chunk")).withColumn("_copy", F.explode(F.sequence(first, last)))
