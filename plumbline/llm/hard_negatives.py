"""Hard negatives by threshold joins over inverted indexes with norm bounds.

Integer vectors are dealt into shards and anchors into blocks, both of bounded size; each
shard meets each block in one task. There the dimensions are ordered by their energy in
the shard, and an inverted index holds a row only in its leading dimensions: the rest is
left out as soon as its norm times the largest norm of the anchors' rest lies below the
lowest threshold, for then the rest alone cannot reach it. Rows are ordered by the number of
dimensions that they keep, which makes the list of a dimension a prefix of the rows. Partial
scores are accumulated dimension by dimension, a pair is given up where partial score and
remaining norms stay below its anchor's threshold, and the survivors are scored exactly.

A window asks for the ``k`` best rows between two scores. Its search starts close to the
upper end and its threshold is lowered in rounds until the window is full or its lower end
is reached; full windows take no part in later rounds. A shard gives each window its own
``k`` best rows, which hold the overall best, so ties and copies cost nothing more.

Rows with a null label or vector, or a null or non-finite component, take no part; neither
do rows whose norm is 2^31 or more, as their scores may not fit. A null id comes last among
equal scores and is no anchor. Repeated ids are rows of their own. Vectors of different
length are compared as if the shorter one ended in zeros. An empty table, and an anchor
without positives, give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, table

#: Components of a shard and of a block of anchors; anchors scored at once; dimensions between two looks at the bounds.
SHARD, BLOCK, AT_ONCE, STEP = 1 << 19, 1 << 18, 128, 16
#: Parts of a window, from its upper end, that the rounds search.
SHARES = (0.25, 0.375, 0.5, 1.0)
#: Below this share of surviving pairs they are finished one by one.
FEW = 0.05
PAIRS = 1 << 16
WINDOWS = "array<struct<num:int,lo:bigint,hi:bigint>>"


def integer_rows(rows: DataFrame, key: Column, label: Column, vector: Column, scale: int = 256) -> DataFrame:
    """Rows (row, id, label, vector, norm) that take part; a component x becomes floor(scale * x)."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = rows.select(key.cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.alias("vector"), usable.alias("usable"))
    found = found.filter("label IS NOT NULL AND vector IS NOT NULL AND usable")
    whole = F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    found = found.select("id", "label", whole.alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda held, x: held + x.cast("double") * x.cast("double"))
    found = found.withColumn("norm", F.sqrt(squares)).filter(F.col("norm") < float(1 << 31))
    small = found.withColumn("vector", F.col("vector").cast("array<int>"))
    return small.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector", "norm")


def _matrix(column: pa.ChunkedArray, width: int, exact: type) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), exact)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - start] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _rest_norms(vectors: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norm of what follows each cut."""
    squares = np.zeros((len(vectors), vectors.shape[1] + 1))
    squares[:, :-1] = np.cumsum(np.square(vectors[:, ::-1], dtype=np.float64), axis=1)[:, ::-1]
    return np.sqrt(squares[:, cuts])


def pairs_above(rows: np.ndarray, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor: (anchor, rows with a score of at least its ``least``, their scores)."""
    order = np.argsort(-np.square(rows, dtype=np.float64).sum(axis=0), kind="stable")
    rows, anchors = rows[:, order], anchors[:, order]
    cuts = [*range(0, rows.shape[1], STEP), rows.shape[1]]
    rest_rows, rest_anchors = _rest_norms(rows, cuts), _rest_norms(anchors, cuts)
    by_need = np.argsort(-least, kind="stable")
    for start in range(0, len(anchors), AT_ONCE):
        block = by_need[start : start + AT_ONCE]
        need, sides, norms = least[block].astype(np.float64), anchors[block], rest_anchors[block]
        slack = 1e-9 * norms[:, :1].max() * rest_rows[:, 0].max()
        kept = (rest_rows[:, :-1] * norms[:, :-1].max(axis=0) + slack >= need.min()).sum(axis=1)  # steps in the index
        place = np.argsort(-kept, kind="stable")
        index, norms_rows, kept = rows[place], rest_rows[place], kept[place]
        sums = np.zeros((len(block), int((kept > 0).sum())), rows.dtype)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for c in range(len(cuts) - 1):
            n = int((kept > c).sum())  # the list of these dimensions is the first n rows
            if not n:
                break
            part = slice(cuts[c], cuts[c + 1])
            sums[:, :n] += sides[:, part] @ index[:n, part].T
            ended = int((kept > c + 1).sum())
            could = sums[:, :n] + norms[:, c + 1 : c + 2] * norms_rows[:n, c + 1] + slack >= need[:, None]
            last = could.sum() <= FEW * could.size
            anchor, row = np.nonzero(could if last else could[:, ended:])
            row += 0 if last else ended
            for i in range(0, len(row), PAIRS):
                a, r = anchor[i : i + PAIRS], row[i : i + PAIRS]
                score = sums[a, r] + np.einsum("ij,ij->i", sides[a, cuts[c + 1] :], index[r, cuts[c + 1] :])
                enough = score >= need[a]
                found.append((a[enough], place[r[enough]], score[enough]))
            if last:
                break
        if found:
            anchor, row, score = (np.concatenate(x) for x in zip(*found))
            turn = np.argsort(anchor, kind="stable")
            ends = np.searchsorted(anchor[turn], np.arange(len(block) + 1))
            for i, q in enumerate(block):
                if ends[i] < ends[i + 1]:
                    own = turn[ends[i] : ends[i + 1]]
                    yield int(q), row[own], score[own]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, smaller ids first among equal ones."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


_LAST_ID = np.iinfo(np.int64).max


def _searching(k: int):
    """Shard and block of anchors to the k best rows of each window in the shard."""

    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if shard.num_rows and block.num_rows:
            norms = [np.max(t.column("norm").to_numpy()) for t in (shard, block)]
            exact = np.float64 if norms[0] * norms[1] < 2**52 else np.int64
            width = max(max((len(v) for v in t.column("vector").combine_chunks()), default=0) for t in (shard, block))
            rows, anchors = (_matrix(t.column("vector"), max(width, 1), exact) for t in (shard, block))
            number, label = shard.column("row").to_numpy(), shard.column("label").to_numpy()
            given = shard.column("id")
            known = np.asarray(given.is_valid())
            ids = given.fill_null(_LAST_ID).to_numpy()
            wanted = block.select(["anchor", "label", "same", "windows"]).to_pylist()
            least = np.array([min(w["lo"] for w in a["windows"]) for a in wanted], np.int64)
            for q, near, score in pairs_above(rows, anchors, least):
                anchor = wanted[q]
                fits = (label[near] == anchor["label"]) == anchor["same"]
                fits &= number[near] != anchor["anchor"]
                near, score = near[fits], score[fits]
                for window in anchor["windows"]:
                    inside = np.flatnonzero((score >= window["lo"]) & (score <= window["hi"]))
                    best = inside[_best(score[inside], ids[near[inside]], k)]
                    out[0] += [anchor["anchor"]] * len(best)
                    out[1] += [window["num"]] * len(best)
                    out[2] += [int(ids[i]) if known[i] else None for i in near[best]]
                    out[3] += [int(i) for i in number[near[best]]]
                    out[4] += [int(s) for s in score[best]]
        kinds = {"anchor": pa.int64(), "num": pa.int32(), "id": pa.int64(), "row": pa.int64(), "score": pa.int64()}
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds.values())], names=list(kinds))

    return search


def _meet(rows: DataFrame, wanted: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """Rows (anchor, num, id, row, score, rank): the k best rows of each window."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = wanted.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    cells = dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
    found = cells.applyInArrow(_searching(k), "anchor long, num int, id long, row long, score long")
    order = "PARTITION BY anchor, num ORDER BY score DESC, id ASC NULLS LAST, row"
    return found.withColumn("rank", F.expr(f"row_number() OVER ({order})")).filter(F.col("rank") <= k)


def best_in_windows(rows: DataFrame, wanted: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """The ``k`` best rows of every window, thresholds lowered in rounds.

    ``wanted``: (anchor, label, vector, norm, same, windows), the windows an array of (num,
    lo, hi); same: whether the rows have the anchor's label or another. Columns as in the rounds:
    anchor, num, id, row, score, rank.
    """
    found, open_ = [], wanted
    for share in SHARES:
        start = F.transform(
            "windows",
            lambda w: F.struct(
                w["num"].alias("num"),
                F.greatest(w["lo"], F.floor(w["hi"] - (w["hi"] - w["lo"]) * F.lit(share))).alias("lo") if share < 1 else w["lo"].alias("lo"),
                w["hi"].alias("hi"),
            ),
        )
        met = materialise(_meet(rows, open_.withColumn("windows", start), shards, blocks, k), "negatives-round")
        found.append(met)
        if share == 1:
            break
        full = met.filter(F.col("rank") == k).groupBy("anchor").agg(F.collect_set("num").alias("full"))
        left = F.filter("windows", lambda w: ~F.array_contains(F.coalesce("full", F.array().cast("array<int>")), w["num"]))
        open_ = open_.join(full, "anchor", "left").withColumn("windows", left).drop("full").filter(F.size("windows") > 0)
        open_ = materialise(open_, "negatives-open")
        found[-1] = met.join(met.filter(F.col("rank") == k).select("anchor", "num"), ["anchor", "num"], "left_semi")
        if open_.isEmpty():
            break
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: from ``integer_rows``, stored; ``anchors``: the condition on them. Positives are the
    best rows of the anchor's label, negatives the best of other labels whose score lies between
    ``low`` and ``high`` percent of the positive's.
    """
    sums = rows.agg(
        F.count("*").alias("n"), F.count_if(anchors).alias("m"), F.max(F.size("vector")).alias("width"), F.max("norm").alias("norm")
    ).first()
    width = max(1, sums["width"] or 0)
    shards, blocks = (max(1, -(-sums[c] // max(1, size // width))) for c, size in (("n", SHARD), ("m", BLOCK)))
    mine = rows.filter(anchors).withColumnRenamed("row", "anchor")
    reach = F.ceil(F.col("norm") * float(sums["norm"] or 0)) + 1
    whole = F.array(F.struct(F.lit(0).alias("num"), (-reach).alias("lo"), reach.alias("hi"))).cast(WINDOWS)
    same = mine.select("anchor", "label", "vector", "norm", F.lit(True).alias("same"), whole.alias("windows"))
    held = best_in_windows(rows, same, shards, blocks, positives)
    held = materialise(held.select("anchor", F.col("rank").alias("num"), F.col("id").alias("positive_id"), "score"), "positives")
    # Both ends are rounded inwards; as decimals, since a product need not fit a long.
    exact = F.col("score").cast("decimal(38,0)")
    lo = F.ceil(exact * low / 100).cast("bigint")
    hi = F.floor(exact * high / 100).cast("bigint")
    windows = held.withColumn("lo", lo).withColumn("hi", hi).filter("lo <= hi")
    windows = windows.groupBy("anchor").agg(F.collect_list(F.struct("num", "lo", "hi")).cast(WINDOWS).alias("windows"))
    other = mine.select("anchor", "label", "vector", "norm", F.lit(False).alias("same")).join(windows, "anchor")
    other = materialise(other, "negatives-wanted")
    best = best_in_windows(rows, other, shards, blocks, negatives)
    named = mine.select("anchor", F.col("id").alias("anchor_id"))
    scored = held.withColumnRenamed("score", "positive_score")
    return (
        best.join(scored, ["anchor", "num"])
        .join(named, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


#: The query's anchors, and the rows whose label it moves on.
ANCHOR_EVERY, MOVED_EVERY, LABELS = 100, 7, 10


def mined(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    held = materialise(integer_rows(rows, F.col("vec_id"), moved, F.col("embedding")), "negatives-rows")
    return hard_negatives(held, F.col("id") % ANCHOR_EVERY == 0)


SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS line, vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.line, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.line <> b.line
), positives AS (
  SELECT line, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY line ORDER BY score DESC, vec_id NULLS LAST) AS num
  FROM scored WHERE same QUALIFY num <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.line, p.num ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.line = s.line
WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
