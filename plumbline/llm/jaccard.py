"""Exact Jaccard self-join over word shingles, as classes and links.

Texts with equal shingle sets are one class; one of each goes on. Candidates come from a
prefix filter: two sets of similarity t share a shingle among the first
``n - ceil(t n) + 1`` of either in any common order; shingles of rare words come first
and frequent shingles last, as a bounded sample of documents shows them (the sample
decides speed, not results).
Postings of one shingle and one size band form a tile; two sets can only be alike if
their bands are equal or neighbours.

First every member of a tile is compared with one leader of its own and of the next
band, then with all its leaders, and in further rounds with leaders that each shingle orders
in its own way; that joins groups of near copies at a cost linear in their size. Tiles whose
members then still lie in different components are compared whole, in blocks of bounded size:
hashed bitmaps, wider for larger sets, bound the overlap from above by counting differing
bits, and only pairs of different components that pass reach the exact intersection of sorted
arrays. No pair within one component is looked at again.

Null and empty texts have no shingles and are linked with nothing; a text of fewer words
than a shingle is one shingle. Null ids: such rows get the component of their class (null
if it has no other id). Repeated rows, repeated ids and other columns are allowed; an
empty table gives an empty result; text length is not limited. Shingles and set classes
are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import alone, freed_shuffles, materialise, slices, small_batches, texts
from plumbline.llm.components import components
from plumbline.llm.hashing import WordHashes, mixed

#: Bits of the smallest bitmap; larger sets get ``SPREAD`` to twice as many bits a shingle, so that
#: few shingles of near copies share a bit and most pairs below the threshold are told by their bits.
LEAST_BITS, SPREAD = 512, 8
#: Documents whose words and shingles are counted to tell frequent ones, and how many are kept.
SAMPLE_DOCUMENTS, SAMPLE_OFTEN, FREQUENT = 2_000, 3, 200_000
#: Members of a tile compared in one block, and 64-bit words of the bitmap that goes with each of
#: them; sets of ``WIDE`` or more shingles have a wider one, which is compared per distinct pair.
BLOCK, TILE_WORDS = 512, 32
WIDE = 64 * TILE_WORDS // SPREAD


def word_hashes(text: bytes, memory: WordHashes) -> np.ndarray:
    """Hashes of the words after lower-casing A-Z."""
    found = text.lower().split()
    return np.fromiter(map(memory.__getitem__, found), np.uint64, len(found))


def _windows(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    width = min(size, len(hashes))
    last = len(hashes) - width + 1
    return [hashes[i : last + i] for i in range(width)]


def shingle_set(text: bytes, size: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of word shingles."""
    hashes = word_hashes(text, memory)
    return np.unique(mixed(_windows(hashes, size))) if len(hashes) else hashes


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Hashed bits of a set; the width follows its size, so it differs at most twofold in a tile."""
    width = max(LEAST_BITS, 1 << (SPREAD * len(shingles)).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(shingles % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that the same set has at a smaller width."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def _narrow(profiles: DataFrame) -> DataFrame:
    """Rows (node, bits) with bitmaps of ``TILE_WORDS`` words at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [folded(v.values.to_numpy(), TILE_WORDS) for v in batch.column("bits")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(maps)], ["node", "bits"])

    return profiles.select("node", "bits").mapInArrow(run, "node bigint, bits array<bigint>")


def differing(p: np.ndarray, q: np.ndarray) -> int:
    """At most as many bits differ as shingles are in one set alone."""
    words = min(len(p), len(q))
    return int(np.bitwise_count((folded(p, words) ^ folded(q, words)).view(np.uint64)).sum())


def least_overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection with 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _set_rows(rows: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, node, n, shingles): the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in slices(batches, "text"):
            sets = [shingle_set(v, size, memory) for v in batch.column("text").cast(pa.binary()).to_pylist()]
            nodes, counts = pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), nodes, counts, _lists(sets)], ["doc_id", "node", "n", "shingles"]
            )

    return rows.mapInArrow(run, "doc_id bigint, node bigint, n bigint, shingles array<bigint>")


def _word_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in slices(batches, "text"):
            found = [np.unique(word_hashes(v, memory)) for v in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["s"])

    return rows.mapInArrow(run, "s bigint")


class Order:
    """How common a shingle seems: by the words in it, and whether it is a frequent one itself.

    Both come from a bounded sample and are bounded in number. Any order gives the same
    results; one that puts rare shingles first gives few candidates.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, frequent: np.ndarray) -> None:
        by = np.argsort(words)
        self.words, self.levels = words[by], np.ceil(np.log2(counts[by] + 1)).astype(np.int64)
        self.frequent = np.sort(frequent)

    def _found(self, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return at, known[at] == values

    def profile(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingles, and the same from rare to common."""
        if not len(hashes):
            return hashes, hashes
        at, known = self._found(self.words, hashes)
        levels = np.where(known, self.levels[at], 0) if len(self.words) else np.zeros(len(hashes), np.int64)
        shingles, first = np.unique(mixed(_windows(hashes, size)), return_index=True)
        level = sum(_windows(levels, size))[first] + (self._found(self.frequent, shingles)[1].astype(np.int64) << 20)
        return shingles, shingles[np.argsort(level, kind="stable")]


def _order(rows: DataFrame, size: int) -> Order:
    ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    sample = rows.join(F.broadcast(materialise(ids, "sampled")), "doc_id", "left_semi")

    def often(found: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
        counted = found.groupBy("s").count().filter(F.col("count") >= least)
        top = counted.orderBy(F.desc("count"), "s").limit(FREQUENT).toArrow()
        return top.column("s").to_numpy().view(np.uint64), top.column("count").to_numpy()

    words, counts = often(_word_rows(sample), 2)
    frequent, _ = often(_set_rows(sample, size).select(F.explode("shingles").alias("s")), SAMPLE_OFTEN)
    return Order(words, counts, frequent)


def _profiles(rows: DataFrame, size: int, percent: int, order: Order) -> DataFrame:
    """Rows (doc_id, node, n, prefix, bits) of every document."""
    sent = rows.sparkSession.sparkContext.broadcast((order.words, order.levels, order.frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, ranked = WordHashes(), Order.__new__(Order)
        ranked.words, ranked.levels, ranked.frequent = sent.value
        for batch in slices(batches, "text"):
            nodes, counts, prefixes, bitmaps = [], [], [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                shingles, ordered = ranked.profile(word_hashes(value, memory), size)
                length = len(shingles) - -(-percent * len(shingles) // 100) + 1 if len(shingles) else 0
                nodes.append(_node(shingles))
                counts.append(len(shingles))
                prefixes.append(ordered[:length])
                bitmaps.append(bitmap(shingles))
            columns = [batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, _lists(prefixes), _lists(bitmaps)], ["doc_id", "node", "n", "prefix", "bits"]
            )

    return rows.mapInArrow(run, "doc_id bigint, node bigint, n bigint, prefix array<bigint>, bits array<bigint>")


def _plausible(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and bitmaps leave the threshold within reach."""

    def side(name: str) -> DataFrame:
        return profiles.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "bits")])

    joined = pairs.distinct().join(side("b").drop("b_bits"), "b").join(side("a").drop("a_bits"), "a")
    both = F.col("a_n") + F.col("b_n")
    near = joined.filter(F.least("a_n", "b_n") >= F.ceil(F.lit(percent) * both / (100 + percent))).select("a", "b")
    joined = near.join(side("b"), "b").join(side("a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            n, m = (batch.column(f"{x}_n").to_numpy() for x in "ab")
            left, right = batch.column("a_bits"), batch.column("b_bits")
            for i in range(batch.num_rows):
                need = least_overlap(int(n[i]), int(m[i]), percent)
                if 2 * need <= n[i] + m[i] - differing(left[i].values.to_numpy(), right[i].values.to_numpy()):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(kept, pa.int32())) for c in "ab"], ["a", "b"])

    return joined.mapInArrow(run, "a bigint, b bigint")


def _verified(
    pairs: DataFrame, profiles: DataFrame, rows: DataFrame, repeated: DataFrame, size: int, percent: int
) -> DataFrame:
    """Edges (a, b) among plausible pairs of nodes whose similarity reaches the threshold.

    The whole sets of the nodes in plausible pairs are made again from their texts, one per
    node: ids that occur once name the text, the sets of null and ``repeated`` ids are told apart.
    Nothing but the edges and these sets stays on disk.
    """
    told = (profiles, rows, repeated, size, percent)
    return alone(rows.sparkSession, "links", lambda: _exact(pairs, *told), keep=("sets",))


def _exact(pairs: DataFrame, profiles: DataFrame, rows: DataFrame, repeated: DataFrame, size: int, percent: int) -> DataFrame:
    pairs = materialise(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = materialise(profiles.select("node", "doc_id").join(nodes, "node"), "wanted")
    ids = wanted.select("doc_id").distinct()
    named = _set_rows(rows.join(ids, "doc_id", "left_semi").join(repeated, "doc_id", "left_anti"), size)
    unclear = rows.join(ids.join(repeated, "doc_id", "left_semi"), "doc_id", "left_semi").union(rows.filter("doc_id is null"))
    unclear = _set_rows(unclear, size).join(nodes, "node", "left_semi").dropDuplicates(["node"])
    sets = materialise(named.select("node", "shingles").union(unclear.select("node", "shingles")), "sets")

    def side(name: str) -> DataFrame:
        return sets.select(F.col("shingles").alias(f"{name}_shingles"), F.col("node").alias(name))

    # The second node of a pair may be the leader of many; it is joined while rows are short.
    joined = pairs.join(side("b"), "b").join(side("a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                kept = []
                for i in range(batch.num_rows):
                    x, y = (batch.column(f"{s}_shingles")[i].values.to_numpy() for s in "ab")
                    need = least_overlap(len(x), len(y), percent)
                    if min(len(x), len(y)) < need:
                        continue
                    x, y = (x, y) if len(x) <= len(y) else (y, x)
                    x, y = x.view(np.uint64), y.view(np.uint64)
                    if int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) >= need:
                        kept.append(i)
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(kept, pa.int32())) for c in "ab"], ["a", "b"])

    return joined.mapInArrow(run, "a bigint, b bigint")


def _leader_pairs(members: DataFrame, seed: int) -> DataFrame:
    """Each member with the leaders of its own tiles and of the next band's tiles of the shingle.

    Seed 0: the same order of members in every tile, so that few lead; otherwise an order of
    each shingle's own, so that a member meets about as many leaders as it has tiles.
    """
    order = F.struct("first_id", "node") if seed == 0 else F.struct(F.xxhash64("node", "token", F.lit(seed)), "node")
    leaders = members.groupBy("token", "band").agg(
        F.min(F.struct(order.alias("leader"), "label")).alias("head"), F.count("*").alias("size")
    )
    lower = leaders.select("token", (F.col("band") - 1).alias("band"), "head", F.lit(2).alias("size"))
    both = leaders.filter("size > 1").union(lower)
    pairs = members.join(both, ["token", "band"]).filter(F.col("label") != F.col("head.label"))
    return pairs.select(F.col("node").alias("a"), F.col("head.leader").alias("leader"))


def _mixed(members: DataFrame) -> DataFrame:
    """Tiles that, with the next band's of the shingle, hold more than one component.

    ``untested``: they hold pairs in which neither is a leader; ``alike`` tells the sets of members.
    """
    # A node is once in a tile, so both hashes of its set are the same in any order.
    names = {"own": ["own_x", "own_y"], "next": ["next_x", "next_y"]}
    sets = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(c) for i, c in enumerate(names["own"])]
    sides = [F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("own"), *sets]
    tiles = members.groupBy("token", "band").agg(*sides)
    above = tiles.withColumn("band", F.col("band") - 1).withColumnsRenamed(dict(zip(["own", *names["own"]], ["next", *names["next"]])))
    none = dict.fromkeys([*names["own"], *names["next"], "own", "next"], F.lit(0).cast("bigint"))
    wide = tiles.withColumns({c: v for c, v in none.items() if c not in tiles.columns})
    wide = wide.unionByName(above.withColumns({c: v for c, v in none.items() if c not in above.columns}))
    sums = [F.sum(c).alias(c) for c in names] + [F.bit_xor(c).alias(c) for side in names.values() for c in side]
    wide = wide.groupBy("token", "band").agg(F.min("low").alias("low"), F.max("high").alias("high"), *sums)
    mixed = wide.filter((F.col("low") < F.col("high")) & (F.col("own") > 0))
    untested = (F.col("own") > 2) | (F.col("next") > 1)
    alike = F.struct("own", "next", *names["own"], *names["next"]).alias("alike")
    return mixed.select("token", "band", (F.col("own") + F.col("next")).alias("size"), untested.alias("untested"), alike)


def _distinct_tiles(tiles: DataFrame) -> DataFrame:
    """One of the tiles that hold the same members, which the shingles that near copies share make."""
    return tiles.groupBy("band", "alike").agg(F.min("token").alias("token"), F.first("size").alias("size")).drop("alike")


def _tile_pairs(members: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, wide) of different components in mixed tiles that narrow bitmaps cannot rule out.

    ``wide``: the two sets have wider bitmaps as well.
    """
    mixed = materialise(_distinct_tiles(_mixed(members).filter("untested")), "mixed")
    own = members.join(mixed, ["token", "band"]).withColumn("upper", F.lit(False))
    next_ = members.withColumn("band", F.col("band") - 1).join(mixed, ["token", "band"]).withColumn("upper", F.lit(True))
    rows = own.unionByName(next_).join(_narrow(profiles), "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select(
        "token",
        "band",
        F.least("mine", "other").alias("x"),
        F.greatest("mine", "other").alias("y"),
        (F.col("mine") <= F.col("other")).alias("left"),
        "upper",
        "node",
        "label",
        "n",
        "bits",
    )
    keys = ["token", "band", "x", "y"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def compare(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, label, n = (tile.column(c).to_numpy() for c in ("node", "label", "n"))
        upper, left = (tile.column(c).to_numpy(zero_copy_only=False) for c in ("upper", "left"))
        diagonal = tile.column("x")[0].as_py() == tile.column("y")[0].as_py()
        maps = [v.values.to_numpy() for v in tile.column("bits")]
        words = min(map(len, maps))
        bits = np.stack([folded(b, words) for b in maps]).view(np.uint64)
        found_a, found_b, wide = [], [], []
        for i in range(len(node)):
            if not left[i]:
                continue
            others = np.flatnonzero((label != label[i]) & ~(upper & upper[i]) & (~left | diagonal))
            others = others[others > i] if diagonal else others
            need = -(-percent * (n[i] + n[others]) // (100 + percent))
            others = others[need <= np.minimum(n[i], n[others])]
            need = -(-percent * (n[i] + n[others]) // (100 + percent))
            differ = np.bitwise_count(bits[others] ^ bits[i]).sum(1, dtype=np.int64)
            others = others[2 * need <= n[i] + n[others] - differ]
            found_a.append(np.full(len(others), node[i]))
            found_b.append(node[others])
            wide.append(np.minimum(n[i], n[others]) >= WIDE)
        if not found_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return np.concatenate(found_a), np.concatenate(found_b), np.concatenate(wide)

    def answer(tile: pa.Table) -> pa.RecordBatch:
        a, b, wide = compare(tile)
        columns = [pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64()), pa.array(wide)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "wide"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in keys]
            names = list(zip(*columns))
            start = 0
            for i, name in enumerate(names):
                if last is not None and name != last:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if sum(h.num_rows for h in held) > 1:
                        yield answer(pa.Table.from_batches(held))
                    held, start = [], i
                last = name
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if sum(h.num_rows for h in held) > 1:
            yield answer(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a bigint, b bigint, wide boolean").distinct()


def _contracted(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Members of tiles that still hold several components."""

    def make() -> DataFrame:
        labels = components(edges)
        found = members.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        return _open_members(materialise(found, "labelled"))

    return alone(members.sparkSession, "open", make)


def similar_components(
    df: DataFrame, percent: int, size: int, key: str = "doc_id", text: str = "text", rounds: int = 1
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_copies) for links of similarity percent / 100 or more.

    ``component_id``: smallest id reachable by links; ``n_copies``: rows of the same class.
    ``rounds`` compare members with all leaders of their tiles, the first with one order of the
    members, others with an order per shingle: more of them leave fewer pairs where large groups
    of near copies miss each other's leaders; the result is the same. What runs in Python is
    written here, in small batches; the result and the sets compared stay on disk.
    """
    spark = df.sparkSession
    with small_batches(spark), freed_shuffles(spark):
        return alone(spark, "similar", lambda: _similar_components(df, percent, size, key, text, rounds), keep=("sets",))


def _similar_components(df: DataFrame, percent: int, size: int, key: str, text: str, rounds: int) -> DataFrame:
    rows = texts(df, key, text)
    every = materialise(_profiles(rows, size, percent, _order(rows, size)), "profiles")
    full = every.filter("n > 0")
    classes = full.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
    classes = materialise(classes, "classes")
    # One document stands for its class, also where the class has no id or repeats one.
    single = full.join(classes, "node").filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).dropDuplicates(["node"])
    postings = single.select("node", F.explode("prefix").alias("token"))
    shared = postings.groupBy("token").count().filter("count > 1").select("token")
    postings = materialise(postings.join(shared, "token"), "postings")
    step = math.log(100 / percent)
    band = F.floor(F.log("n") / step + 1e-9)
    alive = postings.select("node").distinct()
    profiles = single.join(alive, "node", "left_semi")
    profiles = materialise(profiles.select("node", "doc_id", "first_id", "n", "bits", band.alias("band")), "bits")
    members = postings.join(profiles.select("node", "first_id", "n", "band"), "node").withColumn("label", F.col("node"))
    members = materialise(members, "members")

    # First one leader for each class, the one of the smallest id; then all that are left.
    repeated = every.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    told = (profiles, rows, materialise(repeated, "repeated-ids"), size, percent)
    first = _leader_pairs(members, 0).groupBy("a").agg(F.min("leader")["node"].alias("b"))
    edges = _verified(_plausible(first, profiles, percent), *told)
    members = _contracted(members, edges)
    for seed in range(rounds):
        leaders = _leader_pairs(members, seed).select("a", F.col("leader.node").alias("b"))
        edges = edges.union(_verified(_plausible(leaders, profiles, percent), *told))
        members = _contracted(members, edges)
    pairs = materialise(_tile_pairs(members, profiles, percent), "tile-pairs")
    wide = _plausible(pairs.filter("wide").select("a", "b"), profiles.filter(F.col("n") >= WIDE), percent)
    edges = edges.union(_verified(pairs.filter("not wide").select("a", "b").union(wide), *told))
    labels = components(edges)

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "label").select("node", "component_id", "n_copies")
    return (
        every.select("doc_id", "node", "n")
        .join(named, "node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        )
    )


def _open_members(members: DataFrame) -> DataFrame:
    """Members of mixed tiles and of the next band that such a tile looks at."""
    mixed = _mixed(members)
    tiles = mixed.select("token", "band").union(mixed.select("token", F.col("band") + 1)).distinct()
    return members.join(tiles, ["token", "band"], "left_semi")
