"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model is trained on all trusted texts of one half of the ids, whole; the other half sets
the limits. (Callers may bound the training texts; the languages then take turns, each giving
its texts in hash order.) Trigrams are counted in groups of the same first two words, some middle
words at a time; continuation counts, count-of-count discounts, context totals and back-off
weights follow from them by further grouping. The model stays distributed in shards by n-gram hash: slices of the
documents send each shard their distinct n-grams, get back what it knows of them, and every
whole text is scored in its slice. Counts and contexts are entries of their own, divided where
a text is scored, so no table of n-grams is joined. Per language the limit is a quantile of the perplexity of the
trusted texts that the model has not seen, counted over all of them, plus a margin that is
the wider the fewer they are: ``margin`` * (1 + ``doubt`` / n). A language without any has
no limit, since nothing is known about its good texts; no limit comes from other languages.

Null text counts as empty; a text without words is not kept. A null language is a
language of its own, a null id is trusted by nobody. Repeated rows are scored one by one;
an id labelled more than once is trusted if any label says so; of an id with several texts
each one is used for itself, and none of them sets a limit if one was trained on. Without trusted
text every text with words is kept. Other columns are ignored, text length is
not limited, an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import alone, freed_shuffles, materialise, slices, texts
from plumbline.llm.hashing import mixed
from plumbline.session import hand_over, scratch_path, scratch_scope

#: N-grams in a shard of the model, text of a slice, and parts of the slices scored in turn.
SHARD, SLICE_BYTES, WAVES = 1_000_000, 8 << 20, 12
#: Trigrams of a task that are packed at once; bytes of text per n-gram of a model, about; and
#: parts of the trigrams, by their middle words, that are counted in turn.
PIECE, NGRAM_BYTES, TURNS = 1_000_000, 4, 4
#: Share of unseen trusted texts below the limit, and what is added to its log10.
QUANTILE, MARGIN = 0.995, 0.10
#: Unseen trusted texts of a language at which its margin is twice the plain one.
DOUBT = 10
#: Steps of log10 perplexity that are told apart when quantiles are counted.
GRID = 1_000
START, END = np.uint64(1), np.uint64(2)


def padded_hashes(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents, each with two starts and an end; and where each begins."""
    found = [text.split() for text in documents]
    coded = pa.array([word for words in found for word in words], pa.binary()).dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    stops = np.cumsum(sizes + 3)
    begins = stops - sizes - 3
    hashes = np.full(int(stops[-1]) if len(stops) else 0, START, np.uint64)
    hashes[stops - 1] = END
    inner = np.ones(len(hashes), bool)
    inner[begins] = inner[begins + 1] = inner[stops - 1] = False
    hashes[inner] = distinct[coded.indices.to_numpy()]
    return hashes, begins


def _order(keys: np.ndarray) -> np.ndarray:
    """Order that sorts the keys: leading bits and positions are sorted as one number, which is faster."""
    mask = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~mask | np.arange(len(keys), dtype=np.uint64)) & mask).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = order[np.argsort(ordered, kind="stable")]
    return order


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so that sorted keys lie by shard."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _by_shard(of_key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ascending shards the distinct ones, and where the keys of each begin and end."""
    begins = _firsts(of_key)
    return of_key[begins].astype(np.int64), begins, np.append(begins[1:], len(of_key))


#: What is known of an n-gram: how often it was counted, how often it is followed, and by how
#: many different words once, twice and more often.
VALUES = ("counts", "followed", "ones", "twos", "more")
PACKED = "keys binary, " + ", ".join(f"{name} binary" for name in VALUES)
#: Kinds of packed rows: the order of their n-grams, or pairs of words that are yet to be counted.
PAIRS = 0


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in a byte each; those from 255 on follow in full. Zeros take nothing."""
    if not values.any():
        return b""
    short = np.minimum(values, 255).astype(np.uint8)
    return short.tobytes() + values[short == 255].astype(np.int64).tobytes()


def _wide(packed: bytes, size: int) -> np.ndarray:
    """So many numbers from their narrow form."""
    if not packed:
        return np.zeros(size, np.int64)
    values = np.frombuffer(packed, np.uint8, size).astype(np.int64)
    values[values == 255] = np.frombuffer(packed, np.int64, offset=size)
    return values


def _planes(keys: np.ndarray) -> bytes:
    """Sorted keys by bytes of one place, of which the leading ones compress well."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the keys, and where each distinct one begins in it."""
    order = _order(keys)
    return order, _firsts(keys[order])


def _followers(counts: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Values of contexts from the counts of what follows them; ``first``: where each context begins."""
    parts = {"followed": counts, "ones": counts == 1, "twos": counts == 2, "more": counts > 2}
    return {name: np.add.reduceat(v.astype(np.int64), first) if len(first) else counts for name, v in parts.items()}


def _pieces(kind: int, of_key: np.ndarray, keys: list[np.ndarray], **values: np.ndarray) -> pa.Table:
    """Packed rows, one per shard; the shards of the keys ascend."""
    found, begins, ends = _by_shard(of_key)
    cuts = list(zip(begins, ends))
    columns = [pa.array(found), pa.array(np.full(len(found), kind, np.int32))]
    columns.append(pa.array([b"".join(k[i:j].tobytes() for k in keys) for i, j in cuts], pa.binary()))
    for name in VALUES:
        columns.append(pa.array([_narrow(values[name][i:j]) if name in values else b"" for i, j in cuts], pa.binary()))
    return pa.table(columns, ["shard", "kind", "keys", *VALUES])


PIECES = f"shard bigint, kind int, {PACKED}"


def _unpacked(packed: pa.Table, words: int = 1, names: tuple[str, ...] = VALUES) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys (of so many words each) and values of all rows, one after the other."""
    keys = [np.frombuffer(k.as_buffer(), np.uint64).reshape(words, -1) for k in packed.column("keys")]
    values = [[_wide(v, k.shape[1]) for v, k in zip(packed.column(n).to_pylist(), keys)] for n in names]
    none = np.zeros((words, 0), np.uint64)
    return np.concatenate([none, *keys], axis=1), [np.concatenate([np.zeros(0, np.int64), *v]) for v in values]


def _trigrams(rows: DataFrame, turn: int, turns: int, groups: int) -> DataFrame:
    """Trigrams of pieces of the texts, packed by the first two words; middle words take turns."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.concatenate(held, axis=1)
        order, first = _distinct(mixed(list(grams)))
        counts = np.diff(np.append(first, len(order)))
        grams = grams[:, order[first]]
        group = _shard(mixed(list(grams[:2])), groups)
        by = np.argsort(group, kind="stable")
        table = _pieces(3, group[by], list(grams[:, by]), counts=counts[by])
        return table.select(["shard", "keys", "counts"]).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in slices(batches, "text"):
            hashes, begins = padded_hashes(batch.column("text").cast(pa.binary()).to_pylist())
            real = np.ones(len(hashes), bool)
            real[begins] = real[begins + 1] = False
            ends = np.flatnonzero(real)
            ends = ends[_shard(hashes[ends - 1], turns) == turn]
            held.append(np.stack([hashes[ends - back] for back in (2, 1, 0)]))
            if sum(h.shape[1] for h in held) >= PIECE:
                yield packed(held)
                held = []
        if sum(h.shape[1] for h in held):
            yield packed(held)

    return rows.mapInArrow(run, "shard bigint, keys binary, counts binary")


def _counted(shards: int, groups: int) -> Callable[[pa.Table], pa.Table]:
    """From all trigrams of a group their entries, those of their contexts, and the pairs that end them."""

    def run(parts: pa.Table) -> pa.Table:
        grams, (counts,) = _unpacked(parts, 3, ("counts",))
        keys = mixed(list(grams))
        order, first = _distinct(keys)
        counts, grams, keys = np.add.reduceat(counts[order], first), grams[:, order[first]], keys[order[first]]
        made = [_pieces(3, _shard(keys, shards), [keys], counts=counts)]
        keys = mixed(list(grams[:2]))
        order, first = _distinct(keys)
        contexts = keys[order[first]]
        made.append(_pieces(2, _shard(contexts, shards), [contexts], **_followers(counts[order], first)))
        keys = mixed(list(grams[1:]))
        order, first = _distinct(keys)
        pairs = list(grams[1:, order[first]])
        made.append(_pieces(PAIRS, _shard(keys[order[first]], groups), pairs, counts=np.diff(np.append(first, len(order)))))
        return pa.concat_tables(made)

    return run


def _paired(shards: int) -> Callable[[pa.Table], pa.Table]:
    """From all pairs of a group their entries and what they add to those of their words."""

    def run(parts: pa.Table) -> pa.Table:
        pairs, (counts,) = _unpacked(parts, 2, ("counts",))
        keys = mixed(list(pairs))
        order, first = _distinct(keys)
        counts, pairs, keys = np.add.reduceat(counts[order], first), pairs[:, order[first]], keys[order[first]]
        made = [_pieces(2, _shard(keys, shards), [keys], counts=counts)]
        begun, ended = (mixed([words]) for words in pairs)
        order, first = _distinct(begun)
        keys = begun[order[first]]
        made.append(_pieces(1, _shard(keys, shards), [keys], **_followers(counts[order], first)))
        order, first = _distinct(ended)
        keys = ended[order[first]]
        made.append(_pieces(1, _shard(keys, shards), [keys], counts=np.diff(np.append(first, len(order)))))
        return pa.concat_tables(made)

    return run


def _merged(parts: pa.Table) -> pa.Table:
    """One row of sorted keys; the values that different rows have for a key meet in it."""
    (keys,), values = _unpacked(parts)
    order, first = _distinct(keys)
    values = [np.add.reduceat(v[order], first) for v in values]
    counts = values[0]
    tally = [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts > 0).sum()), int(counts.sum())]
    columns = [keys[order[first]].tobytes(), *map(_narrow, values)]
    packed = {n: pa.array([c], pa.binary()) for n, c in zip(["keys", *VALUES], columns)}
    heads = {n: parts.column(n)[:1] for n in ("shard", "kind")}
    return pa.table({**heads, **packed, "tally": pa.array([tally], pa.list_(pa.int64()))})


def _tallies(entries: DataFrame) -> list[int]:
    """How many n-grams were counted once to four times, how many at all, and the sum of their counts."""
    return list(entries.agg(*(F.coalesce(F.sum(F.col("tally")[i]), F.lit(0)) for i in range(6))).first())


def _discounts(tally: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    ones, twos, threes, fours = tally[:4]
    if not (ones and twos and threes):
        return [0.5, 0.75, 1.0]
    y = ones / (ones + 2 * twos)
    raw = [1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


@dataclass
class Model:
    """Packed entries of all n-grams of an order in a shard by their hash, and what all share.

    Rows (shard, kind, keys, values): ``kind`` is the order; the weight that the discounts leave
    over after an n-gram follows from its values. ``discounts`` and ``total``: of each order,
    and of all unigrams. ``floor``: what any word gets.
    """

    entries: DataFrame
    shards: int
    floor: float
    discounts: list[list[float]]
    total: float


def _by_kind(df: DataFrame, label: str) -> str:
    """Path of packed rows, each kind in a folder of its own."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy("kind").parquet(path)
    return path


def _of_kind(spark: SparkSession, paths: list[str], kind: int) -> DataFrame:
    schema = PIECES.replace(" kind int,", "") + ", kind int"
    read = [spark.read.schema(schema).parquet(path).filter(F.col("kind") == kind) for path in paths]
    return reduce(DataFrame.union, read).select("shard", "kind", "keys", *VALUES)


def train(trusted: DataFrame) -> Model:
    """Model of all texts of a table with a column ``text``; it stays distributed.

    Only its entries stay on disk; what they are made from is deleted step by step. Trigrams
    with some middle words are counted at a time, so that those words' contexts and pairs are whole.
    """
    spark = trusted.sparkSession
    with scratch_scope(spark) as counted:
        paths, shards = _count(trusted)
        entries, tallies = [], []
        with scratch_scope(spark) as owned:
            # One order after the other: the pieces and shuffles of one are on disk twice at a time.
            for kind in (3, 2, 1):
                with scratch_scope(spark) as pieces:
                    pieces.extend(f"{path}/kind={kind}" for path in paths)
                    merged = _of_kind(spark, paths, kind).groupBy("shard").applyInArrow(_merged, f"{PIECES}, tally array<bigint>")
                    entries.append(materialise(merged, "entries"))
                    owned.append(pieces.pop())
                tallies.append(_tallies(entries[-1]))
            kept, owned[:] = list(owned), []
        counted.extend(paths)
    hand_over(kept)
    discounts = [_discounts(tally) for tally in reversed(tallies)]
    ones, twos, _, _, words, total = tallies[-1]
    left = float(np.dot(discounts[0], [ones, twos, words - ones - twos])) / total if total else 1.0
    return Model(reduce(DataFrame.union, entries), shards, left / (words + 1), discounts, float(total or 1))


def _count(trusted: DataFrame) -> tuple[list[str], int]:
    """Paths of the packed pieces of all entries, and the number of shards they are packed for."""
    spark = trusted.sparkSession
    with scratch_scope(spark) as owned:
        rows = materialise(trusted, "learnt")
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
        shards = 1 + size // (NGRAM_BYTES * SHARD)
        turns = min(TURNS, shards)
        groups = 1 + shards // turns
        paths = []
        for turn in range(turns):
            grams = _trigrams(rows, turn, turns, groups).groupBy("shard")
            paths.append(_by_kind(grams.applyInArrow(_counted(shards, groups), PIECES), "trigrams"))
            with scratch_scope(spark) as done:
                done.append(f"{paths[-1]}/kind={PAIRS}")
                pairs = _of_kind(spark, paths[-1:], PAIRS).groupBy("shard")
                paths.append(_by_kind(pairs.applyInArrow(_paired(shards), PIECES), "pairs"))
                done.remove(paths[-1])
        owned[:] = [path for path in owned if path not in paths]
    return paths, shards


def _tokens(texts_: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, where each text begins and where its tokens lie."""
    hashes, begins = padded_hashes(texts_.cast(pa.binary()).to_pylist())
    real = np.ones(len(hashes), bool)
    real[begins] = real[begins + 1] = False
    return hashes, begins, np.flatnonzero(real)


def _keys(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams that end at the tokens; words and neighbouring pairs, which may be contexts too."""
    return mixed([h[ends - 2], h[ends - 1], h[ends]]), np.concatenate([mixed([h]), mixed([h[:-1], h[1:]])])


def _asked(shards: int) -> Callable[[pa.Table], pa.Table]:
    """Per shard the distinct n-grams of a slice, however often they occur."""

    def run(slice_: pa.Table) -> pa.Table:
        h, _, ends = _tokens(slice_.column("text"))
        packed: list[list[bytes]] = []
        for keys in _keys(h, ends):
            keys = np.sort(keys)
            keys = keys[_firsts(keys)]
            cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
            packed.append([_planes(keys[i:j]) for i, j in zip(cuts[:-1], cuts[1:])])
        rows = [(shard, *row) for shard, row in enumerate(zip(*packed)) if any(row)]
        name = slice_.column("slice")[0].as_py()
        found, grams, lower = zip(*rows) if rows else ((), (), ())
        return pa.table(
            {"slice": pa.array([name] * len(rows), pa.int64()), "shard": pa.array(found, pa.int64())}
            | {"grams": pa.array(grams, pa.binary()), "lower": pa.array(lower, pa.binary())}
        )

    return run


ANSWERS = "slice bigint, shard bigint, grams binary, " + ", ".join(f"{name} binary" for name in VALUES)


def _known(entries: pa.Table, kinds: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted keys of such orders, and their values with one more for unknown ones."""
    chosen = entries.filter(pa.array([kind in kinds for kind in entries.column("kind").to_pylist()], pa.bool_()))
    (keys,), values = _unpacked(chosen)
    order = _order(keys)
    return keys[order], [np.append(v[order], 0) for v in values]


def _answered(asked: pa.Table, entries: pa.Table) -> pa.Table:
    """What a shard of the model knows of the n-grams of each slice, in the order of the questions."""

    def places(keys: np.ndarray, packed: pa.Scalar) -> np.ndarray:
        wanted = _from_planes(packed.as_buffer())
        if not len(keys):
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, len(keys))

    grams, (times, *_) = _known(entries, (3,))
    lower, values = _known(entries, (1, 2))
    rows: list[tuple] = []
    for above, below in zip(asked.column("grams"), asked.column("lower")):
        at = places(lower, below)
        rows.append((_narrow(times[places(grams, above)]), *(_narrow(v[at]) for v in values)))
    columns = list(zip(*rows)) or [()] * 6
    packed = {n: pa.array(c, pa.binary()) for n, c in zip(["grams", *VALUES], columns)}
    return pa.table({"slice": asked.column("slice"), "shard": asked.column("shard"), **packed})


def _judged(floor: float, discounts: list[list[float]], total: float, shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Mean log10 of P(c | a b) per text of a slice, the lower orders interpolated."""

    def answer(keys: np.ndarray, rows: pa.Table, names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Place of each key among the distinct ones, and their values; those were asked for by shard."""
        order, first = _distinct(keys)
        sizes = np.bincount(_shard(keys[order[first]], shards).astype(np.int64), minlength=shards)
        place = np.empty(len(keys), np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        own = sizes[rows.column("shard").to_numpy()]
        found = []
        for name in names:
            found.append(np.concatenate([_wide(v, n) for v, n in zip(rows.column(name).to_pylist(), own)]))
        return place, found

    def run(slice_: pa.Table, answers: pa.Table) -> pa.Table:
        h, begins, ends = _tokens(slice_.column("text"))
        grams, lower = _keys(h, ends)
        answers = answers.sort_by("shard")
        triple, (times,) = answer(grams, answers, ("grams",))
        place, (counts, followed, *after) = answer(lower, answers, VALUES)
        single, pair = place[: len(h)], place[len(h) :]

        def left(values: list[float]) -> np.ndarray:
            return np.where(followed > 0, sum(d * v for d, v in zip(values, after)) / np.maximum(followed, 1), 1.0)

        def taken(n: np.ndarray, values: list[float]) -> np.ndarray:
            return n - np.array([0.0, *values])[np.minimum(n, 3)]

        p = taken(counts, discounts[0])[single[ends]] / max(total, 1) + floor
        context = single[ends - 1]
        p = taken(counts, discounts[1])[pair[ends - 1]] / np.maximum(followed, 1)[context] + left(discounts[1])[context] * p
        context = pair[ends - 2]
        p = taken(times, discounts[2])[triple] / np.maximum(followed, 1)[context] + left(discounts[2])[context] * p
        logs = np.zeros(len(h))
        logs[ends] = np.log10(p)
        sizes = np.diff(np.append(begins, len(h))) - 2
        ppl = -np.add.reduceat(logs, begins) / sizes
        return pa.table(
            {"doc_id": slice_.column("doc_id"), "lang": slice_.column("lang"), "n_words": pa.array(sizes - 1, pa.int64()), "log_perplexity": pa.array(ppl)}
        )

    return run


def score(rows: DataFrame, model: Model, waves: int = 1) -> DataFrame:
    """Rows (doc_id, lang, n_words, log_perplexity); rows: doc_id, text, lang.

    Rows are dealt to slices of bounded size by content. A slice asks every shard of the model for
    its distinct n-grams and judges its texts by the answers. ``waves`` take turns, so that the
    questions and answers of a part of the slices are on disk at a time.
    """
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    count = 1 + size // SLICE_BYTES
    dealt = rows.select("doc_id", "text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).alias("slice"))
    judge = _judged(model.floor, model.discounts, model.total, model.shards)
    parts = []
    for wave in range(min(waves, count)):
        part = dealt.filter(F.pmod("slice", F.lit(min(waves, count))) == wave)
        asked = part.groupBy("slice").applyInArrow(_asked(model.shards), "slice bigint, shard bigint, grams binary, lower binary")
        answered = asked.groupBy("shard").cogroup(model.entries.groupBy("shard"))
        answered = answered.applyInArrow(_answered, ANSWERS)
        judged = part.groupBy("slice").cogroup(answered.groupBy("slice"))
        schema = "doc_id bigint, lang string, n_words bigint, log_perplexity double"
        parts.append(materialise(judged.applyInArrow(judge, schema), "perplexity"))
    return reduce(DataFrame.union, parts)


def _quantiles(scored: DataFrame, groups: list[str], share: float) -> DataFrame:
    """Rows (groups, limit, n): counted on a grid, so a group of any size is spread out."""
    cells = scored.groupBy(*groups, F.ceil(F.col("log_perplexity") * GRID).alias("cell")).count()
    by = Window.partitionBy(*groups)
    upto = F.sum("count").over(by.orderBy("cell"))
    ranked = cells.withColumns({"upto": upto, "n": F.sum("count").over(by)})
    reached = ranked.filter(F.col("upto") >= share * F.col("n"))
    return reached.groupBy(*groups).agg((F.min("cell") / GRID).alias("limit"), F.first("n").alias("n"))


def draw(trusted: DataFrame, documents: int) -> DataFrame:
    """At most so many rows (doc_id, lang, text_hash, ...), the languages taking turns in hash order.

    A uniform number per row thins every language to a little more than could be drawn, so the
    window that ranks a language holds a bounded number of rows, however many it has.
    """
    uniform = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 30)) / (1 << 30)
    sizes = trusted.groupBy("lang").agg(F.count("*").alias("size"))
    enough = documents + 10 * math.sqrt(documents) + 50
    thin = trusted.withColumn("uniform", uniform).join(sizes, "lang").filter(F.col("uniform") * F.col("size") <= enough)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("uniform", "doc_id", "text_hash"))
    return thin.withColumn("turn", turn).orderBy("turn", "uniform", "doc_id", "text_hash").limit(documents)


def quality_classifier(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_documents: int | None = None,
    train_chars: int | None = None,
    share: float = QUANTILE,
    margin: float = MARGIN,
    doubt: float = DOUBT,
) -> DataFrame:
    """Rows (doc_id, lang, n_words, perplexity, limit, kept) of every whole text.

    ``labels``: doc_id and quality; texts of quality 1 are trusted. ``limit`` is null where a
    language has no unseen trusted text. The model learns from all trusted texts of one half of
    the ids unless ``train_documents`` or ``train_chars`` bound it, and the others set the limits.
    """
    rows = texts(df, key, text, F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"))
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    if train_chars is not None:
        hashed = hashed.filter(F.length("text") <= train_chars)
    hashed = hashed.filter(F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0)
    # Two reads: no text is shuffled for the choice, and texts are fetched for the chosen rows alone.
    short = hashed.select("doc_id", "lang", "text_hash").join(trusted, "doc_id", "left_semi").distinct()
    drawn = ["doc_id", "lang", "text_hash"]
    chosen = short if train_documents is None else draw(short, train_documents).select(*drawn)
    chosen = materialise(chosen, "trusted")
    fetched = hashed.join(chosen, drawn, "left_semi").dropDuplicates(drawn)
    with freed_shuffles(df.sparkSession):
        # The model goes when all texts are scored.
        scored = alone(df.sparkSession, "scored", lambda: score(rows, train(fetched.select("text")), WAVES))
    seen = chosen.select("doc_id").distinct()
    unseen = scored.filter("n_words > 0").join(trusted, "doc_id", "left_semi").join(seen, "doc_id", "left_anti")
    width = margin * (1 + doubt / F.col("n"))
    limits = materialise(_quantiles(unseen, ["lang"], share).select("lang", (F.col("limit") + width).alias("limit")), "limits")
    judged = scored.join(limits, "lang", "left")
    below = F.coalesce(F.col("log_perplexity") <= F.col("limit"), F.lit(True))
    return judged.select(
        "doc_id",
        "lang",
        "n_words",
        F.pow(F.lit(10.0), "log_perplexity").alias("perplexity"),
        F.pow(F.lit(10.0), "limit").alias("limit"),
        ((F.col("n_words") > 0) & below).alias("kept"),
    )
