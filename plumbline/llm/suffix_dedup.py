"""Repeated byte strings removed, by hash-compared suffix sorting.

A string of ``length`` bytes that starts at two places is found as two equal suffix
heads. So that equal strings meet in one task, every window of ``length`` bytes is filed
under its anchor: the smallest hash among the shorter strings inside it, a choice that
depends on nothing but the window's bytes. Neighbouring windows share their anchor, so a
document has one entry per seventy bytes or so, and only anchors met twice go on.

The bytes around such anchors are sorted twice: what follows the anchor's start, and what
precedes it, read backwards. A bottom-up mergesort compares two suffixes by their longest
common extension, found by binary search over prefix polynomial hashes in a logarithmic
number of steps; neighbours in the order are then compared byte by byte, and a segment that
hashes put in a wrong order is sorted by its bytes. Windows at one distance from their
anchor are equal where they share enough in both orders. Equal surroundings are one entry
with a count, so copies of a document cost one entry however many there are.

An anchor with more than ``HOT`` different surroundings is not sorted but filed again: its
windows are halved by their distance from the anchor, and each half goes under the longer
string that all its windows hold. This repeats until no group is larger; at the end a group
is one window. So a task sorts a bounded number of entries, though all entries of one
anchor pass through one task at first.

Equal texts are judged once. Null text counts as empty; texts shorter than ``length`` keep
all bytes. Repeated rows are other places like any other, a null id is a value like any
other; other columns are ignored; an empty table gives an empty result; texts of any length
are sorted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import alone, freed_shuffles, materialise, slices, texts

LENGTH, ANCHOR = 200, 40
#: Bytes of surroundings sorted at once.
SORT_BYTES = 1 << 20
#: Different surroundings of one anchor that are sorted; more are filed again in halves.
HOT = 2048
#: Text whose anchors are chosen at once.
TEXT_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = np.frombuffer(
    b"".join(xxhash.xxh3_64_digest(bytes([i]), seed=7) for i in range(256)), dtype=">u8"
).astype(np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, size: int) -> np.ndarray:
    """base ** 0 .. base ** (size - 1), modulo 2 ** 64; kept for the largest size asked for."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < size:
        factors = np.full(max(size, 1 << 20), base, np.uint64)
        factors[0] = 1
        known = _POWERS[int(base)] = np.cumprod(factors)
    return known[:size]


class PrefixHashes:
    """Polynomial hashes of all substrings of a buffer from one array of prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        terms = _LETTERS[data] * _powers(_INVERSE, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        self.shift = _powers(_BASE, len(data) + 1)

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.shift[start]

    def every(self, size: int) -> np.ndarray:
        """Hashes of all substrings of one size, by their start."""
        found = self.sums[size:] - self.sums[:-size]
        found *= self.shift[: len(found)]
        return found


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def anchors(documents: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, place of the anchor, its hash) of every run of windows."""
    data = np.frombuffer(b"".join(documents), np.uint8)
    sizes = np.array([len(d) for d in documents], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    none = np.zeros(0, np.int64)
    if not (sizes >= length).any():
        return none, none, none, none, none.astype(np.uint64)
    width = length - anchor + 1
    grams = _mixed(PrefixHashes(data).every(anchor))
    # Smallest of each stretch of ``width``: from the ends of the blocks it touches.
    blocks = -(-len(grams) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    ranked = padded[: len(grams)]
    np.bitwise_and(grams, ~np.uint64((1 << 31) - 1), out=ranked)
    ranked |= np.arange(len(grams), dtype=np.uint64)
    windows = len(grams) - width + 1
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    # Runs of windows end where the choice changes and at the ends of documents; windows that
    # would cross into the next document do not exist.
    long = sizes >= length
    edges = np.flatnonzero(least[1:] != least[:-1]) + 1
    edges = np.unique(np.concatenate([edges, begins[long], (ends - length + 1)[long]]))
    runs = np.diff(np.append(edges, windows))
    owner = np.searchsorted(ends, edges, side="right")
    real = np.flatnonzero((owner < len(ends)) & (runs > 0))
    real = real[edges[real] <= ends[owner[real]] - length]
    first, runs, owner = edges[real], runs[real], owner[real]
    place = (least[first] & np.uint64((1 << 31) - 1)).astype(np.int64)
    return owner, first - begins[owner], runs, place - begins[owner], grams[place]


class SuffixSort:
    """Mergesort of windows in a buffer; each comparison is a binary search over hashes."""

    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length = data, length
        self.hashes = PrefixHashes(data)
        self.steps = int(length).bit_length()

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension of pairs of windows, at most the length."""
        found = np.full(len(x), self.length)
        apart = np.flatnonzero(self.hashes.of(x, self.length) != self.hashes.of(y, self.length))
        x, y = x[apart], y[apart]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        for _ in range(self.steps):
            middle = (low + high + 1) >> 1
            same = self.hashes.of(x, middle) == self.hashes.of(y, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        found[apart] = low
        return found

    def before(self, x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether x sorts before y; ties count as ``ties``."""
        common = self.common(x, y)
        equal = common == self.length
        at = np.where(equal, 0, common)
        return np.where(equal, ties, self.data[x + at] < self.data[y + at])

    def sort(self, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of windows within each segment; segments are contiguous."""
        n = len(start)
        order = np.arange(n)
        edges = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sizes = np.diff(np.append(edges, n))
        base, size = np.repeat(edges, sizes), np.repeat(sizes, sizes)
        rank = np.arange(n) - base
        width = 1
        while width < sizes.max(initial=0):
            run = rank // width
            other = base + (run ^ 1) * width
            stop = np.minimum(other + width, base + size)
            live = np.flatnonzero(other < stop)
            x, first = start[order[live]], (run[live] & 1).astype(bool)
            low, high = other[live], stop[live]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                # Elements of the left run go first among equals.
                less = self.before(start[order[middle]], x[open_], first[open_])
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
            target = np.arange(n)
            moved = low - other[live] + (rank[live] % width) + base[live] + (run[live] & ~1) * width
            target[live] = moved
            placed = np.empty(n, np.int64)
            placed[target] = order
            order, width = placed, width * 2
        return order

    def shared(self, start: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that each window shares with the one before it (-1: none in its segment), and
        which windows should not come after that one."""
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        found, wrong = np.full(len(start), -1), np.zeros(len(start), bool)
        near = np.flatnonzero(segment[1:] == segment[:-1]) + 1
        for at in range(0, len(near), 4096):
            some = near[at : at + 4096]
            x, y = view[start[some - 1]], view[start[some]]
            unlike = x != y
            first = unlike.argmax(axis=1)
            row = np.arange(len(some))
            apart = unlike[row, first]
            found[some] = np.where(apart, first, self.length)
            wrong[some] = x[row, first] > y[row, first]
        return found, wrong

    def ranked(self, start: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every window in the order, and the bytes that each place shares with the one before."""
        order = self.sort(start, segment)
        found, wrong = self.shared(start[order], segment)
        if wrong.any():
            # Different strings of one hash: their segments are sorted by bytes.
            raw = self.data.tobytes()
            for bad in np.unique(segment[wrong]):
                members = np.flatnonzero(segment == bad)
                order[members] = sorted(members.tolist(), key=lambda i: raw[start[i] : start[i] + self.length])
            found, _ = self.shared(start[order], segment)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return rank, found


def _repeated(entries: list[tuple[int, int, bytes, int]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For entries (group, offset of the anchor, bytes, count): which windows start elsewhere too,
    all in a row, and where those of each entry begin.

    Windows of one group are compared where their anchors lie at the same offset; others
    cannot be equal. Such windows are equal if they share what follows the anchor's start as
    well as what precedes it.
    """
    data = np.frombuffer(b"".join([bytes(length), *(e[2] for e in entries), bytes(length)]), np.uint8)
    sizes = np.array([len(e[2]) for e in entries], np.int64)
    begins = length + np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    group, offset, count = (np.array([e[i] for e in entries], np.int64) for i in (0, 1, 3))
    # Windows are cut at a point in them, which is the anchor unless that lies outside.
    low, high = (offset - windows + 1) // (length + 1), offset // (length + 1)
    owner = np.repeat(np.arange(len(entries)), high - low + 1)
    before = np.cumsum(high - low + 1) - (high - low + 1)
    block = low[owner] + np.arange(len(owner)) - before[owner]
    by = np.lexsort((block, group[owner]))
    owner, block = owner[by], block[by]
    group, count = group[owner], count[owner]
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (block[1:] != block[:-1])])
    segment = np.cumsum(new)
    at = offset[owner] - block * (length + 1)
    least, most = np.maximum(at - windows[owner] + 1, 0), np.minimum(at, length)
    point = begins[owner] + at
    after, shared_after = SuffixSort(data, length).ranked(point, segment)
    ahead, shared_ahead = SuffixSort(data[::-1].copy(), length).ranked(len(data) - point, segment)
    place = (np.cumsum(windows) - windows)[owner] + at
    result = np.zeros(windows.sum(), bool)
    for reach in range(least.min(), most.max() + 1):
        some = np.flatnonzero((least <= reach) & (reach <= most))
        key = np.cumsum(shared_after < length - reach)[after[some]] * (len(owner) + 1)
        key += np.cumsum(shared_ahead < reach)[ahead[some]]
        _, classes = np.unique(key, return_inverse=True)
        twice = np.bincount(classes, count[some]) >= 2
        result[place[some] - reach] = twice[classes]
    return result, np.cumsum(windows) - windows


def repeated_windows(entries: list[tuple[int, int, bytes, int]], length: int) -> list[np.ndarray]:
    """For entries (group, offset of the anchor, bytes, count): which windows start elsewhere too."""
    found, begins = _repeated(entries, length)
    return np.split(found, begins[1:])


def _runs(found: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start, end exclusive) of every stretch of repeated windows of an entry."""
    before = np.concatenate([[False], found[:-1]])
    before[begins] = False
    after = np.concatenate([found[1:], [False]])
    after[begins[1:] - 1] = False
    start, end = np.flatnonzero(found & ~before), np.flatnonzero(found & ~after) + 1
    owner = np.searchsorted(begins, start, side="right") - 1
    return owner, start - begins[owner], end - begins[owner]


def _strides(owner: np.ndarray, first: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of alike entries at a constant distance, as periodic text has them: begin, times, distance."""
    if not len(owner):
        return owner, owner, owner
    alike = owner[1:] == owner[:-1]
    for column in same:
        alike &= column[1:] == column[:-1]
    alike = np.concatenate([[False], alike])
    step = np.concatenate([[0], np.diff(first)])
    uneven = np.concatenate([[False], alike[:-1] & (step[1:] != step[:-1])])
    begin = np.flatnonzero(~alike | uneven)
    times = np.diff(np.append(begin, len(owner)))
    return begin, times, np.where(times > 1, step[np.minimum(begin + 1, len(owner) - 1)], 0)


def _anchor_rows(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """Rows (anchor, row, place, run); ``run`` packs how often and at which distance the place repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            owner, first, runs, place, value = anchors(batch.column("text").to_pylist(), length, anchor)
            begin, times, step = _strides(owner, first, value, place - first, runs)
            keys = batch.column("row").to_numpy()[owner[begin]]
            packed = (first << 16 | (place - first) << 8 | (runs - 1))[begin]
            columns = [value[begin].view(np.int64), keys, packed, times << 32 | step]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "row", "place", "run"])

    return rows.mapInArrow(run, "anchor bigint, row bigint, place bigint, run bigint")


def _met_twice(found: DataFrame) -> DataFrame:
    """The rows of anchors that are met at more than one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, met = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if last is None else pa.concat_batches([last, batch])
            keys = whole.column("anchor").to_numpy()
            equal = keys[1:] == keys[:-1]
            keep = whole.column("run").to_numpy() >> 32 > 1
            keep[0] |= met
            keep[1:] |= equal
            keep[:-1] |= equal
            last, met = whole.slice(whole.num_rows - 1), bool(keep[-1])
            yield whole.slice(0, whole.num_rows - 1).filter(pa.array(keep[:-1]))
        if met:
            yield last

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, found.schema)


def _surroundings(batch: pa.RecordBatch, length: int) -> tuple[list, ...]:
    """Of every place: row of the batch, anchor, digest of the bytes around it, offset of the anchor, these bytes, and where they start."""
    texts, lists = batch.column("text").to_pylist(), batch.column("places")
    values = lists.flatten()
    anchor, place, repeats = (values.field(i).to_numpy() for i in range(3))
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    first, offset, size = place >> 16, place >> 8 & 255, (place & 255) + length
    times, step = repeats >> 32, repeats & 0xFFFFFFFF
    single = np.flatnonzero(times <= 1)
    owners, starts, offsets = owner[single].tolist(), first[single].tolist(), offset[single].tolist()
    data = [texts[o][a:b] for o, a, b in zip(owners, starts, (first + size)[single].tolist())]
    out = owners, anchor[single].tolist(), offsets, data, [[a] for a in starts]
    for i in np.flatnonzero(times > 1).tolist():
        text, width, held = texts[owner[i]], int(size[i]), {}
        for start in range(int(first[i]), int(first[i] + times[i] * step[i]), int(step[i])):
            held.setdefault(text[start : start + width], []).append(start)
        for bytes_, at in held.items():
            for column, value in zip(out, (int(owner[i]), int(anchor[i]), int(offset[i]), bytes_, at)):
                column.append(value)
    digest = [xxhash.xxh3_64_intdigest(d, seed=o) - (1 << 63) for d, o in zip(out[3], out[2])]
    return out[0], out[1], digest, out[2], out[3], out[4]


def _entry_rows(held: DataFrame, length: int) -> DataFrame:
    """Surroundings in each document with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, anchor, digest, offset, data, starts = _surroundings(batch, length)
            times = batch.column("n").to_numpy()[owner] * np.array([len(s) for s in starts], np.int64)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip((anchor, digest, offset, data, times), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "digest", "offset", "data", "n"])

    return held.select("text", "n", "places").mapInArrow(run, "anchor bigint, digest bigint, offset int, data binary, n bigint")


def _spot_rows(held: DataFrame, length: int) -> DataFrame:
    """Where each document has which surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, anchor, digest, _, _, starts = _surroundings(batch, length)
            rows = batch.column("row").to_numpy()[owner]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            arrays = [pa.array(c, k) for c, k in zip((anchor, digest, rows, starts), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "digest", "row", "starts"])

    return held.select("row", "text", "places").mapInArrow(run, "anchor bigint, digest bigint, row bigint, starts array<bigint>")


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_PART = ("part", "part_digest", "part_reach", "part_offset", "part_data")


def _halves(entry: tuple, length: int) -> Iterator[tuple]:
    """An entry's windows in two halves by their distance from the anchor, each filed under
    the bytes that all windows of the half hold: key, digest, reach, offset, bytes, where they start."""
    _, _, reach, offset, data, _ = entry
    low, high = reach >> 16, reach & 0xFFFF
    middle = (low + high) >> 1
    for least, most in ((low, middle), (middle + 1, high)):
        first = offset - min(most, offset)
        last = min(offset - least, len(data) - length)
        if first > last:
            continue
        part, at = data[first : last + length], offset - first
        reached = least << 16 | most
        key = xxhash.xxh3_64_intdigest(part[at - least : at + length - most], seed=reached) - (1 << 63)
        yield key, xxhash.xxh3_64_intdigest(part, seed=at) - (1 << 63), reached, at, part, first


def _judged(entries: DataFrame, length: int) -> DataFrame:
    """Rows (anchor, digest, runs) of small groups: stretches of repeated windows, end exclusive.

    Entries of larger groups come back in halves (``_PART``), with their place in the entry.
    """
    names = ("anchor", "digest", "reach", "offset", "data", "n")
    names_out = ["anchor", "digest", "runs", "shift", "n", *_PART]
    kinds = (pa.int64(), pa.int64(), _RUNS, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def answer(held: list[tuple]) -> pa.RecordBatch:
        owner, start, end = _runs(*_repeated([(a, o, d, n) for a, _, _, o, d, n in held], length))
        some, first = np.unique(owner, return_index=True)
        pairs = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"])
        runs = pa.ListArray.from_arrays(pa.array(np.append(first, len(owner)), pa.int32()), pairs)
        columns = [pa.array([held[i][k] for i in some.tolist()], pa.int64()) for k in (0, 1)]
        empty = [pa.nulls(len(some), k) for k in kinds[3:]]
        return pa.RecordBatch.from_arrays([*columns, runs, *empty], names_out)

    def parted(entries: list[tuple]) -> pa.RecordBatch:
        rows = [(e[0], e[1], None, p[5], e[5], *p[:5]) for e in entries for p in _halves(e, length)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = begin = 0  # ``begin``: of the last group in ``held``
        hot = False
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                part = whole.slice(start, 1024)
                for entry in zip(*(part.column(c).to_pylist() for c in names)):
                    if held and entry[0] != held[-1][0]:
                        if hot:
                            yield parted(held)
                        elif size >= SORT_BYTES:
                            yield answer(held)
                        if hot or size >= SORT_BYTES:
                            held, size, hot = [], 0, False
                        begin = len(held)
                    held.append(entry)
                    size += len(entry[4])
                    if len(held) - begin > HOT and entry[2] >> 16 < entry[2] & 0xFFFF:
                        if begin:
                            yield answer(held[:begin])
                        # The group is too large: what is known of it goes on in halves, a part at a time.
                        yield parted(held[begin:-1])
                        held, size, begin, hot = [entry], len(entry[4]), 0, True
        if held:
            yield parted(held) if hot else answer(held)

    rows = entries.repartition("anchor").sortWithinPartitions("anchor").select(*names)
    return rows.mapInArrow(
        run,
        "anchor bigint, digest bigint, runs array<struct<start:int,end:int>>, shift int, n bigint, "
        "part bigint, part_digest bigint, part_reach int, part_offset int, part_data binary",
    )


def _verdicts(entries: DataFrame, length: int) -> DataFrame:
    """Rows (anchor, digest, runs): stretches of repeated windows, end exclusive; an entry may have several."""
    judged = materialise(_judged(entries, length), "verdicts")
    whole = judged.filter("part is null").select("anchor", "digest", "runs")
    parts = judged.filter("part is not null")
    if parts.isEmpty():
        return whole
    names = dict(zip(_PART, ("anchor", "digest", "reach", "offset", "data")))
    smaller = parts.groupBy(*_PART).agg(F.sum("n").alias("n")).withColumnsRenamed(names)
    found = _verdicts(smaller, length).withColumnsRenamed({"anchor": "part", "digest": "part_digest"})
    moved = F.transform("runs", lambda r: F.struct((r["start"] + F.col("shift")).alias("start"), (r["end"] + F.col("shift")).alias("end")))
    back = parts.select("anchor", "digest", "shift", "part", "part_digest").join(found, ["part", "part_digest"])
    return whole.unionByName(back.select("anchor", "digest", moved.alias("runs")))


def _spans(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """Rows (row, spans): the covered stretches of every different text that has some."""
    different = rows.filter(F.length("text") >= length).groupBy("row", "text").agg(F.count("*").alias("n"))
    different = materialise(different, "different")
    found = _met_twice(_anchor_rows(different.select("row", "text"), length, anchor))
    places = found.groupBy("row").agg(F.collect_list(F.struct("anchor", "place", "run")).alias("places"))
    # Written first, so that what it shuffled is gone when the texts are shuffled.
    places = materialise(places, "places")
    held = materialise(different.join(places, "row").select("row", "text", "n", "places"), "held")
    entries = _entry_rows(held, length).groupBy("anchor", "digest", "offset", "data").agg(F.sum("n").alias("n"))
    verdicts = _verdicts(entries.withColumn("reach", F.lit(length - anchor)), length)
    # A text met twice is covered whole.
    spots = _spot_rows(held.filter("n = 1"), length).join(verdicts, ["anchor", "digest"])
    shifted = F.flatten(
        F.transform(
            "starts",
            lambda at: F.transform(
                "runs", lambda r: F.struct((at + r["start"]).alias("start"), (at + r["end"] + length - 1).alias("end"))
            ),
        )
    )
    parts = spots.select("row", shifted.alias("spans")).groupBy("row")
    spans = parts.agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.length("text").cast("bigint").alias("end")))
    return spans.unionByName(different.filter("n > 1").select("row", all_of_it.alias("spans")))


def find_repeats(df: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, data, spans): the bytes of every text and the covered stretches in them."""
    rows = texts(df, key, text).select(
        "doc_id", F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text")
    )
    with freed_shuffles(df.sparkSession):
        # Only the spans stay: what a step shuffled goes with it, the surroundings once they are judged.
        spans = alone(df.sparkSession, "spans", lambda: _spans(rows, length, anchor))
    return rows.join(spans, "row", "left").select("doc_id", F.col("text").alias("data"), "spans")


def remove_repeats(found: DataFrame) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept): the bytes left when covered ones go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            out: list[list] = [[], [], [], []]
            lists = batch.column("spans")
            starts, ends = (lists.flatten().field(i).to_pylist() for i in (0, 1))
            first = 0
            for data, times in zip(batch.column("data").to_pylist(), lists.value_lengths().to_pylist()):
                parts, at, removed, runs = [], 0, 0, 0
                stop = first + (times or 0)
                for start, end in zip(starts[first:stop], ends[first:stop]):
                    if start > at or not runs:
                        parts.append(data[at:start])
                        runs += 1
                        at = start
                    if end > at:
                        removed += end - at
                        at = end
                first = stop
                parts.append(data[at:])
                for column, value in zip(out, (len(data), removed, runs, b"".join(parts))):
                    column.append(value)
            arrays = [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return found.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def repeats_report(found: DataFrame) -> DataFrame:
    return remove_repeats(found).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
