"""Exact removal of long strings that occur more than once, by a run-length compressed index.

Every window of `length` bytes belongs to one anchor, the least hash of the short strings in it, so equal windows have equal
anchors in the same place, and windows next to each other mostly share theirs: together they make a piece of text. Pieces
whose anchor occurs once hold nothing repeated. Equal pieces are stored once, with their number; where an anchor has several different
pieces, tasks build an index of those: their suffixes sorted, the Burrows-Wheeler transform of that order compressed to runs, and
a sample of the suffix and its predecessor at the end of every run. Only there are suffixes compared; along the text, the length of
the longest match follows from the sample before it (one byte less for every step), so that repetitive text costs its runs.
Windows whose match reaches `length` are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.llm.memory import give_back, keep_only
from coinweir.llm.tables import field, fresh, stored, text_of

#: Bytes that an anchor is the hash of; at most the length sought.
ANCHOR_BYTES = 40

#: Text that tasks hash, or index, at a time; a worker takes up to a hundred bytes for each byte of it.
BLOCK = 1 << 20
INDEX_BLOCK = 1 << 20

#: Anchors with more different pieces than this are settled window by window instead.
CROWDED = 20_000

MULTIPLIERS = np.random.default_rng(11).integers(1 << 62, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_PLACE_BITS = 31


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` bytes from each place on."""
    size = len(data) - width + 1
    words = np.ascontiguousarray(np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,)))
    found = np.zeros(size, np.uint64)
    for turn, at in enumerate([*range(0, width - 8, 8), width - 8]):
        found += words[at : at + size] * MULTIPLIERS[turn % 16]
        found ^= found >> np.uint64(29)
        found *= MULTIPLIERS[15]
    return found ^ (found >> np.uint64(32))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` neighbours from each place on."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def pieces_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Pieces of the texts that lie one behind another in `data`, none shorter than `length`: the number of the text, the anchor's
    hash, and the first and last start of the piece's windows, within `data`."""
    width = min(ANCHOR_BYTES, length)
    hashes = _hashes(data, width)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(keys, length - width + 1) & low).astype(np.int64)  # by the window's start
    owner = np.repeat(np.arange(len(starts)), stops - starts - length + 1)
    first = np.concatenate(([0], np.cumsum(stops - starts - length + 1)))[:-1]
    windows = np.arange(len(owner)) - first[owner] + starts[owner]
    anchors = anchor[windows]
    turn = np.ones(len(windows), bool)
    turn[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(turn)
    lasts = np.append(heads[1:], len(windows)) - 1
    return owner[heads], hashes[anchors[heads]].view(np.int64), windows[heads], windows[lasts]


def _pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            texts = [text.encode() for text in batch.column(1).to_pylist()]
            documents = batch.column(0).to_numpy(zero_copy_only=False)
            held, size = [], 0
            for place, text in enumerate(texts):
                if len(text) >= length:
                    held.append(place)
                    size += len(text)
                if held and (size >= BLOCK or place == len(texts) - 1):
                    data = b"".join([texts[each] for each in held])
                    stops = np.cumsum([len(texts[each]) for each in held])
                    starts = np.concatenate(([0], stops[:-1]))
                    owner, anchor, first, last = pieces_of(np.frombuffer(data, np.uint8), starts, stops, length)
                    view, digest = memoryview(data), xxhash.xxh64_intdigest
                    spans = zip(first.tolist(), (last + length).tolist(), strict=True)
                    whole = np.array([digest(view[a:b]) for a, b in spans], np.uint64).view(np.int64)
                    base = starts[owner]
                    columns = [anchor, whole, documents[np.array(held)][owner], (first - base).astype(np.int32), (last - base + 1).astype(np.int32)]
                    for at in range(0, len(owner), 100_000):
                        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in columns], ["anchor", "piece", "document", "first", "stop"])
                    held, size = [], 0
        give_back()

    return run


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """The text of wanted pieces: rows of a document's text and its `wanted` pieces to (anchor, piece, document, first, m, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        names = ["anchor", "piece", "document", "first", "m", "data"]
        for batch in batches:
            for document, text, wanted in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                data = text.encode()
                found = [
                    (each["anchor"], each["piece"], document, each["first"], each["m"], data[each["first"] : each["stop"] + length - 1])
                    for each in wanted
                ]
                yield pa.RecordBatch.from_pylist([dict(zip(names, each, strict=True)) for each in found], schema)
        give_back()

    schema = pa.schema(
        [("anchor", pa.int64()), ("piece", pa.int64()), ("document", pa.int64()), ("first", pa.int32()), ("m", pa.int64()), ("data", pa.binary())]
    )
    return rows.select("document", "text", "wanted").mapInArrow(
        run, "anchor long, piece long, document long, first int, m long, data binary"
    )


class RunIndex:
    """A run-length index of several texts, each ended by a sign of its own."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(text) for text in texts])
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        self.data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        self.ends = self.starts + sizes
        signs = self.data.astype(np.int64) + len(texts)
        signs[self.ends] = np.arange(len(texts))
        self._order(signs, int(sizes.max(initial=0)))
        before = np.concatenate(([-1], signs[:-1]))[self.order]  # the transform
        heads = np.ones(len(before), bool)  # starts of its runs; ends of texts never continue one
        heads[1:] = (before[1:] != before[:-1]) | (before[1:] < len(texts))
        self.heads = np.flatnonzero(heads)
        self.samples = self.order[self.heads]
        self.previous = self.order[self.heads - 1]  # the suffix at the end of the run before
        self.previous[self.heads == 0] = -1

    def _order(self, signs: np.ndarray, longest: int) -> None:
        """Suffixes in order, by doubling the length that they are ranked by; settled ones drop out."""
        size, kinds, span = len(signs), int(signs.max(initial=0)) + 1, 1
        rank = signs
        while span < 4 and kinds < 1 << 31:  # what follows the end of a text does not matter, for ends differ
            rank = rank * kinds + np.append(rank[span:], np.zeros(span, np.int64))
            kinds, span = kinds * kinds, span * 2
        order = np.argsort(rank, kind="stable")
        ranked = rank[order]
        turn = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        rank = np.empty(size, np.int64)
        rank[order] = np.maximum.accumulate(np.where(turn, np.arange(size), 0))  # the first place of equal ones
        while span <= longest + 1:
            alone = np.concatenate((turn, [True]))
            active = np.flatnonzero(~(alone[:-1] & alone[1:]))  # places in the order that are still shared
            if not len(active):
                break
            suffixes = order[active]
            both = rank[suffixes] * size + rank[np.minimum(suffixes + span, size - 1)]
            resort = np.argsort(both)
            suffixes, both = suffixes[resort], both[resort]
            order[active] = suffixes
            new = np.concatenate(([True], both[1:] != both[:-1]))
            rank[suffixes] = np.maximum.accumulate(np.where(new, active, 0))
            turn[active] = new
            span *= 2
        self.order = order

    def _common(self, one: np.ndarray, other: np.ndarray, least: int) -> np.ndarray:
        """How far the texts at two places agree, ends of texts excluded; less may come out where it is less than `least`."""
        ends = np.repeat(self.ends, self.ends - self.starts + 1)
        room = np.minimum(ends[one] - one, ends[other] - other)
        found = np.zeros(len(one), np.int64)
        live = np.flatnonzero(room >= least)
        for at in (least - 1, least // 2, 0):
            live = live[self.data[one[live] + at] == self.data[other[live] + at]]
        while len(live):
            live = live[found[live] < room[live]]
            steps = np.minimum(room[live] - found[live], 16)
            at = found[live][:, None] + np.arange(16)
            places = [np.minimum(x[live][:, None] + at, len(self.data) - 1) for x in (one, other)]
            same = (self.data[places[0]] == self.data[places[1]]) & (np.arange(16) < steps[:, None])
            agreed = np.where(same.all(axis=1), 16, same.argmin(axis=1))
            found[live] += agreed
            live = live[agreed == 16]
        return found

    def matches(self, least: int) -> np.ndarray:
        """For each place, how far it agrees with the suffix before it in order: compared where a run starts, one less than at
        the place before it elsewhere. Only matches of `least` and more are exact."""
        samples, previous = self.samples, self.previous
        found = np.zeros(len(samples), np.int64)
        there = previous >= 0
        found[there] = self._common(samples[there], previous[there], least)
        by_place = np.argsort(samples)
        places, values = samples[by_place], found[by_place]
        last = np.searchsorted(places, np.arange(len(self.data)), "right") - 1
        return np.maximum(values[last] - (np.arange(len(self.data)) - places[last]), 0)

    def repeated(self, length: int) -> np.ndarray:
        """The places where a string of `length` bytes starts that starts somewhere else as well."""
        long = self.matches(length)[self.order] >= length
        marked = np.zeros(len(self.data), bool)
        marked[self.order[long]] = True
        marked[self.order[np.flatnonzero(long) - 1]] = True
        return marked


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _index(rows: DataFrame, length: int) -> DataFrame:
    """(document, first, stop) of repeated windows, of different pieces in partitions by anchor, sorted by it."""
    schema = pa.schema([("document", pa.int64()), ("first", pa.int32()), ("stop", pa.int32())])

    def settled(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        index = RunIndex([data for *_, data in held])
        marked = index.repeated(length)
        found = [
            {"document": document, "first": first + a, "stop": first + b}
            for (_, document, first, data), start in zip(held, index.starts.tolist(), strict=True)
            for a, b in _runs(marked[start : start + len(data)])
        ]
        yield pa.RecordBatch.from_pylist(found, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if size >= INDEX_BLOCK and held[-1][0] != row[0]:
                    yield from settled(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield from settled(held)
        held = []
        give_back()

    return rows.select("anchor", "document", "first", "data").mapInArrow(run, "document long, first int, stop int")


def _one_by_one(rows: DataFrame, length: int) -> DataFrame:
    """(document, first, stop) of repeated windows, of pieces of crowded anchors: each window is counted by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            for document, first, m, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                view, size = memoryview(data), len(data) - length + 1
                digests = np.array([xxhash.xxh64_intdigest(view[at : at + length]) for at in range(size)], np.uint64)
                columns = [digests.view(np.int64), np.full(size, document), np.arange(first, first + size, dtype=np.int32), np.full(size, m)]
                yield pa.RecordBatch.from_arrays([pa.array(each) for each in columns], ["window", "document", "first", "m"])
        give_back()

    windows = rows.select("document", "first", "m", "data").mapInArrow(run, "window long, document long, first int, m long")
    often = windows.groupBy("window").agg(F.sum("m").alias("n")).filter("n > 1").select("window")
    # merged: Spark sizes the windows like the pieces, which are a window for each byte
    return windows.join(often.hint("merge"), "window").select("document", "first", (F.col("first") + 1).alias("stop"))


def repeated_windows(texts: DataFrame, length: int) -> DataFrame:
    """(document, first, stop): starts of windows that occur again, in byte places from 0, for rows of (document, text).

    `document` is a hash of the text; rows with the same one count as that many occurrences. Nothing for texts below `length` bytes.
    """
    kinds = "anchor long, piece long, document long, first int, stop int"
    pieces = stored(texts.select("document", "text").mapInArrow(_pieces(length), kinds))
    again = stored(pieces.groupBy("anchor").count().filter("count > 1").select("anchor"))
    # copies of a text count as occurrences but need one row; what is joined is stored, so that a frequent anchor can be split
    pieces = pieces.groupBy("anchor", "piece", "document", "first", "stop").agg(F.count("*").alias("n"))
    pieces = stored(pieces.join(again.hint("merge"), "anchor"))
    different = pieces.groupBy("anchor", "piece").agg(F.sum("n").alias("m"), F.min(F.struct("n", "document", "first", "stop")).alias("one"))
    several = different.groupBy("anchor").agg(F.count("*").alias("pieces"))
    different = stored(different.join(several, "anchor").select("anchor", "piece", "m", "pieces", "one.*"))

    copies = different.filter("m > 1").select("anchor", "piece")
    whole = pieces.join(copies.hint("merge"), ["anchor", "piece"]).select("document", "first", "stop")

    wanted = different.filter("pieces > 1").select("document", F.struct("anchor", "piece", "first", "stop", "m", "pieces").alias("each"))
    wanted = wanted.groupBy("document").agg(F.collect_list("each").alias("wanted"))  # no more than a text has pieces
    one_each = texts.groupBy("document").agg(F.first("text").alias("text"))
    cut = stored(_cut(one_each.join(wanted.hint("merge"), "document"), length))
    crowds = several.filter(F.col("pieces") > CROWDED).select("anchor", F.lit(True).alias("crowded"))
    cut = cut.join(stored(crowds), "anchor", "left")
    bounded = cut.filter("crowded IS NULL").repartition("anchor").sortWithinPartitions("anchor")
    marked = _index(bounded, length).unionByName(_one_by_one(cut.filter("crowded"), length))
    return whole.unionByName(marked)


def _kept(data: bytes, marks: list[tuple[int, int]], length: int) -> tuple[bytes, list[dict]]:
    """What is left of a text, and the removed spans, from the starts of repeated windows."""
    spans: list[list[int]] = []
    for first, stop in sorted(marks):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], stop + length - 1)
        else:
            spans.append([first, stop + length - 1])
    kept, at = [], 0
    for start, stop in spans:
        kept.append(data[at:start])
        at = stop
    kept.append(data[at:])
    return b"".join(kept), [{"start": start, "stop": stop} for start, stop in spans]


def without_repeats(
    documents: DataFrame, length: int = 200, text_column: str = "text", keep: list[str] | None = None, whole: bool = False
) -> DataFrame:
    """The rows (or their columns `keep`) with `n_bytes`, `kept` (the bytes left) and `removed` (array of start, stop). With
    `whole`, what is left is a string of whole characters: where a cut leaves part of one, that part goes as well.

    A byte goes if it lies under a string of `length` bytes that also starts anywhere else, in the same text or another; matches
    don't cross texts, overlaps count, and strings are judged on the input. Null texts count as empty; null ids and repeated
    rows stay, and a repeated row's text occurs as often as the row does. Texts are told apart by a 64-bit hash.
    """
    columns = documents.columns if keep is None else keep
    names = {f"_c{place}": column for place, column in enumerate(columns)}
    rows = documents.select(*[F.col(column).alias(name) for name, column in names.items()], text_of(text_column).alias("text"))
    rows = rows.withColumn("document", F.xxhash64("text"))
    marks = repeated_windows(rows, length)
    marks = marks.groupBy("document").agg(F.collect_list(F.struct("first", "stop")).alias("marks"))  # within a text
    joined = rows.join(stored(marks).hint("merge"), "document", "left").select(*names, "text", "marks")
    results = [fresh(name, columns) for name in ("n_bytes", "kept", "removed")]
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            texts = [text.encode() for text in batch.column(len(names)).to_pylist()]
            marked = [[(each["first"], each["stop"]) for each in found or ()] for found in batch.column(len(names) + 1).to_pylist()]
            kept = [_kept(data, found, length) for data, found in zip(texts, marked, strict=True)]
            left = [data.decode(errors="ignore") if whole else data for data, _ in kept]
            arrays = [pa.array([len(data) for data in texts], pa.int64()), pa.array(left, pa.string() if whole else pa.binary()), pa.array([removed for _, removed in kept], spans)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *arrays], [*columns, *results])
        give_back()

    kinds = [T.LongType(), T.StringType() if whole else T.BinaryType(), T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))]
    schema = T.StructType([*(field(documents, column) for column in columns), *map(T.StructField, results, kinds)])
    return joined.mapInArrow(run, schema)


def texts_without_repeats(documents: DataFrame, length: int = 200, text_column: str = "text") -> DataFrame:
    """The documents with their text cut like `without_repeats`, in whole characters, and `n_removed`, the bytes taken out by
    the cuts. A null text becomes an empty one."""
    columns = documents.columns
    kept, removed = fresh("kept", columns), fresh("removed", columns)
    rows = without_repeats(documents, length, text_column, whole=True)
    gone = F.aggregate(removed, F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    cut = [F.col(kept).alias(column) if column == text_column else F.col(column) for column in columns]
    return rows.select(*cut, gone.alias(fresh("n_removed", columns)))
