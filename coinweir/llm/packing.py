"""Best-fit packing of tokenized documents into sequences of a fixed capacity, by large-item matching.

Pieces of one length are interchangeable, so a packing is planned over how many there are of each length, at most `capacity` numbers,
whatever the size of the corpus. Lengths above a third of the capacity can meet at most twice in a bin: from the longest
down, each is matched with the longest that still fits beside it. Shorter ones, from the longest down, fill the smallest gap
that takes them. Equal bins are planned as one with a count. Pieces then find their places by their rank among those of
their length, which needs no more than running counts of tasks.
"""

from __future__ import annotations

import json
import os
import re
import struct
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.llm.memory import Memory, give_back, held_by, keep_only
from coinweir.llm.tables import field, fresh, stored

#: Encoded chunks of text that a task remembers before the older half of them goes.
REMEMBERED = 600_000


#: White space apart, texts of these characters are in NFC, lower-cased as the tokenizer does it with all letters, and cut like `_PARTS` by
#: its pattern: ASCII, and the letters of Latin-1 (whose case differs by one bit).
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall
#: Characters that may compose with the one before them are all among these.
_COMPOSES = re.compile("[^\0-\u02ff]").search
_NORMALIZER = [("NFC", None), ("Replace", "\\s+"), ("Lowercase", None)]
_PRE_TOKENIZER = ["Split", "ByteLevel"]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _cuts_like_parts(settings: dict) -> bool:
    """Whether a tokenizer normalizes and cuts as `_SIMPLE` and `_PARTS` have it."""
    normalizer = (settings.get("normalizer") or {}).get("normalizers", [])
    steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [(each["type"], each.get("pattern", {}).get("Regex")) for each in normalizer] != _NORMALIZER or [each["type"] for each in steps] != _PRE_TOKENIZER:
        return False
    split, level = steps
    cuts = split["pattern"].get("Regex") == _PATTERN and split["behavior"] == "Removed" and split["invert"]
    return cuts and not level["add_prefix_space"] and not level["use_regex"] and settings.get("post_processor") is None


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level tokenizer writes for each byte, where it is not the Latin-1 one."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {byte: chr(256 + turn) for turn, byte in enumerate(sorted({*range(256)} - shown))}


class _Chunks(Memory):
    """A memory that makes what it is asked for and does not know."""

    def __init__(self, limit: int, make: Callable[[bytes], bytes]):
        super().__init__(limit)
        self._make = make

    def __missing__(self, chunk: bytes) -> bytes:
        found = self._older.get(chunk)
        if found is None:
            found = self._make(chunk)
        self[chunk] = found
        return found


class Encoder:
    """Ids of texts under a tokenizer whose words never cross ASCII white space, so that chunks between it can be remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # strings of special tokens are found in texts as they are, before letters are lower-cased
        self._special = [token.content.encode() for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self._packed = [struct.pack("<I", id_) for id_ in range(max(self._tokenizer.get_vocab().values(), default=0) + 1)]
        self._letters = _byte_letters()
        self._simple = _SIMPLE if _cuts_like_parts(json.loads(self._tokenizer.to_str())) else lambda text: None
        self.forget()

    def forget(self) -> None:
        """Gives memory back; a worker may be idle for long after a task."""
        self._chunks = _Chunks(REMEMBERED, self._encoded)

    def _encoded(self, chunk: bytes) -> bytes:
        """The ids of a chunk without white space. Where it is known how the tokenizer cuts it, its model gets the parts, so that
        nothing is normalized or cut again for each word."""
        text = chunk.decode()
        if not self._simple(text):
            found = self._tokenizer.encode([text], is_pretokenized=True, add_special_tokens=False)
            return np.array(found.ids, "<u4").tobytes()
        lowered = text.lower()
        if lowered != text:
            return self._chunks[lowered.encode()]
        if not chunk.isalpha():  # of ASCII letters
            parts = _PARTS(text)
            if len(parts) > 1:
                return b"".join([self._chunks[part.encode()] for part in parts])
            text = chunk.decode("latin-1").translate(self._letters)
        packed = self._packed
        return b"".join([packed[token.id] for token in self._model.tokenize(text)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        self._chunks.turn()
        ids_of, special = self._chunks.__getitem__, self._special
        found = []
        for text in texts:
            data = text.encode()
            if any(each in data for each in special):
                found.append(self._whole(text))
            else:
                # a letter and a mark behind it may compose in one case only; other texts hold fewer chunks when lower-cased first
                found.append(b"".join(map(ids_of, (data if _COMPOSES(text) else data.lower()).split())))
        return found

    def _whole(self, text: str) -> bytes:
        """The ids of a text that holds the string of a special token."""
        self._tokenizer.encode_special_tokens = False
        try:
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        finally:
            self._tokenizer.encode_special_tokens = True


_encoders: dict[str, Encoder] = held_by("packing")


def pieces(
    documents: DataFrame, path: str, end_id: int, capacity: int, keep: list[str] | None = None, text_column: str = "text"
) -> DataFrame:
    """The rows (or their columns `keep`) once per piece, with `piece`, `start`, `length` and `ids`.

    A document is the ids of its whole text and `end_id`; only one longer than `capacity` is cut, into pieces of that length and
    a rest. `ids` are little-endian unsigned 32-bit numbers. Null and empty texts make a piece of one id; null ids
    and repeated rows stay.
    """
    columns = documents.columns if keep is None else keep
    names = [f"_c{place}" for place in range(len(columns))]
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("packing")
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        for batch in batches:
            yield from cut(encoder, batch)
        encoder.forget()
        give_back()

    def cut(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            owner, numbers, cuts = [], [], []
            for row, ids in enumerate(encoder.encode([text or "" for text in part.column(len(names)).to_pylist()])):
                ids += end
                count = -(-len(ids) // step)
                owner += [row] * count
                numbers += range(count)
                cuts += [ids[step * number : step * (number + 1)] for number in range(count)]
            number = np.array(numbers, np.int32)
            lengths = np.array([len(ids) // 4 for ids in cuts], np.int64)
            kept = part.take(pa.array(owner, pa.int64())).columns[: len(names)]
            made = [pa.array(number), pa.array(number.astype(np.int64) * capacity), pa.array(lengths), pa.array(cuts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*columns, "piece", "start", "length", "ids"])

    kinds = {"piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids": T.BinaryType()}
    if clash := set(kinds) & set(columns):
        raise ValueError(f"columns that pieces have themselves: {sorted(clash)}; choose others with keep")
    schema = T.StructType([*(field(documents, column) for column in columns), *map(T.StructField, kinds, kinds.values())])
    rows = documents.select(*[F.col(column).alias(name) for column, name in zip(columns, names, strict=True)], F.col(text_column).alias("_text"))
    return rows.mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, rank behind the last, first bin, pieces in a bin, offset).

    Ranks of a length count from 0; each entry fills its bins one after another. `counts` are pieces by length, none longer than
    `capacity` or shorter than 1.
    """
    left = {length: count for length, count in counts.items() if count}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("a piece is empty or longer than a sequence")
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)  # by gap: bins alike, and their contents
    gaps: list[int] = []

    def add(bins: int, contents: list[tuple[int, int]], gap: int) -> None:
        if bins:
            if not groups[gap]:
                insort(gaps, gap)
            groups[gap].append((bins, contents))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        count = left[length]
        place = bisect_left(large, capacity - length + 1) - 1  # the longest that fits beside it
        if place == len(large) - 1 and count == 1:
            place -= 1  # itself, and there is no other
        if place < 0:
            add(count, [(length, 1)], capacity - length)
            pairs, other = 0, length
            left[length] = 0
        else:
            other = large[place]
            pairs = count // 2 if other == length else min(count, left[other])
            add(pairs, [(length, 2)] if other == length else [(length, 1), (other, 1)], capacity - length - other)
            left[length] -= pairs
            left[other] -= pairs
        large = [each for each in large if left[each]] if not (left[length] and left[other]) else large
    for length in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        count = left[length]
        while count:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                bins, contents = groups[gap].pop()
                if not groups[gap]:
                    gaps.pop(at)
            else:
                gap, contents = capacity, []
                bins = -(-count // (capacity // length))
            each = gap // length
            full = min(bins, count // each)
            rest = min(count - full * each, each) if full < bins else 0
            add(full, [*contents, (length, each)], gap - each * length)
            if rest:
                add(1, [*contents, (length, rest)], gap - rest * length)
            add(bins - full - bool(rest), contents, gap)
            count -= full * each + rest
    entries, first, rank = [], 0, defaultdict(int)
    for gap in sorted(groups):
        for bins, contents in groups[gap]:
            offset = 0
            for length, each in contents:
                entries.append((length, rank[length], rank[length] + bins * each, first, each, offset))
                rank[length] += bins * each
                offset += each * length
            first += bins
    return entries


def pack(made: DataFrame, capacity: int, length_column: str = "length") -> DataFrame:
    """The rows with `sequence_id` and `offset`: no sequence longer than `capacity`, offsets gapless from 0.

    Rows are pieces; only their lengths matter. They are written once, with the task that wrote them and their order in it, so that a
    lost executor cannot change a rank: that of a piece among those of its length is how many of them other tasks have before it,
    and its turn in its own. No rows make no sequences.
    """
    task, order, length, turn = (fresh(name, made.columns) for name in ("task", "order", "length_", "turn"))
    columns = made.columns
    rows = stored(
        made.select(
            "*",
            F.col(length_column).cast("long").alias(length),
            F.spark_partition_id().alias(task),
            F.monotonically_increasing_id().alias(order),
        )
    )
    counts = rows.groupBy(length, task).agg(F.count("*").alias("n"))
    before = Window.partitionBy(length).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    totals = counts.groupBy(length).agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    entries = plan({row[length]: row["n"] for row in totals}, capacity)
    kinds = "at long, first long, stop long, bin long, each long, place long"
    entries = rows.sparkSession.createDataFrame([tuple(map(int, entry)) for entry in entries], kinds)
    counts = counts.select(F.col(length).alias("of"), F.col(task).alias("by"), "before").hint("merge")
    in_task = Window.partitionBy(length, task).orderBy(order)
    rows = rows.withColumn(turn, F.row_number().over(in_task) - 1)
    found = rows.join(counts, (F.col(length) == F.col("of")) & (F.col(task) == F.col("by")))
    rank = F.col("before") + F.col(turn)
    # the plan has a few entries for each of at most `capacity` lengths
    found = found.join(F.broadcast(entries), (F.col(length) == F.col("at")) & (rank >= F.col("first")) & (rank < F.col("stop")))
    within = rank - F.col("first")
    return found.select(
        *[rows[column] for column in columns],
        (F.col("bin") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + within % F.col("each") * F.col(length)).alias("offset"),
    )
