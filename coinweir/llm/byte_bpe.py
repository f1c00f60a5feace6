"""Byte-level BPE: texts to ids and back.

The merges of one pre-token run on a hierarchical-bitmap rank queue. Each merge rank has a bucket of linked-list positions;
two levels of bitmaps say which buckets hold any, and find-first-set walks them down to the lowest rank. Entries are never
taken out when a neighbour merges: one whose pair has changed by the time it is popped is stale and skipped. Large buckets
are merged in one go. A pre-token of n bytes costs O(n log n), however long it is.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from coinweir.llm.memory import Memory, held_by, keep_only
from coinweir.llm.tables import field

#: Encoded pieces that a task remembers before the older half of them goes.
REMEMBERED = 500_000

#: Ranks that one bitmap covers, as a power of two, and the bits in it.
SPAN = 10
BITS = [1 << at for at in range(1 << SPAN)]

#: Ids are below this power of two; a pair of ids is one number.
ID_BITS = 21
BREAK = -1
GONE = -2

#: Buckets of so many positions are merged together, smaller ones one by one.
WIDE = 100


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger:
    """Merges pre-tokens, many in one go: they lie in one linked list with breaks between, and share the queue."""

    def __init__(self, ranks: dict[bytes, int]):
        self._whole = ranks
        self._pairs = {
            ranks[token[:cut]] << ID_BITS | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self._bytes = np.array([ranks[bytes([byte])] for byte in range(256)], np.int64)
        of_pair = [self._pairs.get(one << ID_BITS | other, BREAK) for one in self._bytes.tolist() for other in self._bytes.tolist()]
        self._byte_pairs = np.array(of_pair, np.int64).reshape(256, 256)
        self._forward = self._sorted_pairs(self._pairs)
        swapped = {(pair & (1 << ID_BITS) - 1) << ID_BITS | pair >> ID_BITS: rank for pair, rank in self._pairs.items()}
        self._backward = self._sorted_pairs(swapped)
        size = max(ranks.values(), default=0) + 1
        self._buckets: list[list[int]] = [[] for _ in range(size)]  # positions by rank; all empty between calls
        self._bitmaps = [0] * ((size >> SPAN) + 1)

    @staticmethod
    def _sorted_pairs(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array(sorted(pairs), np.int64)
        return keys, np.array([pairs[key] for key in keys.tolist()], np.int64)

    @staticmethod
    def _beside(sorted_pairs: tuple[np.ndarray, np.ndarray], one: int, others: np.ndarray) -> np.ndarray:
        """The ranks of pairs of one id and several; BREAK where there is none."""
        keys, ranks = sorted_pairs
        start, stop = np.searchsorted(keys, (one << ID_BITS, one + 1 << ID_BITS))
        if start == stop:
            return np.full(len(others), BREAK)
        wanted = others | one << ID_BITS
        at = np.searchsorted(keys[start : stop - 1], wanted) + start
        return np.where((keys[at] == wanted) & (others >= 0), ranks[at], BREAK)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token."""
        return [list(struct.unpack(f"<{len(ids) // 4}i", ids)) for ids in self.packed(pieces)]

    def packed(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as little-endian 32-bit numbers."""
        whole = [self._whole.get(piece) for piece in pieces]
        apart = [piece for piece, known in zip(pieces, whole, strict=True) if known is None]
        ids = self._merge(apart).astype("<i4")
        ends = np.flatnonzero(ids == BREAK).tolist()
        data = ids.tobytes()
        found = (data[4 * start + 4 : 4 * end] for start, end in zip(ends, ends[1:], strict=False))
        return [next(found) if known is None else struct.pack("<i", known) for known in whole]

    def _merge(self, pieces: list[bytes]) -> np.ndarray:
        """The ids of all pre-tokens, with a break before each, and two at the end."""
        rank_of, buckets, bitmaps, within = self._pairs.get, self._buckets, self._bitmaps, (1 << SPAN) - 1
        # the bytes and their pairs are looked up together; breaks are put in behind
        text = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0\0", np.uint8)
        size = len(text)
        breaks = np.cumsum([0, *(len(piece) + 1 for piece in pieces)])
        breaks = np.append(breaks, size - 1)
        starting = np.append(self._byte_pairs[text[:-1], text[1:]], BREAK)
        starting[breaks] = BREAK
        starting[breaks[1:] - 1] = BREAK
        spelled = self._bytes[text]
        spelled[breaks] = BREAK
        # large buckets are merged together, in views of the same arrays
        ids, pair = array("q", spelled.tobytes()), array("q", starting.tobytes())
        after, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        views = tuple(np.frombuffer(each, np.int64) for each in (ids, pair, after, before))
        summary = 0  # which bitmaps are not zero

        def push(rank: int, at: int) -> int:
            bucket = buckets[rank]
            if not bucket:
                bitmaps[rank >> SPAN] |= BITS[rank & within]
            bucket.append(at)
            return 1 << (rank >> SPAN)

        places = np.flatnonzero(starting >= 0)
        places = places[np.argsort(starting[places], kind="stable")]
        ranks, starts = np.unique(starting[places], return_index=True)
        in_order = places.tolist()
        ends = [*starts.tolist(), len(in_order)][1:]
        for rank, start, end in zip(ranks.tolist(), starts.tolist(), ends, strict=False):
            buckets[rank] = in_order[start:end]
            bitmaps[rank >> SPAN] |= BITS[rank & within]
            summary |= 1 << (rank >> SPAN)
        while summary:
            top = (summary & -summary).bit_length() - 1
            bits = bitmaps[top]
            least = (top << SPAN) | ((bits & -bits).bit_length() - 1)
            bitmaps[top] = bits = bits & (bits - 1)
            if not bits:
                summary &= summary - 1
            bucket = buckets[least]
            buckets[least] = []
            if len(bucket) >= WIDE:
                pushed = self._together(least, bucket, *views)
                if pushed is not None:
                    for rank, places_of_rank in pushed:
                        if not buckets[rank]:
                            bitmaps[rank >> SPAN] |= BITS[rank & within]
                            summary |= 1 << (rank >> SPAN)
                        buckets[rank] += places_of_rank
                    continue
            bucket.sort()
            for turn, at in enumerate(bucket):
                if pair[at] != least:
                    continue  # stale
                gone = after[at]
                end = after[at] = after[gone]
                before[end] = at
                ids[at] = least
                ids[gone] = pair[gone] = GONE
                left = before[at]
                lower = False
                pair[at] = rank = rank_of(least << ID_BITS | ids[end], BREAK)
                if rank >= 0:
                    summary |= push(rank, at)
                    lower = rank < least
                pair[left] = rank = rank_of(ids[left] << ID_BITS | least, BREAK)
                if rank >= 0:
                    summary |= push(rank, left)
                    lower |= rank < least
                if lower and turn + 1 < len(bucket):  # the new pair goes first
                    for rest in bucket[turn + 1 :]:
                        summary |= push(least, rest)
                    break
        return views[0][views[0] != GONE]

    def _together(
        self, least: int, bucket: list[int], ids: np.ndarray, pair: np.ndarray, after: np.ndarray, before: np.ndarray
    ) -> list[tuple[int, list[int]]] | None:
        """Merges all of a bucket's pairs; the new pairs' ranks and positions. None, and nothing merged, if one of a lower rank than
        the bucket's appears on the way, for that goes first."""
        at = np.sort(np.array(bucket, np.int64))
        at = at[pair[at] == least]  # others are stale
        gone = after[at]
        shared = gone[:-1] == at[1:]
        if shared.any():  # of pairs that share a token, every second one merges
            turn = np.arange(len(at))
            begins = np.maximum.accumulate(np.where(np.append(True, ~shared), turn, 0))
            kept = (turn - begins) % 2 == 0
            at, gone = at[kept], gone[kept]
        end, left = after[gone], before[at]
        right_ranks = self._beside(self._forward, least, ids[end])  # with what is there before its own merge
        met = np.flatnonzero(end[:-1] == at[1:])  # the next merge's left is this one
        left[met + 1] = at[met]
        left_ids = ids[left]
        left_ids[met + 1] = least
        left_ranks = self._beside(self._backward, least, left_ids)
        ranks = np.concatenate((right_ranks, left_ranks))
        if ((ranks >= 0) & (ranks < least)).any():
            return None
        after[at], before[end] = end, at
        ids[at] = least
        ids[gone] = pair[gone] = GONE
        pair[at] = right_ranks
        pair[left] = left_ranks
        ranks[met] = BREAK  # replaced by the pair of both merges
        new = np.flatnonzero(ranks >= 0)
        new = new[np.argsort(ranks[new], kind="stable")]
        ranks, places = ranks[new], np.concatenate((at, left))[new].tolist()
        ranks, starts = np.unique(ranks, return_index=True)
        edges = [*starts.tolist(), len(places)]
        return [(rank, places[start:end]) for rank, start, end in zip(ranks.tolist(), edges, edges[1:], strict=False)]


class Encoder:
    """Encodes batches of texts; of pieces that were met before, it looks up the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._merger = Merger(ranks)
        self._split = regex.compile(pattern).findall
        self._crowded = regex.compile(r"\s\s").search
        # whether a space and letters behind it are one match, which need not be searched for then
        before, _, behind = f"|{pattern}|".partition(r"| ?\p{L}+|")
        self._words_whole = bool(behind) and all(each.startswith("'") for each in before.split("|")[1:])
        self._pieces = Memory(REMEMBERED)
        self._chunks = Memory(REMEMBERED)

    def _learn(self, pieces: set[str]) -> None:
        new = self._pieces.missing(pieces)
        self._pieces.update(zip(new, self._merger.packed([piece.encode() for piece in new]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers.

        Where no two white-space characters meet, a match of the pattern cannot run across a space into the next
        word, so a text may be cut before every space and repeated chunks are looked up. Other texts are split whole.
        """
        split, pieces, chunks = self._split, self._pieces, self._chunks
        pieces.turn()
        chunks.turn()
        cut = []
        for text in texts:
            if self._crowded(text):
                cut.append((split(text), []))
            else:
                first, *rest = text.split(" ")
                cut.append((split(first), rest))
        new = chunks.missing(set().union(*(rest for _, rest in cut)))
        whole = self._words_whole
        found = [[" " + chunk] if whole and chunk.isascii() and chunk.isalpha() else split(" " + chunk) for chunk in new]
        self._learn({piece for each in found for piece in each}.union(*(first for first, _ in cut)))
        for chunk, each in zip(new, found, strict=True):
            chunks[chunk] = pieces[each[0]] if len(each) == 1 else b"".join([pieces[piece] for piece in each])
        return [b"".join([*map(pieces.__getitem__, first), *map(chunks.__getitem__, rest)]) for first, rest in cut]


_encoders: dict[tuple[str, str], Encoder] = held_by("byte_bpe")


def _encoder(path: str, pattern: str) -> Encoder:
    keep_only("byte_bpe")
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def _id_lists(packed: list[bytes]) -> pa.Array:
    offsets = [0]
    for ids in packed:
        offsets.append(offsets[-1] + len(ids) // 4)
    values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(documents: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text, in document rows as they come.

    `path` names a rank file that executors can open, `pattern` the regular expression that splits a text into pre-tokens. No
    special token is recognised or added. A null or empty text has no ids; a null id and repeated rows are kept; other
    columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):  # keeps a batch of ids small
                part = batch.slice(start, 512)
                ids = _id_lists(encoder.encode([text or "" for text in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [id_column, "ids"])

    schema = T.StructType([field(documents, id_column), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return documents.select(id_column, text_column).mapInArrow(run, schema)


class Decoder:
    """Bytes of ids, gathered from the bytes of all tokens laid end to end."""

    def __init__(self, ranks: dict[bytes, int]):
        self._sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self._sizes[list(ranks.values())] = [len(token) for token in ranks]
        self._starts = np.concatenate(([0], np.cumsum(self._sizes)))
        self._bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        each = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = self._sizes[each]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        source = np.repeat(self._starts[each] - ends[:-1], sizes) + np.arange(ends[-1])
        spans = np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())))
        buffers = [None, pa.py_buffer(ends[spans].astype("<i8").tobytes()), pa.py_buffer(self._bytes[source].tobytes())]
        return pa.Array.from_buffers(pa.large_binary(), len(ids), buffers).cast(pa.binary())


def decode(encoded: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """The rows with `decoded`, the bytes that their ids stand for; null ids decode to no bytes."""
    columns = [name for name in encoded.columns if name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(load_ranks(path))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # keeps the bytes of a batch small
                part = batch.slice(at, 512)
                texts = decoder.decode(part.column(columns.index(ids_column)))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*columns, "decoded"])

    schema = T.StructType([*(field(encoded, name) for name in columns), T.StructField("decoded", T.BinaryType())])
    return encoded.select(*columns).mapInArrow(run, schema)


def round_trip(documents: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, decoded): `encode`, then `decode` of its ids, in one pass over the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(path, pattern), Decoder(load_ranks(path))
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = _id_lists(encoder.encode([text or "" for text in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, decoder.decode(ids)], [id_column, "ids", "decoded"])

    kinds = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return documents.select(id_column, text_column).mapInArrow(run, T.StructType([field(documents, id_column), *kinds]))
