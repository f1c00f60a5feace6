"""Katz backoff language model over words, learned from and applied to whole corpora.

P(w | h) is the Good-Turing discounted share of w among what follows h in training, if it does follow; otherwise it is alpha(h)
P(w), where alpha spreads the mass that discounting took from h over just the words that don't follow it. P(w) is discounted in the
same way and leaves its rest to the unknown word. So the probabilities after any h sum to one over the vocabulary and
the unknown word.

Counts live in tables that are partitioned by history, a frequent history being spread over all partitions. Blocks of documents send
each distinct pair of theirs once, with its count, as packed arrays; partitions add the counts up, note how many pairs of each
history have which small count, and answer every block in the order it asked. A block is read again with the answers beside it, and
scores its tokens. What only the whole corpus can tell, the lower-order mass of a history's followers, is summed from the blocks and
joined to the tokens that back off.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.llm.tables import stored, text_of

#: Counts up to this are discounted.
DISCOUNTED = 5

#: Text of a block, and tokens for which there is a partition.
BLOCK_BYTES = 8 << 20
PARTITION_TOKENS = 1_500_000

#: A history with at least this share of all tokens is spread over all partitions; there are at most 1000.
FREQUENT = 1 / 1000

#: Places of the text's start and end in every vocabulary, and what stands for their hashes.
START, END = 0, 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Places(dict):
    """Numbers words as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class Block:
    """Tokens of some documents: `left` and `right` of each pair as places of a vocabulary, and the distinct pairs."""

    def __init__(self, texts: list[bytes], training: list[bool]):
        places = _Places({b"": START, b" ": END})
        number = places.__getitem__
        cut = [np.fromiter(map(number, words), np.int64, len(words)) for words in (text.lower().split() for text in texts)]
        self.tokens = np.array([len(words) + 1 for words in cut], np.int64)  # with the end
        ends = np.array([END])
        self.right = np.concatenate([part for words in cut for part in (words, ends)])
        self.first = np.concatenate(([0], np.cumsum(self.tokens)))[:-1]
        self.left = np.empty_like(self.right)
        self.left[1:] = self.right[:-1]
        self.left[self.first] = START
        digest = xxhash.xxh64_intdigest
        self.hashes = np.array([digest(word) for word in places], np.uint64)
        size = len(places)
        pairs, self.pair = np.unique(self.left * size + self.right, return_inverse=True)
        self.heads, self.followers = pairs // size, pairs % size
        weights = np.repeat(np.array(training, np.float64), self.tokens)
        self.counts = np.bincount(self.pair, weights, len(pairs)).astype(np.uint32)
        self.check = zlib.crc32(b"\0".join(texts))

    def by_partition(self, partitions: int, frequent: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each partition, in order: the distinct pairs there, and the places of their heads and how many pairs each has."""
        heads = self.hashes[self.heads]
        spread = np.isin(heads, frequent)
        key = np.where(spread, heads ^ (self.hashes[self.followers] * _ODD), heads) * _ODD
        part = ((key >> np.uint64(20)) % np.uint64(partitions)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(partitions + 1))
        for number in np.flatnonzero(np.diff(edges)):
            pairs = order[edges[number] : edges[number + 1]]
            own = self.heads[pairs]
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            yield int(number), pairs, own[starts], np.diff(np.append(starts, len(own)))


def _blocks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of a partition in blocks, whatever the batches; numbered by the partition, their last column, and their turn."""
    turn, held, size = 0, [], 0
    for batch in batches:
        for *row, task in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            held.append(row)
            size += len(row[text])
            if size >= BLOCK_BYTES:
                yield task << 24 | turn, held
                turn, held, size = turn + 1, [], 0
    if held:
        yield task << 24 | turn, held


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch; each may be large."""
    for place in range(batch.num_rows):
        yield batch.slice(place, 1).to_pylist()[0]


def discounts(numbers: list[int]) -> np.ndarray:
    """Katz's factors for counts 0 to `DISCOUNTED`, from how many types have count 1, 2 and so on, one further. Where the numbers
    are too few or too uneven for a factor between 0 and 1, half an occurrence is taken off."""
    factors = np.ones(DISCOUNTED + 1)
    for count in range(1, DISCOUNTED + 1):
        now, after = numbers[count - 1], numbers[count]
        factor = 0.0
        common = (DISCOUNTED + 1) * numbers[DISCOUNTED] / numbers[0] if numbers[0] else 1.0
        if now and common != 1:
            factor = ((count + 1) * after / now / count - common) / (1 - common)
        factors[count] = factor if 0 < factor < 1 else 1 - 0.5 / count
    return factors


@dataclass
class Model:
    """What all blocks share: sums over the corpus, and the followers of frequent histories."""

    singles: np.ndarray  # discounts of single words
    pairs: np.ndarray  # discounts of pairs
    tokens: int
    vocabulary: int
    ends: int
    rest: float  # probability of the unknown word
    total: int  # what counts of single words are divided by
    frequent: dict[int, tuple[int, ...]]

    def single(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by the count of w in training."""
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, _factor(self.singles, counts) * counts / self.total, self.rest)


def _factor(factors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Discounts by count; none above `DISCOUNTED`."""
    return factors[np.where(counts <= DISCOUNTED, counts, 0)]


def _frequent(rows: DataFrame) -> tuple[list[int], int]:
    """Hashes of frequent words, and how many tokens there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        total = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = text.encode().lower().split()
                seen.update(words)
                total += len(words) + 1
            if len(seen) > 300_000:  # what is rare so far in this task is not frequent in it
                seen = Counter({word: count for word, count in seen.items() if count >= total * FREQUENT / 20})
        own = [(xxhash.xxh64_intdigest(word), count) for word, count in seen.items() if count >= total * FREQUENT / 2]
        words = np.array([word for word, _ in own], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array([count for _, count in own], pa.int64()), pa.array([0] * len(own), pa.int64())], ["word", "n", "total"]
        )
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([0]), pa.array([total])], ["word", "n", "total"])

    counted = rows.select("text").mapInArrow(run, "word long, n long, total long")
    counted = stored(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    total = counted.agg(F.sum("total")).first()[0] or 0
    words = counted.filter(F.col("word").isNotNull() & (F.col("n") >= total * FREQUENT)).select("word")
    return [row.word for row in words.collect()], total


COUNTED = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("check", T.LongType()),
        T.StructField("head", T.LongType()),
        T.StructField("numbers", T.ArrayType(T.LongType())),
        T.StructField("counts", T.BinaryType()),
        T.StructField("owned", T.BinaryType()),
        T.StructField("heads", T.BinaryType()),
    ]
)
_COUNTED = pa.schema(
    [
        ("kind", pa.string()),
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("check", pa.int64()),
        ("head", pa.int64()),
        ("numbers", pa.list_(pa.int64())),
        ("counts", pa.binary()),
        ("owned", pa.binary()),
        ("heads", pa.binary()),
    ]
)
_HEAD = np.dtype([("count", "<i8"), ("small", "<u4", (DISCOUNTED,)), ("backs_off", "u1")])


def _histogram(counts: np.ndarray) -> list[int]:
    return [int((counts == count).sum()) for count in range(1, DISCOUNTED + 2)]


def _merged(part: int, asked: list[dict], frequent: np.ndarray) -> Iterator[dict]:
    """The answers of one partition to the blocks that asked it, and its sums."""
    heads = [np.frombuffer(each["heads"], "<u8") for each in asked]
    known, at = np.unique(np.concatenate(heads), return_inverse=True)
    owner = np.repeat(at, np.concatenate([np.frombuffer(each["sizes"], "<i4") for each in asked]))
    followers = np.concatenate([np.frombuffer(each["followers"], "<u8") for each in asked])
    counts = np.concatenate([np.frombuffer(each["counts"], "<u4") for each in asked]).astype(np.int64)
    key = followers ^ (known[owner] * _ODD)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    total = np.add.reduceat(counts[order], starts)
    every = np.empty_like(counts)
    every[order] = np.repeat(total, np.diff(np.append(starts, len(order))))
    owned = np.zeros(len(counts), bool)
    owned[order[starts]] = True
    of = owner[order[starts]]  # the history of each distinct pair

    facts = np.zeros(len(known), _HEAD)
    facts["count"] = np.bincount(of, total, len(known)).astype(np.int64)
    for count in range(1, DISCOUNTED + 1):
        facts["small"][:, count - 1] = np.bincount(of[total == count], minlength=len(known))
    facts["backs_off"] = (np.bincount(of[total == 0], minlength=len(known)) > 0) & (facts["count"] > 0)
    spread = np.isin(known, frequent)
    plain = facts["count"][~spread]
    sums = [*_histogram(total), *_histogram(plain), int((plain > 0).sum()), int(plain.sum())]
    yield {"kind": "sums", "part": part, "numbers": sums}
    for place in np.flatnonzero(spread):
        numbers = [int(facts["count"][place]), *map(int, facts["small"][place])]
        yield {"kind": "frequent", "part": part, "head": int(known[place].astype(np.int64)), "numbers": numbers}
    pair = head = 0
    for each, own in zip(asked, heads, strict=True):
        pairs = len(each["counts"]) // 4
        yield {
            "kind": "block",
            "block": each["block"],
            "part": part,
            "check": each["check"],
            "counts": every[pair : pair + pairs].astype("<i8").tobytes(),
            "owned": np.packbits(owned[pair : pair + pairs]).tobytes(),
            "heads": facts[at[head : head + len(own)]].tobytes(),
        }
        pair, head = pair + pairs, head + len(own)


def _count(rows: DataFrame, partitions: int, frequent: np.ndarray) -> DataFrame:
    """The table of counts: answers to blocks, and sums."""

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _blocks(batches, 0):
            block = Block([text.encode() for text, _ in held], [training for _, training in held])
            for part, pairs, heads, sizes in block.by_partition(partitions, frequent):
                row = {
                    "part": part,
                    "block": number,
                    "check": block.check,
                    "heads": block.hashes[heads].astype("<u8").tobytes(),
                    "sizes": sizes.astype("<i4").tobytes(),
                    "followers": block.hashes[block.followers[pairs]].astype("<u8").tobytes(),
                    "counts": block.counts[pairs].astype("<u4").tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], asked)

    def adding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for row in _one_by_one(batch):
                if held and row["part"] != part:
                    yield from answered(part, held)
                    held = []
                part = row["part"]
                held.append(row)
        if held:
            yield from answered(part, held)

    def answered(part: int, held: list[dict]) -> Iterator[pa.RecordBatch]:
        for row in _merged(part, held, frequent):
            yield pa.RecordBatch.from_pylist([row], _COUNTED)

    asked = pa.schema(
        [("part", pa.int32()), ("block", pa.int64()), ("check", pa.int64())]
        + [(name, pa.binary()) for name in ("heads", "sizes", "followers", "counts")]
    )
    kinds = "part int, block long, check long, heads binary, sizes binary, followers binary, counts binary"
    sent = rows.select("text", "training", F.spark_partition_id()).mapInArrow(asking, kinds)
    return sent.repartitionById(partitions, F.col("part")).sortWithinPartitions("part", "block").mapInArrow(adding, COUNTED)


def _model(counted: DataFrame, start: int) -> Model:
    size = 2 * (DISCOUNTED + 1) + 2
    sums = counted.filter("kind = 'sums'").agg(*[F.sum(F.get("numbers", F.lit(place))) for place in range(size)]).first()
    sums = [number or 0 for number in sums]
    rows = counted.filter("kind = 'frequent'").groupBy("head")
    rows = rows.agg(F.array(*[F.sum(F.get("numbers", F.lit(place))) for place in range(DISCOUNTED + 1)]).alias("numbers"))
    frequent = {row["head"]: tuple(row["numbers"]) for row in rows.collect()}  # at most 1001 rows
    pairs, singles = sums[: DISCOUNTED + 1], sums[DISCOUNTED + 1 : -2]
    vocabulary, tokens = sums[-2:]
    ends = frequent.get(start, (0,))[0]  # each training text has one start and one end
    for count in [ends, *(numbers[0] for head, numbers in frequent.items() if head != start)]:
        vocabulary += count > 0
        tokens += count
        if 0 < count <= DISCOUNTED + 1:
            singles[count - 1] += 1
    factors = discounts(singles)
    lost = sum((1 - factors[count]) * count * singles[count - 1] for count in range(1, DISCOUNTED + 1))
    total = tokens if lost else tokens + 1  # nothing to discount: one more occurrence, of the unknown word
    rest = (lost / tokens if lost else 1 / total) if tokens else 1.0
    return Model(factors, discounts(pairs), tokens, vocabulary, ends, rest, total, frequent)


def _scored(block: Block, answers: list[dict], model: Model, partitions: int, frequent: np.ndarray) -> dict:
    """Of each text: its figures, and the hashes of histories that it backs off from; of histories: lower-order mass."""
    counts = np.zeros(len(block.counts), np.int64)
    owned = np.zeros(len(block.counts), bool)
    facts = np.zeros(len(block.hashes), _HEAD)
    given = {answer["part"]: answer for answer in answers}
    for part, pairs, heads, _ in block.by_partition(partitions, frequent):
        answer = given[part]
        if answer["check"] != block.check:
            raise RuntimeError("the documents were not read twice in the same order; store them first")
        counts[pairs] = np.frombuffer(answer["counts"], "<i8")
        owned[pairs] = np.unpackbits(np.frombuffer(answer["owned"], np.uint8), count=len(pairs)).astype(bool)
        facts[heads] = np.frombuffer(answer["heads"], _HEAD)
    spread = np.flatnonzero(np.isin(block.hashes, frequent))
    for place, head in zip(spread, block.hashes[spread].view(np.int64).tolist(), strict=True):
        count, *small = model.frequent.get(head, (0,) * (DISCOUNTED + 1))
        facts[place] = (count, small, count > 0)
    single = facts["count"].copy()  # every word is followed by something
    single[END] = model.ends
    lower = model.single(single)

    lost = (facts["small"] * ((1 - model.pairs[1:]) * np.arange(1, DISCOUNTED + 1))).sum(axis=1)
    total = np.where(lost > 0, facts["count"], facts["count"] + 1)
    left = np.where(lost > 0, lost, 1) / total
    own = block.heads
    seen = counts > 0
    with np.errstate(divide="ignore"):
        direct = np.log10(_factor(model.pairs, counts) * counts / total[own])
    there = facts["count"][own] > 0
    back = np.log10(lower[block.followers]) + np.where(there, np.log10(left[own]), 0.0)
    logs = np.where(seen, direct, back)[block.pair]
    base = np.log10((single + 1) / (model.tokens + model.vocabulary + 1))[block.right]
    backing = (~seen & there)[block.pair]
    text = np.repeat(np.arange(len(block.tokens)), block.tokens)
    masses = seen & owned & (facts["backs_off"][own] > 0)
    mass = np.bincount(own[masses], lower[block.followers[masses]], len(block.hashes))
    held = np.flatnonzero(mass)
    hashes = block.hashes.view(np.int64)
    return {
        "n_known": np.add.reduceat((single[block.right] > 0).astype(np.int64), block.first),
        "base_score": np.add.reduceat(base, block.first),
        "score": np.add.reduceat(logs, block.first),
        "backed": np.split(hashes[block.left[backing]], np.cumsum(np.bincount(text[backing], minlength=len(block.tokens)))[:-1]),
        "heads": hashes[held],
        "masses": mass[held],
    }


def score(documents: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, trained, n_tokens, n_known, train_tokens, base_score, score) of every document.

    The model is learned from all whole texts where `training` holds, null counting as not. A-Z are lower-cased; words part at ASCII
    white space, and each text ends with one end token; null and empty texts are just that token. `score` is the model's log10
    probability of the text, `base_score` that of add-one smoothed single words. Repeated rows count as often as they occur; null ids are
    kept. Without training texts every token has probability 1. The documents are read three times and have to come in the
    same order each time, as stored tables do; otherwise the job fails.
    """
    rows = documents.select(
        F.col(id_column).alias("id"), text_of(text_column).alias("text"), F.coalesce(training, F.lit(False)).alias("training")
    )
    start = int(np.array([xxhash.xxh64_intdigest(b"")], np.uint64).view(np.int64)[0])
    words, tokens = _frequent(rows)
    frequent = np.array(sorted({*words, start}), np.int64).view(np.uint64)
    partitions = max(1, -(-tokens // PARTITION_TOKENS))
    counted = stored(_count(rows, partitions, frequent), "kind")
    model = _model(counted, start)

    id_type = rows.schema["id"].dataType
    asked = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("turn", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("flags", T.ArrayType(T.BooleanType())),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("texts", T.BinaryType()),
        ]
    )

    def sending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for number, held in _blocks(kept(batches), 1):
            for at in range(0, len(held), 1000):
                part = held[at : at + 1000]
                texts = [text.encode() for _, text, _ in part]
                arrays = [
                    pa.array([number], pa.int64()),
                    pa.array([at], pa.int32()),
                    pa.array([[each for each, _, _ in part]], pa.list_(kinds[0])),
                    pa.array([[flag for _, _, flag in part]], pa.list_(pa.bool_())),
                    pa.array([[len(text) for text in texts]], pa.list_(pa.int32())),
                    pa.array([pack.compress(b"".join(texts))], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, asked.names)

    kinds: list[pa.DataType] = []

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not kinds:
                kinds.append(batch.schema.field(0).type)
            yield batch

    result = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("turn", T.IntegerType()),
            T.StructField("id", id_type),
            T.StructField("trained", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("backed", T.ArrayType(T.LongType())),
            T.StructField("head", T.LongType()),
            T.StructField("mass", T.DoubleType()),
        ]
    )

    def scoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one block come together, answers before documents."""
        number, answers, sent = None, [], []
        unpack = zstandard.ZstdDecompressor()

        def done() -> Iterator[pa.RecordBatch]:
            if not sent:
                return
            texts, ids, flags = [], [], []
            for row in sent:
                data, at = unpack.decompress(row["texts"]), 0
                for size in row["sizes"]:
                    texts.append(data[at : at + size])
                    at += size
                ids += row["ids"]
                flags += row["flags"]
            block = Block(texts, flags)
            found = _scored(block, answers, model, partitions, frequent)
            for at in range(0, len(texts), 2000):
                part = slice(at, at + 2000)
                size = len(ids[part])
                arrays = [
                    pa.array([number] * size, pa.int64()),
                    pa.array(range(at, at + size), pa.int32()),
                    pa.array(ids[part], kinds[0].value_type),
                    pa.array(flags[part], pa.bool_()),
                    pa.array(block.tokens[part]),
                    *(pa.array(found[name][part]) for name in ("n_known", "base_score", "score")),
                    pa.array(found["backed"][part], pa.list_(pa.int64())),
                    pa.nulls(size, pa.int64()),
                    pa.nulls(size, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, result.names)
            for at in range(0, len(found["heads"]), 100_000):
                heads, masses = found["heads"][at : at + 100_000], found["masses"][at : at + 100_000]
                empty = [pa.nulls(len(heads), each) for each in (pa.int64(), pa.int32(), kinds[0].value_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*empty, pa.array(heads), pa.array(masses)], result.names)

        for batch in batches:
            if not kinds:
                kinds.append(batch.schema.field("ids").type)
            for row in _one_by_one(batch):
                if row["block"] != number:
                    yield from done()
                    number, answers, sent = row["block"], [], []
                (answers if row["turn"] < 0 else sent).append(row)
        yield from done()

    columns = ["part", "check", "counts", "owned", "heads"]
    sent = rows.select("id", "text", "training", F.spark_partition_id()).mapInArrow(sending, asked)
    sent = sent.select(*asked.names, *[F.lit(None).cast(COUNTED[name].dataType).alias(name) for name in columns])
    answers = counted.filter("kind = 'block'").select(
        "block", F.lit(-1).alias("turn"), *[F.lit(None).cast(asked[name].dataType).alias(name) for name in ("ids", "flags", "sizes", "texts")], *columns
    )
    together = answers.unionByName(sent).repartition("block").sortWithinPartitions("block", "turn", "part")
    scored = stored(together.mapInArrow(scoring, result))

    masses = scored.filter("head IS NOT NULL").groupBy("head").agg(F.sum("mass").alias("mass"))
    texts = scored.filter("turn IS NOT NULL")
    backed = texts.select("block", "turn", F.explode("backed").alias("head")).join(masses, "head", "left")
    # a history's followers leave at least the unknown word
    free = F.log10(F.greatest(1 - F.coalesce("mass", F.lit(0.0)), F.lit(model.rest)))
    backed = backed.groupBy("block", "turn").agg(F.sum(free).alias("free"))
    names = ["trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if clash := {id_column} & set(names):
        raise ValueError(f"the id column needs another name: {clash}")
    return texts.join(backed, ["block", "turn"], "left").select(
        F.col("id").alias(id_column),
        "trained",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("score") - F.coalesce("free", F.lit(0.0))).alias("score"),
    )
