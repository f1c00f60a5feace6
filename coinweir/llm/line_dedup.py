"""Line deduplication by pairwise alignment.

Documents overlap where they share rare lines, those that at most half of the documents have. Who meets whom follows from contexts: a rare line by itself, a rare line with
the line before or behind it, the run of lines from a rare line to a more frequent or short one near it, and a whole text. Every context has a first holder, the earliest
document with it, and each later document with the context is a pair with that one. No pairs are made among later ones, so there are at most a few for each line,
however many documents share it. Where lines are more frequent, several must join a pair that amount to a passage. The two sequences of line
hashes are then aligned by patience diff, and blocks of aligned lines go from the later document.

A document whose block was first somewhere else, in other company, thus also meets the earliest document that has the block's lines in the same order. The
first holder of a line never loses it, for a block could take it only if an earlier document had it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.llm.memory import give_back, keep_only
from coinweir.llm.tables import fresh, stored, text_of

#: A line is rare in no more documents than this, or than this share of all: what a line is must not change as a corpus grows.
RARE = 50
RARE_SHARE = 0.5

#: Characters, blanks at the ends not counted, of a line that can make an overlap or a block by itself, and of
#: frequent lines that do so together.
LINE_CHARS = 20
PASSAGE_CHARS = 100


def _increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing run of the places, by piles."""
    tops: list[int] = []
    piles: list[int] = []
    behind: list[int] = []
    for index, place in enumerate(places):
        pile = bisect_left(tops, place)
        behind.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(place)
            piles.append(index)
        else:
            tops[pile], piles[pile] = place, index
    chosen, index = [], piles[-1] if piles else -1
    while index >= 0:
        chosen.append(index)
        index = behind[index]
    return chosen[::-1]


def aligned(one: list, other: list) -> list[tuple[int, int]]:
    """Places of lines that patience diff aligns, in order: lines that are unique on both sides, in their longest common order, are
    fixed; equal lines next to them join; what lies between is aligned in the same way."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(one), 0, len(other))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and one[a] == other[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and one[a_end - 1] == other[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            found.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        in_one, in_other = Counter(one[a:a_end]), Counter(other[b:b_end])
        where = {line: at for at, line in enumerate(other[b:b_end], b) if in_other[line] == 1}
        unique = [(at, where[line]) for at, line in enumerate(one[a:a_end], a) if in_one[line] == 1 and line in where]
        fixed = [unique[index] for index in _increasing([place for _, place in unique])]
        if not fixed:
            continue
        found += fixed
        edges = [(a - 1, b - 1), *fixed, (a_end, b_end)]
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False)]
    return sorted(found)


def blocks(one: list, other: list, sizes: list[int]) -> list[int]:
    """Places in `other` of the aligned blocks that hold a line of `LINE_CHARS`, by the `sizes` of its lines."""
    gone, block, before = [], [], None
    for a, b in [*aligned(one, other), (-9, -9)]:
        if before != (a - 1, b - 1):
            if any(sizes[place] >= LINE_CHARS for place in block):
                gone += block
            block = []
        block.append(b)
        before = (a, b)
    return gone


def contexts(lines: list[int], sizes: list[int], frequent: frozenset[int]) -> list[int]:
    """Hashes of what surrounds the rare lines of a text: of a rare line and the line before or behind it, and of the run from a rare line
    to each line, before or behind it, up to the next rare one. At most three for each line. Clashes of hashes only make pairs that have nothing to align."""
    rare = [size >= LINE_CHARS and line not in frequent for line, size in zip(lines, sizes, strict=True)]
    found = {hash((2, one, other)): None for one, other, a, b in zip(lines, lines[1:], rare, rare[1:], strict=False) if a or b}
    for way, places in enumerate((range(len(lines)), range(len(lines) - 1, -1, -1))):
        run, steps = None, 0
        for place in places:
            if rare[place]:
                run, steps = lines[place], 0
            elif run is not None:
                run, steps = hash((way, run, lines[place])), steps + 1
                if steps > 1:  # one step is a pair of neighbours
                    found[run] = None
    return list(found)


def _order(id_column: str, text_column: str) -> Column:
    """What makes a document earlier: its id, null behind all others, then its text's hash."""
    number = F.col(id_column)
    return F.struct(number.isNull().alias("late"), number.alias("id"), F.xxhash64(text_of(text_column)).alias("hash"))


def sequences_of(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(document, lines, sizes): hashes and lengths of the lines of each text. Rows with the same id and text are one document."""
    rows = documents.select(_order(id_column, text_column).alias("document"), F.split(text_of(text_column), "\n").alias("_lines"))
    lines = F.col("_lines")
    rows = rows.select(
        "document",
        F.transform(lines, lambda line: F.xxhash64(line)).alias("lines"),
        F.transform(lines, lambda line: F.length(F.trim(line))).alias("sizes"),
    )
    return stored(rows.groupBy("document").agg(F.first("lines").alias("lines"), F.first("sizes").alias("sizes")))


def _with_first_holder(held: DataFrame, key: str) -> DataFrame:
    """(document, holder) for the later holders of each `key`. Its first holders are written, so that a frequent key can be split in the join."""
    first = held.groupBy(key).agg(F.min("document").alias("holder"), F.count("*").alias("holders")).filter("holders > 1")
    later = held.join(stored(first.drop("holders")).hint("merge"), key).filter("holder < document")
    return later.select("document", "holder")


def overlaps(sequences: DataFrame) -> DataFrame:
    """(document, holder): the pairs to align, each once; at most a few for each line of a document."""
    each = sequences.select("document", F.explode(F.array_distinct(F.arrays_zip("lines", "sizes"))).alias("line"))
    each = each.select("document", F.col("line.lines").alias("line"), F.col("line.sizes").alias("size")).filter("size > 0")
    holders = each.groupBy("line").agg(F.min("document").alias("holder"), F.count("*").alias("holders"), F.max("size").alias("longest"))
    # stored, so that a frequent line can be split in the join
    holders = stored(holders.filter("holders > 1"))
    shared = each.join(holders.hint("merge"), "line").filter("holder < document")
    most = max(RARE, int(sequences.count() * RARE_SHARE))
    joined = shared.groupBy("document", "holder").agg(
        F.bool_or((F.col("holders") <= most) & (F.col("size") >= LINE_CHARS)).alias("rare"), F.sum("size").alias("chars")
    )
    pairs = joined.filter(F.col("rare") | (F.col("chars") >= PASSAGE_CHARS)).select("document", "holder")
    # equal texts overlap, however frequent their lines are
    wholes = sequences.filter(F.array_max("sizes") >= LINE_CHARS).select("document", F.xxhash64("lines").alias("whole"))
    # at most twice as many as a document has lines on average
    frequent = frozenset(row.line for row in holders.filter((F.col("holders") > most) & (F.col("longest") >= LINE_CHARS)).collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            at, found = [], []
            for place, text in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                own = contexts(*text, frequent)
                found += own
                at += [place] * len(own)
            documents = batch.column(0).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([documents, pa.array(found, pa.int64())], ["document", "context"])
        give_back()

    kind = sequences.schema["document"].dataType.simpleString()
    around = sequences.mapInArrow(run, f"document {kind}, context bigint")
    pairs = pairs.union(_with_first_holder(wholes, "whole")).union(_with_first_holder(around, "context"))
    return stored(pairs.distinct())


def removed_lines(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(document, gone): the places of lines to delete, for documents that lose any. `document` is a struct of id and text hash."""
    sequences = sequences_of(documents, id_column, text_column)
    return _lost(sequences, overlaps(sequences))


def _lost(sequences: DataFrame, pairs: DataFrame) -> DataFrame:
    """(document, gone): the places of lines that documents lose to the holders they are paired with."""
    first = sequences.select(F.col("document").alias("holder"), F.col("lines").alias("first"))
    # merged: files of lines that recur are much smaller than the lines in memory, and would be broadcast
    pairs = pairs.join(sequences.hint("merge"), "document").join(first.hint("merge"), "holder").select("document", "first", "lines", "sizes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            compared = zip(*(batch.column(place).to_pylist() for place in (1, 2, 3)), strict=True)
            gone = pa.array([blocks(*each) for each in compared], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), gone], ["document", "gone"])
        give_back()

    kind = sequences.schema["document"].dataType.simpleString()
    found = pairs.mapInArrow(run, f"document {kind}, gone array<int>").filter("size(gone) > 0")
    # no more than the lines of a document, for each of its holders
    return found.groupBy("document").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def without_shared_lines(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, their text without the lines that an earlier document has, and with `n_lines`, `n_removed`.

    Earlier is a smaller id; a null id is later than all others. Rows with the same id and text are one document and are
    treated alike, so a repeated row loses nothing to its twin. Lines part at \\n and are compared whole. Null and empty texts stay as
    they are, with no line removed; a document that loses all its lines is left with an empty text.
    """
    gone = removed_lines(documents, id_column, text_column)
    columns = documents.columns
    marks = fresh("gone", columns)
    key = fresh("document", columns)
    names = [fresh(name, columns) for name in ("n_lines", "n_removed")]
    rows = documents.withColumn(key, _order(id_column, text_column))
    gone = stored(gone).select(F.col("document").alias(key), F.col("gone").alias(marks))
    rows = rows.join(gone.hint("merge"), key, "left")  # the same plan whether few or many documents lose lines
    split = fresh("lines", columns)
    rows = rows.withColumn(split, F.split(F.col(text_column), "\n"))
    lines = F.col(split)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(marks))
    text = F.when(
        F.col(marks).isNotNull(),
        F.array_join(F.transform(left, lambda place: F.get(F.col(split), place)), "\n"),
    )
    sizes = [(F.col(text_column), lines), (F.col(marks), F.col(marks))]
    counts = [F.when(there.isNull(), F.lit(0)).otherwise(F.size(items)).cast("long") for there, items in sizes]
    kept = [F.coalesce(text, F.col(column)).alias(column) if column == text_column else F.col(column) for column in columns]
    return rows.select(*kept, *[count.alias(name) for name, count in zip(names, counts, strict=True)])
