"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two segments of 32 bits. Of two fingerprints at most `max_bits` apart, one segment differs by at most
half of that, so each segment has a table of its values, and every fingerprint looks up the small Hamming ball around its own
value there. Whatever a look-up fetches is verified over all 64 bits. Nothing is enumerated for copies: only distinct
fingerprints are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.llm.components import components
from coinweir.llm.memory import give_back, keep_only
from coinweir.llm.tables import field, fresh, stored

SEED = 42
SEGMENT_BITS = 32

#: A table entry with more fingerprints than this is divided by parts of the other segment.
CROWDED = 200


def fingerprint(text: str, words_each: int) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it; 0 for a text without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(words_each, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)
    votes = np.zeros(64, np.int64)
    hashes = np.array([digest(joined[start:end], SEED) for start, end in spans], ">u8")
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * votes > len(hashes))
    return int.from_bytes(majority.tobytes(), "big", signed=True)


def fingerprints(
    documents: DataFrame, words_each: int, name: str = "fingerprint", text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The rows (or their columns `keep`) with the fingerprint of their whole text as a signed long, beside them."""
    columns = documents.columns if keep is None else keep
    place = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            found = [fingerprint(text or "", words_each) for text in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(found, pa.int64())], [*columns, name])
        give_back()

    schema = T.StructType([*(field(documents, column) for column in columns), T.StructField(name, T.LongType())])
    return documents.select(*columns, F.col(text_column).alias("_text")).mapInArrow(run, schema)


def _balls(radius: int) -> list[int]:
    """The bit patterns of at most `radius` bits in a segment."""
    return [sum(1 << bit for bit in bits) for size in range(radius + 1) for bits in combinations(range(SEGMENT_BITS), size)]


def _segment(value: Column, number: int) -> Column:
    """The low or the high half of a fingerprint, as a number from 0."""
    half = F.shiftrightunsigned(value, SEGMENT_BITS) if number else value
    return half.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(src, dst) for every two of the distinct fingerprints that differ in at most `max_bits` bits, src the larger one.

    Entries of a segment's table that hold more than `CROWDED` fingerprints are divided: the other segment is cut into
    `max_bits` + 1 parts, one of which two linked fingerprints must share, and each part makes an entry of its own. That
    finds the same links, whatever the size of an entry.
    """
    value = F.col("fingerprint")
    parts = max_bits + 1
    widths = [SEGMENT_BITS // parts + (part < SEGMENT_BITS % parts) for part in range(parts)]
    found = None
    for number in (0, 1):
        own, other = _segment(value, number), _segment(value, 1 - number)
        table = distinct.select("fingerprint", own.alias("entry"))
        crowded = table.groupBy("entry").count().filter(F.col("count") > CROWDED).select("entry", F.lit(True).alias("crowded"))
        pieces, at = [], 0
        for part, width in enumerate(widths):
            piece = F.shiftright(other, at).bitwiseAND(F.lit((1 << width) - 1))
            pieces.append(F.lit(part).cast("bigint") * (1 << SEGMENT_BITS) + piece)
            at += width

        def entries(rows: DataFrame, crowded: DataFrame = crowded, pieces: list[Column] = pieces) -> DataFrame:
            whole = F.array(F.lit(-1).cast("bigint"))
            part = F.when(F.col("crowded"), F.array(*pieces)).otherwise(whole)
            return rows.join(crowded, "entry", "left").select("fingerprint", "entry", F.explode(part).alias("part"))

        # A ball is entered from one of the two sides only, where that is enough: values one bit apart differ in parity.
        ball = _balls(max_bits // 2)
        if max_bits // 2 == 1:
            odd = F.bit_count(own) % 2 == 1
            probes = F.when(odd, F.array(*[own.bitwiseXOR(F.lit(flip)) for flip in ball])).otherwise(F.array(own))
        else:
            probes = F.array(*[own.bitwiseXOR(F.lit(flip)) for flip in ball])
        sought = distinct.select("fingerprint", F.explode(probes).alias("entry"))
        left = entries(table).withColumnRenamed("fingerprint", "one")
        right = entries(sought).withColumnRenamed("fingerprint", "two")
        near = F.bit_count(F.col("one").bitwiseXOR(F.col("two"))) <= max_bits
        # Spark sizes exploded rows like the rows that they are made from, and would broadcast tables many times too large
        pairs = left.join(right.hint("merge"), ["entry", "part"]).filter(near & (F.col("one") != F.col("two")))
        pairs = pairs.select(F.greatest("one", "two").alias("src"), F.least("one", "two").alias("dst"))
        found = pairs if found is None else found.unionByName(pairs)
    return found


def near_duplicates(
    documents: DataFrame, words_each: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) of every row of the documents.

    `fingerprint` is a signed long; documents whose fingerprints are at most `max_bits` bits apart are linked, and
    `component_id` is the smallest id among the documents that links reach. Null and empty texts have fingerprint 0 and
    are linked like any other; repeated rows stay. A null id counts only where the whole component has no other.
    """
    marked = stored(fingerprints(documents, words_each, "fingerprint", text_column, [id_column]))
    least = marked.groupBy("fingerprint").agg(F.min(id_column).alias("least"))
    distinct = least.select("fingerprint")
    reached = components(links(distinct, max_bits)).withColumnRenamed("node", "fingerprint")
    group = F.coalesce("component", "fingerprint").alias("group")
    # tables of all documents are merged: how large their files are does not tell how large they are in memory
    grouped = stored(least.join(reached.hint("merge"), "fingerprint", "left").select("fingerprint", "least", group))
    first = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    name = fresh("component_id", [id_column])
    found = grouped.join(first.hint("merge"), "group").select("fingerprint", F.col("component_id").alias(name))
    return marked.join(found.hint("merge"), "fingerprint").select(id_column, "fingerprint", name)


def one_of_each(documents: DataFrame, words_each: int = 3, max_bits: int = 2, id_column: str = "doc_id") -> DataFrame:
    """The documents without near-duplicates: of every component the row with its smallest id stays, one of them if rows
    repeat. A component without any id keeps one row."""
    key, place = fresh("row", documents.columns), fresh("place", documents.columns)
    number = F.col(id_column)
    # rows with the same key are equal in all columns
    rows = documents.withColumn(key, F.struct(number.isNull().alias("late"), number.alias("id"), F.xxhash64(*documents.columns).alias("hash")))
    mark = fresh("fingerprint", [key])
    marked = stored(fingerprints(rows, words_each, mark, keep=[key]))
    least = stored(marked.groupBy(F.col(mark).alias("fingerprint")).agg(F.min(key).alias(key)))
    reached = components(links(least.select("fingerprint"), max_bits)).withColumnRenamed("node", "fingerprint")
    group = F.coalesce("component", "fingerprint")
    firsts = least.join(reached.hint("merge"), "fingerprint", "left").groupBy(group).agg(F.min(key).alias(key)).select(key)
    kept = rows.join(firsts.hint("merge"), key, "left_semi")
    turn = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return kept.withColumn(place, turn).filter(F.col(place) == 1).select(*documents.columns)
