"""What each of several filters removes, in every order in which they can be applied.

A document fails some of the filters; the set of those is its mask. Documents are counted by part and mask once, and all orders are
then worked out from those cells: a recursive common table expression begins with the empty prefix of each part and extends every prefix by
each letter that it lacks. A level joins the cells of the part, carries the bits applied so far, and adds the counts of its step. The work after the
counting depends on the number of parts and filters only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.llm.tables import fresh, stored, text_of

BLANKS = r"[\x20\x09-\x0D]+"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

#: Counts of a step: which cells count, by mask, bits applied before and the step's bit, and what is added up.
STEP_COUNTS = {
    "kept": ("(x.mask & (s.applied | f.bit)) = 0", "n"),
    "removed": ("(x.mask & s.applied) = 0 AND (x.mask & f.bit) <> 0", "n"),
    "redundant": ("(x.mask & s.applied) <> 0 AND (x.mask & f.bit) <> 0", "n"),
    "unique_fails": ("x.mask = f.bit", "n"),
    "good_lost": ("(x.mask & s.applied) = 0 AND (x.mask & f.bit) <> 0", "good"),
    "toxic_lost": ("(x.mask & s.applied) = 0 AND (x.mask & f.bit) <> 0", "toxic"),
}


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a whole text fails filters A to D; none of them is ever null."""
    words = F.filter(F.split(text, BLANKS), lambda word: word != "")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(documents: DataFrame, part: str = "lang", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, part, A to E) of every document: whether it fails each filter.

    E: a document with a smaller id has the same text, wherever it is in the table. Null texts count as empty and null parts as the empty string;
    a null id is smaller than none and has none that is smaller. Repeated rows are judged one by one; rows of one id don't copy each other.
    Texts are told apart by SHA-256. The texts are read once; what is kept of them is written to the shared folder. Copies are grouped in tasks
    before the shuffle; the first of each group with several ids is written, so that adaptive execution can split the join, however many copies there are.
    """
    text = F.col("_text")
    rows = documents.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of(text_column).alias("_text")
    )
    rows = stored(
        rows.select(
            "id",
            "part",
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"),
            *[fails.alias(letter) for letter, fails in text_failures(text).items()],
        )
    )
    first = rows.groupBy("same").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    return rows.join(stored(first.drop("last")), "same", "left").select(
        "id", "part", "A", "B", "C", "D", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("E")
    )


def labelled(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """The rows with the flags `good` and `toxic`: a label of their id says 1. Several labels of one id count as one; none, or a null, as false."""

    def says(column: str) -> Column:
        return F.coalesce(F.bool_or(F.col(column) == 1), F.lit(False))

    known = labels.filter(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    known = known.agg(says(good).alias("good"), says(toxic).alias("toxic")).filter("good OR toxic")
    no = F.lit(False)
    return rows.join(known, "id", "left").withColumns({name: F.coalesce(name, no) for name in ("good", "toxic")})


def cells(rows: DataFrame, letters: str) -> DataFrame:
    """One row per `part`: its documents counted by mask, at most 2 ** len(letters) cells. `rows` has a flag for each letter, and `good` and
    `toxic`. Counted in tasks before the shuffle."""
    mask = sum((F.when(F.col(letter), F.lit(1 << at)).otherwise(F.lit(0)) for at, letter in enumerate(letters)), start=F.lit(0))
    counted = rows.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    return counted.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("mask", "n", "good", "toxic"))).alias("cells"))


def _recursion(letters: str) -> str:
    filters = ", ".join(f"named_struct('letter', '{letter}', 'bit', {1 << at})" for at, letter in enumerate(letters))
    counts = ", ".join(
        f"'{name}', aggregate(c.cells, 0L, (total, x) -> total + if({which}, x.{what}, 0L))" for name, (which, what) in STEP_COUNTS.items()
    )
    kind = ", ".join(f"{name}: BIGINT" for name in STEP_COUNTS)
    return f"""WITH RECURSIVE prefixes (part, prefix, applied, steps) AS (
  SELECT part, '', 0, CAST(array() AS ARRAY<STRUCT<letter: STRING, {kind}>>) FROM {{cells}}
  UNION ALL
  SELECT s.part, concat(s.prefix, f.letter), s.applied | f.bit,
    concat(s.steps, array(named_struct('letter', f.letter, {counts})))
  FROM prefixes s
  JOIN LATERAL explode(filter(array({filters}), each -> (each.bit & s.applied) = 0)) AS unused(f)
  JOIN {{cells}} c ON c.part = s.part
)
SELECT part, prefix AS filter_order, step + 1 AS step, of.*
FROM prefixes JOIN LATERAL posexplode(steps) AS each(step, of) WHERE length(prefix) = {len(letters)}"""


def orders(found: DataFrame, letters: str) -> DataFrame:
    """What `cells` come to: a row for each part, order of all letters and step (from 1; its filter is that letter of the order), with
    the counts of `STEP_COUNTS` and `shapley`, the filter's removals added up over all orders. No parts, no rows.

    The result has n! * n rows a part. It is written to the shared folder, with the session's limit on rows of a recursion
    lifted meanwhile, since that limit would stop a job with some thousands of parts.
    """
    spark = found.sparkSession
    found = stored(found)
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        steps = stored(spark.sql(_recursion(letters), cells=found))
    finally:
        spark.conf.set(ROW_LIMIT, limit)
    all_orders = steps.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return steps.join(all_orders, ["part", "letter"]).select(
        "part", "filter_order", "step", *STEP_COUNTS, "shapley"
    )


def audit(
    documents: DataFrame, labels: DataFrame, part: str = "lang", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`orders` of filters A to E over whole documents, by the values of column `part`. Documents and labels of any other columns will do;
    an empty table gives no rows, and without labels nothing good or toxic is lost."""
    rows = labelled(failures(documents, part, id_column, text_column), labels, id_column)
    return orders(cells(rows, "ABCDE"), "ABCDE")


def oracle(part: str = "lang") -> str:
    """`audit` over `documents` and `labels` as DuckDB SQL: each order is walked by itself, over documents' masks."""
    letters = "ABCDE"
    filters = ", ".join(f"('{letter}', {1 << at})" for at, letter in enumerate(letters))
    joins = " ".join(f"JOIN filters f{i} ON " + " AND ".join(f"f{i}.letter <> f{j}.letter" for j in range(i)) for i in range(1, 5))
    steps = " UNION ALL ".join(
        f"SELECT {' || '.join(f'f{j}.letter' for j in range(5))} AS filter_order, {i + 1} AS step, f{i}.bit AS bit, "
        f"{' + '.join(['0', *[f'f{j}.bit' for j in range(i)]])} AS applied FROM filters f0 {joins}"
        for i in range(5)
    )
    return f"""WITH texts AS (SELECT doc_id, coalesce({part}, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
masks AS (SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask FROM split),
marked AS (SELECT part, mask, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM masks LEFT JOIN labels ON masks.doc_id = labels.doc_id),
counted AS MATERIALIZED (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY ALL),
filters (letter, bit) AS (VALUES {filters}),
steps AS ({steps}),
walked AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER ((mask & (applied | bit)) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER ((mask & applied) = 0 AND (mask & bit) <> 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER ((mask & applied) <> 0 AND (mask & bit) <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER ((mask & applied) = 0 AND (mask & bit) <> 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER ((mask & applied) = 0 AND (mask & bit) <> 0), 0)::BIGINT AS toxic_lost
  FROM counted CROSS JOIN steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM walked"""
