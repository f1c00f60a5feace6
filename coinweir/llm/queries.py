"""The numbered queries: each applies one operator to a whole table and derives the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinweir.llm import byte_bpe, filter_audit, katz, line_dedup, lloyd, neighbours, packing, quality_rules, repeats, simhash, toxicity, url_filter, warc
from coinweir.llm.tables import remainder, stored, table
from coinweir.llm.url_filter import ALLOW, BLOCK, Rule
from coinweir.session import work_dir


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_katz(spark: SparkSession, folder: str) -> DataFrame:
    scored = katz.score(table(spark, folder, "documents"), remainder("doc_id", 7) != 2)
    return scored.select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    made = packing.pieces(table(spark, folder, "documents"), path, end_id=1, capacity=4096, keep=["doc_id"])
    made = made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(made, capacity=4096)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = line_dedup.without_shared_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(remainder("doc_id", 5) != 0)
    machine = toxicity.fit(documents, labels)
    return toxicity.score(documents, machine, keep=["doc_id"]).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


URL_RULES = [
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
]


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    left = repeats.without_repeats(table(spark, folder, "documents"), length=200, keep=["doc_id"])
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words_each=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
    return found.withColumnRenamed("id", "vec_id")


def op11_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    found = lloyd.cluster(table(spark, folder, "embeddings"), length=64, scale=64, k=16, rounds=3, seed=1)
    return lloyd.with_totals(found).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    path = work_dir(spark)
    warc.write_archives(pages, path, least_bytes=1000)
    records = stored(warc.read_records(spark, path).drop("payload"))
    captures = warc.full_payloads(stored(warc.assemble(records)))
    number = pages.schema["page_id"].dataType
    digest = F.coalesce("payload_digest", F.replace("declared_digest", F.lit("sha1:"), F.lit("")))
    return captures.select(
        warc.field("metadata", "page").cast(number).alias("page_id"),
        "payload_bytes",
        digest.alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", warc.field("source", "page").cast(number)).alias("refers_to"),
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"), part="lang")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_katz": op2_katz,
        "op3_quality_rules": op3_quality_rules,
        "op4_packing": op4_packing,
        "op5_line_dedup": op5_line_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_url_filter": op7_url_filter,
        "op8_repeats": op8_repeats,
        "op9_simhash": op9_simhash,
        "op10_neighbours": op10_neighbours,
        "op11_lloyd": op11_lloyd,
        "op12_warc": op12_warc,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_url_filter": url_filter.oracle(URL_RULES),
        "op11_lloyd": lloyd.oracle(),
        "op12_warc": warc.oracle(),
        "op13_filter_audit": filter_audit.oracle(),
    }
