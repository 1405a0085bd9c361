"""The operators as queries over the given tables, and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm import (
    decontaminate,
    html_extract,
    jaccard_join,
    line_dedup,
    merkle,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    suffix_dedup,
    warc,
)
from laborlake.llm.common import table
from laborlake.session import new_folder

SHARDS = 40


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.group_documents(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed_lines", "n_runs", F.col("text").alias("kept_text"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.with_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("_matches", lambda m: m["item_id"])))
    return found.select(
        "doc_id",
        (F.size("_matches") > 0).alias("contaminated"),
        items.alias("item_ids"),
        F.array_min(F.transform("_matches", lambda m: m["edits"])).alias("fewest_edits"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    opening = F.crc32(F.col("conv_id").cast("string")) % 6
    return prefix_trie.trie(prefix_trie.with_shared_openings(convs, group=100, opening=opening, most=5))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.try_add(F.col("n_chars"), F.lit(1).cast("long"))
    tampered = F.when(chosen, merkle.leaf(n_chars=more))
    rows = merkle.manifest(docs, tampered=tampered).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("siblings", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda test: F.filter("_spans", lambda s: test(s["kind"]))
    base = of(lambda kind: kind != "random")
    return found.select(
        "doc_id",
        F.size(of(lambda kind: kind == "assign")).cast("long").alias("n_assign"),
        F.size(of(lambda kind: kind == "access")).cast("long").alias("n_access"),
        F.size(of(lambda kind: kind == "hex")).cast("long").alias("n_hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("_spans")).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_jaccard_join,
        op3_warc,
        op4_line_dedup,
        op5_sharding,
        op6_html_extraction,
        op7_decontamination,
        op8_quality_rules,
        op9_quality_classifier,
        op10_packing,
        op11_prefix_trie,
        op12_merkle_manifest,
        op13_secret_scan,
    )
}
