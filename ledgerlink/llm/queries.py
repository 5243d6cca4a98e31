"""One query for each operator: it over the whole of its table, with digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import (
    conversations,
    decontamination,
    embedding_dedup,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    phrases,
    pii,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
)
from ledgerlink.llm.support import Scratch

SHARDS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard(docs, SHARDS, keep=("size", "text_crc32"))
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select(
        "page_id",
        line_dedup.host_of("url").alias("host"),
        line_dedup.page_lines("html").alias("text"),
    )
    # The operator reads its input twice; tags are taken out once.
    return line_dedup.drop_site_lines(Scratch(spark, "pages").store(pages))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        language_id.held_out("row.doc_id").alias("held_out"),
        "lang_pred", "score", "spans",
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out())
    scored = toxicity.toxicity(docs, toxicity.train(docs, labels))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        toxicity.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *_digest("base", pii.KINDS, "true")[:-1], _digest("spans", pii.KINDS, "true")[-1],
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def _digest(spans: str, kinds: tuple[str, ...], base: str) -> list[Column]:
    """Counts of base spans by kind, their digest, and all spans as text; ``base`` is
    the condition on a span x that holds for base spans."""
    shown = "x -> concat_ws(':', x.kind, x.start, x.end)"
    of_base = f"filter({spans}, x -> {base})"
    return [
        *(
            F.expr(f"CAST(size(filter({of_base}, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}")
            for k in kinds
        ),
        F.expr(
            f"sha2(CAST(array_join(transform({of_base}, {shown}), ',') AS BINARY), 256)"
        ).alias("base_sha256"),
        F.expr(f"array_join(transform({spans}, {shown}), ',')").alias("spans"),
    ]


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *_digest("spans", secret_scan.KINDS, "x.via = ''"),
        "complete",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = Scratch(spark, "packing").store(packing.tokenize(docs, tokenizer_path()))
    pieces = tokens.select(
        F.col("row.doc_id").alias("doc_id"), "start", "length",
        F.crc32("ids").alias("ids_crc32"), "doc_tokens",
    )
    return packing.pack(pieces, ["doc_id", "start", "ids_crc32"])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"),
    )
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("words").alias("n_words"),
        F.col("hit").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("hit") > 0).alias("contaminated"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    found = conversations.summaries(conversations.damaged(turns))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    # Conversations of which the damage left nothing are in the result too.
    return turns.select("conv_id").distinct().join(
        found, F.col("conv_id").eqNullSafe(F.col("conv")), "left"
    ).select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
        .alias("repaired_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_pii": op6_pii,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrases": op12_phrases,
    "op13_substring_dedup": op13_substring_dedup,
}
