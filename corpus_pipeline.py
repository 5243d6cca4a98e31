"""Documents from raw to packed: each stage is written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last return
the columns of ``docs``.  ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import decontamination, language_id, line_dedup, near_dedup, packing
from ledgerlink.llm.queries import tokenizer_path
from ledgerlink.llm.support import Scratch, first_of


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in some language: those without any letter go, and those whose
    score is far below that of the labelled documents.

    Without labelled rows the model knows no language, and letters alone decide.
    """
    model = language_id.train(docs.where(~language_id.held_out()))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # Written, so that no text is scored twice: for the threshold and to be kept.
    found = Scratch(spark, "languages").store(language_id.identify(docs, model).drop("spans"))
    least = language_id.calibrate(found.where(~language_id.held_out("row.doc_id")))
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= F.lit(least))
    return found.where(known).select("row.*")


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that their source repeats; a source is a site.

    A document of nothing but such lines is a copy of others: it keeps its text, so that
    the next stage finds its group and keeps one of it.
    """
    before = first_of(docs, "before")
    found = line_dedup.drop_site_lines(
        docs.withColumn(before, F.col("text")), host_col="source"
    )
    emptied = F.col(first_of(docs, "emptied"))
    found = found.withColumn("text", F.when(emptied, F.col(before)).otherwise(F.col("text")))
    return _recounted(found, docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    return near_dedup.deduplicate(docs, percent=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; mostly copied ones go as a whole."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _recounted(decontamination.decontaminate(docs, benchmark), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    tokens = Scratch(spark, "packing").store(
        packing.tokenize(docs.select("doc_id", "text"), tokenizer_path())
    )
    pieces = tokens.select(
        F.col("row.doc_id").alias("doc_id"), "start", "length",
        F.crc32("ids").alias("ids_crc32"), "doc_tokens",
    )
    return packing.pack(pieces, ["doc_id", "start", "ids_crc32"])


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_boilerplate_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier of the first stage nor the tokenizer of the
#: last; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
