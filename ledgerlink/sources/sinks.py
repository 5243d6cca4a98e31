"""Delimited, JSON and segment sinks.  Every sink writes a folder of part files."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.operators.report import report_detail, report_summary
from ledgerlink.operators.segment import sorted_segment_list
from ledgerlink.sources.store import together

# UTF-8 with a header, LF line ends, doubled quotes, blanks kept, null as empty.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def write_json(spark: SparkSession, path: str, document: Mapping[str, object]) -> None:
    """Write one small document through Spark, so that any shared folder works."""
    text = json.dumps(document, ensure_ascii=False, indent=2)
    frame = spark.createDataFrame([(text,)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict[str, object]:
    """Read back a document written by ``write_json``."""
    row = spark.read.text(path, wholetext=True).where("value <> ''").first()
    return json.loads(row["value"])


def json_numbers(spark: SparkSession, path: str) -> DataFrame:
    """The numbers of a document that ``write_json`` wrote: ``key`` and ``value``.

    Those of an inner object have its name before theirs.
    """
    cells = spark.read.text(path, wholetext=True).where("value <> ''").select(
        F.explode(F.from_json("value", "map<string,string>")).alias("key", "text")
    )
    inner = F.from_json("text", "map<string,double>")
    plain = F.create_map(F.lit(""), F.col("text").try_cast("double"))
    return cells.select(
        "key", F.explode(F.when(F.col("text").startswith("{"), inner).otherwise(plain))
        .alias("part", "value")
    ).select(F.concat_ws(".", "key", F.nullif("part", F.lit(""))).alias("key"), "value")


def write_segments(segments: DataFrame, out: str) -> None:
    """Both segment lists, in report order."""
    names = {fv.PREMIUM: "vins_premium.csv", fv.ORDINARY: "vins_ordinaires.csv"}
    together(
        *(
            partial(write_csv, sorted_segment_list(segments, label), f"{out}/{name}")
            for label, name in names.items()
        )
    )


def write_revenue_report(detail: DataFrame, summary: DataFrame, out: str) -> None:
    """The two sheets of the revenue report."""
    write_csv(report_summary(summary), f"{out}/rapport_chiffre_affaires/synthese.csv")
    write_csv(
        report_detail(detail), f"{out}/rapport_chiffre_affaires/ca_par_produit.csv"
    )
