"""Sources, staging, stored tables and sinks."""

import pytest
from pyspark.sql import functions as F

from ledgerlink.sources import specs, store
from ledgerlink.sources.sinks import read_json, write_csv, write_json
from ledgerlink.sources.specs import SourceSpec
from ledgerlink.sources.store import TableStore

AWKWARD = [
    ('say "hi", twice', "1"),
    ("two\nlines", "2"),
    ("back\\slash", "3"),
    (" blanks kept ", "4"),
    ("é €  ", "5"),
    (None, "6"),
]


def test_missing_source_names_it(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="erp not found"):
        specs.read_source(spark, SourceSpec("erp", f"{tmp_path}/none"))


def test_missing_columns_are_listed_sorted(spark, tmp_path):
    path = str(tmp_path / "web")
    frame = spark.createDataFrame([("1", "a")], "sku string, post_title string")
    frame.write.parquet(path)
    message = "Columns missing in web: guid, post_modified, post_type, total_sales"
    with pytest.raises(ValueError, match=message):
        specs.read_source(spark, SourceSpec("web", path))


def test_header_is_stripped_and_other_columns_stay(spark, tmp_path):
    path = str(tmp_path / "bridge.csv")
    with open(path, "w", encoding="utf-8") as file:
        file.write(' product_id , id_web,note\n7.0, sku-1 ,""\n"8","",x\n')
    df = specs.read_source(spark, SourceSpec("liaison", path, "csv"))
    assert df.columns == ["product_id", "id_web", "note"]
    assert [tuple(r) for r in specs.stage_frame(df).collect()] == [
        ("7", "sku-1", None),
        ("8", None, "x"),
    ]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "round")
    frame = spark.createDataFrame(AWKWARD, "product_id string, id_web string")
    write_csv(frame.repartition(2), path)
    back = spark.read.options(**specs.CSV_READ_OPTIONS).csv(path)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == AWKWARD


def test_csv_is_read_as_another_engine_reads_it(spark, tmp_path):
    import duckdb
    import pandas as pd

    path = str(tmp_path / "cells.csv")
    pd.DataFrame(AWKWARD, columns=["product_id", "id_web"]).to_csv(
        path, index=False, encoding="utf-8", lineterminator="\n"
    )
    theirs = duckdb.sql(
        f"SELECT * FROM read_csv('{path}', header = true, all_varchar = true, "
        "nullstr = '')"
    ).fetchall()
    ours = specs.read_source(spark, SourceSpec("liaison", path, "csv")).collect()
    assert [tuple(r) for r in ours] == theirs == AWKWARD


def test_manifest_counts_repeats_as_pandas_does(spark):
    rows = [("a", None), ("a", None), (None, "a"), ("a", "a"), ("a", "a"), ("a", "a")]
    frame = spark.createDataFrame(rows, "x string, y string")
    expected = int(frame.toPandas().duplicated().sum())
    line = specs.manifest({"pairs": frame}).first()
    assert tuple(line) == ("pairs", 6, 2, expected)
    empty = specs.manifest({"none": frame.where("x = 'q'")}).first()
    assert tuple(empty) == ("none", 0, 2, 0)


def test_manifest_of_a_table_of_copies(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("copy"))
        .otherwise(F.col("id").cast("string"))
        .alias("x"),
        F.lit(None).cast("string").alias("y"),
    )
    assert specs.manifest({"t": frame}).first()["full_row_duplicates"] == 9_999


def test_json_round_trip(spark, tmp_path):
    document = {"total": "70568.60", "labels": ["millésime"], "n": 3, "none": None}
    write_json(spark, f"{tmp_path}/doc.json", document)
    write_json(spark, f"{tmp_path}/doc.json", document)
    assert read_json(spark, f"{tmp_path}/doc.json") == document


def test_tables_are_replaced_and_attached(spark, tmp_path):
    tables = TableStore(spark, f"{tmp_path}/t", "replaced")
    tables.save("numbers", spark.range(3).toDF("n"))
    assert tables.save("numbers", spark.range(5).toDF("m")).columns == ["m"]
    assert spark.sql("SELECT count(*) FROM replaced.numbers").first()[0] == 5
    assert tables.exists("numbers") and not tables.exists("letters")
    later = TableStore(spark, f"{tmp_path}/t", "replaced_later")
    later.attach(["numbers"])
    assert later.load("numbers").count() == 5


def test_steps_see_earlier_tables_and_parameters(spark, tmp_path):
    tables = TableStore(spark, f"{tmp_path}/t", "steps")
    tables.save("numbers", spark.range(10).toDF("n"))
    results = tables.run_steps(
        [
            ("large", "SELECT n FROM numbers WHERE n >= :least"),
            ("total", "SELECT sum(n) AS total FROM large WHERE n > :least"),
        ],
        {"least": 7},
    )
    assert results["large"].count() == 3
    assert results["total"].first()["total"] == 17
    assert spark.catalog.currentDatabase() == "default"


def test_views_come_and_go(spark):
    store.register(spark.range(2), "passing")
    assert spark.table("passing").count() == 2
    assert store.unregister(spark, "passing")
    assert not spark.catalog.tableExists("passing")


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    tables = TableStore(spark, f"{tmp_path}/t", "bucketed", buckets=4)
    left = tables.save("lefts", spark.range(1000).toDF("k"), "k")
    right = tables.save("rights", spark.range(500).toDF("k"), "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    grouped = left.groupBy("k").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert store.scratch_root(spark) == named.rstrip("/")
    kept = store.stored(spark.range(4).toDF("n"), "kept")
    assert kept.count() == 4
    assert all(named in name for name in kept.inputFiles())


def test_rows_of_single_hashes_are_not_compared(spark):
    """Only rows that repeat, and a few that share their bits, go on to be shuffled."""
    from ledgerlink.functions.bitmaps import with_listed
    from ledgerlink.sources.specs import full_row_duplicates

    rows = spark.range(20_000).select(
        F.col("id"), F.concat(F.lit("text "), F.col("id")).alias("_hash"), F.lit(1).alias("n")
    )
    doubled = rows.unionByName(rows.where("id % 100 = 0")).unionByName(rows.where("id = 7"))
    hashed = doubled.withColumn("h", F.xxhash64(*doubled.columns))
    repeated = hashed.groupBy("h").count().where("count > 1")
    marked = with_listed(hashed, F.col("h"), repeated, F.col("h"), "again")
    again = marked.where("again")
    assert again.where("id % 100 = 0 OR id = 7").count() == 2 * 201
    assert again.count() < 2 * 201 + 20 and marked.count() == doubled.count()
    counted = spark.range(1).select(full_row_duplicates(doubled).alias("n"))
    assert counted.first()["n"] == 201
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("duplicates", "the frame")
    full_row_duplicates(doubled)
    assert tracker.getJobIdsForGroup("duplicates") == []
    spark.sparkContext.setJobGroup("other", "")


def test_numbers_of_a_document_are_read_back(spark, tmp_path):
    from ledgerlink.sources.sinks import json_numbers, write_json

    write_json(spark, f"{tmp_path}/d.json", {"a": 1.25, "b": {"rows": 3, "é": 4}, "c": None})
    found = {r["key"]: r["value"] for r in json_numbers(spark, f"{tmp_path}/d.json").collect()}
    assert found == {"a": 1.25, "b.rows": 3.0, "b.é": 4.0, "c": None}
