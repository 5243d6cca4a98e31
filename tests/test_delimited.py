"""The splittable reader against Spark's own reader of one task a file."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlink.sources.delimited import read_delimited
from ledgerlink.sources.sinks import write_csv
from ledgerlink.sources.specs import CSV_READ_OPTIONS, SourceSpec, read_source

COLUMNS = "a string, b string, c string"


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "200b")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _rows(seed, n=100):
    rng = random.Random(seed)
    cells = ["plain", "with, comma", 'with "quotes"', "line\nend", "two\n\nends\n", '"', "", None,
             'x"\n"y', "é\nü", " padded ", "\n", "a" * 150]
    return [tuple(rng.choice(cells) for _ in range(3)) for _ in range(n)]


def _both(spark, path):
    schema = spark.read.options(**CSV_READ_OPTIONS).csv(path).schema
    ours = read_delimited(spark, path, CSV_READ_OPTIONS, schema)
    theirs = spark.read.options(**CSV_READ_OPTIONS).csv(path)
    return sorted(map(str, ours.collect())), sorted(map(str, theirs.collect()))


@pytest.mark.parametrize("seed", range(2))
def test_one_file_of_many_splits(spark, small_splits, tmp_path, seed):
    rows = spark.createDataFrame(_rows(seed), COLUMNS)
    write_csv(rows.coalesce(1), f"{tmp_path}/one")
    assert spark.read.text(f"{tmp_path}/one").rdd.getNumPartitions() > 10
    ours, theirs = _both(spark, f"{tmp_path}/one")
    assert ours == theirs and len(ours) > 80


def test_several_files_and_line_ends(spark, small_splits, tmp_path):
    write_csv(spark.createDataFrame(_rows(9), COLUMNS).repartition(3), f"{tmp_path}/three")
    ours, theirs = _both(spark, f"{tmp_path}/three")
    assert ours == theirs and len(ours) > 80
    text = 'a,b,c\r\n1,"x\r\ny",2\r\n\r\n"p ""q""",,"\r\n"\r\nshort\r\n' * 1
    (tmp_path / "crlf.csv").write_bytes(text.encode())
    ours, theirs = _both(spark, f"{tmp_path}/crlf.csv")
    assert ours == theirs and len(ours) == 3
    (tmp_path / "header.csv").write_bytes(b"a,b,c\n")
    assert _both(spark, f"{tmp_path}/header.csv") == ([], [])


def test_a_source_is_read_by_many_tasks(spark, small_splits, tmp_path):
    rows = [(str(i), f"sku\n{i}" if i % 7 == 0 else f"sku-{i}") for i in range(150)]
    write_csv(spark.createDataFrame(rows, "product_id string, id_web string").coalesce(1),
              f"{tmp_path}/bridge")
    df = read_source(spark, SourceSpec("liaison", f"{tmp_path}/bridge", "csv"))
    assert sorted(tuple(r) for r in df.collect()) == sorted(rows)
    # Only lines of longer records are shuffled; the others stay in their splits.
    tasks = df.where("id_web NOT LIKE '%\n%'").select(F.spark_partition_id()).distinct().count()
    assert tasks > 3
    whole = SourceSpec("liaison", f"{tmp_path}/bridge", "csv", options={"multiLine": "true"})
    assert sorted(tuple(r) for r in read_source(spark, whole).collect()) == sorted(rows)
