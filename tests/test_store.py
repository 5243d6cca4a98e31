"""Stored tables belong to their run, and replacing one is safe."""

import pytest
from pyspark.sql import functions as F

from ledgerlink import Expected, SourceSpec
from ledgerlink.plans import run as plans
from ledgerlink.sources import store as stores
from ledgerlink.sources.store import MixedVersionsError, TableStore


def test_two_roots_in_one_database(spark, tmp_path):
    one = TableStore(spark, f"{tmp_path}/one", "shared_name")
    two = TableStore(spark, f"{tmp_path}/two", "shared_name")
    one.save("numbers", spark.range(5))
    two.save("numbers", spark.range(9))
    assert one.load("numbers").count() == 5
    assert two.load("numbers").count() == 9
    assert one.load("numbers").count() == 5
    three = TableStore(spark, f"{tmp_path}/three", "shared_name")
    assert not three.exists("numbers")
    assert plans.stored_tables(three) == {}
    with pytest.raises(ValueError, match="numbers"):
        three.load("numbers")


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/it's", "failing")
    store.save("numbers", spark.range(5))
    broken = spark.range(5).select(
        F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id")
    )
    with pytest.raises(Exception, match="no"):
        store.save("numbers", broken)
    assert store.load("numbers").count() == 5
    store.save("numbers", spark.range(7))
    assert store.load("numbers").count() == 7
    assert store.vacuum() == []
    # Of three written folders, one failed, the present one stays.
    assert len(store.vacuum(retain_seconds=0)) == 2
    assert store._files("numbers") == [store.location("numbers").rsplit("/", 1)[1]]
    assert store.load("numbers").count() == 7


def test_a_frame_outlives_the_version_that_it_reads(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), "readers")
    before = store.save("numbers", spark.range(5))
    doubled = before.selectExpr("id * 2 AS id")
    after = store.save("numbers", doubled, inputs=["numbers"])
    assert (before.count(), doubled.agg(F.max("id")).first()[0], after.count()) == (5, 8, 5)
    again = TableStore(spark, str(tmp_path), "other_readers")
    assert again.load("numbers").agg(F.max("id")).first()[0] == 8


def test_mixed_versions_are_refused(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), "mixed")
    store.save("raw", spark.range(5))
    store.save("clean", store.load("raw"), inputs=["raw"])
    store.save("merged", store.load("clean"), inputs=["clean"])
    store.require_one_set(["merged"])
    held = store.load("clean")
    store.save("raw", spark.range(6))
    assert store.stale(["merged"]) == {"clean": ["raw"]}
    with pytest.raises(MixedVersionsError, match="clean .from another raw."):
        store.require_one_set(["merged"])
    store.save("clean", store.load("raw"), inputs=["raw"])
    # Built from the version that was loaded, whatever is present when it is written.
    store.load("clean")
    assert store.stale(["merged"]) == {"merged": ["clean"]}
    store.save("merged", held, inputs=["clean"])
    other = TableStore(spark, str(tmp_path), "mixed")
    assert other.stale(["merged"]) == {} and held.count() == 5


def test_tables_stored_at_once_all_enter_the_set(spark, tmp_path):
    stores_ = [TableStore(spark, str(tmp_path), "at_once") for _ in range(2)]
    stores.together(*(
        lambda i=i: stores_[i % 2].save(f"t{i}", spark.range(i)) for i in range(8)
    ))
    assert sorted(stores_[0].current()) == [f"t{i}" for i in range(8)]
    assert [stores_[1].load(f"t{i}").count() for i in range(8)] == list(range(8))


def test_runs_keep_their_scratch_apart(spark):
    outside = stores.stored(spark.range(2), "outside")
    with stores.own_scratch(spark) as outer:
        mine = stores.stored(spark.range(3), "mine")
        with pytest.raises(ValueError, match="stop"), stores.own_scratch(spark) as inner:
            stores.together(lambda: stores.stored(spark.range(4), "a"),
                            lambda: stores.stored(spark.range(5), "b"))
            assert len(inner) == 2 and len(outer) == 1
            gone = list(inner)
            raise ValueError("stop")
        assert inner == [] and mine.count() == 3
        for path in gone:
            with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                spark.read.parquet(path)
    assert outer == [] and outside.count() == 2
    with pytest.raises(Exception, match="no"), stores.own_scratch(spark):
        stores.stored(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), "bad")


def test_layout_is_kept_on_attach(spark, tmp_path):
    TableStore(spark, str(tmp_path), "before", buckets=3).save(
        "numbers", spark.range(50).withColumnRenamed("id", "k"), "k"
    )
    later = TableStore(spark, str(tmp_path), "after")
    later.attach(["numbers"])
    facts = later._facts("numbers")
    assert facts["Num Buckets"] == "3" and "k" in facts["Bucket Columns"]
    plan = later.load("numbers").groupBy("k").count()._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_null_web_keys_do_not_share_a_bucket(spark, tmp_path):
    bridge = spark.range(20_000).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("sku-"), F.col("id"))).alias("id_web"),
    )
    store = TableStore(spark, str(tmp_path), "bridges", buckets=4)
    saved = store.save("liaison_clean", bridge, plans.TABLES["liaison_clean"])
    per_file = saved.groupBy(F.input_file_name()).count().select("count").collect()
    assert max(r[0] for r in per_file) < 2 * 20_000 / 4


@pytest.mark.parametrize("names", [["erp", "web"], ["erp", "liaison", "web", "crm"]])
def test_the_set_of_sources_is_checked(spark, tmp_path, names):
    sources = [SourceSpec(name, f"{tmp_path}/{name}") for name in names]
    with pytest.raises(ValueError, match="Sources needed"):
        plans.run(spark, sources, str(tmp_path), Expected.published())


class _Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, name, *default):
        return self.settings.get(name, *default)


def test_scratch_lies_in_a_shared_folder_and_can_be_dropped(spark):
    assert stores.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    named = _Session(spark_checkpoint_dir="hdfs://a/b/", spark_sql_warehouse_dir="hdfs://w")
    assert stores.scratch_root(named) == "hdfs://a/b"
    unnamed = _Session(spark_sql_warehouse_dir="hdfs://w/")
    assert stores.scratch_root(unnamed) == "hdfs://w/scratch"
    gone = stores.stored(spark.range(4), "few")
    with stores.own_scratch(spark):
        kept = stores.stored(spark.range(3), "few")
        stores.drop_stored(spark)
        assert kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        gone.count()
