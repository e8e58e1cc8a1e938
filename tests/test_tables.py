"""Tables are replaced at once: rebuilt from themselves, left alone by a run that fails, kept for those who read them."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shoploom import session
from shoploom.sources import tables
from shoploom.sources.tables import POINTER, current_version, read_table, write_table


def versions(path):
    return sorted(n for n in os.listdir(path) if n.startswith("version-"))


def test_a_table_is_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(100), path)
    for _ in range(3):
        write_table(read_table(spark, path).withColumn("id", F.col("id") + 1000), path)
    assert {r.id for r in read_table(spark, path).collect()} == set(range(3000, 3100))
    assert len(versions(path)) == 2 and not [n for n in os.listdir(path) if n.startswith(POINTER + "-")]


def test_readers_of_the_version_before_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(100), path)
    old = read_table(spark, path)
    new = write_table(spark.range(7), path)
    assert (old.count(), new.count(), read_table(spark, path).count()) == (100, 7, 7)
    write_table(spark.range(3), path, keep=1)
    assert len(versions(path)) == 1 and read_table(spark, path).count() == 3


def test_a_failed_run_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(100).withColumn("d", F.lit("2024-01-01").cast("date")), path, "d")
    bad = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"), F.lit("2024-01-02").cast("date").alias("d")
    )
    with pytest.raises(PySparkException):
        write_table(bad, path, "d")
    assert read_table(spark, path).count() == 100 and len(versions(path)) == 1
    with pytest.raises(PySparkException):
        write_table(bad, str(tmp_path / "never"))
    assert current_version(spark, str(tmp_path / "never")) == str(tmp_path / "never") and not versions(tmp_path / "never")


def test_a_run_cut_off_before_the_switch_is_not_seen(spark, tmp_path, monkeypatch):
    from shoploom.sources import tables

    path = str(tmp_path / "t")
    write_table(spark.range(100), path)

    def cut_off(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "replace_small", cut_off)
    with pytest.raises(KeyboardInterrupt):
        write_table(spark.range(5), path)
    assert read_table(spark, path).count() == 100


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p")).count() == 5
    assert write_table(spark.range(6), str(tmp_path / "p")).count() == 6 == read_table(spark, str(tmp_path / "p")).count()


def test_a_table_written_in_several_runs_is_whole(spark, tmp_path):
    """A third of the rows has one value, some have none; each run writes a stretch of the values."""
    value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("v"), (F.col("id") % 50).cast("string")))
    df = spark.range(3000).select("id", value.alias("v"), (F.col("id") % 2).alias("w"))
    stretches = tables._stretches(df, ["v", "w"], 4)
    assert len(stretches) > 2 and sum(s.count() for s in stretches) == 3000
    places = [sorted([(r.v is not None, r.v or "", r.w) for r in s.collect()]) for s in stretches]
    ends = [(p[0], p[-1]) for p in places if p]
    assert all(before[1] < after[0] for before, after in zip(ends, ends[1:], strict=False))
    made = tables.write_table(df, f"{tmp_path}/t", cluster_by=["v", "w"], runs=4)
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    none = tables.write_table(df.limit(0), f"{tmp_path}/none", cluster_by=["v"], runs=4)
    assert none.count() == 0 and none.columns == df.columns


def test_what_a_write_has_shuffled_goes_with_it(spark, tmp_path):
    """Before, the files stayed until the driver collected garbage."""
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {b for b in blocks.split() if b.endswith(".data")}

    before = shuffled()
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    session.write_files(df, f"{tmp_path}/files")
    tables.write_table(df, f"{tmp_path}/table", cluster_by=["k"])
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert spark.read.parquet(f"{tmp_path}/files").count() == 7
