"""Sums, ranks and frames across ranges against plain windows, with a key that holds nearly all rows."""

import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom import session
from shoploom.operators.ranges import RANGE, Ranged

N = 6000


@pytest.fixture(scope="module")
def rows(spark):
    """Nine tenths of the rows have one key, some no key, and days repeat."""
    i = F.col("id")
    key = F.when(i % 10 < 9, "hot").when(i % 50 == 9, None).otherwise(F.concat(F.lit("k"), (i % 7).cast("string")))
    return spark.range(N).select(
        i, key.alias("k"), F.pmod(F.hash("id"), F.lit(97)).alias("day"), F.when(i % 11 != 0, i % 13).alias("v"), F.lit(1).alias("_at")
    )


def pairs(df, *columns):
    return sorted(map(tuple, df.select("id", *columns).collect()))


@pytest.fixture(scope="module")
def ranged(rows):
    return Ranged(rows, ["k"], ["-day", "id"], ranges=8)


def test_a_hot_key_fills_several_ranges(ranged):
    sizes = {r["n"] for r in ranged.rows.where("k = 'hot'").groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
    assert len(sizes) > 3 and max(sizes) < N / 3


def test_running_sums_and_ranks(rows, ranged):
    w = W.partitionBy("k").orderBy(F.desc("day"), "id").rowsBetween(W.unboundedPreceding, 0)
    assert pairs(ranged.running({"s": F.col("v")}), "s") == pairs(rows.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0))), "s")
    assert pairs(ranged.ranked("r"), "r") == pairs(rows.withColumn("r", F.count("*").over(w)), "r")
    assert set(ranged.ranked("r").columns) == {*rows.columns, "r"}


def test_peers_share_a_value(rows):
    found = Ranged(rows, ["k"], ["day"], ranges=8).running({"s": F.col("v")}, peers=True)
    assert pairs(found, "s") == pairs(rows.withColumn("s", F.coalesce(F.sum("v").over(W.partitionBy("k").orderBy("day")), F.lit(0))), "s")


@pytest.mark.parametrize("reach, ranges", [(3, 8), (250, 40)])
def test_frames_reach_into_earlier_ranges(rows, reach, ranges):
    """With 40 ranges a frame spans several of them."""
    def columns(w):
        return {"lag": F.lag("id", reach).over(w), "sum": F.sum("v").over(w.rowsBetween(-reach, 0)), "n": F.count("*").over(w.rowsBetween(-reach, -1))}

    want = rows.withColumns(columns(W.partitionBy("k").orderBy("day", "id")))
    assert pairs(Ranged(rows, ["k"], ["day", "id"], ranges).framed(reach, columns), "lag", "sum", "n") == pairs(want, "lag", "sum", "n")


def test_no_keys_and_no_rows(spark, rows):
    want = pairs(rows.withColumn("s", F.row_number().over(W.orderBy("id"))), "s")
    assert pairs(Ranged(rows, [], ["id"], ranges=5).ranked("s"), "s") == want
    none = Ranged(rows.limit(0), ["k"], ["id"])
    assert none.ranked("r").count() == 0 and none.framed(2, lambda w: {"l": F.lag("v").over(w)}).count() == 0


def test_windows_over_rows_never_hold_a_key_alone(ranged):
    """Only sums per range are windowed by the key alone."""
    plan = ranged.running({"s": F.col("v")})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    assert len(windows) == 2
    alone = [line for line in windows if f"{RANGE}#" not in line.rsplit("], [", 2)[1]]
    assert len(alone) == 1 and "_before_s" in alone[0]


def test_release_removes_what_was_written(spark, rows):
    import os

    kept = Ranged(rows, ["k"], ["id"])
    path = kept.rows.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert os.path.exists(path)
    mine = [e for e in session._KEPT if e[1] in path]
    others = [e for e in session._KEPT if e not in mine]
    session._KEPT[:] = mine
    session.release(spark)
    session._KEPT[:] = others
    assert not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        pass

    class Spark:
        conf = Conf({"spark.sql.warehouse.dir": "file:/home/me/warehouse"})

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Spark)
    Spark.conf["spark.checkpoint.dir"] = "hdfs://cluster/cuts/"
    assert session.shared_folder(Spark) == "hdfs://cluster/cuts"


def test_rows_are_shuffled_once_for_running_sums(ranged):
    """Before, they were joined to the sums per range, which cost a shuffle more."""
    plan = ranged.running({"s": F.col("v")})._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\bJoin ", plan)


def test_columns_beside_running_sums(rows, ranged):
    beside = rows.groupBy("k").agg(F.max("id").alias("last"))
    found = ranged.running({"s": F.lit(1)}, beside=beside)
    want = rows.withColumn("last", F.max("id").over(W.partitionBy("k")))
    assert pairs(found, "last") == pairs(want, "last") and set(found.columns) == {*rows.columns, "last", "s"}
