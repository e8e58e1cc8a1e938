import os

from pyspark.sql import functions as F

from shoploom import session
from shoploom.llm import common


def test_several_blocks_share_a_bucket(spark, monkeypatch):
    """As many buckets as Spark allows at most, whatever the number of blocks; marks find their rows all the same."""
    monkeypatch.setattr(common, "MOST_BUCKETS", 3)
    blocks = common.Blocks(spark.range(1000).repartition(17), "many")
    assert blocks.buckets == 3 and blocks.rows.select("block").distinct().count() == 17
    marks = common.marks_of(blocks.rows.where("id % 7 = 0").select("rid"))
    found = blocks.marked(marks, "seventh")
    assert found.count() == 1000 and found.where(F.col("seventh") != (F.col("id") % 7 == 0)).count() == 0


def test_release(spark, monkeypatch):
    monkeypatch.setattr(session, "_KEPT", [])
    blocks, rows = common.Blocks(spark.range(10), "gone"), common.written(spark.range(10), "gone")
    paths = [path for _, path, _ in session._KEPT]
    assert len(paths) == 2 and all(os.path.exists(p) for p in paths) and rows.count() == blocks.rows.count()
    tables = {t.name for t in spark.catalog.listTables()}
    session.release(spark)
    assert not any(os.path.exists(p) for p in paths) and session._KEPT == []
    assert len(tables - {t.name for t in spark.catalog.listTables()}) == 1
