from pyspark.sql import functions as F

from pulselake.llm.common import prepare, stored


def test_shuffle_files_go_with_their_query(spark):
    files = lambda: {f for f in map(str, disk.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    prepare(spark)
    before = files()
    held = stored(spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).count(), "test-shuffle")
    assert held.count() == 1000
    assert not files() - before
