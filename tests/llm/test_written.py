"""Work tables leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from tessera.llm import common


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_the_table(spark):
    keyed = spark.range(20_000).select((F.col("id") % 500).alias("k"), "id").repartition(5, "k")
    rows = keyed.groupBy("k").agg(F.sum("id").alias("n")).repartition(3, "n")
    keyed.count()
    before, setting = shuffle_files(spark), spark.conf.get(common.DROP_SHUFFLES, None)
    table = common.written(rows, "shuffled")
    until = time.time() + 5
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(common.DROP_SHUFFLES, None) == setting
    assert table.count() == rows.count() == table.count() == 500


def test_setting_is_restored(spark):
    spark.conf.set(common.DROP_SHUFFLES, "false")
    try:
        common.written(spark.range(10).repartition(2, "id"), "restored")
        assert spark.conf.get(common.DROP_SHUFFLES, None) == "false"
    finally:
        spark.conf.unset(common.DROP_SHUFFLES)
