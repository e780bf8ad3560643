"""Staged tables leave nothing but themselves."""

import time

from pyspark.sql import functions as F

from encore.llm import storage


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "/shuffle_" in f}


def test_staged_leaves_no_shuffle_files(spark):
    held, before = spark.conf.get(storage._SHUFFLES_GO, None), shuffle_files(spark)
    counted = spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count()
    rows = storage.staged(counted, "counted")
    for _ in range(50):  # executors are told, not waited for
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert rows.count() == 1000 and counted.count() == 1000
    assert spark.conf.get(storage._SHUFFLES_GO, None) == held
