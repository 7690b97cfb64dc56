"""Sources and sinks: latest file, empty-frame refusal, dated folders, dictionaries."""

import os
import time

import pytest
from pyspark.sql import functions as F

from surgecast.operators import features as fe
from surgecast.sinks import files as sk
from surgecast.sources import files as src


def test_csv_latest_file_only(spark):
    root = sk.scratch_path(spark, "latest")
    spark.createDataFrame([("old", 1)], "name string, v int").coalesce(1).write.option("header", True).csv(f"{root}/a")
    time.sleep(1.1)
    spark.createDataFrame([("new", 2), ("new", 3)], "name string, v int").coalesce(1).write.option("header", True).csv(f"{root}/b")
    everything = src.csv_union(spark, f"{root}/*/*.csv", "name string, v int")
    latest = src.csv_union(spark, f"{root}/*/*.csv", "name string, v int", latest_only=True)
    assert everything.count() == 3
    assert sorted(r.name for r in latest.collect()) == ["new", "new"]


def test_save_refuses_empty_frame(spark):
    with pytest.raises(ValueError):
        sk.save_processed(spark.range(0), sk.scratch_path(spark, "empty"))


def test_dated_folders_replace_only_their_partitions(spark):
    root = sk.scratch_path(spark, "dated")
    first = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, v int")
    sk.write_dated(first, root)
    sk.write_dated(spark.createDataFrame([("2024-01-02", 20)], "date string, v int"), root)
    local = root[len("file:"):] if root.startswith("file:") else root
    assert os.path.exists(os.path.join(local, "_SUCCESS"))
    assert os.path.exists(os.path.join(local, "date=2024-01-02", "_SUCCESS"))
    got = sorted((str(r.date), r.v) for r in spark.read.parquet(root).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 20)]


def test_dictionary_lookup_falls_back_to_default(spark):
    m = F.create_map(F.lit("m1"), F.lit("a"), F.lit("default"), F.lit("d"))
    df = spark.createDataFrame([("m1",), ("m2",)], "k string")
    got = [r.x for r in df.select(src.dictionary_lookup(m, F.col("k")).alias("x")).collect()]
    assert got == ["a", "d"]


def test_new_columns_are_add_only(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(1, "x", 2.0)], "id int, s string, extra double")
    assert fe.new_columns(a, b) == [("extra", "double")]
    assert fe.new_columns(b, a) == []


def test_cast_objects_to_string(spark):
    df = spark.createDataFrame([(["a", "b"], {"k": 1})], "arr array<string>, m map<string,int>")
    r = sk.cast_objects_to_string(df).first()
    assert r.arr == "a,b" and r.m == '{"k":1}'
