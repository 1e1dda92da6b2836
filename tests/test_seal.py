"""Digests that do not depend on order, and folders that are refused."""

import os

import pytest
from pyspark.sql import functions as F

from loadcast.sinks import seal as S

SMALL = "/root/testdata/sf0.001"


def test_digest_tells_content_and_not_order(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    d = S.table_digest(df)
    shuffled = df.select(*reversed(df.columns)).repartition(5).sortWithinPartitions("o_totalprice")
    assert S.table_digest(shuffled) == d and d["rows"] == df.count()
    key = df.agg(F.min("o_orderkey")).first()[0]
    one = F.col("o_orderkey") == key
    assert S.table_digest(df.where(~one)) != d
    assert S.table_digest(df.withColumn("o_totalprice", F.when(one, 0.5).otherwise(F.col("o_totalprice")))) != d
    assert S.table_digest(df.unionByName(df.where(one)).unionByName(df.where(one))) != d
    assert S.table_digest(df.withColumnRenamed("o_comment", "note") if "o_comment" in df.columns else df.withColumn("x", F.lit(1))) != d


def test_digest_of_nulls_and_empty_tables(spark):
    left = S.table_digest(spark.createDataFrame([(None, 1)], "a int, b int"))
    right = S.table_digest(spark.createDataFrame([(1, None)], "a int, b int"))
    assert left != right
    empty = S.table_digest(spark.createDataFrame([], "a int, `b.c` string"))
    assert (empty["rows"], empty["sum"], empty["xor"]) == (0, "0", 0)


def test_unfinished_and_altered_folders_are_refused(spark, folder):
    root = f"{folder}/package"
    a = spark.range(20).withColumn("v", F.col("id") * 2)
    b = spark.range(3)
    with pytest.raises(S.BrokenSeal):
        S.check_seal(spark, root)

    def save():
        S.open_seal(spark, root)
        a.write.mode("overwrite").parquet(f"{root}/a")
        b.write.mode("overwrite").parquet(f"{root}/b")
        with pytest.raises(S.BrokenSeal):
            S.check_seal(spark, root)
        S.close_seal(spark, root, ["a", "b"])
        S.check_seal(spark, root)

    save()
    # One row altered.
    a.withColumn("v", F.when(F.col("id") == 7, 0).otherwise(F.col("v"))).write.mode("overwrite").parquet(f"{root}/a")
    with pytest.raises(S.BrokenSeal, match="in a$"):
        S.check_seal(spark, root)
    save()
    # One more file.
    b.write.mode("append").parquet(f"{root}/b")
    with pytest.raises(S.BrokenSeal, match="in b$"):
        S.check_seal(spark, root)
    save()
    # The seal itself.
    name = next(f for f in os.listdir(f"{root}/{S.SEAL}") if f.startswith("part-"))
    spark.createDataFrame([("{",)], "value string").write.mode("overwrite").text(f"{root}/{S.SEAL}")
    assert not os.path.exists(f"{root}/{S.SEAL}/{name}")
    with pytest.raises(S.BrokenSeal):
        S.check_seal(spark, root)
