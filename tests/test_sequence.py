import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions.sequence import running_count


def test_running_count_matches_window(spark):
    rnd = random.Random(3)
    data = [("hot" if i % 3 else f"g{i % 7}", rnd.randint(0, 20), i, rnd.randint(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, k int, id int, f int")
    order = [F.col("k").desc(), F.col("id").asc()]
    got = running_count(df, ["g"], order, out="pos", num_partitions=9)
    w = Window.partitionBy("g").orderBy(*order)
    ref = df.withColumn("ref", F.row_number().over(w) - 1)
    j = got.join(ref.select("id", "ref"), "id")
    assert j.where(F.col("pos") != F.col("ref")).count() == 0
    flagged = running_count(df, ["g"], order, flag=F.col("f"), out="pos", num_partitions=5)
    ref2 = df.withColumn("ref", F.coalesce(F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j2 = flagged.join(ref2.select("id", "ref"), "id")
    assert j2.where(F.col("pos") != F.col("ref")).count() == 0


def test_running_count_without_groups(spark):
    df = spark.range(500).withColumn("k", (F.col("id") * 7919) % 500)
    got = running_count(df, [], [F.col("k").asc()], out="pos", num_partitions=6)
    assert all(r.pos == r.k for r in got.collect())


def test_running_count_keeps_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, k int")
    got = sorted((r.g, r.k, r.pos) for r in running_count(df, ["g"], [F.col("k").asc()], out="pos").collect()
                 if r.g is None)
    assert got == [(None, 1, 0), (None, 2, 1)]
