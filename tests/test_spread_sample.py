"""Evenly spaced samples against a sorted list, on more keys than one partition holds."""

from pyspark.sql import functions as F

from strataloom.operators.corpus import spread_sample


def test_equal_to_sorted_list_each_time(spark):
    rows = spark.range(1_200_000).select(((F.col("id") * 7919) % 1_200_007).alias("key")).repartition(13)
    ordered = sorted((k * 7919) % 1_200_007 for k in range(1_200_000))
    for n in (20, 7, 1):
        places = [round(k * (len(ordered) - 1) / (n - 1)) for k in range(n)] if n > 1 else [0]
        for _ in range(2):
            assert sorted(r["key"] for r in spread_sample(rows, "key", n).collect()) == [ordered[k] for k in places]
