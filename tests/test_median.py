"""The counted median against sorting, and its independence of how lines are split."""

import random

from pyspark.sql import functions as F

from tripmart.functions.measures import lower_median

SCHEMA = "service string, borough string, price decimal(18,2), n bigint"


def test_equals_the_sorted_middle(spark):
    draw = random.Random(8)
    prices = {}
    rows = []
    for service in ("a", "b"):
        for borough in ("x", None):
            for _ in range(draw.randrange(1, 400)):
                price = draw.choice([draw.uniform(0.01, 3), draw.uniform(0.01, 5000)])
                price, n = round(price, 2), draw.randrange(1, 6)
                prices.setdefault((service, borough), []).extend([price] * n)
                rows.append((service, borough, f"{price:.2f}", n))
    text = spark.createDataFrame(rows, SCHEMA.replace("decimal(18,2)", "string"))
    frame = text.withColumn("price", F.col("price").cast("decimal(18,2)"))
    want = {k: sorted(v)[(len(v) + 1) // 2 - 1] for k, v in prices.items()}
    for parts in (1, 7):
        got = lower_median(frame.repartition(parts), ("service", "borough"), "price", "n").collect()
        assert {(r["service"], r["borough"]): r["median"] for r in got} == want


def test_a_hundred_thousand_prices(spark):
    lines = spark.range(1, 100_002).select(
        F.lit("a").alias("service"), F.lit("x").alias("borough"), (F.col("id") / 100).alias("price"), F.lit(1).cast("bigint").alias("n")
    )
    runs = {lower_median(lines.repartition(p), ("service", "borough"), "price", "n").first()["median"] for p in (3, 5, 8)}
    assert runs == {500.01}
