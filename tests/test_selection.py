"""Ranks found by histograms against sorted lists."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lendsight.operators.selection import BUCKETS, select_rank

rng = random.Random(11)
KEYS = {
    "double": ([rng.random() for _ in range(3000)] + [0.5] * 500 + [5e-324, -1.7e308, 1.7e308, 0.0, 1e-300], "double"),
    "rounded": ([round(rng.random(), 4) for _ in range(4000)], "double"),
    "long": ([rng.randrange(-(2**63), 2**63) for _ in range(2000)] + [2**63 - 1, -(2**63), 7, 7, 7, 8], "bigint"),
    "close longs": ([10**15 + rng.randrange(100_000) for _ in range(3000)], "bigint"),
    "text": ([f"EVT{rng.getrandbits(64):016x}" for _ in range(2000)] + ["", "E", "EVT", "é", "日本", "EVT", "E\x00"], "string"),
    "equal texts": (["C7"] * 400, "string"),
    "date": ([datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randrange(900)) for _ in range(500)], "date"),
    "one": ([3.25], "double"),
}


@pytest.mark.parametrize("name", KEYS)
@pytest.mark.parametrize("descending", [False, True])
def test_ranks(spark, name, descending):
    keys, kind = KEYS[name]
    df = spark.createDataFrame([(k, i % 7) for i, k in enumerate(keys)] + [(None, 1)] * 3, f"k {kind}, v int").repartition(5)
    ordered = sorted(((k, i % 7) for i, k in enumerate(keys)), key=lambda x: x[0].encode() if kind == "string" else x[0], reverse=descending)
    for rank in sorted({len(keys) // 2 + 1, rng.choice([1, len(keys)])}):
        got = select_rank(df, "k", rank, descending, {"v": F.col("v").cast("double")})
        value = ordered[rank - 1][0]
        before = [v for k, v in ordered[:rank] if k != value]
        assert (got.value, got.before, got.rest) == (value, len(before), rank - len(before))
        assert got.sums == {"v": float(sum(before))}
    assert select_rank(df, "k", 0) is None and select_rank(df, "k", len(keys) + 1) is None


def test_many_keys_and_one_key_take_few_reads(spark):
    df = spark.range(1_000_000).select(F.pmod(F.col("id") * 7919, F.lit(1_000_003)).alias("k"), F.lit(0.5).alias("same"))
    got = select_rank(df.withColumn("k", F.col("k") / 1_000_003), "k", 400_000, descending=True)
    expected = sorted(((i * 7919) % 1_000_003 for i in range(1_000_000)), reverse=True)[399_999] / 1_000_003
    assert (got.value, got.before, got.rest) == (expected, 399_999, 1)
    same = select_rank(df, "same", 999_999)
    assert (same.value, same.before, same.rest) == (0.5, 0, 999_999)
    assert BUCKETS**2 > 1_000_003
