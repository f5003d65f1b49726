"""Quantiles by counting against sorted values."""

import random

import numpy as np
from pyspark.sql import functions as F

from quillon.operators.quantiles import quantiles

SHARES = {"least": 0.0, "third": 1 / 3, "half": 0.5, "most": 1.0}


def test_groups_of_all_kinds(spark):
    rng = random.Random(1)
    rows = [("hot", None if rng.random() < 0.1 else rng.randint(0, 40), rng.random()) for _ in range(900)]
    rows += [(g, rng.randint(-5, 5), rng.gauss(0, 9)) for g in ("a", "b", None) for _ in range(rng.randint(1, 30))] + [("nulls", None, None)] * 3 + [("one", 7, 7.5)]
    df = spark.createDataFrame(rows, "g string, n int, x double").repartition(5)
    for value, at in (("n", 1), ("x", 2)):
        held = {g: [r[at] for r in rows if r[0] == g and r[at] is not None] for g in {r[0] for r in rows}}
        for size in (20, 250_000):
            got = {r["g"]: [r[c] for c in SHARES] for r in quantiles(df, ["g"], value, SHARES, rows=size).collect()}
            assert set(got) == set(held)
            for g, own in held.items():
                assert got[g] == [None] * 4 if not own else np.allclose(got[g], [np.quantile(own, p) for p in SHARES.values()])
    whole = [r[1] for r in rows if r[1] is not None]
    assert np.allclose(list(quantiles(df, [], "n", SHARES).first()), [np.quantile(whole, p) for p in SHARES.values()])
    assert list(quantiles(df.limit(0), [], "n", SHARES).first()) == [None] * 4 and quantiles(df.limit(0), ["g"], "n", SHARES).count() == 0


def test_no_buffer_of_values(spark):
    """A group with all rows: the plan counts, and holds no list of values."""
    df = spark.range(400_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 300_007).alias("v"))
    got = quantiles(df, ["g"], "v", {"half": 0.5, "p90": 0.9}, rows=50_000)
    v = np.arange(400_000) * 7919 % 300_007
    assert np.allclose([got.first()["half"], got.first()["p90"]], [np.quantile(v, 0.5), np.quantile(v, 0.9)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan and "median" not in plan
