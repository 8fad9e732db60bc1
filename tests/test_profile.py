from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from packetloom.operators import profile as profiles
from packetloom.operators.profile import profile


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(3)
    columns = {
        "wide": rng.lognormal(0, 3, 5000),
        "hot": np.where(rng.random(5000) < 0.4, 7.0, rng.random(5000) * 20),
        "few": rng.integers(0, 3, 5000).astype(float),
    }
    rows = list(zip(*(c.tolist() for c in columns.values())))
    df = spark.createDataFrame(rows, "wide double, hot double, few double")
    # A coarse sketch makes the brackets do the work.
    for accuracy in (50, 1000, 100000):
        got = {r.column: r for r in profile(df, accuracy=accuracy).collect()}
        for name, values in columns.items():
            want = np.percentile(values, [25, 50, 75])
            np.testing.assert_allclose([got[name].p25, got[name].p50, got[name].p75], want, rtol=1e-12)
            np.testing.assert_allclose(got[name]["std"], values.std(ddof=1), rtol=1e-9)


def test_missing_values_and_types(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "x", None), (3, 2.0, None, None)], "`a b` int, b double, c string, d long"
    )
    got = [tuple(r) for r in profile(df).orderBy("position").collect()]
    assert got[0][1:] == ("a b", "int", 2, 2.0, 2**0.5, 1.0, 1.5, 2.0, 2.5, 3.0)
    assert got[1][1:] == ("b", "double", 1, 2.0, None, 2.0, 2.0, 2.0, 2.0, 2.0)
    assert got[2][1:4] == ("c", "string", 0)
    assert got[3][1:4] == ("d", "bigint", 0) and set(got[3][4:]) == {None}


def test_sketch_alone(spark):
    (row,) = profile(spark.range(1001), exact=False).collect()
    assert (row.p25, row.p50, row.p75) == (250.0, 500.0, 750.0)


def test_no_numeric_column(spark):
    assert profile(spark.createDataFrame([("x",)], "c string")).first()["count"] == 0


def at_ranks(values):
    values, out = sorted(values), {}
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        rank = (len(values) - 1) * share
        out[name] = values[int(rank)], values[-int(-rank // 1)]
    return out


def test_neighbours_by_rank_in_their_own_type(spark, monkeypatch):
    """Few parts and no listing make the passes do the work; a poor sketch is noticed."""
    rng = np.random.default_rng(5)
    n, big = 4000, 2**53
    columns = {
        "large": [big + int(k) for k in rng.integers(0, 50, n)],
        "wide": [int(k) for k in rng.integers(-(2**63), 2**63 - 1, n)],
        "two": [0] * (n // 2) + [1] * (n // 2),
        "dense": [0.5 + k * 1e-15 for k in range(n - 5)] + [1e300, -1e300, 7.0, 8.0, 9.0],
        "money": [Decimal(int(k)) / 100 for k in rng.integers(0, 10**9, n)],
        "small": [int(k) for k in rng.integers(-3, 3, n)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), "large bigint, wide bigint, two int, dense double, money decimal(20,2), small smallint")
    for parts, few, accuracy in ((200, 10_000, 10_000), (200, 0, 10_000), (8, 3, 40)):
        monkeypatch.setattr(profiles, "PARTS", parts)
        monkeypatch.setattr(profiles, "FEW", few)
        got = profiles.ranked(df, list(columns), profiles.QUARTILES, accuracy)
        for name, values in columns.items():
            for point, want in at_ranks(values).items():
                assert got[name, point][:2] == want, (name, point, parts)


def test_many_columns_in_few_passes(spark):
    df = spark.range(5000).select(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10**6)).alias(f"c{k}") for k in range(60)])
    got = {r.column: r for r in profile(df).collect()}
    for k in (0, 31, 59):
        values = [r[0] for r in df.select(f"c{k}").collect()]
        np.testing.assert_allclose([got[f"c{k}"].p25, got[f"c{k}"].p50, got[f"c{k}"].p75], np.percentile(values, [25, 50, 75]), rtol=1e-12)
