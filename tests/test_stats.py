import numpy as np
import pytest

from skyloom.operators import stats


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(2)
    return {
        "normal": rng.normal(0, 50, 3001).tolist(),
        "whole": rng.integers(0, 70_000, 2000).astype(float).tolist(),
        "tiny": (rng.random(500) * 1e-9).tolist(),
        "one": [42.5],
        "same": [7.0] * 100,
        "mixed": [-1e300, -3.0, -0.0, 0.0, 5e-324, 2.0, 1e300],
    }


@pytest.fixture(scope="module")
def df(spark, values):
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("normal", None), ("empty", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(6)


PS = [0, 12.5, 50, 75, 99, 99.9, 99.99, 100]


def test_exact_percentiles(df, values):
    got = {(r.g, r.percentile): r.value for r in stats.exact_percentiles(df, "g", "v", PS).collect()}
    for g, vs in values.items():
        for p in PS:
            expected = float(np.percentile(vs, p)) if g != "mixed" else None
            if expected is not None:
                assert got[(g, p)] == pytest.approx(expected, rel=1e-9, abs=1e-12), (g, p)
    assert got[("mixed", 50.0)] == 0.0 and got[("mixed", 100.0)] == 1e300 and got[("mixed", 0.0)] == -1e300
    assert not any(g == "empty" for g, _ in got)


def test_summary_and_sketch(df, values):
    exact = {r.g: r for r in stats.percentile_summary(df, "g", "v").collect()}
    rough = {r.g: r for r in stats.percentile_summary(df, "g", "v", exact=False).collect()}
    for g, vs in values.items():
        assert exact[g].n == len(vs) and exact[g].max == max(vs) == rough[g].max
    assert exact["normal"].p50 == pytest.approx(np.percentile(values["normal"], 50))
    assert exact["empty"].n == 0 and exact["empty"].p50 is None
    assert rough["whole"].p99 == pytest.approx(exact["whole"].p99, rel=0.01)


def test_curve_is_clamped(df):
    rows = stats.percentile_curve(df, "g", "v").collect()
    assert {r.value for r in rows if r.g == "tiny"} == {1.0}
    tails = {r.percentile: (r.tail, r.log_tail) for r in rows if r.g == "whole"}
    assert tails[90.0] == pytest.approx((10, 1)) and tails[99.9] == pytest.approx((1000, 3))


def test_histogram_buckets(spark):
    vs = [-5, 0, 1, 2047, 2048, 2049, 4095, 4096, 4099, 60_000, 10**12, None]
    df = spark.createDataFrame([("a", v) for v in vs], "g string, v long")
    rows = stats.log_histogram(df, "g", "v").collect()
    got = sorted((r.bucket_low, r.bucket_high, r.n) for r in rows)
    assert got[:6] == [(0, 0, 2), (1, 1, 1), (2047, 2047, 1), (2048, 2049, 2), (4094, 4095, 1), (4096, 4099, 2)]
    assert got[6] == (60_000 - 60_000 % 32, 60_000 - 60_000 % 32 + 31, 1)
    assert got[7][0] <= 10**12 <= got[7][1] and got[7][1] - got[7][0] + 1 <= 10**12 / 1000


def test_merge_is_the_histogram_of_all(df):
    whole = df.where("g = 'whole'")
    parts = [whole.where(f"pmod(hash(v), 3) = {i}") for i in range(3)]
    hs = [stats.log_histogram(p, "g", "v") for p in parts]
    def rows(h):
        return sorted(map(tuple, h.collect()))
    left = stats.merge_histograms("g", stats.merge_histograms("g", hs[0], hs[1]), hs[2])
    right = stats.merge_histograms("g", hs[0], stats.merge_histograms("g", hs[1], hs[2]))
    assert rows(left) == rows(right) == rows(stats.log_histogram(whole, "g", "v"))


def test_histogram_percentiles_are_close(df, values):
    h = stats.log_histogram(df.where("g = 'whole'"), "g", "v")
    for r in stats.histogram_percentiles(h, "g").collect():
        nearest = np.percentile(values["whole"], r.percentile, method="inverted_cdf")
        assert nearest <= r.value <= nearest * 1.001 + 1


def test_sample_probes(spark):
    rows = [(t, float(x), 1.0) for t in (1, 2, 3) for x in range(7)] + [(None, 50.0, 1.0), (4, None, 1.0)]
    df = spark.createDataFrame(rows, "t int, lon double, lat double")
    df = df.selectExpr("timestamp_seconds(t)::timestamp_ntz AS measurement_time", "lon", "lat")
    for n in (2, 20):
        got = stats.sample_probes(df, n, seed=1).collect()
        assert sorted(r.probe_id for r in got) == list(range(n))
        assert len({r.lon for r in got}) == min(n, 8) and None not in {r.probe_time for r in got}
    again = stats.sample_probes(df.repartition(3), 20, seed=1).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    assert sorted(map(tuple, stats.sample_probes(df, 20, seed=2).collect())) != sorted(map(tuple, got))
    assert stats.sample_probes(df.where("false"), 5).collect() == []


def test_percentiles_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), ("a", 2)], "g string, v int")
    summary = {r.g: (r.n, r.p50, r.max) for r in stats.percentile_summary(df, "g", "v").collect()}
    assert summary == {None: (2, 3.0, 5), "a": (1, 2.0, 2)}
    assert {r.g for r in stats.percentile_curve(df, "g", "v").collect()} == {None, "a"}


def test_a_million_close_values_by_repeated_counting(spark):
    import numpy as np
    from pyspark.sql import functions as F

    n = 1_000_000
    values = 1000.0 + ((np.arange(n) * 7919) % 1_000_003) * 3e-7  # all within 0.03 %
    df = spark.range(n).select(
        F.lit("g").alias("g"), (F.lit(1000.0) + F.pmod(F.col("id") * 7919, F.lit(1_000_003)) * F.lit(3e-7)).alias("v")
    )
    ps = [0.0, 50.0, 99.0, 99.9, 100.0]
    got = {r.percentile: r.value for r in stats.exact_percentiles(df, "g", "v", ps, final_rows=500).collect()}
    for p in ps:
        assert got[p] == pytest.approx(float(np.percentile(values, p)), rel=1e-12, abs=1e-9)


def test_probe_numbering_has_no_single_partition(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(
        F.timestamp_seconds(F.col("id") % 1500).cast("timestamp_ntz").alias("measurement_time"),
        (F.col("id") % 1000 / 7.0).alias("lon"), F.lit(1.0).alias("lat"),
    )
    found = stats.sample_probes(df, 100_000, seed=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    rows = found.collect()
    assert sorted(r.probe_id for r in rows) == list(range(100_000))
    assert len({r.lon for r in rows}) == 1000 and len({r.probe_time for r in rows}) == 1500
