"""Operators against brute force on small fixtures."""

import itertools
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.operators import bootstrap, pairs, quality, quantiles, sets, shares, trend
from tallywright.operators.names import canonicalize, display_names
from tallywright.session import shared_folder


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    rows = [("big", float(rng.randint(0, 3000))) for _ in range(6000)]
    rows += [("same", 5.0)] * 500 + [("skew", 10.0 ** rng.uniform(-3, 9)) for _ in range(900)]
    rows += [("two", 1.0), ("two", 4.0), (None, 2.5), ("two", None)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(7)


@pytest.mark.parametrize("accuracy", [10_000, 1000])
def test_group_quantiles_are_exact(values, monkeypatch, accuracy):
    rows, df = values
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    probs = (0.01, 0.25, 0.5, 0.75, 1.0)
    names = [f"q{i}" for i in range(5)]
    got = quantiles.group_stats(df, ["g"], "v", probs, names, extra=[F.avg("v").alias("mean")]).collect()
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    assert {r["g"] for r in got} == set(want)
    for r in got:
        assert r["n"] == len(want[r["g"]])
        assert np.allclose([r[x] for x in names], np.quantile(want[r["g"]], probs), rtol=1e-12)
        assert r["mean"] == pytest.approx(np.mean(want[r["g"]]))
    every = [v for _, v in rows if v is not None]
    total = quantiles.group_stats(df, [], "v", probs, names).collect()[0]
    assert np.allclose([total[x] for x in names], np.quantile(every, probs), rtol=1e-12)


def test_quantiles_of_every_small_size(spark):
    rows = [(n, float(v * v)) for n in range(1, 60) for v in range(n)]
    probs, names = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0), list("abcdef")
    got = quantiles.group_stats(spark.createDataFrame(rows, "g int, v double"), ["g"], "v", probs, names).collect()
    for r in got:
        assert np.allclose([r[x] for x in names], np.quantile([v * v for v in range(r["g"])], probs), rtol=1e-12)


def test_bands_are_thin_and_ranked_in_cells(spark):
    """2 million rows a group: a bootstrap band holds some sqrt(n), and no window sorts data rows in one partition."""
    df = spark.range(4_000_000).selectExpr("id % 2 AS g", "cast(xxhash64(id) as double) AS v")
    bands = quantiles.ranked_bands(df, ["g"], "v", [0.5], spread=6.0)
    inside = [r["n"] for r in bands.where("_v is not null").groupBy("g").agg(F.sum(F.col("_stop") - F.col("_start")).alias("n")).collect()]
    assert len(inside) == 2 and all(n < 25 * 2_000_000**0.5 for n in inside)
    plan = quantiles.ranked_bands(df, [], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 2 and sum(bool(re.search(r"\[_gap#\d+, _cell#\d+\], \[_v#", x)) for x in windows) == 1
    assert sum("sum(_in_cell" in x for x in windows) == 1  # over sums of cells, which are few


def test_bounds_are_sketched_once(spark):
    """Rows in another order at every evaluation, as after a shuffle between machines: the sketch differs each time."""
    def stirred(batches):
        for batch in batches:
            yield batch.sample(frac=1.0)

    df = spark.range(0, 240_000, 1, 6).selectExpr("id % 2 AS g", "cast((id * 7919) % 240007 AS double) AS v").mapInPandas(stirred, "g long, v double")
    want = {g: np.quantile([i * 7919 % 240_007 for i in range(g, 240_000, 2)], [0.25, 0.5, 0.75]) for g in (0, 1)}
    found = quantiles.group_stats(df, ["g"], "v", (0.25, 0.5, 0.75), ("a", "b", "c"), extra=[F.avg("v").alias("mean")])
    assert "percentile_approx" not in found._jdf.queryExecution().toString()
    for r in found.collect():
        assert np.allclose([r["a"], r["b"], r["c"]], want[r["g"]], rtol=1e-12)


def test_quantiles_of_nothing_and_threshold(values):
    _, df = values
    assert quantiles.group_stats(df.where("false"), [], "v").collect() == [(0, None)]
    got = quantiles.group_stats(df, ["g"], "v", min_n=500).collect()
    assert {r["g"] for r in got} == {"big", "same", "skew"}


def brute_bootstrap(a, b, iterations, seed):
    rng = np.random.default_rng(seed)
    x = np.median(rng.choice(a, (iterations, len(a))), axis=1)
    y = np.median(rng.choice(b, (iterations, len(b))), axis=1)
    return x - y


@pytest.mark.parametrize("sizes", [(18, 92), (17, 30)])
def test_bootstrap_has_the_distribution_of_full_resamples(spark, sizes):
    rng = np.random.default_rng(3)
    a, b = (np.round(rng.lognormal(0, 0.6, n) * 1e6, 2) for n in sizes)
    df = spark.createDataFrame([(True, float(v)) for v in a] + [(False, float(v)) for v in b], "f boolean, v double")
    got = bootstrap.bootstrap_diff(df, "f", "v", iterations=20_000).collect()[0]
    assert got["observed_difference"] == pytest.approx(np.median(a) - np.median(b))
    want = brute_bootstrap(a, b, 20_000, 1)
    lo, hi = np.percentile(want, [2.5, 97.5])
    width = hi - lo
    assert abs(got["ci_low"] - lo) < 0.05 * width and abs(got["ci_high"] - hi) < 0.05 * width
    assert got["includes_zero"] == (got["ci_low"] <= 0 <= got["ci_high"])
    again = bootstrap.bootstrap_diff(df.repartition(5), "f", "v", iterations=20_000).collect()[0]
    assert again == got


def test_bootstrap_draws_match_in_the_whole(spark):
    a, b = np.arange(1.0, 12.0), np.arange(3.0, 9.0)
    df = spark.createDataFrame([(True, float(v)) for v in a] + [(False, float(v)) for v in b], "f boolean, v double")
    diffs, _ = bootstrap.bootstrap_differences(df, "f", "v", iterations=30_000)
    got = np.sort([r[1] for r in diffs.collect()])
    want = np.sort(brute_bootstrap(a, b, 30_000, 5))
    grid = np.unique(np.concatenate([got, want]))
    gap = np.abs(np.searchsorted(got, grid, "right") - np.searchsorted(want, grid, "right")) / 30_000
    assert len(got) == 30_000 and gap.max() < 0.02  # two-sample distance


def test_pairs(spark):
    rng = random.Random(1)
    links = {(rng.randint(0, 60), rng.choice("abcdefg")) for _ in range(220)}
    df = spark.createDataFrame(sorted(links), "job_id int, skill string")
    tags = {}
    for job, tag in links:
        tags.setdefault(job, set()).add(tag)
    want = Counter(p for t in tags.values() for p in itertools.combinations(sorted(t), 2))
    got = {(r[0], r[1]): r[2] for r in pairs.pair_counts(df).collect()}
    assert got == dict(want)
    both = {(r[0], r[1]): r[2] for r in pairs.pair_counts(df, ordered=True).collect()}
    assert both == {**want, **{(b, a): n for (a, b), n in want.items()}}


def test_canonical_names(spark):
    names = ["acme", "acme", "acme", "ACME", "Acme Inc", "ACME, Inc.", "Café", "Cafe", "Cafe", "日本", "中国", "中国", "", None,
             "beta", "beta.", "Tie", "TIE"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r["n"] for r in canonicalize(df, "n").orderBy("i").collect()]
    assert got == ["ACME"] * 4 + ["ACME, Inc."] * 2 + ["Cafe"] * 3 + ["中国"] * 3 + ["Unknown Company"] * 2 + [
        "beta", "beta", "TIE", "TIE"]
    again = spark.createDataFrame([(n,) for n in got], "n string")
    assert display_names(again, "n").count() == 0


def test_shares_ranks_and_top_k(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "k string, n bigint")
    assert {r["k"]: r["p"] for r in shares.share(df, "n", "p").collect()} == {"a": 41.67, "b": 25.0, "c": 25.0, "d": 8.33}
    for bounded in (True, False):
        got = shares.demand_rank(df, "n", bounded=bounded).collect()
        assert {r["k"]: r["demand_rank"] for r in got} == {"a": 1, "b": 2, "c": 2, "d": 3}
    assert {r["k"] for r in shares.top_k(df, "n", 2, ties=True).collect()} == {"a", "b", "c"}
    assert [r["k"] for r in shares.top_k(df, "n", 2, ties=False, tie_break=["k"]).collect()] == ["a", "b"]
    full = shares.reindex(df, "k", ["d", "x", "a"], ["n"]).orderBy("label_order").collect()
    assert [(r["k"], r["n"]) for r in full] == [("d", 1), ("x", 0), ("a", 5)]
    run = shares.cumulative(shares.share(df, "n", "p", digits=None), "p", [F.desc("n"), F.asc("k")], "c").orderBy("c").collect()
    assert run[-1]["c"] == pytest.approx(100.0)
    empty = shares.share(df.where("false"), "n", "p")
    assert empty.count() == 0


def test_histogram(spark):
    v = [0.0, 1.0, 2.0, 2.5, 9.9, 10.0]
    got = shares.histogram(spark.createDataFrame([(x,) for x in v], "v double"), "v", 5).orderBy("bin").collect()
    counts, edges = np.histogram(v, bins=5)
    assert [r["row_count"] for r in got] == counts.tolist()
    assert np.allclose([r["bin_low"] for r in got], edges[:-1])
    flat = shares.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 2).orderBy("bin").collect()
    assert [r["row_count"] for r in flat] == np.histogram([3.0, 3.0], bins=2)[0].tolist()


def test_sets(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (4,)], "k int")
    assert sorted(r[0] for r in sets.difference(a, b, "k").collect()) == [1, 3]
    assert [r[0] for r in sets.intersection(a, b, "k").collect()] == [2]
    assert not sets.is_subset(b, a, "k") and sets.is_subset(a.where("k = 2"), b, "k")
    with pytest.raises(ValueError, match="missing required columns: x"):
        sets.require_columns(a, ["k", "x"])


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5, True), (1, -1, False), (2, None, True)], "id int, v int, f boolean")
    got = {r["rule"]: (r["failed_rows"], r["passed"]) for r in quality.union_reports(
        quality.expect(df, {"negative": F.col("v") < 0, "odd name": F.col("v") > 99}),
        quality.expect_unique(df, ["id"], "repeated"),
        quality.expect_foreign_key(df, df.where("id = 1"), "id", "orphans"),
        quality.expect_count(df, 5, "count"),
        quality.expect_recomputed(df, "f", F.col("v") > 0, "flag"),
    ).collect()}
    assert got == {"negative": (1, False), "odd name": (0, True), "repeated": (1, False), "orphans": (1, False),
                   "count": (2, False), "flag": (1, False)}


def test_trend_operators(spark):
    weeks = ["2026-01-05", "2026-01-12", "2026-01-19"]
    jobs = spark.createDataFrame(
        [(i, w, True) for i, w in enumerate([weeks[0]] * 4 + [weeks[1]] * 2 + [weeks[2]] * 4)], "job_id int, w string, is_complete_week boolean"
    ).withColumn("week_start", F.to_date("w"))
    bridge = spark.createDataFrame([(0, "SQL"), (6, "SQL"), (7, "SQL"), (1, "Other")], "job_id int, skill string")
    dense = trend.dense_weekly_share(jobs, bridge, ["SQL", "Excel"]).orderBy("week_start").collect()
    assert [r["skill_share_pct"] for r in dense] == [25.0, 0.0, 50.0] and [r["week_index"] for r in dense] == [0, 1, 2]
    rolled = trend.rolling_mean(trend.dense_weekly_share(jobs, bridge, ["SQL"]), "skill_share_pct", "skill", "week_start", "m")
    assert [r["m"] for r in rolled.orderBy("week_start").collect()] == [25.0, 12.5, 25.0]
    sparse = trend.rolling_mean(trend.weekly_tag_share(jobs, bridge), "skill_share_pct", "skill", "week_start", "m")
    assert [r["m"] for r in sparse.where("skill = 'SQL'").orderBy("week_start").collect()] == [25.0, 37.5]
    slope = trend.trend_slope(trend.dense_weekly_share(jobs, bridge, ["SQL"]), "skill", "skill_share_pct").collect()[0]
    assert slope["percentage_point_change_per_week"] == pytest.approx(12.5) and slope["trend_direction"] == "Upward"
    single = trend.trend_slope(trend.dense_weekly_share(jobs.where("w = '2026-01-05'"), bridge, ["SQL"]), "skill", "skill_share_pct")
    assert single.collect()[0]["trend_direction"] == "Not Available"
    assert trend.dense_weekly_share(jobs, bridge, None).count() == 6
    change = trend.change_vs_prior(trend.weekly_counts(jobs), "weekly_jobs", "week_start").orderBy("week_start").collect()
    assert [(r["absolute_change"], r["week_over_week_pct"]) for r in change] == [(None, None), (-2, -50.0), (2, 100.0)]


def test_a_cluster_needs_a_shared_folder():
    """Only a session in one process may use a folder of its own; executors of ``local-cluster`` are others."""
    class Conf:
        def get(self, name, default=None):
            return default

    def session(master):
        return SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(master=master))

    for master in ("local", "local[8]", "local[*, 4]"):
        assert shared_folder(session(master))
    for master in ("local-cluster[3,2,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(session(master))
