"""Node tables, cluster sums, ridge equations and back-tests against plain computations."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.config import ForecastConfig, ModelConfig
from tripmart.operators import clusters, features, forecast, forests, models
from tripmart.session import materialise

SHAPE = ForecastConfig()


# -- forests ----------------------------------------------------------------


@pytest.fixture(scope="module")
def nodes(spark):
    """Two trees by hand: one split, and a single leaf."""
    rows = [
        (0, 0, 5.0, [4.0, 4.0], 8, 1, 2, 0, [1.5], -1),
        (0, 1, 1.0, [3.0, 1.0], 4, -1, -1, -1, [], -1),
        (0, 2, 9.0, [0.0, 0.0], 4, -1, -1, -1, [], -1),
        (1, 0, 4.0, [1.0, 3.0], 4, -1, -1, -1, [], -1),
    ]
    return spark.createDataFrame(
        rows,
        "tree int, node int, value double, stats array<double>, rows bigint, left int, right int, feature int,"
        " cut array<double>, categories int",
    )


def test_rows_reach_the_leaf_their_values_lead_to(spark, nodes):
    rows = spark.createDataFrame([(1, 1.5), (2, 1.6), (3, -1.0)], "id int, a double")
    placed = forests.with_leaves(rows, nodes, F.array("a"), 3)
    out = placed.select(
        "id", forests.mean_of_leaves(F.col("leaves")).alias("mean"), forests.class_shares(F.col("leaves"), 2).alias("shares")
    )
    got = {r.id: (r.mean, r.shares) for r in out.collect()}
    assert got[1] == got[3] == (2.5, [0.5, 0.5])
    # A leaf without weight has no vote.
    assert got[2] == (6.5, [0.125, 0.375])
    assert placed.columns == ["id", "a", "leaves"]
    means = {(r.tree, r.node): (r.n, r.mean) for r in forests.leaf_means(placed, F.col("id")).collect()}
    assert means == {(0, 1): (2, 2.0), (0, 2): (1, 2.0), (1, 0): (3, 2.0)}


def test_categories_go_left_by_membership(spark, nodes):
    listed = nodes.withColumns({
        "categories": F.when((F.col("tree") == 0) & (F.col("node") == 0), 4).otherwise(-1),
        "cut": F.when((F.col("tree") == 0) & (F.col("node") == 0), F.array(F.lit(0.0), F.lit(3.0))).otherwise(F.col("cut")),
    })
    rows = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "a double")
    placed = forests.with_leaves(rows, listed, F.array("a"), 2)
    got = {r.a: r.n for r in placed.select("a", F.col("leaves")[0]["leaf"]["node"].alias("n")).collect()}
    assert got == {0.0: 1, 1.0: 2, 3.0: 1}


def test_no_rows_are_scored_to_no_rows(spark, nodes):
    rows = spark.createDataFrame([], "id int, a double")
    placed = forests.with_leaves(rows, nodes, F.array("a"), 2)
    assert placed.isEmpty() and forests.leaf_means(placed, F.col("id")).isEmpty()


# -- clusters ---------------------------------------------------------------


def brute_silhouette(x, group):
    far = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    out = []
    for i in range(len(x)):
        own = group == group[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = far[i, own].sum() / (own.sum() - 1)
        b = min(far[i, group == g].mean() for g in set(group) if g != group[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


def test_silhouettes_equal_those_of_all_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3)) + np.repeat(np.arange(3), 20)[:, None]
    x[1] = x[0]
    group = np.repeat(np.arange(3), 20)
    group[59] = 7
    rows = [(i, [float(v) for v in x[i]], int(group[i])) for i in range(60)]
    points = spark.createDataFrame(rows, "id int, x array<double>, cluster int")
    got = clusters.silhouettes(points, "x", "cluster", 3).orderBy("id").collect()
    assert [r.id for r in got] == list(range(60))
    assert np.allclose([r.silhouette for r in got], brute_silhouette(x, group), atol=1e-9)


def test_silhouettes_of_one_cluster_and_of_none(spark):
    points = spark.createDataFrame([([0.0],  1), ([2.0], 1)], "x array<double>, cluster int")
    assert [r.silhouette for r in clusters.silhouettes(points, "x", "cluster", 1).collect()] == [None, None]
    assert clusters.silhouettes(points.limit(0), "x", "cluster", 1).isEmpty()


def test_a_moved_centre_or_member_is_seen(spark):
    points = spark.createDataFrame([([0.0], 0), ([2.0], 0), ([10.0], 1)], "x array<double>, cluster int")

    def judged(rows, centres):
        return {r.cluster: (r.n, r.centred, r.nearest) for r in clusters.fixed_point(rows, "x", "cluster", centres).collect()}

    assert judged(points, [[1.0], [10.0]]) == {0: (2, True, True), 1: (1, True, True)}
    assert judged(points, [[1.1], [10.0]])[0] == (2, False, True)
    wrong = points.withColumn("cluster", F.when(F.col("x")[0] == 2.0, 1).otherwise(F.col("cluster")))
    assert judged(wrong, [[0.0], [6.0]])[1] == (2, True, False)


# -- forecast ---------------------------------------------------------------


@pytest.fixture(scope="module")
def noisy(spark):
    """Three years of a weekly signal with noise; zone 2 starts late, and one zone is null."""
    rng = np.random.default_rng(11)
    rows = []
    for zone, start in ((1, 0), (2, 1060), (None, 0)):
        for n in range(start, 1096):
            y = 200 + 60 * np.sin(2 * np.pi * n / 7) + 40 * np.sin(2 * np.pi * n / 365.25) + rng.normal(0, 12)
            rows.append((zone, dt.date(2021, 1, 1) + dt.timedelta(days=n), int(max(y, 0))))
    return materialise(spark.createDataFrame(rows, "zone int, ds date, y bigint"), "noisy")


def test_fits_solve_their_equations_and_others_do_not(noisy):
    history = forecast.history_of(noisy)
    fitted = materialise(forecast.fit_many(noisy, ["zone"], history, SHAPE), "fitted")
    good = {r.zone: r for r in forecast.certificate(noisy, fitted, ["zone"], history, SHAPE).collect()}
    assert set(good) == {1, 2, None} and {r.days for r in good.values()} == {1096}
    assert all(r.gap < 1e-6 and abs(r.sigma - r.sigma_rows) < 1e-6 * (1 + r.size) for r in good.values())
    for change in (lambda b: b * 0, lambda b: b * 1.01):
        bad = fitted.withColumn("beta", F.transform("beta", change))
        assert all(r.gap > 1e-6 for r in forecast.certificate(noisy, bad, ["zone"], history, SHAPE).collect())


def test_a_fit_at_an_origin_sees_no_later_day(noisy):
    history = forecast.history_of(noisy)
    origin = dt.date(2023, 6, 30)
    both = forecast.fit_at(noisy, ["zone"], history.first, [origin, dt.date(2023, 9, 30)], SHAPE)
    early = {r.zone: r for r in both.where(F.col("origin") == origin).collect()}
    past = noisy.where(F.col("ds") <= origin)
    alone = forecast.fit_many(past, ["zone"], forecast.History(history.first, origin), SHAPE)
    want = {r.zone: r for r in alone.collect()}
    assert set(early) == set(want) == {1, None}
    for zone, row in want.items():
        assert np.allclose(early[zone].beta, row.beta, rtol=1e-6, atol=1e-6)
        assert abs(early[zone].sigma - row.sigma) < 1e-6


def test_back_test_equals_one_by_hand(noisy):
    history = forecast.history_of(noisy)
    origins = forecast.cut_offs(history, 14, 2)
    assert origins == [dt.date(2023, 12, 4), dt.date(2023, 12, 18)]
    tested = materialise(forecast.back_test(noisy, ["zone"], history.first, origins, 14, SHAPE), "tested")
    y = {(r.zone, r.ds): r.y for r in noisy.collect()}
    rows = tested.collect()
    assert len(rows) == 2 * 14 * 3 and len({(r.zone, r.origin, r.day) for r in rows}) == len(rows)
    for r in rows:
        assert r.y == y.get((r.zone, r.day), 0)
        back = [r.origin - dt.timedelta(days=i) for i in range(28)]
        assert r.recent == sum(y.get((r.zone, b), 0) for b in back if b.weekday() == r.day.weekday())
    # Values: those of a fit on the past alone, carried on.
    first = forecast.History(history.first, origins[0])
    alone = forecast.fit_many(noisy.where(F.col("ds") <= origins[0]), ["zone"], first, SHAPE)
    carried = forecast.forecast_many(alone, ["zone"], first, 14, SHAPE).where(F.col("ds") > origins[0])
    want = {(r.zone, r.ds): (r.yhat, r.yhat_lower, r.yhat_upper) for r in carried.collect()}
    got = {(r.zone, r.day): (r.yhat, r.yhat_lower, r.yhat_upper) for r in rows if r.origin == origins[0]}
    assert got == want
    scores = {r.zone: r for r in forecast.back_test_scores(tested, ["zone"]).collect()}
    mine = [r for r in rows if r.zone == 1]
    assert scores[1].days == 28
    assert abs(scores[1].mae - np.mean([abs(r.y - r.yhat) for r in mine])) <= 0.005 + 1e-9
    assert abs(scores[1].mae_naive - np.mean([abs(r.y - r.recent / 4) for r in mine])) <= 0.005 + 1e-9


def test_band_covers_and_forecast_beats_the_baseline(noisy):
    """Noise is normal and the signal is in the model, so about 95 percent of the days lie inside."""
    history = forecast.history_of(noisy)
    origins = forecast.cut_offs(history, 30, 6)
    tested = forecast.back_test(noisy.where("zone = 1"), ["zone"], history.first, origins, 30, SHAPE)
    row = forecast.back_test_scores(tested, ["zone"]).first()
    assert row.days == 180 and 85 <= row.inside_pct <= 100
    assert row.mae < row.mae_naive


def test_all_rows_in_every_tree_without_bootstrap(silver_table):
    cfg = ModelConfig(trees=2, subsample=1.0, bootstrap=False)
    rows = features.fare_features(silver_table)
    model = models.fit_fares(rows, cfg)
    table = forests.node_table(rows.sparkSession, model.stages[-1])
    assert {r.rows for r in table.where("node = 0").collect()} == {rows.count()}
