"""Jointly monotone calibration against plain Python over single rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from winnowmill.errors import InvalidInput, NotCalibrated
from winnowmill.operators import calibrate


def interacting(rows=4000, seed=3):
    """Ratings that grow with the product of two scores, which no mean of single fits can follow."""
    random_ = random.Random(seed)
    points = [(random_.random(), random_.random()) for _ in range(rows)]
    return [(i, [x, y], 2 + 5 * x * y + random_.gauss(0, 0.2)) for i, (x, y) in enumerate(points)]


def grown(rows, features, bins, rounds, depth, rate, least):
    """Boosted trees on rows (bins, rating in [0, 1]): a function of bins."""
    base = sum(y for _, y in rows) / len(rows)
    trees = []

    def value(tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] < tree[1] else tree[3]
        return tree

    def grow(part, low, high, own, level):
        best = None
        for f in range(features) if level < depth else ():
            for b in range(1, bins):
                if not any(x[f] == b - 1 for x, _ in part):
                    continue
                left, right = [r for x, r in part if x[f] < b], [r for x, r in part if x[f] >= b]
                if min(len(left), len(right)) < least:
                    continue
                one, two = (min(max(sum(s) / len(s), low), high) for s in (left, right))
                gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(left + right) ** 2 / len(part)
                if one <= two and gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, f, b, one, two)
        if best is None:
            return own
        _, f, b, one, two = best
        middle = (one + two) / 2
        return (f, b, grow([r for r in part if r[0][f] < b], low, middle, one, level + 1),
                grow([r for r in part if r[0][f] >= b], middle, high, two, level + 1))

    for _ in range(rounds):
        rest = [(x, y - base - sum(rate * value(t, x) for t in trees)) for x, y in rows]
        tree = grow(rest, -math.inf, math.inf, 0.0, 0)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
    return lambda x: min(max(base + sum(rate * value(t, x) for t in trees), 0.0), 1.0)


def test_equals_plain_python(spark):
    rows = interacting(300)
    df = spark.createDataFrame(rows, "i int, features array<double>, rating double").repartition(4)
    model = calibrate.JointCalibration(2, bins=8, rounds=4, depth=2, least=10).fit(df, "rating")
    low, high = min(r[2] for r in rows), max(r[2] for r in rows)
    bins = lambda f: tuple(min(int(v * 8), 7) for v in f)
    want = grown([(bins(f), (y - low) / (high - low)) for _, f, y in rows], 2, 8, 4, 2, 0.3, 10)
    got = {r["i"]: r["calibrated_score"] for r in model.transform(df).collect()}
    assert all(got[i] == pytest.approx(want(bins(f)), abs=1e-5) for i, f, _ in rows)


def test_monotone_and_closer_than_the_mean_of_single_fits(spark):
    rows = interacting()
    df = spark.createDataFrame(rows, "i int, features array<double>, rating double")
    joint, single = calibrate.JointCalibration(2).fit(df, "rating"), calibrate.Calibration(2).fit(df, "rating")
    scaled = calibrate.normalize_ratings(df, "rating", "y")
    error = lambda model: model.transform(scaled).agg(F.avg(F.pow(F.col("calibrated_score") - F.col("y"), 2))).first()[0]
    assert error(joint) < 0.25 * error(single)
    steps = [i / 20 for i in range(21)]
    grid = spark.createDataFrame([([x, y],) for x in steps for y in steps], "features array<double>")
    score = {tuple(r["features"]): r["calibrated_score"] for r in joint.transform(grid).collect()}
    for x in steps:
        for a, b in zip(steps, steps[1:]):
            assert score[x, a] <= score[x, b] and score[a, x] <= score[b, x]
    assert all(0 <= s <= 1 for s in score.values()) and score[1.0, 1.0] > score[0.0, 1.0] + 0.4


def test_nulls_extra_columns_and_errors(spark):
    rows = [(i, [i / 50, None if i == 7 else 0.5], float(i), 1) for i in range(50)] + [(99, [0.5, 0.5], None, 2)]
    df = spark.createDataFrame(rows, "i int, features array<double>, rating double, `a.b` int")
    model = calibrate.JointCalibration(2, least=5).fit(df, "rating")
    got = {r["i"]: r for r in model.transform(df).collect()}
    assert got[7]["calibrated_score"] is None and got[99]["calibrated_score"] is not None and got[99]["a.b"] == 2
    assert model.transform(model.transform(df)).columns == ["i", "features", "rating", "a.b", "calibrated_score"]
    with pytest.raises(NotCalibrated):
        calibrate.JointCalibration(2).transform(df)
    with pytest.raises(InvalidInput):
        calibrate.JointCalibration(3).fit(df, "rating")
    with pytest.raises(InvalidInput):
        calibrate.JointCalibration(2).fit(df.where("false"), "rating")
    with pytest.raises(InvalidInput):
        calibrate.JointCalibration(1).fit(df.where("i = 7").union(df.where("i = 8")).withColumn("features", F.array(F.lit(None).cast("double"))), "rating")
