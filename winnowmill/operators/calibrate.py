"""Calibrating trust scores to human ratings."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInput, NotCalibrated
from ..plans.lineage import written
from .scoring import score_features_of

# Scores are read on this grid when fitting, so a fit never sees more than GRID + 1 distinct values
# per feature and a model stays small whatever the number of ratings.
GRID = 10_000


def normalize_ratings(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Ratings scaled to [0, 1] by their range; null stays null, and so does everything if all are equal."""
    numbers = F.when(~F.isnan(F.col(col).cast("double")), F.col(col).cast("double"))
    ends = df.agg(F.struct(F.min(numbers).alias("low"), F.max(numbers).alias("high"))).scalar()
    scaled = F.try_divide(numbers - ends["low"], ends["high"] - ends["low"])
    return df.withColumn(out_col or col, scaled)


def _rated(df: DataFrame, ratings: str, features: str, n_features: int) -> DataFrame:
    """Rows with a rating, as ``__rating`` scaled to [0, 1]; an error if ratings or features are not as needed."""
    known = df.where(F.col(ratings).isNotNull() & ~F.isnan(F.col(ratings).cast("double")))
    check = known.agg(
        F.min(ratings).alias("low"),
        F.max(ratings).alias("high"),
        F.max(F.size(features)).alias("widest"),
        F.min(F.size(features)).alias("narrowest"),
    ).first()
    if check["low"] is None or check["low"] == check["high"]:
        raise InvalidInput("calibration needs ratings that are not all the same")
    if not check["narrowest"] == check["widest"] == n_features:
        raise InvalidInput(f"calibration expects {n_features} features per row")
    return normalize_ratings(known, ratings, "__rating")


@dataclass
class Calibration:
    """Increasing map from a feature array to [0, 1]: the mean of one isotonic fit per feature.

    Scores are read on a grid of ``grid`` steps, when fitting and when transforming alike, which bounds
    the points of a fit.
    """

    n_features: int
    models: list[IsotonicRegressionModel] | None = None
    grid: int = GRID

    def fit(self, df: DataFrame, ratings: str, features: str = "features") -> "Calibration":
        """``features`` is an array of scores in [0, 1]. Rows without a rating or a score are left out."""
        scaled = _rated(df, ratings, features, self.n_features)
        self.models = []
        for i in range(self.n_features):
            score = F.round(F.col(features)[i] * self.grid) / self.grid
            points = (
                scaled.select(score.alias("x"), "__rating")
                .where(F.col("x").isNotNull())
                .groupBy("x")
                .agg(F.avg("__rating").alias("y"), F.count("*").cast("double").alias("w"))
            )
            fitter = IsotonicRegression(
                featuresCol="x", labelCol="y", weightCol="w", predictionCol="__y", isotonic=True
            )
            self.models.append(fitter.fit(points))
        return self

    def transform(self, df: DataFrame, features: str = "features", out_col: str = "calibrated_score") -> DataFrame:
        if self.models is None:
            raise NotCalibrated("fit the calibration before using it")
        out, names = df, []
        for i, model in enumerate(self.models):
            name, source = f"__y{i}", f"__x{i}"
            score = F.round(F.col(features)[i] * self.grid) / self.grid
            scored = out.withColumn(source, F.coalesce(score, F.lit(0.0)))
            out = model.copy({model.featuresCol: source, model.predictionCol: name}).transform(scored)
            names.append(name)
        complete = ~F.exists(F.col(features), lambda f: f.isNull())
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
        return out.select(*df.columns, F.when(complete, mean).alias(out_col))


@dataclass
class _Node:
    """A node of a tree: where it splits (``feature``, first bin on the right), or the value of its rows."""

    low: float = -math.inf
    high: float = math.inf
    value: float = 0.0
    feature: int | None = None
    bin: int = 0
    left: "_Node | None" = None
    right: "_Node | None" = None

    def leaves(self) -> list["_Node"]:
        return [self] if self.feature is None else [*self.left.leaves(), *self.right.leaves()]

    def column(self, bins: list[Column], of) -> Column:
        """``of(leaf)`` of the leaf that a row with these bins is in."""
        if self.feature is None:
            return of(self)
        return F.when(bins[self.feature] < self.bin, self.left.column(bins, of)).otherwise(self.right.column(bins, of))


def best_split(node: _Node, sums: dict[tuple[int, int], tuple[int, int]], features: int, bins: int, least: int):
    """The split of a node that lowers its squared error most: ``(gain, feature, bin, left, right)`` or None.

    ``sums`` has (sum, rows) by feature and bin. A split whose left value, clipped to the node's bounds, is
    above its right one would make the result fall where a feature grows, and is refused.
    """
    clip = lambda v: min(max(v, node.low), node.high)
    best = None
    for f in range(features):
        total, rows = (sum(sums.get((f, b), (0, 0))[k] for b in range(bins)) for k in (0, 1))
        left, n = 0, 0
        for b in range(1, bins):
            more, count = sums.get((f, b - 1), (0, 0))
            left, n = left + more, n + count
            right, m = total - left, rows - n
            if not count or n < least or m < least:
                continue
            low, high = clip(left / n / SCALE), clip(right / m / SCALE)
            gain = (left * left / n + right * right / m - total * total / rows) / SCALE**2
            if low <= high and gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, b, low, high)
    return best


# Sums over rows are sums of whole numbers of this part of one, the same in any order.
SCALE = 10**6


@dataclass
class JointCalibration:
    """Map from a feature array to [0, 1] that grows with every feature: boosted trees on binned scores.

    Each tree is fitted to what the trees before it leave, on the sums per (node, feature, bin) of one
    aggregate for each of its levels; the driver sees no more than these sums. A split that breaks
    monotonicity is refused, and the values of both sides are kept apart by their middle, so that every
    tree grows with every feature and so does their sum. Rows with equal bins are one row of the aggregates.
    """

    n_features: int
    bins: int = 64
    rounds: int = 12
    depth: int = 3
    rate: float = 0.3
    least: int = 20  # rows in a leaf
    base: float = 0.0
    trees: list[_Node] | None = field(default=None)

    def _bins(self, features: str) -> list[Column]:
        place = lambda i: F.floor(F.col(features)[i] * self.bins).cast("int")
        return [F.greatest(F.lit(0), F.least(place(i), F.lit(self.bins - 1))) for i in range(self.n_features)]

    def _predicted(self, bins: list[Column]) -> Column:
        value = lambda leaf: F.lit(leaf.value * self.rate)
        return sum((tree.column(bins, value) for tree in self.trees), F.lit(self.base))

    def fit(self, df: DataFrame, ratings: str, features: str = "features") -> "JointCalibration":
        """``features`` is an array of scores in [0, 1]. Rows without a rating, or that lack a score, are left out."""
        scaled = _rated(df, ratings, features, self.n_features)
        whole = scaled.where(~F.exists(features, lambda f: f.isNull() | F.isnan(f)))
        names = [f"b{i}" for i in range(self.n_features)]
        rating = F.round(F.col("__rating") * SCALE).cast("bigint")
        cells = whole.select(rating.alias("y"), *[b.alias(n) for b, n in zip(self._bins(features), names)])
        cells = written(cells.groupBy(*names).agg(F.sum("y").alias("y"), F.count("*").alias("n")), "calibration-cells")
        total = cells.agg(F.sum("y").alias("y"), F.sum("n").alias("n")).first()
        if not total["n"]:
            raise InvalidInput("calibration needs rows with all scores")
        self.base, self.trees = total["y"] / total["n"] / SCALE, []
        for _ in range(self.rounds):
            tree = self._tree(cells, names)
            if tree.feature is None:
                break
            self.trees.append(tree)
        return self

    def _tree(self, cells: DataFrame, names: list[str]) -> _Node:
        bins = [F.col(n) for n in names]
        rest = F.col("y") - F.round(F.col("n") * self._predicted(bins) * SCALE).cast("bigint")
        root = _Node()
        open_ = [root]
        for _ in range(self.depth):
            places = {id(leaf): i for i, leaf in enumerate(root.leaves())}
            found = cells.select(
                root.column(bins, lambda leaf: F.lit(places[id(leaf)])).alias("node"), rest.alias("rest"), "n",
                F.posexplode(F.array(*bins)).alias("feature", "bin"),
            ).groupBy("node", "feature", "bin").agg(F.sum("rest").alias("rest"), F.sum("n").alias("n")).collect()
            split = []
            for node in open_:
                own = {(r["feature"], r["bin"]): (r["rest"], r["n"]) for r in found if r["node"] == places[id(node)]}
                best = best_split(node, own, self.n_features, self.bins, self.least)
                if best:
                    _, node.feature, node.bin, low, high = best
                    middle = (low + high) / 2
                    node.left, node.right = _Node(node.low, middle, low), _Node(middle, node.high, high)
                    split += [node.left, node.right]
            open_ = split
            if not open_:
                break
        return root

    def transform(self, df: DataFrame, features: str = "features", out_col: str = "calibrated_score") -> DataFrame:
        """Rows with the calibrated score; null where a feature is."""
        if self.trees is None:
            raise NotCalibrated("fit the calibration before using it")
        complete = ~F.exists(F.col(features), lambda f: f.isNull() | F.isnan(f))
        score = F.greatest(F.lit(0.0), F.least(self._predicted(self._bins(features)), F.lit(1.0)))
        others = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != out_col]
        return df.select(*others, F.when(complete, score).alias(out_col))


def with_calibrated_score(df: DataFrame, result: str, calibration: Calibration | JointCalibration) -> DataFrame:
    """Scored rows whose result struct ``result`` has a ``calibrated_score`` as well.

    The features are the trust score and the custom criteria of the result; null for rows with an error.
    """
    failed = F.col(result)["log"]["error"].isNotNull()
    nothing = F.array_repeat(F.lit(None).cast("double"), calibration.n_features)
    good = df.withColumn("__failed", failed)
    features = score_features_of(F.col(result), calibration.n_features)
    rows = calibration.transform(
        good.withColumn("__features", F.when(F.col("__failed"), nothing).otherwise(features)), "__features", "__calibrated"
    )
    calibrated = F.col(result).withField("calibrated_score", F.col("__calibrated"))
    return rows.withColumn(result, calibrated).drop("__failed", "__features", "__calibrated")
