"""Demand models on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .clean import drop_incomplete

FEATURES = (
    "current_price", "cost_price", "inventory_ratio", "price_to_cost_ratio",
    "inventory_urgency_score", "sensitivity_encoded",
)
TARGET = "units_sold"
DOMINANT_SHARE = 0.55
#: Bins of a feature, as many as the trees look at; names of the columns that hold a bin and a weight.
BINS, BIN, WEIGHT = 32, "_bin_", "_weight"
#: Fewer cells than this are cut into up to PIECES points each.
POINTS, PIECES = 100_000, 32


def training_rows(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Only the columns a model needs, complete rows only."""
    return drop_incomplete(df, [*features, TARGET]).select(
        *features, F.col(TARGET).cast("double").alias(TARGET)
    )


def training_rows_with(df: DataFrame, labels: Sequence[str], features: Sequence[str] = FEATURES) -> DataFrame:
    """Training rows with columns that tell where they belong."""
    return drop_incomplete(df, [*features, TARGET]).select(*labels, *features, F.col(TARGET).cast("double").alias(TARGET))


def thresholds(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Where the bins of each feature end, from all rows: between its values if there are no more than the bins, else at its quantiles.

    What reaches the driver is a few dozen numbers a feature."""
    shares = [i / bins for i in range(1, bins)]

    def quantiles(f: str) -> Column:
        return F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f)

    seen = rows.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    # the estimate is off by a few per cent; sets of at most some dozen values are gathered, quantiles of the other features alone
    few = [f for f in features if seen[f] <= 2 * bins]
    found = rows.agg(*[F.collect_set(F.col(f).cast("double")).alias(f) if f in few else quantiles(f) for f in features]).first().asDict()
    crowded = [f for f in few if len(found[f]) > bins]
    if crowded:
        found |= rows.agg(*map(quantiles, crowded)).first().asDict()
    out = []
    for f in features:
        values = sorted(set(found[f] or ()))
        cuts = values if f not in few or f in crowded else [(a + b) / 2 for a, b in zip(values, values[1:])]
        out.append([-math.inf, *(cuts or [0.0]), math.inf])
    return out


def binning(rows: DataFrame, features: Sequence[str]) -> list[Transformer]:
    """The stages that put the bins of the features into one vector."""
    names = [BIN + f for f in features]
    return [
        Bucketizer(splitsArray=thresholds(rows, features), inputCols=list(features), outputCols=names),
        VectorAssembler(inputCols=names, outputCol="features"),
    ]


def cells(rows: DataFrame, labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Number, sum and squares of the target of all rows that no tree can tell apart.

    A tree sees the bins of a row alone, and chooses its splits by these figures on either side; rows with the same ``keys`` always go
    together.  There are no more cells than rows and, however many rows, no more than combinations of bins."""
    y = F.col(TARGET)
    return rows.groupBy(*labels, *keys).agg(F.count(y).cast("double").alias("_n"), F.sum(y).alias("_s"), F.sum(y * y).alias("_ss"))


def weighted_points(found: DataFrame, pieces: Column) -> DataFrame:
    """Each cell as ``pieces`` (1 or an even number) equal points, no more than it has rows, with the number and the mean of its
    rows and, from two points on, their variance: half of them lie a deviation above the mean, half below."""
    n, mean = F.col("_n"), F.col("_s") / F.col("_n")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("_ss") / n - mean * mean))
    some = F.least(pieces.cast("int"), n.cast("int") - n.cast("int") % 2)
    count = F.when((n == 1) | (pieces == 1), F.lit(1)).otherwise(some)
    values = F.transform(F.sequence(F.lit(1), count), lambda i: F.struct(
        F.when(count == 1, mean).when(i % 2 == 0, mean + spread).otherwise(mean - spread).alias(TARGET), (n / count).alias(WEIGHT)))
    return found.select(*[c for c in found.columns if c not in ("_n", "_s", "_ss")], F.inline(values))


def _fitted(trees: Estimator, rows: DataFrame, stages: Sequence[Transformer], labels: Sequence[str], features: Sequence[str]) -> PipelineModel:
    """The learner fitted to the weighted points of the rows, behind the stages that give it the bins.

    Trees draw points, so few cells are cut into more points each; points that judge a model have the variance of their rows."""
    keys = [BIN + f for f in features]
    ensure_checkpoint_dir(rows.sparkSession)  # also of boosting, which cuts its lineage every 10 trees
    # the order of the points decides which are drawn, so it is fixed
    found = cells(stages[0].transform(rows), labels, keys).sortWithinPartitions(*labels, *keys).checkpoint()
    share = POINTS // max(1, found.count())
    drawn = F.lit(min(PIECES, share - share % 2) if share > 1 else 1)
    pieces = F.when(F.col(labels[0]), F.lit(2)).otherwise(drawn) if labels else drawn
    return PipelineModel([*stages, trees.fit(stages[1].transform(weighted_points(found, pieces)))])


def train_demand(
    train: DataFrame, valid: DataFrame, features: Sequence[str] = FEATURES,
    max_trees: int = 500, depth: int = 6, rate: float = 0.05, tolerance: float = 0.001,
) -> PipelineModel:
    """Gradient-boosted trees that stop when the newer rows stop getting better.

    All rows are read three times at most, whatever the number of trees: for the ends of the bins, and for the points."""
    older = training_rows(train, features)
    both = older.withColumn("_valid", F.lit(False)).unionByName(training_rows(valid, features).withColumn("_valid", F.lit(True)))
    trees = GBTRegressor(
        featuresCol="features", labelCol=TARGET, weightCol=WEIGHT, maxIter=max_trees, maxDepth=depth, maxBins=BINS, stepSize=rate,
        subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42,
        validationIndicatorCol="_valid", validationTol=tolerance, checkpointInterval=10,
    )
    return _fitted(trees, both, binning(older, features), ("_valid",), features)


def train_forest(
    train: DataFrame, features: Sequence[str] = FEATURES, trees: int = 500, depth: int = 6
) -> PipelineModel:
    """Random forest on the same rows and features, for comparison.

    A tree's draw is a number per point; per row it would take four bytes a row and tree."""
    rows = training_rows(train, features)
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=TARGET, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, maxBins=BINS, seed=42
    )
    return _fitted(forest, rows, binning(rows, features), (), features)


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """Share of each feature, largest first, with a mark on one that dominates."""
    shares = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(share)) for name, share in zip(features, shares)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.withColumn("dominant", F.col("importance") > DOMINANT_SHARE).orderBy(
        F.col("importance").desc(), "feature"
    )


def _scored(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Every row asked of every tree: for tables of one row per product."""
    return model.transform(df).drop("features", *model.stages[0].getOutputCols())


def cell_keys(names: Sequence[str]) -> list[Column]:
    """The bins of ``names`` in as few whole numbers as hold them, ten to one; null if one of its bins is."""
    wide = [names[at:at + 10] for at in range(0, len(names), 10)]
    return [reduce(lambda a, b: a * F.lit(2 * BINS) + b, [F.col(n).cast("long") for n in part]) for part in wide]


def predict(df: DataFrame, model: PipelineModel, alias: str = "prediction") -> DataFrame:
    """The rows with what the model says of them.

    Trees look at the bins of a row alone, so they are asked once for every cell of bins that has rows, however many, and the rows take the
    answer over.  A cell with very many rows can be split, as the join exchanges both sides and has one answer a cell."""
    bins = model.stages[0].getOutputCols()
    binned = model.stages[0].transform(df)
    keys = [f"_cell_{n}" for n in range(len(cell_keys(bins)))]
    # a row without a bin has no cell; it meets the one of that kind, which the model refuses as it would the row
    at = dict(zip(keys, [F.coalesce(key, F.lit(-1)) for key in cell_keys(bins)]))
    found = binned.select(*bins).distinct()
    answers = PipelineModel(model.stages[1:]).transform(found).select(*[key.alias(k) for k, key in at.items()], F.col("prediction").alias(alias))
    return binned.withColumns(at).join(answers, keys, "left").select(*df.columns, alias)


def predict_baseline(
    lookup: DataFrame, model: PipelineModel, features: Sequence[str] = FEATURES
) -> DataFrame:
    """``baseline_demand`` of every product at its base price, never below zero.

    The price features are set to the base price for scoring and dropped again; missing
    features count as 0.  One ``transform`` over the lookup, whatever its size.
    """
    base = F.coalesce("base_price", "current_price")
    scoring = {f: F.coalesce(F.col(f), F.lit(0.0)) if f in lookup.columns else F.lit(0.0) for f in features}
    scoring["current_price"] = base
    if "cost_price" in lookup.columns and "price_to_cost_ratio" in features:
        at_base = F.when(F.col("cost_price") > 0, base / F.col("cost_price"))
        scoring["price_to_cost_ratio"] = F.coalesce(at_base, scoring["price_to_cost_ratio"])
    renamed = [F.col(c) if c not in scoring else F.col(c).alias(f"_own_{c}") for c in lookup.columns]
    at_base = lookup.select(*renamed, *[v.alias(k) for k, v in scoring.items()])
    scored = _scored(at_base, model)
    restored = [F.col(f"_own_{c}").alias(c) if c in scoring else F.col(c) for c in lookup.columns]
    return scored.select(*restored, F.greatest(F.lit(0.0), F.col("prediction")).alias("baseline_demand"))
