"""Rolling origins and both learners on a known signal."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelift.operators import comparison, models


@pytest.fixture(scope="module")
def rows(spark):
    """Units that fall with the price of the day; every product has the same mean."""
    df = spark.range(4000).select(
        (F.col("id") % 20).alias("product_id"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 20).cast("int")).alias("date"),
        (F.rand(1) * 10).alias("current_price"), F.lit(2.0).alias("cost_price"), F.rand(3).alias("inventory_ratio"), F.lit(2.0).alias("price_to_cost_ratio"),
        F.rand(4).alias("inventory_urgency_score"), (F.col("id") % 3 + 1).cast("int").alias("sensitivity_encoded"))
    return spark.createDataFrame(df.withColumn("units_sold", F.round(F.lit(60.0) - F.col("current_price") * 4).cast("long")).toPandas()).persist()


def test_cuts_come_from_counts_per_date(spark, rows):
    ordered = sorted(r.date for r in rows.select("date").collect())
    for share in (0.0, 0.3, 0.55, 0.99):
        (cut,) = comparison.cut_dates(rows, [share])
        assert sum(d < cut for d in ordered) >= share * len(ordered) and (share == 0.0 or sum(d < cut - dt.timedelta(days=1) for d in ordered) < share * len(ordered))
    assert comparison.cut_dates(rows.limit(0), [0.5]) == []
    folds = comparison.origins(rows, 3)
    assert len(folds) == 3 and all(a[1] == b[0] for a, b in zip(folds, folds[1:], strict=False)) and folds[-1][1] is None


def test_both_learners_beat_the_naive_forecast_at_every_origin(spark, rows):
    got = comparison.compare_models(rows, folds=2, max_trees=30, forest_trees=20).collect()
    assert {(r.fold, r.learner) for r in got} == {(f, m) for f in (0, 1) for m in ("boosted", "forest")}
    assert all(r.beats_naive and r.mape < r.naive_mape / 1.5 and 0 < r.trees <= 30 for r in got)
    (a, b) = comparison.origins(rows, 2)
    assert {r.fold: r.n_rows for r in got} == {0: rows.filter((F.col("date") >= a[0]) & (F.col("date") < a[1])).count(), 1: rows.filter(F.col("date") >= b[0]).count()}
    shares = comparison.compared_importances(spark, {"forest": models.train_forest(rows, trees=5)}).collect()
    assert max(shares, key=lambda r: r.importance).feature == "current_price" and {r.learner for r in shares} == {"forest"}
    assert comparison.compare_models(rows.limit(0), 2).count() == 0


def test_trees_read_points_and_not_rows(spark, rows):
    """Points keep number, sum and squares of the rows; their number follows the bins, and copies of the table add none."""
    stages = models.binning(rows, models.FEATURES)
    keys = [models.BIN + f for f in models.FEATURES]

    def sums(df, weight):
        w, y = F.col(weight), F.col(models.TARGET)
        return df.agg(F.sum(w), F.sum(w * y), F.sum(w * y * y)).first()

    binned = stages[0].transform(models.training_rows(rows)).withColumn("one", F.lit(1.0))
    many = binned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50))))
    count = binned.select(keys).distinct().count()
    for df in (binned, many):
        for pieces in (1, 2, 8):
            points = models.weighted_points(models.cells(df, (), keys), F.lit(pieces))
            got, want = list(sums(points, models.WEIGHT)), list(sums(df, "one"))
            assert got[:2] == pytest.approx(want[:2]) and points.count() <= pieces * count and (pieces == 1 or got[2] == pytest.approx(want[2]))
    assert binned.select(keys).distinct().groupBy().agg(*[F.max(k) for k in keys]).first()[0] <= models.BINS - 1
    # a rare value has a bin of its own, a single value is one bin
    rare = spark.range(5000).select((F.col("id") < 3).cast("int").alias("a"), F.lit(2.0).alias("b"))
    assert models.thresholds(rare, ("a", "b")) == [[-float("inf"), 0.5, float("inf")], [-float("inf"), 0.0, float("inf")]]


def test_forest_on_points_keeps_no_draw_per_row(spark, rows):
    """Fifty copies of every row: the same trees' splits, and no more points cached than of one copy."""
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50))))
    one, fifty = (models.train_forest(r, trees=5) for r in (rows, many))
    assert [s.getOutputCols() for s in (one.stages[0], fifty.stages[0])] == [[models.BIN + f for f in models.FEATURES]] * 2
    error = [models.predict(rows, m).agg(F.avg(F.abs(F.col("units_sold") - F.col("prediction")))).first()[0] for m in (one, fifty)]
    mean = rows.select(F.abs(F.col("units_sold") - F.avg("units_sold").over(Window.partitionBy())).alias("e")).agg(F.avg("e")).first()[0]
    assert max(error) < mean / 2 and "_bin_current_price" not in models.predict(rows, one).columns


class Asked(Transformer):
    """Says which bin of the price a row is in, and counts the rows it is asked for."""

    def __init__(self, counter):
        super().__init__()
        self.counter = counter

    def _transform(self, df):
        counter = self.counter

        @F.udf("double")
        def say(price):
            counter.add(1)
            return price

        return df.withColumn("prediction", say(models.BIN + "current_price"))


def test_a_model_is_asked_once_for_every_cell(spark, rows):
    """It was asked for every row, 500 trees each."""
    stages = models.binning(rows, models.FEATURES)
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    cells = stages[0].transform(rows).select([models.BIN + f for f in models.FEATURES]).distinct().count()
    asked = spark.sparkContext.accumulator(0)
    got = models.predict(many, PipelineModel([*stages, Asked(asked)]), "said")
    assert got.columns == [*many.columns, "said"] and got.agg(F.sum("said")).first()[0] == 20 * stages[0].transform(rows).agg(F.sum("_bin_current_price")).first()[0]
    assert 0 < asked.value <= cells
    model = models.train_forest(rows, trees=5)
    key = ["product_id", "date"]
    want = {tuple(r[c] for c in key): r.prediction for r in model.transform(rows).collect()}
    assert {tuple(r[c] for c in key): r.prediction for r in models.predict(rows, model).collect()} == want and len(want) == rows.count()


def test_cells_of_many_features_have_their_own_keys(spark):
    names = [f"f{n}" for n in range(12)]
    df = spark.createDataFrame([tuple(float(i == n) for i in range(12)) for n in range(12)] + [tuple([31.0] * 12), tuple([31.0] * 11 + [30.0])], names)
    keys = models.cell_keys(names)
    assert len(keys) == 2 and df.select(*keys).distinct().count() == 14
