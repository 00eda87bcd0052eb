"""Error metrics on given predictions, and the models themselves (rows only)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from ..functions import retail
from ..operators import comparison, features, metrics, models
from ..sources import testdata as td
from ..sources.tables import written_once


def _test(spark, sf):
    train, test = x.train_and_test(spark, sf)
    return x.with_predictions(train, test)


def _naive(spark, sf):
    train, test = x.train_and_test(spark, sf)
    return metrics.naive_forecast(train, test).select("product_id", "date", "units_sold", "naive_pred")


def _by_product(spark, sf):
    return metrics.mape_by_product(_test(spark, sf), "units_sold", "prediction")


def _report(spark, sf):
    train, test = x.train_and_test(spark, sf)
    return metrics.model_report(x.with_predictions(train, test), x.with_predictions(train, train))


def model_rows(spark, sf):
    """Sales with the six model features; sales and elasticity lie by product, in parts of the same number."""
    sales = td.sales(spark, sf, by_product=True)
    category = x.lerner(spark, sf).select("product_id", "price_sensitivity_category").hint("merge")
    return sales.join(category, "product_id", "left").select(
        "product_id", "product_name", "date", "units_sold", "base_price", "current_price", "cost_price", "inventory_ratio",
        retail.price_to_cost("current_price", "cost_price").alias("price_to_cost_ratio"),
        retail.inventory_urgency("inventory_ratio").alias("inventory_urgency_score"),
        retail.sensitivity_encode("price_sensitivity_category").alias("sensitivity_encoded"),
    )


def _split(rows):
    return rows.filter(F.col("date") < x.SPLIT_DATE), rows.filter(F.col("date") >= x.SPLIT_DATE)


_FITTED: dict[tuple[str, str, str], PipelineModel] = {}


def _both(spark, sf, learners=("boosted", "forest"), rows=None):
    """Models with the pipeline's parameters; queries of one application that need the same one train it once.

    ``rows`` are written model rows; without them those that training needs are written here, once for all readings of all learners."""
    app = spark.sparkContext.applicationId
    missing = [learner for learner in learners if (app, sf, learner) not in _FITTED]
    if missing:
        train, test = _split(written_once(models.training_rows_with(model_rows(spark, sf), ("date",))) if rows is None else rows)
        for learner in missing:
            _FITTED[app, sf, learner] = models.train_demand(train, test) if learner == "boosted" else models.train_forest(train)
    return {learner: _FITTED[app, sf, learner] for learner in learners}


def _fitted(spark, sf, learner, rows=None):
    return _both(spark, sf, (learner,), rows)[learner]


def _facts(scored):
    """What SQL can check of a trained model: how many rows it scores, and that each score is a number and of the
    size of the target.  The errors themselves depend on the learner."""
    report = metrics.regression_metrics(scored, "units_sold", "prediction")
    range_ = scored.agg(
        F.count_if(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("scored_rows"),
        (F.max(F.abs("prediction")) <= 2 * F.max(F.abs("units_sold"))).alias("in_range"),
    )
    packed = range_.select(F.struct(*range_.columns).alias("s")).scalar()
    return report.withColumn("s", packed).select("n_rows", "s.scored_rows", "s.in_range", (F.col("rmse") >= F.col("mae")).alias("rmse_bounds_mae"))


def _compared(spark, sf):
    """Both learners from two origins, with fewer trees than the pipeline takes."""
    return comparison.compare_models(model_rows(spark, sf), folds=2, max_trees=60, forest_trees=60)


def _metrics(spark, sf):
    """Errors of both models on the newer rows, trained with the pipeline's parameters, beside the naive forecast's."""
    rows = written_once(model_rows(spark, sf))
    train, test = _split(rows)
    naive = metrics.naive_forecast(train, test)
    compared = [metrics.regression_metrics(naive, "units_sold", "naive_pred").withColumns({"learner": F.lit("naive"), "trees": F.lit(None).cast("int")})]
    for name, model in _both(spark, sf, rows=rows).items():
        errors = metrics.regression_metrics(models.predict(naive, model), "units_sold", "prediction")
        compared.append(errors.withColumns({"learner": F.lit(name), "trees": F.lit(comparison.iterations(model))}))
    return reduce(DataFrame.unionByName, compared)


def _importances(spark, sf):
    return comparison.compared_importances(spark, _both(spark, sf))


def _at_base(spark, sf):
    """The lookup scored at its base prices; model and lookup read the same written rows."""
    rows = written_once(model_rows(spark, sf).drop("product_name"))
    model = _fitted(spark, sf, "boosted", rows)
    return models.predict_baseline(features.product_lookup(rows.drop("date")), model)


def _baseline_values(spark, sf):
    return _at_base(spark, sf).select("product_id", "base_price", "baseline_demand")


def _scored(spark, sf, learner):
    rows = written_once(model_rows(spark, sf))
    return _facts(models.predict(_split(rows)[1], _fitted(spark, sf, learner, rows)))


def _importance(spark, sf):
    model = _fitted(spark, sf, "boosted")
    shares = models.feature_importance(spark, model)
    total = shares.agg(F.round(F.sum("importance"), 6)).scalar()
    return shares.select("feature", F.col("importance").between(0, 1).alias("is_share"), total.alias("total"))


def _baseline(spark, sf):
    return _at_base(spark, sf).select("product_id", "base_price", (F.col("baseline_demand") >= 0).alias("not_negative"))


_ERRORS = """count(*) as n_rows, avg(abs(units_sold - prediction)) as mae, sqrt(avg((units_sold - prediction) ** 2)) as rmse,
               avg(abs((units_sold - prediction) / (units_sold + 1)) * 100) as mape"""

CHECKS = [
    Check("naive_forecast", _naive, """
        select product_id, date, units_sold, naive_pred from predictions where date >= date '2000-06-01'""",
        doubles="naive_pred", dates="date"),
    Check("regression_metrics", lambda s, d: metrics.regression_metrics(_test(s, d), "units_sold", "prediction"), f"""
        select {_ERRORS} from predictions where date >= date '2000-06-01'""", doubles="mae rmse mape"),
    Check("mape_by_product", _by_product, "select * from product_errors", doubles="mape"),
    Check("mape_distribution", lambda s, d: metrics.describe_col(_by_product(s, d), "mape"), """
        select count(mape) as count, avg(mape) as mean, stddev_samp(mape) as std, min(mape) as min, quantile_cont(mape, 0.25) as p25,
               quantile_cont(mape, 0.5) as p50, quantile_cont(mape, 0.75) as p75, max(mape) as max, count(*) filter (where mape > 30) as n_above
        from product_errors""", doubles="mean std min p25 p50 p75 max"),
    Check("top_worst_mape", lambda s, d: metrics.worst_products(_by_product(s, d)), """
        select * from product_errors where mape > 30 order by mape desc, product_id limit 15""", doubles="mape"),
    Check("model_report", _report, """
        select t.test_mape, r.train_mape, t.naive_mape, case when t.test_mape - r.train_mape > 5 then 1 else 0 end as overfit,
               case when t.test_mape < t.naive_mape then 1 else 0 end as beats_naive, t.naive_mape - t.test_mape as beats_naive_by,
               q.p25, q.p50, q.p75, q.mx as max, q.n_above_30
        from (select avg(abs((units_sold - prediction) / (units_sold + 1)) * 100) as test_mape,
                     avg(abs((units_sold - naive_pred) / (units_sold + 1)) * 100) as naive_mape
              from predictions where date >= date '2000-06-01') t,
             (select avg(abs((units_sold - prediction) / (units_sold + 1)) * 100) as train_mape from predictions where date < date '2000-06-01') r,
             (select quantile_cont(mape, 0.25) as p25, quantile_cont(mape, 0.5) as p50, quantile_cont(mape, 0.75) as p75,
                     max(mape) as mx, count(*) filter (where mape > 30) as n_above_30 from product_errors) q""",
        doubles="test_mape train_mape naive_mape beats_naive_by p25 p50 p75 max"),
    *[Check(key, plan, f"""
        select count(*) as n_rows, count(*) as scored_rows, 1 as in_range, 1 as rmse_bounds_mae
        from sales where date >= date '{x.SPLIT_DATE}'""") for key, plan in (("train_demand", lambda s, d: _scored(s, d, "boosted")), ("train_forest", lambda s, d: _scored(s, d, "forest")))],
    Check("feature_importance", _importance, f"""
        select feature, 1 as is_share, cast(1 as double) as total
        from (values {", ".join(f"('{name}')" for name in models.FEATURES)}) as f(feature)""", doubles="total"),
    Check("predict_baseline", _baseline, """
        select product_id, base_price, 1 as not_negative from sales_lookup""", doubles="base_price"),
    # figures that no SQL states: the tests hold them against a known signal
    Check("model_errors", _metrics), Check("model_importances", _importances), Check("baseline_demand", _baseline_values),
    Check("model_comparison", _compared),
]
