"""Queries for pipelines, params, model search and model persistence
(SURVEY §2.1 snk_model/snk_pipeline/src_model, §2.16)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from spindle.operators import features, learners, reports, split, tune
from spindle.plans import setups
from spindle.plans.registry import query
from spindle.plans.setups import OLS_SQL
from spindle.plans.tables import fold_sql, split_sql, table
from spindle.session import scratch_path
from spindle.sources import models

_KEYS = ["l_orderkey", "l_linenumber"]

_PRED_SQL = "WITH " + OLS_SQL + """
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 2) AS prediction FROM lineitem, m
"""


def _stages():
    return [features.assembler(["l_quantity"], "features"), setups.exact_linreg()]


def _lineitem_xy(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     F.col("l_extendedprice").alias("label"))


def _rounded(pred):
    return pred.select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("prediction"))


@query("ml_pipeline", _PRED_SQL)
def ml_pipeline(spark, sf):
    df = _lineitem_xy(spark, sf)
    model = tune.fit_pipeline(_stages(), df)
    return _rounded(model.transform(df))


@query("snk_model", _PRED_SQL)
def snk_model(spark, sf):
    df = _lineitem_xy(spark, sf)
    path = models.save_stage(tune.fit_pipeline(_stages(), df), scratch_path(spark, "fitted_pipeline"))
    return _rounded(models.load_pipeline_model(path).transform(df))


@query("snk_pipeline", _PRED_SQL)
def snk_pipeline(spark, sf):
    df = _lineitem_xy(spark, sf)
    path = models.save_stage(tune.pipeline(_stages()), scratch_path(spark, "unfitted_pipeline"))
    return _rounded(learners.fit(models.load_pipeline(path), df).transform(df))


@query("src_model", _PRED_SQL)
def src_model(spark, sf):
    df = _lineitem_xy(spark, sf)
    path = scratch_path(spark, "served_model")
    tune.fit_pipeline(_stages(), df).write().overwrite().save(path)
    served = PipelineModel.load(path)
    if len(served.stages) != 2:
        raise RuntimeError("loaded pipeline lost stages")
    return _rounded(served.transform(df))


# --- params -------------------------------------------------------------------

def _binary(spark, sf):
    li = table(spark, sf, "lineitem")
    df = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                   (F.col("l_quantity") + 200 * F.col("l_discount") > 30).cast("double").alias("label"))
    return features.assemble(df, ["l_quantity", "l_discount"], "features")


_SET_PARAMS = """
SELECT * FROM (VALUES ('aggregationDepth', '2'), ('elasticNetParam', '0.0'), ('family', 'auto'),
 ('featuresCol', 'features'), ('fitIntercept', 'True'), ('labelCol', 'label'), ('maxIter', '{it}'),
 ('probabilityCol', '{prob}'), ('regParam', '{reg}'), ('threshold', '{thr}'), ('tol', '1e-06'))
AS t(param, value), (SELECT count(*) AS n_rows FROM lineitem)
"""


@query("ml_params_set", _SET_PARAMS.format(it=10, prob="probability", reg=0.01, thr=0.5))
def ml_params_set(spark, sf):
    lr = learners.logistic_regression()
    lr.setMaxIter(10).setRegParam(0.01)
    model = learners.fit(lr, _binary(spark, sf))
    seen = model.summary.predictions.count()
    return reports.params(spark, model, "model1").filter(F.col("is_set")).select("param", "value", F.lit(seen).alias("n_rows"))


@query("ml_params_override", _SET_PARAMS.format(it=30, prob="myProbability", reg=0.1, thr=0.55))
def ml_params_override(spark, sf):
    """A param map given to fit overrides the setters, and within the
    merged maps the later value wins; reported as the fitted model's set
    params (the scored rows use the renamed probability column)."""
    lr = learners.logistic_regression(max_iter=10, reg=0.01)
    pm = tune.merge_params({lr.maxIter: 20}, {lr.maxIter: 30},
                           {lr.regParam: 0.1, lr.threshold: 0.55},
                           {lr.probabilityCol: "myProbability"})
    data = _binary(spark, sf)
    model = learners.fit(lr, data, pm)
    scored = model.transform(data)
    if "myProbability" not in scored.columns:
        raise RuntimeError("probabilityCol override did not reach the model")
    return reports.params(spark, model, "model2").filter(F.col("is_set")).select("param", "value", F.lit(scored.count()).alias("n_rows"))


# --- grid and search ------------------------------------------------------------

_GRID_SQL = f"""
WITH tr AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE {split_sql(_KEYS)}),
te AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE NOT {split_sql(_KEYS)}),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, sum(x * y) / sum(x * x) AS b0 FROM tr),
r AS (SELECT sqrt(avg((y - (a + b * x)) ^ 2)) AS r1, sqrt(avg((y - b0 * x) ^ 2)) AS r0 FROM te, m),
gr AS (SELECT * FROM (VALUES (true, true), (true, false), (false, true), (false, false))
       AS v(fit_intercept, standardization))
SELECT fit_intercept, standardization, round(CASE WHEN fit_intercept THEN r1 ELSE r0 END, 6) AS rmse
FROM gr, r
"""


@query("tune_grid", _GRID_SQL)
def tune_grid(spark, sf):
    data = setups.ols_lineitem(spark, sf)
    train, test = split.keyed_split(data, _KEYS)
    est = setups.exact_linreg()
    maps = tune.grid([(est.fitIntercept, None), (est.standardization, None)])
    ev = RegressionEvaluator(metricName="rmse")
    _, found, _ = tune.search_holdout(spark, train, test, est, maps, ev)
    return _by_setting(spark, found, maps, est)


def _by_setting(spark, found, maps, est):
    """(setting, metric) with the setting's two flags instead of its number."""
    flags = spark.createDataFrame([(i, bool(m[est.fitIntercept]), bool(m[est.standardization])) for i, m in enumerate(maps)],
                                  "setting int, fit_intercept boolean, standardization boolean")
    return found.join(F.broadcast(flags), "setting").select("fit_intercept", "standardization", F.round("metric", 6).alias("rmse"))


@query("tune_cv", f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, {fold_sql(_KEYS)} AS fold FROM lineitem),
f AS (SELECT CAST(k AS INTEGER) AS k FROM range(3) t(k)),
m AS (SELECT k, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, sum(x * y) / sum(x * x) AS b0
      FROM f JOIN d ON d.fold <> f.k GROUP BY k),
r AS (SELECT m.k, sqrt(avg((y - (a + b * x)) ^ 2)) AS r1, sqrt(avg((y - b0 * x) ^ 2)) AS r0
      FROM m JOIN d ON d.fold = m.k GROUP BY m.k),
per AS (SELECT true AS fit_intercept, k AS fold, r1 AS rmse FROM r
        UNION ALL SELECT false, k, r0 FROM r)
SELECT fit_intercept, fold, round(rmse, 6) AS rmse,
       round(avg(rmse) OVER (PARTITION BY fit_intercept), 6) AS avg_rmse FROM per
""")
def tune_cv(spark, sf):
    """3-fold search by key: (params, fold, metric) from the fold models,
    with the search's own average per setting."""
    data = setups.ols_lineitem(spark, sf).withColumn("fold", split.fold_column(_KEYS, 3))
    est = setups.exact_linreg()
    maps = tune.grid([(est.fitIntercept, None)])
    _, found, _ = tune.search_cv(spark, data, [], est, maps, RegressionEvaluator(metricName="rmse"), "fold", 3)
    flags = spark.createDataFrame([(i, bool(m[est.fitIntercept])) for i, m in enumerate(maps)], "setting int, fit_intercept boolean")
    mean = found.groupBy("setting").agg(F.avg("metric").alias("mean"))
    return (found.join(F.broadcast(flags), "setting").join(F.broadcast(mean), "setting")
            .select("fit_intercept", "fold", F.round("metric", 6).alias("rmse"), F.round("mean", 6).alias("avg_rmse")))


@query("tune_tv_split", _GRID_SQL.replace(split_sql(_KEYS), split_sql(_KEYS, 75)))
def tune_tv_split(spark, sf):
    """Train/validation search at the built-in's ratio (75 %), split by key."""
    train, valid = split.keyed_split(setups.ols_lineitem(spark, sf), _KEYS, 75)
    est = setups.exact_linreg()
    maps = tune.grid([(est.fitIntercept, None), (est.standardization, None)])
    _, found, _ = tune.search_holdout(spark, train, valid, est, maps, RegressionEvaluator(metricName="rmse"))
    return _by_setting(spark, found, maps, est)
