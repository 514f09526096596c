"""Queries for evaluation."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from spindle.operators import evaluate, learners, split
from spindle.plans import setups
from spindle.plans.registry import query
from spindle.plans.setups import LOGIT_TAX_SQL, RATES_SQL
from spindle.plans.tables import split_sql, table

_KEYS = ["l_orderkey", "l_linenumber"]

# predictions of the one-feature logistic model, threshold 0.5
_PRED_SQL = "WITH " + LOGIT_TAX_SQL + "," + RATES_SQL + """,
pr AS (SELECT label, CAST(p > 0.5 AS DOUBLE) AS prediction FROM d JOIN g USING (x))
"""


def _predictions(spark, sf):
    model, data = setups.fit_exact_logit(setups.logit_tax(spark, sf))
    return model.transform(data)


@query("eval_accuracy", _PRED_SQL + """
SELECT round(avg(CAST(prediction = label AS DOUBLE)), 10) AS accuracy FROM pr
""")
def eval_accuracy(spark, sf):
    acc = evaluate.accuracy(_predictions(spark, sf))
    return acc.select(F.round("accuracy", 10).alias("accuracy"))


@query("eval_test_error", "WITH " + LOGIT_TAX_SQL + f""",
g AS (SELECT x, avg(label) AS p FROM d WHERE {split_sql(_KEYS)} GROUP BY x),
pr AS (SELECT label, CAST(p > 0.5 AS DOUBLE) AS prediction FROM d JOIN g USING (x)
       WHERE NOT {split_sql(_KEYS)})
SELECT round(avg(CAST(prediction = label AS DOUBLE)), 10) AS accuracy,
       round(1 - avg(CAST(prediction = label AS DOUBLE)), 10) AS test_error FROM pr
""")
def eval_test_error(spark, sf):
    train, test = split.keyed_split(setups.logit_tax(spark, sf), _KEYS)
    model, _ = setups.fit_exact_logit(train)
    from spindle.operators import features
    scored = model.transform(features.assemble(test, ["x"], "features"))
    acc = evaluate.accuracy(scored)
    return acc.select(F.round("accuracy", 10).alias("accuracy"),
                      F.round("test_error", 10).alias("test_error"))


@query("eval_precision", _PRED_SQL + """,
cl AS (SELECT label AS cls FROM pr UNION SELECT prediction FROM pr),
m AS (SELECT cls, count(*) FILTER (WHERE label = cls AND prediction = cls) AS tp,
             count(*) FILTER (WHERE label <> cls AND prediction = cls) AS fp,
             count(*) FILTER (WHERE label = cls AND prediction <> cls) AS fn
      FROM cl, pr GROUP BY cls)
SELECT cls, tp, fp, fn,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 10) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 10) AS recall FROM m
""")
def eval_precision(spark, sf):
    c = evaluate.confusion(_predictions(spark, sf))
    return c.select("cls", "tp", "fp", "fn", F.round("precision", 10).alias("precision"),
                    F.round("recall", 10).alias("recall"))


_SCORES_SQL = """
WITH s AS (SELECT l_extendedprice AS score,
                  sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS neg
           FROM lineitem GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
                sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn,
                sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM s)
"""


def _scored_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_extendedprice").alias("score"),
                     (F.col("l_returnflag") == "R").cast("double").alias("label"))


@query("eval_auc", _SCORES_SQL + """
SELECT round(sum(neg * (2 * cp - pos)) / (2.0 * max(P) * max(N)), 10) AS auc FROM c
""")
def eval_auc(spark, sf):
    a = evaluate.auc(_scored_lineitem(spark, sf), "score", "label")
    return a.select(F.round("auc", 10).alias("auc"))


@query("eval_roc", _SCORES_SQL + """
SELECT score AS threshold, cn / N AS fpr, cp / P AS tpr FROM c
""")
def eval_roc(spark, sf):
    return evaluate.roc(_scored_lineitem(spark, sf), "score", "label")


@query("eval_rmse", f"""
WITH tr AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE {split_sql(_KEYS)}),
te AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE NOT {split_sql(_KEYS)}),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM tr)
SELECT round(sqrt(avg((y - (a + b * x)) ^ 2)), 6) AS rmse FROM te, m
""")
def eval_rmse(spark, sf):
    data = setups.ols_lineitem(spark, sf)
    train, test = split.keyed_split(data, _KEYS)
    model = learners.fit(setups.exact_linreg(), train)
    r = evaluate.rmse(model.transform(test), "label", "prediction")
    return r.select(F.round("rmse", 6).alias("rmse"))


@query("eval_wssse", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT label, i, avg(v[i]) AS m FROM e, range(1, 65) r(i) GROUP BY label, i),
c AS (SELECT label, list(m ORDER BY i) AS cv FROM d GROUP BY label),
dist AS (SELECT e.vec_id, min(list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) ^ 2))) AS d2
         FROM e, c GROUP BY e.vec_id)
SELECT round(sum(d2), 4) AS wssse FROM dist
""")
def eval_wssse(spark, sf):
    emb = table(spark, sf, "embeddings").select(
        "label", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    # given centres: per-label means (k x d numbers, bounded), then the cost
    cent = emb.groupBy("label").agg(Summarizer.mean(F.col("features")).alias("c")).collect()
    centers = [r["c"].toArray().tolist() for r in sorted(cent, key=lambda r: r["label"])]
    w = evaluate.wssse(emb, centers, "features")
    return w.select(F.round("wssse", 4).alias("wssse"))
