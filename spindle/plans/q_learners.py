"""Queries for learners and model reports."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spindle.operators import features, learners, reports, rules
from spindle.plans import setups
from spindle.plans.registry import query
from spindle.plans.setups import (BOOSTED_SQL, LOGIT_DISCOUNT_SQL, LOGIT_TAX_SQL, OLS_SQL, RATES_SQL,
                                  STUMP_CLASS_SQL, STUMP_REG_SQL)
from spindle.plans.tables import table

# --- logistic regression -----------------------------------------------------

_LOGIT_COEF_OUT = """
SELECT '(intercept)' AS term, 0 AS cls, round(b0, 4) AS value FROM c
UNION ALL SELECT 'x', 0, round(b1, 4) FROM c
"""


def _coef_rounded(spark, model, names, digits=4):
    t = reports.coefficients(spark, model, names)
    return t.select("term", F.col("class").alias("cls"), F.round("value", digits).alias("value"))


@query("clf_logreg", "WITH " + LOGIT_DISCOUNT_SQL + "," + RATES_SQL + _LOGIT_COEF_OUT)
def clf_logreg(spark, sf):
    model, data = setups.fit_exact_logit(setups.logit_discount(spark, sf))
    return _coef_rounded(spark, model, ["x"])


@query("clf_logreg_lbfgs", "WITH " + LOGIT_TAX_SQL + "," + RATES_SQL + _LOGIT_COEF_OUT)
def clf_logreg_lbfgs(spark, sf):
    model, data = setups.fit_exact_logit(setups.logit_tax(spark, sf), family="binomial")
    return _coef_rounded(spark, model, ["x"])


@query("ml_threshold", "WITH " + LOGIT_DISCOUNT_SQL + "," + RATES_SQL + """
SELECT l_orderkey, l_linenumber, round(p, 4) AS p1, CAST(p > 0.55 AS DOUBLE) AS prediction
FROM d JOIN g USING (x)
""")
def ml_threshold(spark, sf):
    model, data = setups.fit_exact_logit(setups.logit_discount(spark, sf), threshold=0.55,
                                         probability_col="myProbability")
    out = model.transform(data)
    return out.select("l_orderkey", "l_linenumber",
                      F.round(vector_to_array("myProbability")[1], 4).alias("p1"), "prediction")


# --- naive Bayes ------------------------------------------------------------

_NB_SQL = """
WITH d AS (SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS cls,
                  l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem),
s AS (SELECT cls, count(*) AS n, sum(f0) AS s0, sum(f1) AS s1, sum(f2) AS s2 FROM d GROUP BY cls),
t AS (SELECT sum(n) AS tot, count(*) AS k FROM s)
SELECT cls, 'pi' AS term, round(ln(n + 1.0) - ln(tot + k * 1.0), 8) AS value FROM s, t
UNION ALL SELECT cls, 'f0', round(ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3 * 1.0), 8) FROM s
UNION ALL SELECT cls, 'f1', round(ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3 * 1.0), 8) FROM s
UNION ALL SELECT cls, 'f2', round(ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3 * 1.0), 8) FROM s
"""


@query("clf_naive_bayes", _NB_SQL)
def clf_naive_bayes(spark, sf):
    li = table(spark, sf, "lineitem")
    lab = (F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
            .otherwise(2.0))
    df = features.assemble(li.select(lab.alias("label"), "l_quantity", "l_discount", "l_tax"),
                           ["l_quantity", "l_discount", "l_tax"], "features")
    model = learners.fit(learners.naive_bayes(smoothing=1.0), df)
    pi = model.pi.toArray()
    theta = model.theta.toArray()
    rows = [(c, "pi", float(pi[c])) for c in range(len(pi))]
    rows += [(c, f"f{j}", float(theta[c][j])) for c in range(len(pi)) for j in range(theta.shape[1])]
    t = spark.createDataFrame(rows, "cls int, term string, value double")
    return t.select("cls", "term", F.round("value", 8).alias("value"))


# --- several classes, elastic net, L1 hinge -------------------------------------

@query("clf_logreg_multinomial", "WITH " + setups.LOGIT_BANDS_SQL + """
SELECT '(intercept)' AS term, cls, round(v, 3) AS value FROM v WHERE band = 0
UNION ALL SELECT CASE a.band WHEN 1 THEN 'middle' ELSE 'high' END, a.cls, round(a.v - b.v, 3)
FROM v a JOIN v b ON a.cls = b.cls AND b.band = 0 WHERE a.band > 0
""")
def clf_logreg_multinomial(spark, sf):
    """Three classes: a block of coefficients for each, centred over the
    classes, from one categorical feature."""
    data = setups.logit_bands(spark, sf)
    est = learners.logistic_regression(max_iter=200, reg=0.0, tol=1e-10, family="multinomial")
    return _coef_rounded(spark, learners.fit(est, data), reports.feature_names(data), 3)


@query("reg_elastic_net", """
WITH d AS (SELECT l_quantity / 10 + 2 * a + 0.1 * b AS y, a, b FROM lineitem, (VALUES (-1.0), (1.0)) s(a), (VALUES (-1.0), (1.0)) t(b)),
m AS (SELECT avg(y) AS my, stddev_pop(y) AS sy, covar_pop(a, y) AS ca, covar_pop(b, y) AS cb FROM d)
SELECT '(intercept)' AS term, 0 AS cls, round(my, 4) AS value FROM m
UNION ALL SELECT 'strong', 0, round(sign(ca) * greatest(abs(ca) - 0.3 * 0.8, 0) / (1 + 0.3 * 0.2 / sy), 4) FROM m
UNION ALL SELECT 'weak', 0, round(sign(cb) * greatest(abs(cb) - 0.3 * 0.8, 0) / (1 + 0.3 * 0.2 / sy), 4) FROM m
""")
def reg_elastic_net(spark, sf):
    """The reference's settings (10 iterations, penalty 0.3, ratio 0.8): on
    uncorrelated features each coefficient is soft-thresholded by itself."""
    data = setups.mirrored(spark, sf)
    out = _coef_rounded(spark, learners.fit(learners.linear_regression(), data), reports.feature_names(data))
    return out.withColumn("value", F.col("value") + 0.0)


@query("clf_logreg_elastic", """
WITH RECURSIVE d AS (SELECT CAST(l_quantity > 25 AS DOUBLE) AS x, CAST(l_quantity + 100 * l_discount > 30 AS DOUBLE) AS y FROM lineitem),
g AS (SELECT avg(1 - x) AS f0, avg(x) AS f1, avg(y) FILTER (x = 0) AS y0, avg(y) FILTER (x = 1) AS y1, avg(y) AS p, 1 / stddev_samp(x) AS t FROM d),
it(k, a, u) AS (
  SELECT 0, ln(p / (1 - p)), CAST(0.1 AS DOUBLE) FROM g
  UNION ALL
  SELECT k + 1, a - (huu * ga - hau * gu) / (haa * huu - hau * hau), u - (haa * gu - hau * ga) / (haa * huu - hau * hau)
  FROM (SELECT *, f0 * (q0 - y0) + f1 * (q1 - y1) AS ga, f1 * (q1 - y1) * t + 0.3 * 0.8 + 0.3 * 0.2 * u AS gu,
               f0 * q0 * (1 - q0) + f1 * q1 * (1 - q1) AS haa, f1 * q1 * (1 - q1) * t AS hau, f1 * q1 * (1 - q1) * t * t + 0.3 * 0.2 AS huu
        FROM (SELECT *, 1 / (1 + exp(-a)) AS q0, 1 / (1 + exp(-a - u * t)) AS q1 FROM it, g WHERE k < 40)))
SELECT '(intercept)' AS term, 0 AS cls, round(a, 3) AS value FROM it WHERE k = 40
UNION ALL SELECT 'x', 0, round(u * t, 3) FROM it, g WHERE k = 40
""")
def clf_logreg_elastic(spark, sf):
    """The reference's settings (10 iterations, penalty 0.3, ratio 0.8) against
    Newton's method on the penalised likelihood of two groups."""
    data = setups.logit_big(spark, sf)
    model = learners.fit(learners.logistic_regression(reg=learners.LINREG_REG, elastic=learners.LINREG_ELASTIC), data)
    return _coef_rounded(spark, model, ["x"], 3)


_HINGE_GRID = """
SELECT min(loss) AS least
FROM (SELECT w, b, sum(n * greatest(0, 1 - s * (w * x + b))) / sum(n) + {penalty} AS loss
      FROM groups, (SELECT {i} AS w FROM {w}) ws, (SELECT {j} AS b FROM {b}) bs GROUP BY w, b) grid
"""


@query("clf_svm_l1", """
WITH groups AS (SELECT CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE -1.0 END AS s,
                       CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE -1.0 END + round(40 * l_discount - 2, 6) AS x, CAST(count(*) AS DOUBLE) AS n
                FROM lineitem GROUP BY ALL)
SELECT round(least, 6) AS grid_loss, true AS reached FROM (""" + _HINGE_GRID.format(
    i="i / 50.0", w="range(0, 76) t(i)", j="j / 50.0", b="range(-50, 51) t(j)", penalty="0.1 * w") + ")")
def clf_svm_l1(spark, sf):
    """The alternative updater (L1, penalty 0.1) on overlapping groups: the
    loss reached is that of the best point of a fine grid, within 1e-3."""
    rows = setups.overlapping(spark, sf)
    model = learners.fit_linear_svc_l1(features.assemble(rows, ["x"], "features"))
    spark_groups = rows.groupBy((2 * F.col("label") - 1).alias("s"), "x").agg(F.count("*").alias("n"))
    least = spark.sql(_HINGE_GRID.format(i="id / 50.0", w="range(0, 76)", j="id / 50.0", b="range(-50, 51)", penalty="0.1 * w").replace("groups", "{groups}"), groups=spark_groups)
    return least.select(F.round("least", 6).alias("grid_loss"), (F.abs(F.col("least") - F.lit(model.objective)) <= 1e-3).alias("reached"))


_RIDGE = "0.5 * w * w * max(spread)"  # penalty 1.0 on the standardised coefficient


@query("clf_svm_overlap", """
WITH d AS (SELECT CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE -1.0 END AS s,
                  CAST(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE -1.0 END + round(40 * l_discount - 2, 6) AS DOUBLE) AS x FROM lineitem),
groups AS (SELECT s, x, CAST(count(*) AS DOUBLE) AS n, (SELECT var_samp(x) FROM d) AS spread FROM d GROUP BY ALL)
SELECT round(least, 6) AS grid_loss, true AS reached FROM (""" + _HINGE_GRID.format(
    i="i / 100.0", w="range(0, 101) t(i)", j="j / 100.0", b="range(-60, 61) t(j)", penalty=_RIDGE) + ")")
def clf_svm_overlap(spark, sf):
    """The reference's settings (100 iterations, L2 1.0) on overlapping groups:
    the loss of the fitted plane is at most 1e-3 above the best of a grid."""
    rows = setups.overlapping(spark, sf)
    model = learners.fit(learners.linear_svc(), features.assemble(rows, ["x"], "features"))
    groups = rows.groupBy((2 * F.col("label") - 1).alias("s"), "x").agg(F.count("*").alias("n"))
    groups = groups.withColumn("spread", F.lit(rows.agg(F.var_samp("x")).first()[0]))
    grid = dict(i="id / 100.0", w="range(0, 101)", j="id / 100.0", b="range(-60, 61)")
    point = dict(i=f"id + {float(model.coefficients[0])!r}D", w="range(0, 1)", j=f"id + {float(model.intercept)!r}D", b="range(0, 1)")
    least, reached = (spark.sql(_HINGE_GRID.format(**at, penalty=_RIDGE).replace("groups", "{groups}"), groups=groups) for at in (grid, point))
    both = least.withColumn("loss", F.lit(reached.first()[0]))
    return both.select(F.round("least", 6).alias("grid_loss"), (F.col("loss") <= F.col("least") + 1e-3).alias("reached"))


# --- trees ------------------------------------------------------------------

_STUMP_CLASS_OUT = """
SELECT thr AS threshold,
       CAST(CASE WHEN ln1 > ln - ln1 THEN 1 ELSE 0 END AS DOUBLE) AS left_prediction,
       CAST(CASE WHEN rn1 > rn - rn1 THEN 1 ELSE 0 END AS DOUBLE) AS right_prediction
FROM best
"""

_STUMP_REG_OUT = """
SELECT thr AS threshold, round(ls / ln, 3) AS left_prediction, round(rs / rn, 3) AS right_prediction
FROM best
"""


def _root_splits(spark, model, digits: int | None = None):
    """(tree, threshold, left_prediction, right_prediction) of every tree's
    root, from the saved node table; a tree without a split has no row."""
    nodes = reports.tree_nodes(spark, model)
    root = nodes.filter(F.col("id") == 0).select("tree", "threshold", "left_child", "right_child")
    left = nodes.select("tree", F.col("id").alias("left_child"), F.col("prediction").alias("left_prediction"))
    right = nodes.select("tree", F.col("id").alias("right_child"), F.col("prediction").alias("right_prediction"))
    out = root.join(left, ["tree", "left_child"]).join(right, ["tree", "right_child"])
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: F.col(c))
    return out.select("tree", "threshold", rnd("left_prediction").alias("left_prediction"),
                      rnd("right_prediction").alias("right_prediction"))


def _stump_summary(spark, model, digits: int | None = None):
    """(threshold, left_prediction, right_prediction) of a depth-1 tree
    (or the first tree of an ensemble)."""
    return _root_splits(spark, model, digits).filter(F.col("tree") == 0).drop("tree")


@query("clf_tree", "WITH " + STUMP_CLASS_SQL + _STUMP_CLASS_OUT)
def clf_tree(spark, sf):
    data = setups.stump_class_data(spark, sf)
    model = learners.fit(learners.decision_tree_classifier(max_depth=1, max_bins=64), data)
    return _stump_summary(spark, model)


@query("clf_forest", "WITH " + STUMP_CLASS_SQL + _STUMP_CLASS_OUT)
def clf_forest(spark, sf):
    # one unbagged tree over all features: the forest reduces to the tree
    data = setups.stump_class_data(spark, sf)
    model = learners.fit(learners.random_forest_classifier(num_trees=1, max_depth=1, max_bins=64,
                                                           bootstrap=False,
                                                           featureSubsetStrategy="all"), data)
    return _stump_summary(spark, model)


# Greedy depth-5 variance tree over two ordered numbers and a set of seven
# categories, one level of CTEs after the other.  A cut of a number lies
# midway to the next value of the whole table; categories are ordered by the
# mean of their rows in the node, and a prefix of them goes left.
_DEEP_DEPTH = 5


def _deep_sql(depth: int) -> str:
    ctes = ["""cells AS MATERIALIZED (SELECT l_quantity AS f0, l_discount AS f1, CAST(l_linenumber - 1 AS DOUBLE) AS f2, count(*) AS n,
            sum(l_extendedprice / 1000 + 15 * ((l_linenumber * 3) % 7)) AS s FROM lineitem GROUP BY 1, 2, 3)""",
            """cuts AS MATERIALIZED (SELECT 0 AS f, v, (v + lead(v) OVER (ORDER BY v)) / 2 AS cut FROM (SELECT DISTINCT f0 AS v FROM cells)
            UNION ALL SELECT 1, v, (v + lead(v) OVER (ORDER BY v)) / 2 FROM (SELECT DISTINCT f1 AS v FROM cells))""",
            "c0 AS MATERIALIZED (SELECT 1 AS node, * FROM cells)"]
    for d in range(depth + 1):
        ctes.append(f"t{d} AS MATERIALIZED (SELECT node, sum(n) AS n, sum(s) AS s FROM c{d} GROUP BY node)")
        if d == depth:
            break
        ctes.append(f"""b{d} AS MATERIALIZED (
          WITH a AS (SELECT node, 0 AS f, f0 AS v, f0 AS o, sum(n) AS n, sum(s) AS s FROM c{d} GROUP BY node, f0
                     UNION ALL SELECT node, 1, f1, f1, sum(n), sum(s) FROM c{d} GROUP BY node, f1
                     UNION ALL SELECT node, 2, f2, sum(s) / sum(n), sum(n), sum(s) FROM c{d} GROUP BY node, f2),
          p AS (SELECT node, f, v, o, sum(n) OVER w AS ln, sum(s) OVER w AS ls, CASE WHEN f = 2 THEN list(v) OVER w END AS cats
                FROM a WINDOW w AS (PARTITION BY node, f ORDER BY o, v ROWS UNBOUNDED PRECEDING)),
          g AS (SELECT p.*, ls * ls / ln + (t.s - ls) * (t.s - ls) / (t.n - ln) - t.s * t.s / t.n AS gain
                FROM p JOIN t{d} t USING (node) WHERE ln < t.n)
          SELECT * FROM g WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, o) = 1)""")
        ctes.append(f"""c{d + 1} AS MATERIALIZED (SELECT 2 * c.node + CASE WHEN CASE b.f WHEN 0 THEN c.f0 <= b.v WHEN 1 THEN c.f1 <= b.v
            ELSE list_contains(b.cats, c.f2) END THEN 0 ELSE 1 END AS node, c.f0, c.f1, c.f2, c.n, c.s FROM c{d} c JOIN b{d} b USING (node))""")
    rows = [f"""SELECT t.node, t.n, t.s, b.f, c.cut, b.cats FROM t{d} t LEFT JOIN b{d} b USING (node)
            LEFT JOIN cuts c ON c.f = b.f AND c.v = b.v""" for d in range(depth)]
    rows.append(f"SELECT node, n, s, NULL, NULL, NULL FROM t{depth}")
    return "WITH " + ",\n".join(ctes) + ",\nnodes AS (" + " UNION ALL ".join(rows) + """)
SELECT CAST(node AS BIGINT) AS place, CAST(n AS BIGINT) AS n, round(s / n, 4) AS prediction, CAST(coalesce(f, -1) AS INTEGER) AS feature,
       round(cut, 6) AS threshold, array_to_string(list_transform(list_sort(cats), lambda x: CAST(CAST(x AS INTEGER) AS VARCHAR)), ',') AS left_categories
FROM nodes
"""


@query("reg_tree_deep", _deep_sql(_DEEP_DEPTH))
def reg_tree_deep(spark, sf):
    """The whole node table of a tree of the reference's depth, with a categorical map."""
    li = table(spark, sf, "lineitem")
    y = F.col("l_extendedprice") / 1000 + 15 * ((F.col("l_linenumber") * 3) % 7)
    data = features.assemble(li.select("l_quantity", "l_discount", (F.col("l_linenumber") - 1).cast("double").alias("line"), y.alias("label")),
                             ["l_quantity", "l_discount", "line"], "features")
    indexed = features.vector_indexer("features", "indexed", max_categories=7).fit(data).transform(data)
    model = learners.fit(learners.decision_tree_regressor(features="indexed", max_depth=_DEEP_DEPTH, max_bins=64), indexed)
    nodes = reports.tree_places(reports.tree_nodes(spark, model), _DEEP_DEPTH)
    left = F.transform(F.array_sort("left_categories"), lambda x: x.cast("int").cast("string"))
    return nodes.select("place", F.element_at("stats", 1).cast("long").alias("n"), F.round("prediction", 4).alias("prediction"), "feature",
                        F.round("threshold", 6).alias("threshold"), F.array_join(left, ",").alias("left_categories"))


@query("reg_tree", "WITH " + STUMP_REG_SQL + _STUMP_REG_OUT)
def reg_tree(spark, sf):
    data = setups.stump_reg_data(spark, sf)
    model = learners.fit(learners.decision_tree_regressor(max_depth=1, max_bins=64), data)
    return _stump_summary(spark, model, 3)


@query("reg_forest", "WITH " + STUMP_REG_SQL + _STUMP_REG_OUT)
def reg_forest(spark, sf):
    data = setups.stump_reg_data(spark, sf)
    model = learners.fit(learners.random_forest_regressor(num_trees=1, max_depth=1, max_bins=64,
                                                          bootstrap=False,
                                                          featureSubsetStrategy="all"), data)
    return _stump_summary(spark, model, 3)


@query("reg_gbt", "WITH " + STUMP_REG_SQL + _STUMP_REG_OUT)
def reg_gbt(spark, sf):
    # one boosting round of squared loss fits the first tree to the label
    data = setups.stump_reg_data(spark, sf)
    model = learners.fit(learners.gbt_regressor(max_iter=1, max_depth=1, max_bins=64), data)
    return _stump_summary(spark, model, 3)


@query("rep_tree", "WITH " + STUMP_CLASS_SQL + """,
tot AS (SELECT sum(n) AS n, sum(n1) AS n1 FROM v)
SELECT 0 AS id, CAST(CASE WHEN tot.n1 > tot.n - tot.n1 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
       1 AS left_child, 2 AS right_child, 0 AS feature, thr AS threshold FROM best, tot
UNION ALL SELECT 1, CAST(CASE WHEN ln1 > ln - ln1 THEN 1 ELSE 0 END AS DOUBLE), -1, -1, -1, NULL FROM best
UNION ALL SELECT 2, CAST(CASE WHEN rn1 > rn - rn1 THEN 1 ELSE 0 END AS DOUBLE), -1, -1, -1, NULL FROM best
""")
def rep_tree(spark, sf):
    data = setups.stump_class_data(spark, sf)
    model = learners.fit(learners.decision_tree_classifier(max_depth=1, max_bins=64), data)
    return reports.tree_nodes(spark, model).select(
        "id", "prediction", "left_child", "right_child", "feature", "threshold")


# --- rows-only learners ------------------------------------------------------

def _binary_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    df = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                   (F.col("l_quantity") + 200 * F.col("l_discount") > 30).cast("double").alias("label"))
    return features.assemble(df, ["l_quantity", "l_discount"], "features")


@query("clf_gbt", BOOSTED_SQL + """
SELECT tree, thr AS threshold, round(l, 6) AS left_prediction, round(r, 6) AS right_prediction FROM roots
""")
def clf_gbt(spark, sf):
    # the reference's settings (10 rounds, depth 5): where the tree of each
    # round first cuts, and the mean of what it is fitted to on either side,
    # which from the second round on depends on all leaves of those before
    data = setups.stump_class_data(spark, sf)
    model = learners.fit(learners.gbt_classifier(max_bins=64), data)
    return _root_splits(spark, model, 6)


@query("clf_svm", """
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'O' AS DOUBLE) AS label,
       CAST(l_linestatus = 'O' AS DOUBLE) AS prediction FROM lineitem
""")
def clf_svm(spark, sf):
    # the reference's settings (100 iterations, L2 1.0) on two groups 100
    # apart: the hinge optimum still separates them, so every row is
    # predicted as its own group
    groups = setups.kmeans_groups(spark, sf).withColumn(
        "label", (F.col("x") >= 100).cast("double"))
    model = learners.fit(learners.linear_svc(), groups)
    return model.transform(groups).select("l_orderkey", "l_linenumber", "label", "prediction")


@query("clf_mlp", """
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'O' AS DOUBLE) AS label,
       CAST(l_linestatus = 'O' AS DOUBLE) AS prediction FROM lineitem
""")
def clf_mlp(spark, sf):
    # two groups that a small network has to tell apart without an error
    x = F.when(F.col("l_linestatus") == "O", 1.0).otherwise(-1.0) + F.col("l_discount")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"), F.col("l_tax").alias("y"),
                                             (F.col("l_linestatus") == "O").cast("double").alias("label"))
    data = features.assemble(li, ["x", "y"], "features")
    model = learners.fit(learners.mlp_classifier([2, 5, 2], max_iter=100), data)
    return model.transform(data).select("l_orderkey", "l_linenumber", "label", "prediction")


# --- ensembles at the reference's settings, on targets they must hit exactly

def _steps(spark, sf):
    """label is a class, y a step function, of features that trees can cut:
    quantity over 25, then tax over 0.04."""
    li = table(spark, sf, "lineitem")
    big, taxed = (F.col("l_quantity") > 25).cast("double"), (F.col("l_tax") > 0.04).cast("double")
    rows = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", big.alias("label"), (100 * big + 10 * big * taxed).alias("y"))
    return features.assemble(rows, ["l_quantity", "l_tax"], "features")


_STEP_CLASS_SQL = """
SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS DOUBLE) AS prediction FROM lineitem
"""
_STEP_VALUE_SQL = """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_quantity > 25 THEN CASE WHEN l_tax > 0.04 THEN 110 ELSE 100 END ELSE 0 END AS DOUBLE) AS prediction
FROM lineitem
"""


def _predicted(model, data, digits: int = 0):
    value = F.round("prediction", digits) + 0.0                     # no negative zero
    return model.transform(data).select("l_orderkey", "l_linenumber", value.alias("prediction"))


@query("clf_forest_10", _STEP_CLASS_SQL)
def clf_forest_10(spark, sf):
    data = _steps(spark, sf)
    forest = learners.random_forest_classifier(max_bins=64, featureSubsetStrategy="all")   # 10 bagged trees
    model = learners.fit(forest, data)
    if model.getNumTrees != learners.FOREST_TREES:
        raise RuntimeError(f"{model.getNumTrees} trees")
    return _predicted(model, data)


@query("rep_tree_rules", _STEP_CLASS_SQL)
def rep_tree_rules(spark, sf):
    """The forest's ten node tables as one expression, instead of the model."""
    data = _steps(spark, sf)
    model = learners.fit(learners.random_forest_classifier(max_bins=64, featureSubsetStrategy="all"), data)
    return rules.score_by_rules(model, data).select("l_orderkey", "l_linenumber", "prediction")


@query("clf_gbt_10", _STEP_CLASS_SQL)
def clf_gbt_10(spark, sf):
    data = _steps(spark, sf)
    model = learners.fit(learners.gbt_classifier(max_bins=64), data)                        # 10 rounds
    if len(model.trees) != learners.GBT_CLASSIFIER_ROUNDS:
        raise RuntimeError(f"{len(model.trees)} rounds")
    return _predicted(model, data)


@query("reg_forest_20", _STEP_VALUE_SQL)
def reg_forest_20(spark, sf):
    data = _steps(spark, sf)
    model = learners.fit(learners.random_forest_regressor("y", max_bins=64, featureSubsetStrategy="all"), data)
    return _predicted(model, data)


@query("reg_gbt_30", _STEP_VALUE_SQL)
def reg_gbt_30(spark, sf):
    data = _steps(spark, sf)
    model = learners.fit(learners.gbt_regressor("y", max_bins=64), data)                    # 30 rounds
    if len(model.trees) != learners.GBT_REGRESSOR_ROUNDS:
        raise RuntimeError(f"{len(model.trees)} rounds")
    return _predicted(model, data)


def _ordered_centers(spark, model):
    """Centres numbered by their first coordinate (k-means numbers them in
    whatever order its initialisation found them)."""
    cs = sorted((tuple(c.tolist()), i) for i, c in enumerate(model.clusterCenters()))
    return {orig: rank for rank, (_, orig) in enumerate(cs)}, [c for c, _ in cs]


@query("clu_kmeans", "WITH " + setups.KMEANS_GROUPS_SQL + """
SELECT l_orderkey, l_linenumber, cluster, round(cx, 6) AS center_x, round(cy, 6) AS center_y
FROM d JOIN r ON (d.x >= 100) = r.grp
""")
def clu_kmeans(spark, sf):
    data = setups.kmeans_groups(spark, sf)
    model = learners.fit(learners.kmeans(), data)          # k = 2, seed 1
    rank, cs = _ordered_centers(spark, model)
    lookup = spark.createDataFrame(
        [(orig, rank[orig], float(cs[rank[orig]][0]), float(cs[rank[orig]][1])) for orig in rank],
        "prediction int, cluster int, center_x double, center_y double")
    out = model.transform(data).join(F.broadcast(lookup), "prediction")  # k rows
    return out.select("l_orderkey", "l_linenumber", "cluster",
                      F.round("center_x", 6).alias("center_x"), F.round("center_y", 6).alias("center_y"))


@query("rep_centers", "WITH " + setups.KMEANS_GROUPS_SQL + """
SELECT cluster, 0 AS dim, round(cx, 6) AS value FROM r
UNION ALL SELECT cluster, 1, round(cy, 6) FROM r
""")
def rep_centers(spark, sf):
    model = learners.fit(learners.kmeans(), setups.kmeans_groups(spark, sf))
    rank, _ = _ordered_centers(spark, model)
    t = reports.centers(spark, model)
    m = spark.createDataFrame(list(rank.items()), "cluster int, rank int")
    return (t.join(m, "cluster").select(F.col("rank").alias("cluster"), "dim",
                                        F.round("value", 6).alias("value")))


# --- linear regression and its reports ----------------------------------------

@query("reg_linear", "WITH " + OLS_SQL + """
SELECT '(intercept)' AS term, 0 AS cls, round(a, 4) AS value FROM m
UNION ALL SELECT 'l_quantity', 0, round(b, 4) FROM m
""")
def reg_linear(spark, sf):
    data = setups.ols_lineitem(spark, sf)
    model = learners.fit(setups.exact_linreg(), data)
    return _coef_rounded(spark, model, reports.feature_names(data))


@query("rep_coefficients", """
WITH m AS (SELECT covar_pop(l_quantity, l_quantity) AS sxx, covar_pop(l_quantity, l_discount) AS sxz,
                  covar_pop(l_discount, l_discount) AS szz, covar_pop(l_quantity, l_extendedprice) AS sxy,
                  covar_pop(l_discount, l_extendedprice) AS szy, avg(l_quantity) AS mx,
                  avg(l_discount) AS mz, avg(l_extendedprice) AS my FROM lineitem),
b AS (SELECT (szz * sxy - sxz * szy) / (sxx * szz - sxz * sxz) AS b1,
             (sxx * szy - sxz * sxy) / (sxx * szz - sxz * sxz) AS b2, mx, mz, my FROM m)
SELECT '(intercept)' AS term, 0 AS cls, round(my - b1 * mx - b2 * mz, 2) AS value FROM b
UNION ALL SELECT 'l_quantity', 0, round(b1, 4) FROM b
UNION ALL SELECT 'l_discount', 0, round(b2, 2) FROM b
""")
def rep_coefficients(spark, sf):
    data = setups.ols_lineitem(spark, sf, ("l_quantity", "l_discount"))
    model = learners.fit(setups.exact_linreg(), data)
    t = reports.coefficients(spark, model, reports.feature_names(data))
    value = (F.when(F.col("term") == "l_quantity", F.round("value", 4))
              .otherwise(F.round("value", 2)))
    return t.select("term", F.col("class").alias("cls"), value.alias("value"))


@query("rep_residuals", "WITH " + OLS_SQL + """
SELECT l_orderkey, l_linenumber, round(l_extendedprice - (a + b * l_quantity), 2) AS residual
FROM lineitem, m
""")
def rep_residuals(spark, sf):
    data = setups.ols_lineitem(spark, sf)
    model = learners.fit(setups.exact_linreg(), data)
    r = reports.residuals(model, data, "label", ["l_orderkey", "l_linenumber"])
    return r.select("l_orderkey", "l_linenumber", F.round("residual", 2).alias("residual"))


@query("ml_predict", "WITH " + OLS_SQL + """
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 2) AS prediction FROM lineitem, m
""")
def ml_predict(spark, sf):
    data = setups.ols_lineitem(spark, sf)
    model = learners.fit(setups.exact_linreg(), data)
    return model.transform(data).select("l_orderkey", "l_linenumber",
                                        F.round("prediction", 2).alias("prediction"))


@query("rep_fit_stats", "WITH " + OLS_SQL + """,
r AS (SELECT l_extendedprice - (a + b * l_quantity) AS e FROM lineitem, m)
SELECT round(sqrt(avg(e * e)), 4) AS rmse,
       round((SELECT regr_r2(l_extendedprice, l_quantity) FROM lineitem), 8) AS r2,
       round(avg(abs(e)), 4) AS mae, count(*) AS n FROM r
""")
def rep_fit_stats(spark, sf):
    data = setups.ols_lineitem(spark, sf)
    model = learners.fit(setups.exact_linreg(), data)
    s = reports.fit_stats(spark, model)
    return s.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"),
                    F.round("mae", 4).alias("mae"), "n")


@query("rep_loss_history", "WITH " + LOGIT_TAX_SQL + "," + RATES_SQL + """,
a AS (SELECT avg(label) AS p FROM d),
l AS (SELECT avg(-label * ln(p) - (1 - label) * ln(1 - p)) AS best FROM d JOIN g USING (x))
SELECT 'first' AS point, round(-p * ln(p) - (1 - p) * ln(1 - p), 6) AS loss, true AS falling FROM a
UNION ALL SELECT 'last', round(best, 6), true FROM l
""")
def rep_loss_history(spark, sf):
    """The first loss is that of the labels' share, the last one the least
    there is (both known in closed form); it never rises between."""
    model, _ = setups.fit_exact_logit(setups.logit_tax(spark, sf))
    losses = [r["loss"] for r in reports.loss_history(spark, model).orderBy("iteration").collect()]
    falling = all(b <= a + 1e-12 for a, b in zip(losses, losses[1:], strict=False))
    return spark.createDataFrame([("first", round(losses[0], 6), falling), ("last", round(losses[-1], 6), falling)],
                                 "point string, loss double, falling boolean")


@query("rep_iterations", """
SELECT true AS within_limit, true AS one_loss_each, count(*) AS n FROM lineitem
""")
def rep_iterations(spark, sf):
    """The count has no closed form; it is at most the limit (10) and one
    less than the losses.  ``n`` is the rows that the fit saw."""
    data = setups.ols_lineitem(spark, sf, ("l_quantity", "l_discount", "l_tax"))
    model = learners.fit(learners.linear_regression(solver="l-bfgs"), data)      # 10 iterations, reg 0.3, elastic 0.8
    losses = F.lit(reports.loss_history(spark, model).count())
    found, rows = reports.iterations(spark, model), model.summary.numInstances
    total = F.col("total_iterations")
    return found.select((total.between(1, learners.LINREG_ITERATIONS)).alias("within_limit"),
                        (losses == total + 1).alias("one_loss_each"), F.lit(rows).cast("long").alias("n"))


# --- training-summary ROC and AUC ---------------------------------------------

_ROC2_SQL = "WITH " + LOGIT_TAX_SQL + "," + RATES_SQL + """,
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
hi AS (SELECT * FROM g ORDER BY p DESC LIMIT 1),
pts AS (SELECT 0.0::DOUBLE AS FPR, 0.0::DOUBLE AS TPR
        UNION ALL SELECT hi.neg / t.N, hi.pos / t.P FROM hi, t
        UNION ALL SELECT 1.0::DOUBLE, 1.0::DOUBLE
        UNION ALL SELECT 1.0::DOUBLE, 1.0::DOUBLE)
"""


@query("rep_roc", _ROC2_SQL + "SELECT FPR, TPR FROM pts")
def rep_roc(spark, sf):
    model, _ = setups.fit_exact_logit(setups.logit_tax(spark, sf))
    return reports.summary_roc(model)


@query("rep_auc", _ROC2_SQL + """
SELECT round((SELECT hi.neg / t.N * hi.pos / t.P / 2
                     + (1 - hi.neg / t.N) * (hi.pos / t.P + 1) / 2 FROM hi, t), 10) AS auc
""")
def rep_auc(spark, sf):
    model, _ = setups.fit_exact_logit(setups.logit_tax(spark, sf))
    return reports.summary_auc(spark, model).select(F.round("auc", 10).alias("auc"))


# --- params, labels, stages ------------------------------------------------------

@query("rep_params", """
SELECT * FROM (VALUES
 ('LogisticRegressionModel', 'aggregationDepth', '2', true),
 ('LogisticRegressionModel', 'elasticNetParam', '0.0', true),
 ('LogisticRegressionModel', 'family', 'auto', true),
 ('LogisticRegressionModel', 'featuresCol', 'features', true),
 ('LogisticRegressionModel', 'fitIntercept', 'True', true),
 ('LogisticRegressionModel', 'labelCol', 'label', true),
 ('LogisticRegressionModel', 'lowerBoundsOnCoefficients', NULL, false),
 ('LogisticRegressionModel', 'lowerBoundsOnIntercepts', NULL, false),
 ('LogisticRegressionModel', 'maxBlockSizeInMB', '0.0', false),
 ('LogisticRegressionModel', 'maxIter', '200', true),
 ('LogisticRegressionModel', 'predictionCol', 'prediction', false),
 ('LogisticRegressionModel', 'probabilityCol', 'probability', true),
 ('LogisticRegressionModel', 'rawPredictionCol', 'rawPrediction', false),
 ('LogisticRegressionModel', 'regParam', '0.0', true),
 ('LogisticRegressionModel', 'standardization', 'True', false),
 ('LogisticRegressionModel', 'threshold', '0.5', true),
 ('LogisticRegressionModel', 'thresholds', NULL, false),
 ('LogisticRegressionModel', 'tol', '1e-12', true),
 ('LogisticRegressionModel', 'upperBoundsOnCoefficients', NULL, false),
 ('LogisticRegressionModel', 'upperBoundsOnIntercepts', NULL, false),
 ('LogisticRegressionModel', 'weightCol', NULL, false)) AS t(stage, param, value, is_set),
 (SELECT count(*) AS n_rows FROM lineitem)
""")
def rep_params(spark, sf):
    model, _ = setups.fit_exact_logit(setups.logit_tax(spark, sf))
    seen = model.summary.predictions.count()
    return reports.params(spark, model, "LogisticRegressionModel").select("stage", "param", "value", "is_set", F.lit(seen).alias("n_rows"))


@query("rep_labels", """
WITH c AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS INTEGER) AS index, v AS label FROM c
""")
def rep_labels(spark, sf):
    o = table(spark, sf, "orders")
    return features.label_index(o, "o_orderpriority").select("index", "label")


@query("rep_stage", """
SELECT * FROM (VALUES (0, 'StringIndexerModel'), (1, 'VectorAssembler'), (2, 'LogisticRegressionModel'))
AS t(position, stage), (SELECT count(*) AS n_rows FROM orders)
""")
def rep_stage(spark, sf):
    from spindle.operators import tune

    o = table(spark, sf, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    stages = [features.string_indexer("o_orderpriority", "pidx"),
              features.assembler(["pidx", "o_totalprice"], "features"),
              learners.logistic_regression(max_iter=10)]
    model = tune.fit_pipeline(stages, o)
    assert isinstance(reports.stage_of(model, 2), type(model.stages[2]))
    seen = model.stages[2].summary.predictions.count()                 # rows that the last stage was fitted on
    return reports.stages(spark, model).select("position", "stage", F.lit(seen).alias("n_rows"))
