"""Fit set-ups shared by learner, report, evaluation and tuning queries.

Each set-up is chosen so that Spark's fitted result has a closed form that
SQL can state (SURVEY §2.13 "C"): one binary feature for logistic
regression (intercept = logit p0, slope = logit p1 - logit p0), one or two
features without regularisation for linear regression (least squares),
depth-1 trees on one feature whose distinct values fit in the bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators import features, learners
from spindle.plans.tables import table

#: Levels of a boosted tree below its root, unless the caller asks for others.
GBT_DEPTH = 5

# --- binary logistic set-ups on lineitem ---------------------------------


def logit_discount(spark: SparkSession, sf: str) -> DataFrame:
    """x = discount > 0.05, y = quantity + 200 * discount > 30."""
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_discount") > 0.05).cast("double").alias("x"),
        (F.col("l_quantity") + 200 * F.col("l_discount") > 30).cast("double").alias("label"))


LOGIT_DISCOUNT_SQL = """
d AS (SELECT l_orderkey, l_linenumber, CAST(l_discount > 0.05 AS DOUBLE) AS x,
             CAST(l_quantity + 200 * l_discount > 30 AS DOUBLE) AS label FROM lineitem)
"""


def logit_tax(spark: SparkSession, sf: str) -> DataFrame:
    """x = tax > 0.04, y = quantity + 500 * tax > 40."""
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_tax") > 0.04).cast("double").alias("x"),
        (F.col("l_quantity") + 500 * F.col("l_tax") > 40).cast("double").alias("label"))


LOGIT_TAX_SQL = """
d AS (SELECT l_orderkey, l_linenumber, CAST(l_tax > 0.04 AS DOUBLE) AS x,
             CAST(l_quantity + 500 * l_tax > 40 AS DOUBLE) AS label FROM lineitem)
"""

# group rates and the closed-form coefficients, after a CTE named d
RATES_SQL = """
g AS (SELECT x, avg(label) AS p, sum(label) AS pos, sum(1 - label) AS neg FROM d GROUP BY x),
c AS (SELECT max(CASE WHEN x = 0 THEN ln(p / (1 - p)) END) AS b0,
             max(CASE WHEN x = 1 THEN ln(p / (1 - p)) END)
           - max(CASE WHEN x = 0 THEN ln(p / (1 - p)) END) AS b1 FROM g)
"""


def fit_exact_logit(df: DataFrame, threshold: float = 0.5, probability_col: str = "probability",
                    family: str = "auto"):
    """Unregularised logistic regression on the one feature x, converged
    tightly enough for the closed form to hold to 7+ digits."""
    asm = features.assembler(["x"], "features")
    est = learners.logistic_regression(max_iter=200, reg=0.0, tol=1e-12, threshold=threshold,
                                       probability_col=probability_col, family=family)
    data = asm.transform(df)
    return learners.fit(est, data), data


# --- least squares on lineitem -----------------------------------------------

def ols_lineitem(spark: SparkSession, sf: str, cols=("l_quantity",)) -> DataFrame:
    li = table(spark, sf, "lineitem")
    data = features.assemble(li.select("l_orderkey", "l_linenumber", "l_extendedprice", *cols),
                             list(cols), "features")
    return data.withColumnRenamed("l_extendedprice", "label")


def exact_linreg(fit_intercept: bool = True, standardization: bool = True):
    """Linear regression solved by the normal equations, no penalty."""
    return learners.linear_regression(max_iter=100, reg=0.0, elastic=0.0, solver="normal",
                                      fit_intercept=fit_intercept,
                                      standardization=standardization)


OLS_SQL = """
m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
      FROM lineitem)
"""

# --- depth-1 trees on l_quantity ---------------------------------------------

def stump_class_data(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    df = li.select("l_quantity",
                   (F.col("l_quantity") + 200 * F.col("l_discount") > 30).cast("double").alias("label"))
    return features.assemble(df, ["l_quantity"], "features")


# best gini split of y over midpoints of consecutive distinct x values;
# ties go to the smaller threshold, like Spark's first maximum
STUMP_CLASS_SQL = """
d AS (SELECT l_quantity AS x, CAST(l_quantity + 200 * l_discount > 30 AS DOUBLE) AS y FROM lineitem),
v AS (SELECT x, count(*) AS n, sum(y) AS n1 FROM d GROUP BY x),
cu AS (SELECT x, (x + lead(x) OVER (ORDER BY x)) / 2 AS thr,
              sum(n) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS ln,
              sum(n1) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS ln1,
              sum(n) OVER () AS tn, sum(n1) OVER () AS tn1 FROM v),
sp AS (SELECT thr, ln, ln1, tn - ln AS rn, tn1 - ln1 AS rn1, tn, tn1 FROM cu WHERE thr IS NOT NULL),
gi AS (SELECT *, 1 - (ln1 / ln) ^ 2 - ((ln - ln1) / ln) ^ 2 AS gl,
                 1 - (rn1 / rn) ^ 2 - ((rn - rn1) / rn) ^ 2 AS gr FROM sp),
best AS (SELECT * FROM gi ORDER BY (ln * gl + rn * gr) / tn ASC, thr ASC LIMIT 1)
"""


def stump_reg_data(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    df = li.select("l_quantity", F.col("l_extendedprice").alias("label"))
    return features.assemble(df, ["l_quantity"], "features")


# best variance split over midpoints of x, given a CTE v(x, n, s, ss) of
# per-value count, sum and sum of squares of the target
_VARIANCE_SPLIT_SQL = """
cu AS (SELECT x, (x + lead(x) OVER (ORDER BY x)) / 2 AS thr,
              sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(ss) OVER w AS lss,
              sum(n) OVER () AS tn, sum(s) OVER () AS ts, sum(ss) OVER () AS tss
       FROM v WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
sp AS (SELECT thr, ln, ls, lss, tn - ln AS rn, ts - ls AS rs, tss - lss AS rss FROM cu WHERE thr IS NOT NULL),
best AS (SELECT * FROM sp ORDER BY (lss - ls * ls / ln) + (rss - rs * rs / rn) ASC, thr ASC LIMIT 1)
"""

# extendedprice over quantity (regression stump)
STUMP_REG_SQL = """
v AS (SELECT l_quantity AS x, count(*) AS n, sum(l_extendedprice) AS s,
             sum(l_extendedprice * l_extendedprice) AS ss FROM lineitem GROUP BY 1),
""" + _VARIANCE_SPLIT_SQL

# all rounds of a two-class GBT on l_quantity.  Labels are remapped to -1/+1; a
# round's tree is fitted to s, the sum of a quantity's residuals (4y / (1 + exp(2yf))
# under the log loss, the label itself in the first round), by variance splits one
# level after the other, and f moves by the mean of a row's leaf.  The children of a
# node k are 2k (up to the cut) and 2k + 1; a node without a gain is all in 2k.
BOOSTED_SQL = f"""
WITH RECURSIVE cells AS MATERIALIZED (
  SELECT x, (x + lead(x) OVER (ORDER BY x)) / 2 AS thr, CAST(n AS DOUBLE) AS n, pos
  FROM (SELECT l_quantity AS x, count(*) AS n, sum(CAST(l_quantity + 200 * l_discount > 30 AS DOUBLE)) AS pos FROM lineitem GROUP BY 1)),
rounds AS (
  SELECT 0 AS tree, 0 AS level, CAST(1 AS BIGINT) AS node, x, thr, n, pos, CAST(0 AS DOUBLE) AS f, 2 * pos - n AS s FROM cells
  UNION ALL
  SELECT CASE WHEN level < {GBT_DEPTH} THEN tree ELSE tree + 1 END, CASE WHEN level < {GBT_DEPTH} THEN level + 1 ELSE 0 END,
         CASE WHEN level = {GBT_DEPTH} THEN 1 WHEN x > cut THEN 2 * node + 1 ELSE 2 * node END, x, thr, n, pos, f,
         CASE WHEN level < {GBT_DEPTH} THEN s ELSE 4 * pos / (1 + exp(2 * f)) - 4 * (n - pos) / (1 + exp(-2 * f)) END
  FROM (SELECT tree, level, node, x, thr, n, pos, s, f + CASE WHEN level < {GBT_DEPTH} THEN 0 WHEN tree = 0 THEN ts / tn ELSE 0.1 * ts / tn END AS f,
               first_value(CASE WHEN gain > 0 THEN x END) OVER (PARTITION BY node ORDER BY gain DESC NULLS LAST, x) AS cut
        FROM (SELECT *, CASE WHEN ln < tn THEN ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn END AS gain
              FROM (SELECT *, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY node) AS tn, sum(s) OVER (PARTITION BY node) AS ts
                    FROM rounds WINDOW w AS (PARTITION BY node ORDER BY x ROWS UNBOUNDED PRECEDING))))
  WHERE tree < {learners.GBT_CLASSIFIER_ROUNDS}),
roots AS (SELECT tree, max(thr) FILTER (node = 2) AS thr, sum(s) FILTER (node = 2) / sum(n) FILTER (node = 2) AS l, sum(s) FILTER (node = 3) / sum(n) FILTER (node = 3) AS r
          FROM rounds WHERE level = 1 GROUP BY tree HAVING count(*) FILTER (node = 3) > 0)
"""


# --- k-means on two separated groups -------------------------------------------

def kmeans_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Two groups 100 apart on the first axis (line status), spread by
    discount and tax: k-means with k = 2 converges to the group means."""
    li = table(spark, sf, "lineitem")
    x = F.when(F.col("l_linestatus") == "O", 100.0).otherwise(0.0) + F.col("l_discount")
    df = li.select("l_orderkey", "l_linenumber", x.alias("x"), F.col("l_tax").alias("y"))
    return features.assemble(df, ["x", "y"], "features")


KMEANS_GROUPS_SQL = """
d AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linestatus = 'O' THEN 100.0 ELSE 0.0 END + l_discount AS x, l_tax AS y
      FROM lineitem),
g AS (SELECT l_linestatus = 'O' AS grp, avg(x) AS cx, avg(y) AS cy FROM
      (SELECT *, CASE WHEN x >= 100 THEN 'O' ELSE 'F' END AS l_linestatus FROM d) GROUP BY 1),
r AS (SELECT grp, cx, cy, CAST(row_number() OVER (ORDER BY cx) - 1 AS INTEGER) AS cluster FROM g)
"""

# --- saturated multinomial, elastic net and L1 hinge set-ups --------------------

def logit_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Three classes of size (quantity + 200 * discount) and one categorical
    feature, the discount band, as two indicators: a saturated model."""
    li = table(spark, sf, "lineitem")
    size = F.col("l_quantity") + 200 * F.col("l_discount")
    rows = li.select(F.when(size < 20, 0.0).when(size < 40, 1.0).otherwise(2.0).alias("label"),
                     F.col("l_discount").between(0.03, 0.065).cast("double").alias("middle"),
                     (F.col("l_discount") > 0.065).cast("double").alias("high"))
    return features.assemble(rows, ["middle", "high"], "features")


# log counts about their mean over the classes are the centred logits of a band
LOGIT_BANDS_SQL = """
n AS (SELECT CASE WHEN l_quantity + 200 * l_discount < 20 THEN 0 WHEN l_quantity + 200 * l_discount < 40 THEN 1 ELSE 2 END AS cls,
             CASE WHEN l_discount > 0.065 THEN 2 WHEN l_discount >= 0.03 THEN 1 ELSE 0 END AS band, ln(count(*)) AS lc
      FROM lineitem GROUP BY 1, 2),
v AS (SELECT band, cls, lc - avg(lc) OVER (PARTITION BY band) AS v FROM n)
"""


def mirrored(spark: SparkSession, sf: str) -> DataFrame:
    """Each row of lineitem once for each pair of signs: two features that are
    exactly uncorrelated, a strong one and one that an L1 penalty drops."""
    li = table(spark, sf, "lineitem")
    signs = F.explode(F.array(*[F.struct(F.lit(a).alias("strong"), F.lit(b).alias("weak")) for a in (-1.0, 1.0) for b in (-1.0, 1.0)]))
    rows = li.select("l_quantity", signs.alias("s")).select(
        (F.col("l_quantity") / 10 + 2 * F.col("s.strong") + 0.1 * F.col("s.weak")).alias("label"), F.col("s.strong").alias("strong"), F.col("s.weak").alias("weak"))
    return features.assemble(rows, ["strong", "weak"], "features")


def logit_big(spark: SparkSession, sf: str) -> DataFrame:
    """x = quantity > 25, y = quantity + 100 * discount > 30."""
    li = table(spark, sf, "lineitem")
    rows = li.select((F.col("l_quantity") > 25).cast("double").alias("x"),
                     (F.col("l_quantity") + 100 * F.col("l_discount") > 30).cast("double").alias("label"))
    return features.assemble(rows, ["x"], "features")


def overlapping(spark: SparkSession, sf: str) -> DataFrame:
    """Two groups, open and closed lines, 2 apart on an axis on which each is
    4 wide."""
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_linestatus") == "O").cast("double").alias("label"),
                     (F.when(F.col("l_linestatus") == "O", 1.0).otherwise(-1.0) + F.round(40 * F.col("l_discount") - 2, 6)).alias("x"))
