"""Feature operators: tokenising, hashing, Word2Vec, PCA, string and vector
indexing, normalising, assembling, quantile buckets, one-hot encoding.

All are ``pyspark.ml`` stages or DataFrame plans.  Some of Spark's stages
keep a table on the driver (a string indexer's labels, category maps, PCA's
d x d matrix, Word2Vec's vocabulary); ``string_index`` does without.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import (PCA, Bucketizer, HashingTF, IndexToString, Normalizer,
                                OneHotEncoder, QuantileDiscretizer, RegexTokenizer,
                                StringIndexer, StringIndexerModel, Tokenizer, VectorAssembler,
                                VectorIndexer, Word2Vec)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from spindle.operators.columns import q
from spindle.operators.ranking import running_totals

# --- text ---------------------------------------------------------------------


def tokenize(df: DataFrame, input_col: str, output_col: str = "words") -> DataFrame:
    """Lower-case, split on each single whitespace character (a double space
    gives an empty token; trailing empties are dropped)."""
    return Tokenizer(inputCol=input_col, outputCol=output_col).transform(df)


def regex_tokenize(df: DataFrame, input_col: str, output_col: str = "words",
                   pattern: str = "\\s+", gaps: bool = True, min_token_length: int = 1,
                   lowercase: bool = True) -> DataFrame:
    return RegexTokenizer(inputCol=input_col, outputCol=output_col, pattern=pattern, gaps=gaps,
                          minTokenLength=min_token_length, toLowercase=lowercase).transform(df)


def hashing_tf(df: DataFrame, input_col: str, output_col: str = "tf",
               num_features: int = 1000, binary: bool = False) -> DataFrame:
    """Term frequencies hashed (murmur3) into ``num_features`` slots."""
    return HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=num_features,
                     binary=binary).transform(df)


def hash_slots(df: DataFrame, tf_col: str, keep: Sequence[str]) -> DataFrame:
    """(``keep``…, slot, value) of every filled slot of a hashed vector."""
    slots = df.select(*[F.col(q(c)) for c in keep], F.posexplode(vector_to_array(q(tf_col))).alias("slot", "value"))
    return slots.filter(F.col("value") != 0)


def hash_collisions(df: DataFrame, words_col: str, num_features: int = 1000) -> DataFrame:
    """(slot, n_words, n_tokens, first_word) of the slots that several words
    share, to choose ``num_features`` by.  Words are counted first, so each
    is hashed once, and a frequent one moves one row from a task."""
    words = (df.select(F.explode(q(words_col)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("_words", F.array("word")))
    slots = hash_slots(hashing_tf(words, "_words", "_tf", num_features), "_tf", ["word", "n"])
    return (slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n_tokens"), F.min("word").alias("first_word"))
            .filter(F.col("n_words") > 1))


def fit_word2vec(df: DataFrame, input_col: str, output_col: str = "w2v", vector_size: int = 3,
                 min_count: int = 0, seed: int = 42, num_partitions: int = 8,
                 max_iter: int = 1):
    """Word2Vec.

    Partial models are trained per partition and summed.  How many is a plain
    parameter, so the split of the work depends neither on the corpus nor on
    the cluster; raise it with the corpus.  The float sum runs in no fixed
    order, so only ``num_partitions=1`` gives bit-repeatable vectors.  The
    vocabulary (words used at least ``min_count`` times) and its vectors live
    on the driver; ``min_count`` is the lever for large corpora.
    """
    return Word2Vec(inputCol=input_col, outputCol=output_col, vectorSize=vector_size,
                    minCount=min_count, seed=seed, numPartitions=num_partitions,
                    maxIter=max_iter).fit(df)


def word_vectors(model) -> DataFrame:
    """(word, vector) of a fitted Word2Vec model, as a table."""
    return model.getVectors()


# --- PCA --------------------------------------------------------------------

def fit_pca(df: DataFrame, input_col: str, k: int, output_col: str = "pca"):
    """PCA via Spark's d x d covariance, which comes to the driver."""
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df)


def pca_variance(spark: SparkSession, model) -> DataFrame:
    """(component, explained_variance) rows."""
    ev = model.explainedVariance.toArray().tolist()
    schema = StructType([StructField("component", IntegerType(), False),
                         StructField("explained_variance", DoubleType(), False)])
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(ev)], schema)


# --- string indexing ----------------------------------------------------------

def string_indexer(input_col: str, output_col: str, handle_invalid: str = "error") -> StringIndexer:
    """Most frequent first, ties alphabetical (a pipeline stage)."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc")


def label_index(df: DataFrame, input_col: str) -> DataFrame:
    """(label, index) of every distinct non-null value: most frequent first,
    ties alphabetical.  Positions come from range-partitioned running sums,
    so any number of labels stays on the cluster."""
    counts = (df.select(F.col(q(input_col)).cast("string").alias("label"))
                .filter(F.col("label").isNotNull())
                .groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    placed = running_totals(counts.withColumn("_one", F.lit(1)),
                            [F.col("n").desc(), F.col("label").asc()], ["_one"])
    return placed.select("label", (F.col("cum__one") - 1).cast("int").alias("index"))


def string_index(df: DataFrame, input_col: str, output_col: str, labels: DataFrame | None = None,
                 handle_invalid: str = "error") -> DataFrame:
    """``df`` with the index of ``input_col`` as a double, attached by a join
    with ``labels`` (default: learnt from ``df``).  A value that has no index
    fails the job, is dropped ('skip') or gets one index more than there are
    ('keep')."""
    labels = label_index(df, input_col) if labels is None else labels
    at = labels.select(F.col("label").alias("_label"), F.col("index").alias("_index"))
    found = df.join(at, F.col(q(input_col)).cast("string") == F.col("_label"), "left").drop("_label")
    if handle_invalid == "skip":
        found = found.filter(F.col("_index").isNotNull())
    other = F.raise_error(F.concat(F.lit(f"no index for {input_col} value "),
                                   F.coalesce(F.col(q(input_col)).cast("string"), F.lit("NULL"))))
    if handle_invalid == "keep":
        other = F.lit(labels.count())
    value = F.when(F.col("_index").isNotNull(), F.col("_index").cast("double")).otherwise(other.cast("double"))
    return found.withColumn(output_col, value).drop("_index")


def labels_table(spark: SparkSession, model: StringIndexerModel) -> DataFrame:
    """(index, label) rows of a fitted string index."""
    schema = StructType([StructField("index", IntegerType(), False),
                         StructField("label", StringType(), True)])
    return spark.createDataFrame(list(enumerate(model.labels)), schema)


def index_to_string(df: DataFrame, input_col: str, output_col: str,
                    labels: Sequence[str] | None = None) -> DataFrame:
    """Indices back to labels; without ``labels`` they come from the
    column's metadata (set by the string indexer)."""
    kw = {"labels": list(labels)} if labels is not None else {}
    return IndexToString(inputCol=input_col, outputCol=output_col, **kw).transform(df)


# --- vectors ----------------------------------------------------------------

def vector_indexer(input_col: str, output_col: str, max_categories: int = 20,
                   handle_invalid: str = "keep") -> VectorIndexer:
    """Features with <= max_categories distinct values become category
    indices (ascending values, 0.0 always index 0); others pass through.
    ``keep`` maps a value unseen at fit time to an extra index instead of
    failing on a fold that lacks it."""
    return VectorIndexer(inputCol=input_col, outputCol=output_col,
                         maxCategories=max_categories, handleInvalid=handle_invalid)


def category_report(spark: SparkSession, model) -> DataFrame:
    """(feature, value, index) for every categorical feature a fitted
    vector indexer chose."""
    rows = [(int(f), float(v), int(i))
            for f, m in sorted(model.categoryMaps.items()) for v, i in sorted(m.items())]
    schema = StructType([StructField("feature", IntegerType(), False),
                         StructField("value", DoubleType(), False),
                         StructField("index", IntegerType(), False)])
    return spark.createDataFrame(rows, schema)


def normalize(df: DataFrame, input_col: str, output_col: str = "norm", p: float = 2.0) -> DataFrame:
    """Scale each vector to unit p-norm (a zero vector stays zero)."""
    return Normalizer(inputCol=input_col, outputCol=output_col, p=p).transform(df)


def assembler(input_cols: Sequence[str], output_col: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """Numeric, boolean and vector columns into one vector; a null fails
    unless ``handle_invalid`` is 'skip' or 'keep'."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return assembler(input_cols, output_col, handle_invalid).transform(df)


# --- quantile buckets -------------------------------------------------------

def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> list[float]:
    """Exact quantiles: for each p the smallest value whose cumulative count
    reaches ceil(p * n), nulls and NaN skipped (the rule of an exact
    quantile summary).

    Values are first counted per distinct value (partial aggregation), then
    running counts are taken with the bucketed running sum, so no task holds
    the whole column.  One row per p comes back to the driver.
    """
    vals = df.select(F.col(q(column)).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    cum, tot = running_totals(counts, "v", ["n"], descending=False, with_totals=True)
    total = tot["n"]
    if total == 0:
        return []
    aggs = []
    for i, p in enumerate(probs):
        if p <= 0:
            aggs.append(F.min("v").alias(f"q{i}"))
        elif p >= 1:
            aggs.append(F.max("v").alias(f"q{i}"))
        else:
            target = math.ceil(p * total)
            aggs.append(F.min(F.when(F.col("cum_n") >= F.lit(target), F.col("v"))).alias(f"q{i}"))
    row = cum.agg(*aggs).first()
    return [float(row[f"q{i}"]) for i in range(len(probs))]


def quantile_splits(df: DataFrame, column: str, num_buckets: int, exact: bool = True,
                    relative_error: float = 0.001) -> list[float]:
    """Bucket borders as a quantile discretizer makes them: quantiles at
    i/n, de-duplicated, outer borders at +-inf."""
    probs = [i / num_buckets for i in range(num_buckets + 1)]
    if exact:
        qs = exact_quantiles(df, column, probs)
    else:
        qs = df.approxQuantile(column, probs, relative_error)
    inner = sorted(set(qs[1:-1]))
    return [-math.inf] + inner + [math.inf]


def quantile_bucket(df: DataFrame, input_col: str, output_col: str, num_buckets: int,
                    exact: bool = True, relative_error: float = 0.001,
                    handle_invalid: str = "keep") -> tuple[DataFrame, list[float]]:
    """Equal-frequency buckets.  ``exact`` uses exact distributed quantiles;
    otherwise the approximate summary of ``QuantileDiscretizer``."""
    if exact:
        splits = quantile_splits(df, input_col, num_buckets, True)
        model = Bucketizer(splits=splits, inputCol=input_col, outputCol=output_col,
                           handleInvalid=handle_invalid)
    else:
        model = QuantileDiscretizer(numBuckets=num_buckets, inputCol=input_col,
                                    outputCol=output_col, relativeError=relative_error,
                                    handleInvalid=handle_invalid).fit(df)
        splits = list(model.getSplits())
    return model.transform(df), splits


def one_hot(input_col: str, output_col: str, drop_last: bool = True,
            handle_invalid: str = "error") -> OneHotEncoder:
    """Index -> one-hot vector (an estimator: it learns the category count)."""
    return OneHotEncoder(inputCols=[input_col], outputCols=[output_col], dropLast=drop_last,
                         handleInvalid=handle_invalid)
