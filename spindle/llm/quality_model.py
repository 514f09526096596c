"""Quality classifier: histogram gradient-boosted trees over document
statistics, flattened into arrays for numpy traversal.

Statistics of a text come from its bytes (class counts) and from its sets of
words, word pairs and lines.  The trees are fitted on at most
``4 * per_class`` labelled rows, chosen by hash; scoring looks at every
text as a whole.

Trees are complete and of one depth, kept as heap arrays: a node's children
are ``2i + 1`` and ``2i + 2``, so all rows go down all trees together.

Edge cases: null text is empty, and is scored like any other.  Without labels
all scores are 0.5; with labels of one class they are that class's share,
smoothed.  Null labels and labels without a document are ignored; several
labels of a document all count.  A null doc_id is held out.  Ties in the
choice of a split go to the first statistic and bin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.common import documents, map_text, remainder, sample_rows, utf8
from spindle.llm.registry import query
from spindle.session import read_table

CLASSES = ("space", "newline", "lower", "upper", "digit", "symbol", "mark", "other", "high")
STATISTICS = ("bytes", "words", "lines", "mean_word", *(f"share_{c}" for c in CLASSES),
              "distinct_words", "distinct_pairs", "distinct_lines")


def _byte_classes() -> np.ndarray:
    of = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in (("space", " \t\r\v\f"), ("newline", "\n"), ("symbol", "#*$%&|<>"), ("mark", ".,;:!?'\"()-")):
        of[[ord(c) for c in chars]] = CLASSES.index(name)
    of[0x61:0x7B], of[0x41:0x5B], of[0x30:0x3A] = (CLASSES.index(c) for c in ("lower", "upper", "digit"))
    of[0x80:] = CLASSES.index("high")
    return of


BYTE_CLASS = _byte_classes()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    raw, off = utf8(texts)
    n = len(texts)
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(off)
    code = BYTE_CLASS[raw] + np.repeat(np.arange(n) * len(CLASSES), size)
    counts = np.bincount(code, minlength=n * len(CLASSES)).reshape(n, -1)
    out[:, 4:13] = counts / np.maximum(size, 1)[:, None]
    data = raw.tobytes()
    for i in range(n):
        text = data[off[i]:off[i + 1]]
        words, lines = text.split(), text.split(b"\n")
        k = len(words)
        kinds = set(words)
        out[i, [0, 1, 2]] = np.log1p([len(text), k, len(lines)])
        if k:
            out[i, 3] = sum(map(len, words)) / k
            out[i, 13] = len(kinds) / k
            out[i, 14] = len(set(zip(words, words[1:], strict=False))) / max(1, k - 1)
        out[i, 15] = len(set(lines)) / len(lines)
    return out


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
              ridge: float = 1.0, least: int = 20) -> dict:
    """Second-order boosting of the logistic loss on binned columns."""
    n, d = x.shape
    prior = (y.sum() + 0.5) / (n + 1.0) if n else 0.5
    model = {"base": float(np.log(prior / (1 - prior))), "depth": depth, "feature": np.zeros((0, 2 ** depth - 1), np.int64),
             "limit": np.zeros((0, 2 ** depth - 1)), "leaf": np.zeros((0, 2 ** depth))}
    if n == 0 or y.min() == y.max():
        return model
    borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(borders[j], x[:, j], "left") for j in range(d)], 1)
    flat = binned + np.arange(d) * bins
    score = np.full(n, model["base"])
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, limit = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            key = ((at - first)[:, None] * (d * bins) + flat).ravel()
            hist = [np.bincount(key, np.repeat(v, d), width * d * bins).reshape(width, d, bins) for v in (g, h, np.ones(n))]
            gl, hl, nl = (np.cumsum(v, 2) for v in hist)
            gt, ht, nt = (v[:, :, -1:] for v in (gl, hl, nl))
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain[(nl < least) | (nt - nl < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(borders[j]):
                    feature[first + k], limit[first + k] = j, borders[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > limit[at])
        leaf = at - (2 ** depth - 1)
        value = -rate * np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + ridge)
        score += value[leaf]
        features.append(feature)
        limits.append(limit)
        leaves.append(value)
    return model | {"feature": np.array(features), "limit": np.array(limits), "leaf": np.array(leaves)}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of class 1: every row goes down every tree at once."""
    k, rows = len(model["feature"]), np.arange(len(x))[:, None]
    if not k:
        return np.full(len(x), 1 / (1 + np.exp(-model["base"])))
    at, tree = np.zeros((len(x), k), np.int64), np.arange(k)
    for _ in range(model["depth"]):
        at = 2 * at + 1 + (x[rows, model["feature"][tree, at]] > model["limit"][tree, at])
    score = model["base"] + model["leaf"][tree, at - (2 ** model["depth"] - 1)].sum(1)
    return 1 / (1 + np.exp(-score))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text and label of at most ``4 * per_class`` labelled rows."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    rows = sample_rows(known, "label", per_class, "doc_id", "label")
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", per_class: int = 6000, **options) -> dict:
    fields = [T.StructField("x", T.ArrayType(T.DoubleType()))]

    def make():
        return lambda texts: [pa.array(list(statistics(texts)), pa.list_(pa.float64()))]

    rows = map_text(labelled_sample(docs, labels, label, per_class), fields, make, keep=("doc_id", "label")).collect()
    rows.sort(key=lambda r: (str(r["doc_id"]), r["label"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(STATISTICS))
    return fit_trees(x, np.array([r["label"] for r in rows], float), **options)


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [pa.array(predict(shared.value, statistics(texts)), pa.float64())]

    return map_text(docs, [T.StructField("score", T.DoubleType())], make)


@query("op4_quality_classifier")
def op4_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(True))
    labels = read_table(spark, sf_dir, "labels")
    model = fit(docs.filter(~held), labels.filter(~held))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
