"""Linear classifiers fitted together, one aggregate per step.

``fit_logistic`` fits all settings of a search on all folds at once: binary
logistic regressions with elastic net, as many as there are (fold, setting)
pairs.  A step is one Spark job over the kept rows.  Each task works out, for
every model that is still moving, the loss, gradient and curvature over its
rows in numpy; Spark sums them by position; the driver takes a proximal
Newton step for each model (coordinate descent on a quadratic with the size
of the model) and halves it where the loss did not fall enough.  Some ten
steps settle a whole grid, where separate fits run hundreds of jobs.

``fit_hinge_l1`` is the linear SVM with an L1 penalty: proximal sub-gradient
steps, one aggregate each, for any number of penalties together.

What reaches the driver has the size of the models: terms squared for each
logistic model, terms for each hinge model.  ``MAX_TERMS`` bounds the former.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Features up to which curvatures are summed (a model's is its square).
MAX_TERMS = 128


@dataclass(frozen=True)
class Setting:
    """What a logistic regression is fitted with."""

    reg: float = 0.0
    elastic: float = 0.0
    fit_intercept: bool = True
    standardization: bool = True
    threshold: float = 0.5


_BLOCK = "set int, n int, valid binary, label binary, features binary"


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (_set int from 0, _valid boolean, label double, features
    array<double>) as matrices, one row for the rows of a set in an Arrow
    batch.  Kept once, they are read by every step without being converted
    again.  Rows with a null raise."""
    def pack(batches):
        for b in batches:
            sets = b.column(0).to_numpy()
            valid = b.column(1).to_numpy(zero_copy_only=False)
            label = b.column(2).to_numpy()
            out = []
            for k in np.unique(sets).tolist():
                at = np.flatnonzero(sets == k)
                matrix = b.column(3).take(pa.array(at)).flatten().to_numpy()
                out.append((k, len(at), valid[at].tobytes(), label[at].tobytes(), matrix.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=_NAMES)

    return rows.select("_set", "_valid", "label", "features").mapInArrow(pack, _BLOCK)


_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
_NAMES = ["set", "n", "valid", "label", "features"]


def summed(packed: DataFrame, work: Callable, size: int) -> np.ndarray:
    """``work(set, valid, labels, matrix, out)`` adds a block's share to the
    vector ``out``; the vectors of all tasks are added up by Spark."""
    def partial(batches):
        out = np.zeros(size)
        for b in batches:
            for k, n, valid, label, matrix in zip(*[c.to_pylist() for c in b.columns], strict=True):
                work(k, np.frombuffer(valid, bool), np.frombuffer(label), np.frombuffer(matrix).reshape(n, -1), out)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out[at])], names=["at", "v"])

    total = np.zeros(size)
    found = packed.mapInArrow(partial, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    total[found.column("at").to_numpy()] = found.column("v").to_numpy()
    return total


def moments(packed: DataFrame, sizes: Sequence[int]) -> list[tuple]:
    """(rows, share of label 1, means, sample deviations) of each set's
    training rows.  Labels other than 0 and 1 raise."""
    begin = np.append(0, np.cumsum([4 + 2 * d for d in sizes]))

    def work(k, valid, y, x, out):
        y, x = y[~valid], x[~valid]
        part = out[begin[k]:begin[k + 1]]
        part[0] += len(y)
        part[1] += y.sum()
        part[2] += ((y != 0) & (y != 1)).sum()
        part[4:4 + sizes[k]] += x.sum(axis=0)
        part[4 + sizes[k]:] += (x * x).sum(axis=0)

    total = summed(packed, work, int(begin[-1]))
    out = []
    for k, d in enumerate(sizes):
        n, ones, bad = total[begin[k]:begin[k] + 3]
        if bad:
            raise ValueError(f"{int(bad)} labels are neither 0 nor 1")
        mean = total[begin[k] + 4:begin[k] + 4 + d] / max(n, 1)
        square = total[begin[k] + 4 + d:begin[k + 1]]
        spread = np.maximum(square - n * mean * mean, 0)
        spread[spread <= 1e-14 * square] = 0                       # a constant feature
        out.append((n, ones / max(n, 1), mean, np.sqrt(spread / max(n - 1, 1))))
    return out


@dataclass
class Model:
    """A logistic model while it is fitted; ``at`` holds the intercept and the
    coefficients of the standardised features."""

    set: int
    setting: Setting
    mean: np.ndarray
    deviation: np.ndarray
    l1: np.ndarray
    l2: np.ndarray
    at: np.ndarray
    trial: np.ndarray = field(default=None)
    value: float = np.inf
    move: np.ndarray = field(default=None)
    slope: float = 0.0
    length: float = 1.0
    done: bool = False

    @property
    def scale(self) -> np.ndarray:
        return np.where(self.deviation > 0, 1 / np.where(self.deviation > 0, self.deviation, 1), 0.0)

    @property
    def coefficients(self) -> np.ndarray:
        return self.at[1:] * self.scale

    @property
    def intercept(self) -> float:
        return float(self.at[0] - (self.mean * self.coefficients).sum()) if self.setting.fit_intercept else 0.0

    def penalty(self, at: np.ndarray) -> float:
        return float((self.l1 * np.abs(at)).sum() + (self.l2 * at * at).sum() / 2)

    def take(self, loss: float, gradient: np.ndarray, curvature: np.ndarray, tol: float) -> None:
        """Judge the trial point by its loss; set the next one."""
        value = loss + self.penalty(self.trial)
        if not value <= self.value + 1e-4 * self.length * self.slope + 1e-15 * abs(value):
            self.length /= 2
            self.done = self.length < 1e-8
            self.trial = self.at + self.length * self.move
            return
        self.at, self.value = self.trial, value
        self.move = newton_move(self.at, gradient, curvature, self.l1, self.l2)
        self.slope = float(gradient @ self.move) + self.penalty(self.at + self.move) - self.penalty(self.at)
        self.done = self.slope > -tol * max(1.0, abs(value))
        self.length, self.trial = 1.0, self.at + self.move


def newton_move(at, gradient, curvature, l1, l2) -> np.ndarray:
    """The move that minimises the quadratic model with its penalties."""
    h = curvature + 1e-12 * np.eye(len(at))
    if not l1.any():
        return np.linalg.solve(h + np.diag(l2), -(gradient + l2 * at))
    move, slope = np.zeros(len(at)), gradient.copy()                 # slope of the smooth part at the move
    for _ in range(10_000):
        widest = 0.0
        for j in range(len(at)):
            curve = h[j, j] + l2[j]
            here = at[j] + move[j]
            target = h[j, j] * here - slope[j]
            new = np.sign(target) * max(abs(target) - l1[j], 0.0) / curve
            change = new - here
            if change:
                move[j] += change
                slope += change * h[:, j]
                widest = max(widest, abs(change))
        if widest < 1e-12:
            break
    return move


def fit_logistic(packed: DataFrame, sizes: Sequence[int], settings: Sequence[Setting], max_steps: int = 100,
                 tol: float = 1e-11) -> list[list[Model]]:
    """Models by set and setting, on kept blocks; rows that are valid count in
    no fit.  ``sizes``: the features of each set.  The objective is that of
    ``pyspark.ml``: mean log loss and reg * (elastic * L1 + (1 - elastic) / 2 *
    L2) of the coefficients, in deviations of their features if standardised."""
    models = []
    for k, (n, share, mean, deviation) in enumerate(moments(packed, sizes)):
        scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1), 0.0)
        for s in settings:
            weight = np.ones(sizes[k]) if s.standardization else scale
            at = np.zeros(sizes[k] + 1)
            one_class = s.fit_intercept and (share in (0, 1))
            if s.fit_intercept:
                at[0] = np.inf * (2 * share - 1) if one_class else np.log(share / (1 - share))
            models.append(Model(k, s, mean, deviation, np.append(0, s.reg * s.elastic * weight),
                                np.append(0, s.reg * (1 - s.elastic) * weight * weight), at, at, done=one_class or n == 0))
    for _ in range(max_steps):
        moving = [m for m in models if not m.done]
        if not moving:
            break
        for m, found in zip(moving, _curvatures(packed, sizes, moving), strict=True):
            m.take(*found, tol)
    by_set = [[] for _ in sizes]
    for m in models:
        by_set[m.set].append(m)
    return by_set


def _curvatures(packed: DataFrame, sizes: Sequence[int], moving: Sequence[Model]) -> list[tuple]:
    """(mean log loss, gradient, curvature) of each model at its trial point,
    over its set's training rows: one job."""
    widths = [2 + (d := sizes[m.set] + 1) + d * d for m in moving]
    begin = np.append(0, np.cumsum(widths))
    plans = [(m.set, m.mean, m.scale, m.setting.fit_intercept, m.trial) for m in moving]

    def work(k, valid, y, x, out):
        y, x = y[~valid], x[~valid]
        ready: dict = {}
        for i, (of, mean, scale, centred, at) in enumerate(plans):
            if of != k or not len(y):
                continue
            if centred not in ready:
                z = (x - mean) * scale if centred else x * scale
                ready[centred] = np.column_stack([np.full(len(y), float(centred)), z])
            z = ready[centred]
            margin = z @ at
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            d = len(at)
            part = out[begin[i]:begin[i + 1]]
            part[0] += len(y)
            part[1] += (np.logaddexp(0, margin) - y * margin).sum()
            part[2:2 + d] += (p - y) @ z
            part[2 + d:] += (z.T @ (z * (p * (1 - p))[:, None])).ravel()

    total = summed(packed, work, int(begin[-1]))
    out = []
    for i, m in enumerate(moving):
        n, loss, *rest = total[begin[i]:begin[i + 1]]
        d = len(m.trial)
        rest = np.array(rest) / n
        out.append((loss / n, rest[:d], rest[d:].reshape(d, d)))
    return out


def accuracies(packed: DataFrame, by_set: Sequence[Sequence[Model]]) -> list[list[float]]:
    """Share of each set's valid rows that each of its models names rightly:
    one job for all."""
    plans = [np.array([[m.intercept, np.log(m.setting.threshold / (1 - m.setting.threshold)) if 0 < m.setting.threshold < 1 else
                        (np.inf if m.setting.threshold >= 1 else -np.inf), *m.coefficients] for m in models]) for models in by_set]
    begin = np.append(0, np.cumsum([1 + len(p) for p in plans]))

    def work(k, valid, y, x, out):
        y, x = y[valid], x[valid]
        margins = x @ plans[k][:, 2:].T + plans[k][:, 0]
        part = out[begin[k]:begin[k + 1]]
        part[0] += len(y)
        part[1:] += ((margins > plans[k][:, 1]) == y[:, None]).sum(axis=0)

    total = summed(packed, work, int(begin[-1]))
    return [(total[a + 1:b] / total[a]).tolist() if total[a] else [float("nan")] * (b - a - 1) for a, b in zip(begin, begin[1:], strict=False)]


@dataclass(frozen=True)
class HingeModel:
    """``prediction = intercept + coefficients . x > 0``, and the objective
    (mean hinge loss and reg * L1) of the point."""

    reg: float
    intercept: float
    coefficients: tuple
    objective: float


def fit_hinge_l1(packed: DataFrame, size: int, regs: Sequence[float], steps: int = 100, rate: float = 1.0,
                 fit_intercept: bool = True) -> list[HingeModel]:
    """Linear SVMs with an L1 penalty, one for each of ``regs``, on kept blocks
    of one set with labels 0 and 1.

    Step t moves against the mean sub-gradient by ``rate / sqrt(t)`` and
    shrinks the coefficients by that times the penalty.  Each step's aggregate
    also gives the objective at the point and at the running mean of the
    points; the best of all these is returned, so more steps never do worse.
    """
    width = size + 1
    at = np.zeros((len(regs), width))
    mean, best = at.copy(), [(np.inf, None)] * len(regs)
    weights = np.asarray(regs, float)
    for t in range(1, steps + 2):
        points = np.concatenate([at, mean])

        def work(k, valid, y, x, out, points=points):
            x, sign = np.column_stack([np.full(len(x), float(fit_intercept)), x])[~valid], (2 * y - 1)[~valid]
            slack = 1 - (x @ points.T) * sign[:, None]
            inside = slack > 0
            part = out.reshape(len(points), width + 2)
            part[:, 0] += len(x)
            part[:, 1] += np.where(inside, slack, 0).sum(axis=0)
            part[:, 2:] -= (inside * sign[:, None]).T @ x

        total = summed(packed, work, len(points) * (width + 2)).reshape(len(points), width + 2)
        n = max(total[0, 0], 1)
        losses = total[:, 1] / n + np.tile(weights, 2) * np.abs(points[:, 1:]).sum(axis=1)
        for i, loss in enumerate(losses):
            j = i % len(regs)
            if loss < best[j][0]:
                best[j] = (float(loss), points[i].copy())
        pace = rate / np.sqrt(t)
        at = at - pace * total[:len(regs), 2:] / n
        at[:, 1:] = np.sign(at[:, 1:]) * np.maximum(np.abs(at[:, 1:]) - pace * weights[:, None], 0)
        mean = mean + (at - mean) / t
    return [HingeModel(r, float(p[0]) if fit_intercept else 0.0, tuple(p[1:].tolist()), loss) for r, (loss, p) in zip(regs, best, strict=True)]
