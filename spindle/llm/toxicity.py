"""Toxicity by a weighted finite-state pattern grammar.

Words become tags: insults of three strengths, threat verbs, targets,
negations, report verbs, clause ends and other words.  Five small weighted
transducers read the tags: insults weigh by their strength, a target close
to an insult adds to it, a threat verb followed by a target weighs, a
negation shortly before takes away, and so does a report verb earlier in the
clause.  They are composed into one table; a text's clauses are run
through it, so what is scored are matched clauses.  A logistic function of
the strongest clause, the sum and the length gives the probability.

The insult lexicon has fixed seeds and what a bounded labelled sample
(``2 * per_class`` rows of each class at most) teaches: words, and stems
with something after them, that occur in toxic texts far more often.  Near
copies in the sample count once, so that a copied text does not make
its own words insults.

Edge cases: null text is empty and scores like a text without matches;
without labels the seeds alone count, with fixed weights.  Null labels,
labels without a document and labels other than 0 and 1 are ignored.  A
null doc_id is held out.  Ties in the lexicon are kept.  Repeated rows get
equal scores.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.common import documents, filter_text, map_text, remainder
from spindle.llm.quality_model import labelled_sample
from spindle.llm.registry import query
from spindle.session import read_table

OTHER, END, TARGET, NEGATION, REPORT, THREAT, WEAK, MEDIUM, STRONG = range(9)
TAGS = 9
STRENGTH = {WEAK: 1.0, MEDIUM: 2.0, STRONG: 3.0}

# Seeds of the lexicon.
SEEDS = {
    STRONG: "idiot moron scum worthless".split(),
    MEDIUM: "stupid loser pathetic disgusting trash clown filth vermin imbecile cretin".split(),
    THREAT: "kill hurt destroy beat burn shoot stab smash crush".split(),
    TARGET: "you your yourself he she him her they them this these those".split(),
    NEGATION: "not never no nobody isn't aren't wasn't don't without nicht kein keine nie pas jamais nunca ningún".split(),
    REPORT: "said says wrote quoted reported claimed called alleged according sagte schrieb dit écrit dijo escribió".split(),
}
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]+")
ENDS = frozenset(".!?;\n")


# --- transducers: dicts (state, tag) -> (state, weight); state 0 starts, missing arcs stay at no weight


def insult_transducer() -> dict:
    return {(0, tag): (0, w) for tag, w in STRENGTH.items()}


def near(first: int, second, weight, reach: int, both_ways: bool = True) -> dict:
    """``second`` within ``reach`` tags after ``first`` (or before it) weighs
    ``weight(tag)``.  States count down from the last ``first`` (1 to reach),
    or the last ``second`` (beyond)."""
    arcs = {}
    states = range(2 * reach + 1 if both_ways else reach + 1)
    last = None if not second else max(second, key=lambda t: abs(weight(t)))
    for s in states:
        left = s if s <= reach else s - reach
        for tag in range(TAGS):
            if tag == END:
                arcs[s, tag] = (0, 0.0)
            elif tag == first:
                arcs[s, tag] = (reach, weight(last) if s > reach else 0.0)
            elif tag in second:
                arcs[s, tag] = (2 * reach if both_ways and not 0 < s <= reach else (s - 1 if 0 < s <= reach else 0),
                                weight(tag) if 0 < s <= reach else 0.0)
            elif s:
                arcs[s, tag] = (s - 1 if left > 1 else 0, 0.0)
    return arcs


def target_transducer() -> dict:
    return near(TARGET, STRENGTH, lambda t: 0.5, reach=4)


def threat_transducer() -> dict:
    return near(THREAT, (TARGET,), lambda t: 2.5, reach=3, both_ways=False)


def negation_transducer() -> dict:
    return near(NEGATION, STRENGTH, lambda t: -0.7 * STRENGTH[t], reach=3, both_ways=False)


def report_transducer() -> dict:
    """A report verb holds until the clause ends."""
    arcs = {(s, END): (0, 0.0) for s in (0, 1)} | {(s, REPORT): (1, 0.0) for s in (0, 1)}
    return arcs | {(1, t): (1, -0.4 * w) for t, w in STRENGTH.items()}


def compose(a: dict, b: dict) -> dict:
    """Both read the same tags; states pair up and weights add.  Only pairs
    that can be reached are made, numbered from the start pair."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for tag in range(TAGS):
            (p, v), (q, w) = a.get((pair[0], tag), (pair[0], 0.0)), b.get((pair[1], tag), (pair[1], 0.0))
            if (p, q) not in number:
                number[p, q] = len(number)
                todo.append((p, q))
            arcs[number[pair], tag] = (number[p, q], v + w)
    return arcs


def grammar() -> tuple[list[list[int]], list[list[float]]]:
    """The composed transducer as tables: next state and weight by state and tag."""
    whole = insult_transducer()
    for part in (target_transducer(), threat_transducer(), negation_transducer(), report_transducer()):
        whole = compose(whole, part)
    n = 1 + max(s for s, _ in whole)
    return [[whole[s, t][0] for t in range(TAGS)] for s in range(n)], [[whole[s, t][1] for t in range(TAGS)] for s in range(n)]


# --- tags


class Tagger(dict):
    """Word to tag; words not met before are looked up by their stems.  At
    most ``room`` such words are remembered."""

    def __init__(self, words: dict[str, int], stems: dict[str, int], room: int = 200_000):
        super().__init__(words)
        self.stems, self.room = stems, room
        self.sizes = sorted({len(s) for s in stems}, reverse=True)

    def __missing__(self, word: str) -> int:
        if word[0] in ENDS:
            tag = END
        else:
            tag = max((self.stems.get(word[:k], OTHER) for k in self.sizes if len(word) > k), default=OTHER)
        if len(self) < self.room:
            self[word] = tag
        return tag


def clause_weights(tags: list[int], table) -> list[float]:
    """Weights of the clauses in which anything weighs."""
    to, weight = table
    out, state, total = [], 0, 0.0
    for tag in tags:
        total += weight[state][tag]
        state = to[state][tag]
        if tag == END:
            if total:
                out.append(total)
            total = 0.0
    return [*out, total] if total else out


SCORING = frozenset((THREAT, WEAK, MEDIUM, STRONG))


def features(texts: pa.Array, tagger: Tagger, table) -> np.ndarray:
    """1, the strongest clause, the sum of clauses (both damped), log words."""
    out = np.zeros((len(texts), 4))
    out[:, 0] = 1.0
    for i, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        tags = list(map(tagger.__getitem__, TOKEN.findall(text.lower())))
        out[i, 3] = np.log1p(len(tags))
        if not SCORING.isdisjoint(tags):
            weights = clause_weights(tags, table)
            if weights:
                out[i, 1], out[i, 2] = min(max(weights), 6.0), np.log1p(max(0.0, sum(weights)))
    return out


# --- learning


def _signatures(words: list[str]) -> list[tuple[int, int]]:
    """A few minima over five-word runs; near copies share one."""
    runs = {zlib.crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))}
    return [(k, min((r * m + 1) & 0xFFFFFFFF for r in runs)) for k, m in enumerate((0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35))]


def _grams(words: set[str], shortest: int) -> set[tuple[str, bool]]:
    """Whole words (False) and their proper beginnings (True)."""
    return {(w, False) for w in words} | {(w[:k], True) for w in words for k in range(shortest, len(w))}


def learn_lexicon(rows: list[tuple[str, int]], *, support: int = 6, odds: float = 2.0, shortest: int = 4) -> tuple[dict, dict]:
    """Words and stems whose log odds of a toxic text are ``odds`` or more."""
    seen: set = set()
    sets: dict[int, list[set[str]]] = {0: [], 1: []}
    for text, label in rows:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        marks = _signatures(words) if words else []
        if not words or not seen.isdisjoint(marks):
            continue
        seen.update(marks)
        sets[label].append(set(words))
    toxic, clean = sets[1], sets[0]
    a = Counter()
    for words in toxic:
        a.update(_grams(words, shortest))
    a = {g: n for g, n in a.items() if n >= support}
    b = Counter()
    for words in clean:
        b.update(g for g in _grams(words, shortest) if g in a)
    words, stems = {}, {}
    for (gram, is_stem), n in a.items():
        value = np.log((n + 0.5) / (len(toxic) + 1)) - np.log((b[gram, is_stem] + 0.5) / (len(clean) + 1))
        if value >= odds:
            (stems if is_stem else words)[gram] = STRONG if value >= 4 else MEDIUM if value >= 3 else WEAK
    return words, stems


def fit_logistic(x: np.ndarray, y: np.ndarray, *, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Newton steps with a ridge on all weights but the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Weights when there is nothing to learn from.
PRIOR = np.array([-3.0, 1.5, 0.5, 0.0])


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = 2500, **options) -> dict:
    """Lexicon and weights from labelled rows, ``4 * per_class`` at most."""
    rows = labelled_sample(docs, labels, label, per_class).collect()
    rows = sorted(((r["text"] or "", r["label"]) for r in rows), key=lambda r: (zlib.crc32(r[0].encode()), r))
    words, stems = learn_lexicon(rows, **options)
    for tag, seeds in SEEDS.items():
        for word in seeds:
            words[word] = max(tag, words.get(word, OTHER)) if tag in STRENGTH else tag
    model = {"words": words, "stems": stems, "weights": PRIOR}
    y = np.array([r[1] for r in rows], float)
    if len(y) and y.min() < y.max():
        x = features(pa.array([r[0] for r in rows], pa.string()), Tagger(words, stems), grammar())
        model["weights"] = fit_logistic(x, y)
    return model


def _scorer(shared):
    """In a task: texts to scores, and whether any clause of a text weighs."""
    model, table = shared.value, grammar()
    tagger = Tagger(model["words"], model["stems"])

    def score(texts):
        x = features(texts, tagger, table)
        z = np.clip(x @ model["weights"], -30, 30)
        return 1 / (1 + np.exp(-z)), x[:, 1] > 0

    return score


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = _scorer(shared)
        return lambda texts: [pa.array(score(texts)[0], pa.float64())]

    return map_text(docs, [T.StructField("score", T.DoubleType())], make)


def remove_toxic(docs: DataFrame, model: dict, limit: float = 0.5) -> DataFrame:
    """The documents, with all columns, that score under ``limit`` or have no
    clause that weighs: such texts score what the labels' share of toxic ones
    makes of them, which is no ground to reject one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = _scorer(shared)

        def stays(texts):
            scores, weighs = score(texts)
            return (scores < limit) | ~weighs

        return stays

    return filter_text(docs, make)


def train_part(docs: DataFrame, labels: DataFrame):
    """The rows that labels may be learnt from, and the test of the others."""
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(True))
    return docs.filter(~held), labels.filter(~held), held


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    train_docs, train_labels, held = train_part(docs, read_table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, fit(train_docs, train_labels))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
